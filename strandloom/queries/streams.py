"""Event-time queries, in their batch form; tests run the same functions on a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.queries.registry import query
from strandloom.sources.tables import table
from strandloom.streaming.sessions import session_piles, tumbling_counts


@query("""WITH m AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM m)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts) + INTERVAL 30 MINUTE) AS end_us, count(*) AS members FROM s GROUP BY user_id, k""")
def session_windows(spark, d):
    s = session_piles(table(spark, d, "events"), "user_id", "ts", "30 minutes", "1 day")
    return s.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "members")


@query("SELECT event_type, epoch_us(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01')) AS start_us, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_windows(spark, d):
    t = tumbling_counts(table(spark, d, "events"), "event_type", "ts", "6 hours", "1 day")
    return t.select("event_type", F.unix_micros("start").alias("start_us"), "n")
