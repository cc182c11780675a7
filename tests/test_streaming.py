from pyspark.sql import functions as F

from strandloom.functions import hooks
from strandloom.streaming.sessions import session_piles

D = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark):
    batch = spark.read.parquet(f"{D}/events.parquet")
    stream = spark.readStream.schema(batch.schema).option("pathGlobFilter", "events.parquet").parquet(D)
    out = session_piles(stream, "user_id", "ts", "30 minutes", "0 seconds")
    q = out.writeStream.format("memory").queryName("sessions").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = {tuple(r) for r in session_piles(batch, "user_id", "ts", "30 minutes", "0 seconds").collect()}
    got = {tuple(r) for r in spark.table("sessions").collect()}
    newest = batch.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    # what the watermark has passed is out, and equal to the batch
    assert got == {w for w in want if w[2] <= newest}


def test_hooks():
    hooks.register("twice", lambda x: 2 * x)
    assert hooks.resolve("twice")(3) == 6 and hooks.resolve("math:sqrt")(9) == 3


def test_stored_is_released(spark):
    import os

    from strandloom.plans import lineage

    df = lineage.stored(spark.range(5))
    at = lineage._MADE.folders[-1].removeprefix("file:")
    assert df.count() == 5 and os.path.isdir(at)
    assert lineage.release(spark) >= 1 and not os.path.isdir(at)
