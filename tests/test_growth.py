"""Steps that must not grow faster than their input: what plans hold, and how rows are dealt."""

from itertools import combinations

from pyspark.sql import functions as F

from strandloom.operators import assemble, events, folds, graph, intervals
from strandloom.plans import components, lineage
from strandloom.queries import annotation as queries_annotation
from strandloom.queries import events as queries_events
from strandloom.queries import models as queries_models
from strandloom.sources import formats, gtf_checks


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filters_over_parsed_hits_do_not_parse_again(spark):
    rows = spark.range(3).select(F.concat_ws("\t", *[F.col("id").cast("string")] * 21).alias("value"))
    assert optimized(events.filtered_hits(formats.psl(rows), 90, 20, "+")).count("split(") == 4  # the line and its three lists


def test_gtf_lines_are_parsed_once(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(gtf_checks, "stored", lambda df: kept.append(df) or lineage.stored(df))
    line = "c\ts\tCDS\t1\t9\t.\t+\t0\tgene_id \"g\"; transcript_id \"t\";"
    got = gtf_checks.transcript_errors(spark.createDataFrame([(line,)], "value string"))
    assert len(kept) == 1 and "split(" not in optimized(got)


def test_sample_is_dealt_by_its_rows(spark, monkeypatch):
    monkeypatch.setattr(lineage, "ROWS", 10)
    rows = spark.range(500).select((F.col("id") % 50).alias("contig"), "id", F.col("id").cast("int").alias("lend"), F.col("id").cast("int").alias("rend"), F.lit(1.0).alias("score"))
    assert lineage.dealt(rows, "contig").rdd.getNumPartitions() == 50
    assert intervals.stratified_sample(rows, ("contig",), 3, 100).count() == 150


def test_components_deal_more_rows_to_more_tasks(spark, monkeypatch):
    name, seen = "spark.sql.shuffle.partitions", []
    was = spark.conf.get(name)
    monkeypatch.setattr(lineage, "ROWS", 2)
    inner = components.stored
    monkeypatch.setattr(components, "stored", lambda df: seen.append(int(spark.conf.get(name))) or inner(df))
    got = components.connected_components(spark.range(200).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")))
    assert {r.component for r in got.collect()} == {0} and max(seen) >= 200 and spark.conf.get(name) == was


def test_gene_clusters_link_genes_only(spark, monkeypatch):
    links, inner = [], graph.connected_components
    monkeypatch.setattr(graph, "connected_components", lambda e, a, b: links.extend(e.collect()) or inner(e, a, b))
    iv = spark.createDataFrame([(1, i, 10, 20, "+") for i in range(20)] + [(1, 30, 90, 95, "+")], "contig long, id long, lend int, rend int, strand string")
    genes = spark.createDataFrame([(1, 7, 1, 25), (1, 8, 5, 30)], "contig long, id long, lend int, rend int")
    got = {r.id: r.cluster for r in graph.gene_clusters(iv, genes).collect()}
    assert got == {i: "gene:0" for i in range(20)} | {30: "pile:1:1"}
    assert {tuple(r) for r in links} == {(7, 8)}


def test_triangles_against_all_triples(spark):
    links = {(a, b) for a, b in combinations(range(40), 2) if (a * 7 + b * 11) % 3 == 0}
    want = {t for t in combinations(range(40), 3) if all(p in links for p in combinations(t, 2))}
    df = spark.createDataFrame(sorted(links), "a int, b int")
    got = graph.triangles(df.select(F.col("a").alias("u"), F.col("b").alias("v")), df, 3).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_folded_models_store_no_bases(spark):
    one = {"gene_id": "g", "kind": 0, "id": "m", "strand": "+", "lend": 1, "bases": "ACGT", "taken": False}
    rows = folds._rows(spark.createDataFrame([("c",)], "contig string"), **{n: F.lit(v) for n, v in one.items()})
    got = folds._pass(rows, folds.merge).first()
    assert (got.id, got.lend, got.bases) == ("m", 1, None)


def test_tables_stored_on_the_way_are_deleted(spark):
    def make():
        rows = lineage.stored(lineage.stored(spark.range(4)))
        return rows.where("id < 2"), rows.where("id > 0")

    since = lineage.mark()
    few, more = lineage.settled_all(spark, make)
    assert lineage.mark() - since == 2 and (few.count(), more.count()) == (2, 3)


def test_models_that_are_read_again_are_made_once(spark):
    d = "/root/testdata/sf0.001"
    for made in (queries_models.gene_gtf_round_trip, queries_annotation.coded, queries_events.annotation_update):
        assert not [f for f in made(spark, d).inputFiles() if "lineitem" in f]


def test_structures_are_stored_before_piles_read_them(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(assemble, "stored", lambda df: kept.append(df.columns) or lineage.stored(df))
    row = "1 AS contig, 7 AS acc, '+' AS strand, array(named_struct('lend', 1, 'rend', 9)) AS segments, 9D AS score"
    assert assemble.assemblies(spark.sql(f"SELECT {row}")).count() == 1
    assert kept[0] == ["contig", "acc", "strand", "segments", "score"]
