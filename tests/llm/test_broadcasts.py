"""What is made of one row by the dozen is dealt, never sent whole by way of the driver."""

from strandloom.llm import lines, simhash
from strandloom.plans.lineage import stored


def exploded_broadcasts(df):
    """Nodes of df's first plan that are broadcast with an explode below them, and no shuffle between, which would show its true size."""

    def walk(node, above):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.initialPlan(), above)
        if name == "Exchange":
            above = ""
        above = above or (name if name.startswith("BroadcastExchange") else "")
        kids = node.children()
        return [above] * (name == "Generate" and bool(above)) + [x for i in range(kids.size()) for x in walk(kids.apply(i), above)]

    return walk(df._jdf.queryExecution().executedPlan(), "")


def test_index_of_fingerprints_is_not_broadcast(spark):
    """Spark sizes the index of 64 keys a fingerprint as the fingerprints themselves, far below its threshold."""
    fps = [0, 1, 3, 1 << 40, 0b11111, (1 << 62) + 1]
    found = simhash.links(stored(spark.createDataFrame([(x,) for x in fps], "fp bigint")))
    assert not exploded_broadcasts(found)
    want = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4}
    assert {(r.src, r.dst) for r in found.collect()} == want


def test_indexes_of_the_pipeline_are_not_broadcast(spark, monkeypatch):
    """What the stages of lines and of near copies store on their way."""
    seen = []

    def watched(df):
        seen.append(exploded_broadcasts(df))
        return stored(df)

    words = [f"word{i % 97}" for i in range(400)]
    texts = [" ".join(words[i : i + 60]) + f"\nA line that nearly all of them have, no {i % 3}." for i in range(40)]
    docs = stored(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    monkeypatch.setattr(simhash, "stored", watched)
    monkeypatch.setattr(lines, "stored", watched)
    kept = {r.doc_id: r.text.split("\n") for r in lines.line_dedup(docs).collect()}
    assert kept[0] == texts[0].split("\n") and not any(len(x) > 1 for i, x in kept.items() if i)
    assert simhash.similar_groups(docs).count() == len(texts)
    assert len(seen) > 10 and not any(seen)
