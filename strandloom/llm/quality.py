"""Quality classifier as a sparse rule ensemble (operator 8).

Statistics of a text are gathered in one Arrow pass. A random forest of shallow trees over them gives its paths
as conjunctive rules; a lasso logistic regression over the rules' truth values gives each a weight, most of them
zero; the rest are compiled into one Spark column expression, which is all that scoring evaluates.

Fitting uses at most SAMPLE labelled rows, those with the least hash of their id; statistics are those of the
rows themselves, so nothing else of the corpus enters the model. Null texts count as empty and are scored.
Rows with a null id are scored and never learned from; extra columns are left out. Of several labels of one id the highest counts; of
equal hashes the smaller id is sampled. Repeated rows are scored alike, and learned from once for each row. A very long text is one pass.
An empty table gives an empty one, and no labels give the score 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.plans.lineage import stored

#: Labelled rows that a fit uses at most.
SAMPLE = 20_000
#: Rows of an Arrow batch that a worker takes apart and gives back at a time.
STEP = 512
STATS = (
    "log_words", "word_length", "upper", "digits", "stops", "symbols", "bars", "shouts", "foreign",
    "repeats", "distinct", "top_word", "line_words", "line_copies", "marked_words",
)

_CLASS = np.zeros(256, np.uint8)  # 0 other, 1 lower, 2 upper, 3 digit, 4 sentence mark, 5 symbol, 6 bar, 7 exclamation, 8 beyond ASCII
for _k, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:?'\"()-", "#$%&*+/<=>@[\\]^_`{}~", "|", "!"), 1):
    _CLASS[list(_chars.encode())] = _k
_CLASS[128:] = 8


def text_statistics(text: str) -> list[float]:
    """The STATS of one whole text; an empty one has zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(STATS)
    n = np.bincount(_CLASS[np.frombuffer(text.encode(), np.uint8)], minlength=9)
    shown, letters = max(1, n[1:].sum()), max(1, n[1] + n[2])
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    again = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    marked = sum(not w[-1].isalnum() and w[-1] not in ".,;:?" for w in words)
    return [
        float(np.log1p(len(words))), shown / len(words), n[2] / letters, n[3] / shown, n[4] / shown, n[5] / shown, n[6] / shown,
        n[7] / shown, n[8] / shown, again / len(words), len(seen) / len(words), max(seen.values()) / len(words),
        len(words) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)), marked / len(words),
    ]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, *keep, *STATS) of every row. A text that is kept goes through the workers once, and only some rows of a batch are taken apart at a time."""
    own = (id_col, *keep)
    rows = docs.select(*own, *(() if text_col in own else (text_col,)))
    at = rows.columns.index(text_col)
    out = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in own] + [f"{s} double" for s in STATS])

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, STEP):
                part = batch.slice(begin, STEP)
                got = np.array([text_statistics(t or "") for t in part.column(at).to_pylist()], np.float64)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(own)], *map(pa.array, got.T)], [*own, *STATS])

    return rows.mapInArrow(run, out)


Rule = tuple[tuple[int, float, float], ...]  # (statistic, above, at most) for each statistic it bounds


def _paths(node, bounds: dict[int, tuple[float, float]], out: set[Rule]) -> None:
    if bounds:
        out.add(tuple(sorted((f, lo, hi) for f, (lo, hi) in bounds.items())))
    if node.subtreeDepth() == 0:
        return
    f, at = node.split().featureIndex(), node.split().threshold()
    lo, hi = bounds.get(f, (-np.inf, np.inf))
    _paths(node.leftChild(), bounds | {f: (lo, min(hi, at))}, out)
    _paths(node.rightChild(), bounds | {f: (max(lo, at), hi)}, out)


def rule_column(rule: Rule) -> Column:
    tests = [F.col(STATS[f]) > lo for f, lo, _ in rule if lo > -np.inf] + [F.col(STATS[f]) <= hi for f, _, hi in rule if hi < np.inf]
    both = tests[0]
    for t in tests[1:]:
        both = both & t
    return both.cast("double")


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[tuple[float, Rule], ...]

    def score(self) -> Column:
        """Probability of label 1, over columns named as STATS."""
        total = F.lit(self.intercept)
        for w, r in self.rules:
            total = total + F.lit(w) * rule_column(r)
        return 1 / (1 + F.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE, trees: int = 24, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> RuleEnsemble:
    """Rules and weights from labelled rows; learn restricts them by their id. One class alone, or none, gives a constant score."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy(id_col).agg(F.max(label_col).cast("double").alias("__label")).orderBy(F.xxhash64(id_col), id_col).limit(sample)
    # at most `sample` ids: a bound that doesn't grow with the corpus
    rows = stored(statistics(docs.join(F.broadcast(known), id_col), id_col, text_col, ("__label",)))
    ones, n = rows.agg(F.sum("__label"), F.count("*")).first()
    if not n or ones in (0, n):
        return RuleEnsemble(0.0 if not n else 6.0 if ones else -6.0, ())
    # a bounded sample: few partitions, so that every round of the two fits is one small stage
    rows = rows.select("__label", array_to_vector(F.array(*STATS)).alias("features"), *STATS).coalesce(4)
    forest = RandomForestClassifier(labelCol="__label", numTrees=trees, maxDepth=depth, maxBins=64, seed=seed).fit(rows)
    found: set[Rule] = set()
    for tree in forest.trees:
        _paths(tree._java_obj.rootNode(), {}, found)
    rules = sorted(found)
    truth = rows.select("__label", array_to_vector(F.array(*map(rule_column, rules))).alias("features"))
    lasso = LogisticRegression(labelCol="__label", elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(truth)
    weights = lasso.coefficients.toArray()
    return RuleEnsemble(float(lasso.intercept), tuple((float(w), r) for w, r in zip(weights, rules) if w))


def predict(docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, *keep, score, predicted) of every row."""
    scored = statistics(docs, id_col, text_col, keep).withColumn("score", model.score())
    return scored.select(id_col, *keep, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def is_held_out(id_col: str = "doc_id") -> Column:
    """Ids whose crc32 as text leaves 1 when divided by 3; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
