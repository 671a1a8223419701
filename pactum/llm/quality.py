"""Quality scores from histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm.common import fold, hash60, table
from pactum.plans.session import materialize

#: Bound of the fit: labelled rows, lowest hashes first.
SAMPLE = 40_000
BINS, TREES, DEPTH, RATE, RIDGE, LEAST = 64, 80, 4, 0.15, 1.0, 8.0
THRESHOLD = 0.7
FEATURES = ("log_bytes", "upper", "lower", "digit", "blank", "line_feed", "stop_mark", "bracket", "symbol", "bar", "wide", "entropy", "log_words",
            "distinct_words", "top_word", "word_length", "longest_word", "single_letters", "marked_words", "shouted_words", "repeated_pairs",
            "log_lines", "distinct_lines", "line_length", "odd_lines", "worst_line")

_CLASS = np.zeros(256, np.int64)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".,;:!?'\"-", b"()[]{}<>",
                             b"#$%&*+/=@\\^_`~", b"|"), 1):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 10
_MARKS = frozenset("#$%&*+=@\\^_`~|!")


def statistics(text: str | None) -> list[float]:
    """FEATURES of one whole text; null is the empty text."""
    raw = (text or "").encode()
    size = max(len(raw), 1)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = np.bincount(_CLASS, counts, 11)[1:] / size
    seen = counts[counts > 0] / size
    words = (text or "").split()
    n = max(len(words), 1)
    kinds = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    marked = sum(k for w, k in kinds.items() if w[-1] in _MARKS or w[0] in _MARKS)
    shouted = sum(k for w, k in kinds.items() if len(w) > 1 and w.isupper())
    lines = (text or "").split("\n")
    odd = [sum(1 for c in line if c in _MARKS or c.isupper()) / max(len(line), 1) for line in lines]
    return [np.log1p(len(raw)), *share, float(-(seen * np.log2(seen)).sum()), np.log1p(len(words)), len(kinds) / n, max(kinds.values(), default=0) / n,
            sum(map(len, words)) / n, max(map(len, kinds), default=0), sum(k for w, k in kinds.items() if len(w) == 1) / n, marked / n, shouted / n,
            1 - len(pairs) / max(len(words) - 1, 1), np.log1p(len(lines)), len(set(lines)) / len(lines), size / len(lines),
            sum(x > 0.08 for x in odd) / len(odd), max(odd)]


@dataclass
class Forest:
    """Complete trees of one depth as arrays: node i has children 2 i + 1 and 2 i + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def margins(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            while at[0] < len(feature) if len(at) else False:
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            total += leaf[at - len(feature)]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Forest:
    """Boosted log loss; splits are sought in histograms of at most `bins` quantile bins for each feature."""
    inner, n_features = (1 << depth) - 1, x.shape[1] if x.ndim == 2 else len(FEATURES)
    mean = (y.sum() + 1) / (len(y) + 2)
    forest = Forest(float(np.log(mean / (1 - mean))), np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    if not len(y):
        return forest
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(n_features)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f]) for f in range(n_features)], 1)
    margin = np.full(len(y), forest.base)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            slot = ((at - first)[:, None] * n_features + np.arange(n_features)) * bins + binned
            g, h = (np.bincount(slot.ravel(), np.repeat(v, n_features), width * n_features * bins).reshape(width, n_features, bins).cumsum(2) for v in (gradient, curve))
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[(h < LEAST / 4) | (all_h - h < LEAST / 4)] = 0
            for f in range(n_features):
                gain[:, f, len(cuts[f]):] = 0
            best = gain.reshape(width, -1).argmax(1)
            for k in range(width):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-6:
                    forest.feature[tree, first + k], forest.limit[tree, first + k] = f, cuts[f][b]
            at = 2 * at + 1 + (x[np.arange(len(y)), forest.feature[tree, at]] > forest.limit[tree, at])
        leaf = at - inner
        sums = [np.bincount(leaf, v, inner + 1) for v in (gradient, curve)]
        forest.leaf[tree] = -rate * sums[0] / (sums[1] + RIDGE)
        margin += forest.leaf[tree][leaf]
    return forest


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: (id, score, predicted), from statistics of the whole text.

    Statistics are computed once and written. The trees are fitted on labelled rows with `learn` (an expression
    over the documents): all, or the share with the lowest hashes that makes about `sample` of them. Null text is empty and is scored too;
    null labels and ids teach nothing; a document with several labels counts once for each; without labels
    every score is 0.5. Repeated rows stay repeated, an empty table gives none, other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), learn.alias("learn"), hash60(F.col(id_col)).alias("place"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t.as_py()) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(stats, pa.list_(pa.float64()))], ["id", "learn", "place", "stats"])

    measured = materialize(rows.mapInArrow(measure, f"id {kind}, learn boolean, place bigint, stats array<double>"), "quality-statistics")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("label is not null")
    taught = materialize(measured.filter("learn").join(known, "id").select("place", "label", "stats"), "quality-labelled")
    cut = int(min(1.0, sample / max(1, taught.count())) * (1 << 60))
    got = sorted(taught.filter(F.col("place") < cut).collect(), key=lambda r: (r["place"], r["label"], r["stats"]))
    x = np.array([r["stats"] for r in got], float).reshape(len(got), len(FEATURES))
    model = docs.sparkSession.sparkContext.broadcast(fit(x, np.array([r["label"] for r in got], float)))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.scores(x), pa.float64())], ["id", "score"])

    return (measured.select("id", "stats").mapInArrow(score, f"id {kind}, score double").withColumnRenamed("id", id_col)
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 4) == 2
    scored = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")
