"""Hard negatives by vertical scans: dimensions in each anchor's order, bounds on what is left shrink the candidates."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactum.llm.common import table
from pactum.plans.session import materialize

POSITIVES = NEGATIVES = 5
LOW_PERCENT, HIGH_PERCENT = 80, 100
SCALE = 256
#: Rows and numbers of a block of columns, anchors of a pack, and how many of each meet in one cell of the join.
BLOCK_ROWS, BLOCK_CELLS, PACK, CELL = 2048, 1 << 18, 256, 64
#: Dimensions read between two looks at the bounds, and anchors whose best scores so far a worker remembers.
STEP, MEMO = 8, 100_000
#: Above this a dot product may not be exact in doubles, and whole numbers of any size are used.
EXACT = 1 << 53


def scaled(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as whole doubles, or as Python numbers where doubles could not add them up exactly."""
    most = float(np.abs(x).max(initial=0.0)) * scale
    if most * most * max(1, x.shape[0]) < EXACT:
        return np.floor(x * scale)
    exact = [math.floor(v * scale) if abs(v * scale) < math.inf else int(v) * scale for v in x.ravel().tolist()]
    out = np.empty(x.size, object)
    out[:] = exact
    return out.reshape(x.shape)


def _written(lines: np.ndarray, scale: int) -> bytes:
    """The numbers and a letter for their kind: floor(scale * x) in two bytes where all of them fit, else doubles as they are."""
    fit = float(np.abs(lines).max(initial=0.0)) * abs(scale) < 1 << 15
    numbers = np.floor(lines * scale).astype(np.int16) if fit else lines
    return numbers.tobytes() + numbers.dtype.char.encode()


def _numbers(data: bytes, n: int) -> np.ndarray:
    """Lines of `n` numbers as they were written."""
    kind = np.dtype(data[-1:].decode())
    return np.frombuffer(data[:-1], kind).reshape(-1, n) if len(data) > 1 else np.zeros((0, n), kind)


def _read(data: bytes, n: int, scale: int) -> np.ndarray:
    """What `scaled` gives for the numbers."""
    numbers = _numbers(data, n)
    return numbers.astype(float) if numbers.dtype == np.int16 else scaled(numbers, scale)


def vertical_scan(columns: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of those that `keep` leaves in, their scores exact.

    `columns` has a line for each dimension, `low` and `high` its least and greatest value. Dimensions come in
    descending magnitude of the anchor; what those not yet read can add at least and at most bounds each
    row's score, and `keep(least, most)` says which rows may still matter.
    """
    dims = min(len(columns), len(anchor))
    order = np.argsort(-np.abs(anchor[:dims]).astype(float), kind="stable")
    q = anchor[order]
    ends = q * low[order], q * high[order]
    rest = [np.concatenate([np.cumsum(f(*ends)[::-1])[::-1], np.zeros(1, q.dtype)]) for f in (np.minimum, np.maximum)]
    scores = np.zeros(len(rows), columns.dtype if columns.dtype == object else q.dtype)
    whole = len(rows) == columns.shape[1]
    for at in range(0, dims, STEP):
        some = order[at:at + STEP]
        part = columns[some] if whole else columns[np.ix_(some, rows)]
        scores = scores + q[at:at + STEP] @ part
        then = min(at + STEP, dims)
        stay = keep(scores + rest[0][then], scores + rest[1][then])
        if not stay.all():
            rows, scores, whole = rows[stay], scores[stay], False
            if not len(rows):
                break
    return rows, scores


def _kth(values: np.ndarray, k: int):
    """The k-th greatest value, None if there are fewer."""
    return np.sort(values)[-k] if len(values) >= k else None


def _best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by score descending, then id, null ids last."""
    return np.lexsort((rows, ids[rows], nulls[rows], -scores))[:k]


def _blocks(most_rows: int, scale: int):
    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows cut into blocks, their vectors turned into columns; shorter vectors end in zeros."""
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, vectors, labels, anchors = batch.columns
            at = 0
            while at < batch.num_rows:
                take = most_rows
                while True:  # by the longest vector of those taken
                    lists = vectors.slice(at, take)
                    offsets = lists.offsets.to_numpy()
                    sizes = np.diff(offsets)
                    dims = int(sizes.max(initial=0))
                    if len(sizes) * dims <= BLOCK_CELLS or len(sizes) == 1:
                        break
                    take = max(1, min(len(sizes) // 2, BLOCK_CELLS // dims))
                n = len(sizes)
                lines = np.zeros((n, dims))
                lines[np.arange(dims) < sizes[:, None]] = lists.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
                own = ids.slice(at, n)
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (
                    first, n, own.fill_null(0).to_numpy().tobytes(), own.is_null().to_numpy(zero_copy_only=False).tobytes(),
                    labels.slice(at, n).to_numpy().tobytes(), anchors.slice(at, n).to_numpy(zero_copy_only=False).tobytes(),
                    _written(np.ascontiguousarray(lines.T), scale))], ["first", "n", "ids", "nulls", "labels", "anchors", "vectors"])
                first += n
                at += n
    return blocks


BLOCK_SCHEMA = "first bigint, n bigint, ids binary, nulls binary, labels binary, anchors binary, vectors binary"


def _anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of blocks that are anchors."""
    for batch in batches:
        for r in batch.to_pylist():
            at = np.flatnonzero(np.frombuffer(r["anchors"], bool))
            columns, kind = _numbers(r["vectors"], r["n"]), r["vectors"][-1:]
            ids = [None if null else i for i, null in zip(np.frombuffer(r["ids"], np.int64)[at].tolist(), np.frombuffer(r["nulls"], bool)[at], strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(r["first"] + at, pa.int64()), pa.array(ids, pa.int64()), pa.array(np.frombuffer(r["labels"], np.int64)[at]),
                pa.array([columns[:, k].tobytes() + kind for k in at], pa.binary())], ["anchor", "anchor_id", "label", "vector"])


def _packs(most: int):
    def packs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Up to `most` anchors in one row."""
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                yield pa.RecordBatch.from_arrays([pa.array([part["anchor"][0].as_py()], pa.int64())] + [
                    pa.array([part[c].to_pylist()], t) for c, t in (
                        ("anchor", pa.list_(pa.int64())), ("label", pa.list_(pa.int64())), ("vector", pa.list_(pa.binary())), ("tops", pa.list_(pa.list_(pa.int64()))))],
                    ["pack", "anchor", "label", "vector", "tops"])
    return packs


def _meet(blocks: DataFrame, anchors: DataFrame, purpose: str) -> DataFrame:
    """Each block with each pack of anchors, dealt into cells of a bounded number of both.

    Both sides are copied to their cells, which the planner's sizes do not tell; so neither is ever broadcast, as
    all copies would pass the driver. Packs are copied for some cells a partition, while their copies hold no more than the blocks'.
    """
    many = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_anchors = anchors.count()
    packs = materialize(anchors.repartition(max(1, n_anchors // PACK), "anchor").mapInArrow(
        _packs(PACK), "pack bigint, anchor array<bigint>, label array<bigint>, vector array<binary>, tops array<array<bigint>>"), purpose)
    n_packs = packs.count()
    n_blocks, n_rows = blocks.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    across = -(-n_packs // CELL) or 1
    down = min(n_blocks, max(-(-n_blocks // CELL), min(-(-4 * many // across), across * n_rows // max(1, n_anchors)))) or 1
    left = blocks.drop("anchors").withColumn("down", F.pmod(F.xxhash64("first"), F.lit(down))).withColumn("across", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    right = packs.withColumn("across", F.pmod(F.xxhash64("pack"), F.lit(across)).cast("int")).withColumn("down", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(down - 1).cast("bigint"))))
    return left.hint("merge").join(right, ["down", "across"]).drop("down", "across", "pack")


def _scan(scale: int, of_label: bool, k: int, low_percent: int = 0, high_percent: int = 100):
    """For each block and anchor the first k rows of the anchor's label, or the first k others in each of its windows.

    A window is named by its top, a positive's score; it goes from `low_percent` to `high_percent` of it.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[tuple[int, int | None], list] = {}  # the best k scores met so far, by anchor and window
        held: tuple[int, tuple] | None = None

        def known(key: tuple[int, int | None], scores: np.ndarray) -> None:
            if len(floors) > MEMO:
                floors.clear()
            floors[key] = sorted([*floors.get(key, []), *scores.tolist()])[-k:]

        for batch in batches:
            out: list[tuple] = []
            for r in range(batch.num_rows):
                first = batch["first"][r].as_py()
                if held is None or held[0] != first:
                    n = batch["n"][r].as_py()
                    columns = _read(batch["vectors"][r].as_py(), n, scale)
                    ids, nulls, labels = (np.frombuffer(batch[c][r].as_py(), t) for c, t in (("ids", np.int64), ("nulls", bool), ("labels", np.int64)))
                    held = first, (columns, columns.min(axis=1), columns.max(axis=1), ids, nulls, labels)
                columns, low, high, ids, nulls, labels = held[1]
                for anchor, label, vector, tops in zip(*(batch[c][r].as_py() for c in ("anchor", "label", "vector", "tops")), strict=True):
                    q = _read(vector, 1, scale)[:, 0]
                    exact = columns, low, high
                    most = float(np.abs(q).astype(float).max(initial=0.0)) * max(1.0, float(np.abs(low).astype(float).max(initial=0.0)), float(np.abs(high).astype(float).max(initial=0.0)))
                    if q.dtype != columns.dtype or most * max(1, len(q)) >= EXACT:
                        q, *exact = (np.array([int(v) for v in x.ravel()], object).reshape(x.shape) for x in (q, columns, low, high))
                    rows = np.flatnonzero(labels == label if of_label else labels != label)
                    if of_label:
                        rows = rows[rows != anchor - first]
                        found = {None: _positives(exact, q, rows, k, floors.get((anchor, None), []))}
                    else:
                        windows = {t: (-(-low_percent * t // 100), high_percent * t // 100) for t in set(tops or [])}
                        found = _negatives(exact, q, rows, k, windows, {t: floors.get((anchor, t), []) for t in windows})
                    for top, (at, scores) in found.items():
                        first_k = _best(at, scores, ids, nulls, k)
                        at, scores = at[first_k], scores[first_k]
                        known((anchor, top), scores)
                        out.extend((anchor, top, None if nulls[i] else int(ids[i]), first + int(i), int(s)) for i, s in zip(at, scores, strict=True))
            names = ("anchor", "top", "id", "row", "score")
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(5)], list(names))
    return scan


def _positives(exact, q: np.ndarray, rows: np.ndarray, k: int, best: list) -> tuple[np.ndarray, np.ndarray]:
    sure = best[0] if len(best) == k else None

    def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        floor = max((x for x in (sure, _kth(least, k)) if x is not None), default=None)
        return np.ones(len(most), bool) if floor is None else (most >= floor).astype(bool)

    return vertical_scan(*exact, q, rows, keep)


def _negatives(exact, q: np.ndarray, rows: np.ndarray, k: int, windows: dict, best: dict) -> dict:
    """For each window the rows whose scores lie in it and may be among its first k."""

    def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(most), bool)
        for top, (low, high) in windows.items():
            inside = least[((least >= low) & (most <= high)).astype(bool)]
            sure = [x for x in (best[top][0] if len(best[top]) == k else None, _kth(inside, k)) if x is not None]
            stay |= ((most >= max([low, *sure])) & (least <= high)).astype(bool)
        return stay

    rows, scores = vertical_scan(*exact, q, rows, keep)
    inside = {top: ((scores >= low) & (scores <= high)).astype(bool) for top, (low, high) in windows.items()}
    return {top: (rows[i], scores[i]) for top, i in inside.items() if i.any()}


_FOUND = "anchor bigint, top bigint, id bigint, row bigint, score bigint"


def hard_negatives(
    rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT, scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each anchor and each of its positives.

    Scores are exact inner products of floor(scale * component). The positives of an anchor are its first other
    rows of the same label, its negatives the first of other labels whose score is between `low_percent` and
    `high_percent` of the positive's; higher scores come first, ties by id (null ids last). Blocks of rows, turned into
    columns, meet packs of anchors; dimensions are read in each anchor's descending magnitude, and bounds on what is
    left shrink the candidates until the first k or the windows are exact. Only a few rows of each block and anchor are shuffled.

    Rows with a null label, a null vector, or a null or non-finite component take no part. Shorter vectors count as
    ending in zeros. Repeated rows are rows of their own: copies of an anchor are other rows, and each repeated
    anchor gives its own result. A score that passes 64 bits is an error. No anchors or an empty table give no rows; other columns are ignored.
    """
    vector = F.col(vector_col).cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    narrow = rows.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("vector"), F.col(label_col).cast("bigint").alias("label"),
                         F.coalesce(anchors, F.lit(False)).alias("is_anchor"), sound.alias("sound"))
    narrow = narrow.filter("label is not null and vector is not null and sound").drop("sound")
    blocks = materialize(narrow.mapInArrow(_blocks(BLOCK_ROWS, scale), BLOCK_SCHEMA), "negatives-blocks")
    chosen = materialize(blocks.mapInArrow(_anchors, "anchor bigint, anchor_id bigint, label bigint, vector binary"), "negatives-anchors")
    first = F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")

    near = _meet(blocks, chosen.withColumn("tops", F.lit(None).cast("array<bigint>")), "negatives-packs").mapInArrow(_scan(scale, True, positives), _FOUND)
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(*first))
    best = materialize(near.withColumn("place", place).filter(F.col("place") <= positives)
                       .select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("top")), "negatives-positives")

    windows = best.groupBy("anchor").agg(F.collect_set("top").alias("tops"))  # at most `positives` each
    far = _meet(blocks, chosen.hint("merge").join(windows, "anchor"), "negatives-packs").mapInArrow(_scan(scale, False, negatives, low_percent, high_percent), _FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor", "top").orderBy(*first))
    found = materialize(far.withColumn("rank", rank).filter(F.col("rank") <= negatives), "negatives-found")
    return (best.join(found, ["anchor", "top"]).join(chosen.select("anchor", "anchor_id"), "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), F.col("top").alias("positive_score"), F.col("score").alias("negative_score")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.v, e.v)]) AS BIGINT) AS score
  FROM e AS a JOIN e ON a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
