"""Shards of near equal bytes by a k-d tree over document metadata."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactum.llm.common import BLANK, nested_cuts, table, unused
from pactum.plans.session import materialize

#: A place on an axis: 20 bits of the coordinate, then 40 bits of the text's hash to split ties.
AXIS_BITS, TIE_BITS = 20, 40
ROWS_PER_RUN = 100_000
AXES = ("log_bytes", "non_ascii", "blank_share", "line_share")


def text_metadata(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, axes, tie) of every row; all but the id depend on the text alone.

    Equal texts therefore lie at one point and are never split. Null and empty texts have one byte.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    n_bytes, n_chars = F.octet_length(text), F.length(text)
    per_char = F.greatest(n_chars, F.lit(1))
    return docs.select(
        F.col(id_col).alias(id_col),
        (n_bytes + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.log2(n_bytes + 1).alias("log_bytes"),
        ((n_bytes - n_chars) / per_char).alias("non_ascii"),
        (F.regexp_count(text, F.lit(BLANK)) / per_char).alias("blank_share"),
        ((n_chars - F.length(F.translate(text, "\n", ""))) / per_char).alias("line_share"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - TIE_BITS).alias("tie"))


def kd_shards(docs: DataFrame, target_bytes: float | None = None, shards: int | None = None,
              id_col: str = "doc_id", text_col: str = "text", keep_tie: bool = False) -> DataFrame:
    """One row per document: (id, size, text_crc32, shard, slot[, tie]).

    Law `bytes`: a node that is to become k leaves is cut at the weighted median along its
    widest axis (its range there against the whole table's), at the histogram cut nearest half its
    bytes; leaves are given out in proportion to the bytes on each side, so one very large group of
    equal texts takes the share it needs. Give the number of `shards`, or `target_bytes` for as many
    as bring each leaf to that size. Slots count from 0 without gaps within a shard. Only node sums are
    compared; nothing is sorted as a whole. Null ids are kept; repeated rows are rows; an empty table
    gives no rows; fewer different texts than shards leave shards empty. Other columns are ignored.
    """
    rows = materialize(text_metadata(docs, id_col, text_col)
                       .withColumn("node", F.lit(0)).withColumn("leaves", F.lit(0)), "shard-rows")
    whole = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("n"),
                     *[F.max(a).alias(f"max_{a}") for a in AXES], *[F.min(a).alias(f"min_{a}") for a in AXES]).first()
    if shards is None:
        shards = max(1, math.ceil((whole["bytes"] or 0) / target_bytes)) if target_bytes else 1
    rows = rows.withColumn("leaves", F.lit(shards))
    ranges = {a: max((whole[f"max_{a}"] or 0) - (whole[f"min_{a}"] or 0), 1e-12) for a in AXES}
    for _ in range(shards - 1):
        rows, left = _split(rows, ranges)
        if not left:
            break
    return _slots(rows, whole["n"], shards).select(
        id_col, "size", "text_crc32", F.col("node").alias("shard"), "slot", *["tie"] * keep_tie)


def _split(rows: DataFrame, ranges: dict[str, float]) -> tuple[DataFrame, bool]:
    """Cut every node that has more than one leaf to give; nodes are numbered by their first leaf."""
    open_rows = rows.filter("leaves > 1")
    stats = open_rows.groupBy("node", "leaves").agg(
        F.sum("size").alias("bytes"), *[F.min(a).alias(f"lo_{a}") for a in AXES], *[F.max(a).alias(f"hi_{a}") for a in AXES])
    widths = [F.struct(((F.col(f"hi_{a}") - F.col(f"lo_{a}")) / ranges[a]).alias("width"), F.lit(i).alias("axis"),
                       F.col(f"lo_{a}").alias("lo"), F.col(f"hi_{a}").alias("hi")) for i, a in enumerate(AXES)]
    nodes = materialize(stats.select("node", "leaves", "bytes", F.greatest(*widths).alias("cut_on")), "shard-nodes")
    if nodes.isEmpty():
        return rows, False
    axis = F.element_at(F.array(*AXES), F.col("cut_on.axis") + 1)
    step = F.floor((axis - F.col("cut_on.lo")) / F.greatest(F.col("cut_on.hi") - F.col("cut_on.lo"), F.lit(1e-12))
                   * ((1 << AXIS_BITS) - 1))
    place = F.shiftleft(step, TIE_BITS) + F.col("tie")
    goals = nodes.select("node", (F.col("bytes") * F.floor(F.col("leaves") / 2) / F.col("leaves")).alias("goal"))
    placed = open_rows.join(nodes.select("node", "cut_on"), "node").withColumn("place", place)
    cuts = nested_cuts(placed, ["node"], "place", "size", goals, "shard-cuts")
    sides = (placed.join(cuts, "node").groupBy("node")
             .agg(F.sum(F.when(F.col("place") < F.col("cut"), F.col("size"))).alias("left_bytes")))
    plan = nodes.join(cuts, "node").join(sides, "node").select(
        "node", "cut_on", "cut",
        F.least(F.greatest(F.round(F.col("leaves") * F.coalesce("left_bytes", F.lit(0)) / F.col("bytes")), F.lit(1)),
                F.col("leaves") - 1).cast("int").alias("to_left"))
    lower = F.col("place") < F.col("cut")
    moved = rows.join(materialize(plan, "shard-plan"), "node", "left").withColumn("place", place)
    cut = F.col("cut").isNotNull()
    node = F.when(cut & ~lower, F.col("node") + F.col("to_left")).otherwise(F.col("node"))
    leaves = F.when(cut & lower, F.col("to_left")).when(cut, F.col("leaves") - F.col("to_left")).otherwise(F.col("leaves"))
    kept = [c for c in rows.columns if c not in ("node", "leaves")]
    return materialize(moved.select(*kept, node.alias("node"), leaves.alias("leaves")), "shard-rows"), True


def _slots(rows: DataFrame, n_rows: int, shards: int) -> DataFrame:
    """Number the rows of each shard from 0, in runs of bounded size and their starts."""
    runs = max(64, math.ceil(n_rows / shards / ROWS_PER_RUN))
    ids = rows.columns[0]
    run = F.pmod(F.xxhash64(ids, "tie"), F.lit(runs))
    dealt = rows.withColumn("run", run)
    before = Window.partitionBy("node").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("node", "run").agg(F.count("*").alias("n"))
              .select("node", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    inside = Window.partitionBy("node", "run").orderBy(ids, "tie")
    return (dealt.withColumn("at", F.row_number().over(inside) - 1).join(starts, ["node", "run"])
            .withColumn("slot", (F.col("at") + F.col("start")).cast("bigint")).drop("run", "at", "start"))


def sharded_documents(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents with `shard` and `slot` added; columns of these names are replaced.

    Documents that share an id and a text share their place in the tree and get the slots of their group in turn.
    """
    docs = docs.drop("shard", "slot")
    placed = kd_shards(docs, shards=shards, id_col=id_col, text_col=text_col, keep_tie=True)
    twin = lambda key, tie: F.row_number().over(Window.partitionBy(key, tie).orderBy(F.lit(0)))
    once = placed.groupBy(id_col, "tie").count().filter("count > 1").isEmpty()
    tie = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), 64 - TIE_BITS)
    number = F.lit(1) if once else None
    named = placed.select(F.col(id_col).alias("p_id"), F.col("tie").alias("p_tie"), "shard", "slot")
    named = named.withColumn("p_turn", number if once else twin("p_id", "p_tie"))
    key, at = unused("p_key", docs.columns), unused("p_at", docs.columns)
    marked = docs.withColumn(key, tie)
    marked = marked.withColumn(at, number if once else twin(id_col, key))
    same = marked[id_col].eqNullSafe(named["p_id"]) & (marked[key] == named["p_tie"]) & (marked[at] == named["p_turn"])
    return marked.join(named, same).select(*[marked[c] for c in docs.columns], "shard", "slot")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
