"""Exact selection of the lowest-hash rows per stratum, without sorting a stratum."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HASH_SPACE = 2147483648
BUCKETS = 65536


def flag_lowest(
    df: DataFrame,
    hash_col: Column,
    tiebreak: Sequence[str],
    quota: DataFrame,
    strata: Sequence[str],
    flag: str = "picked",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Mark the `quota.quota` rows of each stratum that come first by (hash, tiebreak).

    A stratum may hold most of the table, so it is never put into one window.
    A histogram of hash buckets (at most `buckets` rows per stratum) finds the
    bucket the quota runs out in; only rows of that bucket, about 1/`buckets` of
    the stratum, are ranked, which gives the last (hash, tiebreak) picked. One narrow
    comparison with it then decides every row: three reads in all. `quota` has one row
    per stratum; a stratum without one has quota 0. NULL is a stratum too.
    """
    width = HASH_SPACE // buckets
    keyed = df.withColumn("_hash", hash_col).withColumn("_bucket", F.floor(F.col("_hash") / width))

    def beside(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
        named = other.withColumnsRenamed({s: f"_of_{s}" for s in strata})
        same = reduce(lambda x, y: x & y, [rows[s].eqNullSafe(named[f"_of_{s}"]) for s in strata])
        return rows.join(named, same, how).drop(*[f"_of_{s}" for s in strata])

    by_stratum = Window.partitionBy(*strata).orderBy("_bucket")
    hist = (keyed.groupBy(*strata, "_bucket").agg(F.count("*").alias("_n"))
            .withColumn("_upto", F.sum("_n").over(by_stratum)))
    # One row per stratum: the first bucket reaching the quota, and what is left for it.
    cuts = (beside(hist, quota.select(*strata, "quota"), "left")
            .withColumn("quota", F.coalesce("quota", F.lit(0)))
            .filter(F.col("_upto") >= F.col("quota"))
            .groupBy(*strata)
            .agg(F.min(F.struct("_bucket", (F.col("quota") - F.col("_upto") + F.col("_n")).alias("left")))
                 .alias("_cut")))
    place = F.struct("_hash", *tiebreak)
    order = Window.partitionBy(*strata, "_bucket").orderBy("_hash", *tiebreak)
    edge = (beside(keyed.select(*dict.fromkeys([*strata, "_bucket", "_hash", *tiebreak])), cuts, "inner")
            .filter(F.col("_bucket") == F.col("_cut._bucket")).withColumn("_rank", F.row_number().over(order)))
    last = edge.groupBy(*strata).agg(
        F.first("_cut._bucket").alias("_edge"), F.max(F.when(F.col("_rank") <= F.col("_cut.left"), place)).alias("_last"))
    inside = F.coalesce((F.col("_bucket") == F.col("_edge")) & (place <= F.col("_last")), F.lit(False))
    # No edge: the stratum has fewer rows than its quota.
    picked = F.when(F.col("_edge").isNull(), F.lit(True)).otherwise((F.col("_bucket") < F.col("_edge")) | inside)
    return beside(keyed, last, "left").withColumn(flag, picked).drop("_hash", "_bucket", "_edge", "_last")
