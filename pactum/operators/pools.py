"""Data pools: labelled tables, merging, splitting and profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactum.functions.metrics import key_hash
from pactum.operators.features import FEATURE_COLS
from pactum.plans.ranking import flag_lowest
from pactum.policy import SPLIT_SEED, VALIDATION_SHARE


def labelled_dataset(features: DataFrame, verdicts: DataFrame, on: Sequence[str] = ("path", "line"),
                     file: str = "file", columns: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """Features, label and source file of every unit that has a verdict."""
    return (features.join(verdicts.select(*on, "label"), list(on))
            .select(*columns, F.col("label").cast("int").alias("label"), F.col(file).alias("source_file")))


def merge_pools(first: DataFrame, second: DataFrame, key: str = "file", last_wins: bool = False) -> DataFrame:
    """Union by file name. A file in both comes from `first`, or from `second` with `last_wins`.

    The other pool only contributes its distinct names to the anti join, so copies
    of one file never pile up on that side, and adaptive execution may split the rest.
    """
    winner, loser = (second, first) if last_wins else (first, second)
    return winner.unionByName(loser.join(winner.select(key).distinct(), key, "left_anti").select(*winner.columns))


def train_quota(df: DataFrame, label: str, held_out: float) -> DataFrame:
    """(label, quota): rows of each label that train, by largest remainder.

    ceil(held_out * n) rows are held out overall.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    everything = Window.partitionBy()  # one row per label
    wide = counts.select(label, F.col("n").cast("decimal(38,0)").alias("n")).withColumn(
        "whole", F.sum("n").over(everything).cast("decimal(20,0)"))
    # Shares in millionths keep ceil exact.
    part = round(held_out * 1_000_000)
    train = wide.withColumn(
        "train", F.expr(f"CAST(whole - ((whole * {part}BD + 999999BD) div 1000000BD) AS DECIMAL(20,0))"))
    shares = train.select(
        label, F.expr("CAST(n AS DECIMAL(18,0)) * train div whole").alias("base"),
        F.expr("(CAST(n AS DECIMAL(18,0)) * train) % whole").alias("rest"), "train")
    rank = F.row_number().over(Window.partitionBy().orderBy(F.desc("rest"), label))
    spare = F.col("train") - F.sum("base").over(everything)
    return shares.withColumn("_extra", (rank <= spare).cast("int")).select(
        label, (F.col("base") + F.col("_extra")).cast("bigint").alias("quota"))


def stratified_split(df: DataFrame, key: str | Sequence[str], label: str = "label", held_out: float = VALIDATION_SHARE,
                     seed: int = SPLIT_SEED) -> DataFrame:
    """Add `is_train`: an exact split keeping label ratios, seeded, by a unique key of any columns.

    No label is ever sorted as a whole; see `flag_lowest`.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return flag_lowest(df, key_hash(keys, seed), keys, train_quota(df, label, held_out), [label], flag="is_train")


def approximate_split(df: DataFrame, key: str | Sequence[str], held_out: float = VALIDATION_SHARE,
                      seed: int = SPLIT_SEED) -> DataFrame:
    """Add `is_train` by hash threshold alone: narrow, sizes only near their targets."""
    return df.withColumn("is_train", key_hash(key, seed) >= int(held_out * 2147483648))


def pool_overlap(left: DataFrame, right: DataFrame, key: str = "file") -> DataFrame:
    """Distinct keys found in both pools; training and test data must give none."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_semi")


def content_overlap(left: DataFrame, right: DataFrame, content: str = "content") -> DataFrame:
    """Digests of texts found in both pools, whatever they are called."""
    def digests(df: DataFrame) -> DataFrame:
        return df.select(F.sha2(F.col(content), 256).alias("digest")).distinct()

    return digests(left).join(digests(right), "digest", "left_semi")


def unseen_only(units: DataFrame, *pools: DataFrame, key: str = "file") -> DataFrame:
    """Rows whose key is in none of the pools."""
    out = units
    for pool in pools:
        out = out.join(pool.select(key).distinct(), key, "left_anti")
    return out


def pool_profile(df: DataFrame, features: Sequence[str], pool: str = "pool", label: str = "label") -> DataFrame:
    """Rows, risky rows and mean / least / greatest of each feature by pool and label, with totals."""
    stats = [f(c) for c in features for f in (
        lambda c: F.round(F.avg(c), 6).alias(f"mean_{c}"), lambda c: F.min(c).alias(f"min_{c}"),
        lambda c: F.max(c).alias(f"max_{c}"))]
    grouped = df.rollup(pool, label).agg(
        F.grouping_id().cast("int").alias("level"), F.count("*").alias("n_rows"),
        F.sum(F.col(label).cast("bigint")).alias("n_risky"), *stats)
    return grouped
