"""Helpers the training-data operators share: text, folds, repeated rows, order over many partitions."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactum.plans.session import materialize

#: White space of the contracts: space and tab to carriage return.
BLANK = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; `lower` alone would also change other letters."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def word_count(text: Column) -> Column:
    """Number of runs free of white space, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_BLANK)).cast("bigint"), F.lit(0).cast("bigint"))


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def hash60(*parts: Column) -> Column:
    """60 bits of md5 as a number, the same in any engine with md5. Null and empty parts differ."""
    joined = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 15), 16, 10).cast("bigint")


def unused(name: str, columns: Sequence[str]) -> str:
    """The name, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def repeat_copies(df: DataFrame, copies: str) -> DataFrame:
    """Give back as many rows as were folded into one."""
    return df.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop(copies)


def with_ordinal(df: DataFrame, order: Sequence[Column], purpose: str, partitions: int | None = None) -> DataFrame:
    """Add `ordinal`, 0 to n-1 in `order`, without bringing the rows into one task.

    Rows are dealt by range and written, which fixes what lies in each part; numbering
    works inside a part, and only one count per part is summed in one place. Rows
    that are equal in `order` stay in one part, so it should be close to unique.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(df.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), purpose)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("part").agg(F.count("*").alias("n"))
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    inside = Window.partitionBy("part").orderBy(*order)
    return (dealt.withColumn("ordinal", F.row_number().over(inside) - 1).join(starts, "part")
            .withColumn("ordinal", F.col("ordinal") + F.col("start")).drop("part", "start"))


def nested_cuts(
    rows: DataFrame, keys: Sequence[str], place: str, weight: str, goals: DataFrame, purpose: str,
    bits: int = 12, levels: int = 5,
) -> DataFrame:
    """For each key the cut whose weight at places below it comes nearest the goal: (keys, cut).

    Places are numbers below 2 ** (bits * levels). A histogram of 2 ** bits buckets per key
    finds the bucket in which the goal is passed; only that bucket is cut finer, until it holds
    one place. Nothing is sorted but the buckets of a key. All rows at one place go together.
    `goals` has the keys and `goal`. A goal at or above the whole weight cuts above all places.
    """
    span = bits * levels
    state = materialize(goals.select(*keys, F.col("goal").cast("double").alias("goal"),
                                     F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("under"),
                                     F.lit(True).alias("open")), purpose)
    upto = Window.partitionBy(*keys).orderBy("bucket")
    for level in range(levels):
        shift = span - bits * (level + 1)
        inner = rows.select(*keys, F.col(place).alias("at"), F.col(weight).alias("w"))
        if level == 0:
            placed = inner.withColumn("bucket", F.shiftright("at", shift))
        else:
            wanted = state.filter("open").select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], "low")
            same = [inner[k].eqNullSafe(wanted[f"k{i}"]) for i, k in enumerate(keys)]
            placed = (inner.join(wanted, [*same, F.shiftright("at", shift + bits) == F.shiftright("low", shift + bits)])
                      .withColumn("bucket", F.shiftright("at", shift)).select(*keys, "at", "w", "bucket"))
        hist = (placed.groupBy(*keys, "bucket").agg(F.sum("w").alias("w"), F.min("at").alias("first"),
                                                    F.max("at").alias("last"))
                .withColumn("upto", F.sum("w").over(upto)))
        h = hist.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], "bucket", "w", "first", "last", "upto")
        same = [state[k].eqNullSafe(h[f"k{i}"]) for i, k in enumerate(keys)]
        # The first bucket that passes the goal; none when the goal takes all that is left.
        hit = (state.join(h, [*same, F.col("open"), F.col("under") + F.col("upto") > F.col("goal")], "left")
               .groupBy(*keys, "goal", "low", "under", "open")
               .agg(F.min(F.struct("bucket", "w", "first", "last", "upto")).alias("hit")))
        single = F.col("hit.first") == F.col("hit.last")
        under = F.col("under") + F.col("hit.upto") - F.col("hit.w")
        takes = (F.col("goal") - under) * 2 >= F.col("hit.w")
        top = F.lit(1 << span).cast("bigint") if level == 0 else F.col("low") + (1 << (shift + bits))
        state = materialize(hit.select(
            *keys, "goal",
            F.when(~F.col("open"), F.col("low")).when(F.col("hit").isNull(), top)
            .when(single, F.col("hit.first") + takes.cast("bigint"))
            .otherwise(F.shiftleft("hit.bucket", shift)).alias("low"),
            F.when(F.col("hit").isNull(), F.col("under")).otherwise(under).alias("under"),
            (F.col("open") & F.col("hit").isNotNull() & ~single).alias("open")), purpose)
        if state.filter("open").isEmpty():
            break
    return state.select(*keys, F.col("low").alias("cut"))
