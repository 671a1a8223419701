"""Running sums and running minima per key, exact on keys of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pactum.plans.session import materialize


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str,
    start: Column | float = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Add `total`, the sum up to and including each row plus `start`, and `lowest`,
    the least total seen so far, in `order` within `keys`.

    Any orderable columns will do, NULL first; rows equal in `order` follow by the hash
    of the whole row. `start` must be constant within a key. One way for every size: rows
    are dealt by range of (keys, order, hash), so a large key, a NULL key or one order value
    for all lies in as many parts as its size asks for. Parts are scanned on their own and
    written; a key that crosses parts is then shifted by the sums and minima of its earlier
    parts, which compose. Those shifts are fewer than there are parts.
    """
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = [f.name for f in df.schema.fields if not _has_map(f.dataType)]
    dealt = (df.withColumn("_start", start if isinstance(start, Column) else F.lit(start))
             .withColumn("_tie", F.xxhash64(*plain))
             .repartitionByRange(count, *keys, *order, "_tie")
             .withColumn("_part", F.spark_partition_id()))
    upto = (Window.partitionBy("_part", *keys).orderBy(*order, "_tie")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = materialize(dealt.withColumn("total", F.sum(amount).over(upto))
                        .withColumn("lowest", F.min("total").over(upto)).drop("_tie"), "running")

    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    shifts = (local.groupBy(*keys, "_part").agg(F.sum(amount).alias("_sum"), F.min("lowest").alias("_low"))
              .withColumn("_base", F.sum("_sum").over(before))
              .withColumn("_floor", F.min(F.coalesce("_base", F.lit(0)) + F.col("_low")).over(before))
              .filter(F.col("_base").isNotNull())
              .select(*named, F.col("_part").alias("_at"), "_base", "_floor"))
    same = local["_part"] == shifts["_at"]
    for i, k in enumerate(keys):
        same = same & local[k].eqNullSafe(shifts[f"_key{i}"])
    base = F.coalesce("_base", F.lit(0))
    total = F.when(F.col("_base").isNotNull(), F.coalesce("total", F.lit(0)) + base).otherwise(F.col("total"))
    return (local.join(shifts, same, "left")
            .withColumn("lowest", F.least("_floor", base + F.col("lowest")) + F.col("_start"))
            .withColumn("total", total + F.col("_start"))
            .select(*df.columns, "total", "lowest"))


def _has_map(kind: T.DataType) -> bool:
    """Maps have no hash."""
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind.fields)
