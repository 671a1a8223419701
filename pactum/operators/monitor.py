"""Monitoring signals: surges, drift and recall drops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def high_risk_surge(df: DataFrame, ts: str, flag: Column, every: str, rise: float, by: Sequence[str] = ()) -> DataFrame:
    """Share of flagged rows per time window, its change, and whether it rose by at least `rise`.

    Rows are reduced to windows first; only those are ordered.
    """
    counts = (df.groupBy(*by, F.window(ts, every).alias("_w"))
              .agg(F.count("*").alias("n"), F.count_if(flag).alias("n_high"))
              .withColumn("start", F.col("_w.start")).drop("_w")
              .withColumn("share", F.col("n_high") / F.col("n")))
    before = F.lag("share").over(Window.partitionBy(*by).orderBy("start"))
    return (counts.withColumn("change", F.col("share") - before)
            .withColumn("surge", F.coalesce(F.col("change") >= rise, F.lit(False))))


def feature_bounds(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Least and greatest value per feature: one row to the driver."""
    row = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in features
                   for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (row[f"lo_{c}"] or 0.0, row[f"hi_{c}"] or 0.0) for c in features}


def feature_drift(base: DataFrame, other: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, n_base, n_other, mean_shift, psi): is `other` distributed like `base`?

    Equal-width bins over the base range; values outside go to the end bins. Half
    a row per bin keeps the stability index finite. NULLs are counted apart
    (n_null_base, n_null_other) and enter neither bins nor means; a pool without values
    has no mean. Each pool is scanned once and reduced to features x bins counts.
    """
    bounds = feature_bounds(base, features)

    def binned(df: DataFrame, side: str) -> DataFrame:
        cells = []
        for c in features:
            lo, hi = bounds[c]
            width = (hi - lo) / bins
            cell = F.floor((F.col(c) - F.lit(lo)) / F.lit(width)) if width > 0 else F.lit(0)
            cells.append(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v"),
                                  F.when(F.col(c).isNotNull(), F.greatest(F.lit(0), F.least(F.lit(bins - 1), cell)))
                                  .cast("int").alias("bin")))
        return (df.select(F.inline(F.array(*cells))).groupBy("feature", "bin")
                .agg(F.count("*").alias("n"), F.sum("v").alias("s")).withColumn("side", F.lit(side)))

    both = binned(base, "base").unionByName(binned(other, "other"))

    def of(side: str, c: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col(c))), F.lit(0))

    cells = both.groupBy("feature", "bin").agg(of("base", "n").alias("nb"), of("other", "n").alias("no"),
                                               of("base", "s").alias("sb"), of("other", "s").alias("so"))
    known = F.col("bin").isNotNull()

    def where(test: Column, c: str) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col(c))), F.lit(0))

    sums = cells.groupBy("feature").agg(
        where(known, "nb").alias("n_base"), where(known, "no").alias("n_other"),
        where(~known, "nb").alias("n_null_base"), where(~known, "no").alias("n_null_other"),
        F.sum("sb").alias("s_base"), F.sum("so").alias("s_other"),
        F.collect_list(F.when(known, F.struct("bin", "nb", "no"))).alias("_cells"))
    # Bins empty on both sides carry the same half row and add nothing but their share.
    p = lambda x: (x["nb"] + 0.5) / (F.col("n_base") + 0.5 * bins)
    q = lambda x: (x["no"] + 0.5) / (F.col("n_other") + 0.5 * bins)
    seen = F.aggregate("_cells", F.lit(0.0), lambda acc, x: acc + (q(x) - p(x)) * F.ln(q(x) / p(x)))
    p0, q0 = 0.5 / (F.col("n_base") + 0.5 * bins), 0.5 / (F.col("n_other") + 0.5 * bins)
    unseen = (F.lit(bins) - F.size("_cells")) * (q0 - p0) * F.ln(q0 / p0)
    return sums.select("feature", "n_base", "n_other", "n_null_base", "n_null_other",
                       (F.try_divide("s_other", "n_other") - F.try_divide("s_base", "n_base")).alias("mean_shift"),
                       (seen + unseen).alias("psi"))


def recall_drop(runs: DataFrame, order: str = "run", by: Sequence[str] = ()) -> DataFrame:
    """Recall against the run before; on a drop the champion is kept."""
    before = F.lag("recall").over(Window.partitionBy(*by).orderBy(order))
    return (runs.withColumn("previous", before)
            .withColumn("dropped", F.coalesce(F.col("recall") < F.col("previous"), F.lit(False)))
            .withColumn("action", F.when(F.col("dropped"), "keep champion").otherwise("none")))
