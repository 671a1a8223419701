"""Mix sources to target weights by hash thresholds, without sorting documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm.common import hash60, nested_cuts, repeat_copies, table, unused, with_ordinal, word_count
from pactum.plans.session import materialize

PERIOD = (1, 2, 3)
MOST_REPEATS = 3


def source_targets(sizes: DataFrame, budget_share: float = 1.0, weights: Sequence[float] = PERIOD,
                   most_repeats: float = MOST_REPEATS) -> DataFrame:
    """Add `target` to (source, source_size): the budget shared by weight, capped, the excess reshared.

    The i-th source by code point (null last) has weight `weights[i % len]`. A target above
    `most_repeats` times its source's size stops there and the rest is shared again among the
    others by weight, until none is above. Only sums reach the driver.
    """
    ranked = with_ordinal(sizes, [F.col("source").asc_nulls_last()], "mix-sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = materialize(ranked.withColumn("weight", F.element_at(cycle, (F.col("ordinal") % len(weights) + 1).cast("int")))
                         .withColumn("most", F.col("source_size") * float(most_repeats)).drop("ordinal"), "mix-weights")
    budget = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * budget_share
    per_weight, capped = 0.0, -1
    while True:
        stops = F.col("most") < F.lit(per_weight) * F.col("weight")
        row = ranked.agg(F.sum(F.when(stops, F.col("most"))).alias("fixed"), F.sum(F.when(~stops, F.col("weight"))).alias("open"),
                         F.count(F.when(stops, 1)).alias("n")).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, per_weight = row["n"], max(0.0, budget - (row["fixed"] or 0.0)) / row["open"]
    return ranked.select("source", "source_size",
                         F.least(F.col("most"), F.lit(per_weight) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        size: Column | None = None, **targets: object) -> DataFrame:
    """One row per document: (id, size, source, source_size, target, times, taken).

    Every document of a source is taken floor(target / size of the source) times; documents whose
    hash lies below the source's threshold once more, so that the words taken come nearest the
    target. The hash is that of id, source and text: reruns agree, and a larger budget only adds.
    Null text has size 0; a null source is a source of its own; rows equal in id, source and text share
    a hash and are taken alike; an empty table gives no rows. Other columns are ignored.
    """
    narrow, plan = _plan(docs, id_col, text_col, source_col, size, **targets)
    return (narrow.join(plan, F.col("source").eqNullSafe(F.col("s")))
            .withColumn("times", F.col("whole") + (F.col("place") < F.col("cut")).cast("bigint"))
            .select(id_col, "size", "source", "source_size", "target", "times",
                    (F.col("size") * F.col("times")).alias("taken"), "place"))


def _plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, size: Column | None = None,
          **targets: object) -> tuple[DataFrame, DataFrame]:
    """(id, source, size, place) of each document, and (s, source_size, target, whole, cut) of each source."""
    measured = size if size is not None else word_count(F.col(text_col))
    narrow = materialize(docs.select(
        F.col(id_col).alias(id_col), F.col(source_col).cast("string").alias("source"), measured.alias("size"),
        hash60(F.col(id_col), F.col(source_col), F.col(text_col)).alias("place")), "mix-sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = source_targets(sizes, **targets)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    shares = materialize(shares.withColumn("whole", whole), "mix-targets")
    goals = shares.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("goal"))
    cuts = nested_cuts(narrow, ["source"], "place", "size", goals, "mix-cuts")
    plan = shares.join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # At the cap nothing is left to take, and empty documents, which weigh nothing, are not taken once more either.
    most = float(targets.get("most_repeats", MOST_REPEATS))
    plan = plan.withColumn("cut", F.when(F.col("whole") >= most, F.lit(0).cast("bigint")).otherwise(F.col("cut")))
    return narrow, plan.withColumnRenamed("source", "s")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **targets: object) -> DataFrame:
    """The documents that the mix takes at least once, all columns as they are (the filter form of the mix).

    Empty documents weigh nothing, so they stay where their hash or a whole repeat takes them.
    """
    taken = mix(docs, id_col, text_col, source_col, **targets).filter("times > 0").select(
        F.col("place").alias("taken_place")).distinct()
    place = hash60(F.col(id_col), F.col(source_col), F.col(text_col))
    return docs.join(taken, place == taken["taken_place"], "left_semi")


def mixed_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 **targets: object) -> DataFrame:
    """Each document as many times as the mix takes it, all columns as they are.

    Only the table of sources is joined, so no text is shuffled. Empty documents weigh nothing, but are
    repeated like all others of their source.
    """
    _, plan = _plan(docs, id_col, text_col, source_col, **targets)
    plan = materialize(plan.select(F.col("s").alias("mix_source"), F.col("whole").alias("mix_whole"), F.col("cut").alias("mix_cut")), "mix-plan")
    place = hash60(docs[id_col], docs[source_col], docs[text_col])
    times = plan["mix_whole"] + (place < plan["mix_cut"]).cast("bigint")
    joined = docs.join(plan, docs[source_col].cast("string").eqNullSafe(plan["mix_source"]))
    copies = unused("mix_times", docs.columns)
    taken = joined.select(*[docs[c] for c in docs.columns], times.alias(copies)).filter(F.col(copies) > 0)
    return repeat_copies(taken, copies)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source", "times", "place")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce('=' || doc_id, '-') || '|' || coalesce('=' || source, '-') || '|' ||
                                 coalesce('=' || text, '-')), 1, 15) AS BIGINT) AS place
  FROM documents),
s AS (SELECT source, sum(size) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
      FROM d GROUP BY source),
-- Capped sources come first by the share at which they stop; the open rest shares what is left.
o AS (SELECT *, CAST(3 AS DOUBLE) * source_size / weight AS stop,
        coalesce(sum(CAST(3 AS DOUBLE) * source_size) OVER w, 0) AS fixed, (SELECT sum(weight) FROM s) - coalesce(sum(weight) OVER w, 0) AS open
      FROM s WINDOW w AS (ORDER BY CAST(3 AS DOUBLE) * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max(((SELECT sum(source_size) FROM s) - fixed) / open) AS per_weight FROM o
      WHERE ((SELECT sum(source_size) FROM s) - fixed) / open <= stop),
t AS (SELECT source, source_size, CAST(least(CAST(3 AS DOUBLE) * source_size, weight * per_weight) AS DOUBLE) AS target FROM s, l),
r AS (SELECT doc_id, d.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY place) AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (whole + CASE WHEN (target - whole * source_size - (upto - size)) * 2 >= size
                                  AND target - whole * source_size >= upto - size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
