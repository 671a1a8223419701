"""Near duplicates by 64-bit similarity fingerprints: balls of half the radius meet in the middle."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactum.llm.common import table
from pactum.llm.components import components
from pactum.llm.terms import word_blocks
from pactum.plans.session import materialize

SHINGLE = 3
RADIUS = 2
SEED = 42
BITS = 64


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Each bit is 1 if over half of the shingles' hashes have it; 0 without words. Unsigned."""
    ones, total, tail = np.zeros(BITS, np.int64), 0, []
    for words in word_blocks(text.encode().lower() if text else b""):
        words = tail + words
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words[i:i + size]), SEED) for i in range(len(words) - size + 1)], "<u8")
        if len(hashes):
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
        tail = words[max(0, len(words) - size + 1):] if size > 1 else []
    if not total and tail:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of each document as a signed number."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text.as_py(), size) for text in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(make, f"id {narrow.schema['id'].dataType.simpleString()}, fp bigint")


def _ball(radius: int) -> list[int]:
    """All patterns of at most `radius` bits as signed numbers."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(BITS), n)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def fingerprint_links(prints: DataFrame, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect all distinct fingerprints of `prints` (fp) within `radius`, and (fp, n_links).

    Every fingerprint emits all variants within half the radius. Two of them at `radius` bits or less
    share a variant, and all that share one are within `radius` of each other; so each is paired with
    the least one there, which connects whatever links, and pairs never grow with the square of a group. A variant is
    shared by no more fingerprints than a ball has points (65 for radius 2), so no key is hot. Colliding
    pairs are deduplicated and verified. `n_links`, the number of other fingerprints within the
    radius, needs no pairs for radius 2 either: two fingerprints 1 or 2 bits apart share exactly two variants.
    """
    if radius != 2 * (radius // 2):
        raise ValueError("the radius must be even")
    variants = prints.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m).cast("bigint")) for m in _ball(radius // 2)])).alias("variant"))
    here = Window.partitionBy("variant")
    met = variants.select("fp", F.count("*").over(here).alias("members"), F.min("fp").over(here).alias("head")).filter("members > 1")
    met = materialize(met.groupBy("fp", "head").agg(F.sum(F.col("members") - 1).alias("shared")), "simhash-met")
    near = F.bit_count(F.col("head").bitwiseXOR(F.col("fp"))) <= radius
    links = met.filter(F.col("head") != F.col("fp")).filter(near).select(F.col("head").alias("a"), F.col("fp").alias("b"))
    counts = met.groupBy("fp").agg(F.sum("shared").alias("shared"))
    return links, counts.select("fp", (F.col("shared") / 2 if radius == 2 else F.lit(None)).cast("bigint").alias("n_links"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: (id, fingerprint, component_id, n_links).

    A-Z in lower case, words between ASCII white space, shingles of `size` words with repeats; fewer words are one
    shingle. Documents whose fingerprints differ in at most `radius` bits link; `component_id` is the
    least id reachable and `n_links` the number of other fingerprints in reach of one step. Null, empty and
    blank texts have the fingerprint zero, which links like any other. Null ids stay: they are no
    least id unless a component has no other, and rows equal in id and text give equal rows. A long text is read whole, a block at
    a time. An empty table gives none; other columns are ignored, whatever their names.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, size), "simhash-prints")
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-classes")
    links, counts = fingerprint_links(classes.select("fp"), radius)
    named = materialize(components(links, "simhash-parts").withColumnRenamed("node", "fp"), "simhash-named")
    placed = classes.join(named, "fp", "left").withColumn("part", F.coalesce("component", "fp")).drop("component")
    least = placed.groupBy("part").agg(F.min("first").alias("component_id"))
    found = placed.join(least, "part").join(counts, "fp", "left").select("fp", "component_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
    return (prints.join(materialize(found, "simhash-found"), "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
