"""Terms of documents: corpus counts, and sums over a document's terms without moving its frequent ones."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Terms counted in a worker before they are handed on.
CHUNK = 500_000

#: Bytes of a text that are cut into words at a time; a longer one is cut between words.
BLOCK = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")

Split = Callable[[str], list[bytes]]


def words_lower(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered; bytes methods do exactly that and nothing else."""
    return text.encode().lower().split()


def word_blocks(raw: bytes) -> Iterator[list[bytes]]:
    """The words between white space, a block of bytes at a time; no block ends inside a word."""
    at = 0
    while at < len(raw):
        end = _BLANK.search(raw, at + BLOCK)
        stop = end.start() if end else len(raw)
        yield raw[at:stop].split()
        at = stop


def count_terms(texts: DataFrame, text_col: str, split: Split) -> DataFrame:
    """(term, n) over all whole texts, combined in the workers before the shuffle."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])
            seen.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                value = text.as_py()
                if value:
                    seen.update(split(value))
                if len(seen) > CHUNK:
                    yield flush()
        yield flush()

    parts = texts.select(text_col).mapInArrow(partial, "term binary, n bigint")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int, *more: str) -> pa.Table:
    """The most frequent terms, at most `most` of them, most frequent first, ties by term.

    A histogram of the counts, 16 buckets to a doubling, gives the least bucket down to which there are
    not too many terms. So only the terms wanted come to the driver, and no task sends it more than those.
    """
    bucket = F.floor(F.log2("n") * 16)
    low, total = None, 0
    for r in sorted(counts.groupBy(bucket.alias("at")).count().collect(), key=lambda r: -r["at"]):
        total += r["count"]
        if total > most:
            break
        low = r["at"]
    found = counts.filter(F.lit(False) if low is None else bucket >= low).select("term", "n", *more).toArrow()
    return found.sort_by([("n", "descending"), ("term", "ascending")])


def with_marker(rows: DataFrame, key: list[str], rare: str) -> DataFrame:
    """One row per rare term and one marker row per document, `term` being a text no term can equal.

    Marker rows carry the document through the join on `term`; as each has its own, none is hot.
    """
    mark = F.concat(F.lit("#:"), F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in key])).cast("binary")
    entries = F.concat(F.array(F.struct(mark.alias("term"), F.lit(0).alias("tf"))), F.coalesce(F.col(rare), F.array().cast("array<struct<term:binary,tf:int>>")))
    return rows.withColumn(rare, entries).select(*[c for c in rows.columns if c != rare], F.inline_outer(rare))


def is_marker() -> Column:
    return F.col("tf") == 0


def rare_array(per_doc: list[dict[bytes, int]]) -> pa.Array:
    """Rare terms of each document as one list column."""
    offsets, terms, tfs = [0], [], []
    for counts in per_doc:
        terms.extend(counts)
        tfs.extend(counts.values())
        offsets.append(len(terms))
    inner = pa.StructArray.from_arrays([pa.array(terms, pa.binary()), pa.array(tfs, pa.int32())], ["term", "tf"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), inner)
