"""Connected components of link tables, a few shuffles a round."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.plans.session import materialize

#: Links held by a worker at a time.
CHUNK = 1_000_000


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for the links of one worker, root being the least node it can reach there."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while True:
            hop = new[new]
            if (hop == new).all():
                break
            new = hop
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        whole = pa.Table.from_batches(held)
        nodes, roots = _forest(whole.column(0).to_numpy(), whole.column(1).to_numpy())
        other = nodes != roots
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(roots[other])], ["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) > CHUNK:
            yield flush()
    if held:
        yield flush()


def components(links: DataFrame, purpose: str) -> DataFrame:
    """(node, component) for every node of links (a, b), component being the least node it reaches.

    Workers first reduce their links to local trees. Then rounds of large and small stars (each link
    goes to the least neighbour of its upper, then its lower end) until nothing changes. Every round is
    a written table; minima combine before the shuffle, and joins may be split where a node has many links.
    """
    edges = materialize(links.select("a", "b").filter("a != b").mapInArrow(_contract, "a bigint, b bigint").distinct(), purpose)
    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large.filter("a != b"), purpose)
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select("a", "b", "m")
        edges = materialize(small.select(F.inline(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))))
            .filter("a != b").distinct(), purpose)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
