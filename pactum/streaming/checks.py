"""Contract checks on streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from operator import itemgetter
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pactum.functions.predicates import lenient
from pactum.operators.contracts import Contract, check_contracts
from pactum.operators.trials import OBJECT_START
from pactum.streaming.sinks import each_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_contract_check(stream: DataFrame, contracts: Sequence[Contract], out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Verdicts over everything seen so far, rewritten with every batch.

    The same aggregate as in batch; its state is one row of counters.
    """
    return each_batch(check_contracts(stream, contracts), lambda batch, _: batch, out, checkpoint, mode="complete", every=every)


def _null_first(place: Sequence) -> list[tuple]:
    return [(v is not None, v) for v in place]


class _Balance(StatefulProcessor):
    """The balance of a key after each of its rows, carried by the engine from batch to batch.

    Rows stay plain values: most keys have few in a batch, and building a pandas table for each key takes longer than its rows.
    """

    def __init__(self, state: T.StructType, places: Sequence[str], shape: T.StructType, start: Any, clamped: bool, dtype: Any) -> None:
        self.schema, self.places, self.names, self.start, self.clamped, self.dtype = state, list(places), shape.names, start, clamped, dtype

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("balance", self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = self.state.get()  # None before the first row of a key
        balance, last = (held[0], _null_first(held[1:])) if held else (self.start, None)
        batch = [(_null_first([row[c] for c in self.places]), row) for row in rows]
        batch.sort(key=itemgetter(0))
        # Python's own whole numbers and decimals do not wrap; a balance that leaves the type is refused when it is written.
        totals = np.add.accumulate(np.array([balance, *[row["state_change"] for _, row in batch]], self.dtype))
        if self.clamped:
            totals = totals - np.minimum(np.minimum.accumulate(totals), 0)
        totals = totals.tolist()
        top = max(([last] if last is not None else []) + [batch[-1][0]])
        self.state.update((totals[-1], *[v for _, v in top]))
        made = Row(*self.names)
        for (place, row), total in zip(batch, totals[1:], strict=True):
            yield made(*row, last is not None and place < last, total)

    def close(self) -> None:
        pass


def stream_state_check(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], change: str, ensures: str, out: str,
    checkpoint: str, requires: str = "true", start: float = OBJECT_START, clamped: bool = False, every: str | None = None,
) -> StreamingQuery:
    """Per key and batch: rows, checked, failed, late, and the balance after the batch.

    The balance and the last place in `order` of each key are the engine's own state (RocksDB), kept by the checkpoint: a
    restart goes on from there, a repeated batch starts from the same state and replaces its own folder, and no
    batch reads what earlier ones wrote. Balances keep the type of `change`: whole numbers and decimals are
    exact. Rows of a batch are taken in `order`, NULL first. A row that comes before one its key has seen in an earlier batch
    is late: it changes the balance when it arrives and is counted in `n_late`. `ensures` sees the row's columns and `balance`.
    A NULL key is a key. Rows of one key in a batch are held together, so `maxFilesPerTrigger` bounds the memory.
    """
    spark = stream.sparkSession
    admitted = F.coalesce(F.expr(requires), F.lit(False))
    staged = stream.withColumn("state_admitted", admitted).withColumn("state_change", F.when(F.col("state_admitted"), F.coalesce(F.expr(change), F.lit(0))).otherwise(F.lit(0)))
    kind, dtype = staged.schema["state_change"].dataType, None
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        kind, dtype = T.LongType(), object
    elif isinstance(kind, T.DecimalType):
        kind, dtype = T.DecimalType(38, kind.scale), object
    elif isinstance(kind, T.FloatType):
        dtype = np.float32
    staged = staged.withColumn("state_change", F.col("state_change").cast(kind))
    zero = spark.range(1).select(F.lit(start).cast(kind)).first()[0]
    # A place in time is kept as microseconds, which no time zone changes.
    places = {c: f"state_at{i}" if isinstance(staged.schema[c].dataType, T.TimestampType) else c for i, c in enumerate(order)}
    staged = staged.withColumns({at: F.unix_micros(c) for c, at in places.items() if at != c})
    state = T.StructType([T.StructField("balance", kind), *[T.StructField(c, staged.schema[at].dataType) for c, at in places.items()]])
    shape = T.StructType([*staged.schema.fields, T.StructField("state_late", T.BooleanType()), T.StructField("state_balance", kind)])
    moved = staged.groupBy(*keys).transformWithState(_Balance(state, list(places.values()), shape, zero, clamped, dtype), shape, "Append", "None")
    seen = moved.drop("balance").withColumnRenamed("state_balance", "balance").withColumn("state_held", lenient(ensures))

    def told(batch: DataFrame, _: int) -> DataFrame:
        place = F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in order])
        return batch.groupBy(*keys).agg(
            F.count("*").alias("n_rows"), F.count_if("state_admitted").alias("n_checked"), F.count_if(F.col("state_admitted") & ~F.col("state_held")).alias("n_failed"),
            F.count_if("state_late").alias("n_late"), F.max_by("balance", place).alias("balance"))

    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)  # read when the query starts
    try:
        return each_batch(seen, told, out, checkpoint, every=every)
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
