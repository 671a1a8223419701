"""Contracts over state carried from one trial to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum.operators.contracts import Contract, row_verdicts
from pactum.operators.trials import OBJECT_START
from pactum.plans.scan import running_sum


def running_state(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    change: str,
    requires: str = "true",
    start: Column | float = OBJECT_START,
    clamped: bool = False,
    state: str = "balance",
) -> DataFrame:
    """Add the state after each row's change, and `admitted`.

    A row failing `requires` leaves the state alone. With `clamped` the state never
    drops below zero: what a withdrawal cannot take is not taken. That is the
    running total less its lowest point below zero, so it needs no per-row loop.
    """
    admitted = df.withColumn("admitted", F.coalesce(F.expr(requires), F.lit(False)))
    moved = admitted.withColumn("_change", F.when(F.col("admitted"), F.expr(change)).otherwise(F.lit(0)))
    scanned = running_sum(moved, keys, order, "_change", start)
    level = F.col("total") - F.least(F.lit(0), F.col("lowest")) if clamped else F.col("total")
    return scanned.withColumn(state, level).drop("total", "lowest", "_change")


def stateful_check(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    change: str,
    ensures: Sequence[str],
    requires: str = "true",
    start: Column | float = OBJECT_START,
    clamped: bool = False,
) -> DataFrame:
    """Verdict per key: rows, checked, failed and the label, state carried along."""
    levels = running_state(df, keys, order, change, requires, start, clamped, "balance")
    contract = Contract("state", "balance", ("admitted",), tuple(ensures))
    flags = row_verdicts(levels, contract, keep=[*keys, "balance"])
    return flags.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.count_if("pre").alias("n_checked"), F.count_if("bad").alias("n_failed"),
        F.coalesce(F.bool_or("bad"), F.lit(False)).cast("int").alias("label"),
        F.min("balance").alias("lowest_balance"))
