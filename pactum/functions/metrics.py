"""Scores, bands and evaluation metrics as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactum.policy import Policy


def risk_level(score: Column, policy: Policy = Policy()) -> Column:
    """LOW / MEDIUM / HIGH; a score equal to a threshold belongs to the upper band."""
    return (F.when(score < policy.low, F.lit("LOW"))
            .when(score < policy.medium, F.lit("MEDIUM"))
            .when(score.isNotNull(), F.lit("HIGH")))


def linear_score(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """Logistic score from stored weights."""
    terms = [F.col(name) * F.lit(float(w)) for name, w in weights.items()]
    z = reduce(lambda a, b: a + b, terms, F.lit(float(intercept)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def ratio(num: Column, den: Column) -> Column:
    """Quotient, 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def confusion(label: Column, prediction: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if((label == 1) & (prediction == 1)),
        "fp": F.count_if((label == 0) & (prediction == 1)),
        "fn": F.count_if((label == 1) & (prediction == 0)),
        "tn": F.count_if((label == 0) & (prediction == 0)),
    }


def recall_risky() -> Column:
    """Recall on class 1 over a row that carries tp and fn."""
    return ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def key_hash(keys: Sequence[str] | str, seed: int = 0) -> Column:
    """Hash of any key columns into [0, 2^31), from md5: the same in any engine that has it."""
    names = [keys] if isinstance(keys, str) else list(keys)
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in names]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(2147483648))


def lcg(*parts: Column | str, seed: int = 0) -> Column:
    """Integer mixing into [0, 2^31): the same arithmetic in any SQL engine, no overflow."""
    mod = 2147483648
    state: Column = F.lit(seed % mod).cast("bigint")
    for part in parts:
        value = F.col(part) if isinstance(part, str) else part
        state = F.pmod((state + F.pmod(value.cast("bigint"), F.lit(mod))) * F.lit(1103515245)
                       + F.lit(12345), F.lit(mod))
    return state
