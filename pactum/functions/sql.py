"""The vocabulary as session SQL functions, inlined by the optimizer like any expression."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pactum.functions.predicates import floor_div, is_upper, prefix
from pactum.policy import Policy


def register(spark: SparkSession, policy: Policy = Policy()) -> None:
    """Define risk_level, recall_risky, floor_div, is_upper and text_prefix for this session."""
    bodies = {
        "risk_level(score DOUBLE) RETURNS STRING":
            f"CASE WHEN score < {policy.low}D THEN 'LOW' WHEN score < {policy.medium}D THEN 'MEDIUM' "
            "WHEN score IS NOT NULL THEN 'HIGH' END",
        "recall_risky(tp BIGINT, fn BIGINT) RETURNS DOUBLE": "coalesce(try_divide(tp, tp + fn), 0D)",
        "floor_div(a BIGINT, b BIGINT) RETURNS BIGINT": floor_div("a", "b"),
        "is_upper(s STRING) RETURNS BOOLEAN": is_upper("s"),
        "text_prefix(s STRING, n BIGINT) RETURNS STRING": prefix("s", "n"),
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
