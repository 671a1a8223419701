"""Predicates and the contract vocabulary.

`lenient` is the one non-standard semantic: a predicate that is NULL, or whose evaluation fails, is false.
Clauses whose integer arithmetic may overflow are bound under ANSI mode, where an overflow is an error and never a
plausible value; all others are bound without it, so a zero divisor, a bad cast or a missing element
is NULL. The text builders below cover operations whose Spark spelling means something else than in the contract language.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException, ParseException
from pyspark.logger import PySparkLogger
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lenient(pred: Column | str) -> Column:
    col = F.expr(pred) if isinstance(pred, str) else pred
    return F.coalesce(col, F.lit(False))


def condition(sql: str, dtype: T.DataType | None) -> str:
    """SQL text for the truth of a clause of any type, NULL when unknown.

    Enough for a filter, and a plain comparison stays one the scan can push down.
    A clause that does not bind (no type) is false.
    """
    if dtype is None or isinstance(dtype, T.NullType):
        return "false"
    if isinstance(dtype, T.BooleanType):
        return f"({sql})"
    if isinstance(dtype, T.NumericType):
        return f"(({sql}) <> 0)"
    if isinstance(dtype, T.StringType):
        return f"(({sql}) <> '')"
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return f"(size({sql}) > 0)"
    return f"(({sql}) IS NOT NULL)"


def truthy(sql: str, dtype: T.DataType | None) -> str:
    """`condition` with unknown counted as false."""
    test = condition(sql, dtype)
    return test if test == "false" else f"coalesce({test}, false)"


@contextmanager
def quiet_analysis() -> Iterator[None]:
    """An expression that does not bind is an answer here, not an error worth a log line."""
    log = PySparkLogger.getLogger("SQLQueryContextLogger")
    level = log.level
    log.setLevel(logging.CRITICAL)
    try:
        yield
    finally:
        log.setLevel(level)


def clause_types(df: DataFrame, clauses: list[str]) -> dict[str, T.DataType | None]:
    """Type of each expression over `df`, None where it does not bind. Runs no job.

    One analysis when all bind, one each otherwise.
    """
    unique = list(dict.fromkeys(clauses))

    def types(texts: list[str]) -> list[T.DataType]:
        return [f.dataType for f in df.selectExpr(*[f"({t}) AS c{i}" for i, t in enumerate(texts)]).schema.fields]

    def one(text: str) -> T.DataType | None:
        try:
            return types([text])[0]
        except (AnalysisException, ParseException):
            return None

    with quiet_analysis():
        try:
            return dict(zip(unique, types(unique), strict=True)) if unique else {}
        except (AnalysisException, ParseException):
            return {t: one(t) for t in unique}


_TOKEN = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|[A-Za-z_][A-Za-z_0-9]*|\d[\d.]*(?:[eE]-?\d+)?\w*|->|::|\s+|.", re.S)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_WHOLE_NAMES = {"tinyint", "smallint", "int", "integer", "bigint", "long", "short", "byte"}
# Calls that neither overflow nor turn fractions into whole numbers.
_SAFE_CALLS = {"try_divide", "try_add", "try_subtract", "try_multiply", "try_mod", "coalesce", "nullif", "greatest", "least", "sqrt",
               "exp", "log", "and", "or", "not", "in", "when", "then", "else", "between", "case", "array", "try_element_at", "element_at"}
_BEFORE_SIGN = {"", "(", ",", "<", ">", "=", "and", "or", "not", "then", "when", "else", "between", "in", "->", "["}


def may_overflow(sql: str, columns: dict[str, T.DataType]) -> bool:
    """Could whole numbers wrap in this clause, were it evaluated without ANSI mode? When in doubt, yes.

    Only arithmetic over fractional columns and small literals, and casts of text, are known not to.
    """
    words = [w for w in _TOKEN.findall(sql) if not w.isspace() and w[0] not in "'\""]
    lower = [w.strip("`").lower() for w in words]
    known = {name.lower(): kind for name, kind in columns.items()}
    kinds = [known[w] for w in lower if w in known]
    signs = [w for before, w, after in zip(["", *lower], lower, [*lower[1:], ""], strict=False)
             if w in ("+", "-", "*") and not (w == "-" and after[:1].isdigit() and before in _BEFORE_SIGN) and not (w == "*" and before == "(")]
    calls = {w for w, after in zip(lower, lower[1:], strict=False) if after == "(" and (w[:1].isalpha() or w[:1] == "_")} - _SAFE_CALLS
    cast_to_whole = "::" in words or bool(calls & _WHOLE_NAMES) or ("cast" in lower and not _WHOLE_NAMES.isdisjoint(lower))
    if cast_to_whole and (signs or any(isinstance(k, T.NumericType) for k in kinds)):
        return True
    if not cast_to_whole:
        calls -= {"cast", "try_cast"}
    if not signs and "div" not in lower:
        return bool(calls & {"abs", "negative", "sum", "aggregate", "reduce", "shiftleft", "factorial", "floor", "ceil", "ceiling", "round", "bround", "conv"})
    small = all(not w[:1].isdigit() or "." in w or "e" in w or len(w) < 5 for w in lower)
    return bool(calls) or not small or not kinds or any(not isinstance(k, _FRACTIONAL) for k in kinds)


# Each use of these gives another value.
_VOLATILE = {"rand", "randn", "random", "uuid", "shuffle", "uniform", "randstr", "monotonically_increasing_id", "java_method", "reflect", "try_reflect"}


def volatile(sql: str) -> bool:
    return not _VOLATILE.isdisjoint(w.lower() for w in _TOKEN.findall(sql))


def spelled_out(sql: str, name: str, value: str) -> str | None:
    """`sql` with the bare column `name` written as the expression `value`, or None where that would not mean the same.

    A function over `name` always means the same, but is interpreted row by row; spelled out,
    generated code evaluates a repeated expression once. A clause with functions of its own, or a
    value that changes with each use, is not spelled out.
    """
    words = _TOKEN.findall(sql)
    if "->" in words or volatile(value):
        return None
    out, before = [], ""
    for w in words:
        own = w.strip("`").lower() == name and before not in (".", "as")
        out.append(value if own and (w[0] == "`" or w.lower() == name) else w)
        before = before if w.isspace() else w.lower()
    return "".join(out)


@contextmanager
def errors_as_null(spark: SparkSession, active: bool = True) -> Iterator[None]:
    """Expressions bound inside give NULL where evaluating them fails; the session is as before afterwards."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    if active:
        spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def column_types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def bind_clauses(df: DataFrame, clauses: Sequence[str]) -> DataFrame:
    """A column `c0`, `c1`, ... for each clause: true where it holds, false where it does not, is NULL, or fails.

    Other columns stay. A clause in which whole numbers may overflow still raises.
    """
    strict = [may_overflow(s, column_types(df)) for s in clauses]
    names = [f"c{i}" for i in range(len(clauses))]
    out = df
    for mode in (False, True):
        with errors_as_null(df.sparkSession, not mode):
            types = clause_types(df, [s for s, hard in zip(clauses, strict, strict=True) if hard == mode])
            out = out.selectExpr("*", *[f"{truthy(s, types[s])} AS {n}" for s, n, hard in zip(clauses, names, strict, strict=True) if hard == mode])
    return out.select(*df.columns, *names)


# -- contract vocabulary, as SQL text ---------------------------------------

def floor_div(a: str, b: str) -> str:
    """Integer division rounding down, exact over BIGINT; NULL on a zero divisor."""
    return (f"(CASE WHEN ({b}) = 0 THEN NULL "
            f"WHEN ({a}) % ({b}) <> 0 AND (({a}) < 0) <> (({b}) < 0) THEN ({a}) div ({b}) - 1 "
            f"ELSE ({a}) div ({b}) END)")


def item_at(values: str, i: str) -> str:
    """Zero-based element, counting from the end for negative positions; NULL outside."""
    return (f"(CASE WHEN ({i}) >= 0 THEN try_element_at({values}, CAST(({i}) + 1 AS INT)) "
            f"ELSE try_element_at({values}, CAST(({i}) AS INT)) END)")


def total(values: str) -> str:
    return f"aggregate({values}, 0L, (acc, v) -> try_add(acc, v))"


def is_upper(s: str) -> str:
    return f"(({s}) = upper({s}) AND ({s}) <> lower({s}))"


def prefix(s: str, n: str) -> str:
    """First n characters; a negative n leaves that many off the end."""
    return (f"(CASE WHEN ({n}) >= 0 THEN left({s}, CAST(({n}) AS INT)) "
            f"ELSE left({s}, CAST(greatest(length({s}) + ({n}), 0) AS INT)) END)")


def with_entry(m: str, key: str, value: str) -> str:
    return f"map_concat(map_filter({m}, (k, v) -> k <> ({key})), map(({key}), ({value})))"
