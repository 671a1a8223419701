"""Contract checking on tables.

A contract derives `result` from a row with a Spark SQL expression (`transform`)
and constrains inputs (`requires`) and outcome (`ensures`). Every row is a trial:

* a row failing any `requires` is skipped;
* a NULL `result` on an admitted row is an error, unless `null_ok`;
* an admitted row that errs or fails any `ensures` is bad;
* the target is RISKY (label 1) if any row is bad, else SAFE (label 0).

A clause that does not bind to the table counts as what evaluating it would give:
a `requires` or `ensures` is false, a transform is an error.

Evaluating a clause may fail: a `requires` or `ensures` that fails is false, a transform that fails is an
error. Only contracts in which whole numbers may overflow are bound under ANSI mode, where that stops the job.

Contracts are text and stay text: each becomes one expression giving the row's outcome as bit flags.
Where postconditions could mean something else by `result`, or the transform's value changes with each use, `result` is
the variable of a function over that value: it is computed once, and the analyser decides what the name means. Otherwise
the value is spelled out. The flags are read with getbit, which the optimizer does not fold into the CASE branches, so the
outcome stays one common subexpression: generated code evaluates it once per row, in a method of its own, however many contracts there are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactum.functions.predicates import bind_clauses, clause_types, column_types, condition, errors_as_null, may_overflow, spelled_out, truthy, volatile

# Outcome bits: 0 = admitted, 1 = bad, 2 = transform failed.
SKIPPED, MET, VIOLATED, ERRED = 0, 1, 3, 7

# Contracts per aggregate: above 100 aggregate columns Spark gives up whole-stage
# code generation, which costs far more than another scan.
PER_SCAN = 32
PER_SCAN_WITH_WITNESS = 24


@dataclass(frozen=True)
class Contract:
    target: str
    transform: str = "true"
    requires: Sequence[str] = ()
    ensures: Sequence[str] = ()
    invariant: Sequence[str] = ()
    null_ok: bool = False


def contracts_from_table(df: DataFrame) -> list[Contract]:
    """Contracts kept as rows (target, transform, requires, ensures[, null_ok]).

    Contract text becomes plan text, so it has to be on the driver.
    """
    rows = df.select(*[c for c in ("target", "transform", "requires", "ensures", "null_ok") if c in df.columns])
    return [Contract(r["target"], r["transform"], tuple(r["requires"] or ()), tuple(r["ensures"] or ()),
                     null_ok=bool(r["null_ok"]) if "null_ok" in r else False)
            for r in rows.orderBy("target").collect()]


@dataclass(frozen=True)
class _Bound:
    """A contract as SQL text over one table. `strict`: under ANSI mode."""

    target: str
    pre: str
    result: str
    failed: str
    ensures: tuple[str, ...]
    strict: bool

    def told(self, cases: str, otherwise: str) -> str:
        """`cases` of an admitted row, which may name `result`; `otherwise` of others, whose transform is not evaluated."""
        plain = spelled_out(cases, "result", self.result)
        admitted = f"CASE {plain} END" if plain else f"element_at(transform(array({self.result}), result -> CASE {cases} END), 1)"
        return f"CASE WHEN {self.pre} THEN {admitted} ELSE {otherwise} END"

    @property
    def verdict(self) -> str:
        return f"WHEN {self.failed} THEN {ERRED} WHEN {' AND '.join(self.ensures) or 'true'} THEN {MET} ELSE {VIOLATED}"

    @property
    def outcome(self) -> str:
        return self.told(self.verdict, str(SKIPPED))


def _bind(df: DataFrame, contracts: Sequence[Contract]) -> list[_Bound]:
    names = [c.target for c in contracts]
    if not names:
        raise ValueError("no contracts given")
    if len(set(names)) != len(names):
        raise ValueError("contract targets must be unique")
    kinds = column_types(df)

    def is_strict(c: Contract, of_result: dict[str, T.DataType | None]) -> bool:
        known = {**kinds, "result": of_result[c.transform] or T.NullType()}
        return any(may_overflow(s, kinds) for s in (*c.requires, c.transform)) or any(may_overflow(s, known) for s in c.ensures)

    found: dict[str, _Bound] = {}
    of_result = clause_types(df, [c.transform for c in contracts])
    for strict in (False, True):
        group = [c for c in contracts if is_strict(c, of_result) == strict]
        with errors_as_null(df.sparkSession, not strict):
            front = clause_types(df, [s for c in group for s in (*c.requires, c.transform)])
            results = [f"({c.transform})" if front[c.transform] is not None and not isinstance(front[c.transform], T.NullType)
                       else "CAST(NULL AS BOOLEAN)" for c in group]
            back = clause_types(df, [f"transform(array({r}), result -> ({e}))" for c, r in zip(group, results, strict=True) for e in c.ensures])
        for c, r in zip(group, results, strict=True):
            types = [back[f"transform(array({r}), result -> ({e}))"] for e in c.ensures]
            found[c.target] = _Bound(
                c.target, " AND ".join(truthy(s, front[s]) for s in c.requires) or "true", r, "false" if c.null_ok else "result IS NULL",
                tuple(truthy(e, t.elementType if t is not None else None) for e, t in zip(c.ensures, types, strict=True)), strict)
    return [found[c.target] for c in contracts]


def _select(df: DataFrame, bound: Sequence[_Bound], told: Callable[[_Bound], str], name: str) -> DataFrame:
    """Add an array with what each contract tells of the row, each bound in its own mode."""
    spare = f"{name}_"
    while spare in df.columns:
        spare += "_"
    with errors_as_null(df.sparkSession):
        soft = df.selectExpr("*", f"array({', '.join(told(b) for b in bound if not b.strict)}) AS {spare}")
    hard = ", ".join(told(b) for b in bound if b.strict)
    if not hard:
        return soft.withColumnRenamed(spare, name)
    lenient_too = any(not b.strict for b in bound)
    return soft.selectExpr("*", f"concat({spare}, array({hard})) AS {name}" if lenient_too else f"array({hard}) AS {name}").drop(spare)


def row_verdicts(df: DataFrame, contract: Contract, keep: Sequence[str] | None = None) -> DataFrame:
    """Per row: `pre` (admitted), `result`, `err`, `bad`. Skipped rows stay, unflagged.

    `result` is a column of its own before postconditions look at it; a column of that name gives way.
    """
    (b,) = _bind(df, [contract])
    columns = [c for c in (df.columns if keep is None else keep) if c != "result"]
    with errors_as_null(df.sparkSession, not b.strict):
        staged = df.selectExpr(*[f"`{c}`" for c in df.columns if c != "result"], f"{b.pre} AS _pre", f"CASE WHEN {b.pre} THEN {b.result} END AS result")
        told = staged.selectExpr(*[f"`{c}`" for c in columns], "result", f"CASE WHEN NOT _pre THEN {SKIPPED} {b.verdict} END AS _outcome")
    return told.selectExpr(*[f"`{c}`" for c in columns], "getbit(_outcome, 0) = 1 AS pre", "result",
                           "getbit(_outcome, 2) = 1 AS err", "getbit(_outcome, 1) = 1 AS bad")


def precondition_gate(df: DataFrame, requires: Sequence[str]) -> DataFrame:
    """Rows on which every precondition holds."""
    out = df
    for s in requires:
        with errors_as_null(df.sparkSession, not may_overflow(s, column_types(df))):
            out = out.filter(condition(s, clause_types(df, [s])[s]))
    return out


def apply_target(df: DataFrame, contract: Contract) -> DataFrame:
    """Admitted rows with `result` and whether computing it failed."""
    return row_verdicts(df, contract).filter("pre").drop("pre", "bad")


def postcondition_check(df: DataFrame, contract: Contract) -> DataFrame:
    """Admitted rows with `ok`: result computed and every postcondition true."""
    return row_verdicts(df, contract).filter("pre").withColumn("ok", ~F.col("bad")).drop("pre", "bad", "err")


def check_contracts(
    df: DataFrame,
    contracts: Sequence[Contract],
    order: Sequence[str] = (),
    evidence: Sequence[str] = (),
) -> DataFrame:
    """Check many contracts together: one verdict row per contract.

    One scan serves up to PER_SCAN contracts; more take further scans of the columns they name, and those
    that need ANSI mode scans of their own.

    Columns: target, n_rows, n_checked, n_skipped, n_failed (errors included),
    n_errors, label, vacuous and, when `order` is given, first_bad: the first bad
    row by `order` with its `evidence` columns.
    """
    bound = _bind(df, contracts)
    if df.isStreaming and any(b.strict for b in bound):  # a stream takes one aggregate
        bound = [replace(b, strict=True) for b in bound]
    witness = ", ".join([*order, *[c for c in evidence if c not in order]]) if order else ""
    parts = []
    for strict in (False, True):
        group = [b for b in bound if b.strict == strict]
        size = PER_SCAN_WITH_WITNESS if witness else PER_SCAN
        with errors_as_null(df.sparkSession, not strict):
            parts += [_count(df, group[k:k + size], witness) for k in range(0, len(group), size)]
    return reduce(DataFrame.unionByName, parts).selectExpr(
        "target", "n_rows", "n_checked", "n_rows - n_checked AS n_skipped", "n_failed", "n_errors",
        "CAST(n_failed > 0 AS INT) AS label", "n_checked = 0 AS vacuous", *(["first_bad"] if order else []))


def _count(df: DataFrame, bound: Sequence[_Bound], witness: str) -> DataFrame:
    aggs, rows, staged = ["count(*) AS _rows"], [], []
    for i, b in enumerate(bound):
        code = b.outcome
        if volatile(code):  # aggregates take no value that changes with each use
            staged.append(f"{code} AS _outcome{i}")
            code = f"_outcome{i}"
        aggs += [f"coalesce(sum(getbit({code}, {bit})), 0L) AS _{n}{i}" for bit, n in enumerate("cfe")]
        parts = [f"'{_quoted(b.target)}' AS target", "_rows AS n_rows", f"_c{i} AS n_checked", f"_f{i} AS n_failed", f"_e{i} AS n_errors"]
        if witness:
            aggs.append(f"min(CASE WHEN getbit({code}, 1) = 1 THEN struct({witness}) END) AS _w{i}")
            parts.append(f"_w{i} AS first_bad")
        rows.append(f"struct({', '.join(parts)})")
    return df.selectExpr("*", *staged).selectExpr(*aggs).selectExpr(f"inline(array({', '.join(rows)}))")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def label_targets(df: DataFrame, contracts: Sequence[Contract]) -> DataFrame:
    """(target, label): 1 if any admitted row errs or violates."""
    return check_contracts(df, contracts).select("target", "label")


def first_violation(df: DataFrame, contracts: Sequence[Contract], order: Sequence[str],
                    evidence: Sequence[str] = ()) -> DataFrame:
    """The row each failing target stops at, in trial order."""
    return (check_contracts(df, contracts, order, evidence)
            .filter("label = 1").select("target", "first_bad.*"))


def violating_rows(df: DataFrame, contracts: Sequence[Contract], keep: Sequence[str]) -> DataFrame:
    """Every bad row of every contract, with the clause that stopped it.

    `clause` is the number of the first false postcondition, 0 when the transform failed.
    """
    bound = _bind(df, contracts)

    def hit(b: _Bound) -> str:
        steps = "".join(f" WHEN NOT {e} THEN {i}" for i, e in enumerate(b.ensures, 1))
        clause = b.told(f"WHEN {b.failed} THEN 0{steps}", "NULL")
        return f"struct('{_quoted(b.target)}' AS target, CAST({clause} AS INT) AS clause)"

    return _select(df, bound, hit, "_hits").selectExpr(*keep, "inline_outer(_hits)").filter("clause IS NOT NULL")


def resolve_targets(requested: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Requested targets with their verdict; one that was never checked is SAFE, unresolved."""
    found = verdicts.select("target", F.col("label").alias("_label"))
    return (requested.join(found, "target", "left")
            .withColumn("label", F.coalesce("_label", F.lit(0)))
            .withColumn("resolved", F.col("_label").isNotNull()).drop("_label"))


def invariant_check(df: DataFrame, invariants: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Do all invariants hold on every row of a group? Kept apart from labels."""
    staged = bind_clauses(df.select("*"), list(invariants))
    held = " AND ".join(f"c{i}" for i in range(len(invariants))) or "true"
    staged = staged.selectExpr(*by, f"{held} AS _held")
    return staged.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.count_if(~F.col("_held")).alias("n_broken"),
        F.coalesce(F.bool_and("_held"), F.lit(True)).alias("holds"))
