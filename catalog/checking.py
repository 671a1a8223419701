"""Contract checks on lineitem, orders, customer, supplier, part and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.shared import CODE_CTE, code_corpus, key_hash_sql, lcg_sql, read
from pactum.functions.predicates import bind_clauses, floor_div
from pactum.functions.sql import register
from pactum.operators import contracts as D
from pactum.operators import state as S
from pactum.operators import trials as T
from pactum.operators.contracts import Contract
from pactum.operators.units import find_units
from pactum.plans.session import materialize
from pactum.policy import Policy

PRICE = Contract("disc_price", "l_extendedprice * (1 - l_discount)", ["l_quantity > 0"],
                 ["result <= l_extendedprice", "result >= 0"])
TAXED = Contract("taxed_price", "l_extendedprice * (1 - l_discount) * (1 + l_tax)", ["l_quantity > 0"],
                 ["result <= l_extendedprice"])
# A zero divisor, a bad cast and a missing element: a transform that fails is an error, a clause that fails is false.
RATIO = Contract("tax_per_discount", "l_tax / l_discount", ["l_tax > 0"], ["result < 1"])
BAD_CAST = Contract("flag_as_number", "CAST(l_returnflag AS INT)", ["l_quantity > 40"], ["result > 0"])
NO_ELEMENT = Contract("fifth_of_three", "array(l_tax, l_discount, l_quantity)", ["l_quantity > 30"], ["result[l_linenumber] >= 0", "result[1] >= 0"])
# Whether clauses bind is part of the semantics: these three do not.
UNBOUND_PRE = Contract("unbound_requires", "l_tax", ["no_such_column > 1"], ["result < 1"])
UNBOUND_BODY = Contract("unbound_transform", "no_such_column", ["l_quantity > 10"], ["result < 1"])
UNBOUND_POST = Contract("unbound_ensures", "l_tax", ["l_quantity > 20"], ["size(result) > 0"])
LINE_CONTRACTS = [PRICE, TAXED, RATIO, BAD_CAST, NO_ELEMENT, UNBOUND_PRE, UNBOUND_BODY, UNBOUND_POST]

_DISC = "l_extendedprice * (1 - l_discount)"
_TAXED = f"{_DISC} * (1 + l_tax)"


def d1_lenient(spark, d):
    li = read(spark, d, "lineitem")
    tests = {"quotient": "l_tax / l_discount < 1", "element": "array(l_tax, l_discount)[l_linenumber] >= 0.05",
             "cast": "CAST(l_returnflag AS INT) > 0", "unknown": "nullif(l_tax, 0.02) < 0.05"}
    bound = bind_clauses(li, list(tests.values())).select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(tests)])
    return bound.groupBy(*tests).agg(F.count("*").alias("n"))


D1 = """SELECT coalesce(CASE WHEN l_discount <> 0 THEN l_tax / l_discount < 1 END, false) AS quotient,
 coalesce(CASE l_linenumber WHEN 0 THEN l_tax WHEN 1 THEN l_discount END >= 0.05, false) AS element,
 coalesce(try_cast(l_returnflag AS INT) > 0, false) AS "cast", coalesce(nullif(l_tax, 0.02) < 0.05, false) AS "unknown", count(*) AS n FROM lineitem GROUP BY ALL"""


def d2_precondition_gate(spark, d):
    return (D.precondition_gate(read(spark, d, "lineitem"), ["l_quantity > 10", "l_tax", "l_shipdate >= '1996-01-01'"])
            .groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys")))


D2 = """SELECT l_returnflag, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem
WHERE l_quantity > 10 AND l_tax <> 0 AND l_shipdate >= TIMESTAMP '1996-01-01' GROUP BY 1"""


def d3_apply_target(spark, d):
    return (D.apply_target(read(spark, d, "lineitem"), RATIO)
            .select("l_orderkey", "l_linenumber", "l_partkey", F.round("result", 6).alias("result"), "err"))


D3 = """SELECT l_orderkey, l_linenumber, l_partkey,
 round(CASE WHEN l_discount <> 0 THEN l_tax / l_discount END, 6) AS result, l_discount = 0 AS err
FROM lineitem WHERE l_tax > 0"""


def d4_postcondition_check(spark, d):
    customers = read(spark, d, "customer")
    c = Contract("credit", "c_acctbal + 1000", ["c_mktsegment <> 'BUILDING'"], ["result >= 1000", "result < 10500"])
    return D.postcondition_check(customers, c).select("c_custkey", F.round("result", 6).alias("result"), "ok")


D4 = """SELECT c_custkey, round(c_acctbal + 1000, 6) AS result,
 c_acctbal + 1000 >= 1000 AND c_acctbal + 1000 < 10500 AS ok FROM customer WHERE c_mktsegment <> 'BUILDING'"""


def d5_label_targets(spark, d):
    return D.label_targets(read(spark, d, "lineitem"), LINE_CONTRACTS)


_OUTCOMES = f"""o AS (
 SELECT 'disc_price' AS target, l_orderkey, l_linenumber, l_partkey, l_tax, l_quantity > 0 AS pre, false AS err,
  NOT ({_DISC} <= l_extendedprice AND {_DISC} >= 0) AS bad FROM lineitem
 UNION ALL SELECT 'taxed_price', l_orderkey, l_linenumber, l_partkey, l_tax, l_quantity > 0, false,
  NOT ({_TAXED} <= l_extendedprice) FROM lineitem
 UNION ALL SELECT 'tax_per_discount', l_orderkey, l_linenumber, l_partkey, l_tax, l_tax > 0, l_discount = 0,
  l_discount = 0 OR NOT (l_tax / l_discount < 1) FROM lineitem
 UNION ALL SELECT 'flag_as_number', l_orderkey, l_linenumber, l_partkey, l_tax, l_quantity > 40, true, true FROM lineitem
 UNION ALL SELECT 'fifth_of_three', l_orderkey, l_linenumber, l_partkey, l_tax, l_quantity > 30, false, l_linenumber > 2 FROM lineitem
 UNION ALL SELECT 'unbound_requires', l_orderkey, l_linenumber, l_partkey, l_tax, false, false, false FROM lineitem
 UNION ALL SELECT 'unbound_transform', l_orderkey, l_linenumber, l_partkey, l_tax, l_quantity > 10, true, true FROM lineitem
 UNION ALL SELECT 'unbound_ensures', l_orderkey, l_linenumber, l_partkey, l_tax, l_quantity > 20, false, true FROM lineitem)"""
D5 = f"WITH {_OUTCOMES} SELECT target, CAST(bool_or(pre AND bad) AS INT) AS label FROM o GROUP BY 1"


def d6_first_violation(spark, d):
    return D.first_violation(read(spark, d, "lineitem"), LINE_CONTRACTS,
                             ["l_orderkey", "l_linenumber", "l_partkey"], ["l_tax"])


D6 = f"""WITH {_OUTCOMES} SELECT target, l_orderkey, l_linenumber, l_partkey, l_tax FROM o WHERE pre AND bad
QUALIFY row_number() OVER (PARTITION BY target ORDER BY l_orderkey, l_linenumber, l_partkey, l_tax) = 1"""


def d7_verdict_counts(spark, d):
    return D.check_contracts(read(spark, d, "lineitem"), LINE_CONTRACTS)


D7 = f"""WITH {_OUTCOMES} SELECT target, count(*) AS n_rows, count(*) FILTER (pre) AS n_checked,
 count(*) FILTER (NOT pre) AS n_skipped, count(*) FILTER (pre AND bad) AS n_failed,
 count(*) FILTER (pre AND err) AS n_errors, CAST(coalesce(bool_or(pre AND bad), false) AS INT) AS label,
 count(*) FILTER (pre) = 0 AS vacuous FROM o GROUP BY 1"""


def _flat_arguments(df):
    return df.withColumn("list", F.array_join(F.col("list").cast("array<string>"), ","))


def d8_make_trials(spark, d):
    units = find_units(code_corpus(spark, d))
    return _flat_arguments(T.make_trials(units, ["path", "line"], ["path", "line"], n=Policy().trials, seed=42))


_KIND = """CASE WHEN param = 'other' AND class <> '' THEN 'object' WHEN param IN ('s', 'text', 'name') THEN 'string'
 WHEN param IN ('lst', 'values', 'items') THEN 'list' ELSE 'int' END"""
_ARGS = f"""args AS (
 SELECT path, line, class, param, pos, {_KIND} AS kind,
  CASE {_KIND} WHEN 'object' THEN 1 WHEN 'int' THEN 11 ELSE 3 END AS size
 FROM (SELECT path, line, class, unnest(list_filter(string_split(params, ','), lambda p: p <> 'self')) AS param,
        generate_subscripts(list_filter(string_split(params, ','), lambda p: p <> 'self'), 1) - 1 AS pos FROM described))"""
_VALUE = """CASE kind WHEN 'int' THEN pick - 5 WHEN 'object' THEN 10 END AS number,
 CASE WHEN kind = 'string' THEN ['a', 'hello', 'XYZ'][CAST(pick AS INT) + 1] END AS "string",
 CASE WHEN kind = 'list' THEN ['1,2,3', '0', '5,-1'][CAST(pick AS INT) + 1] END AS "list" """
D8 = f"""WITH {CODE_CTE}, {_ARGS},
p AS (SELECT *, {lcg_sql(key_hash_sql("path", "line", seed=42), "trial", "pos")} // 65536 % size AS pick
      FROM args, range(20) AS t(trial))
SELECT path, CAST(line AS INT) AS line, CAST(trial AS INT) AS trial, CAST(pos AS INT) AS pos, param, kind, {_VALUE}
FROM p"""


def d9_exhaustive_trials(spark, d):
    units = find_units(code_corpus(spark, d)).select("path", "line", "class", "params")
    return _flat_arguments(T.exhaustive_trials(units, ["path", "line"]))


D9 = f"""WITH {CODE_CTE}, {_ARGS},
st AS (SELECT *, coalesce(product(size) OVER (PARTITION BY path, line ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS stride,
        product(size) OVER (PARTITION BY path, line) AS total FROM args),
p AS (SELECT *, CAST(trial // CAST(stride AS BIGINT) AS BIGINT) % size AS pick FROM
      (SELECT *, unnest(range(CAST(total AS BIGINT))) AS trial FROM st))
SELECT path, CAST(line AS INT) AS line, CAST(trial AS BIGINT) AS trial, CAST(pos AS INT) AS pos, param, kind, {_VALUE}
FROM p"""


def d10_sample_trials(spark, d):
    """A fraction by threshold and an exact number by lowest hash, over all orders."""
    orders = read(spark, d, "orders")
    share = T.sample_trials(orders, "o_orderkey", 0.1, seed=7).select(F.lit("fraction").alias("how"), "o_orderkey")
    exact = T.sample_n_trials(orders, "o_orderkey", 500, seed=7).select(F.lit("exact").alias("how"), "o_orderkey")
    return share.unionByName(exact)


_H7 = key_hash_sql("o_orderkey", seed=7)
D10 = f"""SELECT 'fraction' AS how, o_orderkey FROM orders WHERE {_H7} < {int(0.1 * 2147483648)}
UNION ALL SELECT 'exact', o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY {_H7}, o_orderkey LIMIT 500)"""


# Amounts in cents keep sums exact.
_MOVE = "CAST(round(value * 100) AS BIGINT) * CASE WHEN event_type IN ('purchase', 'error') THEN -1 ELSE 1 END"
_START = 1000


def _moves(spark, d):
    return read(spark, d, "events").select("user_id", "ts", "event_id", F.expr(_MOVE).alias("move"), "event_type")


def d11_stateful_check(spark, d):
    return S.stateful_check(_moves(spark, d), ["user_id"], ["ts", "event_id"], "move", ["balance >= 0"],
                            requires="event_type <> 'view'", start=_START)


D11 = f"""WITH m AS (SELECT user_id, event_type <> 'view' AS ok, {_START} + sum(CASE WHEN event_type <> 'view' THEN {_MOVE} ELSE 0 END)
 OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS balance FROM events)
SELECT user_id, count(*) AS n_rows, count(*) FILTER (ok) AS n_checked, count(*) FILTER (ok AND balance < 0) AS n_failed,
 CAST(bool_or(ok AND balance < 0) AS INT) AS label, CAST(min(balance) AS BIGINT) AS lowest_balance FROM m GROUP BY 1"""


def d12_stateful_clamped(spark, d):
    return (S.running_state(_moves(spark, d), ["user_id"], ["ts", "event_id"], "move", start=_START, clamped=True)
            .select("user_id", "event_id", "balance"))


D12 = f"""WITH RECURSIVE m AS (SELECT user_id, event_id, {_MOVE} AS move,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT user_id, event_id, i, greatest(0, {_START} + move) AS balance FROM m WHERE i = 1
 UNION ALL SELECT m.user_id, m.event_id, m.i, greatest(0, r.balance + m.move)
 FROM r JOIN m ON m.user_id = r.user_id AND m.i = r.i + 1)
SELECT user_id, event_id, CAST(balance AS BIGINT) AS balance FROM r"""


def d13_missing_target(spark, d):
    """Every supplier nation asks for a verdict; only nations with indebted customers are checked."""
    verdicts = (read(spark, d, "customer").filter("c_acctbal < 0").groupBy(F.col("c_nationkey").alias("target"))
                .agg(F.bool_or(F.col("c_acctbal") < -900).cast("int").alias("label")))
    asked = read(spark, d, "supplier").select(F.col("s_suppkey"), F.col("s_nationkey").alias("target"))
    return D.resolve_targets(asked, verdicts)


D13 = """WITH v AS (SELECT c_nationkey AS target, CAST(bool_or(c_acctbal < -900) AS INT) AS label
 FROM customer WHERE c_acctbal < 0 GROUP BY 1)
SELECT s_suppkey, s_nationkey AS target, coalesce(label, 0) AS label, label IS NOT NULL AS resolved
FROM supplier LEFT JOIN v ON s_nationkey = target"""


def d14_invariant_check(spark, d):
    return D.invariant_check(read(spark, d, "customer"), ["c_acctbal >= -500", "length(c_name) > 3"], ["c_nationkey"])


D14 = """SELECT c_nationkey, count(*) AS n_rows, count(*) FILTER (NOT (c_acctbal >= -500 AND length(c_name) > 3)) AS n_broken,
 bool_and(c_acctbal >= -500 AND length(c_name) > 3) AS holds FROM customer GROUP BY 1"""


MANY = [Contract(f"t{i:02d}", f"l_extendedprice * (1 - l_discount) * (1 + l_tax) + {i}", [f"l_quantity > {i % 40}"],
                 [f"result <= l_extendedprice + {i * 10}", f"{floor_div('l_orderkey', str(i + 1))} >= 0"])
        for i in range(50)]


def d15_check_contracts(spark, d):
    return D.check_contracts(read(spark, d, "lineitem"), MANY)


D15 = f"""WITH o AS (SELECT i, l_quantity > i % 40 AS pre,
 NOT ({_TAXED} + i <= l_extendedprice + i * 10) AS bad FROM lineitem, range(50) AS r(i))
SELECT 't' || lpad(CAST(i AS VARCHAR), 2, '0') AS target, count(*) AS n_rows, count(*) FILTER (pre) AS n_checked,
 count(*) FILTER (NOT pre) AS n_skipped, count(*) FILTER (pre AND bad) AS n_failed, CAST(0 AS BIGINT) AS n_errors,
 CAST(bool_or(pre AND bad) AS INT) AS label, count(*) FILTER (pre) = 0 AS vacuous FROM o GROUP BY i"""


def d16_violating_rows(spark, d):
    keep = ["l_orderkey", "l_linenumber", "l_partkey"]
    return D.violating_rows(read(spark, d, "lineitem"), LINE_CONTRACTS, keep)


D16 = f"""WITH {_OUTCOMES} SELECT l_orderkey, l_linenumber, l_partkey, target,
 CASE WHEN err THEN 0 ELSE 1 END AS clause FROM o WHERE pre AND bad"""


def d17_contracts_as_rows(spark, d):
    """Contracts kept as rows, one per brand, with bounds seen on the training parts, in the session's vocabulary; checked on all parts."""
    register(spark)
    parts = read(spark, d, "part")
    worth = "floor_div(CAST(round(p_retailprice * 100) AS BIGINT), 100)"
    seen = (parts.filter("p_partkey % 10 <= 5").groupBy("p_brand")
            .agg(F.min(F.expr(worth)).alias("low"), F.max(F.expr(worth)).alias("high")))
    rows = seen.select(
        F.col("p_brand").alias("target"), F.lit(worth).alias("transform"),
        F.array(F.format_string("p_brand = '%s'", "p_brand"), F.lit("is_upper(text_prefix(p_type, 2))")).alias("requires"),
        F.array(F.format_string("result >= %d", "low"), F.format_string("result <= %d", "high")).alias("ensures"))
    table = materialize(rows, "contracts")
    return D.check_contracts(parts, D.contracts_from_table(table))


D17 = """WITH w AS (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) // 100 AS worth, left(p_type, 2) AS t2 FROM part),
b AS (SELECT p_brand, min(worth) AS low, max(worth) AS high FROM w WHERE p_partkey % 10 <= 5 GROUP BY 1),
o AS (SELECT b.p_brand AS target, w.p_brand = b.p_brand AND t2 = upper(t2) AND t2 <> lower(t2) AS pre, worth < low OR worth > high AS bad FROM w, b)
SELECT target, count(*) AS n_rows, count(*) FILTER (pre) AS n_checked, count(*) FILTER (NOT pre) AS n_skipped, count(*) FILTER (pre AND bad) AS n_failed,
 CAST(0 AS BIGINT) AS n_errors, CAST(coalesce(bool_or(pre AND bad), false) AS INT) AS label, count(*) FILTER (pre) = 0 AS vacuous FROM o GROUP BY 1"""


QUERIES = {
    "d1_lenient": (d1_lenient, D1),
    "d2_precondition_gate": (d2_precondition_gate, D2),
    "d3_apply_target": (d3_apply_target, D3),
    "d4_postcondition_check": (d4_postcondition_check, D4),
    "d5_label_targets": (d5_label_targets, D5),
    "d6_first_violation": (d6_first_violation, D6),
    "d7_verdict_counts": (d7_verdict_counts, D7),
    "d8_make_trials": (d8_make_trials, D8),
    "d9_exhaustive_trials": (d9_exhaustive_trials, D9),
    "d10_sample_trials": (d10_sample_trials, D10),
    "d11_stateful_check": (d11_stateful_check, D11),
    "d12_stateful_clamped": (d12_stateful_clamped, D12),
    "d13_missing_target_default": (d13_missing_target, D13),
    "d14_invariant_check": (d14_invariant_check, D14),
    "d15_check_contracts": (d15_check_contracts, D15),
    "d16_violating_rows": (d16_violating_rows, D16),
    "d17_contracts_as_rows": (d17_contracts_as_rows, D17),
}
