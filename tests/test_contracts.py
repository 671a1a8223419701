import random

import pytest
from pyspark.sql import functions as F

from pactum.functions.predicates import bind_clauses, floor_div, is_upper, item_at, lenient, prefix, total, with_entry
from pactum.functions.sql import register
from pactum.operators import contracts as C
from pactum.operators.contracts import Contract, check_contracts


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(-5, 5), rng.choice([None, 0, 1, 2, 7]), rng.choice(["a", "", None, "XYZ"])) for i in range(300)]
    return spark.createDataFrame(rows, "id bigint, a bigint, b bigint, s string").cache()


def verdicts(df, *contracts, **kw):
    return {r["target"]: r for r in check_contracts(df, contracts, **kw).collect()}


def test_semantics_against_plain_python(table):
    rows = table.collect()
    c = Contract("q", "try_divide(a, b)", ["b >= 0"], ["result >= 0", "result < 3"])
    v = verdicts(table, c)["q"]
    checked = [r for r in rows if r["b"] is not None and r["b"] >= 0]
    errors = [r for r in checked if r["b"] == 0]
    bad = [r for r in checked if r["b"] == 0 or not 0 <= r["a"] / r["b"] < 3]
    assert (v["n_rows"], v["n_checked"], v["n_skipped"]) == (300, len(checked), 300 - len(checked))
    assert (v["n_errors"], v["n_failed"], v["label"], v["vacuous"]) == (len(errors), len(bad), 1, False)


def test_null_result_may_be_allowed(table):
    strict, loose = Contract("x", "CAST(NULL AS INT)"), Contract("x", "CAST(NULL AS INT)", null_ok=True)
    assert verdicts(table, strict)["x"]["n_errors"] == 300
    assert verdicts(table, loose)["x"]["label"] == 0
    assert verdicts(table, Contract("y", "NULL"))["y"]["label"] == 1


def test_transform_is_not_evaluated_on_skipped_rows(table):
    # Under ANSI mode 1 / 0 raises; the precondition keeps it from being reached.
    v = verdicts(table, Contract("d", "a / b", ["b > 0"], ["a / b < 100"]))["d"]
    assert v["label"] == 0 and v["n_checked"] > 0


def test_unbound_clauses(table):
    v = verdicts(table, Contract("pre", "a", ["nope > 0"]), Contract("body", "nope + 1"),
                 Contract("post", "a", [], ["size(result) > 0"]), Contract("syntax", "a", [], ["result >"]))
    assert (v["pre"]["label"], v["pre"]["vacuous"]) == (0, True)
    assert (v["body"]["label"], v["body"]["n_errors"]) == (1, 300)
    assert (v["post"]["label"], v["post"]["n_errors"]) == (1, 0)
    assert v["syntax"]["label"] == 1


def test_clauses_of_any_type_have_a_truth_value(table):
    v = verdicts(table, Contract("number", "a", ["b"]), Contract("text", "a", ["s"]), Contract("list", "a", ["array(a)"]),
                 Contract("empty", "a", ["array()"]), Contract("null", "a", ["NULL"]))
    rows = table.collect()
    assert v["number"]["n_checked"] == sum(bool(r["b"]) for r in rows)
    assert v["text"]["n_checked"] == sum(bool(r["s"]) for r in rows)
    assert v["list"]["n_checked"] == 300 and v["empty"]["vacuous"] and v["null"]["vacuous"]


def test_label_does_not_depend_on_order_or_partitions(table):
    c = [Contract("t", "a + 1", ["b > 0"], ["result < 6"]), Contract("u", "try_divide(a, b)", [], ["result < 9"])]
    base = check_contracts(table, c, ["id"]).collect()
    for n in (1, 7):
        assert check_contracts(table.repartition(n, F.rand(n)), c, ["id"]).collect() == base


def test_many_contracts_equal_single_runs(table):
    many = [Contract(f"t{i}", f"a * {i}", [f"b > {i % 3}"], [f"result < {i}"]) for i in range(70)]
    together = {r["target"]: tuple(r) for r in check_contracts(table, many).collect()}
    assert len(together) == 70
    for c in many[::9]:
        assert together[c.target] == tuple(check_contracts(table, [c]).first())


def test_empty_table(table):
    v = verdicts(table.limit(0), Contract("t", "a", [], ["result > 0"]), order=["id"])["t"]
    assert (v["n_rows"], v["n_failed"], v["label"], v["vacuous"], v["first_bad"]) == (0, 0, 0, True, None)


def test_first_violation_and_bad_rows(table):
    c = Contract("t", "try_divide(a, b)", ["a > 0"], ["result > 1", "result < 2"])
    rows = [r for r in table.orderBy("id").collect() if r["a"] > 0]

    def clause(r):
        if not r["b"]:
            return 0
        q = r["a"] / r["b"]
        return 1 if not q > 1 else 2 if not q < 2 else None

    want = [(r["id"], clause(r)) for r in rows if clause(r) is not None]
    got = C.violating_rows(table, [c], ["id"]).orderBy("id").collect()
    assert [(r["id"], r["clause"]) for r in got] == want
    assert C.first_violation(table, [c], ["id"], ["a"]).first()["id"] == want[0][0]


def test_result_means_what_the_analyser_says(table):
    """A lambda's own `result`, strings and fields stay what they are; the transform is computed once."""
    v = verdicts(table, Contract("lambda", "array(a, id)", [], ["exists(result, result -> result > -1)"]),
                 Contract("string", "s", ["s = 'a'"], ["result <> 'result'", "named_struct('result', 1).result = 1"]),
                 Contract("once", "rand()", [], ["result = result", "result < 1"]), Contract("column", "a", [], ["`result` = a"]))
    assert [v[t]["n_failed"] for t in ("lambda", "string", "once", "column")] == [0, 0, 0, 0] and v["string"]["n_checked"] > 0
    rows = C.row_verdicts(table.withColumn("result", F.lit("old")), Contract("once", "rand()", ["a > 0"], ["result < 1"])).collect()
    assert all(r["pre"] == (r["a"] > 0) and not r["bad"] and (r["result"] is not None) == r["pre"] for r in rows)


def test_errors_are_false_and_failing_transforms_are_errors(table):
    rows = table.withColumn("v", F.array("a", "b")).collect()
    df = table.withColumn("v", F.array("a", "b"))
    v = verdicts(df, Contract("quotient", "id", ["id / b > 1"], ["id / b < 100"]), Contract("body", "a / b"), Contract("cast", "CAST(s AS INT)"),
                 Contract("element", "v[4]", [], ["result > 0"]), Contract("post", "a", [], ["v[9] > 0"]), Contract("date", "CAST(s AS DATE)"),
                 order=["id"])
    fits = [r for r in rows if r["b"] and r["id"] / r["b"] > 1]
    assert v["quotient"]["n_checked"] == len(fits) and v["quotient"]["n_failed"] == sum(r["id"] / r["b"] >= 100 for r in fits)
    assert v["body"]["n_errors"] == sum(not r["b"] for r in rows)
    assert [v[t]["n_errors"] for t in ("cast", "element", "post", "date")] == [300, 300, 0, 300] and v["post"]["n_failed"] == 300
    assert C.row_verdicts(df, Contract("body", "a / b")).filter("err").count() == v["body"]["n_errors"]
    assert C.precondition_gate(df, ["id / b > 1"]).count() == len(fits)
    held = bind_clauses(df, ["id / b > 1", "b + 1 > 0", "v[4] > 0"]).agg(F.count_if("c0"), F.count_if("c1"), F.count_if("c2")).first()
    assert tuple(held) == (len(fits), sum(r["b"] is not None for r in rows), 0)
    assert df.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"


def test_overflow_is_never_a_value(spark):
    from pyspark.errors import ArithmeticException

    big = spark.createDataFrame([(2**63 - 1, 2**31 - 1, 1e300, "3")], "a bigint, i int, x double, s string")
    for clause in ("a + 1 < 0", "i * 2 < 0", "-a - 2 > 0", "abs(a) + 1 < 0", "CAST(x AS INT) > 0", "int(a) < 0", "CAST(s AS INT) + 2147483647 < 0"):
        with pytest.raises(ArithmeticException):
            check_contracts(big, [Contract("t", "a", [clause])]).collect()
    with pytest.raises(ArithmeticException):
        check_contracts(big, [Contract("t", "a", [], ["result + 1 < 0"])]).collect()
    safe = verdicts(big, Contract("t", "x * (1 - x) / 0"), Contract("u", "a", ["CAST(s AS INT) = 3", "a > -1"], ["result > -5"]))
    assert safe["t"]["n_errors"] == 1 and safe["u"]["n_checked"] == 1 and safe["u"]["n_failed"] == 0


def test_contract_rows(spark, table):
    rows = spark.createDataFrame([("t", "a", ["b > 0"], ["result > 0"])],
                                 "target string, transform string, requires array<string>, ensures array<string>")
    assert C.contracts_from_table(rows) == [Contract("t", "a", ("b > 0",), ("result > 0",))]


def test_targets_must_be_unique_and_present(table):
    with pytest.raises(ValueError):
        check_contracts(table, [Contract("t", "a"), Contract("t", "b")])
    with pytest.raises(ValueError):
        check_contracts(table, [])


def test_quoted_names(table):
    assert "o'brien" in verdicts(table, Contract("o'brien", "a"))


def test_resolve_and_invariants(spark, table):
    asked = spark.createDataFrame([("t",), ("gone",)], "target string")
    out = {r["target"]: (r["label"], r["resolved"]) for r in C.resolve_targets(
        asked, check_contracts(table, [Contract("t", "a", [], ["result > 0"])])).collect()}
    assert out == {"t": (1, True), "gone": (0, False)}
    held = {r["s"]: r["holds"] for r in C.invariant_check(table, ["b >= 0"], ["s"]).collect()}
    rows = table.collect()
    assert held == {s: all(r["b"] is not None and r["b"] >= 0 for r in rows if r["s"] == s) for s in held}


def test_vocabulary(spark):
    row = spark.sql(f"""SELECT {floor_div('-7', '2')} AS a, {floor_div('7', '-2')} AS b, {floor_div('1', '0')} AS c,
        {floor_div('9007199254740993', '1')} AS big,
        {item_at('array(1, 2, 3)', '-1')} AS d, {item_at('array(1, 2, 3)', '0')} AS e, {item_at('array(1)', '4')} AS f,
        {total('array(1L, 2L)')} AS g, {is_upper("'AB1'")} AS h, {is_upper("'1'")} AS i, {prefix("'hello'", '2')} AS j,
        {prefix("'hello'", '-1')} AS k, {with_entry("map('x', 1)", "'x'", '2')} AS m""").first()
    assert tuple(row) == (-4, -4, None, 9007199254740993, 3, 1, None, 3, True, False, "he", "hell", {"x": 2})
    assert spark.range(1).select(lenient("CAST(NULL AS BOOLEAN)").alias("x")).first()["x"] is False


def test_preconditions_reach_the_scan(spark, sf):
    gated = C.precondition_gate(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_quantity > 10", "l_tax"]).select("l_orderkey")
    plan = gated._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,10.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_tax:double>" in plan


def test_sql_functions(spark):
    register(spark)
    row = spark.sql("""SELECT risk_level(0.2D) AS a, risk_level(0.6D) AS b, floor_div(-7, 2) AS c, is_upper('AB') AS d,
                       text_prefix('hello', 2) AS e, recall_risky(3, 1) AS f, recall_risky(0, 0) AS g""").first()
    assert tuple(row) == ("MEDIUM", "HIGH", -4, True, "he", 0.75, 0.0)
    df = spark.range(-5, 6).selectExpr("id AS a")
    assert verdicts(df, Contract("t", "floor_div(a, 2)", [], ["result * 2 = a"]))["t"]["n_failed"] == 6


def test_runtime_errors_keep_their_kind_after_a_check(spark):
    from pyspark.errors import ArithmeticException

    from pactum import Contract, check_contracts

    check_contracts(spark.range(3), [Contract("odd", "no_such_column", [], ["result > 0"])]).collect()
    with pytest.raises(ArithmeticException):
        spark.sql("select 1/0").collect()
