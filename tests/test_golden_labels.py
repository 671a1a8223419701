"""Sample contracts restated as Spark SQL over every argument combination.

Expected counts are read from the fixture table, section 3.
"""

import os

import pytest

from pactum.functions.predicates import floor_div, is_upper, item_at, prefix, total, with_entry
from pactum.operators.contracts import Contract, check_contracts
from pactum.operators.state import stateful_check
from pactum.operators.trials import argument_grid, exhaustive_trials, make_trials

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "FIXTURES.md")
NOT_EMPTY = "size(values) > 0"

# Unit, parameters, transform, requires, ensures.
CASES = [
    ("div", "a b", floor_div("a", "b"), ["b <> 0"], ["result * b = a"]),
    ("sqrt", "x", "sqrt(x)", ["x >= 0"], ["result >= 0"]),
    ("mean", "values", f"try_divide({total('values')}, size(values))", [NOT_EMPTY],
     ["result >= array_min(values)", "result <= array_max(values)"]),
    ("clamp", "x lo hi", "CASE WHEN x < lo THEN lo WHEN x > hi THEN hi ELSE x END", ["lo <= hi"],
     ["result >= lo", "result <= hi"]),
    ("reciprocal", "x", "try_divide(1, x)", ["true"], ["result > 0"]),
    ("abs_value", "x", "x", ["true"], ["result >= 0"]),
    ("maximum", "a b", "CASE WHEN a >= b THEN a ELSE b END", ["true"], ["result >= a", "result >= b"]),
    ("impossible", "x", "x", ["true"], ["result < x", "result > x"]),
    ("to_uppercase", "s", "upper(s)", ["length(s) > 0"], [is_upper("result")]),
    ("duplicate", "values", "concat(values, values)", [NOT_EMPTY], ["size(result) = 2 * size(values)"]),
    ("truncate", "s n", prefix("s", "n + 1"), ["n >= 0"], ["length(result) <= n"]),
    ("pop_element", "values", item_at("values", "-1"), ["true"], ["size(result) >= 0"]),
    ("square", "x", "x * x", ["true"], ["result >= 0"]),
    ("decrement", "x", "x - 1", ["true"], ["result >= x"]),
    ("add", "a b", "a + b", ["true"], ["result = a + b"]),
    ("first_char", "s", "right(s, 1)", ["length(s) > 0"], ["result = left(s, 1)"]),
    ("uppercase", "s", "upper(s)", ["length(s) > 0"], [is_upper("result")]),
    ("head", "values", item_at("values", "-1"), [NOT_EMPTY], [f"result = {item_at('values', '0')}"]),
    ("length", "values", "size(values)", ["true"], ["result >= 0"]),
    ("positive", "x", "x", ["true"], ["result > 0"]),
    ("abs_nonnegative", "x", "abs(x)", ["true"], ["result >= 0"]),
    ("contradiction", "x", "x", ["true"], ["result > x", "result < x"]),
    ("first", "values", item_at("values", "-1"), [NOT_EMPTY], [f"result = {item_at('values', '0')}"]),
    ("tail", "values", "slice(values, 2, size(values))", [NOT_EMPTY], ["size(result) = size(values) - 1"]),
    ("percentage", "x total", floor_div("x * 100", "total"), ["total <> 0"], ["result * total = x * 100"]),
    ("ratio", "x total", "try_divide(x * 1.0D, total)", ["total <> 0"], ["result >= 0"]),
    ("strip_spaces", "s", "trim(s)", ["length(s) > 0"], ["length(result) <= length(s)"]),
    ("reverse_string", "s", "s", ["length(s) > 0"], ["result = reverse(s)"]),
    ("repeat", "s n", "repeat(s, CAST(n AS INT))", ["n >= 0"], ["length(result) = length(s) * n"]),
    ("last", "values", item_at("values", "-1"), [NOT_EMPTY], [f"result = {item_at('values', '-1')}"]),
    ("remove_first", "values", "slice(values, 1, size(values) - 1)", [NOT_EMPTY],
     ["size(result) = size(values) - 1", f"{item_at('result', '0')} = {item_at('values', '1')}"]),
    ("total_sum", "values", total("values"), [NOT_EMPTY], ["result >= 0"]),
    ("keys_count", "d", "size(d)", ["true"], ["result = size(d)"]),
    ("get_value", "d key", "NULL", ["map_contains_key(d, key)"], ["result = try_element_at(d, key)"]),
    ("update_value", "d key value", with_entry("d", "key", "value"), ["true"], ["try_element_at(result, key) = value"]),
    ("remove_key", "d key", "d", ["map_contains_key(d, key)"], ["NOT map_contains_key(result, key)"]),
    ("append", "values x", "concat(values, array(x))", ["true"], ["size(result) = size(values) + 1"]),
    ("index", "values i", item_at("values", "i"), ["true"], [f"result = {item_at('values', 'i')}"]),
    ("power", "x n", "power(x, n)", ["n >= 0"], ["result >= 1"]),
    ("wrong_power", "x n", "x - n", ["n >= 0"], ["result = power(x, n)"]),
]


def _expected():
    out = {}
    with open(FIXTURES, encoding="utf-8") as f:
        for line in f:
            cells = [x.strip() for x in line.strip().strip("|").split("|")]
            if len(cells) in (9, 10) and cells[1].startswith("example") and cells[3].isdigit():
                out[cells[2]] = tuple(int(c) for c in cells[3:8])
    return out


@pytest.mark.parametrize("unit, params, transform, requires, ensures", CASES, ids=[c[0] for c in CASES])
def test_label(spark, unit, params, transform, requires, ensures):
    grid = argument_grid(spark.range(1), params.split())
    v = check_contracts(grid, [Contract(unit, transform, requires, ensures)]).first()
    assert (v["n_rows"], v["n_checked"], v["n_errors"], v["n_failed"], v["label"]) == _expected()[unit]


def _calls(spark, amounts):
    return spark.createDataFrame([("k", i, a) for i, a in enumerate(amounts)], "k string, i int, amount bigint")


def test_account_methods(spark):
    df = _calls(spark, [5, -3, 4, 5, 2, 5, 1])
    positive = "amount > 0"
    run = lambda change, **kw: stateful_check(df, ["k"], ["i"], change, ["balance >= 0"], positive, **kw).first()["label"]
    assert run("amount") == 0
    assert run("-amount") == 1
    assert run("-amount", clamped=True) == 0


def test_trials_stay_in_their_domains(spark):
    units = spark.createDataFrame(
        [("u", "K", ["self", "other", "s", "values", "n"], 7), ("v", None, ["other", "self"], 8), ("w", None, [], 9)],
        "name string, class string, params array<string>, id bigint")
    rows = make_trials(units, ["name"], "id", n=50, seed=3).collect()
    u = [r for r in rows if r["name"] == "u"]
    assert len(u) == 50 * 4 and {r["param"] for r in u} == {"other", "s", "values", "n"}
    assert {r["string"] for r in u if r["param"] == "s"} == {"a", "hello", "XYZ"}
    assert {tuple(r["list"]) for r in u if r["param"] == "values"} == {(1, 2, 3), (0,), (5, -1)}
    assert {r["number"] for r in u if r["param"] == "n"} <= set(range(-5, 6))
    assert {r["number"] for r in u if r["param"] == "other"} == {10}
    v = [r for r in rows if r["name"] == "v"]
    assert {r["kind"] for r in v} == {"int"} and len(v) == 100
    again = make_trials(units.repartition(5), ["name"], "id", n=50, seed=3).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_exhaustive_trials_cover_the_product(spark):
    units = spark.createDataFrame([("u", None, ["s", "n", "values"])], "name string, class string, params array<string>")
    rows = exhaustive_trials(units, ["name"]).collect()
    calls = {}
    for r in rows:
        calls.setdefault(r["trial"], {})[r["param"]] = r["number"] if r["kind"] == "int" else r["string"] or tuple(r["list"])
    assert len(calls) == 99 and len({tuple(sorted(map(str, c.items()))) for c in calls.values()}) == 99


def test_many_parameters_make_no_large_array(spark):
    """Eight integer parameters: 11 ** 8 trials, counted from their blocks."""
    from pactum.operators import trials

    units = spark.createDataFrame([("u", None, list("abcdefgh"))], "name string, class string, params array<string>")
    plan = trials.exhaustive_trials(units, ["name"])._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and str(trials.BLOCK) in plan
    few = spark.createDataFrame([("v", None, ["a", "b"])], "name string, class string, params array<string>")
    assert trials.exhaustive_trials(few, ["name"]).select("trial").distinct().count() == 121


def test_a_large_grid_is_made_in_blocks(spark, monkeypatch):
    from pactum.operators import trials

    whole = sorted(map(tuple, argument_grid(spark.range(2), ["a", "s"]).collect()))
    assert len(whole) == 2 * 33 and len(set(whole)) == 66
    monkeypatch.setattr(trials, "BLOCK", 7)
    assert sorted(map(tuple, argument_grid(spark.range(2), ["a", "s"]).collect())) == whole
    with pytest.raises(OverflowError):
        argument_grid(spark.range(1), list("abcdefghijklmnopqrst"))
