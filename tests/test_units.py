import ast
import os
import random

import pytest
from pyspark.sql import functions as F

from catalog import monitoring
from pactum.functions.text import parameter_names
from pactum.operators import risk
from pactum.operators.features import contract_features
from pactum.operators.trials import exhaustive_trials
from pactum.operators.units import (class_invariants, classify_lines, clauses_above, describe_units, explode_lines,
                                    extract_clauses, quarantine, structure)
from pactum.sources.corpus import read_corpus

HERE = os.path.dirname(os.path.abspath(__file__))


def corpus(spark, *texts):
    rows = [("p", f"f{i}.py", f"f{i}.py", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "pool string, path string, file string, content string")


def units(spark, *texts, **kw):
    return {(r["path"], r["name"]): r for r in describe_units(corpus(spark, *texts), **kw).collect()}


@pytest.mark.parametrize("header, names", [
    ("def f(a, b=((((((1,),),),),),), c=2):", ["a", "b", "c"]),
    ("def f(a,  b: dict[str, list[tuple[int, (int)]]] = {1: [(2, 3)]}, *, d=[[]]) -> dict[str, int]:", ["a", "b"]),
    ("def f(x=lambda p, q: (p, q), y=1):", ["x", "y"])])
def test_parameters_at_any_depth(spark, header, names):
    row = spark.createDataFrame([(header,)], "h string").select(parameter_names(F.col("h")).alias("p")).first()
    assert [p for p in row["p"] if p not in ("q",)] == names


def test_header_continued_by_backslash(spark):
    found = units(spark, "def f(a, \\\n      b, \\\n      c):\n    return a\n")
    assert found["f0.py", "f"]["params"] == ["a", "b", "c"]


def test_line_numbers_and_trailing_newline(spark):
    rows = explode_lines(corpus(spark, "a\nb\n", "a\r\nb\rc", "", "\n", "x\n\n")).groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("line", "text"))).alias("l")).collect()
    got = {r["path"]: [(x["line"], x["text"]) for x in r["l"]] for r in rows}
    assert got == {"f0.py": [(1, "a"), (2, "b")], "f1.py": [(1, "a"), (2, "b"), (3, "c")],
                   "f3.py": [(1, "")], "f4.py": [(1, "x"), (2, "")]}


def test_line_kinds_strip_every_kind_of_space(spark):
    rows = classify_lines(explode_lines(corpus(spark, "\t# c\n\u00a0\u2003\n x\n\x0b#\n"))).orderBy("line").collect()
    assert [r["kind"] for r in rows] == ["comment", "blank", "code", "comment"]
    assert [r["indent"] for r in rows] == [8, 0, 1, 0]


def test_clause_matching(spark):
    text = "# @requires a\n#@ensuresX b\n##@requires c\n#  @invariant\n# see @requires d\nx = 1  # @requires e\n"
    rows = extract_clauses(explode_lines(corpus(spark, text))).orderBy("line").collect()
    assert [(r["line"], r["clause"], r["expr"]) for r in rows] == [
        (1, "requires", "a"), (2, "ensures", "X b"), (4, "invariant", "")]


def test_block_above_skips_blanks_but_ends_at_a_gap(spark):
    text = "# @requires far\n\n# @requires near\n# note\n# @ensures e\n\n\ndef f(a):\n    return a\n"
    u = units(spark, text)["f0.py", "f"]
    assert u["requires"] == ["near"] and u["ensures"] == ["e"]


def test_decorator_hides_the_block_above(spark):
    u = units(spark, "# @requires r\n@cached\ndef f(a):\n    # @ensures e\n    return a\n")["f0.py", "f"]
    assert u["requires"] == [] and u["ensures"] == ["e"] and u["line"] == 3


def test_trailing_comment_belongs_to_the_next_function(spark):
    u = units(spark, "def f(a):\n    return a\n    # @ensures t\ndef g(b):\n    return b\n")
    assert u["f0.py", "f"]["ensures"] == [] and u["f0.py", "f"]["n_loc"] == 2
    assert u["f0.py", "g"]["ensures"] == ["t"]


def test_invariants_come_from_above_the_class(spark):
    text = ("# @invariant i\nclass A:\n    # @invariant body\n    def m(self):\n        # @invariant own\n        return 1\n"
            "def f():\n    # @invariant x\n    pass\n")
    u = units(spark, text)
    assert u["f0.py", "m"]["invariant"] == ["i"] and u["f0.py", "f"]["invariant"] == []
    assert units(spark, text, invariant_scope="body")["f0.py", "m"]["invariant"] == ["i", "body", "own"]
    assert [r["invariant"] for r in class_invariants(corpus(spark, text)).collect()] == [["i"]]


def test_only_direct_members_are_units(spark):
    text = ("async def a(x):\n    return x\nif True:\n    def b(x):\n        return x\n"
            "def c(x):\n    def d(y):\n        # @requires y\n        return y\n    return d\n"
            "class K:\n    class L:\n        def e(self):\n            return 1\n    def g(self):\n        return 2\n")
    u = units(spark, text)
    assert set(u) == {("f0.py", "c"), ("f0.py", "g")}
    assert u["f0.py", "c"]["requires"] == ["y"] and u["f0.py", "g"]["class"] == "K"


def test_strings_do_not_break_structure(spark):
    text = ('def f(a, b="x(,"):\n    """doc (\n# @requires in_doc\ndef not_a_unit(q):\n"""\n    s = \'#\'\n'
            "    return [a,\n  b]\n\ndef g(c): return c\n")
    u = units(spark, text)
    assert set(u) == {("f0.py", "f"), ("f0.py", "g")}
    assert u["f0.py", "f"]["n_loc"] == 8 and u["f0.py", "f"]["params"] == ["a", "b"]
    assert u["f0.py", "f"]["requires"] == ["in_doc"]


@pytest.mark.parametrize("header, names", [
    ("def f():", []), ("def f(a):", ["a"]), ("def f(a, b=1, *args, c, **kw) -> int:", ["a", "b"]),
    ("def f(a, /, b, *, c):", ["b"]), ("def f(a: dict[str, int] = {}, b=(1, (2, 3))):", ["a", "b"]),
    ("def f(a=lambda x, y: x, b=2): return (a)", ["a", "b"]), ("def f[T](x: T, *, y):", ["x"]), ("def f(*, a):", []),
])
def test_parameter_names(spark, header, names):
    row = spark.createDataFrame([(header,)], ["h"]).select(parameter_names(F.col("h")).alias("p")).first()
    assert row["p"] == names


def _random_source(rng):
    """A small module with nested, decorated, multi-line and class-held functions."""
    out, n = [], 0

    def body(pad):
        for _ in range(rng.randint(0, 3)):
            out.append(pad + rng.choice(["# @requires a", "# note", "x = (1,\n" + pad + "     2)", "", "y = '(' + \"#\"",
                                         "if x:\n" + pad + "    x = 2", "'''a\n b ('''", "z = 1  # ("]))
        out.append(pad + rng.choice(["return 1", "pass", "return [\n" + pad + "]"]))
        if rng.random() < 0.3:
            out.append(pad + "# @ensures late")

    def function(pad):
        nonlocal n
        n += 1
        if rng.random() < 0.3:
            out.append(pad + "# @requires above")
        if rng.random() < 0.2:
            out.append(pad + "@deco(1)")
        params = rng.choice(["a, b", "a, b=(1, 2)", "", "a,\n" + pad + "        b", "a, *r, k=1", "p, /, q", "s='x)'"])
        out.append(f"{pad}def f{n}({params}):")
        body(pad + "    ")
        if rng.random() < 0.3:
            out.append("")

    for _ in range(rng.randint(1, 5)):
        if rng.random() < 0.35:
            out.append("# @invariant i\nclass C:" if rng.random() < 0.5 else "class D(object):")
            for _ in range(rng.randint(1, 3)):
                function("    ")
        elif rng.random() < 0.2:
            out.append("value = {\n    'a': 1,\n}")
        else:
            function("")
    return "\n".join(out) + "\n"


def test_units_agree_with_the_language_parser(spark):
    rng = random.Random(5)
    texts = [_random_source(rng) for _ in range(120)]
    want = set()
    for i, t in enumerate(texts):
        for top in ast.parse(t).body:
            members = [(top, "")] if isinstance(top, ast.FunctionDef) else [
                (m, top.name) for m in getattr(top, "body", []) if isinstance(top, ast.ClassDef)]
            for m, holder in members:
                want.add((f"f{i}.py", m.name, holder, m.lineno, m.end_lineno - m.lineno + 1,
                          ",".join(a.arg for a in m.args.args)))
    got = {(r["path"], r["name"], r["class"] or "", r["line"], r["n_loc"], ",".join(r["params"]))
           for r in describe_units(corpus(spark, *texts)).collect()}
    assert got == want


def test_inconsistent_files_are_set_aside(spark):
    bad = quarantine(corpus(spark, "x = 1\n", "x = 'open\n", "f((1)\n", "s = '('  # )\n")).select("path").collect()
    assert {r["path"] for r in bad} == {"f1.py", "f2.py"}


def test_brackets_pair_in_order_and_kind(spark):
    rng, closer = random.Random(8), {"(": ")", "[": "]", "{": "}"}

    def sound(brackets):
        awaited = []
        for b in brackets:
            if b in closer:
                awaited.append(closer[b])
            elif not awaited or awaited.pop() != b:
                return False
        return not awaited

    def nested(depth):
        return "".join(o + nested(depth - 1) + closer[o] for o in rng.choices("([{", k=rng.randint(0, 2))) if depth else ""

    texts = ["".join(rng.choices("()[]{}", k=rng.randint(0, 6))) for _ in range(300)] + [nested(7) for _ in range(60)]
    texts += ["(" * 500 + ")" * 500, "([" * 300 + ")]" * 300, "x = )(", "x = (]", ""]
    got = {r["path"]: r["fault"] for r in quarantine(corpus(spark, *[" a ".join(t) + "\n" for t in texts])).collect()}
    want = {f"f{i}.py": "unpaired bracket" for i, t in enumerate(texts) if not sound(t)}
    assert got == want and 100 < len(want) < len(texts) - 50


def test_only_sound_files_are_described(spark):
    good = "def f(a):\n    return (a)\n"
    df = corpus(spark, good, good + "x = )(\n", good + "x = (]\n", good + 'y = "open\n', good + "s = ')('  # ((\n", "")
    assert {r["path"] for r in describe_units(df).collect()} == {"f0.py", "f4.py"}
    assert {r["path"]: r["fault"] for r in quarantine(df).collect()} == {
        "f1.py": "unpaired bracket", "f2.py": "unpaired bracket", "f3.py": "stray quote"}


def test_extraction_needs_one_exchange(spark):
    plan = describe_units(corpus(spark, "def f():\n    pass\n"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_blocks_above_on_headers(spark):
    rows = clauses_above(corpus(spark, "# @invariant i\n\nclass A:\n    # @requires r\n    def m(self):\n        pass\n"))
    assert {(r["header_line"], r["line"], r["clause"]) for r in rows.collect()} == {(3, 1, "invariant"), (5, 4, "requires")}


def test_structure_keeps_every_line(spark):
    text = _random_source(random.Random(1))
    assert structure(corpus(spark, text)).count() == len(text.splitlines())


@pytest.mark.skipif("SAMPLE_DIRS" not in os.environ, reason="set SAMPLE_DIRS to the folders of the sample programs")
def test_golden_feature_rows(spark):
    c = read_corpus(spark, os.environ["SAMPLE_DIRS"].split(","), "all")
    feats = contract_features(describe_units(c), ("path", "name"))
    got = {(r["path"].rsplit("/", 1)[-1], r["name"]): tuple(r)[2:] for r in feats.collect()}
    want = {}
    with open(os.path.join(HERE, "..", "FIXTURES.md"), encoding="utf-8") as f:
        for line in f:
            cells = [x.strip() for x in line.strip().strip("|").split("|")]
            if len(cells) == 14 and cells[1].startswith("example"):
                want[cells[1], cells[2]] = tuple(map(int, cells[3:]))
    assert len(want) == 44 and got == want


def test_lines_pass_few_windows(spark):
    """Each window copies every line once more: those that ask nothing of one another are one."""
    plan = describe_units(corpus(spark, "def f(a):\n    return a\n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") <= 6


def test_units_are_told_once_to_fit_and_to_score(spark, sf, monkeypatch):
    told = []
    for module in (monitoring, risk):
        monkeypatch.setattr(module, "describe_units", lambda c, real=describe_units: told.append(1) or real(c))
    assert monitoring.h2_score_units(spark, sf).count() > 0 and len(told) == 1


def test_trials_are_numbered_after_their_arguments_come_apart(spark):
    trials = exhaustive_trials(describe_units(corpus(spark, "def f(a, s):\n    return a\n")), ["path", "line"])
    plan = trials._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(sequence(_block") < plan.index("inline(_args")  # the plan is printed from its end
    got = sorted((r["trial"], r["pos"], r["number"], r["string"]) for r in trials.collect())
    want = [(t, 0, t % 11 - 5, None) for t in range(33)] + [(t, 1, None, ("a", "hello", "XYZ")[t // 11]) for t in range(33)]
    assert got == sorted(want, key=lambda r: r[:2])
