import itertools
import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from pactum.llm.common import fold, table
from pactum.llm.hidden_markov import Markov, expected_counts, forward, groups, maximized, score_texts, shape_of

from .conftest import odd_texts


def small_model(states=3, symbols=5):
    rng = np.random.default_rng(1)
    part = lambda *shape: rng.uniform(0.1, 1, shape)
    start, move, emit = part(states), part(states, states), part(symbols, states)
    return Markov(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def path_sum(m, run):
    states = range(len(m.start))
    total = 0.0
    for path in itertools.product(states, repeat=len(run)):
        p = m.start[path[0]] * m.emit[run[0], path[0]]
        for a, b, x in zip(path, path[1:], run[1:], strict=False):
            p *= m.move[a, b] * m.emit[x, b]
        total += p
    return total


def test_forward_is_exact():
    m = small_model()
    runs = [np.array(r, np.uint16) for r in ([0], [1, 2], [4, 0, 0, 3, 2, 1], [2, 2, 2, 2])]
    assert np.allclose(forward(m, runs), [math.log(path_sum(m, r)) for r in runs])


def test_probabilities_of_all_runs_of_a_length_sum_to_one():
    m = small_model()
    runs = [np.array(r, np.uint16) for r in itertools.product(range(5), repeat=3)]
    assert abs(np.exp(forward(m, runs)).sum() - 1) < 1e-9


def test_expected_counts_match_paths_and_training_helps():
    m, runs = small_model(), [np.array(r, np.uint16) for r in ([0, 1, 1, 4], [3, 2], [0, 0, 1])]
    emit, move, start = np.zeros((5, 3)), np.zeros((3, 3)), np.zeros(3)
    expected_counts(m, runs, emit, move, start)
    want = np.zeros((5, 3))
    for run in runs:
        total = path_sum(m, run)
        for path in itertools.product(range(3), repeat=len(run)):
            p = m.start[path[0]] * m.emit[run[0], path[0]]
            for a, b, x in zip(path, path[1:], run[1:], strict=False):
                p *= m.move[a, b] * m.emit[x, b]
            for s, x in zip(path, run, strict=True):
                want[x, s] += p / total
    assert np.allclose(emit, want) and abs(start.sum() - 3) < 1e-9 and abs(move.sum() - 6) < 1e-9
    better = maximized(emit, move, start)
    assert forward(better, runs).sum() > forward(m, runs).sum()


def test_blocks_of_steps_change_nothing():
    m, rng = small_model(), np.random.default_rng(3)
    runs = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 2, 7, 8, 9, 40, 2500)]
    told = []
    for block in (1, 4, 8, 5000):
        emit, move, start = np.zeros((5, 3)), np.zeros((3, 3)), np.zeros(3)
        expected_counts(m, runs, emit, move, start, block)
        told.append(np.concatenate([emit.ravel(), move.ravel(), start]))
    assert all(np.allclose(t, told[0]) for t in told[1:])
    assert abs(told[0][:15].sum() - 2567) < 1e-6 and abs(told[0][15:24].sum() - 2560) < 1e-6
    assert sorted(i for g in groups(runs, 100, 10) for i in g) == list(range(7))


def plain_baum_welch(codes, symbols, states, rounds):
    """Unscaled forward and backward tables, one text at a time, from the same start."""
    rng = np.random.default_rng(7)
    move = np.where(np.eye(states), 0.9, 0.1 / (states - 1))
    emit = rng.uniform(0.2, 1.8, (symbols, states))
    m = Markov(np.full(states, 1 / states), move, emit / emit.sum(0))

    def tables(run):
        a, b = [m.start * m.emit[run[0]]], [np.ones(states)]
        for x in run[1:]:
            a.append((a[-1] @ m.move) * m.emit[x])
        for x in reversed(run[1:]):
            b.insert(0, m.move @ (m.emit[x] * b[0]))
        return a, b, a[-1].sum()

    for _ in range(rounds):
        emit, move, start = np.zeros((symbols, states)), np.zeros((states, states)), np.zeros(states)
        for run in codes:
            a, b, total = tables(run)
            start += a[0] * b[0] / total
            for t, x in enumerate(run):
                emit[x] += a[t] * b[t] / total
                if t:
                    move += np.outer(a[t - 1], m.emit[x] * b[t]) * m.move / total
        m = maximized(emit, move, start)
    return lambda run: math.log10(tables(run)[2])


def test_scores_equal_plain_baum_welch_and_word_shares(spark):
    singles, shapes = 3, 2
    texts = {0: "a b a c a b dd", 1: "b a eee a a b ff", 2: "a a b c dd zz", 3: "c a b a gggg", 4: "", 5: "a b b a c c hh a q"}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    learned = [t for i, t in texts.items() if i not in (2, 5)]
    counts = Counter(w.encode() for t in learned for w in t.split())
    single = [w for w, _ in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:singles]]
    assert [counts[w] for w in single] == [8, 5, 2]  # no ties at the border
    code = lambda w: single.index(w) if w in single else shape_of(w, singles, shapes)
    runs = {i: [*[code(w.encode()) for w in t.split()], singles + shapes] for i, t in texts.items()}
    plain = plain_baum_welch([runs[i] for i in texts if i not in (2, 5)], singles + shapes + 1, 2, 3)
    for hot in (4, 100):
        for r in score_texts(docs, F.col("doc_id").isin(2, 5), states=2, rounds=3, singles=singles, shapes=shapes, hot=hot).collect():
            want = plain(runs[r["doc_id"]])
            for w in (w.encode() for w in texts[r["doc_id"]].split()):
                if w not in single:
                    of = [v for v in counts if v not in single and code(v) == code(w)]
                    want += math.log10((counts[w] + 1) / (sum(counts[v] for v in of) + len(of) + 1))
            assert abs(r["score"] - want) < 1e-9


def brute_base(texts):
    learned = [t for i, t in texts if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    counts = {None: len(learned)}
    for t in learned:
        for w in (t or "").encode().lower().split():
            counts[w] = counts.get(w, 0) + 1
    return counts


def test_scores(odd, nothing):
    texts = odd_texts()
    counts = brute_base(texts)
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in texts:
        tokens = [*(t or "").encode().lower().split(), None]
        want.append((str(i), len(tokens), sum(w in counts for w in tokens), round(sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in tokens), 6)))
    # A small table of frequent words sends most of them through the join.
    rows = score_texts(odd, fold(F.col("doc_id"), 7) == 2, singles=8, shapes=4, hot=12, states=2, rounds=2).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in rows) == sorted(want)
    assert {r["train_tokens"] for r in rows} == {n} and all(r["score"] < 0 for r in rows)
    all_hot = score_texts(odd, fold(F.col("doc_id"), 7) == 2, singles=8, shapes=4, states=2, rounds=2).collect()
    assert sorted((str(r["doc_id"]), round(r["score"], 6)) for r in rows) == sorted((str(r["doc_id"]), round(r["score"], 6)) for r in all_hot)
    assert score_texts(nothing, F.lit(False), rounds=1).count() == 0


def test_held_out_texts_are_likelier_than_by_single_words(spark, sf):
    rows = score_texts(table(spark, sf, "documents"), fold(F.col("doc_id"), 7) == 2, singles=256, shapes=64).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_nothing_to_learn_from(odd):
    rows = score_texts(odd, F.lit(True), singles=4, shapes=4, rounds=1).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) and r["n_known"] == 0 for r in rows)
