"""Hidden Markov language model: Baum-Welch counts summed over partitions, exact scaled forward scores."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm.common import fold, repeat_copies, table
from pactum.llm.terms import count_terms, frequent, is_marker, rare_array, with_marker, words_lower
from pactum.plans.session import materialize

STATES = 8
#: States emit symbols: the `SINGLES` most frequent words are symbols of their own, all other words share
#: `SHAPES` by length and ending, and one symbol ends a text. Given a shared symbol, a word has its add-one share.
SINGLES, SHAPES = 4096, 512
HOT = 200_000
ROUNDS = 4
#: Training keeps the forward messages of this many steps at a time; a worker's arrays hold about GROUP symbols of them.
STEPS = 1024
GROUP = 200_000
SMOOTH = 0.05


@dataclass
class Markov:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols x states


def shape_of(word: bytes, singles: int = SINGLES, shapes: int = SHAPES) -> int:
    return singles + zlib.crc32(word[-3:] + bytes([min(len(word), 15) // 3])) % shapes


def groups(runs: list[np.ndarray], most: int = GROUP, steps: int = STEPS) -> Iterator[list[int]]:
    """Numbers of runs of like length, longest first: at most `most` symbols of `steps` together, and 20 times as many in all."""
    order = sorted(range(len(runs)), key=lambda i: -len(runs[i]))
    at = 0
    while at < len(order):
        longest = max(1, len(runs[order[at]]))
        width = max(1, min(most // min(longest, steps), 20 * most // longest))
        yield order[at:at + width]
        at += width


def padded(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(time, run) symbols and, for each time, how many runs are that long; runs come longest first."""
    lengths = np.array([len(r) for r in runs])
    grid = np.zeros((lengths[0], len(runs)), np.uint16)
    for i, r in enumerate(runs):
        grid[:len(r), i] = r
    return grid, np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")


def forward(model: Markov, runs: list[np.ndarray]) -> np.ndarray:
    """Natural log likelihood of each whole run by the scaled forward recursion."""
    out = np.zeros(len(runs))
    for group in groups(runs):
        grid, active = padded([runs[i] for i in group])
        total = np.zeros(len(group))
        alpha = model.start * model.emit[grid[0]]
        for t in range(len(grid)):
            n = active[t]
            if t:
                alpha = (alpha[:n] @ model.move) * model.emit[grid[t, :n]]
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            total[:n] += np.log(scale)
        out[group] = total
    return out


def expected_counts(model: Markov, runs: list[np.ndarray], emit: np.ndarray, move: np.ndarray, start: np.ndarray, block: int = STEPS) -> None:
    """Add the forward-backward counts of whole runs to emit, move and start.

    The forward messages are kept at the borders of blocks of steps only and computed again block by block on the
    way back, so no run is cut and a long one needs no more memory than a block and its borders.
    """
    states = len(start)
    for group in groups(runs):
        grid, active = padded([runs[i] for i in group])
        steps, width = grid.shape

        def onward(begin: int, end: int, a: np.ndarray | None, grid=grid, active=active, width=width) -> tuple[np.ndarray, np.ndarray]:
            """Scaled forward messages and scales of the steps, from the message before them."""
            alpha, scales = np.zeros((end - begin, width, states)), np.ones((end - begin, width, 1))
            for t in range(begin, end):
                n = active[t]
                a = (a[:n] @ model.move if t else model.start) * model.emit[grid[t, :n]]
                scales[t - begin, :n] = a.sum(1, keepdims=True)
                a = a / scales[t - begin, :n]
                alpha[t - begin, :n] = a
            return alpha, scales

        begins = range(0, steps, block)
        borders: list[np.ndarray | None] = [None]
        for begin in begins[:-1]:
            borders.append(onward(begin, begin + block, borders[-1])[0][-1].copy())
        beta = np.ones((width, states))
        for begin, before in zip(reversed(begins), reversed(borders), strict=True):
            end = min(begin + block, steps)
            alpha, scales = onward(begin, end, before)
            for t in reversed(range(begin, end)):
                n, at = active[t], t - begin
                if t:
                    ahead = model.emit[grid[t, :n]] * beta[:n] / scales[at, :n]
                    move += model.move * ((alpha[at - 1] if at else before)[:n].T @ ahead)
                alpha[at, :n] *= beta[:n]  # from here on the posterior of the state at t
                if t:
                    beta[:n] = ahead @ model.move.T
            if begin == 0:
                start += alpha[0].sum(0)
            there = np.arange(width)[None, :] < active[begin:end, None]
            symbols, weights = grid[begin:end][there], alpha[there]
            for k in range(states):
                emit[:, k] += np.bincount(symbols, weights[:, k], len(emit))


def train(encoded: DataFrame, symbols: int, states: int = STATES, rounds: int = ROUNDS, seed: int = 7) -> Markov:
    """Baum-Welch over all rows of `encoded` (codes), whole texts: each round adds up the workers' expected counts.

    What a round brings to the driver is one row per symbol and state: a fixed number, whatever the corpus.
    """
    rng = np.random.default_rng(seed)
    move = np.full((states, states), 0.1 / max(1, states - 1)) if states > 1 else np.ones((1, 1))
    if states > 1:
        np.fill_diagonal(move, 0.9)
    emit = rng.uniform(0.2, 1.8, (symbols, states))
    model = Markov(np.full(states, 1 / states), move, emit / emit.sum(0))
    session = encoded.sparkSession.sparkContext
    names = [f"s{k}" for k in range(states)]
    for _ in range(rounds):
        shared = session.broadcast(model)

        def count(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            emits, moves, starts = np.zeros((symbols, states)), np.zeros((states, states)), np.zeros(states)
            for batch in batches:
                expected_counts(shared.value, [np.frombuffer(c, np.uint16) for c in batch.column(0).to_pylist()], emits, moves, starts)
            rows = np.vstack([emits, moves, starts[None, :]])
            used = np.flatnonzero(rows.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *[pa.array(rows[used, k]) for k in range(states)]], ["at", *names])

        sums = (encoded.select("codes").mapInArrow(count, "at int, " + ", ".join(f"{n} double" for n in names))
                .groupBy("at").agg(*[F.sum(n).alias(n) for n in names]).collect())
        rows = np.zeros((symbols + states + 1, states))
        for r in sums:
            rows[r["at"]] = [r[n] for n in names]
        model = maximized(rows[:symbols], rows[symbols:symbols + states], rows[-1])
        shared.unpersist()
    return model


def maximized(emit: np.ndarray, move: np.ndarray, start: np.ndarray) -> Markov:
    """Parameters from expected counts. A little of the whole corpus in every state keeps all symbols possible."""
    whole = (emit.sum(1) + 0.5) / (emit.sum() + 0.5 * len(emit))
    emit = (1 - SMOOTH) * (emit + 1e-9) / (emit + 1e-9).sum(0) + SMOOTH * whole[:, None]
    return Markov((start + 0.1) / (start + 0.1).sum(), (move + 0.1) / (move + 0.1).sum(1, keepdims=True), emit / emit.sum(0))


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
                rounds: int = ROUNDS, singles: int = SINGLES, shapes: int = SHAPES, hot: int = HOT) -> DataFrame:
    """One row per document: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from all whole texts that are not held out. Tokens are the lowered words and one end.
    score is log10 of the text's probability: the forward recursion over its symbols, exact for any length,
    plus the add-one share of each word in its symbol. base_score is the add-one unigram. Both need the count of
    every word: the `hot` most frequent are looked up where documents are read, rarer words are joined to the
    counts, so no key of the join is hot. Null text is empty; rows equal in id and text are scored alike; an
    empty table gives no rows, and with nothing to learn from all symbols are equally likely; other columns
    are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), held_out.alias("held_out"), text.alias("text"))
    learned = texts.filter(~F.col("held_out"))
    counts = materialize(count_terms(learned, "text", words_lower), "lm-counts")
    ends = learned.count()
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = (totals["n"] or 0) + ends, totals["v"] + (ends > 0)
    found = frequent(counts, hot)
    top = list(zip(found["term"].to_pylist(), found["n"].to_pylist(), strict=True))
    single = {w: i for i, (w, _) in enumerate(top[:singles])}
    symbols, end = singles + shapes + 1, singles + shapes

    def by_shape(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(shapes, np.int64), np.zeros(shapes, np.int64)
        for batch in batches:
            for word, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if word not in single:
                    at = shape_of(word, singles, shapes) - singles
                    n[at] += k
                    v[at] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(shapes), pa.int32()), pa.array(n), pa.array(v)], ["at", "n", "v"])

    shape_log = np.zeros(shapes)  # log10 of the words and kinds of each shared symbol
    for r in counts.mapInArrow(by_shape, "at int, n bigint, v bigint").groupBy("at").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        shape_log[r["at"]] = math.log10(r["n"] + r["v"] + 1)
    base_log = math.log10(n_all + v_all + 1)
    hot_at = {w: i for i, (w, _) in enumerate(top)}
    hot_base = np.array([math.log10(n + 1) - base_log for _, n in top])
    hot_code = np.array([i if i < singles else shape_of(w, singles, shapes) for i, (w, _) in enumerate(top)], np.uint16)
    hot_inner = np.array([0.0 if i < singles else math.log10(n + 1) - shape_log[hot_code[i] - singles] for i, (_, n) in enumerate(top)])
    shared = spark.sparkContext.broadcast((hot_at, hot_base, hot_code, hot_inner, shape_log))
    end_base = math.log10((ends + 1)) - base_log

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_of, base, code, inner, logs = shared.value
        for batch in batches:
            codes, tokens, known, bases, inners, rest = [], [], [], [], [], []
            for value in batch.column(3):
                words = words_lower(value.as_py())
                at = np.array([at_of.get(w, -1) for w in words], np.int64)
                seen = at >= 0
                hit = at[seen]
                line = np.empty(len(words) + 1, np.uint16)
                line[:-1][seen] = code[hit]
                line[-1] = end
                rare = Counter(words[i] for i in np.flatnonzero(~seen))
                of = {w: shape_of(w, singles, shapes) for w in rare}
                line[:-1][~seen] = [of[words[i]] for i in np.flatnonzero(~seen)]
                missing = sum(rare.values())
                codes.append(line.tobytes())
                tokens.append(len(words) + 1)
                known.append(len(hit) + (ends > 0))
                bases.append(base[hit].sum() + end_base - missing * base_log)
                inners.append(inner[hit].sum() - sum(tf * logs[of[w] - singles] for w, tf in rare.items()))
                rest.append(rare)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(codes, pa.binary()), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(bases, pa.float64()), pa.array(inners, pa.float64()), rare_array(rest)],
                ["id", "th", "held_out", "codes", "n_tokens", "known", "base", "inner", "rare"])

    id_type = texts.schema["id"].dataType.simpleString()
    fixed = f"id {id_type}, th bigint, held_out boolean"
    encoded = materialize(texts.mapInArrow(encode, fixed + ", codes binary, n_tokens bigint, known bigint, base double, inner double, "
                                           "rare array<struct<term:binary,tf:int>>"), "lm-codes")
    model = spark.sparkContext.broadcast(train(encoded.filter(~F.col("held_out")), symbols, states, rounds))

    def recurse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = forward(model.value, [np.frombuffer(c, np.uint16) for c in batch.column(3).to_pylist()]) / math.log(10)
            columns = [batch.column(i) for i in (0, 1, 2, 4, 5, 6)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(logs + batch.column(7).to_numpy()), batch.column(8)],
                                             ["id", "th", "held_out", "n_tokens", "known", "base", "chain", "rare"])

    scored = encoded.mapInArrow(recurse, fixed + ", n_tokens bigint, known bigint, base double, chain double, rare array<struct<term:binary,tf:int>>")
    joined = with_marker(scored, ["id", "th"], "rare").join(counts, "term", "left")
    there = F.coalesce(F.col("n"), F.lit(0))
    summed = joined.groupBy("id", "th", "held_out").agg(
        F.count(F.when(is_marker(), 1)).alias("copies"), F.max("n_tokens").alias("n_tokens"), F.max("known").alias("known"),
        F.max("base").alias("base"), F.max("chain").alias("chain"),
        F.sum(F.when(there > 0, F.col("tf")).otherwise(0)).alias("rare_known"), F.sum(F.col("tf") * F.log10(there + 1)).alias("rare_log"))
    share = F.col("rare_log") / F.col("copies")
    return repeat_copies(summed.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.floor(F.col("rare_known") / F.col("copies"))).cast("bigint").alias("n_known"),
        F.lit(n_all).cast("bigint").alias("train_tokens"), (F.col("base") + share).alias("base_score"), (F.col("chain") + share).alias("score"), "copies"), "copies")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) == 2)
