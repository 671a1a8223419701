import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pactum.llm.components import components
from pactum.llm.ngram_join import _across, bitmap, distinct_documents, ngram_components, overlap_bound
from pactum.llm.shingles import shingle_sets

from .conftest import SCHEMA, odd_texts, prose, rows_of


def shingles(text, size=4):
    w = (text or "").encode().lower().split()
    n = min(size, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def brute(texts, percent=85, size=4):
    sets = [(i, shingles(t, size)) for i, t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((str(i), len(s), str(least.get(find(k)) if s else i)) for k, (i, s) in enumerate(sets)))


def got(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def test_odd_rows_match_brute_force(odd, nothing):
    assert got(ngram_components(odd)) == brute(odd_texts())
    assert ngram_components(nothing).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_copies_match_brute_force(spark, seed):
    rng, texts = random.Random(seed), []
    passage = prose(99, 60)
    for k in range(25):
        words = prose(seed * 100 + k, rng.choice([6, 30, 80, 200])).split()
        texts.append(" ".join(words) + (" " + passage if k % 2 else ""))
        for _ in range(rng.randrange(5)):
            changed = list(words)
            for _ in range(rng.randrange(5)):
                changed[rng.randrange(len(changed))] = rng.choice(["zz", "yy", ""])
            texts.append(" ".join(changed) + (" " + passage if k % 2 else ""))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    result = got(ngram_components(spark.createDataFrame(rows_of(rows), SCHEMA).repartition(4)))
    assert result == brute(rows)
    assert len({c for _, _, c in result}) < len(rows)


def test_variants_that_link_only_through_their_source(spark):
    rng = random.Random(5)
    source = prose(50, 150).split()
    texts = [" ".join(source)]
    for _ in range(60):
        changed = list(source)
        for at in rng.sample(range(10, len(source) - 10), 2):
            changed[at] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(changed))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    result = got(ngram_components(spark.createDataFrame(rows_of(rows), SCHEMA).repartition(4)))
    assert result == brute(rows)


def test_many_variants_below_the_threshold_make_few_pairs(spark):
    """Each of 300 variants links with no other; all share one template, so tiles are large."""
    rng, source = random.Random(9), [f"w{k}" for k in range(170)]
    texts = []
    for k in range(300):
        changed = list(source)
        for at in rng.sample(range(3, 166), 7):
            changed[at] = f"n{rng.randrange(10**7)}"
        texts.append(" ".join(changed))
    texts += [" ".join(source), " ".join([*source[:80], "one", *source[81:]])]
    docs = spark.createDataFrame(rows_of(list(enumerate(texts))), SCHEMA).repartition(4)
    assert got(ngram_components(docs)) == brute(list(enumerate(texts)))
    keyed = [(key, node, len(s), at, node) for node, s in enumerate(sorted(shingles(t), key=lambda x: (not any(w.startswith(b"n") for w in x), x)) for t in texts)
             for at, key in enumerate(hash(x) for x in s)]
    columns = [np.array(c, np.int64) for c in zip(*sorted(keyed), strict=True)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "node", "n", "at", "part"])
    pairs = {(a, b) for found in _across(85)([batch]) for a, b in zip(*(c.to_pylist() for c in found.columns), strict=True)}
    sets = [shingles(t) for t in texts]
    links = {(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert links <= pairs and len(pairs) < 3 * len(texts)


def test_keeps_one_of_each_group(odd):
    kept = distinct_documents(odd)
    assert kept.columns == odd.columns
    least = {i: c for i, _, c in brute(odd_texts())}
    ids = Counter(str(r["doc_id"]) for r in kept.collect())
    assert {i for i in ids if i != "None"} == {i for i, c in least.items() if i == c and i != "None"} and ids["11"] == 2


def test_bits_bound_the_overlap():
    rng = np.random.default_rng(3)
    for _ in range(50):
        pool = rng.integers(0, 1 << 63, 300, np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 250))) for _ in range(2))
        assert overlap_bound(len(a), bitmap(a), len(b), bitmap(b)) >= len(np.intersect1d(a, b))


def test_hashed_sets_have_the_sizes_of_the_sets():
    texts = [t for _, t in odd_texts()]
    assert [len(s) for s, _, _ in shingle_sets(texts, 4)] == [len(shingles(t)) for t in texts]
    by_set = {}
    for t, (s, _, _) in zip(texts, shingle_sets(texts, 4), strict=True):
        assert by_set.setdefault(shingles(t), s.tobytes()) == s.tobytes()
    assert len(set(by_set.values())) == len(by_set)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(2001, 2000), (5, 5)]
    rows = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long").repartition(7), "test").collect()}
    assert rows == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(40)} | {2000: 2000, 2001: 2000}
