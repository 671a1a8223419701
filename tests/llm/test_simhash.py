import random

import pytest
import xxhash

from pactum.llm.simhash import fingerprint, fingerprint_links, simhash_components
from pactum.llm.terms import BLOCK

from .conftest import SCHEMA, odd_texts, prose, rows_of


def plain(text):
    w = (text or "").encode().lower().split()
    runs = [w[i:i + 3] for i in range(len(w) - 2)] or ([w] if w else [])
    hashes = [xxhash.xxh64(b" ".join(r), seed=42).intdigest() for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    prints = [plain(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    others = {p: sum(0 < (p ^ q).bit_count() <= radius for q in set(prints)) for p in set(prints)}
    return sorted((str(i), f"{prints[k]:016x}", str(least.get(find(k))), others[prints[k]]) for k, (i, _) in enumerate(rows))


def got(df):
    return sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"]), r["n_links"]) for r in df.collect())


def test_odd_rows_match_brute_force(odd, nothing):
    result = simhash_components(odd)
    assert result.columns == ["doc_id", "fingerprint", "component_id", "n_links"]
    assert got(result) == brute(odd_texts())
    assert simhash_components(nothing).count() == 0


def test_copies_edited_slightly_match_brute_force(spark):
    rng, texts = random.Random(4), []
    for k in range(12):
        words = prose(400 + k, 900).split()
        for _ in range(12):
            changed = list(words)
            for _ in range(rng.randrange(6)):
                changed[rng.randrange(len(changed))] = f"n{rng.randrange(99)}"
            texts.append(" ".join(changed))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    result = got(simhash_components(spark.createDataFrame(rows_of(rows), SCHEMA).repartition(4)))
    assert result == brute(rows)
    assert max(n for *_, n in result) > 1 and 12 <= len({c for _, _, c, _ in result}) < 100


@pytest.mark.parametrize("radius", [2, 4])
def test_balls_connect_what_is_within_the_radius(spark, radius):
    rng = random.Random(radius)
    prints = {0, -1, 1 << 62}
    for _ in range(10):
        p = rng.getrandbits(64)
        for _ in range(15):
            q = p
            for bit in rng.sample(range(64), rng.randrange(5)):
                q ^= 1 << bit
            prints.add(q - (1 << 64) if q >> 63 else q)
    links, counts = fingerprint_links(spark.createDataFrame([(p,) for p in prints], "fp long"), radius)
    pairs = {(r["a"], r["b"]) for r in links.collect()}
    apart = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    assert all(apart(a, b) <= radius for a, b in pairs)
    reach = {p: {p} for p in prints}
    for a, b in pairs:
        if reach[a] is not reach[b]:
            reach[a] |= reach[b]
            for x in reach[b]:
                reach[x] = reach[a]
    assert all(b in reach[a] for a in prints for b in prints if apart(a, b) <= radius)
    if radius == 2:
        n = {r["fp"]: r["n_links"] for r in counts.collect()}
        assert {p: n.get(p, 0) for p in prints} == {p: sum(0 < apart(p, q) <= 2 for q in prints) for p in prints}


def test_long_texts_are_read_whole():
    text = prose(77, 20_000)
    text += "\t" + "x" * (BLOCK + 5) + "\n" + prose(78, 180_000)
    assert len(text) > 2 * BLOCK and fingerprint(text) == plain(text)
    assert fingerprint("One") == plain("one") and fingerprint(" ") == 0 and fingerprint(None) == 0


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        fingerprint_links(spark.createDataFrame([], "fp long"), 3)
