import random

import numpy as np
from pyspark.sql import functions as F

from pactum.llm.common import fold, table
from pactum.llm.language import fit as fit_language
from pactum.llm.language import identify_languages, kernel, predict, presence, with_known_language
from pactum.llm.quality import FEATURES, LEAST, RIDGE, fit, quality_scores, statistics

from .conftest import odd_texts


def test_languages_held_out(spark, sf):
    docs = table(spark, sf, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    rows = identify_languages(docs, ~held_out).join(docs.select("doc_id", "lang", held_out.alias("h")), "doc_id").filter("h").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows) and all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_rows(odd, nothing):
    rows = identify_languages(odd, F.lit(True)).collect()
    assert len(rows) == len(odd_texts())
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1, 2, 3, 12)) and by_id[6]["lang_pred"] in ("en", "fr")
    assert by_id[6]["lang_pred"] == by_id[7]["lang_pred"]
    assert identify_languages(nothing, F.lit(True)).count() == 0
    assert {r["lang_pred"] for r in identify_languages(odd, F.lit(False)).collect()} == {"und"}
    kept = with_known_language(odd, F.lit(True))
    assert kept.columns == odd.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in odd_texts())


def test_folded_weights_equal_the_kernel_form():
    texts = ["the cat sat on the mat", "the dog ran", "der hund lief", "die katze sass auf der matte", "the bird", "der vogel"]
    x = np.stack([presence(t) for t in texts]).astype(float)
    model = fit_language(x, ["en", "en", "de", "de", "en", "de"])
    margins = x @ model.weights / np.sqrt(x.sum(1))[:, None]
    assert [model.languages[k] for k in margins.argmax(1)] == ["en", "en", "de", "de", "en", "de"]
    k = kernel(x, x)
    assert np.allclose(np.diag(k), 1) and np.allclose(k[0, 1], (x[0] * x[1]).sum() / np.sqrt(x[0].sum() * x[1].sum()))


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held_out = fold(F.col("doc_id"), 4) == 2
    rows = quality_scores(docs, labels, ~held_out).join(labels, "doc_id").join(docs.select("doc_id", held_out.alias("h")), "doc_id").filter("h").collect()
    good, bad = [r["score"] for r in rows if r["quality"] == 1], [r["score"] for r in rows if r["quality"] == 0]
    assert sum(g > b for g in good for b in bad) >= 0.9 * len(good) * len(bad)


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(6, 1, 0), (10, 0, 0), (4, None, 1), (None, 1, 1), (6, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality_scores(odd, labels, F.lit(True)).collect()
    assert len(rows) == len(odd_texts()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert {r["score"] for r in quality_scores(odd, labels, F.lit(False)).collect()} == {0.5}
    assert quality_scores(nothing, labels, F.lit(True)).count() == 0


def test_trees_split_and_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 1] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    forest = fit(x, y, trees=30)
    assert ((forest.scores(x) > 0.5) == y).mean() > 0.97
    # Walking one row by hand gives the vectorised margin.
    for row in x[:20]:
        total = forest.base
        for feature, limit, leaf in zip(forest.feature, forest.limit, forest.leaf, strict=True):
            at = 0
            while at < len(feature):
                at = 2 * at + 1 + int(row[feature[at]] > limit[at])
            total += leaf[at - len(feature)]
        assert abs(total - forest.margins(row[None, :])[0]) < 1e-9
    assert len(statistics(None)) == len(FEATURES) == len(statistics("a | B\nc" * 1000)) and statistics(None) == statistics("")


def _spoken(language, seed, words):
    """A text over an alphabet of the language's own three syllables."""
    own = random.Random(f"language {language}")
    syllables = ["".join(own.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(3)]
    rng = random.Random(seed)
    return " ".join(rng.choice(syllables) + rng.choice(syllables) for _ in range(words))


def test_every_language_has_a_landmark():
    names = [f"l{i:03}" for i in range(300)]
    learned = [(_spoken(n, f"{n} {k}", 40), n) for n in names for k in range(2)]
    model = fit_language(np.stack([presence(t) for t, _ in learned]), [n for _, n in learned])
    assert model.languages == names
    found, _ = predict(model, [_spoken(n, f"{n} new", 40) for n in names])
    assert found == names


def test_fit_equals_plain_kernel_ridge_regression():
    names = [f"l{i}" for i in range(3)]
    labels = [n for i, n in enumerate(names) for _ in range(10 + 5 * i)]
    x = np.stack([presence(_spoken(n, f"{n} {k}", 12)) for k, n in enumerate(labels)])
    model = fit_language(x, labels, landmarks=len(x), ridge=0.5)
    gram = kernel(x.astype(float), x.astype(float))
    counts = np.array([labels.count(n) for n in labels])
    targets = np.where(np.array(labels)[:, None] == np.array(names), 1.0, -1.0)
    new = np.stack([presence(_spoken(names[k % 3], f"other {k}", 12)) for k in range(20)]).astype(float)
    want = kernel(new, x.astype(float)) @ np.linalg.solve(gram + 0.5 / len(x) * np.diag(counts), targets)
    got = (new @ model.weights) / np.sqrt(new.sum(1))[:, None]
    assert np.abs(got - want).max() < 0.01


def plain_boosting(x, y, trees, depth, bins, rate):
    """Margins of the training rows, every split sought over all cuts by sums over the rows themselves."""
    mean = (y.sum() + 1) / (len(y) + 2)
    margin = np.full(len(y), np.log(mean / (1 - mean)))
    cuts = [sorted({sorted(column)[int(q * (len(y) - 1))] for q in np.linspace(0, 1, bins + 1)[1:-1]}) for column in x.T]
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = p - y, p * (1 - p)
        nodes = [np.arange(len(y))]
        for _ in range(depth):
            halves = []
            for rows in nodes:
                best, side = 1e-6, np.ones(len(rows), bool)
                for f, column in enumerate(cuts):
                    for cut in column:
                        left = x[rows, f] <= cut
                        g, h = gradient[rows][left].sum(), curve[rows][left].sum()
                        all_g, all_h = gradient[rows].sum(), curve[rows].sum()
                        if min(h, all_h - h) < LEAST / 4:
                            continue
                        gain = g**2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g**2 / (all_h + RIDGE)
                        if gain > best + 1e-12:
                            best, side = gain, left
                halves += [rows[side], rows[~side]]
            nodes = halves
        for rows in nodes:
            margin[rows] -= rate * gradient[rows].sum() / (curve[rows].sum() + RIDGE)
    return margin


def test_fit_equals_plain_boosting():
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(240, 3)), 1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] > 0.5) | (rng.random(240) < 0.1)).astype(float)
    forest = fit(x, y, trees=6, depth=3, bins=8, rate=0.3)
    assert np.abs(forest.margins(x) - plain_boosting(x, y, 6, 3, 8, 0.3)).max() < 1e-9
    assert len(np.unique(forest.margins(x))) > 8
