from collections import Counter

import corpus_pipeline
from pactum.llm.common import table
from pactum.llm.mixing import mix
from pactum.plans.session import materialize

from .test_decontamination import brute as contaminated
from .test_ngram_join import brute as groups
from .test_sharding import check


def test_stages_against_plain_python(spark, sf):
    docs = table(spark, sf, "documents")
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    before, columns = [(r["doc_id"], r["text"]) for r in docs.collect()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, materialize(stage(spark, docs, sf), "test-pipeline")
        after = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name == "language_id":
            want = [(i, t) for i, t in before if any(c.isalpha() for c in t or "")]
        elif name == "ngram_join":
            least = {i: c for i, _, c in groups(before, percent=80, size=5)}
            want = [(i, t) for i, t in before if least[str(i)] == str(i)]
        elif name == "decontamination":
            want = [(i, t) for i, t in before if not contaminated(t, items)[4]]
        elif name == "mixing":
            times = {r["doc_id"]: r["times"] for r in mix(given).collect()}
            want = [(i, t) for i, t in before for _ in range(times[i])]
        else:
            want = before
        assert Counter(after) == Counter(want), name
        assert docs.columns == columns + ["shard", "slot"] * (name == "sharding")
        assert after
        before = after
    check([r.asDict() | {"text_crc32": r["text"]} for r in docs.collect()], corpus_pipeline.SHARDS)


def test_run_is_registered(spark, sf):
    from pactum.llm.queries import QUERIES

    assert QUERIES["pipeline"][0] is corpus_pipeline.run and 4 <= len(corpus_pipeline.STAGES) <= 5
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
