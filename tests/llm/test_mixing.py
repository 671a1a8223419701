from pactum.llm.mixing import mix, mixed_documents

from .conftest import odd_texts


def water_fill(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: share * weight[s] for s in open_}
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_targets_and_taken(odd):
    rows = mix(odd).collect()
    assert len(rows) == len(odd_texts())
    sizes, taken = {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = water_fill(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
    for s, w in want.items():
        assert abs(taken[s] - w) <= max(r["size"] for r in rows if r["source"] == s)
    assert sorted(map(str, rows)) == sorted(map(str, mix(odd.repartition(5)).collect()))
    by_id = {(r["doc_id"], r["size"]) for r in rows}
    assert (1, 0) in by_id and (2, 0) in by_id and (5, 2) in by_id


def test_larger_budget_only_adds(odd):
    small = {r["place"]: r["times"] for r in mix(odd, budget_share=0.3).collect()}
    large = {r["place"]: r["times"] for r in mix(odd, budget_share=0.6).collect()}
    assert all(large[p] >= n for p, n in small.items()) and sum(large.values()) > sum(small.values())


def test_filter_keeps_columns_and_rows(odd, nothing):
    kept = mixed_documents(odd)
    assert kept.columns == odd.columns
    want = sorted(str(r["doc_id"]) for r in mix(odd).filter("times > 0").collect())
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    assert mix(nothing).count() == 0 and mixed_documents(nothing).count() == 0
