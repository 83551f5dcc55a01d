import pytest

from lakelayer.llm import mixing


def fill(totals, weights, budget):
    """Targets by water filling, one drained source at a time."""
    left, out = dict(totals), {}
    while True:
        share = {s: weights[s] * (budget - sum(out.values())) / sum(weights[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 2 * totals[s]]
        if not over:
            return {**out, **share}
        for s in over:
            out[s] = 2.0 * totals[s]
            del left[s]


def test_targets_and_hot_source(spark):
    rows = [(i, "w " * (1 + i % 7), "a" if i % 3 else ("b" if i % 2 else None)) for i in range(3000)]
    rows += [(9000 + i, "x y z", "c") for i in range(5)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    totals = {}
    for r in got:
        totals[r["source"]] = totals.get(r["source"], 0) + r["size"]
    order = sorted((s for s in totals if s is not None)) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    want = fill(totals, weights, 1.5 * sum(totals.values()))
    for s in order:
        own = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == totals[s] and r["target"] == pytest.approx(want[s]) for r in own)
        taken = sum(r["taken"] for r in own)
        assert want[s] - 7 <= taken <= want[s] + 1e-6
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in own)


def test_messy(messy, clash, no_docs):
    a, b = (sorted(tuple(r) for r in mixing.mix(messy).select(*[c.cast("string") for c in map(mixing.F.col, ("doc_id", "size", "target", "taken"))]).fillna("-").collect()) for _ in range(2))
    assert a == b and len(a) == messy.count()
    assert mixing.mix(clash).count() == messy.count()
    out = mixing.mixed_documents(clash)
    assert out.columns == clash.columns and out.count() >= 1
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_mix_is_in_order_of_finish(spark):
    rows = [(i, "w w w", s) for s in "ab" for i in range(100)]
    out = [r["source"] for r in mixing.mixed_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(3, 1), share=1.0).collect()]
    assert 0.7 <= out[:40].count("a") / 40 <= 0.8  # 3 to 1 from the start
