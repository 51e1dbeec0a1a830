import re

import pytest
from helpers import collect, docs_of, odd_rows, with_extra

from ordermart.llm import mixing as mx


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def fill(sizes, weights, share, epochs):
    """Water-filling by hand: sources -> targets."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    held = set()
    while True:
        rest = share * sum(sizes.values()) - sum(epochs * sizes[s] for s in held)
        total = sum(w[s] for s in names if s not in held)
        target = {s: epochs * sizes[s] if s in held else rest * w[s] / total for s in names}
        over = {s for s in names if s not in held and target[s] > epochs * sizes[s]}
        if not over:
            return target
        held |= over
        if len(held) == len(names):
            return {s: epochs * sizes[s] for s in names}


def many(n, seed=1):
    import random

    r = random.Random(seed)
    return [(i, " ".join("w" for _ in range(r.randrange(0, 60))), "en",
             r.choice(["src0"] * 6 + ["src1", "src10", "src2", "Z", "é", None])) for i in range(n)]


@pytest.mark.parametrize("rows", [many(600), odd_rows()])
def test_targets_and_taken(spark, rows):
    found = [r["__mix"].asDict() | {"source": r["source"], "doc_id": r["doc_id"]}
             for r in collect(mx.mix(with_extra(docs_of(spark, rows))))]
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    want = fill(sizes, mx.WEIGHTS, 1.5, 2.0)
    assert len(found) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["size"] * r["repeats"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    if len(rows) > 100:
        for s, n in taken.items():
            assert abs(n - want[s]) <= 30  # half of the largest document
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_reruns_agree_and_seeds_differ(spark):
    docs = docs_of(spark, many(300))

    def reps(df):
        return sorted((r["doc_id"], r["__mix"]["repeats"]) for r in df.collect())

    assert reps(mx.mix(docs)) == reps(mx.mix(docs.repartition(5)))
    assert reps(mx.mix(docs)) != reps(mx.mix(docs, seed=1))


def test_mixed_repeats_rows_and_keeps_columns(spark):
    docs = docs_of(spark, many(200))
    out = mx.mixed(docs)
    assert out.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {r["doc_id"]: r["__mix"]["repeats"] for r in mx.mix(docs).collect() if r["__mix"]["repeats"]}


def test_one_source_one_document_and_empty(spark):
    assert mx.mix(docs_of(spark, [])).count() == 0
    row = mx.mix(docs_of(spark, [(1, "a b c d", "en", "s")])).first()["__mix"]
    assert (row["target"], row["taken"]) == (6.0, 4)
    nothing = mx.mix(docs_of(spark, [(1, None, None, None), (2, "", "en", "s")])).collect()
    assert [r["__mix"]["taken"] for r in nothing] == [0, 0]
