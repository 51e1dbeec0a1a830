import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from helpers import LONG, docs_of, odd_rows, with_extra
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermart.llm import periodic_runs as pr


def brute(words):
    """Runs by comparing each word with the one q before it, for every q."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        start = None
        for i in range(len(words) - q + 1):
            if i < len(words) - q and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                if (size := i - start + q) >= max(24, 3 * q):
                    found.setdefault((start, size), q)
                start = None
    return sorted((s, size, q) for (s, size), q in found.items())


def runs(docs):
    lengths = np.array([len(d) for d in docs], np.int64)
    names = {}
    codes = np.array([names.setdefault(w, len(names)) for d in docs for w in d], np.int64)
    doc, start, size, period = pr.runs_of(codes, np.cumsum(lengths) - lengths, lengths)
    return [sorted((s, n, q) for d, s, n, q in zip(doc.tolist(), start.tolist(), size.tolist(), period.tolist(), strict=True) if d == k)
            for k in range(len(docs))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 30)), max_size=4), min_size=1, max_size=5))
def test_runs_equal_brute_force(plan):
    docs = [[w for block, times in doc for w in block * times] for doc in plan]
    assert runs(docs) == [brute(d) for d in docs]


def test_nested_and_long_runs():
    rng = random.Random(3)
    inner = ["a"] * 30 + ["b"]
    nested = (inner * 4 + ["c", "d"]) * 5
    noise = [str(rng.randrange(50)) for _ in range(3000)]
    long = noise + noise[:700] * 4 + noise
    docs = [nested, ["x"] * 5000, noise, long, [], ["y"], ["z"] * 23, ["z"] * 24]
    assert runs(docs) == [brute(d) for d in docs]


def test_extensions_of_the_grammar():
    rng = np.random.default_rng(4)
    for words in (rng.integers(0, 2, 400), np.repeat(rng.integers(0, 3, 40), rng.integers(1, 20, 40)), np.zeros(300, np.int64)):
        n = len(words)
        seq = np.concatenate([[10], words, [11]])
        lone = np.zeros(n + 2, bool)
        lone[[0, -1]] = True
        g = pr.Grammar(seq, lone)
        assert g.length[-1] <= n + 2 and (g.parent >= -1).all()
        i, j = (np.sort(rng.integers(1, n + 1, (2, 300)), axis=0))
        keep = i < j
        i, j = i[keep], j[keep]
        for forward in (True, False):
            sign = 1 if forward else -1
            for a, b, got in zip(i, j, g.extension(i, j, forward), strict=True):
                k = 0
                while seq[a + sign * k] == seq[b + sign * k]:
                    k += 1
                assert got == k


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    drop = {i for s, size, q in found for i in range(s + q, s + size)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{size},{q}\n" for s, size, q in found).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in drop)))


def result(spark, docs, monkeypatch):
    class Session:
        read = type("R", (), {"parquet": staticmethod(lambda path: docs)})

    return sorted((tuple(r) for r in pr.op11_periodic_runs(Session(), "x").collect()), key=repr)


def test_query_equals_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(k, " ".join(str(rng.randrange(4)) for _ in range(rng.randrange(120))), "en", "s") for k in range(150)]
    rows += [(200 + k, " a b\x85 " + "p q\tr\n" * 9 * k + " end", "en", "s") for k in range(4)]
    rows += [r for r in odd_rows() if r[1] != LONG]
    docs = with_extra(docs_of(spark, rows)).repartition(3)
    assert result(spark, docs, monkeypatch) == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    assert result(spark, docs.limit(0), monkeypatch) == []


def test_very_long_texts(spark, monkeypatch):
    rows = [(1, LONG, None, None), (2, "w " * 400_000, None, None)]
    got = {r.doc_id: r for r in pr.periodic_runs(docs_of(spark, rows)).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 30000, 1)] and got[1].collapsed == "word " + "x" * 5000 + " end"
    assert [tuple(r) for r in got[2].runs] == [(0, 400_000, 1)] and got[2].collapsed == "w"


def test_slices_do_not_change_the_result():
    texts = ["a b c " * 20, "", "x " * 50, "one two", "a b c " * 20]
    whole = pr._solve([], pa.array(texts), False, 24, 3)
    each = [pr._solve([], pa.array([t]), False, 24, 3) for t in texts]
    assert whole["collapsed"].to_pylist() == [e["collapsed"].to_pylist()[0] for e in each]
    assert whole["period"].tolist() == [p for e in each for p in e["period"].tolist()] == [3, 1, 3]


def test_limits_are_stated(spark):
    with pytest.raises(ValueError):
        pr.periodic_runs(docs_of(spark, []), least=20)


def test_whole_table_equals_brute_force(spark):
    from ordermart.llm.queries import QUERIES

    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/documents.parquet").collect()
    short = [r for r in rows if len(r.text.split()) < 700]
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, path).collect()}
    assert len(got) == len(rows) and len(short) > 100
    for r in short:
        assert got[r.doc_id] == expected(r.doc_id, r.text)
