import hashlib
import random

import pytest
import xxhash
from helpers import docs_of, odd_rows, with_extra

from ordermart.llm import winnowing as wn


def slow(text, k, w):
    """Kept (hash, position) pairs by the definition, one code point at a time."""
    codes, mask = [ord(c) + 1 for c in text], (1 << 64) - 1
    if not codes:
        return [], []
    k, hashes = min(k, len(codes)), []
    for i in range(len(codes) - k + 1):
        h = 0
        for c in codes[i:i + k]:
            h = (h * wn.BASE + c) & mask
        for m in (wn.MIX1, wn.MIX2):
            h = (h ^ h >> 33) * int(m) & mask
        hashes.append((h ^ h >> 33) >> 32)
    w, kept = min(w, len(hashes)), []
    for i in range(len(hashes) - w + 1):
        low = min(hashes[i:i + w])
        at = max(j for j in range(i, i + w) if hashes[j] == low)
        if not kept or kept[-1] != at:
            kept.append(at)
    return [hashes[i] for i in kept], kept


@pytest.mark.parametrize("k,w", [(16, 64), (5, 4), (1, 1), (7, 3)])
def test_winnow_by_definition(k, w):
    r = random.Random(1)
    for n in (0, 1, 15, 16, 17, 79, 80, 81, 300):
        for letters in ("ab", "aaaaaaab", "abcdefé日"):
            text = "".join(r.choice(letters) for _ in range(n))
            hashes, positions = wn.winnow(text, k, w)
            assert (hashes.tolist(), positions.tolist()) == slow(text, k, w)


def test_match_guarantee():
    r = random.Random(2)
    for _ in range(50):
        def noise(n):
            return "".join(r.choice("abcdefgh ") for _ in range(n))
        shared = noise(wn.K + wn.WINDOW - 1)
        a, b = noise(200) + shared + noise(90), noise(55) + shared + noise(300)
        assert set(wn.winnow(a)[0].tolist()) & set(wn.winnow(b)[0].tolist())


def test_short_documents_are_nearer_to_their_edited_text():
    r = random.Random(3)

    def noise(n):
        return "".join(r.choice("abcdefghijklmnopqrst ") for _ in range(n))

    for n in range(30, 120):
        text, following = noise(n), noise(n)
        own, other, after = (set(wn.winnow(t)[0].tolist()) for t in (text, wn.edited(text, following), following))
        assert len(own & other) / len(own | other) > len(own & after) / len(own | after)


def brute(rows):
    def hashed(text):
        h = xxhash.xxh64_intdigest((text or "").encode(), 42)
        return h - (1 << 64) if h >> 63 else h

    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashed(r[1])))
    out = []
    for i, (doc, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        m = len(text) // 3
        changed = text[:len(text) - m] + after[:m]
        a, b, c = (wn.winnow(t)[0] for t in (text, changed, after))
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), wn.digest(a), wn.digest(b),
                    wn.likeness(a, b), wn.likeness(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [1, 3, None])
def test_compare_next_is_brute_force(spark, blocks):
    got = sorted((tuple(r) for r in wn.compare_next(with_extra(docs_of(spark, odd_rows())), blocks).collect()), key=str)
    assert got == brute(odd_rows())


def test_query_is_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = sorted((tuple(r) for r in wn.op9_winnowing(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("hot", [7, None])
def test_a_hot_doc_id_is_many_blocks(spark, hot):
    r = random.Random(5)
    rows = [(hot if i % 3 else i, " ".join(r.choice(["ab", "cd", "ef"]) for _ in range(r.randrange(30))), "en", "s") for i in range(300)]
    rows += [(1 << 62, "x", "en", "s"), (-(1 << 63), "y", "en", "s"), ((1 << 63) - 1, "z", "en", "s")]
    docs = docs_of(spark, rows)
    got = sorted((tuple(x) for x in wn.compare_next(docs, 12).collect()), key=str)
    assert got == brute(rows)


def test_single_and_empty(spark):
    assert wn.compare_next(docs_of(spark, [])).count() == 0
    row = wn.compare_next(docs_of(spark, [(5, "a text of its own", "en", "s")])).first()
    assert (row.near_next, row.n_chars) == (1.0, 17)


def test_fingerprint_has_positions(spark):
    for r in wn.fingerprint(docs_of(spark, odd_rows())).collect():
        assert len(r.hashes) == len(r.positions) and r.positions == sorted(r.positions)
