import re

import numpy as np
import pyarrow as pa
from helpers import docs_of, odd_rows, with_extra

from ordermart.llm import token_counts as tc


def cheapest(word: bytes, pieces: dict[bytes, int]) -> int:
    """Tokens of one pre-token by dynamic programming over its bytes."""
    text, longest = b" " + word, max(map(len, pieces))
    best = [(0, 0)]
    for end in range(1, len(text) + 1):
        best.append(min((best[i][0] + int(round(tc.UNIT * np.log(pieces[text[i:end]] + tc.OFFSET))), best[i][1] + 1)
                        for i in range(max(0, end - longest), end) if text[i:end] in pieces))
    return best[-1][1]


def pieces():
    import base64

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def test_trie_counts_equal_separate_segmentations(spark):
    words = {w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()
             for w in re.split(tc.SPACE, r.text) if w} | {"", "a", "é", "日本語", " ", "x" * 300, "-" * 200, "naïve,"}
    known = pieces()
    listed = sorted(words, reverse=True)
    got = tc.counted(pa.array(listed), tc.Vocabulary(known))
    assert got.tolist() == [cheapest(w.encode(), known) for w in listed]


def test_small_vocabulary_prefers_cheap_then_short():
    known = {bytes([b]): 1000 + b for b in range(256)} | {b" ab": 0, b"abc": 1, b" a": 2, b"bc": 3}
    got = tc.counted(pa.array(["abc", "ab", "abcabc", "q"]), tc.Vocabulary(known))
    assert got.tolist() == [cheapest(w, known) for w in (b"abc", b"ab", b"abcabc", b"q")]


def test_documents(spark):
    known, rows = pieces(), odd_rows()
    got = sorted(((r.doc_id, r.n_words, r.n_tokens) for r in tc.token_counts(with_extra(docs_of(spark, rows))).collect()), key=str)
    memo = {}
    want = []
    for doc, text, *_ in rows:
        words = [w for w in re.split(tc.SPACE, text or "") if w]
        want.append((doc, len(words), sum(memo.setdefault(w, None) or memo.update({w: cheapest(w.encode(), known)}) or memo[w]
                                          for w in words)))
    assert got == sorted(want, key=str)
    assert tc.token_counts(docs_of(spark, [])).count() == 0


def test_texts_without_white_space_take_linear_time():
    """Eight times the bytes in about eight times the time; no blank in megabytes."""
    import time

    known = tc.Vocabulary(pieces())
    r = np.random.default_rng(6)
    seconds = []
    for n in (1 << 17, 1 << 20):
        words = ["".join(map(chr, r.integers(0x4E00, 0x9FFF, n // 3))), "Zm9v" * (n // 8)]
        t = time.perf_counter()
        got = tc.counted(pa.array(words), known)
        seconds.append(time.perf_counter() - t)
        assert (got > n // 40).all()
    assert seconds[1] < 24 * seconds[0]


def test_long_words_equal_brute_force():
    known = pieces()
    words = [w * 40 for w in ("base64/+", "日本語テキスト", "ab", "--=", "Straße", "xyz")] + ["a" * 700, "a" * 699 + "b"]
    assert tc.counted(pa.array(words), tc.Vocabulary(known)).tolist() == [cheapest(w.encode(), known) for w in words]
