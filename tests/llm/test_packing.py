import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from helpers import docs_of, odd_rows, with_extra
from tokenizers import Tokenizer

from ordermart.llm import packing as pk

TEXTS = ["", " ", "a", " a b", "a  b", "a \nb", "don't stop I'll", "a<|endoftext|>b c", "é " * 5, "tail ", "\n\n",
         "日本語 テキスト 123 4", "a\x85 b c", "a\x1c b", "x  y", "tabs\tand\nlines here. And 12,5!"]


def exact():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizers_library(spark):
    texts = TEXTS + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = [e.ids for e in exact().encode_batch(texts, add_special_tokens=False)]
    got = pk.ByteTokenizer().encode(pa.array(texts))
    assert [g.tolist() for g in got] == want


def test_pieces_are_binary():
    for n in (1, 2, 3, 1023, 1024, 1025, 5000):
        pieces = pk.binary_pieces(n, 1024)
        assert sum(pieces) == n and all(p & (p - 1) == 0 and p <= 1024 for p in pieces)
        assert len({p for p in pieces if p < 1024}) == len([p for p in pieces if p < 1024])


def test_round_trip_on_odd_rows(spark):
    rows = [(i, *r[1:]) for i, r in enumerate(odd_rows())] + [(100 + i, t, "en", "s") for i, t in enumerate(TEXTS)]
    out = pk.pack(with_extra(docs_of(spark, rows))).collect()
    assert len({r.sequence_id for r in out}) == len(out) and {r.offset for r in out} == {0}
    tokenizer = exact()
    for doc, text, *_ in rows:
        own = sorted((r for r in out if r.doc_id == doc), key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in own]).tolist()
        assert ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1])
        assert {r.doc_tokens for r in own} == {len(ids)} and all(1 << r.bucket == r.length for r in own)


def test_query_digest_is_crc32_of_the_ids(spark):
    out = pk.op6_packing(spark, "/root/testdata/sf0.001").where("doc_id < 20").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    tokenizer = exact()
    for r in out:
        ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 0][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_null_and_repeated_ids_and_empty_table(spark):
    assert pk.pack(docs_of(spark, [])).count() == 0
    out = pk.pack(docs_of(spark, [(None, "a", "en", "s"), (1, "a", "en", "s"), (1, "a", "en", "s")])).collect()
    assert len(out) == 3 and len({r.sequence_id for r in out}) == 3


def test_buckets_are_stored_apart(spark, tmp_dir):
    pk.write_buckets(pk.pack(docs_of(spark, odd_rows())), f"{tmp_dir}/b")
    assert all(r.length == 1 << r.bucket for r in spark.read.parquet(f"{tmp_dir}/b").collect())
