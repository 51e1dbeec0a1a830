"""Packing by power-of-two decomposition.

Every document (its token ids and one end id) is cut into pieces whose
lengths are powers of two: as many pieces of ``max_length`` as fit, then the
binary digits of the rest from large to small. A piece is a sequence of its
own, so no sequence crosses documents and none needs padding; sequences of
equal length share a ``bucket`` (log2 of the length), from which a trainer
draws batches of one shape.

The work is one map over the documents: no shuffle, no group, no state.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded_words, lean, pieces_of, ragged

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, bucket int")

#: a blank next to another white-space character: cutting there could split a pre-token
ODD_SPACE = r" [\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}]|[\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}] "


def binary_pieces(total: int, max_length: int) -> list[int]:
    """Lengths of the pieces of ``total`` ids, each a power of two."""
    whole, rest = divmod(total, max_length)
    return [max_length] * whole + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


class ByteTokenizer:
    """Token ids of the byte-level vocabulary, the same as
    ``Tokenizer.from_file(json).encode(text, add_special_tokens=False)``.

    A text is cut at single blanks, where a pre-token always starts; the
    distinct pieces of a batch are encoded once, as one joined text, and the
    ids are dealt back by the byte lengths of the tokens. Texts with blanks
    beside other white space are encoded whole, and those that spell a special
    token by the ``tokenizers`` library itself.
    """

    def __init__(self, name: str = "byte_bpe_50k"):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, rank in ranks.items():
            self.width[rank] = len(piece)
        self.json, self.exact = public_tokenizers.path(f"{name}.json"), None
        self.special = "<|endoftext|>"

    def whole(self, text: str) -> np.ndarray:
        if self.special in text:
            if self.exact is None:
                from tokenizers import Tokenizer

                self.exact = Tokenizer.from_file(self.json)
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)

    def joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all distinct words, each with the blank before it, and offsets."""
        ends = np.cumsum(np.asarray(pc.binary_length(words)).astype(np.int64) + 1)
        text = " " + pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py()
        ids = np.array(self.fast.encode_ordinary(text), np.uint32)
        cuts = np.searchsorted(np.cumsum(self.width[ids]), ends, side="left") + 1
        return ids, np.concatenate([[0], cuts])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        odd = np.asarray(pc.or_(pc.match_substring_regex(texts, ODD_SPACE),
                                pc.match_substring(texts, self.special)))
        # a text's first piece has no blank before it: it is encoded as it stands
        odd |= np.asarray(pc.or_(pc.match_substring_regex(texts, r"^ | $"), pc.equal(texts, "")))
        easy = texts.filter(pa.array(~odd))
        out: list = [None] * len(texts)
        if len(easy):
            codes, offsets, words = coded_words(easy, lambda t: pc.split_pattern(t, " "))
            ids, at = self.joined(words)
            first = np.zeros(len(codes), bool)
            first[offsets[:-1]] = True
            heads = codes[offsets[:-1]]
            starts, lengths = at[codes], at[codes + 1] - at[codes]
            lengths[first] = 0
            flat = ids[ragged(starts, lengths)]
            bounds = np.concatenate([[0], np.cumsum(lengths)])[offsets]
            memo: dict[int, np.ndarray] = {}
            names = words.take(pa.array(heads)).to_pylist()
            for i, k in enumerate(np.flatnonzero(~odd)):
                head = memo.get(heads[i])
                if head is None:
                    head = memo[heads[i]] = self.whole(names[i])
                out[k] = np.concatenate([head, flat[bounds[i]:bounds[i + 1]]])
        for k in np.flatnonzero(odd):
            out[k] = self.whole(texts[k].as_py())
        return out


def _pack(batches, max_length: int, end_id: int, tokenizer: str):
    encoder = ByteTokenizer(tokenizer)
    serial = TaskContext.get().partitionId() << 40
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
              ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("bucket", pa.int32())]
    for batch in batches:
        for part in pieces_of(batch, "text", 2 << 20):
            cols: dict[str, list] = {k: [] for k, _ in fields}
            docs = part.column("doc_id").to_pylist()
            for doc, ids in zip(docs, encoder.encode(pc.fill_null(part.column("text"), "")), strict=True):
                raw = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                total, start = len(raw) // 4, 0
                for n in binary_pieces(total, max_length):
                    cols["doc_id"].append(doc)
                    cols["start"].append(start)
                    cols["length"].append(n)
                    cols["ids"].append(raw[4 * start:4 * (start + n)])
                    cols["doc_tokens"].append(total)
                    cols["bucket"].append(n.bit_length() - 1)
                    start += n
            n = len(cols["start"])
            cols["sequence_id"] = np.arange(serial, serial + n)
            cols["offset"] = np.zeros(n, np.int64)
            serial += n
            yield pa.RecordBatch.from_arrays([pa.array(cols[k], t) for k, t in fields], names=[k for k, _ in fields])


def pack(docs: DataFrame, max_length: int = 1024, end_id: int = 0, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """One row per sequence: the document, where its ids start there, their
    number, the ids (unsigned 32-bit little-endian), the document's ids in all,
    ``sequence_id`` (unique), ``offset`` (0: a sequence holds one piece) and
    ``bucket`` (log2 of the length).

    Null and empty texts give the one end id. Null or repeated doc_ids pass
    through, a sequence each. An empty table gives no rows. Other columns of
    ``docs`` are not read. ``max_length`` must be a power of two.
    """
    if max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(lean(lambda it: _pack(it, max_length, end_id, tokenizer)), SCHEMA)


def write_buckets(sequences: DataFrame, path: str) -> None:
    """The sequences stored by equal length: one folder per bucket."""
    sequences.write.partitionBy("bucket").parquet(path)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """All documents as power-of-two sequences of at most 1024 ids."""
    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "bucket")
