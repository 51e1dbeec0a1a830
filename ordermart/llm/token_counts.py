"""Token counts by unigram segmentation, with a trie shared by pre-tokens.

A pre-token is a run of non-white-space bytes with a blank before it. Its
segmentation into vocabulary pieces is the one of least cost, pieces costing
the negative log of a Zipf probability of their rank; of equally cheap ones
the one with fewer pieces. The cheapest way to reach a position depends only
on the bytes before it, so the distinct pre-tokens of a batch go into a trie,
each node gets its forward cost once for all that share the prefix, and the
nodes where pre-tokens end hold their token counts.

The trie is one of a batch: it is bounded, needs no shuffle, and pre-tokens of
a batch repeat enough to be worth it. Its nodes are made and scored a depth at
a time in numpy.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded_words, pieces_of

SPACE = r"[\x09-\x0D\x20]+"
#: Zipf-Mandelbrot offset of the rank, and the unit of the integer costs
OFFSET, UNIT = 2.7, 10_000
#: the cost where no piece ends; words so few that each is finished by itself
NONE, FEW = np.iinfo(np.int64).max // 4, 4


class Vocabulary:
    """Pieces as a trie read from their last byte to their first: sorted keys
    (state, byte) -> state, and the cost of the piece a state completes."""

    def __init__(self, pieces: dict[bytes, int]):
        states, cost, edges = 1, {}, {}
        for piece, rank in pieces.items():
            at = 0
            for byte in reversed(piece):
                at_next = edges.get(at << 8 | byte)
                if at_next is None:
                    at_next = edges[at << 8 | byte] = states
                    states += 1
                at = at_next
            cost[at] = int(round(UNIT * np.log(rank + OFFSET)))
        self.keys = np.array(sorted(edges), np.int64)
        self.to = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.cost = np.full(states, -1, np.int64)
        self.cost[list(cost)] = list(cost.values())
        self.edges, self.costs = edges, self.cost.tolist()

    @classmethod
    def named(cls, name: str):
        import public_tokenizers

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next states; -1 where there is none."""
        key = state << 8 | byte
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.to[at], -1)


def _grown(x: np.ndarray, n: int) -> np.ndarray:
    """``x`` with room for n items; doubled, so that all growing together is linear."""
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])


def _finished(word: bytes, costs: list[int], tokens: list[int], vocabulary: Vocabulary) -> int:
    """Tokens of a word (with its blank) whose first prefixes are scored: the
    rest of a path that no other word shares, a byte at a time."""
    edges, piece = vocabulary.edges, vocabulary.costs
    for end in range(len(costs), len(word) + 1):
        best, least, state, at = None, 0, 0, end
        while at:
            state = edges.get(state << 8 | word[at - 1])
            if state is None:
                break
            at -= 1
            if piece[state] >= 0:
                c, t = costs[at] + piece[state], tokens[at] + 1
                if best is None or c < best or (c == best and t < least):
                    best, least = c, t
        costs.append(NONE if best is None else best)
        tokens.append(least)
    return tokens[-1]


def counted(words: pa.Array, vocabulary: Vocabulary) -> np.ndarray:
    """Tokens of each distinct pre-token (given without its blank)."""
    if not len(words):
        return np.empty(0, np.int64)
    words = words.cast(pa.large_binary())
    order = np.asarray(pc.sort_indices(words))
    words = words.take(pa.array(order))
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    lengths = np.diff(offsets)
    # the nodes of one depth at a time: a sorted word opens a new node where it leaves the word before it
    parents, letters = np.array([-1, 0]), np.array([0, 32], np.uint8)  # the root, and the blank before every pre-token
    cost, tokens = np.array([0, NONE]), np.array([0, 0])
    nodes, counts = 2, np.zeros(len(words), np.int64)

    def score(first: int, up: np.ndarray, byte: np.ndarray):
        """Forward cost and token count of the nodes from ``first`` on."""
        best, least = np.full(len(up), NONE), np.zeros(len(up), np.int64)
        who, state, above, b = np.arange(len(up)), np.zeros(len(up), np.int64), up, byte.astype(np.int64)
        while len(who):
            state = vocabulary.step(state, b)
            on = state >= 0
            who, state, above = who[on], state[on], above[on]
            piece = vocabulary.cost[state]
            c, t = cost[above] + piece, tokens[above] + 1
            better = (piece >= 0) & ((c < best[who]) | ((c == best[who]) & (t < least[who])))
            best[who[better]], least[who[better]] = c[better], t[better]
            go = above > 0
            who, state, above = who[go], state[go], above[go]
            b, above = letters[above].astype(np.int64), parents[above]
        cost[first:first + len(up)], tokens[first:first + len(up)] = best, least

    score(1, parents[1:], letters[1:])
    active, node, depth = np.arange(len(words)), np.ones(len(words), np.int64), 0
    while True:
        done = lengths[active] == depth
        counts[active[done]] = tokens[node[active[done]]]
        active = active[~done]
        if len(active) <= FEW:
            break
        byte = data[offsets[active] + depth]
        above = node[active]
        new = np.ones(len(active), bool)
        new[1:] = (above[1:] != above[:-1]) | (byte[1:] != byte[:-1])
        node[active] = nodes + np.cumsum(new) - 1
        up, b = above[new], byte[new]
        first, nodes = nodes, nodes + len(up)
        parents, letters, cost, tokens = (_grown(x, nodes) for x in (parents, letters, cost, tokens))
        parents[first:nodes], letters[first:nodes] = up, b
        score(first, up, b)
        depth += 1
    for k in active.tolist():  # the few long words: what the trie has of them, then on alone
        path, at = [], int(node[k])
        while at >= 0:
            path.append(at)
            at = int(parents[at])
        path.reverse()
        counts[k] = _finished(b" " + words[k].as_py(), cost[path].tolist(), tokens[path].tolist(), vocabulary)
    out = np.empty(len(words), np.int64)
    out[order] = counts
    return out


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """doc_id, n_words (pre-tokens) and n_tokens of every whole text.

    Null, empty and blank texts have no pre-tokens: 0 and 0. Bytes that no
    longer piece covers are pieces themselves, so every text is covered. A very
    long pre-token costs time in proportion to its bytes. Null and repeated doc_ids pass through. An empty table gives no rows. Other
    columns are not read.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        known = Vocabulary.named(vocabulary)
        for batch in batches:
            for part in pieces_of(batch, "text"):
                texts = pc.ascii_trim(pc.fill_null(part.column("text"), ""), " \t\n\r\x0b\x0c")
                codes, offsets, words = coded_words(texts, lambda t: pc.split_pattern_regex(t, SPACE))
                each = counted(words, known)
                # a text without words is split into one empty item
                blank = np.asarray(pc.equal(texts, ""))
                sums = np.concatenate([[0], np.cumsum(each[codes])]) if len(codes) else np.zeros(1, np.int64)
                tokens = np.where(blank, 0, sums[offsets[1:]] - sums[offsets[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.where(blank, 0, np.diff(offsets))), pa.array(tokens)],
                    names=["doc_id", "n_words", "n_tokens"])

    return narrow.mapInArrow(run, "doc_id bigint, n_words bigint, n_tokens bigint")


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """Unigram token counts of all documents."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
