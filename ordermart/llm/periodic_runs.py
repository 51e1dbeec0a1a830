"""Periodic runs of words, found through recompression.

A run is a stretch of words with smallest period q and at least three periods
long that can't be made longer. Any such run holds two neighbouring points i
and i + q of the harmonic grid of its period (steps of q, of ``SHORT`` words
for smaller periods) with a whole step of equal words behind them. Grid points
with equal words there are the candidates; how far the period reaches to both
sides is the longest common extension of the two points.

Recompression answers these extensions: rounds of block compression (repeats of
a symbol become one) and pair compression (the symbols are parted in two sides,
every pair from left to right becomes one) turn the words into a run-length
grammar that parses equal stretches alike. An extension climbs and descends
that grammar, over whole blocks at a time; there is no suffix array.

The documents of an Arrow batch's slice share one grammar, parted by symbols
that occur once, so all steps are numpy over many documents at a time.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, ragged

LEAST, PERIODS = 24, 3
#: grid step of periods below it: with a period it fits into the shortest run
SHORT = 8
#: candidates looked at together, and bytes of text in a slice
CHUNK, SLICE = 1 << 20, 4 << 20


class Grammar:
    """Run-length grammar of a sequence by recompression.

    All levels lie in one array of nodes, level 0 (the sequence) first. A node
    knows its symbol, its length, its parent, whether it is the parent's first
    or last child, its first and last child, and, where the next level is one
    of blocks, how many equal nodes follow and precede it in its block. Symbols
    of ``alone`` nodes occur once and are never joined to others."""

    def __init__(self, symbols: np.ndarray, alone: np.ndarray, seed: int = 1):
        self.n = len(symbols)
        rng = np.random.default_rng(seed)
        fresh = int(symbols.max(initial=0)) + 1
        levels = [(symbols, np.ones(self.n, np.int64), np.arange(self.n + 1), True)]
        while True:
            # blocks: a node for each run of equal symbols
            new = np.append(True, symbols[1:] != symbols[:-1])[:len(symbols)]
            starts = np.flatnonzero(new)
            count = np.diff(np.append(starts, len(symbols)))
            many = count > 1
            names = symbols[starts]
            if many.any():
                kinds, inverse = np.unique(names[many] * np.int64(self.n + 1) + count[many], return_inverse=True)
                names[many] = fresh + inverse
                fresh += len(kinds)
            alone = alone[starts]
            levels.append((names, count * levels[-1][1][starts], np.append(starts, len(symbols)), False))
            symbols = names
            if len(symbols) < 2 or not (~alone[1:] & ~alone[:-1]).any():
                break
            # pairs: from a left symbol to a right one; the side is a hash bit of the symbol, drawn anew each round
            side = (symbols + 1).astype(np.uint64) * (rng.integers(1 << 64, dtype=np.uint64) | np.uint64(1)) >> np.uint64(63)
            joined = np.append((side[1:] == 1) & (side[:-1] == 0) & ~alone[1:] & ~alone[:-1], False)
            starts = np.flatnonzero(~np.append(False, joined[:-1]))
            pair = joined[starts]
            names = symbols[starts]
            if pair.any():
                kinds, inverse = np.unique(names[pair] * np.int64(fresh) + symbols[starts[pair] + 1], return_inverse=True)
                names[pair] = fresh + inverse
                fresh += len(kinds)
            edges = np.append(starts, len(symbols))
            levels.append((names, np.add.reduceat(levels[-1][1], starts), edges, True))
            symbols, alone = names, alone[starts]
        self._lay_out(levels)

    def _lay_out(self, levels) -> None:
        sizes = [len(x[0]) for x in levels]
        base = np.cumsum([0, *sizes])
        self.symbol = np.concatenate([x[0] for x in levels])
        self.length = np.concatenate([x[1] for x in levels])
        total = int(base[-1])
        self.parent = np.full(total, -1, np.int64)
        self.head, self.tail = np.zeros(total, bool), np.zeros(total, bool)
        self.first, self.last = np.full(total, -1, np.int64), np.full(total, -1, np.int64)
        self.after, self.before = np.ones(total, np.int64), np.ones(total, np.int64)
        for k in range(1, len(levels)):
            edges, low, up = levels[k][2], base[k - 1], base[k]
            n = np.diff(edges)
            self.first[up:up + len(n)] = low + edges[:-1]
            self.last[up:up + len(n)] = low + edges[1:] - 1
            self.parent[low:up] = up + np.repeat(np.arange(len(n)), n)
            self.head[low + edges[:-1]] = True
            self.tail[low + edges[1:] - 1] = True
            if not levels[k][3]:  # blocks
                place = np.arange(up - low)
                self.after[low:up] = np.repeat(edges[1:], n) - place
                self.before[low:up] = place - np.repeat(edges[:-1], n) + 1

    def extension(self, i: np.ndarray, j: np.ndarray, forward: bool = True) -> np.ndarray:
        """Length of the longest equal stretches from i and j on, or up to and
        with i and j. Each pair must meet two different lone symbols."""
        step, edge, child, sign = (self.after, self.head, self.first, 1) if forward else (self.before, self.tail, self.last, -1)
        out = np.zeros(len(i), np.int64)
        who, a, b = np.arange(len(i)), i.astype(np.int64), j.astype(np.int64)
        while len(who):
            same = self.symbol[a] == self.symbol[b]
            # equal: over all of the block they have in common, then up where both begin a node of the next level
            n = np.where(same, np.minimum(step[a], step[b]), 0)
            out[who] += n * self.length[a]
            a, b = a + sign * n, b + sign * n
            up = same & edge[a] & edge[b] & (self.parent[a] >= 0)
            down = ~same
            a, b = (np.where(up, self.parent[x], np.where(down, child[x], x)) for x in (a, b))
            go = a >= 0
            who, a, b = who[go], a[go], b[go]
        return out


def _pairs(lengths: np.ndarray, low: int, high: int, least: int, periods: int):
    """(document, period) with a period in [low, high) that fits ``periods``
    times into the document, in chunks of about CHUNK grid points."""
    top = np.minimum(lengths // periods, high - 1)
    docs = np.flatnonzero((lengths >= least) & (top >= low))
    while len(docs):
        n = top[docs] - low + 1
        points = n * (lengths[docs] // max(low, SHORT) + 1)
        take = max(1, int(np.searchsorted(np.cumsum(points), CHUNK)))
        part = docs[:take]
        doc, period = np.repeat(part, n[:take]), ragged(np.full(take, low), n[:take])
        each = lengths[doc] // np.maximum(period, SHORT) + 1
        cuts = np.unique(np.cumsum(each) // CHUNK, return_index=True)[1]
        for x, y in zip(cuts, [*cuts[1:], len(doc)], strict=True):
            yield doc[x:y], period[x:y]
        docs = docs[take:]


def _candidates(words, starts, lengths, doc, period):
    """Grid points i (document, period, place) with words i and i + period
    equal for a whole short step."""
    step = np.maximum(period, SHORT)
    # a point needs its step and its period inside the document
    n = np.maximum((lengths[doc] - period - step) // step + 1, 0)
    at = ragged(np.zeros(len(doc), np.int64), n) * np.repeat(step, n)
    doc, period = np.repeat(doc, n), np.repeat(period, n)
    at += starts[doc]
    for k in range(SHORT):
        same = words[at + k] == words[at + k + period]
        doc, period, at = doc[same], period[same], at[same]
    return doc, period, at


def runs_of(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
            least: int = LEAST, periods: int = PERIODS) -> tuple[np.ndarray, ...]:
    """(document, start, length, period) of all runs of the documents, given as
    word codes one after the other, by document, start and period."""
    none = np.empty((4, 0), np.int64)
    longest = int(lengths.max(initial=0))
    groups = [(1 << k, 2 << k) for k in range(max(1, (longest // periods)).bit_length())]
    # documents without a candidate have no run and need no grammar
    open_ = lengths.copy()
    for low, high in groups:
        for doc, period in _pairs(open_, low, high, least, periods):
            live = open_[doc] > 0
            open_[np.unique(_candidates(words, starts, lengths, doc[live], period[live])[0])] = 0
    docs = np.flatnonzero((open_ == 0) & (lengths > 0))
    if not len(docs):
        return tuple(none)
    # their words, a lone symbol before each document and after the last
    n = lengths[docs]
    at = starts[docs]
    begin = np.cumsum(n + 1) - n
    symbols = np.empty(int(n.sum()) + len(docs) + 1, np.int64)
    codes = np.unique(words[ragged(at, n)], return_inverse=True)[1]
    lone = np.ones(len(symbols), bool)
    lone[ragged(begin, n)] = False
    symbols[~lone] = codes
    symbols[lone] = int(codes.max()) + 1 + np.arange(len(docs) + 1)
    grammar = Grammar(symbols, lone)
    # of each word: the period and the end of a run known to hold it
    known, until = np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64)
    found = [none]
    for low, high in groups:
        fresh = []
        for doc, period in _pairs(n, low, high, least, periods):
            doc, period, i = _candidates(symbols, begin, n, doc, period)
            # inside a run whose period divides this one, the extension is that run
            inside = (known[i] > 0) & (period % np.maximum(known[i], 1) == 0) & (i + period + np.maximum(period, known[i]) <= until[i])
            doc, period, i = doc[~inside], period[~inside], i[~inside]
            ahead = grammar.extension(i, i + period)
            behind = grammar.extension(i - 1, i + period - 1, forward=False)
            start, size = i - behind, behind + period + ahead
            fits = size >= np.maximum(least, periods * period)
            fresh.append(np.stack([doc[fits], start[fits], size[fits], period[fits]]))
        if not fresh:
            continue
        rows = _stretches(np.concatenate(fresh, axis=1))
        found.append(rows)
        for _, s, size, p in rows.T.tolist():
            # the longer reach of the runs that share a word, so that most later points are covered
            part = slice(s, s + size)
            longer = until[part] < s + size
            known[part][longer], until[part][longer] = p, s + size
    doc, start, size, period = _stretches(np.concatenate(found, axis=1))
    order = np.lexsort((period, start, doc))
    return docs[doc[order]], (start - begin[doc])[order], size[order], period[order]


def _stretches(rows: np.ndarray) -> np.ndarray:
    """Each stretch (document, start, length) once, with the smallest of its
    periods, which divides the others."""
    rows = rows[:, np.lexsort((rows[3], rows[2], rows[1], rows[0]))]
    return rows[:, np.append(True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0))[:rows.shape[1]]]


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p): words from a on repeat with period p; None for most documents."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(code of each word, words of each text, distinct words)."""
    texts = pc.ascii_trim(texts.cast(pa.string()), " \t\n\r\x0b\x0c")
    lists = pc.ascii_split_whitespace(texts)
    offsets = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    coded = flat.dictionary_encode()
    n, codes = np.diff(offsets), np.asarray(coded.indices).astype(np.int64)
    # a text without words is split into one empty item
    blank = np.asarray(pc.equal(texts, "")) & (n == 1)
    codes = codes[~np.repeat(blank, n)]
    return codes, np.where(blank, 0, n), coded.dictionary


def _solve(ids: list, texts: pa.Array, edit: bool, least: int, periods: int) -> dict:
    codes, n, names = _words(texts)
    starts = np.cumsum(n) - n
    if edit:
        codes = codes.copy()
        for k, (doc_id, size) in enumerate(zip(ids, n.tolist(), strict=True)):
            if (cut := planted(doc_id, size)) is not None:
                s, (a, p) = starts[k], cut
                codes[s + a:s + size] = np.resize(codes[s + a:s + a + p], size - a)
    doc, start, size, period = runs_of(codes, starts, n, least, periods)
    # a word goes if it lies in a run beyond that run's first period
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, starts[doc] + start + period, 1)
    np.add.at(cover, starts[doc] + start + size, -1)
    kept = np.cumsum(cover[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[np.append(starts, len(codes))]
    words = names.take(pa.array(codes[kept]))
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), words), " ")
    return {"n": n, "doc": doc, "start": start, "length": size, "period": period, "collapsed": collapsed}


def periodic_runs(docs: DataFrame, edit: bool = False, least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then
    period) and collapsed (the words outside of runs and those of each run's
    first period, joined by one blank) of every whole text.

    ``edit`` first repeats words of a tenth of the documents, chosen by the
    CRC-32 of the decimal doc_id; a null doc_id is not edited. Words are the
    stretches without ASCII white space, compared as they are. ``least`` is at
    least 24 and ``periods`` at least 3.

    Null, empty and blank texts have no words and no runs, their collapsed text
    is empty. Very long texts are read whole; a slice of 4 MB or one longer
    text is in memory at a time. Null and repeated doc_ids pass through, each
    row by itself. An empty table gives no rows. Other columns are not read.
    """
    if least < 3 * SHORT or periods < 3:
        raise ValueError("the grid finds runs of at least 24 words and three periods")
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def solve(batches):
        for batch in batches:
            for part in pieces_of(batch, "text", SLICE):
                ids = part.column("doc_id")
                found = _solve(ids.to_pylist() if edit else [], pc.fill_null(part.column("text"), ""), edit, least, periods)
                cuts = np.searchsorted(found["doc"], np.arange(part.num_rows + 1)).astype(np.int32)
                items = pa.StructArray.from_arrays([pa.array(found[c]) for c in ("start", "length", "period")], fields=list(run))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(found["n"]), pa.ListArray.from_arrays(pa.array(cuts), items), found["collapsed"]],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return narrow.mapInArrow(solve, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
                                    "collapsed string")


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents, a tenth of them edited: their number, the one of
    greatest exponent, and digests of all runs and of the collapsed text."""
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), edit=True)
    # length / period as an exact fraction: the larger by its whole part, then by cross products
    more = F.reduce("runs", F.expr("CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>)"), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", more).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
