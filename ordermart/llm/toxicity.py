"""Toxicity by a convolutional text classifier, trained in numpy.

A word is embedded as the sum of hashed rows for itself and its beginnings,
so inflected forms share what their stem has learnt. Filters of several widths
run over the whole text, each filter keeps its maximum, and a logistic layer
reads the maxima. Training starts from embeddings whose first coordinate is
the signed root of each row's log-likelihood ratio between the labels.

Out-of-fold scores of the training documents set the slope of the score, the
point where it is 0.5, and a rejection threshold for each language.

Every labelled document is learnt from, whole (``learned``): they are dealt to
parts of about ``PART_BYTES`` of text by a hash of the doc_id, and in each epoch
every part is trained on in a task, from the same weights; the mean of the
tasks' weights, each counting as its documents do, begins the next epoch. There
are at most ``TASKS`` tasks, which then train on several parts in turn, and a
task sends the weights it has moved: what is exchanged for an epoch is bounded,
whatever the documents. Word counts and the out-of-fold scores are summed by
Spark. Every document is scored whole, in tasks. Only the text enters a score.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded_words, lean, pieces_of, stored

ROWS, DIM, FILTERS, WIDTHS, PREFIXES = 1 << 17, 8, 8, (1, 2, 3), (3, 4, 5)
FOLDS, EPOCHS, MIN_POSITIVES = 2, 4, 20
#: text of a part, and of what is tokenised at a time
PART_BYTES, PIECE_BYTES = 32 << 20, 8 << 20
#: copies of the weights that are trained side by side
TASKS = 64
#: places of a logit in the counts that calibrate, and the largest logit told apart
STEPS, LIMIT = 1024, 64
#: slices in which the weights of the tasks are summed
SLICES = 16
#: labelled documents whose ids every task is sent; beyond that Spark chooses the join
SENT_IDS = 1 << 20


def word_rows(words: pa.Array, rows: int = ROWS) -> np.ndarray:
    """Hashed rows of each normalised word: itself and its beginnings."""
    import xxhash

    out = []
    for seed, end in enumerate([None, *PREFIXES]):
        part = words if end is None else pc.utf8_slice_codeunits(words, 0, end)
        part = part.dictionary_encode()
        h = np.array([xxhash.xxh32_intdigest(w, seed) % rows for w in part.dictionary.to_pylist()], np.int64)
        out.append(h[np.asarray(part.indices)] if len(h) else h)
    return np.stack(out, axis=1)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(code of each word, offsets of the texts, distinct normalised words).

    Words are cut at white space, lower-cased and stripped to their letters.
    Word 0 is the empty word, also of words without letters."""
    codes, offsets, raw = coded_words(texts, pc.utf8_split_whitespace)
    plain = pc.utf8_lower(pc.replace_substring_regex(raw, r"[^\p{L}]+", ""))
    plain = pa.concat_arrays([pa.array([""]), plain.cast(pa.string())]).dictionary_encode()
    return np.asarray(plain.indices).astype(np.int64)[codes + 1], offsets, plain.dictionary


def _windows(e: np.ndarray, bank: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Filter values of the windows that start at each place of the padded
    words ``at``; those that would reach into the next text count for nothing."""
    n = len(at) - len(bank) + 1
    total = (e @ bank[0]).take(at[:n], axis=0)
    for k in range(1, len(bank)):
        total += (e @ bank[k]).take(at[k:n + k], axis=0)
        total[starts[1:] - k] = -np.inf
    return total


@dataclass
class Model:
    """Embeddings (ROWS x DIM), one filter bank (width, DIM, FILTERS) per
    width, biases, output weights, and the calibration."""

    table: np.ndarray
    banks: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    base: float = 0.0
    slope: float = 1.0
    middle: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def embed(self, words: pa.Array) -> np.ndarray:
        e = self.table[word_rows(words)].sum(axis=1)
        e[0] = 0  # the empty word
        return e

    def logits(self, texts: pa.Array) -> np.ndarray:
        codes, offsets, words = words_of(texts)
        e = self.embed(words)
        # empty words after every text, so that short and empty ones have a window of each width
        pad = max(WIDTHS)
        lengths = np.diff(offsets) + pad
        starts = np.cumsum(lengths) - lengths
        padded = np.zeros(int(lengths.sum()), np.int64)
        if len(codes):
            padded[np.arange(len(codes)) + np.repeat(np.arange(len(texts)) * pad, np.diff(offsets))] = codes
        pooled = []
        for bank in self.banks:
            pooled.append(np.maximum.reduceat(_windows(e, bank, padded, starts), starts, axis=0))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return hidden @ self.out + self.base

    def scores(self, texts: pa.Array) -> np.ndarray:
        z = self.slope * (self.logits(texts) - self.middle)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Adam:
    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0, rate

    def step(self, x, g, rows=slice(None)):
        self.t += 1
        self.m[rows] = 0.9 * self.m[rows] + 0.1 * g
        self.v[rows] = 0.99 * self.v[rows] + 0.01 * g * g
        x[rows] -= self.rate * (self.m[rows] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[rows] / (1 - 0.99 ** self.t)) + 1e-6)


def _presence(rows: np.ndarray, codes, offsets, kind: np.ndarray, kinds: int = 2) -> np.ndarray:
    """(kinds, ROWS): documents of each kind in which a hashed row occurs."""
    n = np.zeros((kinds, ROWS))
    of_words, of_starts = rows.T[0], rows.T[1:]
    for d, k in enumerate(kind):
        own, count = codes[offsets[d]:offsets[d + 1]], n[k]
        for by in (of_words, *of_starts):
            count[by[own]] += 1  # indexed: once however often a row is named
    return n


def _ratio(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Signed root of the log-likelihood ratio of each hashed row's presence,
    by its documents of each label and all documents of each."""
    total = total.astype(np.float64)[:, None]
    expect = n.sum(axis=0) * total / total.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = sum(np.where(o > 0, o * np.log(o / x), 0) for o, x in ((n, expect), (total - n, total - expect)))
    g = 2 * terms.sum(axis=0)
    return (np.sign(n[1] - expect[1]) * np.sqrt(np.maximum(g, 0))).astype(np.float32)


def untrained(n: np.ndarray, total: np.ndarray, seed: int = 7) -> Model:
    """The weights training begins from; final ones where there is one class only."""
    rng = np.random.default_rng(seed)
    n_out = FILTERS * len(WIDTHS)
    model = Model(np.zeros((ROWS, DIM), np.float32),
                  [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.full(n_out, -0.5, np.float32), rng.normal(0.3, 0.1, n_out).astype(np.float32))
    for bank in model.banks:
        bank[:, 0, :] = np.abs(bank[:, 0, :]) + 0.3
    if not total.all():
        model.out[:], model.base = 0, 3.0 if total[1] else -3.0
        return model
    used = np.flatnonzero(n.sum(axis=0))
    model.table[used] = rng.normal(0, 0.02, (len(used), DIM))
    model.table[used, 0] = 0.25 * _ratio(n, total)[used]
    model.base = -1.0
    return model


class Training:
    """Minibatch steps on a model; positive documents weigh as much as the
    others together, by the ``total`` documents of each label."""

    def __init__(self, model: Model, total: np.ndarray, rate: float = 0.02):
        self.model, self.weight, self.documents = model, (total.sum() / (2 * np.maximum(total, 1))).astype(np.float32), 0
        n_out = len(model.out)
        self.adam = {"table": _Adam(model.table.shape, rate / 4), "bias": _Adam(n_out, rate), "out": _Adam(n_out, rate),
                     "base": _Adam(1, rate)}
        self.banks = [_Adam(b.shape, rate / 2) for b in model.banks]

    def run(self, codes, offsets, rows: np.ndarray, y: np.ndarray, order: np.ndarray, batch: int = 32) -> None:
        place = np.zeros(len(rows), np.int64)
        for start in range(0, len(order), batch):
            self._step(codes, offsets, rows, y, order[start:start + batch], place)
        self.documents += len(order)

    def _step(self, codes, offsets, rows, y, docs, place) -> None:
        model, pad, empty = self.model, max(WIDTHS), np.zeros(max(WIDTHS), np.int64)
        # the batch's words, each text followed by empty ones
        parts = [x for d in docs for x in (codes[offsets[d]:offsets[d + 1]], empty)]
        flat = np.concatenate(parts)
        lengths = offsets[docs + 1] - offsets[docs] + pad
        starts = np.cumsum(lengths) - lengths
        place[flat] = -1
        local = np.flatnonzero(place < 0)
        place[local] = np.arange(len(local))
        at = place[flat]
        place[local] = 0
        e = model.table[rows[local]].sum(axis=1)
        e[local == 0] = 0
        tops, values = [], []
        for bank in model.banks:
            total = _windows(e, bank, at, starts)
            best = np.maximum.reduceat(total, starts, axis=0)
            # first position of each maximum
            where, which = np.nonzero(total == np.repeat(best, np.diff(np.append(starts, len(total))), axis=0))
            top = np.zeros(best.shape, np.int64)
            top[np.searchsorted(starts, where[::-1], "right") - 1, which[::-1]] = where[::-1]
            tops.append(top)
            values.append(best)
        pre = np.concatenate(values, axis=1) + model.bias
        hidden = np.maximum(pre, 0)
        z = hidden @ model.out + np.float32(model.base)
        g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[docs]) * self.weight[y[docs]] / len(docs)).astype(np.float32)
        g_hidden = (g[:, None] * model.out) * (pre > 0)
        g_e = np.zeros_like(e)
        for j, bank in enumerate(model.banks):
            top, gh = tops[j], g_hidden[:, j * FILTERS:(j + 1) * FILTERS]
            g_bank = np.empty_like(bank)
            for k in range(len(bank)):
                word = at[np.minimum(top + k, len(at) - 1)]  # documents x filters
                g_bank[k] = np.einsum("bf,bfd->df", gh, e[word])
                np.add.at(g_e, word.ravel(), (gh[:, :, None] * bank[k].T[None]).reshape(-1, DIM))
            self.banks[j].step(bank, g_bank + 1e-4 * bank)
        self.adam["out"].step(model.out, hidden.T @ g + 1e-4 * model.out)
        self.adam["bias"].step(model.bias, g_hidden.sum(axis=0))
        base = np.array([model.base], np.float32)
        self.adam["base"].step(base, np.array([g.sum()], np.float32))
        model.base = float(base[0])
        moved = np.flatnonzero((g_e != 0).any(axis=1) & (local != 0))
        if len(moved):
            touched, inverse = np.unique(rows[local[moved]], return_inverse=True)
            g_rows = np.zeros((len(touched), DIM), np.float32)
            np.add.at(g_rows, inverse.reshape(len(moved), -1), g_e[moved][:, None, :])
            self.adam["table"].step(model.table, g_rows, touched)


def train(texts: list[str], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """The model of texts at hand. With one class only, scores are that class's."""
    codes, offsets, words = words_of(pa.array(texts, pa.string()))
    rows, total = word_rows(words), np.bincount(y, minlength=2)
    model = untrained(_presence(rows, codes, offsets, y), total, seed)
    rng, training = np.random.default_rng(seed), Training(model, total)
    for _ in range(epochs if total.all() else 0):
        training.run(codes, offsets, rows, y, rng.permutation(len(y)))
    return model


def best_cut(z: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None) -> float:
    """The value between two neighbouring scores that gives the best F1; of
    equally good ones the middle. With ``rows``, each score stands for that many
    documents, ``y`` of them positive."""
    order = np.argsort(-z, kind="stable")
    z, y = z[order], y[order]
    hits, taken = np.cumsum(y), np.cumsum(np.ones(len(y), np.int64) if rows is None else rows[order])
    f1 = 2 * hits / (taken + y.sum())
    f1[:-1][z[:-1] == z[1:]] = -1  # a cut can't part equal scores
    k = int(np.argmax(f1))
    below = z[k + 1] if k + 1 < len(z) else z[k] - 1.0
    return float((z[k] + below) / 2)


def _squashed(model: Model, z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.slope * (z - model.middle), -30, 30)))


def calibrate(model: Model, z: np.ndarray, y: np.ndarray, rows: np.ndarray) -> None:
    """Middle and slope of the score from out-of-fold logits, each of ``rows``
    documents with ``y`` positive ones."""
    model.middle = best_cut(z, y, rows)
    for _ in range(50):  # slope of the logistic curve through the middle
        model.slope = float(np.clip(model.slope + 0.5 * np.sum((y - rows * _squashed(model, z)) * (z - model.middle)) / rows.sum(), 0.2, 5.0))


def _logits(texts: list[str], model: Model) -> np.ndarray:
    """Logits in slices of 8 MB of text, so that memory does not follow the texts."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    return np.concatenate([model.logits(part.column("text")) for part in pieces_of(batch, "text", PIECE_BYTES)])


def fit(texts: list[str], y, langs: list[str | None], folds: int = FOLDS, min_positives: int = MIN_POSITIVES) -> Model:
    """The model on all documents at hand, calibrated by out-of-fold logits. A
    language with fewer than ``min_positives`` positive documents uses the
    common threshold. ``learned`` does the same for a table."""
    y = np.asarray(y, np.int64)
    model = train(texts, y)
    part = np.arange(len(y)) % folds
    if min(((y == c) & (part != k)).sum() for c in (0, 1) for k in range(folds)) == 0:
        return model
    z = np.zeros(len(y))
    for k in range(folds):
        inside = part != k
        other = train([t for t, i in zip(texts, inside, strict=True) if i], y[inside])
        z[~inside] = _logits([t for t, i in zip(texts, inside, strict=True) if not i], other)
    calibrate(model, z, y, np.ones(len(y), np.int64))
    known = np.array([lang if lang is not None else "" for lang in langs])
    for lang in sorted(set(known.tolist())):
        own = known == lang
        if lang and y[own].sum() >= min_positives:
            model.thresholds[lang] = best_cut(_squashed(model, z[own]), y[own])
    return model


def _flat(model: Model) -> np.ndarray:
    return np.concatenate([model.table.ravel(), *[b.ravel() for b in model.banks], model.bias, model.out, [model.base]]).astype(np.float64)


def _model(flat: np.ndarray) -> Model:
    n_out = FILTERS * len(WIDTHS)
    shapes = [(ROWS, DIM), *[(w, DIM, FILTERS) for w in WIDTHS], (n_out,), (n_out,)]
    ends = np.cumsum([int(np.prod(x)) for x in shapes])
    table, *banks, bias, out = [x.reshape(shape).astype(np.float32) for x, shape in zip(np.split(flat[:-1], ends[:-1]), shapes, strict=True)]
    return Model(table, banks, bias, out, float(flat[-1]))


def _pieces(batches):
    for batch in batches:
        yield from pieces_of(batch, "text", PIECE_BYTES)


def _sliced(vector: np.ndarray) -> list[np.ndarray]:
    """SLICES of the vector, in rows of DIM values with zeros after the last."""
    rows = np.zeros((-(-len(vector) // DIM), DIM), np.float32)
    rows.ravel()[:len(vector)] = vector
    return np.array_split(rows, SLICES)


def _summed(rows: DataFrame, of_task, start) -> list[np.ndarray]:
    """Sums of the (weight, vector) that ``of_task`` makes of the pieces of each
    task, each vector times its weight; added in the order of the tasks. A task
    sends the rows of DIM values that differ from those of the ``start`` vectors,
    a broadcast."""
    fields = [("which", pa.int32()), ("slice", pa.int32()), ("task", pa.int32()), ("weight", pa.float64()),
              ("at", pa.binary()), ("data", pa.binary())]

    def run(batches):
        pieces, task = _pieces(batches), TaskContext.get().partitionId()
        first = next(pieces, None)
        if first is None:
            return
        for which, (weight, vector) in enumerate(of_task(itertools.chain([first], pieces))):
            at, data = [], []
            for x, was in zip(_sliced(vector), _sliced(start.value[which]), strict=True):
                moved = np.flatnonzero((x != was).any(axis=1))
                at.append(moved.astype(np.int32).tobytes())
                data.append(x[moved].tobytes())
            yield pa.RecordBatch.from_pydict({"which": [which] * SLICES, "slice": list(range(SLICES)), "task": [task] * SLICES,
                                              "weight": [float(weight)] * SLICES, "at": at, "data": data}, schema=pa.schema(fields))

    def add(found):
        found = found.sort_values("task")
        was = _sliced(start.value[found["which"].iloc[0]])[found["slice"].iloc[0]]
        total = np.zeros(was.shape)
        for weight, at, data in zip(found["weight"], found["at"], found["data"], strict=True):
            x = was.copy()
            x[np.frombuffer(at, np.int32)] = np.frombuffer(data, np.float32).reshape(-1, DIM)
            total += weight * x
        return found.iloc[:1][["which", "slice"]].assign(data=[total.tobytes()])

    sums = (rows.mapInArrow(lean(run), "which int, slice int, task int, weight double, at binary, data binary")
            .groupBy("which", "slice").applyInPandas(add, "which int, slice int, data binary").collect())
    found = itertools.groupby(sorted(sums, key=lambda r: (r["which"], r["slice"])), key=lambda r: r["which"])
    return [np.concatenate([np.frombuffer(r["data"]) for r in own])[:len(start.value[which])] for which, own in found]


def _coded(piece):
    codes, offsets, words = words_of(piece.column("text"))
    return codes, offsets, word_rows(words), np.asarray(piece.column("toxic")).astype(np.int64), np.asarray(piece.column("fold"))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per labelled document whose crc32(doc_id) mod 5 is not 0, dealt
    to parts of about PART_BYTES of text and written once: (part, doc_id, text,
    toxic, lang, fold). Null text: empty."""
    # where few enough ids are wanted, the other texts stay where they lie
    wanted = stored(labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
                    .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
                    .groupBy(F.col("doc_id").cast("bigint").alias("__id")).agg((F.max("toxic") == 1).cast("int").alias("__toxic")),
                    "toxicity-labels")
    wanted = F.broadcast(wanted) if wanted.count() <= SENT_IDS else wanted
    text, key = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("bigint")
    size = (docs.select(key.alias("__doc"), F.octet_length(text).alias("size")).join(wanted, F.col("__doc") == F.col("__id"))
            .agg(F.sum("size").alias("size")).first()["size"] or 0)
    known = (docs.select(key.alias("__doc"), text.alias("text"), F.col("lang").cast("string").alias("lang"))
             .join(wanted, F.col("__doc") == F.col("__id")))
    # dealt before the grouping, which then needs no exchange of its own
    n = max(1, -(-size // PART_BYTES))
    one = (known.repartition(n, "__id")
           .groupBy("__id").agg(F.min(F.struct("text", F.col("__toxic").alias("toxic"), "lang")).alias("row"))
           .select(F.col("__id").alias("doc_id"), "row.*", F.pmod(F.xxhash64(F.lit("fold"), "__id"), F.lit(FOLDS)).cast("int").alias("fold"),
                   # the partition's number, however many there are
                   F.pmod(F.hash("__id"), F.lit(n)).cast("int").alias("part")))
    return stored(one.sortWithinPartitions("part", F.xxhash64("doc_id"), "doc_id"), "toxicity-labelled")


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of all labelled rows whose crc32(doc_id) mod 5 is not 0, whole
    texts, as ``fit`` makes it of texts at hand; folds by a hash of the doc_id."""
    rows = labelled(docs, labels)
    found = rows.groupBy("fold", "toxic").agg(F.count("*").alias("n"), F.max("part").alias("last")).collect()
    counts = {(r["fold"], r["toxic"]): r["n"] for r in found}
    # no tasks without a part, and no more weights to send than TASKS of them
    rows = rows.coalesce(min(max((r["last"] for r in found), default=0) + 1, TASKS))
    own = np.array([[counts.get((k, c), 0) for c in (0, 1)] for k in range(FOLDS)])
    if not own.sum():
        return fit([], [], [])

    def presence(pieces):
        n = np.zeros((FOLDS * 2, ROWS))
        for piece in pieces:
            codes, offsets, words, y, fold = _coded(piece)
            n += _presence(words, codes, offsets, fold * 2 + y, FOLDS * 2)
        return [(1, n.ravel())]

    context = rows.sparkSession.sparkContext
    held = context.broadcast([np.zeros(FOLDS * 2 * ROWS, np.float32)])
    n = _summed(rows, presence, held)[0].reshape(FOLDS, 2, ROWS)
    held.unpersist()
    # the model on all documents, then the one on all but each fold
    totals = [own.sum(axis=0), *[own.sum(axis=0) - own[k] for k in range(FOLDS)]]
    seen = [n.sum(axis=0), *[n.sum(axis=0) - n[k] for k in range(FOLDS)]]
    if not totals[0].all():
        return untrained(seen[0], totals[0])
    judged = all(t.all() for t in totals)
    which = range(FOLDS + 1 if judged else 1)
    models = [untrained(seen[m], totals[m]) for m in which]
    for epoch in range(EPOCHS):
        held = context.broadcast([_flat(m).astype(np.float32) for m in models])

        def trained(pieces, held=held, epoch=epoch):
            runs = [Training(_model(flat), totals[m]) for m, flat in zip(which, held.value, strict=True)]
            for i, piece in enumerate(pieces):
                codes, offsets, words, y, fold = _coded(piece)
                order = np.random.default_rng([7, epoch, i]).permutation(len(y))
                for m, run in zip(which, runs, strict=True):
                    run.run(codes, offsets, words, y, order if m == 0 else order[fold[order] != m - 1])
            return [(run.documents / totals[m].sum(), _flat(run.model)) for m, run in zip(which, runs, strict=True)]

        models = [_model(x) for x in _summed(rows, trained, held)]
        held.unpersist()
    model = models[0]
    if judged:
        _calibrated(rows, model, models[1:])
    return model


def _calibrated(rows: DataFrame, model: Model, others: list[Model]) -> None:
    """``model`` with middle, slope and thresholds from the logits of all
    documents by the model that did not see them, counted by 1/STEPS."""
    held = rows.sparkSession.sparkContext.broadcast(others)

    def run(batches):
        for piece in _pieces(batches):
            fold = np.asarray(piece.column("fold"))
            z = np.zeros(len(fold))
            for k, other in enumerate(held.value):
                if (fold == k).any():
                    z[fold == k] = other.logits(piece.column("text").filter(pa.array(fold == k)))
            step = np.rint(np.clip(z, -LIMIT, LIMIT) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([piece.column("lang"), pa.array(step), piece.column("toxic")], names=["lang", "step", "toxic"])

    by_lang = stored(rows.mapInArrow(lean(run), "lang string, step bigint, toxic int").groupBy("lang", "step")
                     .agg(F.count("*").alias("n"), F.sum("toxic").alias("hits")), "toxicity-logits")
    all_rows = by_lang.groupBy("step").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).orderBy("step").toPandas()
    calibrate(model, all_rows["step"].to_numpy() / STEPS, all_rows["hits"].to_numpy(), all_rows["n"].to_numpy())
    slope, middle = model.slope, model.middle

    def threshold(found):
        found = found.sort_values("step")
        score = 1 / (1 + np.exp(-np.clip(slope * (found["step"].to_numpy() / STEPS - middle), -30, 30)))
        cut = best_cut(score, found["hits"].to_numpy(), found["n"].to_numpy()) if found["hits"].sum() >= MIN_POSITIVES else None
        return found.iloc[:1][["lang"]].assign(threshold=[cut])

    cuts = by_lang.where("lang <> ''").groupBy("lang").applyInPandas(threshold, "lang string, threshold double").where("threshold IS NOT NULL")
    model.thresholds.update({r["lang"]: r["threshold"] for r in cuts.collect()})


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and rejected (score at or above the language's
    threshold) of every document.

    Null text: empty, scored like a text without words. Null or unknown
    language: the common threshold. Null and repeated doc_ids pass through.
    An empty table gives no rows. Other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.col("lang").cast("string").alias("lang"))

    def run(batches):
        model = held.value
        for batch in batches:
            for part in pieces_of(batch, "text", 8 << 20):
                score = model.scores(pc.fill_null(part.column("text"), ""))
                cut = np.array([model.thresholds.get(x, model.threshold) for x in part.column("lang").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(score.astype(np.float64)), pa.array(score >= cut)],
                    names=["doc_id", "score", "rejected"])

    return narrow.mapInArrow(lean(run), "doc_id bigint, score double, rejected boolean")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rejected ones, columns unchanged."""
    held, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")
    lang = docs.columns.index("lang")

    def run(batches):
        model = held.value
        for batch in batches:
            for part in pieces_of(batch, batch.schema.names[at], 8 << 20):
                score = model.scores(pc.fill_null(part.column(at).cast(pa.string()), ""))
                cut = np.array([model.thresholds.get(x, model.threshold) for x in part.column(lang).to_pylist()])
                yield part.filter(pa.array(score < cut))

    return docs.mapInArrow(lean(run), docs.schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; labels of crc32(doc_id) mod 5 = 0 held out."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = scored(docs, learned(docs, labels))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"), "rejected")
