"""Toxicity scores from a bidirectional gated recurrent network in numpy.

Each word enters as two vectors: one of the word, one of its characters (the
mean over its runs of 3 to 5 bytes, word boundaries included), so inflected and
unseen forms resemble the forms that were learnt. Two more inputs are how much
more often the word, and the most telling of its character runs, occurs in toxic
texts of the sample than in others. A GRU reads a window of words
in either direction, attention pools its states, and a logistic unit gives the
window's score. A text's score is that of its worst window; windows overlap by a
quarter and cover every word.

The network is trained in one task from a bounded sample of labelled rows: at
most TRAIN_TEXTS texts of each label, of at most TRAIN_BYTES bytes each, chosen
by a hash of their ids from all that fit. A toxic text's label says that some
window is toxic, so only its worst windows count as toxic, at first by the word
statistics and later by the network's own score. A fifth of the sample, at every
size, isn't learnt from and sets the decision point. The task returns the network
as one row; scoring runs in Arrow batches where the documents are, without a
shuffle. Only the network, of fixed size, goes through the driver.

Null texts count as empty. A text without words scores the share of toxic texts
among the labelled ones. Null ids are held out. Without labels of both kinds, or
without documents that have them, every text scores 0. Rows that repeat each get
their score; of several texts under one labelled id the least is learnt from. A
very long text is scored whole, in windows; an empty table gives an empty result.
Working columns take names that docs doesn't have, so no column can clash.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pennant.llm.common import fresh, materialize
from pennant.llm.words import ALNUM, Words, chunks, mix

WINDOW, STRIDE = 64, 48
WORD_BITS, CHAR_BITS = 16, 15
EMBED, HIDDEN = 8, 8
NGRAMS = (3, 4, 5)
TRAIN_TEXTS = 1500
TRAIN_BYTES = 16_000
FOLDS = 5
EPOCHS, BATCH = 6, 256
#: Windows of a toxic text that count as toxic.
WORST = 2
#: Texts that must hold a word or run before its odds count.
SUPPORT = 3
INPUTS = 2 * EMBED + 2
SEED = 7
#: Texts whose buckets are counted, and words whose vectors are made, at once.
ODDS_TEXTS, INPUT_WORDS = 100, 16384
#: Windows that are scored at once, which bounds memory.
SCORE_WINDOWS = 1024


@dataclass
class Network:
    word: np.ndarray
    char: np.ndarray
    word_odds: np.ndarray
    char_odds: np.ndarray
    wx: np.ndarray  # 2 directions x inputs x 3 gates
    b: np.ndarray
    u: np.ndarray
    attend: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    base: float = 0.0

    def parameters(self) -> list[np.ndarray]:
        return [self.wx, self.b, self.u, self.attend, self.out, self.bias]


def new_network(base: float) -> Network:
    rng = np.random.default_rng(SEED)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    zeros = lambda *shape: np.zeros(shape, np.float32)
    return Network(
        zeros(1 << WORD_BITS, EMBED), draw(1 << CHAR_BITS, EMBED) * np.float32(0.1), zeros(1 << WORD_BITS), zeros(1 << CHAR_BITS), draw(2, INPUTS, 3 * HIDDEN), zeros(2, 3 * HIDDEN),
        draw(2, HIDDEN, 3 * HIDDEN), draw(2 * HIDDEN), draw(2 * HIDDEN), zeros(1), base,
    )


def _unique_words(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket of each distinct word, its character buckets with where each word's begin, and every word's distinct word."""
    _, first, inverse = np.unique(h := w.hashes(), return_index=True, return_inverse=True)
    start, size = w.start[first], w.end[first] - w.start[first]
    # Distinct words one after the other, each between two boundary bytes.
    at = np.concatenate([[0], np.cumsum(size + 2)])
    which = np.repeat(np.arange(len(first)), size + 2)
    place = np.arange(at[-1]) - at[which]
    inner = (place > 0) & (place <= size[which])
    data = np.full(at[-1], 1, np.uint64)
    data[inner] = w.data[(start[which] + place - 1)[inner]]
    buckets, of = [], []
    for n in NGRAMS:
        begin = np.flatnonzero(place + n <= size[which] + 2)
        code = np.full(len(begin), n, np.uint64)
        for k in range(n):
            code = (code << np.uint64(8)) | data[begin + k]
        buckets.append((mix(code) & np.uint64((1 << CHAR_BITS) - 1)).astype(np.int32))
        of.append(which[begin])
    of_all = np.concatenate(of)
    order = np.argsort(of_all, kind="stable")
    counts = np.bincount(of_all, minlength=len(first))
    word = (mix(h[first]) & np.uint64((1 << WORD_BITS) - 1)).astype(np.int32)
    return word, np.concatenate(buckets)[order], np.concatenate([[0], np.cumsum(counts)]), inverse


def _inputs(net: Network, word: np.ndarray, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Input vector of each distinct word. Words of one byte have one run of three, so none is without."""
    out = np.empty((len(word), INPUTS), np.float32)
    out[:, :EMBED] = net.word[word]
    out[:, 2 * EMBED] = net.word_odds[word]
    for lo in range(0, len(word), INPUT_WORDS):
        hi = min(lo + INPUT_WORDS, len(word))
        some, begin = grams[at[lo] : at[hi]], at[lo:hi] - at[lo]
        out[lo:hi, EMBED : 2 * EMBED] = np.add.reduceat(net.char[some], begin, axis=0) / np.diff(at[lo : hi + 1])[:, None].astype(np.float32)
        out[lo:hi, 2 * EMBED + 1] = np.maximum.reduceat(net.char_odds[some], begin)
    return out


def _held(x: _Sample, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How much more often toxic than other texts hold each word bucket and each character bucket.

    Logs of ratios in units of 4, 0 for what fewer than SUPPORT texts hold. Texts
    are taken ODDS_TEXTS at a time, which bounds the pairs of text and bucket.
    """
    counts = [np.zeros((2, 1 << bits)) for bits in (WORD_BITS, CHAR_BITS)]
    for first in range(0, len(learn), ODDS_TEXTS):
        lo, hi = np.searchsorted(x.of_word, [first, first + ODDS_TEXTS])
        pair = np.unique(x.of_word[lo:hi].astype(np.int64) * len(x.word) + x.inverse[lo:hi])
        text, distinct = pair // len(x.word), pair % len(x.word)
        mine = learn[text] >= 0
        text, distinct = text[mine], distinct[mine]
        places, sizes = _spread(x.at, distinct)
        for count, bucket, of in ((counts[0], x.word[distinct], text), (counts[1], x.grams[places], np.repeat(text, sizes))):
            size = count.shape[1]
            seen = np.unique(of.astype(np.int64) * size + bucket)
            for label in (0, 1):
                count[label] += np.bincount(seen[learn[seen // size] == label] % size, minlength=size)
    total = [(learn == label).sum() for label in (0, 1)]
    out = []
    for clean, toxic in counts:
        odds = np.log((toxic + 0.5) / (total[1] + 1)) - np.log((clean + 0.5) / (total[0] + 1))
        out.append(np.where(clean + toxic >= SUPPORT, np.clip(odds / 4, -1, 2), 0).astype(np.float32))
    return out[0], out[1]


def windows(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and text of each window."""
    n = np.maximum(0, -(-(w.counts - WINDOW) // STRIDE)) + (w.counts > 0)
    of = np.repeat(np.arange(len(n)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = w.bounds[of] + k * STRIDE
    return start, np.minimum(WINDOW, w.bounds[of + 1] - start), of


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _read(net: Network, x: np.ndarray, d: int, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States of one direction. x: steps x windows x gates, already projected."""
    steps, n, _ = x.shape
    h = np.zeros((n, HIDDEN), np.float32)
    states, past = np.empty((steps, n, HIDDEN), np.float32), []
    for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
        hu = h @ net.u[d]
        gates = _sigmoid(x[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        c = np.tanh(x[t, :, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
        m = mask[t][:, None]
        new = h + m * z * (c - h)
        if keep:
            past.append((t, h, hu, z, r, c, m))
        states[t] = h = new
    return states, past


def _forward(net: Network, inputs: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logit of each window. index: steps x windows, the distinct word at each place."""
    both = []
    for d in range(2):
        projected = inputs @ net.wx[d] + net.b[d]
        both.append(_read(net, projected[index], d, mask, keep))
    s = np.concatenate([both[0][0], both[1][0]], axis=2)
    a = np.where(mask > 0, s @ net.attend, np.float32(-1e9))
    e = np.exp(a - a.max(axis=0))
    alpha = e / e.sum(axis=0)
    pooled = (alpha[:, :, None] * s).sum(axis=0)
    return pooled @ net.out + net.bias[0], (both, s, alpha, pooled)


def _backward(net: Network, inputs: np.ndarray, index: np.ndarray, mask: np.ndarray, kept, dlogit: np.ndarray):
    both, s, alpha, pooled = kept
    dpooled = dlogit[:, None] * net.out
    dalpha = (s * dpooled).sum(axis=2)
    da = alpha * (dalpha - (alpha * dalpha).sum(axis=0)) * (mask > 0)
    ds = alpha[:, :, None] * dpooled + da[:, :, None] * net.attend
    grads = [np.zeros_like(p) for p in net.parameters()]
    gwx, gb, gu, grads[3], grads[4], grads[5] = grads[0], grads[1], grads[2], (s * da[:, :, None]).sum(axis=(0, 1)), dlogit @ pooled, dlogit.sum(keepdims=True)
    dinputs = np.zeros_like(inputs)
    for d in range(2):
        dx = np.zeros((*index.shape, 3 * HIDDEN), np.float32)
        dh = np.zeros((index.shape[1], HIDDEN), np.float32)
        for t, h, hu, z, r, c, m in reversed(both[d][1]):
            dh = dh + ds[t, :, d * HIDDEN : (d + 1) * HIDDEN]
            dz, dc = dh * m * (c - h) * z * (1 - z), dh * m * z * (1 - c * c)
            dr = dc * hu[:, 2 * HIDDEN :] * r * (1 - r)
            dx[t] = np.concatenate([dz, dr, dc], axis=1)
            dhu = np.concatenate([dz, dr, dc * r], axis=1)
            gu[d] += h.T @ dhu
            dh = dh * (1 - m * z) + dhu @ net.u[d].T
        flat, at = dx.reshape(-1, 3 * HIDDEN), index.ravel()
        by_word = np.stack([np.bincount(at, weights=flat[:, k], minlength=len(inputs)) for k in range(3 * HIDDEN)], axis=1).astype(np.float32)
        gwx[d] += inputs.T @ by_word
        gb[d] += by_word.sum(axis=0)
        dinputs += by_word @ net.wx[d].T
    return grads, dinputs


def _layout(start: np.ndarray, size: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps = np.arange(int(size.max()))[:, None]
    mask = (steps < size).astype(np.float32)
    return inverse[np.minimum(start + steps, len(inverse) - 1)], mask


@dataclass
class _Sample:
    """All windows of the sampled texts, over one list of distinct words."""

    word: np.ndarray
    grams: np.ndarray
    at: np.ndarray
    inverse: np.ndarray
    of_word: np.ndarray
    start: np.ndarray
    size: np.ndarray
    of: np.ndarray


def _gather(texts: list[str]) -> _Sample | None:
    cols: list[list[np.ndarray]] = [[] for _ in range(8)]
    words_before = unique_before = 0
    for w in chunks(pa.array(texts, pa.large_string()), ALNUM, lower=True):
        if len(w):
            (u, g, a, inv), (s, n, o) = _unique_words(w), windows(w)
            for col, x in zip(cols, (u, g, np.diff(a), inv + unique_before, w.of + w.first, s + words_before, n, o + w.first), strict=True):
                col.append(x)
            words_before, unique_before = words_before + len(inv), unique_before + len(u)
    if not words_before:
        return None
    word, grams, sizes, inverse, of_word, start, size, of = (np.concatenate(x) for x in cols)
    return _Sample(word, grams, np.concatenate([[0], np.cumsum(sizes)]), inverse, of_word, start, size, of)


def _spread(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places at[r] .. at[r+1]-1 for each of the rows, and the sizes of these runs."""
    sizes = np.diff(at)[rows]
    return np.repeat(at[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()), sizes


def _worst(score: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """The n windows of each text that score highest; the highest of each text comes first."""
    order = np.lexsort((-score, of))
    rank = np.arange(len(of)) - np.searchsorted(of[order], of[order])
    return np.concatenate([order[rank == k] for k in range(n)])


def train(texts: list[str], toxic: np.ndarray, base: float) -> Network:
    """Fit the network; toxic: 0 or 1 per text. Deterministic."""
    net, rng = new_network(base), np.random.default_rng(SEED)
    x = _gather(texts)
    if x is None:
        return net
    held = np.arange(len(texts)) % 5 == 4
    learn = np.where(held, -1, toxic)
    net.word_odds, net.char_odds = _held(x, learn)
    telling = _inputs(net, x.word, x.grams, x.at)[:, -2:].max(axis=1)[x.inverse]
    ends = np.stack([x.start, x.start + x.size], axis=1).ravel()
    score = np.maximum.reduceat(np.append(telling, -9), ends)[::2]
    label = learn[x.of].astype(np.float32)
    negative = np.flatnonzero(label == 0)
    moments, step = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()], 0
    seen_word, seen_char = np.full(net.word.shape, 1e-6, np.float32), np.full(net.char.shape, 1e-6, np.float32)
    for epoch in range(EPOCHS):
        worst = _worst(score, x.of, WORST)
        first = np.arange(len(worst)) < len(np.unique(x.of))
        positive = worst[(label[worst] == 1) & (first | (score[worst] > 0.5))]
        # Each clean text's worst window comes every time, the others in turn.
        hard = worst[(label[worst] == 0) & first]
        chosen = rng.permutation(np.concatenate([positive, hard, rng.permutation(negative)[: max(len(positive), BATCH)]]))
        for lo in range(0, len(chosen), BATCH):
            take = chosen[lo : lo + BATCH]
            index, mask = _layout(x.start[take], x.size[take], x.inverse)
            used, index = np.unique(index, return_inverse=True)
            index = index.reshape(mask.shape)
            places, sizes = _spread(x.at, used)
            gram = x.grams[places]
            inputs = _inputs(net, x.word[used], gram, np.concatenate([[0], np.cumsum(sizes)]))
            logit, kept = _forward(net, inputs, index, mask, keep=True)
            dlogit = ((_sigmoid(logit) - label[take]) / len(take)).astype(np.float32)
            grads, dinputs = _backward(net, inputs, index, mask, kept, dlogit)
            step += 1
            for p, g, (m, v) in zip(net.parameters(), grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
            _descend(net.word, seen_word, x.word[used], dinputs[:, :EMBED])
            _descend(net.char, seen_char, gram, np.repeat(dinputs[:, EMBED : 2 * EMBED] / sizes[:, None], sizes, axis=0))
        score = _score_windows(net, x.word, x.grams, x.at, x.inverse, x.start, x.size)
    # The decision point: the score that errs least on texts not learnt from, by the labels' own shares.
    by_text = np.zeros(len(texts))
    np.maximum.at(by_text, x.of, score)
    p, q = by_text[held & (toxic == 1)], by_text[held & (toxic == 0)]
    if len(p) and len(q):
        at = np.linspace(-4, 4, 161)
        logit = lambda v: np.log(np.clip(v, 1e-6, 1 - 1e-6) / (1 - np.clip(v, 1e-6, 1 - 1e-6)))
        errs = base * (logit(p)[:, None] < at).mean(axis=0) + (1 - base) * (logit(q)[:, None] >= at).mean(axis=0)
        best = at[errs <= errs.min() + 1e-12]
        net.bias = net.bias - np.float32(best[np.argmin(np.abs(best - np.median(best)))])
    return net


def _descend(table: np.ndarray, seen: np.ndarray, rows: np.ndarray, grads: np.ndarray) -> None:
    """Adagrad on the rows of a table."""
    used, at = np.unique(rows, return_inverse=True)
    g = np.stack([np.bincount(at, weights=grads[:, k], minlength=len(used)) for k in range(table.shape[1])], axis=1).astype(np.float32)
    seen[used] += g * g
    table[used] -= 0.1 * g / np.sqrt(seen[used])


def _score_windows(net: Network, word, grams, at, inverse, start, size) -> np.ndarray:
    inputs, out = _inputs(net, word, grams, at), np.empty(len(start), np.float32)
    for lo in range(0, len(start), SCORE_WINDOWS):
        index, mask = _layout(start[lo : lo + SCORE_WINDOWS], size[lo : lo + SCORE_WINDOWS], inverse)
        out[lo : lo + SCORE_WINDOWS] = _sigmoid(_forward(net, inputs, index, mask)[0])
    return out


def score_texts(net: Network | None, column: pa.Array) -> np.ndarray:
    """Score of each text of an Arrow column."""
    if net is None:
        return np.zeros(len(column))
    out = []
    for w in chunks(column, ALNUM, lower=True):
        part = np.full(w.last - w.first, net.base)
        if len(w):
            part[w.counts > 0] = 0.0
            start, size, of = windows(w)
            np.maximum.at(part, of, _score_windows(net, *_unique_words(w), start, size).astype(float))
        out.append(part)
    return np.concatenate(out) if out else np.zeros(0)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no label is learnt from: crc32 of the id as text is divisible by FOLDS."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sample (id, text, toxic, share) becomes one row, the pickled network."""
    rows = pa.Table.from_batches([b for b in batches if b.num_rows] or [pa.RecordBatch.from_pylist([], pa.schema([("id", pa.int64()), ("text", pa.string()), ("toxic", pa.int32()), ("share", pa.float64())]))])
    rows = rows.sort_by("id")
    toxic = rows.column("toxic").to_numpy().astype(np.int64)
    if len(toxic) and toxic.any() and not toxic.all():
        net = train(rows.column("text").to_pylist(), toxic, rows.column("share")[0].as_py())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], names=["net"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Network | None:
    """Train, in one task, on a bounded sample of the labelled documents that are not held out."""
    known = labels.filter(F.col(label_col).isin(0, 1) & ~held_out(id_col)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter(F.octet_length("text") <= TRAIN_BYTES)
    # Ids and labels alone are shuffled; the texts of the chosen ids are then read where they are.
    known = materialize(known.join(rows.select("id"), "id", "left_semi"), "labelled")
    pick = lambda label: known.filter(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(TRAIN_TEXTS)
    share = known.agg(F.avg("toxic").alias("share"))
    sample = rows.join(F.broadcast(pick(0).unionByName(pick(1))), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    sample = sample.join(F.broadcast(share)).select("id", "text", "toxic", "share")
    found = materialize(sample.repartition(1).mapInArrow(_train, "net binary"), "network").first()
    return pickle.loads(bytes(found["net"])) if found else None


def with_score(docs: DataFrame, net: Network | None, text_col: str = "text", name: str = "_score") -> DataFrame:
    """docs and the score of each text in the new column `name`."""
    at = docs.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(score_texts(net, batch.column(at)).astype(float))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])

    return docs.mapInArrow(add, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def decide(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted."""
    net = fit(docs, labels, id_col, text_col, label_col)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = with_score(slim, net)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", least: float = 0.5) -> DataFrame:
    """The rows of docs that score below `least`, with all their columns."""
    name = fresh(docs, "_score")
    return with_score(docs, fit(docs, labels, id_col, text_col, label_col), text_col, name).filter(F.col(name) < least).drop(name)
