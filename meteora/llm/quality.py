"""Quality classifier: random-indexing word vectors, pooled per document, and a
two-layer numpy network with temperature-calibrated probabilities.

Random indexing (Kanerva et al., 2000): every word has a fixed sparse random
index vector, here that of its hashed form plus that of its shape (letters
folded to ``a``/``A``, digits to ``0``, runs of one character cut short).  A
word's vector is the sum of the index vectors met within two words of it, over
ALL documents: tasks add integers into a table of fixed size, Spark sums the
tables, so the result does not depend on the order of rows.

A document is the mean and the deviation of its words' vectors with a few
counts.  The network learns from a bounded sample of labelled rows
(``SAMPLE_ROWS``, in the order of a hash of the id); a fifth of it is kept
back to fit the temperature of the probabilities.

Null text counts as empty; an empty text gets a score like any other.  Labels
of a repeated id are averaged; a null label is ignored.  Without both labels
in the sample every score is the smoothed share of label 1.  Rows without an
id are scored, never learnt from.  Empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.llm.common import release, text_slices, with_text_columns

DIM = 48
WORD_ROWS = 1 << 14
SHAPE_ROWS = 1 << 10
WINDOW = 2
#: Labelled rows the network learns from at most.
SAMPLE_ROWS = 16_000
THRESHOLD = 0.7
SLICE_BYTES = 2 << 20
#: Words whose vectors are gathered together.
BLOCK_WORDS = 1 << 15


def index_vectors(seed: int = 7) -> np.ndarray:
    """Six entries of +1 or -1 in every row."""
    rng = np.random.default_rng(seed)
    n = WORD_ROWS + SHAPE_ROWS
    out = np.zeros((n, DIM), np.int64)
    at = np.argsort(rng.random((n, DIM)), axis=1)[:, :6]
    np.put_along_axis(out, at, rng.choice([-1, 1], (n, 6)), axis=1)
    return out


_SHAPE = [("[a-zß-öø-ÿ]+", "a"), ("[A-ZÀ-ÖØ-Þ]+", "A"), (r"\d+", "0")]
_RUN = re.compile(r"(.)\1{2,}")


def shapes(words: pa.StringArray) -> tuple[list[str], np.ndarray]:
    """The distinct shapes, and each word's: ``Don't`` is ``Aa'a``, ``1,204`` is
    ``0,0``, ``!!!!!`` is ``!!!``."""
    for pattern, to in _SHAPE:
        words = pc.replace_substring_regex(words, pattern, to)
    coded = words.dictionary_encode()
    return [_RUN.sub(r"\1\1\1", x) for x in coded.dictionary.to_pylist()], coded.indices.to_numpy(zero_copy_only=False)


def word_row(word: bytes) -> int:
    return zlib.crc32(word) % WORD_ROWS


def shape_row(shape: str) -> int:
    return WORD_ROWS + zlib.crc32(shape.encode()) % SHAPE_ROWS


class _Words:
    """The words of a slice of texts: rows of the table for each distinct word,
    the distinct word at each place, and the places of each text."""

    def __init__(self, texts):
        split = pc.ascii_split_whitespace(texts)
        offsets = split.offsets.to_numpy().astype(np.int64)
        words = split.flatten()
        real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
        self.ends = np.concatenate([[0], np.cumsum(real)])[offsets - offsets[0]]
        coded = words.filter(real).dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        own = coded.dictionary
        self.word = np.fromiter(map(word_row, own.cast(pa.binary()).to_pylist()), np.int64, len(own))
        kinds, of = shapes(own)
        self.shape = np.fromiter(map(shape_row, kinds), np.int64, len(kinds))[of]


def add_contexts(texts, index: np.ndarray, total: np.ndarray) -> None:
    """Add the index vectors near each word of the texts to the rows of ``total``."""
    w = _Words(texts)
    if not len(w.codes):
        return
    # a word's vector has entries from -2 to 2, and four of them are summed: bytes do.
    # WINDOW empty places between texts keep their words apart.
    own = np.concatenate([(index[w.word] + index[w.shape]).astype(np.int8), np.zeros((1, DIM), np.int8)])
    text = np.repeat(np.arange(len(w.ends) - 1), np.diff(w.ends))
    at = np.arange(len(w.codes)) + WINDOW * (text + 1)
    padded = np.full(len(w.codes) + WINDOW * (len(w.ends) + 1), len(own) - 1)
    padded[at] = w.codes
    place = own[padded]
    near = sum((place[WINDOW + d: len(place) - WINDOW + d] for d in range(-WINDOW, WINDOW + 1) if d), np.int8(0))
    near = near.take(at - WINDOW, axis=0)
    for row in (w.word, w.shape):
        row = row[w.codes]
        order = np.argsort(row.astype(np.uint16), kind="stable")  # a radix sort; WORD_ROWS + SHAPE_ROWS fit
        firsts = np.nonzero(np.diff(row[order], prepend=-1))[0]
        total[row[order[firsts]]] += np.add.reduceat(near.take(order, axis=0), firsts, axis=0, dtype=np.int32)


def context_table(docs: DataFrame) -> np.ndarray:
    """Sums of the index vectors met near the words of each table row."""
    rows = WORD_ROWS + SHAPE_ROWS
    cols = [f"c{i}" for i in range(DIM)]

    def run(batches):
        index, total = index_vectors(), np.zeros((rows, DIM), np.int64)
        for batch in batches:
            for _, texts in text_slices(batch, "text", SLICE_BYTES):
                add_contexts(texts, index, total)
        some = np.nonzero(total.any(axis=1))[0]
        yield pa.RecordBatch.from_arrays([pa.array(some)] + [pa.array(total[some, i]) for i in range(DIM)], names=["row", *cols])
        release()

    parts = docs.select("text").mapInArrow(run, "row long, " + ", ".join(f"{c} long" for c in cols))
    out = np.zeros((rows, DIM), np.int64)
    for r in parts.groupBy("row").agg(*[F.sum(c).alias(c) for c in cols]).collect():  # at most ``rows`` rows
        out[r[0]] = r[1:]
    return out


def unit_rows(table: np.ndarray) -> np.ndarray:
    norm = np.sqrt((table.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return (table / np.maximum(norm, 1)).astype(np.float32)


def _distinct(keys: np.ndarray, per_text: int, texts: int) -> np.ndarray:
    """How many distinct keys each text has; a key's text is its quotient by ``per_text``."""
    keys = np.sort(keys)
    return np.bincount(keys[np.diff(keys, prepend=-1) != 0] // per_text, minlength=texts)


def features(texts, vectors: np.ndarray) -> np.ndarray:
    """One row per text: mean and deviation of the word vectors, then counts."""
    w = _Words(texts)
    n = np.diff(w.ends)
    out = np.zeros((len(n), 2 * DIM + 5), np.float32)
    out[:, 2 * DIM] = np.log1p(n)
    some = np.nonzero(n)[0]
    if not len(some):
        return out
    own, total = vectors[w.word] + vectors[w.shape], np.zeros((len(n), 2, DIM))
    for i in some.tolist():
        for at in range(w.ends[i], w.ends[i + 1], BLOCK_WORDS):
            block = own.take(w.codes[at: min(at + BLOCK_WORDS, w.ends[i + 1])], axis=0)
            total[i, 0] += np.ones(len(block), np.float32) @ block
            total[i, 1] += np.einsum("ij,ij->j", block, block)
    mean, square = total[some, 0] / n[some][:, None], total[some, 1] / n[some][:, None]
    doc, kinds = np.repeat(np.arange(len(n)), n), len(w.word) + 1
    inner = doc[1:] == doc[:-1]
    singles = _distinct(doc * kinds + w.codes, kinds, len(n))
    pairs = _distinct((doc[1:] * kinds + w.codes[:-1])[inner] * kinds + w.codes[1:][inner], kinds * kinds, len(n))
    out[some, :DIM] = mean
    out[some, DIM:2 * DIM] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[some, 2 * DIM + 1] = np.sqrt((mean * mean).sum(axis=1))
    out[some, 2 * DIM + 2] = singles[some] / n[some]
    out[some, 2 * DIM + 3] = (pairs[some] + 1) / n[some]
    out[some, 2 * DIM + 4] = np.log1p(pc.binary_length(texts).to_numpy(zero_copy_only=False)[some] / n[some])
    return out


@dataclass
class Network:
    """Two layers: tanh, then one logit, divided by the temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x.astype(np.float64)) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, seed: int = 3) -> Network:
    """Adam on the cross-entropy; every fifth row only sets the temperature."""
    x, y = x.astype(np.float64), y.astype(np.float64)
    kept = np.arange(len(y)) % 5 == 4
    if len(set(y[~kept] > 0.5)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        d = x.shape[1]
        return Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    net = Network(x[~kept].mean(0), x[~kept].std(0) + 1e-3, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)),
                  np.zeros(hidden), rng.normal(0, hidden ** -0.5, hidden), 0.0)
    z, t = (x[~kept] - net.shift) / net.scale, y[~kept]
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        rate = 4e-3 * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(len(t))
        for at in range(0, len(t), 128):
            i = order[at: at + 128]
            h = np.tanh(z[i] @ params[0] + params[1])
            g = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3][0], -40, 40))) - t[i]) / len(i)
            dh = g[:, None] * params[2] * (1 - h * h)
            grads = [z[i].T @ dh + 1e-4 * params[0], dh.sum(0), h.T @ g + 1e-4 * params[2], np.array([g.sum()])]
            step += 1
            for p, d, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if kept.any():
        raw, t = net.logit(x[kept]), y[kept]
        loss = lambda c: np.mean(np.logaddexp(0, raw / c) - t * raw / c)
        net.temperature = float(min(np.geomspace(0.25, 10, 120), key=loss))
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Word vectors from all of ``docs``; the network from labelled rows for which
    ``learn_from`` (over doc_id) holds."""
    vectors = unit_rows(context_table(docs))
    chosen = labels.where("doc_id is not null and quality is not null").where(learn_from).groupBy("doc_id").agg(
        F.avg("quality").alias("__label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # at most ``sample_rows`` rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    made = with_text_columns(rows, [("x", "array<float>")], lambda: lambda t: [list(features(t, vectors))], keep_text=False,
                             slice_bytes=SLICE_BYTES)
    # of the rows of a repeated id the one with the smallest numbers, so that a run again learns the same
    got = made.groupBy("doc_id").agg(F.min("x").alias("x"), F.first("__label").alias("__label")).orderBy("doc_id").collect()
    x = np.array([r["x"] for r in got], np.float64).reshape(len(got), 2 * DIM + 5)
    # the order of a hash, so that every fifth row is no pattern of the ids
    order = sorted(range(len(got)), key=lambda i: zlib.crc32(str(got[i]["doc_id"]).encode()))
    y = np.array([r["__label"] for r in got])
    return QualityModel(vectors, fit_network(x[order], y[order]))


def with_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` up)."""
    def make():
        def f(texts):
            score = model.network.score(features(texts, model.vectors))
            return [score, (score >= threshold).astype(np.int32)]
        return f
    return with_text_columns(docs, [("score", "double"), ("predicted", "int")], make, keep_text=keep_text, slice_bytes=SLICE_BYTES)
