"""Language-model scoring by deleted interpolation.

P(w | v) mixes the maximum-likelihood bigram, the unigram and a uniform share.  The
mixture weights depend on how often the context v was seen (buckets by powers of
two) and are learnt by expectation-maximisation on the counts of a tuning part
of the training rows, every event of it deleted from the counts it is held against.

No count table is sent to tasks or the driver.  Rows are gathered into chunks of
about ``CHUNK_BYTES`` of text, stored once as word codes with the hashes of the
chunk's distinct words.  Each chunk sends its distinct unigrams and bigrams, as
sorted hash arrays with its training counts, to buckets of the hash space; a bucket
adds up the counts and answers every chunk with the totals.  So a word or a pair crosses
the network once per chunk however often it occurs, and a frequent one is no
hot key.  Chunks then score their rows from the answers.

Tokens: words between ASCII white space, A-Z lower-cased, then one end per text.  Null text counts as
empty: just the end.  Rows without an id train and are not held out.  Repeated rows each count.  Without training
rows all counts are zero and the weights fall back to the uniform share.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.llm.common import stored

CHUNK_BYTES = 16 << 20
#: Text whose n-grams one bucket adds up, about.
BUCKET_BYTES = 16 << 20
CONTEXT_BUCKETS = 48
STEPS = 4  # histogram bins per factor of two
MAX_BIN = 48 * STEPS
FLOOR = 1e-6
# no word holds white space
START, END = b" start", b" end"
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _press(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _open(raw: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype)


def chunks(docs: DataFrame, fold: Column, held_fold: int, tune_fold: int) -> DataFrame:
    """One row per chunk: chunk, tune, bytes, train_tokens, doc_ids, held, tokens (per row), codes, vocabulary."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(fold == held_fold, F.lit(False)).alias("held"), F.coalesce(fold == tune_fold, F.lit(False)).alias("tune"))
    schema = (f"chunk long, tune boolean, bytes long, train_tokens long, doc_ids array<{dict(rows.dtypes)['doc_id']}>, held array<boolean>, "
              "tokens array<int>, codes binary, vocabulary binary")
    id_type = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[dict(rows.dtypes)["doc_id"]]

    def pack(number: int, tune: bool, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).combine_chunks()
        texts = pc.ascii_lower(whole.column("text")).combine_chunks()
        held = whole.column("held").to_numpy()
        split = pc.ascii_split_whitespace(texts)
        offsets = split.offsets.to_numpy().astype(np.int64)
        words = split.flatten()
        real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
        ends = np.concatenate([[0], np.cumsum(real)])[offsets - offsets[0]]
        coded = words.filter(real).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.uint32) + 1  # 0 is the end
        vocabulary = np.array([xxhash.xxh64_intdigest(END)] + [xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], _U)
        n = np.diff(ends) + 1
        with_ends = np.insert(codes, ends[1:], 0)
        return pa.RecordBatch.from_arrays([
            pa.array([number]), pa.array([tune]), pa.array([int(pc.sum(pc.binary_length(texts)).as_py() or 0)], pa.int64()),
            pa.array([int(n[~held].sum())], pa.int64()), pa.array([whole.column("doc_id").to_pylist()], pa.list_(id_type)),
            pa.array([held.tolist()], pa.list_(pa.bool_())), pa.array([n.tolist()], pa.list_(pa.int32())),
            pa.array([_press(with_ends)], pa.binary()), pa.array([_press(vocabulary)], pa.binary())], names=NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        open_: dict[bool, list] = {True: [], False: []}
        size = {True: 0, False: 0}
        for batch in batches:
            for tune in (True, False):
                part = batch.filter(pc.equal(batch.column(3), tune))
                lens = np.cumsum(pc.binary_length(part.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
                at = 0
                while at < part.num_rows:
                    base = lens[at - 1] if at else 0
                    to = max(at + 1, int(np.searchsorted(lens, base + CHUNK_BYTES - size[tune], "right")))
                    open_[tune].append(part.slice(at, to - at))
                    size[tune] += int(lens[to - 1] - base)
                    at = to
                    if size[tune] >= CHUNK_BYTES or at < part.num_rows:
                        yield pack(number, tune, open_[tune])
                        number, open_[tune], size[tune] = number + 1, [], 0
        for tune, parts in open_.items():
            if parts:
                yield pack(number, tune, parts)
                number += 1

    return rows.mapInArrow(run, schema)


NAMES = ["chunk", "tune", "bytes", "train_tokens", "doc_ids", "held", "tokens", "codes", "vocabulary"]


@dataclass
class Chunk:
    """A chunk's tokens and its distinct n-grams, in the order in which buckets answer."""

    codes: np.ndarray  # of every token
    tokens: np.ndarray  # number of tokens of each row
    held: np.ndarray
    vocabulary: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Chunk:
        return cls(_open(row["codes"], np.uint32).astype(np.int64), np.array(row["tokens"], np.int64), np.array(row["held"], bool),
                   _open(row["vocabulary"], _U))

    def __post_init__(self):
        kinds = len(self.vocabulary)
        firsts = np.cumsum(self.tokens) - self.tokens
        self.before = np.empty_like(self.codes)
        self.before[1:] = self.codes[:-1]
        self.before[firsts] = kinds  # the start
        self.pair, self.pair_of = np.unique(self.before * (kinds + 1) + self.codes, return_inverse=True)
        hashes = np.append(self.vocabulary, _U(xxhash.xxh64_intdigest(START)))
        v, w = hashes[self.pair // (kinds + 1)], hashes[self.pair % (kinds + 1)]
        self.pair_key = mix(mix(v) * _U(3) + w)
        self.train = np.repeat(~self.held, self.tokens)

    def sent(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(order, keys, training counts) of the unigrams and of the bigrams."""
        one = np.bincount(self.codes, self.train, len(self.vocabulary)).astype(np.uint32)
        two = np.bincount(self.pair_of, self.train, len(self.pair)).astype(np.uint32)
        return [(1, mix(self.vocabulary), one), (2, self.pair_key, two)]


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by bucket, then key, and the ends of the buckets in it."""
    bucket = keys % _U(buckets)
    order = np.lexsort((keys, bucket))
    return order, np.searchsorted(bucket[order], np.arange(1, buckets + 1, dtype=_U))


def _send(buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for n, keys, counts in Chunk.read(row).sent():
                    order, ends = _dealt(keys, buckets)
                    keys, counts = keys[order], counts[order]
                    if n == 2:  # 40 bits do inside a bucket; sorted, the upper 8 of them press to nothing
                        part = (keys >> _U(24)) & _U((1 << 40) - 1)
                    for b, (x, y) in enumerate(zip([0, *ends], ends, strict=False)):
                        if y > x:
                            raw = keys[x:y].tobytes() if n == 1 else (part[x:y] >> _U(32)).astype(np.uint8).tobytes() + part[x:y].astype(np.uint32).tobytes()
                            out.append((b, n, row["chunk"], raw, counts[x:y].tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                        names=["bucket", "n", "chunk", "keys", "counts"])
    return run


def _answer(group: pa.Table) -> pa.Table:
    """Totals of one bucket's n-grams, for each chunk in the order of its keys; with the first
    answer, how many n-grams have a training count."""
    rows = group.to_pylist()
    n = rows[0]["n"]
    keys = []
    for r in rows:
        raw = r["keys"]
        if n == 1:
            keys.append(np.frombuffer(raw, _U))
        else:
            size = len(raw) // 5
            keys.append(np.frombuffer(raw, np.uint8, size).astype(_U) << _U(32) | np.frombuffer(raw, np.uint32, size, size).astype(_U))
    sizes = [len(k) for k in keys]
    own, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in rows]), len(own)).astype(np.int64)
    width = np.uint32 if not len(total) or total.max() < 1 << 32 else np.uint64
    answers = np.split(total[at].astype(width), np.cumsum(sizes)[:-1])
    known = [int((total > 0).sum())] + [0] * (len(rows) - 1)
    return pa.table([pa.array([r["chunk"] for r in rows], pa.int64()), pa.array([n] * len(rows), pa.int32()),
                     pa.array([r["bucket"] for r in rows], pa.int32()), pa.array([a.tobytes() for a in answers], pa.binary()),
                     pa.array([a.itemsize for a in answers], pa.int32()), pa.array(known, pa.int64())],
                    names=["chunk", "n", "bucket", "totals", "width", "known"])


def _totals(c: Chunk, answers: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Training totals of the chunk's unigrams and bigrams."""
    out = []
    rows = answers.select(["n", "bucket", "totals", "width"]).to_pylist()
    for n, keys, _ in c.sent():
        order, _ = _dealt(keys, buckets)
        own = sorted((r for r in rows if r["n"] == n), key=lambda r: r["bucket"])
        total = np.empty(len(keys), np.int64)
        total[order] = np.concatenate([np.frombuffer(r["totals"], np.uint32 if r["width"] == 4 else np.uint64).astype(np.int64) for r in own])
        out.append(total)
    return out[0], out[1]


def _context_bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(np.maximum(count, 0) + 1)).astype(np.int64), CONTEXT_BUCKETS - 1)


def _bin(p: np.ndarray) -> np.ndarray:
    """A bin of a probability on a logarithmic scale; the last one is zero."""
    with np.errstate(divide="ignore"):
        x = -np.log2(p) * STEPS
    return np.where(p > 0, np.minimum(np.rint(np.minimum(x, MAX_BIN)), MAX_BIN - 1), MAX_BIN).astype(np.int64)


def events(c: Chunk, one: np.ndarray, two: np.ndarray, starts: int, n_train: int) -> np.ndarray:
    """(context bucket, bigram bin, unigram bin) of each training token, itself deleted."""
    use = c.train
    contexts = np.append(one, starts)[c.before][use] - 1
    pair, word = two[c.pair_of][use] - 1, one[c.codes][use] - 1
    p2 = np.where(contexts > 0, pair / np.maximum(contexts, 1), 0.0)
    p1 = word / max(n_train - 1, 1)
    return np.stack([_context_bucket(contexts), _bin(p2), _bin(p1)])


def fit_weights(hist: np.ndarray, n_types: int, rounds: int = 60) -> np.ndarray:
    """Weights (bigram, unigram, uniform) of each context bucket by expectation-maximisation
    on rows (context bucket, bigram bin, unigram bin, events)."""
    prob = np.append(2.0 ** (-np.arange(MAX_BIN) / STEPS), 0.0)
    out = np.zeros((CONTEXT_BUCKETS, 3))
    last = np.array([0.0, 0.9, 0.1]) if len(hist) else np.array([0.0, 0.0, 1.0])
    for b in range(CONTEXT_BUCKETS):
        own = hist[hist[:, 0] == b] if len(hist) else hist
        if len(own):
            p = np.stack([prob[own[:, 1]], prob[own[:, 2]], np.full(len(own), 1 / (n_types + 1))], axis=1)
            w, mass = np.full(3, 1 / 3), own[:, 3].astype(float)
            for _ in range(rounds):
                share = p * w
                share /= share.sum(axis=1, keepdims=True)
                w = np.maximum(mass @ share / mass.sum(), FLOOR)
                w /= w.sum()
            last = w
        out[b] = last
    return out


def score(docs: DataFrame, fold: Column, held_fold: int, tune_fold: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``fold`` gives a row's fold: ``held_fold`` is not learnt from, ``tune_fold`` is learnt from
    and also sets the weights.
    """
    made = stored(chunks(docs, fold, held_fold, tune_fold), "lm-chunks")
    sums = made.agg(F.sum("bytes"), F.sum("train_tokens"), F.sum(F.size(F.filter("held", lambda h: ~h)))).first()
    n_bytes, n_train, starts = (int(x or 0) for x in sums)
    buckets = max(4, -(-n_bytes // BUCKET_BYTES))
    sent = made.mapInArrow(_send(buckets), "bucket int, n int, chunk long, keys binary, counts binary")
    answers = sent.groupBy("bucket", "n").applyInArrow(_answer, "chunk long, n int, bucket int, totals binary, width int, known long")
    answers = stored(answers, "lm-counts")
    n_types = int(answers.where("n = 1").agg(F.sum("known")).first()[0] or 0)

    def tune(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for row in left.to_pylist():
            c = Chunk.read(row)
            parts.append(events(c, *_totals(c, right, buckets), starts, n_train))
        kinds, times = np.unique(np.concatenate(parts, axis=1), axis=1, return_counts=True)
        return pa.table([*(pa.array(k, pa.int32()) for k in kinds), pa.array(times, pa.int64())], names=["b", "two", "one", "events"])

    tuning = made.where("tune")
    heard = answers.join(tuning.select("chunk"), "chunk", "left_semi")
    hist = tuning.groupBy("chunk").cogroup(heard.groupBy("chunk")).applyInArrow(tune, "b int, two int, one int, events long")
    # one row per bucket and pair of bins: bounded whatever the input
    rows = hist.groupBy("b", "two", "one").agg(F.sum("events").alias("events")).orderBy("b", "two", "one").collect()
    weights = fit_weights(np.array(rows, np.int64).reshape(-1, 4), n_types)
    id_type = docs.select("doc_id").schema[0].dataType.simpleString()

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            c = Chunk.read(row)
            one, two = _totals(c, right, buckets)
            count = one[c.codes]
            context = np.append(one, starts)[c.before]
            w = weights[_context_bucket(context)]
            p = w[:, 0] * np.where(context > 0, two[c.pair_of] / np.maximum(context, 1), 0.0) + w[:, 1] * count / max(n_train, 1) + w[:, 2] / (n_types + 1)
            at = np.cumsum(c.tokens) - c.tokens
            add = lambda x: np.add.reduceat(x, at)  # noqa: E731, B023
            out.append(pa.table([
                left.column("doc_ids").combine_chunks().flatten(), pa.array(c.held), pa.array(c.tokens), pa.array(add((count > 0).astype(np.int64))),
                pa.array(np.full(len(at), n_train)), pa.array(add(np.log10((count + 1) / (n_train + n_types + 1)))), pa.array(add(np.log10(p)))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out)

    return made.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        rate, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
