"""Language ID: interpolated Kneser-Ney character models, one per language.

A text is its words (runs of letters, lower case), each with a start and an
end mark; tokens that mix letters and digits count only in a text that has
nothing else.  Every language has n-gram counts up to ``ORDER`` from a bounded
sample of its rows; the interpolated probabilities are worked out once and kept
in arrays sorted by n-gram key, one column per language.  A lookup is a binary
search; what the highest order does not hold backs off with the context's
weight.  The language with the lowest cross-entropy per character wins.

``score`` is the winner's share of exp(-scale * n * cross-entropy) with the scale
fitted on rows kept out of the counts.  Those rows also give the mean and the
spread of the right language's cross-entropy; a text whose best
cross-entropy lies beyond ``slack`` times the largest spread seen is rejected.

A null text, or one without a letter, is ``und``: score 0, rejected.  So is every text
if there is nothing to learn from.  Rows without an id or lang are never
learnt from; repeated rows are each predicted.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meteora.llm.common import with_text_columns

ORDER = 4
#: Rows per language that a model learns from at most, and their longest text.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 20_000
SLACK = 2.0
#: Classes of characters: padding, start, end, any letter not learnt.
PAD, START, END, OTHER = 0, 1, 2, 3
BITS = 15
TOKENS, LETTERS = re.compile(r"[^\W_]+"), re.compile(r"[^\W\d_]+")


def letter_runs(text: str, mixed: bool = False) -> list[str]:
    """Words of letters alone; with ``mixed`` also the letters next to digits."""
    if mixed:
        return [w for w in LETTERS.findall(text.lower()) if any(map(str.isalpha, w))]
    return [w for w in TOKENS.findall(text.lower()) if w.isalpha()]


def keys(words: list[str], classes: dict[str, int], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of the ``order``-gram that ends at each symbol, and each word's number of symbols."""
    lens = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    pad = [PAD] * (order - 2) + [START]
    flat = np.fromiter((c for w in words for c in (*pad, *(classes.get(x, OTHER) for x in w), END)), np.int64,
                       int(lens.sum()) + len(words) * len(pad))
    ends = np.cumsum(lens + len(pad))
    symbol = np.ones(len(flat), bool)
    for i in range(len(pad)):
        symbol[ends - lens - 1 - i] = False
    key = np.zeros(len(flat), np.int64)
    for back in range(order):
        shifted = flat if back == 0 else np.concatenate([np.zeros(back, np.int64), flat[:-back]])
        key |= shifted << (BITS * back)
    return key[symbol], lens


def find(sorted_keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the wanted keys, -1 where absent."""
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == wanted, at, -1)


def last(key: np.ndarray, n: int) -> np.ndarray:
    """The last n symbols of n-gram keys."""
    return key & ((1 << (BITS * n)) - 1)


@dataclass
class Tables:
    """By order: n-gram keys with log probabilities, context keys with log weights."""

    classes: dict[str, int]
    langs: list[str]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    contexts: dict[int, tuple[np.ndarray, np.ndarray]]

    def log_prob(self, key: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of the last symbol of each key, a column per language."""
        if order == 1:
            return self.grams[1][1][last(key, 1)]
        sorted_keys, values = self.grams[order]
        at = find(sorted_keys, last(key, order))
        out = values[at]
        miss = np.nonzero(at < 0)[0]
        if len(miss):
            sorted_contexts, weights = self.contexts[order]
            c = find(sorted_contexts, last(key[miss], order) >> BITS)
            out[miss] = np.where(c[:, None] < 0, 0.0, weights[c]) + self.log_prob(key[miss], order - 1)
        return out


def kneser_ney(counts: list[tuple[np.ndarray, np.ndarray]], classes: dict[str, int], langs: list[str]) -> Tables:
    """Tables from each language's (n-gram keys, counts) of the highest order."""
    n_classes = max(classes.values(), default=OTHER) + 1
    by_order = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):  # continuation counts: different symbols before
        by_order[n] = [np.unique(last(k, n), return_counts=True) for k, _ in by_order[n + 1]]
    unigram = np.zeros((n_classes, len(langs)))
    for i, (k, c) in enumerate(by_order[1]):
        p = np.full(n_classes, 1.0)
        p[k] += c
        unigram[:, i] = np.log(p / p.sum())
    t = Tables(classes, langs, {1: (np.arange(n_classes), unigram)}, {})
    for n in range(2, ORDER + 1):
        grams = np.unique(np.concatenate([k for k, _ in by_order[n]]))
        contexts = np.unique(grams >> BITS)
        weight = np.zeros((len(contexts), len(langs)))
        own = np.zeros((len(grams), len(langs)))
        of = find(contexts, grams >> BITS)
        for i, (k, c) in enumerate(by_order[n]):
            ones, twos = int((c == 1).sum()), int((c == 2).sum())
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            at = np.searchsorted(contexts, k >> BITS)
            total = np.bincount(at, c, len(contexts))
            kinds = np.bincount(at, minlength=len(contexts))
            seen = total > 0
            weight[seen, i] = np.log(discount * kinds[seen] / total[seen])
            own[np.searchsorted(grams, k), i] = (c - discount) / total[at]
        lower = t.log_prob(grams, n - 1)
        t.contexts[n] = (contexts, weight)
        t.grams[n] = (grams, np.log(own + np.exp(weight[of] + lower)))
    return t


@dataclass
class LanguageModel:
    tables: Tables | None
    scale: float = 1.0
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    limit: float = 0.0

    def entropies(self, texts, mixed: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each text, and its cross-entropy (nats a symbol) in each language."""
        split = pc.ascii_split_whitespace(texts)
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        runs = [letter_runs(w, mixed) for w in coded.dictionary.to_pylist()]
        words = [w for r in runs for w in r]
        kinds, langs = len(runs), len(self.tables.langs)
        per = np.zeros((kinds + 1, langs + 1))
        if words:
            key, lens = keys(words, self.tables.classes, ORDER)
            starts = np.cumsum(lens) - lens
            value = np.column_stack([np.add.reduceat(self.tables.log_prob(key), starts, axis=0), lens])
            np.add.at(per, np.repeat(np.arange(kinds), [len(r) for r in runs]), value)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        ends = offsets - offsets[0]
        total = np.zeros((len(texts), langs + 1))
        some = np.nonzero(np.diff(ends))[0]
        if len(some):
            total[some] = np.add.reduceat(per[codes], ends[:-1][some], axis=0)
        n = total[:, -1]
        return n, -total[:, :-1] / np.maximum(n, 1)[:, None]

    def strangeness(self, n: np.ndarray, best: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """How many spreads the best cross-entropy lies above that language's mean."""
        return (best - self.mean[lang]) / (self.spread[lang] * np.sqrt(1 + 40 / np.maximum(n, 1)))

    def predict(self, texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        if self.tables is None:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        n, h = self.entropies(texts)
        bare = np.nonzero(n == 0)[0]
        if len(bare):
            n[bare], h[bare] = self.entropies(texts.take(pa.array(bare)), mixed=True)
        best = h.argmin(axis=1)
        low = h[np.arange(len(h)), best]
        score = 1 / np.exp(-self.scale * n[:, None] * (h - low[:, None])).sum(axis=1)
        none = n == 0
        rejected = none | (self.strangeness(n, low, best) > self.limit)
        return ["und" if e else self.tables.langs[b] for b, e in zip(best, none, strict=True)], np.where(none, 0.0, score), rejected


def fit_rows(rows: list[tuple[str, str]], slack: float = SLACK) -> LanguageModel:
    """A model from (lang, text) rows in a fixed order; every fifth calibrates."""
    counted = [(lang, Counter(letter_runs(t))) for lang, t in rows]
    counted = [(lang, c) for lang, c in counted if c]
    langs = sorted({lang for lang, _ in counted})
    if not langs:
        return LanguageModel(None)
    position, kept, learn = Counter(), [], {lang: Counter() for lang in langs}
    for (lang, c) in counted:
        position[lang] += 1
        if position[lang] % 5 == 0:
            kept.append((lang, c))
        else:
            learn[lang].update(c)
    letters = Counter(x for c in learn.values() for w, k in c.items() for x in w for _ in range(min(k, 2)))
    classes = {x: OTHER + 1 + i for i, x in enumerate(sorted(x for x, k in letters.items() if k > 1)[: (1 << BITS) - OTHER - 2])}
    counts = []
    for lang in langs:
        words, times = list(learn[lang]), np.fromiter(learn[lang].values(), np.int64)
        key, lens = keys(words, classes, ORDER)
        own, at = np.unique(key, return_inverse=True)
        counts.append((own, np.bincount(at, np.repeat(times, lens)).astype(np.int64)))
    model = LanguageModel(kneser_ney(counts, classes, langs))
    check = kept or counted
    n, h = model.entropies(pa.array([" ".join(w for w, k in c.items() for _ in range(k)) for _, c in check], pa.string()))
    right = np.array([langs.index(lang) for lang, _ in check])
    own = h[np.arange(len(h)), right]
    # rows that fit another language better are taken as mislabelled: one would lift the limit, or the spread, above any text
    sure = h.argmin(axis=1) == right
    sure |= not sure.any()
    every = own[sure].mean()
    mine = [sure & (right == i) for i in range(len(langs))]
    model.mean = np.array([own[m].mean() if m.any() else every for m in mine])
    deviation = (own - model.mean[right]) / np.sqrt(1 + 40 / n)
    model.spread = np.array([max(deviation[m].std() if m.sum() > 2 else 0.0, 0.06 * every) for m in mine])
    model.limit = slack * max(6.0, float(model.strangeness(n, own, right)[sure].max()))
    gap = n[:, None] * (h - own[:, None])
    loss = lambda s: np.log(np.exp(np.minimum(-s * gap, 500)).sum(axis=1)).mean()
    model.scale = float(min(np.geomspace(0.01, 1, 60), key=loss))
    return model


def fit(docs: DataFrame, learn_from: Column, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """A model from rows for which ``learn_from`` (over doc_id) holds: at most
    ``sample_rows`` per language, in the order of a hash of the id.  Texts of over
    ``sample_chars`` characters fill up a language if the others do not, shortest first and
    whole: the first, and then those that fit in ``sample_rows * sample_chars`` bytes together."""
    able = docs.select("doc_id", "lang", "text").where("doc_id is not null and lang is not null and text is not null").where(
        learn_from).withColumn("over", F.greatest(F.length("text") - sample_chars, F.lit(0)))
    first = Window.partitionBy("lang").orderBy("over", F.xxhash64("doc_id"), "doc_id")
    so_far = first.rowsBetween(Window.unboundedPreceding, 0)
    long_bytes = F.when(F.col("over") > 0, F.col("bytes").cast("long")).otherwise(0)
    chosen = able.select("doc_id", "lang", "over", F.octet_length("text").alias("bytes")).withColumn("no", F.row_number().over(first)).where(
        F.col("no") <= sample_rows).withColumn("used", F.sum(long_bytes).over(so_far)).where(
        f"over = 0 or used = bytes or used <= {sample_rows * sample_chars}")
    # at most ``sample_rows`` rows per language
    got = able.join(F.broadcast(chosen.select("doc_id", "lang", "over").distinct()), ["doc_id", "lang", "over"]).dropDuplicates(["doc_id", "lang"]).orderBy(
        F.xxhash64("doc_id"), "doc_id").collect()
    return fit_rows([(r["lang"], r["text"]) for r in got])


def with_language(docs: DataFrame, model: LanguageModel, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``."""
    def make():
        def f(texts):
            lang, score, rejected = model.predict(texts)
            return [lang, score, rejected]
        return f
    return with_text_columns(docs, [("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")], make, keep_text=keep_text)
