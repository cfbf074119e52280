"""Quality rules: repetition coverage by rolling hashes of several n-gram lengths.

For each length n a 64-bit polynomial hash rolls over the words of a text; words
inside a window whose hash occurs twice or more in the text (the first occurrence
included) are covered, and their characters are counted.  Lines that
equal an earlier line of the text count with their characters too.  A text
whose covered share is above a limit is not kept.

Words are runs of anything but ASCII white space.  Null text counts as empty: no words, failed
base rule, not kept.  Repeated rows are each measured; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from meteora.llm.common import with_text_columns

#: Most characters, as a share of those in words, inside windows of n words that repeat.
NGRAM_LIMITS = {5: 0.30, 7: 0.26, 10: 0.20}
#: Most characters, as a share of those in lines, inside lines that equal an earlier one.
LINE_LIMIT = 0.20
MIN_WORDS = 50
BASE_WINDOW = 3
FIELDS = [("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"),
          ("base_failed", "boolean"), ("kept", "boolean"), *((f"dup_chars_{n}", "bigint") for n in NGRAM_LIMITS),
          ("dup_line_chars", "bigint"), ("line_chars", "bigint")]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def covered(hashes: np.ndarray, doc: np.ndarray, n: int, upto: np.ndarray) -> np.ndarray:
    """Which words lie in a window of n words that repeats in its text.

    ``hashes`` are window hashes by first word; ``upto`` is the end of each word's text.
    """
    out = np.zeros(len(doc) + 1, np.int64)
    whole = np.nonzero(np.arange(len(doc)) + n <= upto)[0]
    if len(whole):
        # other numbers than those of the words, whose hashes are sums of the same function
        key = mix(hashes[whole] + mix(doc[whole].astype(np.uint64) + np.uint64(1 << 62)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        repeats = np.zeros(len(whole), bool)
        repeats[1:] |= same
        repeats[:-1] |= same
        starts = whole[order[repeats]]
        np.add.at(out, starts, 1)
        np.add.at(out, starts + n, -1)
    return np.cumsum(out[:-1]) > 0


def measure(texts: pa.StringArray) -> list[np.ndarray]:
    """The arrays of ``FIELDS`` for a slice of texts."""
    rows = len(texts)
    split = pc.ascii_split_whitespace(texts)
    offsets = split.offsets.to_numpy().astype(np.int64)
    words = split.flatten()
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    ends = np.concatenate([[0], np.cumsum(real)])[offsets - offsets[0]]
    coded = words.filter(real).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    n_words = np.diff(ends)
    doc = np.repeat(np.arange(rows), n_words)
    chars = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    symbols = pc.count_substring_regex(coded.dictionary, "[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    per_text = lambda v: np.bincount(doc, v, rows).astype(np.int64)
    word_hash = mix(np.arange(1, len(coded.dictionary) + 1, dtype=np.uint64))[codes]
    upto = ends[1:][doc]
    base, factor = np.uint64(0x9E3779B97F4A7C15), np.uint64(1)
    rolling, power, length, found = np.zeros(len(codes), np.uint64), factor, 0, {}
    for n in sorted({BASE_WINDOW, *NGRAM_LIMITS}):
        while length < n:  # one more word: its hash times the next power of the base
            rolling[: max(len(codes) - length, 0)] += word_hash[length:] * power
            with np.errstate(over="ignore"):
                power = power * base
            length += 1
        found[n] = covered(rolling, doc, n, upto)
    lines = pc.split_pattern(texts, "\n")
    line_doc = np.repeat(np.arange(rows), np.diff(lines.offsets.to_numpy().astype(np.int64)))
    coded_lines = lines.flatten().dictionary_encode()
    own = coded_lines.dictionary
    has_word = pc.binary_length(pc.ascii_trim_whitespace(own)).to_numpy(zero_copy_only=False) > 0
    line_codes = coded_lines.indices.to_numpy(zero_copy_only=False)
    key = line_doc.astype(np.int64) << 32 | line_codes
    later = np.ones(len(key), bool)
    later[np.unique(key, return_index=True)[1]] = False
    worded = has_word[line_codes]
    length_of = pc.utf8_length(own).to_numpy(zero_copy_only=False).astype(np.int64)[line_codes]
    in_lines = lambda v: np.bincount(line_doc, v, rows).astype(np.int64)
    dup_line_chars, line_chars = in_lines(length_of * (later & worded)), in_lines(length_of * worded)
    word_chars, repeat = per_text(chars), per_text(found[BASE_WINDOW])
    failed = (n_words < MIN_WORDS) | (100 * repeat > 50 * n_words)
    dup = [per_text(chars * found[n]) for n in NGRAM_LIMITS]
    kept = ~failed & (dup_line_chars <= LINE_LIMIT * line_chars)
    for d, limit in zip(dup, NGRAM_LIMITS.values(), strict=True):
        kept &= d <= limit * word_chars
    return [n_words, word_chars, per_text(symbols), in_lines(later & worded), repeat, failed, kept, *dup, dup_line_chars, line_chars]


def with_rules(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept``."""
    return with_text_columns(docs, FIELDS, lambda: measure, keep_text=keep_text)


def oracle_sql() -> str:
    """The same in DuckDB SQL over ``documents``."""
    lengths = sorted({BASE_WINDOW, *NGRAM_LIMITS})
    gram = lambda n: " || ' ' || ".join(["w", *(f"lead(w, {i}) OVER (PARTITION BY id ORDER BY pos)" for i in range(1, n))])
    grams = ", ".join(f"{gram(n)} AS g{n}" for n in lengths)
    flags = ", ".join(f"g{n} IS NOT NULL AND count(*) OVER (PARTITION BY id, g{n}) > 1 AS d{n}" for n in lengths)
    cover = ", ".join(f"bool_or(d{n}) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in lengths)
    sums = ", ".join(f"CAST(coalesce(sum(length(w)) FILTER (c{n}), 0) AS BIGINT) AS dup_chars_{n}" for n in NGRAM_LIMITS)
    limits = " AND ".join(f"coalesce(dup_chars_{n}, 0) <= CAST({x} AS DOUBLE) * word_chars" for n, x in NGRAM_LIMITS.items())
    dups = ", ".join(f"coalesce(dup_chars_{n}, 0) AS dup_chars_{n}" for n in NGRAM_LIMITS)
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
lists AS (SELECT id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS l FROM docs),
words AS (SELECT id, unnest(l) AS w, generate_subscripts(l, 1) AS pos FROM lists),
grams AS (SELECT id, pos, w, {grams} FROM words),
flags AS (SELECT id, pos, w, {flags} FROM grams),
cover AS (SELECT id, w, {cover} FROM flags),
per_text AS (SELECT id, count(*) AS n_words, CAST(sum(length(w)) AS BIGINT) AS word_chars,
    CAST(sum(length(regexp_replace(w, '[^#*$%&|<>]', '', 'g'))) AS BIGINT) AS n_symbols,
    count(*) FILTER (c{BASE_WINDOW}) AS n_repeat_words, {sums} FROM cover GROUP BY id),
split AS (SELECT id, string_split(text, chr(10)) AS l FROM docs),
lines AS (SELECT id, unnest(l) AS s, generate_subscripts(l, 1) AS pos FROM split),
worded AS (SELECT id, s, row_number() OVER (PARTITION BY id, s ORDER BY pos) > 1 AS later FROM lines WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
per_lines AS (SELECT id, count(*) FILTER (later) AS n_dup_lines, CAST(coalesce(sum(length(s)) FILTER (later), 0) AS BIGINT) AS dup_line_chars,
    CAST(sum(length(s)) AS BIGINT) AS line_chars FROM worded GROUP BY id),
counts AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, coalesce(n_symbols, 0) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, {dups},
    coalesce(dup_line_chars, 0) AS dup_line_chars, coalesce(line_chars, 0) AS line_chars
    FROM docs LEFT JOIN per_text USING (id) LEFT JOIN per_lines USING (id))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)
    AND dup_line_chars <= CAST({LINE_LIMIT} AS DOUBLE) * line_chars AND {limits} AS kept
FROM counts
"""
