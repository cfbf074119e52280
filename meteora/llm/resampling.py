"""Importance resampling towards a target, with segments counted once.

A text's features are its words and runs of consecutive words; each falls into one of a
fixed number of buckets.  No word contains a line break, so texts are cut into lines there: the
corpus counts group equal lines first, and the features of each distinct line are counted once and multiplied
by its occurrences.  Runs that cross a line break belong to no line and are added separately, from whole texts.
Only sums per bucket leave the tasks.  Equal lines of a slice also share their weight when documents are weighed.

A bucket's gain is a scaled log ratio of its share in the target and in the corpus; a document's
weight is the sum of its features' gains.  Weight plus Gumbel noise from a hash of the id gives a score; the highest
scores are a draw without replacement in proportion to exp(weight / SCALE).  Ranks come from
range partitions of the scores, numbered inside each and shifted by the rows before, with no task that sees all rows.

Null text has no words, weight 0.  A null id is hashed as an empty one and ranks before others of its score.
Repeated rows are scored and drawn each.  An empty corpus gives no rows; an empty target gives gains all the same.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteora.llm.common import SLICE_BYTES, release, stored, text_slices, with_text_columns

SCALE = 1000
#: Rows ranked together.
RANK_ROWS = 1 << 20
#: Of each byte: what it becomes in lower case, and whether it belongs to a word.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True


def words_of(texts: pa.StringArray) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """The words of all texts laid end to end, each one's text, and the byte it starts at."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    if at[-1] == at[0]:
        return pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[at[0]: at[-1]]]
    at -= at[0]
    inside = WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < len(data)]
    first[heads] = inside[heads]
    starts = np.nonzero(first)[0]
    # a word ends where the bytes of words before the next start end
    before = np.cumsum(inside)
    packed = data[inside]
    offsets = np.append(before[starts] - 1, len(packed)).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    return words, np.searchsorted(at, starts, "right") - 1, starts


def bucket_of(features: pa.BinaryArray, buckets: int) -> np.ndarray:
    """The bucket of each feature; the hash of equal ones is computed once."""
    coded = features.dictionary_encode()
    of = np.fromiter((zlib.crc32(x) % buckets for x in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
    return of[coded.indices.to_numpy(zero_copy_only=False)] if len(features) else np.zeros(0, np.int64)


def runs(words: pa.BinaryArray, n: int) -> pa.BinaryArray:
    """All runs of n consecutive words, joined by a space."""
    if n == 1:
        return words
    many = max(len(words) - n + 1, 0)
    return pc.binary_join_element_wise(*[words.slice(i, many) for i in range(n)], pa.scalar(b" ", pa.binary()))


def line_features(lines: pa.StringArray, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features inside each line, and the line of each."""
    words, line, _ = words_of(lines)
    found, of = [], []
    for n in range(1, longest + 1):
        whole = np.nonzero(line[: len(line) - n + 1] == line[n - 1:])[0] if len(line) >= n else np.zeros(0, np.int64)
        found.append(bucket_of(runs(words, n).take(pa.array(whole)), buckets) if n > 1 else bucket_of(words, buckets))
        of.append(line[whole])
    return np.concatenate(found), np.concatenate(of)


def crossing_features(texts: pa.StringArray, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features that cross a line break, and the text of each."""
    words, doc, starts = words_of(texts)
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0]: at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    line = np.searchsorted(np.nonzero(data == 10)[0], starts)
    found, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in range(2, longest + 1):
        if len(doc) >= n:
            m = len(doc) - n + 1
            across = np.nonzero((doc[:m] == doc[n - 1:]) & (line[:m] != line[n - 1:]))[0]
            found.append(bucket_of(runs(words, n).take(pa.array(across)), buckets))
            of.append(doc[across])
    return np.concatenate(found), np.concatenate(of)


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features per bucket over all rows of ``texts`` (column text)."""
    lines = texts.select(F.explode(F.split(F.col("text"), "\n")).alias("text")).where("text != ''")
    distinct = lines.groupBy("text").agg(F.count("*").alias("times"))
    schema = "bucket long, n long"

    def total(features):
        def run(batches):
            sums = np.zeros(buckets, np.int64)
            for batch in batches:
                for part, rows in text_slices(batch, "text", SLICE_BYTES):
                    found, of = features(rows, longest, buckets)
                    times = part.column(1).to_numpy(zero_copy_only=False)[of]
                    np.add.at(sums, found, times)
            some = np.nonzero(sums)[0]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["bucket", "n"])
            release()
        return run

    parts = distinct.mapInArrow(total(line_features), schema)
    if longest > 1:
        whole = texts.select("text", F.lit(1).cast("long").alias("times"))
        parts = parts.unionAll(whole.mapInArrow(total(crossing_features), schema))
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, from the counts of both sides."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = ((target + 1.0) * (s_all + buckets)) / ((corpus + 1.0) * (t_all + buckets))
    return np.array([math.floor(SCALE * math.log(x)) for x in ratio], np.int64)


def with_weights(docs: DataFrame, gain: np.ndarray, longest: int = 1) -> DataFrame:
    """``docs`` without text, with ``n_words``, ``n_features`` and ``weight``."""
    buckets = len(gain)

    def make():
        def f(texts):
            split = pc.split_pattern(texts, "\n")
            offsets = split.offsets.to_numpy().astype(np.int64)
            coded = split.flatten().dictionary_encode()
            words, line, _ = words_of(coded.dictionary)
            found, of = line_features(coded.dictionary, longest, buckets)
            per_line = [np.bincount(line, minlength=len(coded.dictionary)), np.bincount(of, minlength=len(coded.dictionary)),
                        np.zeros(len(coded.dictionary), np.int64)]
            np.add.at(per_line[2], of, gain[found])
            codes = coded.indices.to_numpy(zero_copy_only=False)
            out = []
            for v in per_line:
                sums = np.concatenate([[0], np.cumsum(v[codes])])
                out.append(sums[offsets[1:] - offsets[0]] - sums[offsets[:-1] - offsets[0]])
            if longest > 1:
                found, of = crossing_features(texts, longest, buckets)
                np.add.at(out[1], of, 1)
                np.add.at(out[2], of, gain[found])
            return out
        return f

    return with_text_columns(docs, [("n_words", "bigint"), ("n_features", "bigint"), ("weight", "bigint")], make, keep_text=False)


def _drawn(eligible: DataFrame, percent: int) -> DataFrame:
    """``eligible`` with ``rank`` by descending score, then doc_id, where it is drawn."""
    total = eligible.count()
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    ranged = eligible.repartitionByRange(max(1, -(-total // RANK_ROWS)), *order).withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    before, base = 0, []
    for r in sorted(ranged.groupBy("range").count().collect()):  # one row for RANK_ROWS documents
        base.append((r["range"], before))
        before += r["count"]
    shift = eligible.sparkSession.createDataFrame(base, "range int, base long")
    number = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    ranked = ranged.withColumn("no", number).join(F.broadcast(shift), "range").withColumn("rank", (F.col("no") + F.col("base")).cast("long"))
    return ranked.withColumn("rank", F.when(F.col("rank") <= total * percent // 100, F.col("rank"))).drop("range", "no", "base")


def resample(docs: DataFrame, target: DataFrame, seed: int, longest: int = 1, buckets: int = 10_000, percent: int = 10,
             min_words: int = 20) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank (null: not drawn).

    Of the documents with ``min_words`` words or more, ``percent`` of 100 are drawn.
    """
    docs = docs.select("doc_id", "text")
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target.select("text"), longest, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    scored = stored(with_weights(docs, gain, longest).withColumn("score", F.col("weight") + noise), "scored")
    few = F.col("n_words") < min_words
    return _drawn(scored.where(~few), percent).unionByName(scored.where(few).withColumn("rank", F.lit(None).cast("long")))


def oracle_sql(seed: int = 2024, buckets: int = 10_000, percent: int = 10, min_words: int = 20) -> str:
    """The registered query (single words) in DuckDB SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"
    return rf"""
WITH crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
docs AS (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents),
d AS (SELECT row_id, {words} AS w FROM docs),
t AS (SELECT {words} AS w FROM benchmark),
vocabulary AS (SELECT DISTINCT w FROM (SELECT w FROM d UNION ALL SELECT w FROM t)),
bytes AS (SELECT w, list_transform(range(CAST(octet_length(encode(w)) AS BIGINT)), lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)) AS b FROM vocabulary),
hashed AS (SELECT w, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % {buckets} AS bucket
    FROM bytes, crc_table),
s AS (SELECT bucket, count(*) AS n FROM d JOIN hashed USING (w) GROUP BY bucket),
tt AS (SELECT bucket, count(*) AS n FROM t JOIN hashed USING (w) GROUP BY bucket),
sums AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE AS s_all, coalesce((SELECT sum(n) FROM tt), 0)::DOUBLE AS t_all),
gains AS (SELECT s.bucket, CAST(floor({SCALE} * ln(((coalesce(tt.n, 0) + 1)::DOUBLE * (s_all + {buckets})) / ((s.n + 1)::DOUBLE * (t_all + {buckets})))) AS BIGINT) AS gain
    FROM s LEFT JOIN tt USING (bucket), sums),
weights AS (SELECT row_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM d JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY row_id),
scored AS (SELECT row_id, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-{SCALE}.0::DOUBLE * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
        / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM docs LEFT JOIN weights USING (row_id)),
ranked AS (SELECT row_id, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS FIRST) AS rank FROM scored WHERE n_features >= {min_words})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM ranked) * {percent} // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (row_id)
"""
