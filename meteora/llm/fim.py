"""Fill-in-middle transformation with a piecewise-linear learned rank index.

A text of n units (lines by default) has n + 1 boundaries.  The offsets of all
boundaries of a slice of texts are learnt as a function of their rank: straight
segments, each grown while one line stays within ``ERROR`` bytes of every offset it
covers.  A cut is predicted from its segment and corrected by the residual
stored for its rank, which makes it exact.  Residuals take two bytes each, segments three numbers.

Cuts, form and order follow from a hash of the seed and the row's id, so a task run
again gives the same rows.  ``restore`` rebuilds the text from output and form alone:
a text that contains a marker stays plain, and markers can't arise across a joint, because
none begins with the last or ends with the first character of another.

Null text counts as empty and is plain.  A null id is hashed as an empty one.  Repeated rows are
transformed alike; an empty table gives an empty result.  Whole texts are cut, whatever their length.
Other columns pass through; those named like a new one are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteora.llm.common import SLICE_BYTES, release, text_slices

#: Largest distance, in bytes, of a learnt offset from the true one.
ERROR = 128
#: Boundaries a segment is first tried on; doubled while it holds.
STEP = 64
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIELDS = [("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"), ("output", "string")]


class RankIndex:
    """Ascending offsets by rank, as error-bounded segments and residuals."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        first, slopes, at, n = [], [], 0, len(offsets)
        while at < n:
            end, slope = self._segment(offsets, at, error)
            first.append(at)
            slopes.append(slope)
            at = end
        self.first = np.array(first, np.int64)
        self.start = offsets[self.first] if n else np.zeros(0, np.int64)
        self.slope = np.array(slopes, np.float64)
        self.residual = np.zeros(n, np.int16)
        self.residual = (offsets - self.lookup(np.arange(n))).astype(np.int16)

    @staticmethod
    def _segment(offsets: np.ndarray, at: int, error: int) -> tuple[int, float]:
        """The end of the longest segment from rank ``at``, and its slope."""
        low, high, done, step = 0.0, np.inf, at + 1, STEP
        while done < len(offsets):
            part = offsets[done: done + step] - offsets[at]
            run = np.arange(done - at, done - at + len(part))
            lows = np.maximum(np.maximum.accumulate((part - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((part + error) / run), high)
            bad = np.nonzero(lows > highs)[0]
            good = int(bad[0]) if len(bad) else len(part)
            if good:
                low, high = float(lows[good - 1]), float(highs[good - 1])
            done += good
            if len(bad):
                break
            step *= 2
        return done, (low + high) / 2 if np.isfinite(high) else 0.0

    def lookup(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of ``ranks``."""
        if len(self.first) == 0:
            return np.zeros(len(ranks), np.int64)
        s = np.searchsorted(self.first, ranks, "right") - 1
        return self.start[s] + np.rint(self.slope[s] * (ranks - self.first[s])).astype(np.int64) + self.residual[ranks]


def line_boundaries(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of all boundaries of texts laid end to end (0, then the end of each unit),
    and the number of units of each text.  ``ends`` are the ends of the texts."""
    after = np.nonzero(data == 10)[0] + 1
    offsets = np.union1d(np.append(after, 0), ends)
    ranks = np.searchsorted(offsets, ends)
    return offsets, np.diff(ranks, prepend=0)


def _transform(texts: pa.StringArray, h: np.ndarray, rate: int, spm_rate: int) -> list:
    rows = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + rows + 1].astype(np.int64)
    raw = memoryview(texts.buffers()[2])[at[0]: at[-1]] if at[-1] > at[0] else memoryview(b"")
    at -= at[0]
    offsets, n = line_boundaries(np.frombuffer(raw, np.uint8), at[1:])
    index = RankIndex(offsets)
    base = np.cumsum(n) - n
    picks = h[:, :2] % (n + 1)[:, None]
    cuts = [index.lookup(base + c) for c in (picks.min(1), picks.max(1))]
    marked = np.zeros(rows, bool)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.match_substring(texts, m).to_numpy(zero_copy_only=False)
    plain = (n == 0) | marked | (h[:, 2] % 100 >= rate)
    spm = h[:, 3] % 100 < spm_rate
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    form, out, prefixes, middles = [], [], [], []
    for i, (a, b, c, d) in enumerate(zip(at[:-1].tolist(), cuts[0].tolist(), cuts[1].tolist(), at[1:].tolist(), strict=True)):
        if plain[i]:
            form.append("plain")
            out.append(bytes(raw[a:d]))
            prefixes.append(None)
            middles.append(None)
            continue
        prefix, middle, suffix = bytes(raw[a:b]), bytes(raw[b:c]), bytes(raw[c:d])
        form.append("spm" if spm[i] else "psm")
        out.append(s + suffix + p + prefix + m + middle if spm[i] else p + prefix + s + suffix + m + middle)
        prefixes.append(prefix)
        middles.append(middle)
    chars = [pc.utf8_length(pa.array(x, pa.binary()).cast(pa.string())).cast(pa.int64()) for x in (prefixes, middles)]
    return [pa.array(n, pa.int64()), pa.array(form, pa.string()), *chars, pa.array(out, pa.binary()).cast(pa.string())]


def transform(docs: DataFrame, seed: int, rate: int = 100, spm_rate: int = 50, keep_text: bool = False) -> DataFrame:
    """``docs`` with the columns of ``FIELDS``.

    ``rate``: of 100 texts, so many are cut; ``spm_rate``: of 100 cut ones, so many begin with the suffix.
    """
    names = [x for x, _ in FIELDS]
    kept = [c for c in docs.columns if c not in names]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    numbers = F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])
    df = docs.select(*[F.col(f"`{c}`") for c in kept], numbers.alias("__numbers"))
    there = [i for i, c in enumerate(kept) if c != "text" or keep_text]
    schema = T.StructType([df.schema.fields[i] for i in there] + [T.StructField(x, T._parse_datatype_string(t)) for x, t in FIELDS])

    def run(batches):
        for batch in batches:
            for part, texts in text_slices(batch, "text", SLICE_BYTES):
                h = part.column(len(kept)).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([part.column(i) for i in there] + _transform(texts, h, rate, spm_rate),
                                                 names=[kept[i] for i in there] + names)
        release()

    return df.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text, rebuilt from output and form."""
    def between(after: str, before: str | None) -> Column:
        rest = F.substring_index(output, after, -1)
        return F.substring_index(rest, before, 1) if before else rest

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def oracle_sql(seed: int = 7, rate: int = 100, spm_rate: int = 50) -> str:
    """The registered query in DuckDB SQL."""
    number = lambda i: f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)"
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
    sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cuts AS (SELECT *, len(l) AS n, {number(0)} % (len(l) + 1) AS c1, {number(1)} % (len(l) + 1) AS c2,
    CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR {number(2)} % 100 >= {rate} THEN 'plain'
         WHEN {number(3)} % 100 < {spm_rate} THEN 'spm' ELSE 'psm' END AS form FROM docs),
parts AS (SELECT *, array_to_string(l[1:least(c1, c2)], '') AS p, array_to_string(l[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
    array_to_string(l[greatest(c1, c2) + 1:n], '') AS s FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
           ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""
