"""Byte-pair encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be merged over,
so a cut between its bytes is certain.  Texts are cut at such pairs, the
distinct fragments of a slice of texts are encoded once each with the
tokenizers library, and the ids are laid end to end.

A certain cut must not change where the pre-tokenizer splits elsewhere
either.  Cuts are therefore left out inside a character, between white space
(or a byte that may end a wide space) and something else, because a run of
white space gives its last character to what follows, and before an
apostrophe, because contractions are matched before punctuation runs.
Strings of special tokens become their ids, as the library does by default; a vocabulary whose special
tokens take white space or whole words with them is refused.

Null text counts as empty and has no ids.  Whole texts are encoded, whatever their length; repeated rows each, an
empty table gives an empty result.  Columns named like a new one are replaced.  The vocabulary file is a parameter.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meteora.llm.common import with_text_columns

SLICE_BYTES = 2 << 20
#: Rows decoded at a time.
DECODE_ROWS = 256
#: Fragments a worker remembers at most (about 15 MB).
KNOWN_FRAGMENTS = 100_000
#: Fragments the library gets as one text.
JOINED = 500
#: The same two bounds for jobs with nothing else in a worker's memory (about 120 MB with the slice's arrays).
WIDE = (4 << 20, 500_000)


def byte_characters() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1
    stands for itself, the others follow from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, most_known: int = KNOWN_FRAGMENTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        # fragments met lately by number, in order; their ids laid end to end, and how many each has
        self.most_known, self.known, self.known_ids, self.known_len = most_known, {}, array("I"), array("I")
        if any(x.get(k) for x in file.get("added_tokens") or [] for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError(f"{path}: special tokens with lstrip, rstrip or single_word")
        self.special = {x["content"]: x["id"] for x in file.get("added_tokens") or []}
        self.special_re = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        of = byte_characters()
        tokens = {i: bytes(of[c] for c in t) for t, i in file["model"]["vocab"].items() if t not in self.special}
        tokens |= {i: t.encode() for t, i in self.special.items()}
        # tokens as one byte string with starts and lengths, for decoding
        n = max(tokens) + 1
        self.token_len = np.array([len(tokens.get(i, b"")) for i in range(n)], np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.token_bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(n)), np.uint8)
        self.may_cut = self._cut_table(t for i, t in tokens.items() if i not in self.special.values())

    @staticmethod
    def _cut_table(tokens) -> np.ndarray:
        """For each pair of bytes (first * 256 + second): is a cut certain there?"""
        cut = np.ones((256, 256), bool)
        for t in tokens:
            b = np.frombuffer(t, np.uint8)
            cut[b[:-1], b[1:]] = False
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        cut[:, 0x80:0xC0] = False  # inside a character
        left = space.copy()
        left[0x1C:0x20] = left[0x80:] = True
        cut[np.ix_(left, ~space)] = False
        cut[:, ord("'")] = False
        return cut.reshape(-1)

    def _segments(self, texts: pa.StringArray):
        """Texts cut at special strings: arrow texts, each one's row, and whether it is special."""
        if self.special_re is not None:
            found = [bool(self.special_re.search(t)) for t in texts.to_pylist()] if any(
                pa.compute.any(pa.compute.match_substring(texts, s)).as_py() for s in self.special) else []
            if any(found):
                parts, rows = [], []
                for i, t in enumerate(texts.to_pylist()):
                    own = [x for x in self.special_re.split(t) if x] if found[i] else [t]
                    parts += own
                    rows += [i] * len(own)
                return pa.array(parts, pa.string()), np.array(rows, np.int64), np.array([x in self.special for x in parts], bool)
        return texts, np.arange(len(texts)), np.zeros(len(texts), bool)

    def _fragment_ids(self, fragments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids laid end to end, and where those of each fragment start and how many they are."""
        if len(self.known) > self.most_known:  # the older half goes
            gone = len(self.known) // 2
            self.known = {x: i - gone for x, i in self.known.items() if i >= gone}
            self.known_ids = self.known_ids[sum(self.known_len[:gone]):]
            self.known_len = self.known_len[gone:]
        known, ids, lens = self.known, self.known_ids, self.known_len
        new = [x for x in fragments if x not in known and x not in self.special]
        self._learn(new)
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        for x, i in self.special.items():  # only a special string in a text gives such a fragment
            if x not in known:
                known[x] = len(known)
                ids.append(i)
                lens.append(1)
        at = np.fromiter(map(known.__getitem__, fragments), np.int64, len(fragments))
        length = np.array(lens, np.int64)
        return np.array(ids, np.uint32), (np.cumsum(length) - length)[at], length[at]

    def _learn(self, new: list[str]) -> None:
        """Append the ids of fragments that hold no special string.

        Many fragments go to the library as one text, apart by a special token: it splits texts
        there before anything else, so each fragment is encoded as alone.
        """
        if self.special:
            mark, number = next(iter(self.special.items()))
            texts = [mark.join([*new[i: i + JOINED], ""]) for i in range(0, len(new), JOINED)]
            for e in self.model.encode_batch_fast(texts, add_special_tokens=False):
                own = np.array(e.ids, np.uint32)
                ends = np.nonzero(own == number)[0]
                self.known_len.frombytes((np.diff(ends, prepend=-1) - 1).astype(np.uint32).tobytes())
                self.known_ids.frombytes(np.delete(own, ends).tobytes())
            return
        for e in self.model.encode_batch_fast(new, add_special_tokens=False):
            self.known_ids.extend(e.ids)
            self.known_len.append(len(e.ids))

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) laid end to end, and the number of ids of each text."""
        segments, rows, special = self._segments(texts)
        counts = np.zeros(len(texts), np.int64)
        offsets = np.frombuffer(segments.buffers()[1], np.int32)[segments.offset: segments.offset + len(segments) + 1].astype(np.int64)
        if len(segments) == 0 or offsets[-1] == offsets[0]:
            return np.zeros(0, np.uint32), counts
        data = np.frombuffer(segments.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
        offsets -= offsets[0]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = self.may_cut[data[:-1].astype(np.uint16) * 256 + data[1:]]
        for i in np.nonzero(special)[0]:
            cut[offsets[i]: offsets[i + 1]] = False
        cut[offsets] = True
        at = np.nonzero(cut)[0]
        fragments = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        flat, starts, lens = self._fragment_ids(fragments.dictionary.to_pylist())
        codes = fragments.indices.to_numpy(zero_copy_only=False)
        ids = gather(flat, starts[codes], lens[codes])
        ends = np.concatenate([[0], np.cumsum(lens[codes])])
        by_segment = np.diff(ends[np.searchsorted(at, offsets)])
        np.add.at(counts, rows, by_segment)
        return ids, counts

    def decode(self, ids: np.ndarray) -> str:
        raw = gather(self.token_bytes, self.token_at[ids], self.token_len[ids])
        return raw.tobytes().decode("utf-8", "replace")


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + len], laid end to end."""
    before = np.cumsum(lens) - lens
    return flat[np.repeat(starts - before, lens) + np.arange(int(lens.sum()))]


@functools.lru_cache(maxsize=2)
def codec(path: str, most_known: int = KNOWN_FRAGMENTS) -> Codec:
    """One codec per Python worker."""
    return Codec(path, most_known)


def _runs(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    raw, ends = ids.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def encode(docs: DataFrame, path: str, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    def make():
        c = codec(path)

        def f(texts):
            ids, counts = c.encode(texts)
            return [counts, pa.array(_runs(ids, counts), pa.binary())]
        return f
    return with_text_columns(docs, [("n_tokens", "bigint"), ("ids", "binary")], make, keep_text=keep_text, slice_bytes=SLICE_BYTES)


def round_trip(docs: DataFrame, path: str, wide: bool = False) -> DataFrame:
    """``encode`` with the ``decoded`` text of the ids beside them, in one pass.

    ``wide``: the larger bounds of ``WIDE`` for a worker's memory.
    """
    most = WIDE[1] if wide else KNOWN_FRAGMENTS

    def make():
        c = codec(path, most)

        def f(texts):
            ids, counts = c.encode(texts)
            ends = np.cumsum(counts).tolist()
            return [counts, pa.array(_runs(ids, counts), pa.binary()),
                    pa.array([c.decode(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)], pa.string())]
        return f
    fields = [("n_tokens", "bigint"), ("ids", "binary"), ("decoded", "string")]
    return with_text_columns(docs, fields, make, keep_text=False, slice_bytes=SLICE_BYTES)


def decode(coded: DataFrame, path: str) -> DataFrame:
    """``coded`` with its ``ids`` replaced by the ``decoded`` text (null ids: empty)."""
    keep = [c for c in coded.columns if c not in ("ids", "decoded")]
    coded = coded.select(*keep, "ids")
    schema = coded.select(*keep).schema.add("decoded", "string")

    def run(batches):
        c = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, DECODE_ROWS):
                b = batch.slice(at, DECODE_ROWS)
                texts = [c.decode(np.frombuffer(x or b"", "<u4")) for x in b.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays(b.columns[:-1] + [pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return coded.mapInArrow(run, schema)
