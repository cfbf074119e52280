import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meteora.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PIECES = ["a", "'s", "'", "'re", " ", "  ", "\n", "\t", " ", "　", "é", "ß", "日本", "1", "12", "!", "<|endoftext|>", "!'s", "x'll",
          " ", "\x1c", "\x85", "😀", "$$$", "...", "\r\n", "A", "'S", "ж", "½", "​", "<|end", "the", " of"]


def same(texts):
    ids, counts = bpe.codec(PATH).encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for text, a, b, want in zip(texts, ends - counts, ends, LIBRARY.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids[a:b].tolist() == want.ids, text
        assert bpe.codec(PATH).decode(ids[a:b]) == LIBRARY.decode(want.ids, skip_special_tokens=False), text


def test_ids_of_mixed_pieces():
    rng = random.Random(1)
    same(["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(20_000)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_ids_of_any_text(texts):
    same(texts)


def test_round_trip_of_edge_rows(edge_docs):
    texts = sorted((r["doc_id"] or 0, r["text"] or "") for r in edge_docs.collect())
    back = bpe.decode(bpe.encode(edge_docs.select("doc_id", "text", "score"), PATH), PATH)
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in back.collect()) == texts
    once = bpe.round_trip(edge_docs, PATH).collect()
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in once) == texts
    assert {r["n_tokens"] for r in once if r["doc_id"] in (1, 2)} == {0}


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=20))
def test_plan_places_every_length_once(counts):
    used, fill = {}, {}
    for length, first, number, sequence, offset in packing.plan(counts, 64):
        for k in range(number):
            assert used.setdefault(length, set()).isdisjoint({first + k})
            used[length].add(first + k)
            fill.setdefault(sequence + k, []).append((offset, length))
    assert {n: len(r) for n, r in used.items()} == counts and all(r == set(range(len(r))) for r in used.values())
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    # best fit leaves no two sequences that would fit into one
    rooms = sorted(sum(n for _, n in p) for p in fill.values())
    assert len(rooms) < 2 or rooms[0] + rooms[1] > 64


@pytest.mark.parametrize("size", [2048, 7])
def test_pack_edge_rows(edge_docs, size, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 3)
    docs = {}
    for r in edge_docs.where("doc_id != 6").collect():
        docs[r["doc_id"]] = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids + [0]
    rows = packing.pack(edge_docs.where("doc_id != 6"), PATH, size).collect()
    by_sequence, got = {}, {}
    for r in rows:
        own = docs[r["doc_id"]][r["start"]: r["start"] + r["length"]]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        got.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for i, ids in docs.items():
        at = 0
        for piece, (no, start, length) in enumerate(sorted(got[i])):
            assert (no, start) == (piece, at) and (length == size or piece == 0)
            at += length
        assert at == len(ids)
    for parts in by_sequence.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist() and sum(n for _, n in parts) <= size


def test_repeated_rows_and_empty_table(edge_docs, no_docs):
    assert packing.pack(edge_docs.where("doc_id = 6"), PATH).count() == 2
    assert packing.pack(no_docs, PATH).count() == 0
    assert bpe.round_trip(no_docs, PATH).count() == 0
