import random

import numpy as np
import pytest
import xxhash

from meteora.llm import simhash
from meteora.llm.components import components


def slow_fingerprint(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i: i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(pairs, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("text", ["", "a", "A b c", "a b c d", "x " * 9, "Ünï cöde Wörds here, and\x0bmore too", "\n\t"])
def test_fingerprint_by_definition(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('a b c d')").first()[0] % 2 ** 64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_links_connect_exactly_the_brute_force_components(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_ROWS", 16)
    monkeypatch.setattr(simhash, "SUB_ROWS", 8)
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(120)]
    fps = set(seeds)
    for s in seeds[:60]:
        for _ in range(4):
            x = s
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    ids = rng.sample(range(10_000), len(fps))
    df = spark.createDataFrame([(i, x - 2 ** 64 if x >= 2 ** 63 else x) for i, x in zip(ids, fps, strict=True)], "node long, simhash long")
    got = {r["node"]: r["component"] for r in components(simhash.links(df, 4)).collect()}
    want = groups([(ids[i], ids[j]) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4], ids)
    assert {i: got.get(i, i) for i in ids} == want


def test_a_forest_not_all_pairs():
    near = np.array([1 << i for i in range(60)], np.uint64)  # all pairs are 2 bits apart
    u, v = simhash.links_within(near, near[:0], 4)
    assert len(u) == 59 and set(v.tolist()) == {0}


def test_edge_rows(edge_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    assert by_id[1] == by_id[2] == by_id[3] == {("0" * 16, 1)}
    assert by_id[4] == by_id[5] and len(by_id[6]) == 1


def test_one_row_of_each_group_stays(edge_docs):
    kept = simhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=lambda x: (x is None, x))
    assert ids[:3] == [1, 4, 6] and ids[-1] is None and len(ids) == len(set(ids))


def test_rows_that_share_an_id_are_not_one_group(spark):
    texts = [f"the {a} tells a long story about {b} and about nothing else in the whole wide world" for a, b in [("first", "rivers"), ("other", "trade")]]
    texts[1] = " ".join(reversed(texts[1].split())) + " with an ending of its own"
    rows = [(1, texts[0], "a"), (1, texts[1], "b"), (2, texts[1], "c"), (1, texts[0], "d"), (None, texts[0], "e")]
    out = [simhash.drop_near_duplicates(spark.createDataFrame(r, "doc_id long, text string, lang string")).collect() for r in (rows, rows[::-1])]
    assert sorted(map(str, out[0])) == sorted(map(str, out[1]))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out[0]) == sorted([(0, texts[0]), (1, texts[0]), (1, texts[1])])


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_components_of_hubs_chains_and_loops(spark):
    edges = [(0, i) for i in range(1, 500)] + [(1000 + i, 1001 + i) for i in range(100)] + [(5000, 5000), (7, 6)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(500)) and all(got[1000 + i] == 1000 for i in range(101)) and 5000 not in got
