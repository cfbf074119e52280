"""Line de-duplication and fingerprints, held against plain Python; the pipeline."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meteora.llm import fingerprint, linededup
from meteora.llm.common import stored, stored_by
from meteora.llm.components import components

SF = "/root/testdata/sf0.001"
SHINGLE = re.compile(r"(?s)(?=(\S.{11}))\S{1,8}")


def shingles_of(line):
    return [line] if len(line) <= 12 else SHINGLE.findall(line) + ([line[-12:]] if len(line) < 60 else [])


def jaccard(a, b):
    a, b = set(shingles_of(a)), set(shingles_of(b))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("kind", ["characters", "words", "cut"])
def test_recall_against_all_character_shingles(kind):
    # edited copies of real lines whose index over ALL 12-character shingles is 0.8 or more, before banding
    texts = duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet' order by doc_id").fetchall()
    lines = [x for (t,) in texts for x in (t or "").split("\n") if x.isascii() and 40 <= len(x) <= 2000][:1500]
    every = lambda x: {x[i: i + 12] for i in range(len(x) - 11)}
    rng, found, close = random.Random(kind), 0, 0
    for line in lines:
        for _ in range(3):
            if kind == "cut":
                other = line[: len(line) - rng.randint(1, max(1, len(line) // 4))].strip()
            elif kind == "words":
                w = line.split(" ")
                for _ in range(rng.randint(1, 1 + len(w) // 20)):
                    w[rng.randrange(len(w))] = "".join(rng.choice("abcdefgh") for _ in range(5))
                other = " ".join(w)
            else:
                c = list(line)
                for _ in range(rng.randint(1, 1 + len(c) // 100)):
                    c[rng.randrange(len(c))] = rng.choice("abcdefgh")
                other = "".join(c).strip()
            a, b = every(line), every(other)
            if len(a & b) >= 0.8 * len(a | b):
                close += 1
                found += jaccard(line, other) >= 0.8
    # measured on sf0.01: 0.879, 0.944, 0.912
    assert close > 300 and found >= {"characters": 0.86, "words": 0.92, "cut": 0.9}[kind] * close


def slow_lines(rows):
    """Texts without later lines of a component, from all pairs."""
    places = [(i, n, x.strip(" \t\r\f\x0b")) for i, t in rows for n, x in enumerate(t.split("\n")) if x.strip(" \t\r\f\x0b")]
    own = list(dict.fromkeys(x for _, _, x in places))
    up = {x: x for x in own}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for j, b in enumerate(own):
        for a in own[:j]:
            if jaccard(a, b) >= 0.8 and root(a) != root(b):
                up[root(b)] = root(a)
    seen, gone = set(), set()
    for i, n, x in sorted(places):
        if root(x) in seen:
            gone.add((i, n))
        seen.add(root(x))
    return {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in rows}


def test_lines_by_brute_force(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 12))) for _ in range(400)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    for x in list(lines):
        for _ in range(3):
            w = x.split()
            for _ in range(rng.choice([0, 1, 1, 6])):
                w[rng.randrange(len(w))] = rng.choice(words)
            lines.append(" ".join(w))
    rows = [(i, "\n".join(rng.choice([*lines, "", "  "]) + rng.choice(["", " "]) for _ in range(rng.randint(1, 8)))) for i in range(90)]
    got = {r["doc_id"]: r["text"] for r in linededup.without_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = slow_lines(rows)
    # banding finds a pair at the threshold with probability 0.997
    assert sum(got[i] != want[i] for i in want) <= 1


def test_spark_shingles_are_the_same(spark):
    texts = ["one", "a bb ccc", "averyveryverylongword and more", "日本語の文章です ab", "日本語の文章です。" * 4, "x" * 30, "y" * 70]
    for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", linededup.shingles(F.col("t")).alias("s")).collect():
        if "日" not in r["t"]:
            assert r["s"] == shingles_of(r["t"])
        else:
            assert len(r["s"]) >= min(9, 2 * len(r["t"]) - 23) and r["s"][0] == r["t"][:12]


def test_a_large_bucket_makes_links_not_pairs(spark):
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{base} tail{i}") for i in range(300)]
    distinct = stored_by(linededup.distinct_lines(spark.createDataFrame(rows, "doc_id long, text string")), "lines", ["k1", "k2"])
    n = linededup.links(distinct).distinct().count()
    assert 299 <= n <= 8 * 300
    out = linededup.without_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("text != ''").collect()
    assert [r["doc_id"] for r in out] == [0]


def test_dissimilar_lines_of_a_bucket_find_their_own_leaders(spark):
    # bands of one row: many lines share one without being similar
    rows = [(i, f"shared words here {'abcdefgh'[i % 8] * 5} " + " ".join(f"{'abcdefgh'[i % 8]}{j}" for j in range(30)) + f" {i}") for i in range(64)]
    distinct = stored_by(linededup.distinct_lines(spark.createDataFrame(rows, "doc_id long, text string")), "lines", ["k1", "k2"])
    found = components(linededup.links(distinct, bands=6, rows=1))
    assert found.select("component").distinct().count() == 8 and found.count() == 64


def components_of(lines, pairs):
    up = {x: x for x in lines}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        up[root(a)] = root(b)
    groups = {}
    for x in lines:
        groups.setdefault(root(x), set()).add(x)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


def found_groups(spark, docs, **options):
    distinct = stored_by(linededup.distinct_lines(spark.createDataFrame(docs, "doc_id long, text string")), "lines", ["k1", "k2"])
    found = components(linededup.links(distinct, **options)).join(distinct.select("node", "line"), "node")
    return {frozenset(r["g"]) for r in found.groupBy("component").agg(F.collect_set("line").alias("g")).collect()}


def edited(words, share, rng, mark):
    """The words with a share of them, chosen at random, replaced by words of their own."""
    at = set(rng.sample(range(len(words)), int(len(words) * share)))
    return " ".join(f"{mark}x{i}" if i in at else w for i, w in enumerate(words))


@pytest.mark.parametrize("copies", [20, 300])
def test_copies_around_one_original(spark, copies):
    # each copy is similar to the original and not to the other copies; one shared row: all lines of a group meet
    rng, lines = random.Random(copies), []
    for g in range(3):
        words = [f"g{g}w{i:03}abcdefgh" for i in range(90)]
        lines += [" ".join(words)] + [edited(words, 0.1, rng, f"g{g}c{c}") for c in range(copies)]
    rng.shuffle(lines)
    near = [(a, b) for i, a in enumerate(lines) for b in lines[:i] if a[:2] == b[:2] and jaccard(a, b) >= 0.8]
    want = components_of(lines, near)
    assert len(want) == 3 and len(near) < 4 * len(lines)
    assert found_groups(spark, list(enumerate(lines)), bands=24, rows=1) == want


def test_small_buckets_are_compared_outright(spark, monkeypatch):
    # copies similar to their original only, which is seldom the smallest line: no counting of shingles for buckets of five
    monkeypatch.setattr(linededup, "_prefixes", None)
    rng, lines = random.Random(5), []
    for g in range(12):
        words = [f"g{g:02}w{i:03}abcdefgh" for i in range(90)]
        lines += [" ".join(words)] + [edited(words, 0.1, rng, f"g{g:02}c{c}") for c in range(4)]
    rng.shuffle(lines)
    near = [(a, b) for i, a in enumerate(lines) for b in lines[:i] if a[:3] == b[:3] and jaccard(a, b) >= 0.8]
    want = components_of(lines, near)
    assert len(want) == 12 and len(near) < 4 * len(lines)
    assert found_groups(spark, list(enumerate(lines)), bands=24, rows=1) == want


def test_short_lines_at_the_threshold_share_a_band(spark):
    # 9 shingles each, 8 in common: 0.8; independent permutations share a band with probability 0.997
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    rows = []
    for pair in range(4000):
        rest = [word() for _ in range(9)]
        rows += [(pair * 2 + i, " ".join([word(), *rest])) for i in range(2)]
    assert jaccard(rows[0][1], rows[1][1]) == 0.8
    lines = spark.createDataFrame(rows, "node long, line string").withColumns({"k1": F.col("node"), "k2": F.col("node")})
    both = linededup.band_values(lines).withColumn("pair", F.floor(F.col("node") / 2)).groupBy("pair", "band").agg(F.count("*").alias("n"))
    assert both.where("n = 2").select("pair").distinct().count() > 0.993 * 4000


def test_one_hot_bucket_of_many_groups(spark):
    # an opening that all share, and tails in 150 groups of 2: more than any fixed number of leaders
    rng, lines = random.Random(4), []
    opening = [f"opening{i}" for i in range(30)]
    for g in range(150):
        tail = [f"g{g}t{i:02}" for i in range(30)]
        lines += [" ".join(opening + tail), " ".join(opening) + " " + edited(tail, 0.1, rng, f"g{g}")]
    near = [(a, b) for i, a in enumerate(lines) for b in lines[:i] if jaccard(a, b) >= 0.8]
    rng.shuffle(lines)
    want = components_of(lines, near)
    assert len(want) == 150
    assert found_groups(spark, list(enumerate(lines)), bands=24, rows=1) == want


def test_line_edge_rows(edge_docs, no_docs):
    rows = linededup.without_duplicate_lines(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[1][0]["text"] == "" and by_id[2][0]["text"] is None and by_id[3][0]["text"] == "   \n\t "
    assert by_id[4][0]["text"] == "one" and by_id[5][0]["text"] == "" and by_id[7][0]["text"] == "l'été à la plage\n\nfin"
    assert [r["text"] for r in by_id[6]] == ["the quick brown fox jumps over the lazy dog " * 3] * 2 and by_id[4][0]["line"] == "other"
    assert linededup.without_duplicate_lines(no_docs).count() == 0


def test_shuffled_removals_give_the_same(edge_docs, monkeypatch):
    want = sorted(map(str, linededup.without_duplicate_lines(edge_docs).collect()))
    monkeypatch.setattr(linededup, "BROADCAST_BYTES", -1)
    assert sorted(map(str, linededup.without_duplicate_lines(edge_docs).collect())) == want


# fingerprints

def slow_versions(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    blocks = lambda t: set(re.findall(fingerprint._BLOCK, t))
    near = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for at, (i, t) in enumerate(rows):
        after = rows[(at + 1) % len(rows)][1]
        k = len(t) // 4
        e = t[: len(t) - k] + after[:k]
        yield i, (len(t), hashlib.sha256(e.encode()).hexdigest(), near(blocks(t), blocks(e)), near(blocks(t), blocks(after)))


@pytest.mark.parametrize("size", [16 << 20, 20_000])
def test_versions_by_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(fingerprint, "RANGE_BYTES", size)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = fingerprint.compare_versions(docs).collect()
    got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in rows}
    for i, want in slow_versions([(r["doc_id"], r["text"]) for r in docs.collect()]):
        assert got[i][:2] == want[:2] and got[i][2:] == pytest.approx(want[2:]), i
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {}
    for r in rows:
        prints.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len({min(p) for p in prints.values()}) == len(prints)


def test_a_failed_sketch_is_tried_larger_then_compared_outright(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    want = sorted(map(str, fingerprint.compare_versions(docs).collect()))
    monkeypatch.setattr(fingerprint, "LOAD", 60)  # far too many digests for a sketch
    assert sorted(map(str, fingerprint.compare_versions(docs).collect())) == want


def test_peeling_recovers_the_differences(spark):
    rng = random.Random(3)
    mark = spark.range(4000).select(fingerprint._marked(F.xxhash64("id")).alias("d")).collect()
    digests = [r["d"] for r in mark]
    rows = []
    for n in range(60):
        a = set(rng.sample(digests, rng.randint(0, 80)))
        b = set(rng.sample(sorted(a), rng.randint(0, len(a)))) | set(rng.sample(digests, rng.randint(0, 9)))
        rows.append((n, sorted(a), sorted(b)))
    got = {r["row"]: r for r in fingerprint.differences(spark.createDataFrame(rows, "row int, a array<long>, b array<long>"), ["row"]).collect()}
    good = 0
    for n, a, b in rows:
        if n in got and not got[n]["failed"]:
            assert (got[n]["only_a"], got[n]["only_b"]) == (len(set(a) - set(b)), len(set(b) - set(a)))
            good += 1
    assert good > 50


def test_fingerprint_edge_rows(edge_docs, no_docs):
    docs = edge_docs.where("doc_id is null or doc_id != 10").dropDuplicates(["doc_id"])
    got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in fingerprint.compare_versions(docs).collect()}
    want = dict(slow_versions([(r["doc_id"], r["text"] or "") for r in docs.collect()]))
    assert {i: g[:2] for i, g in got.items()} == {i: w[:2] for i, w in want.items()}
    assert all(got[i][2:] == pytest.approx(want[i][2:]) for i in want)
    assert fingerprint.compare_versions(edge_docs).count() == edge_docs.count()
    one = fingerprint.compare_versions(edge_docs.where("doc_id = 4")).first()
    assert one["near_edited"] == one["near_next"] == 1.0
    assert fingerprint.compare_versions(no_docs).count() == 0


# pipeline

def test_stages_keep_the_columns_and_their_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("mine"))
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), "stage")
        assert out.columns == docs.columns and out.join(docs, "doc_id", "left_anti").count() == 0, name
        assert out.select("doc_id").distinct().count() == out.count() and {r["score"] for r in out.select("score").distinct().collect()} <= {"mine"}
        counts.append(out.count())
        docs = out
    assert counts[1] < counts[0] and counts[3] == counts[2] and counts[4] < counts[3]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.select("doc_id").distinct().count() == counts[4]


def test_labelled_rows_that_the_first_stages_drop(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.known_language(spark, stored(corpus_pipeline.good_quality(spark, docs, sf), "stage"), sf)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    labels = dict(duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall())
    good, bad = [i for i, q in labels.items() if q == 1], [i for i, q in labels.items() if q == 0]
    assert sum(i in ids for i in good) > 0.98 * len(good) and sum(i in ids for i in bad) < 0.1 * len(bad)


@pytest.mark.parametrize("number", range(5))
def test_stage_edge_rows(spark, edge_docs, no_docs, tmp_path, number):
    spark.createDataFrame([(4, 1), (6, 0), (7, 1), (8, 0), (11, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    stage = corpus_pipeline.STAGES[number][1]
    assert stage(spark, edge_docs, str(tmp_path)).count() >= (0 if number == 0 else 1)
    assert stage(spark, no_docs, str(tmp_path)).count() == 0
