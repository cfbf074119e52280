"""Fill-in-middle, resampling and personal data, held against plain Python and SQL."""

import hashlib
import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meteora.llm import fim, pii, registry, resampling

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def same_as_sql(spark, name, *tables):
    con = duckdb.connect()
    for t in tables:
        con.register(t, pq.read_table(f"{SF}/{t}.parquet"))
    df = registry.QUERIES[name](spark, SF)
    want = sorted(con.sql(f"SELECT {', '.join(df.columns)} FROM ({registry.ORACLES[name]})").fetchall())
    assert sorted(tuple(r) for r in df.collect()) == want and len(want) > 0


# fill in middle

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100_000), max_size=400), st.sampled_from([1, 7, 128]))
def test_rank_index_is_exact(gaps, error):
    offsets = np.cumsum([0, *gaps])
    index = fim.RankIndex(offsets, error)
    assert (index.lookup(np.arange(len(offsets))) == offsets).all()
    assert np.abs(index.residual).max(initial=0) <= error + 1


def test_rank_index_uses_few_segments_on_even_offsets():
    assert len(fim.RankIndex(np.arange(0, 10_000_000, 71)).first) == 1
    assert len(fim.RankIndex(np.cumsum(np.random.default_rng(1).integers(20, 60, 50_000))).first) < 500


def slow_fim(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


FIM_PIECES = ["a", "é", "😀", "\n", "\n\n", "<", ">", "P>", "<S", "M>", "line of words", "\r\n", " "]


@pytest.mark.parametrize("rate,spm_rate", [(100, 50), (60, 20)])
def test_fim_by_brute_force(spark, rate, spm_rate):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(FIM_PIECES) for _ in range(rng.randint(0, 40)))) for i in range(600)]
    rows += [(None, "no id\nhere"), (700, None), (701, ""), (702, "x<P>y\nz"), (703, "line\n" * 20_000)]
    df = fim.transform(spark.createDataFrame(rows, "doc_id long, text string"), 7, rate, spm_rate, keep_text=True)
    df = df.withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = {(r["doc_id"], r["text"]): r for r in df.collect()}
    assert len(got) == len(set(rows))
    for i, t in rows:
        r = got[i, t]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == slow_fim(i, t, rate=rate, spm_rate=spm_rate)
        assert r["back"] == (t or "")


def test_fim_edge_rows(edge_docs, no_docs):
    clash = edge_docs.withColumn("form", F.lit(1)).withColumn("output", F.lit(2))
    rows = fim.transform(clash, 7).collect()
    assert len(rows) == edge_docs.count() and {"score", "line"} <= set(rows[0].asDict())
    for r in rows:
        assert r["form"] in ("plain", "psm", "spm")
    assert sum(r["doc_id"] == 6 for r in rows) == 2
    assert fim.transform(no_docs, 7).count() == 0
    text_ids = edge_docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert fim.transform(text_ids, 7).count() == edge_docs.count()


def test_fim_sql_agrees(spark):
    same_as_sql(spark, "op11_fill_in_middle", "documents")


# resampling

def slow_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow_counts(texts, longest, buckets):
    out = np.zeros(buckets, np.int64)
    for t in texts:
        w = slow_words(t)
        for n in range(1, longest + 1):
            for i in range(len(w) - n + 1):
                out[zlib.crc32(" ".join(w[i: i + n]).encode()) % buckets] += 1
    return out


def slow_resample(docs, target, seed, longest, buckets, percent, min_words):
    s, t = slow_counts([x for _, x in docs], longest, buckets), slow_counts(target, longest, buckets)
    gain = [math.floor(1000 * math.log((float(b) + 1) * (s.sum() + buckets) / ((float(a) + 1) * (t.sum() + buckets)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for i, x in docs:
        own = slow_counts([x], longest, buckets)
        h = int(sha(f"{seed}:{'' if i is None else i}")[:8], 16)
        weight = int((own * np.array(gain)).sum())
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(slow_words(x)), int(own.sum()), weight, score, None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("longest,rank_rows", [(1, 1 << 20), (3, 7)])
def test_resampling_by_brute_force(spark, longest, rank_rows, monkeypatch):
    monkeypatch.setattr(resampling, "RANK_ROWS", rank_rows)
    rng = random.Random(5)
    pieces = ["the", "Cat", "é", "É", "x1", " ", " ", "\n", "\n", ". ", "-", "日本", "dog ", "same line\n", "\x0b"]
    docs = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    docs += [(900, None), (901, ""), (902, "\n\n"), (None, "the cat the dog " * 9), (903, "same line\n" * 50), (903, "same line\n" * 50)]
    target = ["the cat\nthe dog", "same line", None, "日本 cat"]
    got = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string").withColumn("weight", F.lit("w")),
                              spark.createDataFrame([(t,) for t in target], "text string"), 2024, longest, 97, 30, 5)
    rows = sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)
    want = slow_resample(docs, target, 2024, longest, 97, 30, 5)
    assert [r[:5] for r in rows] == [r[:5] for r in want]
    assert sorted((r[5], r[0], r[4]) for r in rows if r[5]) == sorted((r[5], r[0], r[4]) for r in want if r[5])


def test_resampling_edge_rows(edge_docs, no_docs):
    target = edge_docs.where("doc_id = 7").select("text")
    assert resampling.resample(edge_docs, target, 1).count() == edge_docs.count()
    assert resampling.resample(edge_docs, target.where("false"), 1).count() == edge_docs.count()
    assert resampling.resample(no_docs, target, 1).count() == 0


def test_resampling_sql_agrees(spark):
    same_as_sql(spark, "op12_importance_resampling", "documents", "benchmark")


# personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def slow_luhn(digits):
    double = {str(d): sum(map(int, str(2 * d))) for d in range(10)}
    return (sum(map(int, digits[-1::-2])) + sum(double[d] for d in digits[-2::-2])) % 10 == 0


def slow_base(text):
    checks = {"email": lambda m: True, "ip": lambda m: all(len(p.lstrip("0")) < 4 and int(p[-9:]) <= 255 for p in m.split(".")),
              "card": lambda m: 14 <= len(re.sub(r"[^0-9]", "", m)) <= 19 and slow_luhn(re.sub(r"[^0-9]", "", m)),
              "phone": lambda m: 10 <= len(re.sub(r"[^0-9]", "", m)) <= 15}
    found = [(m.start(), k, m.end()) for k, (name, rx) in enumerate(BASE.items()) for m in re.finditer(rx, text) if checks[name](m.group())]
    return sorted(found)


PII_PIECES = ["a", "1", "2", "0", "00", "255", "4111111111111111", "4111 1111 1111 1111", ".", ".", "..", "@", "@", "-", " ", " ", "+", "+1", "(", ")", "é", "%", "_",
              "x.y", "example.com", "+1 (743) 555-3824", "227.5.221.1", "\n", ",", "::", "1:2", "tel:", "account no. ", "IBAN ", "(at)", "😀", "5555-5555-5555-4444"]


def test_base_spans_by_brute_force():
    rng = random.Random(8)
    for _ in range(30_000):
        text = "".join(rng.choice(PII_PIECES) for _ in range(rng.randint(0, 14)))
        base, every = pii.find(text)
        assert base == slow_base(text), text
        assert set(base) <= set(every) and every == sorted(every)
        own = [x for x in every if x not in base]
        for s, _, e in own:
            assert s < e and all(e <= s2 or e2 <= s for s2, _, e2 in every if (s2, e2) != (s, e)), text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1290.@+- ()%:_é\n")), max_size=60))
def test_base_spans_of_any_text(text):
    assert pii.find(text)[0] == slow_base(text)


@pytest.mark.parametrize("text,want", [
    ("write to jörg@büro.example soon", "jörg@büro.example"), ("ann.lee (at) example (dot) org.", "ann.lee (at) example (dot) org"),
    ("host 2001:db8::8a2e:370:7334 up", "2001:db8::8a2e:370:7334"), ("Tel. 030 1234567, ask", "030 1234567"), ("tel:5551234567", "5551234567"),
    ("IBAN: DE89 3704 0044 0532 0130 00 please", "DE89 3704 0044 0532 0130 00"), ("account no. 12345678 open", "12345678"),
])
def test_added_spans(text, want):
    base, every = pii.find(text)
    assert [text[s:e] for s, k, e in every if (s, k, e) not in base] == [want]


@pytest.mark.parametrize("text", ["the account of 2001 was long", "std::vector", "a :: b", "phone me", "on account: see page 12", "time 12::30", "IBAN DE89 3704 0044 0532 0130 01",
                                  "hotel 12345678", "nothing here"])
def test_clean_texts(text):
    assert [x for x in pii.find(text)[1] if pii.KINDS[x[1]] != "account" or "IBAN" not in text] == []


@pytest.mark.parametrize("text", ["1" * 400_000, "1." * 200_000, "1 " * 200_000, "a" * 400_000 + "@", "@" * 300_000, "+1" * 200_000, "+1 " * 100_000, "é" * 200_000 + "@é",
                                  "::" * 200_000, "account " * 50_000, "iban AA11" + "A" * 300_000, "a.b@" * 100_000, "(at) " * 80_000])
def test_long_texts_in_linear_time(text):
    started = time.perf_counter()
    pii.find(text)
    assert time.perf_counter() - started < 4


def test_personal_data_of_a_table(spark):
    rows = {r["doc_id"]: r for r in registry.QUERIES["op13_personal_data"](spark, SF).collect()}
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    assert len(rows) == len(docs)
    for d in docs:
        want, r = slow_base(d["text"] or ""), rows[d["doc_id"]]
        assert [r[f"n_{k}"] for k in BASE] == [sum(x[1] == i for x in want) for i in range(4)]
        joined = ",".join(f"{list(BASE)[k]}:{s}:{e}" for s, k, e in want)
        assert r["base_sha256"] == sha(joined) and (r["spans"] or "").startswith(joined.split(",")[0])


def test_personal_data_edge_rows(edge_docs, no_docs):
    rows = pii.with_spans(edge_docs.withColumn("n_ip", F.lit("clash")), mask=True).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["masked"] == (r["text"] or "") and r["spans"] == "" and r["n_ip"] == 0 for r in rows)
    assert pii.with_spans(no_docs).count() == 0


def test_masked():
    text = "mail a@b.c or +1 (743) 555-3824!"
    assert pii.masked(text, pii.find(text)[1]) == "mail <email> or <phone>!"
