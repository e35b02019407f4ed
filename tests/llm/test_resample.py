import hashlib
import math
import random
import re
import zlib

import pytest

from cartwise.llm import queries as Q
from cartwise.llm import resample as R

SCHEMA = "doc_id bigint, text string, lang string"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def buckets_of(text, m):
    w = words(text)
    return [zlib.crc32(x.encode()) % m for x in [*w, *map(" ".join, zip(w, w[1:]))]]


def brute(docs, target, percent=25, min_words=20, m=10_000, seed=7):
    s, t = [0] * m, [0] * m
    for count, rows in ((s, docs), (t, target)):
        for r in rows:
            for b in buckets_of(r[1], m):
                count[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + m) / ((a + 1) * (sum(t) + m)))) for a, b in zip(s, t, strict=True)]
    out = []
    for i, text, *_ in docs:
        f = buckets_of(text, m)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words(text))])
    fit = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2], r[1]))
    for n, r in enumerate(fit[:percent * len(fit) // 100]):
        r[4] = n + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def corpus(n=120):
    rng = random.Random(5)
    vocabulary = ["Apfel", "tree", "ÜBER", "straße", "x1", "日本", "B" * 70, "c" * 64, "d" * 65, "don't", "A-b", "é", "_", "10"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))), "en") for i in range(n)]
    rows += [(900, None, None), (901, "", "en"), (902, " \x00.,; ", None), (903, "one\x00two\x00three " * 9, "en"), (None, "tree Apfel " * 15, "en")]
    return rows + [(7, rows[7][1], "en"), (7, rows[7][1], "de"), (904, "z" * 5000 + " " + "tree " * 30, "en")]


def rows_of(df):
    return sorted([(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()], key=str)


@pytest.mark.parametrize("joined", [R.JOINED_BYTES, 200])
def test_equals_brute_force(spark, monkeypatch, joined):
    monkeypatch.setattr(R, "JOINED_BYTES", joined)
    target = [(1, "tree Apfel über 日本"), (2, None), (3, "straße x1 " + "q" * 200)]
    docs = spark.createDataFrame(corpus(), SCHEMA).selectExpr("*", "1 as t", "2 as i", "3 as rank", "'y' as weight", "0 as _rank").repartition(5)
    held = []
    got = R.resample(docs, spark.createDataFrame(target, "item_id bigint, text string"), hold=held)
    assert rows_of(got) == brute(corpus(), target)


def test_other_parameters(spark):
    target = [(1, "tree")]
    got = R.resample(spark.createDataFrame(corpus(60), SCHEMA), spark.createDataFrame(target, "item_id bigint, text string"),
                     percent=70, min_words=3, buckets=97, seed=3)
    assert rows_of(got) == brute(corpus(60), target, 70, 3, 97, 3)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame(corpus(30), SCHEMA)
    assert R.resample(none, some).count() == 0
    assert rows_of(R.resample(some, none)) == brute(corpus(30), [])


def test_features_of_random_bytes():
    rng = random.Random(9)
    for _ in range(60):
        texts = ["".join(rng.choice("aZ9 \x00-\n§日é~") for _ in range(rng.choice([0, 1, 5, 400]))) for _ in range(7)]
        bucket, doc, n = R.features([t.encode() for t in texts], 1000)
        for i, t in enumerate(texts):
            assert sorted(bucket[doc == i].tolist()) == sorted(buckets_of(t, 1000)) and n[i] == len(words(t))


def test_whole_table_equals_brute_force(spark, sf01):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf01}/benchmark.parquet").select("item_id", "text").collect()]
    got = rows_of(Q.op12_importance_resampling(spark, sf01))
    assert got == brute(docs, items)
    n = sum(1 for _, t in docs if len(words(t)) >= 20)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 25 * n // 100 + 1))
