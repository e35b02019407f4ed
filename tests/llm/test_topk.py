import math
import random

import pytest
from pyspark.sql import functions as F

from cartwise.llm import topk as K

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k, every):
    v = [(i, [math.floor(256 * x) for x in e]) for i, e, _ in rows
         if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    queries = {}
    for i, q in v:
        if i % every == 0:
            queries[i] = min(queries.get(i, q), q)
    out = []
    for i, q in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(q, x, strict=False)), j) for j, x in v if j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def rows_with_ties(n=230, dim=6):
    rng = random.Random(8)
    rows = [(i, [rng.randrange(-8, 9) / 8 for _ in range(dim)], 0) for i in range(n)]
    rows += [(i, [0.5] * dim, 0) for i in range(n, n + 60)]  # one vector on many rows
    rows += [(500, None, 1), (501, [None] + [1.0] * (dim - 1), 1), (502, [float("nan")] * dim, 1), (503, [float("inf")] * dim, 1)]
    rows += [(504, [], 1), (505, [1.0], 1), (None, [9.0] * dim, 1), (10, rows[10][1], 0), (50, [0.25] * dim, 0)]
    return rows


@pytest.mark.parametrize(("k", "buckets", "block"), [(5, 1024, 2048), (3, 4, 16), (400, 1024, 64)])
def test_equals_brute_force(spark, monkeypatch, k, buckets, block):
    monkeypatch.setattr(K, "BLOCK_ROWS", block)
    monkeypatch.setattr(K, "BLOCK_QUERIES", 3 if block == 16 else 2048)
    rows = rows_with_ties()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as qb", "2 as id", "3 as v").repartition(4)
    got = K.top_k(df, k, F.col("vec_id") % 10 == 0, buckets=buckets)
    assert sorted(map(tuple, got.collect())) == brute(rows, k, 10)


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(-(1 << 22), 1 << 22)) for _ in range(3)], 0) for i in range(60)]
    got = K.top_k(spark.createDataFrame(rows, SCHEMA), 5, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 10)


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(K, "broadcast_if", lambda df, size: df)
    rows = rows_with_ties(60)
    got = K.top_k(spark.createDataFrame(rows, SCHEMA), 5, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 10)


def test_no_queries_and_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0], 0)], SCHEMA)
    assert K.top_k(df, 5, F.col("vec_id") % 50 == 0).count() == 0
    assert K.top_k(df.limit(0), 5, F.col("vec_id") % 50 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 0)], SCHEMA)
    assert K.top_k(alone, 5, F.col("vec_id") % 50 == 0).count() == 0


def test_very_large_components_take_part(spark):
    rows = [(i, [i / 8, -1.0], 0) for i in range(20)] + [(30, [float(1 << 41), 2.0], 0), (31, [-float(1 << 40), 0.5], 0)]
    got = K.top_k(spark.createDataFrame(rows, SCHEMA), 3, (F.col("vec_id") % 10 == 0) & (F.col("vec_id") < 30))
    want = [r for r in brute(rows, 3, 10) if r[0] < 30]
    assert any(r[2] == 30 for r in want) and sorted(map(tuple, got.collect())) == want


def test_scores_beyond_64_bits_are_an_error(spark):
    for huge in (float(1 << 41), 3e38):
        rows = [(0, [1.0], 0), (1, [2.0], 0), (10, [huge], 0)]
        with pytest.raises(ValueError, match="64 bits"):
            K.top_k(spark.createDataFrame(rows, SCHEMA), 5, F.col("vec_id") % 10 == 0)
