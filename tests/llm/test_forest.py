import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.llm import forest as N
from cartwise.llm import queries as Q

SCHEMA = "vec_id bigint, embedding array<float>, label int"

def tens():
    return F.col("vec_id") % 10 == 0


def brute(rows, k, every=10):
    v = [(i, [float(np.float32(x)) for x in e]) for i, e, *_ in rows if i is not None and e is not None
         and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    queries = {}
    for i, q in v:
        if i % every == 0:
            queries[i] = min(queries.get(i, q), q)
    out = []
    for i, q in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(q, x, strict=False)), j) for j, x in v if j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def some(n=300, dim=6, seed=8):
    rng = random.Random(seed)
    rows = [(i, [rng.randrange(-8, 9) / 8 for _ in range(dim)], 0) for i in range(n)]
    rows += [(i, [0.5] * dim, 0) for i in range(n, n + 60)]  # one vector on many rows
    rows += [(900, None, 1), (901, [None] + [1.0] * (dim - 1), 1), (902, [float("nan")] * dim, 1), (903, [float("inf")] * dim, 1)]
    rows += [(904, [0.0] * dim, 1), (905, [], 1), (906, [1.0], 1), (None, [9.0] * dim, 1), (910, [0.0, -0.0], 2)]
    return rows + [(10, rows[10][1], 0), (50, [0.25] * dim, 0), (50, [0.25] * dim, 0)]


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize(("k", "block", "pack"), [(5, 2048, 1024), (3, 7, 4), (500, 2048, 1024)])
def test_all_leaves_give_brute_force(spark, monkeypatch, k, block, pack):
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    monkeypatch.setattr(N, "PACK_QUERIES", pack)
    df = spark.createDataFrame(some(), SCHEMA).selectExpr("*", "1 as id", "2 as v", "3 as entry", "4 as query_id", "5 as rank").repartition(4)
    got = N.nearest(df, k, tens(), leaf_rows=20, target=1.1)
    want = brute(some(), k)
    if k == 500:  # every candidate is asked for
        assert rows_of(got) == want
    else:
        found = {r[:3] for r in rows_of(got)}
        assert len(found & {r[:3] for r in want}) >= 0.97 * len(want) and len(found) == len(want)


def test_every_leaf_is_exact(spark, monkeypatch):
    monkeypatch.setattr(N, "_calibrated", lambda *a: 1 << 40)
    assert rows_of(N.nearest(spark.createDataFrame(some(), SCHEMA), 5, tens(), leaf_rows=20)) == brute(some(), 5)


def test_few_found_are_asked_again(spark, monkeypatch):
    monkeypatch.setattr(N, "_calibrated", lambda *a: 1)
    got = rows_of(N.nearest(spark.createDataFrame(some(), SCHEMA), 90, tens(), leaf_rows=20))
    want = brute(some(), 90)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert {(r[0], *r[2:]) for r in got} <= {(r[0], *r[2:]) for r in brute(some(), 500)}


def test_double_vectors_lengths_that_differ_and_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(N, "broadcast_if", lambda df, size: df)
    rng = random.Random(1)
    rows = [(i, [rng.randrange(-50, 50) * 10.0 ** rng.randrange(3) for _ in range(4)]) for i in range(400)]
    got = N.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), 4, tens(), leaf_rows=25)
    want = brute([(i, e, 0) for i, e in rows], 4)
    assert len({r[:3] for r in rows_of(got)} & {r[:3] for r in want}) >= 0.9 * len(want)
    assert N.recall(got, spark.createDataFrame(want, "query_id bigint, rank int, vec_id bigint, score double")) >= 0.9


def test_no_queries_no_rows_one_row(spark):
    df = spark.createDataFrame([(1, [1.0], 0)], SCHEMA)
    for rows in (df, df.limit(0), spark.createDataFrame([(0, [1.0], 0)], SCHEMA), spark.createDataFrame([(0, [0.0], 0)], SCHEMA)):
        assert N.nearest(rows, 5, tens()).count() == 0
    two = spark.createDataFrame([(0, [1.0], 0), (3, [-2.0], 0)], SCHEMA)
    assert rows_of(N.nearest(two, 5, tens())) == [(0, 1, 3, -2.0)]


def test_queue_opens_leaves_by_cost():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 8))
    forest = N.fit(x, float(np.sqrt((x * x).sum(1).max())), 2000, trees=2, leaf_rows=30)
    q = rng.normal(size=(5, 8))
    cost, n = forest.costs(q), 1 << forest.depth
    splits = forest.thresholds.tolist()
    for i, p in enumerate(forest.asked(q).tolist()):
        order = [t * n + leaf for t, leaf in forest.search(p, splits, 0, 1 << 40)]
        assert sorted(order) == list(range(2 * n)) and (np.diff(cost[i, order]) >= -1e-12).all()
        assert order[5:9] == [t * n + leaf for t, leaf in forest.search(p, splits, 5, 9)]
    assert all(np.bincount(forest.leaves(x)[:, t], minlength=n).max() < 3 * 2000 / n for t in range(2))


def test_recall_of_the_query(spark, sf01):
    rows = [(r[0], list(r[1]), 0) for r in spark.read.parquet(f"{sf01}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = spark.createDataFrame(brute(rows, 20, 20), "query_id bigint, rank int, vec_id bigint, score double")
    got = Q.op13_approximate_neighbours(spark, sf01).cache()
    assert got.count() == want.count() and N.recall(got, want) >= 0.9
    same = got.join(want, ["query_id", "vec_id"]).filter(F.abs(got.score - want.score) > 1e-12)
    assert same.count() == 0
    got.unpersist()
