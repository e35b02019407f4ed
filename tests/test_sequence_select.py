"""Skew-safe sequencing and exact order statistics against brute force."""

import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwise.functions.select import column_order_stats, kth_tuples, tuple_le
from cartwise.functions.sequence import sequence_within


def _rows(seed=7, n=3000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot key holding a third of the rows, a null key, many small keys
        r = rng.random()
        key = 0 if r < 0.34 else (None if r < 0.36 else rng.randint(1, 200))
        rows.append((key, rng.randint(0, 50), i, float(rng.randint(0, 9))))
    return rows


def test_sequence_matches_window_with_hot_and_null_keys(spark):
    df = spark.createDataFrame(_rows(), "k int, o int, id long, v double")
    for n in (1, 5, 23):
        s = sequence_within(df, ["k"], ["o", "id"], "rn", {"v": "lag_v"}, "last", num_partitions=n)
        w = Window.partitionBy("k").orderBy("o", "id")
        ref = (df.withColumn("rn2", F.row_number().over(w)).withColumn("lag2", F.lag("v").over(w))
               .withColumn("n", F.count("*").over(Window.partitionBy("k"))))
        j = s.join(ref.select("id", "rn2", "lag2", "n"), "id")
        bad = j.filter(~((F.col("rn") == F.col("rn2")) & F.col("lag_v").eqNullSafe(F.col("lag2"))
                         & (F.col("last") == (F.col("rn2") == F.col("n"))))).count()
        assert j.count() == df.count() and bad == 0


def test_sequence_without_keys_and_inside_union(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(500)], "id long, g int")
    s = sequence_within(df, [], ["id"], "rn", num_partitions=7)
    assert s.filter(F.col("rn") != F.col("id") + 1).count() == 0
    # a union puts the sequenced side after other partitions
    other = spark.createDataFrame([(10_000 + i, 0, 0) for i in range(20)], "id long, g int, rn long")
    u = other.unionByName(sequence_within(df, ["g"], ["id"], "rn", num_partitions=4))
    got = {r["id"]: r["rn"] for r in u.filter("id < 10000").collect()}
    assert all(got[i] == i // 3 + 1 for i in range(500))


def test_kth_tuples_exact_with_ties_and_groups(spark):
    rng = np.random.default_rng(3)
    n = 20_000
    g = rng.integers(0, 3, n)
    a = np.where(rng.random(n) < 0.4, 5, rng.integers(0, 1000, n))   # 40 % ties at 5
    rows = [(int(x), int(y), i) for i, (x, y) in enumerate(zip(g, a))]
    df = spark.createDataFrame(rows, "g int, a long, id long")
    targets = {}
    for gv in range(3):
        m = int((g == gv).sum())
        targets[gv] = (m, [1, m // 3, m // 2, m])
    got = kth_tuples(df, ["a", "id"], targets, group="g")
    for gv in range(3):
        srt = sorted((y, i) for (x, y, i) in rows if x == gv)
        for k in targets[gv][1]:
            assert got[(gv, k)] == srt[k - 1]


def test_tuple_le_selects_first_k(spark):
    df = spark.createDataFrame([(i % 4, i) for i in range(100)], "a int, b long")
    kth = kth_tuples(df, ["a", "b"], {None: (100, [37])})
    sel = df.filter(tuple_le(["a", "b"], kth[(None, 37)]))
    assert sel.count() == 37


def test_column_order_stats_matches_numpy(spark):
    rng = np.random.default_rng(5)
    n = 5000
    x = rng.normal(size=n)
    y = rng.integers(0, 4, n).astype(float)          # heavy ties
    rows = [(float(a), float(b) if i % 10 else None) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double")
    ny = sum(1 for r in rows if r[1] is not None)
    got = column_order_stats(df, {"x": (n, [1, 17, n // 2, n]), "y": (ny, [1, ny // 2, ny])})
    xs = sorted(r[0] for r in rows)
    ys = sorted(r[1] for r in rows if r[1] is not None)
    assert got[("x", 17)] == xs[16] and got[("x", n // 2)] == xs[n // 2 - 1]
    assert got[("x", 1)] == xs[0] and got[("x", n)] == xs[-1]
    assert got[("y", ny // 2)] == ys[ny // 2 - 1] and got[("y", ny)] == ys[-1]


def test_sequence_keeps_every_digit_beside_nulls(spark):
    big = 1 << 53
    rows = [(None if i % 4 == 0 else big + i % 3, i, None if i % 5 == 0 else big + i) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    for n in (1, 7):
        got = sequence_within(df, ["k"], ["o"], "rn", {"v": "lag_v"}, "last", num_partitions=n)
        w = Window.partitionBy("k").orderBy("o")
        want = df.select("k", "o", "v", F.row_number().over(w).cast("long").alias("rn"), F.lag("v").over(w).alias("lag_v"),
                         (F.lead("o").over(w).isNull()).alias("last"))
        assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_sequence_across_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_sequence_matches_window_with_hot_and_null_keys(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_order_statistics_of_extreme_values(spark):
    x = [1e308, -1e308, 0.0, 5e-324, -5e-324, 1.0, 1.0, 1.0] + [float(i) ** 9 for i in range(40)]
    wide = [(1 << 62) - 1, -(1 << 62), 0, 1, 2, (1 << 62) - 2] + [i * 7919 for i in range(42)]
    df = spark.createDataFrame(list(zip(x, wide)), "x double, w long")
    got = column_order_stats(df, {"x": (48, list(range(1, 49)))})
    assert [got[("x", k)] for k in range(1, 49)] == sorted(x)
    kth = kth_tuples(df, ["w"], {None: (48, list(range(1, 49)))})
    assert [kth[(None, k)][0] for k in range(1, 49)] == sorted(wide)


def test_plot_sample_is_the_first_rows_by_hash(spark):
    from cartwise.operators import labels as LB

    df = spark.createDataFrame([(i % 50, i) for i in range(500)], "user_id long, product_id long")
    got = LB.plot_sample(df, 37)
    h = F.md5(F.concat_ws("-", F.col("user_id").cast("string"), F.col("product_id").cast("string"), F.lit("42")))
    want = df.orderBy(h, "user_id", "product_id").limit(37)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString()
    assert LB.plot_sample(df, 500).count() == 500 and LB.plot_sample(df, 0).count() == 0


def test_order_statistics_of_infinities_zeros_and_nan_equal_sql(spark):
    import duckdb

    from cartwise.operators.quality import exact_quantiles, profile

    inf, nan = float("inf"), float("nan")
    columns = {"a": [inf, 1.0, 2.0, -inf], "b": [inf, inf, -inf, -inf], "c": [-0.0, 0.0, 5e-324, -5e-324], "d": [nan, None, inf, 3.0],
               "e": [inf] * 4, "f": [None] * 4, "g": [1e308, -1e308, 1e-300, -0.0], "h": [nan] * 4}
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(3)
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, list(columns), probs).collect()}
    con = duckdb.connect()
    for c, xs in columns.items():
        con.execute("CREATE OR REPLACE TABLE t (x DOUBLE)")
        con.executemany("INSERT INTO t VALUES (?)", [[x] for x in xs])
        for p in probs:
            want = con.execute(f"SELECT quantile_cont(x, {p}) FROM t WHERE NOT isnan(x)").fetchone()[0]
            assert str(got[(c, p)]).replace("-0.0", "0.0") == str(want).replace("-0.0", "0.0"), (c, p)
    assert {r["value"] for r in profile(df.select("e")).collect() if r["statistic"] in ("min", "25%", "50%", "max")} == {inf}


def test_images_keep_the_order():
    import pyarrow as pa

    from cartwise.functions.select import image, value

    x = [-float("inf"), -1e308, -1.0, -5e-324, 0.0, 5e-324, 2.2250738585072014e-308, 1.0, 1e308, float("inf")]
    im = image(pa.array([None, *x, float("nan")]))
    assert (np.diff(im) > 0).all() and [value(int(i), False) for i in im] == x
    assert image(pa.array([-0.0]))[0] == image(pa.array([0.0]))[0]
    whole = pa.array([-(1 << 63), -1, 0, (1 << 63) - 1])
    assert image(whole).tolist() == whole.to_pylist()


def test_every_round_takes_few_rows_to_the_driver(spark):
    """Many targets on spread-out values end after a handful of passes."""
    from cartwise.functions import select as SEL

    df = spark.range(20000).select((F.xxhash64("id") / 7.0).alias("x"), F.xxhash64("id", F.lit(1)).alias("w"))
    x = sorted(r[0] for r in df.select("x").collect())
    passes, ran = [], SEL._slices
    try:
        SEL._slices = lambda parts: passes.append(len(parts)) or ran(parts)
        got = column_order_stats(df, {"x": (20000, [1, 5000, 10000, 20000])})
    finally:
        SEL._slices = ran
    assert [got[("x", k)] for k in (1, 5000, 10000, 20000)] == [x[0], x[4999], x[9999], x[-1]]
    assert len(passes) <= 7


def test_box_of_groups_and_of_an_empty_table(spark):
    from cartwise.operators import plotdata as PD

    df = spark.createDataFrame([("x", 1.0), ("x", float("inf")), (None, 3.0), ("y", None)], "by string, v double")
    got = {(r["group"], r["statistic"]): r["value"] for r in PD.box_stats(df, "v", "by").collect()}
    assert got[("x", "min")] == 1.0 and got[("x", "max")] == float("inf") and got[(None, "median")] == 3.0
    assert got[("y", "q1")] is None and len(got) == 15
    assert PD.box_stats(df.limit(0), "v", "by").count() == 0
