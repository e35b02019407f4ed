"""Feature table and labels on a literal basket that holds every trap case:
a product missing from ``products`` (null category, zero affinity), a
duplicated product_id, users with a single prior order (null mean gap), a
user with no 'train' order, a pair bought twice in one order, and a future
product never bought before (makes no row)."""

import math

import pytest
from pyspark.sql import functions as F

from cartwise.operators import features as FT
from cartwise.operators import labels as LB
from cartwise.operators import quality as QC
from cartwise.sources import schemas as S


class _Basket:
    pass


@pytest.fixture(scope="module")
def basket(spark):
    b = _Basket()
    b.orders = spark.createDataFrame([
        (11, 1, "prior", 1, 1, 10, None), (12, 1, "prior", 2, 3, 14, 7.0),
        (13, 1, "train", 3, 2, 9, 3.0),
        (21, 2, "prior", 1, 0, 8, None), (22, 2, "test", 2, 5, 8, 4.0),
        (31, 3, "prior", 1, 6, 23, None), (32, 3, "train", 2, 1, 7, 10.0),
    ], S.ORDERS)
    b.order_products_prior = spark.createDataFrame([
        (11, 100, 1, 0), (11, 101, 2, 0), (11, 102, 3, 0),
        (12, 100, 1, 1), (12, 100, 2, 1),                 # bought twice in one order
        (21, 101, 1, 0), (31, 100, 1, 0), (31, 102, 2, 0),
    ], S.ORDER_PRODUCTS_PRIOR)
    b.order_products_train = spark.createDataFrame(
        [(13, 100, 1, 1), (13, 103, 2, 0), (32, 102, 1, 1)], S.ORDER_PRODUCTS_TRAIN)
    b.products = spark.createDataFrame([
        (100, "a", 1, 1), (101, "b", 2, 1), (101, "b2", 3, 2),   # duplicate id
    ], S.PRODUCTS)                                                   # 102 missing
    b.lines = None
    return b


@pytest.fixture(scope="module")
def feats(basket):
    return {(r.user_id, r.product_id): r for r in FT.build_features(basket).collect()}


def test_schema_and_keys(basket, feats):
    df = FT.build_features(basket)
    assert df.columns == S.FEATURE_COLUMNS
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in S.FEATURE_SCHEMA.fields]
    assert set(feats) == {(1, 100), (1, 101), (1, 102), (2, 101), (3, 100), (3, 102)}


def test_pair_features(feats):
    r = feats[(1, 100)]
    assert (r.user_product_purchase_count, r.user_product_reorder_count,
            r.user_product_last_order_number) == (3, 2, 2)
    assert math.isclose(r.user_product_reorder_rate, 2 / 3)
    assert math.isclose(r.user_product_avg_cart_position, 4 / 3)
    assert r.user_product_recency_orders == 0
    assert feats[(1, 101)].user_product_recency_orders == 1


def test_user_features_null_gap(feats):
    assert feats[(1, 100)].user_total_orders == 2
    assert feats[(1, 100)].user_avg_days_between_orders == 7.0
    assert feats[(1, 100)].user_avg_order_hour == 12.0 and feats[(1, 100)].user_avg_order_dow == 2.0
    assert feats[(2, 101)].user_avg_days_between_orders is None   # single prior order


def test_category_dedup_missing_and_affinity(feats):
    assert (feats[(1, 101)].aisle_id, feats[(1, 101)].department_id) == (2, 1)   # lowest pair
    miss = feats[(1, 102)]
    assert miss.department_id is None and miss.aisle_id is None
    assert miss.user_department_purchase_count == 0 and miss.user_department_purchase_share == 0.0
    assert miss.user_aisle_purchase_count == 0 and miss.user_aisle_purchase_share == 0.0
    # null-category purchases are outside the share denominators
    assert feats[(1, 100)].user_department_purchase_count == 4
    assert feats[(1, 100)].user_department_purchase_share == 1.0
    assert feats[(1, 100)].user_aisle_purchase_share == 0.75
    assert feats[(1, 101)].user_aisle_purchase_share == 0.25


def test_product_features(feats):
    r = feats[(1, 100)]
    assert (r.product_total_purchases, r.product_unique_users) == (4, 2)
    assert r.product_reorder_rate == 0.5
    assert feats[(1, 102)].product_total_purchases == 2


def test_labels_keep_users_without_train_order(spark, basket):
    fut = LB.future_pairs(basket.orders, basket.order_products_train)
    assert {(r[0], r[1]) for r in fut.collect()} == {(1, 100), (1, 103), (3, 102)}
    lab = LB.label_pairs(FT.build_features(basket), fut)
    got = {(r.user_id, r.product_id): r.target for r in lab.collect()}
    assert got[(1, 100)] == 1 and got[(3, 102)] == 1 and got[(2, 101)] == 0
    assert (1, 103) not in got                               # never bought before: no row
    only = LB.label_pairs(FT.build_features(basket), fut, only_labelled_users=True,
                          orders=basket.orders)
    assert {r.user_id for r in only.collect()} == {1, 3}


def test_quality_report_flags(spark, basket):
    rep = {(r.check, r.column): r.value for r in
           QC.quality_report(FT.build_features(basket)).collect()}
    assert rep[("row_count", "*")] == 6 and rep[("duplicate_keys", "user_id,product_id")] == 0
    assert rep[("null_count", "department_id")] == 2
    assert rep[("null_count", "user_avg_days_between_orders")] == 3
    assert rep[("max", "user_aisle_purchase_share")] == 1.0
    assert all(v == 0 for (c, _), v in rep.items() if c in ("negative_count", "infinite_count"))


def test_quality_on_bad_rows(spark):
    df = spark.createDataFrame([(1, 1, float("inf"), -1), (1, 1, 0.5, 2), (2, 1, None, 3)],
                               "user_id long, product_id long, r double, c long")
    rep = {(r.check, r.column): r.value for r in
           QC.quality_report(df, rate_cols=["r"], count_cols=["c"]).collect()}
    assert rep[("duplicate_keys", "user_id,product_id")] == 1
    assert rep[("infinite_count", "r")] == 1 and rep[("negative_count", "c")] == 1
    assert rep[("null_count", "r")] == 1


def test_split_balance_folds_sizes(spark):
    rows = [(u, p, 1 if (u * 7 + p) % 9 == 0 else 0) for u in range(60) for p in range(20)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, target int")
    counts = LB.class_counts(df)
    flagged = LB.split_flag(df, 0.2)
    n = len(rows)
    test_n = flagged.filter("is_test").count()
    assert test_n == math.ceil(0.2 * n)
    q = LB.largest_remainder(counts, test_n)
    per = {r[0]: r[1] for r in flagged.filter("is_test").groupBy("target").count().collect()}
    assert per == q
    # deterministic: same rows on a re-run
    again = {(r.user_id, r.product_id) for r in LB.split_flag(df, 0.2).filter("is_test").collect()}
    assert again == {(r.user_id, r.product_id) for r in flagged.filter("is_test").collect()}
    train = flagged.filter(~F.col("is_test")).drop("is_test")
    bal = LB.balance_undersample(train)
    bc = LB.class_counts(bal)
    assert bc[0] == bc[1] == LB.class_counts(train)[1]
    folds = LB.stratified_folds(bal, 3)
    fc = {(r.target, r.fold): r["count"] for r in folds.groupBy("target", "fold").count().collect()}
    for t in (0, 1):
        sizes = [fc.get((t, f), 0) for f in range(3)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == bc[t]


def test_samples_exact_sizes(spark):
    rows = [(u, p, 1 if p < 3 else 0) for u in range(50) for p in range(20)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, target int")
    s = LB.stratified_sample(df, 101)
    assert s.count() == 101
    cv = LB.cv_sample(df, 200)
    c = LB.class_counts(cv)
    assert c[1] == int(200 * 150 / 1000) and c[0] == 200 - c[1]
    assert LB.cv_sample(df, 5000).count() == 1000            # whole set when smaller
    assert LB.plot_sample(df, 10).count() == 10


def test_plot_sample_is_first_n_by_md5_order(spark):
    import hashlib

    rows = [(u, p, u % 2) for u in range(40) for p in range(25)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, target int")
    got = {(r.user_id, r.product_id) for r in LB.plot_sample(df, 137).collect()}
    order = sorted(rows, key=lambda r: (hashlib.md5(f"{r[0]}-{r[1]}-42".encode()).hexdigest(),
                                        r[0], r[1]))
    assert got == {(u, p) for u, p, _ in order[:137]}


def test_grains_share_orders_and_cart_positions(spark, sf001):
    from cartwise.sources.adapter import load_basket

    part, bt = load_basket(spark, sf001, "part"), load_basket(spark, sf001, "brand_type")
    assert part.orders.inputFiles() == bt.orders.inputFiles()
    assert all("/basket-orders-" in f for f in part.orders.inputFiles())
    # same order rows and cart positions at both grains; only product ids differ
    cols = ["order_id", "add_to_cart_order"]
    assert (part.lines.select(*cols).exceptAll(bt.lines.select(*cols)).count() == 0
            and part.lines.count() == bt.lines.count())


def _tables(spark, path, n_types=150, drop_parts=0):
    """Small driver-shaped tables with many part types."""
    parts = [(i, f"Brand#{i % 25 + 1}", f"TYPE {i % n_types:03d}") for i in range(600)]
    orders = [(o, o % 40, f"1995-01-{o % 28 + 1:02d} 00:00:00") for o in range(200)]
    lines = [(o, (o * 7 + k * 13) % 600, k % 5, k, float(k), 1.0, "1995-02-01 00:00:00") for o in range(200) for k in range(6)]
    spark.createDataFrame(parts[drop_parts:], "p_partkey long, p_brand string, p_type string").write.mode("overwrite").parquet(f"{path}/part.parquet")
    (spark.createDataFrame(orders, "o_orderkey long, o_custkey long, d string")
     .selectExpr("o_orderkey", "o_custkey", "cast(d as timestamp_ntz) as o_orderdate").write.mode("overwrite").parquet(f"{path}/orders.parquet"))
    (spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, d string")
     .selectExpr("* except (d)", "cast(d as timestamp_ntz) as l_shipdate").write.mode("overwrite").parquet(f"{path}/lineitem.parquet"))
    return path


def test_products_of_many_types_do_not_collide(spark, tmp_path):
    from cartwise.sources import adapter as AD

    d = _tables(spark, str(tmp_path))
    products = AD.basket_products(spark.read.parquet(f"{d}/part.parquet"), "brand_type")
    pairs = products.select("aisle_id", "department_id").distinct().count()
    assert pairs > 140 and products.select("product_id").distinct().count() == pairs == products.count()


def test_lines_of_unknown_parts_are_kept_at_both_grains(spark, tmp_path):
    import duckdb

    from cartwise import oracle as O
    from cartwise.sources import adapter as AD

    d = _tables(spark, str(tmp_path), drop_parts=150)
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem"):
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet/*.parquet'")
    for grain in AD.GRAINS:
        lines = AD.adapt(spark, d, grain).lines
        cols = ["order_id", "product_id", "add_to_cart_order", "user_id", "eval_set", "order_number", "reordered"]
        got = sorted((tuple(r) for r in lines.select(*cols).collect()), key=str)
        want = con.execute(f"WITH {O.basket_cte(grain)} SELECT {', '.join(cols)} FROM b_lines").fetchall()
        assert len(got) == 1200 and got == sorted(want, key=str)


def test_stage_key_follows_files_inside_a_table_folder(spark, tmp_path):
    from cartwise.sources.adapter import _input_fingerprint

    d = _tables(spark, str(tmp_path))
    before = _input_fingerprint(spark, d)
    assert _input_fingerprint(spark, d) == before
    spark.read.parquet(f"{d}/part.parquet").limit(3).write.parquet(f"{d}/part.parquet/day=1")
    assert _input_fingerprint(spark, d) != before


def test_pairs_with_a_null_id_are_no_pairs(spark):
    from cartwise.sources.schemas import FEATURE_SCHEMA

    row = {f.name: 0 if f.dataType.simpleString() == "bigint" else 0.0 for f in FEATURE_SCHEMA.fields}
    rows = [dict(row, user_id=1, product_id=2), dict(row, user_id=1, product_id=2), dict(row, user_id=None, product_id=2)]
    got = QC.warehouse_checks(spark.createDataFrame(rows, FEATURE_SCHEMA)).first()
    assert got.unique_customer_product_pairs == 1 and got.null_user_ids == 1 and got.row_count == 3


def test_a_user_with_a_third_of_all_pairs(spark):
    """Features of a hot user equal those computed without the join settings; joins stay splittable."""
    orders = spark.createDataFrame([(u * 10 + k, u, "prior", k + 1, 1, 2, 3.0 if k else None) for u in range(30) for k in range(2)],
                                   S.ORDERS)
    lines = [(u * 10 + k, p, 1, 0) for u in range(30) for k in range(2) for p in range(200 if u == 0 else 10)]
    products = spark.createDataFrame([(p, f"n{p}", p % 7, p % 3) for p in range(200)], S.PRODUCTS)
    from types import SimpleNamespace

    b = SimpleNamespace(orders=orders, products=products,
                        order_products_prior=spark.createDataFrame(lines, S.ORDER_PRODUCTS_PRIOR))
    feats = FT.build_features(b)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    rows = feats.collect()
    assert len(rows) == 200 + 29 * 10
    hot = [r for r in rows if r.user_id == 0]
    assert all(r.user_product_purchase_count == 2 and r.user_total_orders == 2 for r in hot)
    assert abs(sum({r.department_id: r.user_department_purchase_share for r in hot}.values()) - 1) < 1e-9


def _with_null_products(spark):
    rows = [(u, None if p == 0 else p, int((u + p) % 4 == 0)) for u in range(12) for p in range(5)]
    rows += [(None, 3, 1), (None, None, 0), (20, None, 1), (21, None, 0)]
    return spark.createDataFrame(rows, "user_id long, product_id long, target int")


def test_cuts_keep_rows_with_null_keys(spark):
    """Every labelled row is in exactly one of train and test, and samples have their size."""
    from cartwise.operators import labels as LB

    df = _with_null_products(spark)
    key = ["user_id", "product_id", "target"]
    everything = sorted(map(str, df.collect()))
    for seed in range(6):
        train, test = LB.train_test_split(df, seed=seed)
        assert sorted(map(str, train.select(*key).collect() + test.select(*key).collect())) == everything
        assert LB.split_flag(df, seed=seed).filter("is_test is null").count() == 0
        assert LB.stratified_sample(df, 20, seed=seed).count() == 20
        assert LB.cv_sample(df, 20, seed=seed).count() == 20
        assert LB.plot_sample(df, 17, seed=seed).count() == 17
        balanced = LB.balance_undersample(df, seed=seed)
        assert {r["target"]: r["count"] for r in balanced.groupBy("target").count().collect()} == {
            t: df.filter(f"target = 1").count() for t in (0, 1)}


def test_null_products_equal_sql_on_tables_with_removed_parts(spark, sf001, tmp_path):
    """The samples against DuckDB where lines name parts that the part table lacks."""
    import os
    import shutil

    import duckdb
    import pyarrow.parquet as pq

    from cartwise.plans import registry

    for f in ("orders", "lineitem"):
        shutil.copy(f"{sf001}/{f}.parquet", tmp_path / f"{f}.parquet")
    part = pq.read_table(f"{sf001}/part.parquet")
    pq.write_table(part.filter([i % 4 != 0 for i in range(part.num_rows)]), tmp_path / "part.parquet")
    con = duckdb.connect()
    for f in sorted(os.listdir(tmp_path)):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{tmp_path}/{f}')")
    queries, sql = registry.queries(), registry.oracle_sql()
    nulls = 0
    for name in ("train_test_split", "balanced_train", "stratified_folds"):
        df = queries[name](spark, str(tmp_path))
        res = con.execute(sql[name])
        at = [[d[0] for d in res.description].index(c) for c in df.columns]
        want = [tuple(r[i] for i in at) for r in res.fetchall()]
        got = [tuple(r) for r in df.collect()]
        assert sorted(map(str, got)) == sorted(map(str, want)), name
        nulls += sum(None in r for r in got)
    assert nulls > 0


def test_quality_counts_keys_apart(spark):
    """Distinct keys are counted over the keys alone, not beside every other aggregate."""
    from cartwise.operators import quality as QC
    from cartwise.sources.schemas import FEATURE_SCHEMA

    def row(user, item):
        return tuple(user if f.name == "user_id" else item if f.name == "product_id" else f.dataType.fromInternal(1) if f.dataType.simpleString() != "double"
                     else 1.0 for f in FEATURE_SCHEMA.fields)

    df = spark.createDataFrame([row(1, 2), row(1, 2), row(1, None), row(1, None), row(None, 2), row(3, 4)], FEATURE_SCHEMA)
    report, checks = QC.quality_report(df), QC.warehouse_checks(df)
    value = {(r["check"], r["column"]): r["value"] for r in report.collect()}
    assert value[("duplicate_keys", "user_id,product_id")] == 4.0 and value[("row_count", "*")] == 6.0
    assert checks.first()["unique_customer_product_pairs"] == 2 and checks.columns[1] == "unique_customer_product_pairs"
    for out in (report, checks):
        assert "distinct" not in out._jdf.queryExecution().executedPlan().toString().lower()


def test_lines_numbered_beside_hot_orders_and_pairs(spark):
    """Cart positions and first orders of heavy and ordinary keys, nulls and repeats included."""
    import datetime as dt

    from cartwise.sources import adapter as AD

    day = dt.datetime(2020, 1, 1)
    line = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp, l_quantity double, l_extendedprice double"
    rows = [(1, i, i % 3, 1, day, 1.0, 2.0) for i in range(600)]                       # a hot order
    rows += [(k, i, 7 if i else None, 1, day, 1.0, 2.0) for k in range(2, 302) for i in range(2)]  # pairs of one user
    rows += [(None, 1, 5, 1, day, 1.0, 2.0)] * 3
    li = spark.createDataFrame(rows, line)
    orders = spark.createDataFrame([(k, 1 if k < 200 else None, "prior", k) for k in range(1, 302)],
                                   "order_id long, user_id long, eval_set string, order_number int")
    got = AD.basket_lines(li, orders, None).collect()
    AD.release_cached()
    at, first = {}, {}
    want = []
    for k, n, p, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1])):
        at[k] = at.get(k, 0) + 1
        u = 1 if k < 200 else None
        first.setdefault((u, p), k)
        want.append((u, p, k, at[k], "prior", k, int(k > first[(u, p)])))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_lines_are_moved_once_by_order(spark):
    """Numbering and the join with the orders share one shuffle of the lines."""
    from cartwise.sources import adapter as AD

    lines = spark.range(20_000).selectExpr("id div 2 AS l_orderkey", "CAST(id % 2 AS INT) AS l_linenumber", "id AS l_partkey", "1L AS l_suppkey",
                                           "timestamp'2020-01-01' AS l_shipdate", "1D AS l_quantity", "1D AS l_extendedprice")
    orders = spark.range(10_000).selectExpr("id AS order_id", "id AS user_id", "'prior' AS eval_set", "1 AS order_number")
    plan = AD.order_lines(lines, orders.hint("shuffle_merge"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_orderkey") + plan.count("Exchange hashpartitioning(order_id") == 2
