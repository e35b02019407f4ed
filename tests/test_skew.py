"""Salted joins: the same rows as a plain join, and hot keys spread without adaptive settings."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cartwise.functions import skew as K
from cartwise.operators import features as FT
from cartwise.sources import schemas as S


@pytest.fixture
def no_aqe(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(before, ("false", "-1")):
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def left(spark, n=6000):
    rng = random.Random(3)
    keys = [7 if i % 3 == 0 else None if i % 3 == 1 else rng.randrange(1000, 4000) for i in range(n)]
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k bigint, v bigint")


def task_rows(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]


def test_heavy_keys(spark):
    assert K.heavy_keys(left(spark), "k") == [7]
    assert K.heavy_keys(left(spark).filter("k is null"), "k") == []
    assert K.heavy_keys(left(spark).limit(0), "k") == []
    even = spark.range(512).selectExpr("id % 2 as k", "id as v")
    assert sorted(K.heavy_keys(even, "k")) == [0, 1]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_equals_a_plain_join(spark, how):
    a = left(spark)
    b = spark.createDataFrame([(7, "x"), (7, "y"), (None, "z"), *[(k, str(k)) for k in range(1000, 4000, 2)]], "k bigint, w string")
    want, got = a.join(b, "k", how), K.salted_join(a, b, "k", how)
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    with pytest.raises(ValueError):
        K.salted_join(a, b, "k", "full")


def test_a_hot_key_is_spread_without_adaptive_execution(spark, no_aqe):
    a, b = left(spark), spark.createDataFrame([(7, "x")], "k bigint, w string")
    plain, salted = task_rows(a.join(b, "k", "left")), task_rows(K.salted_join(a, b, "k"))
    assert sum(plain) == sum(salted) == 6000
    assert max(plain) >= 2000 and max(salted) <= 1500


def test_features_of_a_hot_user_are_spread_without_adaptive_execution(spark, no_aqe):
    hot = 1500
    orders = spark.createDataFrame([(u, u, "prior", 1, 1, 2, None) for u in range(60)], S.ORDERS)
    lines = [(u, p, 1, 0) for u in range(60) for p in range(hot if u == 0 else 50)]
    products = spark.createDataFrame([(p, f"n{p}", p % 7, p % 3) for p in range(hot)], S.PRODUCTS)
    b = SimpleNamespace(orders=orders, products=products, order_products_prior=spark.createDataFrame(lines, S.ORDER_PRODUCTS_PRIOR))
    pc = FT.pairs_with_category(FT.pair_stats(FT.prior_lines(orders, b.order_products_prior)), products)
    users = FT.user_order_features(orders)
    assert max(task_rows(pc.join(users, "user_id"))) >= hot
    assert max(task_rows(K.salted_join(pc, users, "user_id", "inner", by=F.col("product_id")))) < hot / 2
    made = FT.build_features(b)
    assert made.count() == hot + 59 * 50
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "user_id" in plan and "_salt" in plan
    assert made.filter("user_id = 0").agg(F.countDistinct("user_aisle_purchase_count")).first()[0] >= 1
    shares = made.filter("user_id = 0").select("department_id", "user_department_purchase_share").distinct().collect()
    assert len(shares) == 3 and abs(sum(r[1] for r in shares) - 1) < 1e-9
