"""What the base chain moves: few columns, once."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from cartwise.operators import features as FT
from cartwise.sources import adapter as AD
from cartwise.sources.adapter import LINE_ORDER, cart_positions


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_numbered_without_their_wide_columns(spark, tmp_path):
    rows = [(1, 1, 7, 3, "1995-01-02", 2.0, 9.0), (1, 1, 7, 2, "1995-01-01", 5.0, 1.0), (1, 1, 6, 9, "1995-01-03", 1.0, 1.0),
            (1, None, 5, 1, "1995-01-01", 1.0, 1.0), (2, 1, None, 1, "1995-01-01", 1.0, 1.0), (2, 1, 4, 1, "1995-01-01", 1.0, 1.0)]
    rows += [(k, 1, 1, 1, "1995-01-01", 1.0, 1.0) for k in range(10, 2000)]  # no order is heavy
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate string, "
                                     "l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/li")
    li = spark.read.parquet(f"{tmp_path}/li")
    got = cart_positions(li)
    assert sorted(map(tuple, got.filter("l_orderkey < 10").collect()), key=str) == sorted(
        [(1, 5, 1), (1, 6, 2), (1, 7, 3), (1, 7, 4), (2, None, 1), (2, 4, 2)], key=str)
    assert not any(c in plan(got) for c in LINE_ORDER if c not in ("l_linenumber", "l_partkey"))


def test_part_map_is_broadcast_by_its_own_size(spark):
    n = 200_000
    part = spark.range(n).select(F.col("id").alias("p_partkey"), F.concat(F.lit("Brand#"), 11 + F.col("id") % 5).alias("p_brand"),
                                 F.concat(F.lit("T"), F.col("id") % 7).alias("p_type"))
    orders = spark.createDataFrame([(1, 1, "prior", 1)], "order_id long, user_id long, eval_set string, order_number int")
    joined = spark.createDataFrame([(1, 3, 1, 1, "prior", 1), (1, n, 2, 1, "prior", 1)],
                                   "order_id long, l_partkey long, add_to_cart_order int, user_id long, eval_set string, order_number int")
    lines = AD.basket_lines(orders, orders, part, "brand_type", joined=joined)
    assert "hashpartitioning(l_partkey" not in plan(lines)
    # part 3: aisle 14, fourth of seven types; the other part is unknown
    assert sorted(r["product_id"] or 0 for r in lines.collect()) == [0, 14 * 8 + 4]
    AD.release_cached()


def test_pairs_are_shuffled_by_user_once(spark):
    """Category counts and shares equal those of ``user_category_affinity``, also of a user
    with very many pairs; a null user and one without orders have none."""
    users = [(u, 10 * u + k, "prior", k, 1, 2, 3.0) for u in range(1, 40) for k in (1, 2)]
    orders = spark.createDataFrame(users, "user_id long, order_id long, eval_set string, order_number int, order_dow int, "
                                          "order_hour_of_day int, days_since_prior_order double")
    bought = [(7, p, 71) for p in range(300)] + [(u, (u * k) % 50, 10 * u + 1) for u in range(1, 40) for k in range(1, 4)]
    bought += [(None, p, 5) for p in range(9)] + [(99, 3, 6), (1, None, 11), (2, 777, 21)]
    lines = spark.createDataFrame([(u, p, o, 1 + (p or 0) % 3, "prior", 1 + o % 2, (p or 0) % 2) for u, p, o in bought],
                                  "user_id long, product_id long, order_id long, add_to_cart_order int, eval_set string, "
                                  "order_number int, reordered int")
    products = spark.createDataFrame([(p, p % 4 if p % 5 else None, p % 3) for p in range(300)], "product_id long, aisle_id int, department_id int")
    pairs = FT.pair_stats(lines)
    for heavy_share in (1 / 256, 2.0):  # with heavy users, and with none
        real = FT.heavy_keys
        FT.heavy_keys = lambda df, key: real(df, key, heavy_share) if heavy_share < 1 else []
        try:
            out = FT.build_features(SimpleNamespace(orders=orders, lines=lines, products=products))
        finally:
            FT.heavy_keys = real
        text = plan(out)  # before it runs: an adaptive plan then shows twice
        got = {(r["user_id"], r["product_id"]): r.asDict() for r in out.collect()}
        assert len(got) == pairs.count()
        for level in ("aisle", "department"):
            count, share = f"user_{level}_purchase_count", f"user_{level}_purchase_share"
            cat = FT.pairs_with_category(pairs, products)
            known = FT.user_category_affinity(cat, level).join(orders.select("user_id").distinct(), "user_id")
            want = cat.join(known, ["user_id", f"{level}_id"], "left").select(
                "user_id", "product_id", "user_product_reorder_rate", "user_product_avg_cart_position",
                F.coalesce(count, F.lit(0)).alias(count), F.coalesce(share, F.lit(0.0)).alias(share))
            for r in want.collect():
                mine = got[r["user_id"], r["product_id"]]
                assert {c: mine[c] for c in r.asDict()} == r.asDict()
        assert got[7, 1]["user_total_orders"] == 2 and got[99, 3]["user_total_orders"] is None
    # without heavy users: the pairs, the users' aggregate and its rows for the join
    assert text.count("Exchange hashpartitioning(user_id") == 3
