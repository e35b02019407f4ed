"""Customer × product behavioural features (the 21-column feature table).

Plan shape, chosen for skewed keys and 100 TB inputs:

* every aggregate is a ``groupBy`` (partial aggregation before the shuffle, so a
  hot user or product is pre-combined map-side);
* user-level values reach the pair rows by one shuffle by user: order features by a join
  on a pre-aggregated row per user, category sums by windows over the user's rows. Users
  that hold very many pairs (found by a sketch) are salted, their category sums aggregated
  and joined — no window holds all rows of such a user;
* the product dimension is deduplicated once, deterministically (lowest
  (aisle_id, department_id) per product), and broadcast only behind a size check;
* null categories are excluded from the category sums and the share
  denominators (pandas drops null group keys; Spark would keep a null group).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.columns import ratio
from cartwise.functions.handoff import remove_at_exit, written
from cartwise.functions.joins import estimated_size_bytes, sized_broadcast
from cartwise.functions.skew import dealt, heavy_keys, repeated, salts_of
from cartwise.sources.schemas import FEATURE_COLUMNS, FEATURE_SCHEMA, TARGET_COLUMN

#: Size on disk up to which the written product values are broadcast: in memory they take several times that.
PRODUCTS_LIMIT = 16 * 1024 * 1024


def prior_orders(orders: DataFrame) -> DataFrame:
    """History only — features never see the 'train' (future) orders."""
    return orders.filter(F.col("eval_set") == "prior")


def prior_lines(orders: DataFrame, order_products_prior: DataFrame) -> DataFrame:
    """Purchase lines joined to their prior order (inner on order_id)."""
    o = prior_orders(orders).select("order_id", "user_id", "order_number")
    return order_products_prior.select("order_id", "product_id", "add_to_cart_order",
                                       "reordered").join(o, "order_id", "inner")


def user_order_features(orders: DataFrame) -> DataFrame:
    """A1 + A4 in one aggregation: per-user order count, three means and the
    user's last prior order number (used for recency)."""
    return (prior_orders(orders).groupBy("user_id").agg(
        F.count("order_id").alias("user_total_orders"),
        F.avg("days_since_prior_order").alias("user_avg_days_between_orders"),
        F.avg("order_hour_of_day").alias("user_avg_order_hour"),
        F.avg("order_dow").alias("user_avg_order_dow"),
        F.max("order_number").alias("user_last_order_number"),
    ))


def pair_sums(lines: DataFrame) -> DataFrame:
    """A2: counts, sums and the last order per (user, product); partial rows merge."""
    return lines.groupBy("user_id", "product_id").agg(
        F.count("order_id").alias("user_product_purchase_count"),
        F.sum("reordered").cast("long").alias("user_product_reorder_count"),
        F.max("order_number").cast("long").alias("user_product_last_order_number"),
        F.sum("add_to_cart_order").cast("long").alias("_cart_sum"),
    )


def pair_ratios(sums: DataFrame) -> DataFrame:
    """A3: the two ratios of :func:`pair_sums`."""
    return sums.select(
        "user_id", "product_id", "user_product_purchase_count", "user_product_reorder_count",
        "user_product_last_order_number",
        ratio("user_product_reorder_count", "user_product_purchase_count")
        .alias("user_product_reorder_rate"),
        ratio("_cart_sum", "user_product_purchase_count").alias("user_product_avg_cart_position"),
    )


def pair_stats(lines: DataFrame) -> DataFrame:
    """A2/A3: one row per (user, product) over the prior lines, with the two ratios."""
    return pair_ratios(pair_sums(lines))


def pair_recency(pairs: DataFrame, users: DataFrame) -> DataFrame:
    """J2 + P6: orders since the pair was last bought."""
    u = users.select("user_id", "user_last_order_number")
    return (pairs.join(u, "user_id", "left")
            .withColumn("user_product_recency_orders",
                        (F.col("user_last_order_number") - F.col("user_product_last_order_number"))
                        .cast("long"))
            .drop("user_last_order_number"))


def dedup_products(products: DataFrame) -> DataFrame:
    """One category row per product — the lowest (aisle_id, department_id)."""
    first = F.min(F.struct(F.col("aisle_id"), F.col("department_id"))).alias("_c")
    return (products.groupBy("product_id").agg(first)
            .select("product_id", F.col("_c.aisle_id").alias("aisle_id"),
                    F.col("_c.department_id").alias("department_id")))


def product_features(pairs: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """A5 (+J3): per-product purchases, distinct buyers and reorder rate.

    The pair table is unique per (user, product), so ``count`` equals the
    distinct user count without a distinct aggregation.
    """
    agg = pairs.groupBy("product_id").agg(
        F.sum("user_product_purchase_count").cast("long").alias("product_total_purchases"),
        F.count("user_id").alias("product_unique_users"),
        F.sum("user_product_reorder_count").alias("_reorders"),
    ).select("product_id", "product_total_purchases", "product_unique_users",
             ratio("_reorders", "product_total_purchases").alias("product_reorder_rate"))
    if products is not None:
        agg = agg.join(sized_broadcast(dedup_products(products)), "product_id", "left")
    return agg


def pairs_with_category(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """Attach aisle and department (null when the product is unknown)."""
    return pairs.join(sized_broadcast(dedup_products(products)), "product_id", "left")


def user_category_affinity(pairs_cat: DataFrame, level: str) -> DataFrame:
    """A6 + W1: per (user, category) purchase count and its share of the user's
    purchases in known categories. ``level`` is 'department' or 'aisle'."""
    key = f"{level}_id"
    known = pairs_cat.filter(F.col(key).isNotNull())
    counts = known.groupBy("user_id", key).agg(
        F.sum("user_product_purchase_count").cast("long").alias(f"user_{level}_purchase_count"))
    totals = known.groupBy("user_id").agg(
        F.sum("user_product_purchase_count").alias("_total"))
    return (counts.join(totals, "user_id", "inner")
            .withColumn(f"user_{level}_purchase_share",
                        ratio(f"user_{level}_purchase_count", "_total"))
            .drop("_total"))


def _category_counts(pairs_cat: DataFrame, level: str) -> DataFrame:
    """Per user a map from category to purchases in it, and their sum (known categories)."""
    key = f"{level}_id"
    counts = (pairs_cat.filter(F.col(key).isNotNull()).groupBy("user_id", key)
              .agg(F.sum("user_product_purchase_count").cast("long").alias("n")))
    return counts.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct(key, "n"))).alias(f"_{level}s"), F.sum("n").alias(f"_{level}_total"))


def customer_product_features(orders: DataFrame, lines: DataFrame,
                              products: DataFrame, reuse: str = "checkpoint",
                              label: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The 21-column feature table, with ``label`` (pairs → pairs with a target column) the
    labelled one: the narrow pair table is joined, as it lies after its aggregation.

    ``lines`` are the prior purchase lines joined to their order
    (order_id, user_id, product_id, order_number, add_to_cart_order, reordered),
    e.g. :func:`prior_lines` of the basket tables.

    The narrow pair table feeds the product aggregate and the output. ``reuse='checkpoint'``
    (default) writes it once to the shared checkpoint folder, so the line table is scanned and
    shuffled once and a lost executor does not replay the pair aggregation; 'persist' caches it
    on the executors instead; None leaves it to exchange reuse, which column pruning usually
    defeats. It is then shuffled once more, by user: a user's purchases by category are window
    sums over its rows as they lie.
    """
    pairs = pair_sums(lines)
    if label is not None:
        pairs = label(pairs)
    users = user_order_features(orders)
    if reuse == "checkpoint":
        pairs, path = written(pairs, "pairs")
        remove_at_exit(pairs.sparkSession, path)
    elif reuse == "persist":
        from pyspark import StorageLevel

        pairs = pairs.persist(StorageLevel.MEMORY_AND_DISK)
    elif reuse is not None:
        raise ValueError("reuse must be 'checkpoint', 'persist' or None")

    prod = product_features(pairs, products)
    if reuse == "checkpoint":  # its size is then known, not guessed from the pairs'
        prod, path = written(prod, "products")
        remove_at_exit(prod.sparkSession, path)

    def with_product(df):
        return df.join(sized_broadcast(prod, PRODUCTS_LIMIT), "product_id", "left")

    # users with very many pairs are spread over tasks; the sums of their categories are
    # aggregated and joined with their order features
    heavy = heavy_keys(pairs, "user_id")
    salts = salts_of(pairs)
    if heavy:
        hot = with_product(pairs.filter(F.col("user_id").isin(heavy)))
        users = users.join(_category_counts(hot, "department"), "user_id", "left").join(
            _category_counts(hot, "aisle"), "user_id", "left")
    # product values that must be shuffled for join while the rows are narrow, others after the shuffle
    size = estimated_size_bytes(prod)
    late = size is not None and size <= PRODUCTS_LIMIT
    rows = dealt(pairs if late else with_product(pairs), "user_id", heavy, F.col("product_id"), salts).repartition("user_id", "_salt")
    rows = with_product(rows) if late else rows
    for level in ("aisle", "department"):
        key, n = f"{level}_id", F.col("user_product_purchase_count")
        rows = rows.withColumn(f"_{level}_n", F.when(F.col(key).isNotNull(), F.sum(n).over(Window.partitionBy("user_id", "_salt", key))))
        rows = rows.withColumn(f"_{level}_sum", F.sum(F.when(F.col(key).isNotNull(), n)).over(Window.partitionBy("user_id", "_salt")))
    out = rows.join(repeated(users, "user_id", heavy, salts), ["user_id", "_salt"], "left")
    known, hot = F.col("user_total_orders").isNotNull(), F.col("user_id").isin(heavy)
    for level in ("aisle", "department"):
        n, total = F.col(f"_{level}_n"), F.col(f"_{level}_sum")
        if heavy:
            n = F.when(hot, F.col(f"_{level}s")[F.col(f"{level}_id")]).otherwise(n)
            total = F.when(hot, F.col(f"_{level}_total")).otherwise(total)
        # a user without orders (or none) has no categories either
        out = out.withColumn(f"user_{level}_purchase_count", F.when(known, n)).withColumn(f"_{level}_total", total)
    dcount = F.coalesce(F.col("user_department_purchase_count"), F.lit(0).cast("long"))
    acount = F.coalesce(F.col("user_aisle_purchase_count"), F.lit(0).cast("long"))
    cols = {
        "user_product_reorder_rate": ratio("user_product_reorder_count", "user_product_purchase_count"),
        "user_product_avg_cart_position": ratio("_cart_sum", "user_product_purchase_count"),
        "user_product_recency_orders":
            (F.col("user_last_order_number") - F.col("user_product_last_order_number")),
        "user_department_purchase_count": dcount,
        "user_department_purchase_share":
            F.coalesce(F.when(F.col("user_department_purchase_count").isNotNull(),
                              ratio(dcount, "_department_total")), F.lit(0.0)),
        "user_aisle_purchase_count": acount,
        "user_aisle_purchase_share":
            F.coalesce(F.when(F.col("user_aisle_purchase_count").isNotNull(),
                              ratio(acount, "_aisle_total")), F.lit(0.0)),
    }
    return out.select(*[
        (cols[f.name] if f.name in cols else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in FEATURE_SCHEMA.fields
    ], *([TARGET_COLUMN] if label is not None else []))


def build_features(basket, reuse: str = "checkpoint", label: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Feature table from a :class:`~cartwise.sources.adapter.Basket` (or any object
    with ``orders``, ``order_products_prior`` and ``products``)."""
    lines = getattr(basket, "lines", None)
    if lines is not None:
        lines = lines.filter(F.col("eval_set") == "prior")
    else:
        lines = prior_lines(basket.orders, basket.order_products_prior)
    return customer_product_features(basket.orders, lines, basket.products, reuse, label)


__all__ = [
    "FEATURE_COLUMNS", "prior_orders", "prior_lines", "user_order_features", "pair_stats",
    "pair_sums", "pair_ratios", "pair_recency", "dedup_products", "product_features", "pairs_with_category",
    "user_category_affinity", "customer_product_features", "build_features",
]
