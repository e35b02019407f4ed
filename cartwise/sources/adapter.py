"""Adapter: the driver's TPC-H-style tables seen as basket tables.

Rules (FIXTURES.md):

* order_id, user_id        = o_orderkey, o_custkey
* order_number             = row number per customer by (o_orderdate, o_orderkey)
* eval_set                 = 'train' for a customer's last order, else 'prior'
* order_dow                = day of week, Sunday = 0
* order_hour_of_day        = o_orderkey % 24 (synthetic stand-in)
* days_since_prior_order   = days since the customer's previous order, null first
* add_to_cart_order        = row number within the order by (l_linenumber, l_partkey,
                             l_suppkey, l_shipdate, l_quantity, l_extendedprice)
* reordered                = 1 if the customer bought the product in a lower
                             order_number, else 0
* aisle_id                 = the number in p_brand ('Brand#13' -> 13)
* department_id            = rank of p_type among the distinct p_type values
* product_id               = l_partkey (grain 'part') or aisle_id*(departments+1)+department_id
                             (grain 'brand_type', used for modelling where the part
                             grain has too few positives); null for a line whose part
                             is unknown at the latter grain

Per-customer numbering uses :func:`sequence_within`, so a hot customer is spread over
many tasks. Lines are numbered in their order by a window, whose shuffle serves the join
with the orders too; orders that hold a large share of all lines are found by a sketch
(:func:`heavy_keys`) and numbered by :func:`sequence_within`. In the same way the first
order of a pair is a window's minimum, and that of a heavy pair an aggregate joined back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.functions import sequence
from cartwise.functions.handoff import written
from cartwise.functions.joins import sized_broadcast
from cartwise.functions.sequence import release_cached, sequence_within
from cartwise.functions.skew import heavy_keys

GRAINS = ("part", "brand_type")

# Sort tuple that makes lineitem rows unique within an order (measured).
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
              "l_extendedprice"]


@dataclass
class Basket:
    """The basket tables of one data set."""

    orders: DataFrame                 # ORDERS schema
    order_products_prior: DataFrame   # order_id, product_id, add_to_cart_order, reordered
    order_products_train: DataFrame   # same columns, lines of the 'train' orders
    products: DataFrame               # product_id, aisle_id, department_id
    lines: DataFrame                  # lines joined to their order (all eval sets)


def read_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def part_categories(part: DataFrame) -> DataFrame:
    """p_partkey → aisle_id, department_id (department = rank of the distinct p_type),
    departments (how many there are)."""
    types = part.select("p_type").filter(F.col("p_type").isNotNull()).distinct()
    # windows over the distinct category values only (a small dimension)
    types = (types.withColumn("department_id",
                              F.dense_rank().over(Window.orderBy("p_type")).cast("int"))
             .withColumn("departments", F.max("department_id").over(
                 Window.orderBy("p_type").rowsBetween(Window.unboundedPreceding,
                                                      Window.unboundedFollowing))))
    return (part.select("p_partkey", "p_brand", "p_type")
            .join(sized_broadcast(types), "p_type", "left")
            .select("p_partkey",
                    F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int").alias("aisle_id"),
                    "department_id", "departments"))


def basket_products(part: DataFrame, grain: str = "part") -> DataFrame:
    """Products table at the chosen grain, plus the part → product map."""
    cats = part_categories(part)
    if grain == "part":
        return cats.select(F.col("p_partkey").alias("product_id"), "aisle_id", "department_id")
    if grain == "brand_type":
        return (cats.select(product_key().alias("product_id"), "aisle_id", "department_id")
                .distinct())
    raise ValueError(f"grain must be one of {GRAINS}")


def product_key() -> F.Column:
    """One number per (aisle, department): the base exceeds every department."""
    return (F.col("aisle_id").cast("long") * (F.col("departments") + 1)
            + F.col("department_id").cast("long"))


def part_to_product(part: DataFrame, grain: str) -> DataFrame:
    cats = part_categories(part)
    if grain == "part":
        return cats.select("p_partkey", F.col("p_partkey").alias("product_id"))
    return cats.select("p_partkey", product_key().alias("product_id"))


def basket_orders(orders: DataFrame) -> DataFrame:
    """orders → ORDERS schema (all eval sets)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate",
                      F.unix_date(F.to_date("o_orderdate")).alias("_day"))
    seq = sequence_within(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], rn_col="_n",
                          lags={"_day": "_prev_day"}, last_col="_is_last")
    return seq.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("_is_last"), F.lit("train")).otherwise(F.lit("prior")).alias("eval_set"),
        F.col("_n").cast("int").alias("order_number"),
        (F.dayofweek("o_orderdate") - 1).cast("int").alias("order_dow"),
        (F.col("o_orderkey") % 24).cast("int").alias("order_hour_of_day"),
        (F.col("_day") - F.col("_prev_day")).cast("double").alias("days_since_prior_order"),
    )


def cart_positions(lineitem: DataFrame) -> DataFrame:
    """lineitem → (l_orderkey, l_partkey, add_to_cart_order): the row number
    within each order by the line sort tuple. Independent of the product grain.
    Lines of equal number and part give equal rows in any order, so the window sorts
    by these two and moves no other column."""
    li = lineitem.select("l_orderkey", *LINE_ORDER)
    heavy = heavy_keys(li, "l_orderkey")
    hot = F.coalesce(F.col("l_orderkey").isin(heavy), F.lit(False))
    cols = ["l_orderkey", "l_partkey", "add_to_cart_order"]
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey"))
    out = (li.filter(~hot) if heavy else li).select("l_orderkey", "l_linenumber", "l_partkey").withColumn("add_to_cart_order", n).select(*cols)
    if heavy:  # the whole tuple cuts an order of many equal lines into several ranges
        out = out.unionByName(sequence_within(li.filter(hot), ["l_orderkey"], LINE_ORDER, rn_col="add_to_cart_order").select(*cols))
    return out.withColumn("add_to_cart_order", F.col("add_to_cart_order").cast("int"))


def order_lines(lineitem: DataFrame, orders_b: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """Numbered lines joined to their order; independent of the product grain."""
    li = positions if positions is not None else cart_positions(lineitem.filter(F.col("l_orderkey").isNotNull()))
    o = orders_b.select("order_id", "user_id", "eval_set", "order_number")
    return (li.withColumnRenamed("l_orderkey", "order_id").join(o, "order_id", "inner")
            .select("order_id", "l_partkey", "add_to_cart_order", "user_id", "eval_set", "order_number"))


def with_first(lines: DataFrame) -> DataFrame:
    """Lines with ``_first``, the least order_number of their (user, product), nulls equal
    to nulls. ``lines`` are read twice, so they should be written."""
    pair = ["user_id", "product_id"]
    keyed = lines.withColumn("_pair", F.xxhash64(*pair))
    heavy = heavy_keys(keyed, "_pair")
    first = F.min("order_number").over(Window.partitionBy(*pair))
    if not heavy:
        return lines.withColumn("_first", first)
    hot = keyed.filter(F.col("_pair").isin(heavy)).drop("_pair")
    # about as many rows as there are heavy keys
    least = hot.groupBy(*pair).agg(F.min("order_number").alias("_first")).select(
        F.col("user_id").alias("_u"), F.col("product_id").alias("_p"), "_first")
    match = F.col("user_id").eqNullSafe(F.col("_u")) & F.col("product_id").eqNullSafe(F.col("_p"))
    rest = keyed.filter(~F.col("_pair").isin(heavy)).drop("_pair").withColumn("_first", first)
    return rest.unionByName(hot.join(F.broadcast(least), match).drop("_u", "_p"))


def basket_lines(lineitem: DataFrame, orders_b: DataFrame, part: DataFrame,
                 grain: str = "part", positions: DataFrame | None = None,
                 joined: DataFrame | None = None) -> DataFrame:
    """lineitem → lines with order_id, user_id, eval_set, order_number, product_id,
    add_to_cart_order, reordered. ``positions``, ``joined``: already written
    :func:`cart_positions` or :func:`order_lines` of the same lineitem."""
    if grain == "part":
        pmap = None
    else:  # written, so that its size is known: a join's estimate multiplies its sides
        pmap, path = written(part_to_product(part, grain), "partmap")
        sequence._WRITTEN.append((part.sparkSession, path))
        pmap = sized_broadcast(pmap)

    def with_product(df):
        if pmap is None:
            return df.withColumn("product_id", F.col("l_partkey"))
        return df.join(pmap, df["l_partkey"] == F.col("p_partkey"), "left")

    if joined is None:
        joined, path = written(order_lines(lineitem, orders_b, positions), "orderlines")
        sequence._WRITTEN.append((lineitem.sparkSession, path))
    lines = with_product(joined).select("order_id", "product_id", "add_to_cart_order", "user_id", "eval_set", "order_number")
    return (with_first(lines)
            .withColumn("reordered", (F.col("order_number") > F.col("_first")).cast("int"))
            .select("user_id", "product_id", "order_id", "add_to_cart_order", "eval_set",
                    "order_number", "reordered"))


def _basket(orders_b: DataFrame, lines: DataFrame, products: DataFrame) -> Basket:
    cols = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    return Basket(
        orders=orders_b,
        order_products_prior=lines.filter(F.col("eval_set") == "prior").select(*cols),
        order_products_train=lines.filter(F.col("eval_set") == "train").select(*cols),
        products=products,
        lines=lines,
    )


def adapt(spark: SparkSession, sf_dir: str, grain: str = "part") -> Basket:
    """Lazy basket tables straight from the driver's tables (one plan)."""
    t = read_tables(spark, sf_dir, "orders", "lineitem", "part")
    orders_b = basket_orders(t["orders"])
    lines = basket_lines(t["lineitem"], orders_b, t["part"], grain)
    return _basket(orders_b, lines, basket_products(t["part"], grain))


_LOADED: dict[tuple, Basket] = {}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _input_fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Every data file of the three tables (path, length, time), also those in
    partition folders: rewriting, adding or deleting one gives another text."""
    parts = []
    for name in ("orders", "lineitem", "part"):
        fs, p = _fs(spark, f"{sf_dir}/{name}.parquet")
        files = fs.listFiles(p, True)
        while files.hasNext():
            st = files.next()
            parts.append(f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}")
    return "|".join(sorted(parts))


def load_basket(spark: SparkSession, sf_dir: str, grain: str = "part") -> Basket:
    """Basket tables written once as Parquet under the shared checkpoint folder
    (``spark.checkpoint.dir``) and read back.

    The adapter is an ETL step: its sequencing and joins run once per input,
    lines are partitioned by eval_set (prior / train) so that feature and label
    jobs prune to their half, and every later query starts from short lineage.
    """
    import hashlib

    from cartwise.session import checkpoint_dir, code_fingerprint

    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    fp = _input_fingerprint(spark, sf_dir)
    key = hashlib.md5(f"{fp}|{grain}|{code_fingerprint()}".encode()).hexdigest()[:16]
    memo = (spark.sparkContext.applicationId, key)
    if memo in _LOADED:
        return _LOADED[memo]
    # orders and the lines joined to them do not depend on the product grain:
    # numbered and written once per input
    okey = hashlib.md5(f"{fp}|shared|{code_fingerprint()}".encode()).hexdigest()[:16]
    orders_path = f"{checkpoint_dir(spark)}/basket-orders-{okey}"
    joined_path = f"{checkpoint_dir(spark)}/basket-orderlines-{okey}"
    fs, odone = _fs(spark, f"{orders_path}/_SUCCESS")
    if not fs.exists(odone):
        write_orders(spark, sf_dir, orders_path)
    _, jdone = _fs(spark, f"{joined_path}/_SUCCESS")
    if not fs.exists(jdone):
        write_order_lines(spark, sf_dir, joined_path, orders_path)
    root = f"{checkpoint_dir(spark)}/basket-{grain}-{key}"
    _, done = _fs(spark, f"{root}/_BASKET_DONE")
    if not fs.exists(done):
        write_basket(spark, sf_dir, grain, root, orders_path, joined_path=joined_path)
        fs.create(done, True).close()
    b = read_basket(spark, root, orders_path)
    _LOADED[memo] = b
    return b


def write_orders(spark: SparkSession, sf_dir: str, path: str) -> None:
    """ORDERS (sequenced per customer) written as Parquet at ``path``; shared by
    every product grain."""
    basket_orders(read_tables(spark, sf_dir, "orders")["orders"]) \
        .write.mode("overwrite").option("compression", "zstd").parquet(path)
    release_cached()


def write_cart_positions(spark: SparkSession, sf_dir: str, path: str) -> None:
    """:func:`cart_positions` written as Parquet at ``path``; shared by every
    product grain."""
    cart_positions(read_tables(spark, sf_dir, "lineitem")["lineitem"]) \
        .write.mode("overwrite").parquet(path)
    release_cached()


def write_order_lines(spark: SparkSession, sf_dir: str, path: str, orders_path: str) -> None:
    """:func:`order_lines` written as Parquet at ``path``; shared by every product grain."""
    order_lines(read_tables(spark, sf_dir, "lineitem")["lineitem"], spark.read.parquet(orders_path)) \
        .write.mode("overwrite").option("compression", "zstd").parquet(path)
    release_cached()


def write_basket(spark: SparkSession, sf_dir: str, grain: str, root: str,
                 orders_path: str | None = None, positions_path: str | None = None,
                 joined_path: str | None = None) -> None:
    """The adapter ETL: orders (sequenced per customer; written under ``root``
    unless an already written ``orders_path`` is given), lines (cart positions
    — from ``positions_path`` when given — mapped to the grain's product, joined
    to their order, reorder flag; partitioned by eval_set) and products, written
    as Parquet under ``root``."""
    if orders_path is None:
        orders_path = f"{root}/orders"
        write_orders(spark, sf_dir, orders_path)
    t = read_tables(spark, sf_dir, "lineitem", "part")
    orders_b = spark.read.parquet(orders_path)
    positions = spark.read.parquet(positions_path) if positions_path else None
    joined = spark.read.parquet(joined_path) if joined_path else None
    (basket_lines(t["lineitem"], orders_b, t["part"], grain, positions, joined)
     .write.mode("overwrite").option("compression", "zstd").partitionBy("eval_set").parquet(f"{root}/lines"))
    basket_products(t["part"], grain).write.mode("overwrite").parquet(f"{root}/products")
    release_cached()


def read_basket(spark: SparkSession, root: str, orders_path: str | None = None) -> Basket:
    return _basket(spark.read.parquet(orders_path or f"{root}/orders"),
                   spark.read.parquet(f"{root}/lines"), spark.read.parquet(f"{root}/products"))
