"""Data-quality reports: one aggregation pass, a long (check, column, value) table.

Exact quartiles for the profile come from exact order statistics on the wide
table — no sort and no single-task percentile buffer.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.functions.columns import ratio
from cartwise.functions.select import column_quantiles
from cartwise.sources.schemas import COUNT_FEATURES, ID_COLUMNS, RATE_FEATURES

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def _long(rows: list[tuple[str, str, F.Column]], df: DataFrame) -> DataFrame:
    """Evaluate all aggregate expressions in one pass and unpivot to long form."""
    aggs = [e.cast("double").alias(f"_m{i}") for i, (_, _, e) in enumerate(rows)]
    wide = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("check"), F.lit(col).alias("column"),
                               F.col(f"_m{i}").alias("value"))
                      for i, (c, col, _) in enumerate(rows)])
    return wide.select(F.explode(pairs).alias("r")).select("r.check", "r.column", "r.value")


def quality_report(features: DataFrame, keys=ID_COLUMNS, rate_cols=RATE_FEATURES,
                   count_cols=COUNT_FEATURES) -> DataFrame:
    """V5 (A9–A13): rows, duplicate keys, nulls and infinities per column, min/max
    of the rate columns, negatives per count column — as (check, column, value)."""
    rows: list[tuple[str, str, F.Column]] = [("row_count", "*", F.count(F.lit(1)))]
    for c in features.columns:
        rows.append(("null_count", c, F.count_if(F.col(c).isNull())))
    for c in numeric_columns(features):
        if isinstance(features.schema[c].dataType, (T.FloatType, T.DoubleType)):
            rows.append(("infinite_count", c,
                         F.count_if(F.col(c).isin(float("inf"), float("-inf")))))
        else:
            rows.append(("infinite_count", c, F.lit(0)))
    for c in rate_cols:
        rows.append(("min", c, F.min(c)))
        rows.append(("max", c, F.max(c)))
    for c in count_cols:
        rows.append(("negative_count", c, F.count_if(F.col(c) < 0)))
    # keys are counted apart: beside a distinct count every other aggregate would be shuffled per key
    known = [F.col(k).isNotNull() for k in keys]
    per_key = features.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    extra = (F.coalesce(F.sum("_n"), F.lit(0)) - F.count_if(reduce(and_, known))).cast("double")
    doubles = per_key.agg(extra.alias("value")).select(
        F.lit("duplicate_keys").alias("check"), F.lit(",".join(keys)).alias("column"), "value")
    return _long(rows, features).unionByName(doubles)


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column (column, null_count)."""
    rep = _long([("null_count", c, F.count_if(F.col(c).isNull())) for c in df.columns], df)
    return rep.select("column", F.col("value").cast("long").alias("null_count"))


def warehouse_checks(features: DataFrame) -> DataFrame:
    """The load checks of the warehouse script as one row."""
    # rows where either id is null are no pair; counted apart, so that the shuffle holds ids alone
    pairs = (features.select("user_id", "product_id").filter("user_id IS NOT NULL AND product_id IS NOT NULL")
             .distinct().agg(F.count(F.lit(1)).alias("unique_customer_product_pairs")))

    def bad_rate(c):
        return F.count_if((F.col(c) < 0) | (F.col(c) > 1))

    found = features.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("user_id").isNull()).alias("null_user_ids"),
        F.count_if(F.col("product_id").isNull()).alias("null_product_ids"),
        F.count_if(F.col("user_product_purchase_count") < 0).alias("negative_purchase_counts"),
        F.count_if(F.col("user_product_reorder_count") < 0).alias("negative_reorder_counts"),
        bad_rate("user_product_reorder_rate").alias("invalid_reorder_rates"),
        bad_rate("user_department_purchase_share").alias("invalid_department_shares"),
        bad_rate("user_aisle_purchase_share").alias("invalid_aisle_shares"),
        bad_rate("product_reorder_rate").alias("invalid_product_reorder_rates"),
    )
    # both sides are single rows
    return found.crossJoin(F.broadcast(pairs)).select("row_count", "unique_customer_product_pairs", *found.columns[1:])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, count, share) sorted by value; share over the whole table."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    # ``total`` is a single row; a join on a constant key keeps it a broadcast join
    return (counts.withColumn("_k", F.lit(1))
            .join(F.broadcast(total.withColumn("_k", F.lit(1))), "_k")
            .select(F.col(col), "count", ratio("count", "_n").alias("share"))
            .orderBy(col))


def class_distribution(df: DataFrame, target: str = "target", name: str = "all") -> DataFrame:
    """D3: class counts and percentages of one split, tagged with ``name``."""
    vc = value_counts(df, target)
    return vc.select(F.lit(name).alias("split"), F.col(target).alias("class"), "count",
                     (F.col("share") * 100).alias("percent"))


def distinct_count(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """Exact (or HyperLogLog++) number of distinct values."""
    f = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(f.alias(f"{col}_distinct"))


def class_rate(df: DataFrame, target: str = "target") -> DataFrame:
    """Mean of the 0/1 target."""
    return df.agg(F.avg(F.col(target).cast("double")).alias("positive_rate"))


def exact_quantiles(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Linear-interpolated quantiles (pandas ``describe`` / SQL ``quantile_cont``)
    of several columns: (column, p, value). Nulls and NaN are skipped.

    The two order statistics around each quantile position are found exactly
    by :func:`column_quantiles` on the wide table, by radix descent in passes
    that all columns share: no sort, no sketch, no shuffle of the rows, no
    single-task buffer of a column's values. Infinities are values like others.
    """
    res = column_quantiles(df, cols, [float(p) for p in probs])
    rows = [(c, float(p), res[(c, float(p))]) for c in cols for p in probs]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")


def profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, std (sample), min, 25%, 50%, 75%, max per column, long form
    (column, statistic, value)."""
    cols = cols or numeric_columns(df)
    rows = []
    for c in cols:
        x = F.col(c).cast("double")
        rows += [("count", c, F.count(x)), ("mean", c, F.avg(x)), ("std", c, F.stddev_samp(x)),
                 ("min", c, F.min(x)), ("max", c, F.max(x))]
    basic = _long(rows, df).select("column", F.col("check").alias("statistic"), "value")
    q = exact_quantiles(df, cols).select(
        "column", F.concat((F.col("p") * 100).cast("int").cast("string"), F.lit("%"))
        .alias("statistic"), "value")
    return basic.unionByName(q)


def dtypes(df: DataFrame) -> DataFrame:
    """A14 (``info``): column names and Spark types as a table."""
    spark = df.sparkSession
    return spark.createDataFrame([(n, t) for n, t in df.dtypes], "column string, type string")
