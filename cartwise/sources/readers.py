"""Typed readers for the basket CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cartwise.sources.schemas import FEATURE_SCHEMA, SOURCE_SCHEMAS, TRAINING_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None,
             limit: int | None = None, mode: str = "FAILFAST",
             repartition: int | None = None) -> DataFrame:
    """CSV with a header and a declared schema (no inference).

    * ``columns``: column pruning (S2) — Catalyst reads only what is selected;
    * ``limit``: row-limited read (S4);
    * ``.gz`` files are decompressed transparently (S5) but are not splittable:
      pass ``repartition`` to spread a single large gzip file after the read;
    * ``mode='FAILFAST'`` aborts on the first malformed row (S9, the bulk-load
      rule); 'PERMISSIVE' keeps going.
    """
    df = (spark.read.schema(schema).option("header", True).option("mode", mode)
          .option("quote", '"').option("escape", '"').csv(path))
    if columns:
        df = df.select(*columns)
    if repartition:
        df = df.repartition(repartition)
    if limit is not None:
        df = df.limit(limit)
    return df


def read_source(spark: SparkSession, data_dir: str, name: str, **kw) -> DataFrame:
    """One of the six basket source files (``orders.csv``, ``products.csv`` ...)."""
    return read_csv(spark, f"{data_dir}/{name}.csv", SOURCE_SCHEMAS[name], **kw)


def read_features(spark: SparkSession, path: str, fmt: str = "parquet", **kw) -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(FEATURE_SCHEMA).parquet(path)
    return read_csv(spark, path, FEATURE_SCHEMA, **kw)


def read_training(spark: SparkSession, path: str, fmt: str = "parquet", **kw) -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(TRAINING_SCHEMA).parquet(path)
    return read_csv(spark, path, TRAINING_SCHEMA, **kw)


class BasketFiles:
    """The reference's six CSV inputs as DataFrames (same attribute names as
    :class:`cartwise.sources.adapter.Basket`)."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.orders = read_source(spark, data_dir, "orders")
        self.order_products_prior = read_source(spark, data_dir, "order_products__prior")
        self.order_products_train = read_source(spark, data_dir, "order_products__train")
        self.products = read_source(spark, data_dir, "products")
        self.aisles = read_source(spark, data_dir, "aisles")
        self.departments = read_source(spark, data_dir, "departments")
        self.lines = None
