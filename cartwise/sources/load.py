"""Staged bulk load (S9, V4): parse, keep what is wrong with a row, swap in whole.

The files' lines are parsed by declared types, once: one pass writes good and bad rows to
two folders beside the table, and both are counted there. With more bad rows than allowed
the good ones are deleted and the table stays as it is. Else the table's location is set to
their folder, one change in the catalog, so readers see the old rows or the new ones. Bad
rows are written to a reject table with file, line number, reason and text.

No filter stands on a parsed column: Spark would move it below the parsing and parse a
line anew for every field that the filter names.

Defined cases: a line equal to the header is no row, an empty line neither; a line ends at
its newline, quoted or not; an empty field is null, which is bad only in a required column;
a field that its type can't hold, too few and too many fields are bad; no files or no rows
give an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.functions.handoff import remove
from cartwise.sources.schemas import FEATURE_SCHEMA

KEYS = ("user_id", "product_id")
#: Column of the stage that tells the two folders apart, and the one with a bad row's line.
PART, LINE = "load_rejected", "load_line"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


class LoadRejected(ValueError):
    """Too many bad rows: nothing was loaded. ``rejects`` is the reject table's path."""

    def __init__(self, bad: int, rejects: str):
        super().__init__(f"{bad} bad rows, see {rejects}; the table is unchanged")
        self.bad, self.rejects = bad, rejects


def checked_lines(spark: SparkSession, csv_path: str, schema: T.StructType = FEATURE_SCHEMA, required=KEYS) -> DataFrame:
    """Every line but headers and empty ones: file, block (its split's start), place (order
    in the task), text, the typed columns in ``row``, and ``reason`` (null if it is good)."""
    names = schema.fieldNames()
    lines = spark.read.text(csv_path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("text"))
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("_bad", T.StringType())])
    parsed = lines.withColumn("f", F.from_csv("text", as_text.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                                              {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "escape": '"'}))
    typed = {f.name: F.col(f"f.{f.name}").try_cast(f.dataType) for f in schema.fields}
    reasons = [F.when(F.col("f._bad").isNotNull(), F.lit(f"not {len(names)} fields"))]
    reasons += [F.when(F.col(f"f.{f.name}").isNotNull() & typed[f.name].isNull(),
                       F.concat(F.lit(f"{f.name}: "), F.col(f"f.{f.name}"), F.lit(f" is no {f.dataType.simpleString()}")))
                for f in schema.fields]
    reasons += [F.when(typed[c].isNull(), F.lit(f"{c} is missing")) for c in required if c in names]
    return parsed.select("file", "block", "place", "text", F.struct(*[c.alias(n) for n, c in typed.items()]).alias("row"),
                         F.coalesce(*reasons).alias("reason"))


def _rows(lines: DataFrame, schema: T.StructType) -> DataFrame:
    return lines.filter((F.trim("text") != "") & (F.trim("text") != ",".join(schema.fieldNames())))


def rejects(spark: SparkSession, csv_path: str, schema: T.StructType = FEATURE_SCHEMA, required=KEYS) -> DataFrame:
    """The bad rows: file, line (from 1, headers and empty lines counted), reason, text.
    Lines are numbered by counts per file split, so no file passes through one task."""
    lines = checked_lines(spark, csv_path, schema, required)
    return _numbered(_rows(lines, schema).filter(F.col("reason").isNotNull()), lines)


def _numbered(bad: DataFrame, lines: DataFrame) -> DataFrame:
    """Bad rows with their line: ``lines`` is every line's file, block and place."""
    splits = lines.groupBy("file", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return (bad.join(starts, ["file", "block"])
            .select("file", (F.col("before") + F.col("place") - F.col("first") + 1).alias("line"), "reason", "text"))


def staged_load(spark: SparkSession, csv_path: str, table: str, schema: T.StructType = FEATURE_SCHEMA, required=KEYS,
                max_rejects: int = 0) -> dict:
    """Replace the rows of ``table`` (a Parquet table of the session catalog with the
    columns of ``schema``) by those of the CSV files, or raise :class:`LoadRejected`.
    Returns loaded, rejected, rejects (path or None), location and previous (the folder
    that held the table's rows, left for those who still read it)."""
    previous = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location")
    stage = f"{previous.rstrip('/')}-load-{uuid.uuid4().hex[:12]}"
    lines = checked_lines(spark, csv_path, schema, required)
    good, bad = f"{stage}/{PART}=false", f"{stage}/{PART}=true"
    line = F.when(F.col("reason").isNotNull(), F.struct("file", "block", "place", "reason", "text"))
    sorting = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, "2")  # a task keeps both folders' files open instead of sorting its rows
    try:
        (_rows(lines, schema).select("row.*", line.alias(LINE), F.col("reason").isNotNull().alias(PART))
         .write.partitionBy(PART).option("compression", "zstd").parquet(stage))
    except BaseException:
        remove(spark, stage)
        raise
    finally:
        spark.conf.set(WRITERS, sorting) if sorting is not None else spark.conf.unset(WRITERS)
    fs, path = _fs(spark, stage)
    if not fs.exists(path(good)):  # no good row: an empty table
        spark.createDataFrame([], schema).write.parquet(good)
    loaded, wrong, kept = spark.read.schema(schema).parquet(good).count(), 0, None
    if fs.exists(path(bad)):
        kept = f"{stage}-rejects"
        found = spark.read.parquet(bad).select(f"{LINE}.*")
        _numbered(found, lines).write.parquet(kept)
        wrong = spark.read.parquet(kept).count()
        remove(spark, bad)
    if wrong > max_rejects:
        remove(spark, stage)
        raise LoadRejected(wrong, kept)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{good}'")
    spark.catalog.refreshTable(table)
    return {"loaded": loaded, "rejected": wrong, "rejects": kept, "location": good, "previous": previous}


def _fs(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
