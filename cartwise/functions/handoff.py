"""Intermediate tables written to the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from cartwise.session import checkpoint_dir


def written(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back, and
    the path. Cuts lineage: every executor sees the files, and one that is lost
    makes only the step that reads them run again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/step-{tag}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_AT_EXIT: list = []


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a written table when the driver ends: for tables that a result which is
    still to be computed reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not _AT_EXIT:
        atexit.register(_remove_noted)
    _AT_EXIT.append((p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())))


def _remove_noted() -> None:
    for p, fs in _AT_EXIT:
        with contextlib.suppress(Exception):  # the JVM may have ended before
            fs.delete(p, True)
