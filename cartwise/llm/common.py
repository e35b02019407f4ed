"""Helpers shared by the operators: input tables and written hand-offs."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.handoff import remove_at_exit
from cartwise.session import checkpoint_dir

# A side is hinted for broadcast only when its measured size is at most this.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024

#: Innermost list that :func:`staged` notes its folders in.
_NOTED: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back."""
    return _kept(df, tag)[0]


def _kept(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, tag: str) -> DataFrame:
    """A step's hand-off, written and read back like :func:`written`.

    Cuts lineage: a lost executor recomputes at most the step that reads the
    table, and row ids made before the write keep their values. Inside
    :func:`noting` the folder is noted for a later :func:`release`, elsewhere it is
    deleted when the driver ends (what is returned lazily may be read until then).
    """
    out, path = _kept(df, tag)
    if _NOTED:
        _NOTED[-1].append(path)
    else:
        remove_at_exit(df.sparkSession, path)
    return out


@contextlib.contextmanager
def noting(folders: list[str]):
    """Note the folders staged inside the block in ``folders``."""
    _NOTED.append(folders)
    try:
        yield
    finally:
        _NOTED.pop()


def release(spark: SparkSession, folders: list[str]) -> None:
    """Delete noted folders; call it once what is built on them has been written."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while folders:
        p = jvm.org.apache.hadoop.fs.Path(folders.pop())
        p.getFileSystem(conf).delete(p, True)


def broadcast_if(df: DataFrame, size_bytes: int, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast when its measured ``size_bytes`` is within the
    limit; beyond it the join shuffles (and AQE may split skewed keys)."""
    return F.broadcast(df) if size_bytes <= limit else df
