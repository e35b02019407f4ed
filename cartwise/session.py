"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes, coalesces
# small shuffle partitions and splits skewed join partitions; ANSI stays on.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cartwise", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above.

    On a cluster the session normally exists already (spark-submit); then those
    defaults that a running session takes and that nobody has set are filled in.
    ``master`` is only used when building.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        spark = active
        for k, v in DEFAULT_CONF.items():
            if spark.conf.isModifiable(k) and spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
    else:
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master)
        for k, v in DEFAULT_CONF.items():
            builder = builder.config(k, v)
        if shuffle_partitions:
            builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        for k, v in (extra or {}).items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir`` as the cluster names it. Only when it is
    unset (local tests) a private scratch folder is created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="cartwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


_CODE_FP: str | None = None


def code_fingerprint() -> str:
    """md5 over the library's source files: stage tables written by other code
    versions are never reused."""
    global _CODE_FP
    if _CODE_FP is None:
        import hashlib
        import pathlib

        root = pathlib.Path(__file__).resolve().parent
        h = hashlib.md5()
        for f in sorted(root.rglob("*.py")):
            h.update(f.relative_to(root).as_posix().encode())
            h.update(f.read_bytes())
        _CODE_FP = h.hexdigest()[:12]
    return _CODE_FP
