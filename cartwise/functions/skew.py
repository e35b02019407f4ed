"""Equi-joins that spread heavy keys by themselves, whatever the adaptive settings are.

A frequent-items sketch names the keys that hold a large share of the rows; their rows are
dealt out over salts and the other side's rows of these keys are repeated once per salt. All
other keys have one salt. Which keys the sketch names changes the plan's balance, never the
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy from this share of the rows on, so at most 1 / SHARE keys are.
SHARE = 1 / 256
#: Counters of the sketch: it errs by a few rows in so many, far below SHARE.
TRACKED = 16_384
MAX_SALTS = 4_096
#: Salts per shuffle partition: several, since they fall into partitions by hash.
PER_PARTITION = 4


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> list:
    """Keys that hold at least ``share`` of the rows (by the sketch's estimate; one that
    holds clearly more is never missed): at most ``1 / share`` values. Null is none."""
    k = int(1 / share)
    found = df.select(F.col(key).alias("k")).agg(
        F.count("k").alias("n"),
        F.expr(f"approx_top_k(k, {k}, {TRACKED}) FILTER (WHERE k IS NOT NULL)").alias("top")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] >= max(2.0, found["n"] * share)]


def salts_of(df: DataFrame) -> int:
    """PER_PARTITION salts for every shuffle partition, up to MAX_SALTS."""
    return max(2, min(MAX_SALTS, PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def dealt(df: DataFrame, key: str, heavy: list, by: Column | None = None, salts: int | None = None) -> DataFrame:
    """``df`` with ``_salt``: rows of ``heavy`` keys and of a null ``key`` are spread over
    ``salts`` values by the hash of ``by`` (default: all columns), all others have 0."""
    salts = salts or salts_of(df)
    hot = F.coalesce(F.col(key).isin(heavy), F.lit(False)) if heavy else F.lit(False)
    spread = F.pmod(F.xxhash64(by if by is not None else F.struct(*[F.col(f"`{c}`") for c in df.columns])), F.lit(salts))
    return df.withColumn("_salt", F.when(hot | F.col(key).isNull(), spread).otherwise(F.lit(0)).cast("int"))


def repeated(df: DataFrame, key: str, heavy: list, salts: int | None = None) -> DataFrame:
    """``df`` with ``_salt``, its rows of ``heavy`` keys once for each salt: what joins the
    rows of :func:`dealt` on ``key`` and ``_salt``. Null keys match nothing and are left out."""
    salts = salts or salts_of(df)
    hot = F.coalesce(F.col(key).isin(heavy), F.lit(False)) if heavy else F.lit(False)
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return df.filter(F.col(key).isNotNull()).withColumn("_salt", F.explode(copies))


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", heavy: list | None = None,
                by: Column | None = None, salts: int | None = None) -> DataFrame:
    """``left`` joined to ``right`` on ``key`` (``how``: left or inner), the rows of heavy keys
    of ``left`` spread over ``salts`` tasks by the hash of ``by`` (default: all columns). Rows
    with a null key match nothing and are spread likewise. ``right`` should hold few rows per
    heavy key: they are repeated ``salts`` times. ``heavy`` is found by the sketch if not given
    (a pass over the key column alone)."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    heavy = heavy_keys(left, key) if heavy is None else heavy
    salts = salts or salts_of(left)
    return dealt(left, key, heavy, by, salts).join(repeated(right, key, heavy, salts), [key, "_salt"], how).drop("_salt")
