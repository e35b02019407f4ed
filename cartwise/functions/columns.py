"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double, null when the denominator is 0 or null.

    Spark 4 runs in ANSI mode, where a plain ``/`` by zero raises even for
    doubles; the counts used here are >= 1 by construction, but generic helpers
    must not fail on an empty group.
    """
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(n.cast("double"), d.cast("double"))


def hash_order_key(seed: int, *cols: str) -> Column:
    """Seeded, engine-independent ordering key: md5 of ``c1-c2-...-seed``.

    md5 over the same text gives the same digest in Spark and DuckDB, so
    samples and splits drawn with it can be checked against SQL.
    """
    parts = [F.col(c).cast("string") for c in cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("-", *parts))


def round_doubles(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every double column (for order-insensitive comparison only)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def require_columns(df: DataFrame, cols, what: str = "input") -> None:
    """Raise ValueError naming the columns ``df`` lacks."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
