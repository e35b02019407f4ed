"""Exact order statistics by radix descent on sortable 64-bit images.

The k-th row of a group (a split threshold, a quantile) is located without
sorting or shuffling the table. A value's image is a 64-bit integer of the same
order: an integer is its own image, a double's are its IEEE bits, all but the sign
flipped where it is negative. A target starts with the whole range of images; each
round counts the rows of up to ``1 << BITS`` equal slices of it, by subtraction and
shift alone, and goes on in the slice that holds the k-th row, shrunk to the
smallest and largest image found there. It ends when that slice holds a single
value: each round takes BITS bits off, so seven end it whatever the values are,
infinities, subnormals and values on a third of the rows included.

A round is one pass: every task counts its slices in arrays (one Arrow batch after
another) and gives a row per slice it has met, at most targets x slices, which
Spark sums. No sketch, no sort, no window, no row is copied or moved.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 10
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def image(column: pa.Array) -> np.ndarray:
    """Order-preserving 64-bit integers of a column's values without nulls (of doubles
    also without NaN; -0.0 counts as 0.0)."""
    if pa.types.is_integer(column.type):
        return column.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    x = column.drop_null().to_numpy(zero_copy_only=False)
    bits = (x[~np.isnan(x)] + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(_MOST), bits)


def value(image: int, integral: bool):
    """The value of an image."""
    if integral:
        return image
    return float(np.int64(image if image >= 0 else image ^ _MOST).view(np.float64))


def _slices(parts: list[tuple[int, int, int]]):
    """Count the images of each part (column, lowest, highest): rows of part, slice, rows,
    smallest and largest image."""

    def run(batches):
        held: dict = {}
        for batch in batches:
            columns: dict = {}
            for j, (i, lo, hi) in enumerate(parts):
                if i not in columns:
                    columns[i] = image(batch.column(i))
                x = columns[i]
                if (lo, hi) != (_LEAST, _MOST):
                    x = x[(x >= lo) & (x <= hi)]
                if not len(x):
                    continue
                if j not in held:
                    held[j] = (np.zeros(1 << BITS, np.int64), np.full(1 << BITS, _MOST), np.full(1 << BITS, _LEAST))
                # distances fit 64 bits without a sign
                at = ((x.view(np.uint64) - np.int64(lo).view(np.uint64)) >> np.uint64(max(0, (hi - lo).bit_length() - BITS))).astype(np.int64)
                n, low, high = held[j]
                n += np.bincount(at, minlength=1 << BITS)
                np.minimum.at(low, at, x)
                np.maximum.at(high, at, x)
        for j, (n, low, high) in held.items():
            at = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), j)), *(pa.array(c) for c in (at, n[at], low[at], high[at]))],
                                             names=["part", "slice", "n", "low", "high"])

    return run


def _locate(df: DataFrame, values: dict, targets: dict) -> dict:
    """{(name, k): (value, rows of that name below the value)}.

    ``values``: {name: numeric column, null where the row doesn't belong to the
    name}; ``targets``: {name: ks}, each k between 1 and the name's row count.
    """
    names = [n for n in targets if targets[n]]
    if not names:
        return {}
    read = df.select(*[values[n].alias(f"v{i}") for i, n in enumerate(names)])
    integral = [isinstance(f.dataType, _INTEGRAL) for f in read.schema.fields]
    read = read.select(*[F.col(f"v{i}").cast("long" if whole else "double") for i, whole in enumerate(integral)])
    # open parts: (column, lowest, highest image) -> [(k, rows below)]
    parts = {(i, _LEAST, _MOST): [(k, 0) for k in sorted(set(targets[n]))] for i, n in enumerate(names)}
    found: dict = {}
    while parts:
        rows = (read.mapInArrow(_slices(list(parts)), "part bigint, slice bigint, n bigint, low bigint, high bigint")
                .groupBy("part", "slice").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect())
        counted: dict = {}
        for r in sorted(rows, key=lambda r: (r["part"], r["slice"])):
            counted.setdefault(r["part"], []).append(r)
        nxt: dict = {}
        for j, ((i, _, _), ks) in enumerate(parts.items()):
            for k, below in ks:
                for r in counted[j]:
                    if k <= below + r["n"]:
                        if r["low"] == r["high"]:
                            found[(names[i], k)] = (value(r["low"], integral[i]), below)
                        else:
                            nxt.setdefault((i, r["low"], r["high"]), []).append((k, below))
                        break
                    below += r["n"]
        parts = nxt
    return found


def kth_tuples(df: DataFrame, order: list[str], targets: dict, group: str | None = None) -> dict:
    """Exact k-th rows in ascending ``order``, nulls first in every column but the first,
    which is numeric and whose nulls are excluded.

    targets: {group value: (group row count, [k1, k2, ...])}
    Returns {(group value, k): tuple of the ``order`` columns}.

    Rows that share the k-th leading value are told apart by the other columns:
    their distinct tuples are counted and read, so the leading column should be
    (nearly) distinct, as the leading bits of a hash are.
    """
    lead = order[0]
    df = df.filter(F.col(lead).isNotNull())
    belongs = {g: F.lit(True) if group is None else F.col(group) == F.lit(g) for g in targets}
    values = {g: F.when(belongs[g], F.col(lead)) for g in targets}
    found = _locate(df, values, {g: [k for k in ks if 1 <= k <= n] for g, (n, ks) in targets.items()})
    if not found:
        return {}
    at = {(g, v) for (g, _), (v, _) in found.items()}
    where = None
    for g, v in at:
        here = belongs[g] & (F.col(lead) == F.lit(v))
        where = here if where is None else where | here
    keys = ([F.col(group).alias("_g")] if group is not None else [F.lit(None).alias("_g")]) + [F.col(c) for c in order]
    tied = df.filter(where).select(*keys).groupBy("_g", *order).agg(F.count(F.lit(1)).alias("_m")).collect()
    result = {}
    for (g, k), (v, below) in found.items():
        mine = sorted(((tuple(r[c] for c in order), r["_m"]) for r in tied
                       if r[lead] == v and (group is None or r["_g"] == g)),
                      key=lambda x: [(c is not None, c) for c in x[0]])
        for t, m in mine:
            below += m
            if k <= below:
                result[(g, k)] = t
                break
    return result


def tuple_le(order: list[str], values: tuple) -> Column:
    """Row tuple (order columns) <= ``values`` lexicographically, nulls first in every
    column: never null itself, so a row is on exactly one side of the cut."""
    expr = F.lit(True)
    for c, v in zip(reversed(order), reversed(values)):
        below = F.lit(False) if v is None else F.col(c).isNull() | F.coalesce(F.col(c) < F.lit(v), F.lit(False))
        expr = below | (F.col(c).eqNullSafe(F.lit(v)) & expr)
    return expr


def _number(c: str) -> Column:
    """A column as double; NaN counts as missing."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def column_order_stats(df: DataFrame, targets: dict) -> dict:
    """Exact k-th smallest values of several numeric columns of one table:
    {(column, k): value}. targets: {column: (non-null count, [k1, k2, ...])}.
    Nulls and NaN are ignored. All columns share each round's single pass."""
    found = _locate(df, {c: _number(c) for c in targets},
                    {c: [k for k in ks if 1 <= k <= n] for c, (n, ks) in targets.items()})
    return {key: v for key, (v, _) in found.items()}


def column_quantiles(df: DataFrame, cols: list[str], probs) -> dict:
    """Exact linear-interpolated quantiles of several columns:
    {(column, p): value} (None for an all-null column): the two order statistics
    around each position ``p·(n-1)``."""
    counts = df.agg(*[F.count(_number(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    targets, plan = {}, []
    for i, c in enumerate(cols):
        n = counts[f"n{i}"]
        for p in probs:
            at = p * (n - 1)
            if n:
                targets.setdefault(c, (n, set()))[1].update((math.floor(at) + 1, math.ceil(at) + 1))
            plan.append((c, p, n, at))
    kth = column_order_stats(df, {c: (n, sorted(ks)) for c, (n, ks) in targets.items()})
    out = {}
    for c, p, n, at in plan:
        if not n:
            out[(c, p)] = None
            continue
        out[(c, p)] = between(kth[(c, math.floor(at) + 1)], kth[(c, math.ceil(at) + 1)], at - math.floor(at))
    return out


def between(lo: float, hi: float, share: float) -> float:
    """Linear interpolation that also holds where hi - lo isn't finite."""
    if lo == hi or share == 0:
        return lo
    return lo + (hi - lo) * share if math.isfinite(hi - lo) else lo * (1 - share) + hi * share
