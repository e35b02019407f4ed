"""Skew-safe sequencing: ROW_NUMBER / LAG / is-last within a group.

A window ``PARTITION BY key ORDER BY ...`` sends every row of a key to one task.
With a key that holds a third of all rows that task does a third of the work
and cannot be split by AQE. This helper gives the same three results with the
groups spread over many tasks:

1. ``repartitionByRange(n, key..., order...)`` + ``sortWithinPartitions``: range
   bounds are sampled over the full sort tuple, so a hot key is cut into
   several contiguous partitions of similar size; n grows with the input.
2. One vectorised pass per partition (``mapInArrow``) numbers rows within each
   key *locally*, takes local lags and flags the local last row, carrying state
   across the batches of the partition. Columns stay Arrow arrays throughout:
   64-bit integers beside nulls keep every digit. The numbered rows are written
   to the shared folder, so the pass runs once for both of its readers and a
   lost executor doesn't repeat it.
3. Only the first key of a partition can have begun in an earlier partition,
   and only its last key can continue in a later one. The per-partition head
   and tail rows (at most 2·n rows, n = partition count) give the missing
   offsets; that table has a proven size bound and is broadcast back.

Result: one range shuffle, no single-task group, exact numbering. The sort
tuple must be a total order (unique) for the numbering to be deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.functions.handoff import remove, written
from cartwise.functions.joins import input_size_bytes

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Input bytes (as the plan estimates them) for one range partition.
PARTITION_BYTES = 64 * 1024 * 1024
_WRITTEN: list[tuple[SparkSession, str]] = []


def release_cached() -> None:
    """Delete the numbered rows kept by :func:`sequence_within` (call once the
    results that depend on them have been written)."""
    while _WRITTEN:
        remove(*_WRITTEN.pop())


def release_held(hold: list) -> None:
    """Delete the numbered rows noted in a caller's ``hold`` list."""
    while hold:
        remove(*hold.pop())


def _make_numberer(key_names: list[str], lag_names: list[str], integral_lags: set[str]):
    def number(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def follows(a, b):
            """Element-wise: b equals a, nulls equal to nulls."""
            both = pc.and_(pc.is_null(a), pc.is_null(b))
            return pc.or_(pc.fill_null(pc.equal(a, b), False), both).to_numpy(zero_copy_only=False)

        prev_keys = prev_lags = None   # one-row arrays of the last row seen
        prev_run = 0                   # its local row number
        held = None                    # batch waiting for the next one (last flag)
        first = True

        def finish(batch, flags, ends_key, is_tail):
            rn, head, last, lags = flags
            last[-1] = ends_key
            tail = np.zeros(len(rn), dtype=bool)
            tail[-1] = is_tail
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rn), pa.array(head), pa.array(tail), pa.array(last), *lags],
                names=[*batch.schema.names, "_seq_rn", "_seq_head", "_seq_tail", "_seq_last",
                       *[f"_seq_lag_{i}" for i in range(len(lags))]])

        for batch in batches:
            m = batch.num_rows
            if m == 0:
                continue
            keys = [batch.column(batch.schema.get_field_index(k)) for k in key_names]
            sources = [batch.column(batch.schema.get_field_index(c)).cast(pa.int64() if c in integral_lags else pa.float64())
                       for c in lag_names]
            same = np.ones(m, dtype=bool)
            for k in keys:
                same[1:] &= follows(k.slice(0, m - 1), k.slice(1))
            same[0] = prev_keys is not None and all(
                bool(follows(a, k.slice(0, 1))[0]) for a, k in zip(prev_keys, keys))
            if held is not None:
                # the held batch's last row ends its key unless this row continues it
                yield finish(*held, not same[0], False)
            start = np.where(~same, np.arange(m), 0)
            rn = np.arange(m) - np.maximum.accumulate(start) + 1
            if same[0]:
                other = np.nonzero(~same)[0]
                rn[:other[0] if len(other) else m] += prev_run
            last = np.ones(m, dtype=bool)
            last[:-1] = ~same[1:]
            head = np.zeros(m, dtype=bool)
            head[0] = first
            lags = []
            for i, src in enumerate(sources):
                before = prev_lags[i] if prev_lags is not None else pa.nulls(1, src.type)
                shifted = pa.concat_arrays([before, src.slice(0, m - 1)])
                lags.append(pc.if_else(pa.array(same), shifted, pa.scalar(None, src.type)))
            prev_keys = [k.slice(m - 1, 1) for k in keys]
            prev_lags = [c.slice(m - 1, 1) for c in sources]
            prev_run = int(rn[-1])
            held = batch, (rn.astype("int64"), head, last, lags)
            first = False
        if held is not None:
            yield finish(*held, True, True)

    return number


def _null_safe_eq(a, b) -> bool:
    return a == b if a is not None and b is not None else a is b


def sequence_within(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                    rn_col: str | None = "rn", lags: dict[str, str] | None = None,
                    last_col: str | None = None, num_partitions: int | None = None,
                    hold: list | None = None) -> DataFrame:
    """Add ROW_NUMBER (``rn_col``), LAG (``lags``: source column → output name) and an
    is-last-in-group flag (``last_col``) over ``PARTITION BY keys ORDER BY order_by``
    (ascending), with no group pinned to one task. Lag sources must be numeric.

    The numbered rows stay written until :func:`release_cached`; a caller that
    passes a list as ``hold`` gets them noted there instead and deletes them with
    :func:`release_held` once its result is computed.
    """
    spark = df.sparkSession
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              -(-(input_size_bytes(df) or 0) // PARTITION_BYTES))
    keys, order_by = list(keys), list(order_by)
    lags = dict(lags or {})
    lag_names = list(lags)
    sort_cols = keys + order_by
    ranged = df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
    fields = list(ranged.schema.fields)
    # The range partition index, taken from the partition itself (inside a union
    # the task's partition id is the union's index, not this one).
    ranged = ranged.withColumn("_seq_pid", F.spark_partition_id())
    integral = {c for c in lag_names if isinstance(ranged.schema[c].dataType, _INTEGRAL)}
    lag_fields = [T.StructField(f"_seq_lag_{i}",
                                T.LongType() if c in integral else T.DoubleType())
                  for i, c in enumerate(lag_names)]
    schema = T.StructType(fields + [
        T.StructField("_seq_pid", T.IntegerType(), False),
        T.StructField("_seq_rn", T.LongType()),
        T.StructField("_seq_head", T.BooleanType()),
        T.StructField("_seq_tail", T.BooleanType()),
        T.StructField("_seq_last", T.BooleanType()),
    ] + lag_fields)
    seq = ranged.mapInArrow(_make_numberer(keys, lag_names, integral), schema)

    # one write serves both readers: the boundary rows (one head and one tail per
    # non-empty partition, at most 2·n rows whatever the data size) and the output
    seq, path = written(seq, "sequence")
    (hold if hold is not None else _WRITTEN).append((spark, path))
    edge_rows = seq.filter(F.col("_seq_head") | F.col("_seq_tail")).select(
        "_seq_pid", "_seq_head", "_seq_tail", "_seq_rn",
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[F.col(c).cast("long" if c in integral else "double").alias(f"_v{i}")
          for i, c in enumerate(lag_names)]).collect()
    if len(edge_rows) > 2 * n:
        raise AssertionError(f"{len(edge_rows)} boundary rows for {n} partitions")
    bounds = _boundary_offsets(spark, edge_rows, [ranged.schema[k] for k in keys],
                               [T.LongType() if c in integral else T.DoubleType()
                                for c in lag_names])

    joined = seq.join(F.broadcast(bounds), seq["_seq_pid"] == bounds["_b_key"], "left")
    cont = F.col("_b_cum").isNotNull()
    for i, k in enumerate(keys):
        cont = cont & F.col(k).eqNullSafe(F.col(f"_bp{i}"))
    cont = F.coalesce(cont, F.lit(False))
    out_cols = [F.col(f.name) for f in fields]
    if rn_col:
        out_cols.append((F.col("_seq_rn") + F.when(cont, F.col("_b_cum")).otherwise(F.lit(0)))
                        .cast("long").alias(rn_col))
    for i, c in enumerate(lag_names):
        out_cols.append(F.when(cont & (F.col("_seq_rn") == 1), F.col(f"_bv{i}"))
                        .otherwise(F.col(f"_seq_lag_{i}")).alias(lags[c]))
    if last_col:
        out_cols.append(F.when(F.col("_seq_tail") & F.coalesce(F.col("_b_cont"), F.lit(False)),
                               F.lit(False)).otherwise(F.col("_seq_last")).alias(last_col))
    return joined.select(*out_cols)


def _boundary_offsets(spark, edge_rows, key_fields, lag_types) -> DataFrame:
    """Per non-empty partition: the key, running count and lag values carried in
    from the partitions before it (``_bp*``, ``_b_cum``, ``_bv*``) and whether its
    last key continues in the next partition (``_b_cont``). Input and output have
    at most 2·n and n rows (n = partition count)."""
    nk, nl = len(key_fields), len(lag_types)
    heads, tails = {}, {}
    for r in edge_rows:
        key = tuple(r[f"_k{i}"] for i in range(nk))
        if r["_seq_head"]:
            heads[r["_seq_pid"]] = key
        if r["_seq_tail"]:
            tails[r["_seq_pid"]] = (key, r["_seq_rn"], tuple(r[f"_v{i}"] for i in range(nl)))

    def same(a, b):
        return a is not None and b is not None and all(_null_safe_eq(x, y) for x, y in zip(a, b))

    pids = sorted(tails)
    rows, carry = [], None            # carry: (key, running count, lag values)
    for j, pid in enumerate(pids):
        key, local_n, vals = tails[pid]
        nxt = heads.get(pids[j + 1]) if j + 1 < len(pids) else None
        ck, cn, cv = carry if carry is not None else ((None,) * nk, None, (None,) * nl)
        rows.append((pid, *ck, cn, *cv, same(key, nxt)))
        carry = (key, local_n + (cn if carry is not None and same(ck, key) else 0), vals)
    schema = T.StructType(
        [T.StructField("_b_key", T.IntegerType(), False)]
        + [T.StructField(f"_bp{i}", f.dataType) for i, f in enumerate(key_fields)]
        + [T.StructField("_b_cum", T.LongType())]
        + [T.StructField(f"_bv{i}", t) for i, t in enumerate(lag_types)]
        + [T.StructField("_b_cont", T.BooleanType(), False)])
    return spark.createDataFrame(rows, schema)
