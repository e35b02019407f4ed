"""Exact top-k search by distributed histogram selection.

Vectors are quantised to integers and packed into row blocks; queries are
packed into query blocks. Every row block meets every query block once per
round (an equi-join on the query block's number, broadcast only below a
measured size) and scores all its pairs with one matrix product. The first
rounds keep score histograms alone: a round counts, per query, the scores in
equal-width buckets, the global histogram shows the bucket with the k-th
value, and the next round splits just that bucket, until it is one integer
wide. The last round keeps scores above the k-th value and, of those equal to
it, each block's smallest ids, from which ties are settled by id.

A block's histogram is cut below the bucket that holds the block's own k-th
score, since no bucket below can hold the global one; that drops no answer.

Defined cases: rows with a null vector, or a null or non-finite component, take
no part; missing trailing components count as zero, an empty vector as all
zeros; rows with a repeated id are candidates one by one (a query is asked once,
with the smallest of its vectors) and never answer a query of the same id; rows
with a null id take no part; fewer than k candidates give all; an empty table
gives no rows; other columns are ignored. Finite components of any size take
part; where the longest query times the longest vector could pass a 64-bit score
(2^62 after scaling), top_k raises a ValueError instead of leaving rows out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import broadcast_if, staged

BLOCK_ROWS, BLOCK_QUERIES = 2048, 2048
BUCKETS = 1024
#: Up to here sums of integer products are exact in double precision.
EXACT = 1 << 53
#: Scores below this, and the width between two of them, fit 64 bits.
LARGEST = 1 << 62


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): vectors as integer arrays, bad rows left out."""
    v = F.col(vector_col).cast("array<double>")
    ok = (v.isNotNull() & F.col(id_col).isNotNull()
          & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    whole = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))))
    return vectors.filter(ok).select(F.col(id_col).cast("bigint").alias("id"), whole.alias("v"))


def _norm2() -> Column:
    """Largest squared length of the vectors v."""
    return F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))


def _blocks(rows: DataFrame, dim: int, size: int) -> DataFrame:
    """Blocks of up to ``size`` rows: ids and vectors (padded to ``dim``) as bytes."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists = part.column(1)
                lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                m = np.zeros((part.num_rows, dim), dtype=np.int64)
                m[np.arange(dim)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()], pa.binary()),
                     pa.array([m.tobytes()], pa.binary())], names=["ids", "m"])

    return rows.select("id", "v").mapInArrow(run, "ids binary, m binary")


def _product(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact integer inner products, queries by rows."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, rows.shape[1])
    if 0 <= most < EXACT:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def _scored(pairs: DataFrame, dim: int, each, schema: str) -> DataFrame:
    """Run ``each(scores, row ids, query ids, state)`` over every pair of blocks;
    a row's own query is masked out."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, qids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["qids"], np.int64)
                s = _product(np.frombuffer(r["m"], np.int64).reshape(-1, dim), np.frombuffer(r["qm"], np.int64).reshape(-1, dim))
                own = ids[None, :] == qids[:, None]
                columns = each(s, own, ids, qids, r.get("state"))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for _, c in columns], names=[n for n, _ in columns])

    return pairs.mapInArrow(run, schema)


def top_k(vectors: DataFrame, k: int, is_query, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256, buckets: int = BUCKETS) -> DataFrame:
    """query_id, rank, ``id_col``, score: the k highest inner products of each row
    where the condition ``is_query`` holds (on column ``id_col``) with the others."""
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, scale)
    reach = rows.agg(F.max(F.size("v")).alias("dim"), _norm2().alias("norm2")).first()
    dim = reach["dim"] or 1
    asked = (rows.withColumn(id_col, F.col("id")).filter(is_query).groupBy("id").agg(F.min("v").alias("v")))
    asked = staged(asked, "topk-queries")
    n_queries, asked_norm2 = asked.agg(F.count(F.lit(1)), _norm2()).first()
    empty = spark.createDataFrame([], f"query_id bigint, rank int, {id_col} bigint, score bigint")
    if not n_queries:
        return empty
    # the largest possible |score|, by Cauchy-Schwarz over the quantised vectors
    bound = int(math.sqrt(reach["norm2"]) * math.sqrt(asked_norm2) * (1 + 1e-9)) + 1
    if bound >= LARGEST:
        raise ValueError(f"top_k: scores can reach {bound:.3g}, which does not fit 64 bits (longest query times longest "
                         f"vector, components scaled by {scale}); scale the vectors down")
    n_blocks = -(-n_queries // BLOCK_QUERIES)
    # queries are dealt to blocks by hash
    numbered = asked.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
    row_blocks = staged(_blocks(rows, dim, BLOCK_ROWS), "topk-rows")
    query_bytes = n_queries * (16 * dim + 64)
    state = staged(numbered.select(F.col("id").alias("query_id"), "qb", F.lit(-bound).cast("bigint").alias("low"),
                                   F.lit(0).cast("bigint").alias("above")), "topk-state")

    def pairs(state: DataFrame) -> DataFrame:
        """Each row block with each query block; the block's queries carry their state."""
        q = (numbered.join(state.drop("qb"), numbered.id == F.col("query_id"))
             .groupBy("qb").agg(F.sort_array(F.collect_list(F.struct("id", "low", "above", "v"))).alias("q")))

        def flat(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    qids = np.array([x["id"] for x in r["q"]], np.int64)
                    m = np.zeros((len(qids), dim), np.int64)
                    for i, x in enumerate(r["q"]):
                        m[i, :len(x["v"])] = x["v"]
                    known = np.array([[x["low"], x["above"]] for x in r["q"]], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([r["qb"]], pa.int64())] + [pa.array([b.tobytes()], pa.binary()) for b in (qids, m, known)],
                                                     names=["qb", "qids", "qm", "state"])

        q = q.mapInArrow(flat, "qb bigint, qids binary, qm binary, state binary")
        spread = row_blocks.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))
        return spread.join(broadcast_if(q, query_bytes), "qb").select("ids", "m", "qids", "qm", "state")

    def histogram(span: int, width: int):
        """Counts per query and bucket of ``width`` in [low, low + span)."""

        def each(s, own, ids, qids, known):
            low = np.frombuffer(known, np.int64).reshape(-1, 2)[:, 0]
            out = ([], [], [])
            for i in range(len(qids)):
                x = s[i][~own[i]]
                x = x[(x >= low[i]) & (x < low[i] + span)]
                if not len(x):
                    continue
                if len(x) > k:  # nothing below this block's k-th value can be the global one
                    x = x[x >= low[i] + (np.partition(x, len(x) - k)[len(x) - k] - low[i]) // width * width]
                b, n = np.unique((x - low[i]) // width, return_counts=True)
                for column, v in zip(out, (np.full(len(b), qids[i]), b, n), strict=True):
                    column.append(v)
            return [(n, np.concatenate(c) if c else np.empty(0, np.int64)) for n, c in zip(("query_id", "b", "n"), out, strict=True)]

        return each

    span = 2 * bound + 1
    while span > 1:
        width = -(-span // buckets)
        counts = (_scored(pairs(state), dim, histogram(span, width), "query_id bigint, b bigint, n bigint")
                  .groupBy("query_id", "b").agg(F.sum("n").alias("n")))
        down = Window.partitionBy("query_id").orderBy(F.desc("b"))
        seen = state.join(counts, "query_id").withColumn("upto", F.sum("n").over(down) + F.col("above"))
        # the highest bucket by which k scores are reached; with fewer than k in all, none
        hit = (seen.filter(F.col("upto") >= k).groupBy("query_id")
               .agg(F.max_by(F.struct((F.col("low") + F.col("b") * width).alias("to"),
                                      (F.col("upto") - F.col("n")).alias("over")), "b").alias("x")))
        state = staged(state.join(hit, "query_id", "left").select(
            "query_id", "qb", F.coalesce("x.to", "low").alias("low"), F.coalesce("x.over", "above").alias("above")), "topk-state")
        span = width

    def answers(s, own, ids, qids, known):
        low = np.frombuffer(known, np.int64).reshape(-1, 2)[:, 0]
        out = ([], [], [])
        for i in range(len(qids)):
            free = ~own[i]
            more = np.nonzero((s[i] > low[i]) & free)[0]
            ties = np.nonzero((s[i] == low[i]) & free)[0]
            if len(ties) > k:
                ties = ties[np.argsort(ids[ties], kind="stable")[:k]]
            at = np.concatenate([more, ties])
            if len(at) > k:  # a query with fewer than k candidates in all has no threshold
                at = at[np.lexsort((ids[at], -s[i][at]))[:k]]
            out[0].append(np.full(len(at), qids[i]))
            out[1].append(ids[at])
            out[2].append(s[i][at])
        return [(n, np.concatenate(c) if c else np.empty(0, np.int64)) for n, c in zip(("query_id", "id", "score"), out, strict=True)]

    found = _scored(pairs(state), dim, answers, "query_id bigint, id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
