"""Approximate nearest neighbours by largest inner product: a forest of random-projection
trees searched through one priority queue, leaf candidates reranked exactly.

Vectors get one more component that brings all to the longest vector's length, which
makes the largest inner product the least distance. A tree splits by orthogonal random
directions, one a level, at the medians of a bounded sample; every row of the table
is then put into one leaf per tree. A query walks down all trees with a single queue:
the next leaf is the one whose cell lies nearest, by the squared margins crossed on the
way. How many leaves a query opens is calibrated: a bounded set of queries is answered
by brute force, and the number is the least by which ``target`` of their true
neighbours is found (``recall`` measures the same on the result).

On Spark: equal vectors are one entry with its smallest ids; the entries, one copy a
tree, are dealt by leaf and written as blocks; queries are packed by their home leaf, so
that a pack opens much the same leaves. The leaves that a pack opens meet the blocks by
an equi-join, a broadcast only below the measured bound, and a pair of block and pack is
one matrix product. Leaves are opened in rounds, each of four times the leaves before it,
and a round passes on only what reaches the k-th score so far: some tens of rows a query
and round, however many rows the leaves hold. Scores are summed component by component in
double precision on the original vectors. A query that finds fewer than k is asked again
against all leaves of one tree. On data without clusters the calibrated number is a
large share of all leaves: then the work grows with queries times rows, in blocks.

Defined cases: rows with a null id, or a vector that is null, all zeros, or holds null or
non-finite components take no part. Missing trailing components count as zero. Rows with a
repeated id are candidates one by one and never answer a query of their id, which is
asked once, with the smallest of its vectors. Fewer than k candidates give all, an empty
table no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm.common import broadcast_if, staged

TREES, LEAF_ROWS, MAX_DEPTH = 3, 200, 12
#: Bounds of the sample that the trees are fitted on and of the calibration's queries.
SAMPLE_ROWS, CALIBRATION_QUERIES = 1 << 16, 128
TARGET_RECALL = 0.95
BLOCK_ROWS, PACK_QUERIES = 2048, 1024
#: Leaves opened by the end of a round, as a multiple of those before it.
GROWTH = 4
#: Rows of a leaf that are dealt to one task.
CHUNK_ROWS = 50_000
_ALL = 1 << 62


@dataclass
class Forest:
    """Trees of one depth: a direction per level, a threshold per inner node (heap order)."""

    directions: np.ndarray  # trees x components + 1 x depth
    thresholds: np.ndarray  # trees x 2 ** depth
    longest: float

    @property
    def depth(self) -> int:
        return self.directions.shape[2]

    def _projected(self, x: np.ndarray, more: np.ndarray) -> np.ndarray:
        """Rows x trees x levels."""
        return np.einsum("nd,tdl->ntl", np.concatenate([x, more[:, None]], 1), self.directions, optimize=True)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Each row's leaf in each tree."""
        p = self._projected(x, np.sqrt(np.maximum(self.longest**2 - (x * x).sum(1), 0)))
        node = np.ones(p.shape[:2], np.int64)
        trees = np.arange(p.shape[1])[None, :]
        for level in range(self.depth):
            node = 2 * node + (p[:, :, level] > self.thresholds[trees, node])
        return node - (1 << self.depth)

    def asked(self, q: np.ndarray) -> np.ndarray:
        """Projections of queries, brought to the rows' length (their last component is 0)."""
        norm = np.sqrt((q * q).sum(1, keepdims=True))
        return self._projected(q * (self.longest / norm), np.zeros(len(q)))

    def costs(self, q: np.ndarray) -> np.ndarray:
        """Squared margins between each query and each leaf: queries x (trees x leaves)."""
        p = self.asked(q)
        out = []
        for t in range(p.shape[1]):
            cost = np.zeros((len(q), 1))
            for level in range(self.depth):
                margin = p[:, t, level, None] - self.thresholds[t, 1 << level:2 << level][None, :]
                left, right = np.maximum(margin, 0) ** 2, np.minimum(margin, 0) ** 2
                cost = np.stack([cost + left, cost + right], 2).reshape(len(q), -1)
            out.append(cost)
        return np.concatenate(out, 1)

    def search(self, projected: list, splits: list, first: int, last: int):
        """(tree, leaf) in the order of the shared queue, from the ``first`` to before the
        ``last`` leaf; ``projected``: trees x levels of one query, ``splits``: the
        thresholds as lists."""
        queue = [(0.0, t, 1) for t in range(len(projected))]
        opened, end = 0, 1 << self.depth
        while queue and opened < last:
            cost, t, node = heapq.heappop(queue)
            p, split, level = projected[t], splits[t], node.bit_length() - 1
            while node < end:
                margin = p[level] - split[node]
                near = 2 * node + (margin > 0)
                heapq.heappush(queue, (cost + margin * margin, t, near ^ 1))
                node, level = near, level + 1
            if opened >= first:
                yield t, node - end
            opened += 1


def fit(sample: np.ndarray, longest: float, rows: int, trees: int = TREES, seed: int = 1, leaf_rows: int = LEAF_ROWS) -> Forest:
    """A forest for ``rows`` rows from a sample of them."""
    dim = sample.shape[1] + 1
    # a leaf gets 16 rows of the sample at least, so that medians mean something
    most = max(1, int(math.log2(max(2, len(sample) // 16))))
    depth = max(1, min(MAX_DEPTH, most, math.ceil(math.log2(max(2, rows / leaf_rows)))))
    rng = np.random.default_rng(seed)
    directions = []
    for _ in range(trees):
        r = rng.normal(size=(dim, depth))
        directions.append(np.linalg.qr(r)[0] if depth <= dim else r / np.linalg.norm(r, axis=0))
    forest = Forest(np.stack(directions), np.zeros((trees, 1 << depth)), longest)
    p = forest._projected(sample, np.sqrt(np.maximum(longest**2 - (sample * sample).sum(1), 0)))
    for t in range(trees):
        node = np.ones(len(sample), np.int64)
        for level in range(depth):
            x = p[:, t, level]
            order = np.lexsort((x, node))
            ids, at, n = np.unique(node[order], return_index=True, return_counts=True)
            forest.thresholds[t, ids] = (x[order[at + (n - 1) // 2]] + x[order[at + n // 2]]) / 2
            node = 2 * node + (x > forest.thresholds[t, node])
    return forest


def _matrix(lists, dim: int, dtype=np.float64) -> np.ndarray:
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), dim), dtype)
    out[np.arange(dim)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _kept(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    v = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    ok = (v.isNotNull() & F.col(id_col).isNotNull()
          & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0))
    return vectors.filter(ok).select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """(entry, ids, v): distinct vectors with the ids that can answer. A query leaves out
    its own id, so of an id k rows and of a vector 2 k rows are enough; both limits
    are applied in each task before rows are dealt."""
    of_id = Window.partitionBy("v", "id").orderBy("id")
    of_vector = Window.partitionBy("v").orderBy("id", "_n")
    few = rows.withColumn("_n", F.row_number().over(of_id)).filter(F.col("_n") <= k)
    few = few.withColumn("_m", F.row_number().over(of_vector)).filter(F.col("_m") <= 2 * k)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.xxhash64("v").alias("entry"), "ids", "v")


class _Block:
    """Entries of one leaf: vectors, and ids one after another with each entry's end."""

    SCHEMA = "tree int, leaf int, entries binary, ends binary, ids binary, m binary"

    def __init__(self, r: dict, dim: int, dtype):
        self.m = np.frombuffer(r["m"], dtype).reshape(-1, dim).astype(np.float64)
        self.entries = np.frombuffer(r["entries"], np.int64)
        self.ids = np.frombuffer(r["ids"], np.int64)
        self.ends = np.frombuffer(r["ends"], np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        # an entry all of whose ids are one can't answer that id's query (ids are sorted)
        self.first = self.ids[self.starts]
        self.single = self.first == self.ids[self.ends - 1]

    def own(self, qids: np.ndarray) -> np.ndarray:
        return self.single[None, :] & (self.first[None, :] == qids[:, None])


def _index(entries: DataFrame, forest: Forest, dim: int, dtype, chunks: int) -> DataFrame:
    """Blocks of the entries by tree and leaf."""
    vector = entries.schema["v"].dataType.simpleString()

    def dealt(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf = forest.leaves(_matrix(batch.column(2), dim))
            for t in range(leaf.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, t, np.int32)), pa.array(leaf[:, t].astype(np.int32)), *batch.columns],
                    names=["tree", "leaf", "entry", "ids", "v"])

    rows = entries.mapInArrow(dealt, f"tree int, leaf int, entry bigint, ids array<bigint>, v {vector}")
    by = ["tree", "leaf", F.pmod("entry", F.lit(chunks))]
    rows = rows.repartition(*by).sortWithinPartitions("tree", "leaf", "entry")

    def packed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(0).to_numpy().astype(np.int64) << 32 | batch.column(1).to_numpy()
            cuts = [0, *(np.nonzero(at[1:] != at[:-1])[0] + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                for i in range(a, b, BLOCK_ROWS):
                    part = batch.slice(i, min(BLOCK_ROWS, b - i))
                    ends = np.cumsum(part.column(3).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
                    blobs = (part.column(2).to_numpy(), ends, part.column(3).flatten().to_numpy(), _matrix(part.column(4), dim, dtype))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).slice(0, 1), part.column(1).slice(0, 1), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)],
                        names=["tree", "leaf", "entries", "ends", "ids", "m"])

    return staged(rows.mapInArrow(packed, _Block.SCHEMA), "forest-index")


def _nearest_in(blocks: DataFrame, forest: Forest, qids: np.ndarray, q: np.ndarray, k: int, dim: int, dtype) -> list:
    """(query's place, leaves of a true neighbour per tree) of a few queries, by brute
    force over one tree's blocks: k neighbours a task and query, then k in all."""

    def run(batches):
        best = np.full((len(q), k), -np.inf)
        leaf = np.zeros((len(q), k, len(forest.directions)), np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                block = _Block(r, dim, dtype)
                s = np.concatenate([best, np.where(block.own(qids), -np.inf, q @ block.m.T)], 1)
                of = np.concatenate([leaf, np.broadcast_to(forest.leaves(block.m)[None], (len(q), len(block.m), leaf.shape[2]))], 1)
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                best, leaf = np.take_along_axis(s, top, 1), np.take_along_axis(of, top[:, :, None], 1)
        i, j = np.nonzero(best > -np.inf)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, leaf.shape[2] * len(i) + 1, leaf.shape[2], dtype=np.int32)), pa.array(leaf[i, j].reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(best[i, j]), lists], names=["i", "score", "leaves"])

    found = blocks.filter("tree = 0").mapInArrow(run, "i bigint, score double, leaves array<bigint>")
    best = Window.partitionBy("i").orderBy(F.desc("score"), "leaves")
    rows = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).select("i", "leaves").collect()
    return [(r["i"], r["leaves"]) for r in rows]


def _calibrated(forest: Forest, q: np.ndarray, neighbours: list, target: float) -> int:
    """Leaves to open so that ``target`` of the neighbours lie in one of them."""
    if not neighbours:
        return 1
    cost = forest.costs(q)
    place = np.argsort(np.argsort(cost, axis=1, kind="stable"), axis=1)
    n_leaves = 1 << forest.depth
    needed = sorted(min(int(place[i, t * n_leaves + leaf]) for t, leaf in enumerate(leaves)) + 1 for i, leaves in neighbours)
    return needed[min(len(needed), math.ceil(target * len(needed))) - 1]


def _packs(asked: DataFrame, forest: Forest, dim: int) -> DataFrame:
    """Queries in packs of much the same home leaf: pack, qids, qm."""

    def home(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = forest.leaves(_matrix(batch.column(1), dim))[:, 0]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["id", "v", "home"])

    def packed(batches):
        n = 0
        for batch in batches:
            for at in range(0, batch.num_rows, PACK_QUERIES):
                part = batch.slice(at, PACK_QUERIES)
                blobs = (part.column(0).to_numpy(), _matrix(part.column(1), dim))
                yield pa.RecordBatch.from_arrays([part.column(2).slice(0, 1), pa.array([n], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)],
                                                 names=["p", "n", "qids", "qm"])
                n += 1

    rows = asked.mapInArrow(home, f"id bigint, v {asked.schema['v'].dataType.simpleString()}, home bigint")
    rows = rows.repartitionByRange("home", "id").sortWithinPartitions("home", "id").withColumn("p", F.spark_partition_id())
    packs = rows.select("id", "v", "p").mapInArrow(packed, "p int, n bigint, qids binary, qm binary")
    # the numbers are drawn before the write, so a repeated task sees the same ones
    return staged(packs.select((F.shiftleft(F.col("p").cast("bigint"), 32) + F.col("n")).alias("pack"), "qids", "qm"), "forest-packs")


def _visits(packs: DataFrame, forest: Forest, dim: int, first: int, last: int, tree: int | None = None) -> DataFrame:
    """The leaves that each pack opens, with its queries that do (places in the pack)."""

    def run(batches):
        splits = forest.thresholds.tolist()
        for batch in batches:
            for r in batch.to_pylist():
                q = np.frombuffer(r["qm"], np.float64).reshape(-1, dim)
                who: dict = {}
                if tree is not None:
                    who = {(tree, leaf): range(len(q)) for leaf in range(1 << forest.depth)}
                else:
                    for i, p in enumerate(forest.asked(q).tolist()):
                        for at in forest.search(p, splits, first, last):
                            who.setdefault(at, []).append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["pack"]] * len(who), pa.int64()), pa.array([t for t, _ in who], pa.int32()), pa.array([x for _, x in who], pa.int32()),
                     pa.array([np.array(x, np.int32).tobytes() for x in who.values()], pa.binary())], names=["pack", "tree", "leaf", "who"])

    return staged(packs.mapInArrow(run, "pack bigint, tree int, leaf int, who binary"), "forest-visits")


def _bounded(packs: DataFrame, found: DataFrame | None, k: int) -> DataFrame:
    """Packs with each query's k-th score so far (-inf with fewer)."""
    if found is None:
        return packs.withColumn("low", F.lit(None).cast("binary"))
    low = (found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low")).filter(F.col("n") >= k))

    def ids(batches):
        for batch in batches:
            for r in batch.to_pylist():
                q = np.frombuffer(r["qids"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), r["pack"])), pa.array(np.arange(len(q))), pa.array(q)], names=["pack", "i", "query_id"])

    places = packs.select("pack", "qids").mapInArrow(ids, "pack bigint, i bigint, query_id bigint")
    lists = (places.join(low, "query_id", "left").groupBy("pack")
             .agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("low", F.lit(float("-inf"))).alias("low")))).alias("x")))

    def flat(batches):
        for batch in batches:
            for r in batch.to_pylist():
                x = np.array([y["low"] for y in r["x"]], np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([r["pack"]], pa.int64()), pa.array([x.tobytes()], pa.binary())], names=["pack", "low"])

    return packs.join(lists.mapInArrow(flat, "pack bigint, low binary"), "pack")


def _reranked(index: DataFrame, visits: DataFrame, packs: DataFrame, k: int, dim: int, dtype, pack_bytes: int) -> DataFrame:
    """Exact scores of the opened leaves' rows: at most k a block and query, none below
    the query's bound."""
    visit_bytes = visits.agg(F.sum(F.length("who") + 24)).first()[0] or 0

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                block = _Block(r, dim, dtype)
                who = np.frombuffer(r["who"], np.int32)
                qids, q = np.frombuffer(r["qids"], np.int64)[who], np.frombuffer(r["qm"], np.float64).reshape(-1, dim)[who]
                low = np.full(len(who), -np.inf) if r["low"] is None else np.frombuffer(r["low"], np.float64)[who]
                s = q @ block.m.T
                s[block.own(qids)] = -np.inf
                cut = low
                if s.shape[1] > k:
                    cut = np.maximum(cut, np.partition(s, s.shape[1] - k, axis=1)[:, -k])
                # products summed in another order differ by less than this
                near = 1e-9 * np.sqrt((q * q).sum(1) * (block.m * block.m).sum(1).max())
                i, j = np.nonzero((s >= (cut - near)[:, None]) & (s > -np.inf))
                exact = np.zeros(len(i))
                for d in range(dim):
                    exact += q[i, d] * block.m[j, d]
                n = block.ends[j] - block.starts[j]
                at = np.repeat(np.arange(len(i)), n)
                place = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                vec = block.ids[block.starts[j[at]] + place]
                ok = (vec != qids[i[at]]) & (exact[at] >= low[i[at]])
                at, place, vec = at[ok], place[ok], vec[ok]
                order = np.lexsort((place, vec, -exact[at], i[at]))
                of = i[at][order]
                rank = np.arange(len(of)) - np.searchsorted(of, of, side="left")
                top = order[rank < k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids[i[at[top]]]), pa.array(vec[top]), pa.array(exact[at[top]]), pa.array(block.entries[j[at[top]]]), pa.array(place[top])],
                    names=["query_id", "vec_id", "score", "entry", "place"])

    pairs = index.join(broadcast_if(visits, visit_bytes), ["tree", "leaf"]).join(broadcast_if(packs, pack_bytes), "pack")
    return pairs.select("entries", "ends", "ids", "m", "who", "qids", "qm", "low").mapInArrow(
        run, "query_id bigint, vec_id bigint, score double, entry bigint, place bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    """k rows a query; what several trees have found counts once."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "entry", "place")
    once = found.groupBy("query_id", "vec_id", "score", "entry", "place").agg(F.lit(1).alias("_one")).drop("_one")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, k: int, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES,
            leaf_rows: int = LEAF_ROWS, target: float = TARGET_RECALL, seed: int = 1) -> DataFrame:
    """query_id, rank, ``id_col``, score: up to k rows of nearly the largest inner product
    with each row where ``is_query`` (a condition on ``id_col``) holds."""
    spark = vectors.sparkSession
    rows = _kept(vectors, id_col, vector_col)
    asked = staged(rows.withColumn(id_col, F.col("id")).filter(is_query).groupBy("id").agg(F.min("v").alias("v")), "forest-queries")
    entries = staged(_entries(rows, k), "forest-entries")
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, dim, longest2 = entries.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(norm2)).first()
    n_queries = asked.count()
    if not n_queries or not n:
        return spark.createDataFrame([], f"query_id bigint, rank int, {id_col} bigint, score double")
    dtype = np.float32 if isinstance(entries.schema["v"].dataType.elementType, T.FloatType) else np.float64
    drawn = entries.filter(F.pmod(F.xxhash64("v", F.lit(seed)), F.lit(1 << 32)) < int((1 << 32) * min(1.0, SAMPLE_ROWS / n)))
    sample = np.array([list(r["v"]) + [0.0] * (dim - len(r["v"])) for r in drawn.select("v").collect()], np.float64).reshape(-1, dim)
    forest = fit(sample, math.sqrt(longest2), n, trees, seed, leaf_rows)
    index = _index(entries, forest, dim, dtype, max(1, -(-n // ((1 << forest.depth) * CHUNK_ROWS))))

    few = asked.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(CALIBRATION_QUERIES).collect()
    qids = np.array([r["id"] for r in few], np.int64)
    q = np.array([list(r["v"]) + [0.0] * (dim - len(r["v"])) for r in few], np.float64)
    opened = _calibrated(forest, q, _nearest_in(index, forest, qids, q, k, dim, dtype), target)

    packs = _packs(asked, forest, dim)
    pack_bytes = n_queries * (8 * dim + 16)

    def answers(packs: DataFrame, visits: DataFrame, known: DataFrame | None) -> DataFrame:
        found = _reranked(index, visits, _bounded(packs, known, k), k, dim, dtype, pack_bytes)
        if known is not None:
            found = found.unionByName(known.select("query_id", "vec_id", "score", "entry", "place"))
        return staged(_best(found, k), "forest-found")

    found, first, last = None, 0, min(opened, trees)
    while first < opened:
        found = answers(packs, _visits(packs, forest, dim, first, last), found)
        first, last = last, min(opened, GROWTH * last)
    short = asked.join(found.groupBy("query_id").count().filter(F.col("count") >= k), F.col("id") == F.col("query_id"), "left_anti")
    if not short.isEmpty():
        rest = _packs(short, forest, dim)
        found = answers(rest, _visits(rest, forest, dim, 0, _ALL, tree=0), found)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id_col), "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact answers (query_id, vec_id) that were found."""
    hit, n = (exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
              .agg(F.count("hit"), F.count(F.lit(1))).first())
    return hit / n if n else 1.0
