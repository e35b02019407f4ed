"""Vector code compression: product codes with integer codebooks, nearest entries
found through memoised grid cells.

A vector is floored to integers and cut into equal parts; each part position has
its own codebook. A task lays a coarse grid over a part: the cell of a sub-vector
is looked up in a memo of cells met before, whose value is the set of entries that
can be nearest anywhere in the cell's box. An entry is left out where its least
distance to the box exceeds another entry's greatest distance to it, so no nearest
entry, tied ones included, is lost. Only the entries of the set are evaluated
exactly. The memo is bounded: a full one starts anew, which costs time alone.

A training round is one pass over the table in which every task adds up its counts
and sums per part and entry; those small rows are summed by Spark and only the
codebooks (entries x dimensions integers) reach the driver and go back with the
next round's tasks. No vector leaves its task. The table is read once a round: let
an expensive ``vectors`` be a written table.

Defined cases: rows with a null vector, or a null or non-finite component, are left
out. Shorter vectors, empty ones too, count as filled up with zeros to the longest,
and that to a multiple of the number of parts. Repeated rows are coded and counted
one by one. The first codebooks come from the rows with the smallest ids (null ids
last, equal ids by smaller vector); with fewer rows than entries a codebook has as
many entries as there are rows. Rows with a null id or label are coded like others;
null labels form one group. An empty table gives no rows; other columns are ignored.
Vectors whose squared distances could pass 64 bits are an error, not left out.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import broadcast_if, staged

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Cells that a task remembers per part.
MEMO_CELLS = 1 << 15
#: A cell's side as a share of the codebook's widest extent.
CELL_SHARE = 4
#: Squared distances stay below this.
LARGEST = 1 << 62


class Cells:
    """Nearest entries of one codebook (entries x positions, integers)."""

    def __init__(self, entries: np.ndarray, share: int = CELL_SHARE, limit: int = MEMO_CELLS):
        self.entries, self.limit = entries, limit
        self.width = max(1, int((entries.max(0) - entries.min(0)).max(initial=0)) // share)
        self.memo: dict[bytes, np.ndarray] = {}
        self.evaluated = 0

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """Per cell, the entries that may be nearest to some point of its box."""
        low = (cells * self.width)[:, None, :]
        high = low + (self.width - 1)
        e = self.entries[None, :, :]
        near = np.maximum(np.maximum(low - e, e - high), 0)
        far = np.maximum(np.abs(e - low), np.abs(e - high))
        return (near * near).sum(2) <= (far * far).sum(2).min(1, keepdims=True)

    def _candidates(self, cells: np.ndarray) -> np.ndarray:
        keys = [c.tobytes() for c in cells]
        fresh = [i for i, k in enumerate(keys) if k not in self.memo]
        if len(self.memo) + len(fresh) > self.limit:
            self.memo.clear()
            fresh = range(len(keys))
        if len(fresh):
            self.memo.update(zip([keys[i] for i in fresh], self.undominated(cells[list(fresh)]), strict=True))
        return np.stack([self.memo[k] for k in keys])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) per row of ``x``; ties go to the lower entry."""
        cells, of = np.unique(x // self.width, axis=0, return_inverse=True)
        masks = self._candidates(np.ascontiguousarray(cells))
        of = of.reshape(-1)
        entry = np.zeros(len(x), np.int64)
        least = np.full(len(x), np.iinfo(np.int64).max)
        for e in np.nonzero(masks.any(0))[0]:
            rows = np.nonzero(masks[of, e])[0]
            self.evaluated += len(rows)
            gap = x[rows] - self.entries[e]
            d = np.einsum("ij,ij->i", gap, gap)
            closer = d < least[rows]
            least[rows[closer]] = d[closer]
            entry[rows[closer]] = e
        return entry, least


@dataclass
class Codebooks:
    """Entries as integers, parts x entries x positions."""

    entries: np.ndarray
    dim: int
    scale: int

    def sha256(self) -> str:
        """Of all components' decimals by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    ok = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    return vectors.filter(ok).select(F.col(id_col).alias("id"), v.alias("v"), label.alias("label"))


def _whole(lists: pa.ListArray, dim: int, scale: int) -> np.ndarray:
    """Rows of a list column as integers, filled up with zeros to ``dim``."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), dim), np.int64)
    out[np.arange(dim)[None, :] < lengths[:, None]] = np.floor(
        lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).astype(np.int64)
    return out


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS,
          entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks after ``rounds`` of assignment and floored means over every kept row
    (None for a table without any)."""
    rows = _kept(vectors, id_col, vector_col, None)
    widest = F.max(F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x))))
    dim, top = rows.agg(F.max(F.size("v")), widest).first()
    if dim is None:
        return None
    dim = max(-(-dim // parts), 1) * parts
    if top * scale > 2**40 or dim // parts * (2 * int(top * scale) + 2) ** 2 >= LARGEST:
        raise ValueError(f"components reach {top:.3g}: squared distances, scaled by {scale}, could pass 64 bits; scale the vectors down")
    seeds = rows.orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    first = _whole(pa.array([r["v"] for r in seeds], pa.list_(pa.float64())), dim, scale)
    books = np.ascontiguousarray(first.reshape(len(seeds), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        books = _moved(rows, Codebooks(books, dim, scale))
    return Codebooks(books, dim, scale)


def _moved(rows: DataFrame, books: Codebooks) -> np.ndarray:
    """The next round's entries: floored means of the parts assigned to each."""
    parts, entries, places = books.entries.shape

    def run(batches):
        cells = [Cells(b) for b in books.entries]
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, places), np.int64)
        for batch in batches:
            x = _whole(batch.column(0), books.dim, books.scale).reshape(-1, parts, places)
            for p in range(parts):
                entry, _ = cells[p].nearest(np.ascontiguousarray(x[:, p]))
                counts[p] += np.bincount(entry, minlength=entries)
                for j in range(places):
                    np.add.at(sums[p, :, j], entry, x[:, p, j])
        p, e, j = (a.reshape(-1) for a in np.indices(sums.shape))
        used = counts[p, e] > 0
        yield pa.RecordBatch.from_arrays([pa.array(c[used]) for c in (p, e, j, counts[p, e], sums.reshape(-1))],
                                         names=["p", "e", "j", "n", "s"])

    added = (rows.select("v").mapInArrow(run, "p bigint, e bigint, j bigint, n bigint, s bigint").groupBy("p", "e", "j")
             .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    out = books.entries.copy()
    for r in added:  # parts x entries x positions rows at most
        out[r["p"], r["e"], r["j"]] = int(r["s"]) // r["n"]
    return out


def encode(vectors: DataFrame, books: Codebooks | None, id_col: str = "vec_id", vector_col: str = "embedding",
           label_col: str | None = "label") -> DataFrame:
    """``id_col``, label, codes (an entry's number per part), error (their squared
    distances, summed) of every kept row; map-only."""
    schema = f"{id_col} {dict(vectors.dtypes)[id_col]}, label {dict(vectors.dtypes)[label_col] if label_col else 'int'}, codes array<int>, error bigint"
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema)
    parts = len(books.entries)

    def run(batches):
        cells = [Cells(b) for b in books.entries]
        for batch in batches:
            x = _whole(batch.column(1), books.dim, books.scale).reshape(batch.num_rows, parts, -1)
            found = [cells[p].nearest(np.ascontiguousarray(x[:, p])) for p in range(parts)]
            codes = np.stack([entry for entry, _ in found], 1).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32)), pa.array(codes.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists, pa.array(sum(d for _, d in found))],
                                             names=[id_col, "label", "codes", "error"])

    return _kept(vectors, id_col, vector_col, label_col).mapInArrow(run, schema)


def decode(codes: DataFrame, books: Codebooks, codes_col: str = "codes", out: str = "vector") -> DataFrame:
    """Adds the vector that a code stands for (its entries over the scale)."""
    table = F.array(*[F.array(*[F.array(*[F.lit(v / books.scale) for v in e.tolist()]) for e in part]) for part in books.entries])
    return codes.withColumn(out, F.flatten(F.transform(codes_col, lambda c, i: table[i][c])))


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error, the error summed over the rows of equal label (nulls together).
    ``coded`` is written once; the sums join by broadcast below the measured bound."""
    coded = staged(coded, "codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    sums = staged(sums, "label-errors")
    n = sums.count()
    return coded.join(broadcast_if(sums, 32 * n), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
