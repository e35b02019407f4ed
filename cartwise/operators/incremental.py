"""Pair aggregates over a growing folder of line files (A2/A3 over S3).

Purchase counts, reorders, last order and cart sums per (user, product) merge: counts and
sums add, the last order is a maximum. So each file is read once. ``append`` aggregates the
files that the state does not hold yet into a new batch of partial rows, and ``pairs``
merges the batches: work grows with the appended lines and the number of pairs, not with
the history.

On disk a state is a folder of batches (``pairs``: partial rows, ``waiting``: lines whose
order is not a prior order yet) and of numbered manifests, which list every file with its
length, time and batch. A manifest is renamed into place whole, after its batch is written:
an append that is killed leaves the former version in force and is simply repeated.

Defined cases: a line whose order is unknown or still in the future waits and is tried
again by the next append; one with a null order_id can never match and is dropped, as by an
inner join; a file that was changed or removed makes the next append start anew from all
files; an order that counts once is taken not to change (else :meth:`PairState.rebuild`);
an empty folder gives no pairs; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.handoff import remove, written
from cartwise.operators import features as FT

MANIFEST = "path string, length bigint, modified bigint, batch string, seq int"
WAITING = "order_id bigint, product_id bigint, add_to_cart_order int, reordered int"
SUMS = ("user_id bigint, product_id bigint, user_product_purchase_count bigint, user_product_reorder_count bigint, "
        "user_product_last_order_number bigint, _cart_sum bigint")
#: Batches beyond which an append merges them into one.
MAX_BATCHES = 16


class PairState:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)

    def version(self) -> int:
        """The newest manifest's number, 0 without one."""
        found = self._fs.globStatus(self._path(f"{self.path}/manifest-*/_SUCCESS"))
        return max((int(s.getPath().getParent().getName().removeprefix("manifest-")) for s in found or []), default=0)

    def _manifest(self) -> list[tuple]:
        """Files and batches in force: metadata, a row per file."""
        at = self.version()
        if not at:
            return []
        return [tuple(r) for r in self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest-{at:08d}").collect()]

    def files(self) -> set[str]:
        """The files that the state holds."""
        return {r[0] for r in self._manifest() if r[0] is not None}

    def _listed(self, folder: str) -> dict[str, tuple[int, int]]:
        p = self._path(folder)
        fs = p.getFileSystem(self._conf)
        found, out = fs.listFiles(p, True), {}
        while found.hasNext():
            st = found.next()
            if not st.getPath().getName().startswith(("_", ".")):
                out[st.getPath().toString()] = (st.getLen(), st.getModificationTime())
        return out

    def _commit(self, rows: list[tuple], after: int) -> int:
        pending, final = f"{self.path}/.pending-{uuid.uuid4().hex}", self._path(f"{self.path}/manifest-{after + 1:08d}")
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(pending)
        if self._fs.exists(final) or not self._fs.rename(self._path(pending), final):
            remove(self.spark, pending)
            raise OSError(f"another append has written version {after + 1} of {self.path}")
        return after + 1

    def append(self, orders: DataFrame, folder: str, read: Callable[[list[str]], DataFrame] | None = None,
               at_most: int | None = None) -> dict:
        """Take up the files under ``folder`` that the state doesn't hold, at most
        ``at_most`` of them (the rest is for the next call), and the waiting lines.
        ``read`` makes lines (order_id, product_id, add_to_cart_order, reordered) of file
        paths; Parquet by default. Returns version, files taken and whether it began anew."""
        at, known, listed = self.version(), self._manifest(), self._listed(folder)
        changed = any(r[0] is not None and listed.get(r[0]) != (r[1], r[2]) for r in known)
        if changed:
            known = []
        have = {r[0] for r in known}
        new = sorted(p for p in listed if p not in have)[:at_most]
        last = max(known, key=lambda r: r[4])[3] if known else None
        lines = (read or (lambda paths: self.spark.read.parquet(*paths)))(new) if new else self.spark.createDataFrame([], WAITING)
        lines = _lines(lines)
        if last is not None:
            lines = lines.unionByName(self.spark.read.schema(WAITING).parquet(f"{self.path}/{last}/waiting"))
        lines = lines.filter(F.col("order_id").isNotNull())
        batch = f"batch-{uuid.uuid4().hex[:12]}"
        history = FT.prior_orders(orders).select("order_id", "user_id", "order_number")
        # one join serves both: a line without a prior order has no ``_known``
        joined, step = written(lines.join(history.withColumn("_known", F.lit(True)), "order_id", "left"), "append")
        known_lines = F.col("_known").isNotNull()
        _typed(FT.pair_sums(joined.filter(known_lines))).write.option("compression", "zstd").parquet(f"{self.path}/{batch}/pairs")
        _lines(joined.filter(~known_lines)).write.parquet(f"{self.path}/{batch}/waiting")
        remove(self.spark, step)
        seq = max((r[4] for r in known), default=0) + 1
        rows = known + [(p, *listed[p], batch, seq) for p in new] + [(None, None, None, batch, seq)]
        done = {"version": self._commit(rows, at), "files": new, "rebuilt": changed}
        if len({r[3] for r in rows}) > MAX_BATCHES:
            done["version"] = self.compact()
        return done

    def rebuild(self, orders: DataFrame, folder: str, read: Callable[[list[str]], DataFrame] | None = None) -> dict:
        """Forget all batches and take up every file anew."""
        if at := self.version():
            self._commit([], at)
        return self.append(orders, folder, read)

    def _sums(self) -> DataFrame:
        batches = sorted({r[3] for r in self._manifest()})
        if not batches:
            return self.spark.createDataFrame([], SUMS)
        return self.spark.read.schema(SUMS).parquet(*[f"{self.path}/{b}/pairs" for b in batches])

    def merged(self) -> DataFrame:
        """One row of sums per pair over all batches."""
        n = "user_product_purchase_count"
        return self._sums().groupBy("user_id", "product_id").agg(
            F.sum(n).alias(n), F.sum("user_product_reorder_count").alias("user_product_reorder_count"),
            F.max("user_product_last_order_number").alias("user_product_last_order_number"),
            F.sum("_cart_sum").alias("_cart_sum"))

    def pairs(self) -> DataFrame:
        """The rows of :func:`cartwise.operators.features.pair_stats` over all files."""
        return FT.pair_ratios(self.merged())

    def compact(self) -> int:
        """All batches merged into one; returns the new version."""
        at, rows = self.version(), self._manifest()
        if not rows:
            return at
        batch, seq = f"batch-{uuid.uuid4().hex[:12]}", max(r[4] for r in rows) + 1
        last = max(rows, key=lambda r: r[4])[3]
        self.merged().write.parquet(f"{self.path}/{batch}/pairs")
        self.spark.read.schema(WAITING).parquet(f"{self.path}/{last}/waiting").write.parquet(f"{self.path}/{batch}/waiting")
        return self._commit([(*r[:3], batch, seq) for r in rows if r[0] is not None] + [(None, None, None, batch, seq)], at)

    def vacuum(self) -> int:
        """Delete batches and manifests no longer in force, which nobody may be reading;
        returns how many folders went."""
        at = self.version()
        keep = {r[3] for r in self._manifest()} | {f"manifest-{at:08d}"}
        gone = [s.getPath() for s in self._fs.listStatus(self._path(self.path)) if s.getPath().getName() not in keep]
        for p in gone:
            self._fs.delete(p, True)
        return len(gone)


def _lines(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in (x.split() for x in WAITING.split(", "))])


def _typed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in (x.split() for x in SUMS.split(", "))])
