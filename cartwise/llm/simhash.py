"""SimHash near-duplicates through a segment-popcount embedding.

A document's fingerprint takes, bit by bit, the majority over the XXH64 values
of its word shingles. Fingerprints within ``max_distance`` bits are linked:

* Embedding. The 64 bits are cut into 32 segments of two; a fingerprint maps to
  the vector of its segments' bit counts. Flipping one bit moves one coordinate
  by one, so the Manhattan distance of two vectors never exceeds the Hamming
  distance. A count is kept in unary (00, 01, 11), so the Manhattan distance is
  ``bit_count(u ^ v)``.
* Grid range join. A grid cell is one half (16 coordinates) of the vector.
  Within distance d, one of the halves is within d // 2, so each vector is
  stored in the cell of either half and probes the cells around them; a probe
  meets only equal cells (an equi-join), the full Manhattan distance filters,
  and the Hamming distance verifies.
* Radii grow 1, 2, ... max_distance. Components are updated after each, and a
  pair of one component is not emitted again: a crowd of thousands of copies
  that differ by a bit or two yields links linear in its size, not all pairs.

Components come from alternating large-star / small-star rounds over written
tables; no link, component or fingerprint is collected.

Defined cases: null or blank text has fingerprint zero and is linked like any
other; a text of fewer words than a shingle is one shingle; equal texts share a
fingerprint; rows with a repeated doc_id each give a row; null doc_ids take no
part in the minimum; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import staged

SEED = 42
#: Shingle hashes whose bits are counted at once: bounds memory for long texts.
CHUNK = 1 << 17


def _majority(words: list[bytes], width: int) -> int:
    """Unsigned fingerprint of a word sequence."""
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - width + 1
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    join = b" ".join
    for at in range(0, n, CHUNK):
        part = words[at:at + CHUNK + width - 1]
        h = np.fromiter((digest(join(s), SEED) for s in zip(*(part[i:] for i in range(width)), strict=False)),
                        dtype=np.uint64, count=min(CHUNK, n - at))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def text_fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Fingerprint of one text as a signed 64-bit integer (A-Z lower-cased, words
    parted by ASCII white space, repeats included)."""
    value = _majority((text or "").encode().lower().split(), shingle_words)
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, text_hash (bigint), fp (bigint) for every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            fps = [text_fingerprint(t.as_py(), shingle_words) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())],
                                             names=["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash bigint, fp bigint")


def unary(fp: str) -> str:
    """SQL for the embedding of column ``fp``: each two-bit segment's count in unary."""
    m = 0x5555555555555555
    return f"(shiftleft({fp} & shiftright({fp}, 1) & {m}L, 1) | (({fp} | shiftright({fp}, 1)) & {m}L))"


def _cells(nodes: DataFrame) -> DataFrame:
    """Each node twice: under the cell of the lower and of the upper half."""
    return nodes.withColumn("u", F.expr(unary("fp"))).select(
        "fp", "comp", F.explode(F.expr(
            "array(u & 4294967295L, (shiftrightunsigned(u, 32) & 4294967295L) | 4294967296L)")).alias("cell"))


def _probes(cells: DataFrame, radius: int) -> DataFrame:
    """Cells to look in: the own one and those reached by raising up to ``radius``
    coordinates by one step (the lower node of a pair finds the upper)."""
    if radius > 1:
        raise ValueError("max_distance above 3 needs wider probes than one step")
    own = cells.withColumn("same", F.lit(True))
    if radius == 0:
        return own
    step = "case when (shiftright(cell, {s}) & 3) = 0 then cell | {one}L when (shiftright(cell, {s}) & 3) = 1 then cell | {two}L end"
    ups = ", ".join(step.format(s=2 * i, one=1 << 2 * i, two=2 << 2 * i) for i in range(16))
    return (cells.select("fp", "comp", F.explode(F.expr(f"array(cell, {ups})")).alias("to"), F.col("cell").alias("from"))
            .filter("to is not null").select("fp", "comp", F.col("to").alias("cell"), (F.col("to") == F.col("from")).alias("same")))


def grid_links(nodes: DataFrame, distance: int) -> DataFrame:
    """Pairs (a, b) of component labels whose fingerprints lie within ``distance`` bits.

    ``nodes``: fp, comp. Same-component pairs are left out. Both sides are shuffled: the
    probes are made by an explode, whose size Spark takes for that of its input, so it would
    broadcast seventeen rows for each one it sees.
    """
    cells = _cells(nodes)
    p = _probes(cells, distance // 2).toDF("pf", "pc", "cell", "same")
    s = cells.toDF("sf", "sc", "cell")
    close = (F.expr(f"pc <> sc and (not same or pf < sf) and bit_count({unary('pf')} ^ {unary('sf')}) <= {distance}"
                    f" and bit_count(pf ^ sf) <= {distance}"))
    return p.hint("merge").join(s.hint("merge"), (p.cell == s.cell) & close).select(
        F.least("pc", "sc").alias("a"), F.greatest("pc", "sc").alias("b"))


def connected_components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node
    of its component.

    Alternates large-star and small-star steps (Kiveris et al. 2014) on written
    tables until the edge set stays as it is; minima are partially aggregated,
    so a node with very many neighbours is no single task.
    """
    e = staged(edges.filter("a <> b").distinct(), tag)
    if e.isEmpty():
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    while True:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: every larger neighbour is tied to the smallest known node
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: smaller neighbours and the node itself are tied to the smallest
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(small, "a")
        e = staged(tied.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                   .unionAll(small.select("a", F.col("m").alias("b"))).distinct(), tag)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def simhash_components(docs: DataFrame, shingle_words: int = 3, max_distance: int = 3,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp, comp (the smallest
    fingerprint of its component), component_id (the smallest doc_id of it)."""
    fps = staged(fingerprints(docs, shingle_words, id_col, text_col), "simhash-fp")
    nodes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")).withColumn("comp", F.col("fp")), "simhash-nodes")
    for distance in range(1, max_distance + 1):
        roots = connected_components(grid_links(nodes.select("fp", "comp"), distance), "simhash-cc")
        if roots.isEmpty():
            continue
        nodes = staged(nodes.join(roots, nodes.comp == roots.node, "left")
                       .select("fp", "rep", F.coalesce("root", "comp").alias("comp")), "simhash-nodes")
    smallest = nodes.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of_fp = staged(nodes.select("fp", "comp").join(smallest, "comp"), "simhash-comp")
    return fps.join(of_fp, "fp").select("doc_id", "text_hash", "fp", "comp", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = 3, max_distance: int = 3) -> DataFrame:
    """``docs`` with one row left of each component: that of its smallest doc_id
    (rows without a doc_id come last; equal rows count as one)."""
    comps = staged(simhash_components(docs, shingle_words, max_distance), "simhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "fp", "text_hash")).alias("w")
    winners = comps.groupBy("comp").agg(first).select(F.col("w.doc_id").alias("_wd"), F.col("w.text_hash").alias("_wt"))
    text_hash = F.xxhash64(docs["text"].cast("string"))
    kept = docs.join(winners, docs["doc_id"].eqNullSafe(F.col("_wd")) & (text_hash == F.col("_wt")), "left_semi")
    again = comps.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if again.isEmpty():
        return kept
    again = again.select(F.col("doc_id").alias("_wd"), F.col("text_hash").alias("_wt"))
    same = kept["doc_id"].eqNullSafe(F.col("_wd")) & (F.xxhash64(kept["text"].cast("string")) == F.col("_wt"))
    return (kept.join(again, same, "left_anti")
            .unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])))
