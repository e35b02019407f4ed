"""Bounded, repeatable training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, divisor: int):
    """crc32 of an id's text form, modulo ``divisor`` (null ids: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def known_labels(labels: DataFrame, label: str, divisor: int, held_out: int) -> DataFrame:
    """(doc_id, y) outside the held-out fold; labels given twice count with the larger value."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
            .filter(remainder("doc_id", divisor) != held_out)
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int,
                    per_class: dict[int, int], max_chars: int, seed: int) -> list[tuple[int, str]]:
    """(label, text) rows to fit on: at most ``per_class[c]`` of each class c, drawn
    by a hash of the id from the labelled rows of ``docs`` outside the held-out fold;
    drawn texts of more than ``max_chars`` are left out. The bound holds whatever the
    corpus' size, and documents that ``docs`` lacks take no place in the draw; labels
    given twice count with the larger value.
    """
    # ids alone are joined, the drawn rows' texts are fetched afterwards
    known = known_labels(labels, label, divisor, held_out).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    drawn = None
    for c, n in per_class.items():
        part = known.filter(F.col("y") == c).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(n)
        drawn = part if drawn is None else drawn.unionAll(part)
    texts = (docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
             .filter(F.length("text") <= max_chars))
    rows = (texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
            .select("doc_id", "y", "text").toLocalIterator())
    return [(y, text) for _, y, text in sorted(tuple(r) for r in rows)]
