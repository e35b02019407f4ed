"""Target-distribution importance resampling over hashed word n-grams.

Features are words and pairs of consecutive words, hashed to buckets by crc32. A
batch's texts are joined with separator sentinels, one regex pass over the joined
bytes finds all words, document offsets are found by searchsorted and mask the
pairs that would cross documents; all checksums are then made at once, byte column
by byte column, and go into a bincount. Texts are bytes in UTF-8 throughout: every
byte beyond ASCII belongs to a word.

Two map-only passes: the first counts buckets (one row per task and bucket, summed
by Spark; ``buckets`` integers reach the driver), the second gives each document its
weight, the floored mean of its features' gains. Gumbel noise from a hash of the id
turns weights into scores whose highest are a draw without replacement. Ranks come
from a range-partitioned sequence, no task sorts more than its range. Both passes
read ``documents``: let an expensive plan be a written table.

Defined cases: a null text has no words; without words n_features and weight are 0.
A null id counts as empty text in the noise. Repeated rows are documents of their
own; equal scores of equal ids are told apart by weight, then by feature count (null
ids first). Texts of any length are read whole, a long one makes a batch of its own. An
empty table gives no rows, an empty target weighs by the corpus alone; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.sequence import sequence_within
from cartwise.llm.common import staged

BUCKETS = 10_000
#: Bytes of text that are joined and searched at once.
JOINED_BYTES = 1 << 20
#: Zero bytes that a checksum passes at once; longer words take several steps.
STEP = 64
SENTINEL = b"\x00"
#: A word behind all that stands before it: the matches tile the text up to its last word.
WORD = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_ONES = np.uint32(0xFFFFFFFF)
_IS_BETWEEN = np.array([re.match(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]", bytes([c])) is not None for c in range(256)])


def _crc_table() -> np.ndarray:
    """The byte table of crc32 (polynomial EDB88320, reflected)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ np.where(t & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return t


_TABLE = _crc_table()


def _feed(state: np.ndarray, byte: int) -> np.ndarray:
    return _TABLE[(state ^ np.uint32(byte)) & np.uint32(0xFF)] ^ (state >> np.uint32(8))


def _zero_tables() -> np.ndarray:
    """At (n, k, byte), flat: what byte k of a state alone becomes by n zero bytes."""
    rows = [np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]]
    for _ in range(STEP):
        rows.append(_feed(rows[-1], 0))
    return np.stack(rows).reshape(-1)


_ZEROS = _zero_tables()


def _over(state: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksum states after ``n`` zero bytes, element by element. The checksum being
    linear, xor with the following bytes' own checksum from state 0 gives the pair's."""
    state, n = state.copy(), n.copy()
    while True:
        m = np.minimum(n, STEP)
        row = (m << 10).astype(np.int32)
        out = _ZEROS.take(row + (state & np.uint32(0xFF)).astype(np.int32))
        for k in range(1, 4):
            byte = (state >> np.uint32(8 * k)) & np.uint32(0xFF)
            out ^= _ZEROS.take(row + (byte.astype(np.int32) + np.int32(256 * k)))
        n -= m
        state = out
        if not n.any():
            return state


def _checksums(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksum states from 0 over each word: byte column by byte column over the words
    that still have a byte, long words by themselves."""
    state = np.zeros(len(start), np.uint32)
    order = np.argsort(-np.minimum(size, STEP + 1).astype(np.int16), kind="stable")
    n = size[order]
    long = int(np.searchsorted(-n, -STEP, side="left"))
    for i in order[:long]:
        state[i] = np.uint32(zlib.crc32(data[start[i]:start[i] + size[i]].tobytes(), 0xFFFFFFFF) ^ 0xFFFFFFFF)
    order, n = order[long:], n[long:]
    at, s = start[order], np.zeros(len(order), np.uint32)
    for j in range(int(n.max(initial=0))):
        m = int(np.searchsorted(-n, -j, side="left"))  # words of more than j bytes
        byte = (s[:m] ^ data.take(at[:m] + j)) & np.uint32(0xFF)
        s[:m] = _TABLE.take(byte.astype(np.int32)) ^ (s[:m] >> np.uint32(8))
    state[order] = s
    return state


def features(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, document) of every feature and the words per document, of texts that
    are joined and searched at once."""
    joined = SENTINEL.join(texts).lower()  # bytes: A-Z alone
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.cumsum(sizes + 1) - (sizes + 1)
    found = WORD.findall(joined)
    reach = np.fromiter(map(len, found), np.int64, len(found))
    del found
    end = np.cumsum(reach)
    data = np.frombuffer(joined, np.uint8)
    between = np.concatenate([[0], np.cumsum(_IS_BETWEEN[data], dtype=np.int64)])
    start = end - reach
    start += between[end] - between[start]  # what is no word stands before it
    size = end - start
    tail = _checksums(data, start, size)
    own = _over(np.full(len(size), _ONES), size) ^ tail
    doc = np.searchsorted(offsets, start, side="right") - 1
    first = np.nonzero(doc[1:] == doc[:-1])[0]  # pairs that stay inside a document
    pairs = _over(_feed(own[first], 0x20), size[first + 1]) ^ tail[first + 1]
    bucket = (np.concatenate([own, pairs]) ^ _ONES) % np.uint32(buckets)
    return bucket.astype(np.int64), np.concatenate([doc, doc[first]]), np.bincount(doc, minlength=len(texts))


def _groups(column: pa.Array):
    """(first row, texts) of a batch, cut by the bytes that are joined."""
    texts, held, first = [], 0, 0
    for i in range(len(column)):
        t = column[i].as_py() or b""
        if texts and held + len(t) > JOINED_BYTES:
            yield first, texts
            texts, held, first = [], 0, i
        texts.append(t)
        held += len(t) + 1
    if texts:
        yield first, texts


def _bytes(docs: DataFrame, text_col: str):
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over every whole text."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _groups(batch.column(0)):
                counts += np.bincount(features(texts, buckets)[0], minlength=buckets)
        at = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["b", "n"])

    rows = (docs.select(_bytes(docs, text_col).alias("t")).mapInArrow(run, "b bigint, n bigint")
            .groupBy("b").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in rows:  # ``buckets`` at most
        out[r["b"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln(target share / corpus share)), one added to every count."""
    s_all, t_all, m = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + m) / ((s + 1.0) * (t_all + m))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(text: bytes) -> int:
    """floor(1000 Gumbel) of a seeded id text."""
    h = int(hashlib.sha256(text).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(docs: DataFrame, gain: np.ndarray, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_words, n_features, weight and score of every document; map-only."""

    def run(batches):
        for batch in batches:
            counts, words, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for at, texts in _groups(batch.column(1)):
                bucket, doc, n_words = features(texts, len(gain))
                n, total = np.bincount(doc, minlength=len(texts)), np.zeros(len(texts), np.int64)
                np.add.at(total, doc, gain[bucket])
                here = slice(at, at + len(texts))
                counts[here], words[here], weight[here] = n, n_words, total // np.maximum(n, 1)
            ids = batch.column(2).to_pylist()
            score = weight + np.array([noise(f"{seed}:{i or ''}".encode()) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, counts, weight, score))],
                                             names=[id_col, "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col(id_col), _bytes(docs, text_col).alias("t"), F.col(id_col).cast("string").alias("i"))
    return rows.mapInArrow(run, f"{id_col} {dict(docs.dtypes)[id_col]}, n_words bigint, n_features bigint, weight bigint, score bigint")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, buckets: int = BUCKETS, seed: int = 7,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", hold: list | None = None) -> DataFrame:
    """:func:`weights` with ``rank``: 1, 2, 3 ... for the drawn share of the documents with
    at least ``min_words`` words, highest scores first, ties to the smaller id; null for
    all others. ``hold`` notes the ranked rows' folder, see ``sequence_within``."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    # written, so that sampling the ranges doesn't read the texts once more
    scored = staged(weights(docs, gain, seed, id_col, text_col), "resample-scores").withColumn("_fit", F.col("n_words") >= min_words)
    # documents that can't be drawn follow all the others
    ranked = sequence_within(scored.withColumn("_low", -F.col("score")).withColumn("_out", ~F.col("_fit")), [],
                             ["_out", "_low", id_col, "weight", "n_features"], rn_col="_rank", hold=hold)
    drawn = ranked.filter("_fit").count() * percent // 100
    return ranked.select(id_col, "n_words", "n_features", "weight", "score",
                         F.when(F.col("_fit") & (F.col("_rank") <= drawn), F.col("_rank")).alias("rank"))
