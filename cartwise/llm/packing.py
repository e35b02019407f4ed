"""Packing token sequences: first-fit decreasing with a tournament tree.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens.
Pieces are dealt at random into groups of about ``group_pieces`` (the number of
groups grows with the corpus, a group never does) and each group is packed on
its own: longest piece first, each into the first sequence with room, found by
descending a tree whose nodes hold the largest room below them.

Groups are drawn by a hash of the row's place in the written table of pieces,
so rows with one doc_id or one text don't meet in a group more than others.

Defined cases: a null text is an empty one, whose only token is the end token;
a longer document is cut at multiples of the capacity, each cut-off piece being
a sequence of its own or the rest to pack; repeated rows are packed as often as
they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import staged

CAPACITY = 4096
GROUP_PIECES = 8192
END_ID = 2


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each length; lengths are at most ``capacity``."""
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = [0] * n, [0] * n
    for i in sorted(range(n), key=lambda i: -lengths[i]):
        need, at = lengths[i], 1
        while at < leaves:
            at *= 2
            if room[at] < need:
                at += 1
        bins[i], offsets[i] = at - leaves, capacity - room[at]
        room[at] -= need
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
    return bins, offsets


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = True,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if
    asked for, ids (little-endian unsigned 32-bit integers)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    end = END_ID.to_bytes(4, "little")

    def run(batches):
        from cartwise.llm.tokens import word_ids

        encode = word_ids(tokenizer)
        for batch in batches:
            # a batch may hold thousands of long texts: hand on in slices
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                index, out = [], ([], [], [], [], [])
                for i in range(part.num_rows):
                    ids = encode(part.column(1)[i].as_py() or "") + end
                    for s in range(0, len(ids), 4 * capacity):
                        piece = ids[s:s + 4 * capacity]
                        index.append(i)
                        for column, v in zip(out, (s // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece if with_ids else None), strict=True):
                            column.append(v)
                arrays = [part.column(0).take(pa.array(index, pa.int32())), *(pa.array(c, pa.int64()) for c in out[:4])]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    arrays.append(pa.array(out[4], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return rows.mapInArrow(run, schema + ", ids binary" * with_ids)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES,
         with_ids: bool = True, seed: int = 1) -> DataFrame:
    """The pieces of :func:`token_pieces` with sequence_id and offset (gapless from 0)."""
    pieces = staged(token_pieces(docs, tokenizer, capacity, with_ids), "packing-pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(groups)))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "ids_crc32", "start"], ascending=False, kind="stable").reset_index(drop=True)
        bins, offsets = first_fit_decreasing(pdf["length"].tolist(), capacity)
        return pdf.drop(columns="grp").assign(sequence_id=[(key[0] << 32) + b for b in bins], offset=offsets)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("grp").applyInPandas(run, schema + ", sequence_id bigint, offset bigint")


def packed_sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, ids (array, padded to the
    capacity unless its length is a power of two) and the doc_ids it holds."""
    whole = (packed.groupBy("sequence_id")
             .agg(F.sum("length").alias("n_tokens"),
                  F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids"))).alias("p")))
    # little-endian bytes, four to an id
    text = F.expr("array_join(transform(p, x -> hex(x.ids)), '')")
    ids = F.expr("transform(sequence(0, cast(n_tokens as int) - 1), i -> cast(conv(concat(substr(h, 8 * i + 7, 2), substr(h, 8 * i + 5, 2),"
                 " substr(h, 8 * i + 3, 2), substr(h, 8 * i + 1, 2)), 16, 10) as bigint))")
    power = (F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1)) == 0
    padded = F.when(power, F.col("ids")).otherwise(
        F.concat("ids", F.array_repeat(F.lit(pad_id).cast("bigint"), (F.lit(capacity) - F.col("n_tokens")).cast("int"))))
    return (whole.withColumn("h", text).withColumn("ids", ids)
            .select("sequence_id", "n_tokens", padded.alias("ids"), F.expr("transform(p, x -> x.doc_id)").alias("doc_ids")))
