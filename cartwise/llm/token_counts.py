"""Token counts by a linear longest-match automaton.

Greedy word pieces (at each place the longest vocabulary entry) are counted in
one pass over a word's bytes. The vocabulary becomes a trie; each node has a
failure link, the node where matching goes on once the longest piece on the way
to it has been taken, and the number of pieces taken then (Song et al. 2021,
"Fast WordPiece Tokenization"). No piece is ever built.

Words are the runs of letters, single digits and runs of other signs between
white space, NFC-normalised and lower-cased. Pieces are the vocabulary's entries
without their word-end marks, in one set: a piece that the file has only at a
word's end matches anywhere, and the other way round. Counts of white-space
chunks are cached, up to a bound, per worker.

Defined cases: null and blank texts have 0 words and 0 tokens; a word with a
byte that no piece covers counts as one (unknown) token; repeated rows each
give a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the words of the vocabulary's own tokenizer.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
CHUNKS, LONGEST = 400_000, 64

_LOADED: dict[str, ChunkCounts] = {}


class Automaton:
    """Trie with failure links over byte strings; ``count(word)`` is the number of
    greedy pieces, 1 for a word that can't be covered."""

    def __init__(self, pieces):
        self.step: dict[int, int] = {}  # node * 256 + byte -> node
        full, order, parent = {0: False}, [0], {}
        step = self.step
        for piece in sorted(pieces, key=len):
            node = 0
            for byte in piece:
                key = node * 256 + byte
                if key not in step:
                    new = step[key] = len(order)
                    parent[new] = key
                    order.append(new)
                    full[new] = False
                node = step[key]
            if node:
                full[node] = True
        depth = {0: 0}
        for node in order[1:]:
            depth[node] = depth[parent[node] // 256] + 1
        self.fail, self.pops = [-1] * len(order), [0] * len(order)
        for node in sorted(order[1:], key=depth.__getitem__):
            if full[node]:  # the whole way here is a piece
                self.fail[node], self.pops[node] = 0, 1
                continue
            up, byte = divmod(parent[node], 256)
            z, n = self.fail[up], self.pops[up]
            while z >= 0 and z * 256 + byte not in step:
                n += self.pops[z]
                z = self.fail[z]
            if z >= 0:
                self.fail[node], self.pops[node] = step[z * 256 + byte], n

    def count(self, word: bytes) -> int:
        step, fail, pops = self.step, self.fail, self.pops
        node = n = 0
        for byte in word:
            to = step.get(node * 256 + byte)
            while to is None:
                n += pops[node]
                node = fail[node]
                if node < 0:
                    return 1
                to = step.get(node * 256 + byte)
            node = to
        while node:
            n += pops[node]
            node = fail[node]
            if node < 0:
                return 1
        return n


def vocabulary_pieces(path: str) -> set[bytes]:
    """Byte strings of a byte-level BPE vocabulary file, word ends taken off."""
    from cartwise.llm.tokens import byte_symbols

    back = {c: b for b, c in byte_symbols().items()}
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    words = (w.removesuffix("</w>") for w in vocabulary)
    return {bytes(back[c] for c in w) for w in words if w and all(c in back for c in w)}


class ChunkCounts(dict):
    """(words, tokens) of a white-space chunk."""

    def __init__(self, pieces):
        super().__init__()
        self.automaton = Automaton(pieces)

    def __missing__(self, chunk: str) -> tuple[int, int]:
        words = WORD.findall(unicodedata.normalize("NFC", chunk).lower())
        value = len(words), sum(self.automaton.count(w.encode()) for w in words)
        if len(chunk) <= LONGEST:
            if len(self) >= CHUNKS:
                self.clear()
            self[chunk] = value
        return value

    def text(self, text: str) -> tuple[int, int]:
        pairs = list(map(self.__getitem__, text.split()))
        return sum(p[0] for p in pairs), sum(p[1] for p in pairs)


def chunk_counts(path: str) -> ChunkCounts:
    if path not in _LOADED:
        _LOADED[path] = ChunkCounts(vocabulary_pieces(path))
    return _LOADED[path]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_words, n_tokens for every row; ``vocabulary`` is the path of a
    byte-level BPE vocabulary file, readable on every executor."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        counts = chunk_counts(vocabulary)
        for b in batches:
            found = [counts.text(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())],
                names=[id_col, "n_words", "n_tokens"])

    return rows.mapInArrow(run, f"`{id_col}` {rows.schema['_id'].dataType.simpleString()}, n_words bigint, n_tokens bigint")
