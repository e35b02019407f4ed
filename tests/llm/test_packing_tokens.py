import random
import unicodedata
import zlib

import numpy as np
import pytest

from cartwise.llm import packing as P
from cartwise.llm import token_counts as T
from cartwise.llm.queries import tokenizer_path
from cartwise.llm.tokens import WordIds

TEXTS = ["Hello, World's best! 12.5", "ÉTÉ straße İstanbul ﬁn", "a<|endoftext|>b <|startoftext|>", "x\x1cy z w　v\x85u", "é café",
         "中文 русский ელ", "!!!***###", "don't WE'LL they'Re", "²³½ ª º Ω ſ ŉ", "\t\n  ", "", "a" * 300, "😀 👍🏽", "x\xady", "\x00 \x7f", "ABC" * 40]


@pytest.fixture(scope="module")
def encoder():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_ids_equal_the_tokenizer(encoder):
    mine = WordIds(tokenizer_path())
    rng = random.Random(4)
    more = ["".join(chr(rng.choice((rng.randrange(32, 127), rng.randrange(160, 0x24f), rng.randrange(0x300, 0x2100)))) for _ in range(60))
            for _ in range(300)]
    for t in TEXTS + more + [" ".join(TEXTS)]:
        assert ids_of(mine(t)) == encoder.encode(t, add_special_tokens=False).ids, repr(t)


def test_bounded_caches_start_anew(encoder):
    mine = WordIds(tokenizer_path())
    mine.chunks.size = mine.words.size = 3
    text = " ".join(f"word{i % 7} {'ab' * (i % 5)}x" for i in range(60))
    assert ids_of(mine(text)) == encoder.encode(text, add_special_tokens=False).ids
    assert len(mine.chunks) <= 3 and len(mine.words) <= 3


def naive_first_fit(lengths, capacity):
    rooms, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((b for b, r in enumerate(rooms) if r >= lengths[i]), None)
        if b is None:
            rooms.append(capacity)
            b = len(rooms) - 1
        out[i] = b, capacity - rooms[b]
        rooms[b] -= lengths[i]
    return [out[i] for i in range(len(lengths))]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 64, 257])
def test_tournament_tree_is_first_fit_decreasing(n):
    rng = random.Random(n)
    lengths = [rng.choice((rng.randrange(1, 101), 50, 100)) for _ in range(n)]
    bins, offsets = P.first_fit_decreasing(lengths, 100)
    assert list(zip(bins, offsets, strict=True)) == naive_first_fit(lengths, 100)


def check_packed(packed, docs, encoder, capacity):
    want = [(d, encoder.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in docs]
    pieces = {}
    for r in packed:
        assert ids_of(r.ids) and len(ids_of(r.ids)) == r.length <= capacity
        assert zlib.crc32(r.ids) == r.ids_crc32
        pieces.setdefault((r.doc_id, r.start, r.doc_tokens, bytes(r.ids)), []).append(r)
    expected = {}
    for d, ids in want:
        for s in range(0, len(ids), capacity):
            key = d, s, len(ids), np.array(ids[s:s + capacity], "<u4").tobytes()
            expected[key] = expected.get(key, 0) + 1
    assert {k: len(v) for k, v in pieces.items()} == expected
    by = {}
    for r in packed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_pack_covers_every_id_once(spark, encoder):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(TEXTS) for _ in range(rng.randrange(0, 14)))) for i in range(60)]
    docs += [(60, None), (61, ""), (7, docs[7][1]), (7, docs[7][1]), (None, "no id"), (62, "long " * 700)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as grp", "2 as length", "'x' as ids").repartition(3)
    packed = P.pack(df, tokenizer_path(), capacity=128, group_pieces=40).collect()
    by = check_packed(packed, docs, encoder, 128)
    used = sum(r.length for r in packed)
    assert len(by) <= used / 128 * 1.15 + 3
    again = P.pack(df, tokenizer_path(), capacity=128, group_pieces=40, with_ids=False)
    assert "ids" not in again.columns and sum(r.length for r in again.collect()) == used


def test_one_text_on_most_rows_spreads_over_groups(spark):
    df = spark.createDataFrame([(1, "same text again")] * 300, "doc_id bigint, text string")
    packed = P.pack(df, tokenizer_path(), capacity=64, group_pieces=30, with_ids=False).collect()
    sizes = {}
    for r in packed:
        sizes[r.sequence_id >> 32] = sizes.get(r.sequence_id >> 32, 0) + 1
    assert len(sizes) >= 8 and max(sizes.values()) < 90


def test_sequences_are_padded_except_at_powers_of_two(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, "four five six seven eight nine")], "doc_id bigint, text string")
    seqs = P.packed_sequences(P.pack(df, tokenizer_path(), capacity=16), capacity=16).collect()
    assert sum(r.n_tokens for r in seqs) == sum(len([x for x in r.ids if x]) for r in seqs)
    for r in seqs:
        assert len(r.ids) == (r.n_tokens if r.n_tokens & (r.n_tokens - 1) == 0 else 16)


def test_pack_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id bigint, text string"), tokenizer_path()).count() == 0


def greedy(word, pieces, longest):
    n = 0
    while word:
        for size in range(min(longest, len(word)), 0, -1):
            if word[:size] in pieces:
                word, n = word[size:], n + 1
                break
        else:
            return None
    return n


def test_automaton_equals_greedy_longest_match():
    rng = random.Random(9)
    for _ in range(60):
        pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 14))}
        auto = T.Automaton(pieces)
        for _ in range(60):
            word = bytes(rng.choice(b"abcd" if rng.random() < 0.05 else b"abc") for _ in range(rng.randrange(0, 14)))
            want = greedy(word, pieces, 5)
            assert auto.count(word) == (1 if want is None else want), (pieces, word)


def test_counts_of_documents(spark):
    pieces = T.vocabulary_pieces(tokenizer_path())
    longest = max(map(len, pieces))
    rows = list(enumerate([*TEXTS, None, " ".join(TEXTS), "word " * 2000])) + [(1, TEXTS[1])]
    want = []
    for i, t in rows:
        words = [w for c in (t or "").split() for w in T.WORD.findall(unicodedata.normalize("NFC", c).lower())]
        want.append((i, len(words), sum(greedy(w.encode(), pieces, longest) for w in words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "0 as n_tokens", "1 as _id")
    assert sorted(map(tuple, T.token_counts(df, tokenizer_path()).collect())) == sorted(want)
    assert T.token_counts(df.limit(0), tokenizer_path()).count() == 0
