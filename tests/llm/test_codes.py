import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.llm import codes as C

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """The contract in plain Python: every entry of every part is evaluated."""
    kept = [(i, [math.floor(scale * x) for x in e], y) for i, e, y in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    dim = max(-(-max(len(v) for _, v, _ in kept) // parts), 1) * parts
    kept = sorted(((i, v + [0] * (dim - len(v)), y) for i, v, y in kept), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = dim // parts

    def cut(v):
        return [v[p * w:(p + 1) * w] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [[] for _ in book]
            for _, v, _ in kept:
                own[nearest(cut(v)[p], book)[1]].append(cut(v)[p])
            books[p] = [[sum(c) // len(xs) for c in zip(*xs, strict=True)] if xs else e for e, xs in zip(book, own, strict=True)]
    out = [(i, [nearest(x, books[p]) for p, x in enumerate(cut(v))], y) for i, v, y in kept]
    total = {}
    for _, f, y in out:
        total[y] = total.get(y, 0) + sum(d for d, _ in f)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted([(i, [k for _, k in f], sum(d for d, _ in f), total[y]) for i, f, y in out], key=str), sha


def result(spark, rows, **shape):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as v", "'x' as codes", "3 as of", "4 as error").repartition(3)
    books = C.train(df, **shape)
    got = C.with_label_errors(C.encode(df, books))
    return sorted([(r["vec_id"], r["codes"], r["error"], r["label_error"]) for r in got.collect()], key=str), books


def mixed(n=90, dim=16, seed=4):
    rng = random.Random(seed)
    rows = [(i, [rng.randrange(-9, 10) / 16 + rng.randrange(3) / 9999 for _ in range(dim)], i % 3 or None) for i in range(n)]
    rows += [(n + i, [0.25] * dim, 7) for i in range(30)]  # copies, a hot label
    rows += [(700, None, 1), (701, [None] + [1.0] * (dim - 1), 1), (702, [float("nan")] * dim, 1), (703, [float("-inf")] * dim, 1)]
    return rows + [(704, [], 1), (705, [1.0], None), (None, [0.5] * dim, 1), (3, rows[3][1], 2), (3, [-0.5] * dim, 2)]


@pytest.mark.parametrize("shape", [{}, {"parts": 4, "entries": 5, "rounds": 2, "scale": 64}])
def test_equals_brute_force(spark, shape):
    want, sha = brute(mixed(), **shape)
    got, books = result(spark, mixed(), **shape)
    assert got == want and books.sha256() == sha


def test_fewer_rows_than_entries_and_equal_seeds(spark):
    rows = [(5, [0.5] * 8, 0), (6, [0.5] * 8, 0), (9, [-0.5, 0.25] * 4, None)]
    want, sha = brute(rows)
    got, books = result(spark, rows)
    assert got == want and books.sha256() == sha and books.entries.shape == (8, 3, 1)
    assert (got[0][1], got[1][1]) == ([0] * 8, [0] * 8)  # a tie goes to the lower entry


def test_parts_are_filled_up_with_zeros(spark):
    rows = [(i, [i / 7, 1 - i / 5, (i % 4) / 3], 0) for i in range(40)]
    want, sha = brute(rows, parts=2, entries=4)
    got, books = result(spark, rows, parts=2, entries=4)
    assert got == want and books.sha256() == sha and books.dim == 4


def test_empty_table_and_huge_components(spark):
    df = spark.createDataFrame([(1, None, 1)], SCHEMA)
    assert C.train(df) is None
    assert C.with_label_errors(C.encode(df, None)).count() == 0
    with pytest.raises(ValueError, match="64 bits"):
        C.train(spark.createDataFrame([(1, [3e38] * 8, 1)], SCHEMA))


def test_memo_leaves_out_only_dominated_entries():
    rng = np.random.default_rng(2)
    for share in (1, 4, 40):
        entries = rng.integers(-300, 300, (16, 4))
        x = np.concatenate([rng.integers(-400, 400, (3000, 4)), entries, (entries[:8] + entries[8:]) // 2])
        cells = C.Cells(entries, share)
        d = ((x[:, None] - entries[None]) ** 2).sum(2)
        for _ in range(2):  # the second time from the memo
            entry, least = cells.nearest(x)
            assert (entry == d.argmin(1)).all() and (least == d.min(1)).all()
    assert cells.evaluated < 2 * 16 * len(x) / 3 and len(cells.memo) > 100


def test_full_memo_starts_anew():
    rng = np.random.default_rng(3)
    entries = rng.integers(-300, 300, (16, 3))
    cells = C.Cells(entries, 30, limit=50)
    for _ in range(5):
        x = rng.integers(-400, 400, (40, 3))
        assert (cells.nearest(x)[0] == ((x[:, None] - entries[None]) ** 2).sum(2).argmin(1)).all()
        assert len(cells.memo) <= 50


def test_decode_gives_the_entries(spark):
    df = spark.createDataFrame(mixed(), SCHEMA)
    books = C.train(df, entries=3, rounds=1)
    r = C.decode(C.encode(df, books), books).filter(F.col("vec_id") == 4).first()
    assert r["vector"] == [v / 4096 for p, c in enumerate(r["codes"]) for v in books.entries[p, c].tolist()]


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(C, "broadcast_if", lambda df, size: df)
    assert result(spark, mixed(40), rounds=1)[0] == brute(mixed(40), rounds=1)[0]
