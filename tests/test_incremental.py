"""Pair state over appended files: equal to a full rebuild, whatever came when."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from cartwise.operators import features as FT
from cartwise.operators import incremental as INC
from cartwise.session import checkpoint_dir

ORDERS = "order_id bigint, user_id bigint, eval_set string, order_number int"


@pytest.fixture
def place(spark):
    return f"{checkpoint_dir(spark)}/test-state-{uuid.uuid4().hex[:12]}"


def wave(seed, first):
    rng = random.Random(seed)
    return [(o, rng.choice([None, *range(9)]), rng.choice([None, 1, 2, 7]), rng.choice([None, 0, 1]))
            for o in range(first, first + 30) for _ in range(rng.randrange(0, 6))] + [(None, 3, 1, 0)]


def history(spark, last):
    return spark.createDataFrame([(o, o % 5 or None, "prior" if o < last else "train", o // 5) for o in range(95)], ORDERS)


def full(spark, place, orders):
    return FT.pair_stats(FT.prior_lines(orders, spark.read.schema(INC.WAITING).parquet(f"{place}/lines")))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def add(spark, place, lines):
    spark.createDataFrame(lines, INC.WAITING).selectExpr("*", "1 as user_id").coalesce(1).write.mode("append").parquet(f"{place}/lines")


def test_appends_equal_a_full_rebuild(spark, place):
    state = INC.PairState(spark, f"{place}/state")
    assert state.pairs().count() == 0 and state.version() == 0
    for i, last in enumerate((25, 55, 95)):  # orders turn from future to prior between the appends
        add(spark, place, wave(i, 30 * i))
        done = state.append(history(spark, last), f"{place}/lines")
        assert len(done["files"]) == 1 and not done["rebuilt"]
        assert rows(state.pairs()) == rows(full(spark, place, history(spark, last)))
    assert len(state.files()) == 3
    state.compact()
    assert rows(state.pairs()) == rows(full(spark, place, history(spark, 95)))
    assert state.vacuum() > 0 and rows(state.pairs()) == rows(full(spark, place, history(spark, 95)))


def test_an_append_reads_its_own_files_alone(spark, place):
    state, read = INC.PairState(spark, f"{place}/state"), []

    def reader(paths):
        read.append(len(paths))
        return spark.read.parquet(*paths)

    for i in range(3):
        add(spark, place, wave(i, 30 * i))
    assert len(state.append(history(spark, 95), f"{place}/lines", reader, at_most=2)["files"]) == 2
    state.append(history(spark, 95), f"{place}/lines", reader)
    state.append(history(spark, 95), f"{place}/lines", reader)
    assert read == [2, 1]
    assert rows(state.pairs()) == rows(full(spark, place, history(spark, 95)))


def test_a_killed_append_is_repeated_and_a_second_writer_refused(spark, place, monkeypatch):
    state = INC.PairState(spark, f"{place}/state")
    add(spark, place, wave(1, 0))
    state.append(history(spark, 95), f"{place}/lines")
    before = rows(state.pairs())
    add(spark, place, wave(2, 30))
    commit = INC.PairState._commit

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(INC.PairState, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        state.append(history(spark, 95), f"{place}/lines")
    monkeypatch.setattr(INC.PairState, "_commit", commit)
    assert rows(state.pairs()) == before
    state.append(history(spark, 95), f"{place}/lines")
    assert rows(state.pairs()) == rows(full(spark, place, history(spark, 95)))
    with pytest.raises(OSError):
        state._commit([], 1)


def test_a_changed_file_starts_anew_and_many_batches_merge(spark, place, monkeypatch):
    monkeypatch.setattr(INC, "MAX_BATCHES", 2)
    state = INC.PairState(spark, f"{place}/state")
    for i in range(4):
        add(spark, place, wave(i, 20 * i))
        state.append(history(spark, 95), f"{place}/lines")
    assert state.merged().count() == state.pairs().count() and len({r[3] for r in state._manifest()}) <= 2
    gone = sorted(f for f in os.listdir(f"{place}/lines") if f.endswith(".parquet"))[0]
    os.replace(f"{place}/lines/{gone}", f"{place}/{gone}")
    assert state.append(history(spark, 95), f"{place}/lines")["rebuilt"]
    assert rows(state.pairs()) == rows(full(spark, place, history(spark, 95)))
    assert state.rebuild(history(spark, 30), f"{place}/lines")["files"]
    assert rows(state.pairs()) == rows(full(spark, place, history(spark, 30)))
