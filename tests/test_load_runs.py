"""Staged bulk load with rejects, and run-log appends that may be repeated."""

import gzip
import os
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import types as T

from cartwise.plans import runs as RU
from cartwise.session import checkpoint_dir
from cartwise.sources import load as L

SCHEMA = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("product_id", T.LongType()), T.StructField("rate", T.DoubleType())])
HEADER = "user_id,product_id,rate"


@pytest.fixture
def place(spark):
    path = f"{checkpoint_dir(spark)}/test-load-{uuid.uuid4().hex[:12]}"
    os.makedirs(f"{path}/in")
    return path


@pytest.fixture
def table(spark, place):
    name = f"load_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} (user_id bigint, product_id bigint, rate double) USING parquet LOCATION '{place}/t'")
    spark.createDataFrame([(9, 9, 9.0)], SCHEMA).write.insertInto(name)
    yield name
    spark.sql(f"DROP TABLE {name}")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_good_files_replace_the_table(spark, place, table):
    with open(f"{place}/in/a.csv", "w") as f:
        f.write(f"{HEADER}\n1,2,0.5\n\n3,4,\n")
    with gzip.open(f"{place}/in/b.csv.gz", "wt") as f:
        f.write(f"{HEADER}\n5,6,1e3\n\"7\",8,NaN\n")
    done = L.staged_load(spark, f"{place}/in", table, SCHEMA)
    assert done["loaded"] == 4 and done["rejected"] == 0 and done["rejects"] is None
    got = spark.table(table)
    assert sorted((r.user_id, r.product_id) for r in got.collect()) == [(1, 2), (3, 4), (5, 6), (7, 8)]
    assert got.filter("user_id = 3").first().rate is None and got.filter("user_id = 5").first().rate == 1000.0


def test_bad_rows_are_named_and_the_table_unchanged(spark, place, table):
    good = "\n".join(f"{i},{i},0.25" for i in range(2000))
    with open(f"{place}/in/a.csv", "w") as f:
        f.write(f"{HEADER}\n{good}\nx,1,2\n\n1,2\n,5,0\n1,2,3,4\n1,99999999999999999999,0\n{good}\n1,1,abc\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # several splits, numbered across
    try:
        with pytest.raises(L.LoadRejected) as e:
            L.staged_load(spark, f"{place}/in", table, SCHEMA)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows(spark.table(table)) == [(9, 9, 9.0)] and e.value.bad == 6
    found = {r.line: (r.reason, r.text, r.file.rsplit("/", 1)[1]) for r in spark.read.parquet(e.value.rejects).collect()}
    assert found == {
        2002: ("user_id: x is no bigint", "x,1,2", "a.csv"), 2004: ("not 3 fields", "1,2", "a.csv"),
        2005: ("user_id is missing", ",5,0", "a.csv"), 2006: ("not 3 fields", "1,2,3,4", "a.csv"),
        2007: ("product_id: 99999999999999999999 is no bigint", "1,99999999999999999999,0", "a.csv"),
        4008: ("rate: abc is no double", "1,1,abc", "a.csv")}
    assert [x for x in os.listdir(place) if "-load-" in x and not x.endswith("-rejects")] == []
    done = L.staged_load(spark, f"{place}/in", table, SCHEMA, max_rejects=6)
    assert done["loaded"] == 4000 == spark.table(table).count() and done["rejected"] == 6


def test_a_load_that_fails_leaves_nothing(spark, place, table):
    with pytest.raises(Exception):
        L.staged_load(spark, f"{place}/none", table, SCHEMA)
    with open(f"{place}/in/a.csv", "w") as f:
        f.write(f"{HEADER}\n")
    assert rows(spark.table(table)) == [(9, 9, 9.0)]
    assert L.staged_load(spark, f"{place}/in", table, SCHEMA)["loaded"] == 0 and spark.table(table).count() == 0


def test_a_repeated_append_leaves_one_run(spark, place, monkeypatch):
    path = f"{place}/runs"
    log = lambda i, auc: RU.log_run(spark, path, "e=1/x", "a", {}, {"roc_auc": auc}, run_id=i)
    assert log("job/7", 0.5) == "job/7" and log("job/7", 0.9) == "job/7"
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: log("job 8", 0.75), range(4)))
    got = RU.read_runs(spark, path)
    assert rows(got.selectExpr("experiment", "run_id", "metrics['roc_auc']")) == [("e=1/x", "job 8", 0.75), ("e=1/x", "job/7", 0.5)]
    assert RU.logged_runs(spark, path, "e=1/x") == {"job/7", "job 8"} and RU.logged_runs(spark, path, "other") == set()

    def killed(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # killed between writing and renaming
        m.setattr(RU, "quote", killed)
        with pytest.raises(KeyboardInterrupt):
            log("late", 0.1)
    assert got.count() == 2
    log("late", 0.2)
    assert rows(RU.read_runs(spark, path).filter("run_id = 'late'").selectExpr("metrics['roc_auc']")) == [(0.2,)]
    assert RU.log_run(spark, path, "e=1/x", "b", {}, {}) != RU.log_run(spark, path, "e=1/x", "b", {}, {})
    assert RU.read_runs(spark, path).count() == 5


def test_lines_are_parsed_in_one_pass(spark, place, table, monkeypatch):
    """The stage is written from one parse of the lines, without a filter on what is parsed."""
    with open(f"{place}/in/a.csv", "w") as f:
        f.write(f"{HEADER}\n1,2,0.5\nx,1,2\n3,4,1\n")
    made, parse = [], L.checked_lines
    monkeypatch.setattr(L, "checked_lines", lambda *a, **k: made.append(parse(*a, **k)) or made[-1])
    done = L.staged_load(spark, f"{place}/in", table, SCHEMA, max_rejects=1)
    assert len(made) == 1 and (done["loaded"], done["rejected"]) == (2, 1)
    assert rows(spark.table(table)) == [(1, 2, 0.5), (3, 4, 1.0)]
    assert [(r.line, r.reason, r.text) for r in spark.read.parquet(done["rejects"]).collect()] == [(3, "user_id: x is no bigint", "x,1,2")]
    with open(f"{place}/in/a.csv", "w") as f:
        f.write(f"{HEADER}\nx,1,2\n")
    assert L.staged_load(spark, f"{place}/in", table, SCHEMA, max_rejects=1)["loaded"] == 0 and spark.table(table).count() == 0
