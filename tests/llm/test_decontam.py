import hashlib
import random
import re

from pyspark.sql import functions as F

from cartwise.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UP))


def brute(docs, bench, window=10):
    """Per row: (n_words, n_hit, item ids as sorted strings); "" stands for the null item."""
    wins = {}
    for item, text in bench:
        w = words(text)
        if not w:
            continue
        for s in range(max(1, len(w) - window + 1)):
            wins.setdefault(tuple(w[s:s + window]), set()).add("" if item is None else str(item))
    lengths = {len(k) for k in wins}
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if (key := tuple(w[s:s + n])) in wins:
                    hit.update(range(s, s + n))
                    items |= wins[key]
        out.append((doc, len(w), len(hit), sorted(items)))
    return sorted(out, key=str)


def frames(spark, docs, bench):
    return (spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(bench, "item_id bigint, text string"))


def rows(df):
    null = lambda r: [""] * (r.n_items - len(r.item_ids))
    return sorted(((r.doc_id, r.n_words, r.n_hit, null(r) + list(r.item_ids)) for r in df.collect()), key=str)


def corpus():
    rng = random.Random(2)
    vocabulary = ["The", "of", "ÉTÉ", "été", "straße", "x1", "and"] + [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    bench = [(i, text(rng.randrange(1, 30))) for i in range(12)] + [(50, "the of"), (51, None), (52, "..."), (None, "w1 w2")]
    bench.append(bench[3])
    docs = [(i, text(rng.randrange(0, 120))) for i in range(40)]
    for i in range(40, 70):
        item = bench[i % 12][1]
        docs.append((i, text(20) + ",  " + item.upper().replace("É", "é") + "! " + text(5) + " " + item))
    docs += [(70, None), (71, ""), (72, "--- !!"), (5, docs[45][1]), (45, docs[45][1]), (None, docs[46][1]), (73, "of " * 500)]
    return docs, bench


def test_equals_brute_force(spark):
    docs, bench = corpus()
    assert rows(D.decontaminate(*frames(spark, docs, bench))) == brute(docs, bench)


def test_words_fold_only_ascii(spark):
    texts = ["ÀB c_D-e`f{g}", "ABC def GHI", "İstanbul ǅ", "ß SS \x7f z\x00y", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.transform(D.words(F.col("t")), D.fold).alias("w")).collect()
    assert [r.w for r in got] == [words(t) for t in texts]


def test_shuffle_join_beyond_the_broadcast_bound(spark, monkeypatch):
    docs, bench = corpus()
    want = rows(D.decontaminate(*frames(spark, docs, bench)))
    monkeypatch.setattr(D, "broadcast_if", lambda df, size: df)
    assert rows(D.decontaminate(*frames(spark, docs, bench))) == want


def test_empty_tables_and_other_columns(spark):
    docs, bench = frames(spark, [(1, "a b c")], [(1, "b")])
    assert rows(D.decontaminate(docs, bench.limit(0))) == [(1, 3, 0, [])]
    assert D.decontaminate(docs.limit(0), bench).count() == 0
    odd = docs.selectExpr("*", "1 as term", "2 as pos", "3 as uid", "4 as word", "5 as text_hash")
    assert rows(D.decontaminate(odd, bench.selectExpr("*", "1 as wid", "2 as phrase"))) == [(1, 3, 1, ["1"])]
    assert D.drop_contaminated(odd, bench).count() == 0


def test_drop_keeps_clean_rows_and_columns(spark):
    docs, bench = corpus()
    frame, items = frames(spark, docs, bench)
    kept = D.drop_contaminated(frame.withColumn("lang", F.lit("en")), items)
    assert kept.columns == ["doc_id", "text", "lang"]
    hit = {words and (d, t) for (d, t), words in (((d, t), brute([(d, t)], bench)[0][2]) for d, t in docs) if words}
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted([x for x in docs if x not in hit], key=str)


def test_query_digest(spark, tmp_path):
    from cartwise.llm.queries import QUERIES

    docs, bench = corpus()
    a, b = frames(spark, docs, bench)
    a.write.parquet(f"{tmp_path}/documents.parquet")
    b.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op4_benchmark_decontamination"](spark, str(tmp_path)).collect()
    want = [(d, n, h, len(i), hashlib.sha256(",".join(x for x in i if x).encode()).hexdigest(), h > 0) for d, n, h, i in brute(docs, bench)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_proximity(spark):
    docs = [(1, "red a b blue c d green"), (2, "red x x x x x x x x x blue green"), (3, "green blue red"), (4, "red blue")]
    bench = [(1, "red blue green")]
    frame, items = frames(spark, docs, bench)
    phrases = D.Phrases(D.item_windows(items, 10))
    index = D.build_index(frame, phrases)
    of = {r.uid: r.doc_id for r in index.filter("term = 0").collect()}
    assert {of[r.uid] for r in D.proximity_matches(index, phrases, 6).collect()} == {1, 3}
    assert {of[r.uid] for r in D.proximity_matches(index, phrases, 2).collect()} == {3}


def test_words_of_a_null_item_are_hit(spark):
    docs = [(13, "one w1 w2 two"), (14, "w1 two"), (15, "w1 w2 w3")]
    bench = [(None, "w1 w2"), (None, "w1 w2"), (4, "w3")]
    assert rows(D.decontaminate(*frames(spark, docs, bench))) == [(13, 4, 2, [""]), (14, 2, 0, []), (15, 3, 3, ["", "4"])]
    assert [r.doc_id for r in D.drop_contaminated(*frames(spark, docs, bench)).collect()] == [14]


def test_null_items_equal_the_sql(spark, tmp_path):
    import duckdb

    from cartwise.llm.queries import ORACLES, QUERIES

    docs, bench = corpus()
    docs = [d for d in {i: (i, t) for i, t in reversed(docs)}.values() if d[0] is not None]  # the SQL asks for single ids
    a, b = frames(spark, docs, [*bench, (None, docs[20][1])])
    con = duckdb.connect()
    for name, frame in (("documents", a), ("benchmark", b)):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    got = QUERIES["op4_benchmark_decontamination"](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op4_benchmark_decontamination']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
