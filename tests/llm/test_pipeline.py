import os

import corpus_pipeline
from cartwise.llm import common, decontam, quality, toxicity
from cartwise.llm.queries import ORACLES, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_decides_on_its_own_input(spark, sf001, monkeypatch):
    inputs = {}

    def watched(name, stage):
        def run(s, docs, d):
            inputs[name] = {r.doc_id: r for r in docs.collect()}
            assert docs.columns == COLUMNS
            return stage(s, docs, d)

        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
    packed = corpus_pipeline.run(spark, sf001).collect()
    docs, labels = common.table(spark, sf001, "documents"), common.table(spark, sf001, "labels")
    assert inputs["quality"].keys() == {r.doc_id for r in docs.collect()}

    model = quality.fit(docs, labels)
    ids, texts = zip(*((i, r.text) for i, r in inputs["quality"].items()), strict=True)
    assert inputs["toxicity"].keys() == {i for i, s in zip(ids, model.scores(list(texts)), strict=True) if s >= 0.7}

    poor = docs.filter(docs.doc_id.isin(list(inputs["toxicity"])))
    tox = toxicity.fit(poor, labels)
    ids, texts = zip(*((i, r.text) for i, r in inputs["toxicity"].items()), strict=True)
    assert inputs["near_dedup"].keys() == {i for i, s in zip(ids, tox.scores(list(texts)), strict=True) if s < 0.5}

    from test_simhash import brute_components, brute_fingerprint

    fps = {i: brute_fingerprint(r.text) for i, r in inputs["near_dedup"].items()}
    root, first = brute_components(fps.values()), {}
    for i, f in fps.items():
        first[root[f]] = min(first.get(root[f], i), i)
    assert inputs["decontamination"].keys() == set(first.values())

    from test_decontam import brute

    bench = [(r.item_id, r.text) for r in common.table(spark, sf001, "benchmark").collect()]
    clean = {d for d, _, hit, _ in brute([(i, r.text) for i, r in inputs["decontamination"].items()], bench) if not hit}
    assert inputs["packing"].keys() == clean == {r.doc_id for r in packed}


def test_empty_documents(spark, sf001):
    docs = common.table(spark, sf001, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, sf001), f"test-{name}")
    assert docs.count() == 0


def test_step_folders_lie_in_the_shared_folder_and_are_released(spark):
    folders = []
    with common.noting(folders):
        df = common.staged(spark.range(3).toDF("x"), "test")
    other = common.staged(spark.range(2).toDF("x"), "test")
    path = folders[0]
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and df.count() == 3
    common.release(spark, folders)
    assert not folders and not os.path.exists(path.removeprefix("file:")) and other.count() == 2


def test_every_numbered_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(ORACLES) <= set(QUERIES) and set(__spark_entry__.oracle_sql()) <= set(names)


def test_native_operators_plan_no_python(spark, sf001):
    for name in ("op4_benchmark_decontamination", "op7_chat_formatting", "op8_url_filters"):
        plan = QUERIES[name](spark, sf001)._jdf.queryExecution().executedPlan().toString()
        assert not any(k in plan for k in ("Python", "Pandas", "Arrow")), name


def test_phrase_matches_of_a_shared_passage(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"x{i} {passage} y{i}") for i in range(30)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    assert {r.n_hit for r in decontam.decontaminate(docs, bench).collect()} == {60}
