"""Metrics against brute force; request validation; scoring rules."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from cartwise.operators import metrics as MT
from cartwise.operators import scoring as SC
from cartwise.sources.schemas import MODEL_FEATURES


def _auc_brute(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    tot = 0.0
    for p, n in itertools.product(pos, neg):
        tot += 1.0 if p > n else (0.5 if p == n else 0.0)
    return tot / (len(pos) * len(neg))


def test_auc_ties_exact(spark):
    labels = [1, 0, 1, 1, 0, 0, 1, 0, 0, 1, 0, 1] * 5
    scores = [0.9, 0.9, 0.5, 0.5, 0.5, 0.1, 0.7, 0.3, 0.3, 0.3, 0.0, 1.0] * 5
    df = spark.createDataFrame(list(zip(labels, scores, range(60))), "label int, score double, id long")
    got = MT.roc_auc(df, tiebreak=["id"]).first()["roc_auc"]
    assert math.isclose(got, _auc_brute(labels, scores), rel_tol=1e-12)


def test_binary_metrics_and_zero_division(spark):
    rows = [(1, 1, 0.9), (1, 0, 0.4), (0, 1, 0.6), (0, 0, 0.1), (0, 0, 0.2)]
    df = spark.createDataFrame(rows, "label int, prediction int, score double")
    m = MT.binary_metrics(df).first()
    assert m.accuracy == 3 / 5 and m.precision == 0.5 and m.recall == 0.5 and m.f1_score == 0.5
    one = spark.createDataFrame([(0, 0, 0.2), (0, 0, 0.3)], "label int, prediction int, score double")
    m1 = MT.binary_metrics(one).first()
    assert m1.precision == 0.0 and m1.recall == 0.0 and m1.f1_score == 0.0
    assert m1.roc_auc is None                         # one class only


def test_classification_report_and_confusion(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "label int, prediction int")
    cm = {(r.label, r.prediction): r["count"] for r in MT.confusion(df).collect()}
    assert cm == {(1, 1): 3, (1, 0): 1, (0, 1): 2, (0, 0): 4}
    rep = {r.row: r for r in MT.classification_report(df).collect()}
    assert math.isclose(rep["1"].precision, 3 / 5) and math.isclose(rep["1"].recall, 3 / 4)
    assert math.isclose(rep["0"].precision, 4 / 5) and math.isclose(rep["0"].recall, 4 / 6)
    assert rep["macro avg"].support == 10 and math.isclose(rep["accuracy"].f1_score, 0.7)
    w = (rep["0"].f1_score * 6 + rep["1"].f1_score * 4) / 10
    assert math.isclose(rep["weighted avg"].f1_score, w)


def test_cv_summary_comparison_selection(spark):
    folds = spark.createDataFrame([
        ("a", 1, 0.7, 0.6, 0.8, 0.7, 0.80, 1.0), ("a", 2, 0.7, 0.6, 0.8, 0.7, 0.82, 1.0),
        ("b", 1, 0.7, 0.6, 0.8, 0.7, 0.81, 2.0), ("b", 2, 0.7, 0.6, 0.8, 0.7, 0.81, 2.0),
    ], "model string, fold int, accuracy double, precision double, recall double, "
       "f1_score double, roc_auc double, training_time_seconds double")
    summ = MT.cv_summary(folds)
    s = {r.model: r for r in summ.collect()}
    assert math.isclose(s["a"].roc_auc_std, math.sqrt(2 * 0.01 ** 2))   # ddof = 1
    test = spark.createDataFrame([("a", 0.7, 0.2, 0.7, 0.3, 0.79), ("b", 0.7, 0.2, 0.7, 0.3, 0.80)],
                                 "model string, accuracy double, precision double, recall double, "
                                 "f1_score double, roc_auc double")
    cmp = MT.model_comparison(summ, test)
    row = {r.model: r for r in cmp.collect()}
    assert math.isclose(row["a"].roc_auc_generalization_gap, 0.81 - 0.79)
    assert math.isclose(row["b"].roc_auc_stability, 1 / 1e-8)
    # equal CV AUC / F1 / recall: the lower AUC std wins
    assert MT.select_final_model(cmp).first().model == "b"


VALID = {  # the documented example request
    "user_product_purchase_count": 0, "user_product_reorder_count": 0,
    "user_product_last_order_number": 0, "user_product_reorder_rate": 1,
    "user_product_avg_cart_position": 0, "user_product_recency_orders": 0, "department_id": 0,
    "user_department_purchase_count": 0, "user_department_purchase_share": 1, "aisle_id": 0,
    "user_aisle_purchase_count": 0, "user_aisle_purchase_share": 1, "user_total_orders": 0,
    "user_avg_days_between_orders": 0, "user_avg_order_hour": 23, "user_avg_order_dow": 6,
    "product_total_purchases": 0, "product_unique_users": 0, "product_reorder_rate": 1,
}


def test_request_rules_each_broken(spark):
    rows = [dict(VALID, request_id="ok")]
    expected = {"ok": []}
    for field, lo, hi in SC.REQUEST_RULES:
        bad = dict(VALID, request_id=f"{field}-lo")
        bad[field] = lo - 1
        rows.append(bad)
        expected[bad["request_id"]] = [f"{field}:ge_{lo}"]
        if hi is not None:
            b2 = dict(VALID, request_id=f"{field}-hi")
            b2[field] = hi + 0.5
            rows.append(b2)
            expected[b2["request_id"]] = [f"{field}:le_{hi}"]
    miss = dict(VALID, request_id="missing")
    miss["user_avg_order_hour"] = None
    rows.append(miss)
    expected["missing"] = ["user_avg_order_hour:missing"]
    schema = "request_id string, " + ", ".join(f"{c} double" for c in MODEL_FEATURES)
    df = spark.createDataFrame([{k: (None if v is None else (float(v) if k != "request_id" else v))
                                 for k, v in r.items()} for r in rows], schema)
    got = {r.request_id: list(r.violations) for r in SC.violations(df).collect()}
    assert got == expected
    ok, bad = SC.split_requests(df)
    assert ok.count() == 1 and bad.count() == len(rows) - 1


def test_tie_rules_at_half(spark):
    """A model that scores 0.5 exactly: p >= 0.5 says 1, the model's own argmax says 0."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from cartwise.plans import models as M

    rows = [(i, i, float(i % 2 == 0), 0.0, i % 2) for i in range(8)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, u double, x double, target int")
    model = M.fit(Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                                   DecisionTreeClassifier(labelCol="label", maxDepth=1)]), df)
    by_threshold = M.predict(model, df, "threshold").collect()
    by_argmax = M.predict(model, df, "argmax").collect()
    assert {r.score for r in by_threshold} == {0.5}
    assert {r.prediction for r in by_threshold} == {1} and {r.prediction for r in by_argmax} == {0}


def test_auc_ignores_rows_without_label_and_spreads_a_hot_score(spark):
    rows = [(1, 0.9), (0, 0.1), (None, 0.95), (None, 0.0), (1, None)]
    df = spark.createDataFrame(rows, "label int, score double")
    assert MT.roc_auc(df).first()["roc_auc"] == 1.0
    rng = __import__("random").Random(2)
    rows = [(rng.randrange(2), 0.5 if i % 3 == 0 else rng.choice([rng.random(), 0.25])) for i in range(600)]
    got = MT.roc_auc(spark.createDataFrame(rows, "label int, score double").repartition(6)).first()["roc_auc"]
    assert math.isclose(got, _auc_brute(*zip(*rows)), rel_tol=1e-12)


def test_equal_search_scores_share_the_smaller_rank(spark, monkeypatch):
    from cartwise.plans import validation as V

    bal = spark.createDataFrame([(i, i, float(i % 5), i % 2) for i in range(80)],
                                "user_id long, product_id long, x double, target int")
    monkeypatch.setattr(V.M, "tree_pipeline", lambda kind, impute="error", seed=42, **p: p["numTrees"])
    monkeypatch.setattr(V.M, "fit", lambda trees, rows: trees)
    monkeypatch.setattr(V.M, "predict", lambda trees, rows: rows.selectExpr(
        "target as label", f"{'x' if trees == 50 else 'cast(target as double)'} as score"))
    draws = [dict(V.draw_params(1)[0], n_estimators=n) for n in (75, 50, 100)]
    best, res = V.randomized_search(bal, draws=draws, folds=2)
    got = {r.draw: r for r in res.collect()}
    assert [got[i].rank_test_score for i in range(3)] == [1, 3, 1] and best == draws[0]
    assert got[0].mean_test_score == got[0].split0_test_score == got[0].split1_train_score == 1.0
    assert got[0].std_test_score == 0.0 and got[0].mean_fit_time >= 0


def test_selection_and_architecture_reports(spark):
    from cartwise.plans import report as RP

    folds = spark.createDataFrame(
        [(m, f, 0.7 + d, 0.3 + d, 0.6 + d, 0.4 + d, 0.8 + d + f / 100, 1.0 + f)
         for m, d in (("decision_tree", 0.0), ("gradient_boosting", 0.02)) for f in (1, 2, 3)],
        "model string, fold int, accuracy double, precision double, recall double, "
        "f1_score double, roc_auc double, training_time_seconds double")
    tests = spark.createDataFrame(
        [("decision_tree", 0.72, 0.15, 0.74, 0.25, 0.80, 0.5),
         ("gradient_boosting", 0.73, 0.16, 0.75, 0.26, 0.81, 0.4)],
        "model string, accuracy double, precision double, recall double, f1_score double, "
        "roc_auc double, model_size_mb double")
    cmp = MT.model_comparison(MT.cv_summary(folds), tests)
    text = RP.selection_report(cmp).first().report
    rows = [x for x in text.splitlines() if x.startswith("| 1 ") or x.startswith("| 2 ")]
    assert rows[0].startswith("| 1 | gradient_boosting | 0.7200 ± 0.0000 → 0.7300 |") and "| 0.0300 |" in rows[0]
    assert "* `gradient_boosting` before `decision_tree`: higher roc_auc_mean, 0.8400 against 0.8200" in text
    assert text.rstrip().endswith("Chosen: `gradient_boosting`")
    arch = MT.architecture_table(tests)
    lines = RP.architecture_report(arch).first().report.splitlines()
    assert lines[2].startswith("| model | accuracy") and lines[4].startswith("| gradient_boosting | 0.7300")


def test_plot_tables_long_bars_and_error_bars(spark):
    from cartwise.operators import plotdata as PD

    res = spark.createDataFrame([("a", 0.7, 0.8), ("b", 0.9, 0.6)],
                                "model string, accuracy double, roc_auc double")
    long = {(r.model, r.metric): r.value
            for r in PD.metric_long(res, ("accuracy", "roc_auc")).collect()}
    assert long == {("a", "accuracy"): 0.7, ("a", "roc_auc"): 0.8,
                    ("b", "accuracy"): 0.9, ("b", "roc_auc"): 0.6}
    bars = PD.ranked_bars(res, "roc_auc").collect()
    assert [(r.model, r.value) for r in bars] == [("a", 0.8), ("b", 0.6)]
    folds = spark.createDataFrame([("a", 1, 0.6), ("a", 2, 0.8), ("b", 1, 0.5), ("b", 2, 0.5)],
                                  "model string, fold int, roc_auc double")
    summ = folds.groupBy("model").agg(F.avg("roc_auc").alias("roc_auc_mean"),
                                      F.stddev_samp("roc_auc").alias("roc_auc_std"))
    eb = {r.model: (r.metric, round(r.value, 9), round(r.error, 9))
          for r in PD.metric_error_long(summ, ("roc_auc",)).collect()}
    assert eb == {"a": ("roc_auc", 0.7, round(math.sqrt(0.02), 9)), "b": ("roc_auc", 0.5, 0.0)}


def test_write_report_round_trip(spark, tmp_path):
    from cartwise.plans import report as RP

    text = "# Title\n\n| a | b |\n|---|---:|\n| x | 1.0000 |\n"
    path = str(tmp_path / "report")
    RP.write_report(spark.createDataFrame([(text,)], "report string"), path)
    back = "\n".join(r.value for r in spark.read.text(path).collect()) + "\n"
    assert back == text
