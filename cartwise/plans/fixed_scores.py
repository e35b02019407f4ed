"""Model tables on deterministic scores, so that DuckDB can check them.

Fitted trees have no SQL form, but everything after scoring has: fold metrics,
their summary, the comparison with test metrics, the final choice, the ranked
architecture table, error bars, the run table and soft voting. Here three
columns of the feature table stand for three models' probabilities, on the same
balanced rows, md5 folds and test split that the real models use, and the fold
number stands for a fit's seconds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwise import oracle as O
from cartwise.functions.columns import round_doubles
from cartwise.functions.sequence import release_held
from cartwise.operators import labels as LB
from cartwise.operators import metrics as MT
from cartwise.operators import plotdata as PD
from cartwise.plans import runs as RU
from cartwise.plans import stages as ST

#: Name and score of each stand-in, the same text in both dialects.
SCORES = {
    "by_product": "CAST(product_reorder_rate AS DOUBLE)",
    "by_purchases": "least(CAST(1.0 AS DOUBLE), CAST(user_product_purchase_count AS DOUBLE) / 4)",
    "by_share": "CAST(user_department_purchase_share AS DOUBLE)",
}
FOLDS = 3
QUERIES: dict = {}
SQL: dict[str, str] = {}


def _register(sql: str):
    def deco(fn):
        QUERIES[fn.__name__], SQL[fn.__name__] = fn, sql
        return fn
    return deco


def _long_sql(name: str, source: str, fold: str) -> str:
    """(model, fold, label, score, prediction) rows of every stand-in."""
    one = (f"SELECT '{{m}}' AS model, {fold} AS fold, target AS label, {{s}} AS score, "
           f"CAST({{s}} >= 0.5 AS INTEGER) AS prediction FROM {source}")
    return f"{name} AS (" + " UNION ALL ".join(one.format(m=m, s=s) for m, s in SCORES.items()) + ")"


def _metrics_sql(name: str, source: str) -> str:
    """The five metrics per (model, fold) of :func:`_long_sql` rows."""
    return f"""
{name}_g AS (SELECT model, fold, score, count(*) AS c, sum(label) AS p FROM {source} GROUP BY ALL),
{name}_b AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY model, fold ORDER BY score
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM {name}_g),
{name}_a AS (SELECT model, fold, (sum(p * (below + (c + 1) / 2.0)) - sum(p) * (sum(p) + 1) / 2.0)
                / (CAST(sum(p) AS DOUBLE) * (sum(c) - sum(p))) AS roc_auc FROM {name}_b GROUP BY ALL),
{name}_c AS (SELECT model, fold, count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
                count_if(label = 0 AND prediction = 0) AS tn, count_if(label = 1 AND prediction = 0) AS fn,
                count(*) AS n FROM {source} GROUP BY ALL),
{name} AS (SELECT model, fold, CAST(tp + tn AS DOUBLE) / n AS accuracy, {O.safe_div('tp', 'tp + fp')} AS precision,
             {O.safe_div('tp', 'tp + fn')} AS recall, {O.safe_div('2 * tp', '2 * tp + fp + fn')} AS f1_score, roc_auc
           FROM {name}_c JOIN {name}_a USING (model, fold))"""


_BASE = (O.basket_cte("brand_type"), O.features_cte(), O.labels_cte())
_FOLDED = f"""s_folded AS (SELECT *, CAST((row_number() OVER (PARTITION BY target ORDER BY {O._md5_key(':folds')},
  user_id NULLS FIRST, product_id NULLS FIRST) - 1) % {FOLDS} AS INTEGER) + 1 AS fold FROM balanced)"""
_CV = (*_BASE, _FOLDED, _long_sql("s_long", "s_folded", "fold"), _metrics_sql("s_m", "s_long"),
       "s_folds AS (SELECT *, CAST(fold AS DOUBLE) AS training_time_seconds FROM s_m)")
_TEST = (_long_sql("t_long", "test", "0"), _metrics_sql("t_m", "t_long"))
_SUMMARY = ("s_sum AS (SELECT model, " + ", ".join(
    f"avg({m}) AS {m}_mean, stddev_samp({m}) AS {m}_std" for m in MT.CV_METRICS) + " FROM s_folds GROUP BY model)")
_SUMMARY_COLS = [f"{m}_{k}" for m in MT.CV_METRICS for k in ("mean", "std")]
_COMPARE = ("s_cmp AS (SELECT s.*, " + ", ".join(f"t.{m} AS {m}_test" for m in MT.METRICS) + """,
  roc_auc_mean - t.roc_auc AS roc_auc_generalization_gap, f1_score_mean - t.f1_score AS f1_generalization_gap,
  abs(roc_auc_mean - t.roc_auc) AS abs_roc_auc_generalization_gap, abs(f1_score_mean - t.f1_score) AS abs_f1_generalization_gap,
  1.0 / (roc_auc_std + CAST(1e-8 AS DOUBLE)) AS roc_auc_stability,
  CAST(row_number() OVER (ORDER BY roc_auc_mean DESC, f1_score_mean DESC, recall_mean DESC, s.model) AS INTEGER) AS validation_rank
  FROM s_sum s LEFT JOIN t_m t ON s.model = t.model)""")
_COMPARE_COLS = [*_SUMMARY_COLS, *[f"{m}_test" for m in MT.METRICS], "roc_auc_generalization_gap", "f1_generalization_gap",
                 "abs_roc_auc_generalization_gap", "abs_f1_generalization_gap"]


def _rounded(cols) -> str:
    return ", ".join(f"round({c}, {O.R}) AS {c}" for c in cols)


def _all_scored(rows, *more: str):
    """Every model's scores in one pass: a row per row and model."""
    each = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(e).cast("double").alias("score")) for m, e in SCORES.items()])
    return (rows.select(*more, F.col("target").alias("label"), F.explode(each).alias("s"))
            .select(*more, "label", "s.model", "s.score", (F.col("s.score") >= 0.5).cast("int").alias("prediction")))


def _fold_rows(spark, sf_dir):
    """(model, fold, metrics, training_time_seconds), written once."""
    def build():
        held: list = []
        folded = LB.stratified_folds(ST.balanced(spark, sf_dir), FOLDS, hold=held)
        m = MT.metrics_by(_all_scored(folded, "fold"), ["model", "fold"])
        release_held(held)
        return m.select("model", (F.col("fold") + 1).alias("fold"), *MT.METRICS,
                        (F.col("fold") + 1).cast("double").alias("training_time_seconds"))
    return ST.stage(spark, sf_dir, "fixed-folds", build)


def _test_rows(spark, sf_dir):
    def build():
        return MT.metrics_by(_all_scored(ST.test(spark, sf_dir)), ["model"])
    return ST.stage(spark, sf_dir, "fixed-test", build)


def _comparison(spark, sf_dir):
    return MT.model_comparison(MT.cv_summary(_fold_rows(spark, sf_dir)), _test_rows(spark, sf_dir))


@_register(O.with_ctes(*_CV, body=f"SELECT model, fold, {_rounded(MT.METRICS)}, training_time_seconds FROM s_folds"))
def fixed_score_folds(spark, sf_dir):
    """M9's table: metrics per model and stratified fold."""
    return round_doubles(_fold_rows(spark, sf_dir))


@_register(O.with_ctes(*_CV, _SUMMARY, body=f"SELECT model, {_rounded(_SUMMARY_COLS)} FROM s_sum"))
def fixed_score_cv_summary(spark, sf_dir):
    """Mean and sample deviation of the fold metrics."""
    return round_doubles(MT.cv_summary(_fold_rows(spark, sf_dir)))


@_register(O.with_ctes(*_CV, *_TEST, _SUMMARY, _COMPARE, body=f"SELECT model, {_rounded(_COMPARE_COLS)}, "
                       "round(roc_auc_stability, 3) AS roc_auc_stability, validation_rank FROM s_cmp"))
def fixed_score_comparison(spark, sf_dir):
    """J13 + E8 + W2: CV summary with test metrics, gaps, stability, rank."""
    c = _comparison(spark, sf_dir)
    return round_doubles(c).withColumn("roc_auc_stability", F.round("roc_auc_stability", 3))


@_register(O.with_ctes(*_CV, *_TEST, _SUMMARY, _COMPARE, body="SELECT model, validation_rank FROM s_cmp ORDER BY "
                       "roc_auc_mean DESC, f1_score_mean DESC, recall_mean DESC, roc_auc_std, model LIMIT 1"))
def fixed_score_final_model(spark, sf_dir):
    """E9 + O1 + O2: the first row under the four priorities."""
    return MT.select_final_model(_comparison(spark, sf_dir)).select("model", "validation_rank")


@_register(O.with_ctes(*_BASE, *_TEST, body=f"""SELECT model, {_rounded(MT.METRICS)},
  CAST(length(model) AS DOUBLE) AS training_time_seconds,
  CAST(row_number() OVER (ORDER BY roc_auc DESC, model) AS INTEGER) AS auc_rank FROM t_m"""))
def fixed_score_architecture(spark, sf_dir):
    """E10 + J14: test metrics joined with earlier training times, ranked by AUC."""
    tests = _test_rows(spark, sf_dir)
    earlier = tests.select("model", F.length("model").cast("double").alias("training_time_seconds"))
    return round_doubles(MT.architecture_table(tests, earlier))


@_register(O.with_ctes(*_CV, _SUMMARY, body=" UNION ALL ".join(
    f"SELECT model, '{m}' AS metric, round({m}_mean, {O.R}) AS value, round({m}_std, {O.R}) AS error FROM s_sum"
    for m in MT.METRICS)))
def fixed_score_error_bars(spark, sf_dir):
    """V6: plot data of the CV comparison."""
    return round_doubles(PD.metric_error_long(MT.cv_summary(_fold_rows(spark, sf_dir))))


@_register(O.with_ctes(*_BASE, *_TEST, body=" UNION ALL ".join(
    f"SELECT 'fixed' AS experiment, model AS run_name, '{m}' AS metric, round({m}, {O.R}) AS value, "
    "model = (SELECT arg_max(model, roc_auc) FROM t_m) AS best FROM t_m" for m in MT.METRICS)))
def fixed_score_runs(spark, sf_dir):
    """X1 + X4: one run per model appended to a run table, read back per metric;
    the best run marked. The table is deleted once the summary is written."""
    import uuid

    from cartwise.functions.handoff import remove, written
    from cartwise.session import checkpoint_dir

    path = f"{checkpoint_dir(spark)}/runs-{uuid.uuid4().hex[:12]}"
    for r in _test_rows(spark, sf_dir).collect():     # one row per model
        RU.log_run(spark, path, "fixed", r.model, {"score": SCORES[r.model]}, {m: r[m] for m in MT.METRICS})
    runs = RU.read_runs(spark, path)
    best = RU.best_run(runs).select("experiment", F.col("run_id").alias("_best"))
    out, _ = written(RU.run_summary(runs).join(F.broadcast(best), "experiment")
                     .withColumn("best", F.col("run_id") == F.col("_best")).drop("_best", "run_id"), "fixed-runs")
    remove(spark, path)
    return round_doubles(out)


_VOTE = f"({' + '.join(SCORES.values())}) / {len(SCORES)}"


@_register(O.with_ctes(*_BASE, f"""t_long AS (SELECT 'vote' AS model, 0 AS fold, target AS label, {_VOTE} AS score,
  CAST({_VOTE} >= 0.5 AS INTEGER) AS prediction FROM test)""", _metrics_sql("t_m", "t_long"),
                       body=f"SELECT model, {_rounded(MT.METRICS)} FROM t_m"))
def fixed_score_vote(spark, sf_dir):
    """M6's rule on given scores: their mean, label 1 from one half."""
    s = F.expr(_VOTE)
    rows = ST.test(spark, sf_dir).select(F.col("target").alias("label"), s.alias("score"),
                                         (s >= 0.5).cast("int").alias("prediction"))
    return round_doubles(MT.binary_metrics(rows).select(F.lit("vote").alias("model"), *MT.METRICS))


@_register(O.with_ctes(*_BASE, "bal AS (SELECT user_id, product_id, target FROM balanced)",
                       O.per_class_sample_sql("bal", 101, ":cv", True), body=""))
def cv_sample_101(spark, sf_dir):
    """D6 with a size below the row count."""
    return LB.cv_sample(ST.balanced(spark, sf_dir).select("user_id", "product_id", "target"), 101)


@_register(O.with_ctes(*_BASE, body=f"SELECT user_id, product_id, target FROM labelled "
                       f"ORDER BY {O._md5_key('')}, user_id NULLS FIRST, product_id NULLS FIRST LIMIT 500"))
def plot_sample_500(spark, sf_dir):
    """D8 with a size below the row count."""
    return LB.plot_sample(ST.labelled(spark, sf_dir).select("user_id", "product_id", "target"), 500)
