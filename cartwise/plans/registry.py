"""Registered queries (Spark) and their DuckDB oracle strings.

Each query takes (spark, sf_dir), adapts the driver's tables to basket tables
and runs one operator of the library over the whole data set.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwise import oracle as O
from cartwise.functions.columns import round_doubles
from cartwise.functions.handoff import remove_at_exit
from cartwise.operators import features as FT
from cartwise.operators.incremental import PairState
from cartwise.session import checkpoint_dir
from cartwise.sources.adapter import load_basket

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ----------------------------------------------------------------------------- features

@register("customer_product_features", O.with_ctes(
    O.basket_cte("part"), O.features_cte(),
    body=O.rounded_select(O.FEATURE_COLS_TYPES, "features")))
def customer_product_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(FT.build_features(load_basket(spark, sf_dir, "part")))


from pyspark.sql import functions as F  # noqa: E402

from cartwise.operators import labels as LB  # noqa: E402
from cartwise.operators import metrics as MT  # noqa: E402
from cartwise.operators import plotdata as PD  # noqa: E402
from cartwise.operators import quality as QC  # noqa: E402
from cartwise.operators import scoring as SC  # noqa: E402
from cartwise.plans import stages as ST  # noqa: E402
from cartwise.sources.schemas import MODEL_FEATURES  # noqa: E402

_B = O.basket_cte("part")
_BT = O.basket_cte("brand_type")
_F = O.features_cte()
_L = O.labels_cte()


def _sql(*ctes, body):
    return O.with_ctes(*ctes, body=body)


# ---------------------------------------------------------------- adapter (basket tables)

@register("basket_orders", _sql(_B, body="SELECT * FROM b_orders"))
def basket_orders(spark, sf_dir):
    return load_basket(spark, sf_dir, "part").orders


@register("basket_lines", _sql(_B, body="SELECT order_id, product_id, add_to_cart_order, "
                                        "user_id, eval_set, order_number, reordered FROM b_lines"))
def basket_lines(spark, sf_dir):
    return load_basket(spark, sf_dir, "part").lines.select(
        "order_id", "product_id", "add_to_cart_order", "user_id", "eval_set", "order_number",
        "reordered")


# ---------------------------------------------------------------- feature parts

@register("user_order_features", _sql(_B, body=f"""
SELECT user_id, CAST(count(order_id) AS BIGINT) AS user_total_orders,
       round(avg(days_since_prior_order), {O.R}) AS user_avg_days_between_orders,
       round(avg(order_hour_of_day), {O.R}) AS user_avg_order_hour,
       round(avg(order_dow), {O.R}) AS user_avg_order_dow,
       max(order_number) AS user_last_order_number
FROM b_orders WHERE eval_set = 'prior' GROUP BY user_id"""))
def user_order_features(spark, sf_dir):
    return round_doubles(FT.user_order_features(load_basket(spark, sf_dir, "part").orders))


_PAIR_SQL = f"""
SELECT user_id, product_id, CAST(count(order_id) AS BIGINT) AS user_product_purchase_count,
       CAST(sum(reordered) AS BIGINT) AS user_product_reorder_count,
       CAST(max(order_number) AS BIGINT) AS user_product_last_order_number,
       round(CAST(sum(reordered) AS DOUBLE) / count(order_id), {O.R}) AS user_product_reorder_rate,
       round(CAST(sum(add_to_cart_order) AS DOUBLE) / count(order_id), {O.R})
         AS user_product_avg_cart_position
FROM b_lines WHERE eval_set = 'prior' GROUP BY user_id, product_id"""


@register("pair_stats", _sql(_B, body=_PAIR_SQL))
def pair_stats(spark, sf_dir):
    b = load_basket(spark, sf_dir, "part")
    return round_doubles(FT.pair_stats(b.lines.filter(F.col("eval_set") == "prior")))


@register("appended_pair_stats", _sql(_B, body=_PAIR_SQL))
def appended_pair_stats(spark, sf_dir):
    """The pair table from the state of appended line files: half of them, then the rest."""
    b = load_basket(spark, sf_dir, "part")
    path = f"{checkpoint_dir(spark)}/step-pairstate-{uuid.uuid4().hex[:12]}"
    remove_at_exit(spark, path)
    state = PairState(spark, path)
    files = [f for f in b.lines.inputFiles() if "eval_set=prior" in f]
    if files:
        folder = files[0].rsplit("/", 1)[0]
        state.append(b.orders, folder, at_most=max(1, len(files) // 2))
        state.append(b.orders, folder)
    return round_doubles(state.pairs())


@register("pair_recency", _sql(_B, "ps AS (" + _PAIR_SQL + ")", body="""
SELECT ps.*, CAST(u.ulon - ps.user_product_last_order_number AS BIGINT)
         AS user_product_recency_orders
FROM ps LEFT JOIN (SELECT user_id, max(order_number) AS ulon FROM b_orders
                   WHERE eval_set = 'prior' GROUP BY user_id) u ON ps.user_id = u.user_id"""))
def pair_recency(spark, sf_dir):
    b = load_basket(spark, sf_dir, "part")
    pairs = FT.pair_stats(b.lines.filter(F.col("eval_set") == "prior"))
    return round_doubles(FT.pair_recency(pairs, FT.user_order_features(b.orders)))


@register("product_features", _sql(_B, _F, body=f"""
SELECT pr.product_id, CAST(pr.ptp AS BIGINT) AS product_total_purchases,
       CAST(pr.puu AS BIGINT) AS product_unique_users,
       round(CAST(pr.prr AS DOUBLE), {O.R}) AS product_reorder_rate,
       d.aisle_id, d.department_id
FROM f_prod pr LEFT JOIN f_dims d ON pr.product_id = d.product_id"""))
def product_features(spark, sf_dir):
    b = load_basket(spark, sf_dir, "part")
    pairs = FT.pair_stats(b.lines.filter(F.col("eval_set") == "prior"))
    return round_doubles(FT.product_features(pairs, b.products))


def _affinity_sql(level, short):
    key = f"{level}_id"
    return _sql(_B, _F, body=f"""
SELECT user_id, {key}, CAST(u{short}c AS BIGINT) AS user_{level}_purchase_count,
       round(CAST(u{short}s AS DOUBLE), {O.R}) AS user_{level}_purchase_share
FROM f_u{short}""")


@register("user_department_affinity", _affinity_sql("department", "d"))
def user_department_affinity(spark, sf_dir):
    b = load_basket(spark, sf_dir, "part")
    pairs = FT.pair_stats(b.lines.filter(F.col("eval_set") == "prior"))
    return round_doubles(FT.user_category_affinity(FT.pairs_with_category(pairs, b.products),
                                                   "department"))


@register("user_aisle_affinity", _affinity_sql("aisle", "a"))
def user_aisle_affinity(spark, sf_dir):
    b = load_basket(spark, sf_dir, "part")
    pairs = FT.pair_stats(b.lines.filter(F.col("eval_set") == "prior"))
    return round_doubles(FT.user_category_affinity(FT.pairs_with_category(pairs, b.products),
                                                   "aisle"))


@register("customer_product_features_brand_type", _sql(
    _BT, _F, body=O.rounded_select(O.FEATURE_COLS_TYPES, "features")))
def customer_product_features_brand_type(spark, sf_dir):
    return round_doubles(FT.build_features(load_basket(spark, sf_dir, "brand_type")))


# ---------------------------------------------------------------- quality

def _quality_sql():
    from cartwise.sources.schemas import COUNT_FEATURES, FEATURE_SCHEMA, RATE_FEATURES
    parts = ["SELECT 'row_count' AS \"check\", '*' AS \"column\", CAST(count(*) AS DOUBLE) AS value FROM features",
             "SELECT 'duplicate_keys', 'user_id,product_id', CAST(count(*) - count(DISTINCT (user_id, product_id)) AS DOUBLE) FROM features"]
    for f in FEATURE_SCHEMA.fields:
        parts.append(f"SELECT 'null_count', '{f.name}', CAST(count_if({f.name} IS NULL) AS DOUBLE) FROM features")
    for f in FEATURE_SCHEMA.fields:
        if f.dataType.simpleString() == "double":
            parts.append(f"SELECT 'infinite_count', '{f.name}', CAST(count_if(isinf({f.name})) AS DOUBLE) FROM features")
        else:
            parts.append(f"SELECT 'infinite_count', '{f.name}', 0.0")
    for c in RATE_FEATURES:
        parts.append(f"SELECT 'min', '{c}', round(min({c}), {O.R}) FROM features")
        parts.append(f"SELECT 'max', '{c}', round(max({c}), {O.R}) FROM features")
    for c in COUNT_FEATURES:
        parts.append(f"SELECT 'negative_count', '{c}', CAST(count_if({c} < 0) AS DOUBLE) FROM features")
    return _sql(_B, _F, body="\nUNION ALL\n".join(parts))


@register("feature_quality_report", _quality_sql())
def feature_quality_report(spark, sf_dir):
    return round_doubles(QC.quality_report(ST.features(spark, sf_dir, "part")))


@register("warehouse_checks", _sql(_B, _F, body="""
SELECT count(*) AS row_count,
       count(DISTINCT CAST(user_id AS VARCHAR) || '-' || CAST(product_id AS VARCHAR))
         AS unique_customer_product_pairs,
       count_if(user_id IS NULL) AS null_user_ids, count_if(product_id IS NULL) AS null_product_ids,
       count_if(user_product_purchase_count < 0) AS negative_purchase_counts,
       count_if(user_product_reorder_count < 0) AS negative_reorder_counts,
       count_if(user_product_reorder_rate < 0 OR user_product_reorder_rate > 1) AS invalid_reorder_rates,
       count_if(user_department_purchase_share < 0 OR user_department_purchase_share > 1)
         AS invalid_department_shares,
       count_if(user_aisle_purchase_share < 0 OR user_aisle_purchase_share > 1) AS invalid_aisle_shares,
       count_if(product_reorder_rate < 0 OR product_reorder_rate > 1) AS invalid_product_reorder_rates
FROM features"""))
def warehouse_checks(spark, sf_dir):
    return QC.warehouse_checks(ST.features(spark, sf_dir, "part"))


@register("feature_null_counts", _sql(_B, _F, body="\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS null_count FROM features"
    for c, _ in O.FEATURE_COLS_TYPES)))
def feature_null_counts(spark, sf_dir):
    return QC.null_counts(ST.features(spark, sf_dir, "part"))


@register("feature_profile", _sql(_B, _F, body="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", s.statistic, round(s.value, {O.R}) AS value FROM (
  SELECT unnest([{{'statistic': 'count', 'value': CAST(count({c}) AS DOUBLE)}},
                 {{'statistic': 'mean', 'value': avg({c})}},
                 {{'statistic': 'std', 'value': stddev_samp({c})}},
                 {{'statistic': 'min', 'value': CAST(min({c}) AS DOUBLE)}},
                 {{'statistic': 'max', 'value': CAST(max({c}) AS DOUBLE)}},
                 {{'statistic': '25%', 'value': quantile_cont(CAST({c} AS DOUBLE), 0.25)}},
                 {{'statistic': '50%', 'value': quantile_cont(CAST({c} AS DOUBLE), 0.5)}},
                 {{'statistic': '75%', 'value': quantile_cont(CAST({c} AS DOUBLE), 0.75)}}]) AS s
  FROM features)""" for c in MODEL_FEATURES)))
def feature_profile(spark, sf_dir):
    return round_doubles(QC.profile(ST.features(spark, sf_dir, "part"), MODEL_FEATURES))


@register("order_dow_value_counts", _sql(_B, body=f"""
SELECT order_dow, count(*) AS count, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), {O.R}) AS share
FROM b_orders GROUP BY order_dow"""))
def order_dow_value_counts(spark, sf_dir):
    return round_doubles(QC.value_counts(load_basket(spark, sf_dir, "part").orders, "order_dow"))


# ---------------------------------------------------------------- labels and sampling

_LBL = (_BT, _F, _L)


@register("feature_head_20", _sql(_B, _F, body=O.rounded_select(O.FEATURE_COLS_TYPES, "features")
                                   + " ORDER BY user_id, product_id LIMIT 20"))
def feature_head_20(spark, sf_dir):
    """O1 + O3: the warehouse preview (first 20 feature rows); ordered by the key
    so that the preview is deterministic. A top-k: each task keeps its 20 best
    rows, the driver merges at most 20 per task."""
    return round_doubles(ST.features(spark, sf_dir, "part").orderBy("user_id", "product_id").limit(20))


_PLOT_FEATURES = ["user_product_purchase_count", "user_product_reorder_rate",
                  "user_product_recency_orders", "product_reorder_rate"]
_PLOT_TYPES = dict(O.FEATURE_COLS_TYPES)


@register("plot_sample_features", _sql(*_LBL, body=O.rounded_select(
    [("user_id", "bigint"), ("product_id", "bigint"), ("target", "int")]
    + [(c, _PLOT_TYPES[c]) for c in _PLOT_FEATURES], "balanced")
    + f" ORDER BY {O._md5_key('')}, user_id NULLS FIRST, product_id NULLS FIRST LIMIT 50000"))
def plot_sample_features(spark, sf_dir):
    """Seeded sample of min(50 000, n) balanced training rows with the four
    plotted features (a bounded top-n by the md5 order key)."""
    bal = ST.balanced(spark, sf_dir)
    return round_doubles(LB.plot_sample(bal, 50_000).select("user_id", "product_id", "target",
                                                            *_PLOT_FEATURES))


@register("future_pairs", _sql(_BT, body="SELECT DISTINCT user_id, product_id FROM b_lines "
                                         "WHERE eval_set = 'train'"))
def future_pairs(spark, sf_dir):
    b = load_basket(spark, sf_dir, "brand_type")
    return LB.future_pairs(b.orders, b.order_products_train)


@register("labelled_pairs", _sql(*_LBL, body=O.rounded_select(
    O.FEATURE_COLS_TYPES + [("target", "int")], "labelled")))
def labelled_pairs(spark, sf_dir):
    return round_doubles(ST.labelled(spark, sf_dir))


@register("train_test_split", _sql(*_LBL, body="SELECT user_id, product_id, target, is_test FROM split"))
def train_test_split(spark, sf_dir):
    return LB.split_flag(ST.labelled(spark, sf_dir)).select("user_id", "product_id", "target",
                                                            "is_test")


@register("class_distribution", _sql(*_LBL, body=f"""
SELECT name AS split, target AS class, count(*) AS count,
       round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY name), {O.R}) AS percent
FROM (SELECT 'all' AS name, target FROM labelled UNION ALL SELECT 'train', target FROM train
      UNION ALL SELECT 'test', target FROM test UNION ALL SELECT 'balanced', target FROM balanced) x
GROUP BY name, target"""))
def class_distribution(spark, sf_dir):
    parts = [QC.class_distribution(ST.labelled(spark, sf_dir), name="all"),
             QC.class_distribution(ST.train(spark, sf_dir), name="train"),
             QC.class_distribution(ST.test(spark, sf_dir), name="test"),
             QC.class_distribution(ST.balanced(spark, sf_dir), name="balanced")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return round_doubles(out)


@register("balanced_train", _sql(*_LBL, body="SELECT user_id, product_id, target FROM balanced"))
def balanced_train(spark, sf_dir):
    return LB.balance_undersample(ST.train(spark, sf_dir)).select("user_id", "product_id", "target")


@register("cv_sample", _sql(*_LBL, "bal AS (SELECT user_id, product_id, target FROM balanced)",
                            O.per_class_sample_sql("bal", 150_000, ":cv", True), body=""))
def cv_sample(spark, sf_dir):
    return LB.cv_sample(ST.balanced(spark, sf_dir).select("user_id", "product_id", "target"),
                        150_000)


@register("tuning_sample", _sql(*_LBL, "bal AS (SELECT user_id, product_id, target FROM balanced)",
                                O.per_class_sample_sql("bal", 250_000, ":sample", False), body=""))
def tuning_sample(spark, sf_dir):
    return LB.stratified_sample(ST.balanced(spark, sf_dir).select("user_id", "product_id", "target"),
                                250_000)


@register("train_sample_1000", _sql(*_LBL, "tr AS (SELECT user_id, product_id, target FROM train)",
                                    O.per_class_sample_sql("tr", 1000, ":sample", False), body=""))
def train_sample_1000(spark, sf_dir):
    """D4 on the (unbalanced) training rows with a size below the row count."""
    return LB.stratified_sample(ST.train(spark, sf_dir).select("user_id", "product_id", "target"), 1000)


@register("stratified_folds", _sql(*_LBL, body=f"""
SELECT user_id, product_id, target,
       CAST((row_number() OVER (PARTITION BY target ORDER BY {O._md5_key(':folds')}, user_id NULLS FIRST,
             product_id NULLS FIRST) - 1) % 3 AS INTEGER) AS fold
FROM balanced"""))
def stratified_folds(spark, sf_dir):
    return LB.stratified_folds(ST.balanced(spark, sf_dir).select("user_id", "product_id", "target"), 3)


@register("balanced_shuffled", _sql(*_LBL, body=f"""
SELECT user_id, product_id, target,
       row_number() OVER (ORDER BY {O._md5_key(':shuffle')}, user_id NULLS FIRST, product_id NULLS FIRST) AS position
FROM balanced"""))
def balanced_shuffled(spark, sf_dir):
    """The balanced training rows in seeded random order."""
    return LB.seeded_shuffle(ST.balanced(spark, sf_dir).select("user_id", "product_id", "target"))


# ---------------------------------------------------------------- metrics on a fixed score

def _scored(spark, sf_dir):
    t = ST.test(spark, sf_dir)
    s = F.least(F.lit(1.0), F.col("user_product_purchase_count").cast("double") / 10)
    return t.select("user_id", "product_id", F.col("target").alias("label"), s.alias("score"),
                    (s >= 0.5).cast("int").alias("prediction"))


_M = (*_LBL, O.scored_cte())


@register("confusion_matrix", _sql(*_M, body="SELECT label, prediction, count(*) AS count "
                                             "FROM m_scored GROUP BY label, prediction"))
def confusion_matrix(spark, sf_dir):
    return MT.confusion(_scored(spark, sf_dir))


@register("binary_metrics", _sql(*_M, body=f"""
SELECT round({O.safe_div('tp + tn', 'n')}, {O.R}) AS accuracy,
       round({O.safe_div('tp', 'tp + fp')}, {O.R}) AS precision,
       round({O.safe_div('tp', 'tp + fn')}, {O.R}) AS recall,
       round({O.safe_div('2 * tp', '2 * tp + fp + fn')}, {O.R}) AS f1_score,
       round(roc_auc, {O.R}) AS roc_auc
FROM m_cnt CROSS JOIN m_auc"""))
def binary_metrics(spark, sf_dir):
    return round_doubles(MT.binary_metrics(_scored(spark, sf_dir), tiebreak=["user_id", "product_id"]))


@register("roc_auc_exact", _sql(*_M, body=f"SELECT round(roc_auc, {O.R}) AS roc_auc FROM m_auc"))
def roc_auc_exact(spark, sf_dir):
    return round_doubles(MT.roc_auc(_scored(spark, sf_dir), tiebreak=["user_id", "product_id"]))


@register("classification_report", _sql(*_M, body=f"""
, cls AS (
  SELECT '0' AS row, {O.safe_div('tn', 'tn + fn')} AS precision, {O.safe_div('tn', 'tn + fp')} AS recall,
         {O.safe_div('2 * tn', '2 * tn + fn + fp')} AS f1_score, CAST(tn + fp AS DOUBLE) AS support, n
  FROM m_cnt
  UNION ALL
  SELECT '1', {O.safe_div('tp', 'tp + fp')}, {O.safe_div('tp', 'tp + fn')},
         {O.safe_div('2 * tp', '2 * tp + fp + fn')}, CAST(tp + fn AS DOUBLE), n FROM m_cnt)
SELECT row, round(precision, {O.R}) AS precision, round(recall, {O.R}) AS recall,
       round(f1_score, {O.R}) AS f1_score, support FROM cls
UNION ALL
SELECT 'macro avg', round(avg(precision), {O.R}), round(avg(recall), {O.R}), round(avg(f1_score), {O.R}),
       sum(support) FROM cls
UNION ALL
SELECT 'weighted avg', round(sum(precision * support / n), {O.R}), round(sum(recall * support / n), {O.R}),
       round(sum(f1_score * support / n), {O.R}), sum(support) FROM cls
UNION ALL
SELECT 'accuracy', NULL, NULL, round({O.safe_div('tp + tn', 'n')}, {O.R}), CAST(n AS DOUBLE) FROM m_cnt"""))
def classification_report(spark, sf_dir):
    return round_doubles(MT.classification_report(_scored(spark, sf_dir)))


# ---------------------------------------------------------------- request validation

@register("request_validation", _sql(_BT, _F, body="SELECT user_id, product_id, " + """
       list_count(v) = 0 AS is_valid, array_to_string(v, ',') AS violations FROM (
  SELECT user_id, product_id, list_filter([""" + ", ".join(
    [f"CASE WHEN {f} IS NULL OR isnan(CAST({f} AS DOUBLE)) THEN '{f}:missing' END, "
     f"CASE WHEN {f} < {lo} THEN '{f}:ge_{lo}' END"
     + (f", CASE WHEN {f} > {hi} THEN '{f}:le_{hi}' END" if hi is not None else "")
     for f, lo, hi in SC.REQUEST_RULES]) + """], lambda x: x IS NOT NULL) AS v
  FROM features) r"""))
def request_validation(spark, sf_dir):
    v = SC.violations(ST.features(spark, sf_dir, "brand_type"))
    return v.select("user_id", "product_id", "is_valid",
                    F.array_join("violations", ",").alias("violations"))


# ---------------------------------------------------------------- plot data

@register("purchase_count_box", _sql(*_LBL, body="\nUNION ALL\n".join(
    f"SELECT target AS \"group\", '{name}' AS statistic, "
    f"round(quantile_cont(CAST(user_product_purchase_count AS DOUBLE), {p}), {O.R}) AS value "
    f"FROM labelled GROUP BY target"
    for name, p in (("min", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1.0)))))
def purchase_count_box(spark, sf_dir):
    return round_doubles(PD.box_stats(ST.labelled(spark, sf_dir), "user_product_purchase_count",
                                      "target"))


# ---------------------------------------------------------------- models (no SQL form)

from cartwise.plans import models as MD  # noqa: E402
from cartwise.plans import validation as VA  # noqa: E402

def _test_metrics(spark, sf_dir, kind, rule="threshold"):
    return ST.test_metrics(spark, sf_dir, kind, rule)


@register("logistic_baseline_test_metrics", None)
def logistic_baseline_test_metrics(spark, sf_dir):
    """M1 + T1–T3: scaled + one-hot logistic regression, evaluated on the test split."""
    return _test_metrics(spark, sf_dir, "logistic_regression")


@register("decision_tree_test_metrics", None)
def decision_tree_test_metrics(spark, sf_dir):
    """M2 with the reference parameters (depth 12, leaf 10)."""
    return _test_metrics(spark, sf_dir, "decision_tree", rule="argmax")


@register("random_forest_test_metrics", None)
def random_forest_test_metrics(spark, sf_dir):
    """M3: 100 trees, depth 15, leaf 5, sqrt features."""
    return _test_metrics(spark, sf_dir, "random_forest", rule="argmax")


@register("gradient_boosting_test_metrics", None)
def gradient_boosting_test_metrics(spark, sf_dir):
    """M4: 100 rounds, step 0.1, depth 5."""
    return _test_metrics(spark, sf_dir, "gradient_boosting", rule="argmax")


@register("tuned_random_forest_test_metrics", None)
def tuned_random_forest_test_metrics(spark, sf_dir):
    """M5: the search's best draw, fitted anew on all balanced training rows."""
    return _test_metrics(spark, sf_dir, ST.TUNED, rule="argmax")


@register("tuned_random_forest_validation", None)
def tuned_random_forest_validation(spark, sf_dir):
    """M5 + D5: metrics on the search's 20 % part and on the test split (two rows)."""
    return ST.tuned_metrics(spark, sf_dir)


@register("soft_voting_test_metrics", None)
def soft_voting_test_metrics(spark, sf_dir):
    """M6: mean P(1) of the three tree models, p >= 0.5."""
    return _test_metrics(spark, sf_dir, "soft_voting")


@register("cross_validation_folds", None)
def cross_validation_folds(spark, sf_dir):
    """M9: 3-fold stratified CV of the three tree models (fresh fit per fold)."""
    return ST.cv_folds(spark, sf_dir)


@register("randomized_search_results", None)
def randomized_search_results(spark, sf_dir):
    """8 seeded draws of the forest search space, 2-fold CV on ROC-AUC."""
    # Searched on 80 % of the balanced rows, the 20 % validates the best draw
    # (tuned_random_forest_validation)
    return ST.search_results(spark, sf_dir)


@register("model_selection", None)
def model_selection(spark, sf_dir):
    """A17 + E8 + E9 + W2: CV summary joined with test metrics, gaps, stability,
    validation rank; ``selected`` marks the model chosen by the four priorities."""
    cmp = _comparison(spark, sf_dir)
    best = MT.select_final_model(cmp).first()["model"]
    return cmp.withColumn("selected", F.col("model") == F.lit(best))


def _comparison(spark, sf_dir):
    # the tests' models are fitted beside the folds'; times are taken after both
    ST.balanced(spark, sf_dir)
    folds, _ = ST.side_by_side(spark, lambda: ST.cv_folds(spark, sf_dir),
                               lambda: ST.rule_metrics(spark, sf_dir, [*ST.TABLE_KINDS, ST.VOTE]))
    tests = ST.table_metrics(spark, sf_dir, "argmax").drop("inference_time_ms", "inference_ms_per_row", "evaluation_time_seconds")
    return MT.model_comparison(MT.cv_summary(folds), tests)


@register("cv_metric_error_bars", None)
def cv_metric_error_bars(spark, sf_dir):
    """V6: plot data of the CV comparison — mean and sample std per model and
    metric (bars with error bars)."""
    return PD.metric_error_long(MT.cv_summary(ST.cv_folds(spark, sf_dir)))


@register("model_selection_report", None)
def model_selection_report(spark, sf_dir):
    """The selection report (markdown) as one row."""
    from cartwise.plans import report as RP

    return RP.selection_report(_comparison(spark, sf_dir))


@register("architecture_comparison", None)
def architecture_comparison(spark, sf_dir):
    """E10 + J14 + O1: the three tree models, the tuned forest and the soft-voting
    ensemble on the test split (p >= 0.5 rule for all, as the comparison uses),
    with the training run's fit seconds joined by model (the ensemble's: those of
    its members), ranked by AUC."""
    fit_times = None
    rows = ST.table_metrics(spark, sf_dir, "threshold").drop("test_prediction_time_seconds", "evaluation_time_seconds")
    for kind in (*ST.TREE_KINDS, ST.TUNED):
        t = ST.fit_seconds(spark, sf_dir, kind)
        fit_times = t if fit_times is None else fit_times.unionByName(t)
    vote = fit_times.filter(F.col("model").isin(*ST.TREE_KINDS)).agg(
        F.lit("soft_voting").alias("model"), F.sum("training_time_seconds").alias("training_time_seconds"))
    return MT.architecture_table(rows, fit_times.unionByName(vote))


@register("scored_test_requests", None)
def scored_test_requests(spark, sf_dir):
    """V1–V4: the test rows as scoring requests — validated, then scored by the
    boosted-tree model (accepted rows) or returned with reasons (rejected rows)."""
    # a fit leaves cores idle between its jobs: the test rows are written beside it
    (model, _), rows = ST.side_by_side(spark, lambda: ST.trained_model(spark, sf_dir, "gradient_boosting"),
                                       lambda: ST.test(spark, sf_dir))
    req = rows.select("user_id", "product_id", *MODEL_FEATURES)
    ok, bad = SC.score_requests(model, req)
    return (ok.select("user_id", "product_id", "prediction", "prediction_label",
                      "probability_future_purchase", "model", "feature_count",
                      F.lit(None).cast("string").alias("violations"))
            .unionByName(bad.select("user_id", "product_id",
                                    F.lit(None).cast("int").alias("prediction"),
                                    F.lit(None).cast("string").alias("prediction_label"),
                                    F.lit(None).cast("double").alias("probability_future_purchase"),
                                    F.lit(None).cast("string").alias("model"),
                                    F.lit(None).cast("int").alias("feature_count"),
                                    F.array_join("violations", ",").alias("violations"))))


# ---------------------------------------------------------------- more plot data, summaries, IO

@register("purchase_count_histogram", _sql(*_LBL, body=f"""
, h_mm AS (SELECT CAST(min(user_product_purchase_count) AS DOUBLE) AS lo,
                  CAST(max(user_product_purchase_count) AS DOUBLE) AS hi FROM labelled),
h_w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 40 ELSE 1.0 END AS w FROM h_mm),
h_b AS (SELECT l.target, CAST(least(floor((CAST(l.user_product_purchase_count AS DOUBLE) - h.lo) / h.w), 39)
                                AS INTEGER) AS bin, h.lo, h.w
        FROM labelled l CROSS JOIN h_w h)
SELECT target, bin, count(*) AS count, round(lo + bin * w, {O.R}) AS lower,
       round(lo + (bin + 1) * w, {O.R}) AS upper
FROM h_b GROUP BY target, bin, lo, w"""))
def purchase_count_histogram(spark, sf_dir):
    """V6: 40-bin histogram of purchase counts by class."""
    return round_doubles(PD.histogram(ST.labelled(spark, sf_dir), "user_product_purchase_count",
                                      40, by="target"))


@register("labelled_summary", _sql(*_LBL, body=f"""
SELECT count(DISTINCT user_id) AS user_id_distinct, count(DISTINCT product_id) AS product_id_distinct,
       round(avg(CAST(target AS DOUBLE)), {O.R}) AS positive_rate FROM labelled"""))
def labelled_summary(spark, sf_dir):
    """A15 + A16: distinct users and products, positive class rate."""
    lab = ST.labelled(spark, sf_dir)
    parts = [QC.distinct_count(lab, "user_id"), QC.distinct_count(lab, "product_id"),
             QC.class_rate(lab)]
    out = parts[0]
    for p in parts[1:]:
        # single-row frames side by side
        out = out.withColumn("_k", F.lit(1)).join(F.broadcast(p.withColumn("_k", F.lit(1))), "_k").drop("_k")
    return round_doubles(out)


@register("warehouse_load_checks", _sql(_B, _F, body="""
SELECT count(*) AS row_count,
       count(DISTINCT CAST(user_id AS VARCHAR) || '-' || CAST(product_id AS VARCHAR))
         AS unique_customer_product_pairs,
       count_if(user_id IS NULL) AS null_user_ids, count_if(product_id IS NULL) AS null_product_ids,
       count_if(user_product_purchase_count < 0) AS negative_purchase_counts,
       count_if(user_product_reorder_count < 0) AS negative_reorder_counts,
       count_if(user_product_reorder_rate < 0 OR user_product_reorder_rate > 1) AS invalid_reorder_rates,
       count_if(user_department_purchase_share < 0 OR user_department_purchase_share > 1)
         AS invalid_department_shares,
       count_if(user_aisle_purchase_share < 0 OR user_aisle_purchase_share > 1) AS invalid_aisle_shares,
       count_if(product_reorder_rate < 0 OR product_reorder_rate > 1) AS invalid_product_reorder_rates
FROM features"""))
def warehouse_load_checks(spark, sf_dir):
    """S6 + S7 + S8 + S9 + S10 + A7: the feature table written as headered gzip
    CSV parts, loaded with FAILFAST into a typed catalog table, then checked."""
    import uuid

    from cartwise.functions.handoff import remove, written
    from cartwise.session import checkpoint_dir
    from cartwise.sources import sinks as SK

    root = f"{checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex[:12]}"
    SK.write_parts(ST.features(spark, sf_dir, "part"), f"{root}/csv")
    table = f"features_{uuid.uuid4().hex[:8]}"
    name = SK.create_feature_table(spark, "basket_features", table, f"{root}/table")
    SK.bulk_load(spark, f"{root}/csv", name)
    if table not in SK.list_tables(spark, "basket_features"):
        raise RuntimeError("table not in catalog")
    # one row; the table and its files are dropped once it is written
    out, _ = written(QC.warehouse_checks(spark.table(name)), "warehouse-checks")
    spark.sql(f"DROP TABLE {name}")
    remove(spark, root)
    return out


@register("staged_load_rejects", _sql(_B, _F, body="""
SELECT CASE WHEN user_id % 97 = 0 THEN 'user_id: n/a is no bigint'
            WHEN product_id % 89 = 0 THEN 'product_id is missing' ELSE 'loaded' END AS reason,
       count(*) AS n, sum(user_product_purchase_count)::BIGINT AS purchases
FROM features GROUP BY 1"""))
def staged_load_rejects(spark, sf_dir):
    """S9 + V4: the feature table written as CSV with faulty ids in some rows, loaded through
    a stage: rows and purchases loaded, and those of the reject table by reason."""
    from cartwise.functions.handoff import remove, written
    from cartwise.sources import load as L
    from cartwise.sources import sinks as SK

    root = f"{checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex[:12]}"
    user, item = F.col("user_id").cast("string"), F.col("product_id").cast("string")
    faulty = ST.features(spark, sf_dir, "part").withColumns({
        "user_id": F.when(F.col("user_id") % 97 == 0, "n/a").otherwise(user),
        "product_id": F.when((F.col("user_id") % 97 != 0) & (F.col("product_id") % 89 == 0), None).otherwise(item)})
    SK.write_parts(faulty, f"{root}/csv")
    name = SK.create_feature_table(spark, "basket_features", f"features_{uuid.uuid4().hex[:8]}", f"{root}/table")
    done = L.staged_load(spark, f"{root}/csv", name, max_rejects=2**62)
    n = F.count(F.lit(1)).alias("n")
    out = spark.table(name).agg(n, F.sum("user_product_purchase_count").alias("purchases")).select(F.lit("loaded").alias("reason"), "n", "purchases")
    if done["rejects"]:
        bad = spark.read.parquet(done["rejects"])
        count = F.split("text", ",")[L.FEATURE_SCHEMA.fieldNames().index("user_product_purchase_count")].cast("long")
        out = out.unionByName(bad.groupBy("reason").agg(n, F.sum(count).alias("purchases")))
    out, path = written(out.filter("n > 0"), "staged-load")
    remove_at_exit(spark, path)
    spark.sql(f"DROP TABLE {name}")
    remove(spark, root)
    return out


@register("experiment_run_summary", None)
def experiment_run_summary(spark, sf_dir):
    """One run per model appended to a run table (params, metrics, tags,
    artifacts), read back and summarised per metric; ``best`` marks the run with
    the highest ROC-AUC. The table is deleted once the summary is written."""
    import uuid

    from cartwise.functions.handoff import remove, written
    from cartwise.plans import runs as RU
    from cartwise.session import checkpoint_dir

    path = f"{checkpoint_dir(spark)}/runs-{uuid.uuid4().hex[:12]}"
    fitted = ST.models_of(spark, sf_dir, ST.TABLE_KINDS)
    rows = {r["model"]: r.asDict() for r in ST.table_metrics(spark, sf_dir, "argmax").collect()}
    for kind, (model, mpath) in fitted.items():
        row = rows[kind]
        RU.log_run(spark, path, "basket_models", kind, RU.model_params(model), row,
                   {"grain": "brand_type", "model_type": "tuned" if kind == ST.TUNED else "baseline"}, [mpath])
    runs = RU.read_runs(spark, path)
    best = RU.best_run(runs).select(F.col("run_id").alias("_best"))
    out, _ = written(RU.run_summary(runs).join(F.broadcast(best), F.col("run_id") == F.col("_best"), "left")
                     .withColumn("best", F.col("_best").isNotNull()).drop("_best", "run_id"), "run-summary")
    remove(spark, path)
    return out


# ---------------------------------------------------------------- model tables on deterministic scores

from cartwise.plans import fixed_scores as FS  # noqa: E402

_QUERIES.update(FS.QUERIES)
_SQL.update(FS.SQL)
