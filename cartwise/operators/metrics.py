"""Classification metrics, exact ROC-AUC, CV summaries and model selection.

Row-level work is one aggregation (confusion counts) or one range-partitioned
count by score (AUC); the result tables are tiny and only those reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.handoff import remove, written

# Names of the metrics in model tables.
METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]


def _safe(num, den):
    """zero_division = 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count)."""
    return df.groupBy(F.col(label).cast("int").alias("label"),
                      F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("count"))


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: tp, fp, tn, fn, n."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
                  F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 0) & (p == 0)).alias("tn"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"),
                  F.count(F.lit(1)).alias("n"))


def _from_counts(c: DataFrame, more: list = ()) -> DataFrame:
    tp, fp, tn, fn, n = (F.col(x) for x in ("tp", "fp", "tn", "fn", "n"))
    precision = _safe(tp, tp + fp)
    recall = _safe(tp, tp + fn)
    f1 = _safe(2 * tp, 2 * tp + fp + fn)
    return c.select(*more, _safe(tp + tn, n).alias("accuracy"), precision.alias("precision"),
                    recall.alias("recall"), f1.alias("f1_score"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            tiebreak: list[str] | None = None) -> DataFrame:
    """Exact ROC-AUC with tied scores at their average rank (Mann–Whitney).

    Rows are first counted by score, map-side, so a score shared by a third of
    the rows (a tree leaf) is one row from then on. The distinct scores are
    range-partitioned; rows below a score are those of the ranges before its own
    (one total per range) and of the smaller scores inside it. Rows without a
    label or a score take no part. Result: one row ``roc_auc`` (null when a class
    is absent). ``tiebreak`` is no longer needed and ignored.
    """
    spark = df.sparkSession
    y, s = F.col(label).cast("int"), F.col(score).cast("double")
    g = (df.select(s.alias("_s"), y.alias("_y")).filter("_s is not null and _y is not null")
         .groupBy("_s").agg(F.count(F.lit(1)).alias("_c"), F.sum("_y").alias("_p")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written, so that both readers below see the same ranges
    ranged, path = written(g.repartitionByRange(n, "_s").withColumn("_r", F.spark_partition_id()), "auc")
    totals = ranged.groupBy("_r").agg(F.sum("_c").alias("_t"))          # at most n rows
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_r"), F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy("_r").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_o") + F.coalesce(F.sum("_c").over(inside), F.lit(0))
    ranks = ranged.join(F.broadcast(offsets), "_r").select("_c", "_p", below.alias("_b"))
    tot = ranks.agg(F.sum(F.col("_p") * (F.col("_b") + (F.col("_c") + 1) / 2.0)).alias("_w"),
                    F.sum("_p").alias("_P"), F.sum("_c").alias("_n"))
    P, N = F.col("_P"), F.col("_n") - F.col("_P")
    auc = tot.select(F.when((P == 0) | (N == 0), F.lit(None).cast("double"))
                     .otherwise((F.col("_w") - P * (P + 1) / 2.0) / (P.cast("double") * N))
                     .alias("roc_auc")).first()["roc_auc"]
    remove(spark, path)
    return spark.createDataFrame([(auc,)], "roc_auc double")


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   score: str = "score", tiebreak: list[str] | None = None) -> DataFrame:
    """E1 + E2: one row with accuracy, precision, recall, f1_score, roc_auc."""
    m = _from_counts(confusion_counts(df, label, prediction))
    auc = roc_auc(df, label, score, tiebreak)
    # both sides are single rows
    return (m.withColumn("_k", F.lit(1))
            .join(F.broadcast(auc.withColumn("_k", F.lit(1))), "_k").drop("_k"))


def metrics_by(df: DataFrame, by: list[str], label: str = "label", prediction: str = "prediction",
               score: str = "score") -> DataFrame:
    """E1 + E2 for many models (folds, rules) in one pass over their scored rows: ``by``,
    accuracy, precision, recall, f1_score, roc_auc per group.

    Rows are counted by (group, score) map-side, with their confusion counts; the counts
    are range-partitioned by both and ranked inside their range, so neither a group nor
    a score has to fit in one task. Groups are a table's models: few, known, not null.
    """
    return _by(df, by, {None: prediction}, label, score).drop("_rule")


def rules_by(df: DataFrame, by: list[str], rules: dict[str | None, str], label: str = "label",
             score: str = "score") -> DataFrame:
    """:func:`metrics_by` for several rules {name: prediction column} over the same scores, one row
    per group and rule: a score is counted and ranked once for all of them. A rule whose
    predictions are all null in a group has no row there."""
    return _by(df, by, rules, label, score).withColumnRenamed("_rule", "rule")


def _by(df: DataFrame, by: list[str], rules: dict[str | None, str], label: str, score: str) -> DataFrame:
    spark = df.sparkSession
    y, s = F.col(label).cast("int"), F.col(score).cast("double")
    at = list(range(len(rules)))
    p = {i: F.col(f"_pred{i}") for i in at}
    counts = [c for i in at for c in (
        F.count_if((F.col("_y") == 1) & (p[i] == 1)).alias(f"tp{i}"), F.count_if((F.col("_y") == 0) & (p[i] == 1)).alias(f"fp{i}"),
        F.count_if((F.col("_y") == 0) & (p[i] == 0)).alias(f"tn{i}"), F.count_if((F.col("_y") == 1) & (p[i] == 0)).alias(f"fn{i}"),
        F.count(p[i]).alias(f"_m{i}"))]
    g = (df.select(*by, y.alias("_y"), *[F.col(c).cast("int").alias(f"_pred{i}") for i, c in enumerate(rules.values())], s.alias("_s"))
         .groupBy(*by, "_s").agg(*counts, F.count(F.lit(1)).alias("n"), F.count("_y").alias("_c"), F.coalesce(F.sum("_y"), F.lit(0)).alias("_p")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written, so that both readers below see the same ranges
    ranged, path = written(g.repartitionByRange(n, *by, "_s").withColumn("_r", F.spark_partition_id()), "metrics")
    known = F.when(F.col("_s").isNotNull(), F.col("_c")).otherwise(F.lit(0))
    totals = ranged.groupBy(*by, "_r").agg(F.sum(known).alias("_t"))  # at most n rows and one more per group
    before = Window.partitionBy(*by).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_r", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy("_r", *by).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (ranged.withColumn("_c", known).withColumn("_p", F.when(F.col("_s").isNotNull(), F.col("_p")).otherwise(F.lit(0)))
              .withColumn("_i", F.coalesce(F.sum("_c").over(inside), F.lit(0))).join(F.broadcast(offsets), [*by, "_r"]))
    tot = ranked.groupBy(*by).agg(
        F.sum(F.col("_p") * (F.col("_o") + F.col("_i") + (F.col("_c") + 1) / 2.0)).alias("_w"), F.sum("_p").alias("_P"),
        F.sum("_c").alias("_n"), F.sum("n").alias("n"), *[F.sum(f"{c}{i}").alias(f"{c}{i}") for i in at for c in ("tp", "fp", "tn", "fn", "_m")])
    P, N = F.col("_P"), F.col("_n") - F.col("_P")
    auc = F.when((P == 0) | (N == 0), F.lit(None).cast("double")).otherwise((F.col("_w") - P * (P + 1) / 2.0) / (P.cast("double") * N))
    each = F.explode(F.array(*[F.struct(F.lit(name).cast("string").alias("_rule"), *[F.col(f"{c}{i}").alias(c) for c in ("tp", "fp", "tn", "fn", "_m")])
                               for i, name in enumerate(rules)]))
    tot = tot.select(*by, auc.alias("roc_auc"), "n", each.alias("_each")).select(*by, "roc_auc", "n", "_each.*")
    if len(rules) > 1:
        tot = tot.filter("_m > 0")
    out = _from_counts(tot, [*by, "_rule", "roc_auc"]).select(*by, "_rule", *METRICS)
    rows = out.collect()  # one per group and rule
    remove(spark, path)
    return spark.createDataFrame(rows, out.schema)


def classification_report(df: DataFrame, label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Per class precision / recall / f1 / support, then macro and weighted
    averages and accuracy: (row, precision, recall, f1_score, support)."""
    c = confusion_counts(df, label, prediction)
    tp, fp, tn, fn, n = (F.col(x) for x in ("tp", "fp", "tn", "fn", "n"))

    def cls(name, tp_, fp_, fn_):
        p, r = _safe(tp_, tp_ + fp_), _safe(tp_, tp_ + fn_)
        return F.struct(F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"),
                        _safe(2 * tp_, 2 * tp_ + fp_ + fn_).alias("f1_score"),
                        (tp_ + fn_).cast("double").alias("support"))

    per = c.select(F.array(cls("0", tn, fn, fp), cls("1", tp, fp, fn)).alias("a"), "n", "tp", "tn")
    rows = per.select(F.explode("a").alias("r"), "n", "tp", "tn").select("r.*", "n", "tp", "tn")
    macro = rows.groupBy().agg(F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
                               F.avg("recall").alias("recall"), F.avg("f1_score").alias("f1_score"),
                               F.sum("support").alias("support"))
    w = F.col("support") / F.col("n")
    weighted = rows.groupBy().agg(
        F.lit("weighted avg").alias("row"), F.sum(F.col("precision") * w).alias("precision"),
        F.sum(F.col("recall") * w).alias("recall"), F.sum(F.col("f1_score") * w).alias("f1_score"),
        F.sum("support").alias("support"))
    acc = c.select(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                   F.lit(None).cast("double").alias("recall"), _safe(tp + tn, n).alias("f1_score"),
                   n.cast("double").alias("support"))
    return (rows.select("row", "precision", "recall", "f1_score", "support")
            .unionByName(macro).unionByName(weighted).unionByName(acc))


# ----------------------------------------------------------------------------- model tables

# Names of the fold metrics.
CV_METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "training_time_seconds"]


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and sample std (ddof=1) of the six fold metrics per model, sorted
    by roc_auc_mean, f1_score_mean, recall_mean (descending)."""
    aggs = []
    for m in CV_METRICS:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_std")]
    return (folds.groupBy("model").agg(*aggs)
            .orderBy(F.desc("roc_auc_mean"), F.desc("f1_score_mean"), F.desc("recall_mean")))


def model_comparison(summary: DataFrame, test_results: DataFrame) -> DataFrame:
    """E8 + W2: CV summary ⋈ test metrics (renamed *_test), generalisation gaps,
    absolute gaps, stability = 1/(std + 1e-8), validation rank 1..n."""
    t = test_results
    for m in METRICS:
        if m in t.columns:
            t = t.withColumnRenamed(m, f"{m}_test")
    cmp = summary.join(t, "model", "left")
    cmp = (cmp.withColumn("roc_auc_generalization_gap", F.col("roc_auc_mean") - F.col("roc_auc_test"))
           .withColumn("f1_generalization_gap", F.col("f1_score_mean") - F.col("f1_score_test"))
           .withColumn("abs_roc_auc_generalization_gap", F.abs("roc_auc_generalization_gap"))
           .withColumn("abs_f1_generalization_gap", F.abs("f1_generalization_gap"))
           .withColumn("roc_auc_stability", 1.0 / (F.col("roc_auc_std") + F.lit(1e-8))))
    # one row per model: a global window over a handful of rows
    w = Window.orderBy(F.desc("roc_auc_mean"), F.desc("f1_score_mean"), F.desc("recall_mean"),
                       F.asc("model"))
    return cmp.withColumn("validation_rank", F.row_number().over(w))


def selection_order() -> list:
    """CV AUC ↓, F1 ↓, recall ↓, AUC std ↑ (model name breaks exact ties)."""
    return [F.desc("roc_auc_mean"), F.desc("f1_score_mean"), F.desc("recall_mean"),
            F.asc("roc_auc_std"), F.asc("model")]


def select_final_model(comparison: DataFrame) -> DataFrame:
    """E9 + O1 + O2: the top row under :func:`selection_order`."""
    return comparison.orderBy(*selection_order()).limit(1)


def architecture_table(results: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """E10 + J14: all models (+ ensemble) with earlier training times, ranked by AUC."""
    out = results
    if previous is not None:
        out = out.join(previous.select("model", "training_time_seconds"), "model", "left")
    w = Window.orderBy(F.desc("roc_auc"), F.asc("model"))
    return out.withColumn("auc_rank", F.row_number().over(w)).orderBy("auc_rank")
