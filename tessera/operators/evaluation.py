"""Evaluation metrics as aggregates (EVA1-EVA5, EVA7, SCA27)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMAPE_FLOOR = 1e-8  # fixed denominator floor of the reference's SMAPE


def regression_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", by: str | None = None) -> DataFrame:
    """EVA1 + EVA2: MSE, RMSE, MAE, R^2, SMAPE (%), MAPE (%), cumulative error; one pass, a row for each ``by``."""
    e = F.col(pred) - F.col(label)
    keys = [by] if by else []
    x = df.groupBy(*keys).agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                              F.sum(e * e).alias("__sse"), F.var_pop(label).alias("__var"), F.count(F.lit(1)).alias("n"),
                              (F.avg(F.lit(2.0) * F.abs(e) / F.greatest(F.abs(F.col(label)) + F.abs(F.col(pred)),
                                                                       F.lit(SMAPE_FLOOR))) * 100).alias("smape"),
                              (F.avg(F.try_divide(F.abs(e), F.abs(F.col(label)))) * 100).alias("mape"),
                              F.sum(e).alias("cumulative_error"))
    return x.select(*keys, "n", "mse", F.sqrt("mse").alias("rmse"), "mae",
                    (F.lit(1.0) - F.col("__sse") / (F.col("__var") * F.col("n"))).alias("r2"),
                    "smape", "mape", "cumulative_error")


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """EVA3: (label, prediction, count)."""
    return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("count"))


def per_class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """EVA4: precision, recall, F1, support per class; 0 when undefined
    (a class never predicted has precision 0)."""
    cm = confusion_matrix(df, label, pred)
    tp = cm.where(F.col(label) == F.col(pred)).select(F.col(label).alias("class"), F.col("count").alias("tp"))
    sup = cm.groupBy(F.col(label).alias("class")).agg(F.sum("count").alias("support"))
    npred = cm.groupBy(F.col(pred).alias("class")).agg(F.sum("count").alias("n_pred"))
    x = sup.join(npred, "class", "full_outer").join(tp, "class", "left").fillna(0, ["tp", "support", "n_pred"])
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pred")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    x = x.withColumn("precision", p).withColumn("recall", r)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    return x.withColumn("f1", f1).select("class", "precision", "recall", "f1", "support")


def summary_report(report: DataFrame) -> DataFrame:
    """EVA4: accuracy, macro and support-weighted averages from the per-class table."""
    return report.agg(
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("weighted_precision"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def roc_auc(df: DataFrame, positive: str, score: str, by: str | None = None) -> DataFrame:
    """EVA5: AUC by the trapezoid rule over the ROC points; ``positive`` is a
    0/1 column (one-vs-rest: label == class).

    Rows are reduced to (score, positives, negatives) per distinct score --
    tied scores form one ROC point.  The cumulative counts along descending
    score are running sums over range partitions, so even one huge class, or
    scores crowded in a narrow range, are spread over tasks of equal size.
    The previous ROC point is the running sum minus the point's own counts."""
    from tessera.operators.sequence import running_sums
    keys = [by] if by else []
    pts = df.groupBy(*keys, score).agg(F.sum(positive).alias("__p"), F.sum(F.lit(1) - F.col(positive)).alias("__n"))
    x = running_sums(pts, by, [F.desc(score)], ["__p", "__n"])
    totals = pts.groupBy(*keys).agg(F.sum("__p").alias("__tot_p"), F.sum("__n").alias("__tot_n"))
    x = x.join(totals, keys) if keys else x.select(
        "*", *[F.lit(v).alias(k) for k, v in totals.first().asDict().items()])
    tpr = F.try_divide(F.col("__p_cum").cast("double"), F.col("__tot_p"))
    fpr = F.try_divide(F.col("__n_cum").cast("double"), F.col("__tot_n"))
    ptpr = F.try_divide((F.col("__p_cum") - F.col("__p")).cast("double"), F.col("__tot_p"))
    pfpr = F.try_divide((F.col("__n_cum") - F.col("__n")).cast("double"), F.col("__tot_n"))
    area = (fpr - pfpr) * (tpr + ptpr) / 2
    return x.groupBy(*keys).agg(F.sum(area).alias("auc"), F.count(F.lit(1)).alias("n_points"))


def best_run(results: DataFrame, name: str = "model", metric: str = "score", maximize: bool = True) -> DataFrame:
    """EVA7 / SRT7: the best row of a run table (max_by / min_by)."""
    pick = F.max_by if maximize else F.min_by
    return results.agg(pick(F.col(name), F.col(metric)).alias(f"best_{name}"),
                       (F.max(metric) if maximize else F.min(metric)).alias(f"best_{metric}"))
