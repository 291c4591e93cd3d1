"""Model evaluation on a (label, score) table.

Curve metrics never use an un-partitioned window: rows collapse to distinct
scores with per-score positive / negative counts, and running counts come
from :func:`tessera.operators.ordered.running_totals`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordered import running_totals
from tessera.session import cut_lineage


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE and R^2 = 1 - SSE/SST in one aggregate."""
    err = F.col(actual) - F.col(predicted)
    stats = df.agg(F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
                   F.sum(err * err).alias("_sse"), F.var_pop(actual).alias("_var"), F.count(F.lit(1)).alias("n"))
    return stats.select("mae", "rmse", (1 - F.try_divide(F.col("_sse"), F.col("_var") * F.col("n"))).alias("r2"), "n")


def _cells(df: DataFrame, label: str, pred: Column) -> list:
    y, p = F.col(label), pred
    return [F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
            F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
            F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
            F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn")]


def _rates(tp, fp, fn, tn):
    """Precision, recall, F1, accuracy with zero division -> 0."""
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    acc = F.try_divide(tp + tn, tp + fp + fn + tn)
    return prec, rec, f1, acc


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1 at one threshold."""
    pred = (F.col(score) >= threshold).cast("int")
    c = df.agg(*_cells(df, label, pred))
    prec, rec, f1, acc = _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return c.select(acc.alias("accuracy"), prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
                    "tp", "fp", "fn", "tn")


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """2 x 2 confusion matrix with fixed labels 0, 1; empty cells are 0."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, p) for a in (0, 1) for p in (0, 1)], "actual int, predicted int")
    counts = (df.select(F.col(label).cast("int").alias("actual"), (F.col(score) >= threshold).cast("int").alias("predicted"))
                .groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("count")))
    return F.broadcast(grid).join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("count", F.lit(0)).alias("count"))


def class_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Per-class precision / recall / F1 / support plus accuracy, macro and
    weighted averages (E4)."""
    pred = (F.col(score) >= threshold).cast("int")
    c = df.agg(*_cells(df, label, pred))
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    p1, r1, f1_1, acc = _rates(tp, fp, fn, tn)
    p0, r0, f1_0, _ = _rates(tn, fn, fp, tp)  # class 0 is "positive" with roles swapped
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    rows = F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"), f1_0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"), f1_1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"),
                 n.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f1_0 + f1_1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), ((p0 * s0 + p1 * s1) / n).alias("precision"),
                 ((r0 * s0 + r1 * s1) / n).alias("recall"), ((f1_0 * s0 + f1_1 * s1) / n).alias("f1"),
                 n.alias("support")))
    return c.select(F.inline(rows))


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Distinct scores with positive and negative counts (map-side combined)."""
    return (df.where(F.col(score).isNotNull())
              .groupBy(F.col(score).cast("double").alias("score"))
              .agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"),
                   F.sum((F.col(label) != 1).cast("long")).alias("neg")))


def curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score s: tp, fp at threshold ``score >= s`` and totals.

    The distinct-score table is materialised once, since the running totals read it
    from several branches.
    """
    counts = cut_lineage(score_counts(df, label, score))
    rt = running_totals(counts, "score", ["pos", "neg"])
    return rt.select("score", "pos", "neg",
                     (F.col("pos_total") - F.col("pos_incl") + F.col("pos")).alias("tp"),
                     (F.col("neg_total") - F.col("neg_incl") + F.col("neg")).alias("fp"),
                     (F.col("neg_incl") - F.col("neg")).alias("neg_below"),
                     F.col("pos_total").alias("P"), F.col("neg_total").alias("N"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score (E5)."""
    c = curve(df, label, score)
    return c.select(F.col("score").alias("threshold"), F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("tp"), F.col("P")).alias("tpr"))


def _auc():
    return F.try_divide(F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))), F.first("P").cast("double") * F.first("N")).alias("roc_auc")


def _average_precision():
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    return F.try_divide(F.sum(F.when(F.col("pos") > 0, F.col("pos") * prec).otherwise(0.0)), F.first("P").cast("double")).alias("average_precision")


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact ROC-AUC with tied scores counted as 1/2 (Mann-Whitney)."""
    return curve(df, label, score).agg(_auc())


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """sum_n (R_n - R_(n-1)) P_n over distinct thresholds, descending."""
    return curve(df, label, score).agg(_average_precision())


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC-AUC and average precision from one table of scores."""
    return curve(df, label, score).agg(_auc(), _average_precision())


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: list[float]) -> DataFrame:
    """Metrics at several thresholds in one pass over the data.

    Each row is compared with the few thresholds inside one aggregate; no
    join or copy of the data is made.
    """
    aggs = []
    for i, t in enumerate(thresholds):
        pred = (F.col(score) >= t).cast("int")
        aggs += [c.alias(f"{n}_{i}") for c, n in zip(_cells(df, label, pred), ["tp", "fp", "fn", "tn"])]
    a = df.agg(*aggs)
    rows = []
    for i, t in enumerate(thresholds):
        tp, fp, fn, tn = (F.col(f"{n}_{i}") for n in ["tp", "fp", "fn", "tn"])
        prec, rec, f1, acc = _rates(tp, fp, fn, tn)
        rows.append(F.struct(F.lit(i).alias("position"), F.lit(float(t)).alias("threshold"), tp.alias("tp"),
                             fp.alias("fp"), fn.alias("fn"), tn.alias("tn"), prec.alias("precision"),
                             rec.alias("recall"), f1.alias("f1"), acc.alias("accuracy")))
    return a.select(F.inline(F.array(*rows)))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Threshold with the highest F1; ties go to the earliest in the list."""
    return sweep.agg(F.max_by(F.struct("threshold", "f1", "precision", "recall"),
                              F.struct(F.col("f1"), -F.col("position"))).alias("b")).select("b.*")
