"""Evaluation queries on a deterministic score column."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluate as E
from tessera.plans.q_stats import r6
from tessera.plans.registry import query
from tessera.sources.fixtures import view

THRESHOLDS = [0.5, 0.4, 0.3, 0.2]


def _rides_pred(spark, sf):
    r = view(spark, sf, "rides")
    return r.withColumn("predicted", F.greatest(30 * F.col("temperature") + 400, F.lit(0.0)))


RIDES_PRED_SQL = "p AS (SELECT date, hour, bike_count, greatest(30 * temperature + 400, 0.0) AS predicted FROM rides)"


@query("eval_regression", """
WITH p AS (SELECT bike_count, greatest(30 * temperature + 400, 0.0) AS predicted FROM rides)
SELECT round(avg(abs(bike_count - predicted)), 6) AS mae,
       round(sqrt(avg((bike_count - predicted) * (bike_count - predicted))), 6) AS rmse,
       round(1 - sum((bike_count - predicted) * (bike_count - predicted)) / (var_pop(bike_count) * count(*)), 6) AS r2,
       count(*) AS n
FROM p""")
def eval_regression(spark, sf):
    m = E.regression_metrics(_rides_pred(spark, sf), "bike_count", "predicted")
    return m.select(r6("mae").alias("mae"), r6("rmse").alias("rmse"), r6("r2").alias("r2"), "n")


@query("eval_residuals", f"""WITH {RIDES_PRED_SQL}
SELECT date, hour, bike_count, predicted, bike_count - predicted AS residual FROM p""")
def eval_residuals(spark, sf):
    """Actual beside predicted with the residual."""
    p = _rides_pred(spark, sf)
    return p.select("date", "hour", "bike_count", "predicted", (F.col("bike_count") - F.col("predicted")).alias("residual"))


@query("eval_residuals_head", f"""WITH {RIDES_PRED_SQL}
SELECT date, hour, bike_count, predicted, bike_count - predicted AS residual FROM p ORDER BY date, hour, bike_count, predicted LIMIT 20""")
def eval_residuals_head(spark, sf):
    """The first rows of actual beside predicted."""
    return eval_residuals(spark, sf).orderBy("date", "hour", "bike_count", "predicted").limit(20)


CELLS = """count(*) FILTER (WHERE isFraud = 1 AND score >= {t}) AS tp, count(*) FILTER (WHERE isFraud = 0 AND score >= {t}) AS fp,
       count(*) FILTER (WHERE isFraud = 1 AND score < {t}) AS fn, count(*) FILTER (WHERE isFraud = 0 AND score < {t}) AS tn"""
RATES = """round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy"""


@query("eval_classification", f"""
WITH c AS (SELECT {CELLS.format(t=0.5)} FROM txn)
SELECT {RATES}, tp, fp, fn, tn FROM c""")
def eval_classification(spark, sf):
    m = E.classification_metrics(view(spark, sf, "txn"), "isFraud", "score", 0.5)
    return m.select(*[r6(c).alias(c) for c in ["precision", "recall", "f1", "accuracy"]], "tp", "fp", "fn", "tn")


@query("eval_confusion", """
WITH g AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual, predicted)),
c AS (SELECT isFraud AS actual, CAST(score >= 0.5 AS INT) AS predicted, count(*) AS n FROM txn GROUP BY 1, 2)
SELECT g.actual, g.predicted, coalesce(n, 0) AS count FROM g LEFT JOIN c USING (actual, predicted)""")
def eval_confusion(spark, sf):
    return E.confusion(view(spark, sf, "txn"), "isFraud", "score", 0.5)


@query("eval_class_report", f"""
WITH c AS (SELECT {CELLS.format(t=0.5)} FROM txn),
r AS (SELECT tp / nullif(tp + fp, 0) AS p1, tp / nullif(tp + fn, 0) AS r1, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1,
             tn / nullif(tn + fn, 0) AS p0, tn / nullif(tn + fp, 0) AS r0, 2 * tn / nullif(2 * tn + fn + fp, 0) AS f0,
             tp + fn AS s1, tn + fp AS s0, (tp + tn) / (tp + fp + fn + tn) AS acc FROM c),
z AS (SELECT coalesce(p1, 0) p1, coalesce(r1, 0) r1, coalesce(f1, 0) f1, coalesce(p0, 0) p0, coalesce(r0, 0) r0,
             coalesce(f0, 0) f0, s1, s0, acc FROM r)
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM z
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM z
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), s0 + s1 FROM z
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), s0 + s1 FROM z
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
                 round((f0 * s0 + f1 * s1) / (s0 + s1), 6), s0 + s1 FROM z""")
def eval_class_report(spark, sf):
    r = E.class_report(view(spark, sf, "txn"), "isFraud", "score", 0.5)
    return r.select("class", *[r6(c).alias(c) for c in ["precision", "recall", "f1"]], "support")


CURVE_SQL = """c AS (SELECT score, sum(isFraud) AS pos, sum(1 - isFraud) AS neg FROM txn WHERE score IS NOT NULL GROUP BY score),
cur AS (SELECT score, pos, neg,
               sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM c)"""


@query("eval_roc_curve", f"""
WITH {CURVE_SQL}
SELECT score AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM cur""")
def eval_roc_curve(spark, sf):
    r = E.roc_curve(view(spark, sf, "txn"), "isFraud", "score")
    return r.select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query("eval_roc_auc", f"""
WITH {CURVE_SQL}
SELECT round(sum(pos * ((N - fp) + 0.5 * neg)) / (max(P) * max(N)), 6) AS roc_auc
FROM cur""")
def eval_roc_auc(spark, sf):
    return E.roc_auc(view(spark, sf, "txn"), "isFraud", "score").select(r6("roc_auc").alias("roc_auc"))


@query("eval_average_precision", f"""
WITH {CURVE_SQL}
SELECT round(sum(CASE WHEN pos > 0 THEN pos * tp / (tp + fp) ELSE 0 END) / max(P), 6) AS average_precision FROM cur""")
def eval_average_precision(spark, sf):
    a = E.average_precision(view(spark, sf, "txn"), "isFraud", "score")
    return a.select(r6("average_precision").alias("average_precision"))


SWEEP_SQL = "\nUNION ALL\n".join(
    f"SELECT {i} AS position, CAST({t} AS DOUBLE) AS threshold, tp, fp, fn, tn, {RATES} FROM (SELECT {CELLS.format(t=t)} FROM txn) c{i}"
    for i, t in enumerate(THRESHOLDS))


@query("eval_threshold_sweep", SWEEP_SQL)
def eval_threshold_sweep(spark, sf):
    s = E.threshold_sweep(view(spark, sf, "txn"), "isFraud", "score", THRESHOLDS)
    return s.select("position", "threshold", "tp", "fp", "fn", "tn",
                    *[r6(c).alias(c) for c in ["precision", "recall", "f1", "accuracy"]])


@query("eval_best_threshold", f"""
WITH s AS ({SWEEP_SQL})
SELECT threshold, f1, precision, recall FROM s ORDER BY f1 DESC, position LIMIT 1""")
def eval_best_threshold(spark, sf):
    s = E.threshold_sweep(view(spark, sf, "txn"), "isFraud", "score", THRESHOLDS)
    s = s.select("position", "threshold", *[r6(c).alias(c) for c in ["precision", "recall", "f1"]])
    return E.best_threshold(s)
