"""Spark ML pipelines, model fits, importances and experiments.

Preprocessing follows the reference's semantics with exact statistics where
Spark ML's built-ins differ (population std, exact median); model fits are
Spark ML estimators; every result returned is a small metrics DataFrame.
"""

from __future__ import annotations

import time

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.expr import no_nan
from tessera.operators import evaluate as E
from tessera.operators.boosting import HistogramBoostingClassifier
from tessera.operators.features import FRAUD_CATEGORICAL_FEATURES, FRAUD_NUMERIC_FEATURES, FraudFeatureEngineer
from tessera.operators.forest import HistogramForest
from tessera.operators.stats import column_medians, column_modes
from tessera.session import written


def one_hot_stages(cols: list[str]) -> list:
    """``get_dummies`` / ``OneHotEncoder(handle_unknown='ignore')``: alphabetical
    slots, null and unseen values -> all-zero vector (M1, M2)."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="alphabetAsc")
           for c in cols]
    enc = OneHotEncoder(inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}__ohe" for c in cols],
                        dropLast=True, handleInvalid="error")
    return idx + [enc]


def one_hot_columns(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """Fit the encoder and expand each vector into ``<col>_<value>`` 0/1 columns."""
    model = Pipeline(stages=one_hot_stages(cols)).fit(df)
    out = model.transform(df)
    exprs = [F.col(c) for c in keep]
    for st in model.stages:
        if hasattr(st, "labels") and st.getOutputCol().endswith("__idx"):
            src = st.getInputCol()
            arr = vector_to_array(F.col(f"{src}__ohe"))
            for i, lab in enumerate(st.labels):
                exprs.append(arr[i].cast("int").alias(f"{src}_{lab}"))
    return out.select(*exprs)


def standardize(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """(x - mean) / population std, as sklearn's StandardScaler (M5).

    Spark's ``StandardScaler`` uses the sample std, so the exact form is used.
    """
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(stats))  # one row
    return j.select(*keep, *[F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")).alias(c) for c in cols])


class _PreParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "columns to impute by the median and scale", typeConverter=TypeConverters.toListString)
    textCols = Param(Params._dummy(), "textCols", "columns to impute by the most frequent value", typeConverter=TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "fitted medians", typeConverter=TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "fitted means after imputing", typeConverter=TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "fitted population standard deviations (1 for a constant column)", typeConverter=TypeConverters.toListFloat)
    modes = Param(Params._dummy(), "modes", "fitted most frequent values", typeConverter=TypeConverters.toListString)


class PreprocessorModel(Model, _PreParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted imputer and scaler: the training rows' statistics, applied to any rows."""

    @keyword_only
    def __init__(self, numericCols=None, textCols=None, medians=None, means=None, scales=None, modes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        get = lambda p: self.getOrDefault(p)
        new = {c: (F.coalesce(no_nan(c), F.lit(med)) - F.lit(mean)) / F.lit(scale)
               for c, med, mean, scale in zip(get(self.numericCols), get(self.medians), get(self.means), get(self.scales), strict=True)}
        new |= {c: F.coalesce(F.col(c), F.lit(mode)) for c, mode in zip(get(self.textCols), get(self.modes), strict=True)}
        return df.withColumns(new)


class Preprocessor(Estimator, _PreParams, DefaultParamsReadable, DefaultParamsWritable):
    """Impute numbers by the exact median and text by the mode, then scale numbers by mean and
    population std (M3-M5).  A few scalars per column are all that fitting brings to the driver."""

    @keyword_only
    def __init__(self, numericCols=None, textCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PreprocessorModel:
        num, text = self.getOrDefault(self.numericCols), self.getOrDefault(self.textCols)
        med = column_medians(df, num).first() if num else {}
        medians = [float(med[c] or 0.0) for c in num]
        filled = [F.coalesce(no_nan(c), F.lit(m)) for c, m in zip(num, medians, strict=True)]
        stats = df.agg(F.count(F.lit(1)), *[F.avg(x) for x in filled], *[F.stddev_pop(x) for x in filled]).first()
        modes = column_modes(df, text).first() if text else {}
        k = len(num)
        return PreprocessorModel(numericCols=num, textCols=text, medians=medians, means=[float(x or 0.0) for x in stats[1:k + 1]],
                                 scales=[float(x or 1.0) for x in stats[k + 1:]], modes=[modes[c] or "" for c in text])


def fraud_pipeline(classifier) -> Pipeline:
    """Feature engineer -> impute and scale -> one-hot -> assembler -> classifier (M6, M7)."""
    fitted = Preprocessor(numericCols=FRAUD_NUMERIC_FEATURES, textCols=FRAUD_CATEGORICAL_FEATURES)
    stages = [FraudFeatureEngineer(), fitted] + one_hot_stages(FRAUD_CATEGORICAL_FEATURES)
    assembler = VectorAssembler(inputCols=FRAUD_NUMERIC_FEATURES + [f"{c}__ohe" for c in FRAUD_CATEGORICAL_FEATURES],
                                outputCol="features")
    return Pipeline(stages=stages + [assembler, classifier])


class FraudFit:
    """Fits ``fraud_pipeline``: its engineered features are written once, since each later stage and pass reads them."""

    def __init__(self, classifier):
        self.stages = fraud_pipeline(classifier).getStages()

    def fit(self, df: DataFrame) -> PipelineModel:
        engineer, *rest = self.stages
        model = engineer.fit(df)
        last = rest[-1]
        named = [last.getOrDefault(p) for p in last.params if p.name in ("labelCol", "weightCol") and last.isDefined(p)]
        kept = [*FRAUD_NUMERIC_FEATURES, *FRAUD_CATEGORICAL_FEATURES, *(c for c in named if c)]
        features = written(model.transform(df).select(*kept), "fraud-features")
        return PipelineModel([model, *Pipeline(stages=rest).fit(features).stages])


def positive_probability(df: DataFrame, col: str = "probability") -> DataFrame:
    """Class-1 probability as a plain double column."""
    return df.withColumn("p1", vector_to_array(F.col(col))[1])


def classifier_metrics(scored: DataFrame, label: str, name: str, seconds: float | None = None) -> DataFrame:
    """One row: ROC-AUC, average precision, and threshold-0.5 metrics."""
    cls = E.classification_metrics(scored, label, "p1", 0.5)
    out = E.ranking_metrics(scored, label, "p1").crossJoin(cls).withColumn("model", F.lit(name))  # one row each
    if seconds is not None:
        out = out.withColumn("train_seconds", F.lit(float(seconds)))
    return out


def regressor_metrics(pred: DataFrame, label: str, name: str, clip_at_zero: bool = False) -> DataFrame:
    p = pred.withColumn("_p", F.greatest(F.col("prediction"), F.lit(0.0)) if clip_at_zero else F.col("prediction"))
    return E.regression_metrics(p, label, "_p").withColumn("model", F.lit(name))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as the cluster has cores: a fit reads its rows many times."""
    least = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


def scattered(df: DataFrame) -> DataFrame:
    """``df`` dealt over some tasks for each core: scoring with a forest costs far more than the bytes of a row, by which the
    planner packs rows into tasks."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def fit_timed(estimator, df: DataFrame):
    t0 = time.time()
    model = estimator.fit(df)
    return model, time.time() - t0


def importances(model, features_col: str, df: DataFrame) -> DataFrame:
    """featureImportances with slot names from the assembled column's metadata."""
    meta = df.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in meta.values():
        for a in group:
            names[a["idx"]] = a["name"]
    imp = model.featureImportances.toArray().tolist()
    rows = [(i, names.get(i, f"f{i}"), float(v)) for i, v in enumerate(imp)]
    return df.sparkSession.createDataFrame(rows, "slot int, feature string, importance double")


def importance_by_source(imp: DataFrame, sources: list[str]) -> DataFrame:
    """Sum one-hot slot importances back to their source column.

    Slot names are ``<source>__ohe_<value>``; each slot maps to exactly one
    source (no first-prefix ambiguity).
    """
    src = F.regexp_extract("feature", r"^(.*)__ohe_", 1)
    return (imp.withColumn("source", F.when(src == "", F.col("feature")).otherwise(src))
            .groupBy("source").agg(F.sum("importance").alias("importance")))


def top_features(imp: DataFrame, n: int, exclude: list[str]) -> DataFrame:
    """Top-n features by importance minus an exclusion list."""
    return (imp.where(~F.col("source").isin(*exclude)) if exclude else imp).orderBy(
        F.col("importance").desc(), F.col("source")).limit(n)


NO_LIMIT = 30  # for forests that are to grow without a limit


def rf_classifier(label: str, weight: str | None = None, trees: int = 200, depth: int = 16, seed: int = 42, share: float = 0.3):
    """Random forest: sqrt features per split, 30 % rows per tree."""
    return HistogramForest(labelCol=label, featuresCol="features", weightCol=weight or "", numTrees=trees, maxDepth=depth, subsamplingRate=share, seed=seed)


def rf_regressor(label: str, trees: int = 100, depth: int = 16, seed: int = 42):
    """Random forest regression with all features per split, as sklearn's default."""
    return HistogramForest(labelCol=label, featuresCol="features", classes=False, numTrees=trees, maxDepth=depth, sqrtFeatures=False, seed=seed)


def logistic(label: str, n_rows: int, c: float = 1.0, weight: str | None = None, max_iter: int = 1000):
    """L2 logistic regression; sklearn's C maps to regParam = 1 / (C * n)."""
    lr = LogisticRegression(labelCol=label, featuresCol="features", regParam=1.0 / (c * max(n_rows, 1)),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    return lr.setWeightCol(weight) if weight else lr


def linear(label: str):
    return LinearRegression(labelCol=label, featuresCol="features", regParam=0.0)


def tree_regressor(label: str, depth: int = 10):
    return DecisionTreeRegressor(labelCol=label, featuresCol="features", maxDepth=depth)


def tree_classifier(label: str, depth: int = 5, weight: str | None = None):
    t = DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=depth)
    return t.setWeightCol(weight) if weight else t


def boosting(label: str, iters: int = 300, depth: int = 6, step: float = 0.1, rows: float = 1.0, columns: float = 1.0, weight: str = ""):
    """Second-order histogram boosting."""
    return HistogramBoostingClassifier(labelCol=label, featuresCol="features", weightCol=weight, maxIter=iters, maxDepth=depth, stepSize=step,
                                       rowShare=rows, columnShare=columns)


def save_load(model: PipelineModel, path: str) -> PipelineModel:
    """Persist and re-read a fitted pipeline."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
