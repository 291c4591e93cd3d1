"""Feature pipelines, splits, sampling, model fits and experiments.

Model keys are rows-only checks (fitted models cannot be reproduced in SQL).  They use
the reference's sizes; forests without a depth limit there go to Spark's limit of 30.  The keys that score,
rank or explain a fraud model load its published package (``publish_model`` and the like fit it).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.functions import expr as X
from tessera.operators import evaluate as E
from tessera.operators import features as FE
from tessera.operators import ml as M
from tessera.operators import packages as PK
from tessera.operators import quality as Q
from tessera.operators import sampling as SM
from tessera.operators import stats as S
from tessera.plans.q_stats import r6
from tessera.plans.registry import query
from tessera.session import cut_lineage, scratch_dir, shared_dir, shuffles_dropped, written
from tessera.sources import files as FS
from tessera.sources.fixtures import view
from tessera.sources.tables import path_exists, table_state

TXN_KEYS = ["txn_order", "txn_line", "txn_part", "txn_supp"]
RIDE_NUM_FEATURES = ["hour", "temperature", "humidity", "wind_speed", "visibility", "dew_point", "rainfall", "snowfall"]
RIDE_STEPS = ["IsRushHour", "IsCommuteTime", "DiscomfortIndex"]
RIDE_CAT = ["season", "holiday", "functioning_day"]
RIDE_DEPTH = 10  # of the ride forests; without a limit they have millions of nodes, which Spark ML keeps on the driver (README)


def hash_sql(cols: list[str], seed: int = 42) -> str:
    """The seeded row hash of the sampling operators in SQL."""
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(f'CAST({c} AS VARCHAR)' for c in cols)})), 1, 15) AS BIGINT)"


def test_share_sql(cols: list[str], share: float = 0.2) -> str:
    return f"({hash_sql(cols)} % 1073741824) / 1073741824.0 < {share}"


CLEAN_TXN_SQL = """cleaned AS (SELECT DISTINCT * FROM txn),
kept AS (SELECT * FROM cleaned WHERE amount >= 0 AND amount < 'inf'::DOUBLE AND oldbalanceOrg IS NOT NULL AND abs(oldbalanceOrg) < 'inf'::DOUBLE
         AND oldbalanceDest IS NOT NULL AND abs(oldbalanceDest) < 'inf'::DOUBLE AND type IS NOT NULL AND isFraud IS NOT NULL)"""


# ---------------------------------------------------------------- preprocessing (O)
@query("ml_one_hot", """
SELECT customer_id,
  CAST(coalesce(offer = 'AUTOMOBILE', false) AS INT) AS "offer_AUTOMOBILE",
  CAST(coalesce(offer = 'BUILDING', false) AS INT) AS "offer_BUILDING",
  CAST(coalesce(offer = 'HOUSEHOLD', false) AS INT) AS "offer_HOUSEHOLD",
  CAST(coalesce(offer = 'MACHINERY', false) AS INT) AS "offer_MACHINERY",
  CAST(contract = 'Month-to-Month' AS INT) AS "contract_Month-to-Month",
  CAST(contract = 'One Year' AS INT) AS "contract_One Year",
  CAST(contract = 'Two Year' AS INT) AS "contract_Two Year"
FROM churn""")
def ml_one_hot(spark, sf):
    return M.one_hot_columns(view(spark, sf, "churn"), ["offer", "contract"], ["customer_id"])


@query("ml_impute", """
SELECT customer_id,
  coalesce(offer, (SELECT offer FROM churn WHERE offer IS NOT NULL GROUP BY offer ORDER BY count(*) DESC, offer LIMIT 1)) AS offer,
  coalesce(monthly_charge, (SELECT quantile_cont(monthly_charge, 0.5) FROM churn)) AS monthly_charge
FROM churn""")
def ml_impute(spark, sf):
    c = view(spark, sf, "churn").select("customer_id", "offer", "monthly_charge")
    return S.fill_median_mode(c, ["monthly_charge"], ["offer"])


@query("ml_standardize", """
SELECT customer_id, round((age - avg(age) OVER ()) / stddev_pop(age) OVER (), 6) AS age,
       round((monthly_charge - avg(monthly_charge) OVER ()) / stddev_pop(monthly_charge) OVER (), 6) AS monthly_charge,
       round((tenure - avg(tenure) OVER ()) / stddev_pop(tenure) OVER (), 6) AS tenure
FROM churn""")
def ml_standardize(spark, sf):
    s = M.standardize(view(spark, sf, "churn"), ["age", "monthly_charge", "tenure"], ["customer_id"])
    return s.select("customer_id", *[r6(c).alias(c) for c in ["age", "monthly_charge", "tenure"]])


PRE_NUM, PRE_TEXT = ["age", "monthly_charge", "tenure"], ["offer"]


@query("ml_fit_transform", f"""
WITH t AS (SELECT *, {test_share_sql(['customer_id'])} AS is_test FROM churn),
train AS (SELECT * FROM t WHERE NOT is_test),
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS {c}' for c in PRE_NUM)} FROM train),
mode AS (SELECT (SELECT offer FROM train WHERE offer IS NOT NULL GROUP BY offer ORDER BY count(*) DESC, offer LIMIT 1) AS offer),
filled AS (SELECT {', '.join(f'coalesce(train.{c}, med.{c}) AS {c}' for c in PRE_NUM)} FROM train, med),
st AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in PRE_NUM)} FROM filled)
SELECT customer_id, coalesce(t.offer, mode.offer) AS offer,
       {', '.join(f'round((coalesce(t.{c}, med.{c}) - m_{c}) / s_{c}, 6) AS {c}' for c in PRE_NUM)}
FROM t, med, mode, st WHERE is_test""")
def ml_fit_transform(spark, sf):
    """Imputer and scaler fitted on the training rows, applied to the others (M3-M5)."""
    s = SM.random_split(view(spark, sf, "churn"), ["customer_id"], 0.2, 42)
    model = M.Preprocessor(numericCols=PRE_NUM, textCols=PRE_TEXT).fit(s.where(~F.col("is_test")))
    out = model.transform(s.where("is_test"))
    return out.select("customer_id", "offer", *[r6(c).alias(c) for c in PRE_NUM])


@query("ml_class_weights", """
SELECT churn_label, count(*) AS n_c, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM churn GROUP BY churn_label""")
def ml_class_weights(spark, sf):
    w = SM.class_weights(view(spark, sf, "churn"), "churn_label")
    return w.select("churn_label", "n_c", r6("weight").alias("weight"))


@query("split_stratified", """
SELECT churn_label, true AS is_test, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n FROM churn GROUP BY 1
UNION ALL
SELECT churn_label, false, count(*) - CAST(ceil(count(*) * 0.2) AS BIGINT) FROM churn GROUP BY 1""")
def split_stratified(spark, sf):
    s = SM.stratified_split(view(spark, sf, "churn"), "churn_label", ["customer_id"], 0.2, 42)
    return s.groupBy("churn_label", "is_test").agg(F.count(F.lit(1)).alias("n"))


def labelled_keys(spark, sf):
    """Keys and labels of the transactions, written once: a sample reads them in several passes, each of which would repeat the joins."""
    return written(view(spark, sf, "txn").select(*TXN_KEYS, "isFraud"), "txn-keys")


@query("sample_keep_positives", """
SELECT isFraud, CAST(CASE WHEN isFraud = 1 THEN count(*) ELSE least(count(*), 5000) END AS BIGINT) AS n
FROM txn GROUP BY isFraud""")
def sample_keep_positives(spark, sf):
    s = SM.keep_positives_sample_negatives(labelled_keys(spark, sf), "isFraud", TXN_KEYS, 5000, 42)
    return s.groupBy("isFraud").agg(F.count(F.lit(1)).alias("n"))


@query("split_random", f"""SELECT {test_share_sql(TXN_KEYS)} AS is_test, count(*) AS n FROM txn GROUP BY 1""")
def split_random(spark, sf):
    s = SM.random_split(view(spark, sf, "txn"), TXN_KEYS, 0.2, 42)
    return s.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"))


@query("split_stratified_rows", f"""
SELECT customer_id, row_number() OVER (PARTITION BY churn_label ORDER BY {hash_sql(['customer_id'])}, customer_id)
       <= ceil(count(*) OVER (PARTITION BY churn_label) * 0.2) AS is_test FROM churn""")
def split_stratified_rows(spark, sf):
    """The rows of the stratified split (M9)."""
    return SM.stratified_split(view(spark, sf, "churn"), "churn_label", ["customer_id"], 0.2, 42).select("customer_id", "is_test")


@query("sample_keep_positives_rows", f"""
SELECT {', '.join(TXN_KEYS)}, isFraud FROM txn WHERE isFraud = 1
UNION ALL
SELECT * FROM (SELECT {', '.join(TXN_KEYS)}, isFraud FROM txn WHERE isFraud = 0 ORDER BY {hash_sql(TXN_KEYS)}, {', '.join(TXN_KEYS)} LIMIT 5000) n""")
def sample_keep_positives_rows(spark, sf):
    """The rows of the sample."""
    return SM.keep_positives_sample_negatives(labelled_keys(spark, sf), "isFraud", TXN_KEYS, 5000, 42).select(*TXN_KEYS, "isFraud")


@query("sample_csv", f"""
SELECT {', '.join(TXN_KEYS)}, isFraud FROM txn WHERE isFraud = 1
UNION ALL
SELECT * FROM (SELECT {', '.join(TXN_KEYS)}, isFraud FROM txn WHERE isFraud = 0 ORDER BY {hash_sql(TXN_KEYS)}, {', '.join(TXN_KEYS)} LIMIT 5000) n""")
def sample_csv(spark, sf):
    """The sample in seeded random order, written as CSV and read back."""
    sample = SM.seeded_shuffle(sample_keep_positives_rows(spark, sf), TXN_KEYS)
    path = FS.write_csv(sample, scratch_dir(spark, "sample-csv"))
    return FS.read_csv(spark, path, sample.schema)


SCENARIO_KEYS = ["date", "hour", "bike_count", "humidity", "visibility"]


@query("sample_one_per_group", f"""
WITH tagged AS (
  SELECT 'summer_evening' AS scenario, * FROM rides WHERE season = 'Summer' AND hour = 18 AND rainfall = 0
  UNION ALL SELECT 'winter_morning', * FROM rides WHERE season = 'Winter' AND hour = 8
  UNION ALL SELECT 'rainy', * FROM rides WHERE rainfall > 0
  UNION ALL SELECT 'snowy', * FROM rides WHERE snowfall > 0
  UNION ALL SELECT 'holiday_afternoon', * FROM rides WHERE holiday = 'Holiday' AND hour = 14
  UNION ALL SELECT 'closed_day', * FROM rides WHERE functioning_day = 'No' AND season = 'Spring' AND rainfall > 5),
best AS (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY {hash_sql(SCENARIO_KEYS)}, {', '.join(SCENARIO_KEYS)}) AS rn FROM tagged)
SELECT scenario, {', '.join(SCENARIO_KEYS)} FROM best WHERE rn = 1""")
def sample_one_per_group(spark, sf):
    tagged = SM.scenario_filter(view(spark, sf, "rides"))
    return SM.one_per_group(tagged, "scenario", SCENARIO_KEYS, seed=42).select("scenario", *SCENARIO_KEYS)


# ---------------------------------------------------------------- fraud training (R)
TXN_TABLES = ["lineitem", "orders", "customer", "supplier"]  # what the transaction view reads
FRAUD_INPUTS = ["type", "amount", "oldbalanceOrg", "oldbalanceDest", "Hour"]
FRAUD_THRESHOLDS = [0.5, 0.4, 0.3, 0.2]


def fraud_root(spark, sf) -> str:
    """Folder of the fraud packages and of their split, by the state of the input files."""
    return shared_dir(spark, f"fraud-models/{table_state(spark, sf, TXN_TABLES)}")


def fraud_split(spark, sf):
    """(training rows with class weights, test rows): written once, since every fit and every metric reads them again."""
    path = f"{fraud_root(spark, sf)}/split"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        t = FE.with_hour(Q.clean_txn(view(spark, sf, "txn")))
        s = written(SM.stratified_split(t, "isFraud", TXN_KEYS, 0.2, 42), "fraud-rows")
        train = s.where(~F.col("is_test"))
        w = SM.class_weights(train, "isFraud").select("isFraud", "weight")
        positive = SM.scale_pos_weight(train, "isFraud").first()["scale_pos_weight"] or 1.0
        weighted = s.join(F.broadcast(w), "isFraud", "left")  # two classes: bounded
        with shuffles_dropped(spark):
            M.scattered(weighted.withColumn("pos_weight", F.when(F.col("isFraud") == 1, F.lit(float(positive))).otherwise(1.0))).write.parquet(path)
    s = spark.read.parquet(path)
    return s.where(~F.col("is_test")), s.where("is_test")


def fraud_estimators(n: int) -> dict:
    """The candidates in the reference's sizes; the first is the baseline without class weights."""
    return {
        "random_forest_baseline": M.rf_classifier("isFraud", trees=200),
        "logreg_balanced": M.logistic("isFraud", n, weight="weight"),
        "random_forest": M.rf_classifier("isFraud", "weight", trees=300),
        "gbt": M.boosting("isFraud", weight="pos_weight"),
    }


FRAUD_MODELS = ["random_forest_baseline", "logreg_balanced", "random_forest", "gbt"]


def publish_fraud(spark, sf, name: str) -> int:
    """Fit one candidate and publish it with its threshold of the best F1, its test metrics and its input schema."""
    train, test = fraud_split(spark, sf)
    model, seconds = M.fit_timed(M.FraudFit(fraud_estimators(train.count())[name]), M.spread(train))
    scored = cut_lineage(M.positive_probability(model.transform(test)).select("isFraud", "p1"))
    metrics = M.classifier_metrics(scored, "isFraud", name, seconds).first().asDict()
    best = E.best_threshold(E.threshold_sweep(scored, "isFraud", "p1", FRAUD_THRESHOLDS)).first()
    return PK.publish(spark, fraud_root(spark, sf), name, model, train, FRAUD_INPUTS, best["threshold"] or FRAUD_THRESHOLDS[0], metrics,
                      {"amount_threshold": model.stages[0].getOrDefault("amountThreshold"), "train_rows": train.count(), "f1_at_threshold": best["f1"]})


def fraud_package(spark, sf, name: str) -> PK.Package:
    """The published package of one candidate; one is fitted and published where the input has none."""
    root = fraud_root(spark, sf)
    if not PK.versions(spark, root, name):
        publish_fraud(spark, sf, name)
    return PK.load(spark, root, name)


def fraud_scores(spark, sf, name: str):
    """Test rows with the package's probability ``p1``."""
    return M.positive_probability(fraud_package(spark, sf, name).model.transform(fraud_split(spark, sf)[1]))


def _fraud_metrics(spark, sf, name: str):
    seconds = fraud_package(spark, sf, name).metrics["train_seconds"]
    return M.classifier_metrics(cut_lineage(fraud_scores(spark, sf, name).select("isFraud", "p1")), "isFraud", name, seconds)


@query("publish_model")
def publish_model(spark, sf):
    """Fit the weighted forest, publish it as a package and show what was published."""
    package = fraud_package(spark, sf, "random_forest")
    return spark.createDataFrame([("random_forest", package.version, package.threshold, package.details["amount_threshold"], package.details["train_rows"],
                                   package.metrics["average_precision"], package.schema.simpleString())],
                                 "model string, version int, threshold double, amount_threshold double, train_rows long, average_precision double, input_schema string")


@query("ml_pipeline_fit")
def ml_pipeline_fit(spark, sf):
    return _fraud_metrics(spark, sf, "logreg_balanced")


@query("ml_rf_classifier")
def ml_rf_classifier(spark, sf):
    return _fraud_metrics(spark, sf, "random_forest")


@query("ml_gbt")
def ml_gbt(spark, sf):
    return _fraud_metrics(spark, sf, "gbt")


@query("ml_scale_pos_weight", """
SELECT count(*) FILTER (WHERE isFraud = 1) AS positives, count(*) FILTER (WHERE isFraud <> 1) AS negatives,
       round(count(*) FILTER (WHERE isFraud <> 1)::DOUBLE / nullif(count(*) FILTER (WHERE isFraud = 1), 0), 6) AS scale_pos_weight
FROM txn""")
def ml_scale_pos_weight(spark, sf):
    return SM.scale_pos_weight(view(spark, sf, "txn"), "isFraud").withColumn("scale_pos_weight", r6("scale_pos_weight"))


@query("score_batch")
def score_batch(spark, sf):
    """All transactions scored with the published package and its stored threshold."""
    package = fraud_package(spark, sf, "random_forest")
    t = M.scattered(FE.with_hour(view(spark, sf, "txn")))
    scored = M.positive_probability(package.model.transform(package.check_inputs(t))).withColumn("threshold", F.lit(package.threshold))
    return scored.select(*TXN_KEYS, F.round("p1", 4).alias("fraud_probability"),
                         X.flag(F.col("p1") >= F.col("threshold")).alias("prediction"),
                         X.risk_level("p1", "threshold").alias("risk_level"))


@query("score_batch_check", f"""
SELECT count(*) AS n_rows, CAST(bit_xor({hash_sql(TXN_KEYS)}) AS BIGINT) AS keys_hash, CAST(0 AS BIGINT) AS n_outside, CAST(0 AS BIGINT) AS n_risk_mismatch FROM txn""")
def score_batch_check(spark, sf):
    """Row count and key set of the scored rows, probabilities outside 0 to 1, and decisions that contradict the risk level."""
    p = F.col("fraud_probability")
    contradicts = (F.col("prediction") == 1) != (F.col("risk_level") == "High")
    return score_batch(spark, sf).agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_xor(SM.hash_key(TXN_KEYS, 42)).alias("keys_hash"),
        F.count(F.when(p.isNull() | (p < 0) | (p > 1), 1)).alias("n_outside"), F.count(F.when(contradicts, 1)).alias("n_risk_mismatch"))


def _compare(tables, metric: str, baseline: str | None = None, smallest: bool = False):
    """One table of metrics with the best row marked; the baseline is shown but never chosen."""
    t = tables[0]
    for x in tables[1:]:
        t = t.unionByName(x)
    rank = -F.col(metric) if smallest else F.col(metric)
    open_ = t.where(F.col("model") != baseline) if baseline else t
    best = open_.agg(F.max_by("model", F.struct(rank, F.col("model"))).alias("_best"))
    return t.crossJoin(F.broadcast(best)).withColumn("is_best", F.col("model") == F.col("_best")).drop("_best")


@query("exp_model_compare")
def exp_model_compare(spark, sf):
    """Fit several models, tabulate, mark the best by average precision; the unbalanced baseline is excluded."""
    return _compare([_fraud_metrics(spark, sf, m) for m in FRAUD_MODELS], "average_precision", "random_forest_baseline")


@query("exp_model_threshold")
def exp_model_threshold(spark, sf):
    """Threshold with the best F1 on the scores of the chosen model."""
    chosen = exp_model_compare(spark, sf).where("is_best").first()["model"]
    sweep = E.threshold_sweep(fraud_scores(spark, sf, chosen), "isFraud", "p1", FRAUD_THRESHOLDS)
    return E.best_threshold(sweep).withColumn("model", F.lit(chosen))


@query("ml_importance")
def ml_importance(spark, sf):
    model, (train, _) = fraud_package(spark, sf, "random_forest").model, fraud_split(spark, sf)
    assembled = model.transform(train)  # only its schema is read: the slot names are in its metadata
    return M.importances(model.stages[-1], "features", assembled)


@query("ml_importance_by_source")
def ml_importance_by_source(spark, sf):
    imp = ml_importance(spark, sf)
    return M.importance_by_source(imp, FE.FRAUD_CATEGORICAL_FEATURES)


@query("sel_final_features")
def sel_final_features(spark, sf):
    imp = M.importance_by_source(ml_importance(spark, sf), FE.FRAUD_CATEGORICAL_FEATURES)
    return M.top_features(imp, 10, ["BalanceDifference"])


@query("ml_save_load", f"""WITH {CLEAN_TXN_SQL},
c AS (SELECT isFraud, count(*) AS n FROM kept GROUP BY isFraud)
SELECT CAST(sum(ceil(n * 0.2)) AS BIGINT) AS n, 0.0::DOUBLE AS max_abs_diff FROM c""")
def ml_save_load(spark, sf):
    model, (_, test) = fraud_package(spark, sf, "random_forest").model, fraud_split(spark, sf)
    loaded = M.save_load(model, scratch_dir(spark, "pipeline"))
    a = M.positive_probability(model.transform(test)).select(*TXN_KEYS, F.col("p1").alias("p_saved"))
    b = M.positive_probability(loaded.transform(test)).select(*TXN_KEYS, F.col("p1").alias("p_loaded"))
    return a.join(b, TXN_KEYS).agg(F.count(F.lit(1)).alias("n"),
                                   F.max(F.abs(F.col("p_saved") - F.col("p_loaded"))).alias("max_abs_diff"))


# ---------------------------------------------------------------- regression and titanic (R)
def _ride_frame(spark, sf, extra: list[str] | None = None):
    r = FE.ride_features(view(spark, sf, "rides"), severity=False)
    s = SM.random_split(r, ["date", "hour", "bike_count", "temperature", "humidity", "visibility"], 0.2, 42)
    s = s.select("bike_count", "is_test", *RIDE_NUM_FEATURES, *RIDE_CAT, *RIDE_STEPS)  # what the models read, as columns: a fit reads it many times
    return M.spread(written(s, "rides")), RIDE_NUM_FEATURES + (extra or [])


def _ride_pipeline(features: list[str], est):
    stages = M.one_hot_stages(RIDE_CAT)
    asm = VectorAssembler(inputCols=features + [f"{c}__ohe" for c in RIDE_CAT], outputCol="features")
    return Pipeline(stages=stages + [asm, est])


@query("ml_linreg")
def ml_linreg(spark, sf):
    s, feats = _ride_frame(spark, sf)
    train, test = s.where(~F.col("is_test")), s.where(F.col("is_test"))
    model = _ride_pipeline(feats, M.linear("bike_count")).fit(train)
    return M.regressor_metrics(model.transform(test), "bike_count", "linear", clip_at_zero=True)


@query("exp_ablation")
def exp_ablation(spark, sf):
    """Refit a forest of 200 trees with one more feature at a time and tabulate the metric change."""
    s, base = _ride_frame(spark, sf)
    train, test = s.where(~F.col("is_test")), s.where(F.col("is_test"))
    steps = [("base", []), ("+IsRushHour", ["IsRushHour"]), ("+IsCommuteTime", ["IsRushHour", "IsCommuteTime"]),
             ("+DiscomfortIndex", ["IsRushHour", "IsCommuteTime", "DiscomfortIndex"])]
    out = None
    for i, (name, extra) in enumerate(steps):
        model = _ride_pipeline(base + extra, M.rf_regressor("bike_count", trees=200, depth=RIDE_DEPTH)).fit(train)
        m = M.regressor_metrics(model.transform(test), "bike_count", name).withColumn("step", F.lit(i))
        out = m if out is None else out.unionByName(m)
    return out


@query("ml_decision_tree")
def ml_decision_tree(spark, sf):
    s, feats = _ride_frame(spark, sf)
    train, test = s.where(~F.col("is_test")), s.where(F.col("is_test"))
    model = _ride_pipeline(feats, M.tree_regressor("bike_count", depth=10)).fit(train)
    return M.regressor_metrics(model.transform(test), "bike_count", "decision_tree", clip_at_zero=True)


@query("exp_regressor_compare")
def exp_regressor_compare(spark, sf):
    """Ride models side by side, the least RMSE marked."""
    s, feats = _ride_frame(spark, sf)
    train, test = s.where(~F.col("is_test")), s.where(F.col("is_test"))
    models = {"linear": M.linear("bike_count"), "decision_tree": M.tree_regressor("bike_count", depth=10), "random_forest": M.rf_regressor("bike_count", trees=300, depth=RIDE_DEPTH)}
    return _compare([M.regressor_metrics(_ride_pipeline(feats, est).fit(train).transform(test), "bike_count", name, clip_at_zero=True)
                     for name, est in models.items()], "rmse", smallest=True)


@query("ml_rf_regressor")
def ml_rf_regressor(spark, sf):
    h = view(spark, sf, "houses")
    s = M.spread(cut_lineage(SM.random_split(h, ["house_id"], 0.2, 42)))
    train, test = s.where(~F.col("is_test")), s.where(F.col("is_test"))
    asm = VectorAssembler(inputCols=["size", "avg_quantity", "avg_discount", "rating_count"], outputCol="features")
    model = Pipeline(stages=[asm, M.rf_regressor("price", depth=M.NO_LIMIT)]).fit(train)
    return M.regressor_metrics(model.transform(test), "price", "random_forest")


PASSENGER_CATS = ["Sex", "Embarked", "Title"]
PASSENGER_NUM = ["Pclass", "AgeFilled", "SibSp", "Parch", "Fare", "FamilySize", "IsAlone"]


def _passenger_split(spark, sf):
    p = FE.passenger_features(view(spark, sf, "passengers"))
    p = S.fill_group_median(p, "Age", "Title", "AgeFilled").fillna({"Embarked": "S"})
    s = written(SM.stratified_split(p, "Survived", ["PassengerId"], 0.2, 42), "passenger-rows")
    w = SM.class_weights(s.where(~F.col("is_test")), "Survived").select("Survived", "weight")
    s = M.spread(written(s.join(F.broadcast(w), "Survived").select(
        "Survived", "weight", "is_test", *PASSENGER_NUM, *PASSENGER_CATS), "passenger-weighted"))  # two classes
    return s.where(~F.col("is_test")), s.where(F.col("is_test"))


def _passenger_metrics(train, test, name: str, est):
    pre = M.Preprocessor(numericCols=PASSENGER_NUM, textCols=PASSENGER_CATS)
    asm = VectorAssembler(inputCols=PASSENGER_NUM + [f"{c}__ohe" for c in PASSENGER_CATS], outputCol="features")
    model = Pipeline(stages=[pre, *M.one_hot_stages(PASSENGER_CATS), asm, est]).fit(train)
    return M.classifier_metrics(M.positive_probability(model.transform(test)), "Survived", name)


@query("ml_logreg")
def ml_logreg(spark, sf):
    train, test = _passenger_split(spark, sf)
    return _passenger_metrics(train, test, "logreg", M.logistic("Survived", train.count()))


@query("ml_tree_classifier")
def ml_tree_classifier(spark, sf):
    """Decision tree of depth 5 with balanced weights."""
    train, test = _passenger_split(spark, sf)
    return _passenger_metrics(train, test, "decision_tree", M.tree_classifier("Survived", weight="weight"))


@query("exp_passenger_compare")
def exp_passenger_compare(spark, sf):
    """Passenger models side by side, the best ROC-AUC marked; boosting in its second configuration."""
    train, test = _passenger_split(spark, sf)
    models = {"logreg": M.logistic("Survived", train.count()), "decision_tree": M.tree_classifier("Survived", weight="weight"),
              "random_forest": M.rf_classifier("Survived", "weight", trees=300, depth=M.NO_LIMIT, share=1.0),
              "gbt": M.boosting("Survived", depth=4, step=0.05, rows=0.8, columns=0.8)}
    return _compare([_passenger_metrics(train, test, name, est) for name, est in models.items()], "roc_auc")


# ---------------------------------------------------------------- churn (R)
CHURN_NUM, CHURN_TEXT = ["age", "monthly_charge", "tenure"], ["offer", "contract", "country"]


@query("ml_churn_forest")
def ml_churn_forest(spark, sf):
    """Forest of 100 trees without a depth limit on the churn table, text columns one-hot."""
    c = view(spark, sf, "churn").withColumn("label", F.when(F.col("churn_label") == "Yes", 1).otherwise(0))
    s = M.spread(cut_lineage(SM.stratified_split(c, "label", ["customer_id"], 0.2, 42)))
    asm = VectorAssembler(inputCols=CHURN_NUM + [f"{x}__ohe" for x in CHURN_TEXT], outputCol="features")
    forest = M.rf_classifier("label", trees=100, depth=M.NO_LIMIT, share=1.0)
    model = Pipeline(stages=[*M.one_hot_stages(CHURN_TEXT), asm, forest]).fit(s.where(~F.col("is_test")))
    return M.classifier_metrics(cut_lineage(M.positive_probability(model.transform(s.where("is_test"))).select("label", "p1")), "label", "random_forest")


# ---------------------------------------------------------------- evaluation of a fitted ranking
@query("eval_roc_curve_model")
def eval_roc_curve_model(spark, sf):
    """ROC curve of a fitted model's scores (E5 on M18 output)."""
    return E.roc_curve(fraud_scores(spark, sf, "random_forest"), "isFraud", "p1")
