"""Derived columns, projections, filters and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import expr as X
from tessera.operators import features as FE
from tessera.operators import quality as Q
from tessera.operators import recommend as R
from tessera.operators import stats as S
from tessera.operators.sampling import align_to_schema, first_per_class, min_positives_check, scenario_filter
from tessera.plans.q_recommend import META_SQL
from tessera.plans.q_stats import TITLE_CTE, r6
from tessera.plans.registry import query
from tessera.session import cut_lineage, scratch_dir, written
from tessera.sources.fixtures import RATING_ORDER, view

TXN_KEYS = ["txn_order", "txn_line", "txn_part", "txn_supp"]
TK = ", ".join(TXN_KEYS)


# ---------------------------------------------------------------- fraud features (M7)
CLEAN_TXN_SQL = """clean_txn AS (
  SELECT DISTINCT * FROM txn
  WHERE amount IS NOT NULL AND NOT isnan(amount) AND oldbalanceOrg IS NOT NULL AND oldbalanceDest IS NOT NULL
    AND type IS NOT NULL AND isFraud IS NOT NULL AND amount >= 0)"""

FRAUD_FEATURE_SQL = """
  round(a, 6) AS amount, round(s, 6) AS oldbalanceOrg, round(r, 6) AS oldbalanceDest, h AS Hour,
  round(ln(1 + a), 6) AS AmountLog, round(a / (s + 1), 6) AS AmountToSenderBalance,
  round(a / (r + 1), 6) AS AmountToReceiverBalance, round(s - a, 6) AS SenderBalanceAfterEstimated,
  round(r + a, 6) AS ReceiverBalanceAfterEstimated, CAST(s - a <= 0 AS INT) AS IsSenderBalanceZero,
  CAST(a > thr AS INT) AS IsLargeTransaction, CAST(type = 'TRANSFER' AS INT) AS IsTransfer,
  CAST(type = 'CASH_OUT' AS INT) AS IsCashOut, round(s - r, 6) AS BalanceDifference,
  CASE WHEN h <= 5 THEN 'Dawn' WHEN h <= 11 THEN 'Morning' WHEN h <= 17 THEN 'Afternoon' ELSE 'Evening' END AS TimeOfDay"""

FRAUD_BASE_SQL = """base AS (
  SELECT {keys}, type, isFraud, greatest(coalesce(amount, 0), 0) AS a, greatest(coalesce(oldbalanceOrg, 0), 0) AS s,
         greatest(coalesce(oldbalanceDest, 0), 0) AS r, CAST(least(greatest((step - 1) % 24, 0), 23) AS INT) AS h
  FROM {src}),
th AS (SELECT quantile_cont(a, 0.95) AS thr FROM base)"""


def _fraud_out(df):
    dbl = ["amount", "oldbalanceOrg", "oldbalanceDest", "AmountLog", "AmountToSenderBalance",
           "AmountToReceiverBalance", "SenderBalanceAfterEstimated", "ReceiverBalanceAfterEstimated",
           "BalanceDifference"]
    return df.select(*TXN_KEYS, "type", "isFraud", *[r6(c).alias(c) if c in dbl else F.col(c) for c in
                                                      FE.FRAUD_NUMERIC_FEATURES], "TimeOfDay")


@query("feat_fraud_all", f"""
WITH {CLEAN_TXN_SQL}, {FRAUD_BASE_SQL.format(keys=TK, src='clean_txn')}
SELECT {TK}, type, isFraud, {FRAUD_FEATURE_SQL} FROM base, th""")
def feat_fraud_all(spark, sf):
    # fit and transform both read the cleaned table: clean (join + dedupe) once
    t = cut_lineage(FE.with_hour(Q.clean_txn(view(spark, sf, "txn"))))
    model = FE.FraudFeatureEngineer().fit(t)
    return _fraud_out(model.transform(t))


@query("feat_amount_log", f"""
SELECT {TK}, round(ln(1 + greatest(coalesce(amount, 0), 0)), 6) AS AmountLog FROM txn""")
def feat_amount_log(spark, sf):
    t = view(spark, sf, "txn")
    return t.select(*TXN_KEYS, r6(F.log1p(X.non_negative_or_zero("amount"))).alias("AmountLog"))


@query("feat_safe_ratio", f"""
SELECT {TK},
  round(greatest(coalesce(amount, 0), 0) / (greatest(coalesce(oldbalanceOrg, 0), 0) + 1), 6) AS AmountToSenderBalance,
  round(greatest(coalesce(amount, 0), 0) / (greatest(coalesce(oldbalanceDest, 0), 0) + 1), 6) AS AmountToReceiverBalance
FROM txn""")
def feat_safe_ratio(spark, sf):
    t = view(spark, sf, "txn")
    return t.select(*TXN_KEYS, r6(X.safe_ratio("amount", "oldbalanceOrg")).alias("AmountToSenderBalance"),
                    r6(X.safe_ratio("amount", "oldbalanceDest")).alias("AmountToReceiverBalance"))


@query("feat_clip", """
SELECT c_custkey, greatest(c_acctbal, 0) AS acctbal_clipped,
       least(greatest(c_acctbal, 0), 5000) AS acctbal_clipped_both FROM customer""")
def feat_clip(spark, sf):
    from tessera.sources.tables import table
    c = table(spark, sf, "customer")
    return c.select("c_custkey", X.clip("c_acctbal", lower=0).alias("acctbal_clipped"),
                    X.clip("c_acctbal", lower=0, upper=5000).alias("acctbal_clipped_both"))


@query("feat_try_cast", f"""
SELECT {TK}, coalesce(TRY_CAST(CASE WHEN amount IS NULL THEN 'n/a' ELSE CAST(amount AS VARCHAR) END AS DOUBLE), 0) AS amount_parsed
FROM txn""")
def feat_try_cast(spark, sf):
    t = view(spark, sf, "txn").withColumn(
        "amount_text", F.when(F.col("amount").isNull(), F.lit("n/a")).otherwise(F.col("amount").cast("string")))
    return t.select(*TXN_KEYS, F.coalesce(X.parse_number("amount_text"), F.lit(0.0)).alias("amount_parsed"))


@query("feat_hour", f"SELECT {TK}, step, CAST((step - 1) % 24 AS INT) AS Hour FROM txn")
def feat_hour(spark, sf):
    return view(spark, sf, "txn").select(*TXN_KEYS, "step", X.hour_of_step().alias("Hour"))


@query("feat_balance", f"""
SELECT {TK}, oldbalanceOrg - amount AS SenderBalanceAfter, oldbalanceDest + amount AS ReceiverBalanceAfter,
       oldbalanceOrg - oldbalanceDest AS BalanceDifference FROM txn""")
def feat_balance(spark, sf):
    t = view(spark, sf, "txn")
    return t.select(*TXN_KEYS, (F.col("oldbalanceOrg") - F.col("amount")).alias("SenderBalanceAfter"),
                    (F.col("oldbalanceDest") + F.col("amount")).alias("ReceiverBalanceAfter"),
                    (F.col("oldbalanceOrg") - F.col("oldbalanceDest")).alias("BalanceDifference"))


@query("feat_large_txn", f"""
WITH th AS (SELECT quantile_cont(greatest(coalesce(amount, 0), 0), 0.95) AS thr FROM txn)
SELECT {TK}, round(thr, 6) AS amount_threshold,
       CAST(greatest(coalesce(amount, 0), 0) > thr AS INT) AS IsLargeTransaction FROM txn, th""")
def feat_large_txn(spark, sf):
    t = written(view(spark, sf, "txn").select(*TXN_KEYS, "amount"), "txn-amounts")  # read by the passes of the quantile and by the flags
    th = F.broadcast(FE.amount_threshold(t))  # one row
    j = t.crossJoin(th)
    return j.select(*TXN_KEYS, r6("amount_threshold").alias("amount_threshold"),
                    X.flag(X.non_negative_or_zero("amount") > F.col("amount_threshold")).alias("IsLargeTransaction"))


# ---------------------------------------------------------------- ride features
RIDE_FEATURE_SQL = """
  CASE WHEN hour > -1 AND hour <= 5 THEN 'Dawn(0-5)' WHEN hour > 5 AND hour <= 11 THEN 'Morning(6-11)'
       WHEN hour > 11 AND hour <= 17 THEN 'Afternoon(12-17)' WHEN hour > 17 AND hour <= 23 THEN 'Evening(18-23)' END AS HourBlock,
  CASE WHEN temperature > -20 AND temperature <= 0 THEN 'Freezing(~0)' WHEN temperature > 0 AND temperature <= 10 THEN 'Cold(0-10)'
       WHEN temperature > 10 AND temperature <= 20 THEN 'Mild(10-20)' WHEN temperature > 20 AND temperature <= 30 THEN 'Warm(20-30)'
       WHEN temperature > 30 AND temperature <= 40 THEN 'Hot(30+)' END AS TemperatureBin,
  CAST(hour IN (7, 8, 17, 18, 19, 20) AS INT) AS IsRushHour,
  CAST(rainfall > 0 OR snowfall > 0 AS INT) AS IsPrecipitation,
  CAST(hour IN (7, 8, 17, 18, 19, 20) AND holiday = 'No Holiday' AS INT) AS IsCommuteTime,
  0.81 * temperature + 0.01 * humidity * (0.99 * temperature - 14.3) + 46.3 AS DiscomfortIndex,
  temperature - dew_point AS DewPointGap"""


@query("feat_bins", f"""
WITH f AS (SELECT bike_count, {RIDE_FEATURE_SQL} FROM rides)
SELECT HourBlock, TemperatureBin, round(avg(bike_count), 6) AS mean, count(*) AS count
FROM f GROUP BY HourBlock, TemperatureBin""")
def feat_bins(spark, sf):
    f = FE.ride_features(view(spark, sf, "rides"), severity=False)
    return f.groupBy("HourBlock", "TemperatureBin").agg(r6(F.avg("bike_count")).alias("mean"),
                                                        F.count(F.lit(1)).alias("count"))


@query("feat_flags", f"""
WITH f AS (SELECT bike_count, {RIDE_FEATURE_SQL} FROM rides)
SELECT IsPrecipitation, IsCommuteTime, round(avg(bike_count), 6) AS mean, count(*) AS count
FROM f GROUP BY 1, 2""")
def feat_flags(spark, sf):
    f = FE.ride_features(view(spark, sf, "rides"), severity=False)
    return f.groupBy("IsPrecipitation", "IsCommuteTime").agg(r6(F.avg("bike_count")).alias("mean"),
                                                             F.count(F.lit(1)).alias("count"))


@query("feat_rush_hour", """
SELECT CAST(hour IN (7, 8, 17, 18, 19, 20) AS INT) AS IsRushHour, round(avg(bike_count), 6) AS mean,
       count(*) AS count FROM rides GROUP BY 1""")
def feat_rush_hour(spark, sf):
    f = FE.ride_features(view(spark, sf, "rides"), severity=False)
    return S.target_by_group(f, ["IsRushHour"], "bike_count", digits=6)


@query("feat_discomfort", f"""
WITH f AS (SELECT bike_count, {RIDE_FEATURE_SQL} FROM rides)
SELECT round(min(DiscomfortIndex), 6) AS di_min, round(max(DiscomfortIndex), 6) AS di_max,
       round(avg(DiscomfortIndex), 6) AS di_mean,
       round(covar_pop(DiscomfortIndex, bike_count) / (stddev_pop(DiscomfortIndex) * stddev_pop(bike_count)), 6) AS di_corr,
       round(covar_pop(DewPointGap, bike_count) / (stddev_pop(DewPointGap) * stddev_pop(bike_count)), 6) AS gap_corr
FROM f""")
def feat_discomfort(spark, sf):
    f = FE.ride_features(view(spark, sf, "rides"), severity=False)
    return f.agg(r6(F.min("DiscomfortIndex")).alias("di_min"), r6(F.max("DiscomfortIndex")).alias("di_max"),
                 r6(F.avg("DiscomfortIndex")).alias("di_mean"),
                 r6(S.safe_corr("DiscomfortIndex", "bike_count")).alias("di_corr"),
                 r6(S.safe_corr("DewPointGap", "bike_count")).alias("gap_corr"))


@query("feat_severity", f"""
WITH q AS (SELECT quantile_cont(visibility, 0.25) AS vq, quantile_cont(wind_speed, 0.75) AS wq FROM rides),
f AS (SELECT bike_count, CAST(rainfall > 0 OR snowfall > 0 AS INT) + CAST(visibility < vq AS INT)
             + CAST(wind_speed > wq AS INT) AS WeatherSeverityScore FROM rides, q)
SELECT WeatherSeverityScore, round(avg(bike_count), 6) AS mean, count(*) AS count FROM f GROUP BY 1""")
def feat_severity(spark, sf):
    f = FE.ride_features(view(spark, sf, "rides"))
    return S.target_by_group(f, ["WeatherSeverityScore"], "bike_count", digits=6)


# ---------------------------------------------------------------- passenger features
@query("feat_family", """
SELECT PassengerId, SibSp + Parch + 1 AS FamilySize, CAST(SibSp + Parch + 1 = 1 AS INT) AS IsAlone,
       round(Fare / (SibSp + Parch + 1), 6) AS FarePerPerson FROM passengers""")
def feat_family(spark, sf):
    f = FE.passenger_features(view(spark, sf, "passengers"))
    return f.select("PassengerId", "FamilySize", "IsAlone", r6("FarePerPerson").alias("FarePerPerson"))


@query("feat_title", f"""
WITH {TITLE_CTE}
SELECT Title, round(avg(Survived), 6) AS mean, count(*) AS count FROM titled GROUP BY Title""")
def feat_title(spark, sf):
    f = FE.passenger_features(view(spark, sf, "passengers"))
    return S.target_by_group(f, ["Title"], "Survived", digits=6)


@query("feat_cabin_ticket", """
SELECT PassengerId, CAST(Cabin IS NOT NULL AS INT) AS HasCabin,
       count(*) OVER (PARTITION BY Ticket) AS TicketGroupSize FROM passengers""")
def feat_cabin_ticket(spark, sf):
    f = FE.passenger_features(view(spark, sf, "passengers"))
    return f.select("PassengerId", "HasCabin", "TicketGroupSize")


@query("feat_qcut", """
WITH e AS (SELECT quantile_cont(Fare, 0.25) AS e1, quantile_cont(Fare, 0.5) AS e2,
                  quantile_cont(Fare, 0.75) AS e3, min(Fare) AS e0, max(Fare) AS e4 FROM passengers)
SELECT FareGroup, count(*) AS count, round(avg(Survived), 6) AS mean FROM (
  SELECT Survived, CASE WHEN Fare IS NULL THEN NULL WHEN Fare <= e1 THEN 'Low' WHEN Fare <= e2 THEN 'MidLow'
                        WHEN Fare <= e3 THEN 'MidHigh' WHEN Fare <= e4 THEN 'High' END AS FareGroup
  FROM passengers, e) g GROUP BY FareGroup""")
def feat_qcut(spark, sf):
    p = FE.qcut(view(spark, sf, "passengers"), "Fare", FE.FARE_LABELS, "FareGroup")
    return p.groupBy("FareGroup").agg(F.count(F.lit(1)).alias("count"), r6(F.avg("Survived")).alias("mean"))


@query("feat_age_groups", f"""
WITH {TITLE_CTE},
gm AS (SELECT Title, quantile_cont(Age, 0.5) AS gmed FROM titled GROUP BY Title),
filled AS (SELECT titled.*, coalesce(Age, gmed, (SELECT quantile_cont(Age, 0.5) FROM titled)) AS AgeFilled
           FROM titled LEFT JOIN gm ON titled.Title IS NOT DISTINCT FROM gm.Title),
g AS (SELECT Survived, CASE WHEN AgeFilled >= 0 AND AgeFilled <= 12 THEN 'Child' WHEN AgeFilled <= 18 THEN 'Teen'
              WHEN AgeFilled <= 35 THEN 'YoungAdult' WHEN AgeFilled <= 60 THEN 'Adult' ELSE 'Senior' END AS AgeGroup FROM filled),
labels AS (SELECT * FROM (VALUES (0, 'Child'), (1, 'Teen'), (2, 'YoungAdult'), (3, 'Adult'), (4, 'Senior')) v(bin_order, AgeGroup))
SELECT labels.bin_order, labels.AgeGroup, round(avg(Survived), 6) AS mean, count(Survived) AS count
FROM labels LEFT JOIN g ON labels.AgeGroup = g.AgeGroup GROUP BY 1, 2""")
def feat_age_groups(spark, sf):
    p = FE.passenger_features(view(spark, sf, "passengers"))
    p = FE.age_groups(S.fill_group_median(p, "Age", "Title", "AgeFilled"))
    out = S.target_by_bins(p, "AgeGroup", FE.AGE_LABELS, "Survived")
    return out.withColumn("mean", r6("mean"))


@query("feat_title_year", """
SELECT item_id,
       CASE WHEN regexp_matches(trim(title), '\\((\\d{4})\\)')
            THEN trim(regexp_extract(trim(title), '^(.*)\\(\\d{4}\\)', 1)) ELSE trim(title) END AS clean_title,
       CAST(list_last(regexp_extract_all(trim(title), '\\((\\d{4})\\)', 1)) AS INT) AS release_year
FROM items""")
def feat_title_year(spark, sf):
    from tessera.functions.text import split_title_year_cols
    clean, year = split_title_year_cols("title")
    return view(spark, sf, "items").select("item_id", clean.alias("clean_title"), year.alias("release_year"))


# ---------------------------------------------------------------- scoring rules
REQUEST_SQL = """req AS (
  SELECT {keys}, type AS transaction_type, amount, oldbalanceOrg AS sender_old_balance,
         oldbalanceDest AS receiver_old_balance, CAST((step - 1) % 24 AS INT) AS transaction_hour, score
  FROM txn)""".format(keys=TK)
RULES_SQL = """list_filter([
    CASE WHEN NOT coalesce(transaction_type IN ('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER'), false) THEN 'type_allowed' END,
    CASE WHEN NOT coalesce(amount >= 0, false) THEN 'amount_non_negative' END,
    CASE WHEN NOT coalesce(sender_old_balance >= 0, false) THEN 'sender_balance_non_negative' END,
    CASE WHEN NOT coalesce(receiver_old_balance >= 0, false) THEN 'receiver_balance_non_negative' END,
    CASE WHEN NOT coalesce(transaction_hour BETWEEN 0 AND 23, false) THEN 'hour_in_range' END],
  lambda x: x IS NOT NULL)"""


def _requests(spark, sf):
    t = view(spark, sf, "txn")
    return t.select(*TXN_KEYS, F.col("type").alias("transaction_type"), "amount",
                    F.col("oldbalanceOrg").alias("sender_old_balance"),
                    F.col("oldbalanceDest").alias("receiver_old_balance"),
                    X.hour_of_step().alias("transaction_hour"), "score")


@query("validate_rows", f"""
WITH {REQUEST_SQL}
SELECT {TK}, {RULES_SQL} AS failed_rules, len({RULES_SQL}) = 0 AS is_valid FROM req""")
def validate_rows(spark, sf):
    v = Q.validate(_requests(spark, sf), Q.txn_request_rules())
    return v.select(*TXN_KEYS, "failed_rules", "is_valid")


@query("risk_level", f"""
SELECT {TK}, round(score, 6) AS fraud_probability, round(1 - score, 6) AS normal_probability,
       CAST(score >= 0.5 AS INT) AS prediction, CASE WHEN score >= 0.5 THEN 'Suspicious' ELSE 'Normal' END AS label,
       CASE WHEN score < 0.5 * 0.5 THEN 'Low' WHEN score < 0.5 THEN 'Medium' ELSE 'High' END AS risk_level
FROM txn""")
def risk_level(spark, sf):
    t = view(spark, sf, "txn").withColumn("threshold", F.lit(0.5))
    return t.select(*TXN_KEYS, r6("score").alias("fraud_probability"), r6(1 - F.col("score")).alias("normal_probability"),
                    X.flag(F.col("score") >= F.col("threshold")).alias("prediction"),
                    F.when(F.col("score") >= F.col("threshold"), "Suspicious").otherwise("Normal").alias("label"),
                    X.risk_level("score", "threshold").alias("risk_level"))


@query("risk_factors", f"""
WITH {REQUEST_SQL}, {CLEAN_TXN_SQL},
th AS (SELECT quantile_cont(greatest(coalesce(amount, 0), 0), 0.95) AS thr FROM clean_txn)
SELECT {TK}, list_filter([
    CASE WHEN amount > sender_old_balance THEN '{X.RISK_MESSAGES[0]}'
         WHEN sender_old_balance > 0 AND amount / sender_old_balance >= 0.9 THEN '{X.RISK_MESSAGES[1]}' END,
    CASE WHEN transaction_type = 'TRANSFER' THEN '{X.RISK_MESSAGES[2]}'
         WHEN transaction_type = 'CASH_OUT' THEN '{X.RISK_MESSAGES[3]}' END,
    CASE WHEN receiver_old_balance < 100 THEN '{X.RISK_MESSAGES[4]}' END,
    CASE WHEN amount > thr THEN '{X.RISK_MESSAGES[5]}' END,
    CASE WHEN transaction_hour IN (0, 1, 2, 3, 4) THEN '{X.RISK_MESSAGES[6]}' END], lambda x: x IS NOT NULL) AS risk_factors
FROM req, th WHERE len({RULES_SQL}) = 0""")
def risk_factors(spark, sf):
    thr = FE.amount_threshold(Q.clean_txn(view(spark, sf, "txn")))
    v = Q.validate(_requests(spark, sf), Q.txn_request_rules()).where("is_valid")
    j = v.crossJoin(F.broadcast(thr))  # one row
    return j.select(*TXN_KEYS, X.risk_factors().alias("risk_factors"))


# ---------------------------------------------------------------- projections and filters
@query("prj_drop_leakage", "SELECT age, offer, contract, monthly_charge, country, tenure, churn_label FROM churn")
def prj_drop_leakage(spark, sf):
    return view(spark, sf, "churn").drop("customer_id")


@query("prj_drop_leakage_txn", "SELECT * FROM txn")
def prj_drop_leakage_txn(spark, sf):
    """Balances after the event, the flag and the party names go."""
    t = view(spark, sf, "txn")
    full = t.withColumns({"newbalanceOrig": F.col("oldbalanceOrg") - F.col("amount"), "newbalanceDest": F.col("oldbalanceDest") + F.col("amount"),
                          "isFlaggedFraud": F.lit(0), "nameOrig": F.concat(F.lit("C"), "txn_order"), "nameDest": F.concat(F.lit("M"), "txn_supp")})
    return FE.drop_leakage(full)


@query("request_rename", f"""
SELECT {TK}, type, amount, oldbalanceOrg, oldbalanceDest, CAST(((step - 1) % 24 + 24) % 24 AS INT) AS Hour FROM txn""")
def request_rename(spark, sf):
    return FE.request_to_model(_requests(spark, sf)).select(*TXN_KEYS, "type", "amount", "oldbalanceOrg", "oldbalanceDest", F.col("Hour").cast("int").alias("Hour"))


@query("fmt_percent", f"SELECT {TK}, round(score * 100, 2) AS score_pct FROM txn")
def fmt_percent(spark, sf):
    return view(spark, sf, "txn").select(*TXN_KEYS, X.pct("score").alias("score_pct"))


@query("prj_map_label", """
SELECT customer_id, CASE churn_label WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS churn,
       CASE WHEN (CASE churn_label WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END) = 1 THEN 'Yes' ELSE 'No' END AS churn_text
FROM churn""")
def prj_map_label(spark, sf):
    c = view(spark, sf, "churn")
    y = F.when(F.col("churn_label") == "Yes", 1).when(F.col("churn_label") == "No", 0)
    return c.select("customer_id", y.alias("churn"), F.when(y == 1, "Yes").otherwise("No").alias("churn_text"))


TRAINED_COLUMNS = ["age", "tenure", "monthly_charge", "offer_AUTOMOBILE", "offer_BUILDING", "offer_FURNITURE",
                   "offer_HOUSEHOLD", "contract_Month-to-Month", "contract_One Year", "contract_Two Year",
                   "satisfaction_score"]


@query("prj_align_schema", """
SELECT customer_id, age, tenure, monthly_charge,
       CAST(coalesce(offer = 'AUTOMOBILE', false) AS INT) AS "offer_AUTOMOBILE",
       CAST(coalesce(offer = 'BUILDING', false) AS INT) AS "offer_BUILDING",
       CAST(coalesce(offer = 'FURNITURE', false) AS INT) AS "offer_FURNITURE",
       CAST(coalesce(offer = 'HOUSEHOLD', false) AS INT) AS "offer_HOUSEHOLD",
       CAST(contract = 'Month-to-Month' AS INT) AS "contract_Month-to-Month",
       CAST(contract = 'One Year' AS INT) AS "contract_One Year",
       CAST(contract = 'Two Year' AS INT) AS "contract_Two Year",
       0 AS satisfaction_score
FROM churn""")
def prj_align_schema(spark, sf):
    c = view(spark, sf, "churn")
    return align_to_schema(c, TRAINED_COLUMNS, ["offer", "contract"], keep=["customer_id"])


SCENARIOS_SQL = """
  SELECT 'summer_evening' AS scenario, * FROM rides WHERE season = 'Summer' AND hour = 18 AND rainfall = 0
  UNION ALL SELECT 'winter_morning', * FROM rides WHERE season = 'Winter' AND hour = 8
  UNION ALL SELECT 'rainy', * FROM rides WHERE rainfall > 0
  UNION ALL SELECT 'snowy', * FROM rides WHERE snowfall > 0
  UNION ALL SELECT 'holiday_afternoon', * FROM rides WHERE holiday = 'Holiday' AND hour = 14
  UNION ALL SELECT 'closed_day', * FROM rides WHERE functioning_day = 'No' AND season = 'Spring' AND rainfall > 5"""


@query("scenario_rows", f"""
SELECT scenario, count(*) AS n_rows, round(avg(bike_count), 6) AS mean_count
FROM ({SCENARIOS_SQL}) s GROUP BY scenario""")
def scenario_rows(spark, sf):
    s = scenario_filter(view(spark, sf, "rides"))
    return s.groupBy("scenario").agg(F.count(F.lit(1)).alias("n_rows"), r6(F.avg("bike_count")).alias("mean_count"))


@query("rows_by_key", """
SELECT c.* FROM churn c WHERE customer_id IN
  (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def rows_by_key(spark, sf):
    from tessera.sources.tables import table
    keys = (table(spark, sf, "orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
            .select(F.col("o_custkey").alias("customer_id")))
    return view(spark, sf, "churn").join(keys, "customer_id", "left_semi")


@query("sample_per_class", f"""
WITH firsts AS (
  SELECT isFraud, arg_min(struct_pack(txn_order := txn_order, txn_line := txn_line, txn_part := txn_part,
                                      txn_supp := txn_supp, type := type, amount := amount),
                          struct_pack(o := txn_order, l := txn_line, p := txn_part, s := txn_supp)) AS r
  FROM txn GROUP BY isFraud),
classes AS (SELECT * FROM (VALUES (0), (1)) v(isFraud))
SELECT classes.isFraud, r IS NULL AS is_fallback,
       coalesce(r.txn_order, -1) AS txn_order, coalesce(r.txn_line, -1) AS txn_line,
       coalesce(r.type, 'TRANSFER') AS type, coalesce(r.amount, 181000.0) AS amount
FROM classes LEFT JOIN firsts USING (isFraud)""")
def sample_per_class(spark, sf):
    t = view(spark, sf, "txn")
    return first_per_class(t, "isFraud", [0, 1], TXN_KEYS, ["txn_order", "txn_line", "txn_part", "txn_supp", "type", "amount"],
                           {"txn_order": -1, "txn_line": -1, "type": "TRANSFER", "amount": 181000.0},
                           out=["txn_order", "txn_line", "type", "amount"])


@query("check_min_positives", """
SELECT CAST(sum(isFraud) AS BIGINT) AS positives, CAST(count(*) - sum(isFraud) AS BIGINT) AS negatives,
       sum(isFraud) >= 10 AS ok FROM txn""")
def check_min_positives(spark, sf):
    return min_positives_check(view(spark, sf, "txn"), "isFraud", 10)


@query("search_catalog", f"""
WITH {META_SQL}
SELECT item_id, title, rating_count FROM meta WHERE contains(lower(clean_title), 'gear')
ORDER BY rating_count DESC, item_id LIMIT 20""")
def search_catalog(spark, sf):
    meta = R.item_metadata(view(spark, sf, "items"), Q.clean_ratings(view(spark, sf, "ratings"), RATING_ORDER))
    return R.search_catalogue(meta, " Gear ", 20).select("item_id", "title", "rating_count")


@query("clean_txn", f"""
WITH {CLEAN_TXN_SQL}
SELECT {TK}, step, type, amount, oldbalanceOrg, oldbalanceDest, isFraud FROM clean_txn""")
def clean_txn(spark, sf):
    """Whole-row dedupe, Inf -> null, null drop, negative-amount drop."""
    c = Q.clean_txn(view(spark, sf, "txn"))
    return c.select(*TXN_KEYS, "step", "type", "amount", "oldbalanceOrg", "oldbalanceDest", "isFraud")


@query("clean_txn_summary", f"""
WITH {CLEAN_TXN_SQL}
SELECT (SELECT count(*) FROM txn) AS rows_before, (SELECT count(*) FROM clean_txn) AS rows_after,
       (SELECT count(*) FROM txn) - (SELECT count(*) FROM clean_txn) AS rows_removed""")
def clean_txn_summary(spark, sf):
    """Rows removed by the cleaning job (the reference prints this count)."""
    _, summary = Q.clean_observed(view(spark, sf, "txn"), Q.clean_txn, scratch_dir(spark, "clean-txn"))
    return summary
