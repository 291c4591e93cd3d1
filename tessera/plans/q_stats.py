"""Exploratory statistics and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import expr as X
from tessera.functions.text import honorific
from tessera.operators import quality as Q
from tessera.operators import recommend as R
from tessera.operators import stats as S
from tessera.plans.registry import query
from tessera.plans.q_recommend import CLEAN_SQL, META_SQL
from tessera.sources.fixtures import RATING_ORDER, view

RIDE_NUM = ["bike_count", "temperature", "humidity", "wind_speed", "visibility",
            "dew_point", "rainfall", "snowfall", "hour"]
RIDE_TEXT = ["date", "season", "holiday", "functioning_day"]
PASSENGER_COLS = ["PassengerId", "Survived", "Pclass", "Name", "Sex", "Age", "SibSp", "Parch",
                  "Ticket", "Fare", "Cabin", "Embarked"]
TXN_MONEY = ["amount", "oldbalanceOrg", "oldbalanceDest"]


def r6(c):
    return F.round(c, 6)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- A1, A25
@query("agg_target_by_group", """
SELECT season, round(avg(bike_count), 6) AS mean, count(*) AS count FROM rides GROUP BY season""")
def agg_target_by_group(spark, sf):
    return S.target_by_group(view(spark, sf, "rides"), ["season"], "bike_count", digits=6)


@query("agg_hourly_profile", """
SELECT hour, round(avg(bike_count), 6) AS mean, count(*) AS count FROM rides GROUP BY hour""")
def agg_hourly_profile(spark, sf):
    return S.target_by_group(view(spark, sf, "rides"), ["hour"], "bike_count", digits=6)


# ---------------------------------------------------------------- A2-A4
@query("agg_group_size", "SELECT item_id, count(*) AS count FROM ratings GROUP BY item_id")
def agg_group_size(spark, sf):
    return view(spark, sf, "ratings").groupBy("item_id").agg(F.count(F.lit(1)).alias("count"))


@query("agg_event_rate", """
SELECT type, CAST(sum(isFraud) AS BIGINT) AS events, count(*) AS total,
       round(sum(isFraud) * 100.0 / count(*), 6) AS rate_pct
FROM txn GROUP BY type""")
def agg_event_rate(spark, sf):
    r = S.event_rate(view(spark, sf, "txn"), "type", "isFraud")
    return r.withColumn("rate_pct", r6("rate_pct"))


@query("agg_value_counts", """
SELECT Embarked, count(*) AS count,
       round(count(*) / (SELECT count(*) FROM passengers WHERE Embarked IS NOT NULL), 6) AS share
FROM passengers WHERE Embarked IS NOT NULL GROUP BY Embarked""")
def agg_value_counts(spark, sf):
    p = view(spark, sf, "passengers").where(F.col("Embarked").isNotNull())
    return S.value_counts(p, "Embarked").withColumn("share", r6("share"))


# ---------------------------------------------------------------- A5
def _missing_sql(table: str, cols: list[str], float_cols: set[str]) -> str:
    parts = []
    for c in cols:
        miss = f"({c} IS NULL OR isnan({c}))" if c in float_cols else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {miss}) AS BIGINT) AS n_missing, "
                     f"round(count(*) FILTER (WHERE {miss}) * 100.0 / count(*), 6) AS pct_missing FROM {table}")
    return _union(parts)


@query("dq_missing", _missing_sql("passengers", PASSENGER_COLS, {"Age", "Fare"}))
def dq_missing(spark, sf):
    return Q.missing_report(view(spark, sf, "passengers"), digits=6)


# ---------------------------------------------------------------- A6-A8
RATING_COLS = ["user_id", "item_id", "rating", "rated_at", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]


@query("dq_duplicates", f"""
SELECT 'full_row' AS subset, count(*) AS n_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(RATING_COLS)} FROM ratings) d) AS n_duplicates
FROM ratings
UNION ALL
SELECT 'user_item', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM ratings) d)
FROM ratings""")
def dq_duplicates(spark, sf):
    r = view(spark, sf, "ratings")
    out = Q.duplicate_counts(r, {"full_row": RATING_COLS, "user_item": ["user_id", "item_id"]})
    return out.select("subset", F.col("n_rows").cast("long"), F.col("n_duplicates").cast("long"))


@query("clean_ratings", """
WITH c AS (SELECT *, row_number() OVER (PARTITION BY user_id, item_id
              ORDER BY rated_at DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC,
                       l_extendedprice DESC, rating DESC) AS rn FROM ratings)
SELECT user_id, item_id, rating, rated_at, l_orderkey, l_linenumber, l_suppkey, l_extendedprice
FROM c WHERE rn = 1 AND rating BETWEEN 1 AND 5""")
def clean_ratings_q(spark, sf):
    return Q.clean_ratings(view(spark, sf, "ratings"), RATING_ORDER)


@query("dq_duplicate_members", """
SELECT user_id, item_id, rating, l_orderkey, l_linenumber FROM ratings
WHERE (user_id, item_id) IN (SELECT user_id, item_id FROM ratings GROUP BY 1, 2 HAVING count(*) > 1)""")
def dq_duplicate_members(spark, sf):
    r = view(spark, sf, "ratings").select("user_id", "item_id", "rating", "l_orderkey", "l_linenumber")
    return Q.duplicate_members(r, ["user_id", "item_id"])


# ---------------------------------------------------------------- A9-A13
def _describe_sql(table: str, cols: list[str]) -> str:
    parts = [f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
       round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
       round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM {table}""" for c in cols]
    return _union(parts)


@query("stat_describe", _describe_sql("rides", RIDE_NUM))
def stat_describe(spark, sf):
    d = S.describe_numeric(view(spark, sf, "rides"), RIDE_NUM)
    return d.select("column_name", "count", *[r6(c).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


@query("stat_describe_cat", _union([f"""SELECT '{c}' AS column_name, count({c}) AS count,
       count(DISTINCT {c}) AS unique,
       (SELECT {c} FROM rides WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
       (SELECT count(*) FROM rides WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq
FROM rides""" for c in RIDE_TEXT]))
def stat_describe_cat(spark, sf):
    return S.describe_categorical(view(spark, sf, "rides"), RIDE_TEXT)


@query("stat_skew_kurt", _union([f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis
FROM rides""" for c in RIDE_NUM]))
def stat_skew_kurt(spark, sf):
    m = S.moments(view(spark, sf, "rides"), RIDE_NUM)
    return m.select("column_name", "n", *[r6(c).alias(c) for c in ["mean", "std", "skewness", "kurtosis"]])


PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


@query("stat_quantiles", _union([f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS p, "
                                 f"round(quantile_cont({c}, {p}), 6) AS q FROM txn"
                                 for c in TXN_MONEY for p in PROBS]))
def stat_quantiles(spark, sf):
    q = S.quantiles(view(spark, sf, "txn"), TXN_MONEY, PROBS)
    return q.select("column_name", "p", r6("q").alias("q"))


@query("stat_iqr_outliers", _union([f"""SELECT '{c}' AS column_name, round(q1, 6) AS q1, round(q3, 6) AS q3,
       CAST(count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers,
       count({c}) AS n,
       round(count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0 / count({c}), 6) AS pct_outliers
FROM rides, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM rides) f
WHERE {c} IS NOT NULL GROUP BY q1, q3""" for c in RIDE_NUM]))
def stat_iqr_outliers(spark, sf):
    o = S.iqr_outliers(view(spark, sf, "rides"), RIDE_NUM)
    return o.select("column_name", r6("q1").alias("q1"), r6("q3").alias("q3"), "n_outliers", "n",
                    r6("pct_outliers").alias("pct_outliers"))


# ---------------------------------------------------------------- A14-A17
def _corr_sql(a: str, b: str) -> str:
    xm = f"CASE WHEN {b} IS NOT NULL THEN {a} END"
    ym = f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    return f"covar_pop({xm}, {ym}) / nullif(stddev_pop({xm}) * stddev_pop({ym}), 0)"


CORR_COLS = RIDE_NUM
CORR_PAIRS = [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]
CORR_SQL = _union([f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({_corr_sql(a, b)}, 6) AS corr FROM rides"
                   for a, b in CORR_PAIRS])


@query("stat_corr_matrix", CORR_SQL)
def stat_corr_matrix(spark, sf):
    return S.corr_pairs(view(spark, sf, "rides"), CORR_COLS).withColumn("corr", r6("corr"))


@query("sel_high_corr_pairs", f"""
WITH p AS ({CORR_SQL}), p_raw AS ({_union([f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_corr_sql(a, b)} AS corr FROM rides" for a, b in CORR_PAIRS])})
SELECT p.col_a, p.col_b, p.corr, t.threshold
FROM p JOIN p_raw USING (col_a, col_b), (VALUES (0.8), (0.85), (0.9)) t(threshold)
WHERE abs(p_raw.corr) > t.threshold""")
def sel_high_corr_pairs(spark, sf):
    pairs = S.corr_pairs(view(spark, sf, "rides"), CORR_COLS)
    hi = S.high_corr_pairs(pairs, [0.8, 0.85, 0.9])
    return hi.select("col_a", "col_b", r6("corr").alias("corr"), "threshold")


@query("sel_high_corr_pairs_inclusive", _union([f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round({_corr_sql(a, b)}, 6) AS corr, CAST({t} AS DOUBLE) AS threshold
FROM rides HAVING abs({_corr_sql(a, b)}) >= {t}""" for a, b in CORR_PAIRS for t in (0.8, 0.85, 0.9)]))
def sel_high_corr_pairs_inclusive(spark, sf):
    """The form that keeps pairs at the threshold."""
    hi = S.high_corr_pairs(S.corr_pairs(view(spark, sf, "rides"), CORR_COLS), [0.8, 0.85, 0.9], inclusive=True)
    return hi.select("col_a", "col_b", r6("corr").alias("corr"), "threshold")


@query("stat_corr_target", _union([f"SELECT '{a}' AS column_name, round({_corr_sql(a, 'bike_count')}, 6) AS corr FROM rides" for a in RIDE_NUM[1:]]))
def stat_corr_target(spark, sf):
    """Correlation of every numeric column with the target, strongest first."""
    c = S.corr_with_target(view(spark, sf, "rides"), RIDE_NUM[1:], "bike_count")
    return c.withColumn("corr", r6("corr")).orderBy(F.desc("corr"), "column_name")


@query("stat_describe_by_class", _union([f"""SELECT churn_label, '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
       round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max
FROM churn GROUP BY churn_label""" for c in ("age", "monthly_charge", "tenure")]))
def stat_describe_by_class(spark, sf):
    """``describe()`` within each class."""
    d = S.describe_numeric(view(spark, sf, "churn"), ["age", "monthly_charge", "tenure"], ["churn_label"])
    return d.select("churn_label", "column_name", "count", *[r6(c).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


ZV_COLS = ["age", "monthly_charge", "tenure", "country_us", "contract_two_year"]


def _churn_numeric(spark, sf):
    return view(spark, sf, "churn").select(
        "age", "monthly_charge", "tenure",
        (F.col("country") == "United States").cast("int").alias("country_us"),
        (F.col("contract") == "Two Year").cast("int").alias("contract_two_year"))


@query("sel_zero_variance", f"""
WITH c AS (SELECT age, monthly_charge, tenure, CAST(country = 'United States' AS INT) AS country_us,
                  CAST(contract = 'Two Year' AS INT) AS contract_two_year FROM churn)
{_union([f"SELECT '{c}' AS column_name, round(var_pop({c}), 6) AS variance, var_pop({c}) = 0 AS zero_variance FROM c" for c in ZV_COLS])}""")
def sel_zero_variance(spark, sf):
    z = S.zero_variance(_churn_numeric(spark, sf), ZV_COLS)
    return z.select("column_name", r6("variance").alias("variance"), "zero_variance")


@query("sel_zero_variance_filled", _union([f"SELECT '{c}' AS column_name, round(var_pop(coalesce({c}, 0)), 6) AS variance, "
                                           f"var_pop(coalesce({c}, 0)) = 0 AS zero_variance FROM passengers" for c in ("Age", "Fare", "SibSp", "Parch")]))
def sel_zero_variance_filled(spark, sf):
    """The form that fills nulls with 0 first."""
    cols = ["Age", "Fare", "SibSp", "Parch"]
    z = S.zero_variance(view(spark, sf, "passengers").select(*cols).fillna(0), cols)
    return z.select("column_name", r6("variance").alias("variance"), "zero_variance")


QC_COLS = PASSENGER_COLS
QC_THRESHOLDS = [0.01, 0.02, 0.05]


@query("sel_quasi_constant", _union([f"""SELECT '{c}' AS column_name, CAST({t} AS DOUBLE) AS threshold, max(n) AS top_count, CAST(sum(n) AS BIGINT) AS n,
       round(max(n) / sum(n), 6) AS top_share, max(n) / sum(n) >= 1 - {t} AS quasi_constant
FROM (SELECT {c} AS v, count(*) AS n FROM passengers GROUP BY 1) g""" for c in QC_COLS for t in QC_THRESHOLDS]))
def sel_quasi_constant(spark, sf):
    q = S.quasi_constant(view(spark, sf, "passengers"), QC_COLS, QC_THRESHOLDS, count_null=True)
    return q.select("column_name", "threshold", "top_count", F.col("n").cast("long").alias("n"), r6("top_share").alias("top_share"),
                    "quasi_constant")


# ---------------------------------------------------------------- A18, A32, S7
@query("dq_report", """
SELECT count(*) AS n_rows,
       CAST(coalesce(sum(CAST(isinf(amount) AS INT) + CAST(isinf(oldbalanceOrg) AS INT)
                         + CAST(isinf(oldbalanceDest) AS INT)), 0) AS BIGINT) AS n_infinite,
       CAST(count(*) FILTER (WHERE amount < 0) AS BIGINT) AS n_negative_amount,
       CAST(count(*) FILTER (WHERE oldbalanceOrg < 0 OR oldbalanceDest < 0) AS BIGINT) AS n_negative_balance,
       CAST(count(*) FILTER (WHERE amount IS NULL) AS BIGINT) AS n_missing_amount,
       list_sort(list(DISTINCT isFraud)) AS target_values
FROM txn""")
def dq_report(spark, sf):
    return Q.txn_quality_report(view(spark, sf, "txn"))


@query("dq_report_ratings", """
SELECT (SELECT count(*) FROM ratings) AS n_ratings,
       (SELECT CAST(count(*) FILTER (WHERE rating NOT BETWEEN 1 AND 5) AS BIGINT) FROM ratings) AS n_out_of_range,
       (SELECT count(*) - count(DISTINCT (user_id, item_id)) FROM ratings) AS n_repeated_pairs,
       (SELECT count(*) - count(DISTINCT title) FROM items) AS n_repeated_titles""")
def dq_report_ratings(spark, sf):
    out = Q.ratings_quality_report(view(spark, sf, "ratings"), view(spark, sf, "items"))
    return out.select("n_ratings", F.col("n_out_of_range").cast("long"), F.col("n_repeated_pairs").cast("long"),
                      F.col("n_repeated_titles").cast("long"))


_SPARK_TYPE = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
               "WHEN 'VARCHAR' THEN 'string' ELSE lower(typeof({c})) END")


@query("dq_profile", _union([f"""SELECT count(*) AS n_rows, {i} AS position, '{c}' AS column_name,
       (SELECT {_SPARK_TYPE.format(c=c)} FROM passengers LIMIT 1) AS data_type,
       count(*) FILTER (WHERE {c} IS NOT NULL{' AND NOT isnan(' + c + ')' if c in ('Age', 'Fare') else ''}) AS non_null
FROM passengers""" for i, c in enumerate(PASSENGER_COLS)]))
def dq_profile(spark, sf):
    return Q.profile(view(spark, sf, "passengers"))


@query("src_schema_check", """
SELECT 'amount' AS column_name, true AS present, count(amount) AS non_null FROM txn
UNION ALL SELECT 'oldbalanceOrg', true, count(oldbalanceOrg) FROM txn
UNION ALL SELECT 'newbalanceOrig', false, CAST(NULL AS BIGINT)
UNION ALL SELECT 'type', true, count(type) FROM txn
UNION ALL SELECT 'isFraud', true, count(isFraud) FROM txn
UNION ALL SELECT 'isFlaggedFraud', false, CAST(NULL AS BIGINT)""")
def src_schema_check(spark, sf):
    from tessera.sources.tables import schema_check
    return schema_check(view(spark, sf, "txn"),
                        ["amount", "oldbalanceOrg", "newbalanceOrig", "type", "isFraud", "isFlaggedFraud"])


# ---------------------------------------------------------------- A19-A21
@query("fill_median_mode", """
SELECT PassengerId, coalesce(Age, (SELECT quantile_cont(Age, 0.5) FROM passengers)) AS Age,
       coalesce(Embarked, (SELECT Embarked FROM passengers WHERE Embarked IS NOT NULL
                           GROUP BY Embarked ORDER BY count(*) DESC, Embarked LIMIT 1)) AS Embarked
FROM passengers""")
def fill_median_mode(spark, sf):
    p = view(spark, sf, "passengers").select("PassengerId", "Age", "Embarked")
    return S.fill_median_mode(p, ["Age"], ["Embarked"])


TITLE_SQL = """CASE WHEN t IN ('Lady', 'Countess', 'Capt', 'Col', 'Don', 'Dr', 'Major', 'Rev', 'Sir', 'Jonkheer', 'Dona') THEN 'Rare'
     WHEN t IN ('Mlle', 'Ms') THEN 'Miss' WHEN t = 'Mme' THEN 'Mrs' ELSE t END"""
TITLE_CTE = f"""titled AS (
  SELECT *, {TITLE_SQL} AS Title
  FROM (SELECT *, nullif(trim(regexp_extract(Name, ',\\s*([^.]*)\\.', 1)), '') AS t FROM passengers) x)"""


@query("fill_group_median", f"""
WITH {TITLE_CTE},
gm AS (SELECT Title, quantile_cont(Age, 0.5) AS gmed FROM titled GROUP BY Title)
SELECT PassengerId, titled.Title, coalesce(Age, gmed, (SELECT quantile_cont(Age, 0.5) FROM titled)) AS AgeFilled
FROM titled LEFT JOIN gm ON titled.Title IS NOT DISTINCT FROM gm.Title""")
def fill_group_median(spark, sf):
    p = view(spark, sf, "passengers").withColumn("Title", honorific("Name"))
    return S.fill_group_median(p, "Age", "Title", "AgeFilled").select("PassengerId", "Title", "AgeFilled")


@query("agg_argmax", f"""
WITH {META_SQL}
SELECT item_id, title, rating_count FROM meta ORDER BY rating_count DESC, item_id LIMIT 1""")
def agg_argmax(spark, sf):
    meta = R.item_metadata(view(spark, sf, "items"), Q.clean_ratings(view(spark, sf, "ratings"), RATING_ORDER))
    return S.argmax_row(meta, "rating_count", "item_id", ["item_id", "title", "rating_count"])


# ---------------------------------------------------------------- A22-A24
@query("stat_histogram", """
WITH r AS (SELECT min(bike_count) AS lo, max(bike_count) AS hi FROM rides),
b AS (SELECT CAST(least(floor((bike_count - lo) / ((hi - lo) / 30.0)), 29) AS INT) AS bin, count(*) AS n
      FROM rides, r GROUP BY 1),
g AS (SELECT CAST(range AS INT) AS bin FROM range(30))
SELECT g.bin, round(lo + g.bin * ((hi - lo) / 30.0), 6) AS bin_start,
       round(lo + (g.bin + 1) * ((hi - lo) / 30.0), 6) AS bin_end, coalesce(n, 0) AS count
FROM g CROSS JOIN r LEFT JOIN b ON g.bin = b.bin""")
def stat_histogram(spark, sf):
    h = S.histogram(view(spark, sf, "rides"), "bike_count", 30)
    return h.select("bin", r6("bin_start").alias("bin_start"), r6("bin_end").alias("bin_end"), "count")


@query("stat_histogram_log_by_class", """
WITH x AS (SELECT isFraud, ln(1 + greatest(amount, 0)) AS v FROM txn WHERE amount IS NOT NULL),
r AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
b AS (SELECT isFraud, CAST(least(floor((v - lo) / ((hi - lo) / 40.0)), 39) AS INT) AS bin, count(*) AS n
      FROM x, r GROUP BY 1, 2),
g AS (SELECT DISTINCT isFraud, CAST(range AS INT) AS bin FROM x, range(40))
SELECT g.isFraud, g.bin, round(lo + g.bin * ((hi - lo) / 40.0), 6) AS bin_start,
       round(lo + (g.bin + 1) * ((hi - lo) / 40.0), 6) AS bin_end, coalesce(n, 0) AS count
FROM g CROSS JOIN r LEFT JOIN b ON g.isFraud = b.isFraud AND g.bin = b.bin""")
def stat_histogram_log_by_class(spark, sf):
    t = view(spark, sf, "txn").where(F.col("amount").isNotNull()).withColumn("amount", X.clip("amount", lower=0.0))  # as the features do (X3)
    h = S.histogram(t, "amount", 40, groups=["isFraud"], log1p=True)
    return h.select("isFraud", "bin", r6("bin_start").alias("bin_start"), r6("bin_end").alias("bin_end"), "count")


@query("stat_boxplot", """
WITH q AS (SELECT season, quantile_cont(bike_count, 0.25) AS q1, quantile_cont(bike_count, 0.5) AS median,
                  quantile_cont(bike_count, 0.75) AS q3 FROM rides GROUP BY season)
SELECT r.season, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(bike_count) FILTER (WHERE bike_count BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
       round(max(bike_count) FILTER (WHERE bike_count BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
       CAST(count(*) FILTER (WHERE NOT bike_count BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outside,
       count(*) AS n
FROM rides r JOIN q ON r.season = q.season GROUP BY r.season, q1, median, q3""")
def stat_boxplot(spark, sf):
    b = S.boxplot(view(spark, sf, "rides"), "bike_count", "season")
    return b.select("season", *[r6(c).alias(c) for c in ["q1", "median", "q3", "whisker_low", "whisker_high"]],
                    "n_outside", "n")


@query("stat_kde", """
WITH d AS (SELECT Fare AS x FROM passengers WHERE Fare IS NOT NULL),
st AS (SELECT count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS bw, min(x) AS lo, max(x) AS hi FROM d),
g AS (SELECT CAST(range AS INT) AS i, lo - 3 * bw + (hi + 3 * bw - (lo - 3 * bw)) * range / 199 AS gx FROM st, range(200)),
v AS (SELECT x, count(*) AS c FROM d GROUP BY x)
SELECT i, round(gx, 6) AS x,
       round(sum(c * exp(-0.5 * ((gx - x) / bw) * ((gx - x) / bw))) / (n * bw * sqrt(2 * pi())), 9) AS density
FROM g, v, st GROUP BY i, gx, n, bw""")
def stat_kde(spark, sf):
    k = S.kde(view(spark, sf, "passengers"), "Fare")
    return k.select("i", r6("x").alias("x"), F.round("density", 9).alias("density"))


# ---------------------------------------------------------------- A26-A31
@query("pivot_ratings", """
SELECT user_id, item_id, round(avg(rating), 6) AS rating FROM ratings GROUP BY user_id, item_id""")
def pivot_ratings(spark, sf):
    r = view(spark, sf, "ratings")
    return r.groupBy("user_id", "item_id").agg(r6(F.avg("rating")).alias("rating"))


@query("stat_sparsity", f"""
WITH {CLEAN_SQL}
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
       round(count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 9) AS fill_ratio
FROM clean""")
def stat_sparsity(spark, sf):
    s = S.sparsity(Q.clean_ratings(view(spark, sf, "ratings"), RATING_ORDER))
    return s.withColumn("fill_ratio", F.round("fill_ratio", 9))


@query("agg_genre_counts", """
SELECT genre, count(*) AS count FROM
  (SELECT DISTINCT item_id, unnest(string_split(genres, '|')) AS genre FROM items) g
WHERE genre <> '' GROUP BY genre""")
def agg_genre_counts(spark, sf):
    it = view(spark, sf, "items").select("item_id", F.explode(R.genre_array()).alias("genre"))
    return it.groupBy("genre").agg(F.count(F.lit(1)).alias("count"))


@query("agg_year_counts", f"""
WITH {META_SQL}
SELECT release_year, count(*) AS count FROM meta GROUP BY release_year""")
def agg_year_counts(spark, sf):
    meta = R.item_metadata(view(spark, sf, "items"), Q.clean_ratings(view(spark, sf, "ratings"), RATING_ORDER))
    return meta.groupBy("release_year").agg(F.count(F.lit(1)).alias("count"))


@query("agg_conditional_means", """
SELECT 'fraud' AS condition, round(avg(amount) FILTER (WHERE isFraud = 1), 6) AS mean FROM txn
UNION ALL SELECT 'normal', round(avg(amount) FILTER (WHERE isFraud = 0), 6) FROM txn
UNION ALL SELECT 'transfer', round(avg(amount) FILTER (WHERE type = 'TRANSFER'), 6) FROM txn
UNION ALL SELECT 'night', round(avg(amount) FILTER (WHERE (step - 1) % 24 < 5), 6) FROM txn""")
def agg_conditional_means(spark, sf):
    t = view(spark, sf, "txn")
    m = S.conditional_means(t, "amount", {
        "fraud": F.col("isFraud") == 1, "normal": F.col("isFraud") == 0,
        "transfer": F.col("type") == "TRANSFER", "night": F.pmod(F.col("step") - 1, F.lit(24)) < 5})
    return m.withColumn("mean", r6("mean"))


@query("user_stats", f"""
WITH {CLEAN_SQL}
SELECT user_id, count(*) AS n_ratings, round(avg(rating), 6) AS mean_rating FROM clean GROUP BY user_id""")
def user_stats(spark, sf):
    c = Q.clean_ratings(view(spark, sf, "ratings"), RATING_ORDER)
    return c.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_ratings"), r6(F.avg("rating")).alias("mean_rating"))


@query("prj_select_dtypes", f"SELECT {', '.join(RIDE_NUM)} FROM rides")
def prj_select_dtypes(spark, sf):
    r = view(spark, sf, "rides")
    return r.select(*S.numeric_columns(r))


# ---------------------------------------------------------------- E12
def _findings(df, named: dict):
    agg = df.agg(*[c.alias(f"_f{i}") for i, c in enumerate(named.values())])
    rows = F.array(*[F.struct(F.lit(k).alias("finding"), F.col(f"_f{i}").cast("double").alias("value"))
                     for i, k in enumerate(named)])
    return agg.select(F.inline(rows))


@query("report_findings", """
SELECT 'fraud_rate_transfer_pct' AS finding, round(avg(isFraud) FILTER (WHERE type = 'TRANSFER') * 100, 6) AS value FROM txn
UNION ALL SELECT 'fraud_rate_cash_out_pct', round(avg(isFraud) FILTER (WHERE type = 'CASH_OUT') * 100, 6) FROM txn
UNION ALL SELECT 'fraud_rate_other_pct', round(avg(isFraud) FILTER (WHERE type NOT IN ('TRANSFER', 'CASH_OUT')) * 100, 6) FROM txn
UNION ALL SELECT 'skew_amount', round(skewness(amount), 6) FROM txn
UNION ALL SELECT 'skew_log1p_amount', round(skewness(ln(1 + amount)) FILTER (WHERE amount >= 0), 6) FROM txn
UNION ALL SELECT 'corr_amount_fraud', round(covar_pop(CASE WHEN isFraud IS NOT NULL THEN amount END, CASE WHEN amount IS NOT NULL THEN isFraud END)
      / (stddev_pop(CASE WHEN isFraud IS NOT NULL THEN amount END) * stddev_pop(CASE WHEN amount IS NOT NULL THEN isFraud END)), 6) FROM txn
UNION ALL SELECT 'bike_mean_hour_4', round(avg(bike_count) FILTER (WHERE hour = 4), 6) FROM rides
UNION ALL SELECT 'bike_mean_hour_8', round(avg(bike_count) FILTER (WHERE hour = 8), 6) FROM rides
UNION ALL SELECT 'bike_mean_hour_18', round(avg(bike_count) FILTER (WHERE hour = 18), 6) FROM rides
UNION ALL SELECT 'bike_corr_temperature', round(covar_pop(temperature, bike_count) / (stddev_pop(temperature) * stddev_pop(bike_count)), 6) FROM rides
UNION ALL SELECT 'bike_mean_summer', round(avg(bike_count) FILTER (WHERE season = 'Summer'), 6) FROM rides
UNION ALL SELECT 'bike_mean_winter', round(avg(bike_count) FILTER (WHERE season = 'Winter'), 6) FROM rides
UNION ALL SELECT 'bike_mean_precipitation', round(avg(bike_count) FILTER (WHERE rainfall > 0 OR snowfall > 0), 6) FROM rides
UNION ALL SELECT 'bike_mean_dry', round(avg(bike_count) FILTER (WHERE NOT (rainfall > 0 OR snowfall > 0)), 6) FROM rides""")
def report_findings(spark, sf):
    """The numbers quoted in the reports, computed from the data: one aggregate
    pass per table, unpivoted to (finding, value) (E12)."""
    t = view(spark, sf, "txn")
    r = view(spark, sf, "rides")
    n_amount = F.count("amount").cast("double")
    amt_pos = F.when(F.col("amount") >= 0, F.log1p("amount"))
    tf = _findings(t, {
        "fraud_rate_transfer_pct": F.avg(F.when(F.col("type") == "TRANSFER", F.col("isFraud"))) * 100,
        "fraud_rate_cash_out_pct": F.avg(F.when(F.col("type") == "CASH_OUT", F.col("isFraud"))) * 100,
        "fraud_rate_other_pct": F.avg(F.when(~F.col("type").isin("TRANSFER", "CASH_OUT"), F.col("isFraud"))) * 100,
        "skew_amount": S.unbiased_skew(F.col("amount"), n_amount),
        "skew_log1p_amount": S.unbiased_skew(amt_pos, F.count(amt_pos).cast("double")),
        "corr_amount_fraud": S.safe_corr("amount", "isFraud"),
    })
    wet = (F.col("rainfall") > 0) | (F.col("snowfall") > 0)
    rf = _findings(r, {
        "bike_mean_hour_4": F.avg(F.when(F.col("hour") == 4, F.col("bike_count"))),
        "bike_mean_hour_8": F.avg(F.when(F.col("hour") == 8, F.col("bike_count"))),
        "bike_mean_hour_18": F.avg(F.when(F.col("hour") == 18, F.col("bike_count"))),
        "bike_corr_temperature": S.safe_corr("temperature", "bike_count"),
        "bike_mean_summer": F.avg(F.when(F.col("season") == "Summer", F.col("bike_count"))),
        "bike_mean_winter": F.avg(F.when(F.col("season") == "Winter", F.col("bike_count"))),
        "bike_mean_precipitation": F.avg(F.when(wet, F.col("bike_count"))),
        "bike_mean_dry": F.avg(F.when(~wet, F.col("bike_count"))),
    })
    return tf.unionByName(rf).withColumn("value", r6("value"))
