"""Derived feature tables (X1-X16, M7) for transactions, rides and passengers.

``FraudFeatureEngineer`` is a Spark ML ``Estimator``: ``fit`` computes one
scalar (the large-amount quantile) with the distributed exact quantile, and
the fitted ``FraudFeatureModel`` is pure column expressions, so it saves and
loads inside a ``PipelineModel`` and runs identically in batch and streaming.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import expr as X
from tessera.functions.text import honorific
from tessera.operators.ordered import exact_quantiles, quantile_row

# Fixed values of the transaction features.
TXN_RAW_INPUTS = ["type", "amount", "oldbalanceOrg", "oldbalanceDest", "Hour"]
HOUR_BINS = [-1, 5, 11, 17, 23]
HOUR_LABELS = ["Dawn", "Morning", "Afternoon", "Evening"]
LARGE_TRANSACTION_QUANTILE = 0.95
FRAUD_NUMERIC_FEATURES = [
    "amount", "oldbalanceOrg", "oldbalanceDest", "Hour", "AmountLog", "AmountToSenderBalance",
    "AmountToReceiverBalance", "SenderBalanceAfterEstimated", "ReceiverBalanceAfterEstimated",
    "IsSenderBalanceZero", "IsLargeTransaction", "IsTransfer", "IsCashOut", "BalanceDifference",
]
FRAUD_CATEGORICAL_FEATURES = ["type", "TimeOfDay"]
LEAKAGE_COLUMNS = ["newbalanceOrig", "newbalanceDest", "isFlaggedFraud"]
IDENTIFIER_COLUMNS = ["nameOrig", "nameDest"]

# Fixed values of the ride features.
RIDE_HOUR_LABELS = ["Dawn(0-5)", "Morning(6-11)", "Afternoon(12-17)", "Evening(18-23)"]
TEMP_BINS = [-20, 0, 10, 20, 30, 40]
TEMP_LABELS = ["Freezing(~0)", "Cold(0-10)", "Mild(10-20)", "Warm(20-30)", "Hot(30+)"]
RUSH_HOURS = [7, 8, 17, 18, 19, 20]

# Fixed values of the passenger features.
AGE_BINS = [0, 12, 18, 35, 60, float("inf")]
AGE_LABELS = ["Child", "Teen", "YoungAdult", "Adult", "Senior"]
FARE_LABELS = ["Low", "MidLow", "MidHigh", "High"]


REQUEST_TO_MODEL = {
    "transaction_type": "type", "sender_old_balance": "oldbalanceOrg", "receiver_old_balance": "oldbalanceDest", "transaction_hour": "Hour",
}


def drop_leakage(txn: DataFrame) -> DataFrame:
    """Without the columns that are known only after the event and those that name a party."""
    return txn.drop(*LEAKAGE_COLUMNS, *IDENTIFIER_COLUMNS)


def request_to_model(requests: DataFrame) -> DataFrame:
    """Request fields under the model's column names; other columns stay."""
    return requests.withColumnsRenamed(REQUEST_TO_MODEL)


def with_hour(txn: DataFrame) -> DataFrame:
    """Hour of day from the simulation step."""
    return txn.withColumn("Hour", X.hour_of_step("step"))


class _FraudParams(Params):
    largeTransactionQuantile = Param(Params._dummy(), "largeTransactionQuantile",
                                     "quantile of clipped amounts that marks a large transaction",
                                     typeConverter=TypeConverters.toFloat)
    amountThreshold = Param(Params._dummy(), "amountThreshold", "fitted large-amount threshold",
                            typeConverter=TypeConverters.toFloat)


class FraudFeatureModel(Model, _FraudParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted transformer: raw (type, amount, balances, Hour) -> model features."""

    @keyword_only
    def __init__(self, amountThreshold: float = 0.0, largeTransactionQuantile: float = LARGE_TRANSACTION_QUANTILE):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        thr = float(self.getOrDefault(self.amountThreshold))
        return fraud_features(df, F.lit(thr))


class FraudFeatureEngineer(Estimator, _FraudParams, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator whose fit state is one quantile (M7)."""

    @keyword_only
    def __init__(self, largeTransactionQuantile: float = LARGE_TRANSACTION_QUANTILE):
        super().__init__()
        self._setDefault(largeTransactionQuantile=LARGE_TRANSACTION_QUANTILE)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FraudFeatureModel:
        q = float(self.getOrDefault(self.largeTransactionQuantile))
        row = amount_threshold(df, q).first()  # one fitted scalar reaches the driver
        return FraudFeatureModel(amountThreshold=float(row[0]), largeTransactionQuantile=q)


def amount_threshold(df: DataFrame, q: float = LARGE_TRANSACTION_QUANTILE) -> DataFrame:
    """One row: the q-quantile of clipped, zero-filled amounts (M7 fit, J10)."""
    a = df.select(X.non_negative_or_zero("amount").alias("_a"))
    return quantile_row(a, "_a", [q], ["amount_threshold"])


def fraud_features(df: DataFrame, threshold) -> DataFrame:
    """Transform half of M7 (X1-X3, X5, X6, X11, X12); ``threshold`` is a Column."""
    amount = X.non_negative_or_zero("amount")
    sender = X.non_negative_or_zero("oldbalanceOrg")
    receiver = X.non_negative_or_zero("oldbalanceDest")
    hour = F.coalesce(X.clip(X.parse_number(F.col("Hour").cast("string")), 0, 23), F.lit(0.0)).cast("int")
    t = F.col("type").cast("string")
    base = df.select("*", amount.alias("_amount"), sender.alias("_sender"), receiver.alias("_receiver"),
                     hour.alias("_hour"))
    after_s = F.col("_sender") - F.col("_amount")
    return base.select(
        *[c for c in df.columns if c not in TXN_RAW_INPUTS],
        t.alias("type"),
        F.col("_amount").alias("amount"), F.col("_sender").alias("oldbalanceOrg"),
        F.col("_receiver").alias("oldbalanceDest"), F.col("_hour").alias("Hour"),
        F.log1p("_amount").alias("AmountLog"),
        X.safe_ratio(F.col("_amount"), F.col("_sender")).alias("AmountToSenderBalance"),
        X.safe_ratio(F.col("_amount"), F.col("_receiver")).alias("AmountToReceiverBalance"),
        after_s.alias("SenderBalanceAfterEstimated"),
        (F.col("_receiver") + F.col("_amount")).alias("ReceiverBalanceAfterEstimated"),
        X.flag(after_s <= 0).alias("IsSenderBalanceZero"),
        X.flag(F.col("_amount") > threshold).alias("IsLargeTransaction"),
        X.flag(t == "TRANSFER").alias("IsTransfer"),
        X.flag(t == "CASH_OUT").alias("IsCashOut"),
        (F.col("_sender") - F.col("_receiver")).alias("BalanceDifference"),
        X.right_closed_bins(F.col("_hour"), HOUR_BINS, HOUR_LABELS, include_lowest=True).alias("TimeOfDay"))


def ride_features(rides: DataFrame, severity: bool = True) -> DataFrame:
    """Bike-demand features: hour block, temperature bin, rush hour, precipitation,
    commute, discomfort index, dew-point gap, weather severity (X6, X10-X13, P5)."""
    rush = X.flag(F.col("hour").isin(*RUSH_HOURS))
    precip = X.flag((F.col("rainfall") > 0) | (F.col("snowfall") > 0))
    out = rides.select(
        "*",
        X.right_closed_bins(F.col("hour"), HOUR_BINS, RIDE_HOUR_LABELS).alias("HourBlock"),
        X.right_closed_bins(F.col("temperature"), TEMP_BINS, TEMP_LABELS).alias("TemperatureBin"),
        rush.alias("IsRushHour"), precip.alias("IsPrecipitation"),
        X.flag((rush == 1) & (F.col("holiday") == "No Holiday")).alias("IsCommuteTime"),
        X.discomfort_index().alias("DiscomfortIndex"),
        (F.col("temperature") - F.col("dew_point")).alias("DewPointGap"))
    if not severity:
        return out
    vis = quantile_row(rides, "visibility", [0.25], ["_vis_q25"])
    wind = quantile_row(rides, "wind_speed", [0.75], ["_wind_q75"])
    th = F.broadcast(vis.crossJoin(wind))  # one row
    out = out.crossJoin(th)
    return out.select(
        *out.columns,
        X.flag(F.col("visibility") < F.col("_vis_q25")).alias("IsLowVisibility"),
        X.flag(F.col("wind_speed") > F.col("_wind_q75")).alias("IsStrongWind"),
    ).withColumn("WeatherSeverityScore",
                 F.col("IsPrecipitation") + F.col("IsLowVisibility") + F.col("IsStrongWind")).drop("_vis_q25", "_wind_q75")


def passenger_features(p: DataFrame) -> DataFrame:
    """Title, family size, alone flag, fare per person, cabin flag, ticket group size
    (X14, X15, feat_cabin_ticket)."""
    fam = F.col("SibSp") + F.col("Parch") + 1
    tickets = p.groupBy("Ticket").agg(F.count(F.lit(1)).alias("TicketGroupSize"))
    out = p.select("*", honorific("Name").alias("Title"), fam.alias("FamilySize"),
                   X.flag(fam == 1).alias("IsAlone"),
                   (F.col("Fare") / F.when(fam == 0, 1).otherwise(fam)).alias("FarePerPerson"),
                   X.flag(F.col("Cabin").isNotNull()).alias("HasCabin"))
    return out.join(tickets, "Ticket", "left")


def age_groups(p: DataFrame, age: str = "AgeFilled") -> DataFrame:
    return p.withColumn("AgeGroup", X.right_closed_bins(F.col(age), AGE_BINS, AGE_LABELS, include_lowest=True))


def qcut(df: DataFrame, col: str, labels: list[str], out: str) -> DataFrame:
    """``pd.qcut(q=len(labels), duplicates='drop')``: exact quantile edges, first bin
    closed on the left, duplicate edges merged (X7)."""
    k = len(labels)
    probs = [i / k for i in range(k + 1)]
    q = exact_quantiles(df, col, probs)
    edges = q.agg(F.array_sort(F.collect_list(F.struct("p", "q"))).alias("_e"))  # k+1 rows
    j = df.crossJoin(F.broadcast(edges))
    # distinct edges; bins between consecutive distinct edges keep the first labels
    dedup = F.array_distinct(F.transform("_e", lambda s: s["q"]))
    v = F.col(col)
    idx = F.size(F.filter(dedup, lambda e: e < v))  # number of edges strictly below v
    pos = F.when(v == F.element_at(dedup, 1), F.lit(1)).otherwise(idx)
    n_bins = F.size(dedup) - 1
    lab = F.array(*[F.lit(x) for x in labels])
    res = F.when(v.isNull() | (pos < 1) | (pos > n_bins), F.lit(None)).otherwise(F.element_at(lab, pos))
    return j.withColumn(out, res).drop("_e")
