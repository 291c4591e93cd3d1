"""Data quality: missing values, duplicates, cleaning, profiles, row validation.

A5-A8, A18, A32, P6-P8, P13.  Every report is one aggregate pass followed by
an unpivot (``inline`` of an array of structs), never a job per column.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.tables import dealt


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def is_missing(df: DataFrame, c: str) -> Column:
    """pandas ``isnull``: null, and NaN for floating columns."""
    col = F.col(c)
    return (col.isNull() | F.isnan(col)) if _is_float(df, c) else col.isNull()


def missing_report(df: DataFrame, cols: list[str] | None = None, digits: int = 2) -> DataFrame:
    """(column_name, n_missing, pct_missing) for every column, one pass (A5)."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(is_missing(df, c).cast("long")).alias(f"_m{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("n_missing"))
                     for i, c in enumerate(cols)])
    out = agg.select("_n", F.inline(rows))
    return out.select("column_name", F.coalesce("n_missing", F.lit(0)).alias("n_missing"),
                      F.round(F.try_divide(F.col("n_missing") * 100.0, F.col("_n")), digits).alias("pct_missing"))


def duplicate_counts(df: DataFrame, subsets: dict[str, list[str]]) -> DataFrame:
    """(subset, n_rows, n_duplicates): rows minus distinct key groups.

    Each subset is a map-side-combined ``groupBy(key).count()``; the hot-key
    case collapses to one row per partition before the shuffle.
    """
    parts = []
    for name, keys in subsets.items():
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
        parts.append(g.agg(F.lit(name).alias("subset"), F.sum("_c").alias("n_rows"),
                           (F.sum("_c") - F.count(F.lit(1))).alias("n_duplicates")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order`` (pandas ``keep='last'`` with a
    stated order) (A7).

    ``max(struct(order, payload))`` is a partial aggregate, so a key holding a
    third of all rows is reduced map-side, not in one window task.
    """
    payload = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(F.struct(*[F.col(c) for c in order]).alias("o"),
                          F.struct(*[F.col(c) for c in payload]).alias("p"))).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.p.*").select(*df.columns)


def duplicate_members(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once (``keep=False``)."""
    dup_keys = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").drop("_c")
    return df.join(dup_keys, keys, "left_semi")


def clean_ratings(ratings: DataFrame, order: list[str] | None = None, parts: int = 0) -> DataFrame:
    """Drop repeated (user, item) ratings keeping the last by ``order`` (default: latest, then highest), then keep 1..5.

    ``parts``: partitions for tables whose share of the planner's shuffle partitions would be too large for a task.
    """
    dedup = keep_last(dealt(ratings, parts, "user_id", "item_id"), ["user_id", "item_id"], order or ["rated_at", "rating"])
    return dedup.where(F.col("rating").between(1, 5))


def inf_to_null(c: str) -> Column:
    """NaN and +-Infinity become null."""
    col = F.col(c)
    return F.when(F.isnan(col) | (F.abs(col) == float("inf")), F.lit(None).cast("double")).otherwise(col)


TXN_NUMERIC = ["amount", "oldbalanceOrg", "oldbalanceDest"]


def clean_txn(txn: DataFrame) -> DataFrame:
    """Whole-row dedupe, Inf -> null, drop nulls in model columns, drop negative amounts."""
    d = txn.dropDuplicates()
    d = d.select(*[inf_to_null(c).alias(c) if c in TXN_NUMERIC else F.col(c) for c in d.columns])
    d = d.na.drop(subset=[c for c in TXN_NUMERIC + ["type", "isFraud"] if c in d.columns])
    return d.where(F.col("amount") >= 0)


def clean_observed(df: DataFrame, clean, path: str) -> tuple[DataFrame, DataFrame]:
    """Write ``clean(df)`` to ``path`` and count the rows that go in and out on the way (P8): one read of the source.

    Returns the written table and one row (rows_before, rows_after, rows_removed).
    """
    before, after = Observation(), Observation()
    n = F.count(F.lit(1)).alias("n")
    out = clean(df.observe(before, n)).observe(after, n)
    out.write.parquet(path)
    spark = df.sparkSession
    table = spark.read.schema(out.schema).parquet(path)
    rows = _observed(before, df), _observed(after, table)
    return table, spark.createDataFrame([(*rows, rows[0] - rows[1])], "rows_before long, rows_after long, rows_removed long")


def _observed(observation: Observation, rows: DataFrame) -> int:
    """The observed count, or a count of ``rows`` where the optimizer removed the observed node (nothing reached it)."""
    try:
        return observation.get["n"]
    except (Py4JJavaError, KeyError):
        return rows.count()


def txn_quality_report(txn: DataFrame) -> DataFrame:
    """Counters of A18 for the transaction table, one pass."""
    num = [c for c in TXN_NUMERIC if c in txn.columns]
    inf = sum((F.abs(F.col(c)) == float("inf")).cast("long") for c in num)
    return txn.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.coalesce(inf, F.lit(0))).alias("n_infinite"),
        F.sum((F.col("amount") < 0).cast("long")).alias("n_negative_amount"),
        F.sum(((F.col("oldbalanceOrg") < 0) | (F.col("oldbalanceDest") < 0)).cast("long")).alias("n_negative_balance"),
        F.sum(F.col("amount").isNull().cast("long")).alias("n_missing_amount"),
        F.array_sort(F.collect_set("isFraud")).alias("target_values"))


def ratings_quality_report(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Counters of A18 for ratings: repeats of (user, item), out-of-range, repeated titles."""
    pairs = ratings.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("_c"))
    r = ratings.agg(F.count(F.lit(1)).alias("n_ratings"),
                    F.sum((~F.col("rating").between(1, 5)).cast("long")).alias("n_out_of_range"))
    p = pairs.agg((F.sum("_c") - F.count(F.lit(1))).alias("n_repeated_pairs"))
    t = items.groupBy("title").agg(F.count(F.lit(1)).alias("_c")).agg(
        (F.sum("_c") - F.count(F.lit(1))).alias("n_repeated_titles"))
    return r.crossJoin(p).crossJoin(t)


def profile(df: DataFrame) -> DataFrame:
    """``info()``: (column_name, data_type, non_null, n_rows), one pass."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count(F.when(~is_missing(df, c), F.lit(1))).alias(f"_c{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                              F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                              F.col(f"_c{i}").alias("non_null")) for i, c in enumerate(cols)])
    return agg.select("n_rows", F.inline(rows))


def validate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``failed_rules`` (names of violated rules, in rule order) and ``is_valid``.

    A rule is a boolean Column that must hold; null counts as a failure.
    """
    failed = F.filter(F.array(*[F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]),
                      lambda x: x.isNotNull())
    return df.withColumn("failed_rules", failed).withColumn("is_valid", F.size("failed_rules") == 0)


TXN_TYPES = ["CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER"]


def txn_request_rules() -> dict[str, Column]:
    """Request rules of the scoring service: allowed type, non-negative money, hour 0-23."""
    return {
        "type_allowed": F.col("transaction_type").isin(*TXN_TYPES),
        "amount_non_negative": F.col("amount") >= 0,
        "sender_balance_non_negative": F.col("sender_old_balance") >= 0,
        "receiver_balance_non_negative": F.col("receiver_old_balance") >= 0,
        "hour_in_range": F.col("transaction_hour").between(0, 23),
    }
