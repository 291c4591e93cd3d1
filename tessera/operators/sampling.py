"""Row selection, splits and sampling.

Randomness is a seeded hash of the row key (60 bits of its MD5, which any engine can
repeat), so draws are stable under any partitioning and survive task retries
(``randomSplit`` is not).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordered import join_null_safe
from tessera.session import written


def hash_key(cols: list[str], seed: int) -> Column:
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def unit_hash(cols: list[str], seed: int) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) per row key."""
    return F.pmod(hash_key(cols, seed), F.lit(1 << 30)).cast("double") / float(1 << 30)


def scenario_filter(rides: DataFrame) -> DataFrame:
    """Conjunctive scenario filters, tagged and stacked."""
    c = F.col
    scen = {
        "summer_evening": (c("season") == "Summer") & (c("hour") == 18) & (c("rainfall") == 0),
        "winter_morning": (c("season") == "Winter") & (c("hour") == 8),
        "rainy": c("rainfall") > 0,
        "snowy": c("snowfall") > 0,
        "holiday_afternoon": (c("holiday") == "Holiday") & (c("hour") == 14),
        "closed_day": (c("functioning_day") == "No") & (c("season") == "Spring") & (c("rainfall") > 5),
    }
    tagged = F.filter(F.array(*[F.when(cond, F.lit(k)) for k, cond in scen.items()]), lambda x: x.isNotNull())
    # one pass: each row is exploded into the scenarios it matches
    return rides.select(F.explode(tagged).alias("scenario"), *rides.columns)


def one_per_group(df: DataFrame, group: str, key_cols: list[str], seed: int = 42) -> DataFrame:
    """One seeded draw per group (P9): the row with the smallest hash, via a
    partial aggregate (a hot group is reduced map-side)."""
    payload = [c for c in df.columns if c != group]
    best = F.min_by(F.struct(*[F.col(c) for c in payload]), F.struct(hash_key(key_cols, seed), *[F.col(c) for c in key_cols]))
    return df.groupBy(group).agg(best.alias("_r")).select(group, "_r.*")


def seeded_shuffle(df: DataFrame, key_cols: list[str], seed: int = 42) -> DataFrame:
    """Random order with a seed (P10)."""
    return df.orderBy(hash_key(key_cols, seed), *key_cols)


def first_per_class(df: DataFrame, cls: str, classes: list, order: list[str], payload: list[str],
                    defaults: dict, out: list[str]) -> DataFrame:
    """First row of each class by ``order``, or a default row when the class is
    absent (P15)."""
    firsts = df.groupBy(cls).agg(F.min_by(F.struct(*[F.col(c) for c in payload]),
                                          F.struct(*[F.col(c) for c in order])).alias("_r"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(c,) for c in classes], f"{cls} int")
    j = F.broadcast(grid).join(firsts, cls, "left")
    cols = [F.coalesce(F.col(f"_r.{c}"), F.lit(defaults[c])).alias(c) if c in defaults else F.col(f"_r.{c}").alias(c)
            for c in out]
    return j.select(cls, F.col("_r").isNull().alias("is_fallback"), *cols)


def min_positives_check(df: DataFrame, label: str, minimum: int = 10) -> DataFrame:
    """(positives, negatives, ok): refuse to train below ``minimum`` positives."""
    return df.agg(F.sum(label).cast("long").alias("positives"),
                  (F.count(F.lit(1)) - F.sum(label)).cast("long").alias("negatives")).withColumn(
        "ok", F.col("positives") >= minimum)


def align_to_schema(df: DataFrame, trained: list[str], categorical: list[str], keep: list[str] | None = None) -> DataFrame:
    """Columns in trained order: one-hot ``<col>_<value>`` from ``categorical``,
    numeric columns as they are, anything missing as 0, unknown dropped (P12)."""
    exprs = [F.col(c) for c in (keep or [])]
    for name in trained:
        if name in df.columns:
            exprs.append(F.col(name))
            continue
        src = next((c for c in categorical if name.startswith(c + "_")), None)
        if src is not None:
            val = name[len(src) + 1:]
            exprs.append(F.coalesce(F.col(src) == F.lit(val), F.lit(False)).cast("int").alias(name))
        else:
            exprs.append(F.lit(0).alias(name))
    return df.select(*exprs)


def random_split(df: DataFrame, key_cols: list[str], test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: a seeded hash split, stable across partitioning (M8)."""
    return df.withColumn("is_test", unit_hash(key_cols, seed) < test_fraction)


HASH_BITS, BUCKET_BITS = 60, 16


def hash_cuts(hashed: DataFrame, groups: list[str], wanted: Column) -> DataFrame:
    """Per group: the hash ``_cut`` of the row that is the ``wanted``-th by ``_h`` (a Column of the group's rows ``_n``),
    and how many rows of that hash ``_take`` belong to the first ``wanted``.

    Two passes over the hashes alone: counts of 2^16 ranges find the range of that row, and the hashes of this one range
    find the row.  A group of fewer rows has no cut.
    """
    part = F.shiftright("_h", HASH_BITS - BUCKET_BITS)
    ranges = written(hashed.groupBy(*groups, part.alias("_b")).agg(F.count(F.lit(1)).alias("_c")), "hash-ranges")
    every = Window.partitionBy(*groups)
    upto = every.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)  # at most 2^16 rows for a group
    sums = ranges.select(*groups, "_b", "_c", F.sum("_c").over(upto).alias("_upto"), F.sum("_c").over(every).alias("_n"))
    sums = sums.withColumn("_k", wanted.cast("long")).where((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_c") < F.col("_k")))
    found = written(sums.select(*groups, "_b", (F.col("_k") - F.col("_upto") + F.col("_c")).alias("_rest")), "hash-range")  # a row for each group
    inside = join_null_safe(hashed.select(*groups, "_h", part.alias("_b")), found, [*groups, "_b"])
    counts = inside.groupBy(*groups, "_h").agg(F.count(F.lit(1)).alias("_c"), F.max("_rest").alias("_rest"))
    upto = every.orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)  # about 2^-16 of a group's rows
    counts = counts.withColumn("_upto", F.sum("_c").over(upto)).where((F.col("_upto") >= F.col("_rest")) & (F.col("_upto") - F.col("_c") < F.col("_rest")))
    return written(counts.select(*groups, F.col("_h").alias("_cut"), (F.col("_rest") - F.col("_upto") + F.col("_c")).alias("_take")), "hash-cuts")


def _first_by_hash(hashed: DataFrame, groups: list[str], key_cols: list[str], cuts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows off the cut with ``_first``, rows on the cut with ``_first``): is a row among the first of its group?

    Rows keep their place: the cuts are a row for each group.  Only rows that share the hash of a cut are ordered, by key.
    """
    j = join_null_safe(hashed, cuts, groups, "left") if groups else hashed.crossJoin(F.broadcast(cuts))
    on = F.coalesce(F.col("_h") == F.col("_cut"), F.lit(False))
    off = j.where(~on).withColumn("_first", F.coalesce(F.col("_h") < F.col("_cut"), F.lit(False)))
    tie = F.row_number().over(Window.partitionBy(*groups, "_h").orderBy(*key_cols))
    return off, j.where(on).withColumn("_first", tie <= F.col("_take"))


def stratified_split(df: DataFrame, label: str, key_cols: list[str], test_fraction: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Adds ``is_test`` with exactly ceil(test_fraction * n_class) test rows per
    class (M9); a null label is a class.

    The test rows are those with the smallest seeded hashes of their class, so a row is compared with its
    class's cut and whole rows are not shuffled.  Rows and hashes are written first: four passes read them.
    """
    h = written(df.withColumn("_h", hash_key(key_cols, seed)), "split-rows")
    cuts = hash_cuts(h, [label], F.ceil(F.col("_n") * test_fraction))
    off, on = _first_by_hash(h, [label], key_cols, cuts)
    return off.unionByName(on).withColumnRenamed("_first", "is_test").drop("_h", "_cut", "_take")


def smallest_by_hash(df: DataFrame, key_cols: list[str], n: int, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash (ties by key): a seeded sample
    without replacement, exact for any n."""
    h = df.withColumn("_h", hash_key(key_cols, seed))
    cuts = hash_cuts(h, [], F.lit(n))
    if cuts.isEmpty():  # fewer than n rows
        return df if n > 0 else df.limit(0)
    off, on = _first_by_hash(h, [], key_cols, cuts)
    return off.where("_first").unionByName(on.where("_first")).select(*df.columns)


def keep_positives_sample_negatives(df: DataFrame, label: str, key_cols: list[str], n_negatives: int,
                                    seed: int = 42) -> DataFrame:
    """All positive rows plus ``n_negatives`` seeded negatives."""
    pos = df.where(F.col(label) == 1)
    neg = smallest_by_hash(df.where(F.col(label) == 0), key_cols, n_negatives, seed)
    return pos.unionByName(neg)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """'balanced' weights n / (k * n_c) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = counts.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))
    return counts.crossJoin(F.broadcast(tot)).select(
        label, "n_c", (F.col("n") / (F.col("k") * F.col("n_c"))).alias("weight"))


def scale_pos_weight(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives / positives, the weight of a positive row."""
    pos = F.sum((F.col(label) == 1).cast("long"))
    return df.agg(pos.alias("positives"), (F.count(F.lit(1)) - pos).alias("negatives")).withColumn(
        "scale_pos_weight", F.try_divide(F.col("negatives"), F.col("positives").cast("double")))
