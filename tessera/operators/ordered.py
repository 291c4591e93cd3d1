"""Order-dependent aggregates without a single-task window.

A window with no ``partitionBy`` moves every row into one task.  Running totals and ranks
over an order (ROC curves, average precision, popularity ranks) are
instead computed in three distributed steps, one plan at every size:

1. sort the rows into range partitions by ``(groups, value)`` and write them with the
   number of their partition;
2. sum every (group, partition) and prefix-sum those few sums;
3. prefix-sum inside each (group, partition) and add the offset.

Ranges follow the data, so a group with a third of all rows spreads over a third of the
partitions, and no group is joined or gathered by its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage, written


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (group keys may be null)."""
    if not keys:
        return left.crossJoin(right)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def range_parts(df: DataFrame, *order) -> DataFrame:
    """``df`` sorted into range partitions, written, with the partition's number as ``_part``."""
    return cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def running_totals(counts: DataFrame, value: str, sums: list[str], groups: list[str] | None = None) -> DataFrame:
    """Add ``<s>_incl`` (inclusive running sum in ascending ``value`` order) and
    ``<s>_total`` per group for each column in ``sums``.

    ``counts`` must have one row per ``(groups, value)``; ``value`` non-null.
    """
    groups = list(groups or [])
    parts = range_parts(counts, *groups, value)
    per_part = parts.groupBy(*groups, "_part").agg(*[F.sum(s).alias(f"_pt_{s}") for s in sums])
    # one row per group and partition it touches: at most groups + partitions rows
    wg = Window.partitionBy(*groups)
    wp = wg.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        *groups, "_part",
        *[F.coalesce(F.sum(f"_pt_{s}").over(wp), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_pt_{s}").over(wg).alias(f"{s}_total") for s in sums])
    wi = Window.partitionBy(*groups, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    inner = parts.select("*", *[F.sum(s).over(wi).alias(f"_in_{s}") for s in sums])
    return join_null_safe(inner, offsets, [*groups, "_part"]).select(
        *counts.columns,
        *[(F.col(f"_off_{s}") + F.col(f"_in_{s}")).alias(f"{s}_incl") for s in sums],
        *[F.col(f"{s}_total") for s in sums])


def global_rank(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """Add the 1-based position of every row in a global order (ties in any order)."""
    parts = range_parts(df, *order)
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition
    before = F.sum("_n").over(Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_off"))
    inner = parts.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return inner.join(offsets, "_part").select(*df.columns, (F.col("_off") + F.col("_in")).alias(name))


def side_by_side(left: DataFrame, right: DataFrame, left_order: list, right_order: list, how: str = "full") -> DataFrame:
    """Row k of ``left`` beside row k of ``right``, with the place as ``row`` from 1.

    The orders must be total; the frames may not share a column name.  Places come from range partitions, so
    neither frame passes through one task.
    """
    if same := set(left.columns) & set(right.columns):
        raise ValueError(f"columns on both sides: {', '.join(sorted(same))}")
    a, b = global_rank(left, left_order, "row"), global_rank(right, right_order, "row")
    return a.join(b, "row", how)


ACCURACY = 10_000  # of the sketches: a rank is off by n / ACCURACY at most
TAIL = 3.0 / ACCURACY  # half width, in ranks, of the interval whose values are read


def quantile_bounds(df: DataFrame, value: str, probs: list[float], groups: list[str], more: list | None = None, tail: float = TAIL) -> DataFrame:
    """Per group: ``_n`` rows and, for each probability, the interval [a, b] that holds its two ranks; one pass, bounded sketches.

    ``more`` are aggregates over the column ``_x`` that the same pass computes.
    """
    rows = _numbers(df, value, groups)
    shares = [min(max(p + s * tail, 0.0), 1.0) for p in probs for s in (-1, 1)]
    low, high = F.min("_x"), F.max("_x")
    sketch = F.percentile_approx("_x", shares, ACCURACY)
    ends = []
    for k, p in enumerate(probs):
        a = low if shares[2 * k] <= 0 else sketch[2 * k]
        b = high if shares[2 * k + 1] >= 1 else sketch[2 * k + 1]
        ends += [a.alias(f"_a{k}"), b.alias(f"_b{k}")]
    return written(rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), *ends, *(more or [])), "quantile-bounds")


def _numbers(df: DataFrame, value: str, groups: list[str]) -> DataFrame:
    x = F.col(value).cast("double")
    return df.where(x.isNotNull() & ~F.isnan(x)).select(*groups, x.alias("_x"))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], groups: list[str] | None = None,
                    bounds: DataFrame | None = None) -> DataFrame:
    """Linear-interpolated quantiles (pandas / ``quantile_cont`` definition): ``groups..., p, q``.

    Exact in two passes over ``df``, at any scale.  The first takes bounded sketches, which put the two ranks
    around each position into an interval of a few ten-thousandths of the rows.  The second counts the rows
    below each interval and the distinct values inside; only those are shuffled, never all values.  A rank that a
    sketch misplaced is seen by the counts and looked up again in a wider interval.
    ``bounds`` may be a :func:`quantile_bounds` table of the same arguments.
    """
    groups, probs = list(groups or []), [float(p) for p in probs]
    tail, bounds = TAIL, quantile_bounds(df, value, probs, groups) if bounds is None else bounds
    while True:
        out = written(_within(_numbers(df, value, groups), probs, groups, bounds), "quantiles")
        if tail >= 1 or out.where("q is null").isEmpty():
            return out
        tail = min(1.0, 32 * tail)
        bounds = quantile_bounds(df, value, probs, groups, tail=tail)


def _within(rows: DataFrame, probs: list[float], groups: list[str], bounds: DataFrame) -> DataFrame:
    keys = [*groups, "_k"]
    wide = join_null_safe(rows, bounds.select(*groups, "_n", *[f"_{s}{k}" for k in range(len(probs)) for s in "ab"]), groups)
    x = F.col("_x")
    # rows below an interval count as one value below all others
    entry = [F.when(x <= F.col(f"_b{k}"), F.struct(F.lit(k).alias("_k"), F.when(x < F.col(f"_a{k}"), F.lit(float("-inf"))).otherwise(x).alias("_v")))
             for k in range(len(probs))]
    one = wide.select(*groups, "_n", F.explode(F.array(*entry)).alias("_e")).where("_e is not null")
    counts = written(one.groupBy(*groups, F.col("_e._k").alias("_k"), F.col("_e._v").alias("_v")).agg(
        F.count(F.lit(1)).alias("_cnt"), F.max("_n").alias("_n")), "quantile-counts")
    cum = join_null_safe(running_totals(counts.select(*keys, "_v", "_cnt"), "_v", ["_cnt"], keys), counts.select(*keys, "_n").groupBy(*keys).agg(F.max("_n").alias("_n")), keys)
    p = F.get(F.array(*[F.lit(x) for x in probs]), F.col("_k"))
    pos = (F.col("_n") - 1) * p
    at = lambda rank: F.max(F.when((F.col("_cnt_incl") - F.col("_cnt") <= rank) & (rank < F.col("_cnt_incl")), F.col("_v")))
    picked = cum.groupBy(*keys).agg(at(F.floor(pos)).alias("_lo"), at(F.ceil(pos)).alias("_hi"), F.max(pos - F.floor(pos)).alias("_f"))
    between = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.col("_lo") + F.col("_f") * (F.col("_hi") - F.col("_lo")))
    return picked.select(*groups, p.alias("p"), between.alias("q"))


def quantile_row(df: DataFrame, value: str, probs: list[float], names: list[str]) -> DataFrame:
    """One row with one column per probability (global quantiles)."""
    q = exact_quantiles(df, value, probs)
    return q.agg(*[F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(n) for p, n in zip(probs, names)])
