"""Quantiles by sketch and count, co-moments in one scan, density by linear binning, observed cleaning."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import ordered as O
from tessera.operators import quality as Q
from tessera.operators import stats as S
from tessera.session import scratch_dir

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def columns():
    rng = np.random.default_rng(11)
    n = 20_000
    return {"normal": rng.normal(size=n), "skewed": np.exp(rng.normal(0, 12, n)), "constant": np.full(n, 0.1), "two": rng.integers(0, 2, n).astype(float),
            "outlier": np.concatenate([rng.random(n - 1), [1e300]]), "ends": np.concatenate([np.full(n // 2 + 1, -np.inf), np.full(n // 2 - 1, 7.0)])}


@pytest.fixture(scope="module")
def long(spark):
    rows = [(name, float(v)) for name, values in columns().items() for v in values]
    rows += [(None, 3.0), (None, 5.0), ("normal", None), ("normal", float("nan"))]
    return spark.createDataFrame(rows, "g string, x double").repartition(7).cache()


@pytest.mark.parametrize("accuracy, tail", [(O.ACCURACY, O.TAIL), (50, 0.0)])
def test_quantiles_equal_numpy(long, monkeypatch, accuracy, tail):
    """Also with a sketch so coarse, and an interval so narrow, that ranks must be looked up again."""
    monkeypatch.setattr(O, "ACCURACY", accuracy)
    monkeypatch.setattr(O, "TAIL", tail or 1e-9)
    got = {(r.g, r.p): r.q for r in O.exact_quantiles(long, "x", PROBS, ["g"]).collect()}
    assert len(got) == len(PROBS) * (len(columns()) + 1)
    assert got[None, 0.5] == 4.0
    for name, values in columns().items():
        s = np.sort(values)
        for p in PROBS:
            pos = (len(s) - 1) * p
            lo, hi = s[math.floor(pos)], s[math.ceil(pos)]
            want = lo if lo == hi else lo + (pos - math.floor(pos)) * (hi - lo)
            assert got[name, p] == want or math.isclose(got[name, p], want, rel_tol=1e-12), (name, p)


def test_only_values_near_the_ranks_are_shuffled(long, monkeypatch):
    seen = []
    real = O.written
    monkeypatch.setattr(O, "written", lambda df, name="x": seen.append((name, out := real(df, name))) or out)
    O.exact_quantiles(long.where("g = 'normal'"), "x", [0.5]).collect()
    counts = dict(seen)["quantile-counts"]
    assert counts.count() < 100 and counts.agg(F.sum("_cnt")).first()[0] > 9_000  # the rows below are one of them


def test_describe_equals_numpy(spark, long):
    got = {r.column_name: r for r in S.describe_numeric(long.where("g = 'normal'").withColumn("y", F.col("x") * 2), ["x", "y"]).collect()}
    v = columns()["normal"]
    for name, x in (("x", v), ("y", 2 * v)):
        r = got[name]
        want = (len(x), x.mean(), x.std(ddof=1), x.min(), *np.quantile(x, [0.25, 0.5, 0.75]), x.max())
        assert np.allclose([r["count"], r["mean"], r["std"], r["min"], r.q25, r.q50, r.q75, r["max"]], want, rtol=1e-12, atol=1e-12)


def test_co_moments_of_many_columns_with_offsets_and_nulls(spark):
    rng = np.random.default_rng(2)
    n, d = 3000, 12
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d))
    x[:, 1] += 1e9  # spread of a few units around a billion
    x[:, 2] = 1e9 + x[:, 0] * 1e-3
    x[:, 3] = 0.1
    x[rng.random((n, d)) < 0.1] = np.nan
    x[:, 4] = np.nan
    names = [f"v{k}" for k in range(d)]
    df = spark.createDataFrame([tuple(None if math.isnan(v) and k % 2 else float(v) for k, v in enumerate(r)) for r in x], ", ".join(f"{c} double" for c in names))
    got = {(r.col_a, r.col_b): r["corr"] for r in S.corr_pairs(df.repartition(9), names).collect()}
    assert len(got) == d * (d - 1) // 2
    for i in range(d):
        for j in range(i + 1, d):
            r = got[names[i], names[j]]
            if {i, j} & {3, 4}:
                assert r is None
                continue
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i] - np.median(x[both, i]), x[both, j] - np.median(x[both, j])
            assert abs(r - np.corrcoef(a, b)[0, 1]) < 1e-7, (i, j)
    target = {r.column_name: r["corr"] for r in S.corr_with_target(df, names, "v0").collect()}
    assert math.isclose(target["v5"], got["v0", "v5"], rel_tol=1e-9) and math.isclose(target["v0"], 1.0)


def test_co_moments_read_the_source_once(spark):
    plan = S.co_moments(spark.range(10).select(*[(F.col("id") * k).alias(f"c{k}") for k in range(1, 20)]), [f"c{k}" for k in range(1, 20)], [f"c{k}" for k in range(1, 20)])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Range (") == 1


def test_corr_of_an_empty_table(spark):
    assert [r["corr"] for r in S.corr_pairs(spark.createDataFrame([], "a double, b double"), ["a", "b"]).collect()] == [None]


def test_density_error_is_within_its_bound(spark, monkeypatch):
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(size=800), rng.normal(40, 3, 200), np.zeros(50)])
    df = spark.createDataFrame([(float(a),) for a in v], "x double")
    for cells in (4, 2048):
        monkeypatch.setattr(S, "CELLS", cells)
        got = S.kde(df, "x").collect()
        bw = v.std(ddof=1) * len(v) ** -0.2
        peak = max(r.density for r in got)
        for r in got:
            want = np.exp(-0.5 * ((r.x - v) / bw) ** 2).sum() / (len(v) * bw * math.sqrt(2 * math.pi))
            assert abs(r.density - want) <= max(1 / (8 * cells ** 2) * 1.01 * peak * 3, 1e-14)


def test_cleaning_counts_rows_while_it_writes(spark):
    rows = [(1, "PAYMENT", float("inf"), 1.0, 1.0, 0), (2, "PAYMENT", 5.0, 1.0, 1.0, 0), (2, "PAYMENT", 5.0, 1.0, 1.0, 0), (3, "PAYMENT", -5.0, 1.0, 1.0, 0)]
    df = spark.createDataFrame(rows, "k int, type string, amount double, oldbalanceOrg double, oldbalanceDest double, isFraud int")
    table, summary = Q.clean_observed(df, Q.clean_txn, scratch_dir(spark, "t"))
    assert [r.k for r in table.collect()] == [2]
    assert tuple(summary.first()) == (4, 1, 3)
    table, summary = Q.clean_observed(df.limit(0), Q.clean_txn, scratch_dir(spark, "t"))
    assert table.count() == 0 and tuple(summary.first()) == (0, 0, 0)
