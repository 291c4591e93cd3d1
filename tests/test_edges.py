"""Null, NaN, Inf, empty-table and single-class inputs."""

import math

from pyspark.sql import functions as F

from tessera.functions import expr as X
from tessera.operators import evaluate as E
from tessera.operators import quality as Q
from tessera.operators import stats as S
from tessera.operators.ordered import exact_quantiles


def _xy(spark, rows):
    return spark.createDataFrame(rows, "y int, s double")


def test_empty_table_metrics(spark):
    df = _xy(spark, [])
    assert E.roc_auc(df, "y", "s").first()[0] is None
    assert E.average_precision(df, "y", "s").first()[0] is None
    assert E.confusion(df, "y", "s").agg(F.sum("count")).first()[0] == 0
    assert exact_quantiles(df, "s", [0.5]).count() == 0


def test_single_class_auc_is_null_not_error(spark):
    df = _xy(spark, [(1, 0.2), (1, 0.7), (1, 0.9)])
    assert E.roc_auc(df, "y", "s").first()[0] is None
    m = E.classification_metrics(df, "y", "s", 0.5).first()
    assert m.precision == 1.0 and math.isclose(m.recall, 2 / 3)


def test_nan_and_null_are_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (4.0, "a")], "x double, t string")
    rep = {r.column_name: r.n_missing for r in Q.missing_report(df).collect()}
    assert rep == {"x": 2, "t": 1}
    q = {r.p: r.q for r in exact_quantiles(df, "x", [0.0, 0.5, 1.0]).collect()}
    assert q == {0.0: 1.0, 0.5: 2.5, 1.0: 4.0}


def test_infinity_to_null_then_dropped(spark):
    df = spark.createDataFrame([(1, "PAYMENT", float("inf"), 1.0, 1.0, 0, 0.1),
                                (2, "PAYMENT", 5.0, 1.0, 1.0, 0, 0.1),
                                (3, "PAYMENT", -5.0, 1.0, 1.0, 0, 0.1),
                                (4, "PAYMENT", None, 1.0, 1.0, 0, 0.1)],
                               "k int, type string, amount double, oldbalanceOrg double, oldbalanceDest double, "
                               "isFraud int, score double")
    assert [r.k for r in Q.clean_txn(df).collect()] == [2]
    assert Q.txn_quality_report(df).first().n_infinite == 1


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert S.corr_pairs(df, ["a", "b"]).first().corr is None
    z = {r.column_name: r.zero_variance for r in S.zero_variance(df, ["a", "b"]).collect()}
    assert z == {"a": False, "b": True}


def test_histogram_constant_column_single_bin(spark):
    df = spark.createDataFrame([(7.0,)] * 5, "x double")
    h = {r.bin: r["count"] for r in S.histogram(df, "x", 4).collect()}
    assert h == {0: 5, 1: 0, 2: 0, 3: 0}


def test_safe_ratio_and_bins_edges(spark):
    df = spark.createDataFrame([(None, 0.0, 0), (10.0, -3.0, 5), (float("nan"), 4.0, 6), (3.0, 1.0, 23)],
                               "num double, den double, h int")
    out = df.select(X.safe_ratio("num", "den").alias("r"),
                    X.right_closed_bins(F.col("h"), [-1, 5, 11, 17, 23], ["D", "M", "A", "E"]).alias("b")).collect()
    assert [r.r for r in out] == [0.0, 10.0, 0.0, 1.5]
    assert [r.b for r in out] == ["D", "D", "M", "E"]


def test_resolve_path_and_approx_quantiles(spark, tmp_path):
    import pytest
    from tessera.sources.tables import resolve_path
    existing = str(tmp_path)
    assert resolve_path(spark, [existing + "/nope", existing]) == existing
    with pytest.raises(FileNotFoundError):
        resolve_path(spark, [existing + "/a", existing + "/b"])
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    q = {r.p: r.q for r in S.quantiles(df, ["x"], [0.5], method="approx").collect()}
    assert abs(q[0.5] - 499.5) <= 2


def test_seeded_sample_is_the_smallest_hashes(spark):
    from tessera.operators import sampling as SM
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 7).alias("g"))
    assert SM.smallest_by_hash(df, ["g"], 1234, 7).count() == 1234  # many hash ties
    ids = {r.id for r in SM.smallest_by_hash(df, ["id"], 1500, 3).collect()}
    assert ids == {r.id for r in df.orderBy(SM.hash_key(["id"], 3), "id").limit(1500).collect()}
    assert SM.smallest_by_hash(df, ["id"], 5000, 3).count() == 3000


def test_running_totals_of_a_large_group(spark):
    """One group with most rows spreads over several range partitions."""
    from tessera.operators import ordered as O
    df = spark.range(20000).select(F.when(F.col("id") < 19000, "big").when(F.col("id") < 19900, "small").alias("g"), F.col("id").alias("v"),
                                   (F.col("id") % 5).alias("n")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are too few to fill partitions
    try:
        parts = O.range_parts(df, "g", "v")
        got = O.running_totals(df, "v", ["n"], ["g"])
        ranks = O.global_rank(df, [F.col("v").desc()])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts.where("g = 'big'").select("_part").distinct().count() > 1
    bad = got.where((F.col("g") == "big") & (F.col("n_incl") != F.expr("(v div 5) * 10 + (v % 5) * (v % 5 + 1) div 2")))
    assert got.count() == 20000 and bad.count() == 0
    assert {r.g: r.t for r in got.groupBy("g").agg(F.max("n_total").alias("t")).collect()} == {"big": 38000, "small": 1800, None: 200}
    assert ranks.where(F.col("rank") != 20000 - F.col("v")).count() == 0


def test_user_who_has_seen_almost_everything(spark, monkeypatch):
    """Popular unseen items of a heavy user, with few ranks handed out at a time."""
    from tessera.operators import recommend as R
    monkeypatch.setattr(R, "RANK_CHUNK", 7)
    scored = spark.range(200).select(F.col("id").alias("item_id"), (F.col("id") % 50).cast("double").alias("popularity_score"))
    order = sorted(range(200), key=lambda i: (-(i % 50), i))
    seen = [(1, i) for i in order[:197]] + [(2, order[0]), (2, order[3])]
    ratings = spark.createDataFrame(seen, "user_id int, item_id long")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id int")
    out = {}
    for r in R.popular_unseen(scored, ratings, users, 5).collect():
        out.setdefault(r.user_id, {})[r["rank"]] = r.item_id
    assert [out[1][k] for k in sorted(out[1])] == order[197:]
    assert [out[2][k] for k in range(1, 6)] == [order[k] for k in (1, 2, 4, 5, 6)]
    assert [out[3][k] for k in range(1, 6)] == order[:5]


def test_cf_lists_equal_the_dense_matrix(spark):
    import random

    from tessera.operators import recommend as R
    rnd = random.Random(4)
    n, score = 30, {}
    for i in range(n):
        for j in rnd.sample(range(i + 1, n), min(n - i - 1, rnd.choice([0, 1, 8]))):
            score[i, j] = rnd.choice([-0.5, -0.25, 0.0, 0.25, 0.5])
    elig = spark.range(n).select(F.col("id").alias("item_id"))
    need = elig.select("item_id", (F.col("item_id") % 29 + 1).cast("int").alias("n"))
    both = [(a, b, s) for (i, j), s in score.items() for a, b in ((i, j), (j, i))]
    both = spark.createDataFrame(both, "item_id long, similar_item_id long, score double").join(need, "item_id")
    got = {}
    for r in R.cf_lists(elig, both, need).collect():
        got.setdefault(r.item_id, {})[r["rank"]] = (r.similar_item_id, r.score)
    for i in range(n):
        dense = sorted(((-score.get((min(i, j), max(i, j)), 0.0), j) for j in range(n) if j != i))[:i % 29 + 1]
        assert [got[i][k + 1] for k in range(len(dense))] == [(j, -s) for s, j in dense] and len(got[i]) == len(dense)


def test_first_k_unexcluded(spark):
    """Per user first-k after exclusions equals brute force."""
    import random

    from tessera.operators import recommend as R
    rnd = random.Random(9)
    cands, excl = [], []
    for u in range(6):
        items = rnd.sample(range(100), 40)
        cands += [(u, r + 1, it) for r, it in enumerate(items)]
        excl += [(u, it) for it in rnd.sample(items, 15)]
    c = spark.createDataFrame(cands, "user_id int, rank int, item_id int")
    x = spark.createDataFrame(excl, "user_id int, item_id int")
    want = {}
    for u in range(6):
        ex = {it for uu, it in excl if uu == u}
        want[u] = [it for uu, r, it in sorted(cands) if uu == u and it not in ex][:5]

    def got():
        out = {}
        for r in R.first_k_unexcluded(c, x, 5).collect():
            out.setdefault(r.user_id, []).append((r.rank, r.item_id))
        return {u: [it for _, it in sorted(v)] for u, v in out.items()}

    assert got() == want
