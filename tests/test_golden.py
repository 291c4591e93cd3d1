"""Golden cases from the reference's own examples, and properties."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import expr as X
from tessera.functions.text import honorific, split_title_year_cols
from tessera.operators import evaluate as E
from tessera.operators import recommend as R
from tessera.operators import sampling as SM
from tessera.operators import stats as S
from tessera.operators.ordered import exact_quantiles


def test_title_year_split(spark):
    df = spark.createDataFrame([("Toy Story (1995)",), ("unknown",),
                                ("Land Before Time III: The Time of the Great Giving (1995) (V)",)], "title string")
    clean, year = split_title_year_cols("title")
    got = [tuple(r) for r in df.select(clean, year).collect()]
    assert got == [("Toy Story", 1995), ("unknown", None),
                   ("Land Before Time III: The Time of the Great Giving", 1995)]


def test_honorific(spark):
    df = spark.createDataFrame([("Braund, Mr. Owen",), ("Smith, Mlle. Ann",), ("Doe, Dr. X",), ("NoTitle",)], "Name string")
    assert [r[0] for r in df.select(honorific("Name")).collect()] == ["Mr", "Miss", "Rare", None]


def _toy_ratings(spark):
    # toy rating matrix (item, user, rating): items A-D = 1-4, users 1-3
    rows = [(1, 1, 5), (1, 2, 4), (2, 1, 4), (2, 3, 2), (3, 2, 5), (3, 3, 1), (4, 1, 1), (4, 2, 2), (4, 3, 5)]
    return spark.createDataFrame([(u, i, r) for i, u, r in rows], "user_id long, item_id long, rating int")


def test_item_cf_toy_matches_dense(spark):
    df = _toy_ratings(spark)
    got = {(r.item_i, r.item_j): r.similarity for r in R.item_cf_similarity(df, min_ratings=1).collect()}
    M = np.full((3, 4), np.nan)
    for r in df.collect():
        M[r.user_id - 1, r.item_id - 1] = r.rating
    C = np.nan_to_num(M - np.nanmean(M, axis=1, keepdims=True))
    n = np.linalg.norm(C, axis=0)
    for (i, j), s in got.items():
        want = C[:, i - 1] @ C[:, j - 1] / (n[i - 1] * n[j - 1])
        assert abs(s - want) < 1e-12
        assert -1 - 1e-12 <= s <= 1 + 1e-12


def test_item_cf_topn_pads_with_zero_items(spark):
    df = _toy_ratings(spark)
    top = R.item_cf_topn(df, n=3, min_ratings=1).collect()
    per = {}
    for r in top:
        per.setdefault(r.item_id, []).append((r.rank, r.similar_item_id, r.score))
    assert all(len(v) == 3 for v in per.values())


def test_risk_rules_demo_transactions(spark):
    rows = [("PAYMENT", 9839.64, 170136.0, 0.0, 10), ("TRANSFER", 181000.0, 181000.0, 0.0, 2)]
    df = spark.createDataFrame(rows, "transaction_type string, amount double, sender_old_balance double, "
                                     "receiver_old_balance double, transaction_hour int").withColumn(
        "amount_threshold", F.lit(100000.0))
    got = [r[0] for r in df.select(X.risk_factors()).collect()]
    assert got[0] == [X.RISK_MESSAGES[4]]
    assert got[1] == [X.RISK_MESSAGES[1], X.RISK_MESSAGES[2], X.RISK_MESSAGES[4], X.RISK_MESSAGES[5], X.RISK_MESSAGES[6]]


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(7)
    vals = [float(rnd.randint(0, 50)) for _ in range(500)] + [rnd.random() for _ in range(300)]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(vals)], "x double, g int")
    probs = [0.0, 0.05, 0.25, 0.5, 0.6, 0.95, 1.0]
    q = {r.p: r.q for r in exact_quantiles(df, "x", probs).collect()}
    for p in probs:
        assert math.isclose(q[p], float(np.quantile(vals, p)), rel_tol=1e-12, abs_tol=1e-12)
    qg = {(r.g, r.p): r.q for r in exact_quantiles(df, "x", probs, ["g"]).collect()}
    for g in range(3):
        sub = [v for i, v in enumerate(vals) if i % 3 == g]
        for p in probs:
            assert math.isclose(qg[(g, p)], float(np.quantile(sub, p)), rel_tol=1e-12, abs_tol=1e-12)


def test_roc_auc_equals_pair_count(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, s double")
    auc = E.roc_auc(df, "y", "s").first()[0]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(auc - brute) < 1e-12


def test_average_precision_brute(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "y int, s double")
    ap = E.average_precision(df, "y", "s").first()[0]
    P = sum(y for y, _ in rows)
    want, prev_r = 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, s in rows if y == 1 and s >= t)
        fp = sum(1 for y, s in rows if y == 0 and s >= t)
        r = tp / P
        want += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    assert abs(ap - want) < 1e-12


def test_histogram_and_confusion_sum_to_n(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 37).cast("double").alias("x"),
                                  (F.col("id") % 2).cast("int").alias("y"), ((F.col("id") % 10) / 10).alias("s"))
    assert S.histogram(df, "x", 30).agg(F.sum("count")).first()[0] == 1000
    assert E.confusion(df, "y", "s").agg(F.sum("count")).first()[0] == 1000


def test_stratified_split_exact_and_disjoint(spark):
    df = spark.range(1003).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    s = SM.stratified_split(df, "y", ["id"], 0.2, 42)
    counts = {(r.y, r.is_test): r.n for r in s.groupBy("y", "is_test").agg(F.count("*").alias("n")).collect()}
    n1 = 251
    assert counts[(1, True)] == math.ceil(0.2 * n1)
    assert counts[(0, True)] == math.ceil(0.2 * (1003 - n1))
    assert s.select("id").distinct().count() == 1003


def test_content_topn_matches_bruteforce(spark):
    rnd = random.Random(11)
    vocab = [f"g{i}" for i in range(6)]
    items = [(i, "|".join(rnd.sample(vocab, rnd.randint(0, 3)))) for i in range(1, 60)]
    meta = spark.createDataFrame(items, "item_id long, genres string").select(
        "item_id", R.genre_array().alias("genres"), F.lit(0).alias("rating_count"))
    got = {(r.item_id, r.rank): (r.similar_item_id, r.score) for r in R.content_topn(meta, 5).collect()}
    sets = {i: set(g.split("|")) - {""} for i, g in items}
    for i in sets:
        cands = []
        for j in sets:
            if j == i:
                continue
            d = math.sqrt(len(sets[i]) * len(sets[j]))
            cands.append((-(len(sets[i] & sets[j]) / d if d else 0.0), j))
        cands.sort()
        for k, (neg, j) in enumerate(cands[:5], start=1):
            assert got[(i, k)][0] == j
            assert abs(got[(i, k)][1] + neg) < 1e-12


def test_item_cf_salted_equals_unsalted(spark):
    """Splitting heavy users over block-pair keys does not change any similarity."""
    from tests.conftest import SF_SMALL
    from tessera.sources.fixtures import RATING_ORDER, view
    c = R.clean_ratings(view(spark, SF_SMALL, "ratings"), RATING_ORDER)
    a = {(r.item_i, r.item_j): r.similarity for r in R.item_cf_similarity(c, 5).collect()}
    b = {(r.item_i, r.item_j): r.similarity for r in R.item_cf_similarity(c, 5, user_limit=2).collect()}
    assert set(a) == set(b) and len(a) > 0
    assert max(abs(a[k] - b[k]) for k in a) < 1e-12
