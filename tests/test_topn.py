"""Pruned top-n lists against dense matrices: item CF with heavy users, genre cosine with hot genres."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import recommend as R


def ratings_of(seed, items=60, groups=6, users=150, heavy=1):
    """Users rate within their group of items; heavy users rate everything."""
    rng = random.Random(seed)
    rows = []
    for u in range(users):
        own = [i for i in range(items) if i % groups == u % groups]
        rows += [(u, i, rng.choice([1, 2, 4, 5])) for i in rng.sample(own, rng.randint(3, len(own)))]
    for h in range(heavy):
        rows += [(10_000 + h, i, rng.randint(3, 4)) for i in range(items)]
    return rows


def dense_lists(rows, n):
    users, items = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    m = np.zeros((len(users), len(items)))
    for u in users:
        own = [r for r in rows if r[0] == u]
        mean = sum(r[2] for r in own) / len(own)
        for _, i, v in own:
            m[users.index(u), items.index(i)] = v - mean
    norm = np.linalg.norm(m, axis=0)
    with np.errstate(all="ignore"):
        sim = np.nan_to_num((m.T @ m) / np.outer(norm, norm))
    together = (np.array([[1.0 * any(r[0] == u and r[1] == i for r in rows) for i in items] for u in users]))
    sim[together.T @ together == 0] = 0.0
    return items, sim, {i: sorted(((-round(sim[a, b], 9), j) for b, j in enumerate(items) if j != i))[:n] for a, i in enumerate(items)}


@pytest.mark.parametrize("heavy, limit", [(0, 2000), (1, 20), (3, 20), (2, 7)])
def test_cf_lists_equal_the_dense_matrix(spark, heavy, limit):
    rows, n = ratings_of(heavy, heavy=heavy), 5
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    got = {}
    for r in R.item_cf_topn(df, n, 1, user_limit=limit).collect():
        got.setdefault(r.item_id, {})[r["rank"]] = (round(r.score, 9), r.similar_item_id)
    items, sim, want = dense_lists(rows, n)
    for i in items:
        assert sorted(got[i]) == list(range(1, n + 1))
        for k, (neg, _) in enumerate(want[i], 1):  # rounding may part ties: scores must agree, and items must have them
            assert abs(got[i][k][0] + neg) < 1e-8
            assert abs(sim[items.index(i), items.index(got[i][k][1])] + neg) < 1e-8


def test_a_heavy_user_does_not_make_all_pairs(spark):
    rows = ratings_of(1, items=120, groups=10, users=600, heavy=1)
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    elig = R.eligible_items(df, 1, materialise=True)
    need = elig.select("item_id", F.lit(3).alias("n"))
    made = R.cf_candidates(df, need, elig, user_limit=50).count()
    everything = 2 * R.item_cf_similarity(df, 1).count()  # the heavy user has rated all items
    assert everything == 120 * 119
    assert 120 * 3 <= made < everything / 2


def genre_items(seed, n=300, hot=True):
    rng = random.Random(seed)
    names = [f"g{k}" for k in range(25)]
    out = []
    for i in range(n):
        own = rng.sample(names, rng.choice([0, 1, 2, 3, 5]))
        out.append((i, (["hot"] if hot and i % 7 else []) + own))
    return out


@pytest.mark.parametrize("block", [R.GENRE_BLOCK, 4])
def test_genre_lists_equal_the_dense_matrix(spark, monkeypatch, block):
    monkeypatch.setattr(R, "GENRE_BLOCK", block)
    items, n = genre_items(3), 6
    df = spark.createDataFrame([(i, g, i % 5 != 0) for i, g in items], "item_id long, genres array<string>, is_candidate boolean")
    need = df.select("item_id", (F.col("item_id") % n + 1).cast("int").alias("n"))
    got = {}
    for r in R.content_lists(df, need).collect():
        got.setdefault(r.item_id, {})[r["rank"]] = (r.similar_item_id, round(r.score, 12))
    sets = {i: set(g) for i, g in items}
    for i in sets:
        cos = lambda j: len(sets[i] & sets[j]) / math.sqrt(len(sets[i]) * len(sets[j])) if sets[i] and sets[j] else 0.0  # noqa: B023, E731
        want = sorted(((-round(cos(j), 12), j) for j in sets if j != i and j % 5))[:i % n + 1]
        assert [got[i][k + 1] for k in range(len(want))] == [(j, -s) for s, j in want]


def test_a_hot_genre_is_asked_only_without_rarer_ones(spark, monkeypatch):
    monkeypatch.setattr(R, "GENRE_BLOCK", 10)
    items = genre_items(5)
    keyed = spark.createDataFrame(items, "item_id long, gs array<string>").withColumn("gs", F.array_sort("gs")).withColumn("gk", F.array_join("gs", "|"))
    classes = R._ranked_genres(keyed)
    assert classes.where("array_contains(gs, 'hot') and gs[size - 1] <> 'hot'").count() == 0  # the commonest comes last
    pairs = R.genre_matches(classes.withColumn("m", F.lit(2).cast("long")).withColumn("held", F.lit(1).cast("long")))
    n = classes.count()
    together = sum(1 for a in classes.collect() for b in classes.collect() if set(a.gs) & set(b.gs))
    assert n <= pairs.count() < together / 2


def test_bucketed_ratings_join_without_a_shuffle(spark):
    from tessera.session import scratch_dir
    from tessera.sources import files as FS
    rows = ratings_of(2, items=30, users=80)
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    saved = FS.write_bucketed(df, "ratings_by_user_test", scratch_dir(spark, "bucketed"), "user_id", 4)
    got = {(r.item_i, r.item_j): (r.n_users, r.dot) for r in R.bucketed_dots(saved).collect()}
    plan = R.bucketed_dots(saved)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("SortMergeJoin")  # only the sums by pair
    by_user = {}
    for u, i, v in rows:
        by_user.setdefault(u, {})[i] = v
    want = {}
    for own in by_user.values():
        mean = sum(own.values()) / len(own)
        for i in own:
            for j in own:
                if i < j:
                    n, d = want.get((i, j), (0, 0.0))
                    want[i, j] = n + 1, d + (own[i] - mean) * (own[j] - mean)
    assert set(got) == set(want)
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


def test_only_the_heads_of_lists_leave_the_task_that_makes_the_pairs(spark, monkeypatch):
    rows = ratings_of(4, items=40, users=120)
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    elig = df.select("item_id").distinct()
    need = elig.select("item_id", F.lit(3).alias("n"))
    got = R.cf_candidates(df, need, elig)
    pairs = 2 * R.item_cf_similarity(df, 1).count()
    whole = {(r.item_id, r.rank): (r.similar_item_id, round(r.score, 9)) for r in R.cf_lists(elig, got, need).collect()}
    assert got.count() <= 3 * 40 < pairs / 2
    monkeypatch.setattr(R, "HOT_ITEM", 2)  # every item is dealt over salts, every user over blocks
    monkeypatch.setattr(R, "PAIRS_PER_TASK", 500)
    salted = R.cf_lists(elig, R.cf_candidates(df, need, elig), need)
    assert whole == {(r.item_id, r.rank): (r.similar_item_id, round(r.score, 9)) for r in salted.collect()}
    assert pairs == 2 * R.item_cf_similarity(df, 1, user_limit=3).count()


def test_similarity_takes_all_items_of_twenty_ratings(spark):
    """The key's floor is the reference's 20 ratings, not the hybrid's 30."""
    import datetime

    from tessera.plans import QUERIES
    from tessera.session import scratch_dir
    path, day = scratch_dir(spark, "floor-tables"), datetime.datetime(1997, 5, 1)
    raters = {1: range(20), 2: range(5, 30), 3: range(31), 4: range(19)}  # 20, 25, 31 and 19 ratings
    lines = [(u, i, 1, 1, float((u * i + i) % 5), 10.0) for i, us in raters.items() for u in us]
    spark.createDataFrame([(u, u, day) for u in range(31)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double").write.parquet(f"{path}/lineitem.parquet")
    got = {(r.item_i, r.item_j) for r in QUERIES["item_cf_similarity"](spark, path).collect()}
    assert got == {(1, 2), (1, 3), (2, 3)}


def test_heads_are_made_in_lots(spark, monkeypatch):
    """Lots of items give the same lists; each lot is a write of its own."""
    rows = ratings_of(6, items=40, users=120, heavy=0)
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    lists = lambda: {(r.item_id, r["rank"]): (r.similar_item_id, round(r.score, 9)) for r in R.item_cf_topn(df, 3, 1).collect()}
    whole, names, written = lists(), [], R.written
    monkeypatch.setattr(R, "PAIRS_PER_TASK", 100)
    monkeypatch.setattr(R, "PARTS_AT_ONCE", 10, raising=False)
    monkeypatch.setattr(R, "written", lambda rows, name: names.append(name) or written(rows, name))
    assert lists() == whole and names.count("cf-heads") > 1


@pytest.mark.parametrize("shift, kind", [(0, "int"), (1 << 40, "int"), (0, "double")])
def test_pairs_of_narrow_and_wide_numbers(spark, tmp_path, shift, kind):
    """Ids and ratings are shuffled in the narrowest type; what comes back has the ids' own type."""
    rows = ratings_of(7, items=20, users=40, heavy=0)
    df = spark.createDataFrame([(u, i + shift, v + (0.25 if kind == "double" else 0)) for u, i, v in rows], f"user_id long, item_id long, rating {kind}")
    narrow = R._narrowed(df, "item_id", "rating").dtypes
    assert dict(narrow) == {"user_id": "bigint", "item_id": "bigint" if shift else "tinyint", "rating": "tinyint" if kind == "int" else "double"}
    _, sim, _ = dense_lists(rows, 3)
    got = R.item_cf_similarity(df, 1)
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "double"]
    items = sorted({r[1] for r in rows})
    for r in got.collect():
        assert abs(sim[items.index(r.item_i - shift), items.index(r.item_j - shift)] - r.similarity) < 1e-9


def test_partitioned_tables_are_written_in_lots(spark, monkeypatch):
    from tessera.session import scratch_dir
    from tessera.sources import files as FS
    monkeypatch.setattr(FS, "FILES_AT_ONCE", 3, raising=False)
    df = spark.range(1000).withColumn("k", F.col("id") % 70)
    back = spark.read.parquet(FS.write_parquet_partitioned(df, scratch_dir(spark, "lots"), "k", rows_per_file=100))
    assert sorted(r.id for r in back.collect()) == list(range(1000)) and back.select("_bucket").distinct().count() == 10
