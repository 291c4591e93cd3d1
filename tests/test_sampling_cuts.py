"""Splits and samples by hash cuts against sorting; rows beside rows."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import sampling as SM
from tessera.operators.ordered import side_by_side


def rows_with_hash(df, keys, seed):
    return [(r["_h"], *[r[k] for k in keys], r) for r in df.withColumn("_h", SM.hash_key(keys, seed)).collect()]


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_stratified_split_takes_the_smallest_hashes(spark, share):
    rows = [(i, ["a", "b", None][min(i % 7, 2)], i % 50) for i in range(1000)] + [(5000, "lone", 1)]
    df = spark.createDataFrame(rows, "k long, cls string, few long").repartition(5)
    for keys in (["k"], ["few", "k"], ["few"]):  # the last has many equal hashes
        got = SM.stratified_split(df, "cls", keys, share, 3)
        assert got.columns == [*df.columns, "is_test"] and got.count() == len(rows)
        test = {}
        for h, *_, r in rows_with_hash(got, keys, 3):
            test.setdefault(r.cls, []).append((h, r.is_test))
        for own in test.values():
            n = math.ceil(len(own) * share)
            assert sum(t for _, t in own) == n
            assert sorted(h for h, t in own if t) == sorted(h for h, _ in own)[:n]


@pytest.mark.parametrize("n", [0, 1, 10, 399, 400, 401])
def test_smallest_by_hash(spark, n):
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 9).alias("few"))
    for keys in (["k"], ["few"]):
        got = [r[0] for r in rows_with_hash(SM.smallest_by_hash(df, keys, n, 5), keys, 5)]
        assert sorted(got) == sorted(r[0] for r in rows_with_hash(df, keys, 5))[:n]
    assert SM.smallest_by_hash(df.limit(0), ["k"], n, 5).count() == 0


def test_whole_rows_are_not_shuffled(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 2).alias("cls"), F.lit("payload").alias("wide"))
    plan = SM.stratified_split(df, "cls", ["k"])._jdf.queryExecution().executedPlan().toString()
    big = plan.split("Union")[-1].split("Window")[0]
    assert "Exchange hashpartitioning" not in big


def test_side_by_side(spark):
    a = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "x int, s string")
    b = spark.createDataFrame([(9,), (8,)], "y int")
    got = [tuple(r) for r in side_by_side(a, b, [F.col("x")], [F.desc("y")]).orderBy("row").collect()]
    assert got == [(1, 1, "a", 9), (2, 2, "b", 8), (3, 3, "c", None)]
    assert side_by_side(a, b.limit(0), [F.col("x")], [F.col("y")], "inner").count() == 0
    with pytest.raises(ValueError):
        side_by_side(a, a, [F.col("x")], [F.col("x")])


@pytest.mark.parametrize("key", ["sample_keep_positives", "sample_keep_positives_rows", "feat_large_txn"])
def test_passes_do_not_repeat_the_joins(spark, tmp_path, key):
    import __spark_entry__ as entry
    n = 400
    ids = spark.range(n)
    tables = {
        "lineitem": ids.selectExpr("id % 50 as l_orderkey", "cast(id as int) as l_linenumber", "id as l_partkey", "id % 5 as l_suppkey",
                                   "cast(id as double) as l_extendedprice", "cast(id % 50 as double) as l_quantity"),
        "orders": spark.range(50).selectExpr("id as o_orderkey", "id % 7 as o_custkey", "if(id % 2 = 0, '1-URGENT', '5-LOW') as o_orderpriority"),
        "customer": spark.range(7).selectExpr("id as c_custkey", "cast(id as double) as c_acctbal"),
        "supplier": spark.range(5).selectExpr("id as s_suppkey", "cast(id as double) as s_acctbal")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    out = entry.queries()[key](spark, str(tmp_path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_orderkey" not in plan
    assert len(out.collect()) == {"sample_keep_positives": out.count()}.get(key, n)
