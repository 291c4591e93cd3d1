"""Large joins are dealt over partitions that grow with the input; the rows stay the same."""

import datetime

import pytest
from pyspark.sql import functions as F

from tessera.operators import ml as M
from tessera.operators import sampling as SM
from tessera.plans import QUERIES
from tessera.session import scratch_dir
from tessera.sources import tables as TB


@pytest.fixture
def tables(spark):
    """A few orders with repeated ratings of one user and item."""
    path, day = scratch_dir(spark, "dealt-tables"), datetime.datetime(1997, 5, 1)
    n = 60
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    kinds = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    put("orders", [(i, i % 7, day + datetime.timedelta(days=i), kinds[i % 5]) for i in range(n)],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string")
    put("lineitem", [(i, j, (i * j) % 30, j, float(1 + i % 50), 10.0 * i) for i in range(n) for j in range(1, 4)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double")
    put("customer", [(i, 100.0 * i) for i in range(7)], "c_custkey long, c_acctbal double")
    put("supplier", [(i, 10.0 * i) for i in range(1, 4)], "s_suppkey long, s_acctbal double")
    put("part", [(i, f"a{i % 3} b", i % 9, "t") for i in range(30)], "p_partkey long, p_name string, p_size int, p_type string")
    return path


@pytest.mark.parametrize("key", ["set_union", "popular_unseen"])
def test_dealt_rows_are_the_same(spark, tables, monkeypatch, key):
    whole = sorted(map(tuple, QUERIES[key](spark, tables).collect()))
    monkeypatch.setattr(TB, "TASK_BYTES", 200)
    assert TB.tasks_for(spark, TB.table_bytes(spark, tables, "lineitem")) > spark.sparkContext.defaultParallelism
    assert whole and sorted(map(tuple, QUERIES[key](spark, tables).collect())) == whole


def test_partitions_grow_with_the_bytes(spark):
    cores = spark.sparkContext.defaultParallelism
    assert TB.tasks_for(spark, cores * TB.TASK_BYTES) == 0
    assert TB.tasks_for(spark, 100 * cores * TB.TASK_BYTES) == 100 * cores


def test_union_joins_once(spark, tables):
    """Both branches read the written transactions."""
    plan = QUERIES["set_union"](spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_split_reads_written_rows(spark):
    plan = SM.stratified_split(spark.range(50).withColumn("y", F.col("id") % 2), "y", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan


def test_fraud_fit_equals_its_pipeline(spark):
    rows = [("TRANSFER" if i % 2 else "DEBIT", 10.0 * i, 5.0 * i, 3.0, i % 24, int(i % 4 == 0), 1.0 + i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "type string, amount double, oldbalanceOrg double, oldbalanceDest double, Hour int, isFraud int, weight double")
    lr = M.logistic("isFraud", 80, weight="weight", max_iter=5)
    a, b = M.FraudFit(lr).fit(df).stages[-1], M.fraud_pipeline(lr).fit(df).stages[-1]
    assert abs(a.coefficients.toArray() - b.coefficients.toArray()).max() < 1e-6
