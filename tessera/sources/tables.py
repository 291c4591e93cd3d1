"""Base-table access, path resolution and header checks."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one base table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Hadoop FileSystem check, so it works for HDFS / object stores too."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it does not exist."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


#: Bytes of Parquet that one task of a sort-merge join takes (about half a million rows of the fact table).
TASK_BYTES = 8 << 20


def table_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Bytes of a base table's files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(path).getLength())


def tasks_for(spark: SparkSession, n_bytes: int) -> int:
    """Partitions that a table of ``n_bytes`` is dealt into by the key of a join, or 0 where the cores take it as it is.

    The planner's number of shuffle partitions does not grow with the data, so a task's sort buffers would.
    """
    n = -(-n_bytes // TASK_BYTES)
    return n if n > spark.sparkContext.defaultParallelism else 0


def dealt(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``df`` in ``n`` partitions by ``keys``; as it is for 0."""
    return df.repartition(n, *keys) if n else df


def table_state(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """Short hash of the files of some tables: names, sizes and times of change.  Results kept under it go stale with the data."""
    jvm, told = spark.sparkContext._jvm, []
    for name in names:
        todo = [jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")]
        while todo:
            at = todo.pop()
            fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            for s in fs.listStatus(at):
                if s.isDirectory():
                    todo.append(s.getPath())
                else:
                    told.append(f"{s.getPath().toString()} {s.getLen()} {s.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(told)).encode()).hexdigest()[:16]


def resolve_path(spark: SparkSession, candidates: list[str]) -> str:
    """First existing path among ``candidates``; otherwise fail listing all of them."""
    for p in candidates:
        if path_exists(spark, p):
            return p
    raise FileNotFoundError("none of these paths exist: " + ", ".join(candidates))


def schema_check(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column: present in ``df``, and its non-null count.

    The counts come from a single aggregate pass; missing columns get null.
    """
    present = [c for c in required if c in df.columns]
    counts = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(present)]
                    or [F.count(F.lit(1)).alias("_n")])
    entries = []
    for c in required:
        if c in df.columns:
            n = F.col(f"n{present.index(c)}")
            entries.append(F.struct(F.lit(c).alias("column_name"), F.lit(True).alias("present"),
                                    n.alias("non_null")))
        else:
            entries.append(F.struct(F.lit(c).alias("column_name"), F.lit(False).alias("present"),
                                    F.lit(None).cast("bigint").alias("non_null")))
    return counts.select(F.inline(F.array(*entries)))


def select_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Continue with the required columns that exist (S7), in the requested order."""
    return df.select(*[c for c in wanted if c in df.columns])


def typed_scan(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Prune to ``types``' columns and cast each one (S1 on an already-open table)."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
