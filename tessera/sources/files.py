"""Delimited-text and JSON sources and sinks.

Readers always take an explicit schema (``inferSchema`` costs a full extra
pass and is unstable across files); writers go to the shared folder the
session names (see :func:`tessera.session.scratch_dir`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.session import shuffles_dropped

FILES_AT_ONCE = 200  # buckets of a partitioned table that are shuffled at a time
LEGACY_CHARSETS = "spark.sql.legacy.javaCharsets"


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", encoding: str | None = None,
              null_value: str | None = None) -> str:
    w = df.write.mode("overwrite").option("header", header).option("sep", sep)
    if encoding:
        w = w.option("encoding", encoding)
    if null_value is not None:
        w = w.option("nullValue", null_value)
    with shuffles_dropped(df.sparkSession):
        w.csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, sep: str = ",",
             encoding: str | None = None, null_value: str | None = None) -> DataFrame:
    """CSV with a given schema; legacy charsets (cp949, EUC-KR) need the
    ``spark.sql.legacy.javaCharsets`` flag, which is switched on when asked for."""
    if encoding and encoding.lower() not in ("utf-8", "utf8", "iso-8859-1", "latin1", "us-ascii", "utf-16"):
        spark.conf.set(LEGACY_CHARSETS, "true")
    r = spark.read.schema(schema).option("header", header).option("sep", sep).option("mode", "FAILFAST")
    if encoding:
        r = r.option("encoding", encoding)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    return r.csv(path)


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename every column by position (S3)."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def write_json(df: DataFrame, path: str) -> str:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").json(path)
    return path


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table of ``buckets`` files, each sorted by ``key`` (S12): joins and groups by the key read it without a shuffle.

    The table is entered in the session's catalogue under ``name`` and stored at ``path``.  A hot key makes
    one bucket large; use it for keys whose largest share fits a task.
    """
    with shuffles_dropped(df.sparkSession):
        df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def write_parquet_partitioned(df: DataFrame, path: str, key: str, rows_per_file: int = 1_000_000) -> str:
    """Parquet partitioned by a hash bucket of ``key`` (S12): readers of one key prune to
    one folder.

    The number of buckets follows the number of rows, and a bucket with a hot key is
    written by several tasks.
    """
    from pyspark.sql import functions as F

    from tessera.session import written
    df = written(df, "to-partition")  # Parquet takes a fraction of a checkpoint's disk
    buckets = max(1, -(-df.count() // rows_per_file))
    out = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    largest = out.groupBy("_bucket").count().agg(F.max("count")).first()[0] or 0
    split = F.pmod(F.xxhash64(*df.columns), F.lit(max(1, -(-largest // rows_per_file))))
    lots = -(-buckets // FILES_AT_ONCE)
    for lot in range(lots):  # the shuffle of one lot of buckets goes before the next
        own = out.where(F.col("_bucket") % lots == lot) if lots > 1 else out
        with shuffles_dropped(df.sparkSession):
            own.repartition("_bucket", split).write.mode("append" if lot else "overwrite").partitionBy("_bucket").parquet(path)
    return path
