"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_dir

WHITE = r"[ \t\n\x0B\f\r]+"


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared scratch folder, in folders ``by`` columns, and read it back.

    The written table cuts the lineage and survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8_size(text: str = "text") -> Column:
    """UTF-8 bytes of a text; null counts 0."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")


def pack(df: DataFrame, *named: Column) -> DataFrame:
    """The whole row as one struct ``_row`` beside ``named`` columns, so no input column can clash with a working column."""
    return df.select(F.struct("*").alias("_row"), *named)
