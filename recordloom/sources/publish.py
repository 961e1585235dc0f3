"""Published tables: ordered, partitioned, written once and verified."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.functions.keys import bucket


def publish(rows: DataFrame, path: str, key: Sequence[str], *, buckets: int = 64, files: int | None = None) -> None:
    """Writes ``rows`` by hash bucket of the key, sorted by key in each file; refuses to overwrite and refuses repeated or null keys.

    Tasks hold ranges of (bucket, key), ``files`` of them or as many as shuffles have,
    so a bucket has as many files as its size asks for, each a range of its keys.
    """
    bad = rows.groupBy(*key).count().where(" or ".join(["count > 1", *(f"{k} is null" for k in key)])).limit(1).count()
    if bad:
        raise ValueError(f"{path}: an identity is null or repeated")
    text = F.concat_ws("@", *(F.col(k).cast("string") for k in key))
    dealt = rows.withColumn("bucket", bucket(text, buckets))
    order = ("bucket", *(F.col(k).asc_nulls_last() for k in key))
    dealt = dealt.repartitionByRange(files, *order) if files else dealt.repartitionByRange(*order)
    dealt.sortWithinPartitions("bucket", *(F.col(k).asc_nulls_last() for k in key)).write.mode("error").partitionBy("bucket").option("compression", "zstd").parquet(path)


def verify(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """``bucket, n_rows, n_keys`` of a published table; equal numbers mean unique keys."""
    return spark.read.parquet(path).groupBy("bucket").agg(F.count("*").alias("n_rows"), F.count_distinct(*key).alias("n_keys"))


def lookup(spark: SparkSession, path: str, key: str, value: str, *, buckets: int = 64) -> DataFrame:
    """The row of one identity, read from its bucket alone."""
    return spark.read.parquet(path).where((F.col("bucket") == bucket(F.lit(value), buckets)) & (F.col(key).cast("string") == value))


def order_violations(rows: DataFrame, part: str, key: str) -> DataFrame:
    """Rows whose key isn't above the one before in its part by ``position``."""
    w = Window.partitionBy(part).orderBy("position")
    return rows.withColumn("before", F.lag(key).over(w)).where(F.col(key) <= F.col("before"))
