"""Choosing one row for each identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(rows: DataFrame, key: Sequence[str], version: Sequence[Column], ordinal: Sequence[Column]) -> DataFrame:
    """The row of each key with the largest version; of equals the first by ``ordinal``. Null versions come last."""
    order = Window.partitionBy(*key).orderBy(*(v.desc_nulls_last() for v in version), *(o.asc_nulls_last() for o in ordinal))
    return rows.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def version_ties(rows: DataFrame, key: Sequence[str], digest: Column) -> DataFrame:
    """Keys (with version among them) that come with different contents; these can't be chosen from and are refused."""
    return rows.groupBy(*key).agg(F.count("*").alias("n_rows"), F.count_distinct(digest).alias("n_contents")).where("n_contents > 1")


def near_newest(rows: DataFrame, key: Sequence[str], at: Column, digest: Column, margin_s: int) -> DataFrame:
    """Of each key's rows within ``margin_s`` seconds of its newest, the one of the smallest digest."""
    every = rows.withColumn("__at", at).withColumn("__top", F.max("__at").over(Window.partitionBy(*key)))
    near = every.where(F.col("__at") >= F.col("__top") - F.make_dt_interval(secs=F.lit(margin_s))).withColumn("__d", digest)
    return newest(near, key, [F.lit(0)], [F.col("__d")]).drop("__at", "__top", "__d")


def pooled(walks: Sequence[DataFrame], key: Sequence[str], version: Column) -> DataFrame:
    """Repeated walks as one: the newest row of each key, of equals that of the later walk."""
    tagged = [w.withColumn("__walk", F.lit(i)) for i, w in enumerate(walks)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    return newest(out, key, [version, F.col("__walk")], []).drop("__walk")


def merged_by_precedence(rows: DataFrame, key: Sequence[str], rank: Column, date: Column, ordinal: Column) -> DataFrame:
    """The row of the best-ranked source; of one source the newest date; of equals the first."""
    order = Window.partitionBy(*key).orderBy(rank.asc_nulls_last(), date.desc_nulls_last(), ordinal.asc_nulls_last())
    return rows.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def first_with_restatements(rows: DataFrame, key: Sequence[str], ordinal: Sequence[Column], value: str) -> DataFrame:
    """Each key's first value and how many rows state another; one shuffle, no group held in memory."""
    first = F.first(value).over(Window.partitionBy(*key).orderBy(*(o.asc_nulls_last() for o in ordinal)))
    return rows.withColumn("first_value", first).groupBy(*key, "first_value").agg(F.count("*").alias("n_rows"), F.count_if(F.col(value) != F.col("first_value")).alias("n_restated"))
