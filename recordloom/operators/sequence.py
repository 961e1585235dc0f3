"""Order within groups: mentions, intervals, sentences, ladders, qualifiers carried back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A blank after a full stop, question or exclamation mark and before a capital, an opening mark or a digit; not after an initial or a short title.
SENTENCE_BREAK = r"""(?<=[.!?]["')]?)(?<!\b[A-Z]\.)(?<!\b(?:Mr|Ms|Mrs|Dr|No|Sec|Rep|Sen|vs|St)\.)\s+(?=["'(]?[A-Z0-9])"""


def lines(rows: DataFrame, text: str) -> DataFrame:
    """Each line of a text with its number from 0."""
    return rows.select("*", F.posexplode(F.split(text, "\n", -1)).alias("n_line", "line"))


def sentences(rows: DataFrame, text: str) -> DataFrame:
    """Each sentence of a text with its number from 0; white space at the ends is dropped."""
    return rows.select("*", F.posexplode(F.split(F.trim(F.col(text)), SENTENCE_BREAK, -1)).alias("n_sentence", "sentence"))


def blocks(rows: DataFrame, key: str, order: str, is_heading: Column) -> DataFrame:
    """Adds ``block``: how many headings a row of its key stands under; 0 before the first."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("block", F.sum(F.coalesce(is_heading, F.lit(False)).cast("long")).over(w))


def containing(points: DataFrame, intervals: DataFrame, key: str) -> DataFrame:
    """Points ``(key, at, ...)`` with the interval ``(key, begin, end, name)`` that holds them, or a null ``name``.

    Intervals of a key don't overlap and exclude their ends. One sort by key and offset.
    """
    side = points.select(key, F.col("at").alias("__at"), F.struct("*").alias("__point"), F.lit(None).cast("struct<end:bigint,name:string>").alias("__interval"))
    other = intervals.select(key, F.col("begin").alias("__at"), F.lit(None).cast(points.select(F.struct("*")).schema[0].dataType).alias("__point"), F.struct(F.col("end").cast("long").alias("end"), F.col("name").cast("string").alias("name")).alias("__interval"))
    w = Window.partitionBy(key).orderBy("__at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = side.union(other).withColumn("__last", F.last("__interval", ignorenulls=True).over(w)).where("__point is not null")
    return last.select("__point.*", F.when(F.col("__at") < F.col("__last.end"), F.col("__last.name")).alias("name"))


def nearest_mention(rows: DataFrame, key: str, at: str, is_anchor: Column, value: Column) -> DataFrame:
    """Rows that aren't anchors with the ``value`` of the nearest anchor of their key, of equally near ones that after."""
    before = Window.partitionBy(key).orderBy(at).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(key).orderBy(at).rangeBetween(Window.currentRow, Window.unboundedFollowing)
    anchor = F.when(is_anchor, F.struct(F.col(at).alias("at"), value.alias("value")))
    both = rows.withColumn("__before", F.last(anchor, ignorenulls=True).over(before)).withColumn("__after", F.first(anchor, ignorenulls=True).over(after)).where(~is_anchor)
    later = F.col("__before").isNull() | (F.col("__after.at") - F.col(at) <= F.col(at) - F.col("__before.at"))
    return both.withColumn("nearest", F.when(later, F.col("__after.value")).otherwise(F.col("__before.value"))).drop("__before", "__after")


def carried_back(rows: DataFrame, key: str, order: str, value: str, name: str = "carried") -> DataFrame:
    """Adds the row's own value or else the next one that follows in its key."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return rows.withColumn(name, F.first(value, ignorenulls=True).over(w))


def reached_stage(rows: DataFrame, key: str, stage: str, order: Sequence[str], terminal: Sequence[str]) -> DataFrame:
    """``key, stage``: the first terminal stage that the key ever reached, else its latest one that isn't null."""
    seen = rows.where(F.col(stage).isNotNull()).groupBy(key)
    hit = [F.bool_or(F.col(stage) == t).alias(f"__t{i}") for i, t in enumerate(terminal)]
    got = seen.agg(F.max_by(stage, F.struct(*order)).alias("__latest"), *hit)
    return got.select(key, F.coalesce(*(F.when(F.col(f"__t{i}"), t) for i, t in enumerate(terminal)), F.col("__latest")).alias("stage"))


def progress(stage: Column, ladder: Sequence[str]) -> Column:
    """A stage's place on the ladder from 0 to 1; null if it isn't on it."""
    at = F.array_position(F.array(*(F.lit(s) for s in ladder)), stage)
    return F.when(at > 0, (at - 1) / (len(ladder) - 1))


def preferred(options: DataFrame, key: str, option: str, preference: Sequence[str]) -> DataFrame:
    """Each key's option that stands first in ``preference``; keys with none of them are left out."""
    at = F.array_position(F.array(*(F.lit(p) for p in preference)), F.col(option))
    return options.where(at > 0).groupBy(key).agg(F.min_by(option, at).alias(option))
