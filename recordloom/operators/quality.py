"""Admission, references, drift, totals: every refused row is counted with its reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_reason(rows: DataFrame, rules: Sequence[tuple[str, Column]], name: str = "reason") -> DataFrame:
    """Adds the first rule that refuses a row, or null for an admitted one. A null condition doesn't refuse."""
    out = F.lit(None).cast("string")
    for reason, refused in reversed(rules):
        out = F.when(refused, reason).otherwise(out)
    return rows.withColumn(name, out)


def orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows whose reference is complete and names no parent."""
    on = [child[c] == parent[k] for c, k in zip(columns, keys, strict=True)]
    return child.where(" and ".join(f"{c} is not null" for c in columns)).join(parent, on, "left_anti")


def domain_drift(documented: DataFrame, observed: DataFrame) -> DataFrame:
    """Documented and observed values side by side: ``value, state, n``."""
    both = documented.select("value", F.lit(True).alias("known")).join(observed.groupBy("value").agg(F.count("*").alias("n")), "value", "full")
    state = F.when(F.col("known").isNull(), "undocumented").when(F.col("n").isNull(), "unobserved").otherwise("both")
    return both.select("value", state.alias("state"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def profile(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each column: rows, nulls, and exact distinct values, in one pass over the unpivoted columns."""
    long = rows.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))).alias("x")).select("x.*")
    return long.groupBy("column", "value").agg(F.count("*").alias("n")).groupBy("column").agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).cast("long").alias("n_null"), F.count("value").alias("n_distinct"))


def gaps(keys: DataFrame, column: str) -> DataFrame:
    """Missing stretches of an integer sequence: ``gap_start, gap_end``.

    The keys are cut in ranges of a million; each range is ordered by itself, and
    the ranges' ends are compared with each other.
    """
    k = keys.select(F.col(column).cast("long").alias("k")).where("k is not null").distinct().withColumn("part", F.floor(F.col("k") / 1_000_000))
    inner = k.withColumn("next", F.lead("k").over(Window.partitionBy("part").orderBy("k"))).where("next > k + 1").select((F.col("k") + 1).alias("gap_start"), (F.col("next") - 1).alias("gap_end"))
    ends, out = k.groupBy("part").agg(F.min("k").alias("lo"), F.max("k").alias("hi")), inner
    between = lambda rows, w: rows.withColumn("next", F.lead("lo").over(w.orderBy("lo"))).where("next > hi + 1").select((F.col("hi") + 1).alias("gap_start"), (F.col("next") - 1).alias("gap_end"))
    for _ in range(2):  # ranges in ranges of a million, twice: of 64-bit keys some twenty are left
        ends = ends.withColumn("above", F.floor(F.col("part") / 1_000_000))
        out = out.union(between(ends, Window.partitionBy("above")))
        ends = ends.groupBy(F.col("above").alias("part")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    outer = between(ends, Window.partitionBy(F.lit(0)))
    return out.union(outer)


def page_chain_breaks(pages: DataFrame) -> DataFrame:
    """Pages whose cursor is not the one that the page before announced: ``walk, page``."""
    before = F.lag("next_cursor").over(Window.partitionBy("walk").orderBy("page"))
    return pages.withColumn("expected", before).where("page > 0 and not (cursor <=> expected)").select("walk", "page")


def tree_agreement(reference: DataFrame, candidate: DataFrame, by: list[str]) -> DataFrame:
    """Precision, recall and F1 of a candidate's parent links ``(parent, child)`` for each ``by``: ``shared, n_reference, n_candidate`` and the three.

    Repeated links count once. With links on one side only all three are 0; a group
    without any has no row.
    """
    edge = [*by, "parent", "child"]
    both = reference.select(*edge, F.lit(1).alias("r"), F.lit(0).alias("c")).union(candidate.select(*edge, F.lit(0), F.lit(1))).groupBy(*edge).agg(F.max("r").alias("r"), F.max("c").alias("c"))
    n = both.groupBy(*by).agg(F.sum(F.col("r") * F.col("c")).alias("shared"), F.sum("r").alias("n_reference"), F.sum("c").alias("n_candidate"))
    ratio = lambda of: F.when(F.col(of) > 0, F.col("shared") / F.col(of)).otherwise(0.0)
    n = n.withColumn("precision", ratio("n_candidate")).withColumn("recall", ratio("n_reference"))
    total = F.col("n_reference") + F.col("n_candidate")
    return n.withColumn("f1", 2 * F.col("shared") / total)


def unaccounted(blocks: DataFrame, used: DataFrame, unresolved: DataFrame, key: list[str]) -> DataFrame:
    """Blocks that reached neither a node nor an open region, each once: two anti-joins by ``key``."""
    return blocks.select(*key).distinct().join(used.select(*key), key, "left_anti").join(unresolved.select(*key), key, "left_anti")
