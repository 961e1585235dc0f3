"""Linking records: tiers of keys, nearest before, windows of time, intervals, token sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.text import jaccard

#: Rows of one token that meet its queries in one task, about.
BLOCK = 4096


def tiers(left: DataFrame, right: DataFrame, left_id: str, right_id: str, keys: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Pairs that share a key, with the best (first) tier on which they do: ``left_id, right_id, tier``.

    One equi-join for each tier; null keys link nothing.
    """
    out = None
    for i, (_, a, b) in enumerate(keys):
        found = left.select(F.col(left_id), a.alias("k")).join(right.select(F.col(right_id), b.alias("k")), "k").select(left_id, right_id, F.lit(i).alias("i"))
        out = found if out is None else out.union(found)
    names = F.array(*(F.lit(n) for n, _, _ in keys))
    return out.groupBy(left_id, right_id).agg(F.min("i").alias("i")).select(left_id, right_id, names[F.col("i")].alias("tier"))


def best_tier(left: DataFrame, right: DataFrame, left_id: str, right_id: str, keys: Sequence[tuple[str, Column, Column]], *, others: bool = False) -> DataFrame:
    """Pairs of each left row's best tier only, the first on which it meets any right row: ``left_id, right_id, tier``.

    Rows that have met go before the next, weaker key is joined, so a weak key never
    pairs rows that a strong one has linked. ``others`` leaves out the row's own id.
    """
    out, rest = None, left
    for name, a, b in keys:
        found = rest.select(F.col(left_id), a.alias("k")).join(right.select(F.col(right_id), b.alias("k")), "k").select(left_id, right_id, F.lit(name).alias("tier"))
        found = found.where(F.col(left_id) != F.col(right_id)) if others else found
        out = found if out is None else out.union(found)
        rest = rest.join(found.select(left_id).distinct(), left_id, "left_anti")
    return out


def last_before(events: DataFrame, key: str, at: Column, is_left: Column, is_right: Column, right_value: Column) -> DataFrame:
    """Each left row with the value of the last right row strictly before it, in one sort by key (an as-of join)."""
    w = Window.partitionBy(key).orderBy(at).rangeBetween(Window.unboundedPreceding, -1)
    return events.withColumn("last_right", F.last(F.when(is_right, right_value), ignorenulls=True).over(w)).where(is_left)


def within(left: DataFrame, right: DataFrame, key: str, at: str, seconds: int) -> DataFrame:
    """Pairs of a key whose times lie at most ``seconds`` apart: ``l_id, r_id``.

    Inputs have ``id``, ``key`` and ``at`` in whole seconds. Times are cut in
    stretches of that length; the right side is replicated to three stretches, so
    only neighbours meet in the equi-join.
    """
    stretch = F.floor(F.col(at) / max(1, seconds))
    a = left.select(F.col("id").alias("l_id"), key, F.col(at).alias("l_at"), stretch.alias("s"))
    b = right.select(F.col("id").alias("r_id"), key, F.col(at).alias("r_at"), F.explode(F.sequence(stretch - 1, stretch + 1)).alias("s"))
    return a.join(b, [key, "s"]).where(F.abs(F.col("l_at") - F.col("r_at")) <= seconds).select("l_id", "r_id")


def consecutive(rows: DataFrame, key: str, order: Sequence[Column], value: str) -> DataFrame:
    """Each row's value with the next one of its key."""
    return rows.withColumn("next_value", F.lead(value).over(Window.partitionBy(key).orderBy(*order))).where("next_value is not null")


def islands(rows: DataFrame, key: str, at: Column, gap: int) -> DataFrame:
    """Groups of a key's rows of which neighbours lie at most ``gap`` seconds apart: ``key, n_island, start, end, n``."""
    w = Window.partitionBy(key).orderBy("__at")
    cut = rows.withColumn("__at", at).withColumn("__new", (F.col("__at") - F.lag("__at").over(w) > gap).cast("int"))
    numbered = cut.withColumn("n_island", F.sum(F.coalesce("__new", F.lit(0))).over(w.rangeBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "n_island").agg(F.min("__at").alias("start_s"), F.max("__at").alias("end_s"), F.count("*").alias("n"))


def pairs_by_tokens(queries: DataFrame, rows: DataFrame, *, least: float) -> DataFrame:
    """All pairs whose token sets have a Jaccard of at least ``least``: ``q_id, r_id, score``.

    Inputs are ``(id, tokens)`` with distinct tokens. Only pairs that share a token
    of the prefix that any pair of that score must share meet (rarest tokens first),
    if their sizes and the tokens behind the shared one leave the score possible. The
    rows of a token that many have are dealt into blocks of some ``BLOCK``.
    """
    both = queries.select("tokens").union(rows.select("tokens"))
    df = both.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("df"))

    def prefixes(side: DataFrame, name: str, at: str) -> DataFrame:
        long = side.select(F.col("id").alias(name), F.size("tokens").alias(f"{at}_size"), F.explode("tokens").alias("t")).join(df, "t")
        w = Window.partitionBy(name).orderBy("df", "t")
        size = F.col(f"{at}_size")
        return long.withColumn(at, F.row_number().over(w)).where(F.col(at) <= size - F.ceil(size * least) + 1).withColumn("blocks", F.ceil(F.col("df") / BLOCK)).drop("df")

    q = prefixes(queries, "q_id", "i").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    r = prefixes(rows, "r_id", "j").withColumn("block", F.pmod(F.xxhash64("r_id"), F.col("blocks"))).drop("blocks")
    m, n = F.col("i_size"), F.col("j_size")
    can = (F.least(m, n) >= F.greatest(m, n) * least - 1e-9) & ((1 + F.least(m - F.col("i"), n - F.col("j")) + F.least("i", "j") - 1) * (1 + least) >= (m + n) * least - 1e-9)
    pairs = q.join(r, ["t", "block"]).where(can).select("q_id", "r_id").distinct()
    return pairs.join(queries.select(F.col("id").alias("q_id"), F.col("tokens").alias("qt")), "q_id").join(rows.select(F.col("id").alias("r_id"), F.col("tokens").alias("rt")), "r_id").select("q_id", "r_id", jaccard(F.col("qt"), F.col("rt")).alias("score")).where(F.col("score") >= least)


def best_by_tokens(queries: DataFrame, rows: DataFrame, *, k: int, least: float) -> DataFrame:
    """The k rows whose token sets are nearest to each query's by Jaccard: ``q_id, r_id, score, rank``; see ``pairs_by_tokens``."""
    w = Window.partitionBy("q_id").orderBy(F.col("score").desc(), "r_id")
    return pairs_by_tokens(queries, rows, least=least).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
