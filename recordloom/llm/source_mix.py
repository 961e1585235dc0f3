"""Mixing sources to target weights by Pareto order sampling (operator 7).

All of it is DataFrame operations. A source's target is found by sharing out what
capped sources leave, one sum over the sources a step. Within a source the expected
copies of a document follow its importance; each document gets its certain whole
copies, and the fraction that is left is its inclusion probability p. Documents are
ranked by the Pareto value, random odds u / (1 - u) divided by inclusion odds
p / (1 - p), and are selected in that order while the words of the source's extra
copies last: the fixed size of the sample is one of words, as targets are. The cut is
found by descending through 256 ranges of the rank twice, each time summing words by
source and range, so no source is ever sorted as a whole, and sources are numbered by
ranges of their names, so neither are they.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.llm.common import materialize, table

WEIGHTS, SHARE, MOST_COPIES, SEED, RANGES = (3.0, 1.0, 2.0), 1.5, 2.0, 20240607, 256
WORD = r"[^\x20\x09-\x0D]+"
#: Steps of sharing out; each caps at least one more source, and a step for every doubling of sizes is usual.
STEPS = 200
#: Repeated rows that one task makes.
CHUNK = 1 << 16


def numbered(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``place``, the number of its ``source`` from 0, by code point, null last.

    Sources are dealt by ranges and numbered inside; the driver gets one count for each range.
    """
    ranged = sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id())
    dealt = materialize(ranged, "ranges")
    counts = dict(dealt.groupBy("range").count().collect())
    before = dict(zip(sorted(counts), accumulate((counts[r] for r in sorted(counts)), initial=0)))  # noqa: B905  one more than ranges
    starts = F.create_map(*(F.lit(x) for r, n in before.items() for x in (r, n))) if before else F.create_map(F.lit(0), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())) - 1
    return dealt.withColumn("place", inside + F.element_at(starts, F.col("range"))).drop("range")


def targets(sizes: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """``(source, source_size)`` with each source's ``target`` in words.

    Sources by code point, null last, take ``weights`` in turn. All targets together
    are ``share`` of all sizes; none is over ``most`` times its source's size, and
    what that leaves goes to the others by weight, until none is above.
    """
    weight = F.array(*map(F.lit, weights))[F.pmod(F.col("place"), F.lit(len(weights))).cast("int")]
    s = materialize(numbered(sizes).select("source", "source_size", weight.alias("weight"), (most * F.col("source_size")).alias("cap")), "sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    for _ in range(STEPS):
        capped = F.col("cap") <= F.col("weight") * F.lit(level)
        used, left, n = s.agg(F.sum(F.when(capped, F.col("cap"))), F.sum(F.when(~capped, F.col("weight"))), F.count(F.when(capped, 1))).first()
        if not left:
            level = float("inf")
            break
        higher = (min(share, most) * total - (used or 0.0)) / left
        if higher <= level * (1 + 1e-12):
            break
        level = higher
    else:
        raise RuntimeError(f"targets did not settle in {STEPS} steps")
    return s.select("source", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def expected_copies(base: DataFrame, goal: DataFrame, most: float) -> DataFrame:
    """``(source, source_size, target, rate)``: a document's expected copies are ``least(most, rate * given)``.

    With that rate a source's expected words are its target. Documents reach ``most``
    in the falling order of their importance, so the rate is found in one running sum
    over the distinct importances of each source, of which ``rounded`` leaves few. A
    source without any importance has rate 0.
    """
    of = goal.select(F.col("source").alias("of"), "source_size", "target")
    parts = base.groupBy("source", "given").agg(F.sum("size").alias("words")).join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    by = Window.partitionBy("source").orderBy(F.col("given").desc())
    above = F.coalesce(F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    mass = F.sum(F.col("given") * F.col("words")).over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rate = F.when(mass > 0, F.greatest(F.lit(0.0), F.col("target") - most * above) / mass)
    open_ = parts.withColumn("rate", rate).withColumn("fits", F.col("rate") * F.col("given") <= most * (1 + 1e-12))
    every = F.coalesce(most / F.min(F.when(F.col("given") > 0, F.col("given"))), F.lit(0.0))
    return open_.groupBy("source").agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.coalesce(F.max_by("rate", F.when(F.col("fits"), F.col("given"))), every).alias("rate"))


def rounded(given: Column) -> Column:
    """Importance to a 16th of an octave, so that a source has some hundreds of distinct ones; 0 where there is none."""
    given = given.cast("double")
    return F.when((given > 0) & (given < float("inf")), F.pow(F.lit(2.0), F.floor(F.log2(given) * 16 + 0.5) / 16)).otherwise(F.lit(0.0))


def _uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the row's id and text alone."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def mix(docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES, importance: str | Column | None = None, seed: int = SEED) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, size, source_size, target, taken`` and ``copies``.

    ``taken`` is ``size`` times ``copies``. ``importance`` is a column of non-negative
    weights, or an expression over ``size``, that a source's expected copies follow
    (null counts as 0; ``rounded``); inclusion is then unequal within a source; without it they are
    the same. No document is expected more than ``most`` times; what that leaves goes
    to the others of its source. Each source's taken words end within its boundary
    document of its target, unless too few of its documents have any importance.
    Ties in rank go by id; rows that repeat one id and text are alike and counted, not
    ordered. Null texts have size 0 and add no words; a null source is a source;
    an empty table gives no rows. Same input, same result.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    asked = docs.select("doc_id", "source", size.alias("size"), (F.col(importance) if isinstance(importance, str) else F.lit(1.0)).alias("given"), _uniform(F.struct(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))), seed).alias("u"))
    if isinstance(importance, Column):
        asked = asked.withColumn("given", importance)
    base = materialize(asked.withColumn("given", rounded(F.col("given"))), "sizes")
    sums = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = materialize(expected_copies(base, targets(sums, weights=weights, share=share, most=most), most), "targets").withColumnRenamed("source", "of")
    rows = base.join(s, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("expected", F.least(F.lit(most), F.col("rate") * F.col("given")))
    p = F.col("expected") - F.floor("expected")
    pareto = F.col("u") / (1 - F.col("u")) / (p / (1 - p))
    rank = F.when(p > 0, pareto / (1 + pareto))
    # Words of extra copies in a source: what the fractions stand for, all its documents together.
    slots = F.least(F.floor(rank * RANGES * RANGES), F.lit(RANGES * RANGES - 1))
    rows = rows.select("doc_id", "source", "size", "source_size", "target", F.floor("expected").alias("whole"), (p * F.col("size")).alias("part"), rank.alias("rank"), slots.alias("slot"))
    rows = materialize(rows, "ranked")
    by = Window.partitionBy("source").orderBy("range")
    due = rows.where("rank is not null").groupBy("source").agg(F.sum("part").alias("due"))

    def cut(sums: DataFrame) -> DataFrame:
        """The range of each source in which the running words pass what is due, and the words before it."""
        run = sums.withColumn("upto", F.sum("words").over(by)).withColumn("before", F.col("upto") - F.col("words"))
        return run.where("upto > due").groupBy(F.col("source").alias("of")).agg(F.min_by(F.struct("range", "before", "due"), "range").alias("c")).select("of", "c.*")

    same = F.col("source").eqNullSafe(F.col("of"))
    high = rows.where("rank is not null").groupBy("source", F.floor(F.col("slot") / RANGES).alias("range")).agg(F.sum("size").alias("words"))
    first = cut(high.join(due.withColumnRenamed("source", "of"), same).drop("of")).withColumnRenamed("range", "high").withColumnRenamed("before", "base")
    inner = rows.join(first, same).drop("of").where(F.floor(F.col("slot") / RANGES) == F.col("high"))
    low = inner.groupBy("source", (F.col("slot") % RANGES).alias("range")).agg(F.sum("size").alias("words"), (F.max("due") - F.max("base")).alias("due"))
    second = cut(low).withColumnRenamed("range", "low")
    at = first.join(second.select(F.col("of").alias("of2"), "low", "before"), F.col("of").eqNullSafe(F.col("of2"))).select("of", (F.col("high") * RANGES + F.col("low")).alias("at"), (F.col("due") - F.col("base") - F.col("before")).alias("left"))
    at = materialize(at, "cuts")
    dealt = rows.join(at, same, "left").drop("of")
    # Only the rows of one range of 65,536 in a source are put in order, equal ones together; the boundary document comes in if that is nearer.
    alike = ["source", "rank", "doc_id", "size", "source_size", "target", "whole", "left"]
    met = dealt.where("slot = at").groupBy(*alike).agg(F.count("*").alias("n"))
    edge = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = (F.col("left") - F.coalesce(F.sum(F.col("size") * F.col("n")).over(edge), F.lit(0))) / F.col("size") + 0.5
    met = met.withColumn("in", F.when(F.col("size") > 0, F.least("n", F.greatest(F.lit(0), F.floor(room)))).otherwise(F.lit(0)))
    # As many rows again as were alike, many of them in several tasks.
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK)))
    met = met.withColumn("part", part).withColumn("end", F.least("n", (F.col("part") + 1) * CHUNK)).repartition("doc_id", "part")
    near = met.withColumn("i", F.explode(F.sequence(F.col("part") * CHUNK, F.col("end") - 1))).withColumn("extra", (F.col("i") < F.col("in")).cast("int"))
    rest = dealt.where("slot is null or at is null or slot <> at").withColumn("extra", F.when(F.col("rank").isNull(), 0).otherwise((F.col("at").isNull() | (F.col("slot") < F.col("at"))).cast("int")))
    out = near.select("doc_id", "size", "source_size", "target", "whole", "extra").union(rest.select("doc_id", "size", "source_size", "target", "whole", "extra")).withColumn("copies", F.col("whole") + F.col("extra"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), F.col("copies").cast("long").alias("copies"))


def by_length() -> Column:
    """An importance that grows by one with every doubling of a document's words."""
    return F.floor(F.log2(F.col("size") + 1)) + 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), importance=by_length()).select("doc_id", "size", "source_size", "target", "taken")
