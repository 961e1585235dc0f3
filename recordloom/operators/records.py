"""Record keeping: one candidate by tiers, order of printings, journals of outcomes, new blobs, stated locators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.operators.link import tiers


def one_by_tiers(left: DataFrame, right: DataFrame, left_id: str, right_id: str, keys: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Each left id with the right one on its best tier: ``left_id, right_id, tier, n``.

    If that tier meets several right ids, ``right_id`` is null and ``n`` says how
    many; lower tiers don't decide between them. A left id that meets none has tier null.
    """
    order = {name: i for i, (name, _, _) in enumerate(keys)}
    rank = F.element_at(F.create_map(*(F.lit(x) for item in order.items() for x in item)), F.col("tier"))
    met = tiers(left, right, left_id, right_id, keys).groupBy(left_id, "tier").agg(F.count("*").alias("n"), F.min(right_id).alias(right_id))
    best = met.groupBy(left_id).agg(F.min_by(F.struct("tier", "n", right_id), rank).alias("x"))
    return left.select(left_id).distinct().join(best, left_id, "left").select(left_id, F.when(F.col("x.n") == 1, F.col(f"x.{right_id}")).alias(right_id), F.col("x.tier").alias("tier"), F.coalesce("x.n", F.lit(0)).cast("long").alias("n"))


def printing_pairs(rows: DataFrame, key: str, name: str, date: str, rank: str) -> DataFrame:
    """Neighbouring printings of a key: ``key, name, next_name, refused``.

    Printings go by date, then rank; one without a date takes the latest date among
    those of its rank or a lower one, or comes first. A pair is refused as
    ``order_unknown`` if both have the same date and rank, and as ``undated`` if one
    has neither its own date nor a rank.
    """
    by_rank = Window.partitionBy(key).orderBy(F.col(rank).asc_nulls_last()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select(key, name, F.col(rank).alias("__rank"), F.coalesce(date, F.when(F.col(rank).isNotNull(), F.max(date).over(by_rank))).alias("__at"), (F.col(date).isNull() & F.col(rank).isNull()).alias("__lost"))
    w = Window.partitionBy(key).orderBy(F.col("__at").asc_nulls_first(), F.col("__rank").asc_nulls_last(), name)
    step = placed.withColumn("__n", F.lead(F.struct(name, "__at", "__rank", "__lost")).over(w)).where("__n is not null")
    unknown = F.col("__at").eqNullSafe(F.col("__n.__at")) & F.col("__rank").eqNullSafe(F.col("__n.__rank"))
    return step.select(key, name, F.col(f"__n.{name}").alias("next_name"), F.when(F.col("__lost") | F.col("__n.__lost"), "undated").when(unknown, "order_unknown").alias("refused"))


def journal_state(journal: DataFrame, file: str, seq: str, outcome: str, *, done: str = "done") -> DataFrame:
    """Each file's last outcome, how often it was tried, and whether it is still due."""
    last = journal.groupBy(file).agg(F.max_by(outcome, seq).alias(outcome), F.count("*").alias("n_tried"))
    return last.withColumn("due", ~F.col(outcome).eqNullSafe(F.lit(done)))


def new_blobs(incoming: DataFrame, stored: DataFrame, content: str) -> DataFrame:
    """``digest`` and content of the incoming blobs that aren't stored yet, each once; ``stored`` has ``digest``.

    Only digests are compared; contents are shuffled once, by their digest.
    """
    named = incoming.where(F.col(content).isNotNull()).withColumn("digest", F.concat(F.lit("sha256:"), F.sha2(content, 256)))
    return named.join(stored.select("digest").distinct(), "digest", "left_anti").select("digest", content).dropDuplicates(["digest"])


def locators(rows: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """``key, field, locator, state`` for each field: ``absent`` (null), ``empty`` or ``stated``. No row is left out."""
    long = rows.select(key, F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("locator")) for f in fields))).alias("x")).select(key, "x.*")
    return long.withColumn("state", F.when(F.col("locator").isNull(), "absent").when(F.col("locator") == "", "empty").otherwise("stated"))
