"""Comparing texts and sections: shared tokens, precision and recall, moves, disagreement in groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.text import tokens
from recordloom.operators.link import best_by_tokens


def token_counts(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``key, t, n`` over lower-case runs of ASCII letters and digits, repeats counted."""
    return rows.select(key, F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z0-9]+"), F.lit(0))).alias("t")).groupBy(key, "t").agg(F.count("*").alias("n"))


def precision_recall(found: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``key, n_shared, n_found, n_wanted`` over the multisets of tokens of two texts of a key."""
    a, b = token_counts(found, key, text).withColumnRenamed("n", "a"), token_counts(wanted, key, text).withColumnRenamed("n", "b")
    both = a.join(b, [key, "t"], "full").select(key, F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    return both.groupBy(key).agg(F.sum(F.least("a", "b")).alias("n_shared"), F.sum("a").alias("n_found"), F.sum("b").alias("n_wanted"))


def section_changes(old: DataFrame, new: DataFrame, *, moved: float = 0.7) -> DataFrame:
    """Sections ``(path, text)`` of two versions: ``old_path, new_path, op``.

    Equal paths pair first (``same`` or ``changed``). Of the others, two are ``moved`` if
    each is the other's nearest by Jaccard of tokens, at ``moved`` or more; the rest
    are ``removed`` or ``added``. Paths are unique in a version and not null.
    """
    paired = old.alias("o").join(new.alias("n"), F.col("o.path") == F.col("n.path"))
    kept = paired.select(F.col("o.path").alias("old_path"), F.col("n.path").alias("new_path"), F.when(F.col("o.text").eqNullSafe(F.col("n.text")), "same").otherwise("changed").alias("op"))
    gone, fresh = (a.join(b.select("path"), "path", "left_anti").select(F.col("path").alias("id"), F.coalesce(tokens(F.col("text")), F.array().cast("array<string>")).alias("tokens")) for a, b in ((old, new), (new, old)))
    there = best_by_tokens(gone, fresh, k=1, least=moved).select(F.col("q_id").alias("old_path"), F.col("r_id").alias("new_path"))
    back = best_by_tokens(fresh, gone, k=1, least=moved).select(F.col("r_id").alias("old_path"), F.col("q_id").alias("new_path"))
    moves = there.join(back, ["old_path", "new_path"])
    removed = gone.join(moves, F.col("id") == F.col("old_path"), "left_anti").select(F.col("id").alias("old_path"), F.lit(None).cast("string").alias("new_path"), F.lit("removed").alias("op"))
    added = fresh.join(moves, F.col("id") == F.col("new_path"), "left_anti").select(F.lit(None).cast("string").alias("old_path"), F.col("id").alias("new_path"), F.lit("added").alias("op"))
    return kept.union(moves.withColumn("op", F.lit("moved"))).union(removed).union(added)


def top_by_keywords(areas: DataFrame, sections: DataFrame, k: int) -> DataFrame:
    """``area, id, n_shared, rank``: for each area ``(area, tokens)`` the k sections ``(id, tokens)`` that share most tokens."""
    a = areas.select("area", F.explode(F.array_distinct("tokens")).alias("t"))
    s = sections.select("id", F.explode(F.array_distinct("tokens")).alias("t"))
    shared = s.join(a, "t").groupBy("area", "id").agg(F.count("*").alias("n_shared"))
    w = Window.partitionBy("area").orderBy(F.col("n_shared").desc(), "id")
    return shared.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def unique_index(rows: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """``key, value, n``: the one value of each complete key; null where there are ``n`` > 1."""
    whole = rows.where(" and ".join(f"{k} is not null" for k in key)).groupBy(*key)
    return whole.agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count_distinct(value).alias("n")).select(*key, F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias(value), "n")


def first_reference(rows: DataFrame, key: Sequence[str], order: Sequence[Column], value: str) -> DataFrame:
    """``key, value, n_conflicts``: the first reference wins; later ones that differ are counted."""
    got = rows.groupBy(*key, value).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("at"))
    return got.groupBy(*key).agg(F.min_by(value, "at").alias(value), (F.sum("n") - F.min_by("n", "at")).alias("n_conflicts"))


def disagreements(rows: DataFrame, key: str, source: str, fields: Sequence[str]) -> DataFrame:
    """For each field: keys that several sources state, and those of them whose values differ: ``field, n_keys, n_differ``."""
    per = rows.groupBy(key).agg(F.count_distinct(source).alias("__n"), *(F.count_distinct(f).alias(f"__{i}") for i, f in enumerate(fields))).where("__n > 1")
    long = per.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"__{i}").alias("n")) for i, f in enumerate(fields)))).alias("x")).select("x.*")
    return long.groupBy("field").agg(F.count("*").alias("n_keys"), F.sum((F.col("n") > 1).cast("long")).alias("n_differ"))
