"""Agreement: of windows, repeated walks, versions, row sets, names with a vocabulary, keys in several fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def window_problems(windows: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Closed whole-day windows that are ``reversed``, or that leave a ``gap`` to the window before or ``overlap`` it.

    Windows of a key are compared by start, then end. Null ends are ``reversed``.
    """
    w = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    due = F.date_add(before, 1)
    problem = F.when(~F.coalesce(F.col(start) <= F.col(end), F.lit(False)), "reversed").when(F.col(start) > due, "gap").when(F.col(start) < due, "overlap")
    return windows.withColumn("problem", problem).where("problem is not null")


def halved_windows(days: DataFrame, day: str, cap: int, *, first: int | None = None, last: int | None = None) -> DataFrame:
    """Windows ``lo, hi, n, over`` of whole day numbers, halved while more than ``cap`` rows fall in one.

    The left half takes the middle day. A single day with more rows than the cap
    stays and is ``over``. The rows are counted by day once; the halving runs over
    one row a day, which the calendar bounds. Without ``first`` and ``last`` the
    table's own first and last day bound the windows, and null days, if any, are a
    row of null ``lo`` and ``hi``: each row is in one window. With both, only the
    days between them are counted.
    """
    if first is None and last is None:
        first, last, n_rows, n_days = days.agg(F.min(day), F.max(day), F.count("*"), F.count(day)).first()
        nulls = days.where(F.col(day).isNull()).agg(F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"), F.count("*").alias("n")).where("n > 0").withColumn("over", F.col("n") > cap)
        if not n_days:
            return nulls
        bounded = halved_windows(days, day, cap, first=first, last=last)
        return bounded.union(nulls) if n_rows > n_days else bounded
    if first is None or last is None:
        raise ValueError("give both first and last, or neither")
    counted = days.where(F.col(day).between(first, last)).groupBy(F.col(day).cast("long").alias("day")).agg(F.count("*").alias("n_day"))
    every = days.sparkSession.range(first, last + 1).select(F.col("id").alias("day"))
    at = every.join(counted, "day", "left").select("day", F.coalesce("n_day", F.lit(0)).alias("n_day"), F.lit(first).cast("long").alias("lo"), F.lit(last).cast("long").alias("hi"))
    whole, split = F.sum("n_day").over(Window.partitionBy("lo", "hi")), (F.col("n") > cap) & (F.col("lo") < F.col("hi"))
    middle = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2)
    for _ in range(max(0, last - first).bit_length()):
        left = F.col("day") <= middle
        at = at.withColumn("n", whole).select("day", "n_day", F.when(split & ~left, middle + 1).otherwise(F.col("lo")).alias("lo"), F.when(split & left, middle).otherwise(F.col("hi")).alias("hi"))
    return at.groupBy("lo", "hi").agg(F.sum("n_day").alias("n")).withColumn("over", F.col("n") > cap)


def repeated_walks(rows: DataFrame, walk: str, position: str, fields: Sequence[str]) -> DataFrame:
    """For each walk after another: ``walk, n_differ``, the positions at which it differs from the walk before.

    A walk with 0 is confirmed. Walks are whole numbers; each meets its predecessor
    by position in an equi-join, so none is ever held in one place.
    """
    content = F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
    own = rows.select(F.col(walk).alias("walk"), F.col(position).alias("position"), content.alias("a"))
    known = own.select("walk").distinct()
    shifted = own.select((F.col("walk") + 1).alias("walk"), "position", F.col("a").alias("b")).join(known, "walk", "left_semi")
    followers = known.join(known.select((F.col("walk") + 1).alias("walk")), "walk", "left_semi")
    met = own.join(followers, "walk", "left_semi").join(shifted, ["walk", "position"], "full")
    return met.groupBy("walk").agg(F.sum((~F.col("a").eqNullSafe(F.col("b"))).cast("long")).alias("n_differ"))


def newest_or_refused(rows: DataFrame, keys: Sequence[str], version: str, fields: Sequence[str]) -> DataFrame:
    """One row for each key: its newest ``version``, the ``fields`` there, and how many readings that version has.

    Equal repeats are one reading. If the newest version has several, the fields are
    null: which one holds isn't known. A null version is older than any other.
    """
    by_version = rows.groupBy(*keys, version).agg(F.min(F.struct(*fields)).alias("__low"), F.max(F.struct(*fields)).alias("__high"), F.count_distinct(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})).alias("n_readings"))
    newest = by_version.groupBy(*keys).agg(F.max_by(F.struct(version, "__low", "n_readings"), F.struct(F.col(version).isNotNull(), version)).alias("__x"))
    field = lambda f: F.when(F.col("__x.n_readings") == 1, F.col(f"__x.__low.{f}")).alias(f)
    return newest.select(*keys, F.col(f"__x.{version}").alias(version), *map(field, fields), F.col("__x.n_readings").alias("n_readings"))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that two tables of the same columns hold unequally often, with ``n``: how many more the first has.

    One aggregation over both, with partial sums before the shuffle.
    """
    both = a.withColumn("__n", F.lit(1)).unionByName(b.withColumn("__n", F.lit(-1)))
    return both.groupBy(*a.columns).agg(F.sum("__n").alias("n")).where("n <> 0")


def _word_prefixes(name: Column) -> Column:
    words = F.split(name, " ")
    return F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, 1, i), " "))


def named(names: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``name, code, rule`` for each distinct ``name``, against ``vocabulary(known, code)``.

    ``equal`` first; then the longest known name whose words the given one starts
    with (``extends``); then the known names that start with its words (``begins``).
    The first rule that meets anything decides; if it meets several codes, the code
    is null and the rule ``ambiguous``. All joins are equi-joins on word prefixes.
    """
    n, v = names.select("name").where("name is not null").distinct(), vocabulary.select("known", "code").where("known is not null and code is not null").distinct()
    equal = n.join(v, n["name"] == v["known"]).select("name", "code", F.lit(0).alias("r"), F.lit(0).alias("short"))
    given = n.select("name", F.explode(_word_prefixes(F.col("name"))).alias("known")).where("known <> name")
    extends = given.join(v, "known").select("name", "code", F.lit(1).alias("r"), (-F.length("known")).alias("short"))
    starts = v.select(F.explode(_word_prefixes(F.col("known"))).alias("name"), "known", "code").where("known <> name").select("name", "code").distinct()
    begins = n.join(starts, "name").select("name", "code", F.lit(2).alias("r"), F.lit(0).alias("short"))
    ranked = equal.union(extends).union(begins).groupBy("name", "r", "short").agg(F.count_distinct("code").alias("n"), F.min("code").alias("code"))
    best = ranked.groupBy("name").agg(F.min_by(F.struct("r", "n", "code"), F.struct("r", "short")).alias("x"))
    rule = F.when(F.col("x").isNull(), "unmatched").when(F.col("x.n") > 1, "ambiguous").otherwise(F.element_at(F.array(*map(F.lit, ("equal", "extends", "begins"))), F.col("x.r") + 1))
    return n.join(best, "name", "left").select("name", F.when(F.col("x.n") == 1, F.col("x.code")).alias("code"), rule.alias("rule"))


def first_field_match(rows: DataFrame, key: str, fields: Sequence[str], pattern: str, catalog: DataFrame) -> DataFrame:
    """``key, value, field``: of the ``catalog(value, position)`` values that a row's fields name, one.

    Earlier fields go before later ones, then the smaller position. Rows that name none are left out.
    """
    found = [rows.select(key, F.explode(F.array_distinct(F.regexp_extract_all(F.col(f), F.lit(pattern), F.lit(0)))).alias("value"), F.lit(i).alias("i")) for i, f in enumerate(fields)]
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    best = every.join(catalog, "value").groupBy(key).agg(F.min_by(F.struct("value", "i"), F.struct("i", "position", "value")).alias("x"))
    return best.select(key, F.col("x.value").alias("value"), F.element_at(F.array(*map(F.lit, fields)), F.col("x.i") + 1).alias("field"))


def inventory(key: str, **sides: DataFrame) -> DataFrame:
    """``key`` with, for each named side, how many of its rows have it; one aggregation over all sides. Null keys count as one key."""
    every = None
    for name in sides:
        one = sides[name].select(key, *(F.lit(int(n == name)).alias(n) for n in sides))
        every = one if every is None else every.union(one)
    return every.groupBy(key).agg(*(F.sum(n).alias(n) for n in sides))


def collected(rows: DataFrame, key: str, fields: Sequence[str], many: str) -> DataFrame:
    """One row for each key: ``fields``, all distinct ``many`` values in order, joined by U+001F, and ``refused``.

    A key whose rows differ in ``fields`` is refused, its fields null. ``many`` must
    come from a bounded vocabulary, as its values meet in one row.
    """
    whole = F.struct(*fields)
    got = rows.groupBy(key).agg(F.min(whole).alias("__a"), F.max(whole).alias("__b"), F.array_join(F.sort_array(F.collect_set(many)), "\u001f").alias(many))
    same = F.col("__a").eqNullSafe(F.col("__b"))
    return got.select(key, *(F.when(same, F.col(f"__a.{f}")).alias(f) for f in fields), many, F.when(~same, "differs").alias("refused"))
