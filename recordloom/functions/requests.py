"""Requests of paged sources as columns: queries rewritten, day windows, page sizes of repeated walks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def with_query(url: Column, name: str, value: Column) -> Column:
    """The URL with one query parameter: any of that name go, the new one comes last; a fragment goes too."""
    bare = F.substring_index(url, "#", 1)
    path, asked = F.substring_index(bare, "?", 1), F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.filter(F.split(asked, "&"), lambda p: (p != "") & (F.url_decode(F.substring_index(p, "=", 1)) != F.lit(name)))
    kept = F.transform(kept, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("="))))
    own = F.concat(F.url_encode(F.lit(name)), F.lit("="), F.url_encode(value))
    return F.concat(path, F.lit("?"), F.concat_ws("&", kept, own))


def day_window(first: Column, last: Column) -> Column:
    """Exclusive bounds in UTC around whole days: ``start`` a second before the first, ``stop`` as the day after the last begins; null if the days are turned."""
    write = lambda at: F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    start = write(F.to_timestamp_ntz(F.date_format(F.date_sub(first, 1), "yyyy-MM-dd'T'23:59:59")))
    stop = write(F.date_add(last, 1).cast("timestamp_ntz"))
    return F.when(first.isNull() | last.isNull() | (first <= last), F.struct(start.alias("start"), stop.alias("stop")))


def walk_sizes(limit: int) -> list[int]:
    """Page sizes of repeated walks, so that rows at a page's edge lie inside another walk's page."""
    return list(dict.fromkeys([limit, *(limit - limit // n for n in (19, 9))]))


def reach(limit: int, ceiling: int) -> int:
    """How many rows every one of those walks gets to see below a publisher's ceiling."""
    return min(ceiling - ceiling % size for size in walk_sizes(limit))


def volume_fits(congress: Column, volume: Column) -> Column:
    """Whether a volume of the session laws can hold a Congress's laws; null where volumes weren't yearly or either is missing."""
    # The first Congress with numbered public laws, the first whose sessions have a volume each, and the current one.
    numbered, yearly, current = 57, 74, 119
    early, late = volume.between(congress - 26, congress - 24), volume.between(2 * congress - 100, 2 * congress - 97)
    return F.when(congress.between(numbered, current), F.when(congress < yearly, early).otherwise(late))


def unwrapped(text: Column) -> Column:
    """Printed lines as one: a hyphen at a line's end goes with it, other line ends are blanks."""
    return F.translate(F.regexp_replace(text, "[-‐]\n", ""), "\n", " ")


def number_problems(values: Column) -> Column:
    """The entries of a list of regulation numbers that aren't one; an empty list for none and for null."""
    return F.coalesce(F.filter(values, lambda v: v.isNull() | ~v.rlike(r"^\d{4}-[A-Za-z]{2}[A-Za-z0-9]{2}$")), F.array().cast("array<string>"))
