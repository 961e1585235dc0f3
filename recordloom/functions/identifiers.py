"""Identifiers, instants and comparison forms of text, all JVM-side. A value that a function can't read is null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_DASHES = "[­‐-―−]"


def hyphenated(text: Column) -> Column:
    """With every dash, minus and soft hyphen as a plain hyphen."""
    return F.regexp_replace(text, _DASHES, "-")


def rin(text: Column) -> Column:
    """A regulation number that the whole text states, with a label or without: ``0000-XX00``."""
    bare = F.upper(F.regexp_replace(F.trim(hyphenated(text)), r"(?i)^RIN:?\s*", ""))
    return F.when(bare.rlike(r"^\d{4}-[A-Z]{2}\d{2}$"), bare)


def unpadded(number: Column) -> Column:
    """A hyphenated document number without zeros in front of its last part."""
    return F.when(number.rlike(r"^[A-Z0-9]+(-[A-Z0-9]+)*-\d+$"), F.regexp_replace(number, r"-0+(\d+)$", "-$1"))


def docket(text: Column) -> Column:
    """A docket that the text states, its label left out: organisation, year and sequence."""
    bare = F.upper(F.regexp_replace(F.trim(hyphenated(text)), r"(?i)^docket\s*(id|no\.?|number)?:?\s*", ""))
    return F.when(bare.rlike(r"^[A-Z]+([-_][A-Z0-9]+)*-\d{4}-\d{4,5}$"), bare)


def urn(namespace: str, kind: str, *parts: Column) -> Column:
    """``urn:namespace:kind:part:...``; null if a part is null, empty or holds a colon or white space."""
    out = F.lit(f"urn:{namespace}:{kind}")
    for part in parts:
        out = F.concat(out, F.lit(":"), F.when(part.rlike(r"^[^\s:]+$"), part))
    return out


def ordinal_congress(text: Column) -> Column:
    """The number of a Congress named by an ordinal in digits."""
    return F.nullif(F.regexp_extract(text, r"(?i)\b(\d{1,3})(?:st|nd|rd|th)\s+Congress\b", 1), F.lit("")).cast("int")


def term_year(day: Column) -> Column:
    """The year of the term that a day lies in; terms begin in October."""
    return F.year(day) - F.when(F.month(day) < 10, 1).otherwise(0)


def term_code(day: Column) -> Column:
    return F.lpad((term_year(day) % 100).cast("string"), 2, "0")


def instant(text: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` and nothing else, as a timestamp."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX")))


def local_day(text: Column, zone: str = "America/New_York") -> Column:
    """The calendar day of an instant in ``zone``; a bare day, or one at midnight UTC, keeps the day it prints."""
    printed = text.rlike(r"^\d{4}-\d{2}-\d{2}(T00:00:00Z)?$")
    shifted = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), F.try_to_timestamp(F.substring(text, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")))
    return F.when(printed, F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")).when(text.rlike("^.{19}Z$"), shifted)


def bare_media_type(text: Column) -> Column:
    """A media type in lower case without its parameters."""
    bare = F.lower(F.trim(F.substring_index(text, ";", 1)))
    return F.when(bare.rlike(r"^[a-z0-9!#$&^_.+-]+/[a-z0-9!#$&^_.+-]+$"), bare)


def pointer(*parts: Column) -> Column:
    """A JSON pointer to the member that the parts lead to."""
    return F.concat(*(F.concat(F.lit("/"), F.replace(F.replace(p, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))) for p in parts))


def comparison_text(text: Column) -> Column:
    """Lower case, ASCII punctuation as blanks, white space squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[!-/:-@\[-^`{-~]", " "), r"\s+", " "))


def comparison_jaccard(a: Column, b: Column) -> Column:
    """Shared over all words of two comparison texts; 1 if both are empty, 0 if one is."""
    words = lambda c: F.filter(F.array_distinct(F.split(comparison_text(c), " ")), lambda w: w != "")
    every = F.size(F.array_union(words(a), words(b)))
    return F.when(every == 0, 1.0).otherwise(F.size(F.array_intersect(words(a), words(b))) / every)


def keyword_tokens(text: Column, stopwords: Sequence[str] = (), *, least: int = 3, most: int = 84) -> Column:
    """The distinct words of ``least`` to ``most`` letters and digits that aren't ``stopwords``, sorted."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))
    long = F.filter(found, lambda w: F.length(w).between(least, most))
    return F.sort_array(F.array_except(long, F.array(*map(F.lit, stopwords))) if stopwords else long)


def plain_glyphs(text: Column) -> Column:
    """Line ends as LF, curly quotes straight, doubled single quotes or backticks as one double, no-break spaces as blanks."""
    lines = F.regexp_replace(text, r"\r\n?", "\n")
    single = F.regexp_replace(lines, "[‘-‛]", "'")
    return F.translate(F.regexp_replace(F.regexp_replace(single, "''|``", '"'), "[“-‟]", '"'), "  ", "  ")


def rejoined(text: Column) -> tuple[Column, Column]:
    """The text with words that a line end had cut put together, and how many there were."""
    pattern = r"(?<=[a-z])-[ \t]*\n[ \t]*(?=[a-z])"
    return F.regexp_replace(text, pattern, ""), F.regexp_count(text, F.lit(pattern))


def byte_prefix(text: Column, most: int) -> Column:
    """The longest prefix of whole code points with at most ``most`` UTF-8 bytes."""
    return F.coalesce(*(F.try_validate_utf8(F.substring(F.encode(text, "UTF-8"), 1, max(0, most - i)).cast("string")) for i in range(4)))
