"""Text expressions, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeezed(text: Column) -> Column:
    """Without white space at the ends, and one blank for each run of it."""
    return F.trim(F.regexp_replace(text, r"[\s]+", " "))


def tokens(text: Column) -> Column:
    """The distinct lower-case runs of ASCII letters and digits, sorted."""
    return F.sort_array(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+"), F.lit(0))))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all members of two sets; 0 if both are empty."""
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / every)


def slug(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), F.lit("-"))


def visible_text(html: Column) -> Column:
    """Markup without scripts, styles, comments and tags, with five entities resolved, white space squeezed."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"(?s)<[^>]*>", " ")
    for entity, letter in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(letter))
    return squeezed(bare)


def links(html: Column) -> Column:
    """The targets of all anchors, in order."""
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1))


def redacted(text: Column, pattern: str, mark: str) -> tuple[Column, Column]:
    """The text with each match replaced, and how many there were."""
    return F.regexp_replace(text, pattern, mark), F.regexp_count(text, F.lit(pattern))


def canonical(text: Column) -> Column:
    """The ASCII letters and digits alone, in upper case."""
    return F.upper(F.regexp_replace(text, "[^A-Za-z0-9]", ""))


def surname(name: Column) -> Column:
    """What stands before a comma, else the last word, without a generation's mark or a bracket."""
    bare = F.trim(F.regexp_replace(name, r"\s*[\[(].*$|,?\s+(?:Jr|Sr|II|III|IV)\.?$", ""))
    return F.when(bare.contains(","), F.trim(F.substring_index(bare, ",", 1))).otherwise(F.element_at(F.split(bare, r"\s+"), -1))


def chamber_before(text: Column, start: Column) -> Column:
    """``House`` or ``Senate`` if it is the word right before an offset, else null."""
    return F.nullif(F.regexp_extract(F.substring(text, F.greatest(start - 11, F.lit(1)), F.least(start, F.lit(12))), r"\b(House|Senate)\s*$", 1), F.lit(""))
