"""Dates, amounts and URLs as literal values with a stated outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_status(text: Column) -> Column:
    """``absent``, ``empty``, ``invalid`` or ``valid`` for a date that must read YYYY-MM-DD and exist."""
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.when(text.isNull(), "absent").when(text == "", "empty").when(shaped & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), "valid").otherwise("invalid")


def amount(text: Column) -> Column:
    """A printed amount as DECIMAL(38,2): grouped by commas, with cents; a minus, or parentheses, or a dollar sign in front; else null."""
    ok = text.rlike(r"^(-?\$?|\(\$?)(\d{1,3}(,\d{3})*)?\.\d{2}\)?$") & (text.startswith("(") == text.endswith(")"))
    digits = F.regexp_replace(text, r"[^0-9.]", "")
    value = F.when(digits.startswith("."), F.concat(F.lit("0"), digits)).otherwise(digits).try_cast("decimal(38,2)")
    return F.when(ok, F.when(text.startswith("-") | text.startswith("("), -value).otherwise(value))


def query_value(url: Column, name: str) -> Column:
    """A query parameter's value; null if it is absent or repeated."""
    pattern = rf"[?&]{name}=([^&#]*)"
    return F.when(F.regexp_count(url, F.lit(pattern)) == 1, F.regexp_extract(url, pattern, 1))


def normalized_url(url: Column) -> Column:
    """Scheme and host in lower case, without fragment, default port and final slash."""
    bare = F.regexp_replace(url, r"#.*$", "")
    head = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1))
    rest = F.substr(bare, F.length(head) + 1)
    head = F.regexp_replace(F.regexp_replace(head, r"^(http://[^/]*):80$", "$1"), r"^(https://[^/]*):443$", "$1")
    return F.regexp_replace(F.concat(head, rest), r"/$", "")


def banded(value: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The name of the first band whose least value is reached; bands go from high to low."""
    out = F.lit(otherwise)
    for least, name in reversed(bands):
        out = F.when(value >= least, name).otherwise(out)
    return out
