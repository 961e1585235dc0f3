"""What short texts state: numbers, dates, names, votes, placeholders, kinds of bodies. All JVM-side; what can't be read is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that state nothing, in lower case.
UNSTATED = ("", "none", "nan", "null", "n/a", "na", "...", "not yet determined", "undetermined", "not determined", "nyd", "tbd", "to be determined", "not applicable")
# A member's vote as printed, and what it counts as.
VOTES = {
    "yea": "yea", "aye": "yea", "guilty": "yea", "nay": "nay", "no": "nay", "not guilty": "nay",
    "present": "present", "present, giving live pair": "present", "not voting": "not_voting",
}
# The names of totals, and the column that each is.
TALLIES = {
    "yea-total": "yea", "yeas": "yea", "nay-total": "nay", "nays": "nay", "present-total": "present", "present": "present",
    "not-voting-total": "not_voting", "absent": "not_voting",
}
# File endings and their media types.
MEDIA = {
    "doc": "application/msword", "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "htm": "text/html", "html": "text/html",
    "pdf": "application/pdf", "txt": "text/plain", "xml": "application/xml",
}
# Bodies that stand for a text that isn't there, and marks of pages without content.
PLACEHOLDERS = ("[TEXT NOT AVAILABLE IN REFER TO PDF]", "[TEXT NOT AVAILABLE REFER TO PDF]")
SHELLS = ('<div id="root">', "You need to enable JavaScript")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _looked_up(key: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def states_nothing(text: Column) -> Column:
    """Whether a field holds a placeholder: nothing, a word for nothing, or title zero of a code with nothing behind it."""
    bare = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "^[\"'“”\\s]+|[\"'“”\\s]+$", ""))
    rest = F.regexp_replace(bare, r"^0+\s*(c\.?\s?f\.?\s?r|u\.?\s?s\.?\s?c)\.?\s*", "")
    return bare.isin(*UNSTATED) | ((rest != bare) & (rest.isin(*UNSTATED) | rest.rlike("^0+$")))


def year_last(name: Column) -> Column:
    """``2020 X Act`` as ``X Act of 2020``."""
    pattern = r"(?i)^\s*(?:the\s+)?((?:18|19|20)\d{2})\s+(\S.*)$"
    return F.when(name.rlike(pattern), F.concat(F.regexp_extract(name, pattern, 2), F.lit(" of "), F.regexp_extract(name, pattern, 1)))


def printed_dates(text: Column) -> Column:
    """All dates of a text, ``Month D, YYYY`` or ``M/D/YY(YY)``, as ISO days in printed order; two-digit years are of this century."""
    names = "|".join(MONTHS)
    every = F.regexp_extract_all(text, F.lit(rf"(?i)\b((?:{names})\.?\s+\d{{1,2}},?\s+\d{{4}}|\d{{1,2}}/\d{{1,2}}/\d{{2,4}})\b"), F.lit(1))

    def iso(d: Column) -> Column:
        month = F.lpad(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(d, "^([A-Za-z]+)", 1))).cast("string"), 2, "0")
        word = F.concat_ws("-", F.regexp_extract(d, r"(\d{4})$", 1), month, F.lpad(F.regexp_extract(d, r"^[A-Za-z]+\.?\s+(\d+)", 1), 2, "0"))
        year = F.regexp_extract(d, r"(\d+)$", 1).cast("int")
        year = F.when(year < 100, year + 2000).otherwise(year).cast("string")
        return F.when(d.rlike("^[A-Za-z]"), word).otherwise(F.concat_ws("-", year, F.lpad(F.substring_index(d, "/", 1), 2, "0"), F.lpad(F.regexp_extract(d, r"/(\d+)/", 1), 2, "0")))

    return F.transform(every, iso)


def subjects(block: Column) -> Column:
    """The terms of a printed list up to its first sentence end, at commas and semicolons, without the last one's conjunction."""
    body = F.split(squeezed(block), r"(?<![A-Z])(?<!U\.S)\.\s", 2)[0]
    body = F.regexp_replace(body, r"\.+\s*$", "")
    terms = F.transform(F.split(body, "[,;]"), lambda x: F.trim(F.regexp_replace(F.trim(x), r"(?i)^(and|&)\s+", "")))
    return F.filter(terms, lambda x: x != "")


def stated_recommendation(text: Column) -> Column:
    """Kind (``recommendation`` or ``matter``) and number that a bracketed note at a text's end states."""
    pattern = r"(?i)[(\[]\s*(recommendations?|matters?(?: for (?:congressional )?consideration)?)\s*(\d+(?:-\d+)?)\.?\s*[)\]]?\s*\.?\s*$"
    kind = F.when(F.lower(F.regexp_extract(text, pattern, 1)).startswith("rec"), "recommendation").otherwise("matter")
    return F.when(text.rlike(pattern), F.struct(kind.alias("kind"), F.regexp_extract(text, pattern, 2).alias("number")))


def vote(text: Column) -> Column:
    """What a member's printed vote counts as."""
    return _looked_up(F.lower(squeezed(text)), VOTES)


def tally(totals: Column) -> Column:
    """``yea, nay, present, not_voting`` from a map of a chamber's own names of totals; other names are left out."""
    value = lambda column: F.coalesce(*(F.element_at(totals, F.lit(name)) for name, c in TALLIES.items() if c == column))
    return F.struct(*(value(c).alias(c) for c in dict.fromkeys(TALLIES.values())))


def title_key(title: Column) -> Column:
    """A title for comparison: straight quotes, lower case, single blanks; empty where there is none."""
    return F.lower(squeezed(F.translate(F.coalesce(title, F.lit("")), "‘’“”", "''\"\"")))


def last_name(sponsor: Column) -> Column:
    """The first word of a sponsor, in capitals, that is letters only and longer than one; empty if there is none."""
    words = F.filter(F.split(F.upper(sponsor), r"[\s,]+"), lambda w: w.rlike("^[A-Z]{2,}$"))
    return F.coalesce(F.get(words, F.lit(0)), F.lit(""))


def media_type(stated: Column, locator: Column) -> Column:
    """A media type from what is stated (a type or an ending), else from the locator's ending."""
    given = F.lower(F.trim(stated))
    path = F.regexp_replace(F.regexp_replace(locator, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), "[?#].*$", "")
    ending = F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1))
    return F.coalesce(F.when(given.contains("/"), given), _looked_up(given, MEDIA), _looked_up(ending, MEDIA), F.lit("application/octet-stream"))


def body_status(text: Column, rendition: Column) -> Column:
    """Whether a body is the publisher's placeholder, was read from a PDF, or neither."""
    stands = F.coalesce(*(F.when(text.contains(p), True) for p in PLACEHOLDERS), F.lit(False))
    return F.when(stands, "publisher_placeholder").when(rendition == "pdf", "pdf_extracted").otherwise("not_flagged")


def is_shell(body: Column) -> Column:
    """Whether a page only starts a script."""
    return F.coalesce(*(F.when(body.contains(p), True) for p in SHELLS), F.lit(False))


def is_error_page(body: Column) -> Column:
    return body.rlike(r"(?i)govinfo\.gov/error")


def publication(url: Column) -> Column:
    """The number of a cost estimate's publication page."""
    return _found(F.trim(url), r"^https?://www\.cbo\.gov/publication/([1-9][0-9]*)$")


def law_table_file(key: Column) -> Column:
    """The file of a public law's or an earlier chapter's table: ``118-5`` as ``118_5.htm``."""
    known = key.rlike(r"^([1-9][0-9]{0,2}-[1-9][0-9]*|(1[789]|20)[0-9]{2}:[1-9][0-9]*)$")
    return F.when(known, F.concat(F.translate(key, "-:", "__"), F.lit(".htm")))


def register_series(number: Column) -> Column:
    """A mirror's ``C7-`` spelling of a document number as the register's ``Z7-``; others as they are."""
    return F.regexp_replace(number, r"^C7-([1-9]\d{4})$", "Z7-$1")


def names_activity(title: Column) -> Column:
    return F.coalesce(F.lower(title).contains("activit"), F.lit(False))


def camel(column: str) -> str:
    """The attribute of a column in a publisher's record: ``a_b_json`` is ``aB``."""
    first, *more = column.removesuffix("_json").split("_")
    return first + "".join(w[:1].upper() + w[1:] for w in more)


def cycles(through: int, first: int = 1980) -> list[int]:
    """Two-year election cycles from ``first`` up to the one that ``through`` lies in."""
    return list(range(first, through + through % 2 + 1, 2))
