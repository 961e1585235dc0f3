"""Findings in texts: kinds of patterns with keys, spans and stated refusals.

Spark's regular expressions give no offsets, so texts pass through Python in Arrow
batches, each once for all rules. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: A key, or a reason to refuse that starts with ``!``.
Key = Callable[[re.Match], str]


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    key: Key


def _numbered(kind: str, pattern: str, low: int, high: int, shape: str, reserved: Sequence[int] = ()) -> Rule:
    """A rule whose first group is a number in bounds; ``shape`` formats all groups."""

    def key(m: re.Match) -> str:
        n = int(m[1])
        if not low <= n <= high or n in reserved:
            return "!out_of_bounds"
        return shape.format(*(g.replace(",", "") if g else "" for g in m.groups()))

    return Rule(kind, pattern, key)


_DASH = "[-‐-―]"
_BILL_TYPES = {"HR": "hr", "S": "s", "HJRES": "hjres", "SJRES": "sjres", "HCONRES": "hconres", "SCONRES": "sconres", "HRES": "hres", "SRES": "sres"}
_SCALE = {"": 1, "thousand": 10**3, "million": 10**6, "billion": 10**9, "trillion": 10**12}


def _bill(m: re.Match) -> str:
    return f"{_BILL_TYPES[re.sub('[^A-Z]', '', m[1].upper())]}-{int(m[2])}"


def _dollars(m: re.Match) -> str:
    whole, _, cents = m[1].replace(",", "").partition(".")
    units = int(whole + cents) * _SCALE[(m[2] or "").lower()] * 100
    return str(units // 10 ** len(cents))


def _upper(m: re.Match) -> str:
    return re.sub(_DASH, "-", m[0]).upper()


# Bounds of the numberings.
CFR_TITLES, USC_TITLES, USC_RESERVED, FIRST_NUMBERED_CONGRESS, CURRENT_CONGRESS = 50, 54, (53,), 57, 119

#: In order of precedence between findings of equal span.
RULES = (
    Rule("rin", rf"(?<![\w-])\d{{4}}{_DASH}[A-Za-z]{{2}}\d{{2}}(?![\w-])", _upper),
    Rule("fr_document", rf"(?<=FR Doc\. )\d{{4}}{_DASH}\d{{3,5}}(?!\w)", _upper),
    Rule("document", r"(?<![\w-])[A-Z]{2,}(?:-[A-Z]+)*-\d{4}-\d{4,5}-\d{4,}(?![\w-])", _upper),
    Rule("docket", r"(?<![\w-])[A-Z]{2,}(?:-[A-Z]+)*-\d{4}-\d{4,5}(?![\w-])", _upper),
    _numbered("public_law", rf"(?<!\w)(?:Public Law|Pub\. ?L\.|P\. ?L\.)(?: No\.)? ?(\d{{1,3}}){_DASH}(\d{{1,4}})(?!\w)", FIRST_NUMBERED_CONGRESS, CURRENT_CONGRESS, "{}-{}"),
    _numbered("statutes", r"(?<!\w)(\d{1,3}) Stat\. (\d{1,3}(?:,\d{3})+|\d{1,5})(?!\w)", 1, 999, "{} Stat. {}"),
    _numbered("register", r"(?<!\w)(\d{1,3}) (?:Fed\. ?Reg\.|FR|F\. ?R\.) (\d{1,3}(?:,\d{3})+|\d{1,6})(?!\w)", 1, 999, "{} FR {}"),
    _numbered("code", r"(?<!\w)(\d{1,2}) (?:U\. ?S\. ?C\.|USC)(?: §§?)? ?(\d{1,5}[A-Za-z]*(?:-\d+[a-z]*)?)((?:\([A-Za-z0-9]{1,4}\))*)", 1, USC_TITLES, "{} USC {}{}", USC_RESERVED),
    _numbered("regulations", r"(?<!\w)(\d{1,2}) (?:C\. ?F\. ?R\.|CFR)(?: [Pp]arts?| §§?)? ?(\d{1,4}(?:\.\d+[a-z]?(?:-\d+)?)?)((?:\([A-Za-z0-9]{1,4}\))*)", 1, CFR_TITLES, "{} CFR {}{}"),
    _numbered("reports", r"(?<!\w)(\d{1,3}) U\. ?S\. (\d{1,4})(?!\w)", 1, 999, "{} U.S. {}"),
    Rule("order", r"(?<!\w)(?:Executive Order|E\. ?O\.)(?: No\.)? (\d{1,2},?\d{3})(?!\w)", lambda m: m[1].replace(",", "")),
    Rule("bill", r"(?<![\w.])((?:H\. ?R|S|H\. ?J\. ?Res|S\. ?J\. ?Res|H\. ?Con\. ?Res|S\. ?Con\. ?Res|H\. ?Res|S\. ?Res)\.|HR|HJRES|SJRES|HCONRES|SCONRES|HRES|SRES) ?(\d{1,5})(?![\w(]| \()", _bill),
    Rule("gao_report", r"(?<![\w-])GAO-\d{2}-\d{2,6}[A-Z]*(?![\w-])", _upper),
    Rule("crs_report", r"(?<![\w-])(?:RL|RS|R|IF|IN|LSB)\d{5}(?![\w-])", _upper),
    Rule("bioguide", r"(?<![\w-])[A-Z]\d{6}(?![\w-])", _upper),
    Rule("fiscal_year", r"(?<!\w)(?:[Ff]iscal [Yy]ear|FY) ?(\d{4})(?!\w)", lambda m: m[1]),
    Rule("dollars", r"\$(\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?)(?: (thousand|million|billion|trillion))?(?!\w)", _dollars),
    Rule("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", lambda m: m[0]),
)


def findings_of(text: str | None, rules: Sequence[Rule] = RULES) -> list[tuple[str, str | None, int, int, str | None]]:
    """Findings ``(kind, key, start, end, refused)`` of one text.

    Of overlapping ones the earliest stays, of those that start together the longest,
    of equal spans the earlier rule. A refused one has no key and yields to others.
    """
    good, bad = [], []
    for rank, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or ""):
            key = rule.key(m)
            (bad if key.startswith("!") else good).append((m.start(), -m.end(), rank, key))
    kept = _swept(good)
    starts, ends = [f[0] for f in kept], [-f[1] for f in kept]
    free = [f for f in bad if (i := bisect.bisect_left(starts, -f[1])) == 0 or ends[i - 1] <= f[0]]
    out = [(rules[r].kind, k, s, -e, None) for s, e, r, k in kept] + [(rules[r].kind, None, s, -e, k[1:]) for s, e, r, k in _swept(free)]
    return sorted(out, key=lambda f: f[2])


def _swept(found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    out: list = []
    for f in sorted(found):
        if not out or f[0] >= -out[-1][1]:
            out.append(f)
    return out


def findings(rows: DataFrame, key: str, text: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row for each finding: ``key, kind, value, start, end, refused``. Null texts have none."""
    schema = StructType([StructField(key, rows.schema[key].dataType), StructField("kind", StringType()), StructField("value", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("refused", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, out = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                got = findings_of(t, rules)
                of += [i] * len(got)
                out += got
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], schema.names)

    return rows.select(key, text).where(F.col(text).isNotNull()).mapInArrow(run, schema)


def non_overlapping(candidates: DataFrame, key: str, start: str, end: str, order: Sequence[str] = ()) -> DataFrame:
    """The candidates that a sweep keeps in each key: earliest start, then longest, then ``order``.

    Each key's candidates are sorted by Spark and pass by one after another; only the
    last kept end is held, whatever the number of candidates.
    """
    schema = candidates.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reached = object(), 0
        for batch in batches:
            keep = []
            for k, s, e in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (key, start, end)), strict=True):
                if fresh := (k != at or s >= reached):
                    at, reached = k, e
                keep.append(fresh)
            yield batch.filter(pa.array(keep, pa.bool_()))

    dealt = candidates.where(F.col(start).isNotNull() & F.col(end).isNotNull()).repartition(key)
    return dealt.sortWithinPartitions(key, start, F.col(end).desc(), *order).mapInArrow(run, schema)
