"""Lists and ranges of statute and regulation sections: each named section is one row.

``5 U.S.C. 552, 553(a) and 555-557`` names three sections and a range. Texts pass
through Python in Arrow batches, as Spark's regular expressions give no offsets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from recordloom.operators.extract import CFR_TITLES, USC_RESERVED, USC_TITLES

_MARK = r"(?:\s*§§?|\s+(?:sections?|secs?\.|parts?|pts?\.))?"
_HEAD = re.compile(rf"(?<![\w.])(\d{{1,2}})\s+(?:(U\.\s?S\.\s?C\.(?:\s?A\.)?|USC)|(C\.\s?F\.\s?R\.|CFR)){_MARK}\s*(?=\d)")
_PINS = r"((?:\([A-Za-z0-9]{1,5}\))*)"
_SECTION = {
    "code": re.compile(rf"(\d{{1,5}}[A-Za-z]{{0,3}}(?:-\d{{1,4}}[a-z]{{0,2}})?){_PINS}(?![\w])"),
    "regulations": re.compile(rf"(\d{{1,4}}(?:\.\d{{1,4}}[a-z]{{0,2}}(?:-\d{{1,3}}[A-Z]?)?)?){_PINS}(?![\w])"),
}
_RANGE = re.compile(r"\s*(?:through|to|[–—])\s*(?:§§?\s*)?(?=\d)|-(?=\d)")
_NEXT = re.compile(rf"(?:\s*[,;]\s*(?:and\s+|or\s+)?|\s+(?:and|or|&)\s+)(?:§§?\s*|parts?\s+|sections?\s+)?(?=\d)")
_TAIL = re.compile(r"\s*(et seq\.?|notes?\b)|\s*\((note)\)")
#: A number of a list that another kind of unit claims: a date, a further title, a count of things.
_CLAIMED = re.compile(r"\s+(?:U\.\s?S\.|USC|C\.\s?F\.|CFR|Fed\.|FR\b|F\.\s?R\.|Stat\.|days?\b|months?\b|years?\b|percent\b)|\s*%")


@dataclass(frozen=True)
class Coordinate:
    """A section, or a range from ``section`` to ``last``; ``note`` is ``et_seq`` or ``note``; ``refused`` says why it isn't one."""

    kind: str
    title: int
    section: str
    last: str | None
    pinpoint: str | None
    note: str | None
    start: int
    end: int
    refused: str | None


def _order(section: str) -> tuple:
    return tuple((0, int(p)) if p.isdigit() else (1, p) for p in re.findall(r"\d+|[A-Za-z]+", section))


def coordinates_of(text: str | None) -> list[Coordinate]:
    """All sections that a text names, in order. A range that runs backwards, or a title that doesn't exist, is refused."""
    out, text = [], text or ""
    for head in _HEAD.finditer(text):
        kind, title = ("code" if head[2] else "regulations"), int(head[1])
        bad = "no_such_title" if not 1 <= title <= (USC_TITLES if head[2] else CFR_TITLES) or (head[2] and title in USC_RESERVED) else None
        at, first, pattern = head.end(), True, _SECTION[kind]
        while (m := pattern.match(text, at)) and (first or not _CLAIMED.match(text, m.end())):
            last, end = None, m.end()
            if (r := _RANGE.match(text, end)) and (n := pattern.match(text, r.end())) and not _CLAIMED.match(text, n.end()):
                last, end = n[1], n.end()
            note = _TAIL.match(text, end)
            if note:
                end = note.end()
            backwards = last and _order(last) <= _order(m[1])
            out.append(Coordinate(kind, title, m[1], last, m[2] or None, note and ("et_seq" if (note[1] or "").startswith("et") else "note"), head.start() if first else m.start(), end, bad or ("backwards" if backwards else None)))
            more = _NEXT.match(text, end)
            if not more:
                break
            at, first = more.end(), False
    return out


def coordinates(rows: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each named section, with the fields of ``Coordinate``. Null and empty texts have none."""
    kinds = {"title": IntegerType(), "start": IntegerType(), "end": IntegerType()}
    schema = StructType([StructField(key, rows.schema[key].dataType), *(StructField(f, kinds.get(f, StringType())) for f in Coordinate.__dataclass_fields__)])
    types = [f.type for f in to_arrow_schema(schema)][1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *astuple(c)) for i, t in enumerate(batch.column(1).to_pylist()) for c in coordinates_of(t)]
            of, *columns = list(zip(*found, strict=True)) or [()] * (len(types) + 1)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, types, strict=True))], schema.names)

    return rows.select(key, text).where(F.col(text).isNotNull()).mapInArrow(run, schema)


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours between two words; what was swapped may be edited on."""
    far = len(a) + len(b)
    cost = {(-1, j): far for j in range(-1, len(b) + 1)} | {(i, -1): far for i in range(len(a) + 1)}
    cost |= {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    row_of: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        column = 0  # the last place in b of this row that matched
        for j, y in enumerate(b, 1):
            row, met = row_of.get(y, 0), column
            if x == y:
                column = j
            swap = cost[row - 1, met - 1] + (i - row - 1) + 1 + (j - met - 1) if row and met else far
            cost[i, j] = min(cost[i - 1, j - 1] + (x != y), cost[i, j - 1] + 1, cost[i - 1, j] + 1, swap)
        row_of[x] = i
    return cost[len(a), len(b)]
