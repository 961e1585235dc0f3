"""Paragraphs of a printed section as a tree, by the designations in front of their lines."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from recordloom.sources.structured import read_rows

_HEAD = re.compile(r"\s*((?:\([A-Za-z0-9]{1,5}\)\s*)+)")
_ROMAN = re.compile(r"x{0,3}(?:ix|iv|v?i{0,3})$")
_VALUE = {"i": 1, "v": 5, "x": 10}


def _place(level: int, mark: str) -> int | None:
    """Which of its level a designation is, from 1: letters, numbers, small Roman numerals, capitals."""
    if level == 1:
        return int(mark) if mark.isdigit() else None
    if level == 2:
        if not mark or not _ROMAN.match(mark):
            return None
        v = [_VALUE[c] for c in mark]
        return sum(-a if a < b else a for a, b in zip(v, [*v[1:], 0], strict=True))
    case = "abcdefghijklmnopqrstuvwxyz" if level == 0 else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return case.index(mark[0]) + 1 + 26 * (len(mark) - 1) if mark[0] in case and mark == mark[0] * len(mark) else None


def outline_of(text: str | None) -> Iterator[tuple[int, str, int | None, str | None, bool]]:
    """``(line, mark, level, path, ambiguous)`` for each designation in front of a line.

    A mark continues the deepest open level whose next one it is, or opens the level
    below the deepest. Where both are possible it opens, and is ambiguous. One that
    is neither has no level and no path, and leaves the open levels as they are.
    """
    open_: list[tuple[int, str]] = []
    for n, line in enumerate((text or "").split("\n")):
        head = _HEAD.match(line)
        for mark in re.findall(r"\(([^)]+)\)", head[1]) if head else ():
            goes_on = next((i for i in range(len(open_) - 1, -1, -1) if _place(i, mark) == open_[i][0] + 1), None)
            opens = len(open_) <= 3 and _place(len(open_), mark) == 1
            level = len(open_) if opens else goes_on
            if level is not None:
                open_[level:] = [(_place(level, mark), mark)]
            yield n, mark, level, None if level is None else "".join(f"({m})" for _, m in open_), bool(opens and goes_on is not None)


def outline(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``key, line, mark, level, path, ambiguous`` for each text; a parent is the path without its last mark. Null texts have none."""
    fields = StructType([StructField("line", IntegerType()), StructField("mark", StringType()), StructField("level", IntegerType()), StructField("path", StringType()), StructField("ambiguous", BooleanType())])
    return read_rows(rows, key, text, fields, outline_of)
