"""Contracts of published tables, and rows shaped to them from nested records.

A shape names each column with the path or SQL expression that it is read from. All
values are text: booleans are ``true`` and ``false``, lists and structs are JSON, and
what a record doesn't state is null. Everything is a projection, so Catalyst prunes
the nested fields that no column asks for.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

_PATH = re.compile(r"[A-Za-z_]\w*(\.\w+|\[\d+\])*")


def _stated(kind: DataType, path: str) -> bool:
    """Whether a path leads to a field of a type."""
    for step in re.findall(r"\w+(?=\.|\[|$)|\[\d+\]", path):
        if step.startswith("["):
            if not isinstance(kind, ArrayType):
                return False
            kind = kind.elementType
            continue
        while isinstance(kind, ArrayType):  # a field of all entries
            kind = kind.elementType
        if isinstance(kind, StructType) and step in kind.names:
            kind = kind[step].dataType
        elif isinstance(kind, MapType):
            kind = kind.valueType
        else:
            return False
    return True


def read(df: DataFrame, path: str) -> Column:
    """A path of ``df``, or null where its records have no such field; anything else is an expression."""
    if _PATH.fullmatch(path) and path.lower() not in ("null", "true", "false"):
        if not _stated(df.schema, path):
            return F.lit(None).cast("string")
        return F.expr(_nested(path))
    return F.expr(path)


def _nested(path: str) -> str:
    """``a.b[0].c`` with list places that may not be there."""
    out = ""
    for step in re.findall(r"\w+|\[\d+\]", path):
        out = f"get({out}, {step[1:-1]})" if step.startswith("[") else f"{out}.{step}" if out else step
    return out


def as_text(value: Column, kind: DataType) -> Column:
    return F.to_json(value) if isinstance(kind, (ArrayType, StructType, MapType)) else value.cast("string")


def shaped(df: DataFrame, shape: Mapping[str, str]) -> DataFrame:
    """``df`` as the columns of ``shape``, all text. Columns of ``df`` that the shape doesn't read are left out."""
    drawn = df.select(*(read(df, path).alias(name) for name, path in shape.items()))
    return drawn.select(*(as_text(F.col(f.name), f.dataType).alias(f.name) for f in drawn.schema))


def numbered(df: DataFrame, items: str, item: str, index: str) -> DataFrame:
    """One row for each entry of the list ``items``, with its place from 0; none for a null or empty list."""
    return df.select("*", F.posexplode(items).alias(index, item))


def key_text(*parts: Column) -> Column:
    """The spelling of a key: one part as it is, several as a JSON array. A null or empty part has none."""
    there = parts[0].isNotNull() & (parts[0] != "")
    for p in parts[1:]:
        there &= p.isNotNull() & (p != "")
    return F.when(there, parts[0] if len(parts) == 1 else F.to_json(F.array(*parts)))


@dataclass(frozen=True)
class TableContract:
    """A table's name, columns in order, identity, version, and the tables that columns refer to."""

    name: str
    columns: tuple[str, ...]
    identity: tuple[str, ...]
    version: str = "1"
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def __post_init__(self):
        odd = [c for c in (*self.identity, *self.references) if c not in self.columns]
        if odd or not self.identity or len(set(self.columns)) < len(self.columns):
            raise ValueError(f"{self.name}: identity and references must be columns, each named once: {odd}")

    def key(self) -> Column:
        return F.struct(*self.identity)

    def spelled_key(self) -> Column:
        return key_text(*(F.col(c) for c in self.identity))

    def checked(self, df: DataFrame) -> DataFrame:
        """``df`` in the contract's order of columns, with ``refused``: null, or why a row isn't admitted.

        A table with other columns, or columns that aren't text, is an error. Rows are
        refused as data: ``no_identity``, or ``repeated_identity`` for every row of a key
        that several have.
        """
        missing, more = set(self.columns) - set(df.columns), set(df.columns) - set(self.columns)
        other = [f.name for f in df.schema if f.name in self.columns and f.dataType.typeName() != "string"]
        if missing or more or other:
            raise ValueError(f"{self.name}: columns missing {sorted(missing)}, unknown {sorted(more)}, not text {other}")
        rows = df.select(*self.columns).withColumn("spelled", self.spelled_key())
        many = rows.where("spelled is not null").groupBy("spelled").agg(F.count("*").alias("n")).where("n > 1").select(F.col("spelled").alias("again"))
        met = rows.join(many, F.col("spelled") == F.col("again"), "left")
        return met.select(*self.columns, F.when(F.col("spelled").isNull(), "no_identity").when(F.col("again").isNotNull(), "repeated_identity").alias("refused"))

    def dangling(self, df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
        """``column, value, rows`` for each stated reference to a row that the other table hasn't."""
        out = None
        for column, (table, other) in self.references.items():
            if table in tables:
                there = tables[table].select(F.col(other).alias("value")).where("value is not null")
                lost = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows")).join(there, "value", "left_anti")
                lost = lost.select(F.lit(column).alias("column"), "value", "rows")
                out = lost if out is None else out.unionByName(lost)
        if out is None:
            raise ValueError(f"{self.name} refers to none of {sorted(tables)}")
        return out


def latest_place(df: DataFrame, items: str, latest: str, same: tuple[str, ...]) -> Column:
    """The place of the last entry of ``items`` that agrees with ``latest`` in the fields ``same``; null if none does."""
    agrees = " and ".join(f"x.{f} <=> {latest}.{f}" for f in same)
    return F.expr(f"nullif(array_max(transform({items}, (x, i) -> if({agrees}, i, -1))), -1)")


def first_stated(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """One row for each key with every column's first stated value by ``order``: a list entry behind its detail, merged."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = df.select(*keys, *order, *(F.first(c, ignorenulls=True).over(w).alias(c) for c in columns), F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("place"))
    return filled.where("place = 1").select(*keys, *columns)
