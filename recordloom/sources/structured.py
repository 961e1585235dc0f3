"""JSON and markup with places: array members, closed shapes, canonical text, events; JSON as XML and back."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

_SPACE = re.compile(r"[ \t\r\n]*")


def read_rows(rows: DataFrame, key: str, body: str, fields: StructType, read) -> DataFrame:
    """``read(text)`` gives tuples of ``fields``; each becomes a row with the key of its text. Null texts give none."""
    schema = StructType([StructField(key, rows.schema[key].dataType), *fields])
    types = [f.type for f in to_arrow_schema(fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *x) for i, t in enumerate(batch.column(1).to_pylist()) for x in read(t)]
            of, *columns = list(zip(*found, strict=True)) or [()] * (len(types) + 1)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, types, strict=True))], schema.names)

    return rows.select(key, body).where(F.col(body).isNotNull()).mapInArrow(run, schema)


def members_of(text: str) -> Iterator[tuple[int, str | None, int, int, str | None]]:
    """Members ``(ordinal, json, start, end, refused)`` of a JSON array, in code points; one refusal ends the text."""
    at, decoder = _SPACE.match(text, 0).end(), json.JSONDecoder()
    if not text.startswith("[", at):
        yield 0, None, at, at, "not_an_array"
        return
    at, n = _SPACE.match(text, at + 1).end(), 0
    if not text.startswith("]", at):
        while True:
            try:
                _, end = decoder.raw_decode(text, at)
            except (ValueError, RecursionError):
                yield n, None, at, at, "malformed"
                return
            yield n, text[at:end], at, end, None
            n, at = n + 1, _SPACE.match(text, end).end()
            if not text.startswith(",", at):
                break
            at = _SPACE.match(text, at + 1).end()
    if not text.startswith("]", at) or _SPACE.match(text, at + 1).end() < len(text):
        yield n, None, at, at, "malformed"


def json_members(rows: DataFrame, key: str, body: str) -> DataFrame:
    """``key, ordinal, member, start, end, refused`` for each member of a text's top-level array."""
    fields = StructType([StructField("ordinal", IntegerType()), StructField("member", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("refused", StringType())])
    return read_rows(rows, key, body, fields, members_of)


def shape_problem(body: Column, allowed: Sequence[str], required: Sequence[str] = ()) -> Column:
    """``not_an_object``, ``unknown_key`` or ``missing_key`` for a JSON object of a closed shape, else null; null text is no object."""
    keys = F.json_object_keys(body)
    unknown = F.size(F.array_except(keys, F.array(*map(F.lit, allowed)))) > 0
    missing = F.size(F.array_except(F.array(*map(F.lit, required)), keys)) > 0 if required else F.lit(False)
    return F.when(keys.isNull(), "not_an_object").when(unknown, "unknown_key").when(missing, "missing_key")


def canonical_json(text: str | None) -> str | None:
    """Compact JSON with sorted keys and ASCII escapes; null for what isn't JSON, repeats a key, or holds NaN or infinity."""

    def once(pairs: list) -> dict:
        if len(dict(pairs)) < len(pairs):
            raise ValueError
        return dict(pairs)

    try:
        return None if text is None else json.dumps(json.loads(text, object_pairs_hook=once, parse_constant=lambda c: 1 / 0), sort_keys=True, separators=(",", ":"), allow_nan=False)
    except (ValueError, ArithmeticError, RecursionError):
        return None


def with_canonical(rows: DataFrame, key: str, body: str) -> DataFrame:
    return read_rows(rows, key, body, StructType([StructField("canonical", StringType())]), lambda t: [(canonical_json(t),)])


def json_to_xml(text: str) -> str:
    """A JSON value as XML whose tags say its types; letters that XML can't hold are backslash escapes."""
    safe = lambda s: escape(re.sub(r"[\\\x00-\x1f\ud800-\udfff￾￿]", lambda m: f"\\u{ord(m[0]):04x}", s))

    def write(v, name: str = "") -> str:
        if v is None:
            return f"<null{name}/>"
        if isinstance(v, bool):
            return f"<bool{name}>{str(v).lower()}</bool>"
        if isinstance(v, _Number):
            return f"<number{name}>{v}</number>"
        if isinstance(v, str):
            return f"<text{name}>{safe(v)}</text>"
        if isinstance(v, dict):
            return f"<object{name}>" + "".join(write(x, " name=" + quoteattr(re.sub(r"[\\\x00-\x1f\ud800-\udfff￾￿]", lambda m: f"\\u{ord(m[0]):04x}", k))) for k, x in v.items()) + "</object>"
        return f"<array{name}>" + "".join(map(write, v)) + "</array>"

    return write(json.loads(text, parse_int=_Number, parse_float=_Number))


class _Number(str):
    """A number as it was written."""


def xml_to_json(text: str) -> str:
    """What ``json_to_xml`` wrote, as compact JSON; numbers are as they were."""
    plain = lambda s: re.sub(r"\\u([0-9a-f]{4})", lambda m: chr(int(m[1], 16)), s or "")

    def read(e: ElementTree.Element) -> str:
        if e.tag == "null":
            return "null"
        if e.tag in ("bool", "number"):
            return e.text
        if e.tag == "text":
            return json.dumps(plain(e.text))
        if e.tag == "object":
            return "{" + ",".join(json.dumps(plain(x.get("name"))) + ":" + read(x) for x in e) + "}"
        return "[" + ",".join(map(read, e)) + "]"

    return read(ElementTree.fromstring(text))


class _Events(HTMLParser):
    def __init__(self, text: str):
        super().__init__(convert_charrefs=False)
        self.found: list[tuple[str, str, int]] = []
        self.lines = [0, *(m.end() for m in re.finditer("\n", text))]
        self.feed(text)
        self.close()

    def _add(self, kind: str, value: str) -> None:
        line, column = self.getpos()
        self.found.append((kind, value, self.lines[line - 1] + column))

    def handle_starttag(self, tag, attrs):
        self._add("start", tag)

    def handle_startendtag(self, tag, attrs):
        self._add("empty", tag)

    def handle_endtag(self, tag):
        self._add("end", tag)

    def handle_data(self, data):
        self._add("text", data)

    def handle_entityref(self, name):
        self._add("entity", name)

    def handle_charref(self, name):
        self._add("entity", "#" + name)

    def handle_comment(self, data):
        self._add("comment", data)

    def handle_decl(self, decl):
        self._add("declaration", decl)

    def unknown_decl(self, data):
        self._add("declaration", data)

    def handle_pi(self, data):
        self._add("instruction", data)


def html_events(rows: DataFrame, key: str, body: str) -> DataFrame:
    """``key, seq, kind, value, start, end``: tags, texts, entities, comments, declarations and instructions of tolerant HTML, in order.

    Events cover the text from the first one on; each ends where the next begins.
    """

    def read(text: str) -> Iterator[tuple]:
        found = _Events(text).found
        ends = [s for _, _, s in found[1:]] + [len(text)] * bool(found)
        yield from ((i, k, v, s, e) for i, ((k, v, s), e) in enumerate(zip(found, ends, strict=True)))

    fields = StructType([StructField("seq", IntegerType()), StructField("kind", StringType()), StructField("value", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
    return read_rows(rows, key, body, fields, read)
