"""Secret scans (operator 9): Aho-Corasick keywords, anchored patterns near their hits, embedded checksums."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from recordloom.llm.common import map_arrow, table

# The patterns of each kind, in their listed order.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm",
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = ("assign", "access", "hex", "github", "npm")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

_HEX_BYTES = np.zeros(256, bool)
_HEX_BYTES[[*b"0123456789abcdef"]] = True


@cache
def keywords() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def checksum_holds(body: str, check: str) -> bool:
    """Whether the last six letters of a token are the CRC-32 of its body in base 62."""
    left, letters = zlib.crc32(body.encode()), ""
    for _ in range(6):
        left, digit = divmod(left, 62)
        letters = BASE62[digit] + letters
    return letters == check


def hex_spans(text: str) -> list[tuple[int, int]]:
    """Runs of 24 or more of 0-9a-f. A run covers two neighbours among every 12th letter; only there is a pattern tried."""
    data = text.encode("utf-32-le") if not text.isascii() else text.encode()
    codes = np.frombuffer(data, "<u4" if not text.isascii() else np.uint8)[:: LEAST_HEX // 2]
    hits = _HEX_BYTES[np.minimum(codes, 255)]
    found, done = [], 0
    for j in (np.flatnonzero(hits[:-1] & hits[1:]) * (LEAST_HEX // 2)).tolist():
        if j >= done:
            start = j
            while start > done and text[start - 1] in "0123456789abcdef":
                start -= 1
            done = HEX.match(text, start).end()
            if done - start >= LEAST_HEX:
                found.append((start, done))
    return found


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """All spans ``(start, end, kind)`` of a text in code points, by start, then kind as listed."""
    if not text:
        return []
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c.lower() if c.isascii() else c for c in text)
    found = [(s, e, "hex") for s, e in hex_spans(text)]
    starts: dict[str, list[int]] = {}
    for last, (kind, n) in keywords().iter(lower):
        starts.setdefault(kind, []).append(last + 1 - n)
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("github", GITHUB), ("npm", NPM)):
        done = 0
        for start in sorted(starts.get(kind, ())):
            if start >= done and (m := pattern.match(text, start)):
                done = m.end()
                if (
                    kind == "assign" and len(m[2]) >= LEAST_VALUE
                    or kind == "access" and len(m[0]) >= LEAST_ACCESS
                    or kind in ("github", "npm") and checksum_holds(m[1], m[2])
                ):
                    found.append((start, done, kind))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def redact(text: str | None) -> str | None:
    """The text with every stretch of overlapping spans replaced by the first one's kind in brackets."""
    out, at = [], 0
    for start, end, kind in spans(text):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def _joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def secret_scan(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    The base kinds are assign, access and hex; tokens with an embedded checksum
    (github, npm) are added only where the checksum holds. Null and empty texts have
    no spans: counts of 0, the digest of nothing, empty ``spans``. Repeated rows
    repeat, an empty table gives none, other columns are not read.
    """
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *(StructField(f"n_{k}", LongType()) for k in KINDS[:3]), StructField("base_sha256", StringType()), StructField("spans", StringType())])

    def run(ids: list, texts: list) -> list:
        every = [spans(t) for t in texts]
        base = [[s for s in found if s[2] in KINDS[:3]] for found in every]
        counts = [[sum(s[2] == k for s in found) for found in base] for k in KINDS[:3]]
        return [ids, *counts, [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base], [_joined(f) for f in every]]

    return map_arrow(docs.select("doc_id", "text"), run, schema)


def redacted(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with each secret in ``text`` replaced by its kind in brackets."""
    at, arrow = docs.columns.index("text"), to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array(map(redact, batch.column(at).to_pylist()), arrow.field(at).type)
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema.set(at, batch.schema.field(at).with_type(texts.type)))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))
