"""Readers of retained files: archives, XML, feeds, strict JSON and CSV, and facts of PDF and image bytes.

Whole files come from ``spark.read.format("binaryFile")`` as ``path, content``. Every
reader gives a refused file a row with the reason; none fails the job.
"""

from __future__ import annotations

import io
import json
import struct
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def _exploded(rows: DataFrame, key: str, body: str, schema: str, read: Callable[[bytes], Iterator[tuple]], each: int = 64) -> DataFrame:
    """Rows ``key`` plus what ``read`` yields for each body, in batches of ``each`` rows or 16 MB."""
    full = StructType([rows.schema[key], *StructType.fromDDL(schema)])
    arrow = to_arrow_schema(full)
    made_of = lambda made: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), arrow, strict=True)], full.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, size = [], 0
            for k, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for row in read(b) if b is not None else ():
                    made.append((k, *row))
                    size += sum(len(v) for v in row if isinstance(v, bytes | str))
                    if len(made) >= each or size > 1 << 24:
                        yield made_of(made)
                        made, size = [], 0
            if made:
                yield made_of(made)

    return rows.select(key, body).mapInArrow(run, full)


def zip_members(files: DataFrame, *, key: str = "path", max_entries: int = 10_000, max_bytes: int = 1 << 28) -> DataFrame:
    """``path, ordinal, name, size, content, refused`` for each member in the archive's order.

    An unreadable archive, or one of too many entries, is one row with a reason; a member that
    is repeated, encrypted, too large or damaged keeps its row without content.
    """

    def read(body: bytes) -> Iterator[tuple]:
        try:
            archive = zipfile.ZipFile(io.BytesIO(body))
        except (zipfile.BadZipFile, ValueError, NotImplementedError):
            yield None, None, None, None, "not_a_zip"
            return
        infos = archive.infolist()
        if len(infos) > max_entries:
            yield None, None, None, None, "too_many_entries"
            return
        seen: set[str] = set()
        for i, info in enumerate(infos):
            refused = "repeated_name" if info.filename in seen else "encrypted" if info.flag_bits & 1 else "too_large" if info.file_size > max_bytes else None
            seen.add(info.filename)
            content = None
            if not refused and not info.is_dir():
                try:
                    with archive.open(info) as member:
                        content = member.read(max_bytes + 1)
                    refused = "size_differs" if len(content) != info.file_size else None
                except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, OSError):
                    refused = "damaged"
            yield i, info.filename, info.file_size, None if refused else content, refused

    return _exploded(files, key, "content", "ordinal int, name string, size long, content binary, refused string", read)


def xml_nodes(rows: DataFrame, key: str, body: str, *, max_depth: int = 256) -> DataFrame:
    """``key, ordinal, path, tag, attributes, text, refused`` for each element in document order.

    ``path`` counts equal siblings from 1; ``attributes`` is JSON; ``text`` is the element's
    own text before its first child. Entity declarations, depth beyond the bound
    and malformed input give one row with the reason after what was read.
    """

    def read(raw: bytes | str) -> Iterator[tuple]:
        raw = raw.encode() if isinstance(raw, str) else raw
        if b"<!ENTITY" in raw:
            yield None, None, None, None, None, "entity_declared"
            return
        try:
            root = ET.fromstring(raw)
        except (ET.ParseError, ValueError, LookupError):
            yield None, None, None, None, None, "malformed"
            return
        waiting, n = [(root, f"/{root.tag}[1]", 1)], 0
        while waiting:
            node, path, depth = waiting.pop()
            if depth > max_depth:
                yield None, path, None, None, None, "too_deep"
                return
            yield n, path, node.tag, json.dumps(node.attrib, ensure_ascii=False, sort_keys=True), node.text, None
            n += 1
            counts: dict[str, int] = {}
            below = []
            for child in node:
                if isinstance(child.tag, str):
                    counts[child.tag] = counts.get(child.tag, 0) + 1
                    below.append((child, f"{path}/{child.tag}[{counts[child.tag]}]", depth + 1))
            waiting += reversed(below)

    return _exploded(rows, key, body, "ordinal int, path string, tag string, attributes string, text string, refused string", read, 4096)


def xml_records(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Elements of large XML files as rows by Spark's own splittable reader; bad ones in ``_corrupt_record``."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("rowTag", row_tag).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").xml(path)


# The elements of the public feed and listing formats.
FEED = "channel struct<title:string, link:string, item:array<struct<title:string, link:string, guid:string, pubDate:string, description:string>>>"
SITEMAP = "url array<struct<loc:string, lastmod:string, changefreq:string, priority:string>>"
LISTING = "Name string, Prefix string, IsTruncated boolean, NextContinuationToken string, Contents array<struct<Key:string, LastModified:string, ETag:string, Size:bigint>>"


def feed_items(rows: DataFrame, key: str, body: str) -> DataFrame:
    """``key, ordinal`` and the fields of each item of an RSS 2.0 channel."""
    return rows.select(key, F.posexplode(F.from_xml(F.col(body).cast("string"), FEED).channel["item"]).alias("ordinal", "i")).select(key, "ordinal", "i.*")


def sitemap_urls(rows: DataFrame, key: str, body: str) -> DataFrame:
    return rows.select(key, F.posexplode(F.from_xml(F.col(body).cast("string"), SITEMAP)["url"]).alias("ordinal", "i")).select(key, "ordinal", "i.*")


def listed_objects(rows: DataFrame, key: str, body: str) -> DataFrame:
    """``key, next_token, ordinal`` and each object of a bucket listing; the token is null on a last page."""
    page = rows.select(key, F.from_xml(F.col(body).cast("string"), LISTING).alias("p"))
    return page.select(key, F.when(F.col("p.IsTruncated"), F.col("p.NextContinuationToken")).alias("next_token"), F.posexplode("p.Contents").alias("ordinal", "i")).select(key, "next_token", "ordinal", F.col("i.Key").alias("name"), F.col("i.Size").alias("size"), F.col("i.ETag").alias("etag"), F.col("i.LastModified").alias("modified"))


def json_status(text: str | bytes | None, *, floats: bool = True, max_depth: int = 64) -> str:
    """``valid``, or why a JSON document is refused: ``absent``, ``malformed``, ``repeated_key``, ``not_finite``, ``float`` or ``too_deep``."""

    class Refused(Exception):
        pass

    def pairs(items: list[tuple]) -> dict:
        if len({k for k, _ in items}) < len(items):
            raise Refused("repeated_key")
        return dict(items)

    def number(x: str) -> float:
        if not floats:
            raise Refused("float")
        if abs(value := float(x)) == float("inf"):
            raise Refused("not_finite")
        return value

    def constant(_: str) -> None:
        raise Refused("not_finite")

    if text is None:
        return "absent"
    try:
        top = json.loads(text, object_pairs_hook=pairs, parse_float=number, parse_constant=constant)
    except Refused as why:
        return str(why)
    except RecursionError:
        return "too_deep"
    except ValueError:
        return "malformed"
    level, depth = [top], 0
    while level := [y for x in level if isinstance(x, dict | list) for y in (x.values() if isinstance(x, dict) else x)]:
        depth += 1
        if depth > max_depth:
            return "too_deep"
    return "valid"


def strict_json(rows: DataFrame, key: str, body: str, *, floats: bool = True, max_depth: int = 64) -> DataFrame:
    """``key, status`` for each row whose body isn't null; see ``json_status``."""
    return _exploded(rows, key, body, "status string", lambda b: iter([(json_status(b, floats=floats, max_depth=max_depth),)]), 4096)


def quoted_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A dump in which every value is quoted and null is an unquoted empty field; any other record fails the read.

    A mark that no text holds stands for null, as Spark else reads ``""`` as null too.
    """
    options = {"header": True, "quote": '"', "escape": "\\", "multiLine": True, "mode": "FAILFAST", "nullValue": "\x01", "emptyValue": "", "enforceSchema": False}
    return spark.read.schema(schema).options(**options).csv(path)


def delimited(spark: SparkSession, path: str, names: Sequence[str], separator: str = "|") -> DataFrame:
    """Lines of a headerless file by a stated list of names; ``refused`` is ``width`` where a line has another number of fields."""
    cut = spark.read.text(path).select("value", F.split("value", f"\\Q{separator}\\E", -1).alias("f"))
    whole = F.size("f") == len(names)
    return cut.select(*(F.when(whole, F.get("f", F.lit(i))).alias(n) for i, n in enumerate(names)), F.when(~whole, "width").alias("refused"))


def pdf_facts(content: Column) -> Column:
    """A PDF's ``version, linearized_length, last_xref, refused`` from its bytes."""
    head = F.decode(F.substring(content, 1, 1024), "ISO-8859-1")
    tail = F.decode(F.substring(content, -2048, 2048), "ISO-8859-1")
    version = F.regexp_extract(head, r"^%PDF-(\d\.\d)", 1)
    number = lambda text, pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).cast("long")
    refused = F.when(content.isNull(), "absent").when(version == "", "no_header").when(~tail.contains("%%EOF"), "no_trailer")
    xref = number(tail, r"(?s)startxref\s+(\d+)\s+%%EOF(?!.*startxref)")
    return F.struct(F.nullif(version, F.lit("")).alias("version"), number(head, r"/Linearized[^>]*/L\s+(\d+)").alias("linearized_length"), xref.alias("last_xref"), refused.alias("refused"))


def image_size(content: bytes) -> tuple[str | None, int | None, int | None]:
    """Format, width and height from the header of a PNG, GIF or JPEG. A header that ends too early has its format alone; anything else has nulls."""
    if content[:8] == b"\x89PNG\r\n\x1a\n":
        return "png", *(struct.unpack(">II", content[16:24]) if content[12:16] == b"IHDR" and len(content) >= 24 else (None, None))
    if content[:6] in (b"GIF87a", b"GIF89a"):
        return "gif", *(struct.unpack("<HH", content[6:10]) if len(content) >= 10 else (None, None))
    if content[:3] != b"\xff\xd8\xff":
        return None, None, None
    at = 2
    while at + 1 < len(content) and content[at] == 0xFF:
        marker = content[at + 1]
        if marker == 0xFF:  # fill before a marker
            at += 1
        elif marker == 0x01 or 0xD0 <= marker <= 0xD7:  # markers without a segment
            at += 2
        elif marker in (0xD9, 0xDA):  # the end, or the image itself
            break
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            if at + 9 > len(content):
                break
            height, width = struct.unpack(">HH", content[at + 5 : at + 9])
            return "jpeg", width, height
        else:
            at += 2 + max(2, int.from_bytes(content[at + 2 : at + 4], "big"))
    return "jpeg", None, None


def image_headers(files: DataFrame, key: str = "path", body: str = "content") -> DataFrame:
    """``key, format, width, height`` of image files."""
    return _exploded(files, key, body, "format string, width int, height int", lambda b: iter([image_size(b)]), 4096)


def verified(files: DataFrame, expected: DataFrame) -> DataFrame:
    """``path, outcome`` of files ``(path, content)`` against ``(path, size, sha256)``."""
    got = files.select("path", F.length("content").alias("n"), F.sha2("content", 256).alias("d"))
    both = expected.join(got, "path", "full")
    outcome = F.when(F.col("d").isNull(), "missing").when(F.col("sha256").isNull(), "unexpected").when(F.col("n") != F.col("size"), "size_differs").when(F.col("d") != F.col("sha256"), "digest_differs").otherwise("verified")
    return both.select("path", outcome.alias("outcome"))
