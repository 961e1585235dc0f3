"""Benchmark decontamination by winnowing (operator 8).

Of every ``WINDOW`` neighbouring k-gram hashes the smallest (the last of equals) is
a fingerprint. Two texts that share ``K + WINDOW - 1`` words, 13 here, share a
fingerprint at the same place of the shared span, so joining training and test
fingerprints misses no such span. Hits are extended word by word in both
directions; what reaches the length of a window counts.

A benchmark of up to ``SLICE`` words is an index that is broadcast, and nothing is
shuffled. A larger one is a table of fingerprints that those of the documents are
joined with; only documents and items that meet there meet with their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from recordloom.llm.common import ROWS, Memo, filter_rows, map_arrow, materialize, own_names, table

#: A window of words, the k of a k-gram, and the k-gram hashes that one fingerprint is chosen among.
SPAN, K = 13, 5
WINDOW = SPAN - K + 1
#: Words of a benchmark up to which it is broadcast.
SLICE = 2_000_000

_SEPARATORS = [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c in _SEPARATORS else c for c in range(256))
_hash = Memo(lambda w: xxhash.xxh64_intdigest(w, 13), 150_000, alone=True)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hash.__getitem__, words), np.uint64, len(words))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, from the words' hashes."""
    n = len(hashes) - k + 1
    out = np.zeros(max(0, n), np.uint64)
    for i in range(k if n > 0 else 0):
        out = (out ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def winnow(hashes: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a text and where their k-grams begin: the last smallest hash of each window of hashes."""
    h = grams(hashes, k)
    if not len(h):
        return h, np.empty(0, np.int64)
    if window == 1:
        return h, np.arange(len(h))
    w = sliding_window_view(h, min(window, len(h)))
    at = np.unique(np.arange(len(w)) + w.shape[1] - 1 - w[:, ::-1].argmin(axis=1))
    return h[at], at


class Items:
    """Benchmark items with their fingerprints, sorted. Items of fewer than ``SPAN`` words are looked up whole, by length."""

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        self.words = [words_of(r[1]) for r in rows]
        prints, places = [], []
        short: dict[int, dict[int, list[int]]] = {}
        for i, words in enumerate(self.words):
            hashes = hashes_of(words)
            if len(words) >= SPAN:
                h, at = winnow(hashes)
                prints.append(h)
                places += [(i, a) for a in at.tolist()]
            elif words:
                short.setdefault(len(words), {}).setdefault(int(grams(hashes, len(words))[0]), []).append(i)
        prints = np.concatenate(prints or [np.empty(0, np.uint64)])
        order = np.argsort(prints, kind="stable")
        self.prints, self.places = prints[order], [places[j] for j in order.tolist()]
        self.short = {n: (np.sort(np.fromiter(by, np.uint64, len(by))), by) for n, by in short.items()}

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans (start, end) of ``words`` that lie in windows of items, and those items' positions."""
        spans, items = [], set()
        hashes = hashes_of(words)
        for n, (known, by) in self.short.items():
            h = grams(hashes, n)
            for at in np.flatnonzero(_among(h, known)).tolist():
                for i in by[int(h[at])]:
                    if words[at : at + n] == self.words[i]:
                        spans.append((at, at + n))
                        items.add(i)
        if len(words) >= SPAN and len(self.prints):
            h, at = winnow(hashes)
            done: dict[tuple[int, int], int] = {}
            for j in np.flatnonzero(_among(h, self.prints)).tolist():
                lo, hi = np.searchsorted(self.prints, h[j], "left"), np.searchsorted(self.prints, h[j], "right")
                here = int(at[j])
                for i, there in self.places[lo:hi]:
                    if here < done.get((i, here - there), 0):
                        continue
                    start, end = self.extended(words, here, self.words[i], there)
                    done[i, here - there] = end
                    if end - start >= SPAN:
                        spans.append((start, end))
                        items.add(i)
        return spans, items

    @staticmethod
    def extended(a: list[bytes], i: int, b: list[bytes], j: int) -> tuple[int, int]:
        """The longest run of ``a`` through position i that equals ``b`` through j; empty if the words there differ."""
        back, on = 0, 0
        while back < min(i, j) and a[i - back - 1] == b[j - back - 1]:
            back += 1
        while i + on < len(a) and j + on < len(b) and a[i + on] == b[j + on]:
            on += 1
        return i - back, i + on


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, h)
    return known[np.minimum(at, len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)


def _covered(spans: list[tuple[int, int]]) -> int:
    total, upto = 0, 0
    for start, end in sorted(spans):
        total += max(0, end - max(start, upto))
        upto = max(upto, end)
    return total


def usable(bench: DataFrame) -> DataFrame:
    """The distinct items that have an id and a text."""
    return bench.select("item_id", "text").where("item_id is not null and text is not null").distinct()


def small(items: DataFrame, words: int = SLICE) -> Items | None:
    """The items, if they have at most ``words`` words together. The driver gets no more than that, and one item."""
    rows, n = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        n += len(words_of(row[1]))
        if n > words:
            return None
        rows.append((row[0], row[1]))
    return Items(rows)


def contamination(docs: DataFrame, bench: DataFrame, *, slice_words: int = SLICE) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A benchmark of up to ``slice_words`` words is broadcast; a larger one is joined by
    fingerprints, with the same result. Null texts have no words; items without words
    have no window; items without an id are left out; repeated items count once by id;
    repeated documents repeat. An empty benchmark hits nothing.
    """
    docs, items = docs.select("doc_id", "text"), usable(bench)
    if (own := small(items, slice_words)) is not None:
        return _scan(docs, own)
    numbered, schema = materialize(docs.withColumn("row", F.monotonically_increasing_id()), "numbered"), _schema(docs)
    met = numbered.join(_met(numbered, items), "row", "left").select("doc_id", "text", "starts", "ends", "items")

    def run(ids: list, texts: list, starts: list, ends: list, found: list) -> list:
        rows = [_row(i, len(words_of(t)), list(zip(s or (), e or (), strict=True)), f or ()) for i, t, s, e, f in zip(ids, texts, starts, ends, found, strict=True)]
        return [[r[f.name] for r in rows] for f in schema]

    return map_arrow(met, run, schema)


def _schema(docs: DataFrame) -> StructType:
    return StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()), StructField("items_sha256", StringType()), StructField("contaminated", BooleanType())])


def _row(doc_id, n_words: int, spans: list, items) -> dict:
    n_hit = _covered(spans)
    ids = sorted(set(items))
    return {"doc_id": doc_id, "n_words": n_words, "n_hit": n_hit, "n_items": len(ids), "items_sha256": hashlib.sha256(",".join(ids).encode()).hexdigest(), "contaminated": n_hit > 0 and 20 * n_hit >= n_words}


def _scan(docs: DataFrame, items: Items) -> DataFrame:
    shared, schema = docs.sparkSession.sparkContext.broadcast(items), _schema(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                spans, found = own.hits(words := words_of(text))
                rows.append(_row(doc_id, len(words), spans, [str(own.ids[i]) for i in found]))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))

    return docs.mapInArrow(run, schema)


def _prints(texts: DataFrame, lengths: list[int], whole: bool) -> DataFrame:
    """``key, n, h, at`` for ``texts(key, text)``: fingerprints (n is 0), and hashes of runs of n words for short items.

    ``whole`` is for items: one of fewer words than ``SPAN`` has one hash, of all its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes = hashes_of(words_of(text))
                runs = [n for n in lengths if (n == len(hashes) if whole else n <= len(hashes))]
                got = [(n, h := grams(hashes, n), np.arange(len(h))) for n in runs]
                if len(hashes) >= SPAN:
                    got.append((0, *winnow(hashes)))
                for n, h, at in got:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), key, np.int64)), pa.array(np.full(len(h), n, np.int32)), pa.array(h.view(np.int64)), pa.array(at.astype(np.int32))], ["key", "n", "h", "at"])

    return texts.mapInArrow(run, "key long, n int, h long, at int")


def _met(numbered: DataFrame, items: DataFrame) -> DataFrame:
    """``row, starts, ends, items`` for each row of ``numbered(row, text)`` that holds windows of ``items``.

    Rows meet by number, as ids may repeat. What is joined on a fingerprint are numbers
    only; a document's words and an item's are together for the pairs that share one.
    """
    own = materialize(items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("string").alias("item_id"), "text"), "items")
    size = lambda text: len(words_of(text))
    sizes = map_arrow(own.select("text"), lambda texts: [[size(t) for t in texts]], StructType([StructField("n", LongType())]))
    lengths = sorted(r.n for r in sizes.where((F.col("n") > 0) & (F.col("n") < SPAN)).distinct().collect())
    theirs = _prints(own.select("item", "text"), lengths, True).select(F.col("key").alias("item"), "n", "h", F.col("at").alias("there"))
    ours = _prints(numbered.select("row", "text"), lengths, False).select(F.col("key").alias("row"), "n", "h", "at")
    pairs = ours.join(theirs, ["n", "h"]).groupBy("row", "item").agg(F.sort_array(F.collect_list(F.struct("at", "there", "n"))).alias("hits"))
    pairs = materialize(pairs, "pairs")
    texts = numbered.join(pairs.select("row").distinct(), "row", "left_semi").select("row", "text")
    both = pairs.join(own.select("item", "item_id", F.col("text").alias("other")), "item").join(texts, "row").select("row", "item_id", "hits", "text", "other")
    schema = StructType([StructField("row", LongType()), StructField("item_id", StringType()), StructField("starts", ArrayType(LongType())), StructField("ends", ArrayType(LongType()))])

    def run(rows: list, ids: list, hits: list, texts: list, others: list) -> list:
        spans = []
        for found, text, other in zip(hits, texts, others, strict=True):
            a, b, kept, done = words_of(text), words_of(other), [], {}
            for hit in found:
                at, there, n = hit["at"], hit["there"], hit["n"]
                if n:
                    if a[at : at + n] == b:
                        kept.append((at, at + n))
                elif at >= done.get(at - there, 0):
                    start, end = Items.extended(a, at, b, there)
                    done[at - there] = end
                    if end - start >= SPAN:
                        kept.append((start, end))
            spans.append(kept)
        return [rows, ids, [[s for s, _ in kept] for kept in spans], [[e for _, e in kept] for kept in spans]]

    joined = lambda c: F.flatten(F.collect_list(c)).alias(c)
    return map_arrow(both, run, schema).where(F.size("starts") > 0).groupBy("row").agg(joined("starts"), joined("ends"), F.collect_set("item_id").alias("items"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, *, slice_words: int = SLICE) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are.

    With a benchmark that is broadcast nothing is shuffled; with a larger one the
    numbers of contaminated rows are anti-joined.
    """
    dirty = lambda n_words, spans: 0 < (n := _covered(spans)) and 20 * n >= n_words
    items = usable(bench)
    if (own := small(items, slice_words)) is not None:
        shared = docs.sparkSession.sparkContext.broadcast(own)
        return filter_rows(docs, "text", lambda texts: [not dirty(len(w := words_of(t)), shared.value.hits(w)[0]) for t in texts])
    (row,) = own_names(docs, "row")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    texts = numbered.select(F.col(row).alias("row"), "text")
    met = texts.join(_met(texts, items), "row").select("row", "text", "starts", "ends")
    bad = map_arrow(met, lambda row, text, starts, ends: [row, [dirty(len(words_of(t)), list(zip(s, e, strict=True))) for t, s, e in zip(text, starts, ends, strict=True)]], StructType([StructField("row", LongType()), StructField("bad", BooleanType())]))
    return numbered.join(bad.where("bad").select(F.col("row").alias(row)), row, "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
