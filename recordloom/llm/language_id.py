"""Language identification by language-bitmask n-gram filters (operator 1).

A Bloom filter for each language, bit-sliced: a slot holds one bit for each
language, so the slots that an n-gram hashes to, combined by AND, give at once all
languages that contain it. A text's hits are counted by language, corrected for
each filter's rate of false positives, and the largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from recordloom.llm.common import discard, map_arrow, materialize, table

#: Length of an n-gram in letters; a text's letters are lower-cased, all else is one blank.
NGRAM = 4
#: Training texts of each language, about; the one bound of this classifier's sample.
SAMPLE = 3000
#: Share of a language's sampled texts that must hold an n-gram for its filter to.
COMMON = 0.01
#: Most languages; their masks have as many bits.
LANGUAGES = 4096
#: Slots for each n-gram kept, and hashes.
SLOTS, HASHES = 12, 3
#: Code points of a text that are looked at together.
CHUNK = 1 << 20


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Hashes (uint64) of all n-grams of a text, chunk by chunk, as if it were one piece between two blanks; none if it has no letter."""
    before = np.full(1, 32, np.uint64)
    for at in range(0, len(text), CHUNK):
        part = text[at : at + CHUNK].lower() + (" " if at + CHUNK >= len(text) else "")
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        inner = points[points > 127]
        blank = (points < 128) & ((points < 97) | (points > 122))
        if len(inner):
            odd = [p for p in np.unique(inner).tolist() if not chr(p).isalpha()]
            if odd:
                blank |= np.isin(points, odd)
        points[blank] = 32
        points = points[~(blank & np.append(before[-1] == 32, blank[:-1]))]
        points = np.append(before, points)
        before = points[-(NGRAM - 1) :]
        if len(points) >= NGRAM:
            h = np.zeros(len(points) - NGRAM + 1, np.uint64)
            for i in range(NGRAM):
                h = (h ^ points[i : len(points) - NGRAM + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            yield h


class Filters:
    """Bit-sliced Bloom filters: ``slots[i, w]`` is the w-th word of slot i's language bits."""

    def __init__(self, grams: np.ndarray, languages: np.ndarray, names: list[str]):
        self.names, self.size = names, 1 << max(10, int(np.ceil(np.log2(max(1, len(grams)) * SLOTS))))
        self.slots = np.zeros((self.size, -(-len(names) // 64) or 1), np.uint64)
        bits = np.uint64(1) << (languages % 64).astype(np.uint64)
        for slot in self.places(grams):
            np.bitwise_or.at(self.slots, (slot, languages // 64), bits)
        filled = np.asarray([np.count_nonzero(self.slots[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(names))])
        self.false = (filled / self.size) ** HASHES

    def places(self, grams: np.ndarray) -> Iterator[np.ndarray]:
        second = (grams >> np.uint64(32)) | np.uint64(1)
        for i in range(HASHES):
            yield ((grams + np.uint64(i) * second) & np.uint64(self.size - 1)).astype(np.int64)

    def containing(self, grams: np.ndarray) -> np.ndarray:
        """The languages of each n-gram as bits."""
        first, *rest = self.places(grams)
        out = self.slots[first]
        for slot in rest:
            out &= self.slots[slot]
        return out

    def decide(self, text: str | None) -> tuple[str, float]:
        """The language and its share of all corrected hits; ``und`` and 0 for a text without letters."""
        if not self.names or not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        hits, n = np.zeros(len(self.names)), 0
        for grams in ngrams(text):
            masks, n = self.containing(grams), n + len(grams)
            for i in range(len(self.names)):
                hits[i] += np.count_nonzero(masks[:, i // 64] & np.uint64(1 << i % 64))
        true = np.maximum(0.0, (hits - n * self.false) / np.maximum(1e-9, 1 - self.false))
        best = int(np.argmax(true))
        return self.names[best], float(true[best] / true.sum()) if true.sum() > 0 else 0.0


def fit(docs: DataFrame, *, sample: int = SAMPLE, common: float = COMMON) -> Filters:
    """Filters from the rows of ``docs(doc_id, text, lang)`` whose ``lang`` and ``text`` are not null.

    About ``sample`` rows of each language are read, chosen by a hash of id and text;
    equal texts of a language count once. The driver gets the n-grams that at least
    ``common`` of a language's sampled texts hold: 1 / ``common`` times the distinct
    n-grams of an average text at most, whatever the corpus. Languages are numbered by
    name; more than ``LANGUAGES`` of them are refused, as such a column holds something else.
    """
    rows = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    found = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    sizes = dict(found.limit(LANGUAGES + 1).collect())
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different values in lang")
    if not sizes:
        return Filters(np.empty(0, np.uint64), np.empty(0, np.int64), [])
    names = sorted(sizes)
    known = docs.sparkSession.createDataFrame(sorted(sizes.items()), "lang string, rows long")
    own = (F.xxhash64(F.lit(1), "doc_id", "text") % 1_000_003 + 1_000_003) % 1_000_003 / F.lit(1_000_003.0)
    picked = rows.join(F.broadcast(known), "lang").where(own < sample / F.col("rows")).select("lang", "text").dropDuplicates()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """In how many of a batch's texts each n-gram is; for n-gram null, how many texts there are."""
        for batch in batches:
            by: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = [np.unique(g) for g in ngrams(text)]
                by.setdefault(lang, []).append(np.unique(np.concatenate(got)) if got else np.empty(0, np.uint64))
            for lang, lists in by.items():
                grams, n = np.unique(np.concatenate(lists), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(grams) + 1)), pa.array([None, *grams.view(np.int64).tolist()], pa.int64()), pa.array(np.append(len(lists), n))], ["lang", "gram", "n"])

    counts = materialize(picked.mapInArrow(counted, "lang string, gram long, n long"), "ngrams")
    total = {lang: n for lang, n in counts.where("gram is null").groupBy("lang").agg(F.sum("n")).collect()}
    least = docs.sparkSession.createDataFrame([(lang, max(2.0 if n > 2 else 1.0, common * n)) for lang, n in sorted(total.items())], "lang string, least double")
    summed = counts.where("gram is not null").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    kept = summed.join(F.broadcast(least), "lang").where("n >= least").select("lang", "gram").toPandas()
    discard(counts)
    place = {lang: i for i, lang in enumerate(names)}
    return Filters(kept["gram"].to_numpy(np.int64).view(np.uint64), kept["lang"].map(place).to_numpy(np.int64), names)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """``doc_id, lang_pred, score`` for each row of ``docs``, from its whole text alone.

    Null texts and texts without a letter are ``und`` with score 0; a text with no
    known n-gram is the first language with score 0. Ties go to the first language
    by name. Repeated rows repeat; an empty table gives none; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(ids: list, texts: list) -> list:
        got = [shared.value.decide(t) for t in texts]
        return [ids, [g[0] for g in got], [g[1] for g in got]]

    return map_arrow(docs.select("doc_id", "text"), run, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False)).cast(BooleanType())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, filters).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
