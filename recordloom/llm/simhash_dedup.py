"""SimHash near-duplicates by anchor-point covering (operator 5).

Anchors are the 4,096 words of the perfect binary Golay code on the low 23 bits
of a fingerprint: every 23-bit word lies within 3 bits of exactly one anchor, its
home. Two fingerprints that differ in at most 3 bits differ in at most 3 of those
23, so the second lies within 3 + 3 = 6 bits of the first one's home. Each
fingerprint is therefore replicated to all anchors within 6 bits (about 71), and
at each anchor the fingerprints at home there are compared, on all 64 bits, with
every replica. No link can be missed.

Of very many fingerprints (``LONG_FROM``), anchors are pairs of Golay words on the
low 46 bits, 2^24 of them. The bits by which a pair's two parts exceed distance 3
add up to at most 3 for every replica that can matter, about 300 of them; each
anchor then meets a 56,000th of the pairs instead of a 58th. Both find the same links.

Fingerprints may crowd at an anchor. One with more than ``BLOCK`` replicas is split
by the bits that it doesn't look at: of four parts of the 41 bits above the first
word, two fingerprints that differ in 3 bits agree in one. Homes and replicas of
such an anchor go to four groups each, by the value of each part, and inside a group
the same parts are an index. So neither side of a crowded anchor is ever whole in
one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from recordloom.llm.common import few, map_arrow, materialize, own_names, table
from recordloom.llm.graph import connected_components

SHINGLE_WORDS, SEED, RADIUS, THRESHOLD, LENGTH = 3, 42, 3, 3, 23
#: Generator polynomial of the binary Golay code, of degree 11.
GENERATOR = 0b101011100011
#: Replicas compared in one group; an anchor with more is split.
BLOCK = 1 << 20
#: Distinct fingerprints from which anchors are pairs of words (with one word, uniform anchors hold ``BLOCK`` replicas there), and fingerprints replicated at once with one word or two.
LONG_FROM, AT_ONCE = 1 << 26, (1 << 13, 1 << 11)
#: Anchors whose counts are added up first, as bits, with one word or two; the driver gets 2^12 or 2^18 counts.
CELL = (0, 6)
#: The parts of a fingerprint by which crowded anchors are split: first bit and bits.
PARTS = ((23, 10), (33, 10), (43, 10), (53, 11))
#: Comparisons of one group up to which no index is used.
PLAIN = 1 << 22
#: Comparisons made together.
AT_A_TIME = 1 << 18


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, unsigned; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    digest = xxhash.xxh64_intdigest
    return simhash(np.fromiter((digest(s, SEED) for s in shingles), np.uint64))


def simhash(hashes: np.ndarray) -> int:
    """64 bits, each set if it is in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


@cache
def anchors() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[list[np.ndarray]]]:
    """Parity by message; by syndrome the coset leader, its weight and its place among those of that weight.

    Last, by weight and excess over ``RADIUS``: a row for each such syndrome with the message
    differences of the anchors at that excess. Excess 0 is home alone, as the code is perfect,
    and cosets of one weight have equally many anchors at each distance.
    """
    parity = np.zeros(1 << 12, np.uint32)
    for message in range(1 << 12):
        rest = message << 11
        for bit in range(22, 10, -1):
            if rest >> bit & 1:
                rest ^= GENERATOR << (bit - 11)
        parity[message] = rest
    words = (np.arange(1 << 12, dtype=np.uint32) << 11) | parity
    leader = np.full(1 << 11, -1, np.int64)
    every = np.arange(1 << LENGTH, dtype=np.uint32)
    light = every[np.bitwise_count(every) <= RADIUS]
    leader[(light & 0x7FF) ^ parity[light >> 11]] = light
    weight = np.bitwise_count(leader.astype(np.uint32)).astype(np.int64)
    place, reach = np.zeros(1 << 11, np.int64), []
    for w in range(RADIUS + 1):
        of = np.flatnonzero(weight == w)
        place[of] = np.arange(len(of))
        away = np.bitwise_count(words[None, :] ^ leader[of].astype(np.uint32)[:, None]).astype(np.int64) - RADIUS
        reach.append([np.nonzero(np.maximum(away, 0) == t)[1].reshape(len(of), -1) for t in range(THRESHOLD + 1)])
    return parity, leader, weight, place, reach


def replicas(prints: np.ndarray, codes: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For fingerprints: each one's home anchor, and pairs (anchor, position in ``prints``) of its replicas."""
    parity, leader, weight, place, reach = anchors()
    homes, weights, places = [], [], []
    for i in range(codes):
        part = (prints >> np.uint64(i * LENGTH) & np.uint64((1 << LENGTH) - 1)).astype(np.uint32)
        syndrome = (part & 0x7FF) ^ parity[part >> 11]
        homes.append(((part ^ leader[syndrome].astype(np.uint32)) >> 11).astype(np.int64))
        weights.append(weight[syndrome])
        places.append(place[syndrome])
    home = homes[0] if codes == 1 else homes[0] << 12 | homes[1]
    kind = weights[0] if codes == 1 else weights[0] * (RADIUS + 1) + weights[1]
    to, of = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in np.unique(kind):
        own = np.flatnonzero(kind == k)
        there = [reach[w] for w in ((k,) if codes == 1 else divmod(k, RADIUS + 1))]
        for t in range(THRESHOLD + 1):
            first = there[0][t][places[0][own]]
            if codes == 1:
                away = first
            else:
                second = np.concatenate([there[1][u][places[1][own]] for u in range(THRESHOLD + 1 - t)], axis=1)
                away = (first[:, :, None] << 12 | second[:, None, :]).reshape(len(own), -1)
            to.append((home[own][:, None] ^ away).ravel())
            of.append(np.repeat(own, away.shape[1]))
    return home, np.concatenate(to), np.concatenate(of)


def part(prints: np.ndarray, i: int) -> np.ndarray:
    at, bits = PARTS[i]
    return (prints >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64)


def forest(homes: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between ``homes`` and ``prints`` (distinct uint64), as two arrays.

    One pass over ``prints`` for each home; memory in proportion to ``prints``.
    """
    nodes = np.union1d(homes, prints)
    comp = np.arange(len(nodes))
    if len(homes) * len(nodes) <= AT_A_TIME:
        homes = homes[np.count_nonzero(np.bitwise_count(homes[:, None] ^ nodes) <= THRESHOLD, axis=1) > 1]
    for h in homes:
        near = np.bitwise_count(nodes ^ h) <= THRESHOLD
        if np.count_nonzero(near) > 1:
            roots = np.unique(comp[near])
            if len(roots) > 1:
                to = np.arange(len(nodes))
                to[roots] = roots[0]
                comp = to[comp]
    below = np.flatnonzero(comp != np.arange(len(nodes)))
    return nodes[below], nodes[comp[below]]


def indexed_forest(homes: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the same components as those of ``forest``, four times as many at most.

    Each home is compared with the prints that agree with it in one of the ``PARTS``.
    """
    if len(homes) * len(prints) <= PLAIN:
        return forest(homes, prints)
    a, b = [], []
    for i in range(len(PARTS)):
        sides = []
        for side in (homes, prints):
            value = part(side, i)
            order = np.argsort(value, kind="stable")
            sides.append((side[order], np.searchsorted(value[order], np.arange((1 << PARTS[i][1]) + 1))))
        (h, h_at), (p, p_at) = sides
        for v in np.flatnonzero((np.diff(h_at) > 0) & (np.diff(p_at) > 0)).tolist():
            x, y = forest(h[h_at[v] : h_at[v + 1]], p[p_at[v] : p_at[v + 1]])
            a.append(x)
            b.append(y)
    return np.concatenate(a or [homes[:0]]), np.concatenate(b or [homes[:0]])


def _prints(batches: Iterator[pa.RecordBatch], codes: int) -> Iterator[np.ndarray]:
    for batch in batches:
        prints = np.asarray(batch.column(0)).view(np.uint64)
        for at in range(0, len(prints), AT_ONCE[codes - 1]):
            yield prints[at : at + AT_ONCE[codes - 1]]


def _counts(codes: int, cells: np.ndarray | None = None):
    """Counts of replicas by cell, or by anchor within some ``cells``."""
    bits = CELL[codes - 1]

    def by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << 12 * codes - bits, np.int64)
        for prints in _prints(batches, codes):
            n += np.bincount(replicas(prints, codes)[1] >> bits, minlength=len(n))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used])], ["at", "n"])

    def by_anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for prints in _prints(batches, codes):
            to = replicas(prints, codes)[1]
            used, n = np.unique(to[np.isin(to >> bits, cells)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n)], ["at", "n"])

    return by_cell if cells is None else by_anchor


def _dealt(crowded: np.ndarray, codes: int):
    """Packs the homes and replicas of each batch by (anchor, group), so that few long rows are shuffled.

    Group 0 is the whole anchor; a ``crowded`` one (sorted) has a group for each value of each of the ``PARTS``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for prints in _prints(batches, codes):
            home, to, of = replicas(prints, codes)
            for kind, anchor, what in ((0, to, of), (1, home, np.arange(len(home)))):
                split = np.isin(anchor, crowded)
                keys, whats = [anchor[~split] << 16], [what[~split]]
                if split.any():
                    for i in range(len(PARTS)):
                        keys.append(anchor[split] << 16 | (i << 11 | part(prints[what[split]], i)) + 1)
                        whats.append(what[split])
                keys, whats = np.concatenate(keys), np.concatenate(whats)
                order = np.argsort(keys, kind="stable")
                keys, data = keys[order], prints[whats[order]].astype("<u8")
                starts = np.flatnonzero(np.diff(keys, prepend=-1))
                ends = np.append(starts, len(keys)).astype(np.int32) * 8
                packed = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
                keys = keys[starts]
                yield pa.RecordBatch.from_arrays([pa.array((keys >> 16).astype(np.int32)), pa.array((keys & 0xFFFF).astype(np.int32)), pa.array(np.full(len(keys), kind, np.int8)), packed], ["anchor", "block", "home", "prints"])

    return run


def _compared(group: pa.Table) -> pa.Table:
    is_home = np.asarray(group.column("home")) == 1
    chunks = group.column("prints").to_pylist()
    homes, prints = (np.frombuffer(b"".join(c for c, h in zip(chunks, is_home, strict=True) if h == side), "<u8").astype(np.uint64) for side in (True, False))
    a, b = indexed_forest(homes, prints) if len(homes) else (homes, homes)
    return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})


def near_fingerprints(prints: DataFrame, codes: int | None = None) -> DataFrame:
    """Links ``(a, b)`` that span the components of the distinct fingerprints ``fp`` (long) at 3 bits or fewer.

    ``codes`` is 1 or 2 words an anchor, by default 2 from ``LONG_FROM`` fingerprints on; the links
    are the same. The driver gets 2^12 or 2^18 counts, one for each cell of anchors, and then the
    anchors with more than ``BLOCK`` replicas, 302 for each ``BLOCK`` fingerprints at most.
    """
    codes = codes or (2 if prints.count() >= LONG_FROM else 1)
    counts = prints.mapInArrow(_counts(codes), "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    full = np.asarray(sorted(r.at for r in counts.where(F.col("n") > BLOCK).collect()), np.int64)
    if CELL[codes - 1] and len(full):
        counts = prints.mapInArrow(_counts(codes, full), "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
        full = np.asarray(sorted(r.at for r in counts.where(F.col("n") > BLOCK).collect()), np.int64)
    dealt = prints.mapInArrow(_dealt(full, codes), "anchor int, block int, home byte, prints binary")
    return dealt.groupBy("anchor", "block").applyInArrow(_compared, "a long, b long")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` for each row of ``docs``; ``fp`` is the fingerprint's 64 bits as a long."""
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("fp", LongType(), False)])
    to_long = lambda x: x - (x >> 63 << 64)
    return map_arrow(docs.select("doc_id", "text"), lambda ids, texts: [ids, [to_long(fingerprint(t)) for t in texts]], schema)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``fp`` and ``component_id``.

    Rows of equal fingerprint are one node; nodes at 3 or fewer differing bits are
    linked; ``component_id`` is the smallest ``doc_id`` of all rows reachable.
    Null and empty texts have fingerprint 0. Null ids take part but are never the
    smallest; a component of null ids only has a null ``component_id``. Repeated
    rows repeat in the result. An empty table gives no rows.
    """
    fps = materialize(fingerprints(docs), "fingerprints")
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    labels = connected_components(near_fingerprints(nodes.select("fp")))
    comp = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("comp", "fp").alias("comp"))
    smallest = comp.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = comp.select("fp", "comp").join(smallest, "comp").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def text_key() -> Column:
    """A text's key, 16 bytes, the same for a null text and an empty one."""
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def one_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` with exactly one left for each ``comp`` of ``found(doc_id, key, comp)``, all columns as they are.

    That is a row of the component's smallest id; where all its ids are null, of its
    smallest text key. ``key`` is the row's ``text_key``, and ``comp`` depends on the
    text only, so that an id and a key name rows of a single component. Only the ids
    and keys of components with several rows are joined with the texts.
    """
    of_id, of_key, of_mark, text = own_names(docs, "kept_id", "kept_key", "kept_mark", "kept_text")
    rows = found.groupBy("comp", "doc_id", "key").agg(F.count("*").alias("n"))
    first = F.min_by(F.struct("doc_id", "key"), F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    firsts = rows.groupBy("comp").agg(first.alias("first"), F.sum("n").alias("rows")).where(F.col("rows") > 1)
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    marks = rows.join(firsts, "comp").where(~is_first | (F.col("n") > 1))
    marks = materialize(marks.select(F.col("doc_id").alias(of_id), F.col("key").alias(of_key), F.when(is_first, "repeated").otherwise("dropped").alias(of_mark)), "marks")
    marked = docs.withColumn(text, text_key()).join(few(marks), F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.col(text) == F.col(of_key)), "left")
    once = marked.where(F.col(of_mark).isNull()).select(*docs.columns)
    if not marks.where(F.col(of_mark) == "repeated").limit(1).count():
        return once
    return once.union(marked.where(F.col(of_mark) == "repeated").dropDuplicates(["doc_id", text]).select(*docs.columns))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one row for each component left: one of its smallest id.

    Of rows that repeat the kept id and text one stays, whichever. All columns stay
    as they are. A component whose ids are all null keeps one row as well.
    """
    keyed = docs.select(F.struct("doc_id", text_key().alias("key")).alias("doc_id"), "text")
    fps = materialize(fingerprints(keyed), "fingerprints")
    nodes = materialize(fps.select("fp").distinct(), "nodes")
    labels = connected_components(near_fingerprints(nodes)).withColumnRenamed("node", "fp")
    return one_each(docs, fps.join(labels, "fp", "left").select("doc_id.doc_id", "doc_id.key", F.coalesce("comp", "fp").alias("comp")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).cast(StringType()).alias("fingerprint"), "component_id")
