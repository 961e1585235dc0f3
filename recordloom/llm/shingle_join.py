"""Near-duplicates by the Jaccard similarity of word shingle sets, exact (the pipeline's stage).

First the fingerprints of operator 5, of five-word shingles, are linked by anchor-point
covering; of the links, those hold whose sets reach the wanted similarity. At 0.8 two
sets differ in some ten bits of 64, so fingerprints alone miss links; what follows
finds the rest of them.

Two sets of Jaccard ``least`` or more share an element among the first
``n - ceil(least * n) + 1`` of each, in whatever one order all sets are sorted by
(prefix filtering). Sets that meet on so many of these that ``least`` can still be
reached are compared, on their whole sets, so no link is missed and none is guessed. Elements that are common in
a sample of the texts come last in the order; the sample changes what is compared,
never what is found.

Sets that are already in one component needn't be compared. So with the fingerprints
each set of a larger group is compared with the group's hub, the set whose prefix is
shared most, which is the original where a group is copies of one. All pairs that are
still in different components meet after that, in blocks of bounded size; of a large
group only pairs whose bitmaps leave ``least`` possible are compared at all: where two
bitmaps differ, the sets do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from recordloom.llm.common import discard, few, map_arrow, materialize, release
from recordloom.llm.graph import connected_components
from recordloom.llm.simhash_dedup import SEED, near_fingerprints, one_each, simhash, text_key

SHINGLE_WORDS, LEAST = 5, 0.8
#: One text in so many is sampled for common shingles, how many of those must hold one, and the most shingles that the driver gets.
SAMPLE, COMMON, MOST = 16, 3, 1 << 17
#: Members from which a group meets its hub first; bits of a set's bitmap, and members of a block of a large group.
LARGE, BITS, MEET = 16, 2048, 4096


def shingle_set(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct 64-bit hashes of a text's shingles, sorted; of fewer words than ``width`` the whole is one."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    hashes.sort()
    return hashes[np.append(True, hashes[1:] != hashes[:-1])]


def wanted(least: float, n: int) -> int:
    """The smallest whole number that is ``least * n`` or more."""
    return math.ceil(least * n - 1e-9)


def _common(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are common in a sample, sorted, and in how many of its texts they are."""
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text")
    one = map_arrow(sample, lambda texts: [[shingle_set(t, width).view(np.int64) for t in texts]], StructType([StructField("s", ArrayType(LongType()))]))
    often = one.select(F.explode("s").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    got = often.orderBy(F.col("n").desc(), "s").limit(MOST).toPandas()
    order = np.argsort(got["s"].to_numpy(np.int64).view(np.uint64))
    return got["s"].to_numpy(np.int64).view(np.uint64)[order], got["n"].to_numpy(np.int64)[order]


def _rows(docs: DataFrame, width: int, least: float) -> DataFrame:
    """``doc_id, key, node, fp, size, prefix, bits, wide`` for each row; rows of one shingle set have one ``node``. ``wide`` is the bitmap of a large set, four bits or more an element."""
    common, often = _common(docs, width)

    def prefix(s: np.ndarray) -> np.ndarray:
        if len(common) and len(s):
            at = np.minimum(np.searchsorted(common, s), len(common) - 1)
            s = s[np.argsort(np.where(common[at] == s, often[at], 0), kind="stable")]
        return s[: len(s) - wanted(least, len(s)) + 1] if len(s) else s

    def bitmap(s: np.ndarray, size: int = BITS) -> np.ndarray:
        on = np.zeros(size, bool)
        on[(s & np.uint64(size - 1)).astype(np.int64)] = True
        return np.packbits(on, bitorder="little").view("<i8")

    def wide(s: np.ndarray) -> np.ndarray | None:
        return bitmap(s, 4 << (len(s) - 1).bit_length()) if 4 * len(s) > BITS else None

    def run(ids: list, keys: list, texts: list) -> list:
        sets = [shingle_set(t, width) for t in texts]
        nodes = np.fromiter((xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets), np.uint64, len(sets)).view(np.int64)
        prints = np.fromiter((simhash(s) if len(s) else 0 for s in sets), np.uint64, len(sets)).view(np.int64)
        return [ids, keys, nodes, prints, [len(s) for s in sets], [prefix(s).view(np.int64) for s in sets], [bitmap(s) for s in sets], [wide(s) for s in sets]]

    schema = StructType([docs.schema["doc_id"], StructField("key", BinaryType()), StructField("node", LongType()), StructField("fp", LongType()), StructField("size", IntegerType()), StructField("prefix", ArrayType(LongType())), StructField("bits", ArrayType(LongType())), StructField("wide", ArrayType(LongType()))])
    return map_arrow(docs.select("doc_id", text_key().alias("key"), "text"), run, schema)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
            sets = [shingle_set(t, width).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "s"])

    return run


def _possible(least: float):
    """The pairs whose sizes and bitmaps leave ``least`` possible."""

    def unlike(x: np.ndarray, y: np.ndarray) -> int:
        while len(x) != len(y):  # the upper half of the longer one folds onto its lower half
            x, y = (x, y) if len(x) > len(y) else (y, x)
            x = x[: len(x) // 2] | x[len(x) // 2 :]
        return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for m, n, *maps in zip(*(batch.column(c) for c in ("size_a", "size_b", "bits_a", "bits_b")), strict=True):
                m, n = m.as_py(), n.as_py()
                x, y = (np.asarray(v.values).view(np.uint64) for v in maps)
                keep.append(min(m, n) >= max(m, n) * (least - 1e-9) and unlike(x, y) * (1 + least) <= (m + n) * (1 - least) + 1e-6)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _met(least: float):
    """The pairs of each group ``(tok, i, j)``, sorted by it, that lie in different components and whose sizes and bitmaps leave ``least`` possible."""

    def pairs(group: pa.Table) -> pa.RecordBatch:
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        block, node, comp, size = (np.asarray(group.column(c)) for c in ("block", "node", "comp", "size"))
        bits = np.asarray(group.column("bits").combine_chunks().flatten()).view(np.uint64).reshape(len(node), -1)
        names, of = np.unique(comp, return_inverse=True)
        most = np.bincount(of).argmax()
        x, y = (np.arange(len(node)),) * 2 if i == j else (np.flatnonzero(block == i), np.flatnonzero(block == j))
        if np.count_nonzero(of[x] == most) < np.count_nonzero(of[y] == most):
            x, y = y, x
        found = []
        # Two of the largest component needn't be compared, so its members stand on one side alone where both sides are one block.
        for at in x if i != j else x[of[x] != most]:
            to = y[of[y] != of[at]]
            low, high = np.minimum(size[to], size[at]), np.maximum(size[to], size[at])
            to = to[low >= high * (least - 1e-9)]
            differ = np.bitwise_count(bits[to] ^ bits[at]).sum(axis=1, dtype=np.int64)
            to = to[differ * (1 + least) <= (size[to] + size[at]) * (1 - least) + 1e-6]
            if len(to):
                found.append(np.stack([np.minimum(node[to], node[at]), np.maximum(node[to], node[at])]))
        a, b = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.RecordBatch] = []
        for batch in batches:
            key = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in range(3)])
            cuts = np.flatnonzero((np.diff(key, axis=1) != 0).any(axis=0)) + 1
            if open_ and batch.num_rows and any(open_[0].column(c)[0] != batch.column(c)[0] for c in range(3)):
                yield pairs(pa.Table.from_batches(open_))
                open_ = []
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if end > start:
                    open_.append(batch.slice(start, end - start))
                    if end < batch.num_rows:
                        yield pairs(pa.Table.from_batches(open_))
                        open_ = []
        if open_:
            yield pairs(pa.Table.from_batches(open_))

    return run


def components(docs: DataFrame, width: int = SHINGLE_WORDS, least: float = LEAST) -> DataFrame:
    """``doc_id, key, comp`` for each row of ``docs``: rows linked, in any number of steps, by a Jaccard of ``least`` or more.

    Null and empty texts have no shingles and are one component. ``key`` is the text's.
    """
    rows = materialize(_rows(docs, width, least), "shingles")
    nodes = rows.groupBy("node").agg(F.first("size").alias("size"), F.first("prefix").alias("prefix"))
    heads = nodes.select("node", "size", F.explode("prefix").alias("tok"))
    shared = heads.groupBy("tok").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(heads.join(shared, "tok").select("tok", "node", "size", "n"), "members")
    release(docs.sparkSession)
    large = members.where(F.col("n") >= LARGE)
    can = lambda m, n: F.least(m, n) >= F.greatest(m, n) * (least - 1e-9)  # noqa: E731  whether sizes leave ``least`` possible

    def enough(shared: str, m: str, n: str) -> Column:
        # of what two sets share, all but ``shared`` lies behind the prefix of one of them
        behind = F.ceil(F.greatest(m, n) * least - 1e-9) - 1
        return can(m, n) & ((F.col(shared) + behind) * (1 + least) >= (F.col(m) + F.col(n)) * least - 1e-6)

    def links(pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``(a, b)`` of nodes that are similar, on whole sets made anew from one text of each node."""
        pairs = materialize(pairs, "pairs")
        ends = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "ends")
        maps = materialize(rows.select("node", "size", F.coalesce("wide", "bits").alias("bits")).join(ends, "node", "left_semi").dropDuplicates(["node"]), "bitmaps")
        both = pairs.join(maps.toDF("a", "size_a", "bits_a"), "a").join(maps.toDF("b", "size_b", "bits_b"), "b")
        kept = materialize(both.mapInArrow(_possible(least), "a long, b long"), "possible")
        ends = kept.select(F.col("a").alias("node")).union(kept.select("b")).distinct()
        # Written first: while these are few, no text is shuffled for them.
        keys = materialize(rows.select("node", "key").join(ends, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key")), "keys")
        texts = docs.select(text_key().alias("key"), "text").join(few(keys), "key").select("node", "text").dropDuplicates(["node"])
        sets = materialize(texts.mapInArrow(_sets(width), "node long, s array<long>"), "sets")
        whole = kept.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", F.size("sa").alias("m"), F.size("sb").alias("n"), F.size(F.array_intersect("sa", "sb")).alias("both"))
        out = materialize(whole.where(F.col("both") >= F.ceil((F.col("m") + F.col("n") - F.col("both")) * least - 1e-9)).select("a", "b"), "links")
        for done in (sets, pairs, keys, maps, kept):
            discard(done)
        release(docs.sparkSession)
        return out

    # Of equal fingerprints each set meets the smallest; linked fingerprints meet by their smallest sets.
    one = rows.groupBy("fp", "node").agg(F.first("size").alias("size"))
    prints = materialize(one.groupBy("fp").agg(F.min(F.struct("node", "size")).alias("first")), "prints")
    near = near_fingerprints(prints.select("fp")).join(prints.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(prints.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b").select("x", "y")
    equal = one.join(prints, "fp").where(F.col("node") != F.col("first.node")).select(F.struct("node", "size").alias("x"), F.col("first").alias("y"))
    printed = near.union(equal).where(can("x.size", "y.size")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    # The hub of a group is the set that meets most others on an average element of its prefix, for its size.
    weight = members.groupBy("node").agg((F.sum("n") / F.max("size")).alias("w"))
    of = large.join(weight, "node").groupBy("tok").agg(F.max(F.struct("w", "node", "size")).alias("hub"))
    met = large.join(of, "tok").where(F.col("node") != F.col("hub.node")).groupBy("node", "size", F.col("hub.node").alias("b"), F.col("hub.size").alias("size_b")).agg(F.count("*").alias("n"))
    best = met.where(enough("n", "size", "size_b")).groupBy("node").agg(F.max(F.struct("n", "b")).alias("x"))
    edges = links(printed.union(best.select(F.col("node").alias("a"), F.col("x.b").alias("b"))).distinct())
    discard(prints)
    labels = connected_components(edges)

    def several(m: DataFrame) -> DataFrame:
        """Members of the groups that lie in several components, with their own one and their group's size."""
        m = m.select("tok", "node", "size").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        groups = m.groupBy("tok").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("alive")).where("c0 <> c1")
        return m.join(groups.select("tok", "alive"), "tok")

    a, b = (several(members.where(F.col("n") < LARGE)).select("tok", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "size", "comp"))) for x in "ab")
    apart = (F.col("node_a") < F.col("node_b")) & (F.col("comp_a") != F.col("comp_b")) & can("size_a", "size_b")
    rare = a.join(b, "tok").where(apart).groupBy("node_a", "node_b", "size_a", "size_b").agg(F.count("*").alias("n"))
    rare = rare.where(enough("n", "size_a", "size_b")).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    # A pair that shares no element of a large group is among these, with all that it shares; any other is found here.
    left = materialize(several(large), "left")
    alive = materialize(left.select("node").distinct(), "alive")
    bits = rows.select("node", "bits").join(alive, "node", "left_semi").dropDuplicates(["node"])
    blocks = F.ceil(F.col("alive") / MEET).cast("int")
    dealt = left.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(bits, "node")
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("tok", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "comp", "size", "bits")
    many = dealt.repartition("tok", "i", "j").sortWithinPartitions("tok", "i", "j").mapInArrow(_met(least), "a long, b long")
    last = links(rare.union(many).distinct())
    labels = connected_components(edges.union(last))
    out = materialize(rows.join(labels, "node", "left").select("doc_id", "key", F.coalesce("comp", "node").alias("comp")), "components")
    for done in (rows, members, left, alive, edges, last):
        discard(done)
    return out


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` with exactly one left for each of its ``components``, by ``simhash_dedup.one_each``."""
    return one_each(docs, components(docs, width, least))
