"""Exact token counts at every prefix by dynamic programming (operator 4).

Byte-level BPE merges only inside the pieces that its splitting pattern cuts, so
counts add up over pieces. Inside a piece the encoding of each prefix ends in one
token; that token is the one suffix of the prefix that is a token and that may
stand after the last token of the encoding before it. Whether two tokens may stand
side by side is a property of the pair alone. So the count at each byte is one
more than the count at the byte before its last token. The table of counts answers
how many tokens any prefix has and where a budget of tokens ends, without encoding
again.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from recordloom.llm.common import Memo, table

#: Fixed value: the splitting pattern of the byte-level tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: At most so many words are remembered.
MEMO = 300_000
#: Pieces up to so many bytes are counted in step, so many at a time.
LOCKSTEP, PIECES = 48, 100_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class StepMemo(dict):
    """Where the automaton goes on from ``state << 8 | byte``."""

    def __init__(self, own: "PrefixCounter"):
        super().__init__(own.goto)
        self.fail = own.fail

    def __missing__(self, key: int) -> int:
        to = self[self.fail[key >> 8] << 8 | key & 0xFF] if key >> 8 else 0
        if len(self) < 2_000_000:
            self[key] = to
        return to


class PrefixCounter:
    """Token counts at every prefix, for the byte-level BPE in a tokenizers ``.json`` file.

    A file whose settings this counter doesn't follow is refused: any normalizer, a
    pre-tokenizer other than plain byte-level splitting without a prefix blank, a model
    other than BPE without dropout, affixes or ignored merges, an added token that
    matches whole words or strips blanks, and a post-processor besides byte-level
    offsets (templates add tokens only with the special ones, which aren't counted).
    """

    @staticmethod
    def check(spec: dict) -> None:
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        odd += [f"added token {t['content']}" for t in spec.get("added_tokens", ()) if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]
        if model.get("type", "BPE") != "BPE":
            odd.append(f"model {model['type']}")
        if spec.get("normalizer"):
            odd.append("normalizer")
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            odd.append("pre_tokenizer")
        if (spec.get("post_processor") or {}).get("type") not in (None, "ByteLevel", "TemplateProcessing"):
            odd.append("post_processor")
        if odd:
            raise ValueError(f"settings that counts would not follow: {', '.join(odd)}")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.check(spec)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.specials = specials = [t["content"] for t in spec["added_tokens"]]
        self.tokens = [raw(t) for t in spec["model"]["vocab"] if t not in specials]
        self.number = number = {t: i for i, t in enumerate(self.tokens)}
        self.rank, self.born, self.halves = {}, [-1] * len(self.tokens), {}
        for i, merge in enumerate(spec["model"]["merges"]):
            a, b = map(raw, merge.split(" ") if isinstance(merge, str) else merge)
            made = number[a + b]
            self.rank.setdefault(number[a] << 20 | number[b], i)
            if made not in self.halves:
                self.born[made], self.halves[made] = i, (number[a], number[b])
        self.split = regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.alone_memo = Memo(self.alone, 1 << 20)
        self.automaton()
        self.pairs = Memo(lambda key: self.alone_memo[key & 0xFFFFF] and (key < 0 or self.may_stand(key >> 20, key & 0xFFFFF)), 4 * MEMO)
        self.words = Memo(self.word, MEMO)

    def automaton(self) -> None:
        """A trie of all tokens with the links of Aho and Corasick: which tokens end at a byte."""
        self.goto, ends, level = {}, [-1], [0]
        for i, token in enumerate(self.tokens):
            at = 0
            for b in token:
                to = self.goto.setdefault(at << 8 | b, len(ends))
                if to == len(ends):
                    ends.append(-1)
                at = to
            ends[at] = i
        children: dict[int, list] = {}
        for key, to in self.goto.items():
            children.setdefault(key >> 8, []).append((key & 0xFF, to))
        self.fail = [0] * len(ends)
        self.step = StepMemo(self)
        self.found = [()] * len(ends)
        while level:
            below = []
            for at in level:
                for b, to in children.get(at, ()):
                    self.fail[to] = self.step[self.fail[at] << 8 | b] if at else 0
                    below.append(to)
                    own = ((ends[to], len(self.tokens[ends[to]])),) if ends[to] >= 0 else ()
                    self.found[to] = own + self.found[self.fail[to]]
            level = below

    def alone(self, token: int) -> bool:
        """Whether BPE turns the bytes of a token into that token: it repeats the lowest-ranked merge."""
        parts = [self.tokens[token][i : i + 1] for i in range(len(self.tokens[token]))]
        while len(parts) > 1:
            rank, at = min((self.rank.get(self.number.get(a, -1) << 20 | self.number.get(b, -1), 1 << 60), i) for i, (a, b) in enumerate(pairwise(parts)))
            if rank == 1 << 60:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    def may_stand(self, a: int, b: int) -> bool:
        """Whether BPE leaves tokens ``a`` and ``b`` side by side.

        Merges are undone from the latest on; at each step no merge across the
        border may be due before the one just undone. Of equal merges the left
        one comes first, so one across the border precedes one inside ``b``.
        """
        rank, born, limit = self.rank, self.born, 1 << 60
        while True:
            if rank.get(a << 20 | b, 1 << 60) < limit:
                return False
            if born[a] < 0 and born[b] < 0:
                return True
            if born[a] > born[b]:
                limit, a = born[a], self.halves[a][1]
            else:
                limit, b = born[b] + 1, self.halves[b][0]

    def table(self, piece: bytes) -> bytes:
        """For each byte of a piece, by how much the count of the prefix that ends there exceeds the one before; int32.

        ``lasts[i]`` is the last token of the first i bytes. Time and memory follow the piece's length.
        """
        step, found, pairs = self.step, self.found, self.pairs
        at, lasts, counts = 0, [-1], [0]
        for b in piece:
            at = step[at << 8 | b]
            for token, n in found[at]:
                if pairs[lasts[-n] << 20 | token]:
                    lasts.append(token)
                    counts.append(counts[-n] + 1)
                    break
            else:
                raise ValueError("the vocabulary does not cover every byte")
        return struct.pack(f"<{len(piece)}i", *map(sub, counts[1:], counts))

    def pieces(self, text: str) -> list[bytes]:
        return [self.table(p.encode()) for p in self.split.findall(text)]

    def word(self, word: str) -> bytes | None:
        """The table of a space and a word; None where the word's own ends are white, or it has none."""
        return None if not word or word[0].isspace() or word[-1].isspace() else b"".join(self.pieces(" " + word))

    def steps(self, text: str) -> list[bytes]:
        """The tables of the pieces of a text. Pieces never run on into a space, so words that single spaces part stand for themselves."""
        first, *rest = text.split(" ")
        if rest:
            parts = list(map(self.words.__getitem__, rest))
            if None in parts or not first or first[-1].isspace():
                return self.pieces(text)
            return self.pieces(first) + parts
        return self.pieces(first)

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """Tokens of the pieces of ``text`` up to each byte, from 0 at no bytes.

        At the end of a piece, and so of the text, this is the library's count of
        the text up to there. Inside a special string it is the count before it.
        """
        parts, at = [], 0
        text = text or ""
        for m in self.special.finditer(text) if self.special else ():
            parts += self.steps(text[at : m.start()])
            parts.append(np.append(np.zeros(len(m[0].encode()) - 1, "<i4"), np.int32(1)).astype("<i4").tobytes())
            at = m.end()
        parts += self.steps(text[at:] if at else text)
        return np.cumsum(np.frombuffer(b"\0\0\0\0" + b"".join(parts), "<i4"), dtype=np.int64)

    def dense(self) -> tuple[np.ndarray, ...]:
        """The automaton as arrays: next states, then each state's longest token and the state of its next shorter one."""
        if not hasattr(self, "arrays"):
            n = len(self.fail)
            to = np.zeros((n, 256), np.int32)
            by_parent: dict[int, list] = {}
            for key, child in self.goto.items():
                by_parent.setdefault(key >> 8, []).append((key & 0xFF, child))
            level = [0]
            while level:
                below = []
                for at in level:
                    if at:
                        to[at] = to[self.fail[at]]
                    for b, child in by_parent.get(at, ()):
                        to[at, b] = child
                        below.append(child)
                level = below
            ends = np.asarray([found[0][0] if found else -1 for found in self.found], np.int32)
            lengths = np.asarray([len(t) for t in self.tokens], np.int32)
            self.longest_end = np.asarray([self.state_of(found[0][0]) if found else 0 for found in self.found], np.int32)
            shorter = np.asarray([(self.state_of(found[1][0]) if len(found) > 1 else 0) for found in self.found], np.int32)
            self.arrays = to, ends, shorter, lengths
            self.keys, self.valid = np.full(1 << 20, -1 << 50, np.int64), np.zeros(1 << 20, bool)
        return self.arrays

    def state_of(self, token: int) -> int:
        at = 0
        for b in self.tokens[token]:
            at = self.goto[at << 8 | b]
        return at

    def stand(self, left: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``may_stand`` for arrays, by way of a table in which the last pair of each slot stays."""
        key = left.astype(np.int64) << 20 | token
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)
        out = self.valid[slot]
        missing = np.flatnonzero(self.keys[slot] != key)
        if len(missing):
            fresh, back = np.unique(key[missing], return_inverse=True)
            got = np.fromiter((self.alone_memo[k & 0xFFFFF] and (k < 0 or self.may_stand(k >> 20, k & 0xFFFFF)) for k in fresh.tolist()), bool, len(fresh))
            out[missing] = got[back]
            self.keys[slot[missing]], self.valid[slot[missing]] = key[missing], got[back]
        return out

    def tables(self, pieces: list[bytes]) -> np.ndarray:
        """Counts at every prefix of pieces that are sorted by length, longest first: one row each, from 0 at no bytes."""
        to, ends, shorter, lengths = self.dense()
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        wide = int(sizes[0]) if len(pieces) else 0
        data = np.frombuffer(b"".join(p.ljust(wide, b"\0") for p in pieces), np.uint8).reshape(len(pieces), wide)
        lasts, counts = np.full((len(pieces), wide + 1), -1, np.int32), np.zeros((len(pieces), wide + 1), np.int32)
        state = np.zeros(len(pieces), np.int32)
        for end in range(1, wide + 1):
            n = int(np.searchsorted(-sizes, -end, side="right"))
            state = to[state[:n], data[:n, end - 1]]
            open_, at = np.arange(n), self.longest_end[state]
            while len(open_):
                token = ends[at]
                if (token < 0).any():
                    raise ValueError("the vocabulary does not cover every byte")
                start = end - lengths[token]
                ok = self.stand(lasts[open_, start], token)
                done = open_[ok]
                lasts[done, end], counts[done, end] = token[ok], counts[done, start[ok]] + 1
                open_, at = open_[~ok], shorter[at[~ok]]
        return counts

    def totals(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text: every distinct piece of a batch gets its table once, and words and texts add them up."""
        lists = pc.split_pattern(texts, " ")
        flat, starts = lists.flatten(), np.asarray(lists.offsets)
        coded = flat.dictionary_encode()
        codes, distinct = np.asarray(coded.indices), coded.dictionary.to_pylist()
        white = np.fromiter((not w or w[0].isspace() or w[-1].isspace() for w in distinct), bool, len(distinct))
        odd = np.append(0, np.cumsum(white[codes]))
        slow = odd[starts[1:]] > odd[starts[:-1]]
        for s in self.specials:
            slow |= np.asarray(pc.match_substring(texts, s).cast(pa.int8())).astype(bool)
        firsts = flat.take(pa.array(starts[:-1])).to_pylist()
        found, sizes = [], []
        for w in [*(" " + w for w in distinct), *firsts]:
            own = self.split.findall(w)
            found += own
            sizes.append(len(own))
        coded = pa.array([p.encode() for p in found], pa.binary()).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        order = sorted(range(len(pieces)), key=lambda i: -len(pieces[i]))
        ends = np.zeros(len(pieces), np.int64)
        at = 0
        while at < len(order):
            own = order[at : at + PIECES]
            if len(pieces[own[0]]) > LOCKSTEP:
                ends[own[0]] = np.frombuffer(self.table(pieces[own[0]]), "<i4").sum()
                at += 1
                continue
            counts = self.tables([pieces[i] for i in own])
            ends[own] = counts[np.arange(len(own)), [len(pieces[i]) for i in own]]
            at += len(own)
        upto = np.append(0, np.cumsum(ends[np.asarray(coded.indices)] if len(found) else []))
        of_word = np.diff(upto[np.append(0, np.cumsum(sizes)).astype(np.int64)]).astype(np.int64)
        run = np.append(0, np.cumsum(of_word[: len(distinct)][codes]))
        first = starts[:-1]
        out = run[starts[1:]] - run[first] - of_word[codes[first]] + of_word[len(distinct) :]
        for i in np.flatnonzero(slow).tolist():
            out[i] = self.exact(texts[i].as_py())
        return out

    def exact(self, text: str) -> int:
        return int(self.prefix_counts(text)[-1])

    def cut(self, text: str | None, budget: int) -> int:
        """The most bytes of ``text``, in whole code points, whose prefix has at most ``budget`` tokens in the table."""
        data, counts = (text or "").encode(), self.prefix_counts(text)
        ends = np.flatnonzero(counts <= budget)
        for end in ends[::-1]:
            if end == len(data) or data[end] & 0xC0 != 0x80:
                return int(end)
        return 0


@lru_cache(2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_counts(docs: DataFrame, *, path: str | None = None, limit: int = 1024, budgets: tuple[int, ...] = ()) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``, and ``cuts`` if budgets are asked for.

    ``path`` is a vocabulary file on every executor (by default the public one, found
    on each). ``cuts[i]`` is the number of bytes that ``budgets[i]`` tokens pay for.
    A null text counts as empty: no bytes, no tokens. Repeated rows repeat, an empty
    table gives none; other columns are not read. A text is held whole with four
    bytes of table for each of its own; runs of any length are counted in one pass.
    """
    fields = [StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
    if budgets:
        fields.append(StructField("cuts", ArrayType(IntegerType())))

    arrow = to_arrow_schema(schema := StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path or default_vocabulary())
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = pc.fill_null(batch.column(1).cast(pa.string()), "")
            n = own.totals(texts)
            out = [batch.column(0), pc.binary_length(texts.cast(pa.binary())), pa.array(n), pa.array(n > limit)]
            if budgets:
                out.append(pa.array([[own.cut(t, b) for b in budgets] for t in texts.to_pylist()]))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
