"""The training-data operators against brute force, and on null, empty, repeated and clashing input."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from recordloom.llm import chat_format, common, decontaminate, graph, language_id, license_scan, metric_topk, quality_classifier, secret_scan, shingle_join, simhash_dedup, source_mix, token_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, fp long, comp long, __x string"


def documents(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, len(t or ""), 1, 0.5, 7, 8, "x") for i, t in enumerate(texts)]
    rows += [rows[1], (None, None, None, None, None, None, None, None, None, None), (None, "a b c", None, "s1", 5, 1, 0.1, 1, 1, "y")]
    return spark.createDataFrame(rows, DOCS)


TEXTS = ["", None, "one two three four", "one two three four", "!!! ??? 123", "x" * 3000, "word " * 30_000, "Ünïcode 日本語 🙂", "  lead\tand\r\ntrail ", "password = hunter2secret and AKIA" + "A1" * 9]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, TEXTS)


def test_edge_rows_keep_their_number(spark, docs):
    bench = spark.createDataFrame([(1, "one two three four"), (2, None), (2, ""), (3, "x")], "item_id long, text string")
    labels = spark.createDataFrame([(2, 1, 0), (4, 0, 0), (5, 1, 1), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    n, empty = docs.count(), docs.limit(0)
    filters, model = language_id.fit(docs), quality_classifier.fit(docs, labels)
    runs = [
        lambda d: language_id.predict(d, filters), license_scan.license_scan, token_counts.token_counts, simhash_dedup.near_duplicates,
        lambda d: quality_classifier.grade(d, model), source_mix.mix, lambda d: decontaminate.contamination(d, bench), secret_scan.secret_scan,
    ]
    for run in runs:
        assert run(docs).count() == n
        assert run(empty).count() == 0
    assert language_id.fit(empty).decide("abc") == ("und", 0.0)
    assert quality_classifier.fit(empty, labels.limit(0)).grade("x")[0] >= 0
    stages = [lambda d: quality_classifier.drop_rejected(d, model), simhash_dedup.drop_near_duplicates, lambda d: decontaminate.drop_contaminated(d, bench), secret_scan.redacted]
    for stage in stages:
        assert stage(docs).columns == docs.columns and stage(docs).count() <= n
        assert stage(empty).count() == 0


def test_language_bits(spark):
    rows = [(i, " ".join(random.Random(i).choices(("the and of" if i % 2 else "der die und").split(), k=20)), "en" if i % 2 else "de") for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language_id.fit(d)
    assert filters.names == ["de", "en"] and filters.decide("the of and the")[0] == "en" and filters.decide("und der die")[0] == "de"
    assert filters.decide("123 !?") == ("und", 0.0) and filters.decide(None) == ("und", 0.0)
    own = next(language_id.ngrams("der die und"))
    assert (filters.containing(own)[:, 0] & np.uint64(1)).all()  # no n-gram that was put in is ever missed


def test_license_windows():
    own = license_scan.Templates(license_scan.TEMPLATES)
    for name, template in license_scan.TEMPLATES:
        assert name in [f[0] for f in own.found(f"Und der die. {template}\nles de la")]
    assert own.found("Licensed under the Apache License, Version 2.0.")[0][:2] == ("Apache-2.0", 1.0)
    assert own.found("the of under licensed") == [] and own.found(None) == []


def test_topk_ties_and_unusable(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(300)] + [(i, [0.5] * 5) for i in range(300, 700)] + [(700, None), (800, [1.0, None]), (801, [float("nan")]), (None, [1.0]), (900, []), (901, [0.25])]
    got = defaultdict(list)
    for r in metric_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    e = {i: np.floor(1024 * np.pad(np.asarray(v, float), (0, 5 - len(v)))).astype(int) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    want = {q: sorted(((i, int(e[q] @ v)) for i, v in e.items() if i != q), key=lambda x: (-x[1], x[0]))[:10] for q in e if q % 100 == 0}
    assert got == want
    assert metric_topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_tree_skips_work():
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, (40, 8))
    v = centres[rng.integers(0, 40, 4000)] + rng.integers(-9, 9, (4000, 8))
    tree = metric_topk.MTree(np.arange(4000), v, int((v * v).sum(axis=1).max()))
    got = tree.search(-1, v[7], 10, None)
    assert got == sorted(zip((v @ v[7]).tolist(), range(4000), strict=True), key=lambda x: (-x[0], x[1]))[:10]
    assert tree.computed < 2000


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.default_vocabulary())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from([*"ab eth'sr\n\t 1é日🙂<|>.,"]) | st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=5))
def test_token_counts_equal_the_library(library, texts):
    own = token_counts.counter(token_counts.default_vocabulary())
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert own.totals(pa.array(texts)).tolist() == want
    assert [own.exact(t) for t in texts] == want


def test_token_prefixes_and_budgets(library):
    own = token_counts.counter(token_counts.default_vocabulary())
    text = "tokenization of unbelievable thingsandstuff"
    counts = own.prefix_counts(text)
    for end in range(len(text) + 1):
        if end == 0 or text[end - 1] != " ":
            assert counts[end] == len(library.encode(text[:end], add_special_tokens=False).ids)
    assert counts[own.cut(text, 3)] <= 3 and own.cut(text, 10**6) == len(text) and own.cut(None, 5) == 0
    long = "ab" * 4000 + " " + "é" * 200 + "<|endoftext|>x"
    assert own.exact(long) == len(library.encode(long, add_special_tokens=False).ids)


def test_golay_covers():
    _, leader, _, _, reach = simhash_dedup.anchors()
    assert (leader >= 0).all() and all(sum(of.shape[1] for of in r) < 100 and r[0].shape[1] == 1 for r in reach)


@pytest.mark.parametrize(("codes", "block"), [(1, 1 << 17), (2, 1 << 17), (1, 5), (2, 1)])
def test_near_prints_meet(spark, monkeypatch, codes, block):
    monkeypatch.setattr(simhash_dedup, "BLOCK", block)
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(150 if codes == 1 else 20)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for p in prints for _ in range(2)] + [0, 1, 3, 7, 15, 255]
    signed = sorted({p - (p >> 63 << 64) for p in prints})
    links = simhash_dedup.near_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long"), codes)
    got = {r.node: r.comp for r in graph.connected_components(links).collect()}
    parent = {p: p for p in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                a2, b2 = find(a), find(b)
                parent[max(a2, b2)] = min(a2, b2)
    assert {p: got.get(p, p) for p in signed} == {p: find(p) for p in signed}


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 70)] + [(100, i) for i in range(101, 400)] + [(500, 500), (None, 3)]
    got = {r.node: r.comp for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(71)} | {i: 100 for i in range(100, 400)}


def test_components_of_a_shuffled_chain(spark):
    order = random.Random(8).sample(range(1000, 2000), 1000)
    got = {r.node: r.comp for r in graph.connected_components(spark.createDataFrame(list(zip(order, order[1:])), "a long, b long"), rounds=20).collect()}
    assert got == dict.fromkeys(range(1000, 2000), 1000)


def test_fingerprint_by_definition(spark, docs):
    text = "The quick\tbrown fox  jumps THE quick brown"
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash_dedup.fingerprint(text) == want and simhash_dedup.fingerprint(" \n") == simhash_dedup.fingerprint(None) == 0
    assert simhash_dedup.fingerprint("One") == xxhash.xxh64_intdigest("one", 42)
    kept = simhash_dedup.drop_near_duplicates(docs).select("doc_id").collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and 2 in ids and 3 not in ids and 0 in ids and 1 not in ids


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(9)]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2]), (4, texts[2]), (None, texts[2]), (5, texts[3]), (5, texts[4]), (6, texts[5]), (6, texts[5]), (7, texts[5]), (8, texts[6]), (None, texts[7]), (None, None), (None, ""), (9, texts[8])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(None, texts[0]), (None, texts[1]), (4, texts[2]), (5, texts[3]), (5, texts[4]), (6, texts[5]), (8, texts[6]), (None, texts[7]), (None, ""), (9, texts[8])]
    for n in (len(rows), 5, 3):  # with and without repeated rows of the kept id
        of = {t or "" for _, t in rows[:n]}
        got = [(r.doc_id, r.text or "") for r in simhash_dedup.drop_near_duplicates(d.limit(n) if n < len(rows) else d).collect()]
        assert len(got) == len(of)
    assert sorted(map(str, [(r.doc_id, r.text or "") for r in simhash_dedup.drop_near_duplicates(d).collect()])) == sorted(map(str, want))


@pytest.mark.parametrize(("large", "common"), [(8, 3), (2, 10**9), (10**9, 3)])
def test_stage_links_every_pair_of_five_word_shingles(spark, monkeypatch, large, common):
    monkeypatch.setattr(shingle_join, "LARGE", large)
    monkeypatch.setattr(shingle_join, "COMMON", common)
    monkeypatch.setattr(shingle_join, "SAMPLE", 2)
    rng = random.Random(10)
    word = lambda: f"w{rng.randrange(10**5)}"
    passage, texts = [word() for _ in range(25)], ["", None, " ", "a b", "A  b", "a b c d e", "a b c d e f"]
    for k in range(25):
        base = [word() for _ in range(rng.choice((12, 60, 150)))] + (passage if k % 2 else [])
        for _ in range(40 if k == 3 else rng.randint(1, 6)):
            new = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                new[rng.randrange(len(new))] = word()
            texts.append(" ".join(new[: len(new) - rng.randint(0, len(new) // 8)]))
    sets = [frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := (t or "").lower().split()) else frozenset() for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    near = 0
    for i, s in enumerate(sets):
        for j in range(i):
            if 10 * len(s & sets[j]) >= 8 * len(s | sets[j]):
                near += s != sets[j] and ((simhash_dedup.fingerprint(texts[i]) ^ simhash_dedup.fingerprint(texts[j])).bit_count() > 3)
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    assert near > 20  # pairs that fingerprints of three words miss
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, d, "").collect()) == sorted({find(i) for i in range(len(texts))})
    groups = defaultdict(set)
    for r in shingle_join.components(d).collect():
        groups[r.comp].add(r.doc_id)
    want = defaultdict(set)
    for i in range(len(texts)):
        want[find(i)].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert shingle_join.drop_near_duplicates(d.limit(0)).count() == 0


def test_ordinal_learns_and_orders():
    rng = random.Random(4)
    make = lambda g: " ".join(rng.choices("la le lu mi mo".split(), k=30) + (["scum"] * 2 if g == 0 else []) + ([w + "!!" for w in "AB CD EF".split()] * 8 if g == 1 else []))
    grades = np.array([i % 3 for i in range(600)])
    model = quality_classifier.train([quality_classifier.features(make(g)) for g in grades], grades)
    assert (np.diff(model.thresholds) > 0).all()
    held = [(g, model.grade(make(g))) for g in range(3) for _ in range(50)]
    assert np.mean([(p >= 0.5) == (g == 2) for g, (_, p) in held]) > 0.97
    assert np.mean([e for g, (e, _) in held if g == 0]) < np.mean([e for g, (e, _) in held if g == 2])


def test_mix_meets_targets(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(0, 40), f"s{min(4, int(rng.expovariate(0.5)))}" if i % 9 else None) for i in range(3000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = source_mix.mix(d).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, source_mix.mix(d.repartition(3)).collect()))
    source = {i: s for i, _, s in rows}
    taken, target, size = defaultdict(int), {}, {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]], size[source[r.doc_id]] = r.target, r.source_size
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, free, want = 1.5 * sum(size.values()), set(names), {}
    while over := [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * size[s]]:
        for s in over:
            want[s] = 2 * size[s]
            free.remove(s)
        left = 1.5 * sum(size.values()) - sum(want.values())
    want |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    assert all(abs(want[s] - target[s]) < 1e-6 * max(1, want[s]) and abs(taken[s] - target[s]) <= 40 for s in names)


def test_winnowing_finds_every_window(spark):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(9)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice((0, 1, 2, 3, 12, 13, 14, 20, 40))))) for i in range(30)] + [(7, "a a a a a a a a a a a a a a"), (8, None)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(0, 30)) + rng.choice(items)[1].split()[: rng.randint(0, 40)] + rng.choices(vocab, k=5)) if rng.random() < 0.9 else "A a-a a " * 9 for _ in range(150) if (items := [(i, t or "") for i, t in items])]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.contamination(d, bench).collect()}
    parted = {r.doc_id: r for r in decontaminate.contamination(d, bench, slice_words=100).collect()}
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    for i, t in enumerate(texts):
        words, hit, ids = split(t), set(), set()
        for item, other in items:
            w = split(other)
            for window in {tuple(w[j : j + 13]) for j in range(max(1, len(w) - 12))} if w else ():
                for at in range(len(words) - len(window) + 1):
                    if tuple(words[at : at + len(window)]) == window:
                        hit.update(range(at, at + len(window)))
                        ids.add(str(item))
        r = found[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest())
        assert tuple(r) == tuple(parted[i])
    clean = {i for i, r in found.items() if not r.contaminated}
    for size in (10**6, 100):
        assert {r.doc_id for r in decontaminate.drop_contaminated(d, bench, slice_words=size).collect()} == clean


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"abcdef0189 ='\":AKI.-Kſé\n", "password", "TOKEN", "api_key", "secret=", "AKIA" + "Z9" * 9, "0123456789abcdef01234567", "Passwd: "]), max_size=60).map("".join))
def test_base_spans_equal_plain_search(text):
    want = [(m.start(), m.end(), "assign") for m in secret_scan.ASSIGN.finditer(text) if len(m[2]) >= 6]
    want += [(m.start(), m.end(), "access") for m in secret_scan.ACCESS.finditer(text) if len(m[0]) >= 20]
    want += [(m.start(), m.end(), "hex") for m in secret_scan.HEX.finditer(text) if len(m[0]) >= 24]
    assert sorted(want) == sorted(s for s in secret_scan.spans(text) if s[2] in secret_scan.KINDS[:3])


def test_checksums_and_redaction():
    import zlib

    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    left, check = zlib.crc32(body.encode()), ""
    for _ in range(6):
        left, digit = divmod(left, 62)
        check = secret_scan.BASE62[digit] + check
    good, bad = f"x ghp_{body}{check} y", f"x ghp_{body}{check[:-1]}{'0' if check[-1] != '0' else '1'} y"
    assert [s[2] for s in secret_scan.spans(good)] == ["github"] and secret_scan.spans(bad) == []
    assert secret_scan.redact(good) == "x [github] y" and secret_scan.redact("password: abcdefgh.") == "[assign]" and secret_scan.redact(None) is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "odd\nrole\\"]), st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "/", "s>", "\n", "é", " "]), max_size=12).map("".join)), max_size=6))
def test_formatting_is_reversible(turns):
    formatted, mask = chat_format.format_turns(turns)
    assert chat_format.read_turns(formatted) == turns
    assert [chat_format.unescape(formatted[s:e]) for s, e in mask] == [t for r, t in turns if r == "assistant"]


def test_reply_trees(spark):
    nodes = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 5.0), (1, 4, 3, "user", "more", None), (None, 1, 99, "user", None, 1.0)]
    nodes += [(2, i, i - 1 if i else None, "user", str(i), 1.0) for i in range(40)] + [(3, 1, 2, "u", "x", 0.0), (3, 2, 1, "u", "y", 0.0)]
    d = spark.createDataFrame(nodes, "tree long, node long, parent long, role string, text string, score double")
    got = {(r.conv_id, r["rank"]): [t for _, t in chat_format.read_turns(r.formatted)] for r in chat_format.conversations(d, branches=2).collect()}
    assert got == {(1, 1): ["q", "good", "more"], (1, 2): ["q", "bad"], (None, 1): [""], (2, 1): [str(i) for i in range(40)]}
    assert chat_format.conversations(d.limit(0)).count() == 0


def test_pipeline_runs_and_its_decisions_hold(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert out.select("doc_id").join(docs.select("doc_id"), "doc_id", "left_anti").count() == 0
    last = corpus_pipeline.run(spark, sf)
    assert 0 < last.count() < docs.count() and last.where(F.col("taken") > 2 * F.col("size")).count() == 0


@pytest.mark.parametrize("stage", ["quality", "near_duplicates", "benchmark", "secrets"])
def test_stages_that_map_texts_bound_their_batches(spark, stage, tmp_path):
    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" ")), 700), F.col("id").cast("string")).alias("text"))
    spark.range(20).selectExpr("id as doc_id", "int(id % 2) as quality", "0 as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.conf.unset(name := "spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        dict(corpus_pipeline.STAGES)[stage](spark, docs.limit(40), str(tmp_path))
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows], "bytes": [b.nbytes]}) for b in batches), "n long, bytes long").collect()
    finally:
        spark.conf.unset(name)
    assert sum(r.n for r in sizes) == 6000
    assert max(r.bytes for r in sizes) < 1.5 * common.BATCH


def test_a_process_keeps_one_memo_of_those_alone():
    made = []
    first, second, other = (common.Memo(lambda w: made.append(w) or len(w), alone=alone) for alone in (True, True, False))
    assert [first["a"], other["bb"], first["a"], second["ccc"], second["ccc"]] == [1, 2, 1, 3, 3]
    assert (len(first), len(second), len(other)) == (0, 1, 1)
    assert first["a"] == 1 and not second and made == ["a", "bb", "ccc", "a"]
