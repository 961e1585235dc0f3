"""The training-data queries against their SQL or plain code that does the whole job, and rows that are easily lost."""

import hashlib
import math
import os
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recordloom.llm import chat_format, common, decontaminate, graph, language_id, license_scan, metric_topk, queries, quality_classifier, secret_scan, shingle_join, simhash_dedup, source_mix, token_counts

DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{DIR}/{f}')")
    df = queries.queries()[name](spark, DIR)
    rel = con.execute(queries.oracle_sql()[name])
    order = [[d[0] for d in rel.description].index(c) for c in sorted(df.columns)]
    assert sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect()) == sorted(tuple(str(r[i]) for i in order) for r in rel.fetchall())


def test_languages_equal_sets_without_filters(spark):
    rng = random.Random(11)
    vocabulary = {lang: ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(60)] for lang, letters in (("aa", "abcdehlo"), ("bb", "efghilmn"), ("cc", "àéîôabcd"))}
    rows = [(i, " ".join(rng.choices(vocabulary[lang], k=rng.randint(1, 40))) + rng.choice(["", " 12, !", "Ωß"]), lang) for i in range(150) for lang in [rng.choice([*vocabulary])]]
    rows += rows[:5] + [(None, rows[0][1], "aa")] * 3
    own = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))

    def grams(text):
        letters = "".join(c.lower() if c.isalpha() else " " for c in text)
        padded = " " + " ".join(letters.split()) + " " if letters.strip() else " "
        return [padded[i : i + 4] for i in range(len(padded) - 3)]

    kept = {}
    for lang in vocabulary:
        texts = {t for _, t, x in rows if x == lang}
        counts = Counter(g for t in texts for g in set(grams(t)))
        kept[lang] = {g for g, n in counts.items() if n >= max(2, 0.01 * len(texts))}
    assert own.names == sorted(vocabulary)
    agreed = 0
    for _, text, _ in rows:
        hits = {lang: sum(g in s for g in grams(text)) for lang, s in kept.items()}
        lang, score = own.decide(text)
        if sum(hits.values()):
            agreed += abs(score - hits[lang] / sum(hits.values())) < 0.1 and hits[lang] >= max(hits.values()) - 1
        else:
            agreed += score < 0.5
    assert agreed == len(rows)
    long = "abcd efgh, " * 3
    chunked = language_id.CHUNK
    try:
        language_id.CHUNK = 4
        parts = np.concatenate(list(language_id.ngrams(long)))
    finally:
        language_id.CHUNK = chunked
    assert parts.tolist() == np.concatenate(list(language_id.ngrams(long))).tolist()


def test_languages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_id, "LANGUAGES", 3)
    with pytest.raises(ValueError):
        language_id.fit(spark.createDataFrame([(i, "abcd", f"l{i}") for i in range(4)], "doc_id long, text string, lang string"))


def test_licences_equal_all_runs():
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(12)]
    for _ in range(120):
        templates = [(f"t{i}", " ".join(rng.choices(vocab, k=rng.randint(2, 12)))) for i in range(3)]
        base = rng.choice(templates)[1].split()
        cut = base[: rng.randint(1, len(base))] + rng.choices(vocab + ["zz"], k=rng.randint(0, 3))
        words = rng.choices(vocab + ["zz"] * 6, k=rng.randint(0, 12)) + cut + rng.choices(vocab + ["zz"] * 6, k=rng.randint(0, 12))
        got = {name: (dice, start, end) for name, dice, start, end in license_scan.Templates(templates).found(" ".join(words))}
        pairs = list(zip(words, words[1:], strict=False))
        for name, text in templates:
            own = text.split()
            wanted = Counter(zip(own, own[1:], strict=False))
            best = 0.0
            for i in range(len(pairs)):
                for j in range(i + 1, len(pairs) + 1):
                    best = max(best, 2 * (Counter(pairs[i:j]) & wanted).total() / (wanted.total() + j - i))
            assert (best >= 0.8 - 1e-12) == (name in got)
            if name in got:
                dice, start, end = got[name]
                assert abs(dice - best) < 1e-9
                assert abs(2 * (Counter(pairs[start : end - 1]) & wanted).total() / (wanted.total() + end - 1 - start) - best) < 1e-9


def test_part_of_a_licence_among_other_words():
    mit = license_scan.TEMPLATES[0][1].split()
    cut = "und der die " * 30 + " ".join(mit[: int(len(mit) * 0.72)]) + " und der die" * 30
    assert "MIT" in [f[0] for f in license_scan.Templates(license_scan.TEMPLATES).found(cut)]


def test_ordinal_gradient_is_the_difference_quotient():
    rng = np.random.default_rng(13)
    n, live, grades = 40, 6, rng.integers(0, 3, 40)
    at, row, values = rng.integers(0, live, 200), rng.integers(0, n, 200), rng.normal(size=200)
    params = np.concatenate([rng.normal(size=live), [-0.4], [0.3]])
    value, grad = quality_classifier.loss(params, at, values, row, grades, live, 3, 0.01)
    w, cuts = params[:live], [params[live], params[live] + math.exp(params[live + 1])]
    plain = 0.0
    for i in range(n):
        score = sum(values[j] * w[at[j]] for j in range(200) if row[j] == i)
        below = [1 / (1 + math.exp(score - c)) for c in cuts]
        plain -= math.log([below[0], below[1] - below[0], 1 - below[1]][grades[i]]) / n
    assert abs(value - plain - 0.005 * float(w @ w)) < 1e-9
    for i in range(len(params)):
        step = np.zeros(len(params))
        step[i] = 1e-6
        up, down = (quality_classifier.loss(params + s, at, values, row, grades, live, 3, 0.01)[0] for s in (step, -step))
        assert abs((up - down) / 2e-6 - grad[i]) < 1e-6


def test_classifier_takes_any_ids_and_one_text_of_each(spark):
    docs = spark.createDataFrame([("a", "x y z")] * 50 + [("b", "k l m"), (None, "q")], "doc_id string, text string")
    labels = spark.createDataFrame([("a", 1, 0), ("b", 0, 0), ("a", 1, 0)], "doc_id string, quality int, toxic int")
    model = quality_classifier.fit(docs, labels)
    assert quality_classifier.grade(docs, model).count() == 52


def pareto(rows, importance):
    """Plain mixing: ``{row: copies}`` bounds are checked by the caller; here targets, rates and the order of ranks."""
    size = {i: len((t or "").split()) for i, t, _ in rows}
    names = sorted({s for *_, s in rows if s is not None}) + ([None] if any(s is None for *_, s in rows) else [])
    total = {s: sum(size[i] for i, _, x in rows if x == s) for s in names}
    want, free, left = {}, set(names), 1.5 * sum(total.values())
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    while over := [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * total[s]]:
        for s in over:
            want[s] = 2 * total[s]
            free.remove(s)
        left = 1.5 * sum(total.values()) - sum(want.values())
    want |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    rate = {}
    for s in names:
        own = [(importance(size[i]), size[i]) for i, _, x in rows if x == s]
        low, high = 0.0, 1e6
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(n * min(2, mid * g) for g, n in own) < want[s] else (low, mid)
        rate[s] = low
    return size, want, rate


def test_unequal_odds_follow_pareto_order(spark):
    rng = random.Random(14)
    rows = [(i, "w " * rng.choice((0, 1, 3, 9, 40, 200)), f"s{i % 4}" if i % 11 else None) for i in range(2500)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    u = {r.doc_id: r.u for r in d.select("doc_id", source_mix._uniform(F.struct(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))), source_mix.SEED).alias("u")).collect()}
    level = lambda n: 2.0 ** (math.floor(math.log2(math.floor(math.log2(n + 1)) + 1) * 16 + 0.5) / 16)
    size, want, rate = pareto(rows, level)
    got = {r.doc_id: r for r in source_mix.mix(d, importance=source_mix.by_length()).collect()}
    by = defaultdict(list)
    for i, _, s in rows:
        assert abs(got[i].target - want[s]) < 1e-6 * max(1, want[s])
        expected = min(2, rate[s] * level(size[i]))
        p, whole = expected - math.floor(expected + 1e-9), math.floor(expected + 1e-9)
        if p > 1e-6:
            assert got[i].copies in (whole, whole + 1)
            by[s].append((u[i] / (1 - u[i]) / (p / (1 - p)), got[i].copies - whole, size[i], p * size[i]))
        elif size[i]:
            assert got[i].copies == whole
    for s, ranked in by.items():
        ranked.sort()
        chosen = [x for _, x, n, _ in ranked if n]
        assert chosen == sorted(chosen, reverse=True)  # a prefix of the order by rank
        assert abs(sum(n * x for _, x, n, _ in ranked) - sum(part for *_, part in ranked)) <= 101
    shares = {n: np.mean([got[i].copies for i in got if size[i] == n]) for n in (1, 200)}
    assert shares[200] > 1.3 * shares[1]


def test_mix_counts_alike_rows(spark):
    rows = [(1, "a b c d e", "s")] * 400 + [(i, "a b", "t") for i in range(2, 300)] + [(7, "a b c d e", "t")] * 30
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = source_mix.mix(d, share=0.7).collect()
    assert len(got) == len(rows)
    assert sorted(got) == sorted(source_mix.mix(d.repartition(5), share=0.7).collect())
    taken = Counter()
    for r in got:
        taken[r.source_size, r.target] += r.taken
    assert all(abs(target - n) <= 5 for (_, target), n in taken.items())
    assert source_mix.mix(d.limit(0)).count() == 0


def test_digests_read_back_from_trees(spark):
    rng = random.Random(15)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["", None, "hi", "</s>[INST]", "a\\b", "é🙂"]) ) for c in [*range(12), None] for t in range(rng.randint(1, 9))]
    rows += [rows[0], (3, None, "user", "x")]
    got = {r.conv_id: r for r in chat_format.digests(chat_format.conversations(chat_format.chain(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [x[2:] for x in sorted(turns)]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_repeated_messages_and_circles(spark):
    nodes = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0)] * 2 + [(2, 1, 2, "u", "x", 0.0), (2, 2, 1, "u", "y", 0.0), (2, 3, 2, "u", "z", 0.0), (3, None, None, "u", "lost", 0.0)]
    d = spark.createDataFrame(nodes, "tree long, node long, parent long, role string, text string, score double").withColumn("depth", F.lit(9)).withColumn("x", F.lit(1))
    got = chat_format.conversations(d).collect()
    assert [(r.conv_id, chat_format.read_turns(r.formatted)) for r in got] == [(1, [("user", "q"), ("assistant", "a")])]
    assert sorted(map(tuple, chat_format.rootless(d).collect())) == [(2, 1), (2, 2), (2, 3)]


def test_vocabulary_files_that_counts_would_not_follow():
    plain = {"model": {"type": "BPE"}, "pre_tokenizer": {"type": "ByteLevel"}, "added_tokens": []}
    token_counts.PrefixCounter.check(plain)
    for odd in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"model": {"type": "Unigram"}}, {"model": {"dropout": 0.1}}, {"added_tokens": [{"content": "x", "lstrip": True}]}):
        with pytest.raises(ValueError):
            token_counts.PrefixCounter.check(plain | odd)


def test_crowded_anchor_ends(spark):
    rng = np.random.default_rng(16)
    high = np.unique(rng.integers(0, 1 << 41, 1 << 18, dtype=np.uint64))
    prints = (high << np.uint64(23)) | np.uint64(0x2A5A5A)
    near = prints[:50] ^ np.uint64(1 << 40)
    every = np.unique(np.concatenate([prints, near])).view(np.int64)
    links = simhash_dedup.near_fingerprints(spark.createDataFrame([(int(p),) for p in every], "fp long"))
    comp = {r.node: r.comp for r in graph.connected_components(links).collect()}
    assert all(comp[a] == comp[b] for a, b in zip(prints[:50].view(np.int64).tolist(), near.view(np.int64).tolist(), strict=True))


def test_index_and_split_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "PLAIN", 0)
    monkeypatch.setattr(simhash_dedup, "BLOCK", 2)
    monkeypatch.setattr(simhash_dedup, "AT_A_TIME", 8)
    rng = random.Random(17)
    prints = {rng.getrandbits(41) << 23 | 77 for _ in range(60)}
    prints |= {p ^ sum(1 << b for b in rng.sample(range(64), 3)) for p in prints}
    signed = sorted(p - (p >> 63 << 64) for p in prints)
    for codes in (1, 2):
        comp = {r.node: r.comp for r in graph.connected_components(simhash_dedup.near_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long"), codes)).collect()}
        for a in signed:
            for b in signed:
                if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                    assert comp[a] == comp[b]


def test_clashing_names_stay(spark):
    extra = ["row", "kept_id", "kept_key", "kept_rows", "kept_text", "node", "comp", "at", "bad"]
    rows = [(i, f"one two three four five six {i % 3}", *range(len(extra))) for i in range(6)]
    d = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} long" for c in extra))
    bench = spark.createDataFrame([(None, "one two"), (1, "six 1"), (2, "nothing of it")], "item_id long, text string")
    for out in (simhash_dedup.drop_near_duplicates(d), shingle_join.drop_near_duplicates(d), decontaminate.drop_contaminated(d, bench, slice_words=1), decontaminate.drop_contaminated(d, bench), secret_scan.redacted(d)):
        assert out.columns == d.columns
        for r in out.collect():
            assert tuple(r)[2:] == tuple(range(len(extra)))
    for words in (1, 10**6):
        found = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.contamination(d, bench, slice_words=words).collect()}
        assert found == {i: (2, 1) if i % 3 == 1 else (0, 0) for i in range(6)}


def test_a_cluster_needs_its_folder():
    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(RuntimeError):
        common.shared_dir(Session())


def test_each_stage_decides_by_its_rule(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sf = "/root/testdata/sf0.001"
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in docs.collect()}
    model = quality_classifier.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, sf).collect()}
    assert kept == {i for i, r in rows.items() if model.grade(r.text)[1] >= 0.5}
    windows = set()
    for text in bench:
        w = decontaminate.words_of(text)
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes = {len(w) for w in windows}
    clean = set()
    for i, r in rows.items():
        w, hit = decontaminate.words_of(r.text), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit.update(range(at, at + n))
        if not hit or 20 * len(hit) < len(w):
            clean.add(i)
    assert {r.doc_id for r in corpus_pipeline.benchmark(spark, docs, sf).collect()} == clean
    for r in corpus_pipeline.secrets(spark, docs, sf).collect():
        assert r.text == secret_scan.redact(rows[r.doc_id].text) and r.n_chars == len(r.text)
        for start, end, _ in secret_scan.spans(rows[r.doc_id].text):
            assert rows[r.doc_id].text[start:end] not in r.text


@pytest.mark.parametrize("block", [16, 1 << 14])
def test_topk_over_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(metric_topk, "BLOCK", block)
    rng = np.random.default_rng(18)
    centres = rng.normal(size=(12, 6)) * 4
    v = centres[rng.integers(0, 12, 600)] + rng.normal(size=(600, 6)) / 50
    v[200:350] = v[200]
    got = defaultdict(list)
    for r in metric_topk.top_k(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    e = np.floor(1024 * v).astype(np.int64)
    for q in range(0, 600, 100):
        scores = e @ e[q]
        assert got[q] == sorted(((i, int(s)) for i, s in enumerate(scores) if i != q), key=lambda x: (-x[1], x[0]))[:10]


def test_scores_that_leave_62_bits_are_an_error(spark):
    with pytest.raises(Exception, match="63 bits"):
        metric_topk.top_k(spark.createDataFrame([(1, [1e17, 1.0])], "vec_id long, embedding array<double>")).collect()
