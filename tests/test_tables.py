"""Statements of short texts, shapes of nested records, and contracts, on hand-made rows."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from recordloom.functions import statements
from recordloom.operators import tables
from recordloom.plans.shapes import CONTRACTS, SHAPES


def one(spark, fn, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(fn(*(F.col(c) for c in df.columns)).alias("x")).first().x


@pytest.mark.parametrize(
    ("fn", "given", "wanted"),
    [
        (statements.states_nothing, ("'TBD' ",), True), (statements.states_nothing, (None,), True), (statements.states_nothing, ("00 CFR NYD",), True), (statements.states_nothing, ("0 CFR 00",), True),
        (statements.states_nothing, ("0 CFR 150 to 189",), False), (statements.states_nothing, ("none given",), False),
        (statements.year_last, ("the 2019 Rivers Act",), "Rivers Act of 2019"), (statements.year_last, ("Rivers Act",), None),
        (statements.printed_dates, ("Printed March 3, 2021 and 4/05/22; not 13 days",), ["2021-03-03", "2022-04-05"]), (statements.printed_dates, ("12/1/1999",), ["1999-12-01"]),
        (statements.subjects, ("Air quality, Trade;  and U.S. Mint. Then more.",), ["Air quality", "Trade", "U.S. Mint"]),
        (statements.vote, (" Not  Voting",), "not_voting"), (statements.vote, ("Guilty",), "yea"), (statements.vote, ("maybe",), None),
        (statements.title_key, ("A “Big”\n Rule’s  Name",), "a \"big\" rule's name"), (statements.title_key, (None,), ""),
        (statements.last_name, ("O'Hara, Rivers-Hill, J. smith",), "SMITH"), (statements.last_name, ("X.",), ""),
        (statements.media_type, ("PDF", "x"), "application/pdf"), (statements.media_type, (None, "https://h.example/a.b/c.HTM?q=1.pdf"), "text/html"),
        (statements.media_type, (None, "https://h.example/dir.xml/"), "application/octet-stream"), (statements.media_type, (" Text/CSV ", "a.pdf"), "text/csv"),
        (statements.body_status, ("see [TEXT NOT AVAILABLE REFER TO PDF]", "pdf"), "publisher_placeholder"), (statements.body_status, ("x", "pdf"), "pdf_extracted"), (statements.body_status, ("x", "htm"), "not_flagged"),
        (statements.is_shell, ('<body><div id="root"></div>',), True), (statements.is_shell, ("<p>",), False), (statements.is_error_page, ("go to www.GOVINFO.gov/error",), True),
        (statements.publication, (" https://www.cbo.gov/publication/60123",), "60123"), (statements.publication, ("https://www.cbo.gov/publication/060",), None),
        (statements.law_table_file, ("118-5",), "118_5.htm"), (statements.law_table_file, ("1941:12",), "1941_12.htm"), (statements.law_table_file, ("0-5",), None),
        (statements.register_series, ("C7-12345",), "Z7-12345"), (statements.register_series, ("C7-01234",), "C7-01234"),
        (statements.names_activity, ("Report on Activities",), True), (statements.names_activity, (None,), False),
    ],
)
def test_statements(spark, fn, given, wanted):
    assert one(spark, fn, *given) == wanted


def test_recommendations_and_tallies(spark):
    got = one(spark, statements.stated_recommendation, "Do it. (Recommendation 4-2)")
    assert (got.kind, got.number) == ("recommendation", "4-2")
    assert one(spark, statements.stated_recommendation, "[Matter for congressional consideration 3].").kind == "matter" and one(spark, statements.stated_recommendation, "none") is None
    row = spark.sql("select map('yeas', 5, 'nays', 4, 'absent', 2, 'odd', 9) m").select(statements.tally(F.col("m")).alias("t")).first().t
    assert tuple(row) == (5, 4, None, 2) and row.__fields__ == ["yea", "nay", "present", "not_voting"]
    assert statements.camel("receive_date_json") == "receiveDate" and statements.cycles(1985) == [1980, 1982, 1984, 1986]


RECORDS = {
    "bill_actions": {"identity": {"congress": 118, "bill_type": "hr", "number": 7}, "action_index": 2, "is_latest": True, "action": {"action_date": "2024-01-02", "text": "Passed", "recorded_votes": [1, 2]}, "stage": {"stage": "passed"}},
    "amendments": {"record": {"congress": 118, "type": "HAMDT", "number": 3, "sponsors": [{"fullName": "A B"}], "latestAction": {"text": "Agreed"}}},
    "member_votes": {"vote": {"congress": 118, "chamber": "senate", "session": 1, "roll_number": 9}, "member": {"lis_id": "S1", "bioguide_id": "B1", "name": "N", "vote": "Yea"}},
    "treaties": {"read": {"congressReceived": 116, "number": 2, "suffix": "", "countriesParties": [{"name": "X"}, {"name": "Y"}], "actions": {"count": 3}}},
    "nominations": {"record": {"citation": "PN1", "nominationType": {"isCivilian": False}}},
    "press_releases": {"release": {"chamber": "house", "link": "l", "description_text": "abc", "categories": ["a"]}, "feed": {"url": "f"}, "channel": {"title": "t"}},
}
WANTED = {
    "bill_actions": {"bill_id": "118-hr-7", "action_index": "2", "is_latest_action": "true", "action_text": "Passed", "recorded_vote_count": "2", "stage": "passed", "action_code": None},
    "amendments": {"amendment_id": "118-hamdt-3", "sponsor_full_name": "A B", "sponsor_party": None, "latest_action_text": "Agreed", "latest_action_date": None},
    "member_votes": {"vote_id": "118-senate-1-9", "member_key": "lis:S1", "position": "Yea"},
    "treaties": {"treaty_id": "116-2", "package_id": "CDOC-116tdoc2", "countries_json": '["X","Y"]', "action_count": "3", "topic": None},
    "nominations": {"citation": "PN1", "is_civilian": "false", "nomination_type_json": '{"isCivilian":false}', "url": None},
    "press_releases": {"release_id": "sha256:" + hashlib.sha256(b"house|l").hexdigest(), "description_chars": "3", "categories_json": '["a"]', "channel_title": "t", "channel_ttl": None},
}


@pytest.mark.parametrize("name", sorted(RECORDS))
def test_shapes(spark, name):
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(RECORDS[name])]))
    out = tables.shaped(df, SHAPES[name])
    assert out.columns == list(CONTRACTS[name].columns) and {f.dataType.typeName() for f in out.schema} == {"string"}
    row = out.first().asDict()
    assert {k: row[k] for k in WANTED[name]} == WANTED[name]


def test_every_shape_reads_an_empty_record(spark):
    for name, shape in SHAPES.items():
        assert set(CONTRACTS[name].identity) <= set(shape)


def test_contract_refuses_as_data(spark):
    own = tables.TableContract("t", ("id", "part", "bill_id"), ("id", "part"), references={"bill_id": ("bills", "bill_id")})
    df = spark.createDataFrame([("a", "1", "x"), ("a", "1", "y"), ("b", "", "x"), (None, "1", None), ("c", "2", "z")], "id string, part string, bill_id string")
    got = sorted((r.id or "", r.part, r.bill_id or "", r.refused) for r in own.checked(df.select("bill_id", "part", "id")).collect())
    assert got == [("", "1", "", "no_identity"), ("a", "1", "x", "repeated_identity"), ("a", "1", "y", "repeated_identity"), ("b", "", "x", "no_identity"), ("c", "2", "z", None)]
    assert df.select(own.spelled_key().alias("k")).first().k == '["a","1"]'
    lost = own.dangling(df, {"bills": spark.createDataFrame([("x",)], "bill_id string")})
    assert sorted(map(tuple, lost.collect())) == [("bill_id", "y", 1), ("bill_id", "z", 1)]
    for odd in (df.drop("part"), df.withColumn("more", F.lit("")), df.withColumn("part", F.lit(1))):
        with pytest.raises(ValueError):
            own.checked(odd)
    with pytest.raises(ValueError):
        tables.TableContract("t", ("id",), ("key",))


def test_latest_place_and_merged_details(spark):
    df = spark.sql("select array(named_struct('d', 1, 't', 'a'), named_struct('d', 2, 't', 'b'), named_struct('d', 1, 't', 'a')) l, named_struct('d', 1, 't', 'a') x, named_struct('d', 9, 't', 'a') y")
    assert tuple(df.select(tables.latest_place(df, "l", "x", ("d", "t")), tables.latest_place(df, "l", "y", ("d", "t"))).first()) == (2, None)
    assert [r.i for r in tables.numbered(df, "l", "entry", "i").collect()] == [0, 1, 2]
    rows = spark.createDataFrame([("k", 0, None, "a"), ("k", 1, "b", "c")], "key string, rank int, p string, q string")
    assert list(map(tuple, tables.first_stated(rows, ["key"], ["rank"], ["p", "q"]).collect())) == [("k", "b", "a")]


def test_each_row_takes_its_best_tier(spark):
    from recordloom.operators import link

    left = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "x"), (4, "z", "z")], "l_id long, k1 string, k2 string")
    right = spark.createDataFrame([(10, "a", "x"), (11, "q", "x")], "r_id long, k1 string, k2 string")
    got = link.best_tier(left, right, "l_id", "r_id", [("first", F.col("k1"), F.col("k1")), ("second", F.col("k2"), F.col("k2"))])
    assert sorted(map(tuple, got.collect())) == [(1, 10, "first"), (2, 10, "second"), (2, 11, "second"), (3, 10, "second"), (3, 11, "second")]


def test_swapped_letters_may_be_edited_on():
    from recordloom.operators.coordinates import edit_distance

    assert [edit_distance(*p) for p in (("ca", "abc"), ("ab", "ba"), ("", "abc"), ("abc", "abc"), ("kitten", "sitting"))] == [2, 1, 3, 0, 3]


def test_image_headers_with_fill_and_early_end():
    from recordloom.sources.readers import image_size

    frame = b"\xff\xc0\x00\x11\x08\x00\x20\x00\x30" + b"\x00" * 8
    assert image_size(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xff\xff" + frame[1:]) == ("jpeg", 48, 32)
    assert image_size(b"\xff\xd8\xff\x01\xff\xd0" + frame) == ("jpeg", 48, 32)
    assert image_size(b"\xff\xd8\xff\xda\x00\x08" + frame) == ("jpeg", None, None)
    assert image_size(b"GIF89a\x01") == ("gif", None, None) and image_size(b"BM") == (None, None, None)
    assert image_size(b"\x89PNG\r\n\x1a\n\x00\x00\x00\rXXXX" + b"\x00" * 8) == ("png", None, None)


def test_gaps_of_sparse_keys(spark):
    from recordloom.operators import quality

    keys = [1, 2, 5, 10**7, 10**13, 10**13 + 1, -(10**15)]
    got = sorted(map(tuple, quality.gaps(spark.createDataFrame([(k,) for k in keys], "k long"), "k").collect()))
    own = sorted(keys)
    assert got == [(a + 1, b - 1) for a, b in zip(own, own[1:], strict=False) if b > a + 1]


def test_lone_backticks_stay(spark):
    from recordloom.functions import identifiers

    assert one(spark, identifiers.plain_glyphs, "a `b` ``c'' ‘d’") == "a `b` \"c\" 'd'"


def test_requests(spark):
    from recordloom.functions import requests

    urls = [("https://h.example/a?x=1&page=2&y&page=3#f", "https://h.example/a?x=1&y=&page=a+b"), ("https://h.example/a", "https://h.example/a?page=a+b")]
    for url, wanted in urls:
        assert one(spark, lambda u: requests.with_query(u, "page", F.lit("a b")), url) == wanted
    days = spark.sql("select date'2024-03-01' a, date'2024-02-01' b, cast(null as date) n")
    got = days.select(requests.day_window(F.col("a"), F.col("a")).alias("x"), requests.day_window(F.col("a"), F.col("b")).alias("y"), requests.day_window(F.col("n"), F.col("b")).alias("z")).first()
    assert tuple(got.x) == ("2024-02-29T23:59:59Z", "2024-03-02T00:00:00Z") and got.y is None and tuple(got.z) == (None, "2024-02-02T00:00:00Z")
    assert requests.walk_sizes(250) == [250, 237, 223] and requests.walk_sizes(5) == [5] and requests.reach(250, 10_000) == min(10_000 // s * s for s in (250, 237, 223))
    fits = spark.sql("select * from values (118, 137), (118, 130), (60, 35), (50, 30), (null, 1) t(c, v)").select(requests.volume_fits(F.col("c"), F.col("v")).alias("x"))
    assert [r.x for r in fits.collect()] == [True, False, True, None, None]
    assert one(spark, requests.unwrapped, "a co-\nlumn\nof text") == "a column of text"
    bad = spark.sql("select array('1234-AB56', 'x', null) l, cast(null as array<string>) n").select(requests.number_problems(F.col("l")).alias("l"), requests.number_problems(F.col("n")).alias("n")).first()
    assert bad.l == ["x", None] and bad.n == []


def test_tree_agreement_without_links(spark):
    from recordloom.operators import quality

    edges = spark.createDataFrame([("d", 1, 2), ("d", 1, 2), ("d", 1, 3)], "doc string, parent long, child long")
    got = quality.tree_agreement(edges, edges.where("child = 2"), ["doc"]).first()
    assert (got.shared, got.n_reference, got.n_candidate, got.precision, got.recall) == (1, 2, 1, 1.0, 0.5) and abs(got.f1 - 2 / 3) < 1e-12
    assert quality.tree_agreement(edges, edges.limit(0), ["doc"]).first().f1 == 0.0


@pytest.mark.parametrize("block", [2, 4096])
def test_token_pairs_equal_all_pairs(spark, monkeypatch, block):
    import random

    from recordloom.operators import link

    monkeypatch.setattr(link, "BLOCK", block)
    rng = random.Random(20)
    sets = [sorted(rng.sample("abcdefghijkl", rng.randint(1, 9))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, tokens array<string>")
    for least in (0.3, 0.8):
        got = {(r.q_id, r.r_id) for r in link.pairs_by_tokens(df, df, least=least).collect()}
        assert got == {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if len(set(a) & set(b)) >= least * len(set(a) | set(b)) - 1e-9}


def test_batches_append_a_key_once(spark, tmp_path):
    from recordloom.streaming import ingest

    schema = "id long, v string"
    for n, rows in enumerate(([(1, "a"), (2, "b"), (1, "c")], [(2, "d"), (3, "e")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}.parquet")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*.parquet")
        ingest.append_once(stream, f"{tmp_path}/out", f"{tmp_path}/check", ["id"]).awaitTermination(60)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r.id for r in got) == [1, 2, 3] and {r.v for r in got if r.id == 2} == {"b"}
