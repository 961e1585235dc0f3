"""Findings, sequences, comparisons and readers on small hand-made inputs."""

import datetime
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from recordloom.functions import text
from recordloom.operators import compare, extract, sequence
from recordloom.sources import readers

DIR, EPOCH = "/root/testdata/sf0.01", datetime.date(1970, 1, 1)


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("under 5 U.S.C. § 552(b)(4).", [("code", "5 USC 552(b)(4)")]),
        ("40 CFR part 60", [("regulations", "40 CFR 60")]),
        ("Pub. L. 117-58 and Public Law No. 94–553", [("public_law", "117-58"), ("public_law", "94-553")]),
        ("86 FR 1,234; 135 Stat. 429", [("register", "86 FR 1234"), ("statutes", "135 Stat. 429")]),
        ("H.R. 3684, S. Con. Res. 14 and HJRES 7", [("bill", "hr-3684"), ("bill", "sconres-14"), ("bill", "hjres-7")]),
        ("410 U.S. 113", [("reports", "410 U.S. 113")]),
        ("53 USC 1; 51 CFR 2", [("code", None), ("regulations", None)]),
        ("RIN 2060-av16 in EPA-HQ-OAR-2021-0317-0001", [("rin", "2060-AV16"), ("document", "EPA-HQ-OAR-2021-0317-0001")]),
        ("EPA-HQ-OAR-2021-0317", [("docket", "EPA-HQ-OAR-2021-0317")]),
        ("$1.2 million, $19.96 and $5", [("dollars", "120000000"), ("dollars", "1996"), ("dollars", "500")]),
        ("Executive Order 12,866 for fiscal year 2024", [("order", "12866"), ("fiscal_year", "2024")]),
        ("GAO-21-105 and IF12345", [("gao_report", "GAO-21-105"), ("crs_report", "IF12345")]),
        ("S. 5 (a)", []), ("", []), (None, []),
    ],
)
def test_findings(given, wanted):
    got = extract.findings_of(given)
    assert [f[:2] for f in got] == wanted
    assert all(f[2] < f[3] and (f[1] is None) == (f[4] is not None) for f in got)


def test_findings_of_rows_and_odd_texts(spark):
    rows = spark.createDataFrame([(1, "é 5 USC 1", 0), (1, "é 5 USC 1", 0), (2, None, 0), (3, "", 0), (None, "x@y.org", 0), (4, "$1 " * 50_000, 0)], "id long, text string, kind int")
    got = extract.findings(rows, "id", "text")
    assert got.where("id = 1").select("value", "start", "end").collect() == [("5 USC 1", 2, 9)] * 2
    assert got.where("id = 4").count() == 50_000 and got.where("id is null").first().value == "x@y.org"
    assert extract.findings(rows.limit(0), "id", "text").count() == 0


def test_sweep_against_a_plain_loop(spark):
    from recordloom.plans import catalog

    got = {(r.o_custkey, r.o_orderkey) for r in catalog.queries()["interval_sweep"](spark, DIR).collect()}
    rows = [(r.o_custkey, (d := (r.day - EPOCH).days), -(d + 30 + r.o_orderkey % 90), r.o_orderkey) for r in spark.read.parquet(f"{DIR}/orders.parquet").withColumn("day", F.to_date("o_orderdate")).collect()]
    want, last = set(), {}
    for c, start, minus_end, o in sorted(rows):
        if start >= last.get(c, start):
            last[c] = -minus_end
            want.add((c, o))
    assert got == want


def test_sentences(spark):
    given = 'Dr. A. Smith spoke. "Yes!" 5 agreed?  No. 3 of them left'
    got = sequence.sentences(spark.createDataFrame([(given,), (None,)], "t string"), "t").orderBy("n_sentence").collect()
    assert [r.sentence for r in got] == ["Dr. A. Smith spoke.", '"Yes!"', "5 agreed?", "No. 3 of them left"]


def test_sentences_lose_nothing(spark):
    from recordloom.plans import catalog

    rows = spark.read.parquet(f"{DIR}/conversations.parquet").where("text is not null").groupBy("conv_id", "turn").agg(F.sum(F.length(F.regexp_replace("text", r"\s", ""))).alias("n"))
    cut = catalog.queries()["sentence_split"](spark, DIR).groupBy("conv_id", "turn").agg(F.sum(F.length(F.regexp_replace("sentence", r"\s", ""))).alias("n"))
    assert rows.exceptAll(cut).count() == cut.exceptAll(rows).count() == 0


def test_scopes_mentions_and_qualifiers(spark):
    points = spark.createDataFrame([("a", x) for x in (0, 5, 9, 10, 30)] + [("b", 5)], "k string, at long")
    intervals = spark.createDataFrame([("a", 5, 10, "one"), ("a", 10, 20, "two")], "k string, begin long, end long, name string")
    got = {(r.k, r.at): r.name for r in sequence.containing(points, intervals, "k").collect()}
    assert got == {("a", 0): None, ("a", 5): "one", ("a", 9): "one", ("a", 10): "two", ("a", 30): None, ("b", 5): None}
    m = spark.createDataFrame([("a", 0, "x"), ("a", 3, None), ("a", 4, None), ("a", 8, "y"), ("b", 1, None)], "k string, at long, v string")
    near = {(r.k, r["at"]): r.nearest for r in sequence.nearest_mention(m, "k", "at", F.col("v").isNotNull(), F.col("v")).collect()}
    assert near == {("a", 3): "x", ("a", 4): "y", ("b", 1): None}
    back = {(r.k, r["at"]): r.carried for r in sequence.carried_back(m, "k", "at", "v").collect()}
    assert back == {("a", 0): "x", ("a", 3): "y", ("a", 4): "y", ("a", 8): "y", ("b", 1): None}


def test_section_moves(spark):
    old = spark.createDataFrame([("1", "alpha beta gamma"), ("2", "one two three four"), ("3", "gone"), ("4", None)], "path string, text string")
    new = spark.createDataFrame([("1", "alpha beta delta"), ("2a", "one two three five four"), ("9", "quite new"), ("4", None)], "path string, text string")
    got = {(r.old_path, r.new_path, r.op) for r in compare.section_changes(old, new).collect()}
    assert got == {("1", "1", "changed"), ("4", "4", "same"), ("2", "2a", "moved"), ("3", None, "removed"), (None, "9", "added")}
    assert compare.section_changes(old.limit(0), new.limit(0)).count() == 0


def test_names(spark):
    got = spark.createDataFrame([("Smith, John",), ("John Q. Public Jr.",), ("Ann Lee (D-CA)",)], "n string").select(text.surname(F.col("n")).alias("s"), text.canonical(F.lit("H.R. 12-a")).alias("c"), text.chamber_before(F.lit("the Senate S. 5"), F.lit(11)).alias("h")).collect()
    assert [r.s for r in got] == ["Smith", "Public", "Lee"] and got[0].c == "HR12A" and got[0].h == "Senate"


def test_zip_members(spark):
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        z.writestr("a.txt", b"one")
        with pytest.warns(UserWarning):
            z.writestr("a.txt", b"two")
        z.writestr("big", b"x" * 100)
    broken = bytearray(made.getvalue())
    broken[broken.index(b"one")] ^= 1
    files = spark.createDataFrame([("z", made.getvalue()), ("b", bytes(broken)), ("n", b"no"), ("e", None)], "path string, content binary")
    got = {(r.path, r.ordinal): (r.name, r.content and bytes(r.content), r.refused) for r in readers.zip_members(files, max_bytes=50).collect()}
    assert got[("z", 0)] == ("a.txt", b"one", None) and got[("z", 1)][2] == "repeated_name" and got[("z", 2)][2] == "too_large"
    assert got[("b", 0)] == ("a.txt", None, "damaged") and got[("n", None)][2] == "not_a_zip" and ("e", None) not in got
    assert {r.refused for r in readers.zip_members(files.where("path = 'z'"), max_entries=2).collect()} == {"too_many_entries"}


def test_xml_and_feeds(spark):
    rows = spark.createDataFrame([(1, '<a x="1"><b>t</b><c/><b>u</b></a>'), (2, "<a>"), (3, '<!DOCTYPE a [<!ENTITY e "x">]><a/>'), (4, None)], "id long, xml string")
    got = {(r.id, r.ordinal): (r.path, r.attributes, r.text, r.refused) for r in readers.xml_nodes(rows, "id", "xml").collect()}
    assert got[(1, 0)][:2] == ("/a[1]", '{"x": "1"}') and got[(1, 3)][::2] == ("/a[1]/b[2]", "u")
    assert got[(2, None)][3] == "malformed" and got[(3, None)][3] == "entity_declared" and len(got) == 6
    feed = spark.createDataFrame([(1, "<rss version='2.0'><channel><title>t</title><item><title>A</title><guid>1</guid></item><item><title>B</title></item></channel></rss>")], "id long, xml string")
    assert [(r.ordinal, r.title, r.guid) for r in readers.feed_items(feed, "id", "xml").orderBy("ordinal").collect()] == [(0, "A", "1"), (1, "B", None)]
    page = spark.createDataFrame([(1, "<ListBucketResult><IsTruncated>true</IsTruncated><NextContinuationToken>n</NextContinuationToken><Contents><Key>k</Key><Size>5</Size></Contents></ListBucketResult>")], "id long, xml string")
    r = readers.listed_objects(page, "id", "xml").first()
    assert (r.next_token, r.name, r.size) == ("n", "k", 5)
    site = spark.createDataFrame([(1, "<urlset><url><loc>http://x/</loc></url></urlset>")], "id long, xml string")
    assert readers.sitemap_urls(site, "id", "xml").first().loc == "http://x/"


@pytest.mark.parametrize(("given", "wanted"), [('{"a": 1.5}', "valid"), ('{"a": 1, "a": 2}', "repeated_key"), ("[NaN]", "not_finite"), ("[1e999]", "not_finite"), ("{", "malformed"), ("[" * 70 + "]" * 70, "too_deep"), (None, "absent"), ("[" * 100_000, "too_deep")])
def test_json_status(given, wanted):
    assert readers.json_status(given) == wanted
    assert readers.json_status("[1.0]", floats=False) == "float"


def test_dumps(spark, tmp_path):
    (tmp_path / "q.csv").write_text('"id","v"\n"1","a\\"b\nc"\n"2",\n"3",""\n')
    got = readers.quoted_csv(spark, str(tmp_path / "q.csv"), "id string, v string").orderBy("id").collect()
    assert [r.v for r in got] == ['a"b\nc', None, ""]
    (tmp_path / "p.txt").write_text("a|b\nc\n|\n")
    rows = readers.delimited(spark, str(tmp_path / "p.txt"), ["x", "y"]).collect()
    assert {(r.x, r.y, r.refused) for r in rows} == {("a", "b", None), (None, None, "width"), ("", "", None)}


def test_bytes(spark):
    pdf = b"%PDF-1.7\n1 0 obj <</Linearized 1/L 1234>>\nstartxref\n5\n%%EOF\nstartxref\n99\n%%EOF\n"
    got = spark.createDataFrame([(0, pdf), (1, b"nothing"), (2, b"%PDF-1.4"), (3, None)], "i int, b binary").select("i", readers.pdf_facts(F.col("b")).alias("f")).orderBy("i").collect()
    assert tuple(got[0].f) == ("1.7", 1234, 99, None) and [r.f.refused for r in got[1:]] == ["no_header", "no_trailer", "absent"]
    png = b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + (3).to_bytes(4, "big") + (4).to_bytes(4, "big")
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08\x00\x07\x00\x09\x01"
    assert readers.image_size(png) == ("png", 3, 4) and readers.image_size(jpeg) == ("jpeg", 9, 7)
    assert readers.image_size(b"GIF89a\x02\x00\x05\x00") == ("gif", 2, 5) and readers.image_size(b"") == (None, None, None)
    files = spark.createDataFrame([("a", b"x"), ("b", b"y")], "path string, content binary")
    wanted = files.where("path = 'a'").select("path", F.length("content").alias("size"), F.sha2("content", 256).alias("sha256")).union(spark.createDataFrame([("c", 1, "0")], "path string, size int, sha256 string"))
    assert {(r.path, r.outcome) for r in readers.verified(files, wanted).collect()} == {("a", "verified"), ("b", "unexpected"), ("c", "missing")}


def test_section_moves_by_brute_force(spark):
    import re

    from recordloom.plans import catalog

    sf = "/root/testdata/sf0.01"
    rows = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() if r.text is not None]
    old = {f"s{i}": t for i, t in rows if i % 5}
    new = {("m" if i % 4 == 0 else "") + f"s{i}": t + (" new" if i % 7 == 0 else "") for i, t in rows if i % 6}
    own = lambda t: set(re.findall("[a-z0-9]+", t.lower()))
    gone, fresh = ({p: own(t) for p, t in x.items() if p not in y} for x, y in ((old, new), (new, old)))

    def nearest(s, others):
        scored = [(-len(s & o) / len(s | o), p) for p, o in others.items() if s | o and len(s & o) >= 0.7 * len(s | o)]
        return min(scored)[1] if scored else None

    moves = {(p, q) for p, s in gone.items() if (q := nearest(s, fresh)) and nearest(fresh[q], gone) == p}
    want = {(p, p, "same" if old[p] == new[p] else "changed") for p in old.keys() & new.keys()} | {(p, q, "moved") for p, q in moves}
    want |= {(p, None, "removed") for p in gone.keys() - {p for p, _ in moves}} | {(None, q, "added") for q in fresh.keys() - {q for _, q in moves}}
    assert any(gone[p] != fresh[q] for p, q in moves)  # moved with a changed word
    got = [tuple(r) for r in catalog.queries()["section_moves"](spark, sf).select("old_path", "new_path", "op").collect()]
    assert len(got) == len(want) and set(got) == want
