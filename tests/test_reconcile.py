"""Agreement, section lists and identifiers on small hand-made inputs."""

import random

import pytest
from pyspark.sql import functions as F

from recordloom.functions import identifiers as ids
from recordloom.operators import coordinates, reconcile


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("5 U.S.C. 552, 553(a)(1) and 555", [("552", None, None, None), ("553", None, "(a)(1)", None), ("555", None, None, None)]),
        ("40 CFR parts 60 through 63, and 75", [("60", "63", None, None), ("75", None, None, None)]),
        ("42 USC 300aa-1 note; 7 CFR 2.1", [("300aa-1", None, None, "note"), ("2.1", None, None, None)]),
        ("16 U.S.C. §§ 1531 et seq., 1540", [("1531", None, None, "et_seq"), ("1540", None, None, None)]),
        ("5 U.S.C. 552, 40 CFR 60", [("552", None, None, None), ("60", None, None, None)]),
        ("5 U.S.C. 552 and 30 days later", [("552", None, None, None)]),
        ("40 CFR 63-60", [("63", "60", None, None)]),
        ("title 5", []), ("", []), (None, []),
    ],
)
def test_section_lists(given, wanted):
    got = coordinates.coordinates_of(given)
    assert [(c.section, c.last, c.pinpoint, c.note) for c in got] == wanted
    assert all(a.end <= b.start for a, b in zip(got, got[1:]))


def test_section_refusals(spark):
    assert [c.refused for c in coordinates.coordinates_of("53 USC 1, 99 CFR 2, 40 CFR 63-60, 5 USC 1")] == ["no_such_title", "no_such_title", "backwards", None]
    rows = spark.createDataFrame([("a", "see 5 USC 1, 2"), ("b", None), ("c", "")], "id string, text string")
    assert [(r.id, r.section) for r in coordinates.coordinates(rows, "id", "text").orderBy("start").collect()] == [("a", "1"), ("a", "2")]
    assert coordinates.coordinates(rows.limit(0), "id", "text").count() == 0


def test_edit_distance():
    assert [coordinates.edit_distance(a, b) for a, b in (("", "abc"), ("abcd", "acbd"), ("ca", "abc"), ("same", "same"))] == [3, 1, 2, 0]
    rng = random.Random(1)
    for _ in range(50):
        a, b = ("".join(rng.choices("ab", k=rng.randint(0, 6))) for _ in range(2))
        assert coordinates.edit_distance(a, b) == coordinates.edit_distance(b, a) <= max(len(a), len(b))


def test_names(spark):
    names = spark.createDataFrame([("energy",), ("energy and commerce committee",), ("ways and means",), ("rules",), ("armed",), (None,), ("rules",), ("judiciary",)], "name string")
    known = spark.createDataFrame([("energy", "E"), ("energy and commerce", "EC"), ("ways and means", "W1"), ("ways and means", "W2"), ("rules of the house", "R"), ("armed services", "A1"), ("armed forces", "A2"), (None, "x")], "known string, code string")
    got = {r.name: (r.code, r.rule) for r in reconcile.named(names, known).collect()}
    assert got == {"energy": ("E", "equal"), "energy and commerce committee": ("EC", "extends"), "ways and means": (None, "ambiguous"), "rules": ("R", "begins"), "armed": (None, "ambiguous"), "judiciary": (None, "unmatched")}


def test_first_field_match(spark):
    rows = spark.createDataFrame([(1, "about b-2", "b-1"), (2, None, "b-2 and b-1"), (3, "b-9", None), (4, "", "")], "id long, title string, body string")
    catalog = spark.createDataFrame([("b-1", 0), ("b-2", 1)], "value string, position int")
    got = [tuple(r) for r in reconcile.first_field_match(rows, "id", ["title", "body"], r"b-\d", catalog).orderBy("id").collect()]
    assert got == [(1, "b-2", "title"), (2, "b-1", "body")]


def test_newest_refuses_ties(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", 1, "x"), ("b", 1, "z"), ("c", None, "n"), ("d", None, "o"), ("d", 0, None)], "k string, v int, f string")
    got = {r.k: (r.v, r.f, r.n_readings) for r in reconcile.newest_or_refused(rows, ["k"], "v", ["f"]).collect()}
    assert got == {"a": (2, "y", 1), "b": (1, None, 2), "c": (None, "n", 1), "d": (0, None, 1)}


def test_walks(spark):
    rows = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "a"), (2, 1, "c"), (2, 2, "d"), (3, 0, "a"), (3, 1, "c"), (3, 2, "d"), (7, 0, "a")], "w long, p long, f string")
    assert {r.walk: r.n_differ for r in reconcile.repeated_walks(rows, "w", "p", ["f"]).collect()} == {2: 2, 3: 0}


def test_identifiers(spark):
    def of(fn, *values):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r.x for r in rows.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]

    assert of(ids.rin, "RIN: 2060–av16", "2060-AV16", "2060AV16", None) == ["2060-AV16", "2060-AV16", None, None]
    assert of(ids.unpadded, "2024-00123", "E9-0", "x", None) == ["2024-123", "E9-0", None, None]
    assert of(ids.docket, "Docket ID No. epa-hq-oar-2021-0317", "Docket No. FAA-2020-0001", "FAA-2020") == [None, "FAA-2020-0001", None]
    assert of(lambda c: ids.urn("ex", "rin", c), "2060-AV16", "a:b", "", None) == ["urn:ex:rin:2060-AV16", None, None, None]
    assert of(ids.ordinal_congress, "the 117TH Congress", "117 Congress", None) == [117, None, None]
    assert [str(x) if x else x for x in of(ids.local_day, "2024-03-01T02:00:00Z", "2024-03-01", "2024-03-01T00:00:00Z", "x", None)] == ["2024-02-29", "2024-03-01", "2024-03-01", None, None]
    assert [x is not None for x in of(ids.instant, "2024-03-01T02:00:00Z", "2024-13-01T02:00:00Z", "2024-03-01 02:00:00", None)] == [True, False, False, False]
    assert of(ids.bare_media_type, "Text/HTML; charset=x", "nonsense", None) == ["text/html", None, None]
    assert of(lambda c: ids.pointer(c, F.lit("x")), "a/b~c", "") == ["/a~1b~0c/x", "//x"]
    assert of(ids.plain_glyphs, "‘a’ ''b'' “c” d\r\ne\rf") == ["'a' \"b\" \"c\" d\ne\nf"]
    assert of(lambda c: ids.rejoined(c)[0], "regu-\n  lation Co-\nOp", None) == ["regulation Co-\nOp", None]
    assert of(lambda c: ids.byte_prefix(c, 4), "abcdef", "aé日", "日本", "\U0001f642x", "", None) == ["abcd", "aé", "日", "\U0001f642", "", None]
    assert of(lambda c: ids.comparison_jaccard(c, F.lit("a, B")), "A b.", "a", "") == [1.0, 0.5, 0.0]
    assert of(lambda c: ids.comparison_jaccard(c, F.lit("!")), "", "a") == [1.0, 0.0]


def test_halved_windows_hold_every_row(spark):
    rows = [(d,) for d in (5, 5, 5, 6, 40, 41, 99, 100, None, None)]
    days = spark.createDataFrame(rows, "day int")
    got = [tuple(r) for r in reconcile.halved_windows(days, "day", 2).collect()]
    assert sum(n for _, _, n, _ in got) == len(rows)
    assert (None, None, 2, False) in got and (5, 5, 3, True) in got
    spans = sorted(w[:2] for w in got if w[0] is not None)
    assert spans[0][0] == 5 and spans[-1][1] == 100 and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
    assert all(n == sum(d is not None and lo <= d <= hi for (d,) in rows) and (n <= 2 or (over and lo == hi)) for lo, hi, n, over in got if lo is not None)
    nothing = days.where("day is null")
    assert [tuple(r) for r in reconcile.halved_windows(nothing, "day", 1).collect()] == [(None, None, 2, True)]
    assert reconcile.halved_windows(days.limit(0), "day", 2).count() == 0
