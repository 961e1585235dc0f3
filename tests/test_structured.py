"""JSON, markup and outlines on small hand-made inputs."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.operators import outline, reconcile
from recordloom.sources import structured

VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(), x, max_size=4), max_leaves=12)


@settings(max_examples=150, deadline=None)
@given(VALUES)
def test_json_as_xml_and_back(value):
    text = json.dumps(value)
    back = structured.xml_to_json(structured.json_to_xml(text))
    assert structured.canonical_json(back) == structured.canonical_json(text) and json.loads(back) == value


@settings(max_examples=80, deadline=None)
@given(st.lists(VALUES, max_size=5), st.sampled_from(["", " ", "\n"]))
def test_members(values, space):
    text = space + "[" + space + (space + "," + space).join(json.dumps(v, ensure_ascii=False) for v in values) + space + "]" + space
    got = list(structured.members_of(text))
    assert [json.loads(m) for _, m, *_ in got] == values
    assert all(text[s:e] == m and r is None for _, m, s, e, r in got)


def test_refusals():
    ends = {t: [r for *_, r in structured.members_of(t)][-1:] for t in ("", "{}", "[1", "[1,]", "[1] x", "[1 2]", "[]")}
    assert ends == {"": ["not_an_array"], "{}": ["not_an_array"], "[1": ["malformed"], "[1,]": ["malformed"], "[1] x": ["malformed"], "[1 2]": ["malformed"], "[]": []}
    assert structured.canonical_json('{"b": 1, "a": "é"}') == '{"a":"\\u00e9","b":1}'
    assert [structured.canonical_json(t) for t in ('{"a":1,"a":2}', "NaN", "x", None, "[" * 100_000)] == [None] * 5


def test_rows(spark):
    rows = spark.createDataFrame([(1, '[1, "a"]'), (2, None), (3, "[]"), (4, "x")], "id long, body string")
    got = [(r.id, r.ordinal, r.member, r.refused) for r in structured.json_members(rows, "id", "body").orderBy("id", "ordinal").collect()]
    assert got == [(1, 0, "1", None), (1, 1, '"a"', None), (4, 0, None, "not_an_array")]
    assert structured.with_canonical(rows, "id", "body").count() == 3
    shapes = spark.createDataFrame([('{"a":1}',), ('{"a":1,"x":2}',), ('{"b":1}',), ("[]",), (None,)], "body string")
    assert [r.p for r in shapes.select(structured.shape_problem(F.col("body"), ["a", "b"], ["a"]).alias("p")).collect()] == [None, "unknown_key", "missing_key", "not_an_object", "not_an_object"]


def test_html_events_cover_the_text(spark):
    text = "<p class=x>a &amp; b<br/>\n<!-- c --></p>tail <b"
    got = structured.html_events(spark.createDataFrame([(1, text), (2, ""), (3, None)], "id long, body string"), "id", "body").orderBy("seq").collect()
    assert [(r.kind, r.value) for r in got][:5] == [("start", "p"), ("text", "a "), ("entity", "amp"), ("text", " b"), ("empty", "br")]
    assert "".join(text[r.start : r.end] for r in got) == text


def test_outline(spark):
    text = "§ 1 Scope\n(a)(1) first\n(2) second\n(i) child\n(ii) next\n(A) deep\n(b) later\nplain (c) inside\n(q) stray\n(c)\n"
    assert [(m, p) for _, m, _, p, _ in outline.outline_of(text)] == [("a", "(a)"), ("1", "(a)(1)"), ("2", "(a)(2)"), ("i", "(a)(2)(i)"), ("ii", "(a)(2)(ii)"), ("A", "(a)(2)(ii)(A)"), ("b", "(b)"), ("q", None), ("c", "(c)")]
    letters = "\n".join(f"({c})" for c in "abcdefgh") + "\n(1)\n(i)"
    assert list(outline.outline_of(letters))[-1] == (9, "i", 2, "(h)(1)(i)", True)
    rows = spark.createDataFrame([(1, text), (2, None), (3, "")], "id long, text string")
    assert outline.outline(rows, "id", "text").count() == 9


def test_collected_and_inventory(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "w"), ("b", 1, "x"), ("b", 2, None), ("c", None, None)], "k string, f int, m string")
    got = {r.k: (r.f, r.m, r.refused) for r in reconcile.collected(rows, "k", ["f"], "m").collect()}
    assert got == {"a": (1, "w\u001fx", None), "b": (None, "x", "differs"), "c": (None, "", None)}
    assert {r.k: (r.l, r.r) for r in reconcile.inventory("k", l=rows, r=rows.where("k = 'a'").limit(1)).collect()} == {"a": (2, 1), "b": (2, 0), "c": (1, 0)}
