"""Operators on small hand-made tables."""

import pytest
from pyspark.sql import functions as F

from recordloom.functions import keys, text, values
from recordloom.operators import diff, link, quality, select
from recordloom.sources import publish
from recordloom.streaming import ingest


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("given", "wanted"), [("1,234.56", "1234.56"), ("$19.96", "19.96"), (".00", "0.00"), ("-12,161,280.90", "-12161280.90"), ("(1,234.56)", "-1234.56"), ("-$204,348.74", "-204348.74"), ("--5.00", None), ("1500", None), ("", None)])
def test_amount(spark, given, wanted):
    got = one(spark, values.amount(F.lit(given)))
    assert (None if got is None else str(got)) == wanted


def test_dates_urls_keys(spark):
    status = [one(spark, values.date_status(F.lit(d).cast("string"))) for d in (None, "", "2025-02-30", "2025-2-3", "2025-02-03")]
    assert status == ["absent", "empty", "invalid", "invalid", "valid"]
    assert one(spark, values.normalized_url(F.lit("HTTPS://Ex.Org:443/A/?b=1#c"))) == "https://ex.org/A/?b=1"
    assert one(spark, values.query_value(F.lit("http://x/?a=1&b=2&a=3"), "a")) is None
    assert one(spark, keys.joined_key(F.lit("a"), F.lit("b"))) == "a@b"
    assert one(spark, keys.joined_key(F.lit("a"), F.lit(None).cast("string"))) is None
    assert one(spark, text.visible_text(F.lit("<p>a&lt;b</p><script>x</script> <b>c</b>"))) == "a<b c"


def test_selection_ties_and_nulls(spark):
    rows = spark.createDataFrame([(0, "a", 1), (1, "a", 2), (2, "a", 2), (3, "b", None), (4, "b", None)], "o int, id string, v int")
    got = select.newest(rows, ["id"], [F.col("v")], [F.col("o")]).orderBy("id").collect()
    assert [(r.id, r.o) for r in got] == [("a", 1), ("b", 3)]
    assert select.version_ties(rows, ["id", "v"], F.col("o")).where("v = 2").count() == 1


def test_diff_gaps_reasons(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string"), spark.createDataFrame([(2, None), (3, "z")], "k int, v string")
    assert {(r.k, r.state) for r in diff.compared(a, b, ["k"], ["v"]).collect()} == {(1, "missing"), (2, "matched"), (3, "added")}
    g = quality.gaps(spark.createDataFrame([(1,), (2,), (5,), (2_000_005,)], "k long"), "k").collect()
    assert sorted(map(tuple, g)) == [(3, 4), (6, 2_000_004)]
    r = quality.with_reason(a, [("no_value", F.col("v").isNull())])
    assert {x.reason for x in r.collect()} == {None, "no_value"}


def test_within_and_empty(spark):
    a = spark.createDataFrame([(1, "u", 0), (2, "u", 100)], "id long, k string, at long")
    assert sorted(map(tuple, link.within(a, a, "k", "at", 99).collect())) == [(1, 1), (2, 2)]
    assert len(link.within(a, a, "k", "at", 100).collect()) == 4
    assert link.within(a.limit(0), a, "k", "at", 5).count() == 0


def test_publish_once(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
    path = str(tmp_path / "t")
    publish.publish(rows, path, ["id"], buckets=8, files=4)
    assert publish.verify(spark, path, ["id"]).where("n_rows <> n_keys").count() == 0
    assert publish.lookup(spark, path, "id", "42", buckets=8).first().v == 42
    with pytest.raises(Exception, match="(?i)exist"):
        publish.publish(rows, path, ["id"])
    with pytest.raises(ValueError, match="identity"):
        publish.publish(rows.union(rows), str(tmp_path / "u"), ["id"])


def test_stream_reads_each_file_once(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    spark.range(5).write.parquet(src)
    for _ in range(2):
        ingest.append_once(ingest.read_new_files(spark, src, spark.range(1).schema), out, check, ["id"]).awaitTermination()
    assert spark.read.parquet(out).count() == 5


def test_gaps_of_whole_order_keys(spark, tmp_path):
    from recordloom.plans import catalog

    keys = [k for k in range(1, 400) if k not in (17, 18, 56, 200, 201, 202)] + [3, 3, None]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    got = sorted(tuple(r) for r in catalog.queries()["order_key_gaps"](spark, str(tmp_path)).select("gap_start", "gap_end").collect())
    assert got == [(17, 18), (56, 56), (200, 202)]
