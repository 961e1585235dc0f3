"""Record keeping on small hand-made inputs."""

from pyspark.sql import functions as F

from recordloom.operators import records


def test_one_by_tiers(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "c", "x"), (4, None, None), (5, "q", "z")], "l long, id string, name string")
    right = spark.createDataFrame([(10, "a", "y"), (11, "c", "z"), (12, "c", "x"), (13, None, "y"), (14, None, "z")], "r long, id string, name string")
    got = {x.l: (x.r, x.tier, x.n) for x in records.one_by_tiers(left, right, "l", "r", [("id", F.col("id"), F.col("id")), ("name", F.col("name"), F.col("name"))]).collect()}
    assert got == {1: (10, "id", 1), 2: (None, "name", 2), 3: (None, "id", 2), 4: (None, None, 0), 5: (None, "name", 2)}


def test_printing_pairs(spark):
    rows = spark.createDataFrame([("k", "introduced", "2024-01-01", 0), ("k", "enrolled", None, 5), ("k", "reported", "2024-02-01", 2), ("k", "again", "2024-02-01", 2), ("k", "lost", None, None), ("j", "only", None, 1)], "key string, name string, day string, rank int")
    got = [(r.name, r.next_name, r.refused) for r in records.printing_pairs(rows, "key", "name", "day", "rank").collect()]
    assert got == [("lost", "introduced", "undated"), ("introduced", "again", None), ("again", "reported", "order_unknown"), ("reported", "enrolled", None)]


def test_journal_and_blobs(spark):
    journal = spark.createDataFrame([("a", 1, "failed"), ("a", 2, "done"), ("b", 1, "done"), ("b", 2, "failed"), ("c", 1, None)], "file string, seq int, outcome string")
    assert {r.file: (r.outcome, r.n_tried, r.due) for r in records.journal_state(journal, "file", "seq", "outcome").collect()} == {"a": ("done", 2, False), "b": ("failed", 2, True), "c": (None, 1, True)}
    blobs = spark.createDataFrame([("x",), ("x",), ("y",), (None,), ("",)], "content string")
    stored = blobs.where("content = 'y'").select(F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("digest"))
    assert sorted(r.content for r in records.new_blobs(blobs, stored, "content").collect()) == ["", "x"]
    assert records.new_blobs(blobs.limit(0), stored, "content").count() == 0


def test_locators(spark):
    rows = spark.createDataFrame([(1, None, ""), (2, "u", "v")], "id long, a string, b string")
    assert [tuple(r) for r in records.locators(rows, "id", ["a", "b"]).orderBy("id", "field").collect()] == [(1, "a", None, "absent"), (1, "b", "", "empty"), (2, "a", "u", "stated"), (2, "b", "v", "stated")]
