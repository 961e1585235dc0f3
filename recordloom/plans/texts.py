"""Registered queries of findings, sequences and comparisons."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from recordloom.functions import text, values
from recordloom.operators import compare, extract, link, sequence
from recordloom.plans.registry import registered
from recordloom.sources import publish

_EMAIL, _PHONE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", r"\b\d{3}-\d{3}-\d{4}\b|\b\d{3}-\d{4}\b"


@registered(f"""
SELECT doc_id, 'email' AS kind, unnest(regexp_extract_all(text, '{_EMAIL}')) AS value FROM documents
UNION ALL SELECT doc_id, 'phone', unnest(regexp_extract_all(text, '{_PHONE}')) FROM documents""")
def pii_findings(t):
    rules = (extract.Rule("email", _EMAIL, lambda m: m[0]), extract.Rule("phone", _PHONE, lambda m: m[0]))
    return extract.findings(t("documents"), "doc_id", "text", rules).select("doc_id", "kind", "value")


@registered(r"SELECT doc_id, v AS value, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+')) AS v FROM documents) GROUP BY 1, 2")
def digit_runs(t):
    return t("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0))).alias("value")).groupBy("doc_id", "value").agg(F.count("*").alias("n"))


@registered()
def document_citations(t):
    return extract.findings(t("documents"), "doc_id", "text").groupBy("kind", "refused").agg(F.count("*").alias("n"))


@registered()
def interval_sweep(t):
    span = t("orders").select("o_custkey", F.unix_date(F.to_date("o_orderdate")).alias("begin"), (F.unix_date(F.to_date("o_orderdate")) + 30 + F.col("o_orderkey") % 90).cast("int").alias("stop"), "o_orderkey")
    return extract.non_overlapping(span, "o_custkey", "begin", "stop", ["o_orderkey"])


@registered()
def sentence_split(t):
    return sequence.sentences(t("conversations"), "text").select("conv_id", "turn", "n_sentence", "sentence")


@registered("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
     b AS (SELECT doc_id, CAST(sum(CASE WHEN length(line) <= 40 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS block FROM l)
SELECT doc_id, block, count(*) AS n_lines FROM b GROUP BY 1, 2""")
def heading_blocks(t):
    rows = sequence.lines(t("documents").select("doc_id", "text"), "text").drop("text")
    return sequence.blocks(rows, "doc_id", "n_line", F.length("line") <= 40).groupBy("doc_id", "block").agg(F.count("*").alias("n_lines"))


@registered("""
WITH p AS (SELECT event_id, user_id, epoch_us(ts) AS at FROM events WHERE event_type <> 'purchase'),
     i AS (SELECT user_id, epoch_us(ts) AS a, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS b, event_id FROM events WHERE event_type = 'purchase' QUALIFY b > a)
SELECT p.event_id, CAST(i.event_id AS VARCHAR) AS name FROM p LEFT JOIN i ON p.user_id = i.user_id AND p.at >= i.a AND p.at < i.b""")
def scope_of_event(t):
    e = t("events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    w = Window.partitionBy("user_id").orderBy("at")
    scopes = e.where("event_type = 'purchase'").select("user_id", F.col("at").alias("begin"), F.lead("at").over(w).alias("end"), F.col("event_id").alias("name")).where("end > begin")
    return sequence.containing(e.where("event_type <> 'purchase'").select("user_id", "at", "event_id"), scopes, "user_id").select("event_id", "name")


@registered("""
WITH m AS (SELECT event_id, user_id, epoch_us(ts) AS at FROM events WHERE event_type <> 'purchase'),
     a AS (SELECT user_id, epoch_us(ts) AS at, min(event_id) AS v FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT event_id, v AS nearest FROM m LEFT JOIN a ON a.user_id = m.user_id
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY abs(a.at - m.at), a.at DESC) = 1""")
def nearest_mention(t):
    e = t("events").select("event_id", "user_id", (F.col("event_type") == "purchase").alias("anchor"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    first = e.withColumn("v", F.when(F.col("anchor"), F.min(F.when(F.col("anchor"), F.col("event_id"))).over(Window.partitionBy("user_id", "at"))))
    return sequence.nearest_mention(first, "user_id", "at", F.col("anchor"), F.col("v")).select("event_id", "nearest")


@registered("""
WITH q AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS v, o_orderdate FROM orders)
SELECT o_orderkey, (array_agg(v ORDER BY o_orderdate, o_orderkey) FILTER (v IS NOT NULL) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))[1] AS carried FROM q""")
def qualifier_carried_back(t):
    rows = t("orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("v"), F.struct("o_orderdate", "o_orderkey").alias("at"))
    return sequence.carried_back(rows, "o_custkey", "at", "v").select("o_orderkey", "carried")


@registered("""
SELECT user_id, CASE WHEN bool_or(event_type = 'purchase' AND value > 100) THEN 'bought' ELSE arg_max(event_type, (ts, event_id)) END AS stage FROM events GROUP BY 1""")
def reached_stage(t):
    e = t("events").withColumn("stage", F.when((F.col("event_type") == "purchase") & (F.col("value") > 100), "bought").otherwise(F.col("event_type")))
    return sequence.reached_stage(e, "user_id", "stage", ["ts", "event_id"], ["bought"])


@registered("""
SELECT o_orderkey, (CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 WHEN 'F' THEN 2 END) / 2.0::DOUBLE AS progress FROM orders""")
def stage_progress(t):
    return t("orders").select("o_orderkey", sequence.progress(F.col("o_orderstatus"), ["O", "P", "F"]).alias("progress"))


@registered("""
SELECT o_custkey, arg_min(o_orderpriority, CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 END) AS o_orderpriority
FROM orders WHERE o_orderpriority IN ('3-MEDIUM', '1-URGENT') GROUP BY 1""")
def preferred_option(t):
    return sequence.preferred(t("orders"), "o_custkey", "o_orderpriority", ["3-MEDIUM", "1-URGENT"])


@registered("""
WITH d AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM benchmark),
     a AS (SELECT item_id, t, count(*) AS n FROM (SELECT item_id, unnest(w) AS t FROM d) GROUP BY 1, 2),
     b AS (SELECT item_id + 1 AS item_id, t, count(*) AS n FROM (SELECT item_id, unnest(w) AS t FROM d) GROUP BY 1, 2)
SELECT item_id, CAST(sum(least(coalesce(a.n, 0), coalesce(b.n, 0))) AS BIGINT) AS n_shared, CAST(sum(coalesce(a.n, 0)) AS BIGINT) AS n_found, CAST(sum(coalesce(b.n, 0)) AS BIGINT) AS n_wanted
FROM a FULL JOIN b USING (item_id, t) GROUP BY 1""")
def tokens_precision_recall(t):
    b = t("benchmark")
    return compare.precision_recall(b, b.withColumn("item_id", F.col("item_id") + 1), "item_id", "text")


_SECTIONS = """
WITH o AS (SELECT 's' || item_id AS path, text FROM benchmark WHERE item_id % 5 <> 0 AND text IS NOT NULL),
     n AS (SELECT 's' || item_id AS path, CASE WHEN item_id % 7 = 0 THEN text || ' new' ELSE text END AS text FROM benchmark WHERE item_id % 6 <> 0 AND text IS NOT NULL)"""


@registered(_SECTIONS + """
SELECT CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed' WHEN o.text = n.text THEN 'same' ELSE 'changed' END AS op, count(*) AS n
FROM o FULL JOIN n USING (path) GROUP BY 1""")
def section_changes(t):
    b = t("benchmark").where("text is not null").withColumn("path", F.concat(F.lit("s"), F.col("item_id").cast("string")))
    new = b.where("item_id % 6 <> 0").withColumn("text", F.when(F.col("item_id") % 7 == 0, F.concat("text", F.lit(" new"))).otherwise(F.col("text")))
    return compare.section_changes(b.where("item_id % 5 <> 0").select("path", "text"), new.select("path", "text"), moved=1.0).groupBy("op").agg(F.count("*").alias("n"))


@registered()
def section_moves(t):
    b = t("benchmark").where("text is not null").withColumn("path", F.concat(F.lit("s"), F.col("item_id").cast("string")))
    path = F.when(F.col("item_id") % 4 == 0, F.concat(F.lit("m"), "path")).otherwise(F.col("path")).alias("path")
    new = b.where("item_id % 6 <> 0").select(path, F.when(F.col("item_id") % 7 == 0, F.concat("text", F.lit(" new"))).otherwise(F.col("text")).alias("text"))
    return compare.section_changes(b.where("item_id % 5 <> 0").select("path", "text"), new)


@registered("""
WITH a AS (SELECT p_brand AS area, unnest(list_distinct(regexp_extract_all(lower(p_type), '[a-z0-9]+'))) AS t FROM (SELECT p_brand, min(p_type) AS p_type FROM part GROUP BY 1)),
     s AS (SELECT p_partkey AS id, unnest(list_distinct(regexp_extract_all(lower(p_name || ' ' || p_type), '[a-z0-9]+'))) AS t FROM part),
     x AS (SELECT area, id, count(*) AS n_shared FROM a JOIN s USING (t) GROUP BY 1, 2)
SELECT area, id, n_shared, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY n_shared DESC, id) AS rank FROM x) WHERE rank <= 5""")
def keyword_topk(t):
    p = t("part")
    areas = p.groupBy(F.col("p_brand").alias("area")).agg(F.min("p_type").alias("p_type")).select("area", text.tokens(F.col("p_type")).alias("tokens"))
    return compare.top_by_keywords(areas, p.select(F.col("p_partkey").alias("id"), text.tokens(F.concat_ws(" ", "p_name", "p_type")).alias("tokens")), 5)


@registered("""
WITH s AS (SELECT DISTINCT p_brand, p_type, p_size FROM part)
SELECT p_brand, p_type, CASE WHEN count(*) = 1 THEN min(p_size) END AS p_size, count(*) AS n FROM s WHERE p_brand IS NOT NULL AND p_type IS NOT NULL AND p_size IS NOT NULL GROUP BY 1, 2""")
def unique_index(t):
    return compare.unique_index(t("part").where("p_size is not null"), ["p_brand", "p_type"], "p_size")


@registered("""
WITH f AS (SELECT user_id, event_type, props, first_value(props) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS fv FROM events)
SELECT user_id, event_type, fv AS props, CAST(sum(CASE WHEN props IS DISTINCT FROM fv THEN 1 ELSE 0 END) AS BIGINT) AS n_conflicts FROM f GROUP BY 1, 2, 3""")
def first_reference_conflicts(t):
    return compare.first_reference(t("events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")], "props")


@registered("""
WITH k AS (SELECT l_orderkey, count(DISTINCT l_suppkey) AS s, count(DISTINCT l_returnflag) AS a, count(DISTINCT l_linestatus) AS b FROM lineitem GROUP BY 1 HAVING s > 1)
SELECT 'l_returnflag' AS field, count(*) AS n_keys, CAST(sum(CASE WHEN a > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_differ FROM k
UNION ALL SELECT 'l_linestatus', count(*), CAST(sum(CASE WHEN b > 1 THEN 1 ELSE 0 END) AS BIGINT) FROM k""")
def group_disagreements(t):
    return compare.disagreements(t("lineitem"), "l_orderkey", "l_suppkey", ["l_returnflag", "l_linestatus"])


@registered("""
WITH b AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM benchmark),
x AS (SELECT a.item_id AS q_id, b.item_id AS r_id, len(list_intersect(a.t, b.t)) / CAST(len(list_distinct(list_concat(a.t, b.t))) AS DOUBLE) AS score FROM b a JOIN b ON a.item_id < b.item_id AND len(a.t) + len(b.t) > 0)
SELECT q_id, r_id, round(score, 9) AS score FROM x WHERE score >= 0.5""")
def token_jaccard_pairs(t):
    b = t("benchmark").select(F.col("item_id").alias("id"), text.tokens(F.col("text")).alias("tokens"))
    return link.pairs_by_tokens(b, b, least=0.5).where("q_id < r_id").select("q_id", "r_id", F.round("score", 9).alias("score"))


@registered("""
SELECT url, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM (SELECT DISTINCT url FROM pages)""")
def url_parts(t):
    part = lambda pattern: F.regexp_extract("url", pattern, 1)
    return t("pages").select("url").distinct().select("url", part("^([a-z]+)://").alias("scheme"), part("^[a-z]+://([^/?#]*)").alias("host"), part("^[a-z]+://[^/?#]*([^?#]*)").alias("path"))


@registered("""
WITH o AS (SELECT o_orderkey, o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders)
SELECT o_orderkey FROM o WHERE o_orderdate <= before""")
def partition_order_check(t):
    return publish.order_violations(t("orders").withColumn("position", F.col("o_orderkey")), "o_custkey", "o_orderdate").select("o_orderkey")


@registered("""
WITH d AS (SELECT DISTINCT c_nationkey, c_mktsegment, c_name FROM customer ORDER BY ALL LIMIT 200)
SELECT c_nationkey, c_mktsegment, min(c_name) AS c_name FROM d GROUP BY 1, 2""")
def recurrence_limit_then_dedup(t):
    columns = ["c_nationkey", "c_mktsegment", "c_name"]
    top = t("customer").select(*columns).distinct().orderBy(*(F.col(c).asc_nulls_last() for c in columns)).limit(200)
    return top.groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_name").alias("c_name"))


@registered("SELECT c_custkey FROM customer EXCEPT ALL SELECT o_custkey FROM orders")
def set_difference(t):
    return t("customer").select("c_custkey").exceptAll(t("orders").select(F.col("o_custkey").alias("c_custkey")))


@registered("""
SELECT p_partkey, CASE WHEN p_retailprice >= 1500 THEN 'high' WHEN p_retailprice >= 1000 THEN 'medium' ELSE 'low' END AS band FROM part""")
def confidence_band(t):
    return t("part").select("p_partkey", values.banded(F.col("p_retailprice"), [(1500, "high"), (1000, "medium")], "low").alias("band"))


@registered("""
SELECT upper(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')) AS canonical, count(*) AS n FROM part GROUP BY 1""")
def canonical_names(t):
    return t("part").groupBy(text.canonical(F.col("p_name")).alias("canonical")).agg(F.count("*").alias("n"))
