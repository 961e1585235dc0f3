"""The registered queries over the driver's tables, each with its SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.functions import keys, text, values
from recordloom.operators import diff, link, quality, select
from recordloom.plans import checks, tables, texts  # noqa: F401  register their queries
from recordloom.plans.registry import QUERIES, SQL, registered


def seconds(ts: str = "ts"):
    return F.unix_seconds(F.col(ts).cast("timestamp"))


@registered("""
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1""")
def latest_event_per_user(t):
    return select.newest(t("events"), ["user_id"], [F.col("ts")], [F.col("event_id")]).select("user_id", "event_id", "event_type")


@registered("""
SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_rows, count(DISTINCT props) AS n_contents
FROM events GROUP BY ALL HAVING count(DISTINCT props) > 1""")
def event_version_ties(t):
    return select.version_ties(t("events").withColumn("day", F.to_date("ts")), ["user_id", "day"], F.col("props"))


@registered("""
WITH k AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS n FROM events)
SELECT event_type, count(*) AS n_total, CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_selected,
       CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_discarded
FROM k GROUP BY 1""")
def discarded_observations(t):
    chosen = select.newest(t("events"), ["user_id", "event_type"], [F.col("ts")], [F.col("event_id")]).groupBy("event_type").agg(F.count("*").alias("n_selected"))
    every = t("events").groupBy("event_type").agg(F.count("*").alias("n_total"))
    return every.join(chosen, "event_type").select("event_type", "n_total", "n_selected", (F.col("n_total") - F.col("n_selected")).alias("n_discarded"))


@registered("""
WITH e AS (SELECT *, max(ts) OVER (PARTITION BY user_id) AS top FROM events)
SELECT user_id, event_id FROM e WHERE ts >= top - INTERVAL 3 DAY
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY sha256(CAST(event_id AS VARCHAR))) = 1""")
def volatile_tie_margin(t):
    near = select.near_newest(t("events"), ["user_id"], F.col("ts"), F.sha2(F.col("event_id").cast("string"), 256), 3 * 86_400)
    return near.select("user_id", "event_id")


@registered("""
WITH w AS (
  SELECT o_orderkey, o_totalprice, o_orderdate, 0 AS walk FROM orders WHERE o_orderkey % 3 <> 0
  UNION ALL SELECT o_orderkey, o_totalprice + 1, o_orderdate, 1 FROM orders WHERE o_orderkey % 3 <> 1)
SELECT o_orderkey, round(o_totalprice, 2) AS price FROM w
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, walk DESC) = 1""")
def pooled_union_newest(t):
    o = t("orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    walks = [o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 3 <> 1").withColumn("o_totalprice", F.col("o_totalprice") + 1)]
    return select.pooled(walks, ["o_orderkey"], F.col("o_orderdate")).select("o_orderkey", F.round("o_totalprice", 2).alias("price"))


@registered("""
SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey) = 1""")
def merge_by_precedence(t):
    return select.merged_by_precedence(t("orders"), ["o_custkey"], F.col("o_orderpriority"), F.col("o_orderdate"), F.col("o_orderkey")).select("o_custkey", "o_orderkey", "o_orderpriority")


@registered("""
WITH f AS (SELECT l_orderkey, l_suppkey, first_value(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS fv FROM lineitem)
SELECT l_orderkey, fv AS first_value, count(*) AS n_rows, CAST(sum(CASE WHEN l_suppkey <> fv THEN 1 ELSE 0 END) AS BIGINT) AS n_restated FROM f GROUP BY 1, 2""")
def fold_first_with_restatements(t):
    return select.first_with_restatements(t("lineitem"), ["l_orderkey"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")], "l_suppkey")


@registered("""
SELECT CAST(('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 2)) AS INTEGER) % 64 AS bucket, count(*) AS n FROM orders GROUP BY 1""")
def hash_bucket_counts(t):
    return t("orders").groupBy(keys.bucket(F.col("o_orderkey").cast("string")).alias("bucket")).agg(F.count("*").alias("n"))


@registered("SELECT text_digest, count(*) AS n FROM (SELECT 'sha256:' || sha256(text) AS text_digest FROM documents) GROUP BY 1 HAVING count(*) > 1")
def dedup_digest_documents(t):
    return t("documents").groupBy(keys.digest(F.col("text")).alias("text_digest")).agg(F.count("*").alias("n")).where("n > 1")


@registered("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def unique_key_check(t):
    return t("events").groupBy("user_id", "event_type").agg(F.count("*").alias("n")).where("n > 1")


@registered("""
SELECT CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN length(text) < 100 THEN 'too_short' WHEN lang <> 'en' THEN 'other_language' ELSE 'admitted' END AS outcome,
       count(*) AS n FROM documents GROUP BY 1""")
def admit_refuse_counts(t):
    rules = [("empty", F.col("text").isNull() | (F.col("text") == "")), ("too_short", F.length("text") < 100), ("other_language", F.col("lang") != "en")]
    return quality.with_reason(t("documents"), rules).groupBy(F.coalesce("reason", F.lit("admitted")).alias("outcome")).agg(F.count("*").alias("n"))


@registered("SELECT o_orderkey FROM orders o WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_mktsegment <> 'BUILDING')")
def orphan_references(t):
    return quality.orphans(t("orders"), ["o_custkey"], t("customer").where("c_mktsegment <> 'BUILDING'"), ["c_custkey"]).select("o_orderkey")


@registered("""
WITH d AS (SELECT * FROM (VALUES ('click'), ('view'), ('purchase'), ('refund')) AS v(value)),
     o AS (SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1)
SELECT value, CASE WHEN d.value IS NULL THEN 'undocumented' WHEN o.n IS NULL THEN 'unobserved' ELSE 'both' END AS state, coalesce(o.n, 0) AS n
FROM d FULL JOIN o USING (value)""")
def domain_drift(t):
    e = t("events")
    known = e.sparkSession.createDataFrame([(x,) for x in ("click", "view", "purchase", "refund")], "value string")
    return quality.domain_drift(known, e.select(F.col("event_type").alias("value")))


@registered("""
SELECT 'o_orderstatus' AS "column", count(*) AS n_rows, count(*) - count(o_orderstatus) AS n_null, count(DISTINCT o_orderstatus) AS n_distinct FROM orders
UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority), count(DISTINCT o_orderpriority) FROM orders
UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey), count(DISTINCT o_custkey) FROM orders""")
def column_profile(t):
    return quality.profile(t("orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"])


_OLD = "o_orderkey % 7 <> 0"
_NEW = "o_orderkey % 5 <> 0"
_SNAPSHOTS = f"""
WITH a AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE {_OLD}),
     b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE {_NEW})"""


def _snapshots(t):
    o = t("orders").select("o_orderkey", "o_orderstatus")
    return o.where(_OLD), o.where(_NEW).withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 11 == 0, "X").otherwise(F.col("o_orderstatus")))


@registered(_SNAPSHOTS + """
SELECT CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'missing'
            WHEN a.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus THEN 'matched' ELSE 'changed' END AS state, count(*) AS n
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey GROUP BY 1""")
def snapshot_diff_orders(t):
    return diff.compared(*_snapshots(t), ["o_orderkey"], ["o_orderstatus"]).groupBy("state").agg(F.count("*").alias("n"))


@registered(_SNAPSHOTS + """
SELECT b.o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'added' ELSE 'status_changed' END AS event_type,
       a.o_orderstatus AS from_value, b.o_orderstatus AS to_value
FROM b LEFT JOIN a ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus""")
def change_events(t):
    return diff.events(*_snapshots(t), ["o_orderkey"], "o_orderstatus")


@registered("""
WITH k AS (SELECT DISTINCT o_custkey AS k FROM orders), n AS (SELECT k, lead(k) OVER (ORDER BY k) AS nx FROM k)
SELECT k + 1 AS gap_start, nx - 1 AS gap_end FROM n WHERE nx > k + 1""")
def contiguity_gaps(t):
    return quality.gaps(t("orders"), "o_custkey")


@registered("""
WITH k AS (SELECT DISTINCT o_orderkey AS k FROM orders), n AS (SELECT k, lead(k) OVER (ORDER BY k) AS nx FROM k)
SELECT k + 1 AS gap_start, nx - 1 AS gap_end FROM n WHERE nx > k + 1""")
def order_key_gaps(t):
    return quality.gaps(t("orders"), "o_orderkey")


@registered("""
WITH s AS (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS lines FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN lines IS NULL THEN 'not_compared' WHEN lines = CAST(o_totalprice AS DECIMAL(28,2)) THEN 'equal' ELSE 'differs' END AS outcome
FROM orders LEFT JOIN s ON o_orderkey = l_orderkey""")
def totals_reconcile(t):
    s = t("lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("lines"))
    outcome = F.when(F.col("lines").isNull(), "not_compared").when(F.col("lines") == F.col("o_totalprice").cast("decimal(28,2)"), "equal").otherwise("differs")
    return t("orders").join(s, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", outcome.alias("outcome"))


@registered("SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99, count(*) AS n FROM lineitem GROUP BY 1")
def p99_by_group(t):
    return t("lineitem").groupBy("l_returnflag").agg(F.round(F.percentile("l_extendedprice", 0.99), 4).alias("p99"), F.count("*").alias("n"))


@registered("""
WITH a AS (SELECT c_custkey, o_orderdate, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')
SELECT c_custkey, o_orderkey, CAST(n AS INTEGER) AS n FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM a) WHERE n <= 3""")
def top_orders_per_customer(t):
    w = Window.partitionBy("c_custkey").orderBy(F.col("o_orderdate").desc(), "o_orderkey")
    a = t("orders").join(t("customer").where("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey"))
    return a.withColumn("n", F.row_number().over(w)).where("n <= 3").select("c_custkey", "o_orderkey", "n")


@registered("""
WITH p AS (SELECT p_partkey AS id, p_brand, p_type, p_size FROM part),
a AS (SELECT x.id AS l_id, y.id AS r_id, 'brand_type_size' AS tier FROM p x JOIN p y USING (p_brand, p_type, p_size) WHERE x.id <> y.id),
b AS (SELECT x.id AS l_id, y.id AS r_id, 'brand_type' AS tier FROM p x JOIN p y USING (p_brand, p_type) WHERE x.id <> y.id AND x.id NOT IN (SELECT l_id FROM a)),
c AS (SELECT x.id AS l_id, y.id AS r_id, 'type_size' AS tier FROM p x JOIN p y USING (p_type, p_size) WHERE x.id <> y.id AND x.id NOT IN (SELECT l_id FROM a UNION SELECT l_id FROM b))
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""")
def tier_cascade_link(t):
    p = t("part")
    key = lambda *c: F.concat_ws("@", *(F.col(x).cast("string") for x in c))
    of = [("brand_type_size", "p_brand", "p_type", "p_size"), ("brand_type", "p_brand", "p_type"), ("type_size", "p_type", "p_size")]
    return link.best_tier(p.withColumnRenamed("p_partkey", "l_id"), p.withColumnRenamed("p_partkey", "r_id"), "l_id", "r_id", [(n, key(*c), key(*c)) for n, *c in of], others=True)


@registered("""
SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(GROUPING(o_orderstatus) * 2 + GROUPING(o_orderpriority) AS BIGINT) AS level
FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
def rollup_orders(t):
    return t("orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


@registered("""
SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def cube_lines(t):
    return t("lineitem").cube("l_returnflag", "l_linestatus").agg(F.sum(F.round("l_quantity").cast("long")).alias("quantity"))


@registered("""
SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand, p_size), (p_type), ())""")
def grouping_sets_parts(t):
    p = t("part")
    return p.groupingSets([["p_brand", "p_size"], ["p_type"], []], "p_brand", "p_type", "p_size").agg(F.count("*").alias("n")).select("p_brand", "p_type", "p_size", "n")


@registered("""SELECT user_id AS id FROM events WHERE event_type = 'purchase' INTERSECT SELECT user_id FROM events WHERE event_type = 'click'""")
def users_of_both(t):
    of = lambda kind: t("events").where(F.col("event_type") == kind).select(F.col("user_id").alias("id"))
    return of("purchase").intersect(of("click"))


@registered("""SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'""")
def customers_of_one(t):
    of = lambda status: t("orders").where(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("id"))
    return of("F").subtract(of("O"))


@registered("""
SELECT a.event_id AS l_id, b.event_id AS r_id FROM events a JOIN events b ON a.user_id = b.user_id
WHERE a.event_type = 'purchase' AND b.event_type = 'click' AND abs(CAST(floor(epoch(a.ts)) AS BIGINT) - CAST(floor(epoch(b.ts)) AS BIGINT)) <= 86400""")
def date_window_link(t):
    e = t("events").select(F.col("event_id").alias("id"), "user_id", "event_type", seconds().alias("at"))
    return link.within(e.where("event_type = 'purchase'"), e.where("event_type = 'click'"), "user_id", "at", 86_400)


@registered("""
WITH l AS (SELECT event_id, user_id, epoch_us(ts) AS at FROM events WHERE event_type = 'purchase'),
     r AS (SELECT user_id, epoch_us(ts) AS at, max(event_id) AS rid FROM events WHERE event_type = 'click' GROUP BY ALL)
SELECT l.event_id, arg_max(r.rid, r.at) AS last_click FROM l LEFT JOIN r ON r.user_id = l.user_id AND r.at < l.at GROUP BY 1""")
def nearest_before(t):
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    e = t("events").where("event_type in ('purchase', 'click')").withColumn("at", at)
    e = e.groupBy("user_id", "at", "event_type", F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("own")).agg(F.max("event_id").alias("event_id"))
    return link.last_before(e, "user_id", F.col("at"), F.col("event_type") == "purchase", F.col("event_type") == "click", F.col("event_id")).select("event_id", F.col("last_right").alias("last_click"))


@registered("""
SELECT * FROM (SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_value FROM orders) WHERE next_value IS NOT NULL""")
def consecutive_pairs(t):
    return link.consecutive(t("orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")], "o_orderkey").select("o_custkey", "o_orderkey", "next_value")


@registered("""
WITH e AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events),
     f AS (SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY user_id ORDER BY sec) > 172800 THEN 1 ELSE 0 END AS nw FROM e),
     g AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY user_id ORDER BY sec RANGE UNBOUNDED PRECEDING) AS BIGINT) AS n_island FROM f)
SELECT user_id, n_island, min(sec) AS start_s, max(sec) AS end_s, count(*) AS n FROM g GROUP BY 1, 2""")
def interval_islands(t):
    return link.islands(t("events"), "user_id", seconds(), 172_800)


@registered("""
SELECT CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '1%' THEN 'urgent_done' WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'P' THEN 'part' ELSE 'open' END AS stage,
       count(*) AS n FROM orders GROUP BY 1""")
def stage_classifier(t):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    rules = [("urgent_done", (status == "F") & priority.startswith("1")), ("done", status == "F"), ("part", status == "P"), ("open", F.lit(True))]
    return quality.with_reason(t("orders"), rules, "stage").groupBy("stage").agg(F.count("*").alias("n"))


@registered("SELECT lang, CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 5000 THEN 'medium' ELSE 'long' END AS size_class, count(*) AS n FROM documents GROUP BY 1, 2")
def size_class(t):
    c = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 5000, "medium").otherwise("long")
    return t("documents").groupBy("lang", c.alias("size_class")).agg(F.count("*").alias("n"))


@registered()
def html_text(t):
    return t("pages").select("page_id", text.visible_text(F.col("html")).alias("text"))


@registered("""
SELECT page_id, len(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1)) AS n_links,
       array_to_string(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1), chr(31)) AS links FROM pages""".replace("\\\\", "\\"))
def html_links(t):
    found = text.links(F.col("html"))
    return t("pages").select("page_id", F.size(found).cast("long").alias("n_links"), F.array_join(found, "\x1f").alias("links"))


@registered("SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, count(*) AS n FROM pages GROUP BY 1")
def url_hosts(t):
    return t("pages").groupBy(F.regexp_extract(values.normalized_url(F.col("url")), r"^[a-z]+://([^/?#]*)", 1).alias("host")).agg(F.count("*").alias("n"))


@registered("SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_props(t):
    return t("events").groupBy("event_type", F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("n"))


@registered(r"SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS n_redacted, regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '[email]', 'g') AS text FROM documents WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')")
def redact_emails(t):
    new, n = text.redacted(F.col("text"), r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[email]")
    return t("documents").select("doc_id", n.cast("long").alias("n_redacted"), new.alias("text")).where("n_redacted > 0")


@registered("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def part_slugs(t):
    return t("part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"))


@registered("""
WITH d AS (SELECT item_id, list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS tokens FROM benchmark)
SELECT item_id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM d""")
def benchmark_tokens(t):
    own = text.tokens(F.col("text"))
    return t("benchmark").select("item_id", F.size(own).cast("long").alias("n_tokens"), F.array_join(own, " ").alias("tokens"))


@registered("""
WITH b AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM benchmark),
x AS (SELECT a.item_id AS q_id, b.item_id AS r_id, len(list_intersect(a.t, b.t)) / CAST(len(list_distinct(list_concat(a.t, b.t))) AS DOUBLE) AS score FROM b a JOIN b ON len(a.t) + len(b.t) > 0)
SELECT q_id, r_id, round(score, 9) AS score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, r_id) AS rank FROM x WHERE score >= 0.3) WHERE rank <= 5""")
def identify_best_candidate(t):
    b = t("benchmark").select(F.col("item_id").alias("id"), text.tokens(F.col("text")).alias("tokens"))
    return link.best_by_tokens(b, b, k=5, least=0.3).select("q_id", "r_id", F.round("score", 9).alias("score"), "rank")


@registered("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2")
def label_quality_matrix(t):
    return t("labels").groupBy("quality", "toxic").agg(F.count("*").alias("n"))


@registered("""
SELECT conv_id, count(*) AS n_turns, CAST(max(turn) - min(turn) + 1 - count(DISTINCT turn) AS BIGINT) AS n_missing FROM conversations GROUP BY 1""")
def conversation_turns(t):
    return t("conversations").groupBy("conv_id").agg(F.count("*").alias("n_turns"), (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("n_missing"))


@registered("""
WITH p AS (SELECT user_id AS walk, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS page, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM events),
     c AS (SELECT walk, page, CASE WHEN event_id % 17 = 0 THEN event_id + 1 ELSE event_id END AS cur, nxt FROM p)
SELECT walk, CAST(page AS BIGINT) AS page FROM (SELECT *, lag(nxt) OVER (PARTITION BY walk ORDER BY page) AS expected FROM c) WHERE page > 0 AND cur IS DISTINCT FROM expected""")
def page_chain_breaks(t):
    w = Window.partitionBy("user_id").orderBy("event_id")
    p = t("events").select(F.col("user_id").alias("walk"), (F.row_number().over(w) - 1).cast("long").alias("page"), F.when(F.col("event_id") % 17 == 0, F.col("event_id") + 1).otherwise(F.col("event_id")).alias("cursor"), F.lead("event_id").over(w).alias("next_cursor"))
    return quality.page_chain_breaks(p)


@registered("""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(t):
    rows = t("lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
