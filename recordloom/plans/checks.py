"""Registered queries of agreement between tables, and of identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import identifiers
from recordloom.operators import coordinates, reconcile, records
from recordloom.plans.registry import registered
from recordloom.sources import structured

_DAY = "date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))"


@registered(f"""
WITH w AS (SELECT o_custkey, o_orderkey, {_DAY} AS a, {_DAY} + o_orderkey % 90 - 5 AS b FROM orders),
p AS (SELECT *, max(b) OVER (PARTITION BY o_custkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS due FROM w),
x AS (SELECT o_custkey, CASE WHEN NOT a <= b THEN 'reversed' WHEN a > due THEN 'gap' WHEN a < due THEN 'overlap' END AS problem FROM p)
SELECT o_custkey, problem, count(*) AS n FROM x WHERE problem IS NOT NULL GROUP BY 1, 2""")
def window_problems(t):
    first = F.to_date("o_orderdate")
    w = t("orders").select("o_custkey", first.alias("a"), F.date_add(first, (F.col("o_orderkey") % 90 - 5).cast("int")).alias("b"))
    return reconcile.window_problems(w, "o_custkey", "a", "b").groupBy("o_custkey", "problem").agg(F.count("*").alias("n"))


@registered(f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT {_DAY} AS day, count(*) AS n FROM orders GROUP BY 1),
w AS (
  SELECT min(day) AS lo, max(day) AS hi, sum(n) AS n FROM d WHERE day IS NOT NULL
  UNION ALL
  SELECT s.lo, s.hi, (SELECT coalesce(sum(n), 0) FROM d WHERE day BETWEEN s.lo AND s.hi) FROM (
    SELECT CASE WHEN side = 0 THEN lo ELSE lo + (hi - lo) // 2 + 1 END AS lo, CASE WHEN side = 0 THEN lo + (hi - lo) // 2 ELSE hi END AS hi
    FROM w, (VALUES (0), (1)) AS v(side) WHERE n > 100 AND lo < hi) s)
SELECT lo, hi, CAST(n AS BIGINT) AS n, n > 100 AS over FROM w WHERE lo IS NOT NULL AND NOT (n > 100 AND lo < hi)
UNION ALL SELECT NULL, NULL, n, n > 100 FROM d WHERE day IS NULL""")
def halved_windows(t):
    days = t("orders").select(F.unix_date(F.to_date("o_orderdate")).alias("day"))
    return reconcile.halved_windows(days, "day", 100)


@registered("""
WITH o AS (SELECT c_custkey % 5 AS walk, c_custkey // 5 AS position, c_mktsegment AS a FROM customer)
SELECT coalesce(x.walk, y.walk + 1) AS walk, CAST(sum(CASE WHEN x.a IS DISTINCT FROM y.a THEN 1 ELSE 0 END) AS BIGINT) AS n_differ
FROM (SELECT * FROM o WHERE walk > 0) x FULL JOIN (SELECT * FROM o WHERE walk < 4) y ON x.walk = y.walk + 1 AND x.position = y.position GROUP BY 1""")
def repeated_walks(t):
    rows = t("customer").select((F.col("c_custkey") % 5).alias("walk"), F.floor(F.col("c_custkey") / 5).alias("position"), "c_mktsegment")
    return reconcile.repeated_walks(rows, "walk", "position", ["c_mktsegment"])


@registered("""
WITH v AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(DISTINCT props) AS k, min(props) AS props FROM events GROUP BY 1, 2, 3)
SELECT user_id, event_type, CAST(day AS VARCHAR) AS day, CASE WHEN k = 1 THEN props END AS props, k AS n_readings FROM v QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY day DESC) = 1""")
def newest_or_refused(t):
    rows = t("events").select("user_id", "event_type", F.to_date("ts").cast("string").alias("day"), "props")
    return reconcile.newest_or_refused(rows, ["user_id", "event_type"], "day", ["props"])


@registered("""
WITH u AS (SELECT l_suppkey AS k, 1 AS n FROM lineitem UNION ALL SELECT o_custkey, -1 FROM orders)
SELECT k, CAST(sum(n) AS BIGINT) AS n FROM u GROUP BY 1 HAVING sum(n) <> 0""")
def multiset_differences(t):
    return reconcile.differences(t("lineitem").select(F.col("l_suppkey").alias("k")), t("orders").select(F.col("o_custkey").alias("k")))


@registered("SELECT p_type AS name, CAST(min(p_size) AS VARCHAR) AS code, 'equal' AS rule FROM part WHERE p_type IS NOT NULL GROUP BY 1")
def named_types(t):
    known = t("part").where("p_type is not null").groupBy(F.col("p_type").alias("known")).agg(F.min("p_size").cast("string").alias("code"))
    return reconcile.named(t("part").select(F.col("p_type").alias("name")), known)


@registered("""
SELECT CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 10 THEN 1 ELSE 0 END AS INTEGER) AS term, lpad(CAST((year(o_orderdate) - CASE WHEN month(o_orderdate) < 10 THEN 1 ELSE 0 END) % 100 AS VARCHAR), 2, '0') AS code, count(*) AS n FROM orders GROUP BY 1, 2""")
def order_terms(t):
    day = F.col("o_orderdate")
    return t("orders").groupBy(identifiers.term_year(day).alias("term"), identifiers.term_code(day).alias("code")).agg(F.count("*").alias("n"))


@registered(r"""
SELECT conv_id, turn, trim(regexp_replace(regexp_replace(lower(text), '[!-/:-@\[-^`{-~]', ' ', 'g'), '\s+', ' ', 'g')) AS compared FROM conversations""")
def comparison_texts(t):
    return t("conversations").select("conv_id", "turn", identifiers.comparison_text(F.col("text")).alias("compared"))


@registered("""
SELECT item_id, k.keyword FROM (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS keyword FROM benchmark) k WHERE length(keyword) BETWEEN 3 AND 84 AND keyword NOT IN ('the', 'and')""")
def benchmark_keywords(t):
    return t("benchmark").select("item_id", F.explode(identifiers.keyword_tokens(F.col("text"), ["the", "and"])).alias("keyword"))


@registered("SELECT doc_id, text[:list_max(list_filter(range(0, 513), lambda i: strlen(text[:i]) <= 512))] AS prefix FROM documents")
def byte_prefixes(t):
    return t("documents").select("doc_id", identifiers.byte_prefix(F.col("text"), 512).alias("prefix"))


@registered()
def section_coordinates(t):
    found = coordinates.coordinates(t("documents"), "doc_id", "text").groupBy("kind").agg(F.count("*").alias("n"))
    kinds = t("documents").sparkSession.createDataFrame([("code",), ("regulations",)], "kind string")
    return kinds.join(found, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))


@registered("""
WITH k AS (SELECT c_custkey AS k, 1 AS customers, 0 AS orders, 0 AS suppliers FROM customer UNION ALL SELECT o_custkey, 0, 1, 0 FROM orders UNION ALL SELECT s_suppkey, 0, 0, 1 FROM supplier)
SELECT k, CAST(sum(customers) AS BIGINT) AS customers, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(suppliers) AS BIGINT) AS suppliers FROM k GROUP BY 1""")
def key_inventory(t):
    sides = {"customers": ("customer", "c_custkey"), "orders": ("orders", "o_custkey"), "suppliers": ("supplier", "s_suppkey")}
    return reconcile.inventory("k", **{n: t(table).select(F.col(c).alias("k")) for n, (table, c) in sides.items()})


@registered("""
SELECT p_brand, CASE WHEN count(DISTINCT p_size) = 1 THEN min(p_size) END AS p_size, string_agg(DISTINCT p_type, chr(31) ORDER BY p_type) AS p_type, CASE WHEN count(DISTINCT p_size) > 1 THEN 'differs' END AS refused
FROM part WHERE p_size IS NOT NULL AND p_type IS NOT NULL GROUP BY 1""")
def collected_brands(t):
    return reconcile.collected(t("part").where("p_size is not null and p_type is not null"), "p_brand", ["p_size"], "p_type")


@registered("""
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99 FROM (SELECT l_returnflag, l_extendedprice, unnest(range(CAST(l_quantity AS BIGINT))) FROM lineitem) GROUP BY 1""")
def weighted_p99_by_group(t):
    return t("lineitem").groupBy("l_returnflag").agg(F.round(F.percentile("l_extendedprice", 0.99, F.col("l_quantity").cast("long")), 4).alias("p99"))


@registered("""
SELECT event_type, CASE WHEN list_contains(json_keys(props), 'k') AND len(json_keys(props)) = 1 THEN 'closed' ELSE 'open' END AS shape, count(*) AS n FROM events WHERE props IS NOT NULL GROUP BY 1, 2""")
def closed_props(t):
    shape = F.when(structured.shape_problem(F.col("props"), ["k"], ["k"]).isNull(), "closed").otherwise("open")
    return t("events").where("props is not null").groupBy("event_type", shape.alias("shape")).agg(F.count("*").alias("n"))


@registered()
def page_events(t):
    return structured.html_events(t("pages"), "page_id", "html").groupBy("page_id", "kind").agg(F.count("*").alias("n"))


@registered("""
WITH e AS (SELECT user_id, max(epoch_us(ts)) AS at, max_by(event_type, (epoch_us(ts), event_id)) AS event_type, count(*) AS n_tried FROM events GROUP BY 1)
SELECT user_id, event_type, n_tried, event_type <> 'purchase' AS due FROM e""")
def journal_of_users(t):
    rows = t("events").withColumn("seq", F.struct("ts", "event_id"))
    return records.journal_state(rows, "user_id", "seq", "event_type", done="purchase")


@registered("""
SELECT DISTINCT 'sha256:' || sha256(text) AS digest FROM documents WHERE text IS NOT NULL AND text NOT IN (SELECT text FROM benchmark WHERE text IS NOT NULL)""")
def new_texts(t):
    stored = t("benchmark").select(F.concat(F.lit("sha256:"), F.sha2("text", 256)).alias("digest"))
    return records.new_blobs(t("documents").select("text"), stored, "text").select("digest")


@registered("""
SELECT field, state, count(*) AS n FROM (
  SELECT unnest(['text', 'lang', 'source']) AS field, unnest([CASE WHEN text IS NULL THEN 'absent' WHEN text = '' THEN 'empty' ELSE 'stated' END, CASE WHEN lang IS NULL THEN 'absent' WHEN lang = '' THEN 'empty' ELSE 'stated' END, CASE WHEN source IS NULL THEN 'absent' WHEN source = '' THEN 'empty' ELSE 'stated' END]) AS state FROM documents)
GROUP BY 1, 2""")
def stated_fields(t):
    return records.locators(t("documents"), "doc_id", ["text", "lang", "source"]).groupBy("field", "state").agg(F.count("*").alias("n"))


@registered("""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate, ascii(o_orderstatus) AS rank FROM orders),
n AS (SELECT *, lead(o_orderkey) OVER w AS next_name, lead(o_orderdate) OVER w AS d, lead(rank) OVER w AS r FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, rank, o_orderkey))
SELECT o_custkey, o_orderkey, next_name, CASE WHEN o_orderdate = d AND rank = r THEN 'order_unknown' END AS refused FROM n WHERE next_name IS NOT NULL""")
def order_pairs(t):
    return records.printing_pairs(t("orders").withColumn("rank", F.ascii("o_orderstatus")), "o_custkey", "o_orderkey", "o_orderdate", "rank")
