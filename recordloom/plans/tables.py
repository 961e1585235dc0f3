"""Registered queries of shaped tables, contracts and statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import requests, statements
from recordloom.operators import quality, tables
from recordloom.plans.registry import registered
from recordloom.plans.shapes import CONTRACTS, SHAPES


def _lines(t):
    """Order lines as actions of bills: nested records as a publisher gives them."""
    item = F.col("l_linenumber")
    return t("lineitem").select(
        F.struct(F.lit(118).alias("congress"), F.lower("l_returnflag").alias("bill_type"), F.col("l_orderkey").alias("number")).alias("identity"),
        (item - 1).alias("action_index"), (item == 1).alias("is_latest"),
        F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("action_date"), F.col("l_linestatus").alias("text"), F.sequence(F.lit(1), item).alias("recorded_votes")).alias("action"),
        F.struct(F.lit("shipped").alias("stage")).alias("stage"),
    )


@registered("""
SELECT '118-' || lower(l_returnflag) || '-' || l_orderkey AS bill_id, CAST(l_linenumber - 1 AS VARCHAR) AS action_index, strftime(l_shipdate, '%Y-%m-%d') AS action_date,
       CAST(NULL AS VARCHAR) AS action_time, l_linestatus AS action_text, CAST(NULL AS VARCHAR) AS action_code, CAST(NULL AS VARCHAR) AS action_type,
       CAST(NULL AS VARCHAR) AS source_system_code, CAST(NULL AS VARCHAR) AS source_system_name, CAST(l_linenumber AS VARCHAR) AS recorded_vote_count,
       CASE WHEN l_linenumber = 1 THEN 'true' ELSE 'false' END AS is_latest_action, 'shipped' AS stage, CAST(NULL AS VARCHAR) AS stage_rule, CAST(NULL AS VARCHAR) AS stage_matcher
FROM lineitem""")
def shaped_actions(t):
    return tables.shaped(_lines(t), SHAPES["bill_actions"])


@registered("""
WITH k AS (SELECT lower(l_returnflag) AS f, l_orderkey AS o, l_linenumber - 1 AS i, count(*) AS n FROM lineitem GROUP BY 1, 2, 3)
SELECT CASE WHEN n > 1 THEN 'repeated_identity' END AS refused, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY 1""")
def contract_refusals(t):
    own = CONTRACTS["bill_actions"]
    return own.checked(tables.shaped(_lines(t), SHAPES["bill_actions"])).groupBy("refused").agg(F.count("*").alias("n"))


@registered("""
SELECT 'user_id' AS "column", CAST(user_id AS VARCHAR) AS value, count(*) AS rows FROM events e
WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id) GROUP BY 2""")
def dangling_references(t):
    own = tables.TableContract("events", ("event_id", "user_id"), ("event_id",), references={"user_id": ("customer", "c_custkey")})
    return own.dangling(t("events").select(F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("user_id")), {"customer": t("customer").select(F.col("c_custkey").cast("string").alias("c_custkey"))})


@registered("""
SELECT event_type, lower(trim(event_type)) IN ('', 'none', 'nan', 'null', 'n/a', 'na', '...', 'nyd', 'tbd') AS nothing, count(*) AS n FROM events GROUP BY 1, 2""")
def placeholders(t):
    return t("events").groupBy("event_type", statements.states_nothing(F.col("event_type")).alias("nothing")).agg(F.count("*").alias("n"))


@registered("""
WITH r AS (SELECT DISTINCT o_orderstatus AS g, o_custkey AS p, o_orderkey AS c FROM orders), k AS (SELECT DISTINCT o_orderstatus AS g, CASE WHEN o_orderpriority LIKE '1%' THEN -1 ELSE o_custkey END AS p, o_orderkey AS c FROM orders),
n AS (SELECT coalesce(r.g, k.g) AS g, count(r.c) FILTER (k.c IS NOT NULL) AS shared, count(r.c) AS n_reference, count(k.c) AS n_candidate FROM r FULL JOIN k ON r.g = k.g AND r.p = k.p AND r.c = k.c GROUP BY 1)
SELECT g, shared, n_reference, n_candidate, shared / n_candidate AS precision, shared / n_reference AS recall, 2 * shared / (n_reference + n_candidate) AS f1 FROM n""")
def hierarchy_agreement(t):
    o = t("orders").select(F.col("o_orderstatus").alias("g"), F.col("o_custkey").alias("parent"), F.col("o_orderkey").alias("child"), "o_orderpriority")
    moved = o.withColumn("parent", F.when(F.col("o_orderpriority").startswith("1"), F.lit(-1)).otherwise(F.col("parent")))
    return quality.tree_agreement(o, moved, ["g"])


@registered("""
SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL) AND c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""")
def unaccounted_customers(t):
    return quality.unaccounted(t("customer").select(F.col("c_custkey").alias("id")), t("orders").select(F.col("o_custkey").alias("id")), t("events").select(F.col("user_id").alias("id")), ["id"])


@registered("""
SELECT o_orderkey, strftime(date_trunc('day', o_orderdate) - INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%SZ') AS start, strftime(date_trunc('day', o_orderdate) + INTERVAL 3 DAY, '%Y-%m-%dT%H:%M:%SZ') AS stop FROM orders""")
def order_windows(t):
    day = F.to_date("o_orderdate")
    return t("orders").select("o_orderkey", requests.day_window(day, F.date_add(day, 2)).alias("w")).select("o_orderkey", "w.start", "w.stop")


@registered("""
SELECT page_id, split_part(split_part(url, '#', 1), '?', 1) || '?page=' || page_id AS asked FROM pages""")
def page_requests(t):
    bare = F.substring_index(F.substring_index("url", "#", 1), "?", 1)
    return t("pages").select("page_id", requests.with_query(F.concat(bare, F.lit("?page=0&page=1#x")), "page", F.col("page_id").cast("string")).alias("asked"))
