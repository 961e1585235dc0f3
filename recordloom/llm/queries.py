"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from recordloom.llm import chat_format, decontaminate, language_id, license_scan, metric_topk, quality_classifier, secret_scan, simhash_dedup, source_mix, token_counts


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": language_id.query,
        "op2_license_scan": license_scan.query,
        "op3_exact_topk": metric_topk.query,
        "op4_token_counts": token_counts.query,
        "op5_simhash_dedup": simhash_dedup.query,
        "op6_quality_classifier": quality_classifier.query,
        "op7_source_mix": source_mix.query,
        "op8_decontaminate": decontaminate.query,
        "op9_secret_scan": secret_scan.query,
        "op10_chat_format": chat_format.query,
        "pipeline": corpus_pipeline.run,
    }


#: Brute force over all pairs of a query and a vector, exact in integers.
OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


#: Windows of items against all runs of as many words of each document.
OP8 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
),
b AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
),
at_item AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM at_item),
at_doc AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
runs AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM at_doc),
hits AS (SELECT DISTINCT rid, r.n, i, item_id FROM runs r JOIN windows USING (n, g)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""

#: Places follow from the lengths of matches and of what lies between them. DuckDB has no CRC-32, so tokens with a
#: checksum, which no row of the test tables holds, are left out of ``spans``; tests cover them.
OP9 = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS x FROM documents),
p AS (
  SELECT * FROM (VALUES
    (0, 'assign', '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?', '[A-Za-z0-9+/_.=-]+', 6),
    (1, 'access', '', 'AKIA[A-Z0-9]+', 20),
    (2, 'hex', '', '[0-9a-f]+', 24)
  ) AS k(ord, kind, head, body, least)
),
m AS (
  SELECT rid, ord, kind, least, string_split_regex(x, CASE kind WHEN 'hex' THEN '[0-9a-f]{24,}' ELSE head || body END) AS gaps,
         regexp_extract_all(x, CASE kind WHEN 'hex' THEN '[0-9a-f]{24,}' ELSE head || body END) AS whole,
         regexp_extract_all(x, CASE kind WHEN 'hex' THEN '([0-9a-f]{24,})' ELSE head || '(' || body || ')' END, 1) AS part
  FROM t, p
),
e AS (SELECT rid, ord, kind, least, gaps, whole, part, unnest(range(1, len(whole) + 1)) AS i FROM m),
s AS (
  SELECT rid, ord, kind, least, length(part[i]) AS n, length(whole[i]) AS width,
         CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda g: length(g))), 0) AS BIGINT) AS start
  FROM e
),
f AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || (start + width), ',' ORDER BY start, ord) AS spans
  FROM s WHERE n >= least GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN f USING (rid)
"""

#: What is read back is what was told; lengths follow from the template: each backslash and each control string in a text costs one more.
OP10 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
n AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(text, '</s>|<s>|\[/INST\]|\[INST\]')) AS body,
         length(role) + length(role) - length(replace(role, '\', '')) + length(role) - length(replace(role, chr(10), '')) + len(regexp_extract_all(role, '</s>|<s>|\[/INST\]|\[INST\]')) AS named
  FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(CASE WHEN role = 'assistant' THEN 1 + body + 4 ELSE 7 + named + 1 + body + 8 END) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_topk": OP3, "op8_decontaminate": OP8, "op9_secret_scan": OP9, "op10_chat_format": OP10}
