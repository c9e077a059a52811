"""Registered queries of the conversation operators (11 to 13) and their SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import chat_windows, prefix_trie, structure_repair
from tidepool.llm.common import table
from tidepool.llm.turn_order import conversation_key

#: A conversation that says the template's own control strings.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(CONTROL_TEXT).alias("text"))
    return chat_windows.digest(chat_windows.chat_windows(talks.unionByName(extra)))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.prefix_trie(*prefix_trie.share_openings(prefix_trie.order_turns(talks)))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    plans, _ = structure_repair.repair(structure_repair.damage(talks))
    named = talks.select("conv_id").distinct().withColumn("_key", conversation_key("conv_id"))
    none = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return named.join(plans.drop("conv_id"), "_key", "left").select("conv_id", *[
        F.coalesce(c, none.get(c, F.lit(0).cast("bigint"))).alias(c)
        for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")])


QUERIES = {"op11_chat_format": op11_chat_format, "op12_prefix_trie": op12_prefix_trie,
           "op13_structure_repair": op13_structure_repair}

ORACLE_SQL = {
    "op11_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
r AS (
  SELECT *, md5(length(role) || ':' || role || text) AS h,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 2 AS cost,
         14 + length(role) + (length(role) - length(replace(role, '\', '')))
            + (length(role) - length(replace(role, ':' || chr(10), ':')))
            + coalesce(list_sum(list_transform(regexp_extract_all(role, '###+'), lambda x: length(x) - 2)), 0)
            + len(regexp_extract_all(role, '</turn>'))
            + length(text) + (length(text) - length(replace(text, '\', '')))
            + coalesce(list_sum(list_transform(regexp_extract_all(text, '###+'), lambda x: length(x) - 2)), 0)
            + len(regexp_extract_all(text, '</turn>')) AS chars
  FROM c),
p AS (SELECT *, row_number() OVER o AS pos, sum(cost) OVER o - cost AS a FROM r
      WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, a // 512 AS cell, sum(cost) OVER k AS span, min(a) OVER k AS lo, max(a) OVER k AS hi FROM p
      WINDOW k AS (PARTITION BY conv_id, a // 512)),
t AS (SELECT *, cell * 2 + CASE WHEN span > 1024 AND a = hi AND a > lo THEN 1 ELSE 0 END AS w,
             a = 0 AND role = 'system' AND cost <= 1024 AS kept FROM s),
w AS (SELECT conv_id, w, min(a) AS start, greatest(least(512, 1024 - sum(cost)), 0) AS room FROM t GROUP BY ALL),
m AS (
  SELECT conv_id, chars FROM t
  UNION ALL
  SELECT t.conv_id, t.chars FROM t JOIN w ON t.conv_id IS NOT DISTINCT FROM w.conv_id
  WHERE CASE WHEN t.kept THEN w.start > 0
        ELSE t.cost <= 512 AND t.a + t.cost <= w.start AND w.start - t.a <= w.room END),
f AS (SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM m GROUP BY conv_id),
v AS (SELECT conv_id, count(*) AS n_windows FROM w GROUP BY conv_id),
d AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '') AS loss
  FROM p GROUP BY conv_id)
SELECT d.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars, n_windows
FROM d JOIN f ON d.conv_id IS NOT DISTINCT FROM f.conv_id JOIN v ON d.conv_id IS NOT DISTINCT FROM v.conv_id
""",
    "op12_prefix_trie": r"""
WITH o AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM o),
h AS (
  SELECT conv_id, conv_id - ((conv_id % 20) + 20) % 20 AS head, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(1, length(s) + 1), lambda k: ascii(s[k])::BIGINT)),
    lambda acc, b: list_reduce(list_concat([xor(acc, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT)))) % 4 AS h
  FROM i),
r AS (
  SELECT h.conv_id AS c, 0 AS part, o.pos, t, w FROM h JOIN o ON o.conv_id = h.head AND o.pos <= h.h
  UNION ALL
  SELECT h.conv_id, 1, o.pos, t, w FROM h JOIN o ON o.conv_id = h.conv_id AND o.pos > h.h),
p AS (
  SELECT c, row_number() OVER q AS d, w, string_agg(t, ',') OVER q AS p FROM r
  WINDOW q AS (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
m AS (SELECT c, d, p, w FROM p UNION ALL SELECT conv_id, 0, '', 0 FROM i),
x AS (SELECT *, lag(p) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS last FROM m),
n AS (SELECT d, p, any_value(up) AS up, any_value(w) AS w, count(*) AS n, min(c) AS c,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends FROM x GROUP BY d, p),
k AS (SELECT d - 1 AS d, up AS p, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL),
z AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN k USING (d, p)),
s AS (SELECT DISTINCT a.d, a.p, b.d AS bd, b.p AS bp FROM m a JOIN m b ON a.c = b.c AND b.d >= a.d),
g AS (SELECT s.d, s.p, count(*) FILTER (z.kids = 0) AS leaves, sum((z.n - 1) * z.w) AS saved
      FROM s JOIN z ON z.d = s.bd AND z.p = s.bp GROUP BY s.d, s.p)
SELECT z.c AS conv_id, z.d AS depth, u.c AS parent_conv_id, z.n AS n_convs, z.kids AS n_children,
       g.leaves AS n_leaves, CAST(g.saved AS BIGINT) AS saved_tokens, z.ends AS ends_sha256
FROM z JOIN g ON g.d = z.d AND g.p = z.p LEFT JOIN n u ON u.d = z.d - 1 AND u.p = z.up
""",
}
