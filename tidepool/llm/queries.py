"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import (conversation_queries, curriculum, embeddings, exact_dedup, html_render, packing,
                          sharding, simhash, tokens, toxicity, url_filters)
from tidepool.llm.common import table


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _digit(text, at: int):
    """0..15: the ``at``-th hexadecimal digit (from 1) of a hash."""
    return F.position(F.substring(text, at, 1), F.lit("0123456789abcdef")) - 1


def url_list(pages: DataFrame) -> DataFrame:
    """A dated filter list over the hosts, domains and first path segments that occur in
    ``pages``; whether, when and by whom each is listed follows from its MD5."""
    url = F.coalesce("url", F.lit(""))
    seen = pages.select(url_filters.url_host(url).alias("host"), url_filters.url_path(url).alias("path")) \
        .where("host <> ''")
    domain = F.substring_index("host", ".", -3)
    first = F.regexp_extract("path", r"^/[^/]+/", 0)
    named = seen.select(F.explode(F.array(
        F.struct(F.lit("host").alias("kind"), F.col("host").alias("pattern")),
        F.struct(F.lit("domain").alias("kind"), domain.alias("pattern")),
        F.struct(F.lit("prefix").alias("kind"),
                 F.when(first != "", F.concat("host", first)).alias("pattern")))).alias("p")) \
        .select("p.*").where("pattern IS NOT NULL").distinct()
    h = F.md5(F.concat("kind", F.lit("|"), "pattern"))
    a, b = _digit(h, 2) * 16 + _digit(h, 3), _digit(h, 4) * 16 + _digit(h, 5)
    names = F.when(F.col("kind") == "host", F.lit("adult")).when(F.col("kind") == "domain", F.lit("malware")) \
        .otherwise(F.when(_digit(h, 6) < 4, F.lit("trusted")).otherwise(F.lit("spam")))
    listed = named.where(_digit(h, 1) < 8).select(
        "kind", "pattern", names.alias("list"), a.alias("a"), b.alias("b"))
    event = lambda days, action: F.struct(days.cast("int").alias("days"), F.lit(action).alias("action"))
    return listed.select(
        "list", F.when(F.col("list") == "trusted", F.lit("allow")).otherwise(F.lit("block")).alias("mode"),
        "kind", "pattern", F.explode(F.array(
            event(F.col("a"), "add"), event(F.col("a") + F.col("b") + 30, "remove"),
            event(F.col("a") + F.col("b") + 200, "add"))).alias("e")) \
        .select("list", "mode", "kind", "pattern",
                F.date_add(F.lit("2023-01-01").cast("date"), F.col("e.days")).alias("day"), "e.action")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit("2023-01-01").cast("date"), F.pmod("page_id", F.lit(730)).cast("int"))
    judged = url_filters.filter_urls(pages.withColumn("fetched_on", fetched), url_list(pages), carry=["page_id"])
    return judged.select(F.col("row.page_id").alias("page_id"), "url", "host",
                         F.date_format("fetched_on", "yyyy-MM-dd").alias("fetched_on"),
                         "blocked", "n_matches", "lists")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.simhash_components(docs, carry=["doc_id"], words=3, limit=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = tokens.write_tokens(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, added_tokens=True)
    return tokens.read_tokens(manifest, with_ids=False)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, carry=["doc_id"])
    held = F.coalesce(toxicity.fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted",
                         F.size("passages").alias("n_passages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=2048,
                        with_ids=False, added_tokens=True)


def op7_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return curriculum.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = exact_dedup.exact_dedup(docs, carry=["doc_id"])
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "n_links", "component_id", "kept")


def op10_html_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.render_pages(table(spark, sf_dir, "pages"), carry=["page_id", "url"])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_sharding": op2_sharding,
    "op3_simhash": op3_simhash,
    "op4_token_files": op4_token_files,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_curriculum": op7_curriculum,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_html_render": op10_html_render,
    **conversation_queries.QUERIES,
    "pipeline": pipeline,
}

ORACLE_SQL = {
    "op1_url_filter": r"""
WITH c AS (
  SELECT page_id, url, DATE '2023-01-01' + CAST(page_id % 730 AS INTEGER) AS f,
         regexp_replace(lower(regexp_extract(coalesce(url, ''),
           '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+)(?::[0-9]*)?([^?#]*)', 1)), '\.$', '') AS host,
         regexp_extract(coalesce(url, ''),
           '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+)(?::[0-9]*)?([^?#]*)', 2) AS path
  FROM pages),
n AS (
  SELECT 'host' AS kind, host AS pattern FROM c WHERE host <> ''
  UNION SELECT 'domain', array_to_string(list_slice(string_split(host, '.'), -3, -1), '.') FROM c WHERE host <> ''
  UNION SELECT 'prefix', host || regexp_extract(path, '^/[^/]+/', 0) FROM c
        WHERE host <> '' AND regexp_extract(path, '^/[^/]+/', 0) <> ''),
h AS (SELECT kind, pattern, md5(kind || '|' || pattern) AS h FROM n),
x AS (
  SELECT kind, pattern,
         (strpos('0123456789abcdef', h[2]) - 1) * 16 + strpos('0123456789abcdef', h[3]) - 1 AS a,
         (strpos('0123456789abcdef', h[4]) - 1) * 16 + strpos('0123456789abcdef', h[5]) - 1 AS b,
         CASE kind WHEN 'host' THEN 'adult' WHEN 'domain' THEN 'malware'
              ELSE CASE WHEN strpos('0123456789abcdef', h[6]) - 1 < 4 THEN 'trusted' ELSE 'spam' END END AS list
  FROM h WHERE strpos('0123456789abcdef', h[1]) - 1 < 8),
v AS (
  SELECT list, kind, pattern, DATE '2023-01-01' + CAST(a AS INTEGER) AS s,
         DATE '2023-01-01' + CAST(a + b + 30 AS INTEGER) AS e FROM x
  UNION ALL
  SELECT list, kind, pattern, DATE '2023-01-01' + CAST(a + b + 200 AS INTEGER), DATE '9999-12-31' FROM x),
m AS (
  SELECT c.page_id, v.list FROM c JOIN v ON f >= s AND f < e AND c.host <> '' AND (
    (kind = 'host' AND pattern = host)
    OR (kind = 'domain' AND (pattern = host OR ends_with(host, '.' || pattern)))
    OR (kind = 'prefix' AND starts_with(host || path, pattern)))),
g AS (
  SELECT page_id, count(*) AS n, bool_or(list <> 'trusted') AS bl, bool_or(list = 'trusted') AS al,
         string_agg(DISTINCT list, ',' ORDER BY list) AS lists
  FROM m GROUP BY page_id)
SELECT c.page_id, c.url, nullif(host, '') AS host, strftime(f, '%Y-%m-%d') AS fetched_on,
       coalesce(bl AND NOT al, false) AS blocked, coalesce(n, 0) AS n_matches, coalesce(lists, '') AS lists
FROM c LEFT JOIN g USING (page_id)
""",
    "op7_curriculum": r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS sz,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
l AS (
  SELECT source, sz, w, sz * 2.0::DOUBLE AS cap,
         (sum(sz) OVER () * 1.5::DOUBLE - coalesce(sum(sz * 2.0::DOUBLE) OVER o, 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS lev,
         row_number() OVER (ORDER BY sz * 2.0::DOUBLE / w, source NULLS LAST) AS k
  FROM s WINDOW o AS (ORDER BY sz * 2.0::DOUBLE / w, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, sz, least(cap, coalesce((SELECT arg_min(lev, k) FROM l WHERE lev <= cap / w), 0) * w) AS target
  FROM l),
r AS (
  SELECT d.doc_id, d.size, t.sz, t.target, floor(t.target + 0.5) AS goal,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, CAST(sz AS BIGINT) AS source_size, target,
       CAST(greatest(0, least(size, goal - before)) + greatest(0, least(size, goal - sz - before)) AS BIGINT) AS taken
FROM r
""",
    "op8_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
""",
    **conversation_queries.ORACLE_SQL,
}
