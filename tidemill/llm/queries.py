"""One query per operator, over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, ann, chat, decontam, langid, lexical, mixing, ngram_join, quality, secrets, toxicity, urlfilter, warc
from .store import new_path, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.revisits(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    warc.write_archives(pages, path := new_path(spark, "warc"))
    read = warc.read_archives(spark, path, payload=False)
    return read.select(warc.urn_key(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.urn_key(F.col("refers_to")).alias("refers_to"), "target_uri", "error")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0, k=20)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in (*secrets.KINDS, "random")]
    return found.select("doc_id", *counts, F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    nodes = written(chat.threads(rows.union(more)), "threads")
    chosen = chat.paths(nodes.withColumn("score", F.lit(1.0)))
    turns = chosen.join(nodes.select("node", "role", "text"), "node")
    chats = chat.formatted(turns).join(nodes.select(F.col("node").alias("leaf"), "conv_id"), "leaf")
    return chat.read_back(written(chats, "chats"), "conv_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.sized(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    mixed = mixing.copied(written(docs.drop("text"), "sized"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


_MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(text, '')) AS digest,
    row_number() OVER (PARTITION BY doc_id, source, coalesce(text, '')) AS place
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM per
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source) AS k,
    sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER ()::BIGINT AS weights
  FROM weighed
), before AS (
  SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
    weights - coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS share
  FROM ordered
), level AS (
  SELECT total - capped AS rest, share FROM before
  WHERE weight * (total - capped)::DOUBLE / share <= 3 * source_size ORDER BY k LIMIT 1
), targets AS (
  SELECT source, source_size,
    least(weight * (SELECT rest FROM level)::DOUBLE / (SELECT share FROM level)::DOUBLE, 3.0 * source_size)::DOUBLE AS target
  FROM weighed
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END::DOUBLE AS rate,
    ('0x' || left(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || digest || ':' || place), 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM rated
"""

#: Fixed rules.
RULES = (
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
)


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judged(pages, RULES, urlfilter.GLOBS).select("page_id", "host", "path", "rule", "verdict")


_URLS_SQL = r"""
WITH split AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), fitted AS (
  SELECT page_id, host, path, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule,
    '.' || host || path AS whole
  FROM split
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(('.' || host), '\.doubleclick\.|\.(adult-|cheap-|casino)[^/]*\.') AND path LIKE '/%' THEN 'block'
  WHEN regexp_matches(whole, '^[^/]*\.(adult-|cheap-|casino)[^/]*\.') THEN 'block'
  WHEN regexp_matches(whole, '/ads/|/adserver/|/tracking/|/wp-login\.php|/cgi-bin/|^[^/]*\.onion/|\.exe$|\.zip$') THEN 'block'
  ELSE 'allow' END AS verdict
FROM fitted
"""

def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.classified(docs, trusted).select("doc_id", "lang", "perplexity", "threshold", "accepted")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learns = langid.in_training(F.col("doc_id"))
    model = langid.trained(docs.where(learns))
    found = langid.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(~learns, F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.aligned(table(spark, sf_dir, "documents"))


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_SEARCH_SQL = f"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents
), sized AS (
  SELECT r, doc_id, len(w)::BIGINT AS n FROM dw WHERE len(w) > 0
), whole AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sized
), tf AS (
  SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM dw) GROUP BY r, t
), weighed AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM tf, whole GROUP BY t, docs
), asked AS (
  SELECT i, item_id, t, count(*)::BIGINT AS times FROM (SELECT i, item_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM benchmark)) GROUP BY i, item_id, t
), scored AS (
  SELECT i, item_id, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN weighed USING (t) JOIN tf USING (t) JOIN sized USING (r), whole GROUP BY i, item_id, r, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

_WARC_SQL = """
WITH hashed AS (
  SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), coded AS (
  SELECT page_id, url, payload_bytes, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1) FOR i IN range(32)
  ], '') AS payload_digest FROM hashed
), kept AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM coded
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to, url AS target_uri, NULL::VARCHAR AS error
FROM kept
"""

_CUT = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_DECONTAMINATION_SQL = f"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id, {_CUT} AS w FROM documents
), iw AS (
  SELECT item_id, {_CUT} AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[k:k + 12], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM iw WHERE len(w) > 0)
), places AS (
  SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS t
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), found AS (
  SELECT r, k, n, item_id FROM places JOIN win USING (n, t)
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM found) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


def _escaped_sql(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for c in chat.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\-{c[1:]}')"
    return out


_CHAT_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum({len(chat.CONTROL[0]) + len(chat.CONTROL[1]) + 2} + length(replace({_escaped_sql('role')}, chr(10), '\\n')) + length({_escaped_sql('text')}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_nearest": op2_nearest,
    "op3_toxicity": op3_toxicity,
    "op4_secrets": op4_secrets,
    "op5_decontamination": op5_decontamination,
    "op6_chat": op6_chat,
    "op7_mixing": op7_mixing,
    "op8_urls": op8_urls,
    "op9_ngram_join": op9_ngram_join,
    "op10_quality": op10_quality,
    "op11_language": op11_language,
    "op12_search": op12_search,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": _WARC_SQL,
    "op5_decontamination": _DECONTAMINATION_SQL,
    "op6_chat": _CHAT_SQL,
    "op7_mixing": _MIXING_SQL,
    "op8_urls": _URLS_SQL,
    "op12_search": _SEARCH_SQL,
}
