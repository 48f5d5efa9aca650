"""One query per corpus operator over its whole table, with SQL where DuckDB can express the rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoner.llm.chat import rotate_perspectives
from almoner.llm.content_sort import exact_groups
from almoner.llm.fill_middle import fill_in_middle, restore_text
from almoner.llm.fingerprints import fingerprint_edits
from almoner.llm.mixing import mix_sources
from almoner.llm.near_dups import near_duplicates
from almoner.llm.pieces import encode_documents
from almoner.llm.resampling import resample_to_target
from almoner.llm.secrets import scan_secrets
from almoner.llm.token_files import new_folder, read_token_files, write_token_files
from almoner.llm.toxicity import score_toxicity
from almoner.llm.url_lists import filter_urls, host_of, url_key
from almoner.llm.warc import archive_pages
from almoner.session import scratch_folder

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register fn(spark, sf_dir) under `name`."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op8_mix_sources",
    """
WITH RECURSIVE rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
    md5('mix:' || CAST(doc_id AS VARCHAR)) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM rows GROUP BY source),
fill(round, capped) AS (
  SELECT 0, []
  UNION ALL
  SELECT round + 1, (
    SELECT list(s.source) FROM sources s,
      (SELECT sum(source_size) FILTER (WHERE NOT list_contains(capped, source)) AS open_size,
        sum(weight) FILTER (WHERE NOT list_contains(capped, source)) AS open_weight,
        sum(source_size) AS total, coalesce(sum(source_size) FILTER (WHERE list_contains(capped, source)), 0) AS full_size
       FROM sources) t
    WHERE list_contains(capped, s.source)
      OR (total - 3 * full_size) / open_weight * s.weight > 3 * s.source_size)
  FROM fill WHERE round < 40),
last AS (SELECT coalesce(capped, []) AS capped FROM fill ORDER BY round DESC LIMIT 1),
facts AS (
  SELECT (total - 3 * full_size) / open_weight AS share, capped FROM last,
    LATERAL (SELECT sum(source_size) AS total, coalesce(sum(source_size) FILTER (WHERE list_contains(capped, source)), 0) AS full_size,
      sum(weight) FILTER (WHERE NOT list_contains(capped, source)) AS open_weight FROM sources)),
targets AS (
  SELECT source, source_size,
    CASE WHEN list_contains(capped, source) THEN 3.0 * source_size ELSE share * weight END AS target
  FROM sources, facts),
budgets AS (SELECT *, CAST(floor(target) AS BIGINT) AS budget FROM targets),
ordered AS (
  SELECT r.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows r)
SELECT o.doc_id, CAST(o.size AS BIGINT) AS size, b.source_size, round(b.target, 6) AS target,
  CAST((b.budget // greatest(b.source_size, 1)) * o.size
    + greatest(0, least(o.size, b.budget % greatest(b.source_size, 1) - o.before)) AS BIGINT) AS taken
FROM ordered o JOIN budgets b ON b.source IS NOT DISTINCT FROM o.source
""",
)
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query("op2_encode_pieces")
def op2_encode_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), PIECE_MODEL, with_ids=False)


@query(
    "op5_exact_groups",
    """
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER best AS kept, text_sha256
FROM rows WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
""",
)
def op5_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query("op3_near_duplicates")
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


@query("op7_scan_secrets")
def op7_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return scan_secrets(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op9_score_toxicity")
def op9_score_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_toxicity(docs, labels)
    places = F.transform("sentences", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string")))
    return scored.withColumn("sentences", F.array_join(places, ","))


@query("op4_fingerprint_edits")
def op4_fingerprint_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return read_token_files(write_token_files(docs, new_folder(docs), public_tokenizers.path("byte_bpe_50k.json")))


@query(
    "op1_rotate_perspectives",
    """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, turn // 256 AS block, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker,
    replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) AS said
  FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
parts AS (
  SELECT t.*, perspective,
    '<|' || CASE WHEN speaker = 'system' THEN speaker WHEN speaker = perspective THEN 'assistant'
      ELSE 'user name=' || speaker END || '|>' || chr(10) AS head
  FROM turns t JOIN people p ON p.conv_id = t.conv_id),
ends AS (
  SELECT *, sum(length(head) + length(said)) OVER (PARTITION BY conv_id, perspective, block
    ORDER BY turn, speaker, said ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
  FROM parts)
SELECT conv_id, perspective, block, count(*) AS n_turns,
  string_agg(head || said, '' ORDER BY turn, speaker, said) AS text,
  coalesce(string_agg(CASE WHEN speaker = perspective THEN
    CAST(until - length(said) AS VARCHAR) || ':' || CAST(until - 1 AS VARCHAR) END, ',' ORDER BY turn, speaker, said), '') AS mask
FROM ends GROUP BY conv_id, perspective, block
""",
)
def op1_rotate_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = rotate_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    return rotated.withColumn("mask", F.array_join(spans, ","))


def dated_lists(pages: DataFrame) -> DataFrame:
    """Stand-in lists, since the tables hold none: their entries and days follow from hashes of the pages' names.

    A list of domains adds about half of them, takes them off after 60 days and adds them again after 120; a
    list of allowed hosts and a list of single URLs only grow.
    """
    start = F.lit("2024-01-01").cast("date")
    digit = lambda c, k: F.conv(F.substring(F.md5(c), k, 2), 16, 10).cast("int")
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    domain = F.regexp_replace("host", r"^(www|m|blog)\.", "")
    domains = hosts.select(domain.alias("value")).distinct().where(digit(F.col("value"), 1) < 128)
    changes = F.explode(
        F.array(*[F.struct(F.lit(d).alias("after"), F.lit(a).alias("action")) for d, a in ((0, "add"), (60, "remove"), (120, "add"))])
    )
    rows = domains.withColumn("c", changes).select(
        F.lit("spam").alias("list"),
        F.lit("block").alias("verdict"),
        F.lit("domain").alias("kind"),
        "value",
        F.date_add(start, digit(F.col("value"), 3) + F.col("c.after")).alias("day"),
        F.col("c.action").alias("action"),
    )

    def growing(values: DataFrame, name: str, verdict: str, kind: str) -> DataFrame:
        return values.select(
            F.lit(name).alias("list"),
            F.lit(verdict).alias("verdict"),
            F.lit(kind).alias("kind"),
            "value",
            F.date_add(start, digit(F.col("value"), 3)).alias("day"),
            F.lit("add").alias("action"),
        )

    trusted = hosts.select(F.col("host").alias("value")).where(digit(F.col("value"), 1) >= 192)
    urls = pages.select(url_key(F.col("url")).alias("value")).where("value <> ''").distinct().where(digit(F.col("value"), 1) < 16)
    return rows.union(growing(trusted, "trusted", "allow", "host")).union(growing(urls, "manual", "block", "url"))


@query(
    "op10_filter_urls",
    """
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS day,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#:@]*([^#]*)', 1) AS path
  FROM pages),
keyed AS (SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END AS key FROM captures),
domains AS (SELECT DISTINCT regexp_replace(host, '^(www|m|blog)\\.', '') AS value FROM keyed),
dated AS (
  SELECT value, md5(value) AS h, 'domain' AS kind FROM domains
  UNION ALL SELECT host, md5(host), 'host' FROM (SELECT DISTINCT host FROM keyed)
  UNION ALL SELECT key, md5(key), 'url' FROM (SELECT DISTINCT key FROM keyed)),
first AS (
  SELECT value, kind, CAST('0x' || substr(h, 1, 2) AS INTEGER) AS pick,
    DATE '2024-01-01' + CAST('0x' || substr(h, 3, 2) AS INTEGER) AS day
  FROM dated),
spans AS (
  SELECT 'spam' AS list, 'block' AS verdict, kind, value, day AS valid_from, day + 60 AS valid_to, length(value) AS rank
  FROM first WHERE kind = 'domain' AND pick < 128
  UNION ALL SELECT 'spam', 'block', kind, value, day + 120, NULL, length(value) FROM first WHERE kind = 'domain' AND pick < 128
  UNION ALL SELECT 'trusted', 'allow', kind, value, day, NULL, 254 FROM first WHERE kind = 'host' AND pick >= 192
  UNION ALL SELECT 'manual', 'block', kind, value, day, NULL, 255 FROM first WHERE kind = 'url' AND pick < 16),
hits AS (
  SELECT k.page_id, s.*, row_number() OVER (PARTITION BY k.page_id ORDER BY rank DESC, verdict DESC, list) AS place
  FROM keyed k JOIN spans s ON k.day >= s.valid_from AND (s.valid_to IS NULL OR k.day < s.valid_to)
    AND ((kind = 'url' AND s.value = k.key) OR (kind = 'host' AND s.value = k.host)
      OR (kind = 'domain' AND (s.value = k.host OR ends_with(k.host, '.' || s.value)))))
SELECT k.page_id, k.url, k.day, coalesce(h.verdict, 'none') AS verdict, list, kind, h.value, valid_from, valid_to
FROM keyed k LEFT JOIN hits h ON h.page_id = k.page_id AND place = 1
""",
)
def op10_filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int"))
    return filter_urls(pages.select("page_id", "url", day.alias("day")), dated_lists(pages))


@query("op11_resample_target")
def op11_resample_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample_to_target(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op12_fill_middle",
    """
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS a,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM lines),
parts AS (
  SELECT *, array_to_string(list_slice(units, 1, least(a, b)), '') AS prefix,
    array_to_string(list_slice(units, least(a, b) + 1, greatest(a, b)), '') AS middle,
    array_to_string(list_slice(units, greatest(a, b) + 1, n), '') AS suffix
  FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
""",
)
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = restore_text(fill_in_middle(table(spark, sf_dir, "documents")))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256")
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query(
    "op13_salvage_warc",
    """
WITH payloads AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads),
kinds AS (SELECT *, payload_bytes >= 100 AND page_id IS DISTINCT FROM first AS again FROM firsts)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to
FROM kinds
""",
)
def op13_salvage_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"), scratch_folder(spark))
