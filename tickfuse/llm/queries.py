"""The queries of the text operators, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, exact_dedup, language, license_scan, license_sql, line_dedup, mixing, near_dup, quality, suffix_dedup, warc
from .common import read, read_or_empty

LABELS = "doc_id bigint, quality int, toxic int"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "n_items", "item_ids")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read_or_empty(spark, sf_dir, "labels", LABELS)
    return quality.scores(docs, quality.fit(docs, labels))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs)).drop("rejected")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(read(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", line_dedup.host_of(F.col("url")).alias("host"), line_dedup.html_lines(F.col("html")).alias("text"))
    return line_dedup.drop_boilerplate(pages, "page_id", "host", "text", by_text=True)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_warc, op2_decontamination, op3_exact_dedup, op4_mixing, op5_quality, op6_language, op7_suffix_dedup, op8_near_duplicates, op9_line_dedup, op10_license_scan, pipeline)
}

OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f"""

OP3_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM g"""

OP9_SQL = rf"""
WITH t AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
           regexp_replace(regexp_replace(html, '(?is)<(script|style)\b[^>]*>.*?</(script|style)>|<!--.*?-->', chr(10), 'g'), '<[^>]*>', chr(10), 'g') AS text FROM pages),
u AS (SELECT *, md5(trim(regexp_replace(lower(coalesce(text, '')), '[\x20\x09-\x0D]+', ' ', 'g'))) AS same FROM t),
l AS (SELECT page_id, host, same, text, list_transform(string_split(text, chr(10)), lambda s: struct_pack(raw := s, bare := regexp_replace(s, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'))) AS lines FROM u),
h AS (SELECT host, count(*) AS n, count(DISTINCT same) AS texts FROM u GROUP BY host),
e AS (SELECT host, same, unnest(list_distinct(list_transform(lines, lambda s: s.bare))) AS bare FROM l),
c AS (SELECT e.host, bare FROM e JOIN h ON e.host IS NOT DISTINCT FROM h.host WHERE bare <> '' GROUP BY e.host, bare, texts HAVING count(DISTINCT same) >= {line_dedup.PAGES} AND count(DISTINCT same) > {line_dedup.RATIO}::DOUBLE * texts),
b AS (SELECT host, list(bare) AS bad FROM c GROUP BY host),
k AS (SELECT l.*, h.n, list_filter(lines, lambda s: s.bare = '' OR NOT list_contains(coalesce(bad, []), s.bare)) AS kept FROM l JOIN h ON l.host IS NOT DISTINCT FROM h.host LEFT JOIN b ON l.host IS NOT DISTINCT FROM b.host)
SELECT page_id, host, array_to_string(list_transform(kept, lambda s: s.raw), chr(10)) AS text,
       coalesce(len(list_filter(lines, lambda s: s.bare <> '')), 0)::BIGINT AS n_lines,
       coalesce(len(list_filter(lines, lambda s: s.bare <> '')) - len(list_filter(kept, lambda s: s.bare <> '')), 0)::BIGINT AS n_dropped,
       n::BIGINT AS host_pages
FROM k"""

ORACLES = {"op1_warc": OP1_SQL, "op3_exact_dedup": OP3_SQL, "op9_line_dedup": OP9_SQL, "op10_license_scan": license_sql.scan_sql()}
