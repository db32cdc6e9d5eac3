"""Queries on the string functions around documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefind.functions import text as t
from orefind.sources.documents import links_of
from orefind.sources.html import html_fields


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/stored_docs.parquet")


def summaries(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_no", t.summary(F.col("contents")).alias("summary"), F.coalesce(F.length("contents"), F.lit(0)).alias("n"))


def extensions(spark: SparkSession, d: str) -> DataFrame:
    """Files that a filter of extensions lets through."""
    name = F.coalesce(F.trim("filename"), F.lit(""))
    return _docs(spark, d).filter(t.extension_allowed(name, ["*.html", ".cfm", "txt", "*."])).select("doc_no", t.extension(name).alias("ext"))


def normal_extensions(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/search_indexes.parquet").filter("extensions is not null").select("index_no", t.normal_extension(F.col("extensions")).alias("ext"))


def stamps(spark: SparkSession, d: str) -> DataFrame:
    """Times of change as digits, and identities made of them."""
    uid = t.document_uid(F.col("file_path"), F.col("modified"))
    return _docs(spark, d).filter("file_path is not null and modified is not null").select("doc_no", t.timestamp_text(F.col("modified")).alias("stamp"), t.uid_url(uid).alias("path"))


def urls(spark: SparkSession, d: str) -> DataFrame:
    rows = _docs(spark, d).filter("url ilike 'http%'")
    return rows.select("doc_no", t.host_of(F.col("url")).alias("host"), t.directory_of(F.col("url")).alias("folder"))


def normal_urls(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).filter("url ilike 'http%'").select("doc_no", t.normal_url(F.col("url")).alias("url"))


def highlighted(spark: SparkSession, d: str) -> DataFrame:
    rows = _docs(spark, d).filter("contents is not null")
    return rows.select("doc_no", t.highlighted(F.col("contents"), F.lit("servers")).alias("marked"))


def keyword_lists(spark: SparkSession, d: str) -> DataFrame:
    """The words of logged searches that passages would be scored by."""
    rows = spark.read.parquet(f"{d}/search_log.parquet").filter("criteria is not null")
    return rows.select("search_no", F.array_join(t.context_keywords(F.col("criteria")), " ").alias("words"))


def bigrams(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/documents.parquet").filter("text is not null")
    return rows.select("doc_id", F.size(t.tokens(F.col("text"), "japanese")).alias("n"))


def html_extract(spark: SparkSession, d: str) -> DataFrame:
    """Title and text of all contents read as HTML; what is no HTML comes out as its text, null contents as null."""
    return _docs(spark, d).select("doc_no", html_fields(F.col("contents")).alias("f")).select("doc_no", "f.title", "f.contents")


def html_links(spark: SparkSession, d: str) -> DataFrame:
    rows = _docs(spark, d).select(F.concat(F.lit("https://docs.example/x/"), F.col("doc_no").cast("string")).alias("url"), F.col("contents").alias("html"))
    return links_of(rows)


QUERIES = {f.__name__: f for f in (summaries, extensions, normal_extensions, stamps, urls, normal_urls, highlighted, keyword_lists, bigrams, html_extract, html_links)}

_SHAPE = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)([^?#]*)((?s:.*))$"
_ROOT = rf"regexp_replace(regexp_replace(regexp_extract(url, '{_SHAPE}', 1), '(?i)^(http://.*):80$', '\1'), '(?i)^(https://.*):443$', '\1')"
_PATH, _REST = rf"regexp_extract(url, '{_SHAPE}', 2)", rf"regexp_extract(url, '{_SHAPE}', 3)"
TOKENS = r"[\p{L}\p{M}\p{N}_]+(?:[''’.:·][\p{L}\p{M}_]+|[.,;''][\p{N}]+)*"
_EXT = r"lower(regexp_extract(regexp_extract(f, '([^/\\]*)$', 1), '\.([^.]+)$', 1))"
ORACLE = {
    "summaries": "SELECT doc_no, contents[1:200] AS summary, coalesce(length(contents), 0)::INT AS n FROM stored_docs",
    "extensions": f"WITH x AS (SELECT doc_no, coalesce(trim(filename, ' '), '') AS f FROM stored_docs) SELECT doc_no, {_EXT} AS ext FROM x WHERE {_EXT} IN ('html', 'cfm', 'txt', '')",
    "normal_extensions": r"SELECT index_no, lower(regexp_replace(trim(extensions, ' '), '^\*?\.', '')) AS ext FROM search_indexes WHERE extensions IS NOT NULL",
    "stamps": "SELECT doc_no, strftime(modified, '%Y%m%d%H%M%S') || lpad((epoch_us(modified) // 1000 % 1000)::VARCHAR, 3, '0') AS stamp, file_path AS path FROM stored_docs WHERE file_path IS NOT NULL AND modified IS NOT NULL",
    "urls": rf"""WITH x AS (SELECT doc_no, url, {_ROOT} AS r, {_PATH} AS p, {_REST} AS q FROM stored_docs WHERE url ILIKE 'http%')
SELECT doc_no, lower(regexp_extract(url, '(?i)^https?://([^/?#:]+)', 1)) AS host, CASE WHEN r = '' THEN url WHEN contains(p, '.') THEN r || regexp_replace(regexp_replace(p, '\.[^.]*$', ''), '[^/]*$', '') WHEN p LIKE '%/' THEN r || p || q ELSE r || p || '/' END AS folder FROM x""",
    "normal_urls": rf"""WITH x AS (SELECT doc_no, trim(url, ' ') AS url FROM stored_docs WHERE url ILIKE 'http%'), y AS (SELECT doc_no, url, {_ROOT} AS r, {_PATH} AS p, {_REST} AS q FROM x)
SELECT doc_no, CASE WHEN r = '' THEN url ELSE lower(r) || p || CASE WHEN contains(p, '.') OR p LIKE '%/' THEN '' ELSE '/' END || regexp_extract(q, '^(\?[^#]*)', 1) END AS url FROM y""",
    "bigrams": rf"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOKENS}') AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, coalesce(list_sum(list_transform(t, lambda w: CASE WHEN regexp_full_match(w, '[\x{{3040}}-\x{{30ff}}\x{{3400}}-\x{{9fff}}\x{{ac00}}-\x{{d7af}}]{{2,}}') THEN length(w) - 1 ELSE 1 END)), 0)::INT AS n FROM t""",
    "highlighted": "SELECT doc_no, regexp_replace(contents, '(servers)', '<B>\\1</B>', 'gi') AS marked FROM stored_docs WHERE contents IS NOT NULL",
    "keyword_lists": f"SELECT search_no, array_to_string(list_filter(regexp_split_to_array(lower(criteria), '\\s+'), lambda w: length(w) > 2 AND NOT list_contains({t.CONTEXT_STOP_WORDS!r}, w)), ' ') AS words FROM search_log WHERE criteria IS NOT NULL",
}
