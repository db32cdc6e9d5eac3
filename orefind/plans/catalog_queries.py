"""Queries on collections, indexes and the changes of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefind.functions.text import joined_url, language, safe_directory
from orefind.operators import mutate
from orefind.operators.engine import TYPES
from orefind.sources.documents import body, rows_source


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _latest(spark: SparkSession, d: str) -> DataFrame:
    """Each index as last registered."""
    rows = _t(spark, d, "search_indexes")
    return rows.groupBy("index_id").agg(F.max_by(F.struct(*(c for c in rows.columns if c != "index_id")), F.struct("registered_at", "index_no")).alias("r")).select("index_id", "r.*")


def index_registry(spark: SparkSession, d: str) -> DataFrame:
    """Indexes as last registered, with their number of documents."""
    counts = _t(spark, d, "stored_docs").groupBy("index_id").agg(F.count("*").alias("doccount"))
    return _latest(spark, d).join(counts, "index_id", "left").select("index_id", "index_no", "collection_name", F.coalesce("doccount", F.lit(0)).alias("doccount"))


def collection_counts(spark: SparkSession, d: str) -> DataFrame:
    """Collections with their number of documents and indexes."""
    docs = _t(spark, d, "stored_docs").groupBy("collection_name").agg(F.count("*").alias("docs"))
    indexes = _t(spark, d, "search_indexes").groupBy("collection_name").agg(F.countDistinct("index_id").alias("indexes"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return _t(spark, d, "search_collections").join(docs, "collection_name", "left").join(indexes, "collection_name", "left").select("collection_name", "search_mode", zero("docs"), zero("indexes"))


def category_tree_counts(spark: SparkSession, d: str) -> DataFrame:
    return _latest(spark, d).filter("category_tree is not null").groupBy("category_tree").agg(F.count("*").alias("n"))


def category_tree_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Indexes of a category tree or below it."""
    top = "/minutes"
    return _latest(spark, d).filter((F.col("category_tree") == top) | F.startswith("category_tree", F.lit(top + "/"))).select("index_id", "category_tree")


def language_alias(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "search_indexes").select("index_no", language(F.col("lang")).alias("language"))


def type_codes(spark: SparkSession, d: str) -> DataFrame:
    codes = F.create_map(*(F.lit(x) for pair in TYPES.items() for x in pair))
    return _t(spark, d, "search_indexes").select("index_no", F.coalesce(F.try_element_at(codes, F.lower("index_type")), F.lit(TYPES["custom"])).alias("code"))


def title_fallback(spark: SparkSession, d: str) -> DataFrame:
    """A document's title and custom field, or else those of its index."""
    about = _latest(spark, d).select("index_id", F.col("title").alias("t"), F.col("custom1").alias("c"))
    rows = _t(spark, d, "stored_docs").select("doc_no", "index_id", "title", "custom1").join(about, "index_id", "left")
    pick = lambda own, other: F.coalesce(F.nullif(F.col(own), F.lit("")), F.nullif(F.col(other), F.lit("")), F.lit("")).alias(own)
    return rows.select("doc_no", pick("title", "t"), pick("custom1", "c"))


def url_joined(spark: SparkSession, d: str) -> DataFrame:
    """An index's address path joined with a document's own address."""
    about = _latest(spark, d).select("index_id", "urlpath")
    rows = _t(spark, d, "stored_docs").filter("url is not null and url not ilike 'http%'").select("doc_no", "index_id", "url").join(about, "index_id", "left")
    return rows.select("doc_no", joined_url(F.col("urlpath"), F.col("url")).alias("url"))


def body_concat(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "custom_batches")
    return rows.select("batch_no", "index_id", "id", "arrived_at", body(rows, ["title", "body"]).alias("contents"))


def role_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Roles that are columns, in any case, and roles that are constants."""
    return rows_source(_t(spark, d, "custom_batches"), "ID", ["Title", "body"], "title", None, ("index_id", "a constant")).select("key", "title", "contents", "custom1", "custom2", "size")


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """What stands stored and what comes in: the batches before a day, merged, and those since."""
    rows = _t(spark, d, "custom_batches").withColumn("key", F.concat_ws("/", "index_id", F.when(F.col("id").isNotNull(), F.col("id")))).withColumn("key", F.when(F.col("id").isNotNull(), F.col("key")))
    day = F.lit("2021-01-08").cast("timestamp")
    order = F.struct("arrived_at", "batch_no", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")))
    rows = rows.withColumn("o", order)
    old = rows.filter(F.col("arrived_at") < day)
    empty = old.select("key", "title", "body").limit(0)
    return mutate.upsert(empty, old.select("key", "title", "body", "o"), order="o"), rows.filter(F.col("arrived_at") >= day)


def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    stored, incoming = _halves(spark, d)
    return mutate.upsert(stored, incoming.select("key", "title", "body", "o"), order="o")


def upsert_counts(spark: SparkSession, d: str) -> DataFrame:
    return mutate.upsert_counts(*_halves(spark, d))


def delete_by_key(spark: SparkSession, d: str) -> DataFrame:
    stored, incoming = _halves(spark, d)
    return mutate.delete_keys(stored, incoming.select("key"))


def latest_delivery(spark: SparkSession, d: str) -> DataFrame:
    """Each document as last delivered."""
    rows = _t(spark, d, "stored_docs")
    return rows.groupBy("index_id", "doc_key").agg(F.max_by("doc_no", F.struct("indexed_at", "doc_no")).alias("doc_no"), F.count("*").alias("deliveries"))


def directory_names(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "search_collections").select("collection_name", safe_directory(F.col("collection_name")).alias("folder"))


QUERIES = {f.__name__: f for f in (index_registry, collection_counts, category_tree_counts, category_tree_prefix, language_alias, type_codes, title_fallback, url_joined, body_concat, role_mapping, upsert_last_wins, upsert_counts, delete_by_key, latest_delivery, directory_names)}

_LATEST = "l AS (SELECT * FROM search_indexes QUALIFY row_number() OVER (PARTITION BY index_id ORDER BY registered_at DESC, index_no DESC) = 1)"
_KEYED = """k AS (SELECT CASE WHEN id IS NOT NULL THEN concat_ws('/', index_id, id) END AS key, title, body, arrived_at, arrived_at < TIMESTAMP '2021-01-08' AS old,
row_number() OVER (ORDER BY arrived_at, batch_no, coalesce(title, ''), coalesce(body, '')) AS o FROM custom_batches)"""
_ALIAS = "CASE trim(lower(lang)) WHEN 'en' THEN 'english' WHEN 'de' THEN 'german' WHEN 'ru' THEN 'russian' WHEN 'nl' THEN 'dutch' WHEN 'fr' THEN 'french' WHEN 'it' THEN 'italian' WHEN 'no' THEN 'norwegian' WHEN 'pt' THEN 'portuguese' WHEN 'sp' THEN 'spanish' WHEN 'es' THEN 'spanish' WHEN 'br' THEN 'brazilian' WHEN 'pl' THEN 'polish' ELSE coalesce(trim(lower(lang)), 'english') END"
ORACLE = {
    "index_registry": f"WITH {_LATEST} SELECT index_id, index_no, collection_name, (SELECT count(*) FROM stored_docs s WHERE s.index_id = l.index_id) AS doccount FROM l",
    "collection_counts": "SELECT collection_name, search_mode, (SELECT count(*) FROM stored_docs s WHERE s.collection_name = c.collection_name) AS docs, (SELECT count(DISTINCT index_id) FROM search_indexes i WHERE i.collection_name = c.collection_name) AS indexes FROM search_collections c",
    "category_tree_counts": f"WITH {_LATEST} SELECT category_tree, count(*) AS n FROM l WHERE category_tree IS NOT NULL GROUP BY 1",
    "category_tree_prefix": f"WITH {_LATEST} SELECT index_id, category_tree FROM l WHERE category_tree = '/minutes' OR starts_with(category_tree, '/minutes/')",
    "language_alias": f"SELECT index_no, {_ALIAS} AS language FROM search_indexes",
    "type_codes": "SELECT index_no, CASE lower(index_type) WHEN 'file' THEN 0 WHEN 'path' THEN 1 WHEN 'url' THEN 3 ELSE 2 END::INT AS code FROM search_indexes",
    "title_fallback": f"WITH {_LATEST} SELECT doc_no, coalesce(nullif(s.title, ''), nullif(l.title, ''), '') AS title, coalesce(nullif(s.custom1, ''), nullif(l.custom1, ''), '') AS custom1 FROM stored_docs s LEFT JOIN l USING (index_id)",
    "url_joined": f"""WITH {_LATEST}, p AS (SELECT doc_no, coalesce(urlpath, '') AS b, s.url AS u FROM stored_docs s LEFT JOIN l USING (index_id) WHERE s.url IS NOT NULL AND s.url NOT ILIKE 'http%')
SELECT doc_no, CASE WHEN b = '' THEN u WHEN u = '' THEN b WHEN starts_with(lower(regexp_replace(replace(u, '\\', '/'), '^/', '')), lower(regexp_replace(replace(b, '\\', '/'), '/$', ''))) THEN regexp_replace(replace(u, '\\', '/'), '^/', '')
ELSE regexp_replace(replace(b, '\\', '/'), '/$', '') || '/' || regexp_replace(replace(u, '\\', '/'), '^/', '') END AS url FROM p""",
    "body_concat": "SELECT batch_no, index_id, id, arrived_at, coalesce(title || ' ', '') || coalesce(body || ' ', '') AS contents FROM custom_batches",
    "role_mapping": "SELECT id AS key, title, coalesce(title || ' ', '') || coalesce(body || ' ', '') AS contents, index_id AS custom1, 'a constant' AS custom2, length(coalesce(title || ' ', '') || coalesce(body || ' ', ''))::VARCHAR AS size FROM custom_batches",
    "upsert_last_wins": f"WITH {_KEYED} SELECT key, title, body FROM k WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY old, o DESC) = 1",
    "upsert_counts": f"WITH {_KEYED}, i AS (SELECT count(DISTINCT key) AS n FROM k WHERE NOT old AND key NOT IN (SELECT key FROM k WHERE old AND key IS NOT NULL)) SELECT 0::BIGINT AS deleted, n AS inserted, (SELECT count(*) FROM k WHERE NOT old) - n AS updated FROM i",
    "delete_by_key": f"WITH {_KEYED} SELECT key, title, body FROM k WHERE key IS NOT NULL AND old AND key NOT IN (SELECT key FROM k WHERE NOT old AND key IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY key ORDER BY o DESC) = 1",
    "latest_delivery": "SELECT index_id, doc_key, arg_max(doc_no, (indexed_at, doc_no)) AS doc_no, count(*) AS deliveries FROM stored_docs GROUP BY 1, 2",
    "directory_names": "SELECT collection_name, 'CF' || regexp_replace(collection_name, '[^A-Za-z0-9]', '_', 'g') || CASE WHEN regexp_matches(collection_name, '[^A-Za-z0-9]') THEN list_sum(list_transform(list_filter(range(1, length(collection_name) + 1), lambda i: regexp_matches(collection_name[i], '[^A-Za-z0-9]')), lambda i: ascii(collection_name[i]) * (i + 1)))::VARCHAR ELSE '' END AS folder FROM search_collections",
}
