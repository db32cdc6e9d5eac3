"""Searches through collections that are stored: created, filled and then asked, with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefind.operators.engine import Collection, Engine
from orefind.plans.catalog_queries import _KEYED, _halves
from orefind.plans.search_queries import TOKENS, VOCABULARY, A, B, _tf
from orefind.sources.documents import _filled
from orefind.sources.shared import shared_folder

PAGES = "https://pages.example/root/index.html"
_engines: dict[tuple[str, str], Engine] = {}


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """The stored documents in the columns of an index; each doc_no is a document."""
    rows = spark.read.parquet(f"{d}/stored_docs.parquet")
    named = rows.select(F.col("doc_no").cast("string").alias("key"), "title", "contents", "filename", "summary", "keywords", "author", "custom1", "url", "mime_type", F.col("file_path").alias("path"), F.col("size_chars").alias("size"), "modified")
    return _filled(named)


def stored(spark: SparkSession, d: str) -> Engine:
    """The collections of the queries below, filled once a session and folder: library (all documents, in an index of pages and one of
    rows), archive (the rows), mixed (the rows with vectors)."""
    place = (spark.sparkContext.applicationId, d)
    if place not in _engines:
        engine = Engine(spark, shared_folder(spark, "engine"))
        docs = _documents(spark, d)
        web = F.coalesce(F.col("url").ilike("http%"), F.lit(False))
        words = shared_folder(spark, "vocabulary")
        spark.createDataFrame(list(enumerate(VOCABULARY)), "i int, value string").coalesce(1).sortWithinPartitions("i").select("value").write.text(words)
        library, archive = engine.create("library"), engine.create("Archive")
        library.index("url", PAGES, docs.filter(web), title="A page", custom1="page", categories=["web", " news"], category_tree="/site/pages")
        mixed = engine.create("mixed", mode="hybrid", ratio=0.6, vocabulary_path=words)
        for c in (library, archive, mixed):
            c.index("custom", "rows", docs.filter(~web), title="A row", categories=["rows"], category_tree="/site")
        _engines[place] = engine
    return _engines[place]


def _collection(spark: SparkSession, d: str, name: str) -> Collection:
    return stored(spark, d).collection(name)


_COLUMNS = ("key", "title", "custom1", "categoryTree", "category", "type", "author", "size", "summary", "url", "collection")


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(*_COLUMNS, F.round("score", 6).alias("score"))


def stored_search(spark: SparkSession, d: str) -> DataFrame:
    """A search over all documents, with the result's columns."""
    return _shown(_collection(spark, d, "LIBRARY").search(f"{A} {B}", dialect="explicit", context_passages=0)[0])


def stored_required(spark: SparkSession, d: str) -> DataFrame:
    """A search for records that hold both words, in the simple language."""
    return _shown(_collection(spark, d, "library").search(f"{A} and {B}", context_passages=0)[0])


def stored_category(spark: SparkSession, d: str) -> DataFrame:
    """The indexes of a category alone are searched, and count for the scores."""
    return _shown(_collection(spark, d, "library").search(f"{A} {B}", dialect="explicit", categories=["news"], context_passages=0)[0])


def stored_tree(spark: SparkSession, d: str) -> DataFrame:
    """The indexes of a category tree or below it."""
    return _shown(_collection(spark, d, "library").search(f"{A} {B}", dialect="explicit", tree="/site/pages", context_passages=0)[0])


def stored_phrase(spark: SparkSession, d: str) -> DataFrame:
    """Two words beside each other are a phrase in the simple language."""
    return _shown(_collection(spark, d, "library").search("nightly build", context_passages=0)[0])


def stored_all(spark: SparkSession, d: str) -> DataFrame:
    """Everything, a page of 25."""
    return _shown(_collection(spark, d, "archive").search("*", most=25)[0])


def stored_page(spark: SparkSession, d: str) -> DataFrame:
    """The second page of ten over two collections, with ranks."""
    rows, _ = stored(spark, d).search(["library", "archive"], f"{A} or {B}", start=11, most=10, context_passages=0)
    return rows.select("collection", "key", F.round("score", 6).alias("score"), "rank")


def stored_hybrid(spark: SparkSession, d: str) -> DataFrame:
    """Words and vectors together: all records with a word, and the hundred nearest."""
    rows, _ = _collection(spark, d, "mixed").search(f"{A} or {B}", context_passages=0)
    return rows.select("key", F.round("score", 5).alias("score"))


def stored_vectors(spark: SparkSession, d: str) -> DataFrame:
    """The vectors that were stored with the documents."""
    rows = _collection(spark, d, "mixed").docs().filter("vector is not null")
    return rows.select("key", F.posexplode("vector").alias("place", "x")).select("key", "place", F.round("x", 6).alias("x"))


def stored_suggestions(spark: SparkSession, d: str) -> DataFrame:
    """What is suggested for two misspelled words, from the stored dictionaries."""
    _, data = _collection(spark, d, "library").search("compilrs or servrs", suggest=0, most=1, context_passages=0)
    rows = [(t, k, s, i) for t, found in data.suggestions.items() for i, (k, s) in enumerate(found, 1)]
    return spark.createDataFrame(rows, "term string, keyword string, score int, place int")


def stored_counts(spark: SparkSession, d: str) -> DataFrame:
    """Records searched, and each index with its documents."""
    c = _collection(spark, d, "library")
    return c.index_table().select("type", "title", "categories", "categoryTree", F.col("doccount").cast("bigint").alias("doccount"))


def stored_changes(spark: SparkSession, d: str) -> DataFrame:
    """Batches of rows laid over an index, then some of their keys deleted: what the operations count, and what is left."""
    engine = Engine(spark, shared_folder(spark, "changes"))
    c = engine.create("batches")
    old, new = _halves(spark, d)
    first = c.index("custom", "rows", _filled(old.select("key", "title", F.col("body").alias("contents"))))
    second = c.index("custom", "rows", _ordered(new), order="o")
    gone = c.delete_documents(["no such key", *[r["key"] for r in old.select("key").orderBy("key").limit(3).collect()]])
    return spark.createDataFrame([(first.inserted, first.updated, second.inserted, second.updated, gone.deleted, c.count())], "first_inserted bigint, first_updated bigint, inserted bigint, updated bigint, deleted bigint, left_over bigint")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in the columns of an index, with the order in which they count."""
    return _filled(rows.select("key", "title", F.col("body").alias("contents"))).limit(0).withColumn("o", F.lit(None).cast(rows.schema["o"].dataType)).unionByName(rows.select("key", "title", F.col("body").alias("contents"), "o"), allowMissingColumns=True)


def stored_passages(spark: SparkSession, d: str) -> DataFrame:
    """The passages of the ten best documents, highlighted."""
    rows, _ = _collection(spark, d, "library").search(f"{A} or {B}", most=10)
    return rows.select("key", "context.text", F.size("context.passages").alias("n"))


QUERIES = {f.__name__: f for f in (stored_search, stored_required, stored_category, stored_tree, stored_phrase, stored_all, stored_page, stored_hybrid, stored_vectors, stored_suggestions, stored_counts, stored_changes, stored_passages)}

_WEB = "coalesce(url ILIKE 'http%', false)"
_FIELDS = ("contents", "filename")


def _scores(name: str, where: str, terms: list[str]) -> str:
    """Tables name_s (doc_no, term, s: each term's score, over both fields) and what leads to them, of the documents that ``where`` names."""
    of = ", ".join(f"('{t}')" for t in terms)
    parts = []
    for k, f in enumerate(_FIELDS):
        n = f"{name}{k}"
        parts.append(f"""{n}t AS (SELECT doc_no, regexp_extract_all(lower(coalesce({f}, '')), '{TOKENS}') AS t FROM stored_docs WHERE {where}), {n}n AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t)) AS w FROM {n}t),
{n}f AS (SELECT doc_no, term, len(list_filter(t, lambda x: x = term)) AS tf, len(t) AS dl FROM {n}t, (VALUES {of}) AS v(term)), {n}d AS (SELECT term, count(*) FILTER (tf > 0) AS df FROM {n}f GROUP BY term),
{n}s AS (SELECT doc_no, term, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / (w / n))) AS s FROM {n}f JOIN {n}d USING (term), {n}n WHERE tf > 0)""")
    return ", ".join(parts) + f", {name}_s AS (SELECT doc_no, term, s FROM {name}0s UNION ALL SELECT doc_no, term, s FROM {name}1s)"


def _rows(scores: str, collection: str, join: str = "JOIN z USING (doc_no)") -> str:
    """The result's columns of documents scored in z (doc_no, score)."""
    return f"""WITH {scores} SELECT doc_no::VARCHAR AS key, coalesce(nullif(title, ''), CASE WHEN {_WEB} THEN 'A page' ELSE 'A row' END) AS title, coalesce(nullif(custom1, ''), CASE WHEN {_WEB} THEN 'page' ELSE '' END) AS custom1,
CASE WHEN {_WEB} THEN '/site/pages' ELSE '/site' END AS categoryTree, CASE WHEN {_WEB} THEN 'web,news' ELSE 'rows' END AS category, coalesce(mime_type, '') AS type, coalesce(author, '') AS author, coalesce(size_chars, '') AS size,
coalesce(summary, '') AS summary, CASE WHEN {_WEB} THEN 'https://pages.example/root/' || doc_no ELSE coalesce(url, '') END AS url, '{collection}' AS collection, round(score, 6) AS score FROM stored_docs {join}"""


_SUM = "z AS (SELECT doc_no, sum(s) AS score FROM a_s GROUP BY doc_no"
_PHRASE = ", ".join(
    f"""p{k} AS (SELECT doc_no, regexp_extract_all(lower(coalesce({f}, '')), '{TOKENS}') AS t FROM stored_docs), n{k} AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t)) AS w, count(*) FILTER (list_contains(t, 'nightly')) AS d1, count(*) FILTER (list_contains(t, 'build')) AS d2 FROM p{k}),
q{k} AS (SELECT doc_no, len(t) AS dl, len(list_filter(range(1, len(t)), lambda i: t[i] = 'nightly' AND t[i + 1] = 'build')) AS tf FROM p{k}),
r{k} AS (SELECT doc_no, (ln(1 + (n - d1 + 0.5) / (d1 + 0.5)) + ln(1 + (n - d2 + 0.5) / (d2 + 0.5))) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / (w / n))) AS s FROM q{k}, n{k} WHERE tf > 0)"""
    for k, f in enumerate(_FIELDS)
)
_DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2]))"
_VECTORS = f"""v AS (SELECT unnest({VOCABULARY!r}) AS w, generate_subscripts({VOCABULARY!r}, 1) - 1 AS place),
e AS (SELECT doc_no, string_split(trim(regexp_replace(regexp_replace(lower(contents), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' ') AS t FROM stored_docs WHERE contents IS NOT NULL AND NOT {_WEB}
UNION ALL SELECT -1, ['{A}', 'or', '{B}']),
r AS (SELECT doc_no, place::INT AS place, len(list_filter(t, lambda x: x = w)) * (1 + ln(1 + 10 * place / {len(VOCABULARY)})) AS x FROM e, v),
y AS (SELECT doc_no, list(x ORDER BY place) AS l FROM r GROUP BY doc_no), y2 AS (SELECT doc_no, l, sqrt({_DOT.format(a='l', b='l')}) AS z FROM y),
g AS (SELECT doc_no, list_transform(l, lambda x, i: CASE WHEN z > 0 THEN x / z WHEN i = 1 THEN 1e-5 ELSE 0 END) AS l FROM y2)"""
ORACLE = {
    "stored_search": _rows(f"{_scores('a', 'true', [A, B])}, {_SUM})", "library"),
    "stored_required": _rows(f"{_scores('a', 'true', [A, B])}, {_SUM} HAVING count(DISTINCT term) = 2)", "library"),
    "stored_category": _rows(f"{_scores('a', _WEB, [A, B])}, {_SUM})", "library"),
    "stored_tree": _rows(f"{_scores('a', _WEB, [A, B])}, {_SUM})", "library"),
    "stored_phrase": _rows(f"{_PHRASE}, z AS (SELECT doc_no, sum(s) AS score FROM (SELECT * FROM r0 UNION ALL SELECT * FROM r1) GROUP BY doc_no)", "library"),
    "stored_all": _rows(f"z AS (SELECT doc_no, 1.0::DOUBLE AS score FROM stored_docs WHERE NOT {_WEB} ORDER BY doc_no::VARCHAR LIMIT 25)", "Archive"),
    "stored_page": f"""WITH {_scores('a', 'true', [A, B])}, {_scores('b', f'NOT {_WEB}', [A, B])}, z AS (SELECT 'library' AS collection, doc_no, sum(s) AS score FROM a_s GROUP BY doc_no UNION ALL SELECT 'Archive', doc_no, sum(s) FROM b_s GROUP BY doc_no),
o AS (SELECT collection, doc_no::VARCHAR AS key, round(score, 6) AS score, row_number() OVER (ORDER BY z.score DESC, collection, doc_no::VARCHAR) AS rank FROM z) SELECT * FROM o WHERE rank BETWEEN 11 AND 20""",
    "stored_hybrid": f"""WITH {_scores('a', f'NOT {_WEB}', [A, B])}, {_SUM}), {_VECTORS}, q AS (SELECT l FROM g WHERE doc_no = -1),
c AS (SELECT doc_no, {_DOT.format(a='g.l', b='q.l')} / (sqrt({_DOT.format(a='g.l', b='g.l')}) * sqrt({_DOT.format(a='q.l', b='q.l')})) AS c FROM g, q WHERE doc_no >= 0),
k AS (SELECT doc_no, (1 + c) / 2 AS v FROM c ORDER BY v DESC, doc_no::VARCHAR LIMIT 100)
SELECT coalesce(z.doc_no, k.doc_no)::VARCHAR AS key, round(0.4 * coalesce(score, 0) + 0.6 * coalesce(v, 0), 5) AS score FROM z FULL JOIN k ON z.doc_no = k.doc_no""",
    "stored_vectors": f"WITH {_VECTORS} SELECT doc_no::VARCHAR AS key, (generate_subscripts(l, 1) - 1)::INT AS place, round(unnest(l), 6) AS x FROM g WHERE doc_no >= 0",
    "stored_suggestions": f"""WITH t AS ({_tf()}), w AS (SELECT unnest(list_distinct(t)) AS word FROM t), d AS (SELECT word, count(*) AS df FROM w GROUP BY word),
q AS (SELECT unnest(['compilrs', 'servrs']) AS term), s AS (SELECT term, word, df, 1 - levenshtein(term, regexp_replace(word, '[^a-z0-9_.,''’:·]', '?', 'g')) / greatest(length(term), length(word)) AS l FROM q, d WHERE word <> term),
r AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY l DESC, df DESC, word) AS place FROM s WHERE l >= 0.5)
SELECT term, word AS keyword, round(l * 100)::INT AS score, place::INT AS place FROM r WHERE place <= 10""",
    "stored_counts": f"SELECT CASE WHEN {_WEB} THEN 'url' ELSE 'custom' END AS type, CASE WHEN {_WEB} THEN 'A page' ELSE 'A row' END AS title, CASE WHEN {_WEB} THEN 'web,news' ELSE 'rows' END AS categories, CASE WHEN {_WEB} THEN '/site/pages' ELSE '/site' END AS categoryTree, count(*) AS doccount FROM stored_docs GROUP BY ALL",
    "stored_changes": f"""WITH {_KEYED}, f AS (SELECT count(DISTINCT key) AS n FROM k WHERE old), i AS (SELECT count(DISTINCT key) AS n FROM k WHERE NOT old AND key NOT IN (SELECT key FROM k WHERE old AND key IS NOT NULL)),
a AS (SELECT DISTINCT key FROM k WHERE key IS NOT NULL), x AS (SELECT key FROM k WHERE old AND key IS NOT NULL GROUP BY key ORDER BY key LIMIT 3)
SELECT f.n AS first_inserted, 0::BIGINT AS first_updated, i.n AS inserted, (SELECT count(*) FROM k WHERE NOT old) - i.n AS updated, (SELECT count(*) FROM x) AS deleted, (SELECT count(*) FROM a) - (SELECT count(*) FROM x) AS left_over FROM f, i""",
}
