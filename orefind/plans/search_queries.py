"""Search queries over the stored documents, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefind.functions import criteria
from orefind.functions.text import occurrences, tokens
from orefind.operators import match, passages, spell, vectors

# the words of the queries below
A, B = "compilers", "servers"
PHRASE = ("nightly", "build")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/stored_docs.parquet")


def _search(spark: SparkSession, d: str, text: str, fields: tuple[str, ...] = ("contents",), dialect: str = "explicit") -> DataFrame:
    docs = _docs(spark, d).select("doc_no", "contents", "filename", "title")
    found = match.ranked(docs, criteria.parse(text, dialect), fields, known=("contents", "filename", "title"))
    return found.select("doc_no", F.round("score", 6).alias("score"))


def _of(text: str, fields: tuple[str, ...] = ("contents",), dialect: str = "explicit"):
    return lambda spark, d: _search(spark, d, text, fields, dialect)


TOKENS = r"[\p{L}\p{M}\p{N}_]+(?:[''’.:·][\p{L}\p{M}_]+|[.,;''][\p{N}]+)*"


def _tf(field: str = "contents") -> str:
    return f"SELECT doc_no, regexp_extract_all(lower(coalesce({field}, '')), '{TOKENS}') AS t FROM stored_docs"


def _leaves(terms: list[str], field: str = "contents", boosts: dict[str, float] | None = None) -> str:
    """doc_no, term, s: the score of each term in each document, as SQL."""
    of = ", ".join(f"('{t}', {float((boosts or {}).get(t, 1.0))})" for t in terms)
    return f"""t AS ({_tf(field)}), n AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t)) AS w FROM t),
q AS (SELECT * FROM (VALUES {of}) AS v(term, boost)),
f AS (SELECT doc_no, term, boost, len(list_filter(t, lambda x: x = term)) AS tf, len(t) AS dl FROM t, q),
d AS (SELECT term, count(*) FILTER (tf > 0) AS df FROM f GROUP BY term),
s AS (SELECT doc_no, term, boost * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / (w / n))) AS s FROM f JOIN d USING (term), n WHERE tf > 0)"""


def phrase_search(spark: SparkSession, d: str) -> DataFrame:
    return _search(spark, d, f'"{" ".join(PHRASE)}"')


def top_page(spark: SparkSession, d: str) -> DataFrame:
    """The second page of ten of a two-word search."""
    docs = _docs(spark, d).select("doc_no", "contents")
    return match.top(match.ranked(docs, criteria.parse_explicit(f"{A} {B}"), ("contents",)), "doc_no", 10, 10).select("doc_no", F.round("score", 6).alias("score"))


def match_all_page(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d).select("doc_no", "contents")
    return match.top(match.ranked(docs, criteria.parse("*"), ("contents",)), "doc_no", 25).select("doc_no", "score")


def _vector(spark: SparkSession, d: str) -> list[float]:
    row = spark.read.parquet(f"{d}/embeddings.parquet").orderBy("vec_id").select("embedding").first()
    return list(row["embedding"])


def knn_cosine_100(spark: SparkSession, d: str) -> DataFrame:
    """The 100 vectors nearest to the first one."""
    rows = spark.read.parquet(f"{d}/embeddings.parquet")
    return vectors.nearest(rows, _vector(spark, d), "embedding", "vec_id").select("vec_id", F.round("score", 5).alias("score"))


def similar_vectors(spark: SparkSession, d: str) -> DataFrame:
    """The ten words nearest to a word, vectors of the table standing for words."""
    rows = spark.read.parquet(f"{d}/embeddings.parquet").select(F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"), F.col("embedding").alias("vector"))
    first = rows.agg(F.min("word")).first()[0]
    return vectors.similar_words(rows, first, 10).select("word", F.round("similarity", 5).alias("similarity"))


def hybrid_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Word scores of the documents mixed with the scores of vectors of the same numbers."""
    words = match.ranked(_docs(spark, d).select("doc_no", "contents"), criteria.parse_explicit(f"{A} {B}"), ("contents",)).select(F.col("doc_no").alias("id"), "score")
    near = vectors.nearest(spark.read.parquet(f"{d}/embeddings.parquet"), _vector(spark, d), "embedding", "vec_id").select(F.col("vec_id").alias("id"), "score")
    return vectors.hybrid(words, near, "id", 0.7).select("id", F.round("score", 5).alias("score"))


VOCABULARY = ["the", "of", "servers", "indexes", "compilers", "banks"]


def tfidf_embedding(spark: SparkSession, d: str) -> DataFrame:
    """The weight of each of the hundred most frequent words in each document's vector, as far as it isn't 0."""
    docs = _docs(spark, d)
    service = vectors.TermWeights(vectors.vocabulary_of(docs, "contents"))
    rows = docs.select("doc_no", F.posexplode(service.generate(F.col("contents"))).alias("place", "x")).filter("x <> 0")
    return rows.select("doc_no", "place", F.round("x", 6).alias("x"))


def demo_embedding(spark: SparkSession, d: str) -> DataFrame:
    rows = _docs(spark, d).select("doc_no", F.posexplode(vectors.Demo().generate(F.col("contents"))).alias("place", "x"))
    return rows.select("doc_no", "place", F.round("x", 6).alias("x"))


def spell_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return spell.dictionary(_docs(spark, d), "contents").select("word", "df")


def spell_suggest(spark: SparkSession, d: str) -> DataFrame:
    found = spell.suggestions(spell.dictionary(_docs(spark, d), "contents"), ["compilrs", "servrs", "bnks"])
    return found.select("term", "keyword", "score", "place")


def token_counts(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_no", F.size(tokens(F.col("contents"))).alias("n"))


def vector_context_score(spark: SparkSession, d: str) -> DataFrame:
    """How often keywords occur in the contents, as passages are scored in vector searches."""
    text = F.lower(F.coalesce("contents", F.lit("")))
    return _docs(spark, d).select("doc_no", (occurrences(text, F.lit(A)) + occurrences(text, F.lit(B))).alias("n"))


def records_searched(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the collections that a search in one language reads."""
    chosen = spark.read.parquet(f"{d}/search_collections.parquet").filter("lang = 'en'").select("collection_name")
    return _docs(spark, d).join(chosen, "collection_name", "left_semi").agg(F.count("*").alias("n"))


def context_passages(spark: SparkSession, d: str) -> DataFrame:
    """The passages of the ten best documents, highlighted."""
    docs = _docs(spark, d).select("doc_no", "contents")
    hits = match.top(match.ranked(docs, criteria.parse_explicit(f"{A} {B}"), ("contents",)), "doc_no", 10).withColumn("words", F.array(F.lit(A), F.lit(B)))
    found = passages.best_passages(hits, "doc_no", "contents", "words")
    return found.select("doc_no", passages.context_text(F.col("passages")).alias("context"), F.size("passages").alias("n"))


def split_passages(spark: SparkSession, d: str) -> DataFrame:
    rows = _docs(spark, d).select("doc_no", F.posexplode(passages.passages_udf(F.col("contents"), F.lit(150))).alias("place", "p"))
    return rows.select("doc_no", "place", "p.start", "p.end", "p.text")


QUERIES = {
    "bm25_or": _of(f"{A} {B}"),
    "bm25_and": _of(f"{A} AND {B}"),
    "bm25_not": _of(f"{A} -{B}"),
    "bm25_simple": _of(f"{A} or {B}", dialect="simple"),
    "bm25_fields": _of("index readme", ("contents", "filename")),
    "bm25_named_field": _of(f"title:{A} {B}"),
    "bm25_grouped": _of(f"({A} OR banks) AND {B}"),
    "phrase_search": phrase_search,
    "prefix_search": _of("compil*"),
    "wildcard_search": _of("s?rver*s"),
    "pattern_search": _of("/b[ao]nks?/"),
    "range_search": _of("[bank TO banks]"),
    "fuzzy_search": _of("bankx~1"),
    "boosted_search": _of(f"{A}^4 {B}"),
    "near_phrase_search": _of('"indexes parsed"~3'),
    "top_page": top_page, "match_all_page": match_all_page, "knn_cosine_100": knn_cosine_100, "similar_vectors": similar_vectors, "hybrid_ratio": hybrid_ratio,
    "tfidf_embedding": tfidf_embedding, "demo_embedding": demo_embedding, "spell_dictionary": spell_dictionary, "spell_suggest": spell_suggest, "token_counts": token_counts,
    "vector_context_score": vector_context_score, "records_searched": records_searched, "context_passages": context_passages, "split_passages": split_passages,
}

_COS = "list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings ORDER BY vec_id LIMIT 1))"
_KNN = f"SELECT vec_id, (1 + {_COS}) / 2 AS score FROM embeddings ORDER BY score DESC, vec_id LIMIT 100"
_SUM = "SELECT doc_no, round(sum(s), 6) AS score FROM s GROUP BY doc_no"


def _constant(condition: str) -> str:
    return f"WITH t AS ({_tf()}) SELECT doc_no, 1.0::DOUBLE AS score FROM t WHERE len(list_filter(t, lambda x: {condition})) > 0"


ORACLE = {
    "bm25_or": f"WITH {_leaves([A, B])} {_SUM}",
    "bm25_and": f"WITH {_leaves([A, B])} {_SUM} HAVING count(*) = 2",
    "bm25_not": f"WITH {_leaves([A, B])} SELECT doc_no, round(sum(s) FILTER (term = '{A}'), 6) AS score FROM s GROUP BY doc_no HAVING bool_and(term = '{A}')",
    "bm25_simple": f"WITH {_leaves([A, B])} {_SUM}",
    "bm25_fields": f"""WITH c AS (WITH {_leaves(["index", "readme"])} SELECT doc_no, s FROM s), f AS (WITH {_leaves(["index", "readme"], "filename")} SELECT doc_no, s FROM s)
SELECT doc_no, round(sum(s), 6) AS score FROM (SELECT * FROM c UNION ALL SELECT * FROM f) GROUP BY doc_no""",
    "bm25_named_field": f"""WITH c AS (WITH {_leaves([A], "title")} SELECT doc_no, s FROM s), f AS (WITH {_leaves([B])} SELECT doc_no, s FROM s)
SELECT doc_no, round(sum(s), 6) AS score FROM (SELECT * FROM c UNION ALL SELECT * FROM f) GROUP BY doc_no""",
    "bm25_grouped": f"WITH {_leaves([A, 'banks', B])} {_SUM} HAVING bool_or(term = '{B}') AND bool_or(term <> '{B}')",
    "phrase_search": f"""WITH t AS ({_tf()}), n AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t)) AS w, count(*) FILTER (list_contains(t, '{PHRASE[0]}')) AS d1, count(*) FILTER (list_contains(t, '{PHRASE[1]}')) AS d2 FROM t),
p AS (SELECT doc_no, len(t) AS dl, len(list_filter(range(1, len(t)), lambda i: t[i] = '{PHRASE[0]}' AND t[i + 1] = '{PHRASE[1]}')) AS tf FROM t)
SELECT doc_no, round((ln(1 + (n - d1 + 0.5) / (d1 + 0.5)) + ln(1 + (n - d2 + 0.5) / (d2 + 0.5))) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / (w / n))), 6) AS score FROM p, n WHERE tf > 0""",
    "prefix_search": _constant("starts_with(x, 'compil')"),
    "wildcard_search": _constant("regexp_full_match(x, 's.rver.*s')"),
    "pattern_search": _constant("regexp_full_match(x, 'b[ao]nks?')"),
    "range_search": _constant("x >= 'bank' AND x <= 'banks'"),
    "boosted_search": f"WITH {_leaves([A, B], boosts={A: 4.0})} {_SUM}",
    "near_phrase_search": f"""WITH t AS ({_tf()}), n AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t)) AS w, count(*) FILTER (list_contains(t, 'indexes')) AS d1, count(*) FILTER (list_contains(t, 'parsed')) AS d2 FROM t),
p AS (SELECT doc_no, len(t) AS dl, len(list_filter(range(1, len(t) + 1), lambda i: t[i] = 'indexes' AND list_contains(t[i + 1 : i + 4], 'parsed'))) AS tf FROM t)
SELECT doc_no, round((ln(1 + (n - d1 + 0.5) / (d1 + 0.5)) + ln(1 + (n - d2 + 0.5) / (d2 + 0.5))) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / (w / n))), 6) AS score FROM p, n WHERE tf > 0""",
    "fuzzy_search": f"""WITH t AS ({_tf()}), n AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t)) AS w FROM t), o AS (SELECT DISTINCT unnest(t) AS term FROM t),
q AS (SELECT term, 1 - d / least(5, length(term)) AS boost FROM (SELECT term, damerau_levenshtein(term, 'bankx') AS d FROM o WHERE abs(length(term) - 5) <= 1) WHERE d <= 1 ORDER BY d, term LIMIT 50),
f AS (SELECT doc_no, term, boost, len(list_filter(t, lambda x: x = term)) AS tf, len(t) AS dl FROM t, q), d AS (SELECT term, count(*) FILTER (tf > 0) AS df FROM f GROUP BY term)
SELECT doc_no, round(sum(boost * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / (w / n)))), 6) AS score FROM f JOIN d USING (term), n WHERE tf > 0 GROUP BY doc_no""",
    "top_page": f"WITH {_leaves([A, B])} SELECT doc_no, round(score, 6) AS score FROM (SELECT doc_no, sum(s) AS score FROM s GROUP BY doc_no ORDER BY score DESC, doc_no LIMIT 10 OFFSET 10)",
    "match_all_page": "SELECT doc_no, 1.0::DOUBLE AS score FROM stored_docs ORDER BY doc_no LIMIT 25",
    "knn_cosine_100": f"SELECT vec_id, round(score, 5) AS score FROM ({_KNN})",
    "similar_vectors": "WITH w AS (SELECT 'w' || vec_id AS word, embedding::DOUBLE[] AS v FROM embeddings), o AS (SELECT * FROM w ORDER BY word LIMIT 1) SELECT w.word, round(list_cosine_similarity(w.v, o.v), 5) AS similarity FROM w, o WHERE w.word <> o.word ORDER BY list_cosine_similarity(w.v, o.v) DESC, w.word LIMIT 10",
    "hybrid_ratio": f"WITH k AS ({_KNN}), b AS (WITH {_leaves([A, B])} SELECT doc_no, sum(s) AS score FROM s GROUP BY doc_no) SELECT coalesce(doc_no, vec_id) AS id, round(0.3 * coalesce(b.score, 0) + 0.7 * coalesce(k.score, 0), 5) AS score FROM b FULL JOIN k ON doc_no = vec_id",
    "tfidf_embedding": """WITH t AS (SELECT doc_no, string_split(trim(regexp_replace(regexp_replace(lower(coalesce(contents, '')), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' ') AS t FROM stored_docs),
o AS (SELECT unnest(t) AS w FROM t), n AS (SELECT w, count(*) AS n FROM o WHERE w <> '' GROUP BY w), v AS (SELECT w, row_number() OVER (ORDER BY n DESC, w) - 1 AS place FROM n QUALIFY place < 100), k AS (SELECT count(*) AS k FROM v),
r AS (SELECT doc_no, place::INT AS place, len(list_filter(t, lambda x: x = w)) * (1 + ln(1 + 10 * place / k)) AS x FROM t, v, k),
z AS (SELECT doc_no, sqrt(sum(x * x)) AS z FROM r GROUP BY doc_no), e AS (SELECT doc_no, place, CASE WHEN z > 0 THEN x / z WHEN place = 0 THEN 1e-5 ELSE 0 END AS x FROM r JOIN z USING (doc_no))
SELECT doc_no, place, round(x, 6) AS x FROM e WHERE x <> 0""",
    "demo_embedding": f"""WITH v AS (SELECT unnest({vectors.Demo().words!r}) AS w, generate_subscripts({vectors.Demo().words!r}, 1) - 1 AS place),
t AS (SELECT doc_no, regexp_split_to_array(lower(coalesce(contents, '')), '\\s+') AS t FROM stored_docs),
r AS (SELECT doc_no, place::INT AS place, len(list_filter(t, lambda x: x = w))::DOUBLE AS x FROM t, v),
z AS (SELECT doc_no, sqrt(sum(x * x)) AS z FROM r GROUP BY doc_no)
SELECT doc_no, place, round(CASE WHEN z > 0 THEN x / z ELSE 0 END, 6) AS x FROM r JOIN z USING (doc_no)""",
    "spell_dictionary": f"WITH t AS ({_tf()}), w AS (SELECT unnest(list_distinct(t)) AS word FROM t) SELECT word, count(*) AS df FROM w GROUP BY word",
    "spell_suggest": f"""WITH t AS ({_tf()}), w AS (SELECT unnest(list_distinct(t)) AS word FROM t), d AS (SELECT word, count(*) AS df FROM w GROUP BY word),
q AS (SELECT unnest(['compilrs', 'servrs', 'bnks']) AS term), s AS (SELECT term, word, df, 1 - levenshtein(term, regexp_replace(word, '[^a-z0-9_.,''’:·]', '?', 'g')) / greatest(length(term), length(word)) AS l FROM q, d WHERE word <> term),
r AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY l DESC, df DESC, word) AS place FROM s WHERE l >= 0.5)
SELECT term, word AS keyword, round(l * 100)::INT AS score, place::INT AS place FROM r WHERE place <= 10""",
    "token_counts": f"WITH t AS ({_tf()}) SELECT doc_no, len(t)::INT AS n FROM t",
    "vector_context_score": f"SELECT doc_no, ((length(c) - length(replace(c, '{A}', ''))) // {len(A)} + (length(c) - length(replace(c, '{B}', ''))) // {len(B)})::INT AS n FROM (SELECT doc_no, lower(coalesce(contents, '')) AS c FROM stored_docs)",
    "records_searched": "SELECT count(*) AS n FROM stored_docs WHERE collection_name IN (SELECT collection_name FROM search_collections WHERE lang = 'en')",
}
