"""The queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefind.llm import garbled, mainbody, markup, mixing, neardup, subjects, terms, tokens
from orefind.sources.shared import written


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The lines of web pages that aren't part of their main body."""
    return mainbody.page_lines(_table(spark, d, "stored_docs"), "doc_no", "contents", "url").filter("not body").select("doc_no", "line_no")


def p1_body(spark: SparkSession, d: str) -> DataFrame:
    """The main body of each web page."""
    return mainbody.main_body(_table(spark, d, "stored_docs"), "doc_no", "contents", "url")


def _similar(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return neardup.similar_classes(_table(spark, d, "stored_docs"), "doc_no", "contents")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of rows of at least 30 words each and a similarity of at least 0.8."""
    return neardup.similar_pairs(*_similar(spark, d)).select(F.col("id_a").alias("doc_no_a"), F.col("id_b").alias("doc_no_b"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    """Each row's class of equal texts, its number of links to other classes, and the group that the links form."""
    members, links = _similar(spark, d)
    members, links = written(members, "members"), written(links, "links")
    counts = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
    rows = neardup.groups(members, links).join(counts, "class", "left")
    return rows.select(F.col("id").alias("doc_no"), F.col("class").alias("class_no"), F.col("group").alias("group_no"), F.coalesce("links", F.lit(0)).alias("links"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows and the families of markup that their contents hold."""
    return markup.markup_families(_table(spark, d, "stored_docs"), "doc_no", "contents").select("doc_no", F.explode("markup").alias("markup"))


def p3_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every row's contents without markup, as blocks and as text."""
    return markup.clean_markup(_table(spark, d, "stored_docs"), "doc_no", "contents").select("doc_no", "blocks", "clean")


def p3_differenced(spark: SparkSession, d: str) -> DataFrame:
    """Web pages without the lines that they share with the nearest page of their host."""
    return markup.differenced(_table(spark, d, "stored_docs"), "doc_no", "contents", "url")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Terms that occur at least 4 times in a row's contents and in those of 2 to 6 rows."""
    return terms.distinctive_terms(_table(spark, d, "stored_docs"), "doc_no", "contents", min_tf=4, records=(2, 6)).select("doc_no", "term")


def p4_scores(spark: SparkSession, d: str) -> DataFrame:
    """The score of every term of every row."""
    return terms.distinctive_terms(_table(spark, d, "stored_docs"), "doc_no", "contents").withColumn("score", F.round("score", 6))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Terms of contents and whole filenames that are too rare or too common."""
    added = _table(spark, d, "stored_docs").select("contents", "filename", F.lit(1).alias("sign"))
    state = terms.TermCounts(spark).merge(terms.term_deltas(added, "contents"), terms.value_deltas(added, "filename"))
    rows = terms.marked(state.counts(), 1, {"contents": (1, 4), "filename": (1, 50)})
    return rows.filter("mark is not null").select("field_name", "term", "mark")


def p6_deltas(spark: SparkSession, d: str) -> DataFrame:
    """The counts of contents and filenames of each document as last delivered, brought about by deltas: first deliveries are added, later
    ones replace what they change, and documents without contents are deleted."""
    rows = _table(spark, d, "stored_docs").select("index_id", "doc_key", "doc_no", "indexed_at", "contents", "filename")
    place = F.struct("indexed_at", "doc_no")
    ends = rows.groupBy("index_id", "doc_key").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    rows = rows.withColumn("place", place).join(ends, [rows.index_id.eqNullSafe(ends.index_id), rows.doc_key.eqNullSafe(ends.doc_key)]).select("place", "first", "last", "contents", "filename")
    first, last = rows.filter("place = first"), rows.filter("place = last")
    signed = lambda df, sign: df.select("contents", "filename", F.lit(sign).alias("sign"))
    both = lambda df: (terms.term_deltas(df, "contents"), terms.value_deltas(df, "filename"))
    state = terms.TermCounts(spark).merge(*both(signed(first, 1)))
    state.merge(*both(signed(first.filter("first <> last"), -1).unionByName(signed(last.filter("first <> last"), 1))))
    state = terms.TermCounts(spark, state.path).merge(*both(signed(last.filter("contents is null"), -1)))
    return state.counts().select("field_name", "term", "occurrences", "records")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose contents show characters of a wrong decoding."""
    return garbled.repair_text(_table(spark, d, "stored_docs"), "doc_no", "contents").filter("garbled").select("doc_no")


def p7_restored(spark: SparkSession, d: str) -> DataFrame:
    """The affected rows with their restored text."""
    return garbled.repair_text(_table(spark, d, "stored_docs"), "doc_no", "contents").filter("garbled").select("doc_no", "restored")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """The ids of every document."""
    return tokens.encode_corpus(_table(spark, d, "documents"), "doc_id", "text")


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return mixing.token_sizes(_table(spark, d, "documents"), "doc_id", "text", ["source"])


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources that can't reach their target."""
    return mixing.source_quotas(mixing.source_tokens(_sizes(spark, d)), _table(spark, d, "mix_targets")).filter("not reachable").select("source")


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The mixture: each record's number of copies."""
    return mixing.mixture(written(_sizes(spark, d), "sizes"), _table(spark, d, "mix_targets"), "doc_id")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares of the mixture."""
    sizes, targets = written(_sizes(spark, d), "sizes"), _table(spark, d, "mix_targets")
    return mixing.mixture_shares(mixing.mixture(sizes, targets, "doc_id"), mixing.source_report(mixing.source_tokens(sizes), targets))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Each document's subject areas."""
    return subjects.subjects(*(_table(spark, d, t) for t in ("documents", "subject_areas", "subject_labels")), "doc_id", "text", "lang").select("doc_id", "subject")


_QUERIES = (p1_found, p1_body, p2_found, p2_groups, p3_found, p3_clean, p3_differenced, p4_found, p4_scores, p6_found, p6_deltas, p7_found, p7_restored, p8_ids, p9_found, p9_mixture, p9_shares, p10_found)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict:
    from orefind.llm.oracles import ORACLE

    return ORACLE
