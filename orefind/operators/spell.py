"""Suggestions for misspelled words, from the words of the collection itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orefind.functions.text import tokens

ACCURACY, SUGGESTIONS = 0.5, 10


def dictionary(docs: DataFrame, text_col: str, by: list[str] | None = None, language: str | None = "english") -> DataFrame:
    """The words of a text column, by index if asked: word, df (records with the word)."""
    keys = by or []
    return docs.select(*keys, F.explode(F.array_distinct(tokens(F.col(text_col), language))).alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("df"))


def suggestions(words: DataFrame, asked: list[str], most: int = SUGGESTIONS, accuracy: float = ACCURACY) -> DataFrame:
    """term, keyword, score: for each asked word the at most ``most`` similar words of the dictionary, itself left out.

    The score is the similarity 1 - edits / length of the longer, in hundredths; candidates too long or too short for ``accuracy`` are
    left out before edits are counted. Ties by frequency, then word. The asked words are the few of a search.
    """
    terms = words.sparkSession.createDataFrame([(w.lower(),) for w in dict.fromkeys(asked) if w.strip()], "term string")
    size, own = F.length("word"), F.length("term")
    near = words.join(F.broadcast(terms), (F.col("word") != F.col("term")) & (F.least(size, own) >= F.greatest(size, own) * accuracy))
    likeness = 1 - F.levenshtein("term", "word") / F.greatest(size, own)
    scored = near.withColumn("__l", likeness).filter(F.col("__l") >= accuracy)
    rank = F.row_number().over(Window.partitionBy("term").orderBy(F.desc("__l"), F.desc("df"), "word"))
    return scored.withColumn("__r", rank).filter(F.col("__r") <= most).select("term", F.col("word").alias("keyword"), F.round(F.col("__l") * 100).cast("int").alias("score"), F.col("__r").cast("int").alias("place"))


def as_map(found: DataFrame) -> DataFrame:
    """term, keywords, scores: the suggestions of each term as arrays in order."""
    return found.groupBy("term").agg(F.array_sort(F.collect_list(F.struct("place", "keyword", "score"))).alias("__x")).select("term", F.col("__x.keyword").alias("keywords"), F.col("__x.score").alias("scores"))


def suggested_query(simple, best: dict[str, str], begin: str = "<suggestion>", end: str = "</suggestion>") -> tuple[str, str]:
    """A simple search with its misspelled words replaced by the best suggestions: with marks, and without."""
    marked = {w: f"{begin}{best[w.lower()]}{end}" for w in simple.words if w.lower() in best}
    plain = {w: best[w.lower()] for w in simple.words if w.lower() in best}
    tagged = simple.canonical({w: f"\ue000{i}\ue001" for i, w in enumerate(marked)})
    for i, w in enumerate(marked):
        tagged = tagged.replace(f"\ue000{i}\ue001", marked[w])
    return tagged, simple.canonical(plain)
