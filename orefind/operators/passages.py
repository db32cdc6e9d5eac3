"""Passages around what was found, and their highlighting."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from orefind.functions.text import context_keywords, highlighted, occurrences

BYTES, PASSAGES, LENGTH, BEGIN, END = 1000, 3, 150, "<B>", "</B>"
TOLERANCE = 0.2
PASSAGE = ArrayType(StructType([StructField("text", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))


def split_passages(text: str | None, size: int = LENGTH, compat: bool = False) -> list[tuple[str, int, int]]:
    """A text cut behind full stops, exclamation and question marks into passages of at least ``size`` characters: text, start, end.

    What stands behind the last such mark belongs to the passage in hand, however long that is already. A last piece that is short
    joins the passage before it if that stays within a fifth of ``size``. ``compat`` ends an unclosed tail one character early.
    """
    if not text:
        return []
    ends = [m.end() for m in re.finditer(r"[.!?]", text)]
    closed = bool(ends) and ends[-1] == len(text)
    out: list[tuple[int, int]] = []
    start, held = 0, 0  # the passage in hand begins at start, and reaches to held; none where both are equal
    for end in ends:
        if held - start >= size:  # long enough before this sentence
            out.append((start, held))
            start = held
        elif start < held and end - start >= size:
            out.append((start, end))
            start = end
        held = end
    if not closed:
        held = len(text)
    if start < held:
        short = held - start < size - int(size * TOLERANCE)
        if short and out and held - out[-1][0] <= size + int(size * TOLERANCE):
            out[-1] = (out[-1][0], held)
        else:
            out.append((start, held))
    rows = [(text[a:b], a, b) for a, b in out]
    if compat and not closed and rows:
        rows[-1] = (rows[-1][0], rows[-1][1], rows[-1][2] - 1)
    return rows


@F.pandas_udf(PASSAGE)
def passages_udf(texts: pd.Series, sizes: pd.Series) -> pd.Series:
    return pd.Series([[{"text": t, "start": a, "end": b} for t, a, b in split_passages(x, int(s))] for x, s in zip(texts, sizes, strict=True)])


def scored_tag(begin: str, end: str) -> str | None:
    """The name of the element that two marks are the tags of, in the end tag's case; null for other marks. Such a mark bears the score."""
    m = re.fullmatch(r"<(\w+)>", begin)
    return end[2:-1] if m and end.lower() == f"</{m.group(1).lower()}>" else None


def tagged(text: Column, words: Column, begin: str = BEGIN, end: str = END, weights: Column | None = None) -> Column:
    """``text`` with all ``words`` (an array) between the marks, whole tokens only, in any case. Given ``weights`` (of each word) and a
    pair of tags, the tag has the word's weight as its score."""
    esc = lambda s: s.replace("\\", "\\\\").replace("$", "\\$")
    quoted = lambda w: F.regexp_replace(w, r"([^\p{L}\p{N}\s])", r"\\$1")
    tag = scored_tag(begin, end)
    whole = lambda inner: F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}_])(?:"), inner, F.lit(r")(?![\p{L}\p{N}_])"))
    if weights is None or tag is None:
        pattern = whole(F.array_join(F.transform(words, quoted), "|"))
        return F.when(F.size(words) > 0, F.regexp_replace(text, pattern, F.lit(f"{esc(begin)}$0{esc(end)}"))).otherwise(text)
    # a word is marked by a sign of its own first, so that no tag is taken for text
    pairs = F.zip_with(words, weights, lambda w, s: F.struct(w.alias("w"), s.cast("double").cast("string").alias("s")))
    marked = F.aggregate(pairs, text, lambda t, p: F.regexp_replace(t, F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}_\x{e003}])(?:"), quoted(p["w"]), F.lit(r")(?![\p{L}\p{N}_\x{e001}])")), F.concat(F.lit("\ue002"), p["s"], F.lit("\ue003$0\ue001"))))
    return F.regexp_replace(F.regexp_replace(marked, "\ue002([^\ue003]*)\ue003", f'<{tag} score="$1">'), "\ue001", f"</{tag}>")


def best_passages(hits: DataFrame, id_col: str, text_col: str, words_col: str, passages: int = PASSAGES, length: int = LENGTH, begin: str = BEGIN, end: str = END, weights: dict[str, float] | None = None) -> DataFrame:
    """``id_col``, passages (array of original, highlighted, start, end, score in document order): the best ones of each hit.

    A passage's score is the sum of the weights of its tokens that are searched words (array ``words_col``, lower case), each 1 unless
    ``weights`` gives another; passages without any still fill up to ``passages``. Given ``weights`` and a pair of tags as marks, the
    tags bear the weight. Hits are the few rows of a page, so this runs on winners only.
    """
    if passages <= 0:
        return hits.select(id_col, F.array().cast("array<struct<original:string,highlighted:string,start:int,end:int,score:double>>").alias("passages"))
    pieces = hits.select(id_col, F.col(words_col).alias("__w"), F.posexplode(passages_udf(F.col(text_col), F.lit(length))).alias("__i", "__p"))
    lower = F.regexp_extract_all(F.lower("__p.text"), F.lit(r"[\p{L}\p{M}\p{N}_]+"), 0)
    of = F.create_map(*(F.lit(x) for w, s in (weights or {"": 1.0}).items() for x in (w, float(s))))
    met = F.filter(lower, lambda t: F.array_contains(F.col("__w"), t))
    scored = pieces.withColumn("__s", F.aggregate(met, F.lit(0.0), lambda a, t: a + F.coalesce(F.try_element_at(of, t), F.lit(1.0))))
    own = F.transform(F.col("__w"), lambda w: F.coalesce(F.try_element_at(of, w), F.lit(1.0))) if weights is not None else None
    rank = F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc("__s"), "__i"))
    kept = scored.withColumn("__r", rank).filter(F.col("__r") <= passages)
    item = F.struct(F.col("__i"), F.col("__p.text").alias("original"), tagged(F.col("__p.text"), F.col("__w"), begin, end, own).alias("highlighted"), F.col("__p.start").alias("start"), F.col("__p.end").alias("end"), F.col("__s").alias("score"))
    return kept.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["original"].alias("original"), x["highlighted"].alias("highlighted"), x["start"].alias("start"), x["end"].alias("end"), x["score"].alias("score"))).alias("passages"))


def keyword_passages(hits: DataFrame, id_col: str, text_col: str, query: str, passages: int = PASSAGES, length: int = LENGTH) -> DataFrame:
    """As best_passages for vector searches: passages are scored by how often the query's keywords occur in them, and those with none only fill up."""
    words = hits.sparkSession.range(1).select(context_keywords(F.lit(query)).alias("k")).first()["k"]
    pieces = hits.select(id_col, F.posexplode(passages_udf(F.col(text_col), F.lit(length))).alias("__i", "__p"))
    score = F.lit(0)
    marked = F.col("__p.text")
    for w in words:
        score = score + occurrences(F.lower("__p.text"), F.lit(w))
        marked = highlighted(marked, F.lit(w))
    rank = F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc("__s"), "__i"))
    kept = pieces.withColumn("__s", score.cast("double")).withColumn("__r", rank).filter(F.col("__r") <= passages)
    item = F.struct(F.col("__i"), F.col("__p.text").alias("original"), marked.alias("highlighted"), F.col("__p.start").alias("start"), F.col("__p.end").alias("end"), F.col("__s").alias("score"))
    return kept.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["original"].alias("original"), x["highlighted"].alias("highlighted"), x["start"].alias("start"), x["end"].alias("end"), x["score"].alias("score"))).alias("passages"))


def context_text(passages: Column, limit: int = BYTES) -> Column:
    """The highlighted passages with ``...`` and a line feed between, no further one once ``limit`` characters are reached; empty for limit 0."""
    if limit <= 0:
        return F.lit("")
    return F.coalesce(
        F.aggregate(passages, F.lit(""), lambda a, p: F.when(F.length(a) >= limit, a).when(a == "", p["highlighted"]).otherwise(F.concat(a, F.lit("...\n"), p["highlighted"]))), F.lit("")
    )


