"""Vectors: embeddings of texts, nearest neighbours by cosine, and the mixture of word and vector scores."""

from __future__ import annotations

import importlib
import math
from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefind.functions.text import let, plain_tokens, tfidf_tokens

NEIGHBOURS = 100
DIMENSION = 100
# The words of the small demonstration embedding; the eleventh is a product's name, a parameter.
DEMO_WORDS = ("the", "quick", "brown", "fox", "jumps", "over", "lazy", "dog", "hello", "world", None, "ai")
PRODUCT = "orefind"


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two arrays; 0 where one is null, zero or of another length."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(a.isNotNull() & b.isNotNull() & (F.size(a) == F.size(b)) & (size > 0), dot(a, b) / size).otherwise(0.0)


def vector_score(cos: Column) -> Column:
    return (1 + cos) / 2


def literal(vector: list[float]) -> Column:
    return F.array(*(F.lit(float(x)) for x in vector)) if vector else F.array().cast("array<double>")


def nearest(vectors: DataFrame, query: list[float], vector_col: str, id_cols: str | list[str], k: int = NEIGHBOURS) -> DataFrame:
    """The ``k`` rows nearest to a vector, with score (1 + cosine) / 2; exact, each executor keeping its best ``k``. Ties by id; null vectors have none."""
    ids = [id_cols] if isinstance(id_cols, str) else id_cols
    scored = vectors.filter(F.col(vector_col).isNotNull()).withColumn("score", vector_score(cosine(F.col(vector_col), literal(query))))
    return scored.orderBy(F.desc("score"), *(F.asc(c) for c in ids)).limit(k)


def hybrid(words: DataFrame, vectors: DataFrame, id_cols: str | list[str], ratio: float = 0.5) -> DataFrame:
    """``id_cols``, score: (1 - ratio) times the score in ``words`` plus ratio times that in ``vectors``, a missing side counting 0."""
    if not 0 <= ratio <= 1:
        raise ValueError("ratio must be between 0 and 1")
    ids = [id_cols] if isinstance(id_cols, str) else id_cols
    a = words.select(*ids, F.col("score").alias("__w"))
    b = vectors.select(*ids, F.col("score").alias("__v"))
    both = a.join(b, ids, "full")
    return both.select(*ids, ((1 - ratio) * F.coalesce("__w", F.lit(0.0)) + ratio * F.coalesce("__v", F.lit(0.0))).alias("score"))


def normalised(vector: Column) -> Column:
    """A vector of length 1; one that is all but zero has its first entry that isn't 0 made 1 or -1, a zero one stays."""

    def made(v: Column) -> Column:
        first = F.array_position(F.transform(v, lambda x: x != 0), True)
        return let(F.struct(dot(v, v).alias("q"), first.alias("f")), lambda s: F.when(s["q"] > 1e-6, let(F.sqrt(s["q"]), lambda n: F.transform(v, lambda x: x / n))).when(s["f"] > 0, F.transform(v, lambda x, i: F.when(i == s["f"] - 1, F.signum(x)).otherwise(x))).otherwise(v))

    return let(vector, made)


def _count(words: Column, word: str) -> Column:
    return F.size(F.filter(words, lambda t: t == word)).cast("double")


class Embedding(ABC):
    """What turns texts into vectors; ``generate`` is an expression, so that it stays in the JVM."""

    @abstractmethod
    def generate(self, text: Column) -> Column: ...

    @abstractmethod
    def dimension(self) -> int: ...

    def of(self, df: DataFrame, text: str) -> list[float]:
        """The vector of one text, for a search."""
        spark = df.sparkSession
        return list(spark.range(1).select(self.generate(F.lit(text)).alias("v")).first()["v"])


class TermWeights(Embedding):
    """Frequencies of a vocabulary's words times 1 + ln(1 + 10 i / n), i being the word's place, made of length 1; a text with none of them has a trace of the first."""

    def __init__(self, vocabulary: list[str], english: bool = True, dimension: int = DIMENSION) -> None:
        self.words, self.english = vocabulary[:dimension], english

    def dimension(self) -> int:
        return len(self.words)

    def weight(self, i: int) -> float:
        return 1 + math.log(1 + 10 * i / len(self.words))

    def generate(self, text: Column) -> Column:
        known = F.filter(tfidf_tokens(F.coalesce(text, F.lit("")), self.english), lambda t: t.isin(self.words))  # by a hash set
        raw = let(known, lambda tok: F.array(*(_count(tok, w) * self.weight(i) for i, w in enumerate(self.words))))
        trace = lambda v: F.when(F.exists(v, lambda x: x != 0), v).otherwise(F.transform(v, lambda x, i: F.when(i == 0, F.lit(1e-5)).otherwise(x)))
        return let(normalised(raw), trace)

    def save(self, df: DataFrame, path: str) -> None:
        """The vocabulary as lines of word, tab, weight below a line with their number."""
        lines = [f"DOCUMENT_COUNT\t{len(self.words)}", *(f"{w}\t{self.weight(i)}" for i, w in enumerate(self.words))]
        df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").coalesce(1).sortWithinPartitions("i").select("value").write.text(path)


class Demo(Embedding):
    """Counts of a dozen words, made of length 1."""

    def __init__(self, product: str = PRODUCT) -> None:
        self.words = [w or product.lower() for w in DEMO_WORDS]

    def dimension(self) -> int:
        return len(self.words)

    def generate(self, text: Column) -> Column:
        return normalised(let(plain_tokens(F.coalesce(text, F.lit(""))), lambda tok: F.array(*(_count(tok, w) for w in self.words))))


class WordVectors:
    """An embedding by a table of vectors of words (word, vector): the mean of those of a text's words. It is no expression: texts meet
    the table in a join."""

    def __init__(self, table: DataFrame) -> None:
        self.table = table

    def dimension(self) -> int:
        row = self.table.select(F.size("vector").alias("n")).first()
        return row["n"] if row else 0

    def embedded(self, docs: DataFrame, id_cols: list[str], text_col: str, name: str) -> DataFrame:
        """``docs`` with a column of vectors, null for a null text. Rows of equal ids are one text."""
        keyed = docs.withColumn("__id", F.struct(*id_cols))
        found = word_vectors_mean(keyed.filter(F.col(text_col).isNotNull()), "__id", text_col, self.table)
        return keyed.join(found.withColumnRenamed("vector", name), "__id", "left").drop("__id")

    def of(self, df: DataFrame, text: str) -> list[float]:
        one = df.sparkSession.createDataFrame([(1, text)], "__n int, __text string")
        return list(word_vectors_mean(one, "__n", "__text", self.table).first()["vector"])


def vocabulary_of(docs: DataFrame, text_col: str, size: int = DIMENSION) -> list[str]:
    """The ``size`` most frequent words, for want of a vocabulary file; ties by word."""
    words = docs.select(F.explode(tfidf_tokens(F.col(text_col))).alias("w")).groupBy("w").count()
    return [r["w"] for r in words.orderBy(F.desc("count"), "w").limit(size).collect()]


def word_vectors_mean(docs: DataFrame, id_col: str, text_col: str, vectors: DataFrame) -> DataFrame:
    """``id_col``, vector: the mean of the vectors (word, vector) of a text's words, repeats counted; zeros where none is known.

    Words and vectors meet in a join on the word, so the table of vectors may be of any size.
    """
    size = vectors.select(F.size("vector").alias("n")).first()
    width = size["n"] if size else 0
    words = docs.select(id_col, F.explode(tfidf_tokens(F.coalesce(F.col(text_col), F.lit("")))).alias("word")).groupBy(id_col, "word").count()
    known = words.join(vectors, "word").groupBy(id_col).agg(F.sum("count").alias("n"), *(F.sum(F.col("vector")[i] * F.col("count")).alias(f"v{i}") for i in range(width)))
    means = known.select(id_col, F.array(*((F.col(f"v{i}") / F.col("n")).cast("double") for i in range(width))).alias("vector"))
    zeros = F.array(*(F.lit(0.0) for _ in range(width))).cast("array<double>")
    return docs.select(id_col).join(means, id_col, "left").select(id_col, F.coalesce("vector", zeros).alias("vector"))


def similar_words(vectors: DataFrame, word: str, n: int) -> DataFrame:
    """The ``n`` words nearest to a word by cosine, itself left out: word, similarity. An unknown word has none."""
    own = vectors.filter(F.col("word") == word).select("vector").first()
    if own is None:
        return vectors.select("word", F.lit(0.0).alias("similarity")).limit(0)
    rows = vectors.filter(F.col("word") != word).select("word", cosine(F.col("vector"), literal(list(own["vector"]))).alias("similarity"))
    return rows.orderBy(F.desc("similarity"), "word").limit(n)


_REGISTRY: dict[str, type[Embedding]] = {"demo": Demo}


def register(name: str, kind: type[Embedding]) -> None:
    """Make an embedding known by name (any case)."""
    _REGISTRY[name.lower()] = kind


def embedding(name: str, *args, **kwargs) -> Embedding:
    """An embedding by its registered name, or by a dotted path to a class."""
    kind = _REGISTRY.get(name.lower())
    if kind is None and name.lower() == "tf-idf":
        kind = TermWeights
    if kind is None and "." in name:
        module, _, cls = name.rpartition(".")
        kind = getattr(importlib.import_module(module), cls)
    if kind is None:
        raise ValueError(f"no embedding [{name}]")
    return kind(*args, **kwargs)
