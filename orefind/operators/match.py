"""Searches over documents: which match, and how well, as one projection over token arrays.

The tree of a search becomes two expressions on a row, one that says whether it matches and one for its score. Term
frequencies are counted within the row, so matching shuffles nothing, and collection statistics (records, average length,
records per term) come from one aggregation with a row of a few numbers. Over a stored index the same
expressions run on the documents that its postings point to.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import replace
from functools import reduce

import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefind.functions import criteria as c
from orefind.functions import text as t
from orefind.functions.text import tokens
from orefind.sources.shared import written

K1, B = 1.2, 0.75
DEFAULT_FIELDS = ("contents", "filename")
FUZZY_TERMS = 50


def _tok(name: str) -> Column:
    return F.col(f"`__t_{name}`")


def tokenised(docs: DataFrame, fields: tuple[str, ...], language: str | None = "english") -> DataFrame:
    """``docs`` with a token array for each field, cut once a row: behind a generator, no filter or projection is merged with the cutting."""
    cut = F.explode(F.array(F.struct(*(tokens(F.col(f"`{f}`"), language).alias(f) for f in fields)))).alias("__tokens")
    return docs.select("*", cut).select("*", *(F.col(f"__tokens.`{f}`").alias(f"__t_{f}") for f in fields)).drop("__tokens")


def _any(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def _sum(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts, F.lit(0.0))


def idf(n: Column, df: Column) -> Column:
    return F.log1p((n - df + 0.5) / (df + 0.5))


def saturated(tf: Column, length: Column, average: Column, k1: float = K1, b: float = B) -> Column:
    return tf / (tf + k1 * (1 - b + b * length / average))


class Compiler:
    """Turns a tree into expressions. ``stats`` gives, for a (field, term) pair, the columns n, df and average length."""

    def __init__(self, fields: tuple[str, ...], stats, known: tuple[str, ...], language: str | None = "english") -> None:
        self.fields, self.stats, self.known, self.language = fields, stats, known, language
        self.leaves: list[tuple[str, str]] = []

    def analysed(self, text: str) -> list[str]:
        return analysed(text, self.language)

    def _of(self, name: str | None) -> tuple[str, ...]:
        return self.fields if name is None else tuple(f for f in (name,) if f in self.known)

    def _scored(self, name: str, terms: list[str], tf: Column, boost: float) -> tuple[Column, Column]:
        weight = _sum([idf(self.stats(name, t)[0], self.stats(name, t)[1]) for t in terms])
        self.leaves += [(name, t) for t in terms]
        average = self.stats(name, terms[0])[2]
        tf = tf.cast("double")
        score = boost * weight * saturated(tf, F.size(_tok(name)).cast("double"), average)
        return tf > 0, F.when(tf > 0, score).otherwise(0.0)

    def __call__(self, node: object) -> tuple[Column, Column]:
        if isinstance(node, c.All):
            return F.lit(True), F.lit(float(node.boost))
        if isinstance(node, c.Nothing):
            return F.lit(False), F.lit(0.0)
        if isinstance(node, c.Term):
            words = self.analysed(node.text)
            if not words:
                return F.lit(False), F.lit(0.0)
            if len(words) > 1:
                return self(c.Phrase(node.text, node.field, 0, node.boost))
            return self._fields(node, lambda f: self._scored(f, words, F.size(F.filter(_tok(f), lambda x: x == words[0])), node.boost))
        if isinstance(node, c.Phrase):
            words = self.analysed(node.text)
            if not words:
                return F.lit(False), F.lit(0.0)
            return self._fields(node, lambda f: self._scored(f, words, phrase_frequency(_tok(f), words, node.slop), node.boost))
        if isinstance(node, (c.Pattern, c.Range)):
            return self._fields(node, lambda f: self._constant(F.exists(_tok(f), lambda x: holds(x, node)), node.boost))
        if isinstance(node, c.Bool):
            return self._bool(node)
        raise TypeError(f"{type(node).__name__} must be expanded first")

    def _constant(self, match: Column, boost: float) -> tuple[Column, Column]:
        return match, F.when(match, F.lit(float(boost))).otherwise(0.0)

    def _fields(self, node, leaf) -> tuple[Column, Column]:
        parts = [leaf(f) for f in self._of(node.field)]
        return _any([m for m, _ in parts]), _sum([s for _, s in parts])

    def _bool(self, node: c.Bool) -> tuple[Column, Column]:
        parts = [(role, *self(inner)) for role, inner in node.clauses]
        must = [m for role, m, _ in parts if role == c.MUST]
        should = [m for role, m, _ in parts if role == c.SHOULD]
        match = reduce(lambda a, b: a & b, must) if must else _any(should)
        for role, m, _ in parts:
            if role == c.MUST_NOT:
                match = match & ~m
        return match, F.when(match, node.boost * _sum([s for role, _, s in parts if role != c.MUST_NOT])).otherwise(0.0)


def holds(token: Column, node: c.Pattern | c.Range) -> Column:
    """Whether a token fits a pattern or lies in a range."""
    if isinstance(node, c.Pattern):
        return F.startswith(token, F.lit(node.prefix)) if node.prefix else token.rlike(f"^(?:{node.regex})$")
    low = F.lit(True) if node.low is None else (token >= node.low if node.closed_low else token > node.low)
    high = F.lit(True) if node.high is None else (token <= node.high if node.closed_high else token < node.high)
    return low & high


def phrase_frequency(tok: Column, words: list[str], slop: int = 0) -> Column:
    """How often the words follow each other; with ``slop``, with up to so many other words between them, in order."""
    if slop == 0:
        places = F.sequence(F.lit(1), F.greatest(F.size(tok) - len(words) + 1, F.lit(1)))
        return F.size(F.filter(places, lambda i: reduce(lambda a, b: a & b, [F.get(tok, i - 1 + k) == w for k, w in enumerate(words)])))
    places = F.sequence(F.lit(1), F.greatest(F.size(tok), F.lit(1)))

    def near(i: Column) -> Column:
        at, ok = i - 1, F.get(tok, i - 1) == words[0]
        for w in words[1:]:
            rest = F.slice(tok, at + 2, slop + 1)
            step = F.array_position(rest, w)
            ok, at = ok & (step > 0), (at + step).cast("int")
        return F.coalesce(ok & (at - (i - 1) <= slop + len(words) - 1), F.lit(False))

    return F.size(F.filter(places, near))


_TOKEN = regex.compile(t.TOKEN)
_CJK = regex.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]{2,}")


def analysed(text: str, language: str | None = "english") -> list[str]:
    """The tokens of a few words of a search, cut by the expression that cuts the documents."""
    name = t.check_language(language)
    found = _TOKEN.findall(text.lower())
    if name in ("japanese", "korean"):
        return [p for w in found for p in ([w[i : i + 2] for i in range(len(w) - 1)] if _CJK.fullmatch(w) else [w])]
    found = [w for w in found if w not in t.STOPS.get(name, ())]
    if name in t.STEMS:
        return [_stem(w, t.STEMS[name]) for w in found]
    return found


def _stem(word: str, pattern: str) -> str:
    return re.sub(pattern, "", word)


def _swapped(word: str) -> list[str]:
    """A word with each two neighbours in turn exchanged."""
    return [w for i in range(len(word) - 1) if (w := word[:i] + word[i + 1] + word[i] + word[i + 2 :]) != word]


def edits(term: Column, word: str) -> Column:
    """Insertions, deletions, replacements and exchanges of neighbours (up to two of these) between a term and a word."""
    once = _swapped(word)
    twice = sorted({w for x in once for w in _swapped(x)} - {word, *once})
    plain = [F.levenshtein(term, F.lit(word)), *(F.levenshtein(term, F.lit(w)) + 1 for w in once)]
    if twice:
        plain.append(F.when(term.isin(twice), 2).otherwise(len(word)))
    return F.least(*plain) if len(plain) > 1 else plain[0]


def expanded(node: object, docs: DataFrame, fields: tuple[str, ...], dictionary: DataFrame | None = None) -> object:
    """The tree with each fuzzy term replaced by the at most FUZZY_TERMS nearest terms that occur, boosted by nearness. Reads the terms once for each."""
    if isinstance(node, c.Bool):
        return replace(node, clauses=tuple((role, expanded(inner, docs, fields, dictionary)) for role, inner in node.clauses))
    if not isinstance(node, c.Fuzzy):
        return node
    word = node.text
    own = [node.field] if node.field else list(fields)
    if dictionary is not None:
        terms = dictionary.filter(F.col("field").isin(own)).select("term")
    else:
        terms = docs.select(F.explode(F.array_distinct(F.flatten(F.array(*(_tok(f) for f in own))))).alias("term"))
    near = terms.filter(F.abs(F.length("term") - len(word)) <= node.edits).distinct().withColumn("d", edits(F.col("term"), word)).filter(F.col("d") <= node.edits)
    top = near.orderBy("d", "term").limit(FUZZY_TERMS).collect()
    clauses = tuple((c.SHOULD, c.Term(r["term"], node.field, node.boost * (1 - r["d"] / max(1, min(len(word), len(r["term"])))))) for r in top)
    return c.Bool(clauses) if clauses else c.Nothing()


def ranked(docs: DataFrame, tree: object, fields: tuple[str, ...] = DEFAULT_FIELDS, known: tuple[str, ...] | None = None, language: str | None = "english", query_language: str | None = None, dictionary: DataFrame | None = None, statistics=None) -> DataFrame:
    """``docs`` that match, with a column score (double). ``docs`` need the fields as strings; null fields are empty ones.

    Fields that a search names must be among ``known`` (all string columns unless given), or that part matches nothing.
    Over a stored index, ``dictionary`` (field, term) and ``statistics`` (from (field, term) pairs to n, df and average length) spare reading all documents.
    """
    names = known or tuple(k for k, t in docs.dtypes if t == "string")
    fields = tuple(f for f in fields if f in names)
    asked = _named(tree)
    used = tuple(dict.fromkeys([*fields, *(f for f in asked if f in names)]))
    if isinstance(tree, (c.All, c.Nothing)):
        return docs.filter(F.lit(isinstance(tree, c.All))).withColumn("score", F.lit(float(tree.boost)))
    toks = tokenised(docs, used, language)
    tree = expanded(tree, toks, fields, dictionary)
    placeholder = (F.lit(1.0), F.lit(1.0), F.lit(1.0))
    probe = Compiler(fields, lambda f, t: placeholder, names, query_language or language)
    probe(tree)
    leaves = list(dict.fromkeys(probe.leaves))
    stat = {f: i for i, f in enumerate(dict.fromkeys(f for f, _ in leaves))}
    if leaves and statistics is not None:
        numbers = statistics(leaves)
    elif leaves:
        aggs = []
        for f, i in stat.items():
            aggs += [F.count(F.when(F.size(_tok(f)) > 0, 1)).cast("double").alias(f"n{i}"), F.coalesce(F.sum(F.size(_tok(f))), F.lit(0)).cast("double").alias(f"w{i}")]
        aggs += [F.count(F.when(F.array_contains(_tok(f), t), 1)).cast("double").alias(f"d{k}") for k, (f, t) in enumerate(leaves)]
        row = toks.agg(*aggs).first()  # one row of two numbers a field and one a term
        numbers = {(f, t): (row[f"n{stat[f]}"], row[f"d{k}"], row[f"w{stat[f]}"] / max(1.0, row[f"n{stat[f]}"])) for k, (f, t) in enumerate(leaves)}
    else:
        numbers = {}
    compiled = Compiler(fields, lambda f, t: tuple(F.lit(x) for x in numbers[f, t]), names, query_language or language)
    match, score = compiled(tree)
    return toks.filter(match).withColumn("score", score.cast("double")).drop(*(f"__t_{f}" for f in used))


def pointed_to(node: object, language: str | None = "english") -> Column | None:
    """A condition on postings (field, term) that holds for at least one posting of each record that can match; null where every record
    must be read. Of clauses that all must hold, and of the words of a phrase, one is enough: the longest word, which tends to be rare."""
    if isinstance(node, c.Bool):
        must = [inner for role, inner in node.clauses if role == c.MUST]
        if must:
            found = sorted(((_longest(inner, language), p) for inner in must if (p := pointed_to(inner, language)) is not None), key=lambda x: -x[0])
            return found[0][1] if found else None
        parts = [pointed_to(inner, language) for role, inner in node.clauses if role != c.MUST_NOT]
        return _any(parts) if parts and all(p is not None for p in parts) else None if parts else F.lit(False)
    if isinstance(node, (c.Term, c.Phrase)):
        words = analysed(node.text, language)
        return F.col("term") == max(words, key=len) if words else F.lit(False)
    if isinstance(node, (c.Pattern, c.Range)):
        return holds(F.col("term"), node)
    return F.lit(False) if isinstance(node, c.Nothing) else None


def _longest(node: object, language: str | None) -> int:
    """How long a word each record that matches has for certain; 0 if none is known."""
    if isinstance(node, (c.Term, c.Phrase)):
        return max(map(len, analysed(node.text, language)), default=0)
    return 0


def named_fields(node: object) -> set[str]:
    return set(_named(node))


def _named(node: object) -> list[str]:
    if isinstance(node, c.Bool):
        return [f for _, inner in node.clauses for f in _named(inner)]
    name = getattr(node, "field", None)
    return [name] if name else []


def top(scored: DataFrame, id_col: str, n: int | None, offset: int = 0) -> DataFrame:
    """The rows from ``offset`` on, at most ``n`` of them, best score first; ties by id."""
    rows = scored.orderBy(F.desc("score"), F.asc(id_col))
    if offset:
        rows = rows.offset(offset)
    return rows if n is None else rows.limit(n)


def with_rank(rows: DataFrame, order: Iterable[Column], first: int = 1) -> DataFrame:
    """All rows with their rank in an order, from ``first``. Rows are ranged over partitions by the order and numbered within, and what
    lies before a partition is added: no task has more than its part. What reaches the driver is a row a partition."""
    order = list(order)
    rows = written(rows, "found")  # ranges are drawn from a sample: what finds the rows runs once
    placed = written(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranked")
    before, starts = first - 1, []
    for r in placed.groupBy("__part").agg(F.count("*").alias("n")).orderBy("__part").collect():
        starts.append((r["__part"], before))
        before += r["n"]
    known = rows.sparkSession.createDataFrame(starts, "__part int, __before bigint")
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return placed.withColumn("__own", own).join(F.broadcast(known), "__part").withColumn("rank", F.col("__own") + F.col("__before")).drop("__part", "__own", "__before")
