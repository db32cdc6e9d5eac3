"""The subject areas that a document's sentences are about.

Documents are embedded by term weighting (log frequency times inverse document frequency, over hashed terms) and truncated
singular value decomposition, found by a randomized range finder whose passes sum over all documents. Each sentence is
placed in the same space. Labelled documents give a seed centroid for each subject and language, and for sentences about
no subject; the centroids are refined by assigning all sentences of the corpus by cosine similarity, again and again. A
document has the subjects that a stated share of its sentences are nearest to.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefind.sources.shared import written

# Parameters whose size bounds what the driver and executors hold: hashed terms (at most 1 << 16), dimensions, labelled documents that seeds are made of.
TERMS = 1 << 14
DIMENSIONS = 64
SEEDS = 20_000
NO_SUBJECT = "none"
_WORD = re.compile(r"[^\W\d_]{2,}")
_SENTENCE = re.compile(r"(?<=[.?!…])[\"'”»)\]]*\s+|(?<=[。！？])(?![。！？」』”）])|(?<=[。！？][」』”）])|[\r\n]+")
# The same for texts without CJK full stops, which is found faster: behind the sign, what closes and the blanks.
_CUT = re.compile(r"([.?!…])[\"'”»)\]]*\s+|[\r\n]+")
_CJK_STOP = re.compile("[。！？]")
_CLOSED = re.compile(r"[.?!…。！？][\"'”»)\]」』）]*$")
_CJK = re.compile("[\u3040-\u30ff\u4e00-\u9fff]")
# Most words of a heading; two CJK characters count as one.
HEADING = 10


def _pieces(text: str) -> Iterator[tuple[str, bool]]:
    """The pieces of a text, and whether each is known to end a sentence."""
    if _CJK_STOP.search(text):
        for s in _SENTENCE.split(text):
            yield s, False
        return
    start = 0
    for m in _CUT.finditer(text):
        closed = m.start(1) >= 0
        yield text[start : m.start() + closed], closed
        start = m.end()
    yield text[start:], False


def _parted(text: str | None) -> tuple[list[tuple[str, list[str]]], list[tuple[str, list[str]]]]:
    """The sentences of a text, and its headings, each with its words in lower case."""
    sentences, headings, parts = [], [], []
    for s, closed in _pieces(text or ""):
        if words := _WORD.findall(s.lower()):
            whole = closed or _CLOSED.search(s.rstrip()) or len(words) + (0 if s.isascii() else len(_CJK.findall(s)) // 2) > HEADING
            parts.append((s, words))
            (sentences if whole else headings).append(parts[-1])
    return (sentences, headings) if len(headings) <= len(sentences) else (parts, [])


def sentences_of(text: str | None) -> list[str]:
    """The sentences of a text: what ends with a full stop, question or exclamation mark, or is longer than a heading. Where
    headings would be more than half of a text's pieces they are no headings, and all pieces count."""
    return [s for s, _ in _parted(text)[0]]


def _hashed(texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
    """Of each text the hashed words of its sentences, one after another, then of its headings; and where each sentence ends."""
    found, words, counts = [], [], []
    for t in texts:
        sentences, headings = _parted(t)
        found.append([len(w) for _, w in sentences])
        flat = [w for _, x in sentences for w in x] + [w for _, x in headings for w in x]
        counts.append(len(flat))
        words += flat
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    ids = (pd.util.hash_array(distinct.astype(object), categorize=False) % np.uint64(TERMS)).astype(np.int32)[codes] if len(words) else np.empty(0, np.int32)
    cuts = np.cumsum([0, *counts])
    return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], [np.cumsum(x, dtype=np.int32) if x else np.empty(0, np.int32) for x in found]


def _packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Numbers of rows one behind another, ``sizes`` of each, as bytes: a column that nothing between two Python passes has to take apart."""
    offsets = np.concatenate(([0], np.cumsum(sizes))) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _rows(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a packed column, and the row of each."""
    if not len(column):
        return np.empty(0, kind), np.empty(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind) if data is not None and offsets[-1] > offsets[0] else np.empty(0, kind)
    return values, np.repeat(np.arange(len(column)), np.diff(offsets) // np.dtype(kind).itemsize)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches, 2000):
        ids, ends = _hashed(batch.column(1).to_pylist())
        pack = lambda rows, kind: _packed(np.concatenate([*rows, np.empty(0, kind)]).astype(kind), np.array([len(x) for x in rows], np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), pack(ids, np.uint16), pack(ends, np.int32)], ["id", "terms", "ends"])


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _weighted(owner: np.ndarray, term: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, term and weight of each term of an owner, weights of an owner of length 1."""
    key, count = np.unique(owner.astype(np.int64) * TERMS + term, return_counts=True)
    owner, term = key // TERMS, (key % TERMS).astype(np.uint16)
    weight = (1 + np.log(count)) * idf[term]
    length = np.sqrt(np.bincount(owner, weight * weight))
    return owner, term, (weight / np.maximum(length[owner], 1e-12)).astype(np.float32)


def _weights_of(weights):
    """Of rows (id, terms, ends) the sparse rows that all passes read: the document's terms and weights, and those of its sentences one
    behind the other, with the number of each sentence's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = weights.value
        for batch in _slices(batches, 2000):
            term, row = _rows(batch.column(1), np.uint16)
            end, doc = _rows(batch.column(2), np.int32)
            owner, of, weight = _weighted(row, term, idf)
            starts = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=batch.num_rows))))
            sentence = np.searchsorted(end + starts[doc], np.arange(len(term)), "right")
            inside = (sentence < len(end)) & (doc[np.minimum(sentence, len(end) - 1)] == row)  # words of headings lie behind a row's last sentence
            s_owner, s_of, s_weight = _weighted(sentence[inside], term[inside], idf)
            s_row, size = doc[s_owner], np.bincount(s_owner, minlength=len(end)).astype(np.int32)
            by = lambda rows: np.bincount(rows, minlength=batch.num_rows)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([batch.column(0), _packed(of, by(owner)), _packed(weight, by(owner)), _packed(s_of, by(s_row)), _packed(s_weight, by(s_row)), _packed(size, by(doc))], ["id", "terms", "weights", "s_terms", "s_weights", "s_sizes"])

    return run


_ROWS = "terms binary, weights binary, s_terms binary, s_weights binary, s_sizes binary"


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        term, owner = _rows(batch.column(0), np.uint16)
        seen = np.bincount(np.unique(owner.astype(np.int64) * TERMS + term) % TERMS, minlength=TERMS) if len(term) else np.zeros(TERMS, int)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([*some, -1], pa.int32()), pa.array([*seen[some], batch.num_rows], pa.int64())], ["term", "n"])


def _summed(df: DataFrame, by: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums by ``by`` (a number below TERMS) of columns c0, c1 ...: a table of bounded size."""
    table = df.groupBy(by).agg(*(F.sum(f"c{i}").alias(f"c{i}") for i in range(width))).toArrow()
    return table.column(0).to_numpy(), np.stack([table.column(i + 1).to_numpy() for i in range(width)], 1) if table.num_rows else np.zeros((0, width))


def decomposed(docs: DataFrame, dimensions: int = DIMENSIONS, passes: int = 3, seed: int = 5) -> np.ndarray:
    """Terms by dimensions: the leading right singular vectors of the documents' weighted terms (terms, weights)."""
    context, width = docs.sparkSession.sparkContext, dimensions + 8
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((TERMS, width)))[0]
    for _ in range(passes):
        shared = context.broadcast(basis.astype(np.float32))

        def through(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            space, whole, at = shared.value, np.zeros((TERMS, width)), np.zeros(TERMS, np.int64)
            for rows in _slices(batches):
                term, owner = _rows(rows.column(0), np.uint16)
                if len(term):
                    met = np.zeros(TERMS, bool)
                    met[term] = True
                    local = np.flatnonzero(met)
                    at[local] = np.arange(len(local))
                    table = np.zeros((rows.num_rows, len(local)), np.float32)  # of the terms that these rows have
                    table[owner, at[term]] = _rows(rows.column(1), np.float32)[0]
                    whole[local] += table.T @ (table @ space[local])
            some = np.flatnonzero(whole.any(1))
            for first in range(0, len(some), 1024):
                part = some[first : first + 1024]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *(pa.array(whole[part, i].astype(np.float32)) for i in range(width))], ["term", *(f"c{i}" for i in range(width))])

        sums = docs.select("terms", "weights").mapInArrow(through, "term int, " + ", ".join(f"c{i} float" for i in range(width)))
        found, values = _summed(sums, "term", width)
        image = np.zeros((TERMS, width))
        image[found] = values
        shared.unpersist()
        if not len(found):
            return image[:, :dimensions]
        basis = np.linalg.qr(image)[0]
    return np.linalg.svd(image, full_matrices=False)[0][:, :dimensions]


def _sentence_places(batch: pa.RecordBatch, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with s_terms, s_weights, s_sizes the places of the sentences, of length 1 (or 0), and the row each belongs to."""
    term, _ = _rows(batch.column("s_terms"), np.uint16)
    size, doc = _rows(batch.column("s_sizes"), np.int32)
    place = np.zeros((len(size), space.shape[1]), np.float32)
    filled = np.flatnonzero(size)
    if len(filled):
        weighted = space[term]
        weighted *= _rows(batch.column("s_weights"), np.float32)[0][:, None]
        place[filled] = np.add.reduceat(weighted, (np.cumsum(size) - size)[filled], axis=0)
    return place / np.maximum(np.linalg.norm(place, axis=1), 1e-12)[:, None], doc


def _sums_by(group: np.ndarray, place: np.ndarray, count: int) -> np.ndarray:
    """The sums of places by group."""
    member = np.zeros((count, len(group)), np.float32)
    member[group, np.arange(len(group))] = 1
    return (member @ place).astype(np.float64)


def _language(name: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(name), F.lit("")), r"^\s*([A-Za-z]{2})(?![A-Za-z])", 1))


def agreed_labels(labels: DataFrame, areas: DataFrame, id_col: str) -> DataFrame:
    """``id_col`` and subject (an area or NO_SUBJECT): what most raters of a document say, each rater once; without ties, unknown and null labels."""
    known = areas.select("subject").union(areas.sparkSession.createDataFrame([(NO_SUBJECT,)], "subject string")).withColumn("k", F.lower(F.trim("subject"))).dropDuplicates(["k"])
    votes = labels.select(F.col(id_col), F.lower(F.trim("subject")).alias("k"), "rater").distinct().join(F.broadcast(known), "k").groupBy(id_col, "subject").agg(F.count("*").alias("n"))
    top = votes.groupBy(id_col).agg(F.max("n").alias("n"))
    best = votes.join(top, [id_col, "n"]).groupBy(id_col).agg(F.count("*").alias("ties"), F.first("subject").alias("subject"))
    return best.filter("ties = 1").select(id_col, "subject")


def _centroids(parts: DataFrame, width: int) -> dict[tuple[str, str], np.ndarray]:
    table = parts.groupBy("subject", "lang").agg(*(F.sum(f"c{i}").alias(f"c{i}") for i in range(width)), F.sum("n").alias("n")).toArrow().to_pylist()
    return {(r["subject"], r["lang"]): np.array([r[f"c{i}"] for i in range(width)]) for r in table if r["n"]}


def subjects(df: DataFrame, areas: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, share: tuple[int, int] = (1, 4), rounds: int = 3) -> DataFrame:
    """``id_col``, subject, sentences, all_sentences: the areas that at least ``share`` of a document's sentences are about.

    Documents about none, and null, empty and blank texts, have no row; documents of several areas one for each. Areas
    bear the spelling of ``areas``. Without usable labels there are no seeds, and no rows. Ids must be unique. At most
    SEEDS labelled documents, chosen by a hash, make seeds; terms, decomposition, refinement and assignment cover all.
    """
    spark, kind = df.sparkSession, dict(df.dtypes)[id_col]
    base = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    docs = written(base.filter("text is not null").mapInArrow(_terms, f"id {kind}, terms binary, ends binary").filter("length(ends) > 0"), "terms")
    counts = docs.select("terms").mapInArrow(_document_counts, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    at, n = counts.column(0).to_numpy(), counts.column(1).to_numpy()
    whole = int(n[at < 0].sum())
    schema = f"{id_col} {kind}, subject string, sentences bigint, all_sentences bigint"
    seen = np.zeros(TERMS)
    seen[at[at >= 0]] = n[at >= 0]
    idf = np.where(seen > 0, np.log((1 + whole) / (1 + seen)), 0.0)
    weights = spark.sparkContext.broadcast(idf)
    docs = written(docs.mapInArrow(_weights_of(weights), f"id {kind}, {_ROWS}"), "weights")
    space = decomposed(docs).astype(np.float32)
    width = space.shape[1]
    shared = spark.sparkContext.broadcast(space)
    langs = df.select(F.col(f"`{id_col}`").alias("id"), _language(f"`{lang_col}`").alias("lang"))
    seeds = docs.join(agreed_labels(labels.withColumnRenamed(id_col, "id") if id_col in labels.columns else labels, areas, "id").orderBy(F.xxhash64("id"), "id").limit(SEEDS), "id").join(langs, "id")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            place, doc = _sentence_places(batch, shared.value)
            rows = _sums_by(doc, place, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("subject"), batch.column("lang"), *(pa.array(rows[:, i]) for i in range(width)), pa.array(np.bincount(doc, minlength=batch.num_rows))], ["subject", "lang", *(f"c{i}" for i in range(width)), "n"])

    columns = "subject string, lang string, " + ", ".join(f"c{i} double" for i in range(width)) + ", n bigint"
    centroids = _centroids(seeds.select("s_terms", "s_weights", "s_sizes", "subject", "lang").mapInArrow(summed, columns), width)
    if not centroids:
        return spark.createDataFrame([], schema)
    seeded = {k: v / max(1e-12, float(np.linalg.norm(v))) for k, v in centroids.items()}

    def nearest(batch: pa.RecordBatch, names: list, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place, doc = _sentence_places(batch, shared.value)
        return place, doc, np.argmax(place @ centers.T.astype(np.float32), axis=1) if len(place) else np.zeros(0, int)

    now = dict(seeded)
    for _ in range(rounds):
        names, centers = list(now), np.stack(list(now.values()))

        def assigned(batches: Iterator[pa.RecordBatch], names=names, centers=centers) -> Iterator[pa.RecordBatch]:
            rows, met = np.zeros((len(names), width)), np.zeros(len(names), np.int64)
            for batch in _slices(batches):
                place, _, to = nearest(batch, names, centers)
                rows += _sums_by(to, place, len(names))
                met += np.bincount(to, minlength=len(names))
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in names]), pa.array([x for _, x in names]), *(pa.array(rows[:, i]) for i in range(width)), pa.array(met)], ["subject", "lang", *(f"c{i}" for i in range(width)), "n"])

        moved = _centroids(docs.select("s_terms", "s_weights", "s_sizes").mapInArrow(assigned, columns), width)
        for key, v in moved.items():
            mean = seeded[key] + 2 * v / max(1e-12, float(np.linalg.norm(v)))
            now[key] = mean / max(1e-12, float(np.linalg.norm(mean)))
    names, centers = list(now), np.stack(list(now.values()))
    spelled = sorted({s for s, _ in names if s != NO_SUBJECT})
    num, den = share

    def of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        area = np.array([spelled.index(s) if s != NO_SUBJECT else len(spelled) for s, _ in names])
        for batch in _slices(batches):
            _, doc, to = nearest(batch, names, centers)
            table = np.zeros((batch.num_rows, len(spelled) + 1), np.int64)
            np.add.at(table, (doc, area[to]), 1)
            all_of = table.sum(1)
            row, which = np.nonzero((table * den >= all_of[:, None] * num)[:, :-1] & (table[:, :-1] > 0))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), pa.array([spelled[i] for i in which], pa.string()), pa.array(table[row, which]), pa.array(all_of[row])], [id_col, "subject", "sentences", "all_sentences"])

    return docs.select("id", "s_terms", "s_weights", "s_sizes").mapInArrow(of_documents, schema)
