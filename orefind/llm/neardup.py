"""Records that share most of their words, in any order, found exactly by T-occurrence search.

A record is a bag of words, held as a set of elements (word, how often it has occurred so far). Two records of n and m
elements are similar if they share T = ceil(t (n + m) / (1 + t)) or more. Their elements have inverted lists, and
DivideSkip parts a record's lists by length: the L = T - MET longest are left out of the merge, the short ones are merged
in one sorted shuffle by element. A record that shares T elements is met in at least MET of the short lists, so meetings
are counted, pair by pair, and those that reach MET, and that size, place in the lists and a sketch of word counts do not
rule out, are candidates. The long lists are kept the other way round, by record and sorted, so that a candidate is
looked up in all of a record's long lists by binary search in one row; pairs that reach T are checked word for word.

Two records of a list are compared by their sketches, as many comparisons as the square of the list's length: words that a
subject has in common make long lists however large the table is. Lists of many pairs are compared in blocks, a row of
records against a column, so that a comparison is a few machine instructions; the others list after list at once.

Records with the same bag of words are one class from the start, so copies meet in no list. A list of more than ``HOT``
records is cut into a grid: a record is indexed in one row of cells and looks others up in one column, so each two meet in
one cell, and no cell has more than about 2 HOT entries.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefind.sources.shared import written

# Lists of elements in more than this share of all records are long for certain, and counted each by itself: of records of n
# elements on average there are at most HEAVY n. The lengths of others are estimated by the smaller of two counts in tables of BUCKETS
# entries; they only choose the order of lists, which is the same for all records.
HEAVY = 2048
BUCKETS = 1 << 20
# Meetings in short lists that make a candidate.
MET = 2
# Records in one row or column of a list's grid.
HOT = 250_000
# Entries of lists in one partition.
PARTITION = 400_000
_PAIRS = 1 << 20
# Pairs of a list from which on it is compared in blocks, and the records of a block's row and column.
DENSE = 1 << 22
_ROW, _COLUMN = 128, 1024
# Whether a record has an odd number of elements in each of 512 buckets, a bit a bucket; of records of less than WIDE elements, for which
# that is enough, in each of 256, and the other four words are 0. Each element that one of two records lacks changes one bit, so
# the bits in which they differ are a lower bound of how far their elements are. The first half XOR the second has 256 buckets for all.
WIDE = 330
_SKETCH = tuple(f"s{i}" for i in range(8))
_KINDS = ", ".join(f"{c} bigint" for c in _SKETCH)
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def words_of(text: str) -> list[str]:
    """The lower-cased words of a text, as spaces, tabs, carriage returns and line feeds part them."""
    return [w for w in text.lower().replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]


def _elements(texts: list[str | None], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts of at least ``least`` words: their places, sizes, and hashes of all their elements, text after text."""
    rows, sizes, words = [], [], []
    for i, t in enumerate(texts):
        if t is not None and len(w := words_of(t)) >= least:
            rows.append(i)
            sizes.append(len(w))
            words += w
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    sizes = np.array(sizes, dtype=np.int64)
    if not len(words):
        return np.array(rows, dtype=np.int64), sizes, np.empty(0, _U)
    of_word = pd.util.hash_array(distinct.astype(object), categorize=False)
    key = np.repeat(np.arange(len(rows)), sizes) * len(distinct) + codes
    key.sort()
    new = np.concatenate(([True], key[1:] != key[:-1]))
    at = np.arange(len(key))
    seen = at - np.maximum.accumulate(np.where(new, at, 0))
    word = of_word[key % len(distinct)]
    with np.errstate(over="ignore"):
        return np.array(rows, dtype=np.int64), sizes, _mixed(word + seen.astype(_U) * _U(0x9E3779B97F4A7C15))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class Lengths:
    """The lengths of lists by element: exact for heavy ones, estimated from above for others; and how many records and elements there are."""

    def __init__(self, heavy: np.ndarray, exact: np.ndarray, tables: np.ndarray, records: int, elements: int) -> None:
        order = np.argsort(heavy)
        self.heavy, self.exact, self.tables, self.records, self.elements = heavy[order], exact[order], tables, records, elements

    def __call__(self, element: np.ndarray) -> np.ndarray:
        found = np.minimum(*(self.tables[k][at] for k, at in enumerate(_places(element)))).astype(np.int64)
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, element), len(self.heavy) - 1)
            found = np.where(self.heavy[at] == element, self.exact[at], found)
        return found


def _places(element: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (element % _U(BUCKETS)).astype(np.int64), ((element >> _U(32)) % _U(BUCKETS)).astype(np.int64)


def _element_counts(least: int):
    """Elements of a task's records, and in how many of them each is; the row of element null has the records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts, records = np.empty(0, _U), np.empty(0, np.int64), 0
        parts: list[np.ndarray] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            fresh = np.sort(np.concatenate(parts))
            starts = np.flatnonzero(np.concatenate(([True], fresh[1:] != fresh[:-1])))
            both, weight = np.concatenate((seen, fresh[starts])), np.concatenate((counts, np.diff(np.append(starts, len(fresh)))))
            order = np.argsort(both)
            both, weight = both[order], weight[order]
            starts = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
            return both[starts], np.add.reduceat(weight, starts)

        for batch in _slices(batches):
            rows, _, element = _elements(batch.column(0).to_pylist(), least)
            records += len(rows)
            parts.append(element)
            size += len(element)
            if size > 1 << 21:
                seen, counts = merged()
                parts, size = [], 0
            if len(seen) > 1 << 21:
                yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(counts)], ["element", "n"])
                seen, counts = np.empty(0, _U), np.empty(0, np.int64)
        if size:
            seen, counts = merged()
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(counts)], ["element", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([records])], ["element", "n"])

    return run


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        element, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        for table, at in zip(tables, _places(element.view(_U)), strict=True):
            table += np.bincount(at, n, BUCKETS).astype(np.int64)
    some = np.flatnonzero(tables.any(0))
    for at in range(0, len(some), 1 << 16):
        part = some[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(tables[0][part]), pa.array(tables[1][part])], ["bucket", "x", "y"])


def list_lengths(texts: DataFrame, least: int) -> Lengths:
    """The lengths of the lists of all elements, as a table of bounded size: HEAVY times a record's mean size, and two of BUCKETS."""
    counts = written(texts.select("text").mapInArrow(_element_counts(least), "element bigint, n bigint").groupBy("element").agg(F.sum("n").alias("n")), "elements")
    of = counts.groupBy(F.col("element").isNull().alias("whole")).agg(F.sum("n").alias("n")).collect()
    records, elements = (next((r["n"] for r in of if r["whole"] == w), 0) for w in (True, False))
    known = counts.filter("element is not null")
    heavy = known.filter(F.col("n") * HEAVY > records).filter("n > 1").toArrow()
    light = known.filter((F.col("n") * HEAVY <= records) | (F.col("n") <= 1)).mapInArrow(_tables, "bucket int, x bigint, y bigint").groupBy("bucket").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).toArrow()
    tables = np.zeros((2, BUCKETS), np.uint32)
    for k in range(2):
        tables[k][light.column(0).to_numpy()] = np.minimum(light.column(k + 1).to_numpy(), (1 << 32) - 1)
    return Lengths(heavy.column(0).to_numpy().view(_U), heavy.column(1).to_numpy(), tables, records, elements)


def _by_length(owner: np.ndarray, length: np.ndarray, element: np.ndarray) -> np.ndarray:
    """The order of elements by owner (less than 1024), length and element."""
    key = (owner.astype(_U) << _U(54)) | (np.minimum(length, (1 << 32) - 1).astype(_U) << _U(22)) | (element >> _U(42))
    order = np.argsort(key)
    ordered = key[order]
    if (ordered[1:] == ordered[:-1]).any():  # not told apart by that much of the element
        return np.lexsort((element, length, owner))
    return order


def _records(least: int, num: int, den: int, lengths):
    """One row a record: id, its bag's two fingerprints, n, its short lists in order of length, its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_of, met = lengths.value, set()
        for batch in _slices(batches):
            rows, sizes, element = _elements(batch.column(1).to_pylist(), least)
            count, owner = len(rows), np.repeat(np.arange(len(rows)), sizes)
            starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            if not count:
                continue
            with np.errstate(over="ignore"):
                prints = [np.add.reduceat(_mixed(element ^ _U(s)), starts).view(np.int64) for s in (0x51ED270B, 0xA24BAED4963EE407)]
            odd = (np.bincount(owner * 512 + (element >> _U(55)).astype(np.int64), minlength=count * 512) & 1).astype(np.uint8).reshape(count, 512)
            narrow = sizes < WIDE
            odd[narrow, :256] ^= odd[narrow, 256:]
            odd[narrow, 256:] = 0
            sketch = np.packbits(odd, axis=1).view(np.int64)
            order = _by_length(owner, length_of(element), element)
            place = np.arange(len(order)) - np.repeat(starts, sizes)
            short = place < np.repeat(sizes - (num * sizes + den - 1) // den + MET, sizes)
            first = np.array([p not in met and not met.add(p) for p in zip(prints[0].tolist(), prints[1].tolist(), strict=True)])
            short &= np.repeat(first, sizes)
            offsets = np.concatenate(([0], np.cumsum(np.bincount(owner[short], minlength=count)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(element[order][short].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(prints[0]), pa.array(prints[1]), pa.array(sizes), lists, pa.array(first), *(pa.array(sketch[:, i]) for i in range(len(_SKETCH)))],
                ["id", "p1", "p2", "n", "lists", "first", *_SKETCH],
            )

    return run


def _listed(num: int, den: int, lengths):
    """A row for each record and short list: the list (and block), size, place and role packed to sort by size, record, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_of = lengths.value
        for batch in _slices(batches, 5000):
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            element = lists.flatten().to_numpy(zero_copy_only=False).view(_U)
            if not len(element):
                continue
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(_U)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            n = batch.column(1).to_numpy(zero_copy_only=False)[owner]
            length = length_of(element)
            # twice the overlap that equal sizes need
            indexed = place < n - (2 * num * n + num + den - 1) // (num + den) + MET
            edge = -(-length // HOT)
            role = np.where(indexed, 3, 2)
            some = np.flatnonzero((length > 1) & (edge == 1))
            hot = np.flatnonzero(edge > 1)
            own = (_mixed(prints[owner[hot]]) % np.maximum(1, edge[hot]).astype(_U)).astype(np.int64)

            def cells(of: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                """Each of ``of`` once for every other coordinate."""
                times = edge[of]
                other = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                return np.repeat(of, times), np.repeat(mine, times), other

            put, row, column = cells(hot[indexed[hot]], own[indexed[hot]])
            asked, of_column, of_row = cells(hot, own)
            at = np.concatenate((some, put, asked))
            salt = np.concatenate((np.zeros(len(some), np.int64), row * (1 << 31) + column + 1, of_row * (1 << 31) + of_column + 1)).astype(_U)
            role = np.concatenate((role[some], np.ones(len(put), np.int64), np.full(len(asked), 2)))
            with np.errstate(over="ignore"):
                key = np.where(salt > 0, _mixed(element[at] + _mixed(salt)), element[at]).view(np.int64)
            who = pa.array(owner[at])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array((n[at] << 32) | (place[at] << 2) | role), batch.column(0).take(who), *(batch.column(3 + i).take(who) for i in range(len(_SKETCH)))], ["list", "entry", "id", *_SKETCH])

    return run


def _met(num: int, den: int):
    """Merges the lists of a partition, sorted by list and size, into pairs and how often they met; ``least`` is how often a pair must meet."""

    def merge(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, entry, who, *sketches = rows
        group = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        n, place, role = entry >> 32, (entry >> 2) & 0x3FFFFFFF, entry & 3
        index, probe = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
        at = (group[index] << 32) + n[index]
        low = np.searchsorted(at, (group[probe] << 32) + (num * n[probe] + den - 1) // den)
        # a pair's first MET meetings leave enough behind them in both records: what is left of one, less its own part of the overlap
        left = (n - place + MET - 1) * (num + den) - num * n
        most = np.minimum(n[probe], np.maximum(left[probe] // num, 0))
        many = np.maximum(np.searchsorted(at, (group[probe] << 32) + most, "right") - low, 0)
        sketches = [x.view(_U) for x in sketches]
        half = len(sketches) // 2
        folded = [x ^ y for x, y in zip(sketches[:half], sketches[half:], strict=True)]
        quarter = [x ^ y for x, y in zip(folded[: half // 2], folded[half // 2 :], strict=True)]

        def similar(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Those of the pairs of entries that may be similar."""
            keep = np.flatnonzero(left[a] >= num * n[b])
            a, b = a[keep], b[keep]
            keep = np.flatnonzero((n[a] < n[b]) | ((n[a] == n[b]) & (who[a] < who[b])))  # of records of one size, the smaller id is looked up
            a, b = a[keep], b[keep]
            whole = n[a] + n[b] - 2 * ((num * (n[a] + n[b]) + num + den - 1) // (num + den))
            for words, wide in ((folded, False), (sketches, True)):
                spare = whole
                if wide:
                    spare = np.where(n[a] >= WIDE, whole, 64 * len(words))
                for x in words:  # most are out after the second
                    spare = spare - np.bitwise_count(x[a] ^ x[b])
                    keep = np.flatnonzero(spare >= 0)
                    a, b, spare, whole = a[keep], b[keep], spare[keep], whole[keep]
            return a, b

        def counted(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            x, y, least = who[a], who[b], np.minimum(MET, (num * (n[a] + n[b]) + num + den - 1) // (num + den))
            order = np.lexsort((y, x))
            x, y, least = x[order], y[order], least[order]
            starts = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]))))
            return pa.RecordBatch.from_arrays([pa.array(x[starts]), pa.array(y[starts]), pa.array(np.diff(np.append(starts, len(x)))), pa.array(least[starts])], ["a", "b", "met", "least"])

        def dense(own: np.ndarray, others: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Pairs of ``own``, places in probe, with ``others``, places in index, each block's compared at once. Both are in order of size."""
            bits, ones, total = (np.empty(_ROW * _COLUMN, kind) for kind in (_U, np.uint8, np.uint16))
            sizes, first = n[index[others]], others[0]
            edge = int(np.searchsorted(sizes, WIDE))
            # probes of one row ask for about the same sizes
            span = np.clip(8 * (most[own] * den - num * n[probe[own]]) // np.maximum(1, (den - num) * n[probe[own]]), 0, 8)
            own = own[np.argsort(span, kind="stable")]
            cuts = np.flatnonzero(np.diff(np.sort(span))) + 1
            for part in np.split(own, cuts):
                for row in (part[i : i + _ROW] for i in range(0, len(part), _ROW)):
                    b = probe[row]
                    largest = int(n[b].max())
                    low_, high = int(low[row].min()) - first, int((low[row] + many[row]).max()) - first
                    sides = [(low_, min(high, edge), folded), (max(low_, edge), high, sketches)] if int(n[b[0]]) >= WIDE else [(low_, high, folded)]
                    for begin, end, words in sides:
                        # as many words as tell records of that size apart
                        words = quarter if largest < WIDE // 2 else words[: max(half, -(-largest // 60))]
                        for i in range(begin, end, _COLUMN):
                            a = index[others[i : min(end, i + _COLUMN)]]
                            x, c, d = (v[: len(b) * len(a)].reshape(len(b), len(a)) for v in (bits, ones, total))
                            d[:] = 0
                            for w in words:
                                np.bitwise_count(np.bitwise_xor(w[b][:, None], w[a], out=x), out=c)
                                d += c
                            near = np.flatnonzero(d <= np.minimum((den - num) * (n[a] + largest) // (num + den), 1 << 15).astype(np.uint16))
                            if len(near):
                                p, q = near // len(a), near % len(a)
                                inside = np.flatnonzero((n[a[q]] * den >= num * n[b[p]]) & (n[a[q]] <= most[row[p]]))
                                yield a[q[inside]], b[p[inside]]

        of_probe, of_index = group[probe], group[index]
        whole = np.bincount(of_probe, many, minlength=1)
        large = np.flatnonzero(whole >= DENSE)
        for g in large:
            own = np.arange(*np.searchsorted(of_probe, (g, g + 1)))
            others = np.arange(*np.searchsorted(of_index, (g, g + 1)))
            for a, b in dense(own[many[own] > 0], others):
                a, b = similar(a, b)
                if len(a):
                    yield counted(a, b)
        few = np.flatnonzero(whole[of_probe] < DENSE)
        probe, low, many = probe[few], low[few], many[few]
        ends = np.cumsum(many)
        start = 0
        while start < len(probe):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _PAIRS, "right")))
            size = many[start:stop]
            b = np.repeat(probe[start:stop], size)
            a = index[np.repeat(low[start:stop], size) + np.arange(len(b)) - np.repeat(np.cumsum(size) - size, size)]
            start = stop
            a, b = similar(a, b)
            if len(a):
                yield counted(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            key = rows[0]
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            if held and (last or key[0] != held[0][0][0]):
                whole = [np.concatenate(c) for c in zip(*held, [c[:last] for c in rows], strict=True)]
                held = []
                yield from merge(whole)
            elif last:
                yield from merge([c[:last] for c in rows])
            held.append([c[last:] for c in rows])
        if held:
            yield from merge([np.concatenate(c) for c in zip(*held, strict=True)])

    return run


def _reaching(num: int, den: int):
    """Of candidate pairs with their texts, those that reach the overlap: the elements of one, those of its long lists among them, are looked
    up by binary search in the sorted row of the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            _, n, element = _elements([t for pair in zip(a, b, strict=True) for t in pair], 0)
            ends, kept = np.concatenate(([0], np.cumsum(n))), []
            for k in range(batch.num_rows):
                x, y = np.sort(element[ends[2 * k] : ends[2 * k + 1]]), element[ends[2 * k + 1] : ends[2 * k + 2]]
                found = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both, whole = int((x[found] == y).sum()), len(x) + len(y)
                if both * (num + den) >= num * whole:
                    p, q = Counter(words_of(a[k])), Counter(words_of(b[k]))
                    if den * (p & q).total() >= num * (p | q).total():
                        kept.append(k)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])

    return run


def similar_classes(df: DataFrame, id_col: str, text_col: str, least_words: int = 30, similarity: tuple[int, int] = (4, 5)) -> tuple[DataFrame, DataFrame]:
    """Classes of records with the same words, and all pairs of classes whose similarity reaches ``similarity``.

    Returns members (id, class) and links (a, b), a < b, both class numbers; a class bears its smallest id. Similarity is
    the words two records share over all words of both, as bags. Records with a null text or fewer than ``least_words``
    words are in no class. Ids must be whole numbers and unique; columns of ``df`` besides the two are not used. All
    links are found, for any order of words; nothing is capped. An empty table gives empty results.
    """
    num, den = similarity
    spark = df.sparkSession
    texts = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    of_lists = list_lengths(texts, least_words)
    lengths = spark.sparkContext.broadcast(of_lists)
    records = written(texts.mapInArrow(_records(least_words, num, den, lengths), f"id bigint, p1 bigint, p2 bigint, n bigint, lists array<bigint>, first boolean, {_KINDS}"), "records")
    # the class is named by its smallest id, and looked up by the smallest of those that carry its lists
    by_print = records.groupBy("p1", "p2").agg(F.min("id").alias("class"), F.min(F.when(F.col("first"), F.col("id"))).alias("speaker"))
    by_print = written(by_print, "classes")
    members = records.select("id", "p1", "p2").join(by_print.select("p1", "p2", "class"), ["p1", "p2"]).select("id", "class")
    # copies met in different parts of the table: few, and all but one are silent
    silent = records.filter("first").select("id", "p1", "p2").join(by_print.select("p1", "p2", "speaker"), ["p1", "p2"]).filter("id <> speaker").select("id")
    speakers = records.filter("first").select("id", "n", "lists", *_SKETCH).join(silent, "id", "left_anti")
    listed = speakers.mapInArrow(_listed(num, den, lengths), f"list bigint, entry bigint, id bigint, {_KINDS}")
    # as many partitions as keep the entries of each, about PARTITION of them, in a task's memory
    entries = of_lists.elements * (den - num) // den + MET * of_lists.records
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // PARTITION))
    met = listed.repartition(parts, "list").sortWithinPartitions("list", "entry").mapInArrow(_met(num, den), "a bigint, b bigint, met bigint, least bigint")
    met = met.groupBy("a", "b").agg(F.sum("met").alias("met"), F.max("least").alias("least")).filter("met >= least").select("a", "b")
    met = written(met, "candidates")
    asked = met.select(F.col("a").alias("id")).union(met.select("b")).distinct()
    asked_texts = written(texts.join(asked, "id", "left_semi"), "texts")
    pairs = met.join(asked_texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a").join(asked_texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b")
    links = pairs.select("a", "b", "text_a", "text_b").mapInArrow(_reaching(num, den), "a bigint, b bigint")
    name = by_print.select("speaker", "class")
    links = links.join(name.withColumnsRenamed({"speaker": "a", "class": "ca"}), "a").join(name.withColumnsRenamed({"speaker": "b", "class": "cb"}), "b")
    return members, links.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))


def similar_pairs(members: DataFrame, links: DataFrame, block: int = 1000) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every pair of records of one class or of linked classes.

    That many pairs is what is asked for here; ``groups`` is the form for large data. Members of a class are put into blocks of about
    ``block``, and blocks are paired, so no task has the pairs of a large class.
    """
    sizes = members.groupBy("class").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = members.join(sizes, "class").select("id", "class", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "blocks")
    copies = members.groupBy("class").count().filter("count > 1").select("class")
    copied = placed.join(copies, "class", "left_semi")
    x = copied.select(F.col("id").alias("x"), "class", F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"))
    y = copied.select(F.col("id").alias("y"), "class", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"), F.col("block").alias("j"))
    within = x.join(y, ["class", "i", "j"]).filter("i < j or x < y").select("x", "y")
    paired = links.join(sizes.withColumnsRenamed({"class": "a", "blocks": "m"}), "a").join(sizes.withColumnsRenamed({"class": "b", "blocks": "n"}), "b")
    paired = paired.select("a", "b", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("i"), "n").select("a", "b", "i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"))
    own = lambda who, cls, at: placed.select(F.col("id").alias(who), F.col("class").alias(cls), F.col("block").alias(at))
    across = paired.join(own("x", "a", "i"), ["a", "i"]).join(own("y", "b", "j"), ["b", "j"]).select("x", "y")
    both = within.unionByName(across)
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id, class, group): records that links join, directly or over others, bear the same group, the smallest class in it.

    Large-star and small-star rounds over the links, each written to the shared folder, until nothing changes; a round
    halves the longest chain. A record without links is a group with its class alone.
    """
    edges = written(links.select(F.col("b").alias("u"), F.col("a").alias("v")), "edges")
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(lowest, "u")
        new = small.select("u", F.col("m").alias("v")).union(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).filter("u <> v").distinct()
        new = written(new, "edges")
        if new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty():
            break
        edges = new
    tops = edges.groupBy(F.col("u").alias("class")).agg(F.min("v").alias("group"))
    return members.join(tops, "class", "left").select("id", "class", F.coalesce("group", "class").alias("group"))
