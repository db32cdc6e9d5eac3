"""Terms of a text column: collection counts kept by signed deltas, and how distinctive a term is of its record.

A term is a maximal run of letters and digits of any script in the lower-cased text. Texts are cut into terms in Arrow
batches, where the counts of a batch are combined before anything is shuffled, so what moves between executors is one
row per term and batch, however hot a term is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefind.sources.shared import Pointer, names_in, remove, shared_folder, written

TERM = re.compile(r"[^\W_]+")
COUNTS = "field_name string, term string, occurrences bigint, records bigint"


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        occurrences: Counter = Counter()
        records: Counter = Counter()
        rows = 0
        for sign, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text is None:
                continue
            rows += sign
            found = TERM.findall(text.lower())
            if sign == 1:
                occurrences.update(found)
                records.update(set(found))
            else:
                occurrences.subtract(found)
                records.subtract(set(found))
        terms = list(occurrences)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*terms, None], pa.string()), pa.array([*(occurrences[t] for t in terms), rows], pa.int64()), pa.array([*(records[t] for t in terms), rows], pa.int64())],
            ["term", "occurrences", "records"],
        )


def term_deltas(changes: DataFrame, text_col: str) -> DataFrame:
    """What ``changes`` do to the counts of the terms of ``text_col``: field_name, term, occurrences, records, both signed.

    ``changes`` has a column ``sign``: 1 for a record that is new, -1 for one that is gone; a changed record is its old
    row with -1 and its new one with 1. The row whose term is null has the change in the number of records with a
    non-null text. Null texts change nothing; empty texts are records without terms.
    """
    counted = changes.select(F.col("sign").cast("int"), F.col(f"`{text_col}`").cast("string")).mapInArrow(_count_batches, "term string, occurrences bigint, records bigint")
    return counted.groupBy(F.lit(text_col).alias("field_name"), "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def value_deltas(changes: DataFrame, value_col: str) -> DataFrame:
    """As term_deltas, with the whole value, lower-cased and without surrounding spaces, as the one term. Blank values are records without a term."""
    value = F.lower(F.trim(F.col(f"`{value_col}`").cast("string")))
    rows = changes.filter(F.col(f"`{value_col}`").isNotNull()).select(F.col("sign").cast("bigint").alias("sign"), F.explode(F.array_distinct(F.array(F.when(value != "", value), F.lit(None)))).alias("term"))
    return rows.groupBy(F.lit(value_col).alias("field_name"), "term").agg(F.sum("sign").alias("occurrences"), F.sum("sign").alias("records"))


class TermCounts:
    """Persistent counts of terms by field, in buckets by a hash of the term, kept up to date by signed deltas.

    A merge reads and writes only the buckets that its deltas touch: it adds them up in a new folder and then moves the
    pointer, a small file that tells the folder of each bucket, so a merge that fails leaves the counts as they were, and
    of two at once one fails. Buckets that are replaced go with the next merge, so who reads them now can finish. Counts that
    come to nothing are left out. Opened again on its folder, the counts are those of the last merge; without one they are empty. ``buckets``
    is fixed by the first merge.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64) -> None:
        self.spark, self.path = spark, path or shared_folder(spark, "term-counts")
        self.pointer = Pointer(spark, self.path, "buckets")
        self.state = self.pointer.load({"buckets": buckets, "merges": 0, "folders": {}})

    def _read(self, buckets: list[str] | None = None) -> DataFrame:
        folders = self.state["folders"]
        paths = [f"{self.path}/{f}/bucket={b}" for b, f in folders.items() if buckets is None or b in buckets]
        return self.spark.read.schema(COUNTS).parquet(*paths) if paths else self.spark.createDataFrame([], COUNTS)

    def counts(self) -> DataFrame:
        """field_name, term, occurrences, records; the row of a field with a null term has its number of records."""
        return self._read()

    def merge(self, *deltas: DataFrame) -> TermCounts:
        """Add signed deltas to the counts."""
        number = self.state["merges"] + 1
        placed = reduce(DataFrame.unionByName, deltas).withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(self.state["buckets"])).cast("int"))
        old, touched = self.state["folders"], None
        if old:  # which buckets the change touches: at most as many rows as there are buckets
            placed = written(placed, "term-deltas")
            touched = [str(r["bucket"]) for r in placed.select("bucket").distinct().collect()]
            known = self._read(touched).withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(self.state["buckets"])).cast("int"))
            placed = placed.unionByName(known)
        placed = placed.repartition("bucket")  # one file a bucket
        if old or len(deltas) > 1:
            placed = placed.groupBy("field_name", "term", "bucket").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
        new = f"m{number}"
        remove(self.spark, f"{self.path}/{new}")  # of a merge that failed
        placed.filter("records <> 0 or occurrences <> 0").write.partitionBy("bucket").parquet(f"{self.path}/{new}")
        made = {n.removeprefix("bucket=") for n in names_in(self.spark, f"{self.path}/{new}") if n.startswith("bucket=")}
        folders = {b: f for b, f in old.items() if touched is None or b not in touched} | {b: new for b in made}
        replaced = [f"{f}/bucket={b}" for b, f in old.items() if folders.get(b) != f]
        state = {"buckets": self.state["buckets"], "merges": number, "folders": folders, "replaced": replaced}
        gone = self.state.get("replaced", [])
        self.pointer.store(state)
        self.state = state
        for part in gone:
            remove(self.spark, f"{self.path}/{part}")
        return self


def marked(counts: DataFrame, rare_records: int = 1, common_share: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """``counts`` with a column mark: ``rare`` for terms of at most ``rare_records`` records, ``common`` for those of more
    than the share of the field's records given by ``common_share`` as (numerator, denominator), else null.

    A term that is both (in a tiny collection) is rare. The number of records of a field is a bounded table of one row a field.
    """
    shares = common_share or {}
    num = F.create_map(*(F.lit(x) for k, (n, _) in shares.items() for x in (k, n))) if shares else F.create_map(F.lit(""), F.lit(1))
    den = F.create_map(*(F.lit(x) for k, (_, m) in shares.items() for x in (k, m))) if shares else F.create_map(F.lit(""), F.lit(1))
    totals = counts.filter("term is null").select("field_name", F.col("records").alias("all_records"))
    rows = counts.filter("term is not null").join(F.broadcast(totals), "field_name", "left")
    common = F.col("records") * F.try_element_at(den, F.col("field_name")) > F.col("all_records") * F.try_element_at(num, F.col("field_name"))
    return rows.withColumn("mark", F.when(F.col("records") <= rare_records, "rare").when(common, "common")).drop("all_records")


def _posting_batches(min_tf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, lengths, terms, tfs = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = TERM.findall(text.lower()) if text is not None else []
                counted = Counter(found)
                if min_tf > 1:
                    counted = {t: n for t, n in counted.items() if n >= min_tf}
                sizes.append(len(counted))
                lengths.append(len(found))
                terms.extend(counted)
                tfs.extend(counted.values())
            at = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(terms, pa.string()), pa.array(tfs, pa.int64()), pa.array(np.repeat(np.array(lengths, dtype=np.int64), sizes))],
                ["__id", "term", "tf", "doc_length"],
            )

    return run


def postings(df: DataFrame, id_col: str, text_col: str, min_tf: int = 1) -> DataFrame:
    """``id_col``, term, tf, doc_length: each record and term that occurs at least ``min_tf`` times in it. doc_length counts all its terms."""
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(_posting_batches(min_tf), f"__id {kind}, term string, tf bigint, doc_length bigint").withColumnRenamed("__id", id_col)


# A term of more than one in so many records is common: of terms counted in records of n terms on average there are at most COMMON n.
COMMON = 4096


def distinctive_terms(df: DataFrame, id_col: str, text_col: str, min_tf: int = 1, records: tuple[int, int | None] = (1, None), k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """How characteristic each term is of its record: ``id_col``, term, tf, records, score.

    score is the probabilistic relevance weight ln(1 + (N - n + 0.5) / (n + 0.5)) times the saturating frequency
    tf (k1 + 1) / (tf + k1 (1 - b + b dl / avgdl)), with N records of non-null text, n of them with the term, and
    lengths in terms. N, n and avgdl are of all records. Given ``min_tf`` and ``records`` (least and most n), only such
    terms come out. Records with a null or empty text have no terms and give no row; records with equal ids are scored
    each by itself; the score ties where tf, n and length are equal. Columns of ``df`` besides the two are not used.

    Terms of more than one in COMMON records, whose postings are most of all, get their n from a broadcast table of bounded
    size and are not shuffled; no key of the join that the others meet in has more than one in COMMON of the records.
    """
    counts = written(term_deltas(df.select(F.lit(1).alias("sign"), F.col(f"`{text_col}`")), text_col), "counts")
    n_records = counts.filter("term is null").agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    n_terms = counts.filter("term is not null").agg(F.coalesce(F.sum("occurrences"), F.lit(0))).first()[0]
    least, most = records
    terms = counts.filter(F.col("term").isNotNull() & (F.col("records") >= least)).select("term", "records")
    if most is not None:
        terms = terms.filter(F.col("records") <= most)
    met = postings(df, id_col, text_col, min_tf)
    often = F.col("records") * COMMON > n_records
    if most is not None and most <= COMMON:  # no term of few records is a burden
        rows = met.join(terms, "term")
    else:
        common = counts.filter(F.col("term").isNotNull() & often).select("term", F.col("records").alias("__n"))
        looked = met.join(F.broadcast(common), "term", "left")
        if min_tf == 1:
            looked = written(looked, "postings")  # read twice
        own = looked.filter("__n is not null").withColumnRenamed("__n", "records").filter(F.col("records") >= least)
        own = own if most is None else own.filter(F.col("records") <= most)
        rows = own.unionByName(looked.filter("__n is null").drop("__n").join(terms.filter(~often), "term"))
    n, tf = F.col("records").cast("double"), F.col("tf").cast("double")
    idf = F.log1p((n_records - n + 0.5) / (n + 0.5))
    score = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("doc_length") * n_records / max(1, n_terms)))
    return rows.select(id_col, "term", "tf", "records", score.alias("score"))
