"""Collections of indexes: created, filled, searched and looked after.

Each index of a collection has a folder with one folder a version: the Parquet tables ``docs`` (with the documents' vectors, where the
collection embeds), ``postings`` (field, term, key, tf, positions, ranged and sorted by field, term and key, so that a search's terms
prune files and row groups, and a term of a third of all documents lies in several files), ``stats`` and ``words`` (the dictionary that
suggestions are made from). A change writes a new version of its own index alone and then moves the pointer in the catalog, a numbered
file; readers see either state, and of two sessions that change the catalog at once one fails. Folders are reached by the session's file
systems, so they may lie anywhere that Spark reads.
"""

from __future__ import annotations

import hashlib
import re
import time
from dataclasses import asdict, dataclass, field
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orefind.functions import criteria
from orefind.functions.text import check_language, directory_of, joined_url, tokens
from orefind.operators import match, mutate, passages, spell, vectors
from orefind.sources.documents import COLUMNS, NAMES, default_vectors_file, vocabulary, word_vectors
from orefind.sources.shared import Pointer, bytes_in, exists, make_folder, names_in, read_file, remove

MODES = ("keyword", "vector", "hybrid")
TYPES = {"file": 0, "path": 1, "custom": 2, "url": 3}
DOCS = f"{COLUMNS}, index_id string, vector array<double>"
POSTINGS = "field string, term string, index_id string, key string, tf int, positions array<int>"
STATS = "index_id string, field string, n bigint, w bigint"
WORDS = "index_id string, word string, df bigint"
TABLES = {"docs": DOCS, "postings": POSTINGS, "stats": STATS, "words": WORDS}
IDS = ["index_id", "key"]


def type_code(name: str) -> int:
    """The number of an index type; query is another name of custom; others are errors."""
    key = {"query": "custom"}.get(name.lower(), name.lower())
    if key not in TYPES:
        raise ValueError(f"unknown index type [{name}]")
    return TYPES[key]


def type_name(code: int) -> str:
    """The type of a number; custom for an unknown one."""
    return next((k for k, v in TYPES.items() if v == code), "custom")


def index_id(kind: str, key: str, query_name: str | None = None) -> str:
    text = key + (f":{query_name}" if query_name else "")
    return f"{type_name(type_code(kind))}-{hashlib.blake2b(text.encode(), digest_size=8).hexdigest()}"


@dataclass
class Index:
    id: str
    type: str
    key: str
    title: str = ""
    query_name: str = ""
    extensions: list[str] = field(default_factory=list)
    language: str = "english"
    urlpath: str = ""
    custom1: str = ""
    custom2: str = ""
    custom3: str = ""
    custom4: str = ""
    category_tree: str = ""
    categories: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.categories = [c.strip() for c in self.categories if c and c.strip()]


@dataclass
class IndexResult:
    deleted: int = 0
    inserted: int = 0
    updated: int = 0


@dataclass
class SearchData:
    """What a search tells besides its rows."""

    records_searched: int = 0
    suggestions: dict[str, list[tuple[str, int]]] = field(default_factory=dict)
    suggestion_query: str | None = None
    suggested_query: str | None = None


def _stamped(f):
    @wraps(f)
    def run(self, *args, **kwargs):
        out = f(self, *args, **kwargs)
        self.meta["last_update"] = time.time()
        self.engine.store()
        return out

    return run


class Engine:
    """The registry of collections below a folder, of any file system; names are the same in any case."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        make_folder(spark, self.folder)
        self.pointer = Pointer(spark, self.folder, "search")
        self.state: dict[str, dict] | None = self.pointer.load()
        if self.state is None:
            old = f"{self.folder}/search.xml"
            self.state = legacy_catalog(read_file(spark, old)) if exists(spark, old) else {}
            if self.state:
                self.store()

    def store(self) -> None:
        self.pointer.store(self.state)

    def create(self, name: str, path: str | None = None, language: str | None = None, mode: str = "", embedding: str = "", ratio: float = 0.5, overwrite: bool = False, vocabulary_path: str = "") -> Collection:
        """A new collection. ``embedding`` is TF-IDF (over the words of the file ``vocabulary_path``, or else the first documents' most
        frequent ones), word2vec (with the vectors file in the engine's folder ``embedding``), demo, the path of a vectors file, a
        registered name or a class."""
        mode = mode.strip() or "keyword"
        if mode not in MODES:
            raise ValueError(f"mode must be one of {', '.join(MODES)}, not [{mode}]")
        if not 0 <= ratio <= 1:
            raise ValueError("ratio must be between 0 and 1")
        if name.lower() in self.state and not overwrite:
            raise ValueError(f"collection [{name}] exists already")
        language = check_language(language)
        if name.lower() in self.state:
            self.collection(name).delete()
        self.state[name.lower()] = {
            "name": name, "path": (path or f"{self.folder}/{directory_name(name)}").rstrip("/"), "language": language, "mode": mode,
            "embedding": embedding or ("TF-IDF" if mode != "keyword" else ""), "vocabulary_path": vocabulary_path, "vocabulary": [], "ratio": ratio, "created": time.time(), "last_update": time.time(), "indexes": {}, "versions": {},
        }
        self.store()
        return self.collection(name)

    def collection(self, name: str) -> Collection:
        if name.lower() not in self.state:
            raise KeyError(f"collection [{name}] is not defined")
        return Collection(self, self.state[name.lower()])

    def collections(self) -> DataFrame:
        """A row for each collection."""
        rows = []
        for meta in self.state.values():
            c = Collection(self, meta)
            categories = bool({x for i in c.indexes() for x in i.categories})
            rows.append((False, meta["language"], False, meta["name"], True, meta["path"], "", meta["last_update"], categories, "UTF-8", meta["created"], float(c.size()), float(c.count()), meta["mode"], meta["embedding"], float(meta["ratio"])))
        return self.spark.createDataFrame(
            rows, "external boolean, language string, mapped boolean, name string, online boolean, path string, registered string, __l double, categories boolean, charset string, __c double, size double, doccount double, mode string, embedding string, ratio double"
        ).select("external", "language", "mapped", "name", "online", "path", "registered", F.timestamp_seconds("__l").alias("lastmodified"), "categories", "charset", F.timestamp_seconds("__c").alias("created"), "size", "doccount", "mode", "embedding", "ratio")

    def search(self, names: list[str], text: str, start: int = 1, most: int | None = None, **options) -> tuple[DataFrame, SearchData]:
        """Search several collections: best rows first over all of them, paged as one result. Of each only the rows that can come into the page are kept."""
        found, data = None, SearchData()
        for name in names:
            rows, own = self.collection(name).hits(text, top=None if most is None else start - 1 + most, **options)
            data.records_searched += own.records_searched
            for k, v in own.suggestions.items():
                data.suggestions.setdefault(k, []).extend(v)
            data.suggestion_query, data.suggested_query = data.suggestion_query or own.suggestion_query, data.suggested_query or own.suggested_query
            found = rows if found is None else found.unionByName(rows)
        if found is None:
            raise ValueError("no collection to search")
        return page(found, start, most), data


def page(found: DataFrame, start: int = 1, most: int | None = None) -> DataFrame:
    """The rows from ``start`` (1 is the first), at most ``most``, with their rank among all. Without ``most`` all rows are ranked, in parts."""
    order = [F.desc("score"), F.asc("collection"), F.asc("index_id"), F.asc("key")]
    if most is None:
        ranked = match.with_rank(found, order)
        return ranked.filter(F.col("rank") >= start).orderBy("rank")
    rows = found.orderBy(*order)
    if start > 1:
        rows = rows.offset(start - 1)
    rows = rows.limit(max(0, most))
    return rows.withColumn("rank", (F.row_number().over(Window.orderBy(*order)) + max(0, start - 1)).cast("bigint"))  # a page's rows


def directory_name(name: str) -> str:
    """A folder's name for a collection: see functions.text.safe_directory."""
    odd = [(i, ch) for i, ch in enumerate(name) if not re.match("[A-Za-z0-9]", ch)]
    return "CF" + re.sub("[^A-Za-z0-9]", "_", name) + (str(sum(ord(ch) * (i + 2) for i, ch in odd)) if odd else "")


def legacy_catalog(data: bytes) -> dict[str, dict]:
    """Collections of an older XML catalog; they search by words."""
    from xml.etree import ElementTree

    state: dict[str, dict] = {}
    for c in ElementTree.fromstring(data).iter("collection"):
        a = c.attrib
        indexes = {}
        for i in c.iter("index"):
            b = i.attrib
            kind = b.get("type", "custom") if b.get("type", "custom") in TYPES else "custom"
            one = Index(b.get("id") or index_id(kind, b.get("key", "")), kind, b.get("key", ""), b.get("title", ""), b.get("query", ""), [x for x in b.get("extensions", "").split(",") if x], b.get("language", "english"), b.get("urlpath", ""), *(b.get(f"custom{n}", "") for n in range(1, 5)), b.get("categoryTree", ""), b.get("category", "").split(","))
            indexes[one.id] = asdict(one)
        name = a.get("name", "")
        state[name.lower()] = {"name": name, "path": a.get("path", ""), "language": a.get("language", "english"), "mode": "keyword", "embedding": "", "vocabulary_path": "", "vocabulary": [], "ratio": 0.5, "created": time.time(), "last_update": time.time(), "indexes": indexes, "versions": {}}
    return state


class Collection:
    def __init__(self, engine: Engine, meta: dict) -> None:
        self.engine, self.meta, self.spark = engine, meta, engine.spark

    # --- tables ---

    def _folder(self, index: str, version: int | None = None) -> str:
        return f"{self.meta['path']}/{index}/v{self.meta['versions'][index] if version is None else version}"

    def _table(self, name: str, indexes: list[str] | None = None) -> DataFrame:
        """A table of the indexes (all by default) that were ever filled. One that the catalog names must be there: a missing one is an error."""
        filled = [i for i in self.meta["versions"] if indexes is None or i in indexes]
        if not filled:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*(f"{self._folder(i)}/{name}" for i in filled))

    def docs(self, indexes: list[str] | None = None) -> DataFrame:
        return self._table("docs", indexes)

    def postings(self, indexes: list[str] | None = None) -> DataFrame:
        return self._table("postings", indexes)

    def words(self, indexes: list[str] | None = None) -> DataFrame:
        """word, df: the dictionary of the indexes' contents."""
        return self._table("words", indexes).groupBy("word").agg(F.sum("df").alias("df"))

    def _statistics(self, postings: DataFrame, chosen: list[str]):
        """Scores' numbers from the stored tables: records and average length by field, records by term."""
        by_field = {r["field"]: (float(r["n"]), float(r["w"])) for r in self._table("stats", chosen).groupBy("field").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).collect()}

        def of(leaves: list[tuple[str, str]]) -> dict:
            rows = postings.filter(F.col("term").isin([t for _, t in leaves])).groupBy("field", "term").agg(F.count("*").alias("df")).collect()  # a row a searched term
            df = {(r["field"], r["term"]): float(r["df"]) for r in rows}
            return {(f, t): (by_field.get(f, (0.0, 0.0))[0], df.get((f, t), 0.0), by_field.get(f, (0.0, 0.0))[1] / max(1.0, by_field.get(f, (0.0, 0.0))[0])) for f, t in leaves}

        return of

    def _write(self, index: str, docs: DataFrame) -> None:
        """A new version of an index's tables; the one before the last goes once the pointer has moved, so that readers of the last can finish."""
        version = self.meta["versions"].get(index, 0) + 1
        folder = self._folder(index, version)
        remove(self.spark, folder)  # of a change that failed
        docs.select(*NAMES, F.lit(index).alias("index_id")).write.parquet(f"{folder}/plain" if self.embeds() else f"{folder}/docs")
        if self.embeds():
            fresh = self.spark.read.parquet(f"{folder}/plain")
            self._embedded(fresh).select(*NAMES, "index_id", "vector").write.parquet(f"{folder}/docs")
            remove(self.spark, f"{folder}/plain")
        fresh = self.spark.read.schema(DOCS).parquet(f"{folder}/docs")
        words = fresh.select("index_id", "key", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), tokens(F.col(f), self.meta["language"]).alias("t")) for f in match.DEFAULT_FIELDS))).alias("x")).select("x.field", "index_id", "key", F.posexplode("x.t").alias("p", "term"))
        lists = words.groupBy("field", "term", "index_id", "key").agg(F.count("*").cast("int").alias("tf"), F.array_sort(F.collect_list("p")).alias("positions"))
        lists.repartitionByRange("field", "term", "key").sortWithinPartitions("field", "term", "key").write.parquet(f"{folder}/postings")
        known = self.spark.read.schema(POSTINGS).parquet(f"{folder}/postings")
        known.groupBy("index_id", "field").agg(F.countDistinct("key").alias("n"), F.sum("tf").alias("w")).coalesce(1).write.parquet(f"{folder}/stats")
        known.filter(F.col("field") == match.DEFAULT_FIELDS[0]).groupBy("index_id", F.col("term").alias("word")).agg(F.count("*").alias("df")).write.parquet(f"{folder}/words")
        self.meta["versions"][index] = version
        self.engine.store()
        if version > 1:
            remove(self.spark, self._folder(index, version - 2))

    # --- vectors ---

    def embeds(self) -> bool:
        return self.meta["mode"] != "keyword" and bool(self.meta["embedding"])

    def _service(self, docs: DataFrame) -> vectors.Embedding | vectors.WordVectors:
        """The collection's embedding. The words of TF-IDF are fixed with the first documents that are written, or by a file."""
        name = self.meta["embedding"]
        if "/" in name or "\\" in name:
            return vectors.WordVectors(word_vectors(self.spark, name))
        if name.lower() == "word2vec":
            folder = f"{self.engine.folder}/embedding"
            file = default_vectors_file([(n, bytes_in(self.spark, f"{folder}/{n}")) for n in names_in(self.spark, folder)])
            return vectors.WordVectors(word_vectors(self.spark, f"{folder}/{file}"))
        if name.lower() != "tf-idf":
            return vectors.embedding(name)
        if not self.meta["vocabulary"]:
            path = self.meta["vocabulary_path"]
            self.meta["vocabulary"] = vocabulary(self.spark, path, vectors.DIMENSION) if path else vectors.vocabulary_of(docs, "contents")
        return vectors.TermWeights(self.meta["vocabulary"], self.meta["language"] == "english")

    def _embedded(self, docs: DataFrame) -> DataFrame:
        service = self._service(docs)
        if isinstance(service, vectors.WordVectors):
            return service.embedded(docs, IDS, "contents", "vector")
        return docs.withColumn("vector", F.when(F.col("contents").isNotNull(), service.generate(F.col("contents")).cast("array<double>")))

    # --- indexes ---

    def indexes(self) -> list[Index]:
        return [Index(**i) for i in self.meta["indexes"].values()]

    def _register(self, index: Index) -> None:
        language = check_language(index.language)
        if language != self.meta["language"]:
            raise ValueError(f"index language [{language}] isn't the collection's [{self.meta['language']}]")
        index.language = language
        self.meta["indexes"][index.id] = asdict(index)

    @_stamped
    def index(self, kind: str, key: str, docs: DataFrame, query_name: str = "", language: str | None = None, order: str | None = None, refresh: bool = False, **about) -> IndexResult:
        """Fill an index. Rows (custom) are laid over those that are there by key; files, folders and pages replace them; ``refresh`` empties first."""
        if refresh:
            self.purge()
        about = {k: v for k, v in about.items() if v is not None}
        one = Index(index_id(kind, key, query_name), type_name(type_code(kind)), key, query_name=query_name, language=language or self.meta["language"], **about)
        self._register(one)
        own = self.docs([one.id])
        incoming = docs.withColumn("index_id", F.lit(one.id)).withColumn("vector", F.lit(None).cast("array<double>"))
        if one.type == "custom":
            counts = mutate.upsert_counts(own, incoming).first()
            new = mutate.upsert(own, incoming, order=order)
            result = IndexResult(0, counts["inserted"], counts["updated"])
        else:
            before, rows, new = own.count(), incoming.count(), incoming
            result = IndexResult(0, 0, rows) if one.type == "path" or before == rows else IndexResult(0, rows, 0)
        self._write(one.id, new)
        return result

    @_stamped
    def delete_documents(self, keys: list[str]) -> IndexResult:
        """Delete by key from all custom indexes that have one of the keys."""
        gone = 0
        wanted = self.spark.createDataFrame([(k,) for k in keys], "key string")
        for i in [i.id for i in self.indexes() if i.type == "custom" and i.id in self.meta["versions"]]:
            own = self.docs([i])
            here = own.join(F.broadcast(wanted), "key", "left_semi").count()
            if here:
                self._write(i, mutate.delete_keys(own, wanted))
                gone += here
        return IndexResult(gone, 0, 0)

    @_stamped
    def delete_index(self, kind: str, key: str, query_name: str = "") -> IndexResult:
        """Delete a whole index with its registration."""
        name = index_id(kind, key, query_name)
        gone = self.docs([name]).count()
        self.meta["versions"].pop(name, None)
        self.meta["indexes"].pop(name, None)
        self.engine.store()
        remove(self.spark, f"{self.meta['path']}/{name}")
        return IndexResult(gone, 0, 0)

    @_stamped
    def purge(self) -> None:
        """Empty all indexes; the collection and their registration stay."""
        for name in list(self.meta["versions"]):
            self._write(name, self.docs([name]).limit(0))

    def delete(self) -> int:
        """Delete the collection; the number of its documents."""
        gone, filled = self.count(), list(self.meta["versions"])
        self.engine.state.pop(self.meta["name"].lower(), None)
        self.engine.store()
        for name in filled:
            remove(self.spark, f"{self.meta['path']}/{name}")
        return gone

    @_stamped
    def optimize(self, partitions: int | None = None, index: str | None = None) -> None:
        """Rewrite the tables of an index, or of all, in few large files."""
        for name in [i for i in self.meta["versions"] if index in (None, i)]:
            docs = self.docs([name])
            self._write(name, docs.coalesce(partitions) if partitions else docs.repartition("key"))

    @_stamped
    def repair(self) -> None:
        """Derive the postings, and the vectors by the words of the documents there are now, from the documents again."""
        self.meta["vocabulary"] = []
        if self.embeds():
            self._service(self.docs())
        for name in list(self.meta["versions"]):
            self._write(name, self.docs([name]))

    def map(self, path: str) -> None:
        raise NotImplementedError("a collection can't be mapped to another folder")

    # --- what there is ---

    def count(self, index: str | None = None) -> int:
        docs = self.docs()
        return (docs if index is None else docs.filter(F.col("index_id") == index)).count()

    def size(self) -> int:
        """Bytes of the tables in KiB."""
        return sum(bytes_in(self.spark, self._folder(i)) for i in self.meta["versions"]) // 1024

    def index_table(self) -> DataFrame:
        """A row for each index, with its number of documents."""
        rows = [(i.id, i.type, i.custom1, i.custom2, i.custom3, i.custom4, ",".join(i.extensions), i.key, i.language, i.query_name, i.title, i.urlpath, ",".join(i.categories), i.category_tree) for i in self.indexes()]
        about = self.spark.createDataFrame(rows, "id string, type string, custom1 string, custom2 string, custom3 string, custom4 string, extensions string, key string, language string, query string, title string, urlpath string, categories string, categoryTree string")
        counts = self.docs().groupBy(F.col("index_id").alias("id")).agg(F.count("*").alias("doccount"))
        return about.join(counts, "id", "left").withColumn("doccount", F.coalesce("doccount", F.lit(0)))

    def categories(self) -> tuple[dict[str, int], dict[str, int]]:
        """How many indexes there are in each category and category tree."""
        flat: dict[str, int] = {}
        tree: dict[str, int] = {}
        for i in self.indexes():
            for c in i.categories:
                flat[c] = flat.get(c, 0) + 1
            if i.category_tree:
                tree[i.category_tree] = tree.get(i.category_tree, 0) + 1
        return flat, tree

    # --- search ---

    def selected(self, categories: list[str] | None = None, tree: str | None = None) -> list[Index]:
        """The indexes that a search reads: any of the categories, and the tree or one below it."""
        return [i for i in self.indexes() if (not categories or set(categories) & set(i.categories)) and (not tree or tree == "/" or i.category_tree == tree or i.category_tree.startswith(tree.rstrip("/") + "/"))]

    def hits(self, text: str, dialect: str = "simple", categories: list[str] | None = None, tree: str | None = None, language: str | None = None, suggest: int | None = None, context_bytes: int = passages.BYTES, context_passages: int = passages.PASSAGES, context_length: int = passages.LENGTH, begin: str = passages.BEGIN, end: str = passages.END, top: int | None = None, compat: bool = False) -> tuple[DataFrame, SearchData]:
        """All matching rows of the collection, or the ``top`` best, with the result's columns, index_id and key, and what else there is to tell."""
        chosen = self.selected(categories, tree)
        names = [i.id for i in chosen]
        docs = self.docs(names)
        data = SearchData(records_searched=docs.count())
        simple = criteria.parse_simple(text, compat) if dialect != "explicit" else None
        query = simple.canonical() if simple else text
        node = criteria.parse_explicit(query)
        everything = isinstance(node, criteria.All)
        mode = "keyword" if dialect == "explicit" or everything or not self.embeds() else self.meta["mode"]
        fields = tuple(n for n in NAMES if n not in ("modified", "mime_type", "path"))
        if mode == "vector":
            scored = None
        elif everything or match.named_fields(node) - set(match.DEFAULT_FIELDS):
            scored = match.ranked(docs, node, known=fields, language=self.meta["language"], query_language=language)
        else:
            own = self.postings(names)
            node = match.expanded(node, docs, match.DEFAULT_FIELDS, own)
            asked = match.pointed_to(node, language or self.meta["language"])
            met = docs if asked is None else docs.join(own.filter(asked).select(*IDS).distinct(), IDS, "left_semi")
            scored = match.ranked(met, node, known=fields, language=self.meta["language"], query_language=language, dictionary=own, statistics=self._statistics(own, names))
        if mode != "keyword":
            near = vectors.nearest(docs.select(*IDS, "vector"), self._service(docs).of(docs, query), "vector", IDS).select(*IDS, "score")
            both = near if scored is None else vectors.hybrid(scored.select(*IDS, "score"), near, IDS, self.meta["ratio"])
            scored = docs.join(both, IDS)
        scored = scored.drop("vector")
        if top is not None:
            scored = scored.orderBy(F.desc("score"), *IDS).limit(top)
        weights = {w: b for x, b in _weighted_words(node) for w in match.analysed(x, self.meta["language"])}
        rows = self._projected(scored, chosen)
        if context_bytes > 0 and context_passages > 0 and not everything:
            marked = rows.withColumn("__id", F.concat_ws("\0", *IDS)).withColumn("__w", F.array(*map(F.lit, weights)).cast("array<string>"))
            found = passages.keyword_passages(marked, "__id", "contents", query, context_passages, context_length) if mode == "vector" else passages.best_passages(marked, "__id", "contents", "__w", context_passages, context_length, begin, end, weights)
            rows = marked.join(found, "__id", "left").withColumn("context", F.struct(passages.context_text(F.col("passages"), context_bytes).alias("text"), F.col("contents").alias("content"), F.col("passages"))).drop("__id", "__w", "passages")
        else:
            kind = "array<struct<original:string,highlighted:string,start:int,end:int,score:double>>"
            rows = rows.withColumn("context", F.struct(F.lit("").alias("text"), F.col("contents").alias("content"), F.array().cast(kind).alias("passages")))
        if suggest is not None and simple is not None and simple.words and scored.limit(suggest + 1).count() <= suggest:
            asked = [t for w in simple.words for t in match.analysed(w, self.meta["language"])]
            for r in spell.suggestions(self.words(names), asked).orderBy("term", "place").collect():  # at most ten a searched word
                data.suggestions.setdefault(r["term"], []).append((r["keyword"], r["score"]))
            if data.suggestions:
                data.suggestion_query, data.suggested_query = spell.suggested_query(simple, {k: v[0][0] for k, v in data.suggestions.items()})
        return rows.drop("contents"), data

    def search(self, text: str, start: int = 1, most: int | None = None, **options) -> tuple[DataFrame, SearchData]:
        rows, data = self.hits(text, top=None if most is None else start - 1 + most, **options)
        return page(rows, start, most), data

    def _projected(self, scored: DataFrame, chosen: list[Index]) -> DataFrame:
        about = self.spark.createDataFrame([(i.id, i.type, i.title, i.urlpath, i.key, i.custom1, i.custom2, i.custom3, i.custom4, i.category_tree, ",".join(i.categories)) for i in chosen], "index_id string, index_type string, i_title string, urlpath string, i_key string, i_custom1 string, i_custom2 string, i_custom3 string, i_custom4 string, categoryTree string, category string")
        about = about.withColumn("folder", directory_of(F.col("i_key")))
        joined = with_result_url(scored.join(F.broadcast(about), "index_id", "left"))  # a row an index
        first = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.nullif(F.col(f"i_{c}"), F.lit("")), F.lit(""))
        return joined.select(
            first("title").alias("title"), *(first(f"custom{n}").alias(f"custom{n}") for n in range(1, 5)), "categoryTree", "category", F.coalesce("mime_type", F.lit("")).alias("type"), F.coalesce("author", F.lit("")).alias("author"), F.coalesce("size", F.lit("")).alias("size"), F.coalesce("summary", F.lit("")).alias("summary"),
            F.col("score").cast("double").alias("score"), "key", "url", F.lit(self.meta["name"]).alias("collection"), "index_id", "contents",
        )


def with_result_url(rows: DataFrame) -> DataFrame:
    """``rows`` (index_type, urlpath, i_key, folder, key, url) with the address of a result in ``url``: a folder's file below the path's
    address, a page below its own folder, a file's below the path, else its own."""
    kind, path, own = F.col("index_type"), F.coalesce("urlpath", F.lit("")), F.coalesce("url", F.lit(""))
    root = F.when(kind == "url", F.col("folder")).otherwise(F.col("i_key"))
    at = F.when(kind.isin("path", "url") & (F.length(root) > 0), F.instr("key", root)).otherwise(0)  # the first occurrence is cut out
    cut = rows.withColumn("__at", at).withColumn("__root", F.length(root))
    below = F.when(F.col("__at") > 0, F.concat(F.substring("key", F.lit(1), F.col("__at") - 1), F.substring("key", F.col("__at") + F.col("__root"), F.length("key")))).otherwise(F.col("key"))
    placed = cut.withColumn("__base", F.when((kind == "url") & (path == ""), F.col("folder")).otherwise(path)).withColumn("__part", F.when(kind.isin("path", "url"), below).otherwise(own))
    return placed.withColumn("url", F.when(kind.isin("path", "url", "file"), joined_url(F.col("__base"), F.col("__part"))).otherwise(own)).drop("__at", "__root", "__base", "__part")


def custom(row, number: int):
    """A result's custom field by its number, 1 to 4."""
    if number not in (1, 2, 3, 4):
        raise ValueError(f"there is no custom field number [{number}]")
    return row[f"custom{number}"]


def _weighted_words(node: object, boost: float = 1.0) -> list[tuple[str, float]]:
    """The words of a search that count for it, with their boost."""
    if isinstance(node, criteria.Bool):
        return [w for role, inner in node.clauses if role != criteria.MUST_NOT for w in _weighted_words(inner, boost * node.boost)]
    return [(node.text, boost * node.boost)] if isinstance(node, (criteria.Term, criteria.Phrase, criteria.Fuzzy)) else []
