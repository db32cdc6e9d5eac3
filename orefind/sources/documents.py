"""Documents from rows, files, folders and crawled pages, as one table of fixed columns."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orefind.functions.text import document_uid, extension, extension_allowed, host_of, normal_url, summary, timestamp_text
from orefind.sources.html import charset_of, read_html
from orefind.sources.pdf import pdf_text
from orefind.sources.shared import shared_folder

COLUMNS = (
    "key string, title string, contents string, filename string, summary string, keywords string, author string, custom1 string, custom2 string, custom3 string, custom4 string, "
    "url string, mime_type string, path string, size string, modified timestamp, uid string"
)
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
# Extensions and media types by kind of document; extensions that a crawler follows.
HTML_EXTENSIONS = ("cfm", "htm", "html", "cfml", "php", "asp", "aspx")
KINDS = {"text/html": "html", "application/pdf": "pdf", "application/msword": "word", "text/plain": "text"}
CRAWLED = ("cfm", "cfml", "htm", "html", "dbm", "dbml")
WEB_CHARSET = "iso-8859-1"


def role(df: DataFrame, name: str | None) -> Column:
    """A column of ``df`` by name, in any case, or else the name itself as a constant; null for none or an empty one."""
    if not name:
        return F.lit(None).cast("string")
    by_name = {c.lower(): c for c in df.columns}
    return F.col(f"`{by_name[name.lower()]}`").cast("string") if name.lower() in by_name else F.lit(name)


def body(df: DataFrame, names: list[str]) -> Column:
    """The non-null ones of some columns, each with a blank behind it."""
    parts = [F.coalesce(F.concat(role(df, n), F.lit(" ")), F.lit("")) for n in names]
    return F.concat(*parts) if parts else F.lit("")


def _filled(df: DataFrame) -> DataFrame:
    kinds = dict(c.split() for c in COLUMNS.split(", "))
    return df.select(*((F.col(n) if n in df.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in NAMES))


def rows_source(df: DataFrame, key: str, bodies: list[str], title: str | None = None, urlpath: str | None = None, custom: tuple[str | None, ...] = ()) -> DataFrame:
    """Documents of table rows; each role is a column's name or a constant. Rows with a null key are kept here, and skipped when stored."""
    contents = body(df, bodies)
    picked = {f"custom{i + 1}": role(df, custom[i]) if i < len(custom) else F.lit(None).cast("string") for i in range(4)}
    return _filled(
        df.select(role(df, key).alias("key"), role(df, title).alias("title"), contents.alias("contents"), role(df, urlpath).alias("url"), summary(contents).alias("summary"), F.length(contents).cast("string").alias("size"), F.lit("text/plain").alias("mime_type"), *(c.alias(n) for n, c in picked.items()))
    )


def one_row_source(spark: SparkSession, key: str, text: str, title: str | None = None, url: str | None = None, custom: tuple[str | None, ...] = ()) -> DataFrame:
    """One document of plain values."""
    df = spark.createDataFrame([(key, text, title, url)], "key string, body string, title string, url string")
    return rows_source(df, "key", ["body"], "title", "url", custom)


def word_text(data: bytes) -> str:
    """The readable runs of a binary word-processor file, in either of its two character widths."""
    wide = [m.group().decode("utf-16-le", "ignore") for m in re.finditer(rb"(?:[\x20-\x7e\xa0-\xff\r\n\t]\x00){8,}", data)]
    narrow = [m.group().decode("cp1252", "ignore") for m in re.finditer(rb"[\x20-\x7e\x80-\xff\r\n\t]{40,}", data)]
    return "\n".join(x.replace("\r", "\n").strip() for x in (wide or narrow))


def kind_of(name: str, head: bytes) -> str:
    """html, pdf, word or text, by extension or, without one, by the first bytes."""
    ext = name.rsplit(".", 1)[-1].lower() if "." in name else ""
    if ext in HTML_EXTENSIONS:
        return "html"
    if ext in ("pdf", "doc"):
        return "pdf" if ext == "pdf" else "word"
    if not ext:
        if head[:5] == b"%PDF-":
            return "pdf"
        if head[:8] == b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1":
            return "word"
        if re.match(rb"\s*<(?:!doctype html|html)", head, re.I):
            return "html"
    return "text"


def read_bytes(kind: str, data: bytes | None, charset: str, sure: bool = False) -> dict:
    """The fields that bytes of a kind give; an error's text in ``error`` instead of an exception. ``sure`` says that the page itself isn't asked for its charset."""
    out: dict = {"title": None, "contents": None, "summary": None, "keywords": None, "author": None, "mime_type": None, "error": None, **dict.fromkeys(("custom1", "custom2", "custom3", "custom4"))}
    try:
        data = data or b""
        if kind == "html":
            got = read_html(data.decode(charset if sure else charset_of(data) or charset, "replace"))
            out |= {k: got[k] for k in ("title", "contents", "summary", "keywords", "author", "custom1", "custom2", "custom3", "custom4")} | {"mime_type": "text/html"}
        elif kind == "pdf":
            text, info = pdf_text(data)
            out |= {"contents": text, "title": info.get("Title"), "author": info.get("Author"), "keywords": info.get("Keywords"), "summary": info.get("Subject"), "mime_type": "application/pdf"}
        elif kind == "word":
            out |= {"contents": word_text(data), "mime_type": "application/msword"}
        else:
            out |= {"contents": data.decode(charset, "replace"), "mime_type": "text/plain"}
    except Exception as e:  # noqa: BLE001 - one bad file must not end the job
        out["error"] = f"{type(e).__name__}: {e}"
    return out


def read_file(name: str, data: bytes | None, charset: str = "utf-8") -> dict:
    """As read_bytes, the kind being told by the file's name or first bytes."""
    return read_bytes(kind_of(name, (data or b"")[:512]), data, charset)


_READ = "title string, contents string, summary string, keywords string, author string, mime_type string, custom1 string, custom2 string, custom3 string, custom4 string, error string"


def files_source(spark: SparkSession, path: str, extensions: list[str] | None = None, recurse: bool = True, charset: str = "utf-8", urlpath: str = "") -> tuple[DataFrame, DataFrame]:
    """Documents of a file or of a folder's files that pass the extension filter, and the (path, error) of those that failed.

    Files are listed and read by Spark's binaryFile source, a file a row; empty files are skipped and left where they are.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recurse).lower()).load(path)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    if extensions is not None:
        files = files.filter(extension_allowed(name, extensions))
    files = files.filter("length > 0").select("path", "modificationTime", name.alias("name"), "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = pd.DataFrame([read_file(n, d, charset) for n, d in zip(b["name"], b["content"], strict=True)], columns=[c.split()[0] for c in _READ.split(", ")], dtype=object)
            yield pd.concat([b[["path", "modificationTime", "name"]].reset_index(drop=True), got.reset_index(drop=True)], axis=1)

    made = files.mapInPandas(read, f"path string, modificationTime timestamp, name string, {_READ}")
    key = F.regexp_replace("path", r"^file:/*", "/")
    docs = made.filter("error is null").select(
        key.alias("key"), "title", "contents", F.concat_ws(" ", "name", F.regexp_replace("name", r"\.[^.]*$", "")).alias("filename"), F.coalesce("summary", summary(F.col("contents"))).alias("summary"), "keywords", "author", "custom1", "custom2", "custom3", "custom4",
        F.concat(F.lit(urlpath.rstrip("/") + "/"), "name").alias("url"), "mime_type", key.alias("path"), F.length("contents").cast("string").alias("size"), F.col("modificationTime").alias("modified"), document_uid(key, F.col("modificationTime")).alias("uid"),
    )
    return _filled(docs), made.filter("error is not null").select("path", "error")


def resolved_path(path: Column) -> Column:
    """A path without its dot segments: ``.`` goes, ``..`` takes the part before it along."""
    parts = F.split(path, "/", -1)

    def step(done: Column, part: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
        return F.when(part == ".", done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    made = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    folder = path.rlike(r"(?:^|/)\.\.?$") & ~F.endswith(made, F.lit("/"))
    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), F.concat(made, F.when(folder, "/").otherwise(""))).otherwise(path)


def links_of(pages: DataFrame) -> DataFrame:
    """url, link: the absolute addresses that pages (url, html) link to, normalised; of http and https alone."""
    href = F.explode(F.regexp_extract_all("html", F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']?([^\"'\s>]+)"), 1))
    raw = pages.select("url", href.alias("h")).select("url", F.replace("h", F.lit("&amp;"), F.lit("&")).alias("href"))
    root = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_extract("url", r"^(https?://[^/?#]+(?:/[^?#]*/|/)?)", 1)
    link = F.when(F.col("href").rlike("(?i)^https?://"), F.col("href")).when(F.startswith("href", F.lit("//")), F.concat(F.regexp_extract("url", "^(https?:)", 1), "href")).when(F.startswith("href", F.lit("/")), F.concat(root, "href")).when(F.col("href").rlike("^(?:#|[a-zA-Z][a-zA-Z0-9+.-]*:)"), None)
    link = link.when(F.startswith("href", F.lit("?")), F.concat(F.regexp_extract("url", r"^([^?#]*)", 1), "href")).otherwise(F.concat(F.regexp_replace(folder, "/+$", ""), F.lit("/"), "href"))
    found = raw.select("url", link.alias("link")).filter("link is not null")
    shape = r"^([A-Za-z]+://[^/?#]*)([^?#]*)(.*)$"
    whole = F.concat(F.regexp_extract("link", shape, 1), resolved_path(F.regexp_extract("link", shape, 2)), F.regexp_extract("link", shape, 3))
    return found.select("url", normal_url(whole).alias("link")).distinct()


FETCHED = "url string, status int, mime_type string, content binary, error string"


def fetch_pages(urls: DataFrame, agent: str = "orefind", seconds: float = 50.0) -> DataFrame:
    """url, status, mime_type, content, error of each address, fetched where the executors are; what fails has its error's text instead of a content."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.error import HTTPError
        from urllib.request import Request, urlopen

        for b in batches:
            rows = []
            for url in b["url"]:
                try:
                    with urlopen(Request(url, headers={"User-Agent": agent}), timeout=seconds) as got:  # noqa: S310 - addresses are the crawl's own
                        rows.append((url, got.status, got.headers.get("Content-Type"), got.read(), None))
                except HTTPError as e:
                    rows.append((url, e.code, e.headers.get("Content-Type"), None, f"HTTP {e.code}"))
                except Exception as e:  # noqa: BLE001 - one bad address must not end the crawl
                    rows.append((url, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FETCHED.split(", ")])

    return urls.select("url").repartition("url").mapInPandas(run, FETCHED)


def _allowed(links: DataFrame, seed: str, extensions: tuple[str, ...]) -> DataFrame:
    """Of addresses (url) those of the seed's host with an allowed extension or none."""
    path = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), r"^https?://[^/]*", "")
    return links.filter((host_of(F.col("url")) == host_of(F.lit(seed))) & extension(path).isin("", *extensions))


def _rounds(spark: SparkSession, seed: str, recurse: bool, extensions: tuple[str, ...], most_rounds: int | None, html_of) -> DataFrame:
    """The addresses that are reached from ``seed``, round by round, each written beside the others; ``html_of`` gives the pages (url, html) of a frontier."""
    base = shared_folder(spark, "crawl")
    seen = lambda: spark.read.schema("url string, round int").parquet(base).select("url")
    frontier = spark.createDataFrame([(seed,)], "url string").select(normal_url(F.col("url")).alias("url"))
    frontier.write.parquet(f"{base}/round=0")
    done = 0
    while True:
        frontier = spark.read.schema("url string").parquet(f"{base}/round={done}")
        pages = html_of(frontier, done)
        if not recurse:
            break
        links = _allowed(links_of(pages).select(F.col("link").alias("url")).distinct(), seed, extensions)
        links.join(seen(), "url", "left_anti").write.parquet(f"{base}/round={done + 1}")
        if spark.read.schema("url string").parquet(f"{base}/round={done + 1}").isEmpty():
            break
        if done == most_rounds:
            raise ValueError(f"the crawl of {seed} is not done after {most_rounds} rounds")
        done += 1
    return seen()


def crawled(pages: DataFrame, seed: str, recurse: bool = True, extensions: tuple[str, ...] = CRAWLED, most_rounds: int | None = None) -> DataFrame:
    """The pages (url, html) that can be reached from ``seed`` over links of its host with an allowed extension or none.

    A frontier of addresses moves on by joins until nothing new is met; each round is written to the shared folder. ``pages`` stands for
    the web; ``crawled_web`` fetches instead. The start itself is always taken. A crawl that isn't done after ``most_rounds`` raises an error.
    """
    web = pages.withColumn("url", normal_url(F.col("url"))).dropDuplicates(["url"])
    seen = _rounds(pages.sparkSession, seed, recurse, extensions, most_rounds, lambda frontier, _: web.join(frontier, "url", "left_semi"))
    return web.join(seen, "url", "left_semi")


def crawled_web(spark: SparkSession, seed: str, recurse: bool = True, extensions: tuple[str, ...] = CRAWLED, most_rounds: int | None = None, fetch=fetch_pages) -> tuple[DataFrame, DataFrame]:
    """Documents of the pages that are reached from ``seed``, fetched round by round, and the (url, error) of those that weren't had."""
    base = shared_folder(spark, "fetched")

    def html_of(frontier: DataFrame, done: int) -> DataFrame:
        fetch(frontier).write.parquet(f"{base}/round={done}")
        got = spark.read.schema(FETCHED).parquet(f"{base}/round={done}")
        return got.filter((F.col("status") == 200) & F.lower("mime_type").startswith("text/html")).select("url", F.decode("content", WEB_CHARSET).alias("html"))

    _rounds(spark, seed, recurse, extensions, most_rounds, html_of)
    everything = spark.read.schema(FETCHED).parquet(base)
    return pages_source(everything, "mime_type"), everything.filter("error is not null or status <> 200").select("url", F.coalesce("error", F.concat(F.lit("HTTP "), F.col("status").cast("string"))).alias("error"))


def pages_source(pages: DataFrame, mime_col: str | None = None) -> DataFrame:
    """Documents of pages: url and html (text), or content (bytes). With a column status only those of 200; with a media type column only
    those of a known type, each read as what it is, text in the charset that the type or the page names, else in WEB_CHARSET."""
    if "status" in pages.columns:
        pages = pages.filter("status = 200")
    kind = F.lit("text/html") if mime_col is None else F.lower(F.trim(F.regexp_extract(mime_col, "^([^;]*)", 1)))
    charset = F.lit("") if mime_col is None else F.regexp_extract(mime_col, r"(?i)charset\s*=\s*\"?([\w-]+)", 1)
    known = pages.select("url", kind.alias("__kind"), charset.alias("__charset"), (F.col("content") if "content" in pages.columns else F.encode("html", "UTF-8")).alias("__data")).filter(F.col("__kind").isin(*KINDS))
    if "content" not in pages.columns:
        known = known.withColumn("__charset", F.lit("utf-8"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = pd.DataFrame([read_bytes(KINDS[k], d, c or WEB_CHARSET, bool(c)) for k, c, d in zip(b["__kind"], b["__charset"], b["__data"], strict=True)], columns=[c.split()[0] for c in _READ.split(", ")], dtype=object)
            yield pd.concat([b[["url"]].reset_index(drop=True), got.reset_index(drop=True)], axis=1)

    got = known.mapInPandas(read, f"url string, {_READ}").filter("error is null")
    docs = got.select(F.col("url").alias("key"), "url", "title", "contents", F.coalesce("summary", summary(F.col("contents"))).alias("summary"), "keywords", "author", "custom1", "custom2", "custom3", "custom4", "mime_type", F.length("contents").cast("string").alias("size"), F.regexp_extract("url", r"([^/?#]*)(?:[?#].*)?$", 1).alias("filename"))
    return _filled(docs)


def word_vectors(spark: SparkSession, path: str, charset: str = "UTF-8") -> DataFrame:
    """word, vector (array of float) of a text file of lines of a word and its numbers; of a repeated word the last line; lines of one token are skipped."""
    lines = spark.read.option("encoding", charset).text(path).withColumn("n", F.monotonically_increasing_id())
    parts = F.split(F.trim("value"), r"\s+")
    rows = lines.select("n", parts.alias("p")).filter(F.size("p") >= 2).select("n", F.col("p")[0].alias("word"), F.transform(F.slice("p", 2, 1 << 20), lambda x: x.try_cast("float")).alias("vector"))
    return rows.groupBy("word").agg(F.max_by("vector", "n").alias("vector"))


def default_vectors_file(names: list[tuple[str, int]]) -> str:
    """Of (name, size) the largest .txt file."""
    texts = [(size, name) for name, size in names if name.lower().endswith(".txt")]
    if not texts:
        raise FileNotFoundError("no word vectors: put a .txt file of lines of a word and its numbers into the embedding folder")
    return max(texts)[1]


def vocabulary(spark: SparkSession, path: str, size: int) -> list[str]:
    """The first ``size`` words of a file of one a line, compressed or not."""
    return [r["value"].strip() for r in spark.read.text(path).filter("trim(value) <> ''").limit(size).collect()]


def modified_text(df: DataFrame, col: str = "modified") -> DataFrame:
    return df.withColumn(col, timestamp_text(F.col(col)))
