import os

import pytest
from pyspark.sql import functions as F

from orefind.operators.engine import Engine, directory_name, index_id, type_code, type_name
from orefind.sources.documents import crawled, default_vectors_file, files_source, one_row_source, rows_source, vocabulary, word_vectors

ROWS = [
    ("1", "Alpha", "Quarry is an open source stone application server written in Java"),
    ("2", "Beta", "Tomcat is a Java servlet container for running web applications"),
    ("3", "Gamma", "Flask is a lightweight Python web framework for building APIs"),
]


def docs(spark, rows):
    return rows_source(spark.createDataFrame(rows, "id string, title string, body string"), "id", ["body"], "title", "/")


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    engine = Engine(spark, str(tmp_path_factory.mktemp("engine")))
    c = engine.create("Stones")
    c.index("custom", "id", docs(spark, ROWS), categories=["tools", "web"], category_tree="/a/b", title="Default")
    return engine, c


@pytest.mark.parametrize(
    ("text", "n"),
    [("Quarry", 1), ("+Java +open", 1), ("Java -servlet", 1), ("Quarr?", 1), ("serv*", 2), ('"open source"', 1), ("(Java OR Python) AND web", 2), ("Quarry~1", 1), ("Java^4 Python", 3), ("*", 3), ("-java", 0)],
)
def test_explicit_counts(filled, text, n):
    assert filled[1].search(text, dialect="explicit")[0].count() == n


def test_simple_search_page_and_context(filled):
    rows, data = filled[1].search("java or python", start=2, most=2)
    got = rows.collect()
    assert [r["rank"] for r in got] == [2, 3] and data.records_searched == 3
    assert any('<B score="1.0">Java</B>' in r["context"]["text"] for r in got)
    assert filled[1].search("java", start=999)[0].count() == 0
    one = filled[1].search("java", context_passages=0)[0].first()
    assert one["context"]["text"] == "" and one["url"] == "/" and one["category"] == "tools,web"
    assert filled[1].search("java", begin="[H]", end="[/H]", most=1)[0].first()["context"]["text"].count("[H]") == 1


def test_stored_scores_equal_scanned_ones(spark, filled):
    from orefind.functions.criteria import parse_explicit
    from orefind.operators import match

    for text in ("java web", '"open source" java', "quarrx~1 python", "(java OR python) AND web -flask"):
        stored = {r["key"]: round(r["score"], 9) for r in filled[1].search(text, dialect="explicit")[0].collect()}
        scanned = {r["key"]: round(r["score"], 9) for r in match.ranked(filled[1].docs(), parse_explicit(text)).collect()}
        assert stored == scanned and stored, text


def test_filters_and_suggestions(filled):
    assert filled[1].search("java", categories=["web"])[0].count() == 2
    assert filled[1].search("java", categories=["none"])[0].count() == 0
    assert filled[1].search("java", tree="/a")[0].count() == 2 and filled[1].search("java", tree="/ab")[0].count() == 0
    _, data = filled[1].search("quarri", suggest=0)
    assert data.suggestions["quarri"][0] == ("quarry", 83) and data.suggestion_query == "<suggestion>quarry</suggestion>" and data.suggested_query == "quarry"
    assert filled[1].categories() == ({"tools": 1, "web": 1}, {"/a/b": 1})


def test_life_of_a_collection(spark, tmp_path):
    engine = Engine(spark, str(tmp_path))
    c = engine.create("Life")
    with pytest.raises(ValueError):
        engine.create("LIFE")
    with pytest.raises(ValueError):
        engine.create("x", mode="Keyword")
    with pytest.raises(ValueError):
        engine.create("x", ratio=2)
    with pytest.raises(KeyError):
        engine.collection("none")
    with pytest.raises(NotImplementedError):
        c.map("/x")
    rows = [("1", "a", "Unsere Susanne"), ("1", "b", "Unser Michael"), (None, "c", "nobody")]
    got = c.index("custom", "id", docs(spark, rows).withColumn("n", F.monotonically_increasing_id()), order="n")
    assert (got.inserted, got.updated) == (1, 2)
    assert c.search("Michael")[0].count() == 1 and c.search("Susanne")[0].count() == 0
    c.index("custom", "id", docs(spark, [("2", "x", "Second document")]))
    assert c.count() == 2 and c.index_table().first()["doccount"] == 2
    assert c.delete_documents(["1", "9"]).deleted == 1
    c.optimize()
    c.repair()
    assert c.search("second")[0].count() == 1
    c.index("custom", "id", docs(spark, [("3", "x", "Third")]), refresh=True)
    assert c.count() == 1
    c.purge()
    assert c.count() == 0 and len(c.indexes()) == 1
    assert c.delete_index("custom", "id").deleted == 0 and not c.indexes()
    assert engine.collections().count() == 1
    assert Engine(spark, str(tmp_path)).state["life"]["name"] == "Life"
    assert c.delete() == 0 and Engine(spark, str(tmp_path)).state == {}


def test_vector_and_hybrid(spark, tmp_path):
    engine = Engine(spark, str(tmp_path))
    for mode in ("vector", "hybrid"):
        c = engine.create(mode, mode=mode, ratio=0.7)
        c.index("custom", "id", docs(spark, ROWS))
        assert c.search("java web")[0].count() == 3
    rows, data = engine.search(["vector", "hybrid"], "java", most=4)
    assert rows.count() == 4 and data.records_searched == 6


def test_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.html").write_text("<html><head><title>T</title><meta name='author' content='Me'><style>p{}</style></head><body><p>Susi föhnte</p><script>x</script></body></html>")
    (tmp_path / "sub" / "b.TXT").write_text("plain text")
    (tmp_path / "c.log").write_text("ignored")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "d.pdf").write_bytes(b"%PDF-1.4\n1 0 obj<</Title (My title)>>endobj stream\nBT (Preise hier) Tj ET\nendstream")
    got, errors = files_source(spark, str(tmp_path), ["*.html", ".txt", "pdf"], urlpath="/site")
    by = {r["key"].rsplit("/", 1)[1]: r for r in got.collect()}
    assert set(by) == {"a.html", "b.TXT", "d.pdf"} and errors.count() == 0
    assert by["a.html"]["contents"] == "Susi föhnte" and by["a.html"]["author"] == "Me" and by["a.html"]["url"] == "/site/a.html"
    assert by["d.pdf"]["contents"] == "Preise hier" and by["d.pdf"]["title"] == "My title" and os.path.exists(tmp_path / "empty.txt")
    assert files_source(spark, str(tmp_path), ["*.*"], recurse=False)[0].count() == 3


def test_crawl(spark):
    pages = spark.createDataFrame(
        [("http://a.example/", "<a href='x.html'>1</a> <a href=/y.html>2</a> <a href='http://b.example/'>3</a> <a href='#t'>4</a>"), ("http://a.example:80/x.html", "<a href='/'>back</a><a href='z.pdf'>no</a>"), ("http://a.example/y.html", ""), ("http://a.example/z.pdf", ""), ("http://b.example/", "")],
        "url string, html string",
    )
    assert sorted(r["url"] for r in crawled(pages, "http://a.example").collect()) == ["http://a.example/", "http://a.example/x.html", "http://a.example/y.html"]
    assert crawled(pages, "http://a.example", recurse=False).count() == 1


def test_small_things(spark, tmp_path):
    assert directory_name("abc") == "CFabc" and directory_name("a_b") == "CFa_b285"
    assert type_code("query") == 2 and type_name(9) == "custom"
    with pytest.raises(ValueError):
        type_code("x")
    assert index_id("url", "k") != index_id("url", "k", "q")
    assert one_row_source(spark, "k", "text", "t").first()["contents"] == "text "
    (tmp_path / "v.txt").write_text("cat 1 0\ndog 0 1\ncat 2 2\nlonely\n")
    assert {r["word"]: r["vector"] for r in word_vectors(spark, str(tmp_path / "v.txt")).collect()} == {"cat": [2.0, 2.0], "dog": [0.0, 1.0]}
    assert vocabulary(spark, str(tmp_path / "v.txt"), 1) == ["cat 1 0"]
    assert default_vectors_file([("a.txt", 1), ("b.txt", 5), ("c.bin", 9)]) == "b.txt"
    with pytest.raises(FileNotFoundError):
        default_vectors_file([])


def test_stream_of_documents(spark, tmp_path):
    from orefind.streaming import upsert_stream

    engine = Engine(spark, str(tmp_path / "e"))
    c = engine.create("s")
    source = tmp_path / "in"
    docs(spark, ROWS).write.parquet(str(source))
    stream = spark.readStream.schema(docs(spark, ROWS).schema).parquet(str(source))
    upsert_stream(stream, c, "id", str(tmp_path / "check")).awaitTermination()
    assert c.count() == 3


def test_legacy_catalog(spark, tmp_path):
    (tmp_path / "search.xml").write_text("<search><collection name='Old' path='/p' language='english'><index id='custom-1' type='custom' key='k' category='a, b' categoryTree='/t'/></collection></search>")
    engine = Engine(spark, str(tmp_path))
    assert engine.collection("old").indexes()[0].categories == ["a", "b"] and engine.state["old"]["mode"] == "keyword"


def test_a_folder_of_any_scheme_keeps_its_documents(spark, tmp_path):
    engine = Engine(spark, f"file:{tmp_path}/e")
    c = engine.create("c")
    c.index("custom", "a", docs(spark, ROWS[:1]))
    c.index("custom", "a", docs(spark, ROWS[1:2]))
    c.index("custom", "b", docs(spark, ROWS[2:]))
    assert c.count() == 3 and Engine(spark, f"file:{tmp_path}/e").collection("c").count() == 3 and c.size() > 0
    other = Engine(spark, f"file:{tmp_path}/e")
    c.index("custom", "b", docs(spark, ROWS[:1]))
    with pytest.raises(RuntimeError):  # opened before the last change
        other.create("d")
    import shutil

    shutil.rmtree(tmp_path / "e" / "CFc" / c.indexes()[0].id)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):  # what is gone isn't empty
        c.count()


def test_a_change_writes_its_own_index_alone(spark, tmp_path):
    engine = Engine(spark, str(tmp_path))
    c = engine.create("c")
    c.index("custom", "a", docs(spark, ROWS))
    c.index("custom", "b", docs(spark, ROWS))
    a, b = (i.id for i in c.indexes())
    for _ in range(3):
        c.index("custom", "b", docs(spark, ROWS[:1]))
    assert c.meta["versions"] == {a: 1, b: 4}
    assert sorted(os.listdir(tmp_path / "CFc" / b)) == ["v3", "v4"]
    assert c.delete_documents(["1"]).deleted == 2 and c.count() == 4


def test_equal_keys_in_two_indexes_stay_apart(spark, tmp_path):
    engine = Engine(spark, str(tmp_path))
    for mode in ("keyword", "vector", "hybrid"):
        c = engine.create(mode, mode=mode)
        c.index("custom", "a", docs(spark, ROWS[:2]), title="A")
        c.index("custom", "b", docs(spark, ROWS[:2]), title="B")
        got = [(r["index_id"], r["key"]) for r in c.search("java")[0].collect()]
        assert len(got) == len(set(got)) == 4, mode
    rows = engine.search(["vector", "hybrid"], "java", start=3, most=4)[0].collect()
    assert [r["rank"] for r in rows] == [3, 4, 5, 6]
    everything = engine.search(["keyword", "hybrid"], "*")[0].collect()
    assert [r["rank"] for r in everything] == list(range(1, 9)) and {r["type"] for r in everything} == {"text/plain"}


def test_embeddings_by_word_vectors_and_vocabulary(spark, tmp_path):
    (tmp_path / "embedding").mkdir()
    (tmp_path / "embedding" / "small.txt").write_text("java 1 0 0\n")
    (tmp_path / "embedding" / "large.txt").write_text("java 1 0 0\nweb 0 1 0\npython 0 0 1\nflask 0 0 1\n")
    (tmp_path / "words.txt").write_text("python\njava\n")
    engine = Engine(spark, str(tmp_path))
    for name, embedding in (("w", "Word2Vec"), ("p", str(tmp_path / "embedding" / "large.txt"))):
        c = engine.create(name, mode="vector", embedding=embedding)
        c.index("custom", "id", docs(spark, [*ROWS, ("4", "x", "nothing known"), ("5", "y", None)]))
        rows = c.search("flask", most=2)[0].collect()
        assert rows[0]["key"] == "3" and round(rows[0]["score"], 4) == round((1 + 2 / 5**0.5) / 2, 4)
        assert {r["key"]: r["vector"] for r in c.docs().collect()}["4"] == [0.0, 0.0, 0.0]
    t = engine.create("t", mode="vector", vocabulary_path=str(tmp_path / "words.txt"))
    t.index("custom", "id", docs(spark, ROWS))
    assert t.meta["vocabulary"] == ["python", "java"] and t.search("java", most=1)[0].first()["key"] in ("1", "2")
    auto = engine.create("auto", mode="hybrid")
    auto.index("custom", "id", docs(spark, ROWS))
    first = list(auto.meta["vocabulary"])
    auto.index("custom", "id", docs(spark, [("9", "z", "wholly other words here")]))
    assert auto.meta["vocabulary"] == first and "other" not in first
    auto.repair()
    assert "other" in auto.meta["vocabulary"]


def test_scripts_that_join_marks_are_found(spark, tmp_path):
    engine = Engine(spark, str(tmp_path))
    c = engine.create("thai", language="thai")
    c.index("custom", "id", docs(spark, [("1", "a", "ที่ นี่"), ("2", "b", "café au lait")]))
    assert c.search("ที่")[0].count() == 1 and c.search("café")[0].count() == 1


def test_marks_scores_and_small_helpers(filled):
    from orefind.operators.engine import custom

    got = filled[1].search("java^4 web", dialect="explicit", most=1)[0].first()
    assert '<B score="4.0">Java</B>' in got["context"]["text"] and got["type"] == "text/plain"
    assert max(p["score"] for p in got["context"]["passages"]) in (4.0, 5.0)
    assert custom(got, 1) == "" and pytest.raises(ValueError, custom, got, 5)
    assert filled[1].search("javaor python", compat=True)[0].count() >= 0
