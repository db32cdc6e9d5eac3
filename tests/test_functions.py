import pytest
from pyspark.sql import functions as F

from orefind.functions import text as t
from orefind.operators import vectors
from orefind.operators.passages import split_passages
from orefind.operators.spell import suggestions


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_tokens(spark):
    assert one(spark, t.tokens(F.lit("Don't pay 3.14 or 1,000 for foo_bar, u.s.a a-b"))) == ["don't", "pay", "3.14", "or", "1,000", "for", "foo_bar", "u.s.a", "a", "b"]
    assert one(spark, t.tokens(F.lit(None).cast("string"))) == []
    assert one(spark, t.tokens(F.lit("東京都 x"), "japanese")) == ["東京", "京都", "x"]
    assert one(spark, t.tokens(F.lit("Häuser"), "german")) == one(spark, t.tokens(F.lit("Häuse"), "german"))


@pytest.mark.parametrize("name", t.LANGUAGES)
def test_every_language_has_an_analyzer(spark, name):
    assert "language" in one(spark, F.array_join(t.tokens(F.lit(f"Testing the {name} language analyzer"), name), " ")) or name in t.STEMS


def test_languages():
    assert t.check_language(None) == "english" and t.check_language("sp") == "spanish"
    for bad in ("cn", "klingon"):
        with pytest.raises(ValueError):
            t.check_language(bad)


def test_urls(spark):
    assert one(spark, t.joined_url(F.lit("/a/"), F.lit("\\b"))) == "/a/b" and one(spark, t.joined_url(F.lit("/A"), F.lit("/a/x"))) == "/A/a/x"
    assert one(spark, t.joined_url(F.lit("http://x/"), F.lit("HTTP://X/y"))) == "HTTP://X/y" and one(spark, t.joined_url(F.lit(""), F.lit("/y"))) == "/y"
    assert [one(spark, t.directory_of(F.lit(f"http://h.example{x}"))) for x in (":80/a/b.html?x", "/a", "", "/a/?q", "/x.d/y.e/z")] == [f"http://h.example{x}" for x in ("/a/", "/a/", "/", "/a/?q", "/x.d/")]
    assert one(spark, t.normal_url(F.lit("HTTP://H.example:80/dir#x"))) == "http://h.example/dir/"
    assert one(spark, t.uid_url(t.document_uid(F.lit("/a/b"), F.lit("2020-01-02 03:04:05.678").cast("timestamp")))) == "/a/b"


@pytest.mark.parametrize(("name", "patterns", "passes"), [("a.HTML", ["*.html"], True), ("a", ["*."], True), ("a.x", ["*."], False), ("a.x", [".*"], True), ("a", ["*.*"], False), ("a.cfm", ["cfm"], True), ("a.cfm", [], False)])
def test_extension_filter(spark, name, patterns, passes):
    assert one(spark, t.extension_allowed(F.lit(name), patterns)) is passes


def test_highlight_and_count(spark):
    assert one(spark, t.highlighted(F.lit("A cat, Cat."), F.lit("cat"))) == "A <B>cat</B>, <B>Cat</B>."
    assert one(spark, t.occurrences(F.lit("aaa"), F.lit("aa"))) == 1 and one(spark, t.occurrences(F.lit("a"), F.lit(""))) == 0


def test_passages():
    assert split_passages("No terminator here at all", 20) == [("No terminator here at all", 0, 25)]
    assert split_passages("No terminator here at all", 20, compat=True)[0][2] == 24
    assert len(split_passages("a" * 160 + "." + "b" * 75)) == 1 and [p for p, _, _ in split_passages("One. Two. Three. ", 6)] == ["One. Two.", " Three. "]
    assert split_passages(None) == [] and split_passages("") == []
    long = "One sentence here. " * 2000
    assert "".join(p for p, _, _ in split_passages(long)) == long


def test_vectors(spark):
    assert one(spark, vectors.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))) == 0 and one(spark, vectors.cosine(F.lit(None).cast("array<double>"), F.array(F.lit(1.0)))) == 0
    service = vectors.TermWeights(["a", "b"])
    assert service.of(spark.range(1), "") == [1e-5, 0.0]
    got = service.of(spark.range(1), "b b a")
    assert abs(sum(x * x for x in got) - 1) < 1e-9 and got[1] > got[0] and service.dimension() == 2
    assert vectors.embedding("DEMO").dimension() == 12
    with pytest.raises(ValueError):
        vectors.embedding("none")
    words = spark.createDataFrame([("cat", [1.0, 0.0]), ("dog", [0.9, 0.1]), ("car", [0.0, 1.0])], "word string, vector array<double>")
    docs = spark.createDataFrame([(1, "cat cat dog"), (2, "none"), (3, None)], "id int, text string")
    means = {r["id"]: r["vector"] for r in vectors.word_vectors_mean(docs, "id", "text", words).collect()}
    assert abs(means[1][0] - 2.9 / 3) < 1e-6 and means[2] == [0.0, 0.0] == means[3]
    assert vectors.similar_words(words, "cat", 1).first()["word"] == "dog" and vectors.similar_words(words, "x", 3).count() == 0
    empty = spark.createDataFrame([], "id int, score double")
    assert vectors.hybrid(empty, spark.createDataFrame([(1, 0.5)], "id int, score double"), "id", 0.5).first()["score"] == 0.25


def test_query_words_are_cut_as_documents_are(spark):
    from orefind.operators.match import analysed

    for text, lang in (("ที่ x", "thai"), ("Cafe\u0301 it's 3.14", "english"), ("বাংলা", "bengali"), ("東京都 data 語", "japanese"), ("häuser_x", "german"), ("Der Hund und die Katzen", "german"), ("Les chats et les chiens", "french")):
        assert analysed(text, lang) == one(spark, t.tokens(F.lit(text), lang)), text
    assert one(spark, t.tokens(F.lit("Der Hund und die Katzen"), "german")) == ["hund", "katz"] and one(spark, t.tokens(F.lit("the cats"))) == ["the", "cats"]


def test_edits_count_exchanged_neighbours(spark):
    from orefind.operators.match import edits

    got = {r["t"]: r["d"] for r in spark.createDataFrame([("form",), ("from",), ("rfmo",), ("xfrom",)], "t string").select("t", edits(F.col("t"), "from").alias("d")).collect()}
    assert got == {"form": 1, "from": 0, "rfmo": 2, "xfrom": 1}


def test_suggestions(spark):
    words = spark.createDataFrame([("search", 3), ("serch", 1), ("engine", 2)], "word string, df bigint")
    got = suggestions(words, ["serch", ""]).collect()
    assert [(r["keyword"], r["score"]) for r in got] == [("search", 83)]
