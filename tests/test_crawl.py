import pytest

from orefind.sources.documents import crawled


def test_a_cut_crawl_is_an_error(spark):
    rows = [(f"http://h.example/{i}.html", f'<a href="/{i + 1}.html">x</a>') for i in range(3)]
    pages = spark.createDataFrame(rows, "url string, html string")
    with pytest.raises(ValueError, match="not done"):
        crawled(pages, "http://h.example/0.html", most_rounds=1)
