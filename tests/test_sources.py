import base64
import threading
import zlib
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from orefind.sources.documents import crawled_web, links_of, pages_source, resolved_path
from orefind.sources.pdf import pdf_text


def pdf(*objects: bytes, tail: bytes = b"") -> bytes:
    return b"%PDF-1.5\n" + b"\n".join(b"%d 0 obj\n%s\nendobj" % (i + 1, o) for i, o in enumerate(objects)) + b"\n" + tail


def stream(data: bytes, head: bytes = b"") -> bytes:
    return b"<< /Length %d %s >>\nstream\n%s\nendstream" % (len(data), head, data)


def test_pdf_of_plain_and_filtered_streams():
    show = b"BT /F1 12 Tf 10 700 Td (Hello \\(world\\)) Tj 0 -14 Td [(Ne) -20 (xt) -300 (line)] TJ T* (caf\\351) Tj ET"
    for head, data in ((b"", show), (b"/Filter /FlateDecode", zlib.compress(show)), (b"/Filter [/ASCII85Decode /FlateDecode]", base64.a85encode(zlib.compress(show)) + b"~>"), (b"/Filter /ASCIIHexDecode", show.hex().encode() + b">")):
        text, info = pdf_text(pdf(stream(data, head), b"<< /Title (My \\050title\\051) /Author <FEFF00C400620063> >>"))
        assert text == "Hello (world)\nNext line\ncafé" and info == {"Title": "My (title)", "Author": "Äbc"}


def test_pdf_of_fonts_with_maps_and_object_streams():
    cmap = b"1 beginbfchar <0003> <00E9> endbfchar 1 beginbfrange <0041> <0043> <0061> endbfrange"
    inner = b"7 0 8 30 " + b"<< /ToUnicode 1 0 R >>".ljust(30) + b"<< /Font << /F9 7 0 R >> >>"
    packed = stream(zlib.compress(inner), b"/Type /ObjStm /N 2 /First 9 /Filter /FlateDecode")
    text, _ = pdf_text(pdf(stream(cmap), packed, stream(b"BT /F9 1 Tf <004100420003> Tj ET")))
    assert text == "abé"
    with pytest.raises(ValueError):
        pdf_text(pdf(b"<< >>", tail=b"trailer << /Encrypt 4 0 R >>"))
    assert pdf_text(b"") == ("", {}) and pdf_text(b"%PDF-1.4 no object at all")[0] == ""


def test_links_are_resolved(spark):
    html = "<a href='../b/./c.html'>1</a><a href=\"?q=1\">2</a><a href='//o.example/x/../y'>3</a><a href='mailto:a@b'>4</a><a href='d/'>5</a><a href='/../up.cfm#t'>6</a><a href='HTTP://H.example/z'>7</a>"
    rows = links_of(spark.createDataFrame([("http://h.example/a/p.html?x", html)], "url string, html string")).collect()
    assert {r["link"] for r in rows} == {"http://h.example/b/c.html", "http://h.example/a/p.html?q=1", "http://o.example/y/", "http://h.example/a/d/", "http://h.example/up.cfm", "http://h.example/z/"}
    path = spark.createDataFrame([("/a/b/../../../c/.",), ("/a..b/..c",), ("",), ("/x/..",)], "p string").select(resolved_path(F.col("p")))
    assert [r[0] for r in path.collect()] == ["/c/", "/a..b/..c", "", "/"]


def test_pages_by_status_and_media_type(spark):
    rows = [
        ("u1", 200, "text/html; charset=utf-8", "<title>Ä</title><p>ö</p>".encode()), ("u2", 200, "text/html", b"<meta charset='cp1252'><p>\x80</p>"), ("u3", 200, "text/plain", b"\xe4"),
        ("u4", 404, "text/html", b"<p>gone</p>"), ("u5", 200, "image/png", b"x"), ("u6", 200, "application/pdf", pdf(stream(b"BT (pdf text) Tj ET"))), ("u7", 200, None, b"x"), ("u8", 200, "TEXT/HTML", None),
    ]
    got = {r["key"]: (r["title"], r["contents"], r["mime_type"]) for r in pages_source(spark.createDataFrame(rows, "url string, status int, mime_type string, content binary"), "mime_type").collect()}
    assert got == {"u1": ("Ä", "ö", "text/html"), "u2": (None, "€", "text/html"), "u3": (None, "ä", "text/plain"), "u6": (None, "pdf text", "application/pdf"), "u8": (None, "", "text/html")}
    plain = pages_source(spark.createDataFrame([("u", "<p>ü</p>")], "url string, html string")).first()
    assert plain["contents"] == "ü" and plain["size"] == "1"


def test_a_crawl_fetches_its_pages(spark):
    pages = {"/": ("text/html", b"<a href='a.html'>a</a><a href='/gone.html'>x</a><a href='/note'>n</a><a href='http://elsewhere.example/'>y</a>"), "/a.html": ("text/html", b"<title>A</title><p>first</p><a href='./'>back</a>"), "/note/": ("text/plain", b"a note")}

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            kind, data = pages.get(self.path, (None, b""))
            self.send_response(200 if kind else 404)
            self.send_header("Content-Type", kind or "text/html")
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        docs, errors = crawled_web(spark, f"http://127.0.0.1:{server.server_port}")
        got = {r["url"].rsplit(":", 1)[1].split("/", 1)[1]: r["contents"] for r in docs.collect()}
        assert set(got) == {"", "a.html", "note/"} and got["note/"] == "a note" and "first" in got["a.html"]
        assert [r["error"] for r in errors.collect()] == ["HTTP 404"]
    finally:
        server.shutdown()
