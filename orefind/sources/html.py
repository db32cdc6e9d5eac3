"""HTML documents: title, text and meta data, with the standard library's parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

FIELDS = ("title", "contents", "summary", "keywords", "author", "custom1", "custom2", "custom3", "custom4", "charset")
HTML = StructType([StructField(f, StringType()) for f in FIELDS])
_META = {"description": "summary", "keywords": "keywords", "author": "author", "custom1": "custom1", "custom2": "custom2", "custom3": "custom3", "custom4": "custom4"}


class _Reader(HTMLParser):
    def __init__(self, silent: tuple[str, ...]) -> None:
        super().__init__(convert_charrefs=True)
        self.silent, self.deep, self.in_title = silent, 0, False
        self.title, self.lines, self.now, self.meta = "", [], [], {}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.silent:
            self.deep += 1
        elif tag == "title":
            self.in_title = True
        elif tag == "meta":
            a = {k: v for k, v in attrs if v is not None}
            name = (a.get("name") or "").lower()
            if name in _META and "content" in a:
                self.meta.setdefault(_META[name], a["content"])
            if "charset" in a:
                self.meta.setdefault("charset", a["charset"])
            elif "charset=" in a.get("content", "").lower():
                self.meta.setdefault("charset", re.sub(r"(?i).*charset=\s*", "", a["content"]).strip())

    def handle_endtag(self, tag: str) -> None:
        if tag in self.silent:
            self.deep = max(0, self.deep - 1)
        elif tag == "title":
            self.in_title = False
        self._line()

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title += data
        elif not self.deep:
            self.now.append(data)

    def _line(self) -> None:
        text = " ".join("".join(self.now).split())
        if text:
            self.lines.append(text)
        self.now = []


def read_html(text: str | None, compat: bool = False) -> dict | None:
    """The fields of a page; its text has a line for each element that ends. Scripts, and styles unless ``compat``, are left out."""
    if text is None:
        return None
    reader = _Reader(("script",) if compat else ("script", "style"))
    reader.feed(text)
    reader.close()
    reader._line()
    return {**dict.fromkeys(FIELDS), **reader.meta, "title": " ".join(reader.title.split()) or None, "contents": "\n".join(reader.lines)}


@F.pandas_udf(HTML)
def html_fields(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_html(t) or dict.fromkeys(FIELDS) for t in texts], columns=list(FIELDS))


def charset_of(head: bytes) -> str | None:
    """The encoding that a page's first bytes name."""
    m = re.search(rb"charset\s*=\s*[\"']?([\w-]+)", head[:4096], re.I)
    return m.group(1).decode("ascii") if m else None
