"""Markup left in texts: which there is, and the text without it, its structure kept.

Four families are told apart: HTML, Markdown, wiki (bracket and heading dialects) and LaTeX. Code regions are set aside
first; then each family's constructs are looked for, those that only one family has before those that several share: a
star or number sign that begins a line is a list of a wiki page if the page is one, a pair of quotes closes a quotation of
LaTeX. Conversion turns the text into blocks (heading, paragraph, item, code, table, formula), each without its signs.

Differencing pages by nearest address, the method named for this, is ``differenced``: it removes lines that neighbouring pages
share. It can neither find markup within a page's own lines nor keep its structure, so the families and the clean text
come from parsed constructs instead; README has its figures.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAMILIES = ("html", "markdown", "wiki", "latex")
# The elements of HTML that count as markup, and those of wikis that look like them.
_ELEMENTS = (
    "a abbr address article aside audio b base blockquote body br button canvas caption center cite code col colgroup dd del details div dl dt em "
    "fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark "
    "meta nav noscript object ol option p param picture pre q s samp script section select small source span strike strong style sub summary sup "
    "svg table tbody td textarea tfoot th thead time title tr tt u ul var video"
).split()
_WIKI_ELEMENTS = "nowiki|ref|references|syntaxhighlight|gallery|includeonly|noinclude|math"
_TAG = re.compile(rf"<!--.*?(?:-->|$)|<!doctype[^>]*>|<(/?)({'|'.join(sorted(_ELEMENTS, key=len, reverse=True))})(?=[\s/>])([^<>]*)>", re.I | re.S)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#x[0-9a-f]{1,6}|[a-z][a-z0-9]{1,30});", re.I)
# Code, where signs mean nothing else.
_CODE = re.compile(
    r"(?P<md>^(?P<f>`{3,}|~{3,})[^\n]*\n.*?(?:^(?P=f)[ \t]*$|\Z))|(?P<wiki>\{code[^}\n]*\}.*?(?:\{code\}|\Z)|\{noformat\}.*?(?:\{noformat\}|\Z)|<(?P<w>syntaxhighlight|nowiki)[^>]*>.*?(?:</(?P=w)>|\Z)|<source lang[^>]*>.*?(?:</source>|\Z))"
    r"|(?P<tex>\\begin\{(?P<e>verbatim|lstlisting|minted)\*?\}.*?(?:\\end\{(?P=e)\*?\}|\Z))|(?P<html><pre[^>]*>.*?(?:</pre>|\Z))",
    re.S | re.M | re.I,
)
_LATEX = re.compile(
    r"\\[a-zA-Z]{2,}\*?\s?[{\[]|(?<![\w:\\.])\\(?:item|maketitle|tableofcontents|noindent|newline|hline|par|alpha|beta|gamma|sum|frac|sqrt|int|cdot|leq|geq|ldots|quad|centering|bigskip|medskip|smallskip|label|today|LaTeX|TeX)(?![\w\\])"
    r"|\\\[|\\\(|\$\$|(?<![\\$\w])\$[^$\n]{0,200}?[_^\\{][^$\n]{0,200}?\$|``[^`\n]{1,300}?''|\\\\(?=\s|$)"
)
_WIKI = re.compile(
    r"^={2,6}[ \t]*[^=\s][^\n]*?={2,6}[ \t]*$|^h[1-6]\.[ \t]+\S|\[\[|\]\]|\{\{|\}\}|'''|^\{\||^\|\}|^\|-[ \t]*$|^\|\||\{code\b|\{noformat\}|\[https?://[^\s\]]+ [^\]\n]+\]|\[[^\[\]|\n]+\|[^\[\]\n]+\](?!\()"
    rf"|</?(?:{_WIKI_ELEMENTS})[\s/>]|^#redirect\b",
    re.M | re.I,
)
_WIKI_ITALIC = re.compile(r"(?<![\w'])''[^'\n]+''(?!')")
_MARKDOWN = re.compile(
    r"(?<![\w*])\*\*\*?[^\s*]|[^\s*]\*\*\*?(?![\w*])|(?<![\w_])__[^\s_]|[^\s_]__(?![\w_])|^`{3,}|^~{3,}|(?<!`)`[^`\n]+`(?![`'])|!?\[[^\]\n]*\]\([^)\n]*\)|!?\[[^\]\n]+\]\[[^\]\n]*\]|^\[[^\]\n]+\]:[ \t]+\S"
    r"|^\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$|~~\S|^[^\s#>|=-][^\n]*\n={4,}[ \t]*$|^[^\s#>|=-][^\n]*\n-{4,}[ \t]*$|\]\((?:https?:|/)[^)\n]*\)",
    re.M,
)
# What a wiki page or LaTeX text can explain.
_MARKDOWN_SHARED = re.compile(r"^#{1,6}[ \t]+\S|^>[ \t]\S|(?<![\w*])\*[^\s*][^*\n]*?[^\s*]\*(?![\w*])|(?<![\w_])_[^\s_][^_\n]*?_(?![\w_])", re.M)
_ANY = re.compile(r"[<&\\$`*_\[\]{}#=|~>']|^h[1-6]\.", re.M)


# What a text must hold for a pattern to be met at all: looking for it is far cheaper than the pattern.
_SIGNS_LATEX = ("\\", "$", "``")
_SIGNS_WIKI = ("==", "[[", "]]", "{{", "}}", "'''", "|", "{code", "{noformat}", "[http", "<", "#redirect", "h1.", "h2.", "h3.", "h4.", "h5.", "h6.")  # of the text in lower case
_SIGNS_MARKDOWN = ("**", "__", "`", "](", "][", "]:", "~~", "---", "====")
_SIGNS_SHARED = ("#", ">", "*", "_")


def _holds(text: str, signs: tuple[str, ...]) -> bool:
    return any(s in text for s in signs)


def found(text: str | None) -> list[str]:
    """The families of which ``text`` holds a construct, in the order of FAMILIES; none for a null or empty text."""
    if not text or not _ANY.search(text):
        return []
    regions = set()

    def aside(m: re.Match) -> str:
        regions.update(k for k in ("md", "wiki", "tex", "html") if m.group(k))
        return "\n"

    rest = _CODE.sub(aside, text) if "{" in text or "<" in text or "```" in text or "~~~" in text else text
    latex = "tex" in regions or _holds(rest, _SIGNS_LATEX) and bool(_LATEX.search(rest))
    wiki = "wiki" in regions or _holds(rest.lower(), _SIGNS_WIKI) and bool(_WIKI.search(rest)) or (not latex and "''" in rest and bool(_WIKI_ITALIC.search(rest)))
    if latex and wiki and not re.search(r"^={2,6} |^h[1-6]\. |\[\[|'''|^\{\|", rest, re.M):
        wiki = False  # braces and brackets that LaTeX explains
    markdown = "md" in regions or _holds(rest, _SIGNS_MARKDOWN) and bool(_MARKDOWN.search(rest)) or (not wiki and not latex and _holds(rest, _SIGNS_SHARED) and bool(_MARKDOWN_SHARED.search(rest)))
    if markdown and (wiki or latex) and "md" not in regions and not re.search(r"\*\*[^\s*]|\]\(|^\|?[ \t]*:?-{3,}", rest, re.M):
        markdown = False
    html = "html" in regions or "<" in rest and bool(_TAG.search(rest)) or "&" in rest and any(entities.unescape(m) != m for m in _ENTITY.findall(rest))
    return [name for name, is_it in zip(FAMILIES, (html, markdown, wiki, latex), strict=True) if is_it]


def _html(text: str) -> str:
    """HTML as the neutral form that the other converters make too: lines with signs of the private use area."""

    def tag(m: re.Match) -> str:
        if not m.group(2):
            return ""
        name, closing = m.group(2).lower(), bool(m.group(1))
        if name[0] == "h" and name[1:].isdigit():
            return "\n" if closing else f"\n{_HEAD}{name[1]}"
        if name == "li":
            return "" if closing else f"\n{_ITEM}"
        if name in ("td", "th"):
            return _CELL if closing else ""
        if name == "tr":
            return "\n" if closing else f"\n{_ROW}"
        if name == "sub":
            return "" if closing else "_"
        if name == "sup":
            return "" if closing else "^"
        return "\n" if name in _BLOCKS else ""

    text = re.sub(r"<(script|style)\b.*?</\1\s*>", "", text, flags=re.S | re.I)
    return entities.unescape(_TAG.sub(tag, text)).replace("\xa0", " ")


# Private-use signs of the neutral form: heading (and its level), item, numbered item, table row, cell, code line, formula, code place.
_HEAD, _ITEM, _NUMBER, _ROW, _CELL, _FORMULA, _PLACE = "\ue010", "\ue011", "\ue012", "\ue013", "\ue014", "\ue015", "\ue016"
_BLOCKS = frozenset("address article aside blockquote body br dd div dl dt footer form header hr html main nav ol p section table tbody thead ul".split())


def _wiki(text: str) -> str:
    text = re.sub(r"^(={2,6})[ \t]*(.*?)[ \t]*={2,6}[ \t]*$", lambda m: f"{_HEAD}{len(m.group(1))}{m.group(2)}", text, flags=re.M)
    text = re.sub(r"^h([1-6])\.[ \t]+", lambda m: _HEAD + m.group(1), text, flags=re.M)
    text = re.sub(r"^\*+[ \t]+", _ITEM, text, flags=re.M)
    text = re.sub(r"^#+[ \t]+", _NUMBER, text, flags=re.M)
    text = re.sub(r"^\{\|.*$|^\|\}[ \t]*$|^\|-.*$|^\|\+.*$", "", text, flags=re.M)
    text = re.sub(r"^\|\|?(.*?)\|?\|?[ \t]*$|^!(.*)$", lambda m: _ROW + re.sub(r"\s*(?:\|\||!!|\|)\s*", _CELL, (m.group(1) or m.group(2) or "").strip()), text, flags=re.M)
    text = re.sub(r"\{\{math\|(.*?)\}\}|<math>(.*?)</math>", lambda m: f"{_FORMULA}{m.group(1) or m.group(2)}{_FORMULA}", text, flags=re.S)
    text = re.sub(r"\{\{(?:[^{}|]*\|)*([^{}|]*)\}\}", r"\1", text)
    text = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", text)
    text = re.sub(r"\[https?://\S+[ \t]+([^\]\n]+)\]", r"\1", text)
    text = re.sub(r"\[([^\[\]|\n]+)\|[^\[\]\n]+\]", r"\1", text)
    return re.sub(r"'{2,5}|\[\[|\]\]|\{\{|\}\}", "", text)


def _markdown(text: str) -> str:
    text = re.sub(r"^([^\s][^\n]*)\n(=|-){4,}[ \t]*$", lambda m: f"{_HEAD}{1 if m.group(2) == '=' else 2}{m.group(1)}", text, flags=re.M)
    text = re.sub(r"^(#{1,6})[ \t]+(.*?)[ \t]*#*$", lambda m: f"{_HEAD}{len(m.group(1))}{m.group(2)}", text, flags=re.M)
    text = re.sub(r"^[ \t]*[*+-][ \t]+", _ITEM, text, flags=re.M)
    text = re.sub(r"^[ \t]*\d+[.)][ \t]+", _NUMBER, text, flags=re.M)
    text = re.sub(r"^\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$", "", text, flags=re.M)
    text = re.sub(r"^\|(.*?)\|?[ \t]*$", lambda m: _ROW + re.sub(r"\s*\|\s*", _CELL, m.group(1).strip()), text, flags=re.M)
    text = re.sub(r"^>[ \t]?", "", text, flags=re.M)
    text = re.sub(r"^\[[^\]\n]+\]:[ \t]+\S.*$", "", text, flags=re.M)
    text = re.sub(r"!?\[([^\]\n]*)\](?:\([^)\n]*\)|\[[^\]\n]*\])", r"\1", text)
    text = re.sub(r"\*{1,3}(?=\S)([^*\n]*?\S)\*{1,3}", r"\1", text)
    text = re.sub(r"(?<!\w)_{1,3}(?=\S)([^_\n]*?\S)_{1,3}(?!\w)", r"\1", text)
    return re.sub(r"~~|\*\*|(?<!`)`(?!`)|(?<!\w)__|__(?!\w)", "", text)


def _latex(text: str) -> str:
    text = re.sub(r"(?<!\\)%.*$", "", text, flags=re.M)
    text = re.sub(r"\\\[(.*?)\\\]|\$\$(.*?)\$\$|\\begin\{(?:equation|align)\*?\}(.*?)\\end\{(?:equation|align)\*?\}", lambda m: f"\n{_FORMULA}{' '.join(next(g for g in m.groups() if g is not None).split())}{_FORMULA}\n", text, flags=re.S)
    text = re.sub(r"(?<!\\)\$([^$\n]*?[_^\\{][^$\n]*?)\$|\\\((.*?)\\\)", lambda m: f"{_FORMULA}{m.group(1) or m.group(2)}{_FORMULA}", text)
    kept = text.split(_FORMULA)
    for i in range(0, len(kept), 2):
        t = kept[i]
        t = re.sub(r"\\(part|chapter|section|subsection|subsubsection|paragraph)\*?\{([^{}]*)\}", lambda m: f"\n{_HEAD}{('part', 'chapter', 'section', 'subsection', 'subsubsection', 'paragraph').index(m.group(1)) or 1}{m.group(2)}\n", t)
        rows = re.split(r"(\\begin\{tabular\*?\}(?:\{[^{}]*\})*|\\end\{tabular\*?\})", t)
        inside = False
        for j, part in enumerate(rows):
            if j % 2:
                inside, rows[j] = part.startswith("\\begin"), "\n"
            elif inside:
                rows[j] = "\n".join(_ROW + re.sub(r"\s*(?<!\\)&\s*", _CELL, r.replace("\\hline", "").strip()) for r in part.split("\\\\") if r.strip())
        t = re.sub(r"\\item(?:\[[^\]]*\])?[ \t]*", "\n" + _ITEM, "".join(rows))
        t = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\])?", "\n", t)
        t = re.sub(r"~?\\(?:cite|ref|eqref|pageref|label|footnote|bibliography\w*|usepackage|documentclass)\*?(?:\[[^\]]*\])?\{[^{}]*\}", "", t)
        t = re.sub(r"\\href\{[^{}]*\}\{([^{}]*)\}", r"\1", t)
        unwrapped = 1
        while unwrapped:  # from the inmost out, each time shorter
            t, unwrapped = re.subn(r"\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}", r"\1", t)
        t = re.sub(r"\\\\(?=\s|$)|(?<![\w:\\])\\(?:hline|maketitle|centering|noindent|newline|bigskip|medskip|smallskip)\b", "", t)
        kept[i] = re.sub(r"\\([%&$#_{}])", r"\1", t).replace("``", "“").replace("''", "”").replace("~", " ")
    return _FORMULA.join(kept)


def blocks(text: str | None) -> tuple[list[str], list[dict] | None]:
    """The families found, and the text as blocks: kind, level (of a heading, else 0) and text. Null gives null, an empty text no block."""
    families = found(text)
    if text is None:
        return families, None
    codes: list[str] = []

    def aside(m: re.Match) -> str:
        body = re.sub(r"^(?:`{3,}|~{3,})[^\n]*\n|^(?:`{3,}|~{3,})[ \t]*\Z|\{code[^}\n]*\}|\{noformat\}|\\(?:begin|end)\{[a-z]+\*?\}(?:\[[^\]]*\])?|</?(?:pre|code|syntaxhighlight|source|nowiki)[^>]*>", "", m.group(), flags=re.M | re.I)
        codes.append((entities.unescape(body) if m.group("html") else body).strip("\n"))
        return f"\n{_PLACE}{len(codes) - 1}\n"

    now = _CODE.sub(aside, text) if families else text
    for name, convert in (("wiki", _wiki), ("markdown", _markdown), ("latex", _latex), ("html", _html)):
        if name in families:
            now = convert(now)
    out: list[dict] = []
    for line in now.split("\n"):
        kind, level, line = "paragraph", 0, line.strip()
        if line[:1] == _PLACE:
            out.append({"kind": "code", "level": 0, "text": codes[int(line[1:])]})
            continue
        if line[:1] == _HEAD:
            kind, level, line = "heading", int(line[1]), line[2:]
        elif line[:1] in (_ITEM, _NUMBER):
            kind, line = "item", line[1:]
        elif line[:1] == _ROW:
            kind, line = "table", "\t".join(c.strip() for c in line[1:].rstrip(_CELL).split(_CELL))
        elif line[:1] == line[-1:] == _FORMULA and line.count(_FORMULA) == 2:
            kind = "formula"
        line = re.sub("[\ue010-\ue016]", "", line).strip() if kind == "table" else re.sub(r"[ \t]{2,}", " ", re.sub("[\ue010-\ue016]", "", line)).strip()
        if line:
            out.append({"kind": kind, "level": level, "text": line})
    return families, out


def plain(parts: list[dict] | None) -> str | None:
    """Blocks as clean text: a line each, a dash before items, code as it stands."""
    if parts is None:
        return None
    return "\n".join(("- " if b["kind"] == "item" else "") + b["text"] for b in parts)


def markup_families(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col`` and markup (array of families found) of every row, without conversion; as clean_markup otherwise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([found(t) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))], ["__id", "markup"])

    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(run, f"__id {kind}, markup array<string>").withColumnRenamed("__id", id_col)


def clean_markup(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col``, markup (array of families found), blocks (array of kind, level, text) and clean (the text) of every row.

    A null text has no markup and null blocks and text; an empty one no markup, no blocks and an empty text. A text
    without markup keeps its lines. Equal rows come out as often as they go in; texts are read whole. Columns besides
    the two are not used. One pass, no shuffle.
    """
    block = pa.struct([("kind", pa.string()), ("level", pa.int32()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [blocks(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f for f, _ in made], pa.list_(pa.string())), pa.array([b for _, b in made], pa.list_(block)), pa.array([plain(b) for _, b in made], pa.string())],
                ["__id", "markup", "blocks", "clean"],
            )

    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(run, f"__id {kind}, markup array<string>, blocks array<struct<kind:string,level:int,text:string>>, clean string").withColumnRenamed("__id", id_col)


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """The places in ``a`` of a longest common subsequence of the lines of two pages."""
    at: dict[str, list[int]] = {}
    for j, line in enumerate(b):
        at.setdefault(line, []).append(j)
    ends: list[int] = []  # of the common subsequences of each length the smallest last place in b
    last: list[tuple] = []  # their last pair, and the pair before it
    for i, line in enumerate(a):
        for j in reversed(at.get(line, ())):
            k = bisect_left(ends, j)
            pair = (i, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(pair)
            else:
                ends[k], last[k] = j, pair
    found, pair = set(), last[-1] if last else None
    while pair:
        found.add(pair[0])
        pair = pair[1]
    return found


def differenced(df: DataFrame, id_col: str, text_col: str, url_col: str) -> DataFrame:
    """``id_col``, text without the lines that the page's neighbour by address shares with it, and removed, their number, of each web page.

    Within a host pages are ordered by path, and each is aligned with the one before it, the first with the one behind it. A page that
    is alone keeps its lines; equal addresses are neighbours. Rows without an address of http or with a null text give no row; an empty
    text stays. Pages are ranged over the partitions by host and path, so a large host is no one task's work; the first page of a
    partition is compared with the one behind it.
    """
    kind = dict(df.dtypes)[id_col]
    url = F.col(f"`{url_col}`").cast("string")
    host, path = F.lower(F.regexp_extract(url, r"(?i)^\s*https?://([^/?#:\s]+)", 1)), F.regexp_extract(url, r"(?i)^\s*https?://[^/?#]+([^?#]*)", 1)
    pages = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("text"), host.alias("host"), path.alias("path")).filter("host <> '' and text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the page before, and if it is the first of its host, that it waits

        def made(rows: list[tuple]) -> pa.RecordBatch:
            out = []
            for page, other in rows:
                lines = page[1].split("\n")
                gone = common_lines(lines, other[1].split("\n")) if other else set()
                gone = {i for i in gone if lines[i].strip()}
                out.append((page[0], "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], batch.schema.field(0).type), pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.int32())], ["__id", "text", "removed"])

        for batch in batches:
            rows = []
            for page in zip(*(batch.column(c).to_pylist() for c in ("__id", "text", "host")), strict=True):
                before, waits = held[0] if held else (None, False)
                same = before is not None and before[2] == page[2]
                if waits:
                    rows.append((before, page if same else None))
                if same:
                    rows.append((page, before))
                held = [(page, not same)]
            if rows:
                yield made(rows)
        if held and held[0][1]:
            yield made([(held[0][0], None)])

    rows = pages.repartitionByRange("host", "path", "__id").sortWithinPartitions("host", "path", "__id")
    return rows.select("__id", "text", "host").mapInArrow(run, f"__id {kind}, text string, removed int").withColumnRenamed("__id", id_col)
