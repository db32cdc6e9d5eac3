"""Analysis: text to tokens, and the string functions around documents and their addresses. All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The languages with an analyzer, and the names and codes that stand for them.
LANGUAGES = (
    "arabic bulgarian bengali brazilian catalan czech danish dutch english finnish french german greek hungarian italian japanese korean norwegian "
    "portuguese russian spanish swedish thai turkish"
).split()
ALIASES = {
    "en": "english", "de": "german", "ru": "russian", "nl": "dutch", "fr": "french", "it": "italian", "no": "norwegian", "pt": "portuguese", "sp": "spanish",
    "es": "spanish", "br": "brazilian", "cn": "chinese", "gr": "greek", "el": "greek", "th": "thai", "dk": "danish", "da": "danish", "jp": "japanese",
    "ja": "japanese", "kr": "korean", "kp": "korean", "ko": "korean", "sv": "swedish", "fi": "finnish", "pl": "polish", "cs": "czech", "hu": "hungarian", "tr": "turkish",
}
# A word keeps apostrophes, dots and colons between letters, and dots and commas between digits.
TOKEN = r"[\p{L}\p{M}\p{N}_]+(?:['’.:·][\p{L}\p{M}_]+|[.,;'][\p{N}]+)*"
# Words of a search that say nothing of a passage.
CONTEXT_STOP_WORDS = "the a an and or but is in on at to for with by about as of this that".split()
SUMMARY = 200


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def language(name: Column) -> Column:
    """The language that a name or code stands for; null gives english, an unknown one itself in lower case."""
    code = F.lower(F.trim(name))
    table = F.create_map(*(F.lit(x) for pair in ALIASES.items() for x in pair))
    return F.coalesce(F.try_element_at(table, code), code, F.lit("english"))


def check_language(name: str | None) -> str:
    """The analyzer's language for a name; an error where there is none."""
    code = (name or "english").strip().lower()
    full = ALIASES.get(code, code)
    if full not in LANGUAGES:
        raise ValueError(f"no analyzer for language [{name}]")
    return full


# Light stemmers of inflected languages as ending patterns, longest first: fixed values.
STEMS = {
    "german": r"(?<=.{3})(?:ern|em|en|er|es|e|n|s)$", "french": r"(?<=.{3})(?:aient|ements?|ions|ées?|és|er|ez|es|e|s)$", "spanish": r"(?<=.{3})(?:aron|ieron|aciones|ación|ados?|adas?|as|os|es|a|o|e)$",
    "italian": r"(?<=.{3})(?:azioni|azione|ato|ata|ati|ate|i|e|o|a)$", "portuguese": r"(?<=.{3})(?:ações|ação|ados?|adas?|as|os|es|a|o|e)$", "brazilian": r"(?<=.{3})(?:ações|ação|ados?|adas?|as|os|es|a|o|e)$",
    "dutch": r"(?<=.{3})(?:heden|en|e|s)$", "swedish": r"(?<=.{3})(?:arna|erna|orna|ar|er|or|en|et|a|s)$", "norwegian": r"(?<=.{3})(?:ene|ane|er|en|et|e|s)$", "danish": r"(?<=.{3})(?:erne|ene|er|en|et|e|s)$",
    "russian": r"(?<=.{3})(?:ами|ями|ого|его|ому|ему|ов|ев|ам|ям|ах|ях|ой|ей|ый|ий|ая|яя|ое|ее|ые|ие|а|я|о|е|ы|и|у|ю|ь)$", "finnish": r"(?<=.{3})(?:ssa|ssä|sta|stä|lla|llä|lta|ltä|lle|ksi|n|t|a|ä)$",
    "hungarian": r"(?<=.{3})(?:okat|eket|ban|ben|nak|nek|ok|ek|k|t)$", "czech": r"(?<=.{3})(?:ami|ech|ách|ích|ou|y|i|e|a|u|o)$", "catalan": r"(?<=.{3})(?:acions|ació|ats|ades|es|s|a|o)$",
    "turkish": r"(?<=.{3})(?:lar|ler|ları|leri|da|de|dan|den|ın|in)$", "bulgarian": r"(?<=.{3})(?:ите|ата|ят|ът|та|то|те|и|а|о|е)$", "greek": r"(?<=.{3})(?:ους|ων|ος|ης|ας|ες|οι|ου|η|α|ο|ι)$",
}


# Words that say nothing, of the languages whose analyzers leave them out; english keeps all words.
STOPS = {
    "german": "der die das und oder in den von zu mit ist ein eine auf für".split(), "french": "le la les des et ou un une dans en du de à est que".split(), "spanish": "el la los las de y o en un una que es por con para".split(),
    "italian": "il lo la gli le di e o in un una che è per con".split(), "portuguese": "o a os as de e ou em um uma que é por com para".split(), "brazilian": "o a os as de e ou em um uma que é por com para".split(),
    "dutch": "de het een en of in van op te met is dat die".split(), "swedish": "och eller i en ett den det att av på som är".split(), "norwegian": "og eller i en et den det å av på som er".split(), "danish": "og eller i en et den det at af på som er".split(),
    "russian": "и в не на что с по из у за от или".split(), "finnish": "ja tai on ei se että oli".split(), "hungarian": "a az és vagy egy hogy nem is".split(), "czech": "a i nebo v na se je že do s".split(),
}


def tokens(text: Column, language_name: str | None = "english") -> Column:
    """The tokens of a text in order. english: lower case, nothing cut off; japanese and korean: pairs of neighbouring
    characters; languages with endings: light stems, without the words of STOPS; others as english. Null gives an empty array."""
    name = check_language(language_name)
    words = F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0), F.array().cast("array<string>"))
    if name in ("japanese", "korean"):
        return cjk_bigrams(words)
    if name in STOPS:
        words = F.filter(words, lambda w: ~w.isin(STOPS[name]))
    if name in STEMS:
        return F.transform(words, lambda w: F.regexp_replace(w, STEMS[name], ""))
    return words


def cjk_bigrams(words: Column) -> Column:
    """Words of CJK characters as pairs of neighbours (a single one as it is), other words whole."""
    return F.flatten(
        F.transform(
            words,
            lambda w: F.when(
                w.rlike(r"^[\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{ac00}-\x{d7af}]{2,}$"), F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, F.lit(2)))
            ).otherwise(F.array(w)),
        )
    )


def tfidf_tokens(text: Column, english: bool = True) -> Column:
    """Tokens for the term-weight embedding: everything but letters and digits (for english ASCII ones) parts words."""
    clean = F.regexp_replace(F.lower(text), r"[^a-z0-9\s]" if english else r"[^\p{L}\p{N}\s]", " ")
    return F.filter(F.split(F.trim(F.regexp_replace(clean, r"\s+", " ")), " "), lambda w: w != "")


def plain_tokens(text: Column) -> Column:
    """Lower-cased text split at white space."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def context_keywords(text: Column) -> Column:
    """Words of a query that passages are scored by: longer than two characters, no stop words."""
    return F.filter(plain_tokens(text), lambda w: (F.length(w) > 2) & ~w.isin(CONTEXT_STOP_WORDS))


def shortened(text: Column, size: int, dots: str = "") -> Column:
    """At most ``size`` characters of a text, with ``dots`` behind it where something is cut off."""
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit(dots))).otherwise(text)


def summary(text: Column) -> Column:
    return shortened(text, SUMMARY)


def occurrences(text: Column, part: Column) -> Column:
    """How often ``part`` occurs in ``text`` without overlap; 0 for an empty part."""
    return F.when(F.length(part) > 0, ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("int")).otherwise(0)


def highlighted(text: Column, word: Column, begin: str = "<B>", end: str = "</B>") -> Column:
    """``text`` with each occurrence of ``word``, in any case, between the marks; its own case stays."""
    quoted = F.concat(F.lit("(?i)"), F.regexp_replace(word, r"([^\p{L}\p{N}\s])", r"\\$1"))
    return F.when(F.length(word) > 0, F.regexp_replace(text, quoted, F.lit(begin.replace("\\", "\\\\").replace("$", "\\$") + "$0" + end.replace("\\", "\\\\").replace("$", "\\$")))).otherwise(text)


def timestamp_text(ts: Column) -> Column:
    """A timestamp as digits down to the millisecond."""
    return F.date_format(ts, "yyyyMMddHHmmssSSS")


def extension(name: Column) -> Column:
    """The extension of a file name in lower case, '' where it has none."""
    return F.lower(F.regexp_extract(F.regexp_extract(name, r"([^/\\]*)$", 1), r"\.([^.]+)$", 1))


def normal_extension(pattern: Column) -> Column:
    """``*.x`` and ``.x`` as ``x``, in lower case."""
    return F.lower(F.regexp_replace(F.trim(pattern), r"^\*?\.", ""))


def extension_allowed(name: Column, patterns: list[str]) -> Column:
    """Whether a file name passes an extension filter: ``*.`` no extension, ``.*`` and ``*.*`` any, else that one. An empty list passes none."""
    ext, passes = extension(name), F.lit(False)
    for p in (x.strip().lower() for x in patterns):
        if p == "*.":
            passes = passes | (ext == "")
        elif p in (".*", "*.*"):
            passes = passes | (ext != "")
        elif p:
            passes = passes | (ext == p.removeprefix("*").removeprefix("."))
    return passes


def without_default_port(root: Column) -> Column:
    """Scheme and host of an address without the port that its scheme has anyway."""
    return F.regexp_replace(F.regexp_replace(root, r"(?i)^(http://.*):80$", "$1"), r"(?i)^(https://.*):443$", "$1")


def _parts(url: Column) -> tuple[Column, Column, Column]:
    """Scheme with host and port, path, and what is behind it."""
    shape = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)([^?#]*)(.*)$"
    return without_default_port(F.regexp_extract(url, shape, 1)), F.regexp_extract(url, shape, 2), F.regexp_extract(url, shape, 3)


def directory_of(url: Column) -> Column:
    """The directory of an address, with a slash behind it. A path without a dot is a directory itself, and one that ends in a slash
    stays as it is, its query included; of another path it is what stands before the last slash before the last dot. What is no
    address stays."""
    root, path, rest = _parts(url)
    own = F.when(path.contains("."), F.regexp_replace(F.regexp_replace(path, r"\.[^.]*$", ""), r"[^/]*$", "")).otherwise(F.concat(path, F.when(F.endswith(path, F.lit("/")), rest).otherwise("/")))
    return F.when(root == "", url).otherwise(F.concat(root, own))


def joined_url(base: Column, path: Column) -> Column:
    """``base`` and ``path`` with one slash between; ``path``, without the slash before it, alone if it starts with ``base`` already,
    whatever the case. One that is empty or null leaves the other as it is; backslashes become slashes."""
    b, p = F.coalesce(base, F.lit("")), F.coalesce(path, F.lit(""))
    short = F.regexp_replace(F.regexp_replace(p, r"\\", "/"), "^/", "")
    root = F.regexp_replace(F.regexp_replace(b, r"\\", "/"), "/$", "")
    return F.when(b == "", p).when(p == "", b).when(F.startswith(F.lower(short), F.lower(root)), short).otherwise(F.concat(root, F.lit("/"), short))


def normal_url(url: Column) -> Column:
    """An address as a crawler compares it: host in lower case, no default port, no fragment, a slash behind a path without a dot, which is a directory."""
    root, path, rest = _parts(F.trim(url))
    query = F.regexp_extract(rest, r"^(\?[^#]*)", 1)
    own = F.concat(F.lower(root), path, F.when(path.contains(".") | F.endswith(path, F.lit("/")), "").otherwise("/"), query)
    return F.when(root == "", F.trim(url)).otherwise(own)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"(?i)^https?://([^/?#:]+)", 1))


def document_uid(path: Column, modified: Column) -> Column:
    """A document's identity: its path with NUL for slashes, and its time of change."""
    return F.concat(F.replace(path, F.lit("/"), F.lit("\0")), F.lit("\0"), timestamp_text(modified))


def uid_url(uid: Column) -> Column:
    """The path that a document's identity was made of."""
    return F.regexp_replace(F.replace(uid, F.lit("\0"), F.lit("/")), r"/[^/]*$", "")


def safe_directory(name: Column) -> Column:
    """A collection's folder: CF, its name with anything but ASCII letters and digits as _, and, where something was
    replaced, the sum of the replaced characters' codes times their places."""
    places = F.sequence(F.lit(1), F.length(name))
    odd = F.filter(places, lambda i: F.substring(name, i, F.lit(1)).rlike("[^A-Za-z0-9]"))
    total = F.aggregate(odd, F.lit(0).cast("bigint"), lambda a, i: a + F.ascii(F.substring(name, i, F.lit(1))) * (i + 1))
    return F.concat(F.lit("CF"), F.regexp_replace(name, "[^A-Za-z0-9]", "_"), F.when(F.size(odd) > 0, total.cast("string")).otherwise(""))
