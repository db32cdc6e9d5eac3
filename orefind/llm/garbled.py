"""Text decoded with the wrong character encoding: where it is, and what it was.

Characters are mapped back to the bytes of the encoding they were wrongly read in. An automaton over these bytes finds
the maximal spans that are well-formed UTF-8 multibyte sequences, and only those spans are decoded, again and again while
that yields more. Text of one single-byte encoding read as another has no such structure; there, words that no
spelling explains (a capital or a symbol inside a lower-case word, a run of Western accented letters) point to the pair of
encodings under which they become ordinary words, if several words, or one long one, say so together; of Cyrillic, the spans that are likelier Russian in another encoding, by
the letters' own frequencies and case, are translated.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The single-byte encodings that text is wrongly read in, and those it is written in besides UTF-8.
READ_AS = ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "cp437", "cp850", "cp866", "mac-roman", "koi8-r", "cp1254", "iso8859-15", "lower:cp1252")
WRITTEN_IN = ("cp1252", "cp1251", "koi8-r", "mac-roman", "cp1250", "cp437", "cp850", "cp866", "iso8859-2")
# What a span may decode to: Western and Central European letters and signs, Cyrillic of modern Russian, Greek, common punctuation, CJK, emoji.
_SENSE = re.compile("[\x80-ſƒȘ-țˆ-˝Ά-ώЁА-яёЄІЇєіїҐґ‐-⁄€№™←-⋿─-◿ﬁﬂ　-ヿ一-鿿가-힣\U0001f300-\U0001faff﻿�]+")
_LOWER = "a-zß-öø-ÿāăąćčďđęěğıłńňœřśşšťůźżžșț"
_UPPER = "À-ÖØ-ÞĂĄĆČĎĐĘĚŁŃŇŒŘŚŠŤŮŹŻŽŸ"
# Signs that stand in no word, and letters of other scripts, between or beside Latin lower-case letters.
_ODD = "¢¤¥¦§¨ª¬¯±²³´µ¶¸¹º¼½¾×÷ˆ˙˚˛˜˝†‡‰ƒ‚„ⁿ∂∑√∫≈≠≤≥∞∏π◊ﬁﬂΓΘΣΦΩαδεστφ⌐⌠⌡░▒▓─│┐└┴┬├┼╞╟╚╔╩╦╠═╬╧╨╤╥╙╘╒╓╫╪┘┌█▄▌▐▀║╗╝╜╛╖╕╢╡╣┤»«€£™®©"
# Cyrillic inside a Latin word; letters in the place of quotation marks, or of the apostrophe before the end of an English word.
_INSTEAD = r"(?<!\w)ô[A-Za-z]\w*ö(?!\w)|(?<=[a-z]n)ít(?!\w)"
_MIXED = re.compile(f"[a-z]{{2}}[Ѐ-џ]|[Ѐ-џ][a-z]{{2}}|{_INSTEAD}")
_ODD_WORD = re.compile(
    f"[{_LOWER}][{_ODD}\x80-\x9f][{_LOWER}]|[{_LOWER}]{{2}}[▀ﬂ‰§³¹ˆ¸˙˚÷ⁿ±¿¶]|\\b[A-ZÀ-Þ][{_ODD}\x80-\x9f][{_LOWER}]{{2}}"  # a sign inside a word
    f"|[{_LOWER}][{_UPPER}][{_LOWER}]|\\b[A-Z][{_UPPER}][{_LOWER}]|(?<!\\w)[øїÀ└┐ї][A-Z][{_LOWER}]{{2}}|[{_LOWER}]{{3}}[{_UPPER}](?!\\w)"  # a capital inside one
    f"|[a-z]{{2}}[Ѐ-џ]|[Ѐ-џ][a-z]{{2}}|{_INSTEAD}"
    "|(?<=\\s)[ªÈÐÆ╗║╧¯](?=\\s)"  # a sign or letter alone that is neither word nor sign
    "|(?<!\\w)ì[A-Za-zÀ-ÿ]"  # a quotation mark become a letter
    "|[À-ÿ¸¨¹]{4}|[─-▟](?![─-▟])|[\x80-\x84\x86-\x9f]"
)
_WORD_LIKE = re.compile(r"[^\W\d_]{3}|[^\W\d_][^\w\s][^\W\d_]{2}|[^\W\d_]{2}[^\w\s]")  # a sign may stand for a letter
_CONTROLS = re.compile("[\x80-\x84\x86-\x9f]")  # no text has them
_BEYOND = re.compile(r"\S*[^\x00-\x7f\s]\S*")
_CYRILLIC = re.compile("[Ѐ-џҐґ]{3,}")
# No text without one of these is affected.
_ORDINARY = frozenset(map(chr, range(128))) | frozenset("äöüßÄÖÜéèêëàâçùûîïôñáíóúÁÉÍÓÚÀÈÊÇÑœ¿¡»«–—‘’“”„…·›‹©№ąćęłńóśźżĄĆĘŁŃŚŹŻ°µ•€")
_SIGNS = "·¿¡»«–—‘“”„…›‹©№°µ•€"
_CASES = re.compile(f"[{_UPPER}{_SIGNS}À-ÿ](?:(?<=[{_LOWER}][{_UPPER}])|(?<=[{_LOWER}][{_SIGNS}])(?=[{_LOWER}])|(?<=â)€|(?<=[À-ÿ])[À-ÿ]{{3}}|(?<=\\s[ÈÉ])(?=\\s))")
_RUSSIAN_TOO = _ORDINARY | frozenset(map(chr, range(0x410, 0x450))) | frozenset("Ёё")
# What a restored word is made of: those, and letters of some more languages.
_SPELLED = _RUSSIAN_TOO | frozenset("åøæÅØÆìòãõÃÕìÌÒÂÔÛÎÏËÙšžčřěůýťďňŠŽČŘÝőűŐŰşğıŞĞİțșăȚȘĂþðÞÐ")
_CYRILLIC_LETTER = re.compile("[Ѐ-џҐґ]")
_TOKEN = re.compile("[^\\x00-\\x20]+")
# A capital behind a small letter, a sign between letters, or a letter that begins no word.
_MISSPELLED = re.compile("(?<![Ѐ-џҐґ])[ЪЬъь](?=[Ѐ-џҐґ])|(?<=[а-яѐ-џґ])[Ѐ-ЯҐ]|(?<=[Ѐ-џҐґ])[^\\x00-\\x7fЀ-џҐґ«»–—‘’“”„…·\xa0](?=[Ѐ-џҐґ])")
_CAPITALS = re.compile("(?<![Ѐ-џҐґ])[Ѐ-ЯҐ]{2,}(?![Ѐ-џҐґ])")
# Pairs of encodings, as read and as written, that Cyrillic is tried with, and the log likelihood that a span must gain.
_SWAPS = (("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("mac-cyrillic", "cp1251"), ("cp1251", "mac-cyrillic"), ("iso8859-5", "cp1251"), ("cp1251", "iso8859-5"))
_CHANGE = 12
# Relative frequencies of Russian letters, in per mille.
_RUSSIAN = dict(zip("оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё", (110, 85, 80, 74, 67, 63, 55, 47, 45, 43, 35, 32, 30, 28, 26, 20, 19, 17, 17, 16, 16, 14, 12, 10, 9, 7, 6, 5, 4, 3, 3, 0.4, 0.4), strict=True))


@lru_cache(None)
def _to_bytes(codec: str) -> dict[str, int]:
    """The byte that each character beyond ASCII has in ``codec``; bytes it leaves undefined stand for themselves.
    A codec's name with ``lower:`` before it means text that was made lower case after it was wrongly read."""
    codec, lower = codec.removeprefix("lower:"), codec.startswith("lower:")
    table = {}
    for b in range(0x80, 0x100):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        table[c.lower() if lower and (b >= 0xC2 or c.lower() not in table) else c] = b
    return table


@lru_cache(None)
def _automaton(codec: str) -> re.Pattern:
    """Runs of characters whose bytes in ``codec`` are well-formed UTF-8 sequences of two to four bytes."""
    at = {b: c for c, b in _to_bytes(codec).items()}

    def of(first: int, last: int) -> str:
        return "[" + "".join(re.escape(at[b]) for b in range(first, last + 1) if b in at) + "]"

    more = of(0x80, 0xBF)
    forms = ((of(0xC2, 0xDF), more), (of(0xE0, 0xE0), of(0xA0, 0xBF), more), (of(0xE1, 0xEC), more, more), (of(0xED, 0xED), of(0x80, 0x9F), more), (of(0xEE, 0xEF), more, more), (of(0xF0, 0xF0), of(0x90, 0xBF), more, more), (of(0xF1, 0xF3), more, more, more), (of(0xF4, 0xF4), of(0x80, 0x8F), more, more))
    return re.compile("(?:" + "|".join("".join(f) for f in forms if "[]" not in f) + ")+")


def utf8_spans(text: str, codec: str, single: bool = False) -> list[tuple[int, int, str]]:
    """Maximal spans of ``text`` that, as bytes of ``codec``, are well-formed UTF-8 with a sensible meaning: start, end, meaning.
    A pair of letters of a Cyrillic encoding alone, or one that means a foreign sign beside Cyrillic letters, counts only if ``single`` is asked for."""
    found, table = [], _to_bytes(codec)
    for m in _automaton(codec).finditer(text):
        meaning = bytes(table[c] for c in m.group()).decode("utf-8")
        one = not single and len(meaning) < 2 and codec in ("cp1251", "koi8-r", "cp866")
        if _SENSE.fullmatch(meaning) and not (one and (m.group().isalpha() or meaning not in _RUSSIAN_TOO and _CYRILLIC_LETTER.search(text[m.start() - 1 : m.start()] + text[m.end() : m.end() + 1]))):
            found.append((m.start(), m.end(), meaning))
    return found


def _best_spans(text: str) -> list[tuple[int, int, str]]:
    best, size, of = [], 0, ""
    for codec in READ_AS:
        spans = utf8_spans(text, codec)
        covered = sum(b - a for a, b, _ in spans)
        if covered > size:
            best, size, of = spans, covered, codec
    return utf8_spans(text, of, True) if size >= 8 else best


@lru_cache(None)
def _swap_table(read: str, written: str) -> dict[int, str]:
    return {ord(c): bytes([b]).decode(written, errors="replace") for c, b in _to_bytes(read).items()}


@lru_cache(1 << 16)
def _gains(token: str) -> tuple[float, ...] | None:
    """By how much each of _SWAPS makes a token likelier as Russian; null for a token that speaks neither way."""
    beyond = [c for c in token if c > "\x7f" and c != "\ufffd"]
    if not beyond or not (len(beyond) < 3 or _CYRILLIC_LETTER.search(token)):
        return None
    as_is = _likely(token)
    # a character that the encoding doesn't have can't have been read in it
    gains = (_likely(token.translate(_swap_table(*s))) - as_is - 4 * sum(ord(c) not in _swap_table(*s) for c in beyond) for s in _SWAPS)
    return tuple(min(g, 1.0) if len(beyond) < 5 else g for g in gains)  # abbreviations and units are no evidence


def _likely(token: str) -> float:
    """The log likelihood of a token's characters beyond ASCII by the frequencies of Russian letters, less for letters that no spelling explains."""
    whole = 0.0
    for c in token:
        if c > "\x7f":
            whole += math.log(_RUSSIAN.get(c.lower(), 0.05) / 1000) if _CYRILLIC_LETTER.match(c) else -4 if c in _RUSSIAN_TOO or c == "\xa0" else -6
    return whole - 8 * len(_MISSPELLED.findall(token)) - 3 * len(_CAPITALS.findall(token))


def _cyrillic_spans(text: str) -> list[tuple[int, int, tuple[str, str]]]:
    """The maximal spans of ``text`` that a pair of encodings makes likelier as Russian, word for word: start, end, pair.

    The likeliest sequence of states, one for each pair and one for text that is right, each change into a pair costing _CHANGE.
    """
    if sum(map(len, _CYRILLIC.findall(text))) < 8:
        return []
    tokens = [(m.start(), m.end(), g) for m in _TOKEN.finditer(text) if (g := _gains(m.group()))]
    pairs = range(len(_SWAPS))
    right, wrong, back = 0.0, [-math.inf] * len(_SWAPS), []
    for _, _, gains in tokens:
        top = max(pairs, key=wrong.__getitem__)
        left = top if wrong[top] > right else None  # the pair that ends before this token
        right = max(right, wrong[top])
        entered = [right - _CHANGE >= wrong[k] for k in pairs]
        wrong = [max(wrong[k], right - _CHANGE) + gains[k] for k in pairs]
        back.append((left, entered))
    state = max(pairs, key=wrong.__getitem__)
    state = state if wrong[state] > right else None
    of: list[int | None] = [None] * len(tokens)
    for i in range(len(tokens) - 1, -1, -1):
        left, entered = back[i]
        of[i] = state
        if state is None or entered[state]:
            state = left
    found: list[tuple[int, int, tuple[str, str]]] = []
    for k, run in groupby(range(len(tokens)), key=of.__getitem__):
        if k is not None:
            own = list(run)
            found.append((tokens[own[0]][0], tokens[own[-1]][1], _SWAPS[k]))
    return found


def _odd(word: str) -> int:
    return len(_ODD_WORD.findall(f" {word} "))


def _evidence(words: set[str]) -> float:
    """How much different words say that their text is garbled: an odd word 1; one without three letters on end, such as a unit or a
    formula, 0.25; a letter alone, which is a word in some language, 0.4, or a name of a letter, 0.6. Less than 1 is none."""
    whole = 0.0
    for w in words:
        if odd := _odd(w):
            whole += (0.6 if w == "Ð" else 0.4 if w.isalpha() else 1.0) if len(w) == 1 else min(odd, 1) if _WORD_LIKE.search(w) else 0.25
    return whole


def _better(word: str, other: str) -> str:
    """``other`` where it is less odd than ``word``, or no odder and made of ordinary letters where ``word`` has letters."""
    before, after = _odd(word), _odd(other)
    if "\ufffd" in other or after > before:
        return word
    if _SPELLED.issuperset(other) and not _SPELLED.issuperset(word):
        return other
    same = all(c.isalpha() == d.isalpha() for c, d in zip(word, other, strict=True)) if len(word) == len(other) else False
    return other if after < before or (same and _RUSSIAN_TOO.issuperset(other)) else word


def _plain_swap(text: str) -> tuple[str, str] | None:
    """The pair of encodings that turns most odd words into ordinary ones, if those are evidence enough together."""
    found = {w for w in _BEYOND.findall(text) if _odd(w)}
    enough = _evidence(found)
    if enough < 1:
        return None
    words = f" {' '.join(w for w in _BEYOND.findall(text) if w in found or not _SPELLED.issuperset(w))} "
    strange = lambda t: sum(c not in _SPELLED for c in t)
    best, least = None, len(_ODD_WORD.findall(words)) + strange(words)
    for read in READ_AS:
        for written in WRITTEN_IN:
            if read != written:
                swapped = words.translate(_swap_table(read, written))
                odd = len(_ODD_WORD.findall(swapped)) + strange(swapped) + swapped.count("�")
                if odd < least:
                    best, least = (read, written), odd
    if best is None or enough - _evidence({w.translate(_swap_table(*best)) for w in found}) < 1:
        return None
    return best


def repair(text: str | None) -> tuple[bool, str | None]:
    """Whether ``text`` is garbled, and the text with what could be restored; null and empty texts are not garbled.

    Replacement characters are garbled text that can't be restored; they stay.
    """
    if not text or text.isascii():
        return False, text
    plain = _RUSSIAN_TOO.issuperset(text) and not _CASES.search(text)
    if plain and (_CYRILLIC_LETTER.search(text) or "nít" in text or "ô" in text and "ö" in text):  # without these the pattern isn't met
        plain = not _MIXED.search(text)
    if plain and not _CYRILLIC.search(text):
        return False, text
    garbled, now = "\ufffd" in text, text
    while not plain and (spans := _best_spans(now)):  # each time shorter
        parts, at = [], 0
        for a, b, meaning in spans:
            parts += [now[at:a], meaning]
            at = b
        now, garbled = "".join([*parts, now[at:]]), True
    if swaps := _cyrillic_spans(now):
        parts, at = [], 0
        for a, b, swap in swaps:
            parts += [now[at:a], now[a:b].translate(_swap_table(*swap))]
            at = b
        now, garbled = "".join([*parts, now[at:]]), True
    elif _ODD_WORD.search(now):
        if swap := _plain_swap(now):
            table = _swap_table(*swap)
            now, garbled = _BEYOND.sub(lambda m: _better(m.group(), m.group().translate(table)), now), True
        elif _CONTROLS.search(now):
            garbled = True
    return garbled, now


def repair_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col``, garbled (boolean) and restored (the text, repaired where it was garbled) of every row.

    Null and empty texts come out as they are, not garbled; equal rows come out as often as they go in; texts of any
    length are read whole. Columns besides the two are not used. One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [repair(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g for g, _ in results], pa.bool_()), pa.array([t for _, t in results], pa.string())], ["__id", "garbled", "restored"])

    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(run, f"__id {kind}, garbled boolean, restored string").withColumnRenamed("__id", id_col)
