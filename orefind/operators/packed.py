"""Several values packed into one string field, one value per row.

A field is split on its quoted literals: what stands inside a quote pair is taken as it is, what stands between them is
split on the delimiters in use. An array fold then numbers the values. Everything is built-in SQL on one row at a time:
no shuffle, no Python, any row on any executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The delimiters, and the quotes that may wrap a value.
DELIMITERS = ",;|\t\n\r·•，；"
# A quoted value, escaped characters and doubled quotes included; only at the start of a value and only if a value ends behind it.
_OPEN = r"(?:^|(?<=[{d}]))[ \x{{00a0}}]*"
_SHUT = r"(?=[ \x{{00a0}}]*(?:[{d}]|$))"
# A private-use character that marks the cuts around quoted literals.
_CUT = "\ue000"


def _in_class(chars: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in chars)


def _literal_pattern(delims: str) -> str:
    d = _in_class(delims)
    double = r'"(?:[^"\\]|\\.|"")*+"'
    single = r"'(?:[^'\\]|\\.|'')*+'"
    return f"{_OPEN.format(d=d)}((?:{double}|{single})){_SHUT.format(d=d)}"


def split_packed(value: Column, delimiters: str = DELIMITERS) -> Column:
    """An array of the values packed in ``value``, in order, repeats kept, empty ones dropped.

    ``delimiters`` part values outside quotes. A JSON array gives its strings. A backslash before a delimiter, quote or
    backslash stands for that character; a doubled quote inside a quoted value for one. Null gives null; an empty or
    blank field an empty array. A quote mark that does not wrap a whole value is an ordinary character.
    """
    d = _in_class(delimiters)
    text = F.regexp_replace(value, f"[{_CUT}]", "")
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    json_values = F.from_json(trimmed, "array<string>")
    is_json = trimmed.startswith("[") & trimmed.endswith("]") & json_values.isNotNull()
    # Pieces at odd places are quoted literals, those at even places lie between them.
    pieces = F.split(F.regexp_replace(text, _literal_pattern(delimiters), f"{_CUT}$1{_CUT}"), _CUT, -1)

    def literal(p: Column) -> Column:
        quote = F.substring(p, F.lit(1), F.lit(1))
        return F.regexp_replace(F.replace(F.substring(p, F.lit(2), F.length(p) - 2), F.concat(quote, quote), quote), r"\\(.)", "$1")

    def between(p: Column) -> Column:
        return F.transform(F.split(p, f"(?<!\\\\)[{d}]", -1), lambda x: F.regexp_replace(_strip(x), f"\\\\([{d}\"'\\\\])", "$1"))

    folded = F.flatten(F.transform(pieces, lambda p, i: F.when(i % 2 == 1, F.array(_strip(literal(p)))).otherwise(between(p))))
    values = F.when(is_json, F.transform(json_values, _strip)).otherwise(folded)
    return F.when(value.isNull(), F.lit(None)).otherwise(F.filter(values, lambda v: F.length(v) > 0))


def _strip(x: Column) -> Column:
    return F.regexp_replace(x, r"^[\s\x{00a0}]+|[\s\x{00a0}]+$", "")


def explode_packed(df: DataFrame, keys: list[str], fields: dict[str, str]) -> DataFrame:
    """One row per packed value: ``keys``, field_name, item_pos (from 1), item.

    ``fields`` maps a column to the characters that part its values besides DELIMITERS. Rows whose field is null, empty or only delimiters give no row;
    repeated rows of ``df`` give repeated results; other columns of ``df``, of whatever name, are not used.
    """
    packed = F.array(*(F.struct(F.lit(name).alias("field_name"), split_packed(F.col(f"`{name}`"), DELIMITERS + more).alias("vals")) for name, more in fields.items()))
    one = df.select(*(F.col(f"`{k}`") for k in keys), F.explode(packed).alias("__f"))
    out = one.select(*(F.col(f"`{k}`") for k in keys), F.col("__f.field_name").alias("field_name"), F.posexplode("__f.vals").alias("__p", "item"))
    return out.select(*(F.col(f"`{k}`") for k in keys), "field_name", (F.col("__p") + 1).cast("int").alias("item_pos"), "item")
