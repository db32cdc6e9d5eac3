"""Queries on fields that hold several values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orefind.operators.packed import explode_packed


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Each value packed in extensions and category of each search index, with its position."""
    rows = spark.read.parquet(f"{d}/search_indexes.parquet").select("index_no", "extensions", "category")
    return explode_packed(rows, ["index_no"], {"extensions": "/ ", "category": ""})


QUERIES = {"p5_found": p5_found}
_D = ",;|\\t\\n\\r·•，；"  # as DELIMITERS


def _packed(name: str, more: str) -> str:
    """The pieces of a field, each with the delimiter behind it: quoted values, or whatever stands up to a delimiter."""
    d = _D + more
    piece = rf"""[ \x{{a0}}]*(?:"(?:[^"\\]|\\.|"")*"|''(?:[^''\\]|\\.|'''')*'')[ \x{{a0}}]*[{d}]|(?:\\.|[^{d}\\])*[{d}]"""
    return rf"SELECT index_no, '{name}' AS field_name, {name} AS v, regexp_extract_all({name} || ',', '(?s){piece}') AS m FROM search_indexes WHERE {name} IS NOT NULL"


_BLANK = r"'(?s)^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g'"
ORACLE = {
    "p5_found": rf"""WITH p AS ({_packed("extensions", "/ ")} UNION ALL {_packed("category", "")}),
j AS (SELECT index_no, field_name, v, m, regexp_full_match(trim(v), '(?s)\[.*\]') AND json_valid(v) AS js FROM p),
k AS (SELECT index_no, field_name, js, CASE WHEN js THEN from_json(v, '["VARCHAR"]') ELSE list_transform(m, lambda x: regexp_replace(x[:-2], {_BLANK})) END AS l FROM j),
u AS (SELECT index_no, field_name, list_transform(l, lambda x: CASE WHEN js THEN x WHEN length(x) > 1 AND x[1] = '"' AND x[-1] = '"' THEN regexp_replace(replace(x[2:-2], '""', '"'), '\\(.)', '\1', 'g')
WHEN length(x) > 1 AND x[1] = '''' AND x[-1] = '''' THEN regexp_replace(replace(x[2:-2], '''''', ''''), '\\(.)', '\1', 'g') ELSE regexp_replace(x, '\\([{_D}/ "''\\])', '\1', 'g') END) AS l FROM k),
c AS (SELECT index_no, field_name, list_filter(list_transform(l, lambda x: regexp_replace(x, {_BLANK})), lambda x: length(x) > 0) AS l FROM u)
SELECT index_no, field_name, generate_subscripts(l, 1)::INT AS item_pos, unnest(l) AS item FROM c""",
}
