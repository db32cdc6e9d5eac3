"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_TERMS = """docs AS (SELECT doc_no, regexp_extract_all(lower(contents), '[\\p{L}\\p{N}]+') AS ts FROM stored_docs WHERE contents IS NOT NULL),
each AS (SELECT doc_no, len(ts) AS dl, unnest(ts) AS term FROM docs),
tf AS (SELECT doc_no, term, count(*) AS tf, any_value(dl) AS dl FROM each GROUP BY ALL),
df AS (SELECT term, count(*) AS records, sum(tf) AS occurrences FROM tf GROUP BY term)"""

ORACLE = {
    "p4_found": f"WITH {_TERMS} SELECT doc_no, term FROM tf JOIN df USING (term) WHERE tf >= 4 AND records BETWEEN 2 AND 6",
    "p4_scores": f"""WITH {_TERMS}, n AS (SELECT (SELECT count(*) FROM docs) AS n, (SELECT sum(occurrences) FROM df) AS w)
SELECT doc_no, term, tf, records, round(ln(1 + (n - records + 0.5) / (records + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl * n / w)), 6) AS score
FROM tf JOIN df USING (term), n""",
    "p6_found": f"""WITH {_TERMS}, f AS (SELECT lower(trim(filename, ' ')) AS term, count(*) AS records FROM stored_docs WHERE filename IS NOT NULL GROUP BY 1),
m AS (SELECT 'contents' AS field_name, term, CASE WHEN records = 1 THEN 'rare' WHEN records * 4 > (SELECT count(*) FROM docs) THEN 'common' END AS mark FROM df
UNION ALL SELECT 'filename', term, CASE WHEN records = 1 THEN 'rare' WHEN records * 50 > (SELECT count(filename) FROM stored_docs) THEN 'common' END FROM f WHERE term <> '')
SELECT * FROM m WHERE mark IS NOT NULL""",
    "p2_found": r"""WITH w AS (SELECT doc_no, unnest(list_filter(regexp_split_to_array(lower(contents), '[ \t\r\n]+'), lambda x: x <> '')) AS word FROM stored_docs),
c AS (SELECT doc_no, word, count(*) AS n FROM w GROUP BY 1, 2),
s AS (SELECT doc_no, sum(n)::BIGINT AS size FROM c GROUP BY 1 HAVING sum(n) >= 30),
b AS (SELECT c.doc_no, word, n, size FROM c JOIN s USING (doc_no)),
p AS (SELECT x.doc_no AS doc_no_a, y.doc_no AS doc_no_b, sum(least(x.n, y.n)) AS shared, any_value(x.size + y.size) AS sizes
FROM b x JOIN b y ON x.word = y.word AND x.doc_no < y.doc_no AND 5 * least(x.size, y.size) >= 4 * greatest(x.size, y.size) GROUP BY 1, 2)
SELECT doc_no_a, doc_no_b FROM p WHERE 5 * shared >= 4 * (sizes - shared)""",
    "p6_deltas": """WITH k AS (SELECT contents, filename FROM stored_docs QUALIFY row_number() OVER (PARTITION BY index_id, doc_key ORDER BY indexed_at DESC, doc_no DESC) = 1),
l AS (SELECT * FROM k WHERE contents IS NOT NULL),
t AS (SELECT row_number() OVER () AS r, regexp_extract_all(lower(contents), '[\\p{L}\\p{N}]+') AS ts FROM l),
e AS (SELECT r, unnest(ts) AS term FROM t),
f AS (SELECT nullif(lower(trim(filename, ' ')), '') AS term FROM l WHERE filename IS NOT NULL)
SELECT 'contents' AS field_name, term, count(*) AS occurrences, count(DISTINCT r) AS records FROM e GROUP BY 2
UNION ALL SELECT 'contents', NULL, count(*), count(*) FROM l
UNION ALL SELECT 'filename', term, count(*), count(*) FROM f WHERE term IS NOT NULL GROUP BY 2
UNION ALL SELECT 'filename', NULL, count(*), count(*) FROM f""",
}
