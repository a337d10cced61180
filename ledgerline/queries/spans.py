"""Overlapping excerpts and parsed list items over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.spans import merged_excerpts
from ledgerline.queries.registry import Tables, query
from ledgerline.sources import dom

_TERMS = {"licenca": ("license", "licensed", "ense"), "chave": ("token", "ken =", "key")}
_VALUES = ", ".join(f"('{f}', '{w}')" for f, ws in _TERMS.items() for w in ws)


@query(rf"""
WITH t AS (SELECT doc_id, text AS t, lower(strip_accents(text)) AS low FROM documents WHERE text <> ''),
p AS (SELECT t.*, field, term, string_split(low, term) AS ps FROM t, (VALUES {_VALUES}) v(field, term) WHERE contains(low, term)),
k AS (SELECT *, unnest(range(1, len(ps))) AS k FROM p),
i AS (SELECT doc_id, t, low, field, term, CAST(list_sum(list_transform(ps[1:k], lambda x: length(x))) + (k - 1) * length(term) + 1 AS BIGINT) AS i FROM k),
w AS (SELECT doc_id, t, field, term, greatest(i - 61, 0) AS a, least(i - 1 + length(term) + 60, length(t)) AS b FROM i WHERE NOT contains(substring(low, greatest(i - 25, 1), least(i - 1, 25)), 'under ')),
m AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY doc_id, field ORDER BY a, b, term ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM w),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, field ORDER BY a, b, term ROWS UNBOUNDED PRECEDING) AS g FROM m),
e AS (SELECT doc_id, field, min(a) AS a, max(b) AS b, any_value(t) AS t, array_to_string(list_sort(list_distinct(list(term))), ',') AS terms, count(*) AS hits FROM g GROUP BY doc_id, field, g)
SELECT doc_id, field, CAST(a + 1 AS INTEGER) AS "start", regexp_replace(substring(t, a + 1, b - a), '^\s+|\s+$', '', 'g') AS excerpt, terms, CAST(hits AS INTEGER) AS hits FROM e""")
def merged_excerpts_rows(t: Tables) -> DataFrame:
    """Excerpts around overlapping hits of several terms, as one where they meet."""
    e = t.documents.select("doc_id", F.explode(merged_excerpts(F.col("text"), _TERMS, ("under ",))).alias("e"))
    return e.select("doc_id", "e.field", "e.start", "e.excerpt", F.array_join("e.terms", ",").alias("terms"), "e.hits")


_ITEMS = r"""a AS (SELECT page_id, url, html, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS root, regexp_extract_all(html, '<li>\s*<a href="([^"]*)">(.*?)</a>\s*</li>', 1) AS hs, regexp_extract_all(html, '<li>\s*<a href="([^"]*)">(.*?)</a>\s*</li>', 2) AS ts FROM pages),
i AS (SELECT page_id, root, unnest(hs) AS h, unnest(ts) AS t, generate_subscripts(hs, 1) AS item FROM a),
l AS (SELECT page_id, item, root || h AS link, trim(regexp_replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM i)"""


@query(f"""WITH {_ITEMS} SELECT page_id, 'list' AS kind, 1 AS container, CAST(item AS INTEGER) AS item, 1 AS "depth", text, link FROM l""")
def parsed_items(t: Tables) -> DataFrame:
    """Items of lists and tables from parsed pages."""
    return dom.page_items(t.pages).select("page_id", "kind", "container", "item", "depth", "text", "link")


@query(rf"""
WITH {_ITEMS}, d AS (SELECT *, regexp_extract(link, '/([A-Za-zÀ-ÿ]{{3,}})[^/]*$', 1) AS id FROM l)
SELECT id, link, substring(text, 1, 500) AS title, CAST(NULL AS DATE) AS "day", sha256(trim(text || '|' || id)) AS hash FROM d WHERE id <> '' QUALIFY row_number() OVER (PARTITION BY id ORDER BY page_id, item) = 1""")
def parsed_inventory(t: Tables) -> DataFrame:
    """Items of list pages by id from parsed pages, the first of each."""
    return dom.inventory(dom.page_items(t.pages), r"/([A-Za-zÀ-ÿ]{3,})[^/]*$")
