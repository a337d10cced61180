"""Pages: links, list items, document links, totals. Over a table of (url, html)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import day_in_text
from ledgerline.functions.keys import line_hash
from ledgerline.functions.text import fold

ANCHOR = r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"'>]*)[\"'][^>]*>(.*?)</a>"


def absolute(href: Column, base: Column) -> Column:
    """A link made absolute by its page's url, its fragment removed; null for empty, mail and script links."""
    h = F.trim(F.regexp_replace(F.replace(href, F.lit("&amp;"), F.lit("&")), "#.*$", ""))
    root = F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+)", 1)
    folder = F.when(F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+/[^?#]*/)", 1) == "", F.concat(root, F.lit("/"))).otherwise(F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+/(?:[^?#/]*/)*)", 1))
    full = F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h).when(F.startswith(h, F.lit("//")), F.concat(F.regexp_extract(base, r"^([a-zA-Z]+:)", 1), h)).when(F.startswith(h, F.lit("/")), F.concat(root, h)).otherwise(F.concat(folder, h))
    return F.when((h == "") | F.lower(h).rlike("^(mailto|javascript|tel|data):"), F.lit(None)).otherwise(full)


def page_links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, position (from 0), link, text of the links of each page, in page order."""
    hrefs, texts = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), 1), F.regexp_extract_all(F.col(html), F.lit(ANCHOR), 2)
    rows = pages.select(key, F.col(url).alias("__base"), F.posexplode(F.arrays_zip(hrefs.alias("h"), texts.alias("t"))).alias("position", "__a"))
    text = F.trim(F.regexp_replace(F.regexp_replace(F.col("__a.t"), "(?s)<[^>]*>", " "), r"\s+", " "))
    return rows.select(key, "position", absolute(F.col("__a.h"), F.col("__base")).alias("link"), text.alias("text")).filter("link is not null")


def link_inventory(links: DataFrame, allowed: Column, extensions: Sequence[str], limit: int = 40, key: str = "page_id") -> DataFrame:
    """First occurrences of each link of a page with extension, is_document, allowed; of documents the first ``limit``."""
    first = links.withColumn("__rn", F.row_number().over(Window.partitionBy(key, "link").orderBy("position"))).filter("__rn = 1").drop("__rn")
    ext = F.lower(F.regexp_extract("link", r"\.([A-Za-z0-9]{2,5})(?:\?.*)?$", 1))
    d = first.withColumn("extension", ext).withColumn("is_document", ext.isin(*extensions)).withColumn("allowed", allowed)
    nth = F.sum(F.col("is_document").cast("int")).over(Window.partitionBy(key).orderBy("position").rowsBetween(Window.unboundedPreceding, 0))
    return d.withColumn("__n", nth).filter(~F.col("is_document") | (F.col("__n") <= limit)).drop("__n")


def document_links(links: DataFrame, words: Sequence[str], extensions: Sequence[str], limit: int = 5, key: str = "page_id") -> DataFrame:
    """Candidate documents of a detail page: by extension or by a word of the link's text."""
    named = F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(fold(F.col("text")), w))
    ext = F.lower(F.regexp_extract("link", r"\.([A-Za-z0-9]{2,5})(?:\?.*)?$", 1))
    d = links.filter(named | ext.isin(*extensions)).groupBy(key, "link").agg(F.min("position").alias("position"))
    return d.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("position"))).filter(F.col("n") <= limit)


def list_items(links: DataFrame, pattern: str, key: str = "page_id") -> DataFrame:
    """Items of a list page: the id by ``pattern`` from the link, title, day in the title, hash; the first of each id."""
    d = links.withColumn("item", F.regexp_extract("link", pattern, 1)).filter("item <> ''")
    one = d.withColumn("__rn", F.row_number().over(Window.partitionBy("item").orderBy(key, "position"))).filter("__rn = 1")
    return one.select("item", "link", F.col("text").alias("title"), day_in_text(F.col("text")).alias("day"), line_hash(F.concat_ws("|", "item", "text", "link")).alias("hash"))


def announced_total(html: Column) -> Column:
    """The number of results that a page announces; null if it does not."""
    return F.nullif(F.regexp_extract(F.regexp_replace(html, r"(?s)<[^>]*>", " "), r"(?i)(?:total(?:\s+de)?|resultados?\s*:?)\s*:?\s*(\d{1,7})", 1), F.lit("")).cast("int")


def next_pages(links: DataFrame, pattern: str = r"[?&](?:page|pagina|start)=(\d+)", key: str = "page_id") -> DataFrame:
    """Links to other pages of a list, distinct."""
    return links.filter(F.col("link").rlike(pattern)).select(key, "link").distinct()


def title_parts(title: Column) -> Column:
    """Struct place, state, day of titles like 'Place/ST - dd.mm.yyyy' (X25)."""
    p = r"^\s*(.+?)\s*[/-]\s*([A-Z]{2})\b"
    return F.struct(F.nullif(F.regexp_extract(title, p, 1), F.lit("")).alias("place"), F.nullif(F.regexp_extract(title, p, 2), F.lit("")).alias("state"), day_in_text(title).alias("day"))


def protocol_year(name: Column, text: Column | None = None) -> Column:
    """Struct protocol, year from a file name such as 123_2026 or 123-2026; a text must name the same year."""
    p = r"(\d{1,6})[_/-](20\d{2})"
    number, year = F.regexp_extract(name, p, 1).try_cast("int"), F.regexp_extract(name, p, 2).try_cast("int")
    ok = year.isNotNull() if text is None else F.contains(text, year.cast("string"))
    return F.struct(F.when(ok, number).alias("protocol"), F.when(ok, year).alias("year"))
