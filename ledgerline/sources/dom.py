"""Items of lists and tables from a parsed page, where patterns over its text would not do: nested tags, nested lists,
tags left open, markup inside of scripts and comments."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import day_in_text
from ledgerline.functions.keys import line_hash
from ledgerline.sources.pages import absolute

ROWS = "kind string, container int, item int, depth int, title string, text string, href string, image string, value string, cells array<string>"
_ITEMS, _CONTAINERS, _CELLS = {"li": "list", "tr": "table"}, {"ul", "ol", "menu", "table"}, {"td", "th"}
#: Tags that end an open item of their own kind, though its end tag is missing.
_VOID = {"br", "img", "input", "hr", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}


class _Item:
    def __init__(self, kind: str, container: int, number: int, depth: int, title: str | None):
        self.kind, self.container, self.number, self.depth, self.title = kind, container, number, depth, title
        self.text: list[str] = []
        self.cells: list[list[str]] = []
        self.href = self.image = self.value = None
        self.in_cell = False

    def row(self) -> tuple:
        said = lambda parts: " ".join("".join(parts).split())
        return self.kind, self.container, self.number, self.depth, self.title, said(self.text), self.href, self.image, self.value, [said(c) for c in self.cells]


class _Tree(HTMLParser):
    """Walks a page and keeps its open lists, tables and items; an item is done where its end tag, or that of its list, stands."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.containers = 0
        #: Open containers (number, items so far) and open items, in the order in which they were opened.
        self.open: list[tuple[str, object]] = []
        self.done: list[_Item] = []
        self.counts: dict[int, int] = {}

    def _item(self) -> _Item | None:
        return next((x for tag, x in reversed(self.open) if isinstance(x, _Item)), None)

    def _close(self, tag: str) -> None:
        """Closes the innermost open ``tag`` and whatever was left open in it; an item does not end what is outside of its list."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                for _, x in reversed(self.open[k:]):
                    if isinstance(x, _Item):
                        self.done.append(x)
                del self.open[k:]
                return
            if tag in _ITEMS and self.open[k][0] in _CONTAINERS:
                return

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in _CONTAINERS:
            self.containers += 1
            self.open.append((tag, self.containers))
        elif tag in _ITEMS:
            self._close(tag)
            held = [x for _, x in self.open if not isinstance(x, _Item)]
            if held:
                self.counts[held[-1]] = self.counts.get(held[-1], 0) + 1
                self.open.append((tag, _Item(_ITEMS[tag], held[-1], self.counts[held[-1]], len(held), a.get("data-title") or a.get("title"))))
        item = self._item()
        if item is None:
            return
        if tag in _CELLS:
            item.cells.append([])
            item.in_cell = True
        if tag == "a" and item.href is None and a.get("href"):
            item.href = a["href"].strip()
        if tag == "img" and item.image is None and a.get("src"):
            item.image = a["src"].strip()
        if tag == "input" and item.value is None and a.get("value"):
            item.value = a["value"]
        if tag in _VOID or tag in ("p", "div"):
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag in _CONTAINERS or tag in _ITEMS:
            self._close(tag)
        elif tag in _CELLS and (item := self._item()):
            item.in_cell = False
            item.text.append(" ")

    def handle_data(self, data):
        # Scripts and styles come as data of their own; what stands in them is no text of an item.
        if self.cdata_elem is None and (item := self._item()):
            item.text.append(data)
            if item.in_cell:
                item.cells[-1].append(data)


class ItemsOf:
    """The table function: a page in, a row for each item of its lists and tables out, in the order in which they begin."""

    def eval(self, html: str) -> Iterator[tuple]:
        if html:
            tree = _Tree()
            tree.feed(html)
            tree.close()
            tree.done += [x for _, x in tree.open if isinstance(x, _Item)]
            for item in sorted(tree.done, key=lambda x: (x.container, x.number)):
                yield item.row()


def page_items(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, kind (list or table), container and item (numbers, from 1, as they begin), depth, title (of the item's own
    attribute), text (without that of inner lists' items), link (absolute, the first), image, value, cells (S5).

    The parser runs where Spark's partitions are, page by page. Null and empty pages have no items.
    """
    items = F.udtf(ItemsOf, returnType=ROWS)
    rows = pages.select(key, F.col(url).alias("__base"), F.col(html).alias("__html")).lateralJoin(items(F.col("__html").outer()))
    return rows.select(key, "kind", "container", "item", "depth", "title", "text", absolute(F.col("href"), F.col("__base")).alias("link"), absolute(F.col("image"), F.col("__base")).alias("image"), "value", "cells")


def inventory(items: DataFrame, id_pattern: str, key: str = "page_id") -> DataFrame:
    """Items of list pages by the id in their link, or their hidden value (S5, D2): item, link, title, day, hash; items without
    either, or with a link that is none, are left out, and of each id the first in page order stays."""
    said = F.coalesce(F.nullif(F.trim("title"), F.lit("")), "text")
    found = F.coalesce(F.nullif(F.regexp_extract("link", id_pattern, 1), F.lit("")), F.nullif("value", F.lit("")))
    d = items.filter("link is not null").withColumn("__id", found).withColumn("__said", said).filter("__id is not null")
    one = d.withColumn("__rn", F.row_number().over(Window.partitionBy("__id").orderBy(key, "container", "item"))).filter("__rn = 1")
    return one.select(F.col("__id").alias("id"), "link", F.substring("__said", 1, 500).alias("title"), day_in_text(F.col("__said")).alias("day"), line_hash(F.concat_ws("|", "__said", "__id")).alias("hash"))


def protocol_of(image: Column) -> Column:
    """Struct protocol, year of an image's file name, escapes and plus signs read."""
    name = F.regexp_extract(F.try_url_decode(F.coalesce(image, F.lit(""))), r"([^/]*)$", 1)
    p = r"(\d{1,6})[_/-](20\d{2})"
    return F.struct(F.regexp_extract(name, p, 1).try_cast("int").alias("protocol"), F.regexp_extract(name, p, 2).try_cast("int").alias("year"))
