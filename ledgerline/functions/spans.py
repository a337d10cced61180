"""Excerpts around overlapping hits of many terms, found in the folded text and cut from the original one."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.text import NEGATIONS

SPANS = "array<struct<field:string,start:int,excerpt:string,terms:array<string>,hits:int>>"


def folded(text: str) -> tuple[str, list[int] | None]:
    """A text in lower case without accents, and the place in the text of each of its characters; no places where
    both have the same ones. A letter may fold to several characters or, if it is only a mark, to none."""
    if text.isascii():
        return text.lower(), None
    out, places = [], []
    for k, c in enumerate(text):
        plain = c.lower() if c < "\x80" else "".join(x for x in unicodedata.normalize("NFKD", c).lower() if not unicodedata.combining(x))
        out.append(plain)
        places.extend([k] * len(plain))
    low = "".join(out)
    return low, None if len(low) == len(text) and places == list(range(len(text))) else places


def united(windows: Sequence[tuple[int, int, str]]) -> Iterator[tuple[int, int, list[str], int]]:
    """Windows (start, end, term) that meet or overlap, as one: start, end, the terms in order, how many there were."""
    start = end = -1
    terms: list[str] = []
    for a, b, term in sorted(windows):
        if terms and a <= end:
            end = max(end, b)
        else:
            if terms:
                yield start, end, sorted(set(terms)), len(terms)
            start, end, terms = a, b, []
        terms.append(term)
    if terms:
        yield start, end, sorted(set(terms)), len(terms)


class Matcher:
    """All terms of all fields as one automaton over folded texts."""

    def __init__(self, fields: Mapping[str, Sequence[str]], negations: Sequence[str], reach: int, look_back: int):
        self.reach, self.look_back = reach, look_back
        self.negated = re.compile("|".join(re.escape(folded(n)[0]) for n in negations)) if negations else None
        owners: dict[str, list[tuple[str, str]]] = {}
        for field, terms in fields.items():
            for term in terms:
                owners.setdefault(folded(term)[0], []).append((field, term))
        self.order = list(fields)
        self.automaton = ahocorasick.Automaton()
        for term, of in owners.items():
            if term:
                self.automaton.add_word(term, (len(term), of))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def spans(self, text: str | None) -> list[dict]:
        if not text or self.empty:
            return []
        low, places = folded(text)
        windows: dict[str, list[tuple[int, int, str]]] = {}
        for last, (size, of) in self.automaton.iter(low):
            at = last - size + 1
            if self.negated and self.negated.search(low, max(at - self.look_back, 0), at):
                continue
            # Windows are of the original text: so many characters before the hit's first and after its last one.
            first, end = (at, last) if places is None else (places[at], places[last])
            for field, term in of:
                windows.setdefault(field, []).append((max(first - self.reach, 0), min(end + 1 + self.reach, len(text)), term))
        out = []
        for field in self.order:
            for start, end, terms, n in united(windows.get(field, [])):
                excerpt = text[start:end].strip()
                if excerpt:
                    out.append({"field": field, "start": start + 1, "excerpt": excerpt, "terms": terms, "hits": n})
        return out


def merged_excerpts(c: Column, fields: Mapping[str, Sequence[str]], negations: Sequence[str] = NEGATIONS, reach: int = 60, look_back: int = 25) -> Column:
    """Array of (field, start, excerpt, terms, hits) of a text (X7): the original text around every hit of a field's terms
    that has no negation in the ``look_back`` characters before it, overlapping windows as one.

    Case and accents do not count; terms may overlap themselves and one another. ``start`` counts characters from 1, before
    blank ends are cut off. By field in the order given, then place. Null and empty texts give an empty array; a very long text is read once.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(fields, negations, reach, look_back)
        for texts in batches:
            yield pd.Series([matcher.spans(t) for t in texts], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, SPANS)(c.cast("string"))
