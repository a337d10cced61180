"""Overlapping excerpts and parsed items on texts that patterns get wrong."""

import random

from pyspark.sql import functions as F

from ledgerline.functions import spans
from ledgerline.sources import dom


def by_hand(text, terms, negations, reach, look_back):
    low, places = spans.folded(text)
    places = places or list(range(len(low)))
    found = []
    for term in terms:
        for at in range(len(low)):
            if low.startswith(term, at) and not any(n in low[max(at - look_back, 0) : at] for n in negations):
                found.append((max(places[at] - reach, 0), min(places[at + len(term) - 1] + 1 + reach, len(text)), term))
    out = []
    for a, b, term in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b), out[-1][2] + [term])
        else:
            out.append((a, b, [term]))
    return [(a + 1, text[a:b].strip(), sorted(set(t)), len(t)) for a, b, t in out if text[a:b].strip()]


def test_every_overlapping_hit_counts_and_windows_unite():
    rng = random.Random(5)
    terms, negations = ["aa", "aba", "bab", "nao"], ["c "]
    for _ in range(300):
        text = "".join(rng.choice("aAábBcC  ç\nnãoİ") for _ in range(rng.randint(0, 60)))
        got = [(s["start"], s["excerpt"], s["terms"], s["hits"]) for s in spans.Matcher({"f": terms}, negations, 3, 4).spans(text)]
        assert got == by_hand(text, terms, negations, 3, 4), text


def test_places_are_those_of_the_original_text(spark):
    text = "x" * 70 + " ﬁm da BARRAGEM, sem rejeito; İ" + "y" * 100 + " rejeito"
    rows = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "rejeito")], "id int, t string")
    got = {r.id: r.e for r in rows.select("id", spans.merged_excerpts(F.col("t"), {"obra": ["barragem", "fim"], "carga": ["rejeito"], "nada": []}).alias("e")).collect()}
    assert got[2] == got[3] == [] and [(e.field, e.excerpt, e.hits) for e in got[4]] == [("carga", "rejeito", 1)]
    obra, carga = got[1]
    assert (obra.field, obra.terms, obra.hits) == ("obra", ["barragem", "fim"], 2) and "ﬁm da BARRAGEM" in obra.excerpt and text[obra.start - 1 :].startswith(obra.excerpt[:20])
    # The first one is negated; the window of the other ends with the text.
    assert carga.hits == 1 and carga.excerpt.endswith("y rejeito") and carga.start == len(text) - 7 - 60 + 1


HTML = """<html><script>var x = "<li><a href='/no'>no</a></li>";</script><!-- <li>no</li> --><style>li{}</style>
<ul><li data-title="Comunicado - Caeté/MG - 04/10/2026"><a href="/doc/12?x=1&amp;y=2#f">A <b>bold</b>
 one</a><img src="img/123_2026+a.png"><input type=hidden value="77"><ul><li>inner 1<li>inner <i>2</i></ul> tail</li>
<li>open item<p>par<li>next <a name="n">n</a><a href="//h.org/z">z</a></ul>
<table><tr><th>h1<th>h2<tr><td>c1 &lt;x&gt;</td><td>c2<ol><li>deep</li></ol></td></table><li>outside"""


def test_items_of_nested_open_and_quoted_markup(spark):
    pages = spark.createDataFrame([(1, "http://a.org/b/c.html", HTML), (2, "http://a.org", None), (3, "u", ""), (4, "http://a.org/", "<ul><li>x")], "page_id int, url string, html string")
    rows = [(r.kind, r.container, r.item, r.depth, r.title, r.text, r.link, r.image, r.value, r.cells) for r in dom.page_items(pages).filter("page_id = 1").collect()]
    assert rows == [
        ("list", 1, 1, 1, "Comunicado - Caeté/MG - 04/10/2026", "A bold one tail", "http://a.org/doc/12?x=1&y=2", "http://a.org/b/img/123_2026+a.png", "77", []),
        ("list", 1, 2, 1, None, "open item par", None, None, None, []), ("list", 1, 3, 1, None, "next nz", "http://h.org/z", None, None, []),
        ("list", 2, 1, 2, None, "inner 1", None, None, None, []), ("list", 2, 2, 2, None, "inner 2", None, None, None, []),
        ("table", 3, 1, 1, None, "h1h2", None, None, None, ["h1", "h2"]), ("table", 3, 2, 1, None, "c1 <x> c2", None, None, None, ["c1 <x>", "c2"]), ("list", 4, 1, 2, None, "deep", None, None, None, []),
    ]
    assert [r.text for r in dom.page_items(pages).filter("page_id = 4").collect()] == ["x"] and dom.page_items(pages.limit(0)).count() == 0
    found = dom.inventory(dom.page_items(pages.unionByName(pages)), r"/doc/(\d+)").collect()
    assert [(r.id, r.title, str(r.day)) for r in found] == [("12", "Comunicado - Caeté/MG - 04/10/2026", "2026-10-04")]
    p = spark.createDataFrame([("x/a%20+123_2026.png",), ("none",), (None,)], "i string").select(dom.protocol_of(F.col("i")).alias("p")).collect()
    assert [(r.p.protocol, r.p.year) for r in p] == [(123, 2026), (None, None), (None, None)]


def test_sentences_keep_their_digits_and_lose_blank_ends(spark):
    from ledgerline.functions.text import sentences
    from ledgerline.plans.notices import marked_acts

    row = spark.createDataFrame([(" 0 casos 0. 1 caso 1\n  2 casos 2 ", "0a0 @1b1 @ @2c ")], "t string, m string").select(sentences(F.col("t")).alias("s"), marked_acts(F.col("m"), "@").alias("m")).first()
    assert list(row.s) == ["0 casos 0.", "1 caso 1", "2 casos 2"] and list(row.m) == ["0a0", "@1b1", "@", "@2c"]
