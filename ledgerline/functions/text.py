"""Text expressions: normal forms, term matching, sentences, redaction. All are column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.operators.rules import first_match

#: Letters with marks and what they stand for, in the same order.
ACCENTED = "áàâãäåçéèêëíìîïñóòôõöúùûüýÿºª"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyoa"
#: Short words that normal forms leave out.
STOP_WORDS = ("de", "da", "do", "das", "dos", "e", "em")
#: Words that negate what follows within a few characters.
NEGATIONS = ("sem ", "não ", "nao ", "ausência de ", "ausencia de ", "nenhum ", "nenhuma ")


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


#: Blanks of every kind: Java's own class has those of ASCII only.
BLANK = r"[\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"


def trim_all(c: Column) -> Column:
    """A text without blanks of any kind at its ends, no-break spaces too."""
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def plain_blanks(c: Column) -> Column:
    """A text of the same length whose blanks are spaces, all but line ends and tabs."""
    return F.regexp_replace(c, r"[\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]", " ")


def strip_accents(c: Column) -> Column:
    """Lower case without the accents of ``ACCENTED``; null gives ''."""
    return F.translate(F.lower(_text(c)), ACCENTED, PLAIN)


def normalise(c: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Lower-case ASCII words without accents, punctuation and short stop words, joined by one space."""
    ascii_ = F.regexp_replace(strip_accents(c), r"[^\x00-\x7F]", "")
    words = F.split(F.regexp_replace(ascii_, r"[^a-z0-9_\s]", " "), r"\s+")
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(*stop_words)), " ")


def fold(c: Column) -> Column:
    """Lower case, no accents, single spaces, punctuation kept."""
    return F.trim(F.regexp_replace(strip_accents(c), r"\s+", " "))


def normalised(term: str) -> str:
    """``normalise`` of a Python string, for vocabularies."""
    table = {ord(a): p for a, p in zip(ACCENTED, PLAIN)}
    words = re.sub(r"[^a-z0-9_\s]", " ", term.lower().translate(table).encode("ascii", "ignore").decode()).split()
    return " ".join(w for w in words if w not in STOP_WORDS)


def folded(term: str) -> str:
    return re.sub(r"\s+", " ", term.lower().translate({ord(a): p for a, p in zip(ACCENTED, PLAIN)})).strip()


def phrase_pattern(phrases: Iterable[str]) -> str:
    """Java pattern of adjacent whole tokens, a last ``*`` of a token meaning any ending, over text padded by blanks."""
    made = []
    for phrase in phrases:
        tokens = [(normalised(t.replace("*", "")), t.endswith("*")) for t in phrase.split()]
        body = " ".join(re.escape(t) + (r"\w*" if open_ else "") for t, open_ in tokens if t)
        if body:
            made.append(body)
    return " (?:" + "|".join(made) + ") " if made else "(?!)"


def has_phrase(normal: Column, phrases: Iterable[str]) -> Column:
    """Whether a normalised text holds one of the phrases as whole tokens."""
    return F.concat(F.lit(" "), normal, F.lit(" ")).rlike(phrase_pattern(phrases))


def has_substring(normal: Column, terms: Iterable[str]) -> Column:
    """Whether a normalised text contains one of the terms anywhere, in words too."""
    found = [F.contains(normal, F.lit(normalised(t))) for t in terms if normalised(t)]
    return reduce(lambda a, b: a | b, found, F.lit(False))


def word_pattern(term: str) -> str:
    return rf"(?<!\w){re.escape(folded(term))}(?!\w)"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often ``use`` names it: branches and functions of arrays would each
    compute it again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def matched_words(c: Column, terms: Iterable[str]) -> Column:
    """Terms that occur as whole words, accents and case aside, in the order given."""
    return bound(fold(c), lambda f: F.array_compact(F.array(*[F.when(f.rlike(word_pattern(t)), F.lit(t)) for t in terms])))


def hits(low: Column, term: str) -> Column:
    """Places, from 1, where a term occurs in a text, without overlaps: an array, empty where it is not found.

    The text is cut at the term and the lengths of the pieces are added up, so that a long text is read once.
    """
    pieces = F.split(low, re.escape(term), -1)
    # The place after each piece, carried along with the places found before it.
    state = F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("starts"))
    step = lambda s, p: F.struct((s["next"] + F.length(p) + len(term)).alias("next"), F.array_append(s["starts"], s["next"] + F.length(p)).alias("starts"))
    found = F.aggregate(pieces, state, step, lambda s: s["starts"])
    starts = F.slice(found, 1, F.size(found) - 1)
    return F.when(F.contains(low, F.lit(term)), starts).otherwise(F.array().cast("array<int>"))


def has_unnegated(c: Column, terms: Iterable[str], negations: Sequence[str] = NEGATIONS, reach: int = 25) -> Column:
    """Whether a term occurs with no negation in the ``reach`` characters before it.

    Each hit is looked at on its own.
    """
    t = F.lower(_text(c))
    negated = "|".join(re.escape(n) for n in negations)

    def one(term: str) -> Column:
        return F.exists(hits(t, term), lambda i: ~F.substring(t, F.greatest(i - reach, F.lit(1)), F.least(i - 1, F.lit(reach))).rlike(negated))

    return reduce(lambda a, b: a | b, [one(x) for x in terms], F.lit(False))


def excerpts(c: Column, terms: Sequence[str], field: str, reach: int = 60, negations: Sequence[str] = NEGATIONS, look_back: int = 25) -> Column:
    """Array of (field, excerpt): the text around each unnegated hit of a term, distinct, in order of term and place."""
    t, low = _text(c), F.lower(_text(c))
    negated = "|".join(re.escape(n) for n in negations)

    def one(term: str) -> Column:
        free = F.filter(hits(low, term), lambda i: ~F.substring(low, F.greatest(i - look_back, F.lit(1)), F.least(i - 1, F.lit(look_back))).rlike(negated))
        begin = lambda i: F.greatest(i - reach, F.lit(1))
        return F.transform(free, lambda i: F.struct(F.lit(field).alias("field"), F.trim(F.substring(t, begin(i), i + len(term) + reach - begin(i))).alias("excerpt")))

    return F.array_distinct(F.concat(*[one(x) for x in terms]))


def sentences(c: Column) -> Column:
    """Sentences of a text: cut after . ! ? and at line ends, trimmed, without empty ones."""
    parts = F.split(_text(c), r"(?<=[.!?])\s+|\n+")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")


def sentence_nature(sentence: Column, negative: Sequence[str], alleged: Sequence[str], risk: Sequence[str], exempt_from_negation: Column | None = None, is_folded: bool = False) -> Column:
    """NEGATIVA_EXPLICITA, ALEGACAO_OU_INVESTIGACAO, RISCO_OU_POSSIBILIDADE or SINAL_TEXTUAL_SEM_CONFIRMAR_CAUSALIDADE."""
    f = sentence if is_folded else fold(sentence)
    holds = lambda markers: reduce(lambda a, b: a | b, [F.contains(f, F.lit(folded(m))) for m in markers], F.lit(False))
    no = holds(negative) if exempt_from_negation is None else holds(negative) & ~exempt_from_negation
    return first_match([(no, "NEGATIVA_EXPLICITA"), (holds(alleged), "ALEGACAO_OU_INVESTIGACAO"), (holds(risk), "RISCO_OU_POSSIBILIDADE")], "SINAL_TEXTUAL_SEM_CONFIRMAR_CAUSALIDADE")


def _holding(markers: Sequence[str]):
    """A function of a folded sentence: whether it holds one of the markers."""
    return lambda x: reduce(lambda a, b: a | b, [F.contains(x, F.lit(folded(m))) for m in markers], F.lit(False))


def folded_sentences(c: Column) -> Column:
    """The sentences of a text, folded, one a line, blanks at their ends aside: the whole text is folded at once. No marker
    goes beyond a line, as folded markers hold no line end."""
    cut = F.regexp_replace(strip_accents(c), r"(?<=[.!?])\s+|\n+", "\n")
    return F.regexp_replace(cut, r"[^\S\n]+", " ")


def text_status(c: Column, ordered: Sequence[tuple[str, Sequence[str]]], empty: str, otherwise: str) -> Column:
    """The label of the first marker list with a marker in some sentence."""
    nothing = ~_text(c).rlike(r"[^ \n]")
    return bound(folded_sentences(c), lambda s: first_match([(nothing, empty), *[(_holding(ms)(s), label) for label, ms in ordered]], otherwise))


def worst_state(c: Column, themes: dict[str, Sequence[str]], negative: Sequence[str], uncertain: Sequence[str]) -> Column:
    """Map theme -> worst state over the sentences that name it: incerto > negado > afirmado (X11). Themes not named are absent."""
    no, maybe = _holding(negative), _holding(uncertain)
    rank = lambda x: F.when(maybe(x), 3).when(no(x), 2).otherwise(1)
    worst = lambda s, terms: F.array_max(F.transform(F.filter(s, _holding(terms)), rank))
    named = F.filter(F.split(folded_sentences(c), "\n"), _holding([t for terms in themes.values() for t in terms]))
    ranks = bound(named, lambda s: F.array(*[worst(s, terms) for terms in themes.values()]))
    states = F.transform(ranks, lambda r: F.when(r == 3, "incerto").when(r == 2, "negado").when(r == 1, "afirmado"))
    return F.map_filter(F.map_from_arrays(F.array(*[F.lit(theme) for theme in themes]), states), lambda _, v: v.isNotNull())


def suffix_status(normal: Column, negative: Sequence[str], pending: Sequence[str], done: Sequence[str]) -> Column:
    """negativo, em_tramite, concluido or indefinido, from whole tokens, in that order."""
    tokens = F.split(normal, " ")
    has = lambda words: F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in words]))
    return first_match([(has(negative), "negativo"), (has(pending), "em_tramite"), (has(done), "concluido")], "indefinido")


def without_names(c: Column, name: Column) -> Column:
    """The text without a holder's name and without tax numbers."""
    bare = F.when(F.length(F.trim(_text(name))) > 0, F.replace(_text(c), _text(name), F.lit(" "))).otherwise(_text(c))
    return F.regexp_replace(bare, r"[0-9]{2,3}\.[0-9]{3}\.[0-9]{3}(?:/[0-9]{4})?-[0-9]{2}", " ")


def plain_text(html: Column) -> Column:
    """Text of an HTML page: no script, style, nav, header, footer or tags; common entities; no blank lines."""
    t = F.regexp_replace(_text(html), r"(?is)<(script|style|nav|header|footer)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</(p|div|li|tr|h[1-6]|td|title)\s*>", "\n")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    lines = F.transform(F.split(t, r"\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\r\f]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def redacted(c: Column, limit: int = 300) -> Column:
    """An error text on one line, keys and tokens masked, cut at ``limit`` characters."""
    t = F.regexp_replace(_text(c), r"\s+", " ")
    t = F.regexp_replace(t, r"(?i)\b(bearer)\s+[A-Za-z0-9._-]+", "$1 ***")
    t = F.regexp_replace(t, r"(?i)\b(api[_-]?key|token|password|secret|senha)(\s*[=:]\s*)\"?[^\s\"&]+\"?", "$1$2***")
    t = F.regexp_replace(t, r"\bsk-[A-Za-z0-9_-]{8,}", "***")
    return F.substring(F.trim(t), 1, limit)


def blank_to_null(c: Column) -> Column:
    """Null where the text is blank, else trimmed."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first text that is not blank, as it is; null if all are."""
    return F.coalesce(*[F.when(F.trim(c.cast("string")) != "", c) for c in columns])


def missing_to_null(c: Column) -> Column:
    """Null for the spellings by which a text dump marks missing values."""
    return F.when(F.lower(F.trim(c)).isin("", "nan", "none", "<na>", "null", "na", "n/a", "nat"), F.lit(None)).otherwise(c)
