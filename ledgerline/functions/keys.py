"""Keys and hashes of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.text import has_substring, normalise
from ledgerline.operators.rules import first_match

#: Complementary acts that belong to one case; the first family that has a term wins.
FAMILIES = (
    ("instauracao de decaimento", "intimacao para defesa", "decisao de decaimento"),
    ("instauracao de caducidade", "intimacao para defesa", "decisao de caducidade"),
)


def _or_none(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def sha_of(*parts: Column, sep: str = "|") -> Column:
    """SHA-256 of the parts as text, null as ''."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def act_key(process: Column, description: Column, day: Column) -> Column:
    """Identity of one act: process, normal form of its description, day (D3)."""
    return F.sha2(F.concat_ws("|", _or_none(process), normalise(description), _or_none(day)), 256)


def family_of(description: Column, families: Sequence[Sequence[str]] = FAMILIES) -> Column:
    """Sorted terms, joined by |, of the first family with a term in the description; null if none has (K2)."""
    n = normalise(description)
    return first_match([(has_substring(n, f), "|".join(sorted(f))) for f in families])


def instrument_of(text: Column) -> Column:
    """Number and year of the instrument that a text names after an explicit ordinal mark; null if none (K3)."""
    pattern = r"(?iu)N[ºO°]\.?\s*(\d{1,5})\s*/\s*(\d{4})"
    number, year = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    return F.when(number != "", F.concat(number, F.lit("/"), year))


def case_key(process: Column, description: Column, day: Column, company: Column, substance: Column, place: Column, narrative: Column, families: Sequence[Sequence[str]] = FAMILIES) -> Column:
    """Key of the case an act belongs to: its family in the process, else its instrument in the process,
    else company, day, substance and place across processes (K1). Missing values read 'None'."""
    family, instrument = family_of(description, families), instrument_of(narrative)
    seed = F.coalesce(
        F.when(family.isNotNull(), F.concat(_or_none(process), F.lit("|familia:"), family)), F.when(instrument.isNotNull(), F.concat(_or_none(process), F.lit("|instrumento:"), instrument)),
        F.concat_ws("|", _or_none(company), _or_none(day), _or_none(substance), _or_none(place)),
    )
    return F.sha2(seed, 256)


def event_id(prefix: str, key: Column, length: int = 16) -> Column:
    """A readable id from the start of a case key (K4)."""
    return F.concat(F.lit(prefix), F.substring(key, 1, length))


def slug_id(prefix: str, *parts: Column) -> Column:
    """A readable id from text parts: lower-case ASCII words joined by - (K4)."""
    return F.concat(F.lit(prefix), F.array_join(F.split(normalise(F.concat_ws(" ", *parts), stop_words=("",)), " "), "-"))


def line_hash(text: Column) -> Column:
    """Hash of an inventory line or document, blanks at its ends aside (K5)."""
    return F.sha2(F.trim(F.coalesce(text.cast("string"), F.lit(""))), 256)


def input_hash(text: Column) -> Column:
    """Hash of an input, line ends normalised, trimmed (K6)."""
    t = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"\r\n?", "\n")
    return F.sha2(F.regexp_replace(t, r"^\s+|\s+$", ""), 256)


def call_hash(*parts: Column) -> Column:
    """Hash of a call over all its parts, null as '' (K6)."""
    return sha_of(*parts)


def content_hash(*columns: Column) -> Column:
    """Hash of a record's JSON form with the columns in the order given; null fields are left out (K8)."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


