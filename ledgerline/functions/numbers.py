"""Numbers written with comma decimals, normalised scores, costs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_pt(c: Column) -> Column:
    """1.852,42 -> 1852.42; 688,08 -> 688.08; 1096.57 -> 1096.57; 1.096.570 -> 1096570; null if no number."""
    t = F.trim(c.cast("string"))
    many = F.length(t) - F.length(F.replace(t, F.lit("."), F.lit(""))) > 1
    plain = F.when(F.contains(t, F.lit(",")), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(many, F.replace(t, F.lit("."), F.lit(""))).otherwise(t)
    return plain.try_cast("double")


def dump_area(c: Column) -> Column:
    """A dump's area: comma to point only, so that 1.852,42 is no number and counts 0."""
    return F.coalesce(F.replace(F.trim(c.cast("string")), F.lit(","), F.lit(".")).try_cast("double"), F.lit(0.0))


def largest_area(*texts: Column) -> Column:
    """The largest area in hectares that the texts cite; null if none does."""
    cited = F.concat(*[F.regexp_extract_all(F.coalesce(t.cast("string"), F.lit("")), F.lit(r"(?i)(\d[\d.,]*)\s*(?:ha\b|hectares?)"), 1) for t in texts])
    return F.array_max(F.transform(cited, number_pt))


def normalised_score(raw: Column, ceiling: float) -> Column:
    """A raw score on the scale 0 to 100."""
    if ceiling <= 0:
        return F.lit(0.0)
    return F.round(F.least(F.greatest(raw, F.lit(0.0)) / F.lit(float(ceiling)) * 100, F.lit(100.0)), 2)


def call_cost(input_tokens: Column, output_tokens: Column, input_price: Column, output_price: Column, per: int = 1_000_000) -> Column:
    """Cost of a call at prices per million tokens; missing token counts are 0, a missing price gives null."""
    zero = F.lit(0)
    return F.coalesce(input_tokens, zero) / per * input_price + F.coalesce(output_tokens, zero) / per * output_price
