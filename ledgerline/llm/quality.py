"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

``RULES`` names a measure, the bounds it must keep and the least number of words from which the
rule counts. ``measures`` computes all of them from the whole text with array and string functions;
no row leaves its task, so the plan has no exchange.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    name: str
    measure: str
    low: float | None
    high: float | None
    from_words: int = 0


#: Production thresholds.
RULES = (
    Rule("length", "n_words", 20, None),
    Rule("word_length", "mean_word_chars", 2.0, 12.0),
    Rule("symbols", "symbols_per_word", None, 0.25),
    Rule("exclamations", "exclamations_per_word", None, 0.5),
    Rule("alphabetic", "alpha_char_share", 0.6, None),
    Rule("upper_case", "upper_char_share", None, 0.4),
    Rule("stop_words", "stop_word_share", 0.05, None),
    Rule("duplicate_lines", "dup_line_share", None, 0.4),
    Rule("repeated_words", "repeat_word_share", None, 0.3),
)

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in that is was for it with as on be at by this are or from "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch "
    "la le les et en un une du que est pour qui dans par sur au avec pas ce elle "
    "de el los las del se con una su al es lo como más por para no"
).split()

#: Windows of so many words count as repeated when a text holds them twice.
WINDOW = 8


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the counts and ratios that rules may name.

    Words are runs of bytes other than space and \\x09-\\x0D. Null and empty texts have no words and
    all counts 0; ratios over nothing are 0. Lines count if they hold a word.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    a = docs.select(F.col(id_col).alias("__id"), text.alias("t"))
    a = a.select(
        "__id", "t", F.expr(r"filter(split(t, '[\\x20\\x09-\\x0D]+'), w -> w <> '')").alias("w"), F.expr(r"filter(split(t, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("l"),
        F.expr(r"split(regexp_replace(lower(t), '[^\\p{L}]+', ' '), ' ')").alias("lw"),
    )
    b = a.select(
        "__id", "w", F.size("w").cast("long").alias("n_words"), F.length(F.regexp_replace("t", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(F.replace("t", F.lit("!"), F.lit("")))).cast("long").alias("n_exclamations"),
        F.length(F.regexp_replace("t", r"[^\p{L}]+", "")).cast("long").alias("n_letters"), F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size("l").cast("long").alias("n_lines"), (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lw", lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.expr(f"if(size(w) >= {WINDOW}, transform(sequence(1, size(w) - {WINDOW - 1}), i -> xxhash64(slice(w, i, {WINDOW}))), cast(array() as array<bigint>))").alias("h"),
    )
    rest = [c for c in b.columns if c not in ("h", "w")]
    # Most texts repeat no window: only the others pay for the sort.
    c = b.select(*rest, F.expr("if(size(array_distinct(h)) = size(h), cast(null as array<struct<h: bigint, i: int>>), array_sort(transform(h, (x, i) -> struct(x as h, i as i))))").alias("z"))
    d = c.select(*rest, F.expr("array_sort(transform(filter(sequence(0, size(z) - 1), j -> (j > 0 and z[greatest(j - 1, 0)].h = z[j].h) or (j < size(z) - 1 and z[least(j + 1, size(z) - 1)].h = z[j].h)), j -> z[j].i))").alias("p"))
    e = d.select(*rest, F.expr(f"coalesce(aggregate(p, struct(0L as n, -{WINDOW} as last), (s, i) -> struct(s.n + least({WINDOW}, i - s.last) as n, i as last), s -> s.n), 0L)").alias("n_repeat_words"))

    def share(x: str, y: str) -> Column:
        return F.coalesce(F.try_divide(F.col(x).cast("double"), F.col(y).cast("double")), F.lit(0.0))

    return e.select(
        F.col("__id").alias(id_col), *rest[1:], "n_repeat_words", share("word_chars", "n_words").alias("mean_word_chars"), share("n_symbols", "n_words").alias("symbols_per_word"),
        share("n_exclamations", "n_words").alias("exclamations_per_word"), share("n_letters", "word_chars").alias("alpha_char_share"), share("n_upper", "n_letters").alias("upper_char_share"),
        share("n_stop_words", "n_words").alias("stop_word_share"), share("n_dup_lines", "n_lines").alias("dup_line_share"), share("n_repeat_words", "n_words").alias("repeat_word_share"),
    )


def compiled(rules: tuple[Rule, ...]) -> dict[str, Column]:
    """A boolean column per rule: true where the rule is broken."""
    out = {}
    for r in rules:
        broken = [x for x in (F.col(r.measure) < r.low if r.low is not None else None, F.col(r.measure) > r.high if r.high is not None else None) if x is not None]
        out[r.name] = reduce(lambda a, b: a | b, broken, F.lit(False)) & (F.col("n_words") >= r.from_words)
    return out


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``measures`` with base_failed, kept and failed_rules (names in the order of the table).

    base_failed: fewer than 20 words, or over 30 of 100 words in repeated windows. A document is kept
    if it is not base_failed and breaks no rule.
    """
    m = measures(docs, id_col, text_col)
    broken = compiled(rules)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    names = F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in broken.items()])) if broken else F.array().cast("array<string>")
    return m.select("*", base.alias("base_failed"), names.alias("failed_rules")).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
ORACLE_SQL = rf"""
WITH a AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
b AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
        string_split(regexp_replace(lower(t), '[^\p{{L}}]+', ' ', 'g'), ' ') AS lw FROM a),
wi AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM b)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM wi) WHERE n > 1),
cov AS (SELECT doc_id, sum(k) AS k FROM (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS k FROM rep) GROUP BY doc_id),
m AS (SELECT b.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, length(t) - length(replace(t, '!', '')) AS n_ex,
        length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS n_letters, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper,
        len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        len(list_filter(lw, lambda x: x IN ({_STOPS}))) AS n_stop, CAST(coalesce(k, 0) AS BIGINT) AS n_repeat_words
      FROM b LEFT JOIN cov ON b.doc_id = cov.doc_id),
q AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars::DOUBLE / n_words BETWEEN 2 AND 12 AND n_symbols::DOUBLE / n_words <= 0.25 AND n_ex::DOUBLE / n_words <= 0.5
  AND n_letters::DOUBLE / word_chars >= 0.6 AND coalesce(n_upper::DOUBLE / nullif(n_letters, 0), 0) <= 0.4 AND n_stop::DOUBLE / n_words >= 0.05
  AND coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0) <= 0.4 AND n_repeat_words::DOUBLE / n_words <= 0.3 AS kept
FROM q
"""
