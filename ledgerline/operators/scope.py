"""Scoping: which rows count, and why the others do not."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import fold, has_substring, normalise
from ledgerline.operators.rules import first_match, listed


def with_presence(fact: DataFrame, places: DataFrame, key: str, state_col: str, state: str) -> DataFrame:
    """Rows whose key lies, among other places, in a state (F1): a semi-join on the keys, no fan-out."""
    inside = places.filter(F.upper(F.trim(F.col(state_col))) == state.upper()).select(key).distinct()
    return fact.join(inside, key, "left_semi")


def without_families(fact: DataFrame, dictionary: DataFrame, key: str, text_col: str, terms: Sequence[str]) -> DataFrame:
    """Rows whose type is in no excluded family (F2): the texts are judged in the dictionary, once per
    type, and the few ids that fall out are removed by an anti-join."""
    out = dictionary.filter(has_substring(normalise(F.col(text_col)), terms)).select(key).distinct()
    return fact.join(out, key, "left_anti")


def without_family_text(df: DataFrame, text_col: str, terms: Sequence[str]) -> DataFrame:
    """The same by the row's own text (F3); rows without a text stay."""
    return df.filter(~has_substring(normalise(F.col(text_col)), terms))


def scoped(fact: DataFrame, places: DataFrame, key: str, state_col: str, state: str, text_col: str, terms: Sequence[str]) -> DataFrame:
    """Presence, then family text."""
    return without_family_text(with_presence(fact, places, key, state_col, state), text_col, terms)


def from_day(df: DataFrame, day: Column, floor: Column, keep_undated: bool = False) -> DataFrame:
    """Rows from a day on; rows without a readable day fall out (F5) or stay (F6). A null floor keeps all."""
    inside = F.coalesce(day >= floor, F.lit(keep_undated))
    return df.filter(floor.isNull() | (day.isNull() & F.lit(keep_undated)) | inside)


def complete_rows(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all required columns, one row that counts the others) (F8)."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return df.filter(~missing), df.agg(F.count_if(missing).alias("dropped"), F.count("*").alias("total"))


def reject_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """The first reason that rejects a row, null if none: the reasons exclude each other."""
    return first_match([(condition, name) for name, condition in rules])


def reject_counters(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row: read, each reason's count, kept. One pass."""
    reason = reject_reason(rules)
    tagged = df.select(reason.alias("__why"))
    return tagged.agg(F.count("*").alias("read"), *[F.count_if(F.col("__why") == n).alias(n) for n, _ in rules], F.count_if(F.col("__why").isNull()).alias("kept"))


def criteria_met(values: Mapping[str, Column], wanted: Column) -> tuple[Column, Column]:
    """(ok, missing): whether all fields of a map param equal the row's values, case and accents aside.

    Fields that the row lacks are missing; an empty map is met.
    """
    have = F.map_from_arrays(F.array(*[F.lit(k) for k in values]), F.array(*[v.cast("string") for v in values.values()]))
    missing = F.array_sort(F.filter(F.map_keys(wanted), lambda k: F.element_at(have, k).isNull() | (fold(F.element_at(have, k)) != fold(F.element_at(wanted, k)))))
    return F.size(missing) == 0, missing


def url_allowed(url: Column, hosts: Sequence[str], prefixes: Sequence[str]) -> Column:
    """Reason by which a URL is refused, null if it may be read (F10): scheme, host (or a subdomain), path prefix."""
    host, path = F.lower(F.try_parse_url(url, F.lit("HOST"))), F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("/"))
    known = reduce(lambda a, b: a | b, [(host == h) | F.endswith(host, F.lit("." + h)) for h in hosts], F.lit(False))
    below = reduce(lambda a, b: a | b, [F.startswith(path, F.lit(p)) for p in prefixes], F.lit(False)) if prefixes else F.lit(True)
    scheme = F.lower(F.try_parse_url(url, F.lit("PROTOCOL")))
    return first_match([(F.coalesce(~scheme.isin("http", "https"), F.lit(True)), "esquema"), (host.isNull() | ~known, "dominio"), (~below, "caminho")])


def barrier_in(body: Column, signatures: Sequence[str], content_type: Column | None = None, reach: int = 200_000) -> Column:
    """Whether the start of an HTML body holds the signature of an access barrier."""
    t = F.lower(F.substring(F.coalesce(body.cast("string"), F.lit("")), 1, reach))
    found = reduce(lambda a, b: a | b, [F.contains(t, F.lit(s.lower())) for s in signatures], F.lit(False))
    return found if content_type is None else found & F.coalesce(F.contains(F.lower(content_type), F.lit("html")), F.lit(False))


def level_floor(df: DataFrame, level: str, accepted: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of an accepted level, counts of the others by level)."""
    ok = F.coalesce(F.col(level).isin(*accepted), F.lit(False))
    return df.filter(ok), df.filter(~ok).groupBy(level).agg(F.count("*").alias("dismissed"))


def config_violations(portfolios: DataFrame, weights: DataFrame, sources: DataFrame) -> DataFrame:
    """carteira_id and its list of violations (F13): inactive, no source for collection, bands outside
    0-100 or not A >= B >= C, a negative weight. Each child table is aggregated before it is joined."""
    w = weights.groupBy("carteira_id").agg(F.min("peso").alias("__low"))
    s = sources.filter("coleta").groupBy("carteira_id").agg(F.count("*").alias("__sources"))
    j = portfolios.join(w, "carteira_id", "left").join(s, "carteira_id", "left")
    a, b, c = F.col("banda_a"), F.col("banda_b"), F.col("banda_c")
    inside = reduce(lambda x, y: x & y, [F.coalesce(x.between(0, 100), F.lit(False)) for x in (a, b, c)])
    codes = listed([
        (~F.coalesce(F.col("ativa"), F.lit(False)), "inativa"), (F.coalesce("__sources", F.lit(0)) == 0, "sem_fonte_de_coleta"), (~inside, "banda_fora_de_0_100"),
        (~F.coalesce((a >= b) & (b >= c), F.lit(False)), "bandas_fora_de_ordem"), (F.coalesce(F.col("__low") < 0, F.lit(False)), "peso_negativo"),
    ])
    return j.select("carteira_id", codes.alias("violations"))


def resolved_scope(links: DataFrame, key: str, tenant: str, value: str, wanted: str | None = None) -> DataFrame:
    """Per key its one value or why there is none: ok, ambiguo, outra_empresa (F14, A21). Keys without links are ``ausente`` to the caller's left join."""
    rows = links if wanted is None else links.withColumn("__mine", F.col(tenant) == wanted)
    mine = F.count_distinct(F.when(F.col("__mine"), F.col(value))) if wanted is not None else F.count_distinct(value)
    one = F.max(F.when(F.col("__mine"), F.col(value))) if wanted is not None else F.max(value)
    g = rows.groupBy(key).agg(mine.alias("candidates"), one.alias("__one"))
    status = first_match([(F.col("candidates") == 0, "outra_empresa"), (F.col("candidates") > 1, "ambiguo")], "ok")
    return g.select(key, "candidates", status.alias("status"), F.when(status == "ok", F.col("__one")).alias(value))


def visible(events: DataFrame, links: DataFrame, user: str, sees_all: bool, tenant: str = "empresa_id") -> DataFrame:
    """Events a user may see: all for a role of all tenants, else those of tenants with an active link."""
    if sees_all:
        return events
    mine = links.filter((F.col("usuario_id") == user) & F.col("ativo")).select(tenant).distinct()
    return events.join(mine, tenant, "left_semi")


def masked_history(calls: DataFrame, columns: Sequence[str], text: str, status: str, shown: str = "sucesso") -> DataFrame:
    """Safe columns of call history, the text only of calls that succeeded."""
    return calls.select(*columns, F.when(F.col(status) == shown, F.col(text)).alias(text))
