"""Planned and stored enrichment calls: dismissal, gating order, reuse, cost, response audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.text import fold
from ledgerline.operators.rules import active, first_match, listed
from ledgerline.operators.segments import scanned
from ledgerline.plans import vocabulary as V


def first_dismissal(flags: Mapping[str, Column], order: Sequence[str] = V.DISMISSALS) -> Column:
    """The first flag that holds, in the fixed order; null if the call may be made (F19). Unknown flags are an error."""
    unknown = sorted(set(flags) - set(order))
    if unknown:
        raise ValueError(f"unknown flags: {unknown}")
    return first_match([(active(flags[k]), k) for k in order if k in flags])


def notice_flags(failed: Column, band: Column, doc_hash: Column, last_hash: Column, done: Column, ambiguous: Column) -> dict[str, Column]:
    """Flags of a notice (F20): identical document, done before, unread, not linked."""
    same = F.coalesce((doc_hash == last_hash) & (doc_hash != ""), F.lit(False))
    unlinked = ~F.coalesce(band.isin("provavel", "confirmado") | ((band == "contextual") & active(ambiguous)), F.lit(False))
    return {"hash_igual_ultimo_sucesso": same, "registro_identico": same, "enriquecimento_ja_concluido": active(done), "bloqueado_por_falta_de_documento": active(failed), "descartado_por_regra_deterministica": ~active(failed) & unlinked}


def act_flags(out_of_scope: Column, generic: Column, republished: Column, no_delta: Column, done: Column) -> dict[str, Column]:
    """Flags of a case of acts."""
    return {"fora_de_escopo": out_of_scope, "descartado_por_regra_deterministica": generic, "republicacao_literal": republished, "continuidade_sem_mudanca_material": no_delta, "enriquecimento_ja_concluido": done}


def monitored_flags(same_state: Column, no_delta: Column, absent_only: Column, relevant: Column) -> dict[str, Column]:
    """Flags of a monitored structure (F20): without a relevant delta, and nothing else, it is continuity."""
    nothing = ~active(relevant) & ~(active(same_state) | active(no_delta) | active(absent_only))
    return {"registro_identico": same_state, "continuidade_sem_mudanca_material": active(no_delta) | nothing, "descartado_por_regra_deterministica": absent_only}


def flag_map(flags: Mapping[str, Column]) -> Column:
    """The flags that hold, as a map."""
    return F.map_filter(F.map_from_arrays(F.array(*[F.lit(k) for k in flags]), F.array(*[active(v) for v in flags.values()])), lambda _, v: v)


def event_eligibility(events: DataFrame, evidence: DataFrame, details: DataFrame, scores: DataFrame, calls: DataFrame) -> DataFrame:
    """event_id with evidencias, flags and dispensa.

    Superseded evidence does not count here. details: event_id, modulo, faixa_vinculo, falha; scores are
    current rows with nivel; calls: event_id, status.
    """
    e = evidence.filter(~active(F.col("superseded"))).groupBy("event_id").agg(F.count("*").alias("evidencias"), F.bool_or(F.col("trecho_literal").rlike("[0-9]")).alias("com_numero"))
    ok = calls.filter("status = 'sucesso'").select("event_id").distinct().withColumn("__done", F.lit(True))
    j = events.select(F.col("id").alias("event_id")).join(e, "event_id", "left").join(details, "event_id", "left").join(scores, "event_id", "left").join(ok, "event_id", "left")
    flags = {
        "descartado_por_regra_deterministica": F.coalesce(F.col("faixa_vinculo").isin("descartado", "contextual"), F.lit(False)) | F.coalesce(F.col("nivel") == "ROTINA", F.lit(False)), "enriquecimento_ja_concluido": F.col("__done"),
        "bloqueado_por_falta_de_documento": F.coalesce("evidencias", F.lit(0)) == 0,
    }
    return j.select("event_id", F.coalesce("evidencias", F.lit(0)).alias("evidencias"), flag_map(flags).alias("flags"), first_dismissal(flags).alias("dispensa"))


def dossier_evidence(evidence: DataFrame, key: str, field: str, text: str, order: str, priority: Sequence[str], top: int = 12, most: int = 20, cut: int = 700) -> DataFrame:
    """Numbered evidence of a dossier (W6): the earliest of equal (field, text), priority fields first, the first
    ``top`` (never over ``most``), texts cut."""
    w = Window.partitionBy(key, field, text).orderBy(order)
    one = evidence.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
    late = F.when(F.col(field).isin(*priority), 0).otherwise(1)
    n = Window.partitionBy(key).orderBy(late, order, field, text)
    out = one.withColumn("n", F.row_number().over(n)).filter(F.col("n") <= min(top, most))
    return out.select(key, "n", field, F.substring(text, 1, cut).alias(text))


def dossier_text(head: Sequence[tuple[str, Column]], evidence: Column) -> Column:
    """Labelled lines, then the numbered evidence (X31). Empty values give no line."""
    lines = listed([(F.trim(F.coalesce(c.cast("string"), F.lit(""))) != "", F.concat(F.lit(f"{label}: "), c.cast("string"))) for label, c in head])
    items = F.transform(evidence, lambda e: F.concat(F.lit("["), e["n"].cast("string"), F.lit("] "), e["campo"], F.lit(": "), e["trecho"]))
    return F.array_join(F.concat(lines, items), "\n")


def reused(planned: DataFrame, calls: DataFrame, hash_col: str = "hash_chamada") -> DataFrame:
    """planned with reutilizado (the id of the latest success of the same hash), null if none (K7)."""
    ok = calls.filter("status = 'sucesso'").groupBy(F.col(hash_col).alias("__h")).agg(F.max_by("id", F.struct("created_at", "id")).alias("reutilizado"))
    return planned.join(ok, F.col(hash_col) == F.col("__h"), "left").drop("__h")


def limit_violations(cost: Column, day: Column, month: Column, day_limit: Column, month_limit: Column, call_limit: Column) -> Column:
    """Spending limits that a call of this cost would break."""
    return listed([(cost > call_limit, "limite_por_chamada"), (F.coalesce(day, F.lit(0.0)) + cost > day_limit, "limite_diario"), (F.coalesce(month, F.lit(0.0)) + cost > month_limit, "limite_mensal")])


def gated_calls(planned: DataFrame, cap_per_lot: int, lot: str = "lote", seq: str = "seq", segment: Column | None = None) -> DataFrame:
    """planned with situacao: the first gate that stops a call, else ``executar``.

    planned: dispensa, ligada, limite_zero, configurada, preco, reutilizado, ja_analisado, violacoes (array).
    Calls that come so far are numbered per lot, so that the cap holds whatever is stopped before. ``segment`` spreads hot lots.
    """
    before = first_match([
        (F.col("dispensa").isNotNull(), F.concat(F.lit("dispensada:"), F.col("dispensa"))), (~active(F.col("ligada")), "desligada"), (active(F.col("limite_zero")), "limite_zero"), (~active(F.col("configurada")), "sem_configuracao"),
        (F.col("preco").isNull(), "sem_preco"), (F.col("reutilizado").isNotNull(), "reutilizada"), (active(F.col("ja_analisado")), "ja_analisado"),
    ])
    d = planned.withColumn("__before", before)
    counted = F.when(F.col("__before").isNull(), 1).otherwise(0)
    if segment is None:
        nth = F.sum(counted).over(Window.partitionBy(lot).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    else:
        d = scanned(d, [lot], [seq], segment, sums={"__earlier": counted})
        nth = F.coalesce("__earlier", F.lit(0)) + counted
    state = F.coalesce("__before", first_match([(nth > cap_per_lot, "teto_do_lote"), (F.size("violacoes") > 0, F.concat(F.lit("limite:"), F.array_join("violacoes", ",")))], "executar"))
    return d.withColumn("situacao", state).drop("__before", "__earlier")


#: Wording that an analysis must not use.
BARRED_WORDS = ("pre-release", "pre release", "score", "nota editorial", "pronto para publicar")


def number_forms(text: Column) -> Column:
    """Numbers of a text, without thousands points, decimals by point."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\d+(?:[.,]\d+)*)"), 1), lambda n: F.replace(F.regexp_replace(n, r"\.(?=\d{3}(?:\D|$))", ""), F.lit(","), F.lit("."))))


def ungrounded_numbers(answer: Column, source: Column) -> Column:
    """Numbers of an answer that its source does not have."""
    have = number_forms(source)
    return F.array_sort(F.filter(number_forms(answer), lambda n: ~F.array_contains(have, n)))


def response_errors(response: Column, dossier: Column, citations: int | Column, keys: Sequence[str], min_chars: int = 20, max_chars: int = 4000) -> Column:
    """Errors of a stored response, JSON text (R32): required keys, lengths, citations within 1..n, numbers that the
    dossier lacks, barred wording."""
    v = F.try_parse_json(response)
    part = lambda k: F.try_variant_get(v, f"$.{k}", "string")
    whole = F.concat_ws("\n", *[part(k) for k in keys])
    cited = F.transform(F.regexp_extract_all(whole, F.lit(r"\[(\d+)\]"), 1), lambda n: n.try_cast("int"))
    bare = F.regexp_replace(whole, r"\[\d+\]", " ")
    n = F.lit(citations) if isinstance(citations, int) else citations
    return listed([
        (v.isNull(), "json_invalido"), *[(v.isNotNull() & part(k).isNull(), f"falta:{k}") for k in keys], *[(~F.length(part(k)).between(min_chars, max_chars), f"tamanho:{k}") for k in keys],
        (F.exists(cited, lambda i: ~i.between(1, n)), "citacao_fora_do_dossie"), (F.size(ungrounded_numbers(bare, dossier)) > 0, "numero_sem_fonte"),
        *[(F.contains(fold(whole), F.lit(w)), f"termo_vedado:{w}") for w in BARRED_WORDS],
    ])
