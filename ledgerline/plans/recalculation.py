"""Recalculation of pending scores from stored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numbers import largest_area
from ledgerline.operators.rules import active
from ledgerline.operators.shared import written
from ledgerline.plans import vocabulary as V
from ledgerline.plans.criticality import best_of_case, classified_acts

#: The evidence fields that say an act's official type, holder, substance and area.
TYPE, HOLDER, SUBSTANCE, AREA = "descricao_tipo_evento", "titular", "substancia", "area_ha"
#: A notice's signals and the trigger of its stored row that stands for each.
TRIGGERS = {
    "curso_dagua": "atingiu_ou_pode_atingir_curso_dagua", "rejeito": "rejeito_ou_produto_perigoso_ou_volume_significativo", "risco_estrutural": "risco_estrutural_ou_interrupcao_abastecimento",
    "vitimas_ou_comunidade": "vitimas_evacuacao_bloqueio_ou_risco_comunidade", "ultrapassou_limites": "ultrapassou_limites_operacao",
}
FACTS = ("vitimas", "risco_estrutura", "risco_abastecimento", "atingiu_curso_agua", "saiu_limite_operacao")
QUALITY = {"Alta": 3, "Media": 2, "Baixa": 1}


def _said(parts: Column, path: str) -> Column:
    return F.try_variant_get(parts, path, "string")


def pending(scores: DataFrame, module: str = "M9A", prefix: str = "CRIT-") -> DataFrame:
    """Current score rows of a module under a versioned rule that are provisional, potential or without
    sufficient evidence (F15). Reads vigente, versao_score and componentes (JSON); unreadable JSON is not pending."""
    parts = F.try_parse_json("componentes")
    waits = F.coalesce(_said(parts, "$.provisoria") == "true", F.lit(False)) | F.coalesce(F.startswith(_said(parts, "$.criticidade"), F.lit("POTENCIAL_")), F.lit(False)) | F.coalesce(_said(parts, "$.evidencia_suficiente") == "false", F.lit(False))
    return scores.filter(active(F.col("vigente")) & F.startswith(F.coalesce("versao_score", F.lit("")), F.lit(prefix)) & (_said(parts, "$.modulo") == module) & waits)


def act_inputs(events: DataFrame, evidence: DataFrame, key: str = "event_id", seq: str = "seq") -> DataFrame:
    """What ``classified_acts`` reads, from stored events and their evidence (R19): a row per event and
    official type, one with a null type where none is known.

    Superseded evidence counts for nothing; of several excerpts of a field the first by ``seq`` speaks.
    Evidence is aggregated per event before it meets the events, so nothing fans out but the types.
    """
    live = evidence.filter(~active(F.col("superseded")))
    said = F.coalesce("trecho_literal", F.lit("")) != ""
    first = lambda field: F.min(F.when((F.col("campo_sustentado") == field) & said, F.struct(F.col(seq).alias("at"), F.col("trecho_literal").alias("said")))).getField("said")
    own = live.groupBy(key).agg(
        F.count("*").alias("__n"), F.collect_set(F.when((F.col("campo_sustentado") == TYPE) & said, F.col("trecho_literal"))).alias("__types"),
        first(HOLDER).alias("__holder"), first(SUBSTANCE).alias("__substance"), first(AREA).alias("__area"),
    )
    j = events.join(own, key, "left").withColumn("tipo_scm", F.explode_outer("__types"))
    joined = lambda *cs: F.concat_ws(" ", *[F.nullif(F.col(c).cast("string"), F.lit("")) for c in cs])
    stated = F.col("__area").try_cast("double")
    area = F.when(stated.isNotNull(), F.col("__area")).when(F.col("tipo_scm").isNull(), largest_area(F.col("impacto_dimensionado"), F.col("titulo_fato")).cast("string"))
    places = F.size(F.filter(F.split(F.coalesce("municipio", F.lit("")), "[;/]"), lambda m: F.trim(m) != ""))
    return j.select(
        key, "tipo_scm", joined("tipo_evento", "decisao").alias("tipo_texto"), F.col("data_evento").cast("string").alias("data_ato"), F.coalesce("__holder", "empresa").alias("titular"),
        F.coalesce("__substance", joined("atividade", "palavras_chave", "titulo_fato")).alias("substancia"), area.alias("area_ha"), places.alias("n_municipios"), (F.coalesce("__n", F.lit(0)) > 0).alias("tem_evidencia"),
    )


def notice_inputs(rows: DataFrame) -> DataFrame:
    """What ``classified_notices`` reads, from stored notice rows (R19): columns are added to ``rows``.

    The date is the stored one or the first dd/mm/yyyy of the title; signals are the triggers that
    gatilhos_aplicados (JSON) names; evidence is there for read or dismissed notices and wherever lines of it are.
    """
    cited = F.nullif(F.regexp_extract(F.coalesce("titulo_fato", F.lit("")), r"(\d{2}/\d{2}/\d{4})", 1), F.lit(""))
    triggers = F.try_parse_json("gatilhos_aplicados")
    facts = F.map_from_arrays(F.array(*[F.lit(k) for k in FACTS]), F.array(*[F.col(k).cast("boolean") for k in FACTS]))
    signals = F.map_from_arrays(F.array(*[F.lit(k) for k in TRIGGERS]), F.array(*[F.try_variant_get(triggers, f"$.{v}", "variant").isNotNull() for v in TRIGGERS.values()]))
    status = F.coalesce("status_processamento", F.lit(""))
    seen = status.isin("processado", "descartado") | ((F.coalesce("nev", F.lit(0)) > 0) & (status != "falha_extracao"))
    return rows.withColumn("data_ocorrencia", F.coalesce(F.col("data_hora_ocorrencia").cast("string"), cited)).withColumn("confirmados", facts).withColumn("sinais_textuais", signals).withColumn("tem_evidencia", seen)


def evidence_grade(grade: Column) -> Column:
    """Alta 3, Media 2, Baixa 1, else 0."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in QUALITY.items() for x in kv]), grade), F.lit(0))


def recalculated(scores: DataFrame, acts: DataFrame, reference: Column, key: str = "event_id") -> DataFrame:
    """Pending events classified anew by their best act (V3): key, nivel, pontuacao, provisoria, resultado.

    ``acts`` is what ``act_inputs`` gives. resultado is ``inalterado`` where level, points and provisional
    state are those of the current row, and ``gravado`` where a new version is due; ``sem_evento`` where
    the event is not stored. The new versions are the rows ``gravado``; ``latest.rotated_versions`` takes them.
    """
    parts = F.try_parse_json("componentes")
    old = pending(scores).select(key, _said(parts, "$.criticidade").alias("__level"), F.try_variant_get(parts, "$.pontuacao", "double").alias("__points"), (_said(parts, "$.provisoria") == "true").alias("__provisional"))
    mine = acts.join(old.select(key).distinct(), key, "left_semi")
    best = best_of_case(written(classified_acts(mine, reference), "recalculated"), key, ["tipo_scm"])
    same = F.col("nivel").eqNullSafe(F.col("__level")) & F.col("pontuacao").eqNullSafe(F.col("__points")) & F.col("provisoria").eqNullSafe(F.col("__provisional"))
    result = F.when(F.col("nivel").isNull(), "sem_evento").when(same, "inalterado").otherwise("gravado")
    return old.join(best.select(key, "nivel", "pontuacao", "provisoria"), key, "left").select(key, "nivel", "pontuacao", "provisoria", result.alias("resultado"))


def module_short_name(module: Column) -> Column:
    """'M9A_anm' -> 'm9a'; null for other texts."""
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(module.cast("string"), F.lit("")), r"^(M\d+[A-Z]?)_", 1)), F.lit(""))


def industry_code(code: Column, prefixes=V.INDUSTRY_CODES) -> Column:
    """The first of the prefixes with which the digits of an industry code begin; null if none."""
    digits = F.regexp_replace(F.coalesce(code.cast("string"), F.lit("")), r"\D", "")
    return F.coalesce(*[F.when(F.startswith(digits, F.lit(p)), F.lit(p)) for p in prefixes])
