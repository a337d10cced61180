"""The ranked queue: score decisions, blocks, editorial priority, drafts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import json as J
from ledgerline.operators.latest import current_score, ranked_in_parts
from ledgerline.operators.shared import written
from ledgerline.operators.rules import active, first_match, listed
from ledgerline.plans import vocabulary as V
from ledgerline.plans.workflow import ordered_chunks


def score_decision(relevance: Column, computed: Column, stage: Column, level: Column, status: Column, cut: float = V.QUEUE["score_corte"]) -> Column:
    """Struct valor, decisorio, motivo, situacao, regra of an event's current score.

    Editorial relevance beats a final score, which beats a preliminary one; only the first two decide.
    """
    value = F.coalesce(relevance, computed)
    decides = relevance.isNotNull() | (computed.isNotNull() & F.coalesce(stage == "final", F.lit(False)))
    why = first_match([(relevance.isNotNull(), "SCORE_RELEVANCIA_EDITORIAL"), (computed.isNotNull() & (stage == "final"), "SCORE_FINAL_HOMOLOGADO"), (computed.isNotNull(), "SCORE_PRELIMINAR_NAO_DECISORIO")], "PENDENTE_DE_SCORE")
    place = first_match([
        (value.isNull(), "PENDENTE_DE_SCORE"), (~decides, "SCORE_PROVISORIO"), (value >= cut, "NA_SELECAO"), (F.coalesce(level.isin(*V.STRONG_LEVELS), F.lit(False)), "SCORE_BAIXO_COM_GATILHO_FORTE"),
        (F.coalesce(status.isin(*V.LOCKED_STATUSES), F.lit(False)), "FORA_DA_SELECAO_MANTIDO_POR_TRAVA"),
    ], "FORA_DA_SELECAO")
    return F.struct(value.alias("valor"), decides.alias("decisorio"), why.alias("motivo"), place.alias("situacao"), F.when(decides & (value < cut), F.lit("SCORE_MENOR_40")).alias("regra"))


def decision_view(events: DataFrame, scores: DataFrame, cut: float = V.QUEUE["score_corte"]) -> DataFrame:
    """Each event with the decision on its current score (J15, R22, W2), as one join: events(id, status_editorial), scores(event_id,
    vigente, created_at, id, estagio, score_bruto, score_relevancia, criticidade). Events without a score are pending."""
    now = current_score(scores).select("event_id", "estagio", F.col("score_bruto").cast("double").alias("__computed"), F.col("score_relevancia").cast("double").alias("__relevance"), "criticidade")
    j = events.join(now, F.col("id") == F.col("event_id"), "left").drop("event_id")
    d = score_decision(F.col("__relevance"), F.col("__computed"), F.col("estagio"), F.col("criticidade"), F.col("status_editorial"), cut)
    return j.withColumn("decisao", d).drop("__computed", "__relevance")


def fixed_cut_decision(score: Column, cut: float = 40) -> Column:
    """The earlier form with a fixed cut and no stages."""
    return first_match([(score.isNull(), "PENDENTE_DE_SCORE"), (score >= cut, "NA_SELECAO")], "FORA_DA_SELECAO")


def publication_blocks(draft: Column, status: Column, review: Column, action: str, place: Column, value: Column, components: Column, cut: float = V.QUEUE["score_corte"], needs_score: bool = False) -> Column:
    """Ordered list of what blocks an action on an event."""
    rules = [
        (F.trim(F.coalesce(draft, F.lit(""))) == "", "sem pré-release"), (place == "FORA_DA_SELECAO", f"score decisório < {cut:g} (fora da seleção)"),
        (value.isNull() & F.lit(needs_score), "PENDENTE_DE_SCORE"), (J.array_length(components, "$.pendencias_bloqueantes") > 0, "pendência editorial bloqueante"),
    ]
    if action == "publicado":
        rules += [(~status.eqNullSafe(F.lit("pronto_para_publicar")), "aprove antes (Pronto p/ publicar)"), (F.coalesce(review == "Pendente", F.lit(False)), "revisão humana pendente")]
    return listed(rules)


def generation_allowed(place: Column, code: Column, without_score_blocked: bool = True, priorities: Sequence[str] = ()) -> tuple[Column, Column]:
    """(allowed, reasons against) for a paid call."""
    reasons = listed([(place == "FORA_DA_SELECAO", "FORA_DA_SELECAO"), ((place == "PENDENTE_DE_SCORE") & F.lit(without_score_blocked), "PENDENTE_DE_SCORE"), (code.isin(*priorities) if priorities else F.lit(False), F.concat(F.lit("PRIORIDADE_"), code))])
    return F.size(reasons) == 0, reasons


def simple_eligibility(place: Column, barred: Sequence[str] = ("FORA_DA_SELECAO", "PENDENTE_DE_SCORE")) -> Column:
    """Whether an event may be enriched, null as no."""
    return F.coalesce(~place.isin(*barred), F.lit(False))


def illegal_advances(changes: DataFrame, old: str, new: str, blocks: Mapping[str, str]) -> DataFrame:
    """Status changes with aceita and bloqueios (F25). ``blocks`` names the block list column of a target status; others are free."""
    listed_ = F.coalesce(first_match([(F.col(new) == status, F.col(column)) for status, column in blocks.items()], F.lit(None).cast("array<string>")), F.array().cast("array<string>"))
    found = F.when(F.col(new).eqNullSafe(F.col(old)), F.array().cast("array<string>")).otherwise(listed_)
    return changes.withColumn("bloqueios", found).withColumn("aceita", F.size("bloqueios") == 0)


def queue_items(events: DataFrame, scores: DataFrame, evidence: DataFrame, documents: DataFrame, now: Column, cfg: Mapping[str, float] = V.QUEUE) -> DataFrame:
    """One row per event with everything the queue needs.

    events(id, empresa_id, status_editorial, revisao_humana, pre_release, url_oficial, data_evento,
    data_publicacao, created_at), event_scores(..., componentes variant), evidencias(event_id,
    trecho_literal), documentos(event_id). Every child is reduced to a row per event before its join.
    """
    s = current_score(scores).select(F.col("event_id").alias("id"), "score_relevancia", F.coalesce("score_normalizado", "score_bruto").alias("__calc"), "estagio", "versao_score", "componentes")
    e = evidence.groupBy(F.col("event_id").alias("id")).agg(F.sum(F.when(F.coalesce(F.col("trecho_literal"), F.lit("")) != "", 2).otherwise(1)).alias("__e"))
    d = documents.groupBy(F.col("event_id").alias("id")).agg(F.count("*").alias("__d"))
    j = events.join(s, "id", "left").join(e, "id", "left").join(d, "id", "left")
    comp = F.col("componentes")
    j = j.withColumn("criticidade", J.path_text(comp, "$.criticidade")).withColumn("__dec", score_decision(F.col("score_relevancia"), F.col("__calc"), F.col("estagio"), F.col("criticidade"), F.col("status_editorial"), cfg["score_corte"]))
    j = j.withColumn("situacao", F.col("__dec.situacao")).withColumn("score_valor", F.col("__dec.valor")).withColumn("decisorio", F.col("__dec.decisorio")).withColumn("score_motivo", F.col("__dec.motivo"))
    blank = lambda c: F.nullif(c.cast("string"), F.lit(""))
    changed = J.path_text(comp, "$.ultima_atualizacao_material")
    j = j.withColumn("material_texto", F.coalesce(blank(changed), blank(F.col("data_evento")), blank(F.col("data_publicacao")), F.col("created_at").cast("string")))
    j = j.withColumn("material", F.try_to_timestamp("material_texto")).withColumn("atualizado", F.coalesce(F.try_to_timestamp(changed) > F.col("created_at"), F.lit(False)))
    j = j.withColumn("material_ts", F.coalesce(F.unix_millis("material"), F.lit(0))).withColumn("qualidade_evidencia", (F.coalesce("__e", F.lit(0)) + F.coalesce("__d", F.lit(0)) + F.when(F.coalesce(F.col("url_oficial"), F.lit("")) != "", 1).otherwise(0)).cast("long"))
    out = F.coalesce(F.col("status_editorial") == "publicado", F.lit(False)) | J.is_json_bool(comp, "$.publicado_antes", True) | J.is_json_bool(comp, "$.ineditismo", False)
    j = j.withColumn("inedito", ~out).withColumn("__impact", blank(J.path_text(comp, "$.atualizacao_material.impacto")))
    strong = F.coalesce(F.col("criticidade").isin(*V.STRONG_LEVELS), F.lit(False))
    stated = J.path_type(comp, "$.evidencia_suficiente") == "BOOLEAN"
    enough = F.when(F.coalesce(stated, F.lit(False)), F.try_variant_get(comp, "$.evidencia_suficiente", "boolean")).otherwise(F.col("qualidade_evidencia") >= cfg["evidencia_minima"])
    j = j.withColumn("__trigger", strong | (J.array_length(comp, "$.reforcos") > 0)).withColumn("__enough", enough).withColumn("__v", F.when(F.col("decisorio"), F.col("score_valor")))
    days = (F.unix_micros(now) - F.unix_micros("material")) / F.lit(86_400_000_000)
    j = j.withColumn("__fresh", F.coalesce(days <= cfg["janela_atualidade_dias"], F.lit(False)))
    quiet, kept, crit, v = F.col("__impact").isNull() & ~F.col("atualizado"), F.col("situacao") == "SCORE_BAIXO_COM_GATILHO_FORTE", F.col("criticidade"), F.col("__v")
    rules = [
        (F.col("__impact") == "critico", "A", "ATUALIZACAO_MATERIAL_CRITICA"), (~F.col("inedito") & quiet, "D", "JA_PUBLICADO_SEM_NOVIDADE"), ((crit == "CRITICO") & ~kept, "A", "CRITICIDADE_CRITICO"),
        ((v >= cfg["score_a"]) & F.col("__trigger") & F.col("__enough"), "A", "SCORE_80_COM_GATILHO_E_EVIDENCIA"), (F.col("__impact") == "relevante", "B", "ATUALIZACAO_MATERIAL_RELEVANTE"),
        (F.col("situacao").isin("FORA_DA_SELECAO", "FORA_DA_SELECAO_MANTIDO_POR_TRAVA"), "D", "FORA_DA_SELECAO"), (crit.isin("BAIXA", "ROTINA"), "D", "CRITICIDADE_BAIXA_OU_ROTINA"), (kept, "C", "SCORE_BAIXO_COM_GATILHO_FORTE"),
        (v.isNull() & F.col("score_valor").isNull(), "PENDENTE", "PENDENTE_DE_SCORE"), (v.isNull(), "PENDENTE", "SCORE_PROVISORIO"), ((crit == "ALTA") & (v >= cfg["score_corte"]), "B", "CRITICIDADE_ALTA_COM_SCORE"),
        ((v >= cfg["score_b"]) & F.col("__fresh"), "B", "SCORE_60_ELEGIVEL_E_ATUAL"), ((v >= cfg["score_corte"]) & (crit == "MEDIA"), "C", "CRITICIDADE_MEDIA_COM_SCORE"), (v >= cfg["score_corte"], "C", "SCORE_40_A_59_OU_SEM_ATUALIDADE"),
    ]
    pick = first_match([(c, F.struct(F.lit(a).alias("codigo"), F.lit(b).alias("motivo"))) for c, a, b in rules], F.struct(F.lit("D").alias("codigo"), F.lit("SCORE_DECISORIO_MENOR_40").alias("motivo")))
    j = j.withColumn("__pick", pick).withColumn("prioridade", F.col("__pick.codigo")).withColumn("motivo", F.col("__pick.motivo"))
    old = ~F.col("__fresh") & quiet
    notice = first_match([(F.col("motivo") == "SCORE_BAIXO_COM_GATILHO_FORTE", "Score baixo, mantido por gatilho forte"), (old & F.col("inedito") & F.col("prioridade").isin("A", "B", "C"), "Fato antigo, mas ainda inédito")])
    text = F.when(F.col("motivo") == "JA_PUBLICADO_SEM_NOVIDADE", F.concat_ws(", ", F.when(old, F.lit("fato antigo")), F.lit("já publicado"), F.lit("sem atualização material recente"))).otherwise(F.concat(F.col("motivo"), F.when(old & F.col("inedito"), F.lit(" · fato antigo, mas ainda inédito")).otherwise(F.lit(""))))
    j = j.withColumn("aviso", notice).withColumn("texto", text)
    for action in ("pronto_para_publicar", "publicado"):
        j = j.withColumn(f"bloqueios_{action}", publication_blocks(F.col("pre_release"), F.col("status_editorial"), F.col("revisao_humana"), action, F.col("situacao"), F.col("score_valor"), comp, cfg["score_corte"]))
    ok, _ = generation_allowed(F.col("situacao"), F.col("prioridade"))
    j = j.withColumn("ia_pode", ok)
    for name, table, col in (("rank_prioridade", V.PRIORITY_RANK, "prioridade"), ("rank_criticidade", V.LEVEL_RANK, "criticidade")):
        j = j.withColumn(name, first_match([(F.col(col) == k, r) for k, r in table.items()], -1))
    return j.drop(*[c for c in j.columns if c.startswith("__")], "material")


def _day_of(items: DataFrame) -> Column:
    """The day of the material time, which is milliseconds, a timestamp, or text that begins with its date."""
    kind = dict(items.dtypes)["material_ts"]
    if kind == "string":
        return F.substring("material_ts", 1, 10)
    return F.date_trunc("day", "material_ts") if kind.startswith("timestamp") else F.floor(F.col("material_ts") / 86_400_000)


def ranked_queue(items: DataFrame, tenant: str = "empresa_id", key: str = "id") -> DataFrame:
    """items with ordem, the place in their tenant's queue, by eight keys.

    Tenants are few and their queues may be long, so these are ranked in parts of equal state, ranks and day: as many
    parts as there are days, however fine the times are.
    """
    score = F.coalesce(F.when(F.col("decisorio"), F.col("score_valor").cast("double")), F.lit(-1e18))
    leading = [(F.col("atualizado"), True), (F.col("rank_prioridade"), True), (F.col("rank_criticidade"), True), (_day_of(items), True)]
    rest = [F.col("material_ts").desc(), F.col("inedito").desc(), score.desc(), F.col("qualidade_evidencia").desc(), F.col(key).desc()]
    return ranked_in_parts(written(items, "queue-items"), [tenant], leading, rest, "ordem")


def queue_pages(ranked: DataFrame, columns: Sequence[str], tenant: str = "empresa_id", size: int = 1000) -> DataFrame:
    """Each tenant's queue as ordered arrays of at most ``size`` items (A23): tenant, parte (from 0), itens, whole. Their
    parts in order are the queue, whatever its length."""
    return ordered_chunks(ranked, tenant, "ordem", columns, size)


def draft_status(events: DataFrame, calls: DataFrame, blocked: Column, text_path: str = "$.pre_release") -> DataFrame:
    """events with rascunho and rascunho_situacao from the latest successful analysis."""
    last = calls.filter("status = 'sucesso'").groupBy("event_id").agg(F.max_by(F.struct(F.col("id").alias("chamada"), "resposta"), F.struct("created_at", "id")).alias("__c"))
    j = events.join(last, events["id"] == last["event_id"], "left").drop("event_id")
    draft = F.nullif(F.trim(F.try_variant_get(F.try_parse_json("__c.resposta"), text_path, "string")), F.lit(""))
    state = first_match([(F.col("__c").isNull(), "sem_analise"), (draft.isNull(), "sem_rascunho"), (active(blocked), "bloqueado")], "aplicavel")
    return j.withColumn("rascunho", draft).withColumn("rascunho_chamada", F.col("__c.chamada")).withColumn("rascunho_situacao", state).drop("__c")


def applied_drafts(requests: DataFrame, drafts: DataFrame) -> DataFrame:
    """Outcome of requests to apply a draft (F27): only the newest, not blocked, replacing only when asked to."""
    d = drafts.select(F.col("id").alias("event_id"), "pre_release", "rascunho", "rascunho_chamada", "rascunho_situacao")
    j = requests.join(d, "event_id", "left")
    full = F.trim(F.coalesce(F.col("pre_release"), F.lit(""))) != ""
    outcome = first_match([(F.col("rascunho_situacao").isNull(), "evento_inexistente"), (F.col("rascunho_situacao") != "aplicavel", F.col("rascunho_situacao")), (~F.col("chamada").eqNullSafe(F.col("rascunho_chamada")), "rascunho_superado"), (full & ~active(F.col("substituir")), "ja_tem_pre_release")], "aplicado")
    return j.withColumn("resultado", outcome).withColumn("antes", F.col("pre_release")).withColumn("depois", F.when(F.col("resultado") == "aplicado", F.col("rascunho")).otherwise(F.col("pre_release")))
