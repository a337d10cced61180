"""Criticality of process acts and notices, selection groups and the what-if simulation.

Each rule is a column staged under a name of its own, so that expressions stay small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import age_days, to_day
from ledgerline.functions.numbers import dump_area
from ledgerline.functions.text import has_phrase, normalise
from ledgerline.operators.latest import ranked_in_parts
from ledgerline.operators.rules import active, cascade, first_match, listed, rank_of
from ledgerline.plans import vocabulary as V


def phase_of(normal: Column, free_text: Column) -> Column:
    """negativa, pedido, efetiva or indefinida of an act's normalised type."""
    effective = F.when(free_text, has_phrase(normal, V.PHASE_EFFECTIVE_FREE_TEXT)).otherwise(has_phrase(normal, V.PHASE_EFFECTIVE))
    return first_match([(has_phrase(normal, V.PHASE_NEGATIVE), "negativa"), (has_phrase(normal, V.PHASE_REQUEST), "pedido"), (effective, "efetiva")], "indefinida")


def object_of(normal: Column, objects: Sequence[tuple[str, Sequence[str]]] = V.OBJECTS) -> Column:
    """The first object of the ordered vocabulary that the type names, else ``outro``."""
    return first_match([(has_phrase(normal, words), name) for name, words in objects], "outro")


def finalised(df: DataFrame) -> DataFrame:
    """prioridade, bloqueios and selecionavel from nivel, avaliavel, evidencia_suficiente, provisoria."""
    level = F.col("nivel")
    pending = level.isin(*V.POTENTIAL.values())
    blocks = listed([
        (~F.col("avaliavel"), "nao_avaliavel"), (pending, "pendente_de_evidencia"), (~pending & ~level.isin(*V.SELECTION_FLOOR) & F.col("avaliavel"), "abaixo_do_piso"),
        (~F.col("evidencia_suficiente") & ~pending, "evidencia_insuficiente"), (F.col("provisoria"), "classificacao_provisoria"),
    ])
    priority = first_match([(level == k, v) for k, v in V.PRIORITY_OF_LEVEL.items()])
    return df.withColumn("prioridade", priority).withColumn("bloqueios", blocks).withColumn("selecionavel", F.size("bloqueios") == 0)


def classified_acts(df: DataFrame, reference: Column, limits: Mapping[str, int] = V.ACT_AGE_LIMITS) -> DataFrame:
    """Criticality of process acts.

    Reads tipo_scm, tipo_texto, data_ato, titular, substancia, area_ha, n_municipios, tem_evidencia and
    adds objeto, fase, reforcos, pontuacao, nivel_antes_idade, nivel, nivel_potencial, motivos,
    provisoria, pendencia, avaliavel, evidencia_suficiente, and what ``finalised`` adds. Routine comes
    first and stops all else; requests and refusals stay at BAIXA; the potential states arise only after
    ageing. Without a type text an act is not assessable.
    """
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    d = df.withColumn("__free", F.coalesce(F.col("tipo_scm"), F.lit("")) == "").withColumn("__t", normalise(F.when(F.col("__free"), F.col("tipo_texto")).otherwise(F.col("tipo_scm"))))
    day = to_day(F.col("data_ato"))
    d = d.withColumn("idade_dias", age_days(day, reference))
    area = F.when(blank("area_ha"), F.lit(0.0)).otherwise(dump_area(F.col("area_ha")))
    d = d.withColumn("__emp", has_phrase(normalise(F.col("titular")), V.COMPANIES)).withColumn("__est", has_phrase(normalise(F.col("substancia")), V.MINERALS)).withColumn("__ok", area >= V.AREA_MIN).withColumn("__big", area >= V.AREA_LARGE)
    emp, est, ok, big = (F.col(c) for c in ("__emp", "__est", "__ok", "__big"))
    boosts = listed([(emp, "empresa_relevante"), (est, "mineral_estrategico"), (ok, f"area_{V.AREA_MIN}ha"), (F.coalesce(F.col("n_municipios"), F.lit(0)) >= 2, "varios_municipios")])
    d = d.withColumn("__boosts", boosts).withColumn("__kind", first_match([(has_phrase(F.col("__t"), V.ROUTINE), "rotina"), (F.col("__t") == "", "desconhecido")], "ato"))
    d = d.withColumn("__object", object_of(F.col("__t"))).withColumn("__phase", phase_of(F.col("__t"), F.col("__free"))).withColumn("__mining", has_phrase(F.col("__t"), V.MINING_MARKERS))
    obj, phase, age = F.col("__object"), F.col("__phase"), F.col("idade_dias")
    recent = (phase == "efetiva") & F.coalesce(age <= V.EXTENSION_RECENT_DAYS, F.lit(False))
    closed = phase.isin("pedido", "negativa")
    either = emp | est
    level = first_match([
        (closed, "BAIXA"),
        (obj == "perda_titulo", F.when(F.col("__mining"), "CRITICO").otherwise("ALTA")),
        (obj == "prorrogacao_prazo_requerer_lavra", F.when(recent, "MEDIA").otherwise("BAIXA")),
        (obj == "gravame", F.when(either, "ALTA").otherwise("MEDIA")),
        (obj == "cessao", F.when((emp & est) | (est & big), "ALTA").when(either | ok, "MEDIA").otherwise("BAIXA")),
        (obj == "autorizacao_extracao", F.when(either | ok, "ALTA").otherwise("MEDIA")),
        (obj.isin("renuncia", "alvara_outorga"), F.when(either, "MEDIA").otherwise("BAIXA")),
        (obj == "relatorio_aprovado", F.when(either | ok, "MEDIA").otherwise("BAIXA")),
        (obj == "servidao", F.when(emp, "MEDIA").otherwise("BAIXA")),
    ], "BAIXA")
    d = d.withColumn("__raw", level)
    capped = ~closed & (phase == "indefinida") & (rank_of(F.col("__raw"), V.LEVELS) > rank_of(F.lit("MEDIA"), V.LEVELS))
    d = d.withColumn("__before", F.when(capped, "MEDIA").otherwise(F.col("__raw")))
    why = listed([
        (F.lit(True), F.concat(F.lit("objeto="), obj)), (F.lit(True), F.concat(F.lit("fase="), phase)), (F.col("__free"), "classificado_por_texto_livre_sem_tipo_scm"),
        (F.col("__free"), "classificacao_provisoria_origem_curada"), (phase == "pedido", "pedido_nunca_vale_como_ato_efetivado"), (phase == "negativa", "ato_negativo_teto_BAIXA"),
        (~closed & (obj == "perda_titulo"), F.when(F.col("__mining"), "perda_de_titulo_de_lavra").otherwise("perda_de_titulo_de_pesquisa")),
        (~closed & (obj == "prorrogacao_prazo_requerer_lavra"), F.when(recent, "prorrogacao_prazo_lavra_decisao_recente").when(phase == "efetiva", "prorrogacao_prazo_lavra_decisao_antiga_ou_sem_data").otherwise("prorrogacao_prazo_lavra_fase_nao_efetiva")),
        (~closed & (obj == "gravame"), F.when(either, "gravame_com_reforco").otherwise("gravame_sem_reforco")), (capped, "fase_indefinida_teto_MEDIA"),
    ])
    aged, age_why = cascade(F.col("__before"), age, limits, V.LEVELS, "BAIXA", "BAIXA")
    d = d.withColumn("__why", why).withColumn("__aged", aged).withColumn("__age_why", age_why).withColumn("__ev", active(F.col("tem_evidencia")))
    waiting = ~F.col("__ev") & F.col("__aged").isin(*V.POTENTIAL)
    ev_why = listed([(waiting, F.concat(F.lit("potencial_"), F.col("__aged"), F.lit("_aguarda_evidencia_estruturada"))), (~waiting & ~F.col("__ev"), "sem_evidencia_estruturada_nao_selecionavel")])
    act, routine = F.col("__kind") == "ato", F.col("__kind") == "rotina"
    final = first_match([(F.col("__aged") == k, v) for k, v in V.POTENTIAL.items()])
    out = d.withColumn("objeto", F.when(act, obj).otherwise(F.col("__kind"))).withColumn("fase", F.when(act, phase))
    out = out.withColumn("reforcos", F.when(routine, F.array().cast("array<string>")).otherwise(F.col("__boosts"))).withColumn("pontuacao", F.when(act, F.size("__boosts") * F.lit(25.0)).otherwise(F.lit(0.0)))
    out = out.withColumn("nivel_antes_idade", F.when(act, F.col("__before"))).withColumn("nivel_potencial", F.when(act & waiting, F.col("__aged")))
    out = out.withColumn("nivel", F.when(routine, "ROTINA").when(~act, V.NOT_ASSESSABLE).when(waiting, final).otherwise(F.col("__aged")))
    out = out.withColumn("motivos", F.when(routine, F.array(F.lit("rotina_anula_gatilhos"))).when(~act, F.array(F.lit("tipo_do_ato_desconhecido_nao_avaliavel"))).otherwise(F.concat("__why", "__age_why", ev_why)))
    out = out.withColumn("avaliavel", F.col("__kind") != "desconhecido").withColumn("evidencia_suficiente", ~act | F.col("__ev")).withColumn("provisoria", act & F.col("__free"))
    pending = F.when(act & F.col("__free"), F.when(F.col("__ev"), "tipo_oficial_scm").otherwise("tipo_oficial_e_evidencia_estruturada")).when(act & ~F.col("__ev"), "evidencia_estruturada")
    out = out.withColumn("pendencia", pending).drop("__free", "__t", "__emp", "__est", "__ok", "__big", "__boosts", "__kind", "__object", "__phase", "__mining", "__raw", "__before", "__why", "__aged", "__age_why", "__ev")
    return finalised(out)


def classified_notices(df: DataFrame, reference: Column, limits: Mapping[str, int] = V.NOTICE_AGE_LIMITS) -> DataFrame:
    """Criticality of notices (R16), from status_processamento, faixa_vinculo, data_ocorrencia, confirmados and
    sinais_textuais (maps of booleans), score_gravidade, tem_evidencia (null counts as true), motivo_falha.

    Unread notices are not assessable; a weak link is routine; signals by words alone reach MEDIA, provisionally.
    """
    fact = lambda k: active(F.try_element_at(F.col("confirmados"), F.lit(k)))
    d = df.withColumn("idade_dias", age_days(to_day(F.col("data_ocorrencia")), reference))
    d = d.withColumn("__unread", F.coalesce(F.col("status_processamento") == "falha_extracao", F.lit(False)) | ~F.coalesce(F.col("tem_evidencia"), F.lit(True)))
    d = d.withColumn("__linked", F.coalesce(F.col("faixa_vinculo").isin(*V.LINK_BANDS_VALID), F.lit(False)))
    fatal = fact("vitimas") | fact("risco_estrutura") | fact("risco_abastecimento")
    environmental = fact("atingiu_curso_agua") | (fact("saiu_limite_operacao") & fact("rejeito_ou_perigoso")) | fact("atuacao_orgao_publico")
    said = F.coalesce(F.exists(F.map_values("sinais_textuais"), lambda v: F.coalesce(v, F.lit(False))), F.lit(False))
    d = d.withColumn("__kind", first_match([(fatal, "fatal"), (environmental, "ambiental"), (said, "textual")], "nada"))
    kind, probable = F.col("__kind"), F.col("faixa_vinculo") == "provavel"
    raw = first_match([(kind == "fatal", "CRITICO"), (kind == "ambiental", "ALTA"), (kind == "textual", "MEDIA")], "BAIXA")
    capped = probable & (rank_of(raw, V.LEVELS) > rank_of(F.lit("MEDIA"), V.LEVELS))
    d = d.withColumn("__before", F.when(capped, "MEDIA").otherwise(raw)).withColumn("__capped", capped)
    aged, age_why = cascade(F.col("__before"), F.col("idade_dias"), limits, V.LEVELS, "BAIXA", "BAIXA")
    d = d.withColumn("__aged", aged).withColumn("__age_why", age_why)
    ok = ~F.col("__unread") & F.col("__linked")
    provisional = ok & (kind == "textual") & (F.col("__aged") == "MEDIA")
    failure = first_match([
        (F.startswith(F.coalesce("motivo_falha", F.lit("")), F.lit("limite")), "nao_avaliavel_documento_nao_aberto_por_limite_de_requisicoes"),
        (F.col("status_processamento") == "falha_extracao", "nao_avaliavel_falha_de_extracao"),
    ], "nao_avaliavel_sem_evidencia_suficiente")
    why = F.concat(
        listed([(F.lit(True), first_match([(kind == "fatal", "fato_grave_confirmado"), (kind == "ambiental", "impacto_ambiental_confirmado"), (kind == "textual", "agravante_apenas_textual_nao_verificado")], "sem_agravante")), (probable, "vinculo_provavel"), (F.col("__capped"), "vinculo_provavel_teto_MEDIA")]),
        F.col("__age_why"), listed([(provisional, "classificacao_provisoria_agravante_nao_confirmado_em_campo_estruturado")]),
    )
    weak = F.array(F.concat(F.lit("vinculo_"), F.coalesce("faixa_vinculo", F.lit("None")), F.lit("_insuficiente")))
    out = d.withColumn("objeto", F.when(F.col("__unread"), "nao_avaliavel").when(~F.col("__linked"), "sem_vinculo").otherwise("acidente_ambiental")).withColumn("fase", F.when(ok, F.col("faixa_vinculo")))
    out = out.withColumn("nivel", F.when(F.col("__unread"), V.NOT_ASSESSABLE).when(~F.col("__linked"), "ROTINA").otherwise(F.col("__aged"))).withColumn("nivel_antes_idade", F.when(ok, F.col("__before")))
    out = out.withColumn("nivel_potencial", F.lit(None).cast("string")).withColumn("motivos", F.when(F.col("__unread"), F.array(failure)).when(~F.col("__linked"), weak).otherwise(why))
    out = out.withColumn("pontuacao", F.when(ok, F.round(F.coalesce("score_gravidade", F.lit(0.0)) / 11.0 * 100, 2)).otherwise(F.lit(0.0)))
    named = F.array_sort(F.map_keys(F.map_filter(F.coalesce("sinais_textuais", F.create_map().cast("map<string,boolean>")), lambda _, v: F.coalesce(v, F.lit(False)))))
    out = out.withColumn("reforcos", F.when(ok, named).otherwise(F.array().cast("array<string>"))).withColumn("avaliavel", ~F.col("__unread")).withColumn("evidencia_suficiente", F.lit(True)).withColumn("provisoria", provisional)
    out = out.withColumn("pendencia", F.when(provisional, "confirmacao_estruturada_do_agravante")).drop("__unread", "__linked", "__kind", "__before", "__capped", "__aged", "__age_why")
    return finalised(out)


def with_evidence_used(df: DataFrame) -> DataFrame:
    """evidencia_usada: what the row says, or what the level implies."""
    text = F.coalesce(F.nullif(F.col("evidencia_usada"), F.lit("")), first_match([(F.col("nivel") == V.NOT_ASSESSABLE, "nenhuma: texto oficial não lido"), (F.coalesce(F.col("tem_evidencia"), F.lit(True)), "evidência oficial estruturada (detalhe não informado pela origem)")], "nenhuma linha de evidência estruturada"))
    return df.withColumn("evidencia_usada", text)


def selection_group(level: Column, assessable: Column, sufficient: Column, provisional: Column, blocks: Column, status: Column, analysed: Column, only_new: bool = True) -> Column:
    """The selection group, by seven ordered steps."""
    on_floor = level.isin(*V.SELECTION_FLOOR) & assessable
    fresh = F.coalesce(status.isin(*V.NEW_STATUSES), F.lit(False)) if only_new else F.lit(True)
    return first_match([
        (level == V.NOT_ASSESSABLE, "NAO_AVALIAVEL"), (active(analysed), "FORA_DA_SELECAO"), (F.coalesce(status.isin(*V.CLOSED_STATUSES), F.lit(False)), "FORA_DA_SELECAO"), (~fresh, "FORA_DA_SELECAO"),
        (level.isin(*V.POTENTIAL.values()) | (on_floor & (provisional | ~sufficient)), "PENDENTE_DE_EVIDENCIA"), (on_floor & sufficient & ~provisional & (F.size(blocks) == 0), "SELECIONAVEL_AGORA"),
    ], "FORA_DA_SELECAO")


def selection_order(level: str = "nivel", potential: str | None = "nivel_potencial", priority: str = "prioridade", points: str = "pontuacao", age: str = "idade_dias", quality: str = "qualidade_evidencia", key: str = "id_evento", levels: Sequence[str] = V.LEVELS) -> list[Column]:
    """The selection key (O1): potential level or level, priority, points, age with null last, evidence quality, id."""
    lv = F.coalesce(F.col(potential), F.col(level)) if potential else F.col(level)
    place = F.instr(F.lit("ABCD"), F.col(priority))
    return [rank_of(lv, levels).desc(), F.when(F.col(priority).isNull(), 4).otherwise(place - 1).asc(), F.coalesce(F.col(points), F.lit(0.0)).desc(), F.coalesce(F.col(age), F.lit(10**9)).asc(), F.coalesce(F.col(quality), F.lit(0)).desc(), F.col(key).asc()]


def selected(df: DataFrame, eligible: Column, order: Sequence[Column], limit: int = V.SELECTION_LIMIT, per: Sequence[str] = (), key: str = "id_evento") -> DataFrame:
    """df with posicao (among the eligible) and resultado: escolhido, cortado_por_limite, abaixo_do_piso.

    The limit is a cap, not a quota. Only the eligible are ranked, per group where one is named; with none, the
    few rows that can be chosen come from a distributed top-k and no task sorts them all.
    """
    ok = active(eligible)
    if per:
        w = Window.partitionBy(*per, ok).orderBy(*order)
        out = df.withColumn("posicao", F.when(ok, F.row_number().over(w)))
        return out.withColumn("resultado", first_match([(~ok, "abaixo_do_piso"), (F.col("posicao") <= limit, "escolhido")], "cortado_por_limite"))
    top = df.filter(ok).orderBy(*order).limit(limit)
    places = top.withColumn("posicao", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))).select(F.col(key).alias("__key"), "posicao")
    out = df.join(places, F.col(key) == F.col("__key"), "left").drop("__key")
    return out.withColumn("resultado", first_match([(~ok, "abaixo_do_piso"), (F.col("posicao").isNotNull(), "escolhido")], "cortado_por_limite"))


def just_below(df: DataFrame, per: Sequence[str], below: Column, order: Sequence[Column], n: int = 10) -> DataFrame:
    """The n best rows below the floor of each group."""
    w = Window.partitionBy(*per).orderBy(*order)
    return df.filter(below).withColumn("posicao", F.row_number().over(w)).filter(F.col("posicao") <= n)


def page(df: DataFrame, order: Sequence[Column], offset: int, size: int) -> DataFrame:
    """A resumable lot: rows offset+1 to offset+size of an order."""
    return df.orderBy(*order).offset(offset).limit(size)


def simulated(df: DataFrame, before: str, per: Sequence[str], limit: int) -> DataFrame:
    """What-if rows: grupo, posicao_no_grupo, dentro_do_teto, movimento against the priority before, ab_para_d.

    ``df`` is classified, with grupo; places are by the selection key. Groups are few and large, so they are ranked
    in parts of equal level, priority, points and age. A changed rule is a changed argument of the classification.
    """
    level = rank_of(F.coalesce("nivel_potencial", "nivel"), V.LEVELS)
    place = F.when(F.col("prioridade").isNull(), 4).otherwise(F.instr(F.lit("ABCD"), F.col("prioridade")) - 1)
    leading = [(level, True), (place, False), (F.coalesce("pontuacao", F.lit(0.0)), True), (F.coalesce("idade_dias", F.lit(10**9)), False)]
    out = ranked_in_parts(df, [*per, "grupo"], leading, [F.coalesce("qualidade_evidencia", F.lit(0)).desc(), F.col("id_evento").asc()], "posicao_no_grupo")
    was, now = F.instr(F.lit("DCBA"), F.coalesce(F.col(before), F.lit("-"))), F.instr(F.lit("DCBA"), F.coalesce(F.col("prioridade"), F.lit("-")))
    move = first_match([(now > was, "subiu"), (now < was, "desceu")], "igual")
    return out.withColumn("dentro_do_teto", (F.col("grupo") == "SELECIONAVEL_AGORA") & (F.col("posicao_no_grupo") <= limit)).withColumn("movimento", move).withColumn("ab_para_d", F.coalesce(F.col(before).isin("A", "B") & (F.col("prioridade") == "D"), F.lit(False)))


def review_tags(before: Column, after: Column, undefined: Column, pending: Column) -> Column:
    """Review tags joined by ';' (R21): over- and under-rated, moved by two or more, ambiguous, pending."""
    was, now = F.instr(F.lit("DCBA"), F.coalesce(before, F.lit("-"))), F.instr(F.lit("DCBA"), F.coalesce(after, F.lit("-")))
    both = (was > 0) & (now > 0)
    change = F.concat(F.coalesce(before, F.lit("-")), F.lit("->"), F.coalesce(after, F.lit("-")))
    return F.array_join(listed([(both & (now < was), F.concat(F.lit("superestimado:"), change)), (both & (now > was), F.concat(F.lit("subestimado:"), change)), (both & (F.abs(now - was) >= 2), F.concat(F.lit("mudou_2_ou_mais:"), change)), (active(undefined), "ambiguo:fase_indefinida"), (active(pending), "pendente:evidencia")]), ";")


def best_of_case(df: DataFrame, case: str, tie: Sequence[str]) -> DataFrame:
    """The classified act that stands for a case (A4): level, points, recency, then the tie columns."""
    rank = [rank_of(F.col("nivel"), V.LEVELS), F.col("pontuacao"), -F.coalesce(F.col("idade_dias"), F.lit(10**9))]
    key = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)])
    return df.groupBy(case).agg(F.max_by(F.struct(*[c for c in df.columns if c != case]), key).alias("__b")).select(case, "__b.*")
