"""Notices from their text to what becomes of them: link, severity, portfolio score, queue, route."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.rules import active, first_match
from ledgerline.operators.scope import criteria_met
from ledgerline.operators.shared import written
from ledgerline.plans.scores import ALIASES, link_score, link_signals, portfolio_band, severity_normalised, severity_score, severity_signals

#: Components that a notice has a value for, by the name after aliases.
COMPONENTS = ("score_gravidade", "dano_risco")
LINKED = ("provavel", "confirmado")
BANDS = (80, 60, 40)
#: How the reason of a failed reading begins, or what it holds, where a run's requests were used up.
LIMIT_START, LIMIT_INSIDE = "limite:", "limite:limite de"


def stopped_by_limit(reason: Column) -> Column:
    """Whether a reading ended because the run's requests were used up."""
    text = F.coalesce(reason, F.lit(""))
    return F.startswith(text, F.lit(LIMIT_START)) | F.contains(text, F.lit(LIMIT_INSIDE))


def notice_eligibility(link_band: Column, band: Column) -> Column:
    """Struct selecionavel, motivo of a notice by its link and its portfolio band (F16)."""
    why = first_match([(~F.coalesce(link_band.isin(*LINKED), F.lit(False)), "vinculo_nao_suficiente"), (~F.coalesce(band.isin("A", "B"), F.lit(False)), "abaixo_das_bandas_A_B_da_carteira")], "prioridade_A_B_com_gravidade_de_pauta")
    return F.struct((why == "prioridade_A_B_com_gravidade_de_pauta").alias("selecionavel"), why.alias("motivo"))


def act_eligibility(band: Column) -> Column:
    """Struct selecionavel, motivo of a case of acts by its final band (F16)."""
    ok = F.coalesce(band.isin("A", "B"), F.lit(False))
    return F.struct(ok.alias("selecionavel"), F.when(ok, "prioridade_A_B_pela_regua_editorial").otherwise("abaixo_do_piso_editorial_m9a").alias("motivo"))


def routed_notices(notices: DataFrame, weights: Mapping[str, float], wanted: Column, bands: Sequence[float] = BANDS) -> DataFrame:
    """notices with their link, severity, scores and what becomes of them.

    notices: texto, titulo, municipio, atraso_minutos, motivo_falha (null: read), criado (whether the event is new). Added:
    score_vinculo, faixa_vinculo, gatilhos_vinculo, redutores_vinculo, score_gravidade, nivel_gravidade, gatilhos_gravidade,
    score_carteira, prioridade, criterios_ausentes, pesos_ausentes, motivo_fila, selecionavel, acao, status.

    acao: ``adiado_por_limite`` (nothing is stored; it comes again), ``falha_extracao``, ``descartado``, ``contextual``,
    ``processado`` or ``arquivado``. status is what the event's state becomes, null where it stays: only an event that was just
    created leaves the queue. A failed reading is contextual with score 0. Severity is scored for linked notices only.
    """
    failed = F.col("motivo_falha").isNotNull()
    text = F.when(~failed, F.col("texto"))
    # Signals are found once, in a table of their own; scores are sums over its columns.
    link, severity = link_signals(text, F.col("municipio"), F.lit(None).cast("string")), severity_signals(text, F.col("atraso_minutos"))
    d = written(notices.select("*", *[v.alias(f"__l_{k}") for k, v in link.items()], *[v.alias(f"__s_{k}") for k, v in severity.items()]), "notices")
    score, band, memory = link_score({k: F.col(f"__l_{k}") for k in link})
    d = d.withColumn("score_vinculo", F.when(failed, 0.0).otherwise(score)).withColumn("faixa_vinculo", F.when(failed, "contextual").otherwise(band)).withColumn("__memory", F.when(~failed, memory))
    linked = ~failed & F.col("faixa_vinculo").isin(*LINKED)
    found, level, active_weights = severity_score({k: F.col(f"__s_{k}") for k in severity})
    d = d.withColumn("score_gravidade", F.when(linked, found)).withColumn("nivel_gravidade", F.when(linked, level)).withColumn("gatilhos_gravidade", F.when(linked, active_weights))
    absent = sorted({ALIASES.get(k, k) for k in weights} - set(COMPONENTS))
    missing = F.array(*[F.lit(k) for k in absent]).cast("array<string>")
    d = d.withColumn("score_carteira", F.when(linked, severity_normalised(F.col("score_gravidade")))).withColumn("prioridade", F.when(linked, portfolio_band(F.col("score_carteira"), *[F.lit(float(b)) for b in bands])))
    ok, lacking = criteria_met({"titulo_fato": F.col("titulo"), "municipio": F.col("municipio"), "tipo_evento": F.lit("comunicado_acidente_ambiental")}, wanted)
    d = d.withColumn("criterios_ausentes", F.when(linked, lacking)).withColumn("pesos_ausentes", F.when(linked, missing))
    reason = first_match(
        [
            (failed, F.lit(None).cast("string")), (F.col("faixa_vinculo") == "descartado", F.lit(None).cast("string")), (F.col("faixa_vinculo") == "contextual", "vinculo_contextual"),
            (~ok, F.concat(F.lit("criterio_da_carteira_nao_atendido:"), F.array_join("criterios_ausentes", ","))), (~F.col("prioridade").isin("A", "B"), "abaixo_das_bandas_A_B_da_carteira"),
            (F.size("pesos_ausentes") > 0, F.concat(F.lit("componentes_ponderados_indisponiveis:"), F.array_join("pesos_ausentes", ","))),
        ],
        "prioridade_A_B_pelas_bandas_da_carteira",
    )
    d = d.withColumn("motivo_fila", reason).withColumn("selecionavel", F.coalesce(F.col("motivo_fila") == "prioridade_A_B_pelas_bandas_da_carteira", F.lit(False)))
    action = first_match(
        [(failed & stopped_by_limit(F.col("motivo_falha")), "adiado_por_limite"), (failed, "falha_extracao"), (F.col("faixa_vinculo") == "descartado", "descartado"), (F.col("faixa_vinculo") == "contextual", "contextual"), (F.col("selecionavel"), "processado")],
        "arquivado",
    )
    d = d.withColumn("acao", action)
    new = active(F.col("criado"))
    leaves = first_match([(F.col("acao") == "descartado", "descartado"), (F.col("acao").isin("contextual", "arquivado"), "arquivado")], "em_apuracao")
    d = d.withColumn("status", F.when((F.col("acao") != "adiado_por_limite") & new, leaves))
    empty = F.create_map().cast("map<string,double>")
    d = d.withColumn("gatilhos_vinculo", F.coalesce("__memory.gatilhos", empty)).withColumn("redutores_vinculo", F.coalesce("__memory.redutores", empty))
    return d.drop("__memory", *[f"__l_{k}" for k in link], *[f"__s_{k}" for k in severity])
