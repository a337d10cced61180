"""Impact triage: what discovery finds, the limitation audit, literal excerpts and the priority of exposure in one record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import add_years, age_days, months_until
from ledgerline.functions.text import blank_to_null, fold, matched_words, sentences, word_pattern
from ledgerline.operators.rules import active, first_match
from ledgerline.plans import vocabulary as V
from ledgerline.plans.gates import discovered
from ledgerline.plans.recalculation import industry_code

#: Words of direct activity, of environmental and of social impact. Marks and case do not count.
ACTIVITY = (
    "cava da mina", "barragem de rejeitos", "pilha de estéril", "bacia de sedimentação", "drenagem ácida de mina", "drenagem ácida", "dam", "lavra a céu aberto", "lavra subterrânea", "duto de polpa", "espodumênio",
    "minério de ferro", "bauxita", "manganês", "ouro", "lítio", "terras raras",
)
ENVIRONMENT = (
    "mortandade de peixes", "poluição de rios", "córrego", "bacia hidrográfica", "assoreamento", "turbidez da água", "rejeitos na calha", "vazamento de lama", "contaminação do solo", "terra estéril", "erosão",
    "degradação da camada superficial", "inutilização da área", "metais pesados", "arsênio", "chumbo", "cádmio", "cianeto", "mercúrio", "aquífero", "lençol freático", "área de recarga", "infiltração de efluentes", "percolação",
)
SOCIAL = (
    "poço artesiano", "cisterna", "captação comunitária", "assentamento rural", "comunidade tradicional", "vazamento em propriedade de terceiros", "perda de potabilidade", "dessedentação de animais", "pescadores",
    "economia da pesca", "agricultores", "destruição de lavoura", "inviabilidade econômica",
)
#: The state of triage and its reason for each result of discovery.
STATES = {
    "CLASSIFICAR_AGORA": ("candidato_fila_editor", "porta_editorial_ativada"), "PENDENTE_DE_EVIDENCIA": ("em_revisao", "evidencia_ou_vinculo_inconclusivo"), "NAO_AVALIAVEL": ("em_revisao", "documento_ausente_ou_ilegivel"),
    "MONITORAMENTO_ESTRATEGICO": ("monitoramento_estrategico", "watchlist_sem_fato_novo"), "ROTINA": ("descartado", "ato_rotineiro_confirmado"), "FORA_DO_ESCOPO": ("descartado", "vinculo_minerario_nao_comprovado"),
}
#: Names of jurisdictions as registers write them, years to the limit, days of rest that matter, and months that are near.
FEDERAL, STATE = ("federal", "anm"), ("minas gerais", "mg", "estadual mg")
LIMIT_YEARS, IDLE_FEDERAL, IDLE_EXPOSED, MONTHS_EXPOSED = 5, 3 * 365, 365, 12


def limitation_audit(jurisdiction: Column, last_act: Column, mark: Column, state_inertia: Column, reference: Column) -> Column:
    """Struct dias_parado, meses_limite, regra, alerta of a case's limitation period.

    Days since the last act, if it is not in the future. A federal period runs five years from its mark; one of the state
    only where the inertia of the state alone is confirmed; elsewhere none is worked out. ``alerta`` says, as a code, what has
    to be checked: sem_dados, prazo_desde_o_marco, parado_ha_tres_anos, estimativa_condicional, marco_ou_inercia_nao_confirmados.
    """
    j = fold(F.coalesce(jurisdiction, F.lit("")))
    idle = F.when(last_act <= reference, age_days(last_act, reference))
    left = months_until(reference, add_years(mark, LIMIT_YEARS))
    federal, state = j.isin(*FEDERAL), j.isin(*STATE)
    sure = mark.isNotNull() & active(state_inertia)
    months = F.when(mark.isNotNull() & (federal | (state & sure)), left)
    rule = first_match([(federal, "federal"), (state, "estadual")])
    note = first_match(
        [(federal & (idle >= IDLE_FEDERAL), "parado_ha_tres_anos"), (federal & mark.isNotNull(), "prazo_desde_o_marco"), (state & sure, "estimativa_condicional"), (state, "marco_ou_inercia_nao_confirmados")],
        "sem_dados",
    )
    return F.struct(idle.alias("dias_parado"), months.alias("meses_limite"), rule.alias("regra"), note.alias("alerta"))


def _holds(c: Column, terms: Sequence[str]) -> Column:
    """Whether a text has one of the terms as whole words."""
    f = fold(c)
    return reduce(lambda a, b: a | b, [f.rlike(word_pattern(t)) for t in terms])


def triage_records(events: DataFrame, key: str, reference: Column, fields: Sequence[str] = (), gates: Mapping[str, Sequence[str]] = V.GATES, sector: Sequence[str] = V.SECTOR_TERMS) -> DataFrame:
    """A triage record per event.

    events: key, titulo, texto_setorial, texto_fiscal, cnae, fonte_url, jurisdicao, data_ultima_movimentacao (date),
    marco_inicial_prescricao (date), inercia_exclusiva_estado, and whatever ``fields`` names for ``gates.discovered``.
    The excerpt is the first sentence of the fiscal text that names an impact, as it stands there. Exposure is high after a year
    without an act or within a year of the limit. A record without an excerpt or a source is to be checked by hand.
    """
    text = F.concat_ws("\n", *[blank_to_null(F.col(c)) for c in ("titulo", "texto_setorial", "texto_fiscal")])
    found = discovered(events.withColumn("__text", text), key, "__text", fields, gates, sector)
    d = events.join(found.withColumnRenamed(key, "__found"), F.col(key).eqNullSafe(F.col("__found")))
    status = first_match([(F.col("resultado") == k, F.struct(F.lit(s).alias("status"), F.lit(m).alias("motivo"))) for k, (s, m) in STATES.items()])
    impact = F.filter(sentences(F.col("texto_fiscal")), lambda s: _holds(s, (*ENVIRONMENT, *SOCIAL)))
    d = d.withColumns({
        "__status": status, "trecho": F.get(impact, F.lit(0)), "__audit": limitation_audit(F.col("jurisdicao"), F.col("data_ultima_movimentacao"), F.col("marco_inicial_prescricao"), F.col("inercia_exclusiva_estado"), reference),
        "evidencias_atividade": matched_words(F.col("texto_setorial"), ACTIVITY), "evidencias_ambientais": matched_words(F.col("texto_fiscal"), ENVIRONMENT), "evidencias_sociais": matched_words(F.col("texto_fiscal"), SOCIAL),
    })
    exposed = F.coalesce(F.col("__audit.dias_parado") >= IDLE_EXPOSED, F.lit(False)) | F.coalesce(F.col("__audit.meses_limite") <= MONTHS_EXPOSED, F.lit(False))
    by_hand = F.col("requer_revisao") | F.col("trecho").isNull() | (F.coalesce("fonte_url", F.lit("")) == "")
    return d.select(
        key, F.col("__status.status").alias("status_triagem"), "resultado", F.col("__status.motivo").alias("motivo_status"), "vinculo", "portas", F.get("evidencias_atividade", F.lit(0)).alias("atividade_direta"), industry_code(F.col("cnae")).alias("cnae_enquadrado"),
        "evidencias_atividade", "evidencias_ambientais", "evidencias_sociais", "trecho", (F.col("trecho").isNotNull() & _holds(F.col("trecho"), ENVIRONMENT) & _holds(F.col("trecho"), SOCIAL)).alias("cobre_os_dois_nexos"),
        F.when(F.col("__status.status") != "descartado", "pendente").alias("revisao_humana"), "__audit.dias_parado", "__audit.meses_limite", "__audit.regra", "__audit.alerta",
        F.when(exposed, "ALTA_RELEVANCIA_ALERTA_VERMELHO").otherwise("EXPOSICAO_PADRAO").alias("prioridade_exposicao"), by_hand.alias("requer_conferencia"),
    )
