"""Signals and scores of acts, notices and permits; portfolio scores."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numbers import normalised_score
from ledgerline.functions.text import has_substring, has_unnegated, normalise, normalised, strip_accents, suffix_status
from ledgerline.operators.rules import active, active_weights, banded, capped_score, first_match, listed, weighted
from ledgerline.plans import vocabulary as V

ACT_FLAGS = (*V.ACT_WEIGHTS, *V.ACT_REDUCERS, "perda_de_lavra")
LINK_FLAGS = (*V.LINK_WEIGHTS, "municipio_minerador", *V.LINK_REDUCERS, "cadeia_mineral_industrial_nao_confirmada")


ACT_BANDS = ((8, "A"), (5, "B"), (2, "C"))


def act_signals(description: Column, substance: Column, holder: Column, area: Column, places: Column, normal: Column | None = None) -> dict[str, Column]:
    """The 13 signals of an act (R1). Terms are looked for as substrings of the type's normal form, in words too;
    ``normal`` is that form where it is at hand."""
    n = normalise(description) if normal is None else normal
    named = {k: has_substring(n, terms) for k, terms in V.ACT_TERMS.items()}
    done = suffix_status(n, V.SUFFIX_NEGATIVE, V.SUFFIX_PENDING, V.SUFFIX_DONE) == "concluido"
    size = F.replace(F.trim(F.coalesce(area.cast("string"), F.lit(""))), F.lit(","), F.lit("."))
    holds = lambda c, terms: strip_accents(F.trim(c)).rlike("|".join(re.escape(normalised(t)) for t in terms))
    return named | {
        "autorizacao_extracao": named["autorizacao_extracao"] & done, "avanco_pesquisa": named["avanco_pesquisa"] & done, "dimensao_objetiva": ~size.isin("", "0", "0.0"),
        "empresa_relevante": holds(holder, V.COMPANIES), "mineral_estrategico": holds(substance, V.MINERALS), "varios_municipios": F.coalesce(places, F.lit(1)) >= 2,
    }


def material_event(description: Column) -> Column:
    """Whether an act's type names a material change of right."""
    return has_substring(normalise(description), V.ACT_TERMS["mudanca_material_direito"])


def _act_limits(f: Mapping[str, Column]) -> tuple[list[tuple[str, Column, float]], list[tuple[str, Column, float]]]:
    on = {k: active(v) for k, v in f.items()}
    reinforced = on["dimensao_objetiva"] | on["empresa_relevante"] | on["mineral_estrategico"]
    other = reduce(lambda a, b: a | b, [on[k] for k in V.ACT_WEIGHTS if k != "alvara_comum_pesquisa"])
    caps = [
        ("teto_rotina", on["rotina"], 1), ("teto_exigencia", on["exigencia_generica"], 4), ("teto_relatorio_sem_reforco", on["avanco_pesquisa"] & ~reinforced, 7),
        ("teto_alvara_isolado", on["alvara_comum_pesquisa"] & ~other, 4), ("teto_reserva_sem_dimensao", on["reserva_ou_substancia"] & ~on["dimensao_objetiva"], 7),
    ]
    return caps, [("piso_perda_de_lavra", on["perda_de_lavra"], 8)]


def act_score(flags: Mapping[str, Column]) -> tuple[Column, Column, Column]:
    """(score 0-10, band A-D, reasons in order of the rules) of an act's signals (R2).

    Positive sum up to 10, reducers, at least 0, caps, and the floor for a lost mining right last.
    """
    caps, floors = _act_limits(flags)
    score = capped_score(flags, V.ACT_WEIGHTS, 10, V.ACT_REDUCERS, [(c, v) for _, c, v in caps], [(c, v) for _, c, v in floors])
    signed = [(k, w) for k, w in [*V.ACT_WEIGHTS.items(), *V.ACT_REDUCERS.items()]]
    reasons = listed([(active(flags[k]), f"{k}({w:+d})") for k, w in signed] + [(c, n) for n, c, _ in [*caps, *floors]])
    return score, banded(score, ACT_BANDS, "D"), reasons


def act_memory(flags: Mapping[str, Column]) -> Column:
    """Calculation memory (R3): active weights, reducers, highest floor, lowest cap. All caps that act are reported."""
    caps, floors = _act_limits(flags)
    return F.struct(
        active_weights(flags, V.ACT_WEIGHTS).alias("gatilhos"), active_weights(flags, V.ACT_REDUCERS).alias("redutores"),
        F.array_max(listed([(c, float(v)) for _, c, v in floors])).alias("piso"), F.array_min(listed([(c, float(v)) for _, c, v in caps])).alias("teto"),
    )


def link_signals(text: Column, place: Column, company: Column) -> dict[str, Column]:
    """Signals of a notice's link to mining (R4), with negation looked for before each hit."""
    base = F.concat_ws("\n", F.coalesce(text, F.lit("")), F.coalesce(place, F.lit("")), F.coalesce(company, F.lit("")))
    has = lambda k: has_unnegated(base, V.NOTICE_TERMS[k])
    other = has("produto_nao_minerario")
    material, mode, inputs = has("material_mineral") & ~other, has("modalidade_mineracao"), has("insumo_estrutura_vinculada")
    direct = material | mode | inputs
    return {
        "modalidade_mineracao": mode, "mina_identificada": F.lit(False), "material_mineral": material, "insumo_estrutura_vinculada": inputs, "municipio_minerador": has("municipio_minerador"),
        "produto_causa_nao_mineraria": other & ~direct, "acidente_rodoviario_comum": has("acidente_rodoviario") & ~direct, "cadeia_mineral_industrial_nao_confirmada": F.lit(False),
    }


def link_score(f: Mapping[str, Column]) -> tuple[Column, Column, Column]:
    """(score, band, memory) of a link (R4). A mining town counts only beside direct evidence, reducers only
    without it; the score may be negative; an undetermined chain is at least 5."""
    direct = reduce(lambda a, b: a | b, [active(f[k]) for k in V.LINK_WEIGHTS])
    flags = dict(f) | {"municipio_minerador": active(f["municipio_minerador"]) & direct} | {k: active(f[k]) & ~direct for k in V.LINK_REDUCERS}
    weights = {**V.LINK_WEIGHTS, "municipio_minerador": 1}
    bare = F.least(weighted(flags, weights), F.lit(10.0)) + weighted(flags, V.LINK_REDUCERS)
    lifted = active(f["cadeia_mineral_industrial_nao_confirmada"]) & (bare < 5)
    score = F.when(lifted, F.lit(5.0)).otherwise(bare)
    memory = F.struct(active_weights(f, weights).alias("gatilhos"), active_weights(f, V.LINK_REDUCERS).alias("redutores"), F.when(lifted, F.lit(5.0)).alias("piso"))
    return score, banded(score, [(8, "confirmado"), (5, "provavel"), (2, "contextual")], "descartado"), memory


def severity_signals(text: Column, delay_minutes: Column) -> dict[str, Column]:
    """Signals of a notice's severity (R5); an unknown delay is no delay."""
    has = lambda k: has_unnegated(text, V.NOTICE_TERMS[k])
    low = F.lower(F.coalesce(text, F.lit("")))
    names = list(V.SEVERITY_WEIGHTS)
    outside = reduce(lambda a, b: a | b, [F.contains(low, F.lit(t)) for t in V.NOTICE_TERMS["fora_dos_limites"]])
    late = F.coalesce(delay_minutes > 6 * 60, F.lit(False))
    return dict(zip(names, [has("curso_dagua"), outside, has("rejeito_ou_perigoso"), has("risco_estrutural"), late, has("vitimas_evacuacao")]))


def severity_score(f: Mapping[str, Column]) -> tuple[Column, Column, Column]:
    """(score 0-11, level, active weights)."""
    score = weighted(f, V.SEVERITY_WEIGHTS)
    return score, banded(score, [(7, "alerta_imediato"), (4, "pauta_apuracao"), (1, "registro_acompanhamento")], "arquivo_contextual"), active_weights(f, V.SEVERITY_WEIGHTS)


def severity_normalised(score: Column) -> Column:
    return normalised_score(score, float(sum(V.SEVERITY_WEIGHTS.values())))


def permit_score(parts: Mapping[str, Column], presumed: Column, undecided: Column, reducer: Column, out_of_scope: Column, strict_bands: bool = True) -> Column:
    """Struct of a permit's component score (R6): erros, soma, score, faixa, travas.

    A missing component or one outside its bounds is an error, and then there is no score. The reducer
    comes first, then the caps 79 and 59, then 0 to 100. With ``strict_bands`` the bands are the whole
    numbers of the rule, and a score between two of them falls to D.
    """
    errors = listed([(parts[k].isNull() if k in parts else F.lit(True), f"faltando:{k}") for k in V.PERMIT_MAXIMA] + [(~parts[k].between(0, m), f"fora_dos_limites:{k}") for k, m in V.PERMIT_MAXIMA.items() if k in parts])
    total = reduce(lambda a, b: a + b, [parts[k] if k in parts else F.lit(None).cast("double") for k in V.PERMIT_MAXIMA]).cast("double")
    less = total - F.coalesce(reducer, F.lit(0.0))
    first = F.when(active(undecided), F.least(less, F.lit(79.0))).otherwise(less)
    second = F.when(active(presumed), F.least(first, F.lit(59.0))).otherwise(first)
    score = F.greatest(F.least(second, F.lit(100.0)), F.lit(0.0))
    strict = first_match([(score.between(80, 100), "A"), (score.between(60, 79), "B"), (score.between(35, 59), "C")], "D")
    band = F.when(active(out_of_scope), "Fora").otherwise(strict if strict_bands else banded(score, [(80, "A"), (60, "B"), (35, "C")], "D"))
    locks = listed([(F.coalesce(reducer, F.lit(0.0)) != 0, "redutor"), (active(undecided) & (less > 79), "teto_79"), (active(presumed) & (first > 59), "teto_59")])
    good = F.size(errors) == 0
    return F.struct(errors.alias("erros"), total.alias("soma"), F.when(good, score).alias("score"), F.when(good, band).alias("faixa"), locks.alias("travas"))


def permit_verb(text: Column, rules: Sequence[tuple[str, str]] = V.PERMIT_VERBS) -> Column:
    """The decision that the verb of an act expresses: the first pattern of the ordered table."""
    t = F.regexp_replace(strip_accents(text), r"[^\x00-\x7F]", "")
    return first_match([(t.rlike(pattern), kind) for pattern, kind in rules], "indeterminado")


def permit_link(use: Column, activity: Column, text: Column) -> Column:
    """confirmado, nao_mineral_confirmado or indeterminado (R8). 'mina' counts as a whole word only."""
    t = strip_accents(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in (use, activity, text)]))
    mineral = reduce(lambda a, b: a | b, [t.rlike(r"\bmina\b") if w == "mina" else F.contains(t, F.lit(w)) for w in V.PERMIT_MINERAL])
    other = reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in V.PERMIT_OTHER_USE])
    return first_match([(mineral, "confirmado"), (other, "nao_mineral_confirmado")], "indeterminado")


def permit_route(verb: Column, link: Column, score: Column) -> Column:
    """What becomes of a permit act."""
    return first_match([(link == "nao_mineral_confirmado", "descartado"), ((link == "indeterminado") | (verb == "indeterminado"), "requer_revisao"), (score.isNull(), "aguardando_score")], "pontuado")


ALIASES = {"score_dano_risco": "dano_risco", "score_consequencia_operacional": "consequencia_operacional", "score_abrangencia_interesse_publico": "interesse_publico"}


def weighted_portfolio(scores: DataFrame, components: DataFrame, weights: DataFrame, key: str, portfolio: str) -> DataFrame:
    """scores (key, portfolio, base) with score and missing.

    The weighted mean counts only if every weighted component is there; else the base stays and the
    missing names are listed. Names are taken by their aliases. Components outside 0-100 give a null score.
    """
    alias = lambda c: first_match([(c == a, b) for a, b in ALIASES.items()], c)
    w = weights.select(portfolio, alias(F.col("componente")).alias("__c"), F.col("peso").cast("double").alias("__w"))
    c = components.select(key, alias(F.col("componente")).alias("__c"), F.col("valor").cast("double").alias("__v")).groupBy(key, "__c").agg(F.max("__v").alias("__v"))
    j = scores.select(key, portfolio).join(w, portfolio).join(c, [key, "__c"], "left")
    g = j.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("__v").isNull(), F.col("__c")))).alias("missing"), (F.sum(F.col("__v") * F.col("__w")) / F.sum("__w")).alias("__mean"), F.bool_and(F.col("__v").isNull() | F.col("__v").between(0, 100)).alias("__ok"))
    out = scores.join(g, key, "left")
    whole = (F.size(F.coalesce("missing", F.array().cast("array<string>"))) == 0) & F.col("__mean").isNotNull()
    return out.withColumn("score", F.when(whole, F.when(F.col("__ok"), F.col("__mean"))).otherwise(F.col("base"))).withColumn("missing", F.coalesce("missing", F.array().cast("array<string>"))).drop("__mean", "__ok")


def portfolio_band(score: Column, a: Column, b: Column, c: Column) -> Column:
    """Band by a portfolio's thresholds."""
    return first_match([(score >= a, "A"), (score >= b, "B"), (score >= c, "C")], "D")


def notice_route(failed: Column, link_band: Column, missing: Column, criteria_ok: Column, portfolio_band_: Column, created_now: Column) -> Column:
    """What becomes of a notice (R27): only one that was just created may leave the queue."""
    return first_match([
        (active(failed), "falha_extracao"), (link_band == "descartado", F.when(active(created_now), "descartado").otherwise("mantido")), (link_band == "contextual", "contextual"),
        (portfolio_band_ == "D", F.when(active(created_now), "arquivado").otherwise("mantido")), (F.size(missing) > 0, "pontuado_sem_pesos"), (~active(criteria_ok), "fora_dos_criterios"),
    ], "pontuado")


def process_queue_reason(missing: Column, criteria_missing: Column, band: Column) -> Column:
    """Why a case of acts is not queued, null if it is (R29, F16): weights first, then criteria, then the band."""
    return first_match([(F.size(missing) > 0, F.concat(F.lit("componentes_ausentes:"), F.array_join(missing, ","))), (F.size(criteria_missing) > 0, F.concat(F.lit("criterios:"), F.array_join(criteria_missing, ","))), (~F.coalesce(band.isin("A", "B"), F.lit(False)), F.concat(F.lit("banda_"), F.coalesce(band, F.lit("nula"))))])


def lot_order(criteria_ok: str, components_ok: str, band: str, score: str, key: str) -> list[Column]:
    """Order of cases in a portfolio's lots."""
    return [F.col(criteria_ok).desc(), F.col(components_ok).desc(), F.col(band).isin("A", "B").desc(), F.col(score).desc_nulls_last(), F.col(key)]
