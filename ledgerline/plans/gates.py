"""Discovery gates over sentences, triage records, inactivity audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import add_years, age_days, months_until
from ledgerline.functions.text import bound, fold, folded, matched_words, sentence_nature, sentences, text_status
from ledgerline.operators.rules import active, first_match
from ledgerline.plans import vocabulary as V
from ledgerline.plans.recalculation import industry_code


def vocabulary_table(spark: SparkSession, gates: Mapping[str, Sequence[str]]) -> DataFrame:
    """gate, term, and the folded term: a few hundred rows made of literals."""
    rows = [F.struct(F.lit(g).alias("gate"), F.lit(t).alias("term"), F.lit(folded(t)).alias("folded")) for g, terms in gates.items() for t in terms]
    return spark.range(1).select(F.inline(F.array(*rows)))


def gate_signals(df: DataFrame, key: str, text: str, gates: Mapping[str, Sequence[str]] = V.GATES, negative=V.NEGATIVE_MARKS, alleged=V.ALLEGED_MARKS, risk=V.RISK_MARKS, exempt: str = V.GATE_EXEMPT_FROM_NEGATION) -> DataFrame:
    """A row per gate, sentence and term that hits it: key, position, gate, term, nature, sentence.

    Sentences are exploded once; the terms a sentence can hit come from one pass that extracts them all,
    and gates join on the term. Negated hits are dropped, but for the gate that is exempt.
    """
    terms = sorted({folded(t) for ts in gates.values() for t in ts}, key=lambda t: (-len(t), t))
    s = df.select(key, F.posexplode(sentences(F.col(text))).alias("position", "sentence")).withColumn("__f", fold(F.col("sentence")))
    padded = F.concat(F.lit(" "), F.regexp_replace("__f", r"[^\w]+", " "), F.lit(" "))
    hits = bound(padded, lambda p: F.array_compact(F.array(*[F.when(F.contains(p, F.lit(f" {t} ")), F.lit(t)) for t in terms])))
    vocabulary = vocabulary_table(df.sparkSession, gates)
    found = s.withColumn("folded", F.explode(hits)).join(F.broadcast(vocabulary), "folded")  # the vocabulary's size is fixed in code
    nature = sentence_nature(F.col("__f"), negative, alleged, risk, F.col("gate") == exempt, is_folded=True)
    return found.withColumn("nature", nature).filter("nature <> 'NEGATIVA_EXPLICITA'").select(key, "position", "gate", "term", "nature", "sentence")


def discovered(df: DataFrame, key: str, text: str, fields: Sequence[str] = (), gates: Mapping[str, Sequence[str]] = V.GATES, sector: Sequence[str] = V.SECTOR_TERMS, structured: Mapping[str, Sequence[str]] = V.STRUCTURED_GATES) -> DataFrame:
    """df's key with vinculo, portas (sorted gates), resultado, motivo, requer_revisao, selecionavel.

    ``fields`` are columns of df (boolean, or filled when they hold) that structured gates and official links
    read; ``cnae`` and ``documento_url`` are read where df has them. The watch-list gate opens only with news.
    """
    have = set(fields)
    kinds = dict(df.dtypes)
    flag = lambda c: F.lit(False) if c not in have else active(F.col(c)) if kinds[c] == "boolean" else F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    any_flag = lambda cs: reduce(lambda a, b: a | b, [flag(c) for c in cs], F.lit(False))
    news = any_flag(V.NOVELTY)
    signals = gate_signals(df, key, text, gates)
    opened = signals.groupBy(key).agg(F.array_sort(F.collect_set("gate")).alias("__gates"), F.bool_or(F.col("nature") != "SINAL_TEXTUAL_SEM_CONFIRMAR_CAUSALIDADE").alias("__unsure"))
    watch = flag("empresa_watchlist") | flag("ativo_watchlist") | flag("projeto_estrategico")
    extra = [(reduce(lambda a, b: a | b, [flag(c) for c in cols], F.lit(False)) & (news if g.startswith("P8_") else F.lit(True)), g) for g, cols in structured.items()]
    code = industry_code(F.col("cnae")).isNotNull() if "cnae" in df.columns else F.lit(False)
    contextual = F.coalesce(F.col("tipos_contextuais"), F.lit(0)) >= 2 if "tipos_contextuais" in df.columns else F.lit(False)
    d = df.withColumn("__sector", matched_words(F.col(text), sector)).join(opened, key, "left")
    d = d.withColumn("__link", first_match([((F.size("__sector") > 0) | code | any_flag(V.OFFICIAL_LINKS), "DIRETO"), (contextual, "CONTEXTUAL")], "NAO_COMPROVADO"))
    d = d.withColumn("portas", F.array_sort(F.array_distinct(F.concat(F.coalesce("__gates", F.array().cast("array<string>")), F.array_compact(F.array(*[F.when(c, F.lit(g)) for c, g in extra]))))))
    url = F.coalesce(F.col("documento_url").cast("string"), F.lit("")) != "" if "documento_url" in df.columns else F.lit(False)
    empty = (F.trim(F.coalesce(F.col(text), F.lit(""))) == "") & ~url
    link, open_ = F.col("__link"), F.size("portas") > 0
    routine = flag("ato_rotineiro_inequivoco")
    result = first_match([
        (empty, "NAO_AVALIAVEL"), (link == "NAO_COMPROVADO", "FORA_DO_ESCOPO"), (open_ & (link == "DIRETO"), "CLASSIFICAR_AGORA"), (open_, "PENDENTE_DE_EVIDENCIA"), (routine, "ROTINA"), (watch, "MONITORAMENTO_ESTRATEGICO"),
    ], "PENDENTE_DE_EVIDENCIA")
    reason = first_match([
        (empty, "documento_ou_conteudo_ausente"), (link == "NAO_COMPROVADO", "vinculo_minerario_nao_comprovado"), (open_, "porta_editorial_ativada"), (routine, "ato_rotineiro_confirmado"), (watch, "watchlist_sem_fato_novo_ou_porta"),
    ], "nenhuma_porta_identificada")
    out = d.select(key, link.alias("vinculo"), "portas", result.alias("resultado"), reason.alias("motivo"), text_status(F.col(text), V.TEXT_STATUS, "AUSENCIA_DE_INFORMACAO", "SINAL_SEM_STATUS_CONCLUSIVO").alias("semantica"), F.coalesce("__unsure", F.lit(False)).alias("__unsure"))
    review = F.col("resultado").isin("NAO_AVALIAVEL", "PENDENTE_DE_EVIDENCIA", "MONITORAMENTO_ESTRATEGICO") | F.col("__unsure")
    return out.withColumn("requer_revisao", review).withColumn("selecionavel", F.col("resultado") == "CLASSIFICAR_AGORA").drop("__unsure")


def inactivity(start: Column, last_act: Column, reference: Column, years: int, idle_years: int) -> Column:
    """Struct of the limitation audit (X20): deadline after ``years``, whole months left, idle days, status."""
    deadline, idle = add_years(start, years), age_days(F.coalesce(last_act, start), reference)
    status = first_match([(start.isNull(), "SEM_DATA"), (reference > deadline, "PRAZO_VENCIDO"), (idle > 365 * idle_years, "INATIVO"), (months_until(reference, deadline) <= 6, "PRAZO_PROXIMO")], "EM_CURSO")
    return F.struct(deadline.alias("prazo"), months_until(reference, deadline).alias("meses"), idle.alias("dias_inativo"), status.alias("status"))
