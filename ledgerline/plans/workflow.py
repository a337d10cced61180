"""The append-only workflow log: validity of transitions, evidence matrices, versions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.keys import content_hash
from ledgerline.operators.latest import continuity, newest_flag
from ledgerline.operators.rules import active, listed, violations
from ledgerline.operators.segments import scanned
from ledgerline.operators.shared import written
from ledgerline.plans import vocabulary as V


def transition_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = V.TRANSITIONS) -> DataFrame:
    """acao, de, para as a literal table (G1)."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(a).alias("acao"), F.lit(d).alias("de"), F.lit(p).alias("para")) for a, d, p in rules])))


def _payload(path: str) -> Column:
    return F.coalesce(F.get_json_object("payload", f"$.{path}"), F.lit(""))


def transition_violations(log: DataFrame, rules: DataFrame, key: str = "event_id", seq: str = "seq", initial: str = "SEM_FLUXO", enabled: bool = True, segment: Column | None = None) -> DataFrame:
    """Every row of a log with the list of what is wrong with it (G2, batch form).

    Rows are judged against the row before, accepted or not; ``stream_states`` judges against the last
    accepted one. log: key, seq, de, acao, para, usuario_id, motivo, payload (JSON text).
    """
    d = continuity(log, key, seq, "de", "para", initial, segment)
    known = rules.select("acao", "de", "para", F.lit(True).alias("__known"))
    d = d.join(F.broadcast(known), ["acao", "de", "para"], "left")  # the table has as many rows as code lists
    act, back = F.col("acao"), _payload("origem_devolucao")
    final = act.isin("DEVOLVER_REPROVADA", "DEVOLVER_FINAL", "REVOGAR_APROVACAO")
    bad = violations([
        (F.lit(not enabled), "fluxo_desligado"), (~F.col("continuous"), "estado_divergente"), (F.col("__known").isNull(), "transicao_proibida"),
        (~F.startswith(act, F.lit("COLETOR_")) & F.col("usuario_id").isNull(), "usuario_obrigatorio"),
        (act.isin(*V.REASON_REQUIRED) & (F.trim(F.coalesce("motivo", F.lit(""))) == ""), "motivo_obrigatorio"),
        ((act == "INCLUIR_MANUAL") & (_payload("origem") != "SELECAO_MANUAL"), "inclusao_manual_exige_origem"),
        ((act == "DEVOLVER_ANALISE") & (_payload("ajuste_pedido") == ""), "ajuste_pedido_obrigatorio"),
        ((final | (act == "DEVOLVER_ANALISE")) & ~back.isin("ANALISE", "FINAL"), "origem_devolucao_obrigatoria"),
        (((act == "DEVOLVER_ANALISE") & (back == "FINAL")) | (final & (back == "ANALISE")), "origem_devolucao_incoerente"),
        ((act == "APURACAO_REGISTRADA") & ((F.trim(_payload("item")) == "") | (F.trim(_payload("fonte")) == "") | (F.trim(_payload("justificativa")) == "")), "apuracao_incompleta"),
        ((act == "LIBERAR_PRE_RELEASE") & (_payload("conferencia") != "true"), "conferencia_obrigatoria"), ((act == "APROVAR") & (_payload("conferencia_final") != "true"), "conferencia_final_obrigatoria"),
        ((act == "PUBLICAR") & (_payload("confirmacao") != "true"), "confirmacao_obrigatoria"), ((act == "APROVAR_NOVA_ANALISE") & ~_payload("modo_analise").isin("delta", "completa"), "modo_analise_obrigatorio"),
    ])
    return d.withColumn("violations", bad).drop("__known", "expected", "continuous")


MATRIX = "array<struct<codigo:string,estado:string,critico:boolean,classe_impacto:string,fonte_primaria:boolean,evidencia_ids:array<string>,observacao:string,risco_reputacional:boolean,justificativa_sem_risco:string>>"
CLAIMS = "array<struct<id:string,texto:string,status:string,evidencias:array<struct<evidencia_id:string>>>>"


def _blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def _judged(dossiers: DataFrame, evidence: DataFrame, key: str, event: str, column: str, schema: str, name: str, ids: Callable[[Column], Column], rules: Callable[[Column], list[tuple[Column, str]]], invalid: str) -> DataFrame:
    """key and the violations of the items of a JSON list, in order of items, codes and names.

    A list is read once and judged in its row; only items with evidence are rows of their own, for the anti-join by which
    evidence has to be the event's, and what that finds comes back as a row a list.
    """
    found = F.col("__i")
    named = lambda p, i, code: F.struct(p.alias("__p"), code.alias("code"), i[name].alias("name"))
    codes = lambda i, p: F.transform(F.filter(F.array(*[F.when(c, F.lit(code)) for c, code in rules(i)]), lambda c: c.isNotNull()), lambda c: named(p, i, c))
    owned = lambda i, p: F.struct(p.alias("__p"), i[name].alias("name"), F.array_distinct(ids(i)).alias("ids"))
    # Made in one step over the items of one array, so that the text is parsed once; null where it is no list.
    both = F.transform(found, lambda i, p: F.struct(codes(i, p).alias("codes"), owned(i, p).alias("own")))
    d = dossiers.select(key, event, F.from_json(column, schema).alias("__i")).select(key, event, both.alias("__i"))
    d = written(d.select(key, event, found.isNull().alias("__none"), F.flatten(found["codes"]).alias("__codes"), F.filter(found["own"], lambda o: F.size(o["ids"]) > 0).alias("__own")), "judged")
    own = d.select(key, event, F.explode("__own").alias("__o")).select(key, event, "__o.__p", "__o.name", F.explode("__o.ids").alias("__e"))
    strange = own.join(evidence.select(F.col("id").alias("__e"), F.col("event_id").alias(event)), ["__e", event], "left_anti").select(key, named(F.col("__p"), F.struct(F.col("name").alias(name)), F.lit("evidencia_de_outro_evento")).alias("__s"))
    strange = strange.groupBy(key).agg(F.collect_set("__s").alias("__s"))
    every = F.array_sort(F.concat("__codes", F.coalesce("__s", F.array().cast("array<struct<__p:int,code:string,name:string>>"))))
    text = F.transform(every, lambda x: F.concat(F.coalesce(x["name"], F.lit("?")), F.lit(":"), x["code"]))
    return d.join(strange, key, "left").select(key, F.when(F.col("__none"), F.array(F.lit(invalid))).otherwise(text).alias("violations"))


def matrix_violations(dossiers: DataFrame, evidence: DataFrame, key: str = "id", event: str = "event_id", column: str = "matriz") -> DataFrame:
    """key and the violations of its evidence matrix, in order of items and rules.

    A matrix that is no list gives ``matriz_invalida``. Ownership of evidence is an anti-join.
    """
    rules = lambda i: [
        (_blank(i["codigo"]), "sem_codigo"), (~F.coalesce(i["estado"].isin(*V.MATRIX_STATES), F.lit(False)), "estado"), (~F.coalesce(i["classe_impacto"].isin(*V.IMPACT_CLASSES), F.lit(False)), "classe_impacto"),
        (active(i["critico"]) & (i["classe_impacto"] == "PERIFERICA"), "critico_periferico"), ((i["estado"] == "confirmado") & (F.coalesce(F.size(i["evidencia_ids"]), F.lit(0)) <= 0), "confirmado_sem_evidencia"),
        ((i["estado"] == "nao_localizado") & _blank(i["observacao"]), "nao_localizado_sem_observacao"), ((i["estado"] == "aguardando_contraditorio") & ~F.coalesce(i["risco_reputacional"], F.lit(True)) & _blank(i["justificativa_sem_risco"]), "sem_risco_sem_justificativa"),
    ]
    return _judged(dossiers, evidence, key, event, column, MATRIX, "codigo", lambda i: i["evidencia_ids"], rules, "matriz_invalida")


def claim_violations(dossiers: DataFrame, evidence: DataFrame, key: str = "id", event: str = "event_id", column: str = "afirmacoes") -> DataFrame:
    """key and the violations of its claims."""
    rules = lambda i: [(_blank(i["id"]) | _blank(i["texto"]), "sem_id_ou_texto"), (~F.coalesce(i["status"].isin(*V.MATRIX_STATES), F.lit(False)), "status"), ((i["status"] == "confirmado") & (F.coalesce(F.size(i["evidencias"]), F.lit(0)) <= 0), "confirmada_sem_evidencia")]
    return _judged(dossiers, evidence, key, event, column, CLAIMS, "id", lambda i: i["evidencias"]["evidencia_id"], rules, "afirmacoes_invalidas")


def _unconfirmed_source(matrix: Column) -> Column:
    return F.exists(F.coalesce(matrix, F.array().cast(MATRIX)), lambda i: F.coalesce(i["fonte_primaria"], F.lit(False)) & ~i["estado"].eqNullSafe(F.lit("confirmado")))


def _material_gap(matrix: Column) -> Column:
    return F.exists(F.coalesce(matrix, F.array().cast(MATRIX)), lambda i: (~i["estado"].isin("confirmado", "nao_aplicavel") & (i["classe_impacto"] != "PERIFERICA")) | ((i["estado"] == "aguardando_contraditorio") & F.coalesce(i["risco_reputacional"], F.lit(True))))


def generation_blocks(matrix: Column, review: Column, alerts: Column) -> Column:
    """G1-G4 that hold for a dossier: ``matrix`` parsed, ``review`` and ``alerts`` JSON text."""
    return _generation_blocks(_unconfirmed_source(matrix), review, alerts)


def _generation_blocks(source: Column, review: Column, alerts: Column) -> Column:
    said = lambda p: F.get_json_object(review, f"$.{p}")
    alert = lambda p: F.coalesce(F.get_json_object(alerts, f"$.{p}") == "true", F.lit(False))
    return listed([
        (~said("fonte_primaria").eqNullSafe(F.lit("localizada_e_legivel")) | source, "G1"), (~said("identidade_evento").eqNullSafe(F.lit("confirmada")) | alert("chaves_conflitantes"), "G2"),
        (~F.coalesce(said("natureza_ato").isin("pedido", "ato_efetivado", "nao_se_aplica"), F.lit(False)) | alert("pedido_ato_ambiguo"), "G3"), (~said("duplicidade").eqNullSafe(F.lit("nao")) | alert("duplicidade_nao_resolvida"), "G4"),
    ])


def publication_pending(versions: DataFrame, dossiers: DataFrame, checks: DataFrame, states: DataFrame) -> DataFrame:
    """id of each draft version and its blocks B1-B5.

    versions: id, event_id, versao, dossie_id, status_validacao, review (JSON of the release), created_at;
    dossiers: id, event_id, versao, matriz, alertas; checks: event_id, resultado, criado_em;
    states: event_id, state.

    A matrix is read where it lies, for the two facts that blocks need of it; no window or join carries it.
    """
    v = newest_flag(versions, "event_id", "versao")
    facts = dossiers.select("id", "event_id", "versao", "alertas", F.from_json("matriz", MATRIX).alias("__m")).select("id", "event_id", "versao", "alertas", _unconfirmed_source(F.col("__m")).alias("__source"), _material_gap(F.col("__m")).alias("__gap"))
    d = newest_flag(facts, "event_id", "versao").select(F.col("id").alias("dossie_id"), "__source", "__gap", "alertas", F.col("is_newest").alias("__d_newest"))
    last = checks.filter("resultado = 'mudanca_material'").groupBy("event_id").agg(F.max("criado_em").alias("__change"))
    j = v.join(d, "dossie_id", "left").join(last, "event_id", "left").join(states.select("event_id", "state"), "event_id", "left")
    blocks = listed([
        (F.size(_generation_blocks(F.coalesce("__source", F.lit(False)), F.col("review"), F.col("alertas"))) > 0, "B1"), (F.coalesce("__gap", F.lit(False)), "B2"), (F.col("status_validacao") == "reprovada", "B3"),
        (~F.col("is_newest") | ~F.coalesce("__d_newest", F.lit(False)), "B4"), (F.coalesce(F.col("__change") > F.col("created_at"), F.lit(False)) | F.coalesce(F.col("state").isin("ATUALIZADO", "REVISAO_MUDANCA"), F.lit(False)), "B5"),
    ])
    return j.select("id", blocks.alias("blocks"))


def paired_log(log: DataFrame, dossiers: DataFrame, segment: Column, key: str = "event_id", seq: str = "seq") -> DataFrame:
    """One append-only log of transitions and draft versions, admitted in pairs (G7 with G2): key, seq, id, tipo, versao,
    violations, admitted.

    log: key, seq, id, tipo (``transicao`` or ``versao``), acao, para, dossie_id, hash_dossie (of a release's payload),
    liberacao_id and bloqueantes (of versions: the release it is made on, how many rules its text breaks), versao_id (of the
    transition that a version makes). dossiers: id, event_id, hash.

    A version stands on the release that is the last transition before it, with that release's dossier and hash, and
    is followed at once by the transition that names it; neither is admitted without the other, so a reader of the log
    never sees one of a pair alone. Other transitions pass here and are ``transition_violations``' to judge. ``versao``
    numbers the admitted versions of a key; ``segment`` spreads hot keys (``segments.scanned``).
    """
    is_version, generates = F.col("tipo") == "versao", (F.col("tipo") == "transicao") & F.coalesce(F.col("acao") == "GERAR_PRE_RELEASE", F.lit(False))
    step = F.when(F.col("tipo") == "transicao", F.struct("id", "para", "dossie_id", "hash_dossie"))
    d = scanned(log, [key], [seq], segment, previous={"__before": F.struct("tipo", "id")}, known={"__last": step})
    own = dossiers.select(F.col("id").alias("__dossier"), F.col("event_id").alias("__of"), F.col("hash").alias("__hash"))
    d = d.join(own, F.when(is_version, F.col("dossie_id")) == F.col("__dossier"), "left")
    released = F.coalesce((F.col("__last.para") == "PRE_RELEASE_LIBERADO") & (F.col("__last.id") == F.col("liberacao_id")), F.lit(False))
    bad = violations([
        (~released, "geracao_sem_liberacao_valida"), (released & ~F.coalesce((F.col("__of") == F.col(key)) & (F.col("__last.dossie_id") == F.col("dossie_id")), F.lit(False)), "versao_exige_o_dossie_liberado"),
        (released & ~F.coalesce(F.col("__hash") == F.col("__last.hash_dossie"), F.lit(False)), "liberacao_hash_dossie_diverge"),
    ])
    follows = generates & F.coalesce((F.col("__before.tipo") == "versao") & (F.col("__before.id") == F.col("versao_id")), F.lit(False))
    d = d.select(*log.columns, F.when(is_version, bad).alias("__bad"), generates.alias("__generates"), follows.alias("__follows"))
    made = d.filter("__follows").select(F.col(key).alias("__k"), F.col("versao_id").alias("__v"), F.lit(True).alias("__made"))
    d = d.join(made, (F.col(key) == F.col("__k")) & (F.when(is_version, F.col("id")) == F.col("__v")), "left").drop("__k", "__v")
    alone = violations([(F.col("__made").isNull(), "versao_sem_transicao")])
    d = d.withColumn("__bad", F.when(is_version, F.concat("__bad", alone)))
    refused = d.filter(is_version & (F.size("__bad") > 0)).select(F.col(key).alias("__k"), F.col("id").alias("__v"), F.lit(True).alias("__refused"))
    d = d.join(refused, (F.col(key) == F.col("__k")) & (F.when(F.col("__follows"), F.col("versao_id")) == F.col("__v")), "left")
    steps = violations([(F.col("__generates") & ~F.col("__follows"), "transicao_sem_versao"), (F.col("__follows") & F.col("__refused").isNotNull(), "versao_recusada")])
    d = d.withColumn("violations", F.when(is_version, F.col("__bad")).otherwise(steps)).withColumn("admitted", F.size("violations") == 0)
    counted = F.when(is_version & F.col("admitted"), 1).otherwise(0)
    d = scanned(d.select(*log.columns, "violations", "admitted"), [key], [seq], segment, sums={"__earlier": counted})
    number = F.when(is_version & F.col("admitted"), F.coalesce("__earlier", F.lit(0)) + 1)
    status = F.when(is_version & F.col("admitted"), F.when(F.coalesce("bloqueantes", F.lit(0)) > 0, "reprovada").otherwise("aprovada"))
    return d.select(key, seq, "id", "tipo", number.cast("long").alias("versao"), status.alias("status_validacao"), "violations", "admitted")


def lost_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of an append-only table that a later snapshot no longer has: empty if the guarantee holds."""
    return before.exceptAll(after.select(*before.columns))


def template_gaps(templates: DataFrame, dossiers: DataFrame, key: str = "id", module: str = "modulo") -> DataFrame:
    """Template items (per module: itens JSON) that a dossier's matrix lacks."""
    t = templates.select(module, F.explode(F.from_json("itens", "array<struct<codigo:string,critico:boolean,classe_impacto:string>>")).alias("__i")).select(module, "__i.*")
    have = dossiers.select(key, F.explode(F.from_json("matriz", MATRIX)).alias("__m")).select(key, F.col("__m.codigo").alias("codigo")).distinct()
    return dossiers.select(key, module).join(t, module).join(have, [key, "codigo"], "left_anti").select(key, "codigo", "critico", "classe_impacto")


def admitted_dossiers(dossiers: DataFrame, events: DataFrame, evidence: DataFrame, calls: DataFrame) -> DataFrame:
    """Dossiers with tenant, next version, content hash and violations."""
    m, c = matrix_violations(dossiers, evidence).withColumnRenamed("violations", "__m"), claim_violations(dossiers, evidence).withColumnRenamed("violations", "__c")
    ev = events.select(F.col("id").alias("event_id"), F.col("empresa_id").alias("__tenant"))
    own = calls.select(F.col("id").alias("execucao_id"), F.col("event_id").alias("__call_event"))
    j = dossiers.join(ev, "event_id", "left").join(own, "execucao_id", "left").join(m, "id", "left").join(c, "id", "left")
    bad = F.concat(violations([(F.col("__tenant").isNull(), "evento_inexistente"), (F.col("execucao_id").isNotNull() & ~F.col("__call_event").eqNullSafe(F.col("event_id")), "execucao_de_outro_evento")]), "__m", "__c")
    w = Window.partitionBy("event_id").orderBy("criado_em", "id")
    out = j.withColumn("violations", bad).withColumn("empresa_id", F.col("__tenant")).withColumn("versao", F.row_number().over(w)).withColumn("hash", content_hash("event_id", "matriz", "afirmacoes"))
    return out.drop("__tenant", "__call_event", "__m", "__c")


def frozen_ranking(chosen: DataFrame, lot: str, place: str, event: str, cap: int) -> DataFrame:
    """Per lot the ranked events, their number, a content hash and whether the cap is kept (V7). For lots of a bounded size:
    the items are in the row. ``frozen_lots`` takes any."""
    g = chosen.groupBy(lot).agg(F.array_sort(F.collect_list(F.struct(place, event))).alias("itens"), F.count("*").alias("n"))
    return g.withColumn("hash", F.sha2(F.to_json("itens"), 256)).withColumn("dentro_do_teto", F.col("n") <= cap)


def ordered_chunks(ranked: DataFrame, group: str, place: str, columns: Sequence[str], size: int = 1000) -> DataFrame:
    """group, parte (from 0), itens: each group's rows in their order as arrays of at most ``size`` (A23, V7), by the places 1, 2, 3, ...
    that they already have. However many rows a group has, a row of the result holds one part of it."""
    part = F.floor((F.col(place) - 1) / size).cast("long")
    return ranked.groupBy(group, part.alias("parte")).agg(F.array_sort(F.collect_list(F.struct(place, *columns))).alias("itens"))


def frozen_lots(ranked: DataFrame, lot: str, place: str, event: str, cap: int, size: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(chunks, lots) of a frozen ranking of any size (V7): chunks as ``ordered_chunks`` with the hash of each; lots with n,
    partes, hash and dentro_do_teto. A lot's hash is that of its chunks' hashes in order, so that a change of any item or
    place changes it, and no task holds more of a lot than a chunk and a digest of each of the others."""
    chunks = ordered_chunks(ranked, lot, place, [event], size).withColumn("hash", F.sha2(F.to_json("itens"), 256))
    each = F.array_sort(F.collect_list(F.struct("parte", "hash")))
    lots = chunks.groupBy(lot).agg(F.sum(F.size("itens")).cast("long").alias("n"), F.count("*").alias("partes"), each.alias("__h"))
    hashed = F.sha2(F.array_join(F.transform("__h", lambda x: x["hash"]), "\n"), 256)
    return chunks, lots.select(lot, "n", "partes", hashed.alias("hash"), (F.col("n") <= cap).alias("dentro_do_teto"))


def monitoring_violations(checks: DataFrame) -> DataFrame:
    """Monitoring rows with violations of their shape (C5): unchanged has no delta or date, changed has all."""
    changed = F.col("resultado") == "mudanca_material"
    some = F.col("delta").isNotNull() | F.col("data_mudanca").isNotNull()
    bad = violations([(changed & (F.col("delta").isNull() | F.col("data_mudanca").isNull()), "mudanca_incompleta"), (~changed & some, "sem_mudanca_com_delta"), (changed & F.col("impressao").eqNullSafe(F.col("impressao_anterior")), "mudanca_sem_diferenca")])
    return checks.withColumn("violations", bad)


