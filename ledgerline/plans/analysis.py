"""Audit of stored analyses (JSON text) against the dossiers they were written from."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import BLANK as _SPACE
from ledgerline.functions.text import trim_all
from ledgerline.operators.rules import first_match, listed
from ledgerline.operators.shared import written

#: The sections of an analysis with their keys, the least length of each text, and the most items of each list.
SECTIONS = {"fato_confirmado": ("texto", "citacoes"), "contexto_documental": ("texto", "citacoes"), "avaliacao_editorial": ("texto",), "hipotese_apuracao": ("texto",), "proposta_abordagem": ("texto", "rascunho_pre_release")}
LEAST_TEXT = {"fato_confirmado": 20, "contexto_documental": 1, "avaliacao_editorial": 10, "hipotese_apuracao": 10, "proposta_abordagem": 10}
LISTS = {"lacunas": 8, "perguntas_redacao": 6}
MAX_TEXT, MAX_ITEM, MAX_DRAFT = 3000, 500, 6000
#: The sections in the order in which an analysis lists them.
ORDER = ("fato_confirmado", "contexto_documental", "avaliacao_editorial", "hipotese_apuracao", "lacunas", "perguntas_redacao", "proposta_abordagem")
#: Words that give a score if a number follows, and what may stand between; ranks; wording that releases.
SCORE_WORDS, SCORE_TAILS = ("score", "pontuação", "nota"), ("final", "de relevância")
RANK_WORD, RANKS = "prioridade", "ABCD"
RELEASE_STATES, RELEASE_TARGET, RELEASE_ARTICLE = ("pronto", "liberado", "liberada"), "publicação", "a"
RELEASE_PHRASES = ("publicar imediatamente", "pode ser publicad")

_PLAIN = str.maketrans("áàâãéêíóôõúç", "aaaaeeiooouc")


def spelt(term: str) -> str:
    """A pattern for a term in any case, each marked letter with or without its mark, with any blanks between its words."""
    letter = lambda c: f"[{re.escape(c)}{c.translate(_PLAIN)}]" if c != c.translate(_PLAIN) else re.escape(c)
    return f"{_SPACE}+".join("".join(letter(c) for c in word) for word in term.split())


def _any(terms: Sequence[str], pattern: Callable[[str], str] = spelt) -> str:
    return "(?:" + "|".join(pattern(t) for t in terms) + ")"


def _scores() -> str:
    sign = f"{_SPACE}*[:=]?{_SPACE}*"
    return f"(?iu)(?<![A-Za-z0-9_]){_any(SCORE_WORDS)}{_SPACE}*{_any(SCORE_TAILS)}?{sign}[0-9]"


def _ranks() -> str:
    return f'(?<![A-Za-z0-9_]){RANK_WORD}{_SPACE}*[:=]?{_SPACE}*"?[{RANKS}](?![A-Za-z0-9_])'


def _releases() -> str:
    target = f"{_any(RELEASE_STATES)}{_SPACE}+para{_SPACE}+(?:{RELEASE_ARTICLE}{_SPACE}+)?{spelt(RELEASE_TARGET)}"
    return f"(?iu)(?:{target}|{_any(RELEASE_PHRASES)})"


def _numbers(text: Column) -> Column:
    """Numbers of two digits or more, with the signs of dates, amounts and protocols between them."""
    digit, signs = "0-9", ".,/-"
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"([{digit}][{digit}{signs}]*[{digit}])"), 1)


def _digits(number: Column) -> Column:
    return F.regexp_replace(number, "[^0-9]", "")


def dossier_digits(dossier: Column) -> Column:
    """Digits of a dossier's numbers; its dates also in the other of the two orders, year first and day first."""
    text = F.coalesce(dossier, F.lit(""))
    turned = lambda pattern, order: F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), lambda d: F.concat(*[F.substring(d, at, n) for at, n in order]))
    day_first = turned(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", ((9, 2), (6, 2), (1, 4)))
    year_first = turned(r"[0-9]{2}/[0-9]{2}/[0-9]{4}", ((7, 4), (4, 2), (1, 2)))
    return F.array_distinct(F.concat(F.transform(_numbers(text), _digits), day_first, year_first))


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def _said(v: Column) -> Column:
    """A variant as a script would write it, for an error's note."""
    return F.when(F.startswith(_kind(v), F.lit("OBJECT")), "[object Object]").when(_kind(v) == "VOID", "null").otherwise(F.try_variant_get(v, "$", "string"))


def _inside(v: Column, most: Column) -> Column:
    """Whether a variant is a whole number within 1..most: not text, not true."""
    number = F.try_variant_get(v, "$", "double")
    numeric = _kind(v).isin("BIGINT", "DOUBLE") | F.startswith(_kind(v), F.lit("DECIMAL"))
    return F.coalesce(numeric & (number == F.floor(number)) & number.between(1, most), F.lit(False))


def _none() -> Column:
    return F.array().cast("array<string>")


def _named(base: Column, name: str, note: Callable[[Column], Column]) -> Column:
    return F.transform(base, lambda x: F.concat(F.lit(f"{name}("), note(x), F.lit(")")))


def audited_analyses(df: DataFrame, response: str, dossier: str, evidence: str) -> DataFrame:
    """df with erros and avisos of stored analyses (R32), JSON text with the sections above.

    Errors, in this order: unreadable text, something else than an object, other sections (no more is said then); sections of
    another structure; texts that are none, too short or too long; citations that are no whole numbers within 1..n, or none
    for the fact; lists and items; the draft; numbers of factual parts that the dossier has in neither date form; wording that
    scores, ranks or releases. Numbers of the other parts are only noted. Each text is parsed once, to a variant whose types
    are kept: a number in place of a text is no text, a text in place of a number is no number. A null text is unreadable.
    """
    roots = [*SECTIONS, *LISTS]
    d = df.withColumn("__v", F.try_parse_json(response)).withColumn("__have", dossier_digits(F.col(dossier)))
    d = d.withColumn("__root", F.try_variant_get("__v", "$", "map<string,variant>"))
    keys = F.map_keys("__root")
    lack, more = (F.concat_ws(",", F.filter(F.array(*[F.lit(k) for k in roots]), lambda k: ~F.array_contains(keys, k))), F.concat_ws(",", F.array_except(keys, F.array(*[F.lit(k) for k in roots]))))
    dash = lambda c: F.when(c == "", "-").otherwise(c)
    other = F.concat(F.lit("secoes_diferentes_do_schema(faltam:"), dash(lack), F.lit(";sobram:"), dash(more), F.lit(")"))
    same = F.array_sort(keys) == F.array(*[F.lit(k) for k in sorted(roots)])
    d = d.withColumn("__shape", first_match([(F.col("__v").isNull(), "json_invalido"), (~F.startswith(_kind(F.col("__v")), F.lit("OBJECT")), "json_nao_e_objeto"), (~F.coalesce(same, F.lit(False)), other)]))
    sections = {k: F.try_variant_get(F.element_at("__root", F.lit(k)), "$", "map<string,variant>") for k in SECTIONS}
    d = d.withColumns({f"__s_{k}": v for k, v in sections.items()})
    fits = {k: F.coalesce(F.array_sort(F.map_keys(f"__s_{k}")) == F.array(*[F.lit(x) for x in sorted(SECTIONS[k])]), F.lit(False)) for k in SECTIONS}
    cells, asked = {}, {}
    for k in SECTIONS:
        asked[k] = lambda part, k=k: F.when(fits[k], F.element_at(f"__s_{k}", F.lit(part)))
        v = asked[k]("texto")
        cells[f"__t_{k}"] = F.when(_kind(v) == "STRING", trim_all(F.try_variant_get(v, "$", "string")))
    draft = asked["proposta_abordagem"]("rascunho_pre_release")
    cells |= {"__draft_kind": _kind(draft), "__draft": F.when(_kind(draft) == "STRING", trim_all(F.try_variant_get(draft, "$", "string")))}
    for k in ("fato_confirmado", "contexto_documental"):
        cells[f"__c_{k}"] = F.when(F.startswith(_kind(asked[k]("citacoes")), F.lit("ARRAY")), F.try_variant_get(asked[k]("citacoes"), "$", "array<variant>"))
    for k in LISTS:
        v = F.element_at("__root", F.lit(k))
        cells[f"__l_{k}"] = F.when(F.startswith(_kind(v), F.lit("ARRAY")), F.try_variant_get(v, "$", "array<variant>"))
    # Each step reads columns of the table before it, so that nothing is parsed or matched twice.
    d = written(d.select(*df.columns, "__shape", "__have", *[F.when(F.col("__shape").isNull(), fits[k]).alias(f"__ok_{k}") for k in SECTIONS], *[F.when(F.col("__shape").isNull(), v).alias(n) for n, v in cells.items()]), "analyses")
    errors, notices = [listed([(~F.col(f"__ok_{k}"), f"{k}_estrutura_invalida") for k in SECTIONS])], []
    strange = lambda text: F.filter(_numbers(text), lambda n: ~F.exists("__have", lambda h: F.contains(h, _digits(n))))
    for k in ORDER:
        if k in LISTS:
            errors.append(_list_errors(k))
            continue
        text = F.col(f"__t_{k}")
        errors.append(listed([(text.isNull(), f"{k}_nao_e_texto"), (F.length(text) < LEAST_TEXT[k], f"{k}_vazio"), (F.length(text) > MAX_TEXT, f"{k}_longo_demais")]))
        if "citacoes" in SECTIONS[k]:
            cited = F.col(f"__c_{k}")
            wrong = F.filter(F.coalesce(cited, F.array().cast("array<variant>")), lambda v: ~_inside(v, F.col(evidence)))
            errors += [listed([(cited.isNull(), f"{k}_citacoes_nao_e_lista")]), _named(wrong, f"{k}_citacao_inexistente", lambda v: F.substring(_said(v), 1, 12))]
            uncited = cited.isNotNull() & ~F.exists(cited, lambda v: _inside(v, F.col(evidence)))
            (errors if k == "fato_confirmado" else notices).append(listed([(uncited if k == "fato_confirmado" else (uncited | cited.isNull()) & (F.length(text) > 0), f"{k}_sem_citacao")]))
    written_draft = F.col("__draft_kind") != "VOID"
    errors.append(listed([(written_draft & F.col("__draft").isNull(), "rascunho_pre_release_nao_e_texto"), (F.length("__draft") < 1, "rascunho_pre_release_vazio"), (F.length("__draft") > MAX_DRAFT, "rascunho_pre_release_longo_demais")]))
    for c, n in (("__t_fato_confirmado", "fato_confirmado"), ("__t_contexto_documental", "contexto_documental"), ("__draft", "rascunho_pre_release")):
        errors.append(_named(strange(F.col(c)), "numero_nao_encontrado_no_dossie", lambda t, n=n: F.concat(F.lit(f"{n}:"), F.substring(t, 1, 24))))
    for n in ("avaliacao_editorial", "hipotese_apuracao", "proposta_abordagem"):
        notices.append(_named(strange(F.col(f"__t_{n}")), "numero_fora_do_dossie", lambda t, n=n: F.concat(F.lit(f"{n}:"), F.substring(t, 1, 24))))
    texts = [F.coalesce(f"__t_{k}", F.lit("")).alias(k) for k in SECTIONS] + [F.coalesce("__draft", F.lit("")).alias("rascunho")]
    items = [F.transform(F.coalesce(f"__l_{k}", F.array().cast("array<variant>")), lambda v: F.when(_kind(v) == "STRING", trim_all(F.try_variant_get(v, "$", "string"))).otherwise("")).alias(k) for k in LISTS]
    d = d.withColumn("__all", F.to_json(F.struct(*texts, *items)))
    errors.append(listed([(F.col("__all").rlike(_scores()) | F.col("__all").rlike(_ranks()), "atribui_score_ou_prioridade"), (F.col("__all").rlike(_releases()), "libera_publicacao")]))
    bad = F.col("__shape").isNotNull()
    joined = lambda parts: reduce(lambda a, b: F.concat(a, b), [F.coalesce(p, _none()) for p in parts])
    d = d.withColumn("erros", F.when(bad, F.array("__shape")).otherwise(joined(errors))).withColumn("avisos", F.when(bad, _none()).otherwise(joined(notices)))
    return d.select(*df.columns, "erros", "avisos")


def _list_errors(k: str) -> Column:
    """Errors of a list and of its items, each with its place from 0."""
    items = F.col(f"__l_{k}")
    size = listed([(items.isNull(), f"{k}_nao_e_lista"), (F.size(items) < 1, f"{k}_sem_itens"), (F.size(items) > LISTS[k], f"{k}_itens_demais")])

    def of(v: Column, at: Column) -> Column:
        text = F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))
        state = F.when(F.coalesce(trim_all(text), F.lit("")) == "", "_invalido").when(F.length(text) > MAX_ITEM, "_longo_demais")
        return F.concat(F.lit(f"{k}["), at.cast("string"), F.lit("]"), state)

    each = F.array_compact(F.transform(F.coalesce(items, F.array().cast("array<variant>")), of))
    return F.concat(size, each)
