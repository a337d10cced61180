"""Stored analyses of every wrong shape, and notices with blanks of every kind."""

import json

import pytest

from ledgerline.plans import analysis, notices

GOOD = {
    "fato_confirmado": {"texto": "A lavra foi suspensa em 05/03/2026 pelo órgão", "citacoes": [1, 2, 1]}, "contexto_documental": {"texto": "Auto 4.512/2026", "citacoes": [2]}, "avaliacao_editorial": {"texto": "relevante ao setor"},
    "hipotese_apuracao": {"texto": "verificar a origem"}, "lacunas": ["data do auto"], "perguntas_redacao": ["quem assinou?"], "proposta_abordagem": {"texto": "ouvir os dois lados", "rascunho_pre_release": None},
}
DOSSIER = "Auto 4512/2026, de 2026-03-05"


def changed(path, value):
    out = json.loads(json.dumps(GOOD))
    at = out
    for p in path[:-1]:
        at = at[p]
    at[path[-1]] = value
    return json.dumps(out, ensure_ascii=False)


def without(key):
    return json.dumps({k: v for k, v in GOOD.items() if k != key})


CASES = [
    (json.dumps(GOOD), [], []), ("{", ["json_invalido"], []), (None, ["json_invalido"], []), ("[1]", ["json_nao_e_objeto"], []), ("5", ["json_nao_e_objeto"], []), (without("lacunas"), ["secoes_diferentes_do_schema(faltam:lacunas;sobram:-)"], []),
    (changed(["proposta_abordagem", "rascunho_pre_release"], ""), ["rascunho_pre_release_vazio"], []), (changed(["proposta_abordagem", "rascunho_pre_release"], 5), ["rascunho_pre_release_nao_e_texto"], []),
    (changed(["proposta_abordagem", "rascunho_pre_release"], "Em 777 casos"), ["numero_nao_encontrado_no_dossie(rascunho_pre_release:777)"], []), (changed(["lacunas"], ["a", 5, " ", "b" * 501]), ["lacunas[1]_invalido", "lacunas[2]_invalido", "lacunas[3]_longo_demais"], []),
    (changed(["lacunas"], []), ["lacunas_sem_itens"], []), (changed(["lacunas"], "x"), ["lacunas_nao_e_lista"], []), (changed(["fato_confirmado", "citacoes"], ["1", 3, 1.5, None]), [f"fato_confirmado_citacao_inexistente({x})" for x in ("1", "3", "1.5", "null")] + ["fato_confirmado_sem_citacao"], []),
    (changed(["fato_confirmado", "citacoes"], [2.0]), [], []), (changed(["fato_confirmado"], {"texto": "x"}), ["fato_confirmado_estrutura_invalida", "fato_confirmado_nao_e_texto", "fato_confirmado_citacoes_nao_e_lista"], []),
    (changed(["contexto_documental", "citacoes"], []), [], ["contexto_documental_sem_citacao"]), (changed(["contexto_documental", "texto"], "  \n"), ["contexto_documental_vazio"], []), (changed(["fato_confirmado", "texto"], "Suspensa em 2026-03-06, auto 4512"), ["numero_nao_encontrado_no_dossie(fato_confirmado:2026-03-06)"], []),
    (changed(["avaliacao_editorial", "texto"], "prazo de 4567 dias"), [], ["numero_fora_do_dossie(avaliacao_editorial:4567)"]), (changed(["lacunas"], ["a Pontuacao final: 9"]), ["atribui_score_ou_prioridade"], []), (changed(["lacunas"], ["prioridade B"]), ["atribui_score_ou_prioridade"], []),
    (changed(["lacunas"], ["prioridade baixa, e nota fiscal"]), [], []), (changed(["perguntas_redacao"], ["liberado para a publicação"]), ["libera_publicacao"], []), (changed(["perguntas_redacao"], ["denota 5 casos"]), [], []),
]


def test_every_wrong_part_is_named_once(spark):
    df = spark.createDataFrame([(i, text, DOSSIER, 2) for i, (text, _, _) in enumerate(CASES)], "i int, resposta string, dossie string, n int")
    got = {r.i: (list(r.erros), list(r.avisos)) for r in analysis.audited_analyses(df, "resposta", "dossie", "n").collect()}
    for i, (text, errors, notes) in enumerate(CASES):
        assert got[i] == (errors, notes), text
    assert analysis.audited_analyses(df.limit(0), "resposta", "dossie", "n").count() == 0


NOTICE = "Nº Protocolo: 123/2026\nMODALIDADE DO ACIDENTE: Rodoviário\nLOCAL: Rodovia BR 135, Km 625\nMUNICÍPIO: Joaquim Felício\nDATA/HORA DA OCORRÊNCIA: 01/02/2026 06:54\nDATA/HORA DO COMUNICADO AO NEA: 01/02/2026 16:16\nFONTE(S) DE INFORMAÇÕES: PRF\nBREVE DESCRIÇÃO DA OCORRÊNCIA: tombou\nPRODUTO: --\nNÚMERO ONU: 1202\nCLASSE DE RISCO: 3\nNúcleo de Prevenção e Emergência Ambiental"


@pytest.mark.parametrize("blank", [" ", " ", " ", "　", "   "])
def test_blanks_of_every_kind_count_as_blanks(spark, blank):
    got = notices.notice_details(spark.createDataFrame([(1, NOTICE.replace(" ", blank))], "id int, text string"), "id", "text").first()
    assert (got.protocolo, got.modalidade, got.local, got.municipio, got.produto, got.rodovia, got.km, got.onu, got.classe, got.atraso_minutos) == ("123/2026", "Rodoviário", "Rodovia BR 135, Km 625", "Joaquim Felício", None, "BR-135", "625", "1202", "3", 562)


def test_labels_as_scans_have_them_and_words_of_the_narrative(spark):
    texts = ["N Protoc0lo 77\nFONTE S DE INFORMACOES; x\nPRODUTO: y", "nº protocolo: 5\nlocal: aqui\nLOCAL : ali", "DATA / HORA DO COMUNICADO: 01/02/2026", "", None]
    d = {r.i: r for r in notices.labelled_fields(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "t").collect()}
    assert (d[0].protocolo, d[0].fontes, d[0].produto) == ("77", "x", "y") and (d[1].protocolo, d[1].local) == ("5\nlocal: aqui".replace("\n", " "), "ali")
    assert d[2].comunicado == "01/02/2026" and d[3].protocolo is None and d[4].local is None
