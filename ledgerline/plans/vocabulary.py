"""Fixed values of the domain: vocabularies, weights, limits and orders of the production preset.

They are data, kept together, in the order in which the rules read them. Every operator takes them as
arguments with these as defaults.
"""

LEVELS = ("ROTINA", "BAIXA", "MEDIA", "ALTA", "CRITICO")
NOT_ASSESSABLE = "NAO_AVALIAVEL"
POTENTIAL = {"CRITICO": "POTENCIAL_CRITICO_PENDENTE_EVIDENCIA", "ALTA": "POTENCIAL_ALTA_PENDENTE_EVIDENCIA"}
PRIORITY_OF_LEVEL = {"CRITICO": "A", "ALTA": "B", "MEDIA": "C", "BAIXA": "D", "ROTINA": "D"}
SELECTION_FLOOR = ("MEDIA", "ALTA", "CRITICO")
SELECTION_LIMIT = 20
NEW_STATUSES = ("em_apuracao", "pendente")
CLOSED_STATUSES = ("descartado", "publicado", "pronto_para_publicar")

# --- acts of a process -------------------------------------------------------------------------
ACT_AGE_LIMITS = {"CRITICO": 180, "ALTA": 365, "MEDIA": 1095}
READ_WINDOW_DAYS = 1095
AREA_MIN, AREA_LARGE = 500, 1000
COMPANIES = ("vale", "csn", "anglogold", "anglogold ashanti", "kinross", "anglo american", "usiminas", "samarco", "nexa", "itaminas")
MINERALS = ("ferro", "ouro", "litio", "manganes", "niobio", "grafite", "terras raras", "cobalto", "niquel", "fosfato", "titanio")
ROUTINE = (
    "tah", "taxa anual*", "documento diverso", "juntada", "exigencia*", "retificacao*", "baixa transcricao", "procuracao", "fob",
    "comprovante* pagamento", "republicacao", "oficio", "anotacao responsabilidade tecnica", "recolhimento art", "art recolhida",
)
PHASE_NEGATIVE = ("indeferid*", "cancelad*", "devolvid*", "negad*", "anulad*", "revogacao", "arquivad*")
PHASE_REQUEST = ("protoc", "requerimento", "solicitacao*", "pedido*")
PHASE_EFFECTIVE = ("publ", "aprov*", "autorizad*", "deferid*", "averbad*", "efetivad*", "concedid*", "instaurad*")
PHASE_EFFECTIVE_FREE_TEXT = ("instaura*", "autoriza*", "prorroga*", "aprova*", "efetiv*", "concede*", "defere*", "publica*")
OBJECTS = (
    ("prorrogacao_prazo_requerer_lavra", ("prorrogacao prazo req lavra", "prorrogacao prazo requerer lavra", "prorrogacao prazo requerer concessao lavra", "prazo para requerer a concessao lavra")),
    ("perda_titulo", ("decaimento*", "caducidade", "interdicao", "cassacao")),
    ("gravame", ("penhor*", "penhora*", "indisponibilidade", "oneracao", "arresto", "hipoteca")),
    ("cessao", ("cessao", "transf direitos", "transferencia", "arrendamento*")),
    ("renuncia", ("renuncia",)),
    ("autorizacao_extracao", ("guia utilizacao", "portaria lavra", "portaria concessao lavra")),
    ("relatorio_aprovado", ("relatorio aprov*", "reavaliacao aprov*", "aprovacao relatorio*")),
    ("alvara_outorga", ("alvara pesquisa",)),
    ("servidao", ("servidao",)),
    ("edital_disponibilidade", ("edital",)),
)
MINING_MARKERS = ("concessao", "conc lav", "portaria lavra")
EXTENSION_RECENT_DAYS = 365

# --- signals and score of acts -----------------------------------------------------------------
ACT_WEIGHTS = {
    "mudanca_material_direito": 4, "autorizacao_extracao": 3, "avanco_pesquisa": 3, "alvara_comum_pesquisa": 2, "dimensao_objetiva": 2,
    "empresa_relevante": 2, "mineral_estrategico": 2, "reserva_ou_substancia": 1, "varios_municipios": 1,
}
ACT_REDUCERS = {"rotina": -5, "exigencia_generica": -3, "retificacao_formal": -2}
ACT_TERMS = {
    "mudanca_material_direito": ("decaimento", "caducidade", "cessao", "transferencia", "penhora", "indisponibilidade", "interdicao", "renuncia", "concessao"),
    "perda_de_lavra": ("decaimento", "caducidade", "interdicao de concessao de lavra"),
    "autorizacao_extracao": ("guia de utilizacao", "portaria de lavra"),
    "avanco_pesquisa": ("relatorio aprovado", "reavaliacao aprovada"),
    "alvara_comum_pesquisa": ("alvara de pesquisa", "alvara comum de pesquisa"),
    "reserva_ou_substancia": ("nova substancia", "reavaliacao de reserva"),
    "rotina": ("protocolo", "juntada", "pagamento de tah", "ral", "documento diverso"),
    "exigencia_generica": ("exigencia",),
    "retificacao_formal": ("retificacao",),
}
SUFFIX_NEGATIVE = ("indeferida", "cancelada", "devolvida", "negada", "anulada", "revogacao")
SUFFIX_PENDING = ("protoc", "requerimento", "aplicada")
SUFFIX_DONE = ("publ", "autorizada", "autorizado", "deferida", "aprovado", "aprovada", "averbado", "averbada")

# --- notices -----------------------------------------------------------------------------------
NOTICE_AGE_LIMITS = {"CRITICO": 15, "ALTA": 30, "MEDIA": 90}
LINK_BANDS_VALID = ("provavel", "confirmado")
LINK_WEIGHTS = {"modalidade_mineracao": 4, "mina_identificada": 4, "material_mineral": 5, "insumo_estrutura_vinculada": 2}
LINK_REDUCERS = {"produto_causa_nao_mineraria": -4, "acidente_rodoviario_comum": -3}
SEVERITY_WEIGHTS = {
    "atingiu_ou_pode_atingir_curso_dagua": 3, "ultrapassou_limites_operacao": 2, "rejeito_ou_produto_perigoso_ou_volume_significativo": 2,
    "risco_estrutural_ou_interrupcao_abastecimento": 2, "comunicacao_mais_de_6_horas": 1, "vitimas_evacuacao_bloqueio_ou_risco_comunidade": 1,
}
NOTICE_TERMS = {
    "modalidade_mineracao": ("mineração", "minerário", "minerária", "lavra", "atividade minerária"),
    "material_mineral": ("minério", "minerio", "rejeito", "polpa mineral", "polpa de minério", "estéril", "esteril", "sedimento", "turbidez"),
    "insumo_estrutura_vinculada": ("nitrato de amônia", "nitrato de amonia", "polímero", "polimero", "sump", "cava", "pilha de estéril", "usina", "barragem", "sirene"),
    "acidente_rodoviario": ("tombamento", "acidente rodoviário", "acidente rodoviario", "transporte rodoviário", "transporte rodoviario"),
    "produto_nao_minerario": (
        "pigmento", "concentrado alcatone", "lifewood", "carvão vegetal", "carvao vegetal", "óleo lubrificante", "oleo lubrificante", "emulsão asfáltica",
        "emulsao asfaltica", "cimento asfáltico", "cimento asfaltico", "leite cru", "tinta", "usina de asfalto",
    ),
    "municipio_minerador": (
        "conceição do pará", "conceicao do para", "conceição do mato dentro", "conceicao do mato dentro", "nova lima", "congonhas", "sabará", "sabara", "mariana",
        "barão de cocais", "barao de cocais", "itabira", "itatiaiuçu", "itatiaiucu",
    ),
    "curso_dagua": ("córrego", "corrego", "ribeirão", "ribeirao", "rio ", "curso d'água", "curso dagua", "captação", "captacao", "abastecimento"),
    "risco_estrutural": ("barragem", "sirene", "rompimento", "risco de rompimento", "interrupção de abastecimento", "interrupcao de abastecimento"),
    "vitimas_evacuacao": ("vítima", "vitima", "evacuação", "evacuacao", "bloqueio", "risco à comunidade", "risco a comunidade"),
    "rejeito_ou_perigoso": ("rejeito", "produto perigoso", "volume significativo"),
    "fora_dos_limites": ("fora da contenção", "área externa", "area externa"),
}

# --- permits -----------------------------------------------------------------------------------
PERMIT_MAXIMA = {
    "consequencia_operacional_regulatoria": 20, "dimensao_hidrica_fisica": 20, "risco_conflito_interesse_publico": 15, "materialidade_evento": 15,
    "novidade_sinal_temporal": 10, "cruzamentos_historico": 10, "relevancia_empresa_projeto": 5, "potencial_exclusividade": 5,
}
PERMIT_VERBS = (
    (r"fica mantid[oa] o indeferimento|mantem.{0,20}indeferimento", "manutencao_indeferimento"),
    (r"fica mantid[oa] o arquivamento|mantem.{0,20}arquivamento", "manutencao_arquivamento"),
    (r"anula.{0,30}arquivamento", "anulacao_arquivamento"),
    (r"onde se le|leia-se", "retificacao"),
    (r"\bautoriza\b|\bdefere\b", "concessao_outorga"),
    (r"renuncia.{0,20}cancelamento|cancelamento.{0,20}renuncia", "cancelamento_por_renuncia"),
    (r"\bcancela(do)?\b.{0,20}arquivamento", "cancelamento_de_arquivamento"),
    (r"\bsuspende\b|\bsuspensao\b", "suspensao"),
    (r"\brevoga\b|\brevogacao\b", "revogacao"),
    (r"\banula\b|\banulacao\b", "anulacao"),
    (r"\bcassa\b|\bcassacao\b", "cassacao"),
    (r"\bindefer", "indeferimento_original"),
    (r"\barquiv", "arquivamento_original"),
    (r"\banulad[oa]\b", "anulacao"),
    (r"\brevogad[oa]\b", "revogacao"),
    (r"\bcassad[oa]\b", "cassacao"),
    (r"\bautorizar\b|\bdeferid[oa]\b", "concessao_outorga"),
)
PERMIT_MINERAL = (
    "minerio", "mineracao", "mina", "lavra", "beneficiamento", "barragem de rejeito", "rejeito", "minerario", "anm", "pesquisa mineral", "extracao mineral",
    "minerodutos", "pelotizacao", "usina de pelotizacao",
)
PERMIT_OTHER_USE = (
    "irrigacao", "consumo humano", "consumo animal", "dessedentacao", "agroindustria", "agricola", "agropecuaria", "lazer", "turismo", "saneamento", "esgoto",
    "abastecimento publico", "piscicultura", "lavagem de veiculos", "limpeza",
)

# --- discovery gates ---------------------------------------------------------------------------
SECTOR_TERMS = (
    "mineração", "atividade minerária", "empreendimento minerário", "extração mineral", "pesquisa mineral", "prospecção mineral", "beneficiamento mineral",
    "tratamento de minério", "cava da mina", "barragem de rejeitos", "pilha de estéril", "bacia de sedimentação", "drenagem ácida de mina", "lavra a céu aberto",
    "lavra subterrânea", "duto de polpa", "espodumênio", "minério de ferro", "bauxita", "manganês", "ouro", "lítio", "terras raras",
)
INDUSTRY_CODES = ("07103", "07294", "081")
GATES = {
    "P1_DANO_OU_RISCO_AMBIENTAL": ("contaminação", "poluição", "assoreamento", "turbidez", "vazamento", "rejeitos", "erosão", "drenagem ácida", "aquífero", "lençol freático", "metais pesados", "arsênio", "chumbo", "cádmio", "cianeto", "mercúrio", "supressão vegetal", "desmatamento", "fauna", "flora", "cavidade", "poeira", "emissão atmosférica", "material particulado", "ruído", "vibração"),
    "P2_VIDA_SAUDE_SEGURANCA_OU_COMUNIDADE": ("comunidade", "morador", "trabalhador", "terceirizado", "vítima", "ferido", "hospitalização", "morte", "óbito", "evacuação", "reassentamento", "saúde pública", "escola", "abastecimento", "poço artesiano", "cisterna", "captação comunitária", "pescadores", "agricultores", "potabilidade", "dessedentação de animais"),
    "P3_SEGURANCA_DE_ESTRUTURA": ("barragem", "pilha", "dique", "cava", "anomalia", "trinca", "instabilidade", "risco de ruptura", "nível de emergência", "sirene", "extravasamento", "rompimento", "desabamento", "colapso"),
    "P4_DECISAO_REGULATORIA_MATERIAL": ("decisão", "julgamento", "licença", "licenciamento", "outorga", "portaria", "parecer", "ata", "recurso", "condicionante", "tac", "termo de compromisso", "autorização", "concessão", "indeferimento", "deferimento"),
    "P5_SANCAO_EMBARGO_INTERDICAO_OU_PERDA_DE_DIREITO": ("auto de infração", "multa", "embargo", "interdição", "suspensão", "cassação", "revogação", "anulação", "sanção", "apreensão", "perdimento", "perda de direito"),
    "P6_MUDANCA_OPERACIONAL_MATERIAL": ("paralisação", "retomada", "fechamento", "desmobilização", "redução de produção", "aumento de produção", "mudança operacional", "interrupção da operação"),
    "P7_INVESTIMENTO_EXPANSAO_OU_INFRAESTRUTURA": ("investimento", "expansão", "ampliação", "implantação", "capacidade", "produção", "mineroduto", "ferrovia", "terminal", "linha de transmissão", "infraestrutura", "financiamento", "aquisição", "venda", "fusão", "incorporação"),
    "P9_CRUZAMENTO_REINCIDENCIA_OU_PADRAO": ("reincidência", "reincidente", "reiterado", "repetição de ocorrências", "casos relacionados", "padrão recorrente"),
    "P10_INTERESSE_PUBLICO_TERRITORIAL_OU_POLITICO": ("conflito territorial", "terra indígena", "território quilombola", "unidade de conservação", "desapropriação", "servidão", "patrimônio cultural", "patrimônio histórico", "audiência pública", "interesse público", "acesso interrompido", "estrada bloqueada"),
}
GATE_EXEMPT_FROM_NEGATION = "P4_DECISAO_REGULATORIA_MATERIAL"
STRUCTURED_GATES = {
    "P8_ENTIDADE_PROJETO_OU_ATIVO_ESTRATEGICO": ("empresa_watchlist", "ativo_watchlist", "projeto_estrategico"),
    "P9_CRUZAMENTO_REINCIDENCIA_OU_PADRAO": ("reincidencia_confirmada", "casos_relacionados"),
    "P11_ANTECEDENCIA_OU_EXCLUSIVIDADE": ("antecedencia_relevante", "exclusividade_jornalistica"),
    "P12_ATUALIZACAO_MATERIAL_DE_CASO": ("atualizacao_material",),
}
NEGATIVE_MARKS = ("não houve", "não ocorreu", "não foi constatado", "não foi constatada", "não foi identificada", "sem registro de", "ausência de", "não se verificou", "inexistência de")
ALLEGED_MARKS = ("alega que", "denuncia que", "segundo moradores", "investiga possível", "suspeita de")
RISK_MARKS = ("risco de", "possibilidade de", "potencial de", "pode ocorrer", "ameaça de")
REQUEST_MARKS = ("pedido de", "requerimento de", "solicitação de", "solicitou", "protocolou pedido")
DENIED_MARKS = ("indeferiu", "negou o pedido", "não concedeu", "cancelou", "revogou", "anulou")
DONE_MARKS = ("deferiu", "concedeu", "autorizou", "aprovou", "publicou", "embargou", "interditou", "cassou")
TEXT_STATUS = (
    ("NEGATIVA_EXPLICITA", NEGATIVE_MARKS), ("ALEGACAO_OU_INVESTIGACAO", ALLEGED_MARKS), ("RISCO_OU_POSSIBILIDADE", RISK_MARKS),
    ("DECISAO_NEGATIVA", DENIED_MARKS), ("PEDIDO_AINDA_NAO_DECIDIDO", REQUEST_MARKS), ("ATO_OU_DECISAO_EFETIVADA", DONE_MARKS),
)

# --- queue -------------------------------------------------------------------------------------
QUEUE = {"score_corte": 40, "score_b": 60, "score_a": 80, "janela_atualidade_dias": 90, "evidencia_minima": 2}
STRONG_LEVELS = ("CRITICO", "ALTA", "POTENCIAL_CRITICO_PENDENTE_EVIDENCIA", "POTENCIAL_ALTA_PENDENTE_EVIDENCIA")
LOCKED_STATUSES = ("pronto_para_publicar", "publicado", "arquivado", "descartado")
PRIORITY_RANK = {"A": 4, "B": 3, "C": 2, "PENDENTE": 1, "D": 0}
LEVEL_RANK = {"CRITICO": 5, "ALTA": 4, "POTENCIAL_CRITICO_PENDENTE_EVIDENCIA": 4, "POTENCIAL_ALTA_PENDENTE_EVIDENCIA": 3, "MEDIA": 3, "BAIXA": 2, "ROTINA": 1}

# --- calls -------------------------------------------------------------------------------------
DISMISSALS = (
    "registro_identico", "hash_igual_ultimo_sucesso", "republicacao_literal", "fora_de_escopo", "descartado_por_regra_deterministica",
    "continuidade_sem_mudanca_material", "enriquecimento_ja_concluido", "bloqueado_por_falta_de_documento", "tarefa_sem_linguagem_natural",
)

# --- workflow ----------------------------------------------------------------------------------
#: action, from, to
TRANSITIONS = (
    ("COLETOR_SELECIONAR", "SEM_FLUXO", "REVISAO_SELECAO"),
    ("INCLUIR_MANUAL", "SEM_FLUXO", "REVISAO_SELECAO"),
    ("COLETOR_ATUALIZAR", "SEM_FLUXO", "ATUALIZADO"),
    ("COLETOR_ATUALIZAR", "MONITORADO", "ATUALIZADO"),
    ("COLETOR_ATUALIZAR", "IA_LIBERADA", "ATUALIZADO"),
    ("COLETOR_ATUALIZAR", "IA_EXECUTADA", "ATUALIZADO"),
    ("COLETOR_ATUALIZAR", "REVISAO_ANALISE_IA", "ATUALIZADO"),
    ("COLETOR_ATUALIZAR", "PRE_RELEASE_LIBERADO", "ATUALIZADO"),
    ("COLETOR_ATUALIZAR", "PRE_RELEASE_GERADO", "ATUALIZADO"),
    ("COLETOR_ATUALIZAR", "REVISAO_FINAL", "ATUALIZADO"),
    ("COLETOR_ATUALIZAR", "DEVOLVIDO_PARA_AJUSTE", "ATUALIZADO"),
    ("COLETOR_ATUALIZAR", "APROVADO_PARA_PUBLICACAO", "ATUALIZADO"),
    ("COLETOR_ATUALIZAR", "PUBLICADO", "ATUALIZADO"),
    ("APROVAR_PARA_IA", "REVISAO_SELECAO", "PRONTO_PARA_IA"),
    ("MONITORAR_SELECAO", "REVISAO_SELECAO", "MONITORADO"),
    ("DESCARTAR", "REVISAO_SELECAO", "DESCARTADO"),
    ("LIBERAR_IA", "PRONTO_PARA_IA", "IA_LIBERADA"),
    ("RETIRAR_LIBERACAO_IA", "IA_LIBERADA", "PRONTO_PARA_IA"),
    ("EXECUTAR_IA", "IA_LIBERADA", "IA_EXECUTADA"),
    ("ABRIR_REVISAO_ANALISE", "IA_EXECUTADA", "REVISAO_ANALISE_IA"),
    ("APURACAO_REGISTRADA", "REVISAO_ANALISE_IA", "REVISAO_ANALISE_IA"),
    ("LIBERAR_PRE_RELEASE", "REVISAO_ANALISE_IA", "PRE_RELEASE_LIBERADO"),
    ("DEVOLVER_ANALISE", "REVISAO_ANALISE_IA", "DEVOLVIDO_PARA_AJUSTE"),
    ("DESCARTAR_OU_MONITORAR", "REVISAO_ANALISE_IA", "DESCARTADO"),
    ("DESCARTAR_OU_MONITORAR", "REVISAO_ANALISE_IA", "MONITORADO"),
    ("RETIRAR_LIBERACAO_PRE_RELEASE", "PRE_RELEASE_LIBERADO", "REVISAO_ANALISE_IA"),
    ("GERAR_PRE_RELEASE", "PRE_RELEASE_LIBERADO", "PRE_RELEASE_GERADO"),
    ("ABRIR_REVISAO_FINAL", "PRE_RELEASE_GERADO", "REVISAO_FINAL"),
    ("DEVOLVER_REPROVADA", "PRE_RELEASE_GERADO", "DEVOLVIDO_PARA_AJUSTE"),
    ("APROVAR", "REVISAO_FINAL", "APROVADO_PARA_PUBLICACAO"),
    ("DEVOLVER_FINAL", "REVISAO_FINAL", "DEVOLVIDO_PARA_AJUSTE"),
    ("PUBLICAR", "APROVADO_PARA_PUBLICACAO", "PUBLICADO"),
    ("REVOGAR_APROVACAO", "APROVADO_PARA_PUBLICACAO", "DEVOLVIDO_PARA_AJUSTE"),
    ("REABRIR", "DEVOLVIDO_PARA_AJUSTE", "REVISAO_ANALISE_IA"),
    ("REABRIR_NOVA_ANALISE", "DEVOLVIDO_PARA_AJUSTE", "PRONTO_PARA_IA"),
    ("ABRIR_REVISAO_MUDANCA", "ATUALIZADO", "REVISAO_MUDANCA"),
    ("APROVAR_NOVA_ANALISE", "REVISAO_MUDANCA", "PRONTO_PARA_IA"),
    ("MANTER_MONITORADO", "REVISAO_MUDANCA", "MONITORADO"),
    ("DESCARTAR", "REVISAO_MUDANCA", "DESCARTADO"),
    ("REABRIR_DESCARTADO", "DESCARTADO", "REVISAO_SELECAO"),
)
REASON_REQUIRED = ("DESCARTAR", "DEVOLVER_ANALISE", "DESCARTAR_OU_MONITORAR", "DEVOLVER_REPROVADA", "DEVOLVER_FINAL", "REVOGAR_APROVACAO", "MANTER_MONITORADO", "REABRIR_DESCARTADO", "INCLUIR_MANUAL")
MATRIX_STATES = ("confirmado", "nao_confirmado", "nao_localizado", "nao_aplicavel", "requer_apuracao_humana", "aguardando_contraditorio", "fonte_indisponivel", "divergencia_entre_fontes")
IMPACT_CLASSES = ("FATO_PRINCIPAL", "ATRIBUICAO", "GRAVIDADE", "PERIFERICA")

#: Fields that say that a fact is new, and fields that link an event to the sector officially.
NOVELTY = ("novo_ou_alterado", "evento_novo", "fato_novo")
OFFICIAL_LINKS = ("processo_anm", "identificador_sigbm", "cnpj_watchlist_confirmado", "empresa_watchlist_confirmada", "ativo_watchlist_confirmado", "atividade_licenciada_mineraria", "vinculo_oficial_confirmado", "empresa_watchlist", "ativo_watchlist", "projeto_estrategico")

# --- timelines ---------------------------------------------------------------------------------
#: Terms of an act's type, in order, with the milestone that the first of them found stands for.
ACT_MILESTONES = (
    ("decaimento", "decisao"), ("caducidade", "decisao"), ("indisponibilidade", "decisao"), ("interdicao", "decisao"), ("renuncia", "decisao"), ("cessao", "decisao"), ("transferencia", "decisao"),
    ("concessao", "decisao"), ("portaria lavra", "publicacao"), ("guia utilizacao", "publicacao"), ("alvara pesquisa", "publicacao"), ("relatorio aprovado", "publicacao"),
    ("reavaliacao aprovada", "publicacao"), ("intimacao", "ciencia"), ("exigencia", "ciencia"), ("protocolo", "requerimento"), ("juntada", "requerimento"), ("pagamento tah", "requerimento"),
    ("retificacao", "requerimento"), ("ral", "requerimento"),
)
