"""Household health survey, violence module, editions 2013 and 2019.

Fixed values: character positions, column names and labels of the published
layouts. Codes of yes/no questions are shared by all columns listed as such.
"""

STATE = {
    "11": "Rondônia", "12": "Acre", "13": "Amazonas", "14": "Roraima", "15": "Pará",
    "16": "Amapá", "17": "Tocantins", "21": "Maranhão", "22": "Piauí", "23": "Ceará",
    "24": "Rio Grande do Norte", "25": "Paraíba", "26": "Pernambuco", "27": "Alagoas",
    "28": "Sergipe", "29": "Bahia", "31": "Minas Gerais", "32": "Espírito Santo",
    "33": "Rio de Janeiro", "35": "São Paulo", "41": "Paraná", "42": "Santa Catarina",
    "43": "Rio Grande do Sul", "50": "Mato Grosso do Sul", "51": "Mato Grosso", "52": "Goiás",
    "53": "Distrito Federal",
}
CENSUS_AREA = {"1": "Urbano", "2": "Rural"}
RACE = {"1": "Branca", "2": "Preta", "3": "Amarela", "4": "Parda", "5": "Indígena",
        "9": "Ignorado"}
YES_NO = {"1": "Sim", "2": "Não"}

CARE_PLACE = {
    "02": "Unidade básica de saúde (posto ou centro de saúde ou unidade de saúde da família)",
    "03": "Centro de Especialidades, Policlínica pública ou PAM Posto de Assistência Médica",
    "04": "UPA (Unidade de Pronto Atendimento)",
    "05": "Outro tipo de Pronto Atendimento Público (24 horas)",
    "06": "Pronto-socorro ou emergência de hospital público",
    "07": "Hospital público/ambulatório",
    "08": "Consultório particular ou Clínica privada",
    "09": "Ambulatório ou consultório de empresa ou sindicato",
    "10": "Pronto-atendimento ou emergência de hospital privado",
    "11": "No domicílio, com médico particular",
    "12": "No domicílio, com médico da equipe de saúde da família",
    "13": "Outro",
}

COMMON = ["uf", "estrato", "upa", "domicilio", "situacao_censitaria", "sexo", "idade",
          "raca_cor", "peso_amostral"]

# ---- 2013 -------------------------------------------------------------------

SPANS_2013 = {
    "uf": (0, 2), "estrato": (2, 9), "upa": (9, 16), "domicilio": (16, 20),
    "situacao_censitaria": (37, 38), "sexo": (105, 106), "idade": (114, 117),
    "raca_cor": (117, 118),
    "d_sofreu_violencia": (606, 607), "d_tipo_violencia": (607, 608),
    "d_meio_agressao": (608, 609), "d_local_ocorrencia": (609, 610), "d_agressor": (610, 611),
    "d_deixou_atividades": (611, 612), "d_teve_lesao": (612, 613), "d_buscou_saude": (613, 614),
    "d_local_atendimento": (614, 616), "d_internacao_24h": (616, 617),
    "d_teve_sequela": (617, 618),
    "sofreu_violencia": (618, 619), "frequencia_violencia": (619, 620),
    "tipo_violencia": (620, 621), "meio_agressao": (621, 622), "local_ocorrencia": (622, 623),
    "agressor": (623, 625), "deixou_atividades": (625, 626), "teve_lesao": (626, 627),
    "buscou_saude": (627, 628), "local_atendimento": (628, 630), "internacao_24h": (630, 631),
    "teve_sequela": (631, 632),
    "peso_amostral": (1404, 1418),
}
BOOKS_2013 = {
    "uf": STATE,
    "situacao_censitaria": CENSUS_AREA,
    "sexo": {"1": "Masculino", "2": "Feminino"},
    "raca_cor": RACE,
    "d_tipo_violencia": {"1": "Física", "2": "Sexual", "3": "Psicológica", "4": "Outro"},
    "d_meio_agressao": {
        "1": "Com arma de fogo (revólver, escopeta, pistola)",
        "2": "Com objeto pérfuro-cortante (faca, navalha, punhal, tesoura)",
        "3": "Com objeto contundente (pau, cassetete, barra de ferro, pedra)",
        "4": "Com força corporal, espancamento (tapa, murro, empurrão)",
        "5": "Por meio de palavras ofensivas, xingamentos ou palavrões",
        "6": "Outro",
    },
    "d_local_ocorrencia": {
        "1": "Residência", "2": "Trabalho", "3": "Escola/Faculdade ou similar",
        "4": "Bar ou similar", "5": "Via pública", "6": "Banco/Caixa eletrônico/Lotérica",
        "7": "Outro",
    },
    "d_agressor": {
        "1": "Bandido, ladrão ou assaltante",
        "2": "Agente legal público (policial/agente da lei)",
        "3": "Outro",
    },
    "d_local_atendimento": {"01": "No local da violência"} | CARE_PLACE,
    "frequencia_violencia": {
        "1": "Uma vez", "2": "Duas vezes", "3": "De três a seis vezes",
        "4": "De sete a menos de 12 vezes", "5": "Pelo menos uma vez por mês",
        "6": "Pelo menos uma vez por semana", "7": "Quase diariamente",
    },
    "tipo_violencia": {"1": "Física", "2": "Sexual", "3": "Psicológica", "4": "Outra"},
    "meio_agressao": {
        "1": "Com força corporal/espancamento (tapa, murro, beliscão, empurrão)",
        "2": "Com arma de fogo (revólver, escopeta, pistola)",
        "3": "Com objeto pérfuro-cortante (faca, navalha, punhal, tesoura)",
        "4": "Com objeto contundente (pau, cassetete, barra de ferro, pedra)",
        "5": "Com arremesso de substância/objeto quente",
        "6": "Com lançamento de objetos",
        "7": "Com envenenamento",
        "8": "Por meio de palavras ofensivas, xingamentos ou palavrões",
        "9": "Outro",
    },
    "local_ocorrencia": {
        "1": "Residência", "2": "Trabalho", "3": "Escola / Faculdade ou similar",
        "4": "Bar ou similar", "5": "Via pública", "6": "Outro",
    },
    "agressor": {
        "01": "Cônjuge, companheiro(a), namorado(a)",
        "02": "Ex-cônjuge, ex-companheiro(a), ex-namorado(a)",
        "03": "Pai/Mãe", "04": "Padrasto/Madrasta", "05": "Filho(a)", "06": "Irmão(ã)",
        "07": "Outro parente", "08": "Amigos(as)/colegas", "09": "Patrão/chefe",
        "10": "Outra pessoa conhecida",
    },
    "local_atendimento": {"01": "No local da agressão"} | CARE_PLACE,
} | dict.fromkeys([
    "d_sofreu_violencia", "d_deixou_atividades", "d_teve_lesao", "d_buscou_saude",
    "d_internacao_24h", "d_teve_sequela", "sofreu_violencia", "deixou_atividades", "teve_lesao",
    "buscou_saude", "internacao_24h", "teve_sequela",
], YES_NO)
WOMAN_2013 = "Feminino"
PARTNER_2013 = ["Cônjuge, companheiro(a), namorado(a)",
                "Ex-cônjuge, ex-companheiro(a), ex-namorado(a)"]
KNOWN_2013 = ["sofreu_violencia", "frequencia_violencia", "tipo_violencia", "meio_agressao",
              "local_ocorrencia", "agressor", "deixou_atividades", "teve_lesao", "buscou_saude",
              "local_atendimento", "internacao_24h", "teve_sequela"]
UNKNOWN_2013 = ["d_sofreu_violencia", "d_tipo_violencia", "d_meio_agressao", "d_local_ocorrencia",
                "d_agressor", "d_deixou_atividades", "d_teve_lesao", "d_buscou_saude",
                "d_local_atendimento", "d_internacao_24h", "d_teve_sequela"]

# ---- 2019 -------------------------------------------------------------------

SPANS_2019 = {
    "uf": (0, 2), "estrato": (2, 9), "upa": (9, 18), "domicilio": (18, 22),
    "situacao_censitaria": (30, 31), "sexo": (107, 108), "idade": (116, 119),
    "raca_cor": (119, 120), "privacidade_assegurada": (1245, 1246),
    "psi_humilhacao_publica": (1247, 1248), "psi_gritos": (1248, 1249),
    "psi_ameaca_digital": (1249, 1250), "psi_ameaca_terceiro": (1250, 1251),
    "psi_destruiu_bem": (1251, 1252), "psi_frequencia": (1252, 1253),
    "psi_agressor": (1253, 1255), "psi_local": (1255, 1256),
    "fis_tapa": (1256, 1257), "fis_empurrao": (1257, 1258), "fis_soco_chute": (1258, 1259),
    "fis_estrangulamento": (1259, 1260), "fis_arma": (1260, 1261), "fis_frequencia": (1261, 1262),
    "fis_agressor": (1262, 1264), "fis_local": (1264, 1265),
    "sex_toque_forcado_12m": (1265, 1266), "sex_relacao_forcada_12m": (1266, 1267),
    "sex_toque_forcado_vida": (1267, 1268), "sex_relacao_forcada_vida": (1268, 1269),
    "sex_frequencia": (1269, 1270), "sex_agressor": (1270, 1272), "sex_local": (1272, 1273),
    "deixou_atividades": (1273, 1274),
    "peso_amostral": (1425, 1439),
}
FREQUENCY_2019 = {"1": "Muitas vezes", "2": "Algumas vezes", "3": "Uma vez"}
PLACE_2019 = {
    "1": "Residência", "2": "Trabalho",
    "3": "Escola, faculdade ou outro estabelecimento de ensino",
    "4": "Bar, restaurante ou similar", "5": "Via pública ou outro local público", "6": "Outro",
}
AGGRESSOR_2019 = {
    "01": "Cônjuge ou companheiro (a)",
    "02": "Ex-Cônjuge ou ex-companheiro (a)",
    "03": "Parceiro (a), namorado (a), ex-parceiro (a), ex-namorado (a)",
    "04": "Pai, mãe, padrasto ou madrasta",
    "05": "Filho(a), enteado(a)",
    "06": "Irmão(ã)",
    "07": "Outro parente",
    "08": "Amigo(a)/colega, vizinho(a)",
    "09": "Empregado (a) em geral",
    "10": "Patrão/patroa/chefe",
    "11": "Pessoa desconhecida",
    "12": "Policial",
    "13": "Outro",
}
BOOKS_2019 = {
    "uf": STATE,
    "situacao_censitaria": CENSUS_AREA,
    "sexo": {"1": "Homem", "2": "Mulher"},
    "raca_cor": RACE,
    "psi_frequencia": FREQUENCY_2019,
    "psi_agressor": AGGRESSOR_2019,
    "psi_local": PLACE_2019 | {"6": "Internet/Redes Sociais/Celular", "7": "Outro"},
    "fis_frequencia": FREQUENCY_2019,
    # The published dictionary cuts or extends these labels.
    "fis_agressor": AGGRESSOR_2019 | {
        "03": "Parceiro (a), namorado (a), ex-parceiro (a), ex-namorado (a",
        "05": "Filho(a), enteado(a",
        "10": "Patrão/patroa/chefe(a)",
    },
    "fis_local": PLACE_2019,
    "sex_frequencia": FREQUENCY_2019,
    "sex_agressor": AGGRESSOR_2019 | {
        "02": "Ex-Cônjuge ou ex-companheiro (a",
        "08": "Amigo(a)/colega, vizinho(a",
    },
    "sex_local": PLACE_2019,
}
ACTS_2019 = [
    "psi_humilhacao_publica", "psi_gritos", "psi_ameaca_digital", "psi_ameaca_terceiro",
    "psi_destruiu_bem", "fis_tapa", "fis_empurrao", "fis_soco_chute", "fis_estrangulamento",
    "fis_arma", "sex_toque_forcado_12m", "sex_relacao_forcada_12m", "sex_toque_forcado_vida",
    "sex_relacao_forcada_vida",
]
BOOKS_2019 |= dict.fromkeys([*ACTS_2019, "privacidade_assegurada", "deixou_atividades"], YES_NO)
WOMAN_2019 = "Mulher"
AGGRESSOR_COLUMNS_2019 = ["psi_agressor", "fis_agressor", "sex_agressor"]
PARTNER_CODES_2019 = ["01", "02", "03"]
# Labels that count as partner when decided by text; the cut label of code 02 in
# the sexual block is not among them.
PARTNER_LABELS_2019 = [
    "Cônjuge ou companheiro (a)",
    "Ex-Cônjuge ou ex-companheiro (a)",
    "Parceiro (a), namorado (a), ex-parceiro (a), ex-namorado (a)",
    "Parceiro (a), namorado (a), ex-parceiro (a), ex-namorado (a",
]
