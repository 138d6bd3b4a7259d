"""One landed record of each flow against the published row, both written out
by hand, in the published order: a wrong name, position, label or order that
code and oracle share cannot pass here."""

import pytest

from tabula.plans import outpatient as OP
from tabula.plans import surveys as SV
from tabula.plans import work as WK


def one(spark, record):
    return spark.createDataFrame([tuple(record.values())], ", ".join(f"`{k}` string" for k in record))


def test_panel_row(spark):
    causes = spark.createDataFrame([("C509", "Mama, NE")], "CODIGO string, DESCRICAO string")
    landed = {"CNS_PAC": "700000", "DIAG_DETH": " C50.9", "DIAGNOSTIC": "01", "ESTADIAM": "3", "TRATAMENTO": "4", "ANO_DIAGN": "2023",
              "ANOMES_DIA": "202305", "DT_DIAG": "10/05/2023", "ANO_TRATAM": "2023", "ANOMES_TRA": "202307", "DT_TRAT": "01/07/2023", "TEMPO_TRAT": "52 ",
              "IDADE": "047", "SEXO": "F", "DT_NASC": "03/02/1976", "MUN_RESID": "355030", "UF_RESID": "35", "MUN_DIAG": "350950", "UF_DIAGN": "35",
              "CNES_DIAG": "2077485", "MUN_TRATAM": "355030", "UF_TRATAM": "35", "CNES_TRAT": "2088495", "ARQUIVO_ORIGEM": "POBR2023.dbc"}
    want = {"TOPOGRAFIA_CID10": "C50.9", "TOPOGRAFIA_CID10_DESCRICAO": "Mama, NE", "COD_CATEGORIA_DIAGNOSTICO": "01",
            "CATEGORIA_DIAGNOSTICO": "Neoplasias malignas (Lei 12.732/12)", "COD_ESTADIAMENTO": "3", "ESTADIAMENTO": "III", "COD_TRATAMENTO": "4",
            "TRATAMENTO": "Quimioterapia + Radioterapia", "ANO_DIAGNOSTICO": "2023", "ANO_MES_DIAGNOSTICO": "202305",
            "DATA_DIAGNOSTICO": "10/05/2023", "ANO_TRATAMENTO": "2023", "ANO_MES_TRATAMENTO": "202307", "DATA_TRATAMENTO": "01/07/2023",
            "DIAS_ATE_TRATAMENTO": "52", "IDADE_DIAGNOSTICO": 47, "SEXO": "Feminino", "DATA_NASCIMENTO": "03/02/1976",
            "COD_MUNICIPIO_RESIDENCIA": "355030", "COD_UF_RESIDENCIA": "35", "COD_MUNICIPIO_DIAGNOSTICO": "350950", "COD_UF_DIAGNOSTICO": "35",
            "COD_CNES_DIAGNOSTICO": "2077485", "COD_MUNICIPIO_TRATAMENTO": "355030", "COD_UF_TRATAMENTO": "35", "COD_CNES_TRATAMENTO": "2088495",
            "ARQUIVO_ORIGEM": "POBR2023.dbc"}
    got = OP.curate_panel(one(spark, landed), causes).first().asDict()
    assert list(got.items()) == list(want.items())
    odd = OP.curate_panel(one(spark, {**landed, "DIAGNOSTIC": "00", "ESTADIAM": "7", "IDADE": "999", "SEXO": "X", "DIAG_DETH": "C00"}), causes).first()
    assert (odd["CATEGORIA_DIAGNOSTICO"], odd["ESTADIAMENTO"], odd["IDADE_DIAGNOSTICO"], odd["SEXO"], odd["TOPOGRAFIA_CID10_DESCRICAO"]) == ("00", "7", None, "X", None)


def test_work_registry_row(spark):
    causes = spark.createDataFrame([("C459", "Mesotelioma NE")], "CODIGO string, DESCRICAO string")
    jobs = spark.createDataFrame([("715210", "Pedreiro")], "CODIGO string, DESCRICAO string")
    exposures = {"ASBESTO": "1", "SILICA": "2", "AMINA": "9", "BENZENO": "1", "ALCATRAO": "2", "HIDROCARBO": "9", "OLEOS": "1", "BERILIO": "2",
                 "CADMIO": "9", "CROMO": "1", "NIQUEL": "2", "IONIZANTES": "9", "NAO_IONIZA": "1", "HORMONIO": "2", "NEOPLASICO": "9", "OUTRO_EXP": "7"}
    landed = {"TP_NOT": "2", "DT_NOTIFIC": "20230510", "NU_ANO": "2023", "ID_AGRAVO": "C80", "SG_UF_NOT": "35", "ID_MUNICIP": "355030",
              "ID_UNIDADE": "2077485", "SG_UF": "35", "ID_MN_RESI": "350950", "ANO_NASC": "1960", "NU_IDADE_N": "4063", "CS_SEXO": "M", "CS_RACA": "4",
              "CS_GESTANT": "6", "CS_ESCOL_N": "03", "SIT_TRAB": "06", "ID_OCUPA_N": "715210 ", "CNAE": "4120400", "TERCEIRIZA": "3", "TPTEMPO": "4",
              "NUTEMPO": "20", "TPTEMPORIS": "3", "NUTEMPORIS": "11", **exposures, "OUT_EXP_DE": "poeira", "FUMA": "3", "TP_TEMP_FU": "4", "TEMPO_FUMA": "30",
              "TRAB_DOE": "9", "CAT": "2", "DT_DIAG": "20230102", "DIAG_ESP": "C45.9", "REGIME": "2", "EVOLUCAO": "6", "DT_OBITO": "20230601",
              "ARQUIVO_ORIGEM": "CANCBR23.dbc"}
    told = {"1": "Sim", "2": "Não", "9": "Ignorado", "7": "7"}
    exposed = dict(zip(["EXPOSICAO_ASBESTO", "EXPOSICAO_SILICA_ARSENICO", "EXPOSICAO_AMINAS_AROMATICAS", "EXPOSICAO_BENZENO", "EXPOSICAO_ALCATRAO",
                        "EXPOSICAO_HIDROCARBONETOS", "EXPOSICAO_OLEOS_MINERAIS", "EXPOSICAO_BERILIO", "EXPOSICAO_CADMIO", "EXPOSICAO_CROMO", "EXPOSICAO_NIQUEL",
                        "EXPOSICAO_RADIACOES_IONIZANTES", "EXPOSICAO_RADIACOES_NAO_IONIZANTES", "EXPOSICAO_HORMONIOS", "EXPOSICAO_ANTINEOPLASICOS",
                        "EXPOSICAO_OUTROS"], [told[v] for v in exposures.values()]))
    want = {"DATA_NOTIFICACAO": "20230510", "ANO_NOTIFICACAO": "2023", "COD_AGRAVO": "C80", "COD_UF_NOTIFICACAO": "35",
            "COD_MUNICIPIO_NOTIFICACAO": "355030", "COD_UNIDADE_NOTIFICACAO": "2077485", "COD_UF_RESIDENCIA": "35", "COD_MUNICIPIO_RESIDENCIA": "350950",
            "ANO_NASCIMENTO": "1960", "COD_IDADE": "4063", "IDADE_ANOS": 63, "SEXO": "Masculino", "COD_RACA_COR": "4", "RACA_COR": "Parda",
            "COD_GESTACAO": "6", "GESTACAO": "Não se aplica", "COD_ESCOLARIDADE": "03", "ESCOLARIDADE": "5ª à 8ª série incompleta do EF",
            "COD_SITUACAO_MERCADO_TRABALHO": "06", "SITUACAO_MERCADO_TRABALHO": "Aposentado", "COD_OCUPACAO": "715210", "OCUPACAO_DESCRICAO": "Pedreiro",
            "COD_CNAE": "4120400", "COD_EMPREGADOR_TERCEIRIZADO": "3", "EMPREGADOR_TERCEIRIZADO": "Não se aplica", "COD_TEMPO_TRABALHO_UNIDADE": "4",
            "TEMPO_TRABALHO_UNIDADE": "Ano", "TEMPO_TRABALHO_QTD": "20", "COD_TEMPO_EXPOSICAO_UNIDADE": "3", "TEMPO_EXPOSICAO_UNIDADE": "Mês",
            "TEMPO_EXPOSICAO_QTD": "11", **exposed, "EXPOSICAO_OUTROS_DESCRICAO": "poeira", "COD_HABITO_FUMAR": "3", "HABITO_FUMAR": "Ex-fumante",
            "COD_TEMPO_FUMO_UNIDADE": "4", "TEMPO_FUMO_UNIDADE": "Ano", "TEMPO_FUMO_QTD": "30", "COD_OUTROS_TRABALHADORES_DOENCA": "9",
            "OUTROS_TRABALHADORES_DOENCA": "Ignorado", "COD_COMUNICACAO_ACIDENTE_TRABALHO": "2", "COMUNICACAO_ACIDENTE_TRABALHO": "Não",
            "DATA_DIAGNOSTICO": "20230102", "CID_DIAGNOSTICO_ESPECIFICO": "C45.9", "CID_DIAGNOSTICO_ESPECIFICO_DESCRICAO": "Mesotelioma NE",
            "COD_REGIME_TRATAMENTO": "2", "REGIME_TRATAMENTO": "Ambulatorial", "COD_EVOLUCAO": "6",
            "EVOLUCAO_CASO": "Óbito por câncer relacionado ao trabalho", "DATA_OBITO": "20230601", "ARQUIVO_ORIGEM": "CANCBR23.dbc"}
    got = WK.curate_work_cancer(one(spark, landed), causes, jobs).first().asDict()
    assert list(got.items()) == list(want.items()) and len(got) == 66


def line(*cells):
    """A survey line with the given (position, text) cells, positions from 1."""
    out = [" "] * 1100
    for pos, text in cells:
        out[pos - 1 : pos - 1 + len(text)] = text
    return "".join(out)


#: State 35, stratum, sampling unit, household, person, a woman of 47, brown.
HEAD_2013 = [(1, "35"), (3, "3510011"), (10, "1234567"), (17, "0042"), (102, "03"), (106, "2"), (115, "047"), (118, "4")]
HEAD_2019 = [(1, "35"), (3, "3510011"), (10, "123456789"), (19, "0042"), (104, "03"), (108, "2"), (117, "047"), (120, "4")]


def tail(unit):
    return {"SEXO": "Feminino", "IDADE": 47, "COR_RACA": "Parda", "COD_UF": "35", "ESTRATO_AMOSTRAL": "3510011",
            "UNIDADE_PRIMARIA_AMOSTRAGEM": unit, "NUM_ORDEM_DOMICILIO": "0042", "NUM_ORDEM_MORADOR": "03"}


SURVEYS = {
    "diagnosis_2013": (HEAD_2013 + [(1018, "1"), (1019, "4"), (1020, "39"), (1022, "2")],
                       {"DIAGNOSTICO_CANCER": "Sim", "TIPO_CANCER": "Mama", "IDADE_DIAGNOSTICO": 39, "LIMITACAO_ATIVIDADES": "Um pouco", **tail("1234567")},
                       (1018, "2")),
    "cervix_2013": (HEAD_2013 + [(1044, "3"), (1047, "2"), (1048, "1"), (1049, "3"), (1050, "7"), (1055, "1"), (1056, "4"), (1057, "41")],
                    {"ULTIMO_EXAME_PREVENTIVO": "De 2 a menos de 3 anos", "FEITO_PELO_SUS": "Não sabe", "PAGOU_EXAME": "Sim", "COBERTO_PLANO_SAUDE": "Não",
                     "TEMPO_ATE_RESULTADO": "Nunca fui buscar", "FEZ_HISTERECTOMIA": "Sim", "MOTIVO_HISTERECTOMIA": "Câncer ginecológico",
                     "IDADE_HISTERECTOMIA": 41, **tail("1234567")}, (1044, " ")),
    "breast_2013": (HEAD_2013 + [(1059, "1"), (1060, "1"), (1061, "2"), (1064, "5"), (1065, "1"), (1066, "2"), (1067, "3"), (1068, "5"), (1069, "3")],
                    {"ULTIMO_EXAME_CLINICO_MAMAS": "Menos de 1 ano atrás", "MAMOGRAFIA_SOLICITADA": "Sim", "FEZ_MAMOGRAFIA": "Não",
                     "ULTIMA_MAMOGRAFIA": "Nunca fez", "MAMOGRAFIA_PELO_SUS": "Não sabe", "PAGOU_MAMOGRAFIA": "Não", "MAMOGRAFIA_COBERTA_PLANO": "Sim",
                     "TEMPO_ATE_RESULTADO": "Ainda não recebi",
                     "ENCAMINHAMENTO_APOS_RESULTADO": "Não houve encaminhamento, consultas já eram com especialista", **tail("1234567")}, (1059, " ")),
    "diagnosis_2019": (HEAD_2019 + [(1031, "1")] + [(1032 + k, "12391 29312391 2"[k]) for k in range(15)] + [(1049, "9")],
                       {"DIAGNOSTICO_CANCER": "Sim", "TIPO_PELE": "Sim", "TIPO_PELE_MELANOMA": "Não", "TIPO_PULMAO": "Não sei", "TIPO_COLON_RETO": "Ignorado",
                        "TIPO_ESTOMAGO": "Sim", "TIPO_MAMA": "", "TIPO_COLO_UTERO": "Não", "TIPO_PROSTATA": "Ignorado",
                        "TIPO_BOCA_OROFARINGE_LARINGE": "Não sei", "TIPO_BEXIGA": "Sim", "TIPO_LINFOMA_LEUCEMIA": "Não", "TIPO_CEREBRO": "Não sei",
                        "TIPO_OVARIO": "Ignorado", "TIPO_TIREOIDE": "Sim", "TIPO_OUTRO": "", "LIMITACAO_ATIVIDADES": "Ignorado", **tail("123456789")},
                       (1031, "2")),
    "cervix_2019": (HEAD_2019 + [(1064, "5"), (1065, "07"), (1067, "9"), (1068, "3"), (1069, "1"), (1070, "2"), (1074, "1"), (1075, "6"), (1076, "x1")],
                    {"ULTIMO_EXAME_PREVENTIVO": "Nunca fez", "MOTIVO_NAO_FEZ": "Tempo de espera no serviço de saúde era muito grande",
                     "FEITO_PELO_SUS": "Não sabe/Não lembra", "PAGOU_EXAME": "Ignorado", "TEMPO_ATE_RESULTADO": "Menos de 1 mês depois",
                     "ENCAMINHAMENTO_APOS_RESULTADO": "Não", "FEZ_HISTERECTOMIA": "Sim", "MOTIVO_HISTERECTOMIA": "Sangramento vaginal anormal",
                     "IDADE_HISTERECTOMIA": None, **tail("123456789")}, (1064, " ")),
    "breast_2019": (HEAD_2019 + [(1078, "4"), (1079, "2"), (1080, "1"), (1081, "1"), (1082, "9"), (1083, "3"), (1084, "9"), (1085, "1"), (1086, "8")],
                    {"ULTIMO_EXAME_CLINICO_MAMAS": "Há 3 anos ou mais", "MAMOGRAFIA_SOLICITADA": "Não", "FEZ_MAMOGRAFIA": "Sim",
                     "ULTIMA_MAMOGRAFIA": "Há menos de 1 ano", "MAMOGRAFIA_PELO_SUS": "Não sabe/Não lembra", "PAGOU_MAMOGRAFIA": "Ignorado",
                     "TEMPO_ATE_RESULTADO": "Ignorado", "ENCAMINHAMENTO_APOS_RESULTADO": "Sim", "FOI_A_CONSULTA_ESPECIALISTA": "8", **tail("123456789")},
                    (1078, " ")),
}


@pytest.mark.parametrize("name", SURVEYS)
def test_survey_row(spark, name):
    cells, want, left_out = SURVEYS[name]
    sex = 106 if name.endswith("2013") else 108
    others = [line(*cells, left_out)] + ([line(*cells, (sex, "1"))] if not name.startswith("diagnosis") else [])
    df = spark.createDataFrame([(x,) for x in [line(*cells), *others, "short", ""]], "value string")
    got = SV.curate_survey(df, SV.SURVEYS[name]).collect()
    assert [list(r.asDict().items()) for r in got] == [list(want.items())]
