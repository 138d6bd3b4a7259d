"""Work-related cancer notifications: rename, strict age, decode pairs, one
exposure domain over sixteen flags, diagnosis and occupation labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import domains as D
from .projection import Derived, Keep, Label, Pair, Rename, Spec, apply_spec

# Notification fields kept (source -> published name).
WORK_RENAME = {
    "DT_NOTIFIC": "DATA_NOTIFICACAO", "NU_ANO": "ANO_NOTIFICACAO", "ID_AGRAVO": "COD_AGRAVO",
    "SG_UF_NOT": "COD_UF_NOTIFICACAO", "ID_MUNICIP": "COD_MUNICIPIO_NOTIFICACAO",
    "ID_UNIDADE": "COD_UNIDADE_NOTIFICACAO", "DT_DIAG": "DATA_DIAGNOSTICO", "ANO_NASC": "ANO_NASCIMENTO",
    "SG_UF": "COD_UF_RESIDENCIA", "ID_MN_RESI": "COD_MUNICIPIO_RESIDENCIA", "ID_OCUPA_N": "COD_OCUPACAO",
    "NUTEMPO": "TEMPO_TRABALHO_QTD", "CNAE": "COD_CNAE", "NUTEMPORIS": "TEMPO_EXPOSICAO_QTD",
    "DIAG_ESP": "CID_DIAGNOSTICO_ESPECIFICO", "OUT_EXP_DE": "EXPOSICAO_OUTROS_DESCRICAO",
    "TEMPO_FUMA": "TEMPO_FUMO_QTD", "DT_OBITO": "DATA_OBITO",
}

# Decoded fields (source, domain, code column, label column).
WORK_DECODE = [
    ("CS_SEXO", D.WORK_SEX, None, "SEXO"),
    ("CS_RACA", D.WORK_RACE, "COD_RACA_COR", "RACA_COR"),
    ("CS_GESTANT", D.WORK_PREGNANCY, "COD_GESTACAO", "GESTACAO"),
    ("CS_ESCOL_N", D.WORK_SCHOOLING, "COD_ESCOLARIDADE", "ESCOLARIDADE"),
    ("SIT_TRAB", D.WORK_EMPLOYMENT, "COD_SITUACAO_MERCADO_TRABALHO", "SITUACAO_MERCADO_TRABALHO"),
    ("TPTEMPO", D.WORK_TIME_UNIT, "COD_TEMPO_TRABALHO_UNIDADE", "TEMPO_TRABALHO_UNIDADE"),
    ("TPTEMPORIS", D.WORK_TIME_UNIT, "COD_TEMPO_EXPOSICAO_UNIDADE", "TEMPO_EXPOSICAO_UNIDADE"),
    ("TERCEIRIZA", D.WORK_OUTSOURCED, "COD_EMPREGADOR_TERCEIRIZADO", "EMPREGADOR_TERCEIRIZADO"),
    ("REGIME", D.WORK_REGIME, "COD_REGIME_TRATAMENTO", "REGIME_TRATAMENTO"),
    ("FUMA", D.WORK_SMOKING, "COD_HABITO_FUMAR", "HABITO_FUMAR"),
    ("TP_TEMP_FU", D.WORK_TIME_UNIT, "COD_TEMPO_FUMO_UNIDADE", "TEMPO_FUMO_UNIDADE"),
    ("TRAB_DOE", D.WORK_YES_NO_IGN, "COD_OUTROS_TRABALHADORES_DOENCA", "OUTROS_TRABALHADORES_DOENCA"),
    ("CAT", D.WORK_OUTSOURCED, "COD_COMUNICACAO_ACIDENTE_TRABALHO", "COMUNICACAO_ACIDENTE_TRABALHO"),
    ("EVOLUCAO", D.WORK_OUTCOME, "COD_EVOLUCAO", "EVOLUCAO_CASO"),
]

# Exposure flags (source -> published name), one shared domain.
WORK_EXPOSURES = {
    "ASBESTO": "EXPOSICAO_ASBESTO", "SILICA": "EXPOSICAO_SILICA_ARSENICO", "AMINA": "EXPOSICAO_AMINAS_AROMATICAS",
    "BENZENO": "EXPOSICAO_BENZENO", "ALCATRAO": "EXPOSICAO_ALCATRAO", "HIDROCARBO": "EXPOSICAO_HIDROCARBONETOS",
    "OLEOS": "EXPOSICAO_OLEOS_MINERAIS", "BERILIO": "EXPOSICAO_BERILIO", "CADMIO": "EXPOSICAO_CADMIO",
    "CROMO": "EXPOSICAO_CROMO", "NIQUEL": "EXPOSICAO_NIQUEL", "IONIZANTES": "EXPOSICAO_RADIACOES_IONIZANTES",
    "NAO_IONIZA": "EXPOSICAO_RADIACOES_NAO_IONIZANTES", "HORMONIO": "EXPOSICAO_HORMONIOS",
    "NEOPLASICO": "EXPOSICAO_ANTINEOPLASICOS", "OUTRO_EXP": "EXPOSICAO_OUTROS",
}

# Published column order.
WORK_ORDER = [
    "DATA_NOTIFICACAO", "ANO_NOTIFICACAO", "COD_AGRAVO",
    "COD_UF_NOTIFICACAO", "COD_MUNICIPIO_NOTIFICACAO", "COD_UNIDADE_NOTIFICACAO",
    "COD_UF_RESIDENCIA", "COD_MUNICIPIO_RESIDENCIA",
    "ANO_NASCIMENTO", "COD_IDADE", "IDADE_ANOS", "SEXO",
    "COD_RACA_COR", "RACA_COR", "COD_GESTACAO", "GESTACAO",
    "COD_ESCOLARIDADE", "ESCOLARIDADE",
    "COD_SITUACAO_MERCADO_TRABALHO", "SITUACAO_MERCADO_TRABALHO",
    "COD_OCUPACAO", "OCUPACAO_DESCRICAO", "COD_CNAE",
    "COD_EMPREGADOR_TERCEIRIZADO", "EMPREGADOR_TERCEIRIZADO",
    "COD_TEMPO_TRABALHO_UNIDADE", "TEMPO_TRABALHO_UNIDADE", "TEMPO_TRABALHO_QTD",
    "COD_TEMPO_EXPOSICAO_UNIDADE", "TEMPO_EXPOSICAO_UNIDADE", "TEMPO_EXPOSICAO_QTD",
    *WORK_EXPOSURES.values(), "EXPOSICAO_OUTROS_DESCRICAO",
    "COD_HABITO_FUMAR", "HABITO_FUMAR", "COD_TEMPO_FUMO_UNIDADE", "TEMPO_FUMO_UNIDADE", "TEMPO_FUMO_QTD",
    "COD_OUTROS_TRABALHADORES_DOENCA", "OUTROS_TRABALHADORES_DOENCA",
    "COD_COMUNICACAO_ACIDENTE_TRABALHO", "COMUNICACAO_ACIDENTE_TRABALHO",
    "DATA_DIAGNOSTICO", "CID_DIAGNOSTICO_ESPECIFICO", "CID_DIAGNOSTICO_ESPECIFICO_DESCRICAO",
    "COD_REGIME_TRATAMENTO", "REGIME_TRATAMENTO",
    "COD_EVOLUCAO", "EVOLUCAO_CASO", "DATA_OBITO", "ARQUIVO_ORIGEM",
]

WORK = Spec(
    [Rename(k, v) for k, v in WORK_RENAME.items()]
    + [Derived("NU_IDADE_N", "COD_IDADE", F.trim), Derived("NU_IDADE_N", "IDADE_ANOS", C.age_unit_value_strict)]
    + [Pair(s, dom, code, label) for s, dom, code, label in WORK_DECODE]
    + [Pair(s, D.WORK_EXPOSURE, None, out) for s, out in WORK_EXPOSURES.items()]
    + [Label("DIAG_ESP", "CID_DIAGNOSTICO_ESPECIFICO_DESCRICAO", "causes"),
       Label("ID_OCUPA_N", "OCUPACAO_DESCRICAO", "occupations", key=F.trim),
       Keep("ARQUIVO_ORIGEM")],
    order=WORK_ORDER,
)


def curate_work_cancer(raw: DataFrame, causes: DataFrame | None, occupations: DataFrame | None) -> DataFrame:
    """Landing null tokens (C1), then the spec."""
    return apply_spec(raw, WORK, {"causes": causes, "occupations": occupations}, landing=True)
