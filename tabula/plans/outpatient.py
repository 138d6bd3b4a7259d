"""Oncology panel cases and outpatient authorizations (chemotherapy,
radiotherapy, drugs): rename, decode, label lookups, personal-data-free
whitelist.  Patient identifiers (``CNS_PAC``, ``AP_CNSPCN``) are never in a
spec, so they can never reach an output."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import columns as C
from ..functions import domains as D
from ..operators import filters as fl
from ..operators.policy import first_present
from .projection import Derived, Keep, Label, Pair, Rename, Spec, apply_spec

# Panel source -> published names and output order.
PANEL = Spec(
    steps=[
        Label("DIAG_DETH", "TOPOGRAFIA_CID10_DESCRICAO", "causes", code_dst="TOPOGRAFIA_CID10"),
        Pair("DIAGNOSTIC", D.PANEL_CATEGORY, "COD_CATEGORIA_DIAGNOSTICO", "CATEGORIA_DIAGNOSTICO", strip_zeros=True),
        Pair("ESTADIAM", D.PANEL_STAGE, "COD_ESTADIAMENTO", "ESTADIAMENTO"),
        Pair("TRATAMENTO", D.PANEL_TREATMENT, "COD_TRATAMENTO", "TRATAMENTO"),
        Rename("ANO_DIAGN", "ANO_DIAGNOSTICO"), Rename("ANOMES_DIA", "ANO_MES_DIAGNOSTICO"),
        Rename("DT_DIAG", "DATA_DIAGNOSTICO"), Rename("ANO_TRATAM", "ANO_TRATAMENTO"),
        Rename("ANOMES_TRA", "ANO_MES_TRATAMENTO"), Rename("DT_TRAT", "DATA_TRATAMENTO"),
        Rename("TEMPO_TRAT", "DIAS_ATE_TRATAMENTO"),
        Derived("IDADE", "IDADE_DIAGNOSTICO", C.age_sentinel),
        Pair("SEXO", D.PANEL_SEX, None, "SEXO"),
        Rename("DT_NASC", "DATA_NASCIMENTO"), Rename("MUN_RESID", "COD_MUNICIPIO_RESIDENCIA"),
        Rename("UF_RESID", "COD_UF_RESIDENCIA"), Rename("MUN_DIAG", "COD_MUNICIPIO_DIAGNOSTICO"),
        Rename("UF_DIAGN", "COD_UF_DIAGNOSTICO"), Rename("CNES_DIAG", "COD_CNES_DIAGNOSTICO"),
        Rename("MUN_TRATAM", "COD_MUNICIPIO_TRATAMENTO"), Rename("UF_TRATAM", "COD_UF_TRATAMENTO"),
        Rename("CNES_TRAT", "COD_CNES_TRATAMENTO"),
        Keep("ARQUIVO_ORIGEM"),
    ],
    order=[
        "TOPOGRAFIA_CID10", "TOPOGRAFIA_CID10_DESCRICAO", "COD_CATEGORIA_DIAGNOSTICO", "CATEGORIA_DIAGNOSTICO",
        "COD_ESTADIAMENTO", "ESTADIAMENTO", "COD_TRATAMENTO", "TRATAMENTO",
        "ANO_DIAGNOSTICO", "ANO_MES_DIAGNOSTICO", "DATA_DIAGNOSTICO",
        "ANO_TRATAMENTO", "ANO_MES_TRATAMENTO", "DATA_TRATAMENTO", "DIAS_ATE_TRATAMENTO",
        "IDADE_DIAGNOSTICO", "SEXO", "DATA_NASCIMENTO",
        "COD_MUNICIPIO_RESIDENCIA", "COD_UF_RESIDENCIA",
        "COD_MUNICIPIO_DIAGNOSTICO", "COD_UF_DIAGNOSTICO", "COD_CNES_DIAGNOSTICO",
        "COD_MUNICIPIO_TRATAMENTO", "COD_UF_TRATAMENTO", "COD_CNES_TRATAMENTO", "ARQUIVO_ORIGEM",
    ],
)

# Authorization header fields kept (source -> published name).
AUTH_HEADER = {
    "AP_CODUNI": "COD_CNES", "AP_AUTORIZ": "NUM_APAC", "AP_CMP": "ANO_MES_ATENDIMENTO",
    "AP_PRIPAL": "COD_PROCEDIMENTO_PRINCIPAL", "AP_VL_AP": "VALOR_TOTAL_APAC",
    "AP_UFMUN": "COD_UF_MUNICIPIO_ESTABELECIMENTO", "AP_CNPJCPF": "CNPJ_ESTABELECIMENTO",
    "AP_CNPJMNT": "CNPJ_MANTENEDORA", "AP_COIDADE": "COD_TIPO_IDADE", "AP_NUIDADE": "IDADE",
    "AP_MUNPCN": "COD_MUNICIPIO_RESIDENCIA", "AP_UFNACIO": "COD_NACIONALIDADE",
    "AP_CEPPCN": "CEP_PACIENTE", "AP_DTINIC": "DATA_INICIO_VALIDADE", "AP_DTFIM": "DATA_FIM_VALIDADE",
    "AP_TPATEN": "COD_TIPO_ATENDIMENTO", "AP_CATEND": "COD_CARATER_ATENDIMENTO",
    "AP_CIDPRI": "CID_PRINCIPAL", "AP_CIDSEC": "CID_SECUNDARIO", "AP_CIDCAS": "CID_CAUSAS_ASSOCIADAS",
    "AP_DTSOLIC": "DATA_SOLICITACAO", "AP_DTAUT": "DATA_AUTORIZACAO", "AP_NATJUR": "COD_NATUREZA_JURIDICA",
}
# Personal data present in the source and never published.
AUTH_PERSONAL = ["AP_CNSPCN", "CNS_PAC"]
# Candidate columns for the drug filter's diagnosis.
DRUG_CID_CANDIDATES = ["AP_CIDPRI", "AP_CIDSEC", "AP_CIDCAS"]


def _header():
    steps = [Rename(k, v) for k, v in AUTH_HEADER.items()]
    steps += [Pair("AP_SEXO", D.AUTH_SEX, None, "SEXO"),
              Pair("AP_RACACOR", D.AUTH_RACE, "COD_RACA_COR", "RACA_COR"),
              Pair("AP_TPAPAC", D.AUTH_TYPE, "COD_TIPO_APAC", "TIPO_APAC")]
    return steps


def _oncology_block(p: str):
    return [
        Label(f"{p}_CID10", "TOPOGRAFIA_CID10_DESCRICAO", "causes", code_dst="TOPOGRAFIA_CID10"),
        Pair(f"{p}_ESTADI", D.AUTH_STAGE, "COD_ESTADIAMENTO", "ESTADIAMENTO"),
        Pair(f"{p}_LINFIN", D.AUTH_NODES, "COD_LINFONODOS_INVADIDOS", "LINFONODOS_INVADIDOS"),
        Rename(f"{p}_GRAHIS", "GRAU_HISTOPATOLOGICO"),
        Pair(f"{p}_TRANTE", D.AUTH_YES_NO, "COD_TRATAMENTO_ANTERIOR", "TEVE_TRATAMENTO_ANTERIOR"),
        Rename(f"{p}_DTIDEN", "DATA_IDENTIFICACAO_PATOLOGICA"),
        Pair(f"{p}_CONTTR", D.AUTH_YES_NO, "COD_CONTINUIDADE", "CONTINUIDADE_TRATAMENTO"),
        Rename(f"{p}_DTINTR", "DATA_INICIO_TRATAMENTO"),
    ]


CHEMO = Spec(_header() + _oncology_block("AQ") + [
    Rename("AQ_ESQU_P1", "ESQUEMA_TERAPEUTICO_INICIO"), Rename("AQ_ESQU_P2", "ESQUEMA_TERAPEUTICO_FIM"),
    Rename("AQ_TOTMPL", "TOTAL_MESES_PLANEJADOS"), Rename("AQ_TOTMAU", "TOTAL_MESES_AUTORIZADOS"),
    Keep("ARQUIVO_ORIGEM")])

RADIO = Spec(_header() + _oncology_block("AR") + [
    Pair("AR_FINALI", D.AUTH_RADIO_PURPOSE, "COD_FINALIDADE", "FINALIDADE_RADIOTERAPIA"),
    Keep("ARQUIVO_ORIGEM")])

DRUGS = Spec([Label("AP_CIDPRI", "CID_PRINCIPAL_DESCRICAO", "causes", first=True)] + _header() + [
    Rename("AM_PESO", "PESO_KG"), Rename("AM_ALTURA", "ALTURA_CM"),
    Pair("AM_GESTANT", D.AUTH_YES_NO, None, "GESTANTE"), Keep("ARQUIVO_ORIGEM")])


def _curate(raw: DataFrame, spec: Spec, causes: DataFrame | None) -> DataFrame:
    """Landing null tokens (C1), then the spec; personal data never leaves."""
    out = apply_spec(raw, spec, {"causes": causes}, landing=True)
    leaked = {c.upper() for c in out.columns} & set(AUTH_PERSONAL)
    if leaked:
        raise AssertionError(f"personal data in output: {sorted(leaked)}")
    return out


def curate_panel(raw: DataFrame, causes: DataFrame | None) -> DataFrame:
    return _curate(raw, PANEL, causes)


def curate_chemo(raw: DataFrame, causes: DataFrame | None) -> DataFrame:
    return _curate(raw, CHEMO, causes)


def curate_radio(raw: DataFrame, causes: DataFrame | None) -> DataFrame:
    return _curate(raw, RADIO, causes)


def curate_drugs(raw: DataFrame, causes: DataFrame | None) -> DataFrame:
    """F4 on the first diagnosis column present (none -> empty), then the spec."""
    col = first_present(raw, DRUG_CID_CANDIDATES)
    if col is None:
        return _curate(raw.limit(0), DRUGS, causes)
    return _curate(fl.keep(raw, fl.drug_onco(f"`{col}`")), DRUGS, causes)
