"""Binding views: coded-record tables derived from the driver's tables.

Each view is ONE SQL text that both engines run: Spark receives it through
``spark.sql(text, **dataframes)`` (``{name}`` placeholders are bound to
DataFrames, no temp-view state), DuckDB receives it as a ``WITH name AS (...)``
prefix of the oracle statement.  Every view is a deterministic projection of
a whole driver table, so its size grows with the scale factor.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# view name -> SQL text with {placeholders} for the tables/views it reads.
VIEWS: dict[str, str] = {
    # coded record, one row per order
    "rec": """select
  o_orderkey as rec_id,
  case when o_orderkey % 17 = 0 then null when o_orderkey % 23 = 0 then ' c50.9 ' when o_orderkey % 29 = 0 then 'C9'
       else substr('CCCDBZA', cast(o_orderkey % 7 as int) + 1, 1) || lpad(cast(o_custkey % 100 as string),2,'0') || cast(o_orderkey % 10 as string) end as causabas,
  case when o_orderkey % 29 = 0 then 'AB1' else cast(100 + o_custkey % 150 as string) || 'X' end as causa9,
  case when o_orderkey % 31 = 0 then '' when o_orderkey % 37 = 0 then '4xx'
       else cast(o_orderkey % 7 as string) || lpad(cast(o_custkey % 60 as string),2,'0') end as idade,
  lpad(cast(day(o_orderdate) as string),2,'0') || lpad(cast(month(o_orderdate) as string),2,'0') || cast(year(o_orderdate) as string) as dtobito,
  case when o_orderkey % 13 = 0 then substr(cast(year(o_orderdate) as string),3,2)
       else substr(cast(year(o_orderdate) as string),3,2) || lpad(cast(month(o_orderdate) as string),2,'0') || '00' end as dataobito,
  case when o_orderkey % 41 = 0 then ' ' when o_orderkey % 3 = 0 then cast(100000 + o_custkey % 40 as string) || '7'
       else cast(100000 + o_custkey % 40 as string) end as munres,
  case o_orderkey % 5 when 0 then '1' when 1 then '2' when 2 then ' 1 ' when 3 then '7' else null end as sexo,
  case when o_orderkey % 2 = 0 then '8' || lpad(cast(o_custkey % 30 as string),2,'0') else lpad(cast(o_custkey % 30 as string),3,'0') end as naturalidade,
  lpad(cast(o_custkey % 60 as string),3,'0') as ocup,
  'DOBR' || cast(year(o_orderdate) as string) || '.dbc' as arquivo_origem
from {orders}""",
    # dimensions
    "ref_icd": "select 'C' || case when p_partkey < 1000 then lpad(cast(p_partkey as string),3,'0') else cast(p_partkey as string) end as codigo, p_name || ' ' || p_brand as descricao from {part}",
    "ref_uf": "select lpad(cast(n_nationkey as string),2,'0') as codigo, n_name as descricao from {nation}",
    "ref_pais": "select lpad(cast(n_nationkey as string),3,'0') as codigo, 'PAIS_' || n_name as descricao from {nation}",
    "ref_sin": "select cast(100000 + n_nationkey as string) as antigo, cast(100500 + n_nationkey as string) as atual from {nation}",
    "ref_ocup": "select distinct lpad(cast(p_size as string),3,'0') as codigo, 'OCUP_' || cast(p_size as string) as descricao from {part}",
    "ref_cid9": "select distinct cast(100 + p_size * 3 as string) as codigo, 'CID9_' || cast(p_size as string) as descricao from {part}",
    # death records as landed (source column names), modern and old era
    "sim_do": """select cast(rec_id as string) as CONTADOR, causabas as CAUSABAS, idade as IDADE, dtobito as DTOBITO,
  munres as CODMUNRES, sexo as SEXO, naturalidade as NATUR, ocup as OCUP,
  cast(rec_id % 6 as string) as RACACOR, cast(rec_id % 7 as string) as ESTCIV,
  lpad(cast(rec_id % 13 as string), 2, '0') as ESCFALAGR1, cast(rec_id % 8 as string) as LOCOCOR,
  case when rec_id % 9 = 0 then 'None' else cast(rec_id % 3 as string) end as ASSISTMED,
  '1' as TPPOS, cast(rec_id % 4 as string) as OBITOGRAV, cast(rec_id % 5 as string) as OBITOPUERP,
  '0101' || cast(1930 + rec_id % 60 as string) as DTNASC, lpad(cast(rec_id % 300 as string), 4, '0') as ETNIA,
  munres as CODMUNOCOR, cast(rec_id % 4 as string) as TIPOBITO, cast(rec_id % 3 as string) as EXAME,
  cast(rec_id % 10 as string) as CIRURGIA, case when rec_id % 8 = 0 then 'nan' else cast(rec_id % 3 as string) end as NECROPSIA,
  cast(rec_id % 7 as string) as ATESTANTE, arquivo_origem as ARQUIVO_ORIGEM
from {rec}""",
    # the same records as a DBF file gives them back
    "sim_dbf": "select " + ", ".join(f"nullif(trim({c}), '') as {c}" for c in (
        "CONTADOR CAUSABAS IDADE DTOBITO CODMUNRES SEXO NATUR OCUP RACACOR ESTCIV ESCFALAGR1 LOCOCOR ASSISTMED TPPOS OBITOGRAV OBITOPUERP "
        "DTNASC ETNIA CODMUNOCOR TIPOBITO EXAME CIRURGIA NECROPSIA ATESTANTE ARQUIVO_ORIGEM").split()) + " from {sim_do}",
    "sim_do_old": """select cast(rec_id as string) as contador, causa9 as CAUSABAS, idade as IDADE, dataobito as DATAOBITO,
  munres as MUNIRES, sexo as SEXO, naturalidade as NATUR, ocup as OCUPACAO,
  cast(rec_id % 5 as string) as INSTRUCAO, cast(rec_id % 6 as string) as RACACOR, cast(rec_id % 6 as string) as ESTCIVIL,
  case when rec_id % 4 = 0 then munres else substr(munres, 1, 6) end as MUNIOCOR, cast(rec_id % 8 as string) as LOCOCOR,
  cast(rec_id % 4 as string) as TIPOBITO, cast(rec_id % 3 as string) as ASSISTMED, cast(rec_id % 4 as string) as EXAME,
  case when rec_id % 9 = 0 then 'NaN' else cast(rec_id % 3 as string) end as CIRURGIA, cast(rec_id % 5 as string) as NECROPSIA,
  cast(rec_id % 7 as string) as ATESTANTE,
  'DORBR' || substr(dataobito, 1, 2) || '.dbc' as ARQUIVO_ORIGEM
from {rec}""",
    "ref_sinonimos": "select antigo as COD_MUNICIPIO_ANTIGO, atual as COD_MUNICIPIO_ATUAL from {ref_sin}",
    # facility qualifications, beds, registry
    "hab": """select cast(l_suppkey as string) as cnes,
  case l_partkey % 8 when 0 then '1704' when 1 then '17.06' when 2 then '01709' when 3 then '1711' when 4 then '1712' when 5 then ' 1713 ' when 6 then '1801' else null end as sgruphab,
  case when l_linenumber % 3 = 0 then ' ' when l_linenumber % 4 = 0 then null else 'P' || cast(l_linenumber as string) end as portaria,
  cast(year(l_shipdate) as string) || lpad(cast(month(l_shipdate) as string),2,'0') as dtportar
from {lineitem}""",
    "leitos": "select cast(l_suppkey as string) as cnes, case when l_suppkey % 5 = 0 or l_linenumber = 2 then 'x' else cast(cast(l_quantity as int) as string) end as qt_exist from {lineitem}",
    "estab": """select cast(case when s_suppkey % 10 = 3 then s_suppkey + 5000000 else s_suppkey end as string) as co_cnes, s_name as no_fantasia,
  case when s_suppkey % 4 = 0 then ' ' when s_suppkey % 7 = 0 then null else 'J' || cast(s_suppkey % 30 as string) end as cnpj,
  case when s_suppkey % 8 = 0 then null else 'M' || cast(s_suppkey % 6 as string) end as cnpj_mantenedora,
  case s_suppkey % 6 when 0 then '1' when 1 then ' sim ' when 2 then '0' when 3 then 'N' when 4 then '' else 'x' end as st_flag,
  cast(s_suppkey % 9 as string) as tp_unidade
from {supplier}""",
    # file listing, reference list field
    "listing": "select (case when doc_id % 2 = 0 then 'AQ' else 'aq' end) || upper(lang) || lpad(cast(8 + doc_id % 17 as string),2,'0') || lpad(cast(1 + cast(floor(doc_id / 4) as bigint) % 3 as string),2,'0') || '.dbc' as nome, n_chars as tamanho, doc_id from {documents}",
    "cadmun": """select cast(100000 + n_nationkey as string) as muncod, case when n_nationkey % 6 = 0 then 'EXTINTO' else ' ativo ' end as situacao,
  cast(200000 + n_nationkey as string) || ', 300' || lpad(cast(n_nationkey as string),3,'0') || '-300' || lpad(cast(n_nationkey + 2 as string),3,'0') || ', 400000-409999, x' as munsinon from {nation}""",
    # wide text matrix for unpivot, with total row and column
    "matriz": """select * from (
  select cast(user_id as string) as linha,
    cast(sum(case when event_type = 'click' then 1 else 0 end) as string) || '.000' as click,
    cast(sum(case when event_type = 'view' then 1 else 0 end) as string) || ',00' as view_,
    case when user_id % 5 = 0 then '-' else cast(sum(case when event_type = 'error' then 1 else 0 end) as string) end as error_,
    cast(count(*) as string) as total
  from {events} group by user_id
  union all select 'Total', '1', '1', '1', '3') u""",
    # fixed-width lines: pos 1-2 uf, 3-9 stratum, 10 sex, 11 answer, 12-14 age, 15 race, 16-18 flags
    "linhas": """select lpad(cast(c_nationkey as string),2,'0') || lpad(cast(c_custkey as string),7,'0')
  || (case when c_custkey % 2 = 0 then '2' else '1' end) || substr('123459 ', cast(c_custkey % 7 as int) + 1, 1)
  || lpad(cast(18 + c_custkey % 80 as string),3,'0') || substr('1234598', cast(c_custkey % 7 as int) + 1, 1)
  || substr('129', cast(c_custkey % 3 as int) + 1, 1) || substr('211', cast(c_custkey % 3 as int) + 1, 1) || substr(' 12', cast(c_custkey % 3 as int) + 1, 1) as value
from {customer}""",
    # manifest of already published files (one period missing, some sizes stale)
    "manifesto": """select upper(nome) as chave, max(tamanho) + (case when upper(nome) like '%EN%' then 0 else 1 end) as assinatura
from {listing} where nome not like '%08%' group by upper(nome)""",
    # grants: text plus key
    "convenios": "select doc_id as num, text as objeto, case when doc_id % 3 = 0 then 'M' || cast(doc_id % 6 as string) else 'J' || cast(doc_id % 30 as string) end as convenente, "
    + ", ".join(f"case when doc_id % {k} = 0 then '' else 'c{k}-' || cast(doc_id % {k + 40} as string) || '-' || coalesce(source, lang, '') end as c{k}"
                for k in range(2, 26)) + " from {documents}",
}


def _auth_view(prefix: str) -> str:
    """An outpatient-authorization layout (``prefix`` = AQ / AR / AM) over rec."""
    body = """select cast(1000000 + rec_id % 500 as string) as AP_CODUNI, cast(rec_id as string) as AP_AUTORIZ,
  substr(dtobito, 5, 4) || substr(dtobito, 3, 2) as AP_CMP, '0304' || lpad(cast(rec_id % 100 as string), 6, '0') as AP_PRIPAL,
  cast(rec_id % 1000 as string) || '.50' as AP_VL_AP, munres as AP_UFMUN, cast(rec_id % 3 as string) as AP_SEXO,
  lpad(cast(rec_id % 7 as string), 2, '0') as AP_RACACOR, cast(rec_id % 4 as string) as AP_TPAPAC,
  'J' || cast(rec_id % 30 as string) as AP_CNPJCPF, ' M' || cast(rec_id % 6 as string) || ' ' as AP_CNPJMNT,
  cast(rec_id % 5 as string) as AP_COIDADE, munres as AP_MUNPCN, lpad(cast(rec_id % 400 as string), 3, '0') as AP_UFNACIO,
  lpad(cast(rec_id % 99999 as string), 8, '0') as AP_CEPPCN, dtobito as AP_DTINIC, case when rec_id % 7 = 0 then 'NaN' else dtobito end as AP_DTFIM,
  lpad(cast(rec_id % 40 as string), 2, '0') as AP_TPATEN, lpad(cast(rec_id % 6 as string), 2, '0') as AP_CATEND,
  case when rec_id % 4 = 0 then '' else causabas end as AP_CIDCAS, dtobito as AP_DTSOLIC, dtobito as AP_DTAUT,
  cast(1000 + rec_id % 9 as string) as AP_NATJUR,
  causabas as AP_CIDPRI, causa9 as AP_CIDSEC, ocup as AP_NUIDADE, 'CNS' || cast(rec_id as string) as AP_CNSPCN,
  causabas as XX_CID10, cast(rec_id % 6 as string) as XX_ESTADI, substr('SN3X', cast(rec_id % 4 as int) + 1, 1) as XX_LINFIN,
  cast(rec_id % 4 as string) as XX_GRAHIS, substr('SNX', cast(rec_id % 3 as int) + 1, 1) as XX_TRANTE, dtobito as XX_DTIDEN,
  substr('SN', cast(rec_id % 2 as int) + 1, 1) as XX_CONTTR, dtobito as XX_DTINTR,
  'P' || cast(rec_id % 9 as string) as AQ_ESQU_P1, 'F' || cast(rec_id % 5 as string) as AQ_ESQU_P2,
  cast(rec_id % 12 as string) as AQ_TOTMPL, cast(rec_id % 6 as string) as AQ_TOTMAU,
  cast(rec_id % 8 as string) as AR_FINALI, cast(40 + rec_id % 80 as string) as AM_PESO,
  cast(140 + rec_id % 60 as string) as AM_ALTURA, substr('SNX', cast(rec_id % 3 as int) + 1, 1) as AM_GESTANT,
  'XXBR' || substr(dtobito, 5, 4) || '.dbc' as ARQUIVO_ORIGEM
from {rec}"""
    return body.replace("XX", prefix)


# Exposure flag source names of the work-cancer layout.
_EXPOSURE_SOURCES = ["ASBESTO", "SILICA", "AMINA", "BENZENO", "ALCATRAO", "HIDROCARBO", "OLEOS", "BERILIO",
                     "CADMIO", "CROMO", "NIQUEL", "IONIZANTES", "NAO_IONIZA", "HORMONIO", "NEOPLASICO", "OUTRO_EXP"]


def _work_view() -> str:
    exposures = ",\n  ".join(f"substr('129 ', cast((rec_id + {i}) % 4 as int) + 1, 1) as {n}"
                             for i, n in enumerate(_EXPOSURE_SOURCES))
    return f"""select dtobito as DT_NOTIFIC, substr(dtobito, 5, 4) as NU_ANO, 'Y94' as ID_AGRAVO,
  lpad(cast(rec_id % 27 as string), 2, '0') as SG_UF_NOT, munres as ID_MUNICIP, cast(rec_id % 300 as string) as ID_UNIDADE,
  dtobito as DT_DIAG, cast(1930 + rec_id % 60 as string) as ANO_NASC, lpad(cast(rec_id % 29 as string), 2, '0') as SG_UF,
  munres as ID_MN_RESI, ocup as ID_OCUPA_N, cast(rec_id % 30 as string) as NUTEMPO, cast(rec_id % 99 as string) as CNAE,
  cast(rec_id % 20 as string) as NUTEMPORIS, causabas as DIAG_ESP, 'outro ' || cast(rec_id % 5 as string) as OUT_EXP_DE,
  cast(rec_id % 40 as string) as TEMPO_FUMA, case when rec_id % 9 = 0 then dtobito end as DT_OBITO,
  case rec_id % 4 when 0 then '4' || lpad(cast(rec_id % 90 as string), 3, '0') when 1 then '5003' when 2 then '3011' else null end as NU_IDADE_N,
  substr('MFIX', cast(rec_id % 4 as int) + 1, 1) as CS_SEXO, cast(rec_id % 10 as string) as CS_RACA,
  cast(rec_id % 10 as string) as CS_GESTANT, lpad(cast(rec_id % 12 as string), 2, '0') as CS_ESCOL_N,
  lpad(cast(rec_id % 14 as string), 2, '0') as SIT_TRAB, cast(rec_id % 5 as string) as TPTEMPO,
  cast(rec_id % 6 as string) as TPTEMPORIS, cast(rec_id % 10 as string) as TERCEIRIZA, cast(rec_id % 3 as string) as REGIME,
  cast(rec_id % 4 as string) as FUMA, cast(rec_id % 5 as string) as TP_TEMP_FU, cast(rec_id % 10 as string) as TRAB_DOE,
  cast(rec_id % 10 as string) as CAT, cast(rec_id % 10 as string) as EVOLUCAO,
  {exposures},
  'CANCBR' || substr(dtobito, 5, 4) || '.dbc' as ARQUIVO_ORIGEM
from {{rec}}"""


VIEWS["painel"] = """select substr(dtobito, 5, 4) as ANO_DIAGN, substr(dtobito, 5, 4) || substr(dtobito, 3, 2) as ANOMES_DIA,
  cast(cast(substr(dtobito, 5, 4) as int) + cast(rec_id % 2 as int) as string) as ANO_TRATAM,
  substr(dtobito, 5, 4) || substr(dtobito, 3, 2) as ANOMES_TRA,
  lpad(cast(rec_id % 27 as string), 2, '0') as UF_RESID, munres as MUN_RESID,
  lpad(cast(rec_id % 29 as string), 2, '0') as UF_TRATAM, ' ' || substr(munres, 1, 6) as MUN_TRATAM,
  lpad(cast(rec_id % 31 as string), 2, '0') as UF_DIAGN, substr(munres, 1, 6) as MUN_DIAG,
  cast(rec_id % 7 as string) as TRATAMENTO, lpad(cast(rec_id % 6 as string), 2, '0') as DIAGNOSTIC,
  case when rec_id % 11 = 0 then '999' else lpad(cast(rec_id % 90 as string), 3, '0') end as IDADE,
  case rec_id % 3 when 0 then 'F' when 1 then 'M' else ' X ' end as SEXO,
  cast(rec_id % 10 as string) as ESTADIAM, cast(1000000 + rec_id % 500 as string) as CNES_DIAG,
  lpad(cast(rec_id % 150 as string), 7, '0') as CNES_TRAT,
  case when rec_id % 19 = 0 then '99999' when rec_id % 2 = 0 then '+' || cast(rec_id % 400 as string)
       else '-' || cast(rec_id % 30 as string) end as TEMPO_TRAT,
  causabas as DIAG_DETH, dtobito as DT_DIAG, dtobito as DT_TRAT, '01011950' as DT_NASC,
  'CNS' || cast(rec_id as string) as CNS_PAC, 'POBR' || substr(dtobito, 5, 4) || '.dbc' as ARQUIVO_ORIGEM
from {rec}"""
VIEWS["apac_aq"] = _auth_view("AQ")
VIEWS["apac_ar"] = _auth_view("AR")
VIEWS["apac_am"] = _auth_view("AM")
VIEWS["sinan"] = _work_view()
VIEWS["ref_cid10"] = "select codigo as CODIGO, descricao as DESCRICAO from {ref_icd}"
VIEWS["ref_cbo"] = "select codigo as CODIGO, descricao as DESCRICAO from {ref_ocup}"

VIEWS["estab_reg"] = """select co_cnes as CO_CNES, cnpj as NU_CNPJ, cnpj_mantenedora as NU_CNPJ_MANTENEDORA,
  'RAZAO ' || no_fantasia as NO_RAZAO_SOCIAL, no_fantasia as NO_FANTASIA,
  lpad(cast(cast(co_cnes as int) % 27 as string), 2, '0') as CO_UF, cast(100000 + cast(co_cnes as int) % 25 as string) as CO_IBGE,
  'RUA ' || co_cnes as NO_LOGRADOURO, '-23.' || lpad(cast(cast(co_cnes as int) % 1000 as string), 3, '0') as NU_LATITUDE,
  tp_unidade as TP_UNIDADE, st_flag as ST_CENTRO_CIRURGICO,
  substr('SN1 ', cast(cast(co_cnes as int) % 4 as int) + 1, 1) as ST_ATEND_HOSPITALAR,
  lpad(cast(cast(co_cnes as int) % 9999 as string), 8, '0') as CO_CEP, cast(cast(co_cnes as int) % 500 as string) as NU_ENDERECO,
  'BAIRRO ' || co_cnes as NO_BAIRRO, '-46.' || co_cnes as NU_LONGITUDE, '11 ' || co_cnes as NU_TELEFONE,
  'c' || co_cnes || '@x.example' as NO_EMAIL, cast(1000 + cast(co_cnes as int) % 9 as string) as CO_NATUREZA_JUR,
  cast(cast(co_cnes as int) % 3 as string) as CO_ESFERA_ADMINISTRATIVA, 'ESFERA ' || tp_unidade as DS_ESFERA_ADMINISTRATIVA,
  st_flag as ST_CENTRO_OBSTETRICO, substr('01SN', cast(cast(co_cnes as int) % 4 as int) + 1, 1) as ST_CENTRO_NEONATAL,
  substr('NS', cast(cast(co_cnes as int) % 2 as int) + 1, 1) as ST_SERVICO_APOIO, ' s ' as ST_ATEND_AMBULATORIAL,
  'CPF' || co_cnes as NU_CPF, 'M' as CO_MOTIVO_DESAB
from {estab}"""
VIEWS["geo_saude"] = """select cast(n_nationkey + 1000 as string) as cod_municipio, cast(n_regionkey as string) as cod_macro,
  'MACRO ' || cast(n_regionkey as string) as macro, n_name as no_municipio, cast(n_nationkey * 1000 as string) as populacao,
  cast(n_regionkey + 1 as string) as co_regiao, 'REGIAO ' || cast(n_regionkey as string) as regiao,
  cast(10 + n_nationkey as string) as co_uf, substr(n_name, 1, 2) as sg_uf, 'UF ' || n_name as uf,
  cast(1000 + n_nationkey % 9 as string) as cod_saude, 'SAUDE ' || cast(n_nationkey % 9 as string) as saude
from {nation}"""
VIEWS["geo_xls"] = """select cast(n_nationkey + 1000 as string) as MUNCOD, cast(n_nationkey - 30 as string) as LATITUDE,
  cast(n_nationkey - 50 as string) as LONGITUDE, cast(n_nationkey * 10 as string) as AREA,
  cast(n_nationkey * 7 as string) as ALTITUDE, cast(n_nationkey + 1000 as string) || cast(n_nationkey % 10 as string) as MUNCODDV
from {nation} where n_nationkey % 4 <> 1
union all select cast(n_nationkey + 1000 as string), 'dup', 'dup', 'dup', 'dup', 'dup' from {nation} where n_nationkey % 5 = 0"""
VIEWS["cadmun_full"] = """select '00' || cast(n_nationkey + 1000 as string) as MUNCOD,
  case when n_nationkey % 6 = 0 then 'EXTINTO' else 'ATIVO' end as SITUACAO,
  case when n_nationkey % 7 = 0 then 'S' else 'N' end as CAPITAL, cast(n_regionkey * 10 as string) as MESOCOD,
  cast(n_regionkey * 100 + n_nationkey as string) as MICROCOD, cast(n_nationkey as string) as AREA,
  cast(200000 + n_nationkey as string) || ', 001' || lpad(cast(n_nationkey + 1 as string), 3, '0') as MUNSINON
from {nation}"""


def _survey_line_view(edition: str) -> str:
    """Raw fixed-width survey lines (one per customer) with every field of the
    edition's extracts at its layout position; blanks included."""
    from .plans import surveys as SV

    fields = {}
    for name, sv in SV.SURVEYS.items():
        if not name.endswith(edition):
            continue
        for _, pos, ln in sv.layout:
            fields[pos] = ln
        for pos, ln, _ in sv.equals:
            fields[pos] = ln
    sex_pos = 106 if edition == "2013" else 108
    flag_pos = 1018 if edition == "2013" else 1031
    fields[flag_pos] = 1
    parts, cur = [], 1
    for pos in sorted(fields):
        ln = fields[pos]
        if pos > cur:
            parts.append(f"repeat(' ', {pos - cur})")
        if pos == sex_pos:
            e = "case when c_custkey % 2 = 0 then '2' else '1' end"
        elif pos == flag_pos:
            e = "case when c_custkey % 3 = 0 then '2' else '1' end"
        elif ln == 1:
            e = f"substr('1234 5967', cast((c_custkey + {pos}) % 9 as int) + 1, 1)"
        else:
            e = f"lpad(cast((c_custkey * 7 + {pos}) % {10 ** min(ln, 9)} as string), {ln}, '0')"
        parts.append(f"rpad({e}, {ln}, ' ')")
        cur = pos + ln
    return "select " + " || ".join(parts) + " as value from {customer}"


VIEWS["pns2013"] = _survey_line_view("2013")
VIEWS["pns2019"] = _survey_line_view("2019")
VIEWS["siscan_mat"] = """select 'V' || cast(user_id % 5 as string) as VISAO, cast(2013 + day(ts) % 14 as string) as ANO,
  cast(user_id as string) as linha,
  cast(sum(case when event_type = 'click' then 1 else 0 end) as string) as click,
  cast(sum(case when event_type = 'view' then 1 else 0 end) as string) || ',00' as view_,
  cast(count(*) as string) as Total
from {events} group by 1, 2, 3"""
VIEWS["siscan_views"] = """select 'V' || cast(r_regionkey as string) as VISAO, case r_regionkey when 0 then '2024-01'
  when 1 then 'Desconhecida' when 2 then '2024-02' when 3 then '2024-03' else '2024-04' end as DATA from {region}"""
VIEWS["siscan_manifest"] = """select 'V' || cast(r_regionkey as string) as chave, case r_regionkey when 0 then '2024-01'
  when 2 then '2023-12' else '2024-03' end as assinatura from {region} where r_regionkey in (0, 2, 3)"""
VIEWS["siscan_pub"] = """select VISAO, 'antigo' as EXAME, cast(null as string) as PERFIL, 'Linha' as DIMENSAO_LINHA,
  linha as CATEGORIA_LINHA, 'Coluna' as DIMENSAO_COLUNA, 'click' as CATEGORIA_COLUNA, 'Exames' as MEDIDA,
  cast(1000 as bigint) as QTD, ANO from {siscan_mat}"""

# ten screening views and an unknown one: a matrix for each measure and year
VIEWS["siscan_cube"] = """select case l_partkey % 6 when 0 then 'cito_colo' when 1 then 'histo_colo' when 2 then 'mamografia' when 3 then 'cito_mama'
    when 4 then 'histo_mama' else 'outra' end || case when l_suppkey % 2 = 0 then '_residencia' else '_atendimento' end as VISAO,
  case l_linenumber % 6 when 0 then 'Exames' when 1 then 'ASC-US' when 2 then 'Neo. NIC I' when 3 then 'Nódulo_Resul' when 4 then 'Lesão benigna'
    else 'Inexistente' end as MEDIDA, cast(2013 + l_orderkey % 14 as string) as ANO,
  case when l_suppkey % 9 = 0 then 'Total' else cast(11 + l_suppkey % 9 as string) || ' UF' end as linha,
  cast(sum(case when l_returnflag = 'A' then 1 else 0 end) as string) as antes, cast(count(*) * 1000 as string) || ',00' as depois,
  '7' as Total from {lineitem} group by 1, 2, 3, 4"""
VIEWS["siscan_dates"] = """select case n_nationkey % 5 when 0 then 'cito_colo' when 1 then 'histo_colo' when 2 then 'mamografia' when 3 then 'cito_mama'
    else 'histo_mama' end || case when n_nationkey < 5 then '_residencia' else '_atendimento' end as VISAO,
  case when n_nationkey % 4 = 3 then 'Desconhecida' else '2024-0' || cast(1 + n_nationkey as string) end as DATA from {nation} where n_nationkey < 10"""
VIEWS["siscan_seen"] = """select upper(VISAO) as chave, case when VISAO like 'cito_colo%' then DATA else 'antes' end as assinatura
from {siscan_dates} where VISAO not like '%mama_residencia'"""
VIEWS["siscan_old"] = """select distinct VISAO, 'antigo' as EXAME, cast(null as string) as PERFIL, 'Linha' as DIMENSAO_LINHA, linha as CATEGORIA_LINHA,
  'Coluna' as DIMENSAO_COLUNA, 'antes' as CATEGORIA_COLUNA, MEDIDA, cast(1000 as bigint) as QTD, ANO from {siscan_cube}"""

VIEWS["raw_cid10"] = """select 'C' || lpad(cast(p_partkey % 1000 as string), 3, '0') as CID10,
  'C' || lpad(cast(p_partkey % 1000 as string), 3, '0') || '  ' || p_name || ' ' as DESCR, p_partkey as ordem from {part}"""
VIEWS["raw_cid9"] = """select cast(100 + p_size * 3 as string) as CAUSAS, cast(100 + p_size * 3 as string) || ' ' || p_type as DESCRICAO,
  p_partkey as ordem from {part}"""
VIEWS["raw_cbo2002"] = """select case when p_partkey % 13 = 0 then ' ' else lpad(cast(p_size as string), 3, '0') || '00' end as CODIGO,
  'CBO ' || p_brand as DESCRICAO, p_partkey as ordem from {part}"""
VIEWS["raw_tabocup"] = "select cast(p_size as string) as CODIGO, ' OCUP ' || p_type as DESCRICAO, p_partkey as ordem from {part}"
VIEWS["raw_tabpais"] = """select cast(n_nationkey % 20 as string) as CODIGO, ' ' || n_name || ' ' as DESCRICAO, n_nationkey as ordem
from {nation}"""
VIEWS["raw_tabuf"] = """select lpad(cast(n_nationkey % 22 as string), 2, '0') as CODIGO, n_name || ' ' as DESCRICAO,
  substr(n_name, 1, 2) as SIGLA_UF, n_nationkey as ordem from {nation}"""


def _deps(name: str) -> list[str]:
    import string

    return [f for _, f, _, _ in string.Formatter().parse(VIEWS[name]) if f]


def _ordered(names) -> list[str]:
    """Views needed by ``names`` (dependencies first), base tables excluded."""
    out: list[str] = []

    def visit(n):
        if n in BASE_TABLES or n in out:
            return
        for d in _deps(n):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(views, body: str) -> str:
    """DuckDB oracle: one statement, the binding views as a WITH prefix."""
    names = _ordered(views)
    if not names:
        return body
    ctes = ",\n".join(
        f"{n} AS (\n{VIEWS[n].format(**{d: d for d in _deps(n)})}\n)" for n in names
    )
    stripped = body.lstrip()
    if stripped[:5].lower() == "with ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"


class Tables:
    """Driver tables and binding views of one scale-factor folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        from .session import tune

        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        tune(spark)
        self._cache: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                df = self.spark.sql(VIEWS[name], **{d: self(d) for d in _deps(name)})
            self._cache[name] = df
        return self._cache[name]

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"


@lru_cache(maxsize=None)
def view_names() -> tuple[str, ...]:
    return tuple(VIEWS)
