"""Named curation flows over source-shaped binding views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.domains import MORTALITY_MODERN, MORTALITY_OLD
from ..plans import mortality as MO
from . import sqlbits as S
from .registry import query


def _refs(t, old=False):
    causes = t("ref_cid9") if old else t("ref_icd")
    return MO.References(causes=causes, occupations=t("ref_ocup"), states=t("ref_uf"), countries=t("ref_pais"),
                         synonyms=t("ref_sinonimos"))


def _landed(t, view):
    """The source layout names its birthplace field NATURAL (a reserved word
    in the oracle's SQL, so the binding view calls it NATUR)."""
    return t(view).withColumnRenamed("NATUR", "NATURAL")


def _nt(c):
    return f"(case when {c} in ('nan', 'NaN', 'NaT', 'None', '', '<NA>') then null else {c} end)"


def _dec(c, dom):
    return f"coalesce({S.lookup(dom, f'trim({c})')}, 'Ignorado')"


def _age(c):
    unit = f"substr(trim({c}), 1, 1)"
    val = S.int_text(f"substr(trim({c}), 2)")
    raw = (f"(case when {unit} = '4' then {val} when {unit} = '5' then {val} + 100 "
           f"when {unit} in ('0', '1', '2', '3') then 0 end)")
    return f"case when {raw} between 0 and 120 then {raw} end"


def _muni(c):
    return f"(case when length(trim({c})) >= 7 then substr(trim({c}), 1, 6) else nullif(trim({c}), '') end)"


def _labels(cause_key):
    return f"""left join ref_icd_x rc on {cause_key} = rc.codigo
left join ref_ocup ro on b.OCUP = ro.codigo
left join ref_uf ru on substr(b.NAT, 1, 1) = '8' and substr(b.NAT, 2, 2) = ru.codigo
left join ref_pais rp on substr(b.NAT, 1, 1) <> '8' and b.NAT = rp.codigo
left join ref_sin rs on {_muni('b.MUNI')} = rs.antigo"""


def _modern(c):
    return _dec(f'b.{c}', MORTALITY_MODERN[c]) if c in MORTALITY_MODERN else f'b.{c}'


MODERN_SQL = f"""with l as (select {', '.join(f'{_nt(c)} as {c}' for c in ['CONTADOR', 'CAUSABAS', 'IDADE', 'DTOBITO', 'CODMUNRES', 'SEXO', 'NATUR', 'OCUP', 'RACACOR', 'ESTCIV', 'ESCFALAGR1', 'LOCOCOR', 'ASSISTMED', 'OBITOGRAV', 'OBITOPUERP', 'DTNASC', 'ETNIA', 'CODMUNOCOR', 'TIPOBITO', 'EXAME', 'CIRURGIA', 'NECROPSIA', 'ATESTANTE', 'ARQUIVO_ORIGEM'])} from sim_do),
b as (select *, NATUR as NAT, CODMUNRES as MUNI from l where {S.f1('CAUSABAS')}),
ref_icd_x as (select * from ref_icd)
select b.CONTADOR as ID_REGISTRO, b.CAUSABAS as CAUSA_BASICA, rc.descricao as CAUSA_BASICA_DESCRICAO,
  case when length(trim(b.DTOBITO)) = 8 and regexp_matches(substr(trim(b.DTOBITO), 5, 4), '^[0-9]{{4}}$')
    then cast(substr(trim(b.DTOBITO), 5, 4) as integer) end as ANO_OBITO,
  b.DTOBITO as DATA_OBITO, {_age('b.IDADE')} as IDADE_ANOS,
  {_dec('b.SEXO', MORTALITY_MODERN['SEXO'])} as SEXO, {_dec('b.RACACOR', MORTALITY_MODERN['RACACOR'])} as RACA_COR,
  {_dec('b.ESTCIV', MORTALITY_MODERN['ESTCIV'])} as ESTADO_CIVIL,
  {_dec('b.ESCFALAGR1', MORTALITY_MODERN['ESCFALAGR1'])} as ESCOLARIDADE,
  case when ro.descricao is not null then b.OCUP || ' - ' || ro.descricao else b.OCUP end as OCUPACAO,
  case when substr(b.NAT, 1, 1) = '8' then ru.descricao else rp.descricao end as NATURALIDADE,
  {_muni('b.MUNI')} as COD_MUNICIPIO_RESIDENCIA, coalesce(rs.atual, {_muni('b.MUNI')}) as COD_MUNICIPIO_RESIDENCIA_ATUAL,
  {_dec('b.LOCOCOR', MORTALITY_MODERN['LOCOCOR'])} as LOCAL_OCORRENCIA,
  {_dec('b.ASSISTMED', MORTALITY_MODERN['ASSISTMED'])} as ASSISTENCIA_MEDICA,
  {_dec('b.OBITOGRAV', MORTALITY_MODERN['OBITOGRAV'])} as OBITO_NA_GRAVIDEZ,
  {_modern('OBITOPUERP')} as OBITO_NO_PUERPERIO, {_modern('DTNASC')} as DATA_NASCIMENTO, {_modern('ETNIA')} as ETNIA_INDIGENA,
  {_modern('CODMUNOCOR')} as COD_MUNICIPIO_OCORRENCIA, {_modern('TIPOBITO')} as TIPO_OBITO, {_modern('EXAME')} as TEVE_EXAME,
  {_modern('CIRURGIA')} as TEVE_CIRURGIA, {_modern('NECROPSIA')} as TEVE_NECROPSIA, {_modern('ATESTANTE')} as MEDICO_ATESTANTE,
  b.ARQUIVO_ORIGEM
from b {_labels("replace(b.CAUSABAS, '.', '')")}"""


@query("curate_mortality_modern", MODERN_SQL, ["sim_do", "ref_icd", "ref_ocup", "ref_uf", "ref_pais", "ref_sin"])
def curate_mortality_modern(t):
    """Death records 1996+: landing tokens, F1, decode, age/year/municipality,
    column policy, synonyms, readable names, label lookups."""
    return MO.curate_death_records(_landed(t, "sim_do"), "modern", _refs(t))


def _old(c):
    return _dec(f'b.{c}', MORTALITY_OLD[c]) if c in MORTALITY_OLD else f'b.{c}'


OLD_SQL = f"""with l as (select {', '.join(f'{_nt(c)} as {c}' for c in ['contador', 'CAUSABAS', 'IDADE', 'DATAOBITO', 'MUNIRES', 'SEXO', 'NATUR', 'OCUPACAO', 'INSTRUCAO', 'ESTCIVIL', 'MUNIOCOR', 'LOCOCOR', 'TIPOBITO', 'ASSISTMED', 'EXAME', 'CIRURGIA', 'NECROPSIA', 'ATESTANTE', 'ARQUIVO_ORIGEM'])} from sim_do_old),
b as (select *, NATUR as NAT, OCUPACAO as OCUP, MUNIRES as MUNI from l where {S.f3('CAUSABAS')}),
ref_icd_x as (select * from ref_cid9)
select b.contador as ID_REGISTRO, b.CAUSABAS as CAUSA_BASICA, rc.descricao as CAUSA_BASICA_DESCRICAO,
  case when regexp_matches(trim(b.DATAOBITO), '^[0-9]{{2}}') then cast(substr(trim(b.DATAOBITO), 1, 2) as integer) + 1900 end as ANO_OBITO,
  b.DATAOBITO as DATA_OBITO, {_age('b.IDADE')} as IDADE_ANOS,
  {_dec('b.SEXO', MORTALITY_OLD['SEXO'])} as SEXO, {_old('ESTCIVIL')} as ESTADO_CIVIL,
  {_dec('b.INSTRUCAO', MORTALITY_OLD['INSTRUCAO'])} as ESCOLARIDADE, {_old('MUNIOCOR')} as COD_MUNICIPIO_OCORRENCIA,
  {_old('LOCOCOR')} as LOCAL_OCORRENCIA, {_old('TIPOBITO')} as TIPO_OBITO, {_old('ASSISTMED')} as ASSISTENCIA_MEDICA,
  {_old('EXAME')} as TEVE_EXAME, {_old('CIRURGIA')} as TEVE_CIRURGIA, {_old('NECROPSIA')} as TEVE_NECROPSIA,
  {_old('ATESTANTE')} as MEDICO_ATESTANTE,
  case when ro.descricao is not null then b.OCUP || ' - ' || ro.descricao else b.OCUP end as OCUPACAO,
  case when substr(b.NAT, 1, 1) = '8' then ru.descricao else rp.descricao end as NATURALIDADE,
  {_muni('b.MUNI')} as COD_MUNICIPIO_RESIDENCIA, coalesce(rs.atual, {_muni('b.MUNI')}) as COD_MUNICIPIO_RESIDENCIA_ATUAL,
  b.ARQUIVO_ORIGEM
from b {_labels("substr(b.CAUSABAS, 1, 3)")}"""


@query("curate_mortality_old", OLD_SQL, ["sim_do_old", "ref_cid9", "ref_ocup", "ref_uf", "ref_pais", "ref_sin"])
def curate_mortality_old(t):
    """Death records 1979-95: candidate cause column, F3, old-era domains,
    AAMMDD year, raw columns of the era dropped, label by 3-char prefix."""
    return MO.curate_death_records(_landed(t, "sim_do_old"), "old", _refs(t, old=True))


@query("curate_mortality_prelim", MODERN_SQL.replace("from sim_do)", "from sim_do where CONTADOR is not null)"),
       ["sim_do", "ref_icd", "ref_ocup", "ref_uf", "ref_pais", "ref_sin"])
def curate_mortality_prelim(t):
    """Preliminary deaths: the modern flow when files arrived."""
    return MO.curate_preliminary(t.spark, _landed(t, "sim_do"), _refs(t), None, _landed(t, "sim_do"))


def _yr_old(c):
    d = f"regexp_extract({c}, '(?i)DORBR([0-9]{{2,4}})\\.dbc', 1)"
    return (f"case when length({d}) = 2 then case when cast({d} as integer) >= 79 then cast({d} as integer) + 1900 "
            f"else cast({d} as integer) + 2000 end when {d} <> '' then cast({d} as integer) end")


def _era_sql(view, pred, source, year):
    return f"""select {year} as ANO, '{source}' as FONTE, ARQUIVO_ORIGEM as ARQUIVO,
  count(*) as TOTAL_OBITOS_GERAL, count(*) filter (where {pred}) as TOTAL_OBITOS_CANCER,
  round(cast(count(*) filter (where {pred}) as double) / count(*), 4) as PROPORCAO_OBITOS_CANCER,
  cast(null as varchar) as ERRO from {view} group by ARQUIVO_ORIGEM"""


SUMMARY_FLOW_SQL = f"""with n as (
  {_era_sql("(select * from sim_do where cast(substr(ARQUIVO_ORIGEM, 5, 4) as integer) < 2001)", S.f1(_nt('CAUSABAS')), 'CID10',
            "cast(nullif(regexp_extract(ARQUIVO_ORIGEM, '(?i)DOBR([0-9]{4})\\.dbc', 1), '') as integer)")}
  union all
  {_era_sql("(select * from sim_do where cast(substr(ARQUIVO_ORIGEM, 5, 4) as integer) >= 2000)", S.f1(_nt('CAUSABAS')), 'PRELIM',
            "cast(nullif(regexp_extract(ARQUIVO_ORIGEM, '(?i)DOBR([0-9]{4})\\.dbc', 1), '') as integer)")}
  union all
  {_era_sql('sim_do_old', S.f3(_nt('CAUSABAS')), 'CID9', _yr_old('ARQUIVO_ORIGEM'))}),
p as (select *, case FONTE when 'CID10' then 1 when 'PRELIM' then 2 when 'CID9' then 3 else 4 end as r from n),
best as (select ANO, min(r) as r from p group by ANO)
select p.ANO, FONTE, ARQUIVO, TOTAL_OBITOS_GERAL, TOTAL_OBITOS_CANCER, PROPORCAO_OBITOS_CANCER, ERRO
from p join best on p.ANO = best.ANO and p.r = best.r"""


@query("curate_annual_summary", SUMMARY_FLOW_SQL, ["sim_do", "sim_do_old"])
def curate_annual_summary(t):
    """Three eras -> per-file totals, kept, ratio; upsert by year with
    precedence consolidated > preliminary > old era."""
    modern = t("sim_do")
    year = F.substring("ARQUIVO_ORIGEM", 5, 4).cast("int")
    return MO.annual_summary(None, [(modern.filter(year < 2001), "CID10", "modern"),
                                    (modern.filter(year >= 2000), "PRELIM", "modern"),
                                    (t("sim_do_old"), "CID9", "old")])


# ---- panel, authorizations, work registry ----------------------------------------------------

from ..fixtures import VIEWS as _V  # noqa: E402
from ..plans import outpatient as OP  # noqa: E402
from ..plans import work as WK  # noqa: E402
from .spec_sql import spec_sql  # noqa: E402


def _cols(view):
    import re

    return re.findall(r" as ([A-Z_][A-Z0-9_]*)", _V[view])


_REFS = {"causes": "ref_cid10", "occupations": "ref_cbo"}


@query("curate_panel", spec_sql(OP.PANEL, "painel", _cols("painel"), _REFS), ["painel", "ref_cid10"])
def curate_panel(t):
    """Panel cases: topography label, decode pairs (zero-tolerant category),
    sentinel age, renames; the patient card never selected."""
    return OP.curate_panel(t("painel"), t("ref_cid10"))


@query("curate_chemo", spec_sql(OP.CHEMO, "apac_aq", _cols("apac_aq"), _REFS, landing=True), ["apac_aq", "ref_cid10"])
def curate_chemo(t):
    """Chemotherapy authorizations: header block, oncology block, scheme."""
    return OP.curate_chemo(t("apac_aq"), t("ref_cid10"))


@query("curate_radio", spec_sql(OP.RADIO, "apac_ar", _cols("apac_ar"), _REFS, landing=True), ["apac_ar", "ref_cid10"])
def curate_radio(t):
    """Radiotherapy authorizations: header, oncology block, purpose."""
    return OP.curate_radio(t("apac_ar"), t("ref_cid10"))


@query("curate_drugs", spec_sql(OP.DRUGS, "apac_am", _cols("apac_am"), _REFS, where=S.f4("b.AP_CIDPRI"), landing=True),
       ["apac_am", "ref_cid10"])
def curate_drugs(t):
    """Drug authorizations: F4 on the main diagnosis, header, weight/height."""
    return OP.curate_drugs(t("apac_am"), t("ref_cid10"))


@query("curate_work_cancer", spec_sql(WK.WORK, "sinan", _cols("sinan"), _REFS), ["sinan", "ref_cid10", "ref_cbo"])
def curate_work_cancer(t):
    """Work-related cancer: strict age, decode pairs, 16 exposure flags,
    diagnosis and occupation labels."""
    return WK.curate_work_cancer(t("sinan"), t("ref_cid10"), t("ref_cbo"))


# ---- facilities, grants, geography ---------------------------------------------------------

from ..functions.domains import ONCO_QUALIFICATIONS, UNIT_TYPE  # noqa: E402
from ..operators import filters as FL  # noqa: E402
from ..plans import facilities as FA  # noqa: E402
from ..plans import geography as GE  # noqa: E402
from .filtering import DOC_KEYWORDS  # noqa: E402

_QL = {k: v[0] for k, v in ONCO_QUALIFICATIONS.items()}
_QP = [k for k, v in ONCO_QUALIFICATIONS.items() if v[1]]


def _label_sql(c):
    return f"coalesce({S.lookup(_QL, S.norm4(c))}, 'Código ' || trim({c}) || ' (não catalogado)')"


def _flag_sql(c):
    return (f"case when upper(trim({c})) in ('1', '1.0', 'S', 'SIM', 'TRUE', 'T') then 'Sim' "
            f"when upper(trim({c})) in ('0', '0.0', 'N', 'NAO', 'NÃO', 'FALSE', 'F') then 'Não' end")


FACILITIES_SQL = f"""with inst as (
  select coalesce({S.pad('trim(cnes)', 7)}, '') as CNES,
    bool_or({S.norm4('sgruphab')} in ({', '.join(S.q(x) for x in _QP)})) as TEM_ONCOLOGIA_PEDIATRICA,
    count(*) as QTD_HABILITACOES_ONCOLOGIA,
    string_agg(distinct {_label_sql('sgruphab')}, '; ' order by {_label_sql('sgruphab')}) as HABILITACOES_ONCOLOGIA,
    coalesce(string_agg(distinct case when not {S.blank('portaria')} then portaria end, '; '
      order by case when not {S.blank('portaria')} then portaria end), '') as PORTARIAS,
    min(dtportar) as DATA_PORTARIA_MAIS_ANTIGA
  from hab where {S.f5('sgruphab', list(ONCO_QUALIFICATIONS))} group by 1),
reg as (select * from (select *, row_number() over (partition by K order by NU_CNPJ nulls first) as rn
  from (select *, coalesce({S.pad('trim(CO_CNES)', 7)}, '') as K from estab_reg) x) y where rn = 1),
beds as (select coalesce({S.pad('trim(cnes)', 7)}, '') as CNES,
  sum(case when regexp_matches(trim(qt_exist), '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$') then cast(trim(qt_exist) as double) end) as T
  from leitos group by 1)
select i.CNES as COD_CNES, r.NO_RAZAO_SOCIAL as RAZAO_SOCIAL, r.NO_FANTASIA as NOME_FANTASIA, r.NU_CNPJ as CNPJ,
  r.NU_CNPJ_MANTENEDORA as CNPJ_MANTENEDORA, i.HABILITACOES_ONCOLOGIA, i.QTD_HABILITACOES_ONCOLOGIA,
  i.TEM_ONCOLOGIA_PEDIATRICA, i.PORTARIAS, i.DATA_PORTARIA_MAIS_ANTIGA, r.TP_UNIDADE as COD_TIPO_UNIDADE,
  coalesce({S.lookup(UNIT_TYPE, S.pad('trim(r.TP_UNIDADE)', 2))}, {S.pad('trim(r.TP_UNIDADE)', 2)}) as TIPO_UNIDADE,
  cast(round_even(b.T, 0) as bigint) as TOTAL_LEITOS_CNES,
  {_flag_sql('r.ST_CENTRO_CIRURGICO')} as TEM_CENTRO_CIRURGICO,
  {_flag_sql('r.ST_ATEND_HOSPITALAR')} as TEM_ATENDIMENTO_HOSPITALAR,
  {_flag_sql('r.ST_CENTRO_OBSTETRICO')} as TEM_CENTRO_OBSTETRICO, {_flag_sql('r.ST_CENTRO_NEONATAL')} as TEM_CENTRO_NEONATAL,
  {_flag_sql('r.ST_SERVICO_APOIO')} as TEM_SERVICO_APOIO, {_flag_sql('r.ST_ATEND_AMBULATORIAL')} as TEM_ATENDIMENTO_AMBULATORIAL,
  r.CO_CEP as CEP, r.NU_ENDERECO as NUMERO_ENDERECO, r.NO_BAIRRO as BAIRRO, r.NU_LONGITUDE as LONGITUDE, r.NU_TELEFONE as TELEFONE,
  r.NO_EMAIL as EMAIL, r.CO_NATUREZA_JUR as COD_NATUREZA_JURIDICA, r.CO_ESFERA_ADMINISTRATIVA as COD_ESFERA_ADMINISTRATIVA,
  r.DS_ESFERA_ADMINISTRATIVA as ESFERA_ADMINISTRATIVA,
  r.CO_IBGE as COD_MUNICIPIO, r.CO_UF as COD_UF, r.NO_LOGRADOURO as LOGRADOURO, r.NU_LATITUDE as LATITUDE,
  r.K is not null as ENCONTRADO_NO_CNES
from inst i left join reg r on i.CNES = r.K left join beds b on i.CNES = b.CNES"""


def _facilities(t):
    return FA.curate_facilities(t("hab"), t("estab_reg"), t("leitos"))


def _published_facilities(t):
    """The facilities table as later flows read it: a lazy part of their plan."""
    return _facilities(t)


@query("curate_facilities", FACILITIES_SQL, ["hab", "estab_reg", "leitos"])
def curate_facilities(t):
    """Qualifications (F5, A1) + registry (J6) + beds (A2, J8); unit type,
    yes/no flags, preferred order."""
    return _facilities(t)


_KW = DOC_KEYWORDS + FL.GRANT_KEYWORDS
_EK = "case when not (CNPJ is null or trim(CNPJ) = '') then CNPJ else CNPJ_MANTENEDORA end"


def _first(c):
    return f"arg_min({c}, COD_CNES) filter (where {c} is not null)"


# The other columns of the grants export, as its header names them.
_GRANT_NUMBER = "NÚMERO CONVÊNIO"
_GRANT_COLUMNS = dict(zip((f"c{k}" for k in range(2, 26)), (
    "UF", "CÓDIGO SIAFI MUNICÍPIO", "NOME MUNICÍPIO", "SITUAÇÃO CONVÊNIO", "NÚMERO ORIGINAL", "NÚMERO PROCESSO DO CONVÊNIO",
    "CÓDIGO ÓRGÃO SUPERIOR", "NOME ÓRGÃO SUPERIOR", "CÓDIGO ÓRGÃO CONCEDENTE", "NOME ÓRGÃO CONCEDENTE", "CÓDIGO UG CONCEDENTE",
    "NOME UG CONCEDENTE", "TIPO CONVENENTE", "NOME CONVENENTE", "TIPO ENTE CONVENENTE", "TIPO INSTRUMENTO", "VALOR CONVÊNIO",
    "VALOR LIBERADO", "DATA PUBLICAÇÃO", "DATA INÍCIO VIGÊNCIA", "DATA FINAL VIGÊNCIA", "VALOR CONTRAPARTIDA", "DATA ÚLTIMA LIBERAÇÃO",
    "VALOR ÚLTIMA LIBERAÇÃO")))
GRANTS_SQL = f"""with fac as ({FACILITIES_SQL}),
k as (select {_EK} as KEY, bool_or(TEM_ONCOLOGIA_PEDIATRICA) as CNES_TEM_ONCOLOGIA_PEDIATRICA,
  {_first('NOME_FANTASIA')} as CNES_NOME_FANTASIA, {_first('RAZAO_SOCIAL')} as CNES_RAZAO_SOCIAL,
  string_agg(distinct HABILITACOES_ONCOLOGIA, '; ' order by HABILITACOES_ONCOLOGIA) as CNES_HABILITACOES,
  count(*) as CNES_QTD_UNIDADES_VINCULADAS, cast(sum(TOTAL_LEITOS_CNES) as bigint) as CNES_TOTAL_LEITOS,
  {_first('COD_UF')} as CNES_COD_UF, {_first('COD_MUNICIPIO')} as CNES_COD_MUNICIPIO,
  {_first('LOGRADOURO')} as CNES_LOGRADOURO, {_first('LATITUDE')} as CNES_LATITUDE, {_first('LONGITUDE')} as CNES_LONGITUDE,
  bool_or({S.blank('CNPJ')} and not {S.blank('CNPJ_MANTENEDORA')}) as CNES_VIA_CNPJ_MANTENEDORA
  from fac where not {S.blank(_EK)} group by 1),
g as (select num as "{_GRANT_NUMBER}", objeto as "{FA.GRANT_TEXT}", convenente as "{FA.GRANT_KEY}",
    {', '.join(f'{c} as "{n}"' for c, n in _GRANT_COLUMNS.items())} from convenios
  where regexp_matches(lower(objeto), '{FL.keyword_pattern(_KW).replace("'", "''")}'))
select g.*, k.* exclude (KEY), k.KEY is not null as HABILITADO_CNES_ONCOLOGIA
from g left join k on g."{FA.GRANT_KEY}" = k.KEY"""


@query("curate_grants", GRANTS_SQL, ["hab", "estab_reg", "leitos", "convenios"])
def curate_grants(t):
    """Grants: keyword filter over whole texts, then the published facilities
    rolled up by effective registry key (own, else parent) and joined."""
    g = t("convenios").select(F.col("num").alias(_GRANT_NUMBER), F.col("objeto").alias(FA.GRANT_TEXT),
                              F.col("convenente").alias(FA.GRANT_KEY), *[F.col(c).alias(n) for c, n in _GRANT_COLUMNS.items()])
    return FA.curate_grants(g, _published_facilities(t), _KW)


GEO_SQL = f"""with m as (select {S.pad('cod_municipio', 6)} as COD_MUNICIPIO, cod_macro as COD_MACRORREGIAO_DE_SAUDE,
  macro as MACRORREGIAO_DE_SAUDE, no_municipio as NOME_MUNICIPIO, populacao as POPULACAO_IBGE_2022, co_regiao as CO_REGIAO_PAIS,
  regiao as REGIAO_PAIS, co_uf as CO_UF, sg_uf as SG_UF, uf as UF, cod_saude as COD_REGIAO_DE_SAUDE, saude as REGIAO_DE_SAUDE from geo_saude),
g as (select * from (select *, row_number() over (partition by M6 order by LATITUDE, LONGITUDE, AREA, ALTITUDE, MUNCODDV) as rn
  from (select {S.pad('MUNCOD', 6)} as M6, LATITUDE, LONGITUDE, AREA, ALTITUDE, MUNCODDV from geo_xls) x) y where rn = 1),
c as (select * from (select *, row_number() over (partition by M6 order by SITUACAO, CAPITAL, MESOCOD, MICROCOD) as rn
  from (select {S.pad('MUNCOD', 6)} as M6, SITUACAO, CAPITAL, MESOCOD, MICROCOD from cadmun_full) x) y where rn = 1)
select m.*, g.LATITUDE, g.LONGITUDE, g.ALTITUDE, g.MUNCODDV, g.AREA as AREA_KM2, c.SITUACAO as SITUACAO_MUNICIPIO, c.CAPITAL as EH_CAPITAL,
  c.MESOCOD as COD_MESORREGIAO, c.MICROCOD as COD_MICRORREGIAO
from m left join g on m.COD_MUNICIPIO = g.M6 left join c on m.COD_MUNICIPIO = c.M6"""

# Source headers as delivered (accents, spaces, BOM): normalised by the flow.
_GEO_HEADERS = {"cod_municipio": "cod_municipio", "cod_macro": "COD_MACRORREGIÃO_DE_SAÚDE",
                "macro": " macrorregião_de_saúde", "no_municipio": "﻿NO_MUNICÍPIO", "populacao": "POPULAÇÃO_IBGE_2022",
                "co_regiao": "CO_REGIÃO_PAÍS", "regiao": "Região_País", "co_uf": "co_uf", "sg_uf": "SG_UF ", "uf": "Uf",
                "cod_saude": "cod_região_de_saúde", "saude": "REGIÃO_DE_SAÚDE"}


@query("curate_geography", GEO_SQL, ["geo_saude", "geo_xls", "cadmun_full"])
def curate_geography(t):
    """Three references joined on the padded municipality code (each made
    key-unique), headers normalised, harmonic order."""
    health = t("geo_saude").select(*[F.col(k).alias(v) for k, v in _GEO_HEADERS.items()])
    return GE.curate_geography(health, t("geo_xls"), t("cadmun_full"))


@query("curate_municipal_synonyms", f"""with {'''parts as (
  select MUNCOD as muncod, SITUACAO as situacao, trim(p) as part, pos - 1 as pos from (
    select MUNCOD, SITUACAO, unnest(string_split(coalesce(MUNSINON, ''), ',')) as p,
           generate_subscripts(string_split(coalesce(MUNSINON, ''), ','), 1) as pos from cadmun_full) x),
ok as (select muncod, pos, case when length(part) < 6 then lpad(part, 6, '0') else substr(part, 1, 6) end as codigo
  from parts where regexp_matches(part, '^[0-9]+$') and upper(trim(situacao)) = 'ATIVO'
  and muncod <> '000000' and not ends_with(muncod, '9999'))'''}
select codigo as COD_MUNICIPIO_ANTIGO, muncod as COD_MUNICIPIO_ATUAL from (
  select *, row_number() over (partition by codigo order by muncod desc, pos desc) as rn from ok
  where codigo <> muncod and codigo <> '000000' and not ends_with(codigo, '9999')) z where rn = 1""",
       ["cadmun_full"])
def curate_municipal_synonyms(t):
    """R3 published beside the geography: old code -> current code."""
    return GE.municipal_synonyms(t("cadmun_full"), "MUNCOD")


# ---- surveys, screening, code references, static ------------------------------------------

from ..operators import merge as MG  # noqa: E402
from ..plans import references as RF  # noqa: E402
from ..plans import screening as SC  # noqa: E402
from ..plans import surveys as SV  # noqa: E402
from ..session import staging_path  # noqa: E402


def _survey_sql(sv, view):
    def cut(p, n):
        return f"trim(substr(value, {p}, {n}))"

    cols = []
    for name, p, n in sv.layout:
        v = cut(p, n)
        dom = sv.domains.get(name) or (SV.RACE if name == "COR_RACA" else None)
        if dom is not None:
            v = f"case when {v} = '' then '' else coalesce({S.lookup(dom, v)}, {v}) end"
        elif name in SV.AGE_FIELDS:
            v = S.int_text(v)
        cols.append(f"{v} as {SV.SURVEY_NAMES.get(name, name)}")
    cols += [f"'{v}' as {k}" for k, v in sv.constants.items()]
    preds = [f"{cut(p, n)} = '{val}'" for p, n, val in sv.equals] + [f"{cut(p, n)} <> ''" for p, n in sv.answered]
    return f"select {', '.join(cols)} from {view} where {' and '.join(preds)}"


def _survey_lines(t, view):
    """The lines, built in all tasks: the customers of a line each are a small
    file, which one task would read, their lines are 150 times that."""
    parts = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return t.spark.sql(_V[view], customer=t("customer").repartition(parts))


def _survey_query(key):
    edition = key.rsplit("_", 1)[1]
    view = f"pns{edition}"
    sv = SV.SURVEYS[key]

    def run(t):
        return SV.curate_survey(_survey_lines(t, view), sv)

    run.__doc__ = f"Survey extract {key}: position filter, layout, decode, ages, order."
    query(f"curate_survey_{key}", _survey_sql(sv, view), [view])(run)


for _k in SV.SURVEYS:
    _survey_query(_k)

_SC_TAGS = {"EXAME": "eventos", "PERFIL": "usuarios", "DIMENSAO_LINHA": "Usuário", "DIMENSAO_COLUNA": "Tipo",
            "MEDIDA": "Quantidade"}


def _sc_unpivot(col):
    x = f"replace(replace(trim({col}), '.', ''), ',', '.')"
    q = (f"cast(trunc(coalesce(case when regexp_matches({x}, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$') "
         f"then cast({x} as double) end, 0)) as bigint)")
    return (f"select VISAO, '{_SC_TAGS['EXAME']}' as EXAME, '{_SC_TAGS['PERFIL']}' as PERFIL, "
            f"'{_SC_TAGS['DIMENSAO_LINHA']}' as DIMENSAO_LINHA, trim(linha) as CATEGORIA_LINHA, "
            f"'{_SC_TAGS['DIMENSAO_COLUNA']}' as DIMENSAO_COLUNA, '{col}' as CATEGORIA_COLUNA, "
            f"'{_SC_TAGS['MEDIDA']}' as MEDIDA, {q} as QTD, ANO from todo")


SCREENING_SQL = f"""with ch as (select v.VISAO, v.DATA from siscan_views v left join siscan_manifest m on upper(v.VISAO) = m.chave
  where not coalesce(v.DATA is not null and v.DATA is not distinct from m.assinatura, false) or v.DATA = 'Desconhecida'),
plan as (select ch.VISAO, cast(y.a as varchar) as ANO from ch, range(2013, 2027) y(a)
  where ch.VISAO not in (select chave from siscan_manifest) or y.a >= 2025),
todo as (select * from siscan_mat m where exists (select 1 from plan p where p.VISAO = m.VISAO and p.ANO = m.ANO)
  and not coalesce(lower(trim(linha)) in ('total', ''), false)),
new as (select * from ({_sc_unpivot('click')} union all {_sc_unpivot('view_')}) u where QTD > 0)
select * from siscan_pub p where not exists (select 1 from plan k, siscan_mat m where k.VISAO = p.VISAO and k.ANO = p.ANO
  and m.VISAO = k.VISAO and m.ANO = k.ANO and k.VISAO in (select VISAO from new))
union all select * from new"""


@query("curate_screening", SCREENING_SQL, ["siscan_mat", "siscan_views", "siscan_manifest", "siscan_pub"])
def curate_screening(t):
    """Per view: changed or unknown date (P9), years to take (P10), stacked
    matrices melted (R1), those years replaced in the published table (M2)."""
    return SC.curate_screening(t("siscan_mat"), t("siscan_pub"), t("siscan_views"), t("siscan_manifest"), 2026,
                               _SC_TAGS)


# written out here, apart from the flow's own definitions
SCREENING_VIEWS_SQL = """with v(VISAO, EXAME, medidas) as (values
  ('cito_colo', 'Colo do útero (citopatológico)', ['Exames', 'ASC-US']), ('histo_colo', 'Colo do útero (histopatológico)', ['Exames', 'Neo. NIC I']),
  ('mamografia', 'Mamografia', ['Exames', 'Nódulo_Resul']), ('cito_mama', 'Mama (citopatológico)', ['Exames']),
  ('histo_mama', 'Mama (histopatológico)', ['Exames', 'Lesão benigna'])),
d as (select v.VISAO || '_' || l as VISAO, EXAME, medidas, 'Por local de ' || case l when 'residencia' then 'residência' else l end as PERFIL,
  case l when 'residencia' then 'UF de residencia' else 'UF do prest.serviço' end as DIMENSAO_LINHA from v, (values ('residencia'), ('atendimento')) x(l)),
ch as (select t.VISAO, m.chave is null as nova from siscan_dates t left join siscan_seen m on upper(t.VISAO) = m.chave
  where t.DATA = 'Desconhecida' or m.assinatura is distinct from t.DATA),
todo as (select c.*, EXAME, PERFIL, DIMENSAO_LINHA from siscan_cube c join d on c.VISAO = d.VISAO and list_contains(medidas, c.MEDIDA)
  join ch on ch.VISAO = c.VISAO and (nova or c.ANO in ('2025', '2026'))),
u as (select VISAO, EXAME, PERFIL, DIMENSAO_LINHA, linha, 'antes' as col, cast(antes as bigint) as QTD, MEDIDA, ANO from todo
  union all select VISAO, EXAME, PERFIL, DIMENSAO_LINHA, linha, 'depois', cast(replace(depois, ',00', '') as bigint), MEDIDA, ANO from todo)
select VISAO, EXAME, PERFIL, DIMENSAO_LINHA, linha as CATEGORIA_LINHA, 'Ano competencia' as DIMENSAO_COLUNA, col as CATEGORIA_COLUNA, MEDIDA, QTD, ANO
from u where linha <> 'Total' and QTD > 0
union all select * from siscan_old o where not exists (select 1 from todo t where t.VISAO = o.VISAO and t.ANO = o.ANO)"""


@query("curate_screening_views", SCREENING_VIEWS_SQL, ["siscan_cube", "siscan_dates", "siscan_seen", "siscan_old"])
def curate_screening_views(t):
    """The ten views with their measures: exam, profile and dimensions follow
    the row's view; unknown views and measures are left out."""
    return SC.curate_views(t("siscan_cube"), t("siscan_old"), t("siscan_dates"), t("siscan_seen"), 2026, SC.view_definitions(t.spark))


def _dedupe_sql(select, key, order):
    return (f"select * exclude (rn) from (select *, row_number() over (partition by {key} order by {order}) as rn "
            f"from ({select}) x) y where rn = 1")


@query("curate_ref_causes", _dedupe_sql(
    "select CID10 as CODIGO, trim(regexp_replace(DESCR, '^\\S+\\s+', '')) as DESCRICAO, ordem from raw_cid10",
    "CODIGO", "ordem").replace("select * exclude (rn)", "select CODIGO, DESCRICAO"), ["raw_cid10"])
def curate_ref_causes(t):
    """Modern cause codes: label prefix stripped, first row per code."""
    return RF.causes(t("raw_cid10"), "CID10", "DESCR", "ordem")


@query("curate_ref_causes_old", _dedupe_sql(
    "select CAUSAS as CODIGO, trim(regexp_replace(DESCRICAO, '^[0-9]+\\s+', '')) as DESCRICAO, ordem from raw_cid9",
    "CODIGO", "ordem").replace("select * exclude (rn)", "select CODIGO, DESCRICAO"), ["raw_cid9"])
def curate_ref_causes_old(t):
    """Old-era cause codes: numeric prefix stripped, first row per code."""
    return RF.causes(t("raw_cid9"), "CAUSAS", "DESCRICAO", "ordem", prefix=r"^\d+\s+")


@query("curate_ref_occupations", f"""with o as (select {S.pad('CODIGO', 3)} as CODIGO, trim(DESCRICAO) as DESCRICAO, ordem from raw_tabocup),
u as (select trim(CODIGO) as CODIGO, trim(DESCRICAO) as DESCRICAO, ordem, 0 as p from raw_cbo2002
      where trim(CODIGO) <> '' and trim(DESCRICAO) <> ''
  union all select CODIGO, DESCRICAO, ordem, 1 from o union all select CODIGO || '00', DESCRICAO, ordem, 1 from o)
select CODIGO, DESCRICAO from (select *, row_number() over (partition by CODIGO order by p, ordem) as rn from u) x
where rn = 1""", ["raw_cbo2002", "raw_tabocup"])
def curate_ref_occupations(t):
    """Occupations: newer vocabulary wins; old codes as NNN and NNN00."""
    return RF.occupations(t("raw_cbo2002"), t("raw_tabocup"))


@query("curate_ref_countries", f"""select {S.pad('CODIGO', 3)} as CODIGO, trim(DESCRICAO) as DESCRICAO from (
  {_dedupe_sql('select CODIGO, DESCRICAO, ordem from raw_tabpais', 'CODIGO', 'ordem')}) z""", ["raw_tabpais"])
def curate_ref_countries(t):
    """Countries: first per code, code padded to 3."""
    return RF.countries(t("raw_tabpais"))


@query("curate_ref_states", f"""select CODIGO, trim(DESCRICAO) as DESCRICAO, SIGLA_UF from (
  {_dedupe_sql('select CODIGO, DESCRICAO, SIGLA_UF, ordem from raw_tabuf', 'CODIGO', 'ordem')}) z""", ["raw_tabuf"])
def curate_ref_states(t):
    """States: first per code, with the state abbreviation."""
    return RF.states(t("raw_tabuf"))


@query("curate_static", "select * from customer")
def curate_static(t):
    """Static snapshots published as they are (M7): write, then read back."""
    path = staging_path(t.spark, "snapshot")
    MG.publish(t("customer"), path)
    return t.spark.read.parquet(path)
