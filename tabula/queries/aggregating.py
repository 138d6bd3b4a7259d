"""Queries for A1-A8 (aggregations) on the binding views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.domains import ONCO_QUALIFICATIONS
from ..operators import filters as fl
from ..operators import rollups as ro
from ..plans import facilities as FA
from . import sqlbits as S
from .registry import query

QUAL_CODES = list(ONCO_QUALIFICATIONS)
QUAL_LABEL = {k: v[0] for k, v in ONCO_QUALIFICATIONS.items()}
QUAL_PAED = [k for k, v in ONCO_QUALIFICATIONS.items() if v[1]]


def _year_from_name(c):
    y = F.regexp_extract(c, r"(?i)DOBR(\d{4})\.dbc", 1)
    return F.when(y != "", y.cast("int"))


# --- A4 / A5 / A6: annual summary ------------------------------------------------

SUMMARY_SQL = f"""select cast(nullif(regexp_extract(arquivo_origem, '(?i)DOBR([0-9]{{4}})\\.dbc', 1), '') as integer) as ANO,
  'CID10' as FONTE, arquivo_origem as ARQUIVO,
  count(*) as TOTAL_OBITOS_GERAL,
  count(*) filter (where {S.f1('causabas')}) as TOTAL_OBITOS_CANCER,
  case when count(*) <> 0 then round(cast(count(*) filter (where {S.f1('causabas')}) as double) / count(*), 4) end as PROPORCAO_OBITOS_CANCER,
  cast(null as varchar) as ERRO
from rec group by arquivo_origem"""


def annual_summary_frame(rec, source: str = "CID10"):
    """Per source file: total rows, rows passing F1, ratio (A5 + A6)."""
    kv = ro.kept_vs_total(rec, "arquivo_origem", fl.icd10_onco("causabas"),
                          "TOTAL_OBITOS_GERAL", "TOTAL_OBITOS_CANCER")
    return kv.select(
        _year_from_name(F.col("arquivo_origem")).alias("ANO"),
        F.lit(source).alias("FONTE"),
        F.col("arquivo_origem").alias("ARQUIVO"),
        "TOTAL_OBITOS_GERAL", "TOTAL_OBITOS_CANCER",
        ro.ratio("TOTAL_OBITOS_CANCER", "TOTAL_OBITOS_GERAL").alias("PROPORCAO_OBITOS_CANCER"),
        F.lit(None).cast("string").alias("ERRO"),
    )


@query("annual_summary", SUMMARY_SQL, ["rec"])
def annual_summary(t):
    """F1 -> A5 -> A6 per source file (= per year): the flagship slice."""
    return annual_summary_frame(t("rec"))


@query("kept_vs_total", f"""select arquivo_origem as ARQUIVO_ORIGEM, count(*) as TOTAL,
  count(*) filter (where {S.f1('causabas')}) as MANTIDOS from rec group by arquivo_origem""", ["rec"])
def kept_vs_total(t):
    """A5: total and kept rows per file in one pass."""
    return ro.kept_vs_total(t("rec"), "arquivo_origem", fl.icd10_onco("causabas"), "TOTAL", "MANTIDOS") \
        .withColumnRenamed("arquivo_origem", "ARQUIVO_ORIGEM")


@query("count_by_file", f"""select arquivo_origem as ARQUIVO_ORIGEM, count(*) as N
from rec where {S.f1('causabas')} group by arquivo_origem""", ["rec"])
def count_by_file(t):
    """A4: rows per source file of the filtered table."""
    kept = fl.keep(t("rec"), fl.icd10_onco("causabas"))
    return ro.count_by(kept, "arquivo_origem", "N").withColumnRenamed("arquivo_origem", "ARQUIVO_ORIGEM")


# --- A2: beds per facility ----------------------------------------------------------

BEDS_SQL = f"""select coalesce({S.pad('trim(cnes)', 7)}, '') as CNES,
  cast(round(sum(case when regexp_matches(trim(qt_exist), '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$') then cast(trim(qt_exist) as double) end)) as bigint) as TOTAL_LEITOS_CNES
from leitos group by 1"""


@query("sum_all_null", BEDS_SQL, ["leitos"])
def sum_all_null(t):
    """A2: sum of valid values per key, null when every value is invalid."""
    return FA.beds_by_facility(t("leitos"))


# --- A1: facility rollup --------------------------------------------------------------

def _qual_label_sql(c):
    return f"coalesce({S.lookup(QUAL_LABEL, S.norm4(c))}, 'Código ' || trim({c}) || ' (não catalogado)')"


FACILITY_SQL = f"""select coalesce({S.pad('trim(cnes)', 7)}, '') as CNES,
  bool_or({S.norm4('sgruphab')} in ({', '.join(S.q(x) for x in QUAL_PAED)})) as TEM_ONCOLOGIA_PEDIATRICA,
  count(*) as QTD_HABILITACOES_ONCOLOGIA,
  string_agg(distinct {_qual_label_sql('sgruphab')}, '; ' order by {_qual_label_sql('sgruphab')}) as HABILITACOES_ONCOLOGIA,
  coalesce(string_agg(distinct case when not {S.blank('portaria')} then portaria end, '; ' order by case when not {S.blank('portaria')} then portaria end), '') as PORTARIAS,
  min(dtportar) as DATA_PORTARIA_MAIS_ANTIGA
from hab where {S.f5('sgruphab', QUAL_CODES)} group by 1"""


@query("facility_rollup", FACILITY_SQL, ["hab"])
def facility_rollup(t):
    """A1: any(paediatric), count, sorted distinct lists, text min."""
    return FA.rollup_qualifications(t("hab"))


# --- A3: rollup by effective key ------------------------------------------------------

def effective_key_rollup_frame(estab):
    """C17 then A3 by the library's rollup: the registry's columns under the
    names it expects (the type stands in for the company name, the names for
    the qualifications)."""
    fac = estab.select(
        F.col("co_cnes").alias("COD_CNES"), F.col("cnpj").alias("CNPJ"), F.col("cnpj_mantenedora").alias("CNPJ_MANTENEDORA"),
        (F.col("st_flag") == "1").alias("TEM_ONCOLOGIA_PEDIATRICA"), F.col("no_fantasia").alias("NOME_FANTASIA"),
        F.col("tp_unidade").alias("RAZAO_SOCIAL"), F.col("no_fantasia").alias("HABILITACOES_ONCOLOGIA"),
        F.lit(None).cast("bigint").alias("TOTAL_LEITOS_CNES"))
    k = FA.facilities_by_effective_key(fac)
    return k.select(
        F.col("_CNPJ_EFETIVO").alias("CNPJ_EFETIVO"), "CNES_TEM_ONCOLOGIA_PEDIATRICA", "CNES_NOME_FANTASIA",
        F.col("CNES_RAZAO_SOCIAL").alias("CNES_TIPO_UNIDADE"), F.col("CNES_HABILITACOES").alias("CNES_NOMES"),
        "CNES_QTD_UNIDADES_VINCULADAS", "CNES_VIA_CNPJ_MANTENEDORA")


EKEY = "case when not (cnpj is null or trim(cnpj) = '') then cnpj else cnpj_mantenedora end"
EKEY_ROLLUP_SQL = f"""select {EKEY} as CNPJ_EFETIVO,
  bool_or(st_flag = '1') as CNES_TEM_ONCOLOGIA_PEDIATRICA,
  arg_min(no_fantasia, co_cnes) filter (where no_fantasia is not null) as CNES_NOME_FANTASIA,
  arg_min(tp_unidade, co_cnes) filter (where tp_unidade is not null) as CNES_TIPO_UNIDADE,
  string_agg(distinct no_fantasia, '; ' order by no_fantasia) as CNES_NOMES,
  count(*) as CNES_QTD_UNIDADES_VINCULADAS,
  bool_or({S.blank('cnpj')} and not {S.blank('cnpj_mantenedora')}) as CNES_VIA_CNPJ_MANTENEDORA
from estab where not {S.blank(EKEY)} group by 1"""


@query("effective_key_rollup", EKEY_ROLLUP_SQL, ["estab"])
def effective_key_rollup(t):
    """A3: any, first non-null by explicit order, merged list, size."""
    return effective_key_rollup_frame(t("estab"))


# --- A7 / A8: dedupe ------------------------------------------------------------------

@query("dedupe_first", """select codigo, descricao from (
  select codigo, descricao, row_number() over (partition by codigo order by descricao) as rn
  from (select codigo, descricao from ref_ocup union all select substr(codigo, 1, 2), descricao from ref_icd) u) x
where rn = 1""", ["ref_ocup", "ref_icd"])
def dedupe_first(t):
    """One row per key, the first by an explicit order."""
    u = t("ref_ocup").unionByName(t("ref_icd").select(F.substring("codigo", 1, 2).alias("codigo"), "descricao"))
    return ro.dedupe_first(u, ["codigo"], ["descricao"])


@query("priority_dedupe", """select codigo, descricao from (
  select codigo, descricao, row_number() over (partition by codigo order by prio) as rn from (
    select codigo, descricao, 0 as prio from ref_icd
    union all select 'C' || codigo, descricao, 1 from ref_ocup
    union all select 'C' || codigo || '00', descricao, 1 from ref_ocup) u) x
where rn = 1""", ["ref_ocup", "ref_icd"])
def priority_dedupe(t):
    """New vocabulary wins; an old code is offered as NNN and NNN00."""
    old = t("ref_ocup")
    old_forms = old.select(F.concat(F.lit("C"), "codigo").alias("codigo"), "descricao").unionByName(
        old.select(F.concat(F.lit("C"), "codigo", F.lit("00")).alias("codigo"), "descricao"))
    return ro.priority_dedupe([t("ref_icd"), old_forms], "codigo")
