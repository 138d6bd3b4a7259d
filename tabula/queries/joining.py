"""Queries for J1-J10 (lookup joins) on the binding views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import icd_key, municipality_code6, zero_pad
from ..operators import lookups as L
from . import sqlbits as S
from ..plans.facilities import rollup_qualifications
from .aggregating import EKEY_ROLLUP_SQL, FACILITY_SQL, effective_key_rollup_frame
from .registry import query


@query("lookup_label", """select r.rec_id, r.causabas, d.descricao as CAUSA_BASICA_DESCRICAO
from rec r left join ref_icd d on replace(trim(r.causabas), '.', '') = d.codigo""", ["rec", "ref_icd"])
def lookup_label(t):
    """Diagnosis label on the dot-free key (broadcast after a size check)."""
    r = t("rec").select("rec_id", "causabas")
    return L.lookup_label(r, icd_key("causabas"), t("ref_icd"), "codigo", "descricao", "CAUSA_BASICA_DESCRICAO")


@query("lookup_prefix", """select r.rec_id, r.causa9, d.descricao as CAUSA_BASICA_DESCRICAO
from rec r left join ref_cid9 d on substr(trim(r.causa9), 1, 3) = d.codigo""", ["rec", "ref_cid9"])
def lookup_prefix(t):
    """Label looked up by the first three characters of the code."""
    r = t("rec").select("rec_id", "causa9")
    return L.lookup_label(r, F.substring(F.trim("causa9"), 1, 3), t("ref_cid9"), "codigo", "descricao",
                          "CAUSA_BASICA_DESCRICAO")


@query("lookup_concat", """select r.rec_id, case when d.descricao is not null then r.ocup || ' - ' || d.descricao
  else r.ocup end as OCUPACAO from rec r left join ref_ocup d on r.ocup = d.codigo""", ["rec", "ref_ocup"])
def lookup_concat(t):
    """Occupation replaced by 'code - label'."""
    r = t("rec").select("rec_id", F.col("ocup").alias("OCUPACAO"))
    return L.lookup_concat(r, "OCUPACAO", t("ref_ocup"), "codigo", "descricao")


@query("lookup_conditional", """select r.rec_id, case when substr(r.naturalidade, 1, 1) = '8' then u.descricao
  else p.descricao end as NATURALIDADE
from rec r left join ref_uf u on substr(r.naturalidade, 1, 1) = '8' and substr(r.naturalidade, 2, 2) = u.codigo
left join ref_pais p on substr(r.naturalidade, 1, 1) <> '8' and r.naturalidade = p.codigo""",
       ["rec", "ref_uf", "ref_pais"])
def lookup_conditional(t):
    """J4: '8'+state -> state label, otherwise country label."""
    r = t("rec").select("rec_id", F.col("naturalidade").alias("NATURALIDADE"))
    return L.lookup_conditional(r, "NATURALIDADE", t("ref_uf"), t("ref_pais"))


@query("synonym_resolve", """select r.rec_id, r.m6 as CO_IBGE_RESIDENCIA, coalesce(s.atual, r.m6) as COD_MUNICIPIO_ATUAL
from (select rec_id, case when length(trim(munres)) >= 7 then substr(trim(munres), 1, 6)
      else nullif(trim(munres), '') end as m6 from rec) r left join ref_sin s on r.m6 = s.antigo""", ["rec", "ref_sin"])
def synonym_resolve(t):
    """Current municipality through the synonym map; original kept."""
    r = t("rec").select("rec_id", municipality_code6("munres").alias("CO_IBGE_RESIDENCIA"))
    return L.synonym_resolve(r, "CO_IBGE_RESIDENCIA", t("ref_sin"), "antigo", "atual", "COD_MUNICIPIO_ATUAL")


ESTAB_NORM_SQL = f"""select coalesce({S.pad('trim(co_cnes)', 7)}, '') as co_cnes7, no_fantasia, cnpj from estab"""


def _estab_norm(t):
    e = t("estab")
    return e.select(zero_pad(F.trim("co_cnes"), 7, null_as_empty=True).alias("co_cnes7"), "no_fantasia", "cnpj")


@query("enrich_found_flag", f"""with f as ({FACILITY_SQL}),
e as (select co_cnes7, no_fantasia, cnpj from (select *, row_number() over (partition by co_cnes7 order by no_fantasia, cnpj) as rn
      from ({ESTAB_NORM_SQL}) x) y where rn = 1)
select f.CNES, f.QTD_HABILITACOES_ONCOLOGIA, e.no_fantasia as NOME_FANTASIA, e.cnpj as CNPJ,
  e.co_cnes7 is not null as ENCONTRADO_NO_CNES from f left join e on f.CNES = e.co_cnes7""", ["hab", "estab"])
def enrich_found_flag(t):
    """Right side deduped by key, left join, found flag, rows never multiplied."""
    f = rollup_qualifications(t("hab")).select("CNES", "QTD_HABILITACOES_ONCOLOGIA")
    j = L.enrich_found_flag(f, "CNES", _estab_norm(t), "co_cnes7", "ENCONTRADO_NO_CNES", ["no_fantasia", "cnpj"])
    return j.select("CNES", "QTD_HABILITACOES_ONCOLOGIA", F.col("no_fantasia").alias("NOME_FANTASIA"),
                    F.col("cnpj").alias("CNPJ"), "ENCONTRADO_NO_CNES")


@query("grants_x_facilities", f"""with k as ({EKEY_ROLLUP_SQL})
select c.num, c.convenente, k.CNES_NOME_FANTASIA, k.CNES_QTD_UNIDADES_VINCULADAS, k.CNES_VIA_CNPJ_MANTENEDORA,
  k.CNPJ_EFETIVO is not null as HABILITADO_CNES_ONCOLOGIA
from convenios c left join k on c.convenente = k.CNPJ_EFETIVO""", ["convenios", "estab"])
def grants_x_facilities(t):
    """Grants joined to facilities pre-aggregated by effective key (A3)."""
    k = effective_key_rollup_frame(t("estab")).select(
        "CNPJ_EFETIVO", "CNES_NOME_FANTASIA", "CNES_QTD_UNIDADES_VINCULADAS", "CNES_VIA_CNPJ_MANTENEDORA")
    c = t("convenios").select("num", "convenente")
    j = L.enrich_found_flag(c, "convenente", k, "CNPJ_EFETIVO", "HABILITADO_CNES_ONCOLOGIA")
    return j


@query("three_way_reference", """select n.n_nationkey, n.n_name, n.n_regionkey, r.r_name, s.atual
from nation n left join region r on n.n_regionkey = r.r_regionkey
left join ref_sin s on cast(100000 + n.n_nationkey as varchar) = s.antigo""", ["ref_sin"])
def three_way_reference(t):
    """All base columns plus the two references' columns, keys excluded."""
    n = t("nation").withColumn("_k", (F.col("n_nationkey") + 100000).cast("string"))
    j = L.three_way_reference(n, [(t("region"), "n_regionkey", "r_regionkey"), (t("ref_sin"), "_k", "antigo")])
    return j.drop("_k")


@query("join_fanout_audit", f"""select coalesce({S.pad('trim(cnes)', 7)}, '') as key, count(*) as n
from hab group by 1 having count(*) > 1""", ["hab"])
def join_fanout_audit(t):
    """Keys that would multiply a left join (empty = safe)."""
    return L.duplicate_keys(t("hab"), zero_pad(F.trim("cnes"), 7, null_as_empty=True))
