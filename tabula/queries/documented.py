"""Documented uses of the published tables (thin queries over the flows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import signed_days
from ..plans import facilities as FA
from ..plans import mortality as MO
from ..plans import outpatient as OP
from ..plans import surveys as SV
from . import curation as CU
from .registry import query
from .spec_sql import spec_sql

PANEL_SQL = spec_sql(OP.PANEL, "painel", CU._cols("painel"), CU._REFS)


def _panel(t):
    return OP.curate_panel(t("painel"), t("ref_cid10"))


_DAYS_SQL = ("case when regexp_extract(trim(DIAS_ATE_TRATAMENTO), '^[+-]?([0-9]+)$', 1) in ('', '99999') then null "
             "when starts_with(trim(DIAS_ATE_TRATAMENTO), '-') then -cast(regexp_extract(trim(DIAS_ATE_TRATAMENTO), "
             "'^[+-]?([0-9]+)$', 1) as integer) else cast(regexp_extract(trim(DIAS_ATE_TRATAMENTO), "
             "'^[+-]?([0-9]+)$', 1) as integer) end")


@query("days_to_treatment", f"""select TOPOGRAFIA_CID10, DIAS_ATE_TRATAMENTO, {_DAYS_SQL} as DIAS
from ({PANEL_SQL}) p""", ["painel", "ref_cid10"])
def days_to_treatment(t):
    """Signed days from diagnosis to treatment; 99999 = no treatment info."""
    p = _panel(t)
    return p.select("TOPOGRAFIA_CID10", "DIAS_ATE_TRATAMENTO", signed_days("DIAS_ATE_TRATAMENTO").alias("DIAS"))


@query("panel_facility_link", f"""with p as ({PANEL_SQL}), f as ({CU.FACILITIES_SQL})
select p.COD_CNES_TRATAMENTO, count(*) as CASOS, max(f.NOME_FANTASIA) as NOME_FANTASIA,
  bool_or(f.COD_CNES is not null) as HABILITADO_ONCOLOGIA
from p left join f on p.COD_CNES_TRATAMENTO = f.COD_CNES group by p.COD_CNES_TRATAMENTO""",
       ["painel", "ref_cid10", "hab", "estab_reg", "leitos"])
def panel_facility_link(t):
    """Treated cases per facility, linked to the oncology facility table."""
    cases = _panel(t).groupBy("COD_CNES_TRATAMENTO").agg(F.count(F.lit(1)).alias("CASOS"))
    fac = CU._published_facilities(t).select(F.col("COD_CNES"), "NOME_FANTASIA")
    j = cases.join(fac, cases["COD_CNES_TRATAMENTO"] == fac["COD_CNES"], "left")
    return j.groupBy("COD_CNES_TRATAMENTO").agg(
        F.sum("CASOS").alias("CASOS"), F.max("NOME_FANTASIA").alias("NOME_FANTASIA"),
        F.bool_or(F.col("COD_CNES").isNotNull()).alias("HABILITADO_ONCOLOGIA"))


@query("care_flow_by_state", f"""select COD_UF_RESIDENCIA, COD_UF_TRATAMENTO, count(*) as CASOS,
  COD_UF_RESIDENCIA = COD_UF_TRATAMENTO as MESMA_UF from ({PANEL_SQL}) p group by 1, 2""", ["painel", "ref_cid10"])
def care_flow_by_state(t):
    """Where patients live versus where they are treated."""
    p = _panel(t)
    return (p.groupBy("COD_UF_RESIDENCIA", "COD_UF_TRATAMENTO").agg(F.count(F.lit(1)).alias("CASOS"))
            .withColumn("MESMA_UF", F.col("COD_UF_RESIDENCIA") == F.col("COD_UF_TRATAMENTO")))


@query("deaths_by_year_era", f"""select 'CID10' as ERA, ANO_OBITO, count(*) as OBITOS from ({CU.MODERN_SQL}) m group by 2
union all select 'CID9', ANO_OBITO, count(*) from ({CU.OLD_SQL}) o group by 2""",
       ["sim_do", "sim_do_old", "ref_icd", "ref_cid9", "ref_ocup", "ref_uf", "ref_pais", "ref_sin"])
def deaths_by_year_era(t):
    """Year series of oncology deaths by coding era."""
    modern = MO.curate_death_records(CU._landed(t, "sim_do"), "modern", CU._refs(t))
    old = MO.curate_death_records(CU._landed(t, "sim_do_old"), "old", CU._refs(t, old=True))
    def by_year(df, era):
        return df.groupBy("ANO_OBITO").agg(F.count(F.lit(1)).alias("OBITOS")).select(
            F.lit(era).alias("ERA"), "ANO_OBITO", "OBITOS")
    return by_year(modern, "CID10").unionByName(by_year(old, "CID9"))


_TYPES = [n for n, _ in SV.CANCER_TYPES_2019]


@query("survey_cancer_type_count", f"""select COD_UF, ESTRATO_AMOSTRAL, UNIDADE_PRIMARIA_AMOSTRAGEM, NUM_ORDEM_DOMICILIO,
  NUM_ORDEM_MORADOR, {' + '.join(f"(case when {n} = 'Sim' then 1 else 0 end)" for n in _TYPES)} as QTD_TIPOS_CANCER
from ({CU._survey_sql(SV.DIAGNOSIS_2019, 'pns2019')}) s""", ["pns2019"])
def survey_cancer_type_count(t):
    """Cancer types reported per person: the count of "Sim" flags."""
    s = SV.curate_survey(t("pns2019"), SV.DIAGNOSIS_2019)
    n = sum((F.col(c) == "Sim").cast("int") for c in _TYPES)
    return s.select("COD_UF", "ESTRATO_AMOSTRAL", "UNIDADE_PRIMARIA_AMOSTRAGEM", "NUM_ORDEM_DOMICILIO",
                    "NUM_ORDEM_MORADOR", n.alias("QTD_TIPOS_CANCER"))


@query("network_by_state", f"""with f as ({CU.FACILITIES_SQL}), g as ({CU.GRANTS_SQL}), d as ({CU.MODERN_SQL}),
fs as (select COD_UF as UF, count(*) as ESTABELECIMENTOS from f group by 1),
gs as (select CNES_COD_UF as UF, count(*) as CONVENIOS from g where HABILITADO_CNES_ONCOLOGIA group by 1),
ds as (select substr(COD_MUNICIPIO_RESIDENCIA, 1, 2) as UF, count(*) as OBITOS from d group by 1)
select coalesce(fs.UF, gs.UF, ds.UF) as UF, coalesce(ESTABELECIMENTOS, 0) as ESTABELECIMENTOS,
  coalesce(CONVENIOS, 0) as CONVENIOS, coalesce(OBITOS, 0) as OBITOS
from fs full outer join gs on fs.UF = gs.UF full outer join ds on coalesce(fs.UF, gs.UF) = ds.UF""",
       ["hab", "estab_reg", "leitos", "convenios", "sim_do", "ref_icd", "ref_ocup", "ref_uf", "ref_pais", "ref_sin"])
def network_by_state(t):
    """Oncology network, matched grants and oncology deaths per state."""
    fac = CU._published_facilities(t)
    g = t("convenios").select(F.col("num").alias("NUM_CONVENIO"), F.col("objeto").alias(FA.GRANT_TEXT),
                              F.col("convenente").alias(FA.GRANT_KEY))
    grants = FA.curate_grants(g, fac, CU._KW)
    deaths = MO.curate_death_records(CU._landed(t, "sim_do"), "modern", CU._refs(t))
    fs = fac.groupBy(F.col("COD_UF").alias("UF")).agg(F.count(F.lit(1)).alias("ESTABELECIMENTOS"))
    gs = (grants.filter("HABILITADO_CNES_ONCOLOGIA").groupBy(F.col("CNES_COD_UF").alias("UF"))
          .agg(F.count(F.lit(1)).alias("CONVENIOS")))
    ds = (deaths.groupBy(F.substring("COD_MUNICIPIO_RESIDENCIA", 1, 2).alias("UF"))
          .agg(F.count(F.lit(1)).alias("OBITOS")))
    j = fs.join(gs, "UF", "full_outer").join(ds, "UF", "full_outer")
    return j.select("UF", *[F.coalesce(c, F.lit(0)).alias(c) for c in ["ESTABELECIMENTOS", "CONVENIOS", "OBITOS"]])
