"""Queries for M1-M4, M6 and P11 (incremental merge) on the binding views.

"Published" rows are the whole coded-record table (some with null lineage);
the "new" batch re-delivers the odd-year files, changed, filtered by F1."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import year_ddmmyyyy
from ..operators import filters as fl
from ..operators import merge as M
from ..operators import policy as P
from . import sqlbits as S
from .aggregating import SUMMARY_SQL, annual_summary_frame
from .registry import query

ODD = "cast(substr(arquivo_origem, 5, 4) as integer) % 2 = 1"


def _published(rec):
    lineage = F.when(F.col("rec_id") % 101 != 0, F.col("arquivo_origem"))
    return rec.select("rec_id", "causabas", "sexo", lineage.alias("ARQUIVO_ORIGEM"))


def _odd(c):
    return F.substring(c, 5, 4).cast("int") % 2 == 1


def _batch(rec):
    b = fl.keep(rec.filter(_odd(F.col("arquivo_origem"))), fl.icd10_onco("causabas"))
    return b.select("rec_id", "causabas", F.lit("novo").alias("sexo"), "idade",
                    F.col("arquivo_origem").alias("ARQUIVO_ORIGEM"))


PUB_SQL = "select rec_id, causabas, sexo, case when rec_id % 101 <> 0 then arquivo_origem end as ARQUIVO_ORIGEM from rec"
NEW_SQL = (f"select rec_id, causabas, 'novo' as sexo, idade, arquivo_origem as ARQUIVO_ORIGEM from rec "
           f"where {ODD} and {S.f1('causabas')}")


@query("merge_replace_file", f"""with pub as ({PUB_SQL}), new as ({NEW_SQL}),
readset as (select distinct arquivo_origem as k from rec where {ODD})
select rec_id, causabas, sexo, cast(null as varchar) as idade, ARQUIVO_ORIGEM from pub
where not exists (select 1 from readset where k = pub.ARQUIVO_ORIGEM)
union all select rec_id, causabas, sexo, idade, ARQUIVO_ORIGEM from new""", ["rec"])
def merge_replace_file(t):
    """M1: a re-delivered file replaces only its rows; files read with zero
    surviving rows still drop their old rows; null lineage is kept."""
    rec = t("rec")
    read = rec.filter(_odd(F.col("arquivo_origem"))).select(F.col("arquivo_origem").alias("ARQUIVO_ORIGEM"))
    return M.merge_replace(_published(rec), _batch(rec), "ARQUIVO_ORIGEM", read_keys=read)


YEAR_SQL = ("case when length(trim(dtobito)) = 8 and regexp_matches(substr(trim(dtobito), 5, 4), '^[0-9]{4}$') "
            "then cast(substr(trim(dtobito), 5, 4) as integer) end")


@query("merge_replace_year", f"""with pub as (select rec_id, sexo, {YEAR_SQL} as ANO from rec),
yrs as (select distinct ANO from pub where ANO is not null order by ANO desc limit 2),
new as (select rec_id, 'novo' as sexo, ANO from pub where ANO in (select ANO from yrs) and rec_id % 2 = 0)
select * from pub where ANO is null or ANO not in (select ANO from new)
union all select * from new""", ["rec"])
def merge_replace_year(t):
    """M2: the reprocessed years (latest two) replace their rows."""
    pub = t("rec").select("rec_id", "sexo", year_ddmmyyyy("dtobito").alias("ANO"))
    # the two latest years: a top-2 of the few distinct years, joined back by value
    years = pub.select("ANO").distinct().filter(F.col("ANO").isNotNull()).orderBy(F.col("ANO").desc()).limit(2)
    new = (pub.join(F.broadcast(years), "ANO", "left_semi").filter(F.col("rec_id") % 2 == 0)
           .select("rec_id", F.lit("novo").alias("sexo"), "ANO"))
    return M.merge_replace(pub, new, "ANO")


def _summary_parts(t):
    base = annual_summary_frame(t("rec")).drop("FONTE")
    existing = base.withColumn("FONTE", F.when(F.col("ANO") % 3 == 0, "CID10").otherwise("PRELIM"))
    new = (base.withColumn("FONTE", F.lit("PRELIM"))
           .withColumn("TOTAL_OBITOS_GERAL", F.col("TOTAL_OBITOS_GERAL") + 1))
    undated_old = base.filter(F.col("ANO") == F.lit(1998)).withColumn("ANO", F.lit(None).cast("int")) \
        .withColumn("ARQUIVO", F.lit("DOBRXXXX.dbc")).withColumn("FONTE", F.lit("CID9"))
    undated_new = undated_old.withColumn("TOTAL_OBITOS_GERAL", F.lit(0).cast("bigint"))
    return existing.unionByName(undated_old), new.unionByName(undated_new)


@query("annual_summary_upsert", f"""with base as (select * exclude (FONTE) from ({SUMMARY_SQL}) s),
existing as (select *, case when ANO % 3 = 0 then 'CID10' else 'PRELIM' end as FONTE from base
  union all select * replace (cast(null as integer) as ANO, 'DOBRXXXX.dbc' as ARQUIVO), 'CID9' as FONTE from base where ANO = 1998),
new as (select * replace (TOTAL_OBITOS_GERAL + 1 as TOTAL_OBITOS_GERAL), 'PRELIM' as FONTE from base
  union all select * replace (cast(null as integer) as ANO, 'DOBRXXXX.dbc' as ARQUIVO, cast(0 as bigint) as TOTAL_OBITOS_GERAL), 'CID9' as FONTE from base where ANO = 1998),
u as (select *, 0 as b from existing union all by name select *, 1 as b from new),
p as (select *, case FONTE when 'CID10' then 1 when 'PRELIM' then 2 when 'CID9' then 3 else 4 end as r from u),
best as (select ANO, min(r) as r from p where ANO is not null group by ANO),
bestb as (select p.ANO, max(p.b) as b from p join best on p.ANO = best.ANO and p.r = best.r group by p.ANO),
dated as (select p.* from p join best on p.ANO = best.ANO and p.r = best.r join bestb on p.ANO = bestb.ANO and p.b = bestb.b),
undated as (select * from p where ANO is null and b = (select max(b) from p p2 where p2.ANO is null and p2.ARQUIVO = p.ARQUIVO))
select ANO, FONTE, ARQUIVO, TOTAL_OBITOS_GERAL, TOTAL_OBITOS_CANCER, PROPORCAO_OBITOS_CANCER, ERRO from dated
union all select ANO, FONTE, ARQUIVO, TOTAL_OBITOS_GERAL, TOTAL_OBITOS_CANCER, PROPORCAO_OBITOS_CANCER, ERRO from undated""",
       ["rec"])
def annual_summary_upsert(t):
    """M3: upsert by year; consolidated beats preliminary; null years by file."""
    existing, new = _summary_parts(t)
    return M.summary_upsert(existing, new)


@query("union_by_name", """select rec_id, causabas, null::varchar as idade, arquivo_origem from rec where rec_id % 2 = 0
union all by name select rec_id, idade, arquivo_origem from rec where rec_id % 2 = 1""", ["rec"])
def union_by_name(t):
    """M4: parts with drifting columns unioned by name."""
    r = t("rec")
    a = r.filter(F.col("rec_id") % 2 == 0).select("rec_id", "causabas", "arquivo_origem")
    b = r.filter(F.col("rec_id") % 2 == 1).select("idade", "rec_id", "arquivo_origem")
    return M.union_by_name([a, b])


@query("manifest_upsert", """with new as (select upper(nome) as chave, max(tamanho) as assinatura from listing
  where nome like '%EN%' or nome like '%08%' group by upper(nome))
select * from manifesto where chave not in (select chave from new) union all select * from new""",
       ["listing", "manifesto"])
def manifest_upsert(t):
    """Upper-cased keys, new entries replace old ones."""
    lst = t("listing")
    new = (lst.filter(F.col("nome").contains("EN") | F.col("nome").contains("08"))
           .groupBy(F.upper("nome").alias("chave")).agg(F.max("tamanho").alias("assinatura")))
    return M.manifest_upsert(t("manifesto"), new, "chave")


def _death_columns(columns):
    """What a query hook makes of a layout: the fields both eras name differently, under one name."""
    there = {c.upper() for c in columns}
    wanted = [("CONTADOR", "ID"), ("OCUP", "OCUPACAO"), ("OCUPACAO", "OCUPACAO"), ("CODMUNRES", "MUNICIPIO"), ("MUNIRES", "MUNICIPIO"), ("TPPOS", "POSICAO")]
    return [f"trim({src}) as {dst}" for src, dst in wanted if src in there] + ["ARQUIVO_ORIGEM"]


@query("columns_hook", """select trim(CONTADOR) as ID, trim(OCUP) as OCUPACAO, trim(CODMUNRES) as MUNICIPIO, trim(TPPOS) as POSICAO, ARQUIVO_ORIGEM from sim_do
union all select trim(contador), trim(OCUPACAO), trim(MUNIRES), null, ARQUIVO_ORIGEM from sim_do_old""", ["sim_do", "sim_do_old"])
def columns_hook(t):
    """One hook over two layouts, each selecting what is there; united by name (M4)."""
    return M.union_by_name([P.select_by_columns(t(v), _death_columns) for v in ("sim_do", "sim_do_old")])
