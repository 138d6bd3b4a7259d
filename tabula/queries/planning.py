"""Queries for P1-P12 and K4 (file-arrival planning) on the listing views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import VIEWS
from ..plans import arrival as A
from ..session import staging_path
from ..sources.files import write_named
from .registry import query

PAT = "(?i)^(AQ|AR|AM)([A-Z]{2})([0-9]{2})([0-9]{2})\\.dbc$"


@query("dedupe_case_insensitive", """select nome, tamanho, doc_id from (
  select *, row_number() over (partition by upper(nome) order by nome, doc_id) as rn from listing
  where ends_with(lower(nome), '.dbc')) x where rn = 1""", ["listing"])
def dedupe_case_insensitive(t):
    """First by sorted name among names equal ignoring case."""
    return A.dedupe_case_insensitive(t("listing"), "nome", tie="doc_id")


@query("filename_attributes", f"""select doc_id, nome,
  case when regexp_matches(nome, '{PAT}') then upper(regexp_extract(nome, '{PAT}', 1)) end as PREFIXO,
  case when regexp_matches(nome, '{PAT}') then upper(regexp_extract(nome, '{PAT}', 2)) end as UF,
  case when regexp_matches(nome, '{PAT}') then cast(regexp_extract(nome, '{PAT}', 3) as integer) + 2000 end as ANO,
  case when regexp_matches(nome, '{PAT}') then cast(regexp_extract(nome, '{PAT}', 4) as integer) end as MES,
  coalesce(regexp_matches(nome, '{PAT}') and cast(regexp_extract(nome, '{PAT}', 3) as integer) + 2000 >= 2008, false) as VALIDO
from listing""", ["listing"])
def filename_attributes(t):
    """Prefix / state / year / month from the file name."""
    return t("listing").select("doc_id", "nome", *A.authorization_attributes("nome"))


def _pivot_sql(yy, p):
    return f"case when cast({yy} as integer) >= {p} then cast({yy} as integer) + 1900 else cast({yy} as integer) + 2000 end"


@query("year_pivot", f"""select doc_id, substr(nome, 5, 2) as yy, {_pivot_sql('substr(nome, 5, 2)', 79)} as ANO_MORTALIDADE,
  {_pivot_sql('substr(nome, 5, 2)', 90)} as ANO_RECENCIA from listing""", ["listing"])
def year_pivot(t):
    """Two-digit years, mortality pivot 79 and recency pivot 90."""
    yy = F.substring("nome", 5, 2)
    return t("listing").select("doc_id", yy.alias("yy"),
                               A.two_digit_year(yy, A.MORTALITY_PIVOT).alias("ANO_MORTALIDADE"),
                               A.two_digit_year(yy, A.RECENCY_PIVOT).alias("ANO_RECENCIA"))


def _rk_sql(n):
    d = f"regexp_extract({n}, '([0-9]+)\\.\\w+$', 1)"
    return (f"case when {d} = '' then {n} when length({d}) = 2 then cast({_pivot_sql(d, 90)} as varchar) "
            f"else {d} end")


@query("recency_key", f"""select doc_id, {_rk_sql('nome')} as CHAVE_RECENCIA,
  {_rk_sql("'DOR' || substr(nome, 5, 2) || '.dbc'")} as CHAVE_CURTA from listing""", ["listing"])
def recency_key(t):
    """Digits before the extension (two digits pivot at 90)."""
    n = F.col("nome")
    short = F.concat(F.lit("DOR"), F.substring(n, 5, 2), F.lit(".dbc"))
    return t("listing").select("doc_id", A.recency_key(n).alias("CHAVE_RECENCIA"),
                               A.recency_key(short).alias("CHAVE_CURTA"))


PERIOD_SQL = ("case when regexp_extract(nome, '(?i)^[A-Z]{4}([0-9]{2})([0-9]{2})\\.dbc$', 1) <> '' then "
              + _pivot_sql("regexp_extract(nome, '(?i)^[A-Z]{4}([0-9]{2})([0-9]{2})\\.dbc$', 1)", 90)
              + "::varchar || regexp_extract(nome, '(?i)^[A-Z]{4}([0-9]{2})([0-9]{2})\\.dbc$', 2) end")


@query("latest_period_slice", f"""select nome, tamanho, doc_id from listing
where {PERIOD_SQL} = (select max({PERIOD_SQL}) from listing)""", ["listing"])
def latest_period_slice(t):
    """P5: only the files of the latest period (4-digit year first)."""
    return A.latest_period_slice(t("listing"), A.period_of("nome"))


@query("recency_window_plan", f"""with l as (select *, {_rk_sql('nome')} as rk from listing),
recent as (select distinct rk from l order by rk desc limit 2)
select nome, tamanho, doc_id from l where rk in (select rk from recent)
  or upper(nome) not in (select chave from manifesto)""", ["listing", "manifesto"])
def recency_window_plan(t):
    """Last two periods or not in the manifest."""
    return A.recency_window_plan(t("listing"), t("manifesto"))


@query("changed_by_size", """select l.nome, l.tamanho, l.doc_id,
  not coalesce(l.tamanho is not null and l.tamanho is not distinct from m.assinatura, false) as ALTERADO
from listing l left join manifesto m on upper(l.nome) = m.chave""", ["listing", "manifesto"])
def changed_by_size(t):
    """Skip only when the manifest holds the same size."""
    return A.changed_by_signature(t("listing"), t("manifesto"), "nome", "tamanho")


@query("changed_by_hash", """with cur as (select doc_id, upper('d' || cast(doc_id as varchar)) as chave, sha256(text) as hash from documents),
man as (select upper('d' || cast(doc_id as varchar)) as chave,
  sha256(case when doc_id % 7 = 0 then text || ' (rev)' else text end) as assinatura from documents where doc_id % 11 <> 0)
select cur.doc_id, cur.chave, cur.hash, not coalesce(cur.hash is not distinct from man.assinatura, false) as ALTERADO
from cur left join man on cur.chave = man.chave""")
def changed_by_hash(t):
    """Content hash (sha256) against the stored signature."""
    d = t("documents")
    cur = d.select("doc_id", F.upper(F.concat(F.lit("d"), F.col("doc_id").cast("string"))).alias("chave"),
                   F.sha2("text", 256).alias("hash"))
    man = d.filter(F.col("doc_id") % 11 != 0).select(
        F.upper(F.concat(F.lit("d"), F.col("doc_id").cast("string"))).alias("chave"),
        F.sha2(F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" (rev)"))).otherwise(F.col("text")), 256)
        .alias("assinatura"))
    return A.changed_by_signature(cur, man, "chave", "hash")


VERSION_SQL = """with views as (select upper(n_name) as visao,
  case when n_nationkey % 5 = 0 then null else 'V' || cast(n_nationkey % 4 as varchar) end as versao from nation),
man as (select upper(n_name) as chave, 'V' || cast(n_nationkey % 3 as varchar) as assinatura from nation where n_nationkey % 2 = 0)"""


def _versions(t):
    n = t("nation")
    views = n.select(F.upper("n_name").alias("visao"),
                     F.when(F.col("n_nationkey") % 5 != 0,
                            F.concat(F.lit("V"), (F.col("n_nationkey") % 4).cast("string"))).alias("versao"))
    man = n.filter(F.col("n_nationkey") % 2 == 0).select(
        F.upper("n_name").alias("chave"), F.concat(F.lit("V"), (F.col("n_nationkey") % 3).cast("string")).alias("assinatura"))
    return views, man


@query("changed_by_version", VERSION_SQL + """
select v.visao, v.versao, not coalesce(v.versao is not null and v.versao is not distinct from m.assinatura, false) as ALTERADO
from views v left join man m on upper(v.visao) = m.chave""")
def changed_by_version(t):
    """Published date per view; unknown never counts as unchanged."""
    views, man = _versions(t)
    return A.changed_by_signature(views, man, "visao", "versao")


@query("recent_years_plan", VERSION_SQL + """
select v.visao, v.versao, cast(y.ANO as integer) as ANO from views v
join (select distinct chave from man) k on v.visao = k.chave, range(2025, 2027) y(ANO)
union all select v.visao, v.versao, cast(y.ANO as integer) from views v, range(2013, 2027) y(ANO)
where v.visao not in (select chave from man)""")
def recent_years_plan(t):
    """P10: first load = whole series, later loads = current and previous year."""
    views, man = _versions(t)
    return A.recent_years_plan(views, man, "visao", "chave", current_year=2026)


@query("strip_date_prefix", """select doc_id, regexp_replace(case when doc_id % 3 = 0 then '20240131_' || nome else nome end,
  '^[0-9]{8}_', '') as nome from listing""", ["listing"])
def strip_date_prefix(t):
    """Drop a leading YYYYMMDD_ date."""
    n = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("20240131_"), "nome")).otherwise(F.col("nome"))
    return t("listing").select("doc_id", A.strip_date_prefix(n).alias("nome"))


@query("listing_diff", """with r as (select upper(nome) as k, max(tamanho) as s from listing where doc_id % 8 <> 1 group by 1)
select coalesce(r.k, m.chave) as CHAVE,
  case when r.k is null then 'apagar' when m.chave is null or r.s is distinct from m.assinatura then 'baixar'
  else 'reaproveitar' end as ACAO
from r full outer join manifesto m on r.k = m.chave""", ["listing", "manifesto"])
def listing_diff(t):
    """K4: fetch / reuse / delete from two listings."""
    r = (t("listing").filter(F.col("doc_id") % 8 != 1).groupBy(F.upper("nome").alias("k"))
         .agg(F.max("tamanho").alias("s")))
    return A.listing_diff(r, t("manifesto"), "k", "s", "chave", "assinatura")


_NAMES = """select doc_id, case doc_id % 6 when 0 then 'HB' || upper(lang) || lpad(cast(doc_id % 100 as string), 2, '0') || '01.dbc'
  when 1 then 'lt' || lang || '24' || lpad(cast(doc_id % 12 as string), 2, '0') || '.DBC'
  when 2 then 'DORBR' || lpad(cast(doc_id % 100 as string), 2, '0') || '.dbc' when 3 then 'DOBR' || cast(1990 + doc_id % 40 as string) || '.dbc'
  when 4 then 'cancBR' || cast(doc_id % 10 as string) || '.dbc' else 'DORBRXX.dbc' end as nome from {documents}"""
VIEWS.setdefault("nomes_fontes", _NAMES)


@query("filename_attributes_sources", """select doc_id, nome,
  case when regexp_matches(upper(nome), '^(HB|LT)[A-Z]{2}[0-9]{4}[.]DBC$') then substr(upper(nome), 1, 2) end as PREFIXO,
  case when regexp_matches(upper(nome), '^(HB|LT)[A-Z]{2}[0-9]{4}[.]DBC$') then substr(upper(nome), 3, 2) end as UF,
  case when regexp_matches(upper(nome), '^(HB|LT)[A-Z]{2}[0-9]{4}[.]DBC$') then substr(nome, 5, 4) end as COMPETENCIA,
  case when doc_id % 6 = 2 and doc_id % 100 between 79 and 95 then cast(1900 + doc_id % 100 as integer) end as ANO_CID9,
  case when doc_id % 6 = 3 and doc_id % 40 >= 6 then cast(1990 + doc_id % 40 as integer) end as ANO_CID10,
  doc_id % 6 = 4 as NOTIFICACAO_CANCER from nomes_fontes""", ["nomes_fontes"])
def filename_attributes_sources(t):
    """State and period of facility files, valid years of the death-record
    series, cancer notification files."""
    return t("nomes_fontes").select(
        "doc_id", "nome", *A.facility_file_attributes("nome"), A.death_file_year("nome", "DORBR").alias("ANO_CID9"),
        A.death_file_year("nome", "DOBR").alias("ANO_CID10"), A.is_cancer_notification("nome").alias("NOTIFICACAO_CANCER"))


@query("changed_by_content", """select s_suppkey, sha256(s_name || chr(10)) as assinatura, s_suppkey % 3 = 0 as ALTERADO from supplier""")
def changed_by_content(t):
    """One landed file per supplier; its signature is the hash of the
    file's bytes, compared with a manifest that is stale for every third."""
    path = staging_path(t.spark, "content")
    s = t("supplier").select("s_suppkey", "s_name")
    # as many files as suppliers: written by all tasks into one folder
    key = F.coalesce(F.col("s_suppkey").cast("string"), F.lit("sem"))
    lines = s.select(F.concat(F.lit("s_suppkey="), key, F.lit(".txt")).alias("arquivo"),
                     F.concat(F.coalesce("s_name", F.lit("")), F.lit("\n")).cast("binary").alias("registro"))
    write_named(lines, path).count()
    key = F.regexp_extract("path", "s_suppkey=([0-9]+)", 1)
    landed = A.content_signatures(t.spark, path).select(key.alias("nome"), "assinatura")
    stale = F.when(F.col("s_suppkey") % 3 == 0, F.lit("antigo")).otherwise(F.col("s_name"))
    manifest = s.select(F.col("s_suppkey").cast("string").alias("chave"), F.sha2(F.concat(stale, F.lit("\n")), 256).alias("assinatura"))
    out = A.changed_by_signature(landed, manifest, "nome", "assinatura")
    return out.select(F.col("nome").cast("long").alias("s_suppkey"), "assinatura", "ALTERADO")
