"""E1 queries: three runs of the death-record source over DBF files.

Run 1: the files of 1995 to 2000, that of 1998 cut off.  Run 2: 1998 whole,
2001 new, 1997 and 2000 again with their even records only (1997 is outside
the window of two periods and stays).  Run 3: 2000 cut off, 2001 again with no
oncology record.  1995 is before the series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import delivery as D
from ..session import staging_path
from ..sources import dbf
from ..sources.files import open_store
from . import curation as CU
from .registry import query

# The fields of the landed records and their widths.
LAYOUT = [("CONTADOR", 12), ("CAUSABAS", 7), ("IDADE", 3), ("DTOBITO", 8), ("CODMUNRES", 7), ("SEXO", 3), ("NATURAL", 3), ("OCUP", 3),
          ("RACACOR", 1), ("ESTCIV", 1), ("ESCFALAGR1", 2), ("LOCOCOR", 1), ("ASSISTMED", 4), ("TPPOS", 1), ("OBITOGRAV", 1), ("OBITOPUERP", 1),
          ("DTNASC", 8), ("ETNIA", 4), ("CODMUNOCOR", 7), ("TIPOBITO", 1), ("EXAME", 1), ("CIRURGIA", 1), ("NECROPSIA", 3), ("ATESTANTE", 1)]
FIELDS = [(n, "C", w) for n, w in LAYOUT]
PIECE = 4 << 20  # bytes


def _land(df, landing, *years, even=False, onco=True):
    rows = df.filter(F.regexp_extract(D.FILE, r"(\d{4})", 1).isin([str(y) for y in years]))
    if even:
        rows = rows.filter(F.col("CONTADOR").cast("bigint") % 2 == 0)
    if not onco:
        rows = rows.withColumn("CAUSABAS", F.lit("A00"))
    dbf.write_files(rows, landing, FIELDS, D.FILE).collect()


def _cut(landing, year):
    """Drop the end of a landed file, which is copied piece by piece."""
    store, root = open_store(landing)
    name, part = f"{root}/DOBR{year}.dbc", f"{root}/_DOBR{year}.part"
    with store.open_input_file(name) as f, store.open_output_stream(part) as out:
        left = f.size() * 2 // 3
        while left:
            data = f.read(min(left, PIECE))
            out.write(data)
            left -= len(data)
    store.move(part, name)


def _three_runs(t):
    spark = t.spark
    landed = CU._landed(t, "sim_do")
    at = staging_path(spark, "fonte-sim")
    places = D.Places(f"{at}/chegada", f"{at}/obitos", f"{at}/manifesto", f"{at}/resumo")
    source = D.deaths(CU._refs(t), ", ".join(f"`{n}` string" for n, _ in LAYOUT))
    _land(landed, places.landing, *range(1995, 2001))
    _cut(places.landing, 1998)
    reports = [D.run(spark, source, places)]
    _land(landed, places.landing, 1998, 2001)
    _land(landed, places.landing, 1997, 2000, even=True)
    reports.append(D.run(spark, source, places))
    _cut(places.landing, 2000)
    _land(landed, places.landing, 2001, onco=False, even=True)
    reports.append(D.run(spark, source, places))
    return places, reports


_LEFT = "ARQUIVO_ORIGEM in ('DOBR1996.dbc', 'DOBR1997.dbc', 'DOBR1998.dbc', 'DOBR1999.dbc') or ARQUIVO_ORIGEM = 'DOBR2000.dbc' and {even} % 2 = 0"


@query("deliver_mortality", f"""select * from ({CU.MODERN_SQL.replace('from sim_do)', 'from sim_dbf)')}) f
where {_LEFT.format(even='cast(ID_REGISTRO as bigint)')}""", ["sim_dbf", "ref_icd", "ref_ocup", "ref_uf", "ref_pais", "ref_sin"])
def deliver_mortality(t):
    """What three runs leave published."""
    places, _ = _three_runs(t)
    return D.snapshots.read(t.spark, places.table)


@query("deliver_summary", f"""with l as (select cast(substr(ARQUIVO_ORIGEM, 5, 4) as integer) as ANO, ARQUIVO_ORIGEM,
  {CU.S.f1('CAUSABAS')} and ARQUIVO_ORIGEM <> 'DOBR2001.dbc' as kept from sim_dbf
  where {_LEFT.format(even='cast(CONTADOR as bigint)')} or ARQUIVO_ORIGEM = 'DOBR2001.dbc' and cast(CONTADOR as bigint) % 2 = 0)
select ANO, 'CID10' as FONTE, ARQUIVO_ORIGEM as ARQUIVO, count(*) as TOTAL_OBITOS_GERAL, count(case when kept then 1 end) as TOTAL_OBITOS_CANCER,
  round(cast(count(case when kept then 1 end) as double) / count(*), 4) as PROPORCAO_OBITOS_CANCER, cast(null as varchar) as ERRO
from l group by ANO, ARQUIVO_ORIGEM""", ["sim_dbf"])
def deliver_summary(t):
    """The annual summary after three runs, counted in their one read."""
    places, _ = _three_runs(t)
    return D.snapshots.read(t.spark, places.summary)


@query("deliver_report", """with y(ANO, a1, a2, a3) as (values (1995, 'outro nome', 'outro nome', 'outro nome'),
  (1996, 'publicado', 'fora da janela', 'fora da janela'), (1997, 'publicado', 'fora da janela', 'fora da janela'),
  (1998, 'quarentena', 'publicado', 'fora da janela'), (1999, 'publicado', 'fora da janela', 'fora da janela'),
  (2000, 'publicado', 'publicado', 'quarentena'), (2001, null, 'publicado', 'publicado')),
r as (select ANO, unnest([1, 2, 3]) as RODADA, unnest([a1, a2, a3]) as ACAO from y)
select 'DOBR' || cast(ANO as varchar) || '.dbc' as nome, RODADA, ACAO from r
where ACAO is not null and ANO in (select cast(substr(ARQUIVO_ORIGEM, 5, 4) as integer) from sim_do)""", ["sim_do"])
def deliver_report(t):
    """What each run did with each file."""
    _, reports = _three_runs(t)
    told = [r.select("nome", F.lit(k).alias("RODADA"), "ACAO") for k, r in enumerate(reports, 1)]
    return told[0].unionByName(told[1]).unionByName(told[2])
