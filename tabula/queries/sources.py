"""Queries for the sources (S1-S4, S6, S8, S9, C5) and M6/M7: driver tables
are written to the shared folder in the source format, then scanned back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as fl
from ..operators import merge as M
from ..session import staging_path
from ..sources import dbf
from ..sources import text as X
from . import sqlbits as S
from .registry import query

DBF_FIELDS = [("REC_ID", "N", 10), ("CAUSABAS", "C", 8), ("SEXO", "C", 3), ("DTOBITO", "D", 8),
              ("SEXO_L", "L", 1), ("IDADE", "C", 4)]


@query("dbf_scan", """select cast(rec_id as varchar) as REC_ID, nullif(trim(causabas), '') as CAUSABAS,
  nullif(trim(sexo), '') as SEXO,
  substr(dtobito, 5, 4) || '-' || substr(dtobito, 3, 2) || '-' || substr(dtobito, 1, 2) as DTOBITO,
  case trim(sexo) when '1' then 'True' when '2' then 'False' end as SEXO_L, nullif(trim(idade), '') as IDADE
from rec where rec_id % 50 <> 0""", ["rec"])
def dbf_scan(t):
    """Records written as DBF files (one per Arrow batch, executor side),
    scanned back by the DBF data source in record-aligned ranges."""
    spark = t.spark
    dbf.register(spark)
    r = t("rec")
    src = r.select(
        F.col("rec_id").cast("string").alias("REC_ID"), F.col("causabas").alias("CAUSABAS"),
        F.col("sexo").alias("SEXO"),
        F.concat(F.substring("dtobito", 5, 4), F.substring("dtobito", 3, 2), F.substring("dtobito", 1, 2)).alias("DTOBITO"),
        F.when(F.trim("sexo") == "1", "T").when(F.trim("sexo") == "2", "F").otherwise("?").alias("SEXO_L"),
        F.col("idade").alias("IDADE"), (F.col("rec_id") % 50 == 0).alias("_del"))
    folder = staging_path(spark, "dbf")
    dbf.write_partitions(src, folder, DBF_FIELDS, "_del").collect()
    layout = ", ".join(f"{name} string" for name, _, _ in DBF_FIELDS)
    return dbf.scan(spark, folder, schema=layout, bytesPerPartition=1 << 17)


@query("csv_scan_text", "select cast(n_nationkey as varchar) as n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey from nation")
def csv_scan_text(t):
    """S2: ';'-separated latin1 text with header, every column a string."""
    path = staging_path(t.spark, "csv")
    t("nation").write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return X.csv_text(t.spark, path, sep=";", encoding="ISO-8859-1")


@query("header_normalize", "select n_nationkey as NACAO, n_name as NOME_PAIS, n_regionkey as REGIAO from nation")
def header_normalize(t):
    """BOM / accents / case removed from headers, then renamed."""
    path = staging_path(t.spark, "hdr")
    n = t("nation").select(F.col("n_nationkey").alias("﻿ nação "), F.col("n_name").alias("Nome País"),
                           F.col("n_regionkey").alias("região"))
    n.write.parquet(path)
    df = t.spark.read.parquet(path)
    return X.header_normalize(df, {"NACAO": "NACAO", "NOME PAIS": "NOME_PAIS", "REGIAO": "REGIAO"})


LAYOUT = [("UF", 1, 2), ("ESTRATO", 3, 7), ("SEXO", 10, 1), ("RESPOSTA", 11, 1), ("IDADE", 12, 3),
          ("RACA", 15, 1), ("FLAGS", 16, 3)]


@query("fixed_width_extract", "select " + ", ".join(
    f"trim(substr(value, {p}, {n})) as {name}" for name, p, n in LAYOUT) + " from linhas", ["linhas"])
def fixed_width_extract(t):
    """S3: (name, position, length) layout over raw lines, stripped."""
    return X.fixed_width(t("linhas"), LAYOUT)


@query("scan_union_by_name", """select rec_id, causabas, null::varchar as idade from rec where rec_id % 2 = 0
union all by name select rec_id, idade from rec where rec_id % 2 = 1""", ["rec"])
def scan_union_by_name(t):
    """Parquet files with different layouts read as one table by name."""
    r = t("rec")
    base = staging_path(t.spark, "union")
    r.filter(F.col("rec_id") % 2 == 0).select("rec_id", "causabas").write.parquet(f"{base}/a")
    r.filter(F.col("rec_id") % 2 == 1).select("rec_id", "idade").write.parquet(f"{base}/b")
    return X.parquet_union(t.spark, [f"{base}/a", f"{base}/b"])


@query("lineage_stamp", "select 'orders.parquet' as ARQUIVO_ORIGEM, count(*) as N from orders")
def lineage_stamp(t):
    """Every row carries the name of the file it was read from."""
    o = X.lineage(t.spark.read.parquet(t.path("orders")))
    return o.groupBy("ARQUIVO_ORIGEM").agg(F.count(F.lit(1)).alias("N"))


@query("wide_matrix_scan", """select linha, click, view_, error_, total from matriz""", ["matriz"])
def wide_matrix_scan(t):
    """Four tabulation exports, each with title, header and footer lines;
    only ';' lines are parsed, each file under its own header."""
    path = staging_path(t.spark, "matrix")
    m = t("matriz")
    quoted = F.concat_ws(";", *[F.concat(F.lit('"'), F.col(c), F.lit('"')) for c in m.columns])
    body = m.select(F.pmod(F.xxhash64("linha"), F.lit(4)).alias("parte"), F.lit(1).alias("o"), quoted.alias("value"))
    head = ";".join(f'"{c}"' for c in m.columns)
    rest = t.spark.range(4).select(F.col("id").alias("parte"), F.explode(F.array(
        F.struct(F.lit(-1).alias("o"), F.lit("Tabulação de eventos por usuário").alias("value")),
        F.struct(F.lit(0).alias("o"), F.lit(head).alias("value")),
        F.struct(F.lit(2).alias("o"), F.lit("Fonte: eventos").alias("value")))).alias("x")).select("parte", "x.*")
    (body.unionByName(rest).repartition("parte").sortWithinPartitions("parte", "o").select("parte", "value")
     .write.partitionBy("parte").text(path))
    return X.wide_matrix(t.spark, path)


def _bad_lines(t):
    """Suppliers as lines: every 7th lacks a field, every 11th has one more, some quotes hold separators, a few never close."""
    s = t("supplier")
    key = F.col("s_suppkey")
    name = F.when(key % 5 == 0, F.concat(F.lit('"'), F.col("s_name"), F.lit('; ""x"""'))).when(key % 13 == 0, F.concat(F.lit('"'), F.col("s_name"))).otherwise(F.col("s_name"))
    line = F.concat_ws(";", key.cast("string"), name, F.when(key % 7 != 0, F.concat(F.lit("T"), F.col("s_nationkey").cast("string"))), F.when(key % 11 == 0, F.lit("mais")))
    return s.select(F.pmod(key, F.lit(3)).alias("parte"), key.alias("o"), line.alias("value"))


_SUP = """select *, case when s_suppkey % 5 = 0 then s_name || '; "x"' when s_suppkey % 13 = 0 then '"' || s_name else s_name end as nome,
  case when s_suppkey % 5 <> 0 and s_suppkey % 13 = 0 then 'quote not closed'
    when (s_suppkey % 7 = 0) <> (s_suppkey % 11 = 0) then cast(3 - cast(s_suppkey % 7 = 0 as integer) + cast(s_suppkey % 11 = 0 as integer) as varchar) || ' fields of 3'
    end as motivo from supplier"""


def _landed_lines(t):
    path = staging_path(t.spark, "linhas")
    body = _bad_lines(t)
    head = t.spark.range(3).select(F.col("id").alias("parte"), F.lit(-1).cast("long").alias("o"), F.lit('chave;"nome; completo";telefone').alias("value"))
    (body.unionByName(head).repartition("parte").sortWithinPartitions("parte", "o").select("parte", "value").write.partitionBy("parte").text(path))
    return path


@query("wide_matrix_rejects", f"""select motivo as MOTIVO, count(*) as N from ({_SUP}) s where motivo is not null group by motivo""")
def wide_matrix_rejects(t):
    """Lines with too few or too many fields, or an open quote, come as rejects with file, line and reason."""
    _, bad = X.wide_matrix_with_rejects(t.spark, _landed_lines(t))
    return bad.filter("ARQUIVO is not null and LINHA > 1").groupBy("MOTIVO").agg(F.count("*").alias("N"))


@query("csv_scan_rejects", f"""select motivo as MOTIVO, count(*) as N from ({_SUP}) s group by motivo""")
def csv_scan_rejects(t):
    """Rows and rejects of delimited text with faulty lines; rows count under no reason."""
    good, bad = X.csv_with_rejects(t.spark, _landed_lines(t))
    both = good.select(F.lit(None).cast("string").alias("MOTIVO")).unionAll(bad.select("MOTIVO"))
    return both.groupBy("MOTIVO").agg(F.count("*").alias("N"))


@query("wide_matrix_header", f"""select cast(s_suppkey as varchar) as chave, nome as "nome; completo",
  case when s_suppkey % 7 = 0 then 'mais' else 'T' || cast(s_nationkey as varchar) end as telefone from ({_SUP}) s where motivo is null""")
def wide_matrix_header(t):
    """A header whose quoted name holds the separator; the rows that are left."""
    return X.wide_matrix(t.spark, _landed_lines(t))


@query("candidate_column_filter", f"select * from rec where {S.f1('causabas')}", ["rec"])
def candidate_column_filter(t):
    """The filter runs on the first candidate column present; with no
    candidate present the result is empty."""
    r = t("rec")
    hit = X.candidate_column(r, ["CAUSAMORT", "CAUSABAS", "CAUSAM"], fl.icd10_onco)
    miss = X.candidate_column(r, ["CAUSAMORT", "CAUSAM"], fl.icd10_onco)
    return hit.unionByName(miss)


@query("passthrough", "select * from nation")
def passthrough(t):
    """M7 / K1: a static table published as is (write, then read back)."""
    path = staging_path(t.spark, "static")
    M.publish(t("nation"), path)
    return t.spark.read.parquet(path)


@query("snapshot_replace", "select * from supplier where s_suppkey % 2 = 0")
def snapshot_replace(t):
    """M5: a snapshot source replaces the whole published table on each
    delivery (the older snapshot leaves no rows behind)."""
    path = staging_path(t.spark, "snapshot")
    s = t("supplier")
    M.publish(s, path)                                   # previous month's snapshot
    M.publish(s.filter(F.col("s_suppkey") % 2 == 0), path)  # latest snapshot replaces it
    return t.spark.read.parquet(path)
