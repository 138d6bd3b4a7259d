"""Catalogue of published files (K2) and its audit (K3).

Spark lists the files (path, size, time; no content); row and column counts
come from the parquet footers, read in the tasks.  So an empty table is listed
with 0 rows, an unreadable file with null, and no data page is scanned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import not_control_file
from ..session import ship_package
from ..sources.files import open_store, store_options

UNMAPPED = "(não mapeado)"
CATALOGUE_COLUMNS = ["ARQUIVO", "DIRETORIO", "FONTE_RELACIONADA", "DESCRICAO", "NUM_REGISTROS",
                     "NUM_COLUNAS", "TAMANHO_BYTES", "ULTIMA_ATUALIZACAO"]


def _mapped(mapping: dict | None, key):
    """``mapping[key]`` as a column; null where there is none."""
    if not mapping:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), key)


def footers(options: str):
    """Row and column counts from each file's footer; null if it can't be
    read, with the reason.  A store that cannot be opened at all is an error:
    it says nothing about the file."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for b in batches:
            rows, cols, why = [], [], []
            for path in b.column(0).to_pylist():
                n = c = reason = None
                if path.endswith(".parquet"):
                    store, own = open_store(path, options)
                    try:
                        meta = pq.read_metadata(own, filesystem=store)
                        n, c = meta.num_rows, meta.num_columns
                    except (OSError, pa.ArrowInvalid) as e:
                        reason = str(e).split("\n")[0][:200]
                rows.append(n)
                cols.append(c)
                why.append(reason)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, pa.int64()), pa.array(cols, pa.int32()), pa.array(why, pa.string())],
                                             names=[*b.schema.names, "NUM_REGISTROS", "NUM_COLUNAS", "MOTIVO"])

    return run


def catalogue(spark: SparkSession, tables: dict[str, str], names_by_file: dict | None = None,
              names_by_folder: dict | None = None, descriptions_by_file: dict | None = None,
              tz: str = "America/Sao_Paulo", descriptions_by_folder: dict | None = None) -> DataFrame:
    """K2: one row per published file.  ``tables`` maps a table name to its
    path (a file or a folder).  The name is the file's own, else the first of
    the folder's names; the description is the file's own, else the folder's."""
    ship_package(spark)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([p for _, p in sorted(tables.items())])
              .select("path", "length", "modificationTime"))
    spread = listed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    u = spread.mapInArrow(
        footers(store_options(spark)), "path string, length long, modificationTime timestamp, NUM_REGISTROS long, NUM_COLUNAS int, MOTIVO string")
    u = u.withColumn("ARQUIVO", F.element_at(F.split("path", "/"), -1)).filter(not_control_file("ARQUIVO"))
    folder = F.element_at(F.split("path", "/"), -2)
    session_tz = spark.conf.get("spark.sql.session.timeZone")
    local = F.from_utc_timestamp(F.to_utc_timestamp("modificationTime", session_tz), tz)
    own, of_folder = _mapped(names_by_file, F.col("ARQUIVO")), _mapped(names_by_folder, folder)
    name = F.coalesce(own, F.substring_index(of_folder, " | ", 1), F.lit(UNMAPPED))
    text = F.coalesce(_mapped(descriptions_by_file, F.col("ARQUIVO")), _mapped(descriptions_by_folder, folder), F.lit(""))
    return u.select(
        "ARQUIVO", folder.alias("DIRETORIO"), name.alias("FONTE_RELACIONADA"), text.alias("DESCRICAO"),
        "NUM_REGISTROS", "NUM_COLUNAS", F.col("length").alias("TAMANHO_BYTES"),
        F.date_format(local, "dd-MM-yyyy HH:mm:ss").alias("ULTIMA_ATUALIZACAO"),
    ).orderBy("DIRETORIO", "ARQUIVO")


def catalogue_audit(cat: DataFrame) -> DataFrame:
    """K3: unmapped folders, files without readable metadata, totals."""
    unmapped = F.col("FONTE_RELACIONADA").startswith("(não mapeado")
    return cat.agg(
        F.count_distinct(F.when(unmapped, F.col("DIRETORIO"))).alias("PASTAS_NAO_MAPEADAS"),
        F.count_if(unmapped).alias("ARQUIVOS_NAO_MAPEADOS"),
        F.count_if(F.col("NUM_REGISTROS").isNull()).alias("ARQUIVOS_SEM_METADADOS"),
        F.count(F.lit(1)).alias("TOTAL_ARQUIVOS"),
        F.sum(F.coalesce("NUM_REGISTROS", F.lit(0))).alias("TOTAL_REGISTROS"),
    )


def write_catalogue(cat: DataFrame, path: str) -> None:
    """K2 output: the catalogue as one CSV with header (one row per published
    file, so a single output file is small by construction)."""
    marked = cat.select(*CATALOGUE_COLUMNS).withColumnRenamed("ARQUIVO", "\ufeffARQUIVO")  # BOM: opens as UTF-8 in spreadsheets
    (marked.coalesce(1).write.mode("overwrite")
     .option("header", True).option("encoding", "UTF-8").csv(path))
