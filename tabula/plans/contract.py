"""Data dictionaries as a contract that every publish can be held against.

A dictionary is a text with a table of columns (``| Coluna | Tipo | Descrição
|``); ``read_dictionaries`` turns a folder of them into one contract table.
``check`` compares a published table with its contract in one pass: columns
that are missing or not in the dictionary, types that differ, and for each
file the columns without any value and the values outside their domain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The dictionaries' type names and the Spark types that meet them.
TYPES = {"texto": ("string",), "inteiro": ("int", "bigint", "smallint"), "decimal": ("double", "float"), "booleano": ("boolean",)}
MISSING, EXTRA, TYPE, EMPTY, OUTSIDE = "ausente", "a mais", "tipo", "sem valores", "fora do domínio"
REPORT = "ARQUIVO string, COLUNA string, SITUACAO string, N long"


def read_dictionaries(spark: SparkSession, path: str) -> DataFrame:
    """(TABELA, COLUNA, TIPO, ORDEM) of every dictionary under ``path``: its
    rows of three cells or more whose first is a name in capitals; the table
    is the file's name without its ending."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    lines = files.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("TABELA"), F.posexplode(F.split(F.decode("content", "UTF-8"), r"\r?\n")).alias("n", "l"))
    cells = lines.withColumn("c", F.transform(F.split("l", r"\|"), lambda x: F.trim(x))).filter(F.trim("l").startswith("|") & (F.size("c") >= 4))
    named = cells.select("TABELA", "n", F.get("c", F.lit(1)).alias("COLUNA"), F.lower(F.get("c", F.lit(2))).alias("TIPO"))
    own = named.filter(F.col("COLUNA").rlike("^[A-Z][A-Z0-9_]*$"))
    first = own.groupBy("TABELA", "COLUNA").agg(F.min(F.struct("n", "TIPO")).alias("f"))
    return first.select("TABELA", "COLUNA", "f.TIPO", F.col("f.n").alias("ORDEM"))


def check(df: DataFrame, contract: DataFrame, table: str, file: str = "ARQUIVO_ORIGEM", domains: dict | None = None) -> DataFrame:
    """(ARQUIVO, COLUNA, SITUACAO, N): what of ``df`` does not meet the
    contract; ARQUIVO is null for what holds for the whole table.  ``domains``
    gives a column's values; null is always one.  The contract of one table is
    a few dozen rows; the data is aggregated by file in one pass."""
    spark = df.sparkSession
    told = {r["COLUNA"]: r["TIPO"] for r in contract.filter(F.col("TABELA") == table).collect()}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    whole = [(None, c, MISSING, 1) for c in told if c not in have] + [(None, c, EXTRA, 1) for c in have if c not in told]
    whole += [(None, c, TYPE, 1) for c, t in told.items() if c in have and have[c] not in TYPES.get(t, (have[c],))]
    counted = [c for c in told if c in have and c != file]
    tests = [F.when(F.count(F.col(f"`{c}`")) == 0, F.count(F.lit(1))).otherwise(0).alias(f"v{k}") for k, c in enumerate(counted)]
    bounded = [(c, sorted(set(domains[c]))) for c in counted if c in (domains or {})]
    tests += [F.count_if(~F.col(f"`{c}`").isin(values)).alias(f"d{k}") for k, (c, values) in enumerate(bounded)]
    out = spark.createDataFrame(whole, REPORT)
    if not tests:
        return out
    each = [F.struct(F.lit(c).alias("COLUNA"), F.lit(EMPTY).alias("SITUACAO"), F.col(f"v{k}").cast("long").alias("N")) for k, c in enumerate(counted)]
    each += [F.struct(F.lit(c).alias("COLUNA"), F.lit(OUTSIDE).alias("SITUACAO"), F.col(f"d{k}").cast("long").alias("N")) for k, (c, _) in enumerate(bounded)]
    found = df.groupBy(F.col(f"`{file}`").alias("ARQUIVO")).agg(*tests).select("ARQUIVO", F.explode(F.array(*each)).alias("x")).select("ARQUIVO", "x.*")
    return out.unionByName(found.filter("N > 0"))
