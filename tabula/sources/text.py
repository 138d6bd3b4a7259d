"""Text and parquet sources.

All landings are string-typed (``inferSchema`` off); parsing happens later
in native expressions."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import normalize_header
from ..operators.policy import first_present


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: all leading/trailing whitespace, not only spaces."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def csv_text(spark: SparkSession, path, sep: str = ";", encoding: str = "UTF-8", header: bool = True,
             quote: str = '"', multi_line: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """Delimited text, every column a string (no inference).  A quote
    inside a quoted field is doubled, a backslash is plain text.  ``multi_line``
    allows newlines inside quotes (such a file is read by one task).  A line
    with too few or too many fields fails the job unless ``mode`` says
    otherwise; columns are not pruned while parsing, so none goes unseen."""
    return (spark.read.option("sep", sep).option("header", header).option("encoding", encoding)
            .option("inferSchema", False).option("quote", quote).option("escape", quote)
            .option("multiLine", multi_line).option("columnPruning", False).option("mode", mode).csv(path))


REJECTS = "ARQUIVO string, LINHA long, MOTIVO string, TEXTO string"


def field_count(line: Column, sep: str, quote: str = '"') -> Column:
    """Fields of one delimited line; a quoted field may hold the separator."""
    q = f"\\Q{quote}\\E"
    bare = F.regexp_replace(line, f"{q}(?:[^{quote}]|{q}{q})*{q}", "")
    return F.size(F.split(bare, f"\\Q{sep}\\E", -1))


def line_fault(line: Column, fields: Column, sep: str, quote: str = '"') -> Column:
    """Why a line cannot be read as ``fields`` fields; null where it can."""
    n = field_count(line, sep, quote)
    open_quote = F.length(F.regexp_replace(line, f"[^{quote}]", "")) % 2 == 1
    return (F.when(open_quote, F.lit("quote not closed"))
            .when(n != fields, F.concat(n.cast("string"), F.lit(" fields of "), fields.cast("string"))))


def csv_with_rejects(spark: SparkSession, path, sep: str = ";", encoding: str = "UTF-8", quote: str = '"') -> tuple[DataFrame, DataFrame]:
    """The rows whose lines have as many fields as the header, and the
    other lines as a table (ARQUIVO, MOTIVO, TEXTO), so one bad line costs
    that line alone.  All files share the first one's header; lines equal to
    it are headers, wherever they stand.  Both tables parse in one pass each."""
    read = lines(spark, path, encoding)
    first = read.first()
    if first is None:
        return spark.createDataFrame([], "linha string"), spark.createDataFrame([], "ARQUIVO string, MOTIVO string, TEXTO string")
    names = header_names(first["value"], sep)
    fault = line_fault(F.col("value"), F.lit(len(names)), sep, quote)
    body = read.select("value", F.col("_metadata.file_name").alias("ARQUIVO")).filter(
        (F.col("value") != first["value"]) & (F.col("value") != "")).withColumn("MOTIVO", fault)
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = body.filter("MOTIVO is null").select(F.from_csv("value", schema, {"sep": sep, "quote": quote, "escape": quote}).alias("r")).select("r.*")
    return rows, body.filter("MOTIVO is not null").select("ARQUIVO", "MOTIVO", F.col("value").alias("TEXTO"))


def header_normalize(df: DataFrame, rename: dict | None = None) -> DataFrame:
    """BOM/space stripped, accents removed, upper-case; then an optional
    rename map on the normalised names."""
    rename = {normalize_header(k): v for k, v in (rename or {}).items()}
    out = []
    for c in df.columns:
        n = normalize_header(c)
        out.append(F.col(f"`{c}`").alias(rename.get(n, n)))
    return df.select(*out)


def lines(spark: SparkSession, path, encoding: str = "UTF-8") -> DataFrame:
    """Raw lines as a ``value`` column.  Non-UTF-8 files go through the CSV
    reader with a delimiter and quote that never occur."""
    if encoding.upper().replace("-", "") in ("UTF8",):
        return spark.read.text(path)
    return (spark.read.option("sep", "\u0001").option("quote", "\u0000").option("header", False)
            .option("encoding", encoding).csv(path).select(F.coalesce(F.col("_c0"), F.lit("")).alias("value")))


def fixed_width(df: DataFrame, layout, line: str = "value", where: Column | None = None) -> DataFrame:
    """S3: ``layout`` = [(name, 1-based position, length)]; character based,
    stripped like Python.  ``where`` (F7/F8) runs on the raw line first."""
    if where is not None:
        df = df.filter(F.coalesce(where, F.lit(False)))
    return df.select(*[strip_ws(F.substring(F.col(line), pos, ln)).alias(name) for name, pos, ln in layout])


def parquet_union(spark: SparkSession, paths, lineage: str | None = None) -> DataFrame:
    """S4 (+S6): parquet files with drifting layouts, unioned by name; the
    lineage column carries each row's source file name."""
    df = spark.read.option("mergeSchema", True).parquet(*([paths] if isinstance(paths, str) else paths))
    if lineage:
        df = df.withColumn(lineage, F.col("_metadata.file_name"))
    return df


def lineage(df: DataFrame, name: str = "ARQUIVO_ORIGEM") -> DataFrame:
    """Stamp each row with its source file name (from the scan)."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def header_names(line: str, sep: str) -> list[str]:
    """The column names of a header line, read like any other line of the
    file: quotes may hold the separator; a BOM and outer spaces are dropped;
    a name that recurs or is blank gets its place."""
    cells = [c.strip() for c in next(csv.reader([line.lstrip("\ufeff")], delimiter=sep), [])]
    seen: set[str] = set()
    out = []
    for k, c in enumerate(cells, 1):
        name = c if c and c.lower() not in seen else f"{c or 'coluna'}_{k}"
        seen.add(name.lower())
        out.append(name)
    return out


def matrix_lines(spark: SparkSession, path, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """(ARQUIVO, head, LINHA, value) of the body lines of tabulation exports:
    of a file only lines with the separator count, the first is the header.
    Exports are small, so each is one row until its lines are taken apart."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    numbered = F.transform(F.split(F.decode("content", encoding), r"\r?\n"), lambda x, i: F.struct((i + 1).cast("long").alias("LINHA"), x.alias("value")))
    kept = F.filter(numbered, lambda x: x["value"].contains(sep))
    name = F.element_at(F.split("path", "/"), -1).alias("ARQUIVO")
    exports = files.select(name, kept.alias("ls")).filter(F.size("ls") >= 2)
    body = exports.select("ARQUIVO", F.get("ls", F.lit(0))["value"].alias("head"), F.explode(F.slice("ls", F.lit(2), F.size("ls"))).alias("l"))
    return body.select("ARQUIVO", "head", "l.LINHA", "l.value")


def wide_matrix_with_rejects(spark: SparkSession, path, sep: str = ";", encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame]:
    """Tabulation exports, each under its own header, parsed by the same
    CSV rules as their lines; files with different headers are united by
    column name.  Lines with too few or too many fields, or an open quote, are
    not rows but come as a second table (ARQUIVO, LINHA, MOTIVO, TEXTO)."""
    body = matrix_lines(spark, path, sep, encoding)
    good, bad = None, None
    for row in sorted(body.select("head").distinct().collect()):  # the few layouts there are
        names = header_names(row["head"], sep)
        own = body.filter(F.col("head") == row["head"]).withColumn("MOTIVO", line_fault(F.col("value"), F.lit(len(names)), sep))
        schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
        parsed = own.filter("MOTIVO is null").select(F.from_csv("value", schema, {"sep": sep, "escape": '"'}).alias("r")).select("r.*")
        told = own.filter("MOTIVO is not null").select("ARQUIVO", "LINHA", "MOTIVO", F.col("value").alias("TEXTO"))
        good = parsed if good is None else good.unionByName(parsed, allowMissingColumns=True)
        bad = told if bad is None else bad.unionByName(told)
    if good is None:
        return spark.createDataFrame([], "linha string"), spark.createDataFrame([], REJECTS)
    return good, bad


def wide_matrix(spark: SparkSession, path, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """The rows of ``wide_matrix_with_rejects``."""
    return wide_matrix_with_rejects(spark, path, sep, encoding)[0]


def candidate_column(df: DataFrame, candidates, predicate) -> DataFrame:
    """Apply ``predicate(column)`` to the first candidate column present;
    no candidate present -> an empty result with the same schema."""
    c = first_present(df, candidates)
    if c is None:
        return df.limit(0)
    return df.filter(F.coalesce(predicate(F.col(f"`{c}`")), F.lit(False)))
