"""Shared helpers of the training-data operators: tables, words, staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_path, ship_package, staging_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_ALNUM_RAW = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; every other character stays.  In a text of ASCII
    characters alone that is what the cheaper ``lower`` does."""
    mapped = F.translate(text, UPPER, UPPER.lower())
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(mapped)


def words_of(text: Column, separators: str = SPACES) -> Column:
    """Array of the maximal runs between ``separators``; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often
    ``body`` uses it (a one-element transform binds it to a variable)."""
    return F.transform(F.array(value), body)[0]


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back: cuts
    the lineage, survives lost executors, and fixes nondeterministic input.
    ``options`` are those of the Parquet writer."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: For a lean stage: what the shuffles of a write leave goes when it has ended, and batches for Python are small.
LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


#: For rows of some MB: a page ends after any row, and is unpacked without buffers of its size outside the heap.
LARGE_ROWS = {"compression": "zstd", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def lean_stage(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """As ``stage`` under the settings ``LEAN``, which hold for this write
    alone; ``discard`` removes the table once nothing reads it any more.
    ``batch_bytes`` is for rows of some MB: it bounds the batches for Python by
    their bytes too, and such rows are written to pages of their own."""
    conf = df.sparkSession.conf
    lean = LEAN if batch_bytes is None else {**LEAN, "spark.sql.execution.arrow.maxBytesPerBatch": str(batch_bytes)}
    before = {k: conf.get(k, None) for k in lean}
    for k, v in lean.items():
        conf.set(k, v)
    try:
        out = stage(df, name, **({} if batch_bytes is None else LARGE_ROWS))
    finally:
        for k, v in before.items():
            conf.set(k, v) if v is not None else conf.unset(k)
    out._staged_files = out.inputFiles()[:1]
    return out


def discard(*tables: DataFrame) -> None:
    """Remove what ``lean_stage`` wrote."""
    for df in tables:
        for file in getattr(df, "_staged_files", []):
            remove_path(df.sparkSession, file.rsplit("/", 1)[0])


def python_ready(spark: SparkSession) -> None:
    """Operators with Python in their tasks call this first."""
    ship_package(spark)


def spread(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
