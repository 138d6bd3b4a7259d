"""Incremental merge and publish.

A re-delivered source file replaces exactly its own rows.  The key set of a
batch (file names or years) is tiny next to the table, so Spark broadcasts it
in the anti-join and the table itself does not shuffle.

``publish_partitioned`` is the scale path: the table is partitioned by the
lineage key, and only the partitions of the batch are rewritten (dynamic
partition overwrite) instead of the whole table on every delivery.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import remove_path, staging_path



def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """M4: union all by column name; missing columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def merge_replace(existing: DataFrame, batch: DataFrame, key,
                  read_keys: DataFrame | None = None) -> DataFrame:
    """M1 / M2: rows of ``existing`` whose key is not in the batch key set,
    plus every batch row.  ``key`` is a column name or a list of names.  The
    key set is the keys actually read (``read_keys``), so a file that was
    read but filtered to zero rows still replaces its old rows.  Existing
    rows with a null key are kept (anti-join, not NOT IN)."""
    keys = [key] if isinstance(key, str) else list(key)
    src = read_keys if read_keys is not None else batch
    ks = src.select(*[F.col(k).alias(f"_mk{i}") for i, k in enumerate(keys)]).distinct()
    same = reduce(lambda a, b: a & b, [existing[k] == F.col(f"_mk{i}") for i, k in enumerate(keys)])
    kept = existing.join(ks, same, "left_anti")
    return union_by_name([kept, batch])


# Precedence of summary sources (consolidated > preliminary > old era).
SOURCE_PRECEDENCE = ["CID10", "PRELIM", "CID9"]


def summary_upsert(existing: DataFrame, new: DataFrame, year: str = "ANO", source: str = "FONTE",
                   file: str = "ARQUIVO", precedence=SOURCE_PRECEDENCE) -> DataFrame:
    """M3: per year keep the rows of the best source; within it the newest
    delivery replaces older rows.  Rows without a year are keyed by file."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(p) for p in precedence]), F.col(source)),
                      F.lit(len(precedence) + 1))
    u = union_by_name([existing.withColumn("_b", F.lit(0)), new.withColumn("_b", F.lit(1))])
    # one window over the small summary: a year's rows compete, or a file's where there is no year
    undated = F.col(year).isNull()
    place = F.struct(F.when(undated, 0).otherwise(rank).alias("r"), (-F.col("_b")).alias("b"))
    group = Window.partitionBy(F.col(year), F.when(undated, F.col(file)))
    kept = u.withColumn("_p", place).withColumn("_best", F.min("_p").over(group)).filter(F.col("_p") == F.col("_best"))
    return kept.drop("_b", "_p", "_best").orderBy(year, source)


def empty_with_schema(spark: SparkSession, schema: StructType) -> DataFrame:
    """M6: an empty table that still carries the published schema."""
    return spark.createDataFrame([], schema)


def manifest_upsert(old: DataFrame, new: DataFrame, key: str = "chave") -> DataFrame:
    """Keys upper-cased; new entries replace old ones."""
    n = new.withColumn(key, F.upper(key))
    o = old.withColumn(key, F.upper(key))
    return merge_replace(o, n, key)


def publish(df: DataFrame, path: str, mode: str = "overwrite", rows_per_group: int = 250_000) -> None:
    """K1 / M5 / M7: parquet publish (snapshot replace when mode=overwrite)."""
    (df.write.mode(mode).option("parquet.block.size", str(128 * 1024 * 1024))
     .option("maxRecordsPerFile", str(rows_per_group * 40)).parquet(path))


def publish_partitioned(batch: DataFrame, path: str, key: str) -> None:
    """M1 at scale: rewrite only the partitions (source files / years) present
    in the batch; all other partitions are left untouched.  Rows are first
    rebalanced by key, so a small key makes one file and a large one several.
    The overwrite mode is a per-write option, the session's setting stays."""
    (batch.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(key).parquet(path))


def publish_replacing(batch: DataFrame, path: str, key: str, read_keys: DataFrame) -> None:
    """M1 at scale with the full key rule.  ``read_keys`` holds the keys of
    everything read; their partitions are rewritten, and those of keys read
    without a surviving row are removed.  The batch is computed once, into the
    shared folder; a replay after a failure writes and removes the same."""
    spark = batch.sparkSession
    work = staging_path(spark, "publish")
    batch.write.parquet(work)
    rows = spark.read.schema(batch.schema).parquet(work)
    emptied = read_keys.select(key).distinct().join(rows.select(key).distinct(), key, "left_anti").collect()
    publish_partitioned(rows, path, key)
    drop_partitions(spark, path, key, [r[0] for r in emptied])
    remove_path(spark, work)


def drop_partitions(spark: SparkSession, path: str, key: str, values: list) -> None:
    """Remove the partition folders of ``values`` (one per emptied key)."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for v in values:
        remove_path(spark, f"{path.rstrip('/')}/{names.getPartitionPathString(key, None if v is None else str(v))}")


def read_published(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A published table with its own types: without the schema a partition
    key of digits would come back as a number."""
    return spark.read.schema(schema).parquet(path)
