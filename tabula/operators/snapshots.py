"""K1: published tables whose readers see one whole version.

A table is a folder::

    lote=<lot>/<key>=<value>/...    rows as parquet; never changed once written
    _versoes/<version>-<id>/...     (key, lote): the lot that holds each key's rows
    _atual/<version>                written last: the commit

A commit writes the new rows as a lot of their own, then the version's list of
keys and lots (the old list without the keys that were read, plus the new
ones), then the pointer file, which is created only if nobody else created it:
of two writers that began from one version, the second gets
``ConcurrentPublish`` and changes nothing.  Readers take the pointer with the
highest number that is complete.  So a reader sees the state before a commit
or after it; a failed publish leaves unreferenced files, which ``vacuum``
removes.  Nothing is collected but the lots in use and pointer names.  Read
such a table with ``read``: a plain parquet scan of the folder finds the rows
of every lot that is still there, replaced ones too.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import remove_path

LOT = "lote"
KEPT_VERSIONS = 2


class ConcurrentPublish(RuntimeError):
    """Another writer published first; read the new version and try again."""


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def point(spark: SparkSession, folder: str, number: int, content: dict) -> None:
    """Create pointer ``number`` unless it is there; ends in a newline, so a
    reader can tell a whole one from one that is being written."""
    fs, p = _path(spark, f"{folder}/{number:010d}")
    try:
        stream = fs.create(p, False)
    except Exception as e:  # noqa: BLE001 - py4j wraps the file system's own error
        if fs.exists(p):
            raise ConcurrentPublish(f"{folder}: version {number} is already there") from e
        raise
    stream.write(bytearray((json.dumps(content) + "\n").encode()))
    stream.close()


def pointed(spark: SparkSession, folder: str, number: int | None = None) -> tuple[int, dict] | None:
    """(number, content) of the latest complete pointer, or of ``number``."""
    for name in reversed([n for n in _names(spark, folder) if n.isdigit() and number in (None, int(n))]):
        text = _read_text(spark, f"{folder}/{name}")
        if text.endswith("\n"):
            return int(name), json.loads(text)
    return None


def last_number(spark: SparkSession, folder: str) -> int:
    """The highest pointer number in use, complete or not; 0 without any."""
    return max([int(n) for n in _names(spark, folder) if n.isdigit()], default=0)


@dataclass(frozen=True)
class Version:
    number: int
    key: str
    listed: str  # folder of the key list
    schema: StructType


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The current version of a table, or a numbered one that is still kept."""
    found = pointed(spark, f"{path}/_atual", number)
    if found is None:
        return None
    n, told = found
    return Version(n, told["key"], f"{path}/_versoes/{told['listed']}", StructType.fromJson(told["schema"]))


def _listed(spark: SparkSession, v: Version) -> DataFrame:
    return spark.read.schema(StructType([v.schema[v.key]]).add(LOT, "string")).parquet(v.listed)


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The rows of one version (the current one when this is called); None for
    a table that was never published.  Lots are partitions, so only those in
    use are read; of these, the keys that the version's list gives them."""
    v = version(spark, path, number)
    if v is None:
        return None
    keys = _listed(spark, v)
    lots = [r[0] for r in keys.select(LOT).distinct().collect()]
    if not lots:
        return spark.createDataFrame([], v.schema)
    rows = spark.read.schema(StructType([*v.schema.fields]).add(LOT, "string")).parquet(path).filter(F.col(LOT).isin(lots))
    own = keys.select(F.col(v.key).alias("__key"), F.col(LOT).alias("__lot"))
    held = rows.join(own, rows[v.key].eqNullSafe(F.col("__key")) & (F.col(LOT) == F.col("__lot")), "left_semi")
    return held.select(*[f"`{n}`" for n in v.schema.names])


def read_latest(spark: SparkSession, path: str, order: Callable[[Column], Column] = lambda key: key) -> DataFrame | None:
    """P5 over a table that is published by period: the rows of the latest
    key, by ``order``.  The key comes from the version's list alone, and only
    its partition is read."""
    v = version(spark, path)
    if v is None:
        return None
    keys = _listed(spark, v).filter(F.col(v.key).isNotNull())
    top = keys.select(v.key, order(F.col(v.key)).alias("__order")).filter("__order is not null").orderBy(F.desc("__order"), F.desc(v.key)).first()
    rows = read(spark, path)
    return rows.limit(0) if top is None else rows.filter(F.col(v.key) == F.lit(top[0]))


def commit(rows: DataFrame, path: str, key: str, read_keys: DataFrame | None = None, replace_all: bool = False) -> int:
    """Publish ``rows``: they replace whatever the table holds of their keys
    and of ``read_keys`` (what was read, also without a surviving row), or all
    of it.  Rows with a null key are added; those published stay (M1).
    Returns the version's number."""
    spark, path = rows.sparkSession, path.rstrip("/")
    before = version(spark, path)
    number, own = last_number(spark, f"{path}/_atual") + 1, uuid.uuid4().hex[:12]
    lot = f"{number:010d}-{own}"
    schema = rows.schema
    if before is not None:
        if before.key != key:
            raise ValueError(f"{path} is published by {before.key}, not {key}")
        schema = StructType([*before.schema.fields, *[f for f in schema.fields if f.name.lower() not in {x.lower() for x in before.schema.names}]])
    target = f"{path}/{LOT}={lot}"
    rows.hint("rebalance", key).write.partitionBy(key).parquet(target)
    new = spark.read.schema(rows.schema).parquet(target).select(key).distinct()
    listed = new.withColumn(LOT, F.lit(lot))
    if before is not None and not replace_all:
        gone = new if read_keys is None else new.union(read_keys.select(key))
        listed = _listed(spark, before).join(gone.distinct(), key, "left_anti").unionByName(listed)
    folder = f"{lot}"
    listed.select(key, LOT).write.parquet(f"{path}/_versoes/{folder}")
    point(spark, f"{path}/_atual", number, {"key": key, "listed": folder, "schema": json.loads(schema.json())})
    return number


def vacuum(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Remove versions before the last ``keep`` and lots that none of these
    lists.  Lots and lists numbered after the current version may belong to a
    publish that is under way and stay.  Returns what was removed."""
    path = path.rstrip("/")
    numbers = [int(n) for n in _names(spark, f"{path}/_atual") if n.isdigit()]
    kept = [v for v in (version(spark, path, n) for n in sorted(numbers, reverse=True)) if v is not None][:keep]
    if not kept:
        return []
    used = {r[0] for v in kept for r in _listed(spark, v).select(LOT).distinct().collect()}
    lists = {v.listed.rsplit("/", 1)[1] for v in kept}
    now = kept[0].number
    gone = [f"{path}/_atual/{n:010d}" for n in numbers if n < kept[-1].number]
    gone += [f"{path}/_versoes/{n}" for n in _names(spark, f"{path}/_versoes") if n not in lists and int(n.split("-")[0]) <= now]
    for name in _names(spark, path):
        lot = name.removeprefix(f"{LOT}=")
        if name.startswith(f"{LOT}=") and lot not in used and int(lot.split("-")[0]) <= now:
            gone.append(f"{path}/{name}")
    for g in gone:
        remove_path(spark, g)
    return gone
