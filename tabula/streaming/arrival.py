"""Incremental arrival of delivery files as a Structured Streaming job.

A pass lists the landing folder and compares every file's signature (size and
time, or a hash of the content) with that of its last read version (P7 / P8),
so a file that was replaced in place arrives again.  What is new or changed is
written as one listing, and a stream over the listings reads the files:

* each micro-batch notes which keys its files hold; a file that cannot be read
  goes to quarantine with the reason, and the others go on;
* when the stream has caught up, every touched key is published whole, from
  all files of its latest delivery, in one atomic version (``snapshots``).

A delivery is what one listing first saw in one folder (``delivery="folder"``:
all that a folder ever held), so parts that land together add up, and a later
file of the same key replaces, whatever its name.  A file replaced in place
stays in its delivery, which becomes the latest.  A key whose rows are gone or
all filtered out loses its old rows.  A key of a file in quarantine, and the
file's last signature, stay as they are until a readable version arrives; it
is tried again in every pass.

State, beside the checkpoint in the shared folder: ``chegadas`` (the
listings), ``lidos`` and ``notas`` (files read and their keys, by batch),
``quarentena``, ``compacta`` (files and keys that count, written new by every
pass, older ones removed) and ``publicado`` (pointers: what the last complete
pass left).  Only names of files pass through the driver, and of a batch no
more than ``files_per_trigger``.  A pass that is lost is repeated by the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..operators import snapshots
from ..plans.arrival import changed_by_signature
from ..plans.catalogue import footers
from ..session import remove_path, ship_package, staging_path
from ..sources.files import store_options

_FILE = "_arrival_file"
_ARRIVAL = "caminho string, origem string, pasta string, modificado timestamp, assinatura string, primeira long, listagem long"
_READ = "caminho string, origem string, pasta string, modificado timestamp, assinatura string, primeira long, listagem long"
_REFUSED = "caminho string, assinatura string, listagem long, motivo string"


def listing(spark: SparkSession, landing: str, signature: str = "size") -> DataFrame:
    """(caminho, origem, pasta, modificado, assinatura) of the files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    mark = (F.sha2("content", 256) if signature == "hash"
            else F.concat_ws("-", F.col("length").cast("string"), F.unix_millis("modificationTime").cast("string")))
    return files.select(F.col("_metadata.file_path").alias("caminho"), F.col("path").alias("origem"),
                        F.regexp_replace("path", "/[^/]*$", "").alias("pasta"), F.col("modificationTime").alias("modificado"),
                        mark.alias("assinatura"))


def _batches(spark: SparkSession, folder: str, schema, after: int) -> DataFrame:
    """What the batches after one have written to ``folder``."""
    lots = [f"{folder}/{n}" for n in snapshots._names(spark, folder) if int(n.split("=")[1]) > after]
    return spark.read.schema(schema).parquet(*lots) if lots else spark.createDataFrame([], schema)


class _State:
    """What earlier passes left."""

    def __init__(self, spark: SparkSession, checkpoint: str, note: StructType):
        self.spark, self.at, self.note = spark, checkpoint, note
        self.number, told = snapshots.pointed(spark, f"{checkpoint}/publicado") or (0, {"lote": -1, "compacta": None})
        self.last, self.compact = told["lote"], told["compacta"]

    def _kept(self, name: str, schema) -> DataFrame:
        if self.compact is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.at}/compacta/{self.compact}/{name}")

    def fresh(self, name: str, schema) -> DataFrame:
        return _batches(self.spark, f"{self.at}/{name}", schema, self.last)

    def files(self) -> DataFrame:
        """The last version read of each file."""
        every = self._kept("lidos", _READ).unionByName(self.fresh("lidos", _READ))
        rest = [c for c in every.columns if c not in ("caminho", "listagem")]
        latest = F.max(F.struct("listagem", *rest)).alias("r")
        return every.groupBy("caminho").agg(latest).select("caminho", "r.listagem", *[f"r.{c}" for c in rest])

    def notes(self) -> DataFrame:
        """The keys that each file's last read version holds, with the file's columns."""
        every = self._kept("notas", self.note).unionByName(self.fresh("notas", self.note)).distinct()
        return every.join(self.files(), ["caminho", "listagem"])


def arrival_merge(spark: SparkSession, landing: str, schema: StructType, table: str, key: str,
                  transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                  checkpoint: str | None = None, files_per_trigger: int | None = None,
                  signature: str = "size", delivery: str = "listing") -> str:
    """Run one availableNow pass into the versioned ``table``; returns the
    checkpoint location (reuse it for the next pass)."""
    ship_package(spark)
    checkpoint = checkpoint or staging_path(spark, "arrival-checkpoint")
    note = StructType([schema[key]]).add("caminho", StringType()).add("listagem", "long")
    state = _State(spark, checkpoint, note)
    per_trigger = files_per_trigger or 1000

    # the listing: files that are new, or whose signature is not that of the last version read
    number = max([int(n) for n in snapshots._names(spark, f"{checkpoint}/chegadas") if n.isdigit()], default=0) + 1
    known = state.files().select(F.upper("caminho").alias("chave"), "assinatura", "caminho", "primeira")
    changed = changed_by_signature(listing(spark, landing, signature), known, "caminho", "assinatura").filter("ALTERADO")
    arrived = changed.join(known.select("caminho", "primeira"), "caminho", "left").select(
        "caminho", "origem", "pasta", "modificado", "assinatura", F.coalesce("primeira", F.lit(number)).cast("long").alias("primeira"),
        F.lit(number).cast("long").alias("listagem"))
    (arrived.write.option("maxRecordsPerFile", per_trigger).parquet(f"{checkpoint}/chegadas/{number:010d}"))

    def read(paths: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*paths).withColumn(_FILE, F.col("_metadata.file_path"))

    def note_files(batch: DataFrame, batch_id: int) -> None:
        own = batch.select(*[c.split()[0] for c in _READ.split(", ")])
        told = own.select("origem").mapInArrow(footers(store_options(spark)), "origem string, n long, c int, motivo string")
        judged = own.join(told.select("origem", "n", "motivo"), "origem").persist()
        bad = judged.filter(F.col("n").isNull())
        bad.select("caminho", "assinatura", "listagem", F.coalesce("motivo", F.lit("not a parquet file")).alias("motivo")).write.mode(
            "overwrite").parquet(f"{checkpoint}/quarentena/lote={batch_id}")
        good = judged.filter("n is not null").drop("n", "motivo")
        good.write.mode("overwrite").parquet(f"{checkpoint}/lidos/lote={batch_id}")
        paths = [r[0] for r in good.select("origem").collect()]
        if paths:
            keys = read(paths).select(key, F.col(_FILE).alias("caminho")).distinct().join(good.select("caminho", "listagem"), "caminho")
            keys.select(key, "caminho", "listagem").write.mode("overwrite").parquet(f"{checkpoint}/notas/lote={batch_id}")
        judged.unpersist()

    stream = spark.readStream.schema(_ARRIVAL).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{checkpoint}/chegadas")
    query = stream.writeStream.foreachBatch(note_files).option("checkpointLocation", f"{checkpoint}/fluxo").trigger(availableNow=True).start()
    query.awaitTermination()
    _publish(spark, state, checkpoint, table, key, read, lambda rows: transform(rows.select(*schema.names)), delivery)
    return checkpoint


def _publish(spark, state: _State, checkpoint: str, table: str, key: str, read, transform, delivery: str) -> None:
    """One version with every key that this pass touched, then the state."""
    lots = [int(n.split("=")[1]) for n in snapshots._names(spark, f"{checkpoint}/lidos")]
    if max(lots, default=-1) <= state.last:
        return
    compact = f"{checkpoint}/compacta/{uuid.uuid4().hex[:12]}"
    state.files().write.parquet(f"{compact}/lidos")
    files = spark.read.schema(_READ).parquet(f"{compact}/lidos")
    notes = state.notes()
    notes.select(key, "caminho", "listagem").write.parquet(f"{compact}/notas")
    live = spark.read.schema(state.note).parquet(f"{compact}/notas").join(files, ["caminho", "listagem"])

    fresh = state.fresh("lidos", _READ).select("caminho").distinct()
    before = state._kept("notas", state.note).unionByName(state.fresh("notas", state.note))
    touched = before.join(fresh, "caminho", "left_semi").select(key).distinct()
    first = "primeira" if delivery == "listing" else F.lit(0).cast("long").alias("primeira")
    of = live.join(touched, key, "left_semi").select(key, "caminho", "origem", "pasta", first, "listagem", "modificado")
    by = [key, "pasta", "primeira"]
    deliveries = of.groupBy(*by).agg(F.max("listagem").alias("listagem"), F.max("modificado").alias("modificado"))
    latest = deliveries.groupBy(key).agg(F.max(F.struct("listagem", "modificado", "pasta", "primeira")).alias("m"))
    wanted = of.join(latest.select(key, "m.pasta", "m.primeira"), by, "left_semi").select(key, "caminho", "origem")
    # a key that would need a file which can't be read now waits as it is
    refused = _batches(spark, f"{checkpoint}/quarentena", _REFUSED, -1).groupBy("caminho").agg(F.max("listagem").alias("recusada"))
    broken = refused.join(files.select("caminho", "listagem"), "caminho").filter(F.col("recusada") > F.col("listagem")).select("caminho")
    waiting = wanted.join(broken, "caminho", "left_semi").select(key).distinct()
    touched = touched.join(waiting, key, "left_anti")
    wanted = wanted.join(waiting, key, "left_anti")

    work = staging_path(spark, "arrival-keys")
    touched.write.parquet(f"{work}/chaves")
    wanted.write.parquet(f"{work}/arquivos")
    touched = spark.read.schema(StructType([state.note[key]])).parquet(f"{work}/chaves")
    wanted = spark.read.schema(StructType([state.note[key]]).add("caminho", "string").add("origem", "string")).parquet(f"{work}/arquivos")
    names = [r[0] for r in wanted.select("origem").distinct().collect()]
    if names:
        rows = read(names).join(wanted.withColumnRenamed("caminho", _FILE), [key, _FILE], "left_semi")
        snapshots.commit(transform(rows), table, key, touched)
    elif not touched.isEmpty() and snapshots.version(spark, table) is not None:
        snapshots.commit(snapshots.read(spark, table).limit(0), table, key, touched)
    remove_path(spark, work)

    snapshots.point(spark, f"{checkpoint}/publicado", snapshots.last_number(spark, f"{checkpoint}/publicado") + 1,
                    {"lote": max(lots), "compacta": compact.rsplit("/", 1)[1]})
    for name in ("lidos", "notas"):
        for lot in snapshots._names(spark, f"{checkpoint}/{name}"):
            if int(lot.split("=")[1]) <= max(lots):
                remove_path(spark, f"{checkpoint}/{name}/{lot}")
    if state.compact is not None:
        remove_path(spark, f"{checkpoint}/compacta/{state.compact}")


def quarantined(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(caminho, assinatura, listagem, motivo): every refusal so far."""
    return _batches(spark, f"{checkpoint}/quarentena", _REFUSED, -1)
