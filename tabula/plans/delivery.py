"""One incremental run of a microdata source, from listing to summary.

listing and headers (P1, read report) -> names of the series (P2) -> recency
window and sizes against the manifest (P6, P7) -> one read of the files that
can be read, staged with a kept flag -> curated rows replace the files' old
ones (M1, an atomic version) -> the same staged read gives the counts of the
annual summary (A4-A6, M3) -> manifest of what was published (P11).

A file that cannot be read is told in the report, keeps its published rows and
its manifest entry, and the others go on; a file read without a surviving row
loses its old ones.  The manifest is written after the rows, so a run that is
lost in between is repeated by the next one, with the same outcome.  Published
rows, summary and manifest are versioned tables (``operators.snapshots``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import filters as fl
from ..operators import merge as M
from ..operators import snapshots
from ..session import remove_path, staging_path
from ..sources import dbf
from . import arrival as A
from . import mortality as MO
from . import outpatient as OP

FILE, KEPT = "ARQUIVO_ORIGEM", "_mantido"
PUBLISHED, UNCHANGED, OUTSIDE, BROKEN, FOREIGN = "publicado", "inalterado", "fora da janela", "quarentena", "outro nome"
MANIFEST = "pasta string, chave string, assinatura string"


@dataclass(frozen=True)
class Microdata:
    """What a source is: its file names, layout, filter, curation and counts."""

    folder: str  # of the manifest
    layout: str  # columns of a record, as a schema without the file name
    named: Callable[[Column], Column]  # file name -> whether it belongs to the series
    keep: Callable[[DataFrame], Column]
    curate: Callable[[DataFrame], DataFrame]
    summary: Callable[[DataFrame | None, DataFrame], DataFrame] | None = None
    periods: int = 2
    suffix: str = ".dbc"


@dataclass(frozen=True)
class Places:
    """Where a source lands and what is published of it."""

    landing: str
    table: str
    manifest: str
    summary: str | None = None


def deaths(refs: MO.References, layout: str, source: str = "CID10") -> Microdata:
    """The modern death records as a source."""
    era = MO.ERAS["modern"]
    return Microdata(
        folder="sim", layout=layout, named=lambda n: A.death_file_year(n, "DOBR").isNotNull(),
        keep=lambda raw: era.keep(MO.C.null_tokens(F.col(era.causes[0]))), curate=lambda raw: MO.curate_death_records(raw, "modern", refs),
        summary=lambda old, read: MO.annual_summary(old, [(read, source, "modern")]))


def authorizations(prefix: str, causes: DataFrame | None, layout: str) -> Microdata:
    """Outpatient authorizations (AQ chemotherapy, AR radiotherapy, AM drugs) as a source: every record of AQ and AR is kept."""
    curate = {"AQ": OP.curate_chemo, "AR": OP.curate_radio, "AM": OP.curate_drugs}[prefix]

    def named(name: Column) -> Column:
        told = {c: v for c, v in zip(("PREFIXO", "UF", "ANO", "MES", "VALIDO"), A.authorization_attributes(name))}
        return (told["PREFIXO"] == prefix) & told["VALIDO"]

    def keep(raw: DataFrame) -> Column:
        return fl.drug_onco(F.col("AP_CIDPRI")) if prefix == "AM" else F.lit(True)

    return Microdata(folder=f"siasus_{prefix.lower()}", layout=layout, named=named, keep=keep, curate=lambda raw: curate(raw, causes))


def plan(spark: SparkSession, source: Microdata, places: Places) -> DataFrame:
    """(nome, caminho, tamanho, assinatura, motivo, ACAO) of every landed file."""
    report = dbf.read_report(spark, places.landing, source.suffix).select(
        F.col("ARQUIVO").alias("nome"), F.col("CAMINHO").alias("caminho"), F.col("TAMANHO").alias("tamanho"),
        F.col("TAMANHO").cast("string").alias("assinatura"), F.col("MOTIVO").alias("motivo"))
    listing = A.dedupe_case_insensitive(report, "nome", tie="caminho", suffix=source.suffix)
    own = F.coalesce(source.named(F.col("nome")), F.lit(False))
    manifest = _manifest(spark, source, places)
    series = listing.filter(own)
    window = A.recency_window_plan(series, manifest, "nome", n=source.periods)
    judged = A.changed_by_signature(window, manifest, "nome", "assinatura")
    action = F.when(~F.col("ALTERADO"), UNCHANGED).when(F.col("motivo").isNotNull(), BROKEN).otherwise(PUBLISHED)
    planned = judged.withColumn("ACAO", action).drop("ALTERADO")
    rest = series.join(planned.select("nome"), "nome", "left_anti").withColumn("ACAO", F.lit(OUTSIDE))
    return planned.unionByName(rest).unionByName(listing.filter(~own).withColumn("ACAO", F.lit(FOREIGN)))


def _manifest(spark: SparkSession, source: Microdata, places: Places) -> DataFrame:
    every = snapshots.read(spark, places.manifest)
    every = spark.createDataFrame([], MANIFEST) if every is None else every
    return every.filter(F.col("pasta") == source.folder)


def run(spark: SparkSession, source: Microdata, places: Places) -> DataFrame:
    """One run; returns its report (nome, tamanho, motivo, ACAO), fixed when
    the run ends.  The names of the run's files pass through the driver."""
    report_at, work = staging_path(spark, "entrega-relatorio"), staging_path(spark, "entrega")
    plan(spark, source, places).write.parquet(report_at)
    report = spark.read.parquet(report_at)
    taken = report.filter(F.col("ACAO") == PUBLISHED)
    names = [r[0] for r in taken.select("nome").collect()]
    if names:
        raw = dbf.scan(spark, places.landing, schema=f"{source.layout}, {FILE} string", files=names, lineage=FILE, suffix=source.suffix,
                       on_error="skip")
        # the one read: all records, since the summary counts those not kept too
        raw.withColumn(KEPT, F.coalesce(source.keep(raw), F.lit(False))).write.parquet(work)
        read = spark.read.parquet(work)
        read_keys = taken.select(F.col("nome").alias(FILE))
        snapshots.commit(source.curate(read.filter(KEPT).drop(KEPT)), places.table, FILE, read_keys)
        if source.summary is not None and places.summary is not None:
            summary = source.summary(snapshots.read(spark, places.summary), read.drop(KEPT))
            snapshots.commit(summary, places.summary, "FONTE", replace_all=True)
        new = taken.select(F.lit(source.folder).alias("pasta"), F.col("nome").alias("chave"), "assinatura")
        entries = M.manifest_upsert(_manifest(spark, source, places), new)
        snapshots.commit(entries, places.manifest, "pasta")
        remove_path(spark, work)
    return report.select("nome", "tamanho", "motivo", "ACAO")
