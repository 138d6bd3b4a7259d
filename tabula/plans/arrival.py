"""File-arrival planning (P1-P12) as table work over a file listing.

A listing is a DataFrame ``(name, size, ...)`` (e.g. from
``spark.read.format("binaryFile")`` without content, or an object-store
inventory).  Every planner is a relational operator over it: dedupe, parse,
rank, anti-join against the manifest.  Period ranking never uses a global
window (one partition); it ranks the small set of distinct periods and
broadcasts that back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import _c


def dedupe_case_insensitive(listing: DataFrame, name: str = "nome", tie: str | None = None,
                            suffix: str = ".dbc") -> DataFrame:
    """``*.dbc`` names only (case-insensitive suffix); among names equal
    ignoring case, the first by sorted name (then ``tie``) wins."""
    lst = listing.filter(F.lower(name).endswith(suffix))
    order = [name] + ([tie] if tie else [])
    rest = [c for c in listing.columns if c not in order]
    s = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_s")
    return lst.groupBy(F.upper(name).alias("_k")).agg(s).select(*[F.col(f"_s.{c}").alias(c) for c in listing.columns])


def two_digit_year(yy: Column, pivot: int) -> Column:
    """``yy >= pivot`` -> 19yy, else 20yy."""
    n = yy.try_cast("int")  # not a number: no year
    return F.when(n >= pivot, n + 1900).otherwise(n + 2000)


MORTALITY_PIVOT = 79
RECENCY_PIVOT = 90


def authorization_attributes(name) -> list[Column]:
    """``AQ/AR/AMuuAAMM.dbc`` -> prefix, state, year (20AA, valid from
    2008), month."""
    pat = r"(?i)^(AQ|AR|AM)([A-Z]{2})(\d{2})(\d{2})\.dbc$"
    n = _c(name)
    ok = n.rlike(pat)
    year = F.when(ok, F.regexp_extract(n, pat, 3).cast("int") + 2000)
    return [F.when(ok, F.upper(F.regexp_extract(n, pat, 1))).alias("PREFIXO"),
            F.when(ok, F.upper(F.regexp_extract(n, pat, 2))).alias("UF"),
            year.alias("ANO"),
            F.when(ok, F.regexp_extract(n, pat, 4).cast("int")).alias("MES"),
            F.coalesce(ok & (year >= 2008), F.lit(False)).alias("VALIDO")]


def facility_file_attributes(name) -> list[Column]:
    """``HBuuAAMM.dbc`` (qualifications) and ``LTuuAAMM.dbc`` (beds) ->
    prefix, state, period ``AAMM``."""
    pat = r"(?i)^(HB|LT)([A-Z]{2})(\d{4})\.dbc$"
    n = _c(name)
    part = lambda k: F.when(n.rlike(pat), F.upper(F.regexp_extract(n, pat, k)))
    return [part(1).alias("PREFIXO"), part(2).alias("UF"), part(3).alias("COMPETENCIA")]


# The years for which each death-record series is taken.
DEATH_YEARS = {"DORBR": (1979, 1995), "DOBR": (1996, None)}


def death_file_year(name, prefix: str) -> Column:
    """The year of ``DORBR..`` / ``DOBR..`` files, two digits by the
    mortality pivot; null outside the series' years or for other names."""
    n = F.upper(_c(name))
    d = F.regexp_extract(n, f"^{prefix}(\\d+)\\.DBC$", 1)
    year = F.when(F.length(d) == 2, two_digit_year(d, MORTALITY_PIVOT)).otherwise(d.try_cast("int"))
    first, last = DEATH_YEARS[prefix]
    return F.when((year >= first) & (F.lit(last is None) | (year <= F.lit(last))), year)


def is_cancer_notification(name) -> Column:
    """``CANC*.dbc`` files of work-related cancer notifications."""
    n = F.upper(_c(name))
    return F.coalesce(n.startswith("CANC") & n.endswith(".DBC"), F.lit(False))


def content_signatures(spark: SparkSession, path) -> DataFrame:
    """(name, path, signature) of landed files: the hash of each file's
    bytes, taken in the tasks that read it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("nome"), "path", F.sha2("content", 256).alias("assinatura"))


def recency_key(name) -> Column:
    """Digits before the extension; two digits pivot at 90; other
    lengths verbatim; no digits -> the name itself."""
    n = _c(name)
    d = F.regexp_extract(n, r"(\d+)\.\w+$", 1)
    return (F.when(d == "", n)
            .when(F.length(d) == 2, two_digit_year(d, RECENCY_PIVOT).cast("string"))
            .otherwise(d))


def period_of(name) -> Column:
    """``AAMM`` of an authorization file expanded to ``AAAAMM`` (no 99 > 24 trap)."""
    pat = r"(?i)^[A-Z]{4}(\d{2})(\d{2})\.dbc$"
    n = _c(name)
    yy = F.regexp_extract(n, pat, 1)
    return F.when(yy != "", F.concat(two_digit_year(yy, RECENCY_PIVOT).cast("string"), F.regexp_extract(n, pat, 2)))


def latest_period_slice(df: DataFrame, period: Column) -> DataFrame:
    """P5: rows whose period equals the global maximum period.  The maximum
    is one row; it is broadcast back (no global sort, no window)."""
    d = df.withColumn("_p", period)
    mx = d.agg(F.max("_p").alias("_mx"))
    return d.join(F.broadcast(mx), F.col("_p") == F.col("_mx")).drop("_p", "_mx")


def recent_periods(periods: DataFrame, col: str, n: int) -> DataFrame:
    """The ``n`` most recent distinct periods (a top-n of a tiny set)."""
    return periods.select(col).distinct().orderBy(F.col(col).desc()).limit(n)


def recency_window_plan(listing: DataFrame, manifest: DataFrame, name: str = "nome", key: str = "chave",
                        n: int = 2) -> DataFrame:
    """Files in the last ``n`` distinct recency periods, or not yet in
    the manifest."""
    lst = listing.withColumn("_rk", recency_key(F.col(name)))
    recent = recent_periods(lst, "_rk", n).withColumn("_recent", F.lit(True))
    known = manifest.select(F.col(key).alias("_known")).distinct().withColumn("_in", F.lit(True))
    j = (lst.join(F.broadcast(recent), "_rk", "left")
         .join(known, F.upper(name) == F.col("_known"), "left"))
    return j.filter(F.coalesce(F.col("_recent"), F.lit(False)) | F.col("_in").isNull()).drop(
        "_rk", "_recent", "_known", "_in")


def changed_by_signature(listing: DataFrame, manifest: DataFrame, name: str, signature: str,
                         key: str = "chave", stored: str = "assinatura") -> DataFrame:
    """A file (or view) is unchanged only when the manifest
    holds the same signature; a missing or unknown signature counts as
    changed.  Adds ``ALTERADO``."""
    m = manifest.select(F.col(key).alias("_mk"), F.col(stored).alias("_sig"))
    j = listing.join(m, F.upper(F.col(name)) == F.col("_mk"), "left")
    same = F.col(signature).isNotNull() & F.col(signature).eqNullSafe(F.col("_sig"))
    return j.withColumn("ALTERADO", ~same).drop("_mk", "_sig")


def recent_years_plan(views: DataFrame, manifest: DataFrame, view: str, key: str, current_year: int,
                      first_year: int = 2013) -> DataFrame:
    """P10: a view never published gets its whole series (first_year..current),
    a known view only the current and previous year."""
    known = manifest.select(F.upper(key).alias("_k")).distinct().withColumn("_known", F.lit(True))
    j = views.join(known, F.upper(view) == F.col("_k"), "left")
    start = F.when(F.col("_known").isNull(), F.lit(first_year)).otherwise(F.lit(current_year - 1))
    return j.select("*", F.explode(F.sequence(start, F.lit(current_year))).alias("ANO")).drop("_k", "_known")


def strip_date_prefix(name) -> Column:
    """Drop a leading ``YYYYMMDD_`` from a file name."""
    return F.regexp_replace(_c(name), r"^\d{8}_", "")


def listing_diff(remote: DataFrame, local: DataFrame, key: str, size: str, local_key: str,
                 local_size: str) -> DataFrame:
    """K4: full outer join of two listings -> action per key: ``baixar``
    (missing locally or size differs), ``reaproveitar`` (same size),
    ``apagar`` (orphan local entry)."""
    r = remote.select(F.col(key).alias("_rk"), F.col(size).alias("_rs"))
    lo = local.select(F.col(local_key).alias("_lk"), F.col(local_size).alias("_ls"))
    j = r.join(lo, F.col("_rk") == F.col("_lk"), "full_outer")
    action = (F.when(F.col("_rk").isNull(), "apagar")
              .when(F.col("_lk").isNull() | ~F.col("_rs").eqNullSafe(F.col("_ls")), "baixar")
              .otherwise("reaproveitar"))
    return j.select(F.coalesce("_rk", "_lk").alias("CHAVE"), action.alias("ACAO"))
