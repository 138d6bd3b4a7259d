"""Death-record curation flows (modern era, old era, preliminary) and the
cross-era annual summary.

One lazy plan per batch: landing null tokens -> oncology filter -> in-place
decode + derived age/year/municipality -> column policy -> synonym
resolution -> readable names -> label lookups.  Every step is a native
expression or a size-checked broadcast lookup, so the whole record stream
stays in one codegen stage between scan and write; the only shuffle-free
joins are against code tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.domains import MORTALITY_MODERN, MORTALITY_OLD, decode_else_default
from ..operators import filters as fl
from ..operators import lookups as L
from ..operators import merge as M
from ..operators import policy as P
from ..operators import rollups as R
from .projection import Derived, Keep, Spec, apply_spec

# Where the cause of death may be stored in old-era layouts.
OLD_CAUSE_CANDIDATES = ["CAUSABAS", "CAUSAMORT", "CAUSAM", "CAUSABAS_O"]


class References:
    """Code tables used by the label lookups (any may be None)."""

    def __init__(self, causes=None, occupations=None, states=None, countries=None, synonyms=None):
        self.causes, self.occupations, self.states, self.countries = causes, occupations, states, countries
        self.synonyms = synonyms  # (COD_MUNICIPIO_ANTIGO, COD_MUNICIPIO_ATUAL)


def _q(c):
    return F.col(f"`{c}`")


@dataclass(frozen=True)
class Era:
    """What differs between the layouts of the eras."""

    causes: tuple[str, ...]
    keep: object  # Column -> Column: the era's oncology filter
    domains: dict
    derived: tuple[Derived, ...]
    drop: tuple[str, ...]


# IDADE, the date and the municipality give the published age, year and code.
ERAS = {
    "modern": Era(("CAUSABAS",), fl.icd10_onco, MORTALITY_MODERN,
                  (Derived("IDADE", "IDADE_ANOS", C.age_unit_value), Derived("DTOBITO", "ANO_OBITO", C.year_ddmmyyyy),
                   Derived("CODMUNRES", "CO_IBGE_RESIDENCIA", C.municipality_code6)), tuple(P.MORTALITY_DROP)),
    "old": Era(tuple(OLD_CAUSE_CANDIDATES), fl.icd9_malignant, MORTALITY_OLD,
               (Derived("IDADE", "IDADE_ANOS", C.age_unit_value), Derived("DATAOBITO", "ANO_OBITO", C.year_yymmdd),
                Derived("MUNIRES", "CO_IBGE_RESIDENCIA", C.municipality_code6)),
               (*P.MORTALITY_DROP, *P.MORTALITY_DROP_OLD_ERA)),
}


def death_spec(columns: list[str], era: Era, cause: str) -> Spec:
    """Every landed column decoded in place (D1), the derived ones, and the
    published order; the column that holds the cause is never dropped."""
    decoded = [Derived(c, c, partial(decode_else_default, domain=era.domains[c.upper()])) if c.upper() in era.domains
               else Keep(c, c) for c in columns]
    present = {c.upper() for c in columns}
    steps = [*decoded, *(d for d in era.derived if d.src in present)]
    drop = [d for d in era.drop if d != cause.upper()]
    order = P.order_columns([s.dst for s in steps], drop, P.MORTALITY_GROUPS, P.MORTALITY_TAIL, P.MORTALITY_LINEAGE)
    return Spec([s for s in steps if s.dst in order], order)


def curate_death_records(raw: DataFrame, era: str = "modern", refs: References | None = None) -> DataFrame:
    """The curated oncology death table of one batch (before the merge)."""
    refs, rules = refs or References(), ERAS[era]
    cause = P.first_present(raw, rules.causes)
    if cause is None:
        return raw.limit(0)
    kept = fl.keep(raw, rules.keep(C.null_tokens(_q(cause))))
    base = apply_spec(kept, death_spec(raw.columns, rules, cause), landing=True)
    if refs.synonyms is not None and "CO_IBGE_RESIDENCIA" in base.columns:
        base = L.synonym_resolve(base, "CO_IBGE_RESIDENCIA", refs.synonyms, "COD_MUNICIPIO_ANTIGO",
                                 "COD_MUNICIPIO_ATUAL", "COD_MUNICIPIO_ATUAL")
        base = P.column_policy(base, (), P.MORTALITY_GROUPS, P.MORTALITY_TAIL, P.MORTALITY_LINEAGE)
    out = P.rename_map(base, P.MORTALITY_NAMES)
    return describe_codes(out, refs, cause_prefix3=era == "old")


def describe_codes(df: DataFrame, refs: References, cause_prefix3: bool = False) -> DataFrame:
    """Cause label next to the cause (J1 / J2), occupation as ``code - label``
    (J3), birthplace resolved to a state or country name (J4)."""
    cols = list(df.columns)
    if refs.causes is not None and "CAUSA_BASICA" in cols:
        key = (F.substring("CAUSA_BASICA", 1, 3) if cause_prefix3
               else F.replace(F.col("CAUSA_BASICA"), F.lit("."), F.lit("")))
        df = L.lookup_label(df, key, refs.causes, "CODIGO", "DESCRICAO", "CAUSA_BASICA_DESCRICAO")
        cols.insert(cols.index("CAUSA_BASICA") + 1, "CAUSA_BASICA_DESCRICAO")
    if refs.occupations is not None and "OCUPACAO" in cols:
        df = L.lookup_concat(df, "OCUPACAO", refs.occupations, "CODIGO", "DESCRICAO")
    if refs.states is not None and refs.countries is not None and "NATURALIDADE" in cols:
        df = L.lookup_conditional(df, "NATURALIDADE", refs.states, refs.countries, "CODIGO", "DESCRICAO")
    return df.select(*[_q(c) for c in cols])


def curate_preliminary(spark, raw: DataFrame | None, refs: References, published: DataFrame | None,
                       schema_from: DataFrame) -> DataFrame:
    """Preliminary deaths: as the modern era; when nothing arrived and
    nothing was published yet, an empty table with the published schema (M6)."""
    if raw is not None:
        return curate_death_records(raw, "modern", refs)
    if published is not None:
        return published
    return M.empty_with_schema(spark, curate_death_records(schema_from, "modern", refs).schema)


# ---- annual summary across eras -----------------------------------------------------------

def year_of_file(name, era: str):
    """The year of a death-record file name."""
    n = F.col(name) if isinstance(name, str) else name
    if era == "old":
        d = F.regexp_extract(n, r"(?i)DORBR(\d{2,4})\.dbc", 1)
        yy = d.cast("int")
        return F.when(F.length(d) == 2, F.when(yy >= 79, yy + 1900).otherwise(yy + 2000)).when(d != "", yy)
    d = F.regexp_extract(n, r"(?i)DOBR(\d{4})\.dbc", 1)
    return F.when(d != "", d.cast("int"))


def era_summary(raw: DataFrame, source: str, era: str) -> DataFrame:
    """Per file, in one pass over the landed batch: all records read (A5),
    oncology records kept (the era's filter), ratio (A6); year from the name."""
    df = C.normalize_null_tokens(raw)
    cause = P.first_present(df, OLD_CAUSE_CANDIDATES if era == "old" else ["CAUSABAS"])
    pred = F.lit(False) if cause is None else (
        fl.icd9_malignant(_q(cause)) if era == "old" else fl.icd10_onco(_q(cause)))
    kv = R.kept_vs_total(df, "ARQUIVO_ORIGEM", pred, "TOTAL_OBITOS_GERAL", "TOTAL_OBITOS_CANCER")
    return kv.select(
        year_of_file("ARQUIVO_ORIGEM", era).alias("ANO"), F.lit(source).alias("FONTE"),
        F.col("ARQUIVO_ORIGEM").alias("ARQUIVO"), "TOTAL_OBITOS_GERAL", "TOTAL_OBITOS_CANCER",
        R.ratio("TOTAL_OBITOS_CANCER", "TOTAL_OBITOS_GERAL").alias("PROPORCAO_OBITOS_CANCER"),
        F.when(F.col("TOTAL_OBITOS_GERAL").isNull(), F.lit("falha ao contar registros"))
        .cast("string").alias("ERRO"))


def annual_summary(existing: DataFrame | None, batches) -> DataFrame:
    """M3 over the era summaries of this run (``batches`` = [(raw, source, era)])."""
    new = M.union_by_name([era_summary(raw, source, era) for raw, source, era in batches])
    if existing is None:
        existing = new.limit(0)
    return M.summary_upsert(existing, new)
