"""End-to-end deliveries: read, filter, curate, replace by file, publish.

The whole landing is curated and published; then every file of an odd year is
delivered again, with only its even records, and the files of the years that
end in 7 with none.  What is read back holds the even years as they were, the
odd ones as re-delivered, and nothing of the emptied files (M1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import snapshots as S
from ..plans import mortality as MO
from ..plans import outpatient as OP
from ..session import staging_path
from . import curation as CU
from .registry import ORACLES, query

FILE = "ARQUIVO_ORIGEM"
_YEAR = r"([0-9]{4})\.dbc$"


def _deliver_twice(t, landed, record, curate):
    """``curate`` over the first delivery and over the second one of the odd years."""
    path = staging_path(t.spark, "incremental")
    year = F.regexp_extract(FILE, _YEAR, 1).cast("int")
    again = landed.filter(year % 2 == 1)
    kept = again.filter((year % 10 != 7) & (F.col(record).cast("bigint") % 2 == 0))
    first = curate(landed)
    S.commit(first, path, FILE)
    S.commit(curate(kept), path, FILE, again)
    S.vacuum(t.spark, path, keep=1)
    return S.read(t.spark, path)


def _oracle(flow: str, record: str) -> str:
    """The flow's rows that the two deliveries leave."""
    year = "cast(regexp_extract(ARQUIVO_ORIGEM, '([0-9]{4})[.]dbc$', 1) as integer)"
    return f"select * from ({ORACLES[flow]}) f where {year} % 2 = 0 or ({year} % 10 <> 7 and cast({record} as bigint) % 2 = 0)"


@query("incremental_mortality", _oracle("curate_mortality_modern", "ID_REGISTRO"))
def incremental_mortality(t):
    """Death records delivered twice, replaced by file."""
    return _deliver_twice(t, CU._landed(t, "sim_do"), "CONTADOR", lambda raw: MO.curate_death_records(raw, "modern", CU._refs(t)))


@query("incremental_chemo", _oracle("curate_chemo", "NUM_APAC"))
def incremental_chemo(t):
    """Chemotherapy authorizations delivered twice, replaced by file."""
    return _deliver_twice(t, t("apac_aq"), "AP_AUTORIZ", lambda raw: OP.curate_chemo(raw, t("ref_cid10")))


@query("incremental_radio", _oracle("curate_radio", "NUM_APAC"))
def incremental_radio(t):
    """Radiotherapy authorizations delivered twice, replaced by file."""
    return _deliver_twice(t, t("apac_ar"), "AP_AUTORIZ", lambda raw: OP.curate_radio(raw, t("ref_cid10")))


@query("incremental_drugs", _oracle("curate_drugs", "NUM_APAC"))
def incremental_drugs(t):
    """Drug authorizations (filtered by diagnosis) delivered twice, replaced by file."""
    return _deliver_twice(t, t("apac_am"), "AP_AUTORIZ", lambda raw: OP.curate_drugs(raw, t("ref_cid10")))
