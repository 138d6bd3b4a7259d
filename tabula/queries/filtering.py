"""Queries for F1-F10 (row predicates) on the binding views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.domains import ONCO_QUALIFICATIONS
from ..operators import filters as fl
from . import sqlbits as S
from .registry import query

QUAL_CODES = list(ONCO_QUALIFICATIONS)
# Keywords for the grant filter on the driver's prose (the feature takes the list as a parameter).
DOC_KEYWORDS = ["data", "système", "inca ", "año", "über"]


@query("icd10_onco_filter", f"select rec_id, causabas from rec where {S.f1('causabas')}", ["rec"])
def icd10_onco_filter(t):
    """F1 as coded: C00-C97, D00-D48, B21."""
    return fl.keep(t("rec"), fl.icd10_onco("causabas")).select("rec_id", "causabas")


@query("icd10_malignant_filter", f"select rec_id, causabas from rec where {S.f1('causabas', True)}", ["rec"])
def icd10_malignant_filter(t):
    """C00-C97 only."""
    return fl.keep(t("rec"), fl.icd10_onco("causabas", malignant_only=True)).select("rec_id", "causabas")


@query("icd9_malignant_filter", f"select rec_id, causa9 from rec where {S.f3('causa9')}", ["rec"])
def icd9_malignant_filter(t):
    """three leading digits in 140..208."""
    return fl.keep(t("rec"), fl.icd9_malignant("causa9")).select("rec_id", "causa9")


@query("drug_onco_filter", f"select rec_id, causabas from rec where {S.f4('causabas')}", ["rec"])
def drug_onco_filter(t):
    """oncology drug scope."""
    return fl.keep(t("rec"), fl.drug_onco("causabas")).select("rec_id", "causabas")


@query("code_set_tolerant", f"select cnes, sgruphab from hab where {S.f5('sgruphab', QUAL_CODES)}", ["hab"])
def code_set_tolerant(t):
    """qualification code membership tolerant of dots / leading zeros."""
    return fl.keep(t("hab"), fl.code_set_tolerant("sgruphab", QUAL_CODES)).select("cnes", "sgruphab")


@query("keyword_filter", "select doc_id, source from documents where regexp_matches(lower(text), '"
       + fl.keyword_pattern(DOC_KEYWORDS).replace("'", "''") + "')")
def keyword_filter(t):
    """case-insensitive keyword alternation over whole texts."""
    d = t("documents")
    return fl.keep(d, fl.keyword_match("text", DOC_KEYWORDS)).select("doc_id", "source")


@query("fixed_width_filter", "select value from linhas where substr(value, 11, 1) = '1'", ["linhas"])
def fixed_width_filter(t):
    """raw-line position equality before parsing."""
    return fl.keep(t("linhas"), fl.fixed_width_equals("value", 11, 1, "1"))


@query("fixed_width_two_predicates", """select value from linhas
where substr(value, 10, 1) = '2' and trim(substr(value, 11, 1)) <> ''""", ["linhas"])
def fixed_width_two_predicates(t):
    """F8: sex = 2 and the block answered."""
    line = F.col("value")
    return fl.keep(t("linhas"), fl.fixed_width_equals(line, 10, 1, "2") & fl.not_blank(F.substring(line, 11, 1)))


@query("active_reference_filter", f"""select muncod, situacao from cadmun
where upper(trim(situacao)) = 'ATIVO' and {S.pad('muncod', 6)} <> '000000' and not ends_with({S.pad('muncod', 6)}, '9999')""",
       ["cadmun"])
def active_reference_filter(t):
    """active and a real municipality."""
    return fl.keep(t("cadmun"), fl.active_reference("situacao", "muncod")).select("muncod", "situacao")
