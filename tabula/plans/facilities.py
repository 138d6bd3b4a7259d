"""Oncology facilities (qualifications + registry + beds) and federal grants.

Facilities: F5 filter -> A1 rollup per facility -> J6 registry enrichment
with found flag -> J8 beds (A2) -> renames, unit-type decode (D5), yes/no
flags (D6), preferred order (C7).  Grants: keyword filter (F6) -> join with
the published facilities rolled up by effective registry key (C17 + A3).
All joins are left joins against a key-unique side; none can multiply rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import effective_key, is_blank, zero_pad
from ..functions.domains import ONCO_QUALIFICATIONS, UNIT_TYPE, decode_padded, flag_yes_no, lookup
from ..operators import filters as fl
from ..operators import lookups as L
from ..operators import rollups as R
from ..operators.policy import first_present, preferred_order, rename_map, whitelist

# Candidate source columns of the qualification / beds files.
QUALIFICATION_CANDIDATES = ["SGRUPHAB", "CO_HABILITACAO", "CO_HAB", "HABILITACAO", "TP_HABILITACAO"]
FACILITY_CANDIDATES = ["CNES", "CO_CNES", "CO_UNIDADE"]
ORDINANCE_CANDIDATES = ["PORTARIA"]
ORDINANCE_DATE_CANDIDATES = ["DTPORTAR"]
BEDS_CANDIDATES = ["QT_EXIST", "QTDE_EXIST", "QT_EXIST_", "NULEITOS", "QTLEITOS"]

# Registry columns -> published names.
REGISTRY_NAMES = {
    "CNES": "COD_CNES", "NU_CNPJ": "CNPJ", "NU_CNPJ_MANTENEDORA": "CNPJ_MANTENEDORA",
    "NO_RAZAO_SOCIAL": "RAZAO_SOCIAL", "NO_FANTASIA": "NOME_FANTASIA", "CO_UF": "COD_UF",
    "CO_IBGE": "COD_MUNICIPIO", "CO_CEP": "CEP", "NO_LOGRADOURO": "LOGRADOURO", "NU_ENDERECO": "NUMERO_ENDERECO",
    "NO_BAIRRO": "BAIRRO", "NU_LATITUDE": "LATITUDE", "NU_LONGITUDE": "LONGITUDE", "NU_TELEFONE": "TELEFONE",
    "NO_EMAIL": "EMAIL", "CO_NATUREZA_JUR": "COD_NATUREZA_JURIDICA",
    "CO_ESFERA_ADMINISTRATIVA": "COD_ESFERA_ADMINISTRATIVA", "DS_ESFERA_ADMINISTRATIVA": "ESFERA_ADMINISTRATIVA",
    "TP_UNIDADE": "COD_TIPO_UNIDADE", "ST_CENTRO_CIRURGICO": "TEM_CENTRO_CIRURGICO",
    "ST_CENTRO_OBSTETRICO": "TEM_CENTRO_OBSTETRICO", "ST_CENTRO_NEONATAL": "TEM_CENTRO_NEONATAL",
    "ST_ATEND_HOSPITALAR": "TEM_ATENDIMENTO_HOSPITALAR", "ST_SERVICO_APOIO": "TEM_SERVICO_APOIO",
    "ST_ATEND_AMBULATORIAL": "TEM_ATENDIMENTO_AMBULATORIAL",
}
FLAG_COLUMNS = ["TEM_CENTRO_CIRURGICO", "TEM_CENTRO_OBSTETRICO", "TEM_CENTRO_NEONATAL",
                "TEM_ATENDIMENTO_HOSPITALAR", "TEM_SERVICO_APOIO", "TEM_ATENDIMENTO_AMBULATORIAL"]
FACILITY_ORDER = [
    "COD_CNES", "RAZAO_SOCIAL", "NOME_FANTASIA", "CNPJ", "CNPJ_MANTENEDORA",
    "HABILITACOES_ONCOLOGIA", "QTD_HABILITACOES_ONCOLOGIA", "TEM_ONCOLOGIA_PEDIATRICA",
    "PORTARIAS", "DATA_PORTARIA_MAIS_ANTIGA", "COD_TIPO_UNIDADE", "TIPO_UNIDADE",
    "ESFERA_ADMINISTRATIVA", "COD_ESFERA_ADMINISTRATIVA", "COD_NATUREZA_JURIDICA", "TOTAL_LEITOS_CNES",
    "TEM_CENTRO_CIRURGICO", "TEM_CENTRO_OBSTETRICO", "TEM_CENTRO_NEONATAL",
    "TEM_ATENDIMENTO_HOSPITALAR", "TEM_ATENDIMENTO_AMBULATORIAL", "TEM_SERVICO_APOIO",
    "COD_MUNICIPIO", "COD_UF", "CEP", "LOGRADOURO", "NUMERO_ENDERECO", "BAIRRO",
    "LATITUDE", "LONGITUDE", "TELEFONE", "EMAIL", "ENCONTRADO_NO_CNES",
]

QUAL_CODES = list(ONCO_QUALIFICATIONS)
QUAL_LABEL = {k: v[0] for k, v in ONCO_QUALIFICATIONS.items()}
QUAL_PAED = [k for k, v in ONCO_QUALIFICATIONS.items() if v[1]]


def _q(c):
    return F.col(f"`{c}`")


def facility_code(c):
    """Facility key: trimmed, zero-padded to 7 (never truncated); null -> ''."""
    return zero_pad(F.trim(c), 7, null_as_empty=True)


def rollup_qualifications(hab: DataFrame) -> DataFrame:
    """F5 + A1: one row per facility with oncology qualifications."""
    q = first_present(hab, QUALIFICATION_CANDIDATES)
    k = first_present(hab, FACILITY_CANDIDATES)
    if k is None:
        raise ValueError(f"no facility column among {FACILITY_CANDIDATES}: {hab.columns}")
    if q is None:
        hab = hab.limit(0)
        q = k
    ordinance = first_present(hab, ORDINANCE_CANDIDATES)
    date = first_present(hab, ORDINANCE_DATE_CANDIDATES)
    h = fl.keep(hab, fl.code_set_tolerant(_q(q), QUAL_CODES))
    norm = fl.normalized_code(_q(q))
    label = F.coalesce(lookup(QUAL_LABEL, norm),
                       F.concat(F.lit("Código "), F.trim(_q(q)), F.lit(" (não catalogado)")))
    h = h.select(facility_code(_q(k)).alias("CNES"), label.alias("_label"), norm.isin(QUAL_PAED).alias("_paed"),
                 (_q(ordinance) if ordinance else F.lit(None).cast("string")).alias("_ord"),
                 (_q(date) if date else F.lit(None).cast("string")).alias("_date"))
    aggs = [F.bool_or("_paed").alias("TEM_ONCOLOGIA_PEDIATRICA"),
            F.count("_label").alias("QTD_HABILITACOES_ONCOLOGIA"),
            R.sorted_distinct_list("_label").alias("HABILITACOES_ONCOLOGIA")]
    if ordinance:
        aggs.append(R.sorted_distinct_list("_ord", skip_blank=True).alias("PORTARIAS"))
    if date:
        aggs.append(F.min("_date").alias("DATA_PORTARIA_MAIS_ANTIGA"))
    return h.groupBy("CNES").agg(*aggs)


def beds_by_facility(beds: DataFrame) -> DataFrame | None:
    """A2: numeric beds summed per facility; null when no value is numeric."""
    k, q = first_present(beds, FACILITY_CANDIDATES), first_present(beds, BEDS_CANDIDATES)
    if k is None or q is None:
        return None
    t = F.trim(_q(q))
    num = F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), t.try_cast("double"))
    return (beds.select(facility_code(_q(k)).alias("CNES"), num.alias("_q"))
            .groupBy("CNES").agg(F.bround(R.sum_all_null("_q")).cast("bigint").alias("TOTAL_LEITOS_CNES")))


def curate_facilities(hab: DataFrame, registry: DataFrame | None, beds: DataFrame | None) -> DataFrame:
    inst = rollup_qualifications(hab)
    if registry is not None:
        reg = registry.withColumn("CO_CNES", facility_code(F.col("CO_CNES")))
        # only the published registry columns are read; none of the others may reach the output
        reg = whitelist(reg, ["CO_CNES", *(c for c in REGISTRY_NAMES if c != "CNES")])
        order = [c for c in reg.columns if c != "CO_CNES"]
        df = L.enrich_found_flag(inst, "CNES", reg, "CO_CNES", "ENCONTRADO_NO_CNES", order)
    else:
        df = inst.withColumn("ENCONTRADO_NO_CNES", F.lit(False))
    b = beds_by_facility(beds) if beds is not None else None
    if b is not None:
        df = df.join(b, "CNES", "left")
    df = rename_map(df, {k: v for k, v in REGISTRY_NAMES.items()})
    df = df.select(*[_q(c).alias(c.upper()) for c in df.columns])
    if "COD_TIPO_UNIDADE" in df.columns:
        df = df.withColumn("TIPO_UNIDADE", decode_padded("COD_TIPO_UNIDADE", UNIT_TYPE, 2))
    for c in FLAG_COLUMNS:
        if c in df.columns:
            df = df.withColumn(c, flag_yes_no(c))
    return preferred_order(df, FACILITY_ORDER)


# ---- grants -------------------------------------------------------------------------------

GRANT_TEXT = "OBJETO DO CONVÊNIO"
GRANT_KEY = "CÓDIGO CONVENENTE"


def facilities_by_effective_key(fac: DataFrame) -> DataFrame:
    """C17 + A3: facilities rolled up by their own registry key, else the
    parent's; "first" values by facility code order."""
    if "CNPJ_MANTENEDORA" in fac.columns:
        key, via = effective_key("CNPJ", "CNPJ_MANTENEDORA")
    else:
        key, via = F.col("CNPJ"), F.lit(False)
    f = fac.select("*", key.alias("_CNPJ_EFETIVO"), via.alias("_VIA")).filter(~is_blank("_CNPJ_EFETIVO"))
    o = F.col("COD_CNES")

    def first(c):
        return R.first_non_null(c, o) if c in fac.columns else F.lit(None).cast("string")

    return f.groupBy("_CNPJ_EFETIVO").agg(
        F.bool_or("TEM_ONCOLOGIA_PEDIATRICA").alias("CNES_TEM_ONCOLOGIA_PEDIATRICA"),
        first("NOME_FANTASIA").alias("CNES_NOME_FANTASIA"),
        first("RAZAO_SOCIAL").alias("CNES_RAZAO_SOCIAL"),
        R.sorted_distinct_list("HABILITACOES_ONCOLOGIA").alias("CNES_HABILITACOES"),
        F.count(F.lit(1)).alias("CNES_QTD_UNIDADES_VINCULADAS"),
        R.sum_all_null("TOTAL_LEITOS_CNES").alias("CNES_TOTAL_LEITOS"),
        first("COD_UF").alias("CNES_COD_UF"),
        first("COD_MUNICIPIO").alias("CNES_COD_MUNICIPIO"),
        first("LOGRADOURO").alias("CNES_LOGRADOURO"),
        first("LATITUDE").alias("CNES_LATITUDE"),
        first("LONGITUDE").alias("CNES_LONGITUDE"),
        F.bool_or("_VIA").alias("CNES_VIA_CNPJ_MANTENEDORA"),
    )


def curate_grants(grants: DataFrame, facilities: DataFrame | None, keywords=fl.GRANT_KEYWORDS) -> DataFrame:
    g = fl.keep(grants, fl.keyword_match(_q(GRANT_TEXT), keywords))
    if facilities is None or GRANT_KEY not in grants.columns:
        return g
    k = facilities_by_effective_key(facilities)
    j = L.enrich_found_flag(g, GRANT_KEY, k, "_CNPJ_EFETIVO", "HABILITADO_CNES_ONCOLOGIA")
    return j
