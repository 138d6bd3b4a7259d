"""Geography reference: health-region table + geolocation sheet + municipal
registry complement (J9), normalised headers (C5), harmonic order (C7), and
the municipal synonym map (R3) published next to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import normalize_header, zero_pad
from ..operators import lookups as L
from ..operators import reshape as R
from ..operators.policy import preferred_order, present

# Normalised source header -> published name.
GEO_NAMES = {"COD_MUNICIPIO": "COD_MUNICIPIO", "NO_MUNICIPIO": "NOME_MUNICIPIO", "AREA": "AREA_KM2",
             "SITUACAO": "SITUACAO_MUNICIPIO", "CAPITAL": "EH_CAPITAL", "MESOCOD": "COD_MESORREGIAO",
             "MICROCOD": "COD_MICRORREGIAO"}
# Published column order (country -> municipality -> location).
GEO_ORDER = [
    "CO_REGIAO_PAIS", "REGIAO_PAIS", "CO_UF", "SG_UF", "UF",
    "COD_MACRORREGIAO_DE_SAUDE", "MACRORREGIAO_DE_SAUDE", "COD_REGIAO_DE_SAUDE", "REGIAO_DE_SAUDE",
    "COD_MESORREGIAO", "COD_MICRORREGIAO",
    "COD_MUNICIPIO", "MUNCODDV", "NOME_MUNICIPIO", "EH_CAPITAL", "SITUACAO_MUNICIPIO", "POPULACAO_IBGE_2022",
    "LATITUDE", "LONGITUDE", "ALTITUDE", "AREA_KM2",
]
# What the municipal registry adds to the other two sources.
REGISTRY_COMPLEMENT = ["MUNCOD", "SITUACAO", "CAPITAL", "MESOCOD", "MICROCOD"]


def _pad6(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, zero_pad(F.col(f"`{col}`"), 6))


def curate_geography(health: DataFrame, geo: DataFrame, registry: DataFrame) -> DataFrame:
    key = present(health, "cod_municipio")
    health = _pad6(health, key)
    geo = _pad6(geo, present(geo, "MUNCOD"))
    cad = registry.select(*[F.col(f"`{p}`") for p in (present(registry, c) for c in REGISTRY_COMPLEMENT) if p])
    cad = _pad6(cad, present(cad, "MUNCOD"))
    j = L.three_way_reference(health, [(geo, key, present(geo, "MUNCOD")), (cad, key, present(cad, "MUNCOD"))])
    renamed = [F.col(f"`{c}`").alias(GEO_NAMES.get(normalize_header(c), normalize_header(c))) for c in j.columns]
    return preferred_order(j.select(*renamed), GEO_ORDER)


def municipal_synonyms(registry: DataFrame, order: str) -> DataFrame:
    """R3 over the registry: old code -> current code (sorted on write)."""
    return R.synonym_map(registry, present(registry, "MUNCOD"), present(registry, "SITUACAO"),
                         present(registry, "MUNSINON"), order)
