"""Queries for D1-D8 (domain decoding) on the binding views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import domains as D
from . import sqlbits as S
from .registry import query

SEX_MODERN = D.MORTALITY_MODERN["SEXO"]
SEX_OLD = D.MORTALITY_OLD["SEXO"]
FLAGS = {"s16": "EXPOSICAO_ASBESTO", "s17": "EXPOSICAO_BENZENO", "s18": "EXPOSICAO_OUTROS"}


@query("decode_else_default", f"""select rec_id,
  coalesce({S.lookup(SEX_MODERN, 'trim(sexo)')}, 'Ignorado') as SEXO from rec""", ["rec"])
def decode_else_default(t):
    """Unknown / null -> 'Ignorado'."""
    return t("rec").select("rec_id", D.decode_else_default("sexo", SEX_MODERN).alias("SEXO"))


@query("decode_keep_unknown", f"""select rec_id,
  coalesce({S.lookup(D.AUTH_SEX, 'trim(sexo)')}, trim(sexo)) as SEXO from rec""", ["rec"])
def decode_keep_unknown(t):
    """Unknown keeps the trimmed code; null stays null."""
    return t("rec").select("rec_id", D.decode_keep_unknown("sexo", D.AUTH_SEX).alias("SEXO"))


@query("decode_pair", f"""select rec_id, trim(ocup) as COD_ESTADIAMENTO,
  coalesce({S.lookup(D.PANEL_STAGE, "coalesce(nullif(ltrim(trim(ocup), '0'), ''), trim(ocup))")}, trim(ocup))
  as ESTADIAMENTO from rec""", ["rec"])
def decode_pair(t):
    """D3: raw code and label side by side (zero-tolerant key)."""
    return t("rec").select("rec_id", *D.decode_pair("ocup", D.PANEL_STAGE, "COD_ESTADIAMENTO", "ESTADIAMENTO",
                                                    strip_zeros=True))


@query("decode_blank_empty", f"""select rec_id, case when {S.blank('sexo')} then ''
  else coalesce({S.lookup(SEX_MODERN, 'trim(sexo)')}, trim(sexo)) end as SEXO from rec""", ["rec"])
def decode_blank_empty(t):
    """Blank -> '', unknown kept (survey convention)."""
    return t("rec").select("rec_id", D.decode_blank_empty("sexo", SEX_MODERN).alias("SEXO"))


@query("decode_padded", f"""select co_cnes,
  coalesce({S.lookup(D.UNIT_TYPE, S.pad('trim(tp_unidade)', 2))}, {S.pad('trim(tp_unidade)', 2)}) as TIPO_UNIDADE
from estab""", ["estab"])
def decode_padded(t):
    """Pad to two digits, decode, keep the padded code when unknown."""
    return t("estab").select("co_cnes", D.decode_padded("tp_unidade", D.UNIT_TYPE, 2).alias("TIPO_UNIDADE"))


@query("flag_yes_no", """select co_cnes, case when upper(trim(st_flag)) in ('1', '1.0', 'S', 'SIM', 'TRUE', 'T') then 'Sim'
  when upper(trim(st_flag)) in ('0', '0.0', 'N', 'NAO', 'NÃO', 'FALSE', 'F') then 'Não' end as TEM_CENTRO_CIRURGICO
from estab""", ["estab"])
def flag_yes_no(t):
    """yes/no spellings normalised, anything else null."""
    return t("estab").select("co_cnes", D.flag_yes_no("st_flag").alias("TEM_CENTRO_CIRURGICO"))


def _flags(lines):
    return lines.select(F.substring("value", 3, 7).alias("estrato"),
                        F.substring("value", 16, 1).alias("s16"), F.substring("value", 17, 1).alias("s17"),
                        F.substring("value", 18, 1).alias("s18"))


@query("multi_flag_decode", "select substr(value, 3, 7) as estrato, " + ", ".join(
    f"case when {S.blank(f'substr(value, {p}, 1)')} then '' else coalesce("
    f"{S.lookup(D.WORK_EXPOSURE, f'trim(substr(value, {p}, 1))')}, trim(substr(value, {p}, 1))) end as {o}"
    for p, o in zip((16, 17, 18), FLAGS.values())) + " from linhas", ["linhas"])
def multi_flag_decode(t):
    """One domain over many flag columns."""
    f = _flags(t("linhas"))
    return f.select("estrato", *D.multi_decode(FLAGS, D.WORK_EXPOSURE, D.decode_blank_empty))


@query("decode_by_era", f"""select rec_id,
  coalesce({S.lookup(SEX_MODERN, 'trim(sexo)')}, 'Ignorado') as SEXO_MODERNO,
  coalesce({S.lookup(SEX_OLD, 'trim(sexo)')}, 'Ignorado') as SEXO_ANTIGO,
  coalesce({S.lookup(D.MORTALITY_MODERN['LOCOCOR'], "cast(rec_id % 7 as varchar)")}, 'Ignorado') as LOCAL_MODERNO,
  coalesce({S.lookup(D.MORTALITY_OLD['LOCOCOR'], "cast(rec_id % 7 as varchar)")}, 'Ignorado') as LOCAL_ANTIGO
from rec""", ["rec"])
def decode_by_era(t):
    """The same field decoded by era-specific tables."""
    r = t("rec")
    loc = (F.col("rec_id") % 7).cast("string")
    return r.select("rec_id", D.decode_by_era("sexo", "modern", "SEXO").alias("SEXO_MODERNO"),
                    D.decode_by_era("sexo", "old", "SEXO").alias("SEXO_ANTIGO"),
                    D.decode_by_era(loc, "modern", "LOCOCOR").alias("LOCAL_MODERNO"),
                    D.decode_by_era(loc, "old", "LOCOCOR").alias("LOCAL_ANTIGO"))
