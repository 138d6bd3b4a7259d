"""Queries for C1-C24 (cleaning, parsing, schema policy) on the binding views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import policy as P
from . import sqlbits as S
from .registry import query

# token column over rec: the landing null tokens, two look-alikes kept, else the code
TOKEN_SQL = ("case rec_id % 10 when 0 then 'nan' when 1 then 'NaN' when 2 then 'NaT' when 3 then 'None' "
             "when 4 then '' when 5 then '<NA>' when 6 then 'NULL' when 7 then 'nat' else causabas end")


def _nt(c):
    return f"case when {c} in ('nan', 'NaN', 'NaT', 'None', '', '<NA>') then null else {c} end"


@query("null_tokens", f"""select rec_id, {_nt(f'({TOKEN_SQL})')} as valor, {_nt('causabas')} as causabas,
  {_nt('idade')} as idade, {_nt('sexo')} as sexo, {_nt('munres')} as munres from rec""", ["rec"])
def null_tokens(t):
    """C1 over every string column in one projection."""
    df = t("rec").select("rec_id", F.expr(TOKEN_SQL).alias("valor"), "causabas", "idade", "sexo", "munres")
    return C.normalize_null_tokens(df)


def _ift(c):
    return f"case when {c} = floor({c}) then cast(cast({c} as bigint) as varchar) else cast({c} as varchar) end"


@query("integral_float_text", f"""select l_orderkey, l_linenumber, {_ift('l_quantity')} as quantidade,
  {_ift('l_discount')} as desconto from lineitem""")
def integral_float_text(t):
    """C2 per value: 17.0 -> '17', 0.04 -> '0.04'."""
    li = t("lineitem")
    return li.select("l_orderkey", "l_linenumber", C.integral_float_text("l_quantity").alias("quantidade"),
                     C.integral_float_text("l_discount").alias("desconto"))


TRIM_MAP = {"CAUSABAS": "CAUSA_BASICA", "SEXO": "SEXO", "MUNRES": "MUNICIPIO_RESIDENCIA",
            "OCUP": "OCUPACAO", "CAUSAMORT": "CAUSA_MORTE"}


@query("trim_rename", """select trim(causabas) as CAUSA_BASICA, trim(sexo) as SEXO,
  trim(munres) as MUNICIPIO_RESIDENCIA, trim(ocup) as OCUPACAO from rec""", ["rec"])
def trim_rename(t):
    """Trim + rename of the mapped columns that are present."""
    return P.trim_rename(t("rec"), TRIM_MAP)


@query("rename_map", """select rec_id, causabas as CAUSA_BASICA, causa9, idade, dtobito as DATA_OBITO,
  dataobito, munres, sexo as SEXO, naturalidade, ocup as OCUPACAO, arquivo_origem as ARQUIVO_ORIGEM from rec""",
       ["rec"])
def rename_map(t):
    """C4: additive, case-insensitive rename (many-to-one map)."""
    m = {k: v for k, v in P.MORTALITY_NAMES.items() if k != "DATAOBITO"}
    return P.rename_map(t("rec"), m)


@query("column_policy", """select causabas, dtobito, dataobito, sexo, ocup, naturalidade, rec_id, causa9,
  arquivo_origem from rec""", ["rec"])
def column_policy(t):
    """Drop list (raw IDADE, MUNRES-like) then priority groups, rest, lineage last."""
    df = t("rec").withColumnRenamed("munres", "CODMUNRES").withColumnRenamed("naturalidade", "NATURAL")
    out = P.mortality_policy(df)
    return out.withColumnRenamed("NATURAL", "naturalidade")


@query("preferred_order", """select sexo, ocup, rec_id, causabas, causa9, idade, dtobito, dataobito, munres,
  naturalidade, arquivo_origem from rec""", ["rec"])
def preferred_order(t):
    """Preferred columns first (absent ones skipped), the rest after."""
    return P.preferred_order(t("rec"), ["SEXO", "NAO_EXISTE", "OCUP"])


@query("pii_whitelist", "select rec_id, causabas, sexo, arquivo_origem from rec", ["rec"])
def pii_whitelist(t):
    """Only whitelisted columns leave; personal data can never be listed."""
    return P.whitelist(t("rec"), ["rec_id", "causabas", "sexo", "arquivo_origem"],
                       forbidden=["CNS_PAC", "AP_CNSPCN"])


@query("zero_pad", f"""select coalesce({S.pad('cnes', 7)}, '') as cnes7, {S.pad('trim(sgruphab)', 5)} as hab5
from hab""", ["hab"])
def zero_pad(t):
    """Pad without truncation; null -> '' for facility codes."""
    h = t("hab")
    return h.select(C.zero_pad("cnes", 7, null_as_empty=True).alias("cnes7"),
                    C.zero_pad(F.trim("sgruphab"), 5).alias("hab5"))


@query("municipality_code6", """select rec_id, case when length(trim(munres)) >= 7 then substr(trim(munres), 1, 6)
  else nullif(trim(munres), '') end as CO_IBGE_RESIDENCIA from rec""", ["rec"])
def municipality_code6(t):
    """7 -> 6 digits, blank -> null."""
    return t("rec").select("rec_id", C.municipality_code6("munres").alias("CO_IBGE_RESIDENCIA"))


@query("strip_leading_zeros", """select rec_id, coalesce(nullif(ltrim(trim(ocup), '0'), ''), trim(ocup)) as ocup
from rec""", ["rec"])
def strip_leading_zeros(t):
    """C11: '007' -> '7', '000' stays."""
    return t("rec").select("rec_id", C.strip_leading_zeros("ocup").alias("ocup"))


@query("icd_key", "select rec_id, replace(trim(causabas), '.', '') as chave from rec", ["rec"])
def icd_key(t):
    """C12: ' c50.9 ' -> 'c509'."""
    return t("rec").select("rec_id", C.icd_key("causabas").alias("chave"))


@query("strip_code_prefix", """select codigo, regexp_replace(descricao, '^\\S+\\s+', '') as descricao
from ref_icd""", ["ref_icd"])
def strip_code_prefix(t):
    """Drop the first token of a 'code label' text."""
    return t("ref_icd").select("codigo", C.strip_code_prefix("descricao").alias("descricao"))


def _loc(c):
    x = f"replace(replace(trim({c}), '.', ''), ',', '.')"
    return (f"cast(trunc(coalesce(case when regexp_matches({x}, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$') "
            f"then cast({x} as double) end, 0)) as bigint)")


@query("locale_number", f"""select linha, {_loc('click')} as click, {_loc('view_')} as view_,
  {_loc('error_')} as error_, {_loc('total')} as total from matriz""", ["matriz"])
def locale_number(t):
    """C14: '1.234,9' -> 1234; '-' -> 0."""
    m = t("matriz")
    return m.select("linha", *[C.locale_number(c).alias(c) for c in ["click", "view_", "error_", "total"]])


@query("nullable_int", f"select rec_id, {S.int_text('idade')} as idade from rec", ["rec"])
def nullable_int(t):
    """C15: '007' -> 7, bad -> null."""
    return t("rec").select("rec_id", C.nullable_int("idade").alias("idade"))


@query("is_blank", f"select co_cnes, {S.blank('cnpj')} as cnpj_vazio, {S.blank('cnpj_mantenedora')} as mant_vazio from estab",
       ["estab"])
def is_blank(t):
    """Null or only spaces."""
    e = t("estab")
    return e.select("co_cnes", C.is_blank("cnpj").alias("cnpj_vazio"), C.is_blank("cnpj_mantenedora").alias("mant_vazio"))


@query("effective_key", f"""select co_cnes,
  case when not {S.blank('cnpj')} then cnpj else cnpj_mantenedora end as CNPJ_EFETIVO,
  {S.blank('cnpj')} and not {S.blank('cnpj_mantenedora')} as VIA_MANTENEDORA from estab""", ["estab"])
def effective_key(t):
    """C17: own key else parent's, with the fallback flag."""
    key, via = C.effective_key("cnpj", "cnpj_mantenedora")
    return t("estab").select("co_cnes", key.alias("CNPJ_EFETIVO"), via.alias("VIA_MANTENEDORA"))


def _age_sql(c, capped=True):
    unit = f"substr(trim({c}), 1, 1)"
    val = S.int_text(f"substr(trim({c}), 2)")
    if capped:
        raw = (f"(case when {unit} = '4' then {val} when {unit} = '5' then {val} + 100 "
               f"when {unit} in ('0', '1', '2', '3') then 0 end)")
        return f"case when {raw} between 0 and 120 then {raw} end"
    return f"case when {unit} = '4' then {val} when {unit} = '5' then {val} + 100 end"


@query("age_unit_value", f"select rec_id, {_age_sql('idade')} as IDADE_ANOS from rec", ["rec"])
def age_unit_value(t):
    """Unit digit + value, 0..120 else null."""
    return t("rec").select("rec_id", C.age_unit_value("idade").alias("IDADE_ANOS"))


@query("age_unit_value_strict", f"select rec_id, {_age_sql('idade', False)} as IDADE_ANOS from rec", ["rec"])
def age_unit_value_strict(t):
    """Units 4/5 only, no cap."""
    return t("rec").select("rec_id", C.age_unit_value_strict("idade").alias("IDADE_ANOS"))


@query("age_sentinel", f"""select rec_id, case when trim(substr(idade, 1, 3)) = '999' then null
  else {S.int_text('trim(substr(idade, 1, 3))')} end as IDADE_DIAGNOSTICO from rec""", ["rec"])
def age_sentinel(t):
    """C20: '999' -> null, else whole number."""
    return t("rec").select("rec_id", C.age_sentinel(F.trim(F.substring("idade", 1, 3))).alias("IDADE_DIAGNOSTICO"))


@query("year_ddmmyyyy", """select rec_id, case when length(trim(dtobito)) = 8
  and regexp_matches(substr(trim(dtobito), 5, 4), '^[0-9]{4}$') then cast(substr(trim(dtobito), 5, 4) as integer) end
  as ANO_OBITO from rec""", ["rec"])
def year_ddmmyyyy(t):
    """Year of DDMMAAAA."""
    return t("rec").select("rec_id", C.year_ddmmyyyy("dtobito").alias("ANO_OBITO"))


@query("year_yymmdd", """select rec_id, case when regexp_matches(trim(dataobito), '^[0-9]{2}')
  then cast(substr(trim(dataobito), 1, 2) as integer) + 1900 end as ANO_OBITO from rec""", ["rec"])
def year_yymmdd(t):
    """Year of AAMMDD (partial allowed)."""
    return t("rec").select("rec_id", C.year_yymmdd("dataobito").alias("ANO_OBITO"))


@query("constant_tags", """select linha, total, 'eventos' as VISAO, 'Por usuário' as LINHA_TIPO, 2024 as ANO
from matriz""", ["matriz"])
def constant_tags(t):
    """Constant tag columns."""
    return t("matriz").select("linha", "total", C.constant("eventos").alias("VISAO"),
                              C.constant("Por usuário").alias("LINHA_TIPO"), C.constant(2024, "int").alias("ANO"))


@query("code_label_concat", """select rec_id, case when rec_id % 3 = 0 then ocup
  else ocup || ' - ' || ('OCUP_' || ocup) end as OCUPACAO from rec""", ["rec"])
def code_label_concat(t):
    """C24: 'code - label', code alone when no label."""
    r = t("rec")
    label = F.when(F.col("rec_id") % 3 != 0, F.concat(F.lit("OCUP_"), "ocup"))
    return r.select("rec_id", C.code_label_concat("ocup", label).alias("OCUPACAO"))
