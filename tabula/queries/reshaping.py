"""Queries for R1-R3 (reshape) on the binding views."""

from __future__ import annotations


from ..operators import reshape as R
from .registry import query

TAGS = {"VISAO": "eventos_por_usuario", "EXAME": "eventos", "PERFIL": "usuarios",
        "DIMENSAO_LINHA": "Usuário", "DIMENSAO_COLUNA": "Tipo", "MEDIDA": "Quantidade"}


def _loc(c):
    x = f"replace(replace(trim({c}), '.', ''), ',', '.')"
    return (f"cast(trunc(coalesce(case when regexp_matches({x}, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$') "
            f"then cast({x} as double) end, 0)) as bigint)")


@query("unpivot_matrix", "select * from (" + " union all ".join(
    f"select '{TAGS['VISAO']}' as VISAO, '{TAGS['EXAME']}' as EXAME, '{TAGS['PERFIL']}' as PERFIL, "
    f"'{TAGS['DIMENSAO_LINHA']}' as DIMENSAO_LINHA, trim(linha) as CATEGORIA_LINHA, "
    f"'{TAGS['DIMENSAO_COLUNA']}' as DIMENSAO_COLUNA, '{c}' as CATEGORIA_COLUNA, '{TAGS['MEDIDA']}' as MEDIDA, "
    f"{_loc(c)} as QTD from matriz where not coalesce(lower(trim(linha)) in ('total', ''), false)"
    for c in ["click", "view_", "error_"]) + ") u where QTD > 0", ["matriz"])
def unpivot_matrix(t):
    """Matrix -> long; total row/column dropped; positive quantities; tags."""
    return R.unpivot_matrix(t("matriz"), TAGS)


_PARTS = """parts as (
  select muncod, situacao, trim(p) as part, pos - 1 as pos from (
    select muncod, situacao, unnest(string_split(coalesce(munsinon, ''), ',')) as p,
           generate_subscripts(string_split(coalesce(munsinon, ''), ','), 1) as pos from cadmun) x),
rng as (
  select *, regexp_extract(part, '^([0-9]{1,18})\\s*-\\s*([0-9]{1,18})$', 1) as a,
            regexp_extract(part, '^([0-9]{1,18})\\s*-\\s*([0-9]{1,18})$', 2) as b from parts),
codes as (
  select muncod, situacao, pos, n - cast(a as bigint) as sub, lpad(cast(n as varchar), cast(length(a) as integer), '0') as txt, true as ranged from (
    select *, unnest(range(cast(a as bigint), cast(b as bigint) + 1)) as n from rng
    where a <> '' and length(a) = length(b) and cast(b as bigint) >= cast(a as bigint)
      and cast(b as bigint) - cast(a as bigint) + 1 <= 200) y
  union all select muncod, situacao, pos, 0, part, false from rng where regexp_matches(part, '^[0-9]+$')),
exp as (select muncod, situacao, pos, sub,
  substr(case when length(txt) < 6 and not ranged then lpad(txt, 6, '0') else txt end, 1, 6) as codigo from codes)"""


@query("range_list_explode", f"with {_PARTS} select muncod, codigo from exp", ["cadmun"])
def range_list_explode(t):
    """R2: lists and bounded ranges -> one row per 6-digit code."""
    return R.range_list_explode(t("cadmun"), "munsinon", "codigo").select("muncod", "codigo")


@query("synonym_map", f"""with {_PARTS},
act as (select e.*, case when length(muncod) < 6 then lpad(muncod, 6, '0') else muncod end as cur from exp e
  where upper(trim(situacao)) = 'ATIVO'),
ok as (select * from act where cur <> '000000' and not ends_with(cur, '9999')
  and codigo <> cur and codigo <> '000000' and not ends_with(codigo, '9999'))
select codigo as COD_MUNICIPIO_ANTIGO, cur as COD_MUNICIPIO_ATUAL from (
  select *, row_number() over (partition by codigo order by muncod desc, pos desc, sub desc) as rn from ok) z
where rn = 1""", ["cadmun"])
def synonym_map(t):
    """Old -> current, active and real only, last writer wins."""
    return R.synonym_map(t("cadmun"), "muncod", "situacao", "munsinon", "muncod")
