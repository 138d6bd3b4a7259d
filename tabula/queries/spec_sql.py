"""DuckDB oracle text for the spec-driven curation flows.

Written from the flow semantics: rename = trim; pair = trimmed code plus
``CASE`` label falling back to the trimmed code; label = left join on the
dot-free code; personal data never selected."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..plans.projection import Derived, Keep, Label, Pair, Rename
from . import sqlbits as S

# What stands for "missing" in a landed text.
_TOKENS = "'None', 'nan', 'NaN', 'NaT', '<NA>', ''"

DERIVED_SQL = {
    id(C.age_sentinel): lambda c: f"case when trim({c}) = '999' then null else {S.int_text(f'trim({c})')} end",
    id(F.trim): lambda c: f"trim({c})",
    id(C.age_unit_value_strict): lambda c: (
        f"case when substr(trim({c}), 1, 1) = '4' then {S.int_text(f'substr(trim({c}), 2)')} "
        f"when substr(trim({c}), 1, 1) = '5' then {S.int_text(f'substr(trim({c}), 2)')} + 100 end"),
}


def spec_sql(spec, view: str, columns: list[str], refs: dict, where: str | None = None,
             landing: bool = False) -> str:
    """``columns``: source columns present in ``view``; ``refs``: name -> view."""
    have = {c.upper() for c in columns}
    sel, names, joins, firsts = {}, [], [], []
    for s in spec.steps:
        if s.src.upper() not in have:
            continue
        c = f"(case when b.{s.src} in ({_TOKENS}) then null else b.{s.src} end)" if landing else f"b.{s.src}"
        if isinstance(s, Rename):
            sel[s.dst] = f"trim({c})"; names.append(s.dst)
        elif isinstance(s, Keep):
            sel[s.dst or s.src] = c; names.append(s.dst or s.src)
        elif isinstance(s, Pair):
            if s.code:
                sel[s.code] = f"trim({c})"; names.append(s.code)
            key = f"coalesce(nullif(ltrim(trim({c}), '0'), ''), trim({c}))" if s.strip_zeros else f"trim({c})"
            sel[s.label] = f"coalesce({S.lookup(s.domain, key)}, trim({c}))"; names.append(s.label)
        elif isinstance(s, Derived):
            sel[s.dst] = DERIVED_SQL[id(s.fn)](c); names.append(s.dst)
        elif isinstance(s, Label):
            if s.code_dst:
                sel[s.code_dst] = f"trim({c})"; names.append(s.code_dst)
            if s.ref in refs:
                a = f"r{len(joins)}"
                key = f"trim({c})" if s.key is F.trim else f"replace(trim({c}), '.', '')"
                joins.append(f"left join {refs[s.ref]} {a} on {key} = {a}.CODIGO")
                sel[s.dst] = f"{a}.DESCRICAO"
                (firsts if s.first else names).append(s.dst)
    cols = ", ".join(f"{sel[n]} as {n}" for n in firsts + names)
    w = f" where {where}" if where else ""
    return f"select {cols} from {view} b {' '.join(joins)}{w}"
