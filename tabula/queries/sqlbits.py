"""SQL text used by the DuckDB oracles (the independent side of each check).

These are plain ANSI/DuckDB expressions written from the operator semantics,
not generated from the Spark code."""


def f1(c: str, malignant_only: bool = False) -> str:
    t = f"upper(trim({c}))"
    letter = f"regexp_extract({t}, '^([CDB])([0-9]{{2}})', 1)"
    num = f"try_cast(nullif(regexp_extract({t}, '^([CDB])([0-9]{{2}})', 2), '') as integer)"
    pred = f"({letter} = 'C' and {num} <= 97)"
    if not malignant_only:
        pred += f" or ({letter} = 'D' and {num} <= 48) or ({letter} = 'B' and {num} = 21)"
    return f"coalesce({pred}, false)"


def f3(c: str) -> str:
    d = f"regexp_extract(trim({c}), '^([0-9]{{3}})', 1)"
    return f"coalesce({d} <> '' and try_cast(nullif({d}, '') as integer) between 140 and 208, false)"


def f4(c: str) -> str:
    t = f"upper(trim({c}))"
    dn = f"try_cast(nullif(regexp_extract({t}, '^D([0-9]{{2}})', 1), '') as integer)"
    return (f"coalesce(starts_with({t}, 'C') or {dn} between 0 and 9 or {dn} between 37 and 48 "
            f"or starts_with({t}, 'B21') or starts_with({t}, 'Z51') or starts_with({t}, 'Z08') "
            f"or starts_with({t}, 'Z85'), false)")


def norm4(c: str) -> str:
    s = f"ltrim(replace(trim({c}), '.', ''), '0')"
    return f"(case when length({s}) < 4 then lpad({s}, 4, '0') else {s} end)"


def f5(c: str, codes) -> str:
    lst = ", ".join(f"'{x}'" for x in codes)
    return (f"coalesce(trim({c}) in ({lst}) or replace(trim({c}), '.', '') in ({lst}) "
            f"or {norm4(c)} in ({lst}), false)")


def pad(c: str, n: int) -> str:
    return f"(case when length({c}) < {n} then lpad({c}, {n}, '0') else {c} end)"


def int_text(c: str, typ: str = "integer") -> str:
    return f"(case when regexp_matches({c}, '^\\s*[+-]?[0-9]+\\s*$') then cast(trim({c}) as {typ}) end)"


def blank(c: str) -> str:
    return f"({c} is null or trim({c}) = '')"


def q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def lookup(domain: dict, key: str) -> str:
    """Label of ``key`` or null, as a CASE (null key -> null)."""
    whens = " ".join(f"when {q(k)} then {q(v)}" for k, v in domain.items())
    return f"(case {key} {whens} end)"
