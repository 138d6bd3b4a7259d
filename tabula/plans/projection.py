"""Spec-driven projection used by the select-list curation flows.

A spec is a list of steps; each step contributes output columns only when its
source column is present (layouts drift by year).  The whole spec becomes
ONE ``select`` plus size-checked broadcast lookups for label columns, so a
flow stays a single codegen stage over the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import null_tokens
from ..functions.domains import decode_keep_unknown
from ..operators import lookups as L
from ..operators.policy import present


@dataclass
class Rename:
    src: str
    dst: str


@dataclass
class Pair:
    """D3: trimmed code and its label (unknown keeps the code)."""
    src: str
    domain: dict
    code: str | None
    label: str
    strip_zeros: bool = False


@dataclass
class Derived:
    src: str
    dst: str
    fn: object  # Column -> Column


@dataclass
class Label:
    """Label of a code from a reference table, keyed by ``key(col)``."""
    src: str
    dst: str
    ref: str  # name of the reference in the refs dict
    key: object = None  # Column -> Column; default: dot-free trimmed code
    code_dst: str | None = None  # also emit the trimmed code under this name
    first: bool = False  # label column goes first in the output


@dataclass
class Keep:
    src: str
    dst: str | None = None


@dataclass
class Spec:
    steps: list
    order: list = field(default_factory=list)


def _q(c):
    return F.col(f"`{c}`")


def dot_free(c: Column) -> Column:
    return F.replace(F.trim(c), F.lit("."), F.lit(""))


def apply_spec(df: DataFrame, spec: Spec, refs: dict | None = None, landing: bool = False) -> DataFrame:
    """``landing``: the source is a raw landing, so every source column read
    first maps the missing-value tokens to null (C1), inside the same
    expressions (no extra projection over all columns)."""
    refs = refs or {}
    strings = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    cols: list[Column] = []
    names: list[str] = []
    labels = []
    firsts: list[str] = []
    for s in spec.steps:
        p = present(df, s.src)
        if p is None:
            continue
        c = null_tokens(_q(p)) if landing and p in strings else _q(p)
        if isinstance(s, Rename):
            cols.append(F.trim(c).alias(s.dst)); names.append(s.dst)
        elif isinstance(s, Keep):
            cols.append(c.alias(s.dst or s.src)); names.append(s.dst or s.src)
        elif isinstance(s, Pair):
            if s.code:
                cols.append(F.trim(c).alias(s.code)); names.append(s.code)
            cols.append(decode_keep_unknown(c, s.domain, s.strip_zeros).alias(s.label)); names.append(s.label)
        elif isinstance(s, Derived):
            cols.append(s.fn(c).alias(s.dst)); names.append(s.dst)
        elif isinstance(s, Label):
            if s.code_dst:
                cols.append(F.trim(c).alias(s.code_dst)); names.append(s.code_dst)
            if s.ref in refs and refs[s.ref] is not None:
                key = (s.key or dot_free)(c)
                tmp = f"_key_{len(labels)}"
                cols.append(key.alias(tmp))
                labels.append((tmp, s))
                if s.first:
                    firsts.append(s.dst)
                else:
                    names.append(s.dst)
    out = df.select(*cols)
    for tmp, s in labels:
        ref = refs[s.ref]
        d = L.unique_by_key(ref.select("CODIGO", "DESCRICAO"), "CODIGO").select(
            F.col("CODIGO").alias(f"{tmp}_k"), F.col("DESCRICAO").alias(s.dst))
        out = L.left_join(out, F.col(tmp), d, f"{tmp}_k")
    names = firsts + names
    if spec.order:
        first = [n for n in spec.order if n in names]
        names = first + [n for n in names if n not in first]
    return out.select(*[_q(n) for n in names])
