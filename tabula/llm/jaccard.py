"""Operator 11, n-gram Jaccard join by blocked sparse matrix products.

The incidence matrix has a row for each class of texts with the same set of
4-word shingles and a column for each shingle.

1. A set can only link with one that shares a shingle among its first
   p = n - ceil(t n) + 1 in any common order, and l of them among its first
   p + l - 1.  In the order of the hashes that leaves the rows that can link
   at all, from a part of each set; only their texts are read into whole sets.
2. Over these rows columns are counted.  Shingles of one row alone are in no
   overlap: a row with too many of them leaves.  The others are ordered from
   the rarest, and only the leading ones (as in 1) make buckets, so a passage
   that many texts share pairs only texts that hold little else.
3. Pairs from the buckets that meet the size bounds are grouped into blocks of
   bounded weight.  A block gets the rows that its pairs name and multiplies
   them one group of columns after another, rarest first, adding up overlaps
   and dropping every pair whose count with all that is left would fall short.
4. Components: in the first rounds a bucket pairs its members with one centre
   only and then with what is in other components; the last round pairs all
   that is still apart, so no link that could join two components is missed.
   ``similar_pairs`` leaves out the rounds and gives every linked pair.

Defined results: null text, or text without words, has an empty set and links
with nothing; a text of fewer than four words is one shingle; rows that repeat
share class and component; a row with null doc_id gets the component of its
class, null if nothing in it has an id; extra columns are ignored; empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytewords import byte_kinds, row_ends, text_slices, word_hashes, words_in
from .common import discard, lean_stage, python_ready, table
from .neardup import components, text_mark

SHINGLE = 4
PERCENT = 85
STAR_ROUNDS = 3
BLOCK_WEIGHT = 2_000_000  # matrix entries that the pairs of a block bring in
COLUMN_GROUPS = 4

_KINDS = byte_kinds(b" \t\n\x0b\x0c\r")


def _windows(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` neighbours."""
    n = len(h) - width + 1
    acc = np.full(max(n, 0), 0x9E3779B97F4A7C15 + width, dtype=np.uint64)
    for k in range(width if n > 0 else 0):
        acc = (acc ^ h[k : k + n]) * np.uint64(0xFF51AFD7ED558CCD)
        acc ^= acc >> np.uint64(32)
    return acc


def _leading(n, percent: int):
    """How many of its n shingles, in any common order, a linked set's partner has one of."""
    return n - _ceil(n * percent, 100) + 1


def _ceil(x, by: int):
    return F.ceil(x / by) if isinstance(x, Column) else -(-x // by)


def incidence(docs: DataFrame, percent: int | None = None, width: int = SHINGLE) -> DataFrame:
    """(doc_id, mark, class, n, shingles) of each (doc_id, text) row: a mark of
    its text, a digest of the set and the set itself, sorted; with ``percent``
    only the first 2 p - 1 of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 2):
            found = words_in(part.column(2), _KINDS)
            h = word_hashes(found.dictionary)[found.codes]
            ends = row_ends(found, part.num_rows)
            whole, sets = _windows(h, width), []
            for a, b in zip(ends[:-1], ends[1:]):
                sets.append(np.unique(whole[a : b - width + 1] if b - a >= width else _windows(h[a:b], int(b - a)) if b > a else h[:0]).view(np.int64))
            names = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            sizes = [len(s) for s in sets]
            if percent is not None:
                sets = [s[: 2 * _leading(len(s), percent) - 1] for s in sets]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()), _lists(sets)],
                                             names=["doc_id", "mark", "class", "n", "shingles"])

    python_ready(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_mark(F.col("text")).alias("mark"), "text").mapInArrow(
        run, f"doc_id {kind}, mark long, class binary, n long, shingles array<long>")


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64), pa.int64()))


def classes_of(rows: DataFrame) -> DataFrame:
    """(class, id, doc_id, mark, n, shingles): one row for each set that is not
    empty, with an id of its own (fixed when it is staged), and the smallest
    doc_id of its rows with the mark of that row's text."""
    head = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")).alias("head")
    each = rows.filter("n > 0").groupBy("class").agg(head, F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    return each.select("class", F.monotonically_increasing_id().alias("id"), "head.doc_id", "head.mark", "n", "shingles")


def able_classes(classes: DataFrame, percent: int) -> DataFrame:
    """(id) of the classes that share as many of their leading shingles by
    hash with others as a linked set would have to."""
    each = classes.select("id", "n", F.explode("shingles").alias("g"))
    met = each.groupBy("g").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("g")
    shared = each.join(met, "g", "left_semi").groupBy("id", "n").agg(F.count("*").alias("k"))
    # both sets' parts hold as many as the smaller one's p
    return shared.filter(F.col("k") >= _leading(_ceil(F.col("n") * percent, 100), percent)).select("id")


def whole_sets(docs: DataFrame, classes: DataFrame, able: DataFrame) -> DataFrame:
    """(id, n, shingles) of the able classes, from the texts that stand for them."""
    heads = classes.join(able, "id", "left_semi").select("class", "id", F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"))
    texts = docs.join(heads.select("__id", "__mark"), F.col("doc_id").eqNullSafe(F.col("__id")) & (text_mark(F.col("text")) == F.col("__mark")), "left_semi")
    return incidence(texts).dropDuplicates(["class"]).join(heads.select("class", "id"), "class").select("id", "n", "shingles")


def columns_of(sets: DataFrame, percent: int) -> DataFrame:
    """(id, n, own, g, pos): each row's leading shingles from the rarest that
    another row has; ``own`` counts those that none has, which come before."""
    each = sets.select("id", "n", F.explode("shingles").alias("g"))
    shared = each.groupBy("g").agg(F.count("*").alias("k")).filter("k > 1")
    held = each.join(shared, "g").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("k", "g"))).alias("s"))
    sized = held.withColumn("own", F.col("n") - F.size("s"))
    count = _leading(F.col("n"), percent) - F.col("own")
    able = sized.filter(count > 0).select("id", "n", "own", F.posexplode(F.slice("s", F.lit(1), count.cast("int"))).alias("at", "c"))
    return able.select("id", "n", "own", F.col("c.g").alias("g"), (F.col("at") + F.col("own")).alias("pos"))


def _may_link(percent: int, most: Column) -> Column:
    """The overlap that a link needs, o (100 + t) >= t (na + nb), is at most ``most``."""
    return most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent


def candidates(columns: DataFrame, percent: int, across: bool = False) -> DataFrame:
    """(a, b, na, nb): pairs from the buckets whose sizes, and places of the
    first shingle they share, leave room for a link; ``across`` components only."""
    side = lambda x, y: columns.select("g", F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("pos").alias(f"p{x}"),
                                       *([F.col("component").alias(y)] if across else []))
    met = side("a", "ca").join(side("b", "cb"), "g").filter("a < b")
    if across:
        met = met.filter("ca <> cb")
    # what comes before the first shingle they share is in one of them only
    room = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return met.filter(_may_link(percent, room)).select("a", "b", "na", "nb").distinct()


def _with_centres(columns: DataFrame, degrees: DataFrame | None, percent: int) -> DataFrame:
    """(a, b, na, nb): in each bucket the member with most links (then the
    fewest shingles of its own) and the members of other components."""
    known = columns.withColumn("links", F.lit(0)) if degrees is None else columns.join(degrees, "id", "left").fillna(0, ["links"])
    best = F.min(F.struct((-F.col("links")).alias("links"), "own", "id", "n", "component")).alias("c")
    met = columns.join(known.groupBy("g").agg(best), "g").filter(F.col("component") != F.col("c.component"))
    pairs = met.select(F.col("c.id").alias("a"), F.col("id").alias("b"), F.col("c.n").alias("na"), F.col("n").alias("nb"),
                       F.least(F.col("n") - F.col("own"), F.col("c.n") - F.col("c.own")).alias("most"))
    return pairs.filter(_may_link(percent, F.col("most"))).drop("most").distinct()


def products(pairs: DataFrame, sets: DataFrame, percent: int, weight: int = BLOCK_WEIGHT) -> DataFrame:
    """(a, b, overlap) of the pairs that link: blocks of the product of the
    incidence matrix with its transpose, at the places ``pairs`` names."""
    total = pairs.agg(F.coalesce(F.sum("nb"), F.lit(0))).first()[0]
    blocks = total // weight + 1
    # a row with many partners is spread over several blocks
    heavy = pairs.groupBy("a").agg(F.sum("nb").alias("w")).filter(F.col("w") > weight)
    cut = F.pmod(F.xxhash64("b"), F.coalesce(F.ceil(F.col("w") / weight), F.lit(1)))
    dealt = pairs.join(heavy, "a", "left").select(F.pmod(F.xxhash64("a", cut), F.lit(blocks)).alias("block"), "a", "b")
    needed = dealt.select(F.col("block").alias("at"), F.col("a").alias("id")).union(dealt.select("block", "b")).distinct()
    rows = needed.join(sets.select("id", "shingles"), "id").select("at", "id", "shingles")

    def run(pairs: pa.Table, rows: pa.Table) -> pa.Table:
        a, b, overlap = block_product(pairs.column("a").to_numpy(), pairs.column("b").to_numpy(), rows.column("id").to_numpy(),
                                      rows.column("shingles").combine_chunks(), percent)
        return pa.table({"a": a, "b": b, "overlap": overlap})

    return dealt.groupBy("block").cogroup(rows.groupBy("at")).applyInArrow(run, "a long, b long, overlap long")


def block_product(a: np.ndarray, b: np.ndarray, ids: np.ndarray, shingles: pa.Array, percent: int, groups: int = COLUMN_GROUPS):
    """(a, b, overlap) of the linked pairs among (a, b), given their rows."""
    order = np.argsort(ids)
    a, b = (order[np.searchsorted(ids, x, sorter=order)] for x in (a, b))
    if isinstance(shingles, pa.ChunkedArray):
        shingles = pa.concat_arrays(shingles.chunks) if shingles.num_chunks else pa.array([], shingles.type)
    sizes = shingles.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values, column = np.unique(shingles.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
    # columns by how many rows of the block hold them, the rarest first
    held = np.bincount(column, minlength=len(values))
    place = np.empty(len(values), np.int64)
    place[np.argsort(held, kind="stable")] = np.arange(len(values))
    entries = np.repeat(np.arange(len(ids)), sizes) * len(values) + place[column]
    entries.sort()  # (row, column) in one number
    need = -(-(sizes[a] + sizes[b]) * percent // (100 + percent))
    overlap = np.zeros(len(a), np.int64)
    alive = np.flatnonzero(np.minimum(sizes[a], sizes[b]) >= need)
    rows = np.arange(len(ids)) * len(values)
    for k in range(groups):
        low, high = len(values) * k // groups, len(values) * (k + 1) // groups
        lo, hi, end = (np.searchsorted(entries, rows + x) for x in (low, high, len(values)))
        lengths = (hi - lo)[b[alive]]
        pair = np.repeat(np.arange(len(alive)), lengths)
        within = np.arange(len(pair)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        wanted = entries[lo[b[alive]][pair] + within] + (a[alive] - b[alive])[pair] * len(values)
        at = np.minimum(np.searchsorted(entries, wanted), max(len(entries) - 1, 0))
        overlap[alive] += np.bincount(pair[entries[at] == wanted] if len(pair) else pair, minlength=len(alive))
        rest = np.minimum((end - hi)[a[alive]], (end - hi)[b[alive]])
        alive = alive[overlap[alive] + rest >= need[alive]]
    return ids[a[alive]], ids[b[alive]], overlap[alive]


def linked(columns: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(id, component) of the rows that link with another one; None if there are none."""
    tested, links, comps = None, None, None
    for k in range(STAR_ROUNDS + 1):
        known = columns.withColumn("component", F.col("id")) if comps is None else (
            columns.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id")))
        split = known.groupBy("g").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("g")
        apart = lean_stage(known.join(split, "g", "left_semi"), f"op11-apart{k}")
        if k < STAR_ROUNDS:
            degrees = None if links is None else links.select(F.col("a").alias("id")).union(links.select("b")).groupBy("id").agg(F.count("*").alias("links"))
            new = _with_centres(apart, degrees, percent)
        else:
            new = candidates(apart, percent, across=True)
        if tested is not None:
            new = new.join(tested.select("a", "b").union(tested.select("b", "a")), ["a", "b"], "left_anti")
        new = lean_stage(new, "op11-pairs")
        if new.isEmpty():
            if k < STAR_ROUNDS and not apart.isEmpty():
                continue
            break
        found = lean_stage(products(new, sets, percent), "op11-links")
        tested, links = (new, found) if tested is None else (tested.union(new), links.union(found))
        if comps is None or not found.isEmpty():
            comps = lean_stage(components(links, "op11-star"), "op11-components")
    return comps


def prepared(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, class, n), classes, the sets that can link, and their leading columns."""
    docs = docs.select("doc_id", "text")
    read = lean_stage(incidence(docs, percent), "op11-read")
    rows = lean_stage(read.select("doc_id", "class", "n"), "op11-rows")
    parts = lean_stage(classes_of(read), "op11-parts")
    discard(read)
    able = lean_stage(able_classes(parts, percent), "op11-able")
    classes = lean_stage(parts.select("class", "id", "doc_id", "mark"), "op11-classes")
    discard(parts)
    sets = lean_stage(whole_sets(docs, classes, able), "op11-sets")
    return rows, classes, sets, lean_stage(columns_of(sets, percent), "op11-columns")


def similar_pairs(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Every linked pair of classes, (a, b, overlap), and the membership
    (doc_id, id, n_shingles); id is null for an empty set.  Unlike ``joined``
    this lists a group's links one by one."""
    rows, classes, sets, columns = prepared(docs, percent)
    pairs = lean_stage(candidates(columns, percent), "op11-pairs")
    member = rows.join(classes.select("class", "id"), "class", "left").select("doc_id", "id", F.col("n").alias("n_shingles"))
    return products(pairs, sets, percent), member


def joined(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text)."""
    rows, classes, sets, columns = prepared(docs, percent)
    comps = linked(columns, sets, percent)
    of = classes.withColumn("component", F.col("id")) if comps is None else (
        classes.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id")))
    named = of.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    per_class = of.select("class", "component").join(named, "component").select("class", "component_id")
    out = rows.select("doc_id", "class", "n").join(per_class, "class", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under the 4-word Jaccard join."""
    return joined(table(spark, sf_dir, "documents"))


ORACLE = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(list_slice(w, i, i + 3), ' ') as g
      from d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as u(i) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
e as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
t as (select a, b from e union all select b, a from e),
r(id, x) as (select doc_id, doc_id from d union select r.id, t.b from r join t on r.x = t.a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.x as component_id
from d left join n on d.doc_id = n.doc_id join (select id, min(x) as x from r group by id) m on m.id = d.doc_id"""

QUERIES = {"op11_ngram_jaccard_join": op11_ngram_jaccard_join}
ORACLES = {"op11_ngram_jaccard_join": ORACLE}
