"""Operator 9, near-duplicates: MinHash, banding, verification, components.

1. Each text gets universal hash minima over its distinct word
   shingles, in numpy on Arrow batches, and one key for each band of minima
   (``shape``).  At the threshold a pair misses every band once in a million times.
2. Texts with the same word sequence form one class, named by a hash of a
   128-bit digest, so a group of copies is one row from here on.
3. Pairs are verified on signatures first (an estimate five deviations below
   the threshold rules a pair out) and then exactly on the full shingle sets.
4. Components by alternating large-star and small-star.

A bucket never emits all its pairs.  Counting, over the sets in shared
buckets, the shingles that only one set has bounds every overlap: sets with
too many of their own leave their buckets, and pairs with too many together
are never formed.  In each of the first rounds a bucket then elects a centre
and pairs it with those members that are not yet in the centre's component;
that joins the members of a true group, since a link more inside a component
cannot change it.  The last round pairs what is still apart inside a bucket,
across components only, without pairs already tested and without those whose
rare shingles alone show too small an overlap, so no link that could join two
components is left out.

Defined results: null text, or text without words, has an empty set and links
with nothing; a text of fewer than five words is one shingle; rows that repeat
share class and component; a row with null doc_id gets the component of its
class, null (and kept) if nothing in it has an id; rows of one doc_id with
different texts are judged by their texts; extra columns pass through
``drop_near_copies``; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, python_ready, stage, table, words_of
from .subwords import slices

SHINGLE = 5
PERCENT = 85  # of op9; a stage names its own
MISSED = 1e-6
SIGNATURE_SLACK = 5.0  # standard deviations
STAR_ROUNDS = 2
RARE = 64  # sets at most that hold a rare shingle
_SEED = 20240229


def shape(percent: int) -> tuple[int, int]:
    """Bands and rows in a band with which a pair at the threshold misses every
    band with a probability of at most ``MISSED``."""
    rows = 5 if percent >= 85 else 4
    return math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** rows))), rows


def coefficients(hashes: int = math.prod(shape(PERCENT))) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and shifts of the universal family ((a x + b) mod 2^64) div 2^32."""
    rng = np.random.default_rng(_SEED)
    return rng.integers(0, 1 << 64, hashes, dtype=np.uint64), rng.integers(0, 1 << 64, hashes, dtype=np.uint64)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, at_once: int = 256) -> np.ndarray:
    """The signature of a set of 64-bit shingle hashes (not empty)."""
    x = (shingles >> np.uint64(32)).reshape(-1, 1)
    out = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(x), at_once):
        v = x[k : k + at_once] * a
        v += b
        np.minimum(out, v.min(axis=0), out=out)
    return out >> np.uint64(32)


def shingle_hashes(h: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the ``width``-word shingles of a sequence of
    word hashes; a shorter sequence is one shingle."""
    if not len(h):
        return h
    width = min(width, len(h))
    n = len(h) - width + 1
    acc = np.full(n, 0x9E3779B97F4A7C15 + width, dtype=np.uint64)
    for k in range(width):
        acc = (acc ^ h[k : k + n]) * np.uint64(0xFF51AFD7ED558CCD)
        acc ^= acc >> np.uint64(32)
    return np.unique(acc)


def _word_rows(column: pa.ListArray):
    values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
    return [values[ends[k] : ends[k + 1]] for k in range(len(column))]


def class_of(words: Column) -> Column:
    """The class of a word sequence; null where there are no words."""
    return F.when(F.size(words) > 0, F.xxhash64(F.md5(F.array_join(words, " "))))


def text_mark(text: Column) -> Column:
    """Tells rows of one doc_id apart by their text; null and empty differ."""
    return F.xxhash64(text.isNull(), text)


def hashed_words(docs: DataFrame) -> DataFrame:
    """(doc_id, id, w, mark): the class and the hashes of the words of each (doc_id, text) row."""
    words = docs.select("doc_id", words_of(ascii_lower(F.col("text"))).alias("w"), text_mark(F.col("text")).alias("mark"))
    return words.select("doc_id", class_of(F.col("w")).alias("id"), F.transform("w", lambda x: F.xxhash64(x)).alias("w"), "mark")


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, id, n_shingles, minima, bands, mark) of each row of (doc_id,
    text); no minima or bands for an empty set."""
    python_ready(docs.sparkSession)
    n_bands, n_rows = shape(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = coefficients(n_bands * n_rows)
        mix = np.random.default_rng(_SEED + 1).integers(1, 1 << 62, (n_bands, n_rows), dtype=np.uint64) | np.uint64(1)
        for part in slices(batches):
            n, sig, bands = [], [], []
            for h in _word_rows(part.column(2)):
                s = shingle_hashes(h)
                n.append(len(s))
                if len(s):
                    m = minima(s, a, b)
                    sig.append(m.astype(np.uint32).view(np.int32))
                    k = (m.reshape(n_bands, n_rows) * mix).sum(axis=1, dtype=np.uint64)
                    bands.append((k ^ (k >> np.uint64(29))).view(np.int64))
                else:
                    sig.append(np.empty(0, np.int32))
                    bands.append(np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n, pa.int64()), _lists(sig, pa.int32()), _lists(bands, pa.int64()),
                 part.column(3)], names=["doc_id", "id", "n_shingles", "minima", "bands", "mark"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return hashed_words(docs).mapInArrow(
        run, f"doc_id {kind}, id long, n_shingles long, minima array<int>, bands array<long>, mark long")


def shingle_sets(hashed: DataFrame) -> DataFrame:
    """(id, shingles) with the full set of shingle hashes of each (id, w) row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [shingle_hashes(h).view(np.int64) for h in _word_rows(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(sets, pa.int64())], names=["id", "shingles"])

    return hashed.select("id", "w").mapInArrow(run, "id long, shingles array<long>")


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    flat = np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def components(edges: DataFrame, name: str = "op9-star") -> DataFrame:
    """(id, component) for every end of ``edges`` (a, b): the smallest id
    reachable.  Alternating large-star and small-star; each round is written
    to the shared folder, and a round that changes nothing ends it."""
    edges = stage(_tidy(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), name)
    before = None
    while True:
        # large-star: each node's larger neighbours go to its smallest neighbour (or itself)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _tidy(large)
        # small-star: each node and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        edges = stage(_tidy(small), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    tops = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(tops)


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.filter("u <> v").distinct()


def verified(pairs: DataFrame, sigs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets overlap by at least ``percent``; signatures first."""
    t, hashes = percent / 100, math.prod(shape(percent))
    least = hashes * t - SIGNATURE_SLACK * (hashes * t * (1 - t)) ** 0.5
    agree = F.aggregate(F.zip_with("ma", "mb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    side = lambda t, c, x: t.select(F.col("id").alias(c), F.col(x).alias(("m" if x == "minima" else "s") + c))
    likely = (pairs.join(side(sigs, "a", "minima"), "a").join(side(sigs, "b", "minima"), "b")
              .filter(agree >= least).select("a", "b"))
    both = likely.join(side(sets, "a", "shingles"), "a").join(side(sets, "b", "shingles"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return both.filter(common * 100 >= union * percent).select("a", "b")


def linked_classes(docs: DataFrame, sigs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, component) of the classes that link with another one.  ``sigs``:
    one row per class, with the doc_id whose text stands for it."""
    keys = sigs.select("id", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1").select("band", "key")
    buckets = stage(keys.join(shared, ["band", "key"]), "op9-buckets")
    busy = buckets.select("id").distinct()
    few = stage(sigs.join(busy, "id", "left_semi").select("id", "doc_id", "minima"), "op9-minima")
    # only the texts that stand for a class in a shared bucket are read into sets
    texts = hashed_words(docs).join(few.select("id", "doc_id"), ["id", "doc_id"], "left_semi")
    sets = stage(shingle_sets(texts).dropDuplicates(["id"]), "op9-sets")
    buckets = _able(buckets, stage(_sizes(sets, percent), "op9-sizes"), "op9-able")

    tested, links, comps = None, None, None
    for k in range(STAR_ROUNDS + 1):
        apart = buckets.withColumn("component", F.col("id")) if comps is None else _apart(buckets, comps, f"op9-apart{k}")
        if comps is not None and apart.isEmpty():
            break
        if k < STAR_ROUNDS:
            # a centre for each bucket: the member with most links, at first the one with fewest shingles of its own
            rank = apart.withColumn("links", F.lit(0)) if links is None else apart.join(_degrees(links), "id", "left").fillna(0, ["links"])
            best = F.min(F.struct((-F.col("links")).alias("links"), "own", "id", "n", "component")).alias("c")
            centre = rank.groupBy("band", "key").agg(best).select("band", "key", "c")
            met = apart.join(centre, ["band", "key"]).select(
                F.col("id").alias("ia"), F.col("n").alias("na"), F.col("own").alias("oa"), F.col("component").alias("ca"),
                F.col("c.id").alias("ib"), F.col("c.n").alias("nb"), F.col("c.own").alias("ob"), F.col("c.component").alias("cb"))
            new = met.filter(_may_link(percent) & (F.col("ca") != F.col("cb")))
        else:
            # all that is still apart, across components, but for pairs whose rare shingles differ too much
            members = apart.join(stage(_rare_shingles(sets, apart), "op9-rare"), "id", "left")
            side = lambda x: members.select("band", "key", F.col("id").alias(f"i{x}"), F.col("n").alias(f"n{x}"),
                                            F.col("own").alias(f"o{x}"), F.col("component").alias(f"c{x}"),
                                            F.coalesce("rare", F.array().cast("array<bigint>")).alias(f"r{x}"))
            new = side("a").join(side("b"), ["band", "key"]).filter(
                (F.col("ia") < F.col("ib")) & (F.col("ca") != F.col("cb")) & _may_link(percent) & _may_overlap(percent))
        new = new.select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b")).distinct()
        new = stage(new if tested is None else new.join(tested, ["a", "b"], "left_anti"), "op9-pairs")
        found = stage(verified(new, few, sets, percent), "op9-links")
        tested, links = (new, found) if tested is None else (tested.union(new), links.union(found))
        if comps is None or not found.isEmpty():
            comps = stage(components(links), "op9-components")
    return comps


def _degrees(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("id")).union(links.select("b")).groupBy("id").agg(F.count("*").alias("links"))


def _sizes(sets: DataFrame, percent: int) -> DataFrame:
    """(id, n, own) of the sets that can link at all: ``own`` counts the
    shingles no other set has.  A partner lacks them, so the overlap stays
    under (n - own) / n."""
    each = sets.select("id", F.explode("shingles").alias("g"))
    alone = each.groupBy("g").agg(F.count("*").alias("k"), F.min("id").alias("id")).filter("k = 1")
    own = alone.groupBy("id").agg(F.count("*").alias("own"))
    sized = sets.select("id", F.size("shingles").cast("long").alias("n")).join(own, "id", "left").fillna(0, ["own"])
    return sized.filter(F.col("own") * 100 <= F.col("n") * (100 - percent))


def _may_link(percent: int) -> Column:
    """What two linked sets must meet: their overlap c has
    c (100 + p) >= p (na + nb), and neither set's own shingles are in it."""
    shared = F.least(F.col("na") - F.col("oa"), F.col("nb") - F.col("ob"))
    return shared * (100 + percent) >= (F.col("na") + F.col("nb")) * percent


def _rare_shingles(sets: DataFrame, members: DataFrame, most: int = RARE) -> DataFrame:
    """(id, rare): of each member's shingles those that at most ``most`` members have."""
    each = sets.join(members.select("id").distinct(), "id", "left_semi").select("id", F.explode("shingles").alias("g"))
    few = each.groupBy("g").agg(F.count("*").alias("k")).filter(F.col("k") <= most).select("g")
    return each.join(few, "g", "left_semi").groupBy("id").agg(F.collect_list("g").alias("rare"))


def _may_overlap(percent: int) -> Column:
    """As ``_may_link``, with what either set has among rare shingles and the
    other has not: a rare shingle that is in both is in both lists."""
    lacking = lambda x, y: F.size(F.array_except(f"r{x}", f"r{y}"))
    shared = F.least(F.col("na") - lacking("a", "b"), F.col("nb") - lacking("b", "a"))
    return shared * (100 + percent) >= (F.col("na") + F.col("nb")) * percent


def _able(buckets: DataFrame, sizes: DataFrame, name: str) -> DataFrame:
    """Buckets that still hold two sets which can link, with (n, own) of each."""
    able = buckets.join(sizes, "id")
    shared = able.groupBy("band", "key").agg(F.count("*").alias("k")).filter("k > 1").select("band", "key")
    return stage(able.join(shared, ["band", "key"], "left_semi"), name)


def _apart(buckets: DataFrame, comps: DataFrame, name: str) -> DataFrame:
    """Members, with component, of buckets that still span several components."""
    known = buckets.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = known.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    return stage(known.join(split.select("band", "key"), ["band", "key"], "left_semi"), name)


def judged(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, mark, n_shingles, component, component_id) of every row of
    (doc_id, text); no component for an empty set."""
    docs = docs.select("doc_id", "text")
    rows = stage(signatures(docs, percent), "op9-signatures")
    classes = rows.filter("id is not null").groupBy("id").agg(F.min("doc_id").alias("doc_id"))
    heads = classes.filter("doc_id is not null")
    sigs = rows.select("id", "doc_id", "bands", "minima").join(heads, ["id", "doc_id"], "left_semi").dropDuplicates(["id"])
    comps = linked_classes(docs, stage(sigs, "op9-heads"), percent)
    joined = classes.join(comps, "id", "left").select("id", "doc_id", F.coalesce("component", "id").alias("component"))
    named = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    per_class = joined.select("id", "component").join(named, "component")
    out = rows.select("doc_id", "id", "n_shingles", "mark").join(per_class, "id", "left")
    own = F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "mark", "n_shingles", "component", own.alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of (doc_id, text)."""
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return judged(docs, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the one of
    its smallest doc_id (a row without one only where none has an id), then of
    the smallest mark.  Different texts under one id are rows of their own;
    texts without words stay, once for each doc_id and text."""
    found = stage(judged(docs, percent).select("doc_id", "mark", "component").distinct(), "op9-kept")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")).alias("r")
    kept = (found.filter("component is not null").groupBy("component").agg(first).select("r.doc_id", "r.mark")
            .union(found.filter("component is null").select("doc_id", "mark")))
    kept = kept.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__kept"))
    marked = docs.withColumn("__mark", text_mark(F.col("text")))
    rows = marked.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__kept")), "left_semi")
    return rows.dropDuplicates(["doc_id", "__mark"]).select(*[f"`{c}`" for c in docs.columns])


def op9_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op9_minhash_neardup": op9_minhash_neardup}
ORACLES: dict = {}
