"""Operator 12, phrase collocations by counting quotient filters.

1. Texts are cut into pieces and words in numpy; a block (some texts of one
   language) keeps its own small dictionary and its words as places in it.
2. Word counts are added up over blocks.  A phrase is no more frequent than
   its words, so only words that reach the threshold get an id; the others
   part phrases like a full stop.
3. Each task counts the two- and three-word phrases of its blocks, as packed
   ids, in counting quotient filters (``quotient``): sorted, lossless, and cut
   by leading bits of the permuted key into ranges that any task can merge.
4. Filters of one range are merged over all shards.  Keys are permuted, so
   ranges are even whatever words are frequent, and a frequent phrase is one
   entry of each shard's filter.  Where a range would hold more entries than
   one task should, groups of shards are merged first and cut finer.
5. Scores, covered phrases and the ranking are joins and windows over the
   frequent phrases; a language's ranking first keeps the best of each part.

Every count is over all texts; nothing is sampled, and only phrases below the
threshold, which no result can need, are dropped.

Defined results: null or empty texts have no words; a null language is
``und``, together with rows that say so; repeated rows count each; extra
columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bytewords import byte_kinds, gathered, words_of_pieces
from .common import lean_stage, python_ready, stage, table
from .quotient import U, QuotientFilter, merged, packed, permuted, ranged, restored, tallied, unpacked

LEAST = 10  # occurrences of a candidate
COVERED = 50  # per cent of a phrase's occurrences inside a longer candidate
TOP = 2000
PARTS = 256  # of a language's ranking, and of the dictionary's numbering
BLOCK_BYTES = 8 << 20
BATCH_BYTES = 8 << 20  # that Python gets at once: a block's row is some MB
MERGE_BITS = 4  # leading bits of the ranges that are merged one after the other
WORDS_AT_ONCE = 1 << 17  # of a block that phrases are packed from at once
HELD = 2_000_000  # entries a task counts before it hands its filters over, and of one merge
MOST_RANGES = 12  # bits; more come by merging groups of shards and cutting again
FAN = 64  # shards merged before a range is cut finer

BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"

_FILTER = ("n int, shard long, bits int, half int, prefix int, place long, quotient int, size int, occupied binary, run_ends binary, "
           "`left` binary, `right` binary, counters binary, large binary")
_PARTS = ["half", "prefix", "place", "quotient", "size", "occupied", "run_ends", "left", "right", "counters", "large"]
_GRAM = "n int, w1 long, w2 long, w3 long, a long"


def blocks_of(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, lang, words, counts, codes): the texts of a block as places in
    ``words``, doubled, and one more where a piece begins."""
    kinds = byte_kinds(BLANKS, BREAKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for pieces in gathered(batches, 1, block_bytes):
            found = words_of_pieces(pieces, 1, kinds)
            langs = pa.concat_arrays([p.column(0) for p in pieces]).dictionary_encode()
            lang_of = langs.indices.to_numpy(zero_copy_only=False)[found.rows]
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                mine = lang_of == k
                codes = found.codes[mine]
                if not len(codes):
                    continue
                counts = np.bincount(codes, minlength=len(found.dictionary))
                used = np.flatnonzero(counts)
                places = np.cumsum(counts > 0) - 1
                told = (places[codes] * 2 + found.leads[mine]).astype("<u4")
                words = found.dictionary.take(pa.array(used)).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([lang]), _one(words), _one(pa.array(counts[used], pa.int64())),
                     pa.array([told.tobytes()], pa.binary())], names=["block", "lang", "words", "counts", "codes"])
                number += 1
            del found
            pa.default_memory_pool().release_unused()

    python_ready(docs.sparkSession)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "block long, lang string, words array<binary>, counts array<long>, codes binary")


def _one(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def numbered(words: DataFrame, name: str) -> DataFrame:
    """(lang, word, f, id): ids from 0 without gaps, numbered within parts by a
    hash and shifted by the parts' sizes."""
    order = Window.partitionBy("part").orderBy("lang", "word")
    ranked = words.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(PARTS)).cast("int"))
    ranked = stage(ranked.withColumn("place", F.row_number().over(order) - 1), name)
    sizes, before, shifts = {r["part"]: r["n"] for r in ranked.groupBy("part").agg(F.count("*").alias("n")).collect()}, 0, []
    for part in range(PARTS):
        shifts.append(before)
        before += sizes.get(part, 0)
    shift = F.get(F.array(*[F.lit(s).cast("long") for s in shifts]), F.col("part"))
    return ranked.select("lang", "word", "f", (shift + F.col("place")).alias("id"))


def phrase_filters(blocks: DataFrame, places: DataFrame, bits: int, prefix: int, held: int = HELD) -> DataFrame:
    """Each task's filters of two- and three-word phrases, by range."""

    def rows(n: int, held_parts: list) -> list:
        """The sorted parts as one, merged range by range: sorting takes many times what it sorts."""
        half = _half(n, bits)
        top = min(MERGE_BITS, half)
        bounds = np.arange(1, 1 << top).astype(U) << U(half - top)
        cuts = [[0, *np.searchsorted(part[0], bounds), len(part[0])] for part in held_parts]
        done = []
        for k in range(1 << top):
            own = [[c[cut[k] : cut[k + 1]] for c in part] for part, cut in zip(held_parts, cuts)]
            left, right, counts = (np.concatenate(c) for c in zip(*own))
            done.append(tallied(left, right, half, counts))
        held_parts.clear()
        return [np.concatenate(c) for c in zip(*done)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        held_of: dict[int, list] = {2: [], 3: []}

        def count(ids: list[np.ndarray], n: int) -> Iterator[pa.RecordBatch]:
            left, right, half = packed(ids, bits)
            held_of[n].append(tallied(*permuted(left, right, half), half))
            # the first part holds what was merged so far
            if sum(len(h[0]) for h in held_of[n][1:]) > held // 8:
                held_of[n] = [rows(n, held_of[n])]
                if len(held_of[n][0][0]) > held // 4 * 3:
                    yield hand_over(n)

        def hand_over(n: int) -> pa.RecordBatch:
            left, right, counts = rows(n, held_of[n])
            held_of[n] = []
            half = _half(n, bits)
            return _filter_rows(ranged(left, right, counts, half, min(prefix, half)), n, shard, bits)

        for batch in batches:
            for k in range(batch.num_rows):
                codes = np.frombuffer(batch.column(0)[k].as_buffer(), "<u4")
                spots, ids = (batch.column(c)[k].values for c in (1, 2))
                known = np.full(int(codes.max()) // 2 + 1, -1, dtype=np.int64)
                known[spots.to_numpy(zero_copy_only=False)] = ids.to_numpy(zero_copy_only=False)
                for at in range(0, len(codes), WORDS_AT_ONCE):
                    own = codes[at : at + WORDS_AT_ONCE + 2]  # a phrase may reach two words further
                    w = known[own >> 1]
                    follows = np.append(own[1:] & 1 == 0, False) & (w >= 0) & (np.append(w[1:], -1) >= 0)
                    w = w.astype(U)
                    two = np.flatnonzero(follows[:WORDS_AT_ONCE])
                    if len(two):
                        yield from count([w[two], w[two + 1]], 2)
                    three = two[follows[two + 1]] if len(two) else two
                    if len(three):
                        yield from count([w[three], w[three + 1], w[three + 2]], 3)
            pa.default_memory_pool().release_unused()
        for n in (2, 3):
            if held_of[n]:
                yield hand_over(n)

    coded = blocks.select("block", "codes").join(places, "block").select("codes", "spots", "ids")
    return coded.mapInArrow(run, _FILTER)


def _half(n: int, bits: int) -> int:
    return bits if n == 2 else (3 * bits + 1) // 2


def _filter_rows(filters: list[QuotientFilter], n: int, shard: int, bits: int) -> pa.RecordBatch:
    kinds = {"half": pa.int32(), "prefix": pa.int32(), "place": pa.int64(), "quotient": pa.int32(), "size": pa.int32()}
    size = len(filters)
    return pa.RecordBatch.from_arrays(
        [pa.array([n] * size, pa.int32()), pa.array([shard] * size, pa.int64()), pa.array([bits] * size, pa.int32()),
         *[pa.array([getattr(f, c) for f in filters], kinds.get(c, pa.binary())) for c in _PARTS]],
        names=["n", "shard", "bits", *_PARTS])


def _filters_in(pdf: pd.DataFrame) -> list[QuotientFilter]:
    return [QuotientFilter(*(int(v) if isinstance(v, (int, np.integer)) else bytes(v) for v in row)) for row in pdf[_PARTS].itertuples(index=False)]


def finer(filters: DataFrame, prefix: int) -> DataFrame:
    """Filters of groups of shards merged and cut into ranges of ``prefix`` bits."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n, bits, half = int(pdf["n"].iloc[0]), int(pdf["bits"].iloc[0]), int(pdf["half"].iloc[0])
        out = ranged(*merged(_filters_in(pdf)), half, min(prefix, half))
        return _filter_rows(out, n, int(pdf["shard"].min()) // FAN, bits).to_pandas()

    group = F.floor(F.col("shard") / FAN).alias("group")
    return filters.groupBy("n", "prefix", "place", group).applyInPandas(run, _FILTER)


def frequent(filters: DataFrame, least: int = LEAST) -> DataFrame:
    """(n, w1, w2, w3, a): the phrases, as ids, that occur ``least`` times over all shards."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n, bits, half = int(pdf["n"].iloc[0]), int(pdf["bits"].iloc[0]), int(pdf["half"].iloc[0])
        left, right, counts = merged(_filters_in(pdf))
        enough = counts >= least
        ids = unpacked(*restored(left[enough], right[enough], half), n, bits)
        w3 = pd.array(ids[2].astype(np.int64), dtype="Int64") if n == 3 else pd.array([None] * len(ids[0]), dtype="Int64")
        return pd.DataFrame({"n": n, "w1": ids[0].astype(np.int64), "w2": ids[1].astype(np.int64), "w3": w3, "a": counts[enough]})

    return filters.groupBy("n", "prefix", "place").applyInPandas(run, _GRAM)


def counted_phrases(blocks: DataFrame, words: DataFrame, known: int, occurrences: int, least: int = LEAST, held: int = HELD,
                    most_ranges: int = MOST_RANGES) -> DataFrame:
    """(n, w1, w2, w3, a) of all frequent phrases; ``words``: (lang, word, id)."""
    bits = max(1, (known - 1).bit_length())
    spots = blocks.select("block", "lang", F.posexplode("words").alias("spot", "word")).join(words.select("lang", "word", "id"), ["lang", "word"])
    each = spots.groupBy("block").agg(F.collect_list(F.struct("spot", "id")).alias("s"))
    places = each.select("block", F.col("s.spot").alias("spots"), F.col("s.id").alias("ids"))
    prefix = min(most_ranges, max(0, (4 * occurrences // held).bit_length()))
    filters = lean_stage(phrase_filters(blocks, places, bits, prefix, held), "op12-filters", BATCH_BYTES)
    while True:
        half = filters.groupBy("n", "half").agg(F.max("prefix").alias("prefix"), F.sum("size").alias("size"), F.max("shard").alias("shard")).collect()
        if all(r["size"] >> r["prefix"] <= 2 * held or r["prefix"] >= r["half"] or r["shard"] == 0 for r in half):
            return frequent(filters, least)
        prefix += 6
        filters = stage(finer(filters, prefix), "op12-finer")


def score(a: Column, first: Column, rest: Column) -> Column:
    """floor(1000000 a a / (first rest)) in exact 38-digit arithmetic."""
    wide = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", (F.lit(1_000_000).cast("decimal(8,0)") * wide(a) * wide(a)), (wide(first) * wide(rest)))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, **limits: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of (lang, text) rows."""
    blocks = lean_stage(blocks_of(docs, limits.pop("block_bytes", BLOCK_BYTES)), "op12-blocks", BATCH_BYTES)
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("z")).select("lang", "z.words", "z.counts")
    sums = F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c)
    totals = stage(blocks.groupBy("lang").agg(F.sum(sums).alias("n")), "op12-totals")
    frequent_words = each.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f")).filter(F.col("f") >= least)
    words = stage(numbered(frequent_words, "op12-places"), "op12-words")
    known, occurrences = words.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
    grams = stage(counted_phrases(blocks, words, known, occurrences, least, **limits), "op12-phrases")

    side = lambda k: words.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"x{k}"), F.col("f").alias(f"f{k}"))
    two = grams.filter("n = 2").select("w1", "w2", "a").join(words.select(F.col("id").alias("w1"), "lang", F.col("word").alias("x1"), F.col("f").alias("f1")), "w1")
    two = stage(two.join(side(2), "w2"), "op12-pairs")
    three = grams.filter("n = 3").select("w1", "w2", "w3", "a")
    # the longer phrases that hold a pair, and what they cover
    inside = three.select("w1", "w2", "a").union(three.select("w2", "w3", "a")).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    kept = two.join(inside, ["w1", "w2"], "left").filter(F.coalesce(F.col("longer") * 100 < F.col("a") * covered, F.lit(True)))
    pairs = kept.select("lang", _phrase("x1", "x2"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
                        score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"))
    ends = two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"), F.col("x2").alias("x3"), F.col("f2").alias("f3"))
    triples = (three.join(two.select("w1", "w2", "lang", "x1", "x2", "f1", F.col("a").alias("l2")), ["w1", "w2"])
               .join(ends, ["w2", "w3"])
               .withColumn("s1", score(F.col("a"), F.col("f1"), F.col("r1"))).withColumn("s2", score(F.col("a"), F.col("l2"), F.col("f3"))))
    early = F.col("s1") <= F.col("s2")
    triples = triples.select("lang", _phrase("x1", "x2", "x3"), "a", F.when(early, F.col("f1")).otherwise(F.col("l2")).alias("l"),
                             F.when(early, F.col("r1")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    best = _best(pairs.unionByName(triples), top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), F.col("phrase").cast("string").alias("phrase"),
                                            "a", "l", "r", "n", "score")


def _phrase(*words: str) -> Column:
    """The words, as bytes, joined by single spaces."""
    parts = [F.col(w) for w in words]
    spaced = [p for w in parts for p in (F.lit(b" "), w)][1:]
    return F.concat(*spaced).alias("phrase")


def _best(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language, first within parts by a hash."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    some = some.filter(F.col("rank") <= top).drop("rank", "part")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE = r"""
with d as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
p as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from d),
g as (select lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as g
      from p, (values (1), (2), (3)) as t(k), unnest(range(1, len(w) - k + 2)) as u(i)),
f as (select lang, k, g, count(*)::hugeint as f, string_split(g, ' ') as w from g group by lang, k, g),
n as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as (select * from f where k > 1 and f >= 10),
s as (select c.lang, c.k, c.g, c.w, c.f as a, cut, l.f as l, r.f as r, (1000000::hugeint * c.f * c.f) // (l.f * r.f) as score
      from c, (values (1), (2)) as x(cut), f l, f r
      where cut < c.k and l.lang = c.lang and r.lang = c.lang
        and l.g = array_to_string(list_slice(c.w, 1, cut), ' ') and r.g = array_to_string(list_slice(c.w, cut + 1, c.k), ' ')),
b as (select * from s qualify row_number() over (partition by lang, g order by score, cut) = 1),
v as (select lang, h, max(f) as longer from (
        select lang, f, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) as h
        from c where k = 3) group by lang, h),
o as (select b.*, row_number() over (partition by b.lang order by score desc, a desc, g) as rank
      from b left join v on b.lang = v.lang and b.g = v.h and b.k = 2 where v.longer is null or 100 * v.longer < 50 * b.a)
select o.lang, o.rank::bigint as rank, g as phrase, a::bigint as a, l::bigint as l, r::bigint as r, n.n, score::bigint as score
from o join n on o.lang = n.lang where rank <= 2000"""

QUERIES = {"op12_phrase_collocations": op12_phrase_collocations}
ORACLES = {"op12_phrase_collocations": ORACLE}
