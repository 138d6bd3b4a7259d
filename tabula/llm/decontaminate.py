"""Operator 2, benchmark decontamination by a positional inverted index.

A window is ten consecutive words of a test item (a shorter item is one
window).  1. One pass cuts every text into words and keeps their 64-bit hashes
with their positions; texts are not read again.  2. The terms that test items
use are counted over all documents, and each window names its two rarest that
occur.  3. The postings (term, document, position) of those terms are taken; a
posting also carries the words around it.  4. For every window the lists of its
two terms, each shifted by the term's offset in the window, are intersected.
A start that both lists name and whose carried words are the window's is an
exact match; starts that differ by at most ``SLOP`` are a proximity match, so
a passage with a changed, missing or inserted word is told too.

What is shuffled are counts, postings of rare test terms and hits; small
tables are staged, so Spark broadcasts them by their size or not at all.  A
posting list may be long (a passage that a third of the documents share): it
is spread over tasks by document, never gathered by term.

Defined results: null or empty texts and items have no words and match
nothing; items with equal text all count; every row has hits of its own,
whatever other rows have its doc_id or none; null item_ids are left out; extra
columns are ignored (``clean`` passes them through); empty tables give no rows
or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bytewords import byte_kinds, listed_codes, text_slices, word_hashes, words_in
from .common import lean_stage, python_ready, table

WIDTH = 10
RAREST = 2
SLOP = 3

#: All of ASCII but digits and letters separates words.
_KINDS = byte_kinds(bytes(b for b in range(128) if not chr(b).isalnum()))


def hashed(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, row, digest, w): each row of (key, text) under a number of its own,
    a digest of its text, and the hashes of its words, lower-cased, in order."""
    if "w" in docs.columns:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 32
        for part in text_slices(batches, 2):
            found = words_in(part.column(2), _KINDS)
            words = listed_codes(word_hashes(found.dictionary), found, part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(range(row, row + part.num_rows), pa.int64()), part.column(1), words],
                names=["key", "row", "digest", "w"])
            row += part.num_rows

    python_ready(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    made = docs.select(key, F.md5("text").alias("digest"), "text").mapInArrow(run, f"key {kind}, row long, digest string, w array<long>")
    return made.withColumnRenamed("key", key)


def windows_of(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(window, item_id, words): the distinct windows of all items; ``window`` names the words."""
    words = hashed(items.filter("item_id is not null").select("item_id", "text"), "item_id").filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    each = words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice(F.col("w"), i, width))).alias("words"))
    return each.select(F.md5(F.array_join(F.transform("words", lambda x: x.cast("string")), ",")).alias("window"), "item_id", "words").distinct()


def anchors_of(docs: DataFrame, windows: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(window, place, term, offset, words): each window's rarest terms, of
    those that occur, by their occurrences in all documents and then by their
    offset; place 0 is the rarest."""
    terms = lean_stage(windows.select(F.explode("words").alias("term")).distinct(), "op2-terms")
    counts = hashed(docs).select(F.explode("w").alias("term")).join(terms, "term").groupBy("term").count()
    places = windows.select("window", "words").distinct().select("window", "words", F.posexplode("words").alias("offset", "term"))
    first = Window.partitionBy("window").orderBy("count", "offset")
    ranked = places.join(counts, "term").withColumn("place", F.row_number().over(first) - 1)
    return ranked.filter(F.col("place") < rarest).select("window", "place", "term", "offset", "words")


def index_postings(docs: DataFrame, anchors: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, row, term, pos, first, around): postings of the anchors' terms.
    Those of a window's rarest term carry the up to ``width - 1`` words on
    either side, from the position ``first``; the others are positions alone."""
    terms = lean_stage(anchors.groupBy("term").agg((F.min("place") == 0).alias("carries")), "op2-anchor-terms")
    seen = hashed(docs).select("doc_id", "row", "w", F.posexplode("w").alias("pos", "term")).join(terms, "term")
    first = F.greatest(F.col("pos") - (width - 1), F.lit(0))
    around = F.slice("w", first + 1, F.col("pos") + width - first)
    return seen.select("doc_id", "row", "term", "pos", first.alias("first"), F.when(F.col("carries"), around).alias("around"))


def intersected(postings: DataFrame, anchors: DataFrame, slop: int = SLOP) -> DataFrame:
    """(doc_id, row, window, starts, length, near) of the windows that a row
    matches: exact starts, none for a proximity match alone."""
    told = anchors.withColumn("places", F.count("*").over(Window.partitionBy("window")))
    shifted = postings.join(told, "term").withColumn("start", F.col("pos") - F.col("offset"))
    rarest = F.col("place") == 0
    own = F.slice("around", F.col("start") - F.col("first") + 1, F.size("words"))
    exact = rarest & (F.col("start") >= F.col("first")) & (own == F.col("words"))
    lists = shifted.groupBy("doc_id", "row", "window").agg(
        F.collect_list(F.when(rarest, F.col("start"))).alias("s0"), F.collect_list(F.when(~rarest, F.col("start"))).alias("s1"),
        F.collect_list(F.when(exact, F.col("start"))).alias("sx"), F.max("places").alias("places"), F.max(F.size("words")).alias("length"))
    alone = F.col("places") == 1
    starts = F.when(alone, F.array_distinct("sx")).otherwise(F.array_intersect("sx", "s1"))
    reach = F.flatten(F.transform("s0", lambda s: F.sequence(s - slop, s + slop)))
    near = F.when(alone, F.size("sx") > 0).otherwise(F.arrays_overlap(reach, "s1"))
    return lists.select("doc_id", "row", "window", starts.alias("starts"), "length", near.alias("near")).filter("near")


def phrase_matches(postings: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc_id, row, window, start, length) of every exact occurrence of a window."""
    return intersected(postings, anchors).select("doc_id", "row", "window", F.explode("starts").alias("start"), "length")


def proximity_matches(postings: DataFrame, anchors: DataFrame, slop: int = SLOP) -> DataFrame:
    """(doc_id, row, window): both rarest terms of a window in their order's
    places but for at most ``slop`` positions; exact matches are among them."""
    return intersected(postings, anchors, slop).select("doc_id", "row", "window")


def found_in(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows in words, the windows, and what ``intersected`` finds, each staged."""
    words = lean_stage(hashed(docs.select("doc_id", "text")), "op2-words")
    windows = lean_stage(windows_of(items, width), "op2-windows")
    anchors = lean_stage(anchors_of(words, windows), "op2-anchors")
    return words, windows, lean_stage(intersected(index_postings(words, anchors, width), anchors), "op2-matches")


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near)
    per row of (doc_id, text); ``n_near`` counts items with a proximity match."""
    words, windows, matches = found_in(docs, items, width)
    each = matches.select("row", F.col("length"), F.explode("starts").alias("start"))
    places = each.select("row", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("p"))
    hit = places.distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    owners = windows.select("window", "item_id")
    exact = F.size("starts") > 0
    found = (matches.join(owners, "window").groupBy("row", "item_id").agg(F.max(exact).alias("exact")).groupBy("row")
             .agg(F.sort_array(F.collect_list(F.when(F.col("exact"), F.col("item_id").cast("string")))).alias("ids"), F.count("*").alias("n_near")))
    told = (hit.select("row", "n_hit", F.lit(None).cast("array<string>").alias("ids"), F.lit(None).cast("long").alias("n_near"))
            .unionByName(found.select("row", F.lit(None).cast("long").alias("n_hit"), "ids", "n_near"))
            .groupBy("row").agg(F.max("n_hit").alias("n_hit"), F.max("ids").alias("ids"), F.max("n_near").alias("n_near")))
    out = words.select("doc_id", "row", F.size("w").cast("long").alias("n_words")).join(told, "row", "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` without an exact match, with all their columns.  A
    match depends on the text alone, so rows leave by their text."""
    words, _, matches = found_in(docs, items, width)
    hit = matches.filter(F.size("starts") > 0).select("row").distinct()
    bad = words.join(hit, "row", "left_semi").select(F.col("digest").alias("__digest")).distinct()
    return docs.join(bad, F.md5("text") == F.col("__digest"), "left_anti")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (select distinct item_id, array_to_string(list_slice(w, i, i + 9), ' ') as g, least(len(w), 10) as n
       from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as u(i) where len(w) > 0),
ln as (select distinct n from bw),
dw as (select doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as g
       from d, ln, unnest(range(1, len(w) - n + 2)) as u(i)),
m as (select distinct dw.doc_id, dw.i, bw.n, item_id from dw join bw on dw.g = bw.g and dw.n = bw.n),
h as (select doc_id, count(distinct i + k) as n_hit from m, unnest(range(n)) as v(k) group by doc_id),
t as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
      from (select distinct doc_id, item_id from m) group by doc_id),
p as (select doc_id, k - 1 as pos, w[k] as term from d, unnest(range(1, len(w) + 1)) as u(k)),
c as (select term, count(*) as c from p group by term),
o as (select distinct bw.g, n, j - 1 as off, string_split(bw.g, ' ')[j] as term from bw, unnest(range(1, n + 1)) as u(j)),
a as (select g, n, off, o.term, row_number() over (partition by g, n order by c, off) as place, count(*) over (partition by g, n) as places
      from o join c on o.term = c.term),
f as (select p.doc_id, a.g, a.n, place, places, pos - off as start from p join a on p.term = a.term where place <= 2),
x as (select distinct f.doc_id, f.g, f.n from f join f b on f.doc_id = b.doc_id and f.g = b.g and f.n = b.n
      where f.place = 1 and b.place = 2 and abs(f.start - b.start) <= 3
      union select distinct doc_id, g, n from f where places = 1 and n = 1),
r as (select doc_id, count(distinct item_id) as n_near from x join bw on x.g = bw.g and x.n = bw.n group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated, coalesce(n_near, 0)::bigint as n_near
from d left join h on d.doc_id = h.doc_id left join t on d.doc_id = t.doc_id left join r on d.doc_id = r.doc_id"""

QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLES = {"op2_decontaminate": ORACLE}
