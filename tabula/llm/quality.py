"""Operator 6, quality rules: a threshold table compiled into one projection.

``MEASURES`` names the signals of a text, ``RULES`` bounds them; ``judge``
compiles both into column expressions, so the whole operator is one scan and
one projection with no shuffle and no user function.

Defined results: a null or empty text has no words, so every count is 0 and it
fails the base rules; repeated rows are judged alike, each on its own; columns
that share a name with a result column are replaced by it, other extra columns
pass through ``filter_documents`` untouched; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that for with on was be by "
    "le la les de des et un une est que pour dans pas "
    "der die das und den von zu mit ist ein eine nicht auf "
    "el los del que y en una por con para es las"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high`` for texts of at least ``from_words`` words."""

    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


RULES = (
    Rule("mean_word_length", low=2.0, high=14.0),
    Rule("symbol_ratio", high=0.25),
    Rule("bang_ratio", high=0.3),
    Rule("alpha_word_ratio", low=0.6),
    Rule("stop_words", low=2, from_words=50),
    Rule("dup_line_ratio", high=0.5),
    Rule("bullet_line_ratio", high=0.9),
    Rule("ellipsis_line_ratio", high=0.3),
)


def _covered(positions: Column, width: int) -> Column:
    """Number of indices covered by windows of ``width`` at sorted ``positions``."""
    gaps = F.transform(positions, lambda p, k: F.least(F.lit(width), F.get(positions, k + 1) - p))
    return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside ``width``-word windows that occur at least twice (all
    occurrences count).  Window hashes are compared after a sort, so a long
    text costs n log n; texts without a repeat stop at the distinct count."""

    def marked(windows: Column) -> Column:
        tagged = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            twin = F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))
                            | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)))
            return F.sort_array(F.transform(twin, lambda x: x["i"]))

        return let(let(tagged, positions), lambda p: _covered(p, width))

    def body(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), lambda i: F.xxhash64(F.slice(w, i, width)))
        return F.when(F.size(w) < width + 1, F.lit(0)).otherwise(
            let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(marked(h))))

    return let(words, body)


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The count columns of the contract and the ratios the rules bound."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n_lines = F.greatest(F.size(lines), F.lit(1))
    n_words = F.size(words)
    some = F.greatest(n_words, F.lit(1))
    chars = F.length(F.array_join(words, ""))
    symbols = F.regexp_count(text, F.lit(r"[#*$%&|<>]"))
    dup_lines = F.size(lines) - F.size(F.array_distinct(lines))
    return {
        "n_words": n_words.cast("long"),
        "word_chars": chars.cast("long"),
        "n_symbols": symbols.cast("long"),
        "n_dup_lines": dup_lines.cast("long"),
        "n_repeat_words": repeated_words(words).cast("long"),
        "mean_word_length": chars / some,
        "symbol_ratio": symbols / some,
        "bang_ratio": F.regexp_count(text, F.lit(r"!")) / some,
        "alpha_word_ratio": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))) / some,
        "stop_words": F.size(F.array_intersect(F.transform(words, F.lower), F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)]))),
        "dup_line_ratio": dup_lines / n_lines,
        "bullet_line_ratio": F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))) / n_lines,
        "ellipsis_line_ratio": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))) / n_lines,
    }


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _verdict(rules) -> Column:
    passed = F.lit(True)
    for r in rules:
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (F.col(r.measure) >= r.low)
        if r.high is not None:
            ok = ok & (F.col(r.measure) <= r.high)
        passed = passed & ((F.col("n_words") < r.from_words) | ok)
    return passed


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """``docs`` plus every measure, ``base_failed`` and ``kept``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    with_words = docs.withColumn("__words", words_of(text))
    measured = with_words.withColumns(measures(text, F.col("__words"))).drop("__words")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & _verdict(rules))


def filter_documents(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text"))
    return judge(keyed, rules).filter("kept").select("__row.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents: base counts and the verdict per text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", *COUNTS, "base_failed", "kept")


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
ORACLE = rf"""
with d as (
  select doc_id, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from documents),
win as (
  select doc_id, i, list_slice(w, i, i + {WINDOW - 1}) as g
  from d, unnest(range(1, len(w) - {WINDOW - 2})) as u(i)),
rep as (select doc_id, g from win group by doc_id, g having count(*) > 1),
hit as (select distinct win.doc_id, i + k as p from win join rep on win.doc_id = rep.doc_id and win.g = rep.g,
        unnest(range({WINDOW})) as v(k)),
n as (select doc_id, count(*) as c from hit group by doc_id),
m as (
  select d.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
         len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(c, 0) as n_repeat_words,
         length(t) - length(replace(t, '!', '')) as bangs, greatest(len(w), 1) as nw, greatest(len(ls), 1) as nl,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) as alphas,
         len(list_distinct(list_filter(list_transform(w, lambda x: lower(x)), lambda x: x in ({_STOPS})))) as stops,
         len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[-*\x{{2022}}]'))) as bullets,
         len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}})\s*$'))) as dots
  from d left join n on d.doc_id = n.doc_id)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
       (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) as base_failed,
       not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
       and word_chars / nw between 2.0 and 14.0 and n_symbols / nw <= 0.25 and bangs / nw <= 0.3
       and alphas / nw >= 0.6 and (n_words < 50 or stops >= 2) and n_dup_lines / nl <= 0.5
       and bullets / nl <= 0.9 and dots / nl <= 0.3 as kept
from m"""

QUERIES = {"op6_quality_rules": op6_quality_rules}
ORACLES = {"op6_quality_rules": ORACLE}
