"""Quotient filters against dictionaries; collocations against plain counting."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabula.llm import bytewords, phrases, quotient

from .helpers import LOWER, ODD_TEXTS


@pytest.mark.parametrize("half", [1, 3, 17, 31, 32, 33, 50, 63])
def test_permutation_can_be_undone(half):
    rng = np.random.default_rng(half)
    left, right = (rng.integers(0, 1 << half, 500, dtype=np.uint64) for _ in range(2))
    a, b = quotient.permuted(left, right, half)
    assert int(a.max()) < 1 << half and int(b.max()) < 1 << half
    x, y = quotient.restored(a, b, half)
    assert (x == left).all() and (y == right).all()
    if half == 3:  # all keys: a permutation
        every = np.arange(64, dtype=np.uint64)
        a, b = quotient.permuted(every >> np.uint64(3), every & np.uint64(7), 3)
        assert sorted((a * np.uint64(8) + b).tolist()) == list(range(64))


@pytest.mark.parametrize("bits", [1, 2, 9, 21, 22, 31, 42])
def test_ids_are_packed_whole(bits):
    rng = np.random.default_rng(bits)
    ids = [rng.integers(0, 1 << bits, 300, dtype=np.uint64) for _ in range(3)]
    for n in (2, 3):
        left, right, half = quotient.packed(ids[:n], bits)
        assert 2 * half >= n * bits and int(left.max()).bit_length() <= half and int(right.max()).bit_length() <= half
        assert all((a == b).all() for a, b in zip(ids, quotient.unpacked(left, right, n, bits)))


@pytest.mark.parametrize("half,prefix", [(5, 0), (12, 3), (12, 12), (32, 4), (40, 6), (63, 12)])
def test_filters_merge_without_loss(half, prefix):
    rng = np.random.default_rng(half)
    want, shards = Counter(), []
    for _ in range(4):
        keys = rng.integers(0, min(1 << half, 300), (900, 2), dtype=np.uint64) << np.uint64(max(0, half - 9))
        keys[:400] = keys[0]  # one key holds many occurrences
        want.update(map(tuple, keys.tolist()))
        left, right, counts = quotient.tallied(*quotient.permuted(keys[:, 0], keys[:, 1], half), half)
        shards.append(quotient.ranged(left, right, counts, half, prefix))
    got = Counter()
    for place in {f.place for s in shards for f in s}:
        left, right, counts = quotient.merged([f for s in shards for f in s if f.place == place])
        assert sorted(zip(left.tolist(), right.tolist())) == list(zip(left.tolist(), right.tolist()))
        got.update({k: int(c) for k, c in zip(zip(*(x.tolist() for x in quotient.restored(left, right, half))), counts)})
    assert got == want


def plain_pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def test_words_of_bytes():
    kinds = bytewords.byte_kinds(phrases.BLANKS, phrases.BREAKS)
    texts = [*ODD_TEXTS, " lead", "trail ", "a,b", ",", "É.é", "x"]
    for column in (pa.array(texts), pa.array(["skip", *texts])[1:], pa.array([], pa.string()), pa.array([None, None], pa.string())):
        found = bytewords.words_in(column, kinds)
        words = [w.decode() for w in found.dictionary.to_pylist()]
        got = [[] for _ in column]
        for code, row, lead in zip(found.codes, found.rows, found.leads):
            if lead:
                got[row].append([])
            got[row][-1].append(words[code])
        assert got == [[p for p in plain_pieces(t) if p] for t in column.to_pylist()]


def test_slices_hold_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array([None if k % 7 == 0 else "ab" * k for k in range(40)])], names=["k", "t"])
    parts = list(bytewords.text_slices(iter([batch, batch.slice(5, 9), batch.slice(0, 0)]), 1, 60))
    assert [k for p in parts for k in p.column(0).to_pylist()] == [*range(40), *range(5, 14)]
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 60 for p in parts)


def plain(rows, least, top, covered):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in plain_pieces(text):
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    out = {lang: [] for lang in n}
    for (lang, g), a in f.items():
        if len(g) < 2 or a < least:
            continue
        if len(g) == 2 and any(100 * b >= covered * a for (m, h), b in f.items()
                               if m == lang and len(h) == 3 and b >= least and g in (h[:2], h[1:])):
            continue
        s, k = min((1_000_000 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
        out[lang].append((-s, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                  for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def made(seed, docs=160):
    rng = np.random.default_rng(seed)
    words = ["the", "of", "red", "box", "New", "york", "city", "ÉT", "日本", "a", "b", "c", *[f"w{k}" for k in range(25)]]
    stops = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; "]
    rows = [(["en", "fr", None, "und"][k % 4], "".join(words[int(len(words) * r * r)] + stops[s] for r, s in
             zip(rng.random(90), rng.integers(0, len(stops), 90)))) for k in range(docs)]
    rows += [("en", "new york city " * 30)] * 5 + [("de", None), ("de", ""), (None, "hot pair " * 200)]
    return rows + [("en", t) for t in ODD_TEXTS[:-3]]


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 500, "held": 40, "most_ranges": 1}, {"top": 3, "least": 25, "covered": 90}])
def test_against_plain_counting(spark, limits):
    rows = made(len(limits))
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in phrases.collocations(df, **limits).collect())
    assert got == plain(rows, limits.get("least", 10), limits.get("top", 2000), limits.get("covered", 50))
    assert len(got) > 5


def test_wide_ids_give_the_same(spark, monkeypatch):
    rows = made(7, 60)
    df = spark.createDataFrame(rows, "lang string, text string")
    real = phrases.counted_phrases
    # ids of 34 bits: keys past 64 bits
    monkeypatch.setattr(phrases, "counted_phrases", lambda b, w, known, *a, **k: real(b, w, 1 << 34, *a, **k))
    got = sorted(tuple(r[c] for c in COLUMNS) for r in phrases.collocations(df).collect())
    assert got == plain(rows, 10, 2000, 50)


def test_odd_tables(spark):
    schema = "lang string, text string, phrase string, n int"
    empty = spark.createDataFrame([], schema)
    assert phrases.collocations(empty).count() == 0
    some = spark.createDataFrame([("en", None, "x", 1), (None, "", "y", 2), ("en", "once only", None, None)], schema)
    out = phrases.collocations(some)
    assert out.count() == 0 and out.columns == list(COLUMNS)


def test_scores_past_64_bits(spark):
    a, left, right = 3_000_000_001, 3_000_000_007, 4_000_000_000_003
    row = spark.range(1).select(phrases.F.lit(a).cast("long").alias("a"), phrases.F.lit(left).cast("long").alias("l"), phrases.F.lit(right).cast("long").alias("r"))
    got = row.select(phrases.score(phrases.F.col("a"), phrases.F.col("l"), phrases.F.col("r"))).first()[0]
    assert got == 1_000_000 * a * a // (left * right)


def test_blocks_from_small_pieces():
    """Blocks gather batches of any size, and words found piece by piece are those found at once."""
    import numpy as np
    import pyarrow as pa

    from tabula.llm import bytewords as B

    texts = ["A b. c", None, "", "b a,a", "\u00e9 c b", "x " * 40, "c"]
    batches = [pa.record_batch({"lang": ["x"] * len(t), "text": pa.array(t, pa.string())}) for t in (texts[:2], texts[2:5], texts[5:])]
    groups = list(B.gathered(iter(batches), 1, 30))
    assert len(groups) == 3 and sum(p.num_rows for g in groups for p in g) == len(texts)
    kinds = B.byte_kinds(b" \t", b".,")
    once, pieces = B.words_in(pa.array(texts), kinds), B.words_of_pieces(batches, 1, kinds)
    assert once.dictionary.equals(pieces.dictionary)
    for name in ("codes", "rows", "leads"):
        assert np.array_equal(getattr(once, name), getattr(pieces, name)), name


def test_large_rows_get_pages_of_their_own(spark):
    """op12: a staged row of some MB is a page, and the settings hold for that write alone."""
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from tabula.llm import common

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    staged = common.lean_stage(spark.range(0, 4, numPartitions=1).select(F.repeat(F.lit("ab"), 1 << 20).alias("t")), "rows", 8 << 20)
    assert spark.conf.get(key) == before and staged.count() == 4
    column = pq.ParquetFile(staged.inputFiles()[0].removeprefix("file://")).metadata.row_group(0).column(0)
    assert column.compression == "ZSTD"
