"""Decontamination, near-duplicates and the pipeline against plain Python."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabula.llm import decontaminate, neardup, quality
from tabula.llm.common import stage, table

from .helpers import LOWER, ODD_TEXTS, TABLES, no_documents, odd_documents, shingles


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_contamination(docs, items):
    windows = {}
    for item, text in items:
        w = item_words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    counts = Counter(w for _, text in docs for w in item_words(text))
    anchors = {g: sorted((counts[w], k, w) for k, w in enumerate(g) if counts[w])[:2] for g in windows}
    out = []
    for d, text in docs:
        w, hit, found, near = item_words(text), set(), set(), set()
        at = {}
        for k, x in enumerate(w):
            at.setdefault(x, []).append(k)
        for g, two in anchors.items():
            starts = [[p - k for p in at.get(x, [])] for _, k, x in two]
            if len(two) == 2 and any(abs(a - b) <= 3 for a in starts[0] for b in starts[1]) or len(g) == 1 and g[0] in at:
                near |= windows[g]
        for n in sizes:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= own
        ids = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit), len(near)))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_contamination_of_odd_rows(spark):
    items = [(1, "a b c d e f g h i j k"), (2, "One"), (10, "two WORDS"), (3, None), (4, "..."), (5, "Two words"),
             (6, "É é 日本語"), (7, "a a a a a a a a a a a"), (8, "nowhere to be found at all in any of these texts")]
    docs = [(k, t) for k, t in enumerate(ODD_TEXTS) if k != 7] + [
        (100, "x A B. c d-e f g h i j k a b"), (101, "é É 日本語 one"), (102, "a " * 15), (103, "ONE one oné"), (None, "one")]
    made = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                       spark.createDataFrame(items, "item_id long, text string"))
    assert order(made.collect()) == order(brute_contamination(docs, items))


def test_contamination_of_repeated_rows_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    docs = odd_documents(spark, extra=True)
    rows = decontaminate.contamination(docs, items).filter("doc_id = 7").collect()
    assert len(rows) == 2 and all(r["n_hit"] == 10 and r["contaminated"] for r in rows)
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and kept.filter("doc_id in (7, 8)").count() == 0
    assert kept.filter("doc_id is null").count() == 2
    none = items.filter("false")
    assert decontaminate.contamination(docs, none).filter("contaminated").count() == 0
    assert decontaminate.contamination(no_documents(spark), items).count() == 0


def test_every_row_has_hits_of_its_own(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    rows = [(k, t) for k in (None, 3) for t in ("a b c d e f g h i j", "x y z", "a b c d e f g h i j k", None)] + [(4, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contamination(docs, items).collect()
    assert order(got) == order(brute_contamination(rows, [(1, "a b c d e f g h i j")]))
    assert order(decontaminate.clean(docs, items).collect()) == order([r for r in rows if r[1] in ("x y z", None)])


def test_a_changed_word_is_a_proximity_match(spark):
    items = [(1, "one two three four five six seven eight nine ten")]
    docs = [(1, "so one two three four five SIX seven eight nine ten it is"), (2, "one two three four five other seven eight nine ten"),
            (3, "one two three four five six seven eight nine inserted ten"), (4, "ten nine eight seven six five four three two one")]
    made = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                       spark.createDataFrame(items, "item_id long, text string")).collect()
    assert order(made) == order(brute_contamination(docs, items))
    assert {r["doc_id"]: (r["n_items"], r["n_near"] > 0) for r in made}[1] == (1, True)
    lost = decontaminate.contamination(spark.createDataFrame(docs[1:2], "doc_id long, text string"),
                                       spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(r["n_items"], r["n_near"]) for r in lost] == [(0, 1)]  # six occurs nowhere


def test_proximity_allows_slop(spark):
    docs = spark.createDataFrame([(1, "rare1 of the one rare2"), (2, "rare1 of the one and rare2"), (3, "rare1 x x x x x x x x rare2"),
                                  (4, "rare2 rare1"), (5, "of the one " * 9)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "rare1 of the one rare2")], "item_id long, text string")
    windows = decontaminate.windows_of(items)
    anchors = decontaminate.anchors_of(docs, windows)
    postings = decontaminate.index_postings(docs, anchors)
    assert {r["doc_id"] for r in decontaminate.phrase_matches(postings, anchors).collect()} == {1}
    assert {r["doc_id"] for r in decontaminate.proximity_matches(postings, anchors).collect()} == {1, 2}


def brute_components(docs, percent=85):
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {c: min(d for (d, _), x in zip(docs, label) if x == c) for c in label}
    return [(d, len(s), least[c], d == least[c]) for (d, _), s, c in zip(docs, sets, label)]


def families(seed):
    """Groups of copies with few and many edits, chains, and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    docs = []
    for _ in range(6):
        base = [word() for _ in range(rng.choice([6, 30, 80, 150]))]
        docs.append(" ".join(base))
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 9])):
                copy[rng.randrange(len(copy))] = word()
            docs.append(" ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy))
        chain = list(base)
        for _ in range(8):
            chain[rng.randrange(len(chain))] = word()
            docs.append(" ".join(chain))
    docs += [" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(30)] + ["", " ", "one", "ONE", "a b c d", "a b c d"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed):
    docs = families(seed)
    made = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert order(made.collect()) == order(brute_components(docs))


def brute_kept(docs, percent):
    """Doc ids that are the least of their component at ``percent``."""
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    for i, j in itertools.combinations(range(len(docs)), 2):
        c = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
            label = [label[i] if x == label[j] else x for x in label]
    return {min(d for (d, _), x in zip(docs, label) if x == c) for c in label}


def test_near_copies_from_80_per_cent_on(spark):
    docs = families(3)
    assert brute_kept(docs, 80) != brute_kept(docs, 85)
    kept = neardup.drop_near_copies(spark.createDataFrame(docs, "doc_id long, text string"), 80)
    assert {r["doc_id"] for r in kept.collect()} == brute_kept(docs, 80)


def test_texts_under_one_id_are_rows_of_their_own(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "seven eight nine ten eleven twelve")
    rows = [(1, a, 0), (1, b, 1), (1, a, 2), (2, a + " ", 3), (None, b, 4), (None, c, 5), (None, c.upper(), 6), (3, None, 7), (3, "", 8), (3, None, 9)]
    kept = neardup.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, n int"), 80).collect()
    assert order((r["doc_id"], (r["text"] or "").strip().lower()) for r in kept) == order([(1, a), (1, b), (None, c), (3, ""), (3, "")])


def test_near_duplicates_of_odd_rows(spark):
    docs = odd_documents(spark, extra=True)
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == len(ODD_TEXTS) + 4
    by = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 5, 7)}
    assert by[6]["component_id"] == 5 and not by[6]["kept"] and by[0]["n_shingles"] == 0 and by[0]["kept"]
    kept = neardup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [k for k in range(len(ODD_TEXTS)) if k not in (6, 8)] and ids.count(None) == 2
    assert neardup.near_duplicates(no_documents(spark)).count() == 0
    assert neardup.drop_near_copies(no_documents(spark)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(1000, 1100)] + [(3, 7)]
    got = dict(neardup.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 3 for k in (3, 7, *range(1000, 1100))}}


def test_signature_estimates_the_overlap():
    import numpy as np

    a, b = neardup.coefficients()
    x = np.random.default_rng(0).integers(0, 1 << 63, 4000).astype(np.uint64)
    for share in (0.5, 0.85, 0.95):
        cut = int(4000 * (1 - share) / 2)
        m, n = neardup.minima(x[: 4000 - cut], a, b), neardup.minima(x[cut:], a, b)
        true = (4000 - 2 * cut) / 4000
        assert abs((m == n).mean() - true) < 4 * math.sqrt(true * (1 - true) / len(a))


def test_pipeline_stages_against_plain_python(spark):
    docs = table(spark, TABLES, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = {r["doc_id"] for r in quality.judge(docs).filter("kept").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    first = stage(stages[names[0]](spark, docs, TABLES), "test-1")
    assert first.columns == docs.columns and {r["doc_id"] for r in first.collect()} == kept
    rows = [r for r in rows if r[0] in kept]
    second = stage(stages[names[1]](spark, first, TABLES), "test-2")
    kept = {d for d, _, _, own in brute_components(rows, 80) if own}
    assert second.columns == docs.columns and {r["doc_id"] for r in second.collect()} == kept
    rows = [r for r in rows if r[0] in kept]
    items = [(r["item_id"], r["text"]) for r in table(spark, TABLES, "benchmark").collect()]
    third = stage(stages[names[2]](spark, second, TABLES), "test-3")
    kept = {r[0] for r in brute_contamination(rows, items) if not r[5]}
    assert third.columns == docs.columns and {r["doc_id"] for r in third.collect()} == kept
    fourth = stage(stages[names[3]](spark, third, TABLES), "test-4")
    assert fourth.columns == docs.columns and {r["doc_id"] for r in fourth.collect()} == kept
    assert not fourth.filter(F.col("text").rlike(r"@mail\d")).count()
    last = corpus_pipeline.run(spark, TABLES)
    assert {r["doc_id"] for r in last.select("doc_id").distinct().collect()} == kept


def test_pipeline_of_empty_and_odd_documents(spark):
    for docs in (odd_documents(spark, extra=True), odd_documents(spark, extra=True).filter("false")):
        for name, run in corpus_pipeline.STAGES[:-1]:
            out = stage(run(spark, docs, TABLES), f"odd-{name}")
            assert out.columns == docs.columns and out.count() <= docs.count()
            docs = out
        corpus_pipeline.STAGES[-1][1](spark, docs, TABLES).count()
