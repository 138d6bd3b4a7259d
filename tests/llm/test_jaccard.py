"""The Jaccard join against all pairs of plain Python sets."""

import numpy as np
import pyarrow as pa
import pytest

from tabula.llm import jaccard

from .helpers import TABLES, no_documents, odd_documents, shingles

COLUMNS = ["doc_id", "n_shingles", "component_id"]


def plain_links(sets, percent):
    held = {}
    for k, s in enumerate(sets):
        for g in s:
            held.setdefault(g, []).append(k)
    for a, s in enumerate(sets):
        met = {b for g in s for b in held[g] if b > a}
        for b in met:
            if 100 * len(s & sets[b]) >= percent * len(s | sets[b]):
                yield a, b


def plain(rows, percent=85):
    sets = [shingles(t, 4) for _, t in rows]
    top = list(range(len(rows)))

    def find(k):
        while top[k] != k:
            top[k] = top[top[k]]
            k = top[k]
        return k

    for a, b in plain_links(sets, percent):
        top[find(a)] = find(b)
    ids = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(k)] = min(ids.get(find(k), d), d)
    return [(d, len(s), ids.get(find(k)) if s else d) for k, ((d, _), s) in enumerate(zip(rows, sets))]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def families(seed, n=260):
    """Texts with near copies around the threshold, shared passages and one template."""
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(60)]
    passage = [f"p{k}" for k in range(40)]
    rows, template = [], [f"t{k}" for k in range(50)]
    for k in range(n):
        text = list(rng.choice(words, rng.integers(3, 70)))
        if k % 3 == 0:
            text += passage
        if k % 5 == 0:
            text = [w if rng.random() > 0.03 else str(rng.choice(words[:9])) for w in template]
        rows.append((k, " ".join(text)))
        for c in range(rng.integers(0, 4)):
            near = list(text)
            for _ in range(rng.integers(0, 3)):
                near[rng.integers(len(near))] = f"e{rng.integers(50)}"
            rows.append((1000 + 10 * k + c, "  ".join(near).upper()))
    return rows + [(5000, rows[0][1]), (None, rows[0][1]), (0, rows[0][1])]


@pytest.mark.parametrize("seed,percent", [(0, 85), (1, 85), (2, 60), (3, 100)])
def test_join_against_all_pairs(spark, seed, percent):
    rows = families(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [tuple(r[c] for c in COLUMNS) for r in jaccard.joined(df, percent).collect()]
    assert sorted(got, key=key) == sorted(plain(rows, percent), key=key)


def test_every_pair_is_listed(spark):
    rows = [r for r in families(4, 120) if r[0] is not None and r[0] < 5000]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pairs, member = jaccard.similar_pairs(df, 80)
    of = {}
    for r in member.collect():
        of.setdefault(r["id"], []).append(r["doc_id"])
    sets = {d: shingles(t, 4) for d, t in rows}
    got = {}
    for r in pairs.collect():
        a, b = (sets[of[r[x]][0]] for x in "ab")
        assert r["overlap"] == len(a & b)
        got[frozenset((a, b))] = got.get(frozenset((a, b)), 0) + 1
    each = list(set(sets.values()))
    assert got == {frozenset((each[a], each[b])): 1 for a, b in plain_links(each, 80)}


def test_odd_rows(spark):
    df = odd_documents(spark, extra=True)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = [tuple(r[c] for c in COLUMNS) for r in jaccard.joined(df).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    assert jaccard.joined(no_documents(spark)).count() == 0
    lone = spark.createDataFrame([(None, "same words here too"), (None, "same words here too"), (None, None)], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.joined(lone).collect()), key=key) == sorted([(None, 1, None), (None, 1, None), (None, 0, None)], key=key)


def test_query_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r[c] for c in COLUMNS) for r in jaccard.op11_ngram_jaccard_join(spark, TABLES).collect()]
    assert sorted(got) == sorted(plain(rows))


def test_large_group_is_not_paired_whole(spark):
    """A group of near copies is paired with centres, not all with all."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(600):
        text = list(base)
        text[rng.integers(120)] = f"e{k}"
        rows.append((k, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, _, sets, columns = jaccard.prepared(df, 85)
    first = jaccard._with_centres(columns.withColumn("component", columns["id"]), None, 85)
    assert first.count() < 600 * 40
    assert {r["component_id"] for r in jaccard.joined(df).collect()} == {0}


@pytest.mark.parametrize("groups", [1, 4, 9])
def test_blocks_of_the_product(groups):
    rng = np.random.default_rng(groups)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 50))) for _ in range(50)]
    ids = rng.permutation(1000)[:50]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(50), np.arange(50)))
    got = jaccard.block_product(ids[a], ids[b], ids, pa.array([s.tolist() for s in sets], pa.list_(pa.int64())), 50, groups)
    want = {(ids[x], ids[y], len(np.intersect1d(sets[x], sets[y]))) for x, y in zip(a, b)
            if 2 * len(np.intersect1d(sets[x], sets[y])) >= len(np.union1d(sets[x], sets[y]))}
    assert set(zip(*(c.tolist() for c in got))) == want

