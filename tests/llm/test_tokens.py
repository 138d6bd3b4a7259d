"""Token counts, packing, sharding and language-model scoring."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabula.llm import lm, packing, shards, tokencount
from tabula.llm.common import table
from tabula.llm.subwords import WordEncoder

from .helpers import ODD_TEXTS, TABLES, no_documents, odd_documents

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
byte_library, word_library = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
prefixes, encoder = tokencount.PrefixTable(BYTES), WordEncoder(WORDS)
PIECES = st.lists(st.sampled_from(["a", "The", " ", "  ", "\n", "\t", ",", ".", "'s", "ß", "É", "ή", "Σ", "日", "😀", "́", "\xa0",
                                   "\x1c", "\x85", "12", "½", "<|endoftext|>", "<|", "ing", "\x00", "İ"]), max_size=25).map("".join)


def library_count(text):
    return len(byte_library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.one_of(PIECES, st.text(max_size=40)))
def test_prefix_totals_equal_the_library(text):
    assert prefixes.total(text) == library_count(text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(PIECES, st.text(max_size=40)))
def test_word_ids_equal_the_library(text):
    assert np.frombuffer(encoder.blob(text), "<u4").tolist() == word_library.encode(text, add_special_tokens=False).ids


def test_prefix_table_counts_every_prefix_of_a_pre_token():
    for word in (" thanonontioniner", "Enschauberheit", " éeauxion", "((((((((", " 1234567"):
        data, counts = word.encode(), prefixes.counts(word.encode())
        for k in range(1, len(data) + 1):
            try:
                part = data[:k].decode()
            except UnicodeDecodeError:
                continue
            assert counts[k] == library_count(part)


def test_truncation_is_the_longest_prefix_within_budget():
    for text in ("The house, and the garden  were\n\nold. ", "a <|endoftext|> b", "éé 日本 😀!"):
        for budget in range(0, library_count(text) + 1):
            best = max((text[:k] for k in range(len(text) + 1) if library_count(text[:k]) <= budget), key=len)
            assert prefixes.truncate(text, budget) == best


def test_token_counts_of_odd_rows(spark):
    rows = tokencount.count_tokens(odd_documents(spark, extra=True), BYTES).collect()
    assert len(rows) == len(ODD_TEXTS) + 4
    for r in rows:
        if r["doc_id"] is not None:
            text = ODD_TEXTS[r["doc_id"]] or ""
            assert r["n_bytes"] == len(text.encode()) and r["n_tokens"] == library_count(text) and r["over_limit"] == (r["n_tokens"] > 512)
    assert tokencount.count_tokens(no_documents(spark), BYTES).count() == 0


def gapless(rows, capacity):
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity


def test_packing_of_documents(spark):
    docs = table(spark, TABLES, "documents")
    rows = packing.pack_documents(docs).collect()
    gapless(rows, packing.CAPACITY)
    pieces = {}
    for r in docs.collect():
        ids = [*word_library.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for p in range(-(-len(ids) // 2048)):
            own = ids[2048 * p : 2048 * (p + 1)]
            pieces[r["doc_id"], p] = (2048 * p, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == pieces and len(rows) == len(pieces)
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert len({r["sequence_id"] for r in rows}) <= least + 1


def test_packing_of_odd_rows(spark):
    rows = packing.pack_documents(odd_documents(spark, extra=True)).collect()
    gapless(rows, packing.CAPACITY)
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows) and sum(r["doc_id"] is None for r in rows) == 2
    assert packing.pack_documents(no_documents(spark)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_use_every_piece_once_and_stay_near_the_bound(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([100, 100, 100, rng.randint(1, 400), rng.randint(1, 100)]) for _ in range(5000)]
    lengths = [min(x, 100) for x in lengths]
    histogram = Counter(lengths)
    plan = packing.plan_packing(dict(histogram), 100, unit=1, steps=200)
    used = Counter()
    for _, n, own, _room in plan.groups:
        assert sum(own) <= 100
        for x in own:
            used[x] += n
    assert used == histogram and plan.sequences <= 1.01 * sum(lengths) / 100 + 2


def test_pricing_is_the_best_knapsack():
    sizes, weights = np.array([2, 3, 5]), np.array([1.0, 1.7, 2.6])
    best = max(a + 1.7 * b + 2.6 * c for a in range(6) for b in range(4) for c in range(3) if 2 * a + 3 * b + 5 * c <= 11)
    copies = packing.best_configuration(sizes, weights, 11)
    assert copies @ sizes <= 11 and abs(copies @ weights - best) < 1e-9


def test_shards_are_balanced_and_slots_gapless(spark):
    rows = shards.op7_shard(spark, TABLES).collect()
    docs = {r["doc_id"]: r["text"] for r in table(spark, TABLES, "documents").collect()}
    loads, slots = Counter(), {}
    for r in rows:
        data = (docs[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 8 and r["text_crc32"] == zlib.crc32(data)
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == len(docs) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    odd = shards.shard(odd_documents(spark, extra=True)).collect()
    assert len(odd) == len(ODD_TEXTS) + 4 and len({(r["shard"], r["slot"]) for r in odd}) == len(odd)
    assert shards.shard(no_documents(spark)).count() == 0


def test_shards_stay_even_with_a_hot_id(spark):
    """A third of the rows under one id, and a third without any."""
    rng = random.Random(4)
    rows = [([7, None, k][k % 3], "x" * rng.randrange(400)) for k in range(6000)] + [(7, "same")] * 300
    made = shards.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    loads, slots = Counter(), {}
    for r in made:
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(made) == len(rows) and len(loads) == 24 and max(loads.values()) < 1.02 * sum(loads.values()) / 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bounded_loads_hold_and_movement_is_limited():
    rng = random.Random(2)
    cells = [(c, rng.randint(1, 100)) for c in range(0, 1 << 16, 5)]
    total = sum(n for _, n in cells)
    before, loads = shards.placement(cells, 24)
    after, more = shards.placement(cells, 25)
    assert max(loads) <= 1.002 * total / 24 and max(more) <= 1.002 * total / 25
    assert min(loads) >= 0.95 * total / 24
    moved = sum(n for c, n in cells if before[c] != after[c]) / total
    assert moved < 0.45  # hashing by remainder would move 24 of 25


def brute_base(rows):
    learned = [t for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 5 != 1]
    counts = Counter(w for t in learned for w in [*lm.words_of_text(t), lm.END])
    total = sum(counts.values())
    low = math.log10(total + 0.5 * (len(counts) + 1))
    return counts, total, lambda t: sum(math.log10(counts.get(w, 0) + 0.5) - low for w in [*lm.words_of_text(t), lm.END])


def test_scores_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 5)  # most words go by the join
    docs = odd_documents(spark, extra=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    counts, total, base = brute_base(rows)
    out = lm.score_texts(docs, BYTES).collect()
    assert len(out) == len(rows)
    want = Counter()
    for d, t in rows:
        words = [*lm.words_of_text(t), lm.END]
        want[d, d is None or zlib.crc32(str(d).encode()) % 5 == 1, len(words), sum(w in counts for w in words), total, round(base(t), 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    assert lm.score_texts(no_documents(spark), BYTES).count() == 0


def test_all_words_of_every_text_are_learned_from(spark):
    texts = [" ".join(f"w{k % 97} the" for k in range(3000)), "one", None]
    made = lm.count_joints(spark.createDataFrame([(t,) for t in texts], "text string"), BYTES).collect()
    sub, want, n_ids = lm.Subwords(BYTES), Counter(), 0
    for t in texts:
        ids = [[lm.END_ID], *sub.encode(lm.words_of_text(t)), [lm.END_ID]]
        want.update((v[-1], w[0]) for v, w in zip(ids, ids[1:]))
        n_ids += sum(map(len, ids)) - 1
    assert {(r["a"], r["b"]): r["n"] for r in made} == want
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    assert sum(ok.sum() for *_, ok in lm.training_windows(iter([batch]), BYTES)) == n_ids


def test_long_unseen_words_cost_what_their_ids_cost(spark):
    long = "".join(random.Random(5).choices("qxzjkvwy0123456789", k=600))
    rows = [(0, "the cat sat on the mat"), (101, long), (109, ""), (111, f"the {long}")]
    assert all(zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows[1:])
    out = {r["doc_id"]: r["score"] for r in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), BYTES).collect()}
    assert max(out[101], out[111]) < out[109] - 324


def test_model_is_a_distribution_and_training_helps():
    words = [w for t in ("the cat sat on the mat", "a dog ran to the house", "the dog sat") for w in t.encode().split()] * 4
    sub, seen = lm.Subwords(BYTES), Counter()
    for ids in sub.encode(words):
        seen[-1, ids[0]] += 1
        seen.update(zip(ids, ids[1:]))
        seen[ids[-1], -1] += 1
    a, b = map(np.array, zip(*seen))
    joints = Counter((v[-1], w[0]) for v, w in zip(sub.encode(words), sub.encode(words)[1:]))
    ja, jb = map(np.array, zip(*joints))
    model = lm.fit_pairs((a, b, np.array(list(seen.values()))), (ja, jb, np.array(list(joints.values()))), sub.size)
    assert np.allclose(model.out.sum(axis=0), 1, atol=1e-2) and np.allclose(model.share.sum(), 1, atol=1e-3)
    seq = np.array([i for e in sub.encode(words) for i in e], np.int32)
    x, pad, y, ok = lm.layout([seq] * 40)
    assert ok.sum() == 40 * len(seq)  # each id is scored once
    scorer = lambda: lm.Scorer(model, BYTES, {}, 10, 5)._id_logs([seq])[0].sum()
    first = scorer()
    lm.train_windows(model, x, pad, y, ok)
    assert scorer() > first


def test_context_is_causal():
    sub = lm.Subwords(BYTES)
    none = np.empty(0, np.int64)
    model = lm.fit_pairs((np.array([-1, 262, 464]), np.array([262, -1, 262]), np.array([5, 5, 2])), (none, none, none), sub.size)
    model.weights["v"] += np.random.default_rng(0).normal(0, 1, model.weights["v"].shape).astype(np.float32)
    scorer = lm.Scorer(model, BYTES, {}, 10, 5)
    ids = np.array([262, 464, 262, 50256] * 9, np.int32)
    other = ids.copy()
    other[20:] = 464
    assert np.allclose(scorer._id_logs([ids])[0][:20], scorer._id_logs([other])[0][:20])


def test_seen_words_do_not_add_up_to_more_than_a_context_holds():
    """A rough bound: the ratios below also swap the probability of the end behind each word."""
    texts = ["the cat sat", "the dog ran", "a cat ran", "the cat ran"] * 5
    words = [w for t in texts for w in [*lm.words_of_text(t), lm.END]]
    counts, sub, seen, joints = Counter(words), lm.Subwords(BYTES), Counter(), Counter()
    ids = {w: [lm.END_ID] if w == lm.END else sub.encode([w])[0] for w in counts}
    for w in words:
        seen[-1, ids[w][0]] += 1
        seen.update(zip(ids[w], ids[w][1:]))
        seen[ids[w][-1], -1] += 1
    joints.update((ids[v][-1], ids[w][0]) for v, w in zip(words, words[1:]))
    pairs, joint = ((*map(np.array, zip(*c)), np.array(list(c.values()))) for c in (seen, joints))
    model = lm.fit_pairs(pairs, joint, sub.size)
    scorer = lm.Scorer(model, BYTES, dict(counts), len(words), len(counts))
    start = scorer.score(["the cat"])[0][3] - scorer.score(["the"])[0][3]
    ends = [10 ** (scorer.score([f"the {w.decode()}"])[0][3] - scorer.score(["the"])[0][3]) for w in counts if w != lm.END]
    assert start < 0 and sum(ends) < 2


def test_caches_are_bounded_by_bytes():
    from tabula.llm.subwords import ENTRY_BYTES, LONGEST_KEPT, Recent

    made = []
    cache = Recent(lambda k: made.append(k) or k.encode(), 100 * ENTRY_BYTES)
    for k in range(5000):
        assert cache[f"word{k}"] == f"word{k}".encode()
        assert len(cache) + len(cache.old) <= 200
    assert cache["x" * (LONGEST_KEPT + 1)] == b"x" * (LONGEST_KEPT + 1) and "x" * (LONGEST_KEPT + 1) not in cache
    n = len(made)
    assert cache["word4999"] and len(made) == n  # what was used last is still there
    long = [("w%d" % k) * 700 for k in range(300)]
    before = cache.held
    assert [cache[w] for w in long] == [w.encode() for w in long] and cache.held == before


def test_training_reads_ids_without_lists_and_logs_once():
    """op3: a text's ids are joined bytes, and the posteriors' logarithms are taken once, not at every step."""
    import numpy as np

    from tabula.llm import lm

    spellings = lm.Spellings("byte_bpe_50k.json")
    words = spellings.words("Ab cd Ab")
    ids = [i for e in spellings.sub.encode([b"ab", b"cd", b"ab"]) for i in e] + [lm.END_ID]
    assert np.frombuffer(b"".join(words), "<i4").tolist() == ids and spellings.words(None) == [lm._END_IDS]
    size, rng = 60, np.random.default_rng(3)
    model = lm.Attention(size, rng.random((size, lm.LATENT)).astype(np.float32), rng.dirichlet(np.ones(lm.LATENT), size).astype(np.float32),
                         np.full(size, 1 / size, np.float32), np.ones(size))
    lm.END_ID, kept = 1, lm.END_ID
    try:
        windows = lm.layout([rng.integers(0, size, 200).astype(np.int32)])
    finally:
        lm.END_ID = kept
    lm.train_windows(model, *windows)
    assert model.logs is model.logs and np.array_equal(model.logs, np.log(model.prior)) and "logs" not in lm._copy(model).__dict__


def test_texts_are_spelled_once_and_read_as_ids(spark):
    """op3: joints and training read the staged ids of a text, without a vocabulary, and they are those of the text."""
    texts = ["The cat, the caté ran", "", None, "the " * 3000 + "zqxj'll end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    sub = lm.Subwords(BYTES)
    often = dict(zip([b"the", lm.END], lm.packed([sub.encode([b"the"])[0], [lm.END_ID]])))
    staged = lm.spell_texts(docs, BYTES, often)
    for row in staged.collect():
        words = [*lm.words_of_text(texts[row["doc_id"]]), lm.END]
        ids = np.frombuffer(row["ids"], "<i4")
        cut = np.split(lm.plain(ids), np.flatnonzero(ids < 0)[1:])
        assert [c.tolist() for c in cut] == [*sub.encode(words[:-1]), [lm.END_ID]]
        ranks = np.frombuffer(row["ranks"], "<i4")
        assert ranks.tolist() == [list(often).index(w) if w in often else -1 for w in words]
        assert row["others"] == [w for w in words if w not in often]
    counted = [{(r["a"], r["b"]): r["n"] for r in lm.count_joints(t, BYTES).collect()} for t in (staged, docs)]
    assert counted[0] == counted[1] and sum(counted[0].values()) == 3000 + 2 + 5 + 4
    columns = [pa.array([bytes(r["ids"]) for r in staged.orderBy("doc_id").collect()], pa.binary()), pa.array(texts)]
    ways = [list(lm.training_windows(iter([pa.RecordBatch.from_arrays([c], names=["c"])]), path)) for c, path in zip(columns, ("no such file", BYTES))]
    assert len(ways[0]) == len(ways[1]) and all(np.array_equal(a, b) for v, w in zip(*ways) for a, b in zip(v, w))


def test_training_steps_are_those_of_the_plain_formulas():
    """op3: Adam on the mixture's gradients, window by window and id by id."""
    size, rng, depth, block = 40, np.random.default_rng(5), lm.DEPTH, lm.BLOCK
    model = lm.Attention(size, rng.random((size, lm.LATENT)).astype(np.float32), rng.dirichlet(np.ones(lm.LATENT), size).astype(np.float32),
                         np.full(size, 1 / size, np.float32), np.ones(size))
    model.weights["v"] += rng.normal(0, 1, model.weights["v"].shape).astype(np.float32)
    n = 2 * lm.BATCH + 7  # the last batch is not full
    x, y = rng.integers(0, size, (n, 2 * block)), rng.integers(0, size, (n, block))
    pad, ok = np.zeros((n, 2 * block), bool), np.ones((n, block), bool)
    pad[::5, :block], pad[3::9, -2:], ok[3::9, -2:] = True, True, False
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    m, s = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step, at in enumerate(range(0, n, lm.BATCH), 1):
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        rows = range(at, min(n, at + lm.BATCH))
        for r, i in ((r, i) for r in rows for i in range(block) if ok[r, i]):
            j = np.flatnonzero(~pad[r, : block + i + 1])
            p, own = model.prior[x[r, j]].astype(np.float64), model.prior[x[r, block + i]].astype(np.float64)
            q, k, v = own @ w["q"] / math.sqrt(depth), p @ w["k"], p @ w["v"]
            a = np.exp(k @ q + w["r"][block + i - j])
            a /= a.sum()
            mix = np.exp(a @ v + w["c"]) * own
            mix /= mix.sum()
            joint = mix * model.out[y[r, i]]
            d = (mix - joint / joint.sum()) / ok[at : at + lm.BATCH].sum()
            da = a * (v @ d - a @ v @ d)
            grad["v"] += np.outer(a @ p, d)
            grad["c"] += d
            np.add.at(grad["r"], block + i - j, da)
            grad["q"] += np.outer(own, da @ k) / math.sqrt(depth)
            grad["k"] += np.outer(da @ p, q)
        for k, g in grad.items():
            m[k], s[k] = 0.9 * m[k] + 0.1 * g, 0.99 * s[k] + 0.01 * g * g
            w[k] -= lm.RATE * m[k] / (1 - 0.9**step) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-6)
    lm.train_windows(model, x, pad, y, ok)
    assert all(np.abs(model.weights[k] - w[k]).max() < 2e-3 for k in w)
