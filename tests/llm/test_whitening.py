"""Spectrum slicing against numpy's solver; the query against plain integers."""

import math

import numpy as np
import pytest

from tabula.llm import spectrum, whitening


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


SPECTRA = {
    "falling": [2.0**-k for k in range(20)],
    "ties": [5.0] * 4 + [3.0] * 3 + [1.0] * 5,
    "close": [1 + 1e-9 * k for k in range(6)] + [1e-3, 1e-6],
    "very close": [1 + 1e-14 * k for k in range(5)] + [0.5, 0.5 + 1e-12],
    "rank one": [7.0] + [0.0] * 9,
    "mixed signs": [-3.0, -1.0, 0.0, 1e-5, 2.0, 2.0],
    "one": [4.0],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_pairs(name):
    a = symmetric(SPECTRA[name])
    a = (a + a.T) / 2
    for wanted in (1, 3, len(a), len(a) + 5):
        e, u = spectrum.leading(a, wanted)
        k = min(wanted, len(a))
        assert np.allclose(e, sorted(SPECTRA[name], reverse=True)[:k], rtol=0, atol=1e-12 * 7)
        assert np.abs(u.T @ u - np.eye(k)).max() < 1e-12
        assert np.abs(a @ u - u * e).max() < 1e-12 * 7


def test_counts_are_the_inertia():
    for seed in range(5):
        a = np.random.default_rng(seed).integers(-3, 4, (17, 17)).astype(float)
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for s in [*((values[1:] + values[:-1]) / 2), -1000.0, 1000.0]:
            assert spectrum.count_above(a, s) == (values > s).sum()
    assert spectrum.count_above(np.zeros((4, 4)), 0.0) == 0
    assert spectrum.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_wrong_number_is_not_certified():
    a = np.diag([3.0, 2.0, 1.0])
    with pytest.raises(ArithmeticError):
        spectrum.certify(a, np.array([3.0, 1.0]), np.eye(3)[:, [0, 2]], 3.0)


def plain(rows):
    """The contract's columns in Python integers and numpy's solver."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in usable], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = np.array([[float(n * c - t) / n for c, t in zip(r, s)] for r in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(32, int((e > 1e-9 * e[0]).sum()))
    dev = [int(sum((n * c - t) ** 2 for c, t in zip(r, s))) for r in x]
    return [i for i, _ in usable], n, dev, centred @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    ids, n, dev, z, share = plain(rows)
    got = whitening.digest(df, whitening.fit(df)).collect()
    assert len(got) == len(ids) * z.shape[1]
    assert {(r["n"], r["identity_error"] < 1e-9) for r in got} == {(n, True)}
    for k in range(z.shape[1]):
        mine = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["deviation"], r["whitened"]) for r in got if r["component"] == k + 1)
        want = sorted((-1 if i is None else i, d, w) for i, d, w in zip(ids, dev, z[:, k]))
        sign = np.sign(sum(a[2] * b[2] for a, b in zip(mine, want)))
        want = [(i, d, sign * w) for i, d, w in want]
        assert [m[:2] for m in mine] == [w[:2] for w in want]
        assert np.allclose([m[2] for m in mine], [w[2] for w in want], rtol=0, atol=1e-8)
        assert all(abs(r["explained"] - share[k]) < 1e-10 for r in got if r["component"] == k + 1)


def test_against_plain_integers(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((300, 40)) * np.linspace(0.2, 9, 40)
    rows = [(k, [float(c) for c in r]) for k, r in enumerate(v)]
    rows += [(1000, None), (1001, []), (1002, [None] + [1.0] * 39), (1003, [float("nan")] + [0.0] * 39),
             (1004, [float("-inf")] * 40), (None, [0.5] * 40), (5, [0.5] * 40), (5, [0.5] * 40)]
    check(spark, rows)


def test_few_dimensions_and_copies(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(c) for c in r]) for k, r in enumerate(rng.standard_normal((50, 3)) * 5)]
    check(spark, rows + [(100 + k, [1.0, 2.0, 3.0]) for k in range(60)])


def test_flat_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(5)]):
        df = spark.createDataFrame(rows, schema)
        got = whitening.digest(df, whitening.fit(df))
        assert got.count() == 0
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_lengths_extremes_and_clashing_columns(spark):
    rows = [(k, [float(k), float(k * k % 7)], "x", 1.0) for k in range(20)] + [(90, [1.0], "y", 2.0), (91, [1.0] * 3, "z", 3.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, size string, whitened double")
    model = whitening.fit(df)
    out = whitening.whitened(df, model)
    assert out.columns == ["vec_id", "embedding", "size", "deviation", "whitened"]
    assert out.count() == 20 and model.n == 20 and len(model.values) == 2
    huge = spark.createDataFrame([(1, [1e16, 0.0]), (2, [-1e16, 1.0]), (3, [1e300, 1.0])], "vec_id long, embedding array<double>")
    got = whitening.digest(huge, whitening.fit(huge)).collect()
    assert {r["n"] for r in got} == {2} and {r["deviation"] for r in got} == {None}
