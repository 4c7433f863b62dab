"""Whitening against dense solvers and exact sums."""

import math
import random

import numpy as np
import pytest

from cascata.llm import common, queries, whitening

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def spectrum(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1.0, 41), np.geomspace(1e-6, 1e9, 64), [5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 1], [7, 7, 7, 1, 1, 1, 1, 1, 1, 1e-3],
        [3.0], [1e9, 1, 1 - 1e-9, 0.5, 0, 0], [0, 0, 0], np.r_[100 + 1e-7 * np.arange(20), np.ones(20)], [2, 0, 0, 0],
    ],
)
def test_leading_components(values):
    rng = np.random.default_rng(len(values))
    matrix = spectrum(rng, values)
    matrix = (matrix + matrix.T) / 2
    got, vectors = whitening.leading(matrix, 8)
    want = np.sort(np.array(values, float))[::-1]
    want = want[want > 1e-10 * want[0]][:8] if want[0] else want[:0]
    assert len(got) == len(want)
    if len(want):
        norm = want[0]
        assert np.allclose(got, want, atol=1e-11 * norm)
        assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-12
        assert np.abs(matrix @ vectors - vectors * got).max() < 1e-11 * norm


def test_inertia_counts():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 30):
        for _ in range(20):
            a = rng.integers(-3, 4, (n, n))
            a = (a + a.T) / 2.0
            cut = rng.uniform(-4, 4)
            assert whitening.above(a, cut) == (np.linalg.eigvalsh(a) > cut).sum()
    assert whitening.above(np.array([[0.0, 1], [1, 0]]), 0) == 1


def by_hand(vectors):
    """Sums and deviations by whole numbers, the rest by a dense solver."""
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    centred = np.array(x, float) - np.array(sums) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, values[::-1], basis[:, ::-1]


def compare(got, ids, vectors, most=8):
    deviation, centred, values, basis = by_hand(vectors)
    k = min(most, int((values > 1e-10 * values[0]).sum()))
    assert len(got) == k * len(ids)
    white = centred @ basis[:, :k] / np.sqrt(values[:k])
    table = got.set_index(["vec_id", "component"]).sort_index()
    for c in range(k):
        mine = table.loc[[(i, c + 1) for i in ids]]
        assert mine.deviation.tolist() == deviation and set(mine.n) == {len(ids)}
        sign = np.sign(mine.whitened.to_numpy() @ white[:, c])
        assert np.abs(sign * mine.whitened.to_numpy() - white[:, c]).max() < 1e-7
        assert np.allclose(mine.explained, values[c] / values.sum(), rtol=1e-8)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_rows(spark):
    rng = np.random.default_rng(4)
    good = (rng.standard_normal((300, 12)) * np.geomspace(4, 0.2, 12)).astype(np.float32).astype(float).tolist()
    bad = [None, [], [None] * 12, good[0][:11] + [None], good[0][:11] + [float("nan")], good[0][:11] + [float("inf")], [1.0] * 3]
    rows = [(i, v, "x", 1) for i, v in enumerate(good)] + [(1000 + i, v, "y", 2) for i, v in enumerate(bad)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string, n int").repartition(5)
    compare(whitening.whiten(frame).toPandas(), list(range(300)), good)


def test_few_and_equal_rows(spark):
    kind = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(k, [0.5, 0.25, 1.0]) for k in range(5)], [(1, None)], [(None, [])]):
        out = whitening.whiten(spark.createDataFrame(rows, kind))
        assert out.count() == 0 and out.columns[:2] == ["vec_id", "component"]
    rows = [(None, [0.0, 1.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0]), (4, [1e30, 1.0])]
    out = whitening.whiten(spark.createDataFrame(rows, kind)).collect()
    assert len(out) == 4 and {r.n for r in out} == {4} and {r.component for r in out} == {1}
    assert sum(r.deviation is None for r in out) == 4


def test_query_over_whole_table(spark):
    rows = queries.table(spark, SF, "embeddings").collect()
    rows = [r for r in rows if r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()]
    got = queries.QUERIES["op13_whitening"](spark, SF).toPandas()
    compare(got, [r.vec_id for r in rows], [r.embedding for r in rows])
