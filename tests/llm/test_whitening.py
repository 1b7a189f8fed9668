from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from touchline.llm import catalog, whitening
from touchline.llm.common import read


def brute(vectors, k=32):
    """{(vec_id, component): (deviation, whitened)} by numpy alone, explained by component."""
    rows = [(i, v) for i, v in vectors if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for _, v in rows], dtype=object)
    n, s = len(rows), x.sum(axis=0)
    y = n * x - s
    c = y.astype(float) / n
    values, u = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-values)[:k]
    w = c @ u[:, order] / np.sqrt(values[order])
    return rows, [int(sum(e * e for e in r)) for r in y], w, values[order] / values.sum()


def close(out, vectors, k=32):
    rows, dev, w, explained = brute(vectors, k)
    k = w.shape[1]
    got = defaultdict(dict)
    for r in out.collect():
        got[r.vec_id][r.component] = r
    assert len(got) == len(rows) and all(sorted(g) == list(range(1, k + 1)) for g in got.values())
    mine = np.array([[got[i][j + 1].whitened for j in range(k)] for i, _ in rows])
    sign = np.sign((mine * w).sum(axis=0))
    assert np.abs(mine * sign - w).max() < 1e-7
    for (i, _), d in zip(rows, dev):
        for j, r in got[i].items():
            assert r.deviation == d and r.n == len(rows)
            assert abs(r.explained / explained[j - 1] - 1) < 1e-9 and 0 <= r.identity_error < 1e-9


def test_whole_table(spark, sf_dir):
    vectors = [(r.vec_id, r.embedding) for r in read(spark, sf_dir, "embeddings").collect()]
    close(catalog.op13_whitening(spark, sf_dir), vectors)


def test_unusable_vectors_and_clashing_names(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in rng.normal(size=6) * [9, 5, 3, 1, 0.5, 0.2]]) for i in range(300)]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [math.nan] + [0.0] * 5), (903, [math.inf] + [0.0] * 5), (904, [-math.inf] + [0.0] * 5), (905, [])]
    rows = [(i, v, "x", 1, 2.0) for i, v in [*good, *bad]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string, component int, whitened double")
    close(whitening.whiten(df.repartition(5)), [*good, *bad])


def test_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(6)
    rows = [(i // 2, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(40, 3)))] + [(None, [0.5, 0.25, -1.0])] * 2
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert Counter(r.vec_id for r in out) == {**{i: 6 for i in range(20)}, None: 6}
    assert out[0].n == 42 and out[0].identity_error < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [None])]])
def test_nothing_usable(spark, rows):
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert out.collect() == [] and out.schema.simpleString() == "struct<" + whitening.SCHEMA.replace(" long", ":bigint").replace(" int", ":int").replace(" double", ":double").replace(", ", ",") + ">"


def test_constant_directions_are_null(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(a), float(b), 3.0, float(a + b)]) for i, (a, b) in enumerate(rng.integers(-9, 9, size=(50, 2)))]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in out if r.whitened is None} == {3, 4} and out[0].identity_error < 1e-9
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>")).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(0, None, None, None)] * 6


def test_deviation_beyond_64_bits(spark):
    rows = [(i, [1e9 * (-1) ** i, 1e6 * i]) for i in range(4)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in out} == {None} and all(abs(r.whitened) < 3 for r in out)


def spectrum(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return (q * values) @ q.T, q


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 40),
    np.concatenate([1 + 1e-9 * np.arange(5), [3, 3 + 1e-7, 7]]),  # clusters closer than float32 tells apart
    np.concatenate([np.full(6, 2.0), [1.0, 5.0]]),  # equal eigenvalues
    np.concatenate([10.0 ** -np.arange(10)]),
    1000 + np.arange(30) * 1e-6,
])
def test_refinement_reaches_double_precision(values):
    a, _ = spectrum(values)
    a = (a + a.T) / 2
    e, x = whitening.eigenvectors(a)
    size = np.abs(values).max()
    assert np.abs(e - np.sort(values)[::-1]).max() < 1e-13 * size
    assert np.abs(x.T @ x - np.eye(len(x))).max() < 1e-13
    assert np.abs(a @ x - x * e).max() < 2e-14 * size * len(x)


def test_float32_alone_is_worse():
    a, _ = spectrum(np.concatenate([1 + 1e-9 * np.arange(5), [3.0, 3 + 1e-7, 7]]))
    _, first = np.linalg.eigh(a.astype(np.float32))
    off = first.T.astype(float) @ a @ first
    assert np.abs(off - np.diag(np.diag(off))).max() > 1e-9
