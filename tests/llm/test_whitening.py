import math

import numpy as np
import pytest

from snapdeck.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, x string, id string"


def brute(rows):
    """{(id, component): values} by exact sums and numpy's eigenvalues."""
    ok = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in ok})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    c = np.array(fit, float) - np.array([t / n for t in s])
    cov = c.T @ c / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:4], q.T[::-1][:4]
    out = []
    for i, x in ok:
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s))
        for k in range(len(e)):
            if e[k] > 1e-9 * e[0]:
                out.append((i, k + 1, n, dev, float((np.array(x) - np.array(s) / n) @ q[k] / math.sqrt(e[k])), e[k] / np.trace(cov)))
    return out


def same(df, rows):
    got, want = df.collect(), brute(rows)
    key = lambda r: (str(r[0]), r[1], r[3])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    signs = {}
    for g, w in zip(got, want):
        if abs(w[4]) > 1e-6:
            assert signs.setdefault(g[1], np.sign(g[4] * w[4])) == np.sign(g[4] * w[4])
        assert abs(abs(g[4]) - abs(w[4])) < 1e-7
        assert abs(g[5] - w[5]) < 1e-10 and g[6] < 1e-9
    return got


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = same(queries.QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.001"), rows)
    assert len(got) == 4 * len(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.25, 1.0]),
        (2, [0.5, -0.25, 1.0]),
        (2, [0.1, -0.0, 3.0]),
        (2, [0.1, -0.0, 3.0]),
        (None, [7.5, 2.0, -1.0]),
        (3, None),
        (4, [1.0, None, 2.0]),
        (5, [1.0, nan, 2.0]),
        (6, [1.0, inf, 2.0]),
        (7, [-4.0, 1.0, 0.125]),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    same(whitening.whiten(df), rows)
    assert whitening.whiten(df.filter("vec_id IN (1, 3, 4)")).collect() == []  # one vector: no variance
    assert whitening.whiten(df.filter("false")).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [], "x", "y")], SCHEMA)).collect() == []


def test_vectors_of_two_lengths_are_two_spaces(spark):
    two = [(1, [1.0, 2.0]), (2, [3.0, -1.0]), (3, [0.5, 0.25])]
    three = [(4, [1.0, 2.0, 0.0]), (5, [3.0, -1.0, 1.0]), (6, [0.5, 0.25, 9.0]), (7, [1.5, 0.25, 2.0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in two + three], SCHEMA)
    out = whitening.whiten(df)
    same(out.filter("vec_id < 4"), two)
    same(out.filter("vec_id > 3"), three)


def test_long_vectors_and_large_numbers(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(700).tolist()) for i in range(30)]
    same(whitening.whiten(spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, x string, id string")), rows)
    dev = whitening.deviations(np.array([[1 << 40, 0], [0, 3]]), 2, [1 << 40, 3]).to_pylist()
    assert dev == [None, None]  # (2^40)^2 is beyond a long
    assert whitening.deviations(np.array([[5, 0], [0, 3]]), 2, [5, 3]).to_pylist() == [34, 34]


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
def test_eigenpairs(d):
    rng = np.random.default_rng(d)
    spectra = [
        rng.uniform(0, 1, d),
        np.r_[np.full(min(3, d), 5.0), rng.uniform(0, 1, d)][:d],  # equal ones
        5 + 1e-13 * np.arange(d),  # a cluster
        np.r_[1e12, np.geomspace(1, 1e-9, d)][:d],
    ]
    for values in spectra:
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        v = (q * values) @ q.T
        v = (v + v.T) / 2
        got, vectors = whitening.leading_eigenpairs(v, 4)
        top = np.max(np.abs(values))
        assert np.allclose(got, np.sort(np.linalg.eigvalsh(v))[::-1][:4], rtol=0, atol=1e-13 * top)
        assert np.max(np.abs(vectors @ vectors.T - np.eye(len(got)))) < 1e-12
        assert np.max(np.abs(v @ vectors.T - vectors.T * got)) < 1e-13 * top * d
    for v in (np.diag(np.arange(d, 0, -1.0)), np.eye(d), np.zeros((d, d))):
        got, vectors = whitening.leading_eigenpairs(v, 4)
        assert np.allclose(v @ vectors.T, vectors.T * got, atol=1e-13 * d)
        assert np.allclose(vectors @ vectors.T, np.eye(len(got)), atol=1e-12)
