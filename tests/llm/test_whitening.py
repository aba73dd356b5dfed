"""Embedding whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from graphcluster.llm import registry, whitening

SCHEMA = "vec_id long, embedding array<double>"


def dense(vectors):
    """Integers, eigenvalues (falling) and unit eigenvectors (rows) of the covariance."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    c = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(c.T @ c / len(x))
    return x, values[::-1], vectors.T[::-1]


def check(rows, vectors, components):
    x, values, axes = dense(vectors)
    n, got = len(x), {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == n and all(sorted(g) == list(range(1, components + 1)) for g in got.values())
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, x.sum(axis=0))) for row in x]
    table = np.array([[got[i][k + 1].whitened for k in range(components)] for i in range(n)])
    want = (x - x.mean(axis=0)) @ axes[:components].T / np.sqrt(values[:components])
    for k in range(components):
        sign = np.sign(table[:, k] @ want[:, k])
        assert np.abs(sign * table[:, k] - want[:, k]).max() < 1e-8
        assert got[0][k + 1].explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
    assert [got[i][1].deviation for i in range(n)] == exact
    assert {r.n for r in rows} == {n}
    assert max(r.identity_error for r in rows) < 1e-9


def test_query_equals_dense_eigenvectors(spark, sf):
    rows = registry.queries()["op11_whitening"](spark, sf).collect()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    check(rows, [r.embedding for r in table], 32)


def test_uneven_spectrum_repeated_rows(spark):
    rng = np.random.default_rng(3)
    data = rng.standard_normal((60, 5)) * [100, 30, 3, 1, 0.2]
    data = np.concatenate([data, data[:20]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], SCHEMA)
    check(whitening.whiten(df).collect(), data, 5)


def test_repeated_eigenvalues(spark):
    cube = [[float(i >> k & 1) for k in range(3)] for i in range(8)]
    rows = whitening.whiten(spark.createDataFrame(list(enumerate(cube)), SCHEMA)).collect()
    assert len(rows) == 24 and max(r.identity_error for r in rows) < 1e-9
    assert all(r.explained == pytest.approx(1 / 3) for r in rows)


def test_directions_without_variance_have_no_component(spark):
    line = [(i, [float(i), 2.0 * i, 7.0]) for i in range(6)]
    rows = whitening.whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 6
    for same in ([], line[:1], [(i, [1.0, 2.0]) for i in range(4)], [(1, None)], [(1, [])]):
        made = whitening.whiten(spark.createDataFrame(same, SCHEMA))
        assert made.count() == 0 and made.columns == [
            "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_rows_that_do_not_count_and_clashing_columns(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0], "a"), (None, [3.0, 2.5], "b"), (3, None, "c"), (4, [1.0, None], "d"), (5, [nan, 1.0], "e"),
            (6, [inf, 1.0], "f"), (7, [], "g"), (8, [1.0, 2.0, 3.0], "h"), (9, [1.0, -2.0], "i")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, Whitened string")
    model = whitening.fit(df)
    made = whitening.transform(df, model)
    assert model.n == 3 and made.columns == ["vec_id", "embedding", "deviation", "whitened"]
    assert sorted(map(str, (r.vec_id for r in made.collect()))) == ["1", "9", "None"]
    with pytest.raises(Exception, match="too large"):
        whitening.fit(spark.createDataFrame([(1, [1e300, 0.0])], SCHEMA))


def test_deviation_beyond_64_bits_is_an_error():
    x = np.array([[1 << 33], [0]])
    with pytest.raises(OverflowError):
        whitening.deviations(x, 2, x.sum(axis=0))
    near = np.array([[3_000_000_000], [0]])
    assert whitening.deviations(near, 1, np.array([0])).tolist() == [9_000_000_000_000_000_000, 0]
