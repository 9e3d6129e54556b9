"""Whitening against numpy's eigenvalues and exact sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import queries, whitening


def matrices():
    draw = np.random.default_rng(0)
    for t in range(60):
        d = int(draw.integers(1, 40))
        values = (
            draw.random(d) * 100, 10.0 ** draw.uniform(-6, 3, d), draw.integers(0, 3, d).astype(float),
            1 + 1e-9 * draw.random(d), np.r_[1e4, np.zeros(d - 1)],
        )[t % 5]
        basis = np.linalg.qr(draw.standard_normal((d, d)))[0]
        matrix = basis @ np.diag(values) @ basis.T
        yield (matrix + matrix.T) / 2, int(draw.integers(1, 40))


def test_leading_eigenvalues():
    for matrix, most in matrices():
        values, vectors = whitening.leading(matrix, most)
        norm = np.linalg.norm(matrix)
        want = np.sort(np.linalg.eigvalsh(matrix))[::-1][:most]
        want = want[want > 1e-11 * norm]
        assert len(values) == len(want)
        if len(values):
            assert abs(values - want).max() < 2e-11 * norm
            assert abs(matrix @ vectors - vectors * values).max() < 2e-11 * norm
            assert abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert len(whitening.leading(np.zeros((3, 3)), 2)[0]) == 0


def test_inertia():
    draw = np.random.default_rng(1)
    for _ in range(300):
        d = int(draw.integers(1, 15))
        matrix = draw.integers(-2, 3, (d, d)).astype(float)  # many zero pivots
        matrix = matrix + matrix.T
        values = np.linalg.eigvalsh(matrix)
        for shift in (0.37, -1.21, 5.03):
            assert whitening.above(matrix, shift) == (values > shift).sum()
    assert whitening.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def rows_of(spark, vectors):
    rows = [(i if i % 9 else None, v, 1.0, [2.0]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, deviation double, whitened array<double>").repartition(5)


def whitened(spark, vectors, most=32):
    docs = rows_of(spark, vectors)
    fixed = docs.withColumn("vector", whitening.fixed_point(docs, "embedding"))
    model = whitening.fit(fixed, most)
    return model, whitening.whiten(fixed, model).collect()


def test_whitening_and_rows_left_out(spark):
    draw = np.random.default_rng(2)
    good = [[float(np.float32(c)) for c in draw.standard_normal(6) * [1, 2, 3, 4, 5, 60]] for _ in range(400)]
    good += [good[0]] * 300  # repeated rows
    bad = [None, [], [1.0] * 5, [1.0] * 7, [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [float("-inf")] + [0.0] * 5, [1e20] * 6]
    model, rows = whitened(spark, bad + good, most=4)
    x = np.floor(64 * np.array(good)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    y = x - sums / n
    values, basis = np.linalg.eigh(y.T @ y / n)
    want = y @ basis[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
    assert model.n == n and len(rows) == n and np.allclose(model.values, values[::-1][:4], rtol=1e-12)
    ids = [r["vec_id"] for r in rows]
    assert sorted(map(str, ids)) == sorted(str(i if i % 9 else None) for i in range(len(bad), len(bad) + n))
    sign = np.sign((model.vectors * basis[:, ::-1][:, :4]).sum(axis=0))
    got = sorted((int(r["deviation"]), *np.round(np.array(r["whitened"]) * sign, 8)) for r in rows)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)) for v in x]
    for a, b in zip(got, sorted((e, *np.round(w, 8)) for e, w in zip(exact, want))):
        assert a[0] == b[0] and np.allclose(a[1:], b[1:], atol=1e-7)
    w = np.array([r["whitened"] for r in rows])
    assert model.identity_error < 1e-12 and abs(w.T @ w / n - np.eye(4)).max() < 1e-12


def test_large_entries_stay_exact(spark):
    vectors = [[3e9, 1.0], [-3e9, 2.0], [1e9, 7.0]]
    model, rows = whitened(spark, vectors)
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    assert sorted(int(r["deviation"]) for r in rows) == sorted(sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for v in x)
    assert len(model.values) == 1  # the second direction is below the arithmetic's reach


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_no_variance(spark, vectors):
    model, rows = whitened(spark, vectors)
    assert len(model.values) == 0
    assert [(int(r["deviation"]), r["whitened"]) for r in rows] == [(0, [])] * sum(bool(v) for v in vectors)


def test_query_on_odd_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "none/embeddings.parquet"))
    assert queries.op13_spectrum_whitening(spark, str(tmp_path / "none")).count() == 0
    rows = rows_of(spark, [[1.0, 2.0], [2.0, 1.0], [5.0, 5.0], None]).withColumn("label", F.lit(1))
    rows.write.parquet(str(tmp_path / "some/embeddings.parquet"))
    got = queries.op13_spectrum_whitening(spark, str(tmp_path / "some")).collect()
    assert len(got) == 6 and {r["component"] for r in got} == {1, 2} and abs(sum({r["explained"] for r in got}) - 1) < 1e-12
