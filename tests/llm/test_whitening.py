"""Whitening against dense eigenvectors."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import whitening
from barloom.llm.common import read

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<float>"


def dense(vectors):
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums).astype(float) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return n, deviation, centred, values[::-1], basis[:, ::-1]


def check(rows, vectors, components=8, digits=1e-9):
    """rows: vec_id to vector of the fit list."""
    n, deviation, centred, values, basis = dense(list(vectors.values()))
    found = {(r["vec_id"], r["component"]): r for r in rows}
    k = min(components, len(values))
    assert len(found) == len(rows) == len(vectors) * k
    for j in range(k):
        want = centred @ basis[:, j] / np.sqrt(values[j])
        got = np.array([found[i, j + 1]["whitened"] for i in vectors])
        assert np.abs(got * np.sign(got @ want) - want).max() < digits * max(1, np.abs(want).max())
    for i, d in zip(vectors, deviation, strict=True):
        for j in range(k):
            r = found[i, j + 1]
            assert (r["n"], r["deviation"]) == (n, d)
            assert r["explained"] == pytest.approx(values[j] / values.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-10


def test_query_against_dense_eigenvectors(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in read(spark, SF_DIR, "embeddings").collect()}
    check(whitening.op11_chebyshev(spark, SF_DIR).collect(), vectors)


def random_vectors(n, size, seed=1):
    rng = np.random.default_rng(seed)
    return {i: [float(np.float32(c)) for c in v] for i, v in enumerate(rng.standard_normal((n, size)) * rng.uniform(0.1, 2, size))}


@pytest.mark.parametrize(("n", "size"), [(40, 2), (200, 12), (300, 40), (20, 50)])
def test_shapes(spark, n, size):
    vectors = random_vectors(n, size)
    rows = whitening.whitened(spark.createDataFrame(list(vectors.items()), SCHEMA).repartition(3), components=min(8, n - 1)).collect()
    check(rows, vectors, components=min(8, n - 1))


def test_rows_without_a_usable_vector(spark):
    vectors = random_vectors(30, 4)
    odd = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 2.0, 3.0], [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], [0.0, 0.0, 1e30, 0.0], [None] * 4]
    rows = [*vectors.items(), *((1000 + i, v) for i, v in enumerate(odd))]
    check(whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect(), vectors)


def test_repeated_rows_null_ids_and_ties(spark):
    vectors = random_vectors(25, 3)
    rows = [*vectors.items(), *vectors.items(), (None, [0.0, 0.0, 0.0])]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    assert len(got) == 51 * 3 and {r["n"] for r in got} == {51} and sum(r["vec_id"] is None for r in got) == 3
    # a cross: both directions have one eigenvalue, any pair of axes will do
    cross = [(i, [float(a), float(b)]) for i, (a, b) in enumerate([(1, 0), (-1, 0), (0, 1), (0, -1)])]
    got = whitening.whitened(spark.createDataFrame(cross, SCHEMA)).collect()
    assert [r["explained"] for r in got] == pytest.approx([0.5] * 8) and all(r["identity_error"] < 1e-12 for r in got)


def test_missing_rank(spark):
    """Components of a zero eigenvalue are left out; equal vectors have none."""
    line = [(i, [float(i), 2.0 * i, -1.0 * i]) for i in range(9)]
    got = whitening.whitened(spark.createDataFrame(line, SCHEMA)).collect()
    assert {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1)
    assert whitening.whitened(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], SCHEMA)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)).collect() == []


def test_an_empty_table(spark):
    got = whitening.whitened(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns[0] == "vec_id"


def test_clashing_columns(spark):
    vectors = random_vectors(20, 3)
    docs = spark.createDataFrame(list(vectors.items()), SCHEMA)
    own = docs.withColumns({c: F.lit(f"own {c}") for c in ("component", "n", "deviation", "whitened", "cell", "width", "block", "label")})
    got = whitening.whitened(own).drop("cell", "width", "block").collect()
    assert {r["label"] for r in got} == {"own label"}
    check(got, vectors)


def test_deviations_beyond_64_bits(spark):
    vectors = {i: [float(c) * 1e3 for c in v] for i, v in random_vectors(4000, 2).items()}
    schema = SCHEMA.replace("float", "double")
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitened(spark.createDataFrame(list(vectors.items()), schema)).collect()}
    want = dict(zip(vectors, dense(list(vectors.values()))[1], strict=True))
    assert all(got[i] == (want[i] if want[i] < 1 << 63 else None) for i in want)
    assert any(v is None for v in got.values()) and any(v is not None for v in got.values())


def test_distances_are_exact_beyond_64_bits():
    x = np.array([[1 << 52, -(1 << 52)], [3, 5]])
    n, sums = 10**6, np.array([7, -9], object)
    assert whitening._distance(x, sums, n).tolist() == [[(1 << 52) * n - 7, -(1 << 52) * n + 9], [3 * n - 7, 5 * n + 9]]


def test_the_filter_is_a_chebyshev_polynomial():
    values, cut, top, degree = np.array([0.0, 1.0, 2.0, 3.0, 7.0, 9.0]), 3.0, 9.0, 6
    got = np.diag(whitening.chebyshev(lambda q: values[:, None] * q, np.eye(6), degree, cut, top))
    polynomial = np.polynomial.Chebyshev.basis(degree)
    want = polynomial((values - cut / 2) / (cut / 2)) / polynomial((top - cut / 2) / (cut / 2))
    assert got == pytest.approx(want, rel=1e-12)
    assert np.abs(got[:4]).max() < 1e-3 and got[5] == pytest.approx(1)


def test_what_does_not_settle_is_an_error(monkeypatch):
    monkeypatch.setattr(whitening, "MAX_FILTERS", 2)
    v = np.diag(np.linspace(1, 1.001, 200))
    with pytest.raises(whitening.NotCertified):
        whitening.leading(lambda q: v @ q, 200, 8)
