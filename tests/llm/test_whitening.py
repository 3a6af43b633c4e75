"""Whitening against numpy's eigenvectors, and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import whitening
from llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>, component int, whitened string"


def brute(vectors, components=8):
    """n, deviations, whitened, shares and eigenvalues from a plain covariance."""
    x = np.floor(1024 * np.array(vectors, float)).astype(int) + 100_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, found = np.linalg.eigh(covariance)
    values, found = values[::-1], found[:, ::-1]
    first = centred @ found[:, :components] / np.sqrt(values[:components])
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviations, first, values / np.trace(covariance)


def test_query_against_numpy(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    n, deviations, whitened, shares = brute([r.embedding for r in table])
    found = op11_whitening(spark, sf_dir).collect()
    assert len(found) == 8 * len(table)
    place = {r.vec_id: i for i, r in enumerate(table)}
    signs = {}
    for r in found:
        i, k = place[r.vec_id], r.component - 1
        assert (r.n, r.deviation) == (n, deviations[i])
        assert r.explained == pytest.approx(shares[k], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(whitened[i, k]), abs=1e-8)
        if abs(r.whitened) > 1e-3:
            signs.setdefault(k, set()).add(np.sign(r.whitened) == np.sign(whitened[i, k]))
        assert r.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values())


@pytest.mark.parametrize("size", [1, 2, 5, 8, 31])
def test_eigen(size):
    chance = np.random.default_rng(size)
    # Scales from 1 to 1e-10: small values keep their digits too.
    made = chance.normal(size=(3 * size, size)) * 10.0 ** -np.linspace(0, 10, size)
    values, vectors = whitening.eigen(made.T @ made)
    exact = np.linalg.svd(made, compute_uv=False) ** 2
    assert values[0] == pytest.approx(exact[0], rel=1e-12)
    assert vectors.T @ vectors == pytest.approx(np.eye(vectors.shape[1]), abs=1e-12)
    back = (vectors * values) @ vectors.T
    assert back == pytest.approx(made.T @ made, abs=1e-12 * exact[0])


def test_factor_is_triangular_and_ends_at_the_rank():
    chance = np.random.default_rng(3)
    made = chance.normal(size=(4, 9))
    scatter = made.T @ made
    factor, order = whitening.pivoted_cholesky(scatter)
    assert factor.shape == (9, 4)
    assert np.array_equal(factor, np.tril(factor))
    assert factor @ factor.T == pytest.approx(scatter[order][:, order], abs=1e-12)
    assert len(whitening.eigen(scatter)[0]) == 4
    assert len(whitening.eigen(np.zeros((3, 3)))[0]) == 0


@pytest.mark.parametrize("n", range(7))
def test_rounds_hold_each_pair_once(n):
    pairs = [tuple(sorted(x)) for p, q in whitening.rounds(n) for x in zip(p.tolist(), q.tolist(), strict=True)]
    assert sorted(pairs) == [(i, j) for i in range(n) for j in range(i + 1, n)]


def test_odd_vectors(spark):
    chance = np.random.default_rng(5)
    good = chance.normal(size=(40, 3)).tolist()
    odd = [None, [], [None, 1.0, 2.0], [float("nan"), 0.0, 1.0], [float("inf"), 0.0, 1.0], [1.0, 2.0], [3e38, 0.0, 0.0]]
    # A third of the rows are one vector under one id, another part has no id.
    rows = [(i, v) for i, v in enumerate(good)] + [(7, good[7])] * 30 + [(None, good[0])] * 5
    rows += [(1000 + i, v) for i, v in enumerate(odd)]
    df = spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA)
    model = whitening.fit(df)
    usable = [v for _, v in rows if v is not None and len(v) == 3 and all(x is not None and abs(x) < 9 for x in v)]
    n, _, whitened, shares = brute(np.array(usable, np.float32), 3)
    assert (model.n, len(usable)) == (n, 75)
    assert model.explained == pytest.approx(shares.tolist(), rel=1e-9)
    assert whitening.identity_error(df, model) < 1e-9
    found = df.select("vec_id", whitening.whitened(model).alias("w")).select("vec_id", "w.*").collect()
    assert len(found) == len(rows)
    assert sum(r.whitened is not None for r in found) == n
    assert all((r.deviation is None) == (r.whitened is None) for r in found)


def test_no_spread_and_no_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<double>")
    model = whitening.fit(same)
    assert (model.n, len(model.values), whitening.identity_error(same, model)) == (4, 0, None)
    assert [r.w.whitened for r in same.select(whitening.whitened(model).alias("w")).collect()] == [[]] * 4
    none = same.where(F.lit(False))
    assert whitening.fit(none).n == 0
    assert none.select(whitening.whitened(whitening.fit(none)).alias("w")).collect() == []


def test_query_without_rows(spark, tmp_path):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    none.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op11_whitening(spark, str(tmp_path)).collect() == []


def test_exact_numbers():
    big = np.array([[2**52, -(2**52)], [2**52, 5]], np.int64)
    assert whitening.column_sums(big).tolist() == [2**53, 5 - 2**52]
    assert whitening.column_sums(np.full((4096, 1), 2**52, np.int64)).tolist() == [2**64]
    small = np.array([[3, 4], [5, 9]], np.int64)
    assert whitening.squared_deviations(small, 2, [8, 13]) == [4 + 25, 4 + 25]
    assert whitening.squared_deviations(big, 2, [2**53, 5 - 2**52])[0] is None
