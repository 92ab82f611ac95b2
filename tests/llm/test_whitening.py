import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening
from tidemark.llm.queries import op12_whitening
from tidemark.llm.shared import read_table


def brute_force(vectors, k=8):
    x = np.floor(1024 * np.asarray(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    values, turned = values[::-1][:k], turned[:, ::-1][:, :k]
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return centred @ turned / np.sqrt(values), values / np.trace(centred.T @ centred / n), deviations


def check(rows, ids, vectors, k=8):
    whitened, explained, deviations = brute_force(vectors, k)
    k = whitened.shape[1]
    assert len(rows) == len(ids) * k
    table = np.zeros(whitened.shape)
    place = {i: p for p, i in enumerate(ids)}
    for r in rows:
        p = place[r.vec_id]
        table[p, r.component - 1] = r.whitened
        assert r.n == len(ids) and int(r.deviation) == deviations[p]
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-11)
        assert r.identity_error < 1e-10
    signs = np.sign((table * whitened).sum(axis=0))
    assert np.abs(table * signs - whitened).max() < 1e-8


def test_query_equals_dense_eigenvectors(spark, sf_dir):
    source = read_table(spark, sf_dir, "embeddings").collect()
    check(op12_whitening(spark, sf_dir).collect(), [r.vec_id for r in source], [r.embedding for r in source])


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(v) for v in rng.standard_normal(11) * (1 + i % 3)], 1, "x") for i in range(60)]
    bad = [
        (None, None, 1, "x"), (100, [], 1, "x"), (101, [None] * 11, 1, "x"), (102, [math.nan] * 11, 1, "x"),
        (103, [math.inf] + [0.0] * 10, 1, "x"), (104, [1e300] * 11, 1, "x"), (105, [1.0, 2.0], 1, "x"),
    ]
    frame = spark.createDataFrame(
        good + bad, "vec_id bigint, embedding array<double>, ids int, `a b-c.d` string"
    ).repartition(5)
    check(whitening.whiten(frame).collect(), [r[0] for r in good], [r[1] for r in good])
    assert whitening.whiten(frame.where("vec_id > 99 AND vec_id <> 105")).count() == 0
    assert whitening.whiten(frame.where("vec_id = 1")).count() == 0
    equal = frame.where("vec_id = 1").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(9))))
    assert whitening.whiten(equal).count() == 0


def test_fewer_dimensions_than_components_and_a_hot_vector(spark):
    rows = [(i, [float(i % 7), float(i % 5), float(i * i % 11)]) for i in range(40)]
    rows += [(100 + i, [1.0, 1.0, 1.0]) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(7)
    check(whitening.whiten(frame).collect(), [r[0] for r in rows], [r[1] for r in rows], 3)


def test_vectors_on_a_line_have_one_component(spark):
    frame = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(20)], "vec_id bigint, embedding array<double>")
    assert {r.component for r in whitening.whiten(frame).collect()} == {1}


def test_deviations_beyond_long_are_exact():
    x = np.array([[2**51, -(2**51)], [5, 7], [-(2**50), 3]], np.int64)
    n, sums = 3, [sum(int(v) for v in column) for column in x.T]
    centre = whitening.Centre(n, np.array([s // n for s in sums]), [s % n for s in sums])
    assert centre.deviations(x) == [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]


@pytest.mark.parametrize("d, spread", [(200, 0.9), (300, 0.999), (9, 0.5)])
def test_iteration_without_the_whole_space(d, spread):
    rng = np.random.default_rng(d)
    turned = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = 1e6 * spread ** np.arange(d)
    matrix = (turned * values) @ turned.T
    found = whitening.jacobi_davidson(lambda m: matrix @ m, d)
    assert found.residual < 1e-13
    assert np.allclose(found.values, values[:8], rtol=1e-12)
    assert np.abs(np.abs((found.vectors * turned[:, :8]).sum(axis=0)) - 1).max() < 1e-9


def test_inner_solver_reaches_the_solution():
    rng = np.random.default_rng(5)
    matrix = rng.standard_normal((12, 12))
    matrix = matrix + matrix.T
    ritz = np.linalg.qr(rng.standard_normal((12, 2)))[0]
    project = np.eye(12) - ritz @ ritz.T
    right = project @ rng.standard_normal((12, 2))
    thetas = np.array([0.3, -1.1])
    found = whitening.corrections(lambda m: matrix @ m, thetas, right, ritz, steps=12, tolerance=1e-14)
    for j in range(2):
        inside = project @ (matrix - thetas[j] * np.eye(12)) @ project
        assert np.allclose(inside @ found[:, j], -right[:, j], atol=1e-8)
