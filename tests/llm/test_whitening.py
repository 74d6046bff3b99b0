import math

import numpy as np
import pytest

from emporion.llm import whitening
from emporion.llm.common import ship
from emporion.llm.queries import op11_chebyshev_whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n string, component string"


def vectors(spark, x, first=0, parts=3):
    ship(spark)
    return spark.createDataFrame([(first + i, None if v is None else [None if c is None else float(c) for c in v], 1, "n", "c") for i, v in enumerate(x)], SCHEMA).repartition(parts)


def dense(x):
    """Whole numbers, covariance's eigenvalues and vectors by numpy."""
    t = np.floor(64 * x.astype(np.float32).astype(np.float64))
    dev = t - t.mean(axis=0)
    value, vector = np.linalg.eigh(dev.T @ dev / len(x))
    return t.astype(np.int64) + 1_000_000, value[::-1], vector[:, ::-1]


@pytest.mark.parametrize("scale", ["flat", "falling", "spiked"])
def test_components_equal_the_dense_ones(spark, scale):
    rng = np.random.default_rng(3)
    spread = {"flat": np.ones(70), "falling": 0.9 ** np.arange(70) * 5, "spiked": np.r_[300, 40, np.linspace(3, 1, 68)]}[scale]
    x = rng.standard_normal((900, 70)) * spread @ np.linalg.qr(rng.standard_normal((70, 70)))[0]
    blocks = whitening.stored(vectors(spark, x), "embedding", "vec_id")
    model = whitening.fit(blocks)
    _, value, vector = dense(x)
    assert model.n == 900 and model.identity_error < 1e-12
    np.testing.assert_allclose(model.values, value[:32], rtol=1e-12)
    assert model.trace == pytest.approx(value.sum(), rel=1e-13)
    for i in range(32):
        assert min(np.abs(model.basis[:, i] - s * vector[:, i]).max() for s in (1, -1)) < 1e-9
    # the covariance is never formed, and the filter does its work
    assert 10 < model.passes < 200


def test_rows_of_the_query(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((60, 40)) + 5
    odd = [None, [], [1.0] * 39, [None] + [1.0] * 39, [math.nan] + [1.0] * 39, [math.inf] + [1.0] * 39, [1e30] + [1.0] * 39]
    df = vectors(spark, x).unionByName(vectors(spark, odd, 100)).unionByName(vectors(spark, [x[0]], 0))
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = op11_chebyshev_whitening(spark, str(tmp_path)).collect()
    x = np.concatenate([x, x[:1]])
    whole, value, vector = dense(x)
    n, sums = len(x), whole.sum(axis=0)
    assert len(rows) == 61 * 32 and {r.vec_id for r in rows} == set(range(60))
    signs = {}
    for r in rows:
        at = r.vec_id
        want = ((whole[at] - sums / n) @ vector[:, r.component - 1]) / math.sqrt(value[r.component - 1])
        if abs(want) > 1e-6:
            sign = signs.setdefault(r.component, np.sign(want * r.whitened))
            assert r.whitened == pytest.approx(sign * want, abs=1e-9)
        assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(whole[at], sums))
        assert r.explained == pytest.approx(value[r.component - 1] / value.sum(), rel=1e-10) and r.identity_error < 1e-12


def test_few_dimensions_ties_and_directions_without_variance(spark):
    square = [[a, b, 7.0, a] for a in (-1.0, 1.0) for b in (-1.0, 1.0)]
    model = whitening.fit(whitening.stored(vectors(spark, square), "embedding", "vec_id"))
    assert np.allclose(model.values, [2 * 64 ** 2, 64 ** 2]) and model.identity_error < 1e-12
    ties = np.concatenate([np.eye(40), -np.eye(40)]) * 3
    model = whitening.fit(whitening.stored(vectors(spark, ties), "embedding", "vec_id"))
    assert len(model.values) == 32 and np.allclose(model.values, model.values[0]) and model.identity_error < 1e-12
    assert np.allclose(model.basis.T @ model.basis, np.eye(32), atol=1e-13)


@pytest.mark.parametrize("x", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, []]])
def test_nothing_to_fit(spark, x):
    blocks = whitening.stored(vectors(spark, x, parts=1), "embedding", "vec_id")
    model = whitening.fit(blocks)
    assert len(model.values) == 0 and whitening.whitened(blocks, model).count() == 0


def test_deviations_are_exact_or_null(spark):
    big = [[2.0 ** 47, 0.0], [-(2.0 ** 47), 1.0], [0.0, 2.0]]
    blocks = whitening.stored(vectors(spark, big), "embedding", "vec_id")
    rows = whitening.whitened(blocks, whitening.fit(blocks)).collect()
    assert {r.vec_id: r.deviation for r in rows} == {0: None, 1: None, 2: (3 * 128 - 192) ** 2}
    n, s, q = whitening.exact_sums(blocks)
    assert (n, s, q) == (3, [0, 192], [2 * 2 ** 106, 64 ** 2 + 128 ** 2])
