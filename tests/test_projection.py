"""Truncated SVD by range finder and tall-skinny QR against plain numpy."""

import numpy as np
import pytest

from ferret.operators import projection as P


def frame(spark, x, parts=5):
    return spark.createDataFrame([(x[i].tolist(),) for i in range(len(x))], "v array<double>").repartition(parts)


def angle(a, b):
    """Sine of the largest angle between two row spaces."""
    return np.linalg.norm(a - (a @ b.T) @ b, 2)


def test_two_thousand_dimensions(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 40)) * 0.9 ** np.arange(40) @ rng.standard_normal((40, 2000)) + 0.01 * rng.standard_normal((300, 2000))
    m = P.fit_svd(frame(spark, x), "v", 3)
    values, vectors = np.linalg.eigh(x.T @ x)
    assert angle(m.components, vectors[:, ::-1][:, :3].T) < 1e-6
    assert np.allclose(m.singular_values ** 2, values[::-1][:3], rtol=1e-9)


@pytest.mark.parametrize("block", [2, 5, 64])
def test_flat_spectrum_with_restarts(spark, block):
    x = np.random.default_rng(2).standard_normal((200, 40))
    m = P.fit_svd(frame(spark, x), "v", 2, block=block)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert angle(m.components, vt[:2]) < 1e-6
    assert np.allclose(m.singular_values, s[:2], rtol=1e-10)
    projected = x @ vt[:2].T
    assert np.allclose(m.explained_variance, projected.var(axis=0), rtol=1e-6)
    assert np.allclose(m.explained_variance_ratio, projected.var(axis=0) / x.var(axis=0).sum(), rtol=1e-6)


def test_fewer_rows_than_components_nulls_and_none(spark):
    df = spark.createDataFrame([([3.0, 4.0, 0.0],), (None,)], "v array<double>")
    m = P.fit_svd(df, "v", 2)
    assert np.allclose(m.singular_values, [5.0, 0.0]) and np.allclose(m.components[0], [0.6, 0.8, 0.0])
    with pytest.raises(ValueError):
        P.fit_svd(df.where("v IS NULL"), "v", 2)
