"""Pair sums in tiles, variance inflation and elimination against NumPy."""

import numpy as np
import pytest

from ledgerloom.operators import gram as G
from ledgerloom.operators import modelling as M


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 11))
    x[:, 3] = x[:, 0] + x[:, 1]                      # a singular group of three
    x[:, 6] = 3 * x[:, 5] + 0.1 * rng.normal(size=300)
    x[:, 7] = 0.0
    x[:, 9] = x[:, 8] + 0.4 * rng.normal(size=300)
    x[:, 10] = 1.0
    names = [f"c.{i}" for i in range(11)]
    return x, names, spark.createDataFrame(x.tolist(), ", ".join(f"`{n}` double" for n in names)).repartition(3)


def factor(x, i):
    rest = np.delete(x, i, 1)
    left = x[:, i] - rest @ np.linalg.lstsq(rest, x[:, i], rcond=None)[0]
    total, left = x[:, i] @ x[:, i], left @ left
    return np.inf if left <= 1e-9 * total else total / left


@pytest.mark.parametrize("tile", [512, 4, 1])
def test_pair_sums_with_missing_cells(spark, tile):
    rng = np.random.default_rng(2)
    x = np.where(rng.random((200, 9)) < 0.3, np.nan, rng.normal(5, 2, (200, 9)))
    rows = [[None if np.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)] for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(9))).repartition(4)
    shift = np.arange(9.0)
    got = G.pair_sums(df, [f"x{i}" for i in range(9)], shift, tile)
    here, y = ~np.isnan(x), np.nan_to_num(x - shift)
    y = np.where(here, y, 0.0)
    m = here.astype(float)
    for name, want in (("products", y.T @ y), ("sums", y.T @ m), ("squares", (y * y).T @ m), ("count", m.T @ m)):
        assert np.allclose(getattr(got, name), want), name


def test_nothing_to_sum(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert G.pair_sums(df, ["a", "b"]).count.tolist() == [[0, 0], [0, 0]]
    assert G.pair_sums(df, []).products.shape == (0, 0)


def test_factors_and_singular_groups(data):
    x, names, df = data
    got = M.vif(df, names)
    free = [i for i in range(11) if i not in (3, 7)]
    for at, i in enumerate(free):
        assert got[names[i]] == pytest.approx(factor(x[:, free], at), rel=1e-6), names[i]
    assert [n for n in names if np.isinf(got[n])] == ["c.3", "c.7"]
    assert M.vif_filter(df, names) == [f"c.{i}" for i in (0, 1, 2, 4, 8, 9, 10)]


def test_inverse_times_gram_is_identity(data):
    x, *_ = data
    gram = x.T @ x
    size = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1))
    unit = gram / np.outer(size, size)
    inverse, independent = M.sweep_inverse(unit)
    assert independent == [0, 1, 2, 4, 5, 6, 8, 9, 10]
    at = np.ix_(independent, independent)
    assert np.abs(inverse[at] @ unit[at] - np.eye(9)).max() < 1e-9


def test_elimination_step_by_step(data):
    x, names, df = data
    left = [i for i in range(11) if i not in (3, 7)]
    while True:
        worst = max(left, key=lambda i: (factor(x[:, left], left.index(i)), i))
        if factor(x[:, left], left.index(worst)) < 3:
            break
        left.remove(worst)
    assert M.vif_eliminate(df, names, limit=3.0) == [names[i] for i in left] and len(left) < 9


def test_moments_in_one_pass(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(1e6, 1, (500, 4))
    x[:, 1] = 7.0
    x[rng.random((500, 4)) < 0.2] = np.nan
    x[:, 3] = np.nan
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in r] for r in x], "a double, b double, `c.d` double, e double").repartition(5)
    got = G.column_moments(df, ["a", "b", "c.d", "e"])
    for i, (n, mean, m) in enumerate(got[:3]):
        own = x[~np.isnan(x[:, i]), i]
        assert n == len(own) and mean == pytest.approx(own.mean(), rel=1e-14) and m == pytest.approx(((own - own.mean()) ** 2).sum(), rel=1e-9, abs=1e-12)
    assert got[3] == (0, None, 0.0) and G.column_moments(df.limit(0), ["a"]) == [(0, None, 0.0)] and G.column_moments(df, []) == []
