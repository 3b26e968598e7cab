"""Monthly states, quantile sketches and binned densities against what they replace."""

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import aggspec as A
from ledgerloom.operators import monthly as Y
from ledgerloom.operators import profile as P
from ledgerloom.operators import sketches as K
from ledgerloom.operators.quantiles import exact_quantiles

SPEC = {"x": ["mean", "sum", "max", "min", "var", "std", "count", "size"], "n": ["sum", "size"]}
WINDOWS = {"W6_": (-6, None), "W12_": (-12, -3), "ALL_": (None, None), "NONE_": (5, 9)}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(12)
    n = 900
    x = [None if rng.random() < 0.2 else float(1e6 + rng.normal()) for _ in range(n)]
    data = [(int(k) if k else None, int(m) if m else None, v, int(i % 5)) for i, (k, m, v) in enumerate(zip(rng.integers(0, 8, n), rng.integers(-24, 1, n), x, strict=True))]
    return spark.createDataFrame([*data, (77, -1, None, None)], "k int, m int, x double, n int").repartition(4)


def blocks_of(df):
    known = df.where("m is not null")
    inside = lambda w: (F.lit(True) if w[0] is None else F.col("m") >= w[0]) & (F.lit(True) if w[1] is None else F.col("m") <= w[1])
    return A.segmented_agg(known, "k", [A.Segment(p, SPEC, inside(w)) for p, w in WINDOWS.items()])


def same(got, want):
    got, want = (d.toPandas().sort_values("k").reset_index(drop=True) for d in (got, want))
    pd.testing.assert_frame_equal(got[want.columns].astype(float), want.astype(float), rtol=1e-7)


def test_windows_equal_segments(rows):
    same(Y.window_blocks(Y.monthly_states(rows, "k", "m", SPEC), "k", "m", SPEC, WINDOWS), blocks_of(rows))


def test_a_new_month_is_added_without_reading_the_past(spark, rows, tmp_path):
    path = f"{tmp_path}/states"
    Y.refresh(rows.where("m < -1"), path, "k", "m", SPEC)
    before = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    Y.refresh(rows.where("m = -1"), path, "k", "m", SPEC)
    Y.refresh(rows.where("m = 0 and n < 3"), path, "k", "m", SPEC)
    Y.refresh(rows.where("m = 0 and (n >= 3 or n is null)"), path, "k", "m", SPEC)  # late rows of a month
    after = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    assert before.items() <= after.items()
    same(Y.window_blocks(Y.stored_states(spark, path, "m"), "k", "m", SPEC, WINDOWS), blocks_of(rows))
    recent = Y.stored_states(spark, path, "m", (-6, 0))
    assert "PartitionFilters: [isnotnull(m" in recent._jdf.queryExecution().executedPlan().toString()
    same(Y.window_blocks(recent, "k", "m", SPEC, {"W6_": (-6, None)}), blocks_of(rows.where("m >= -6")).select("k", *[f"W6_{c}_{f.upper()}" for c, fs in SPEC.items() for f in fs]))


def test_sketched_aggregates(rows):
    spec = {"x": ["median_approx", "nunique_approx"]}
    got = Y.window_blocks(Y.monthly_states(rows, "k", "m", spec), "k", "m", spec, {"": (None, None)}).toPandas().set_index("k").sort_index()
    frame = rows.where("k is not null and m is not null").toPandas()
    for k, part in frame.groupby("k"):
        have = part["x"].dropna()
        if len(have):
            assert abs((have < got.loc[k, "x_MEDIAN_APPROX"]).mean() - 0.5) < 0.05
            assert got.loc[k, "x_NUNIQUE_APPROX"] == pytest.approx(have.nunique(), rel=0.05)
    with pytest.raises(ValueError, match="merged"):
        Y.monthly_states(rows, "k", "m", {"x": ["median"]})


def test_sketches_of_parts_equal_that_of_the_whole_within_the_bound(spark):
    rng = np.random.default_rng(5)
    n = 30_000
    frame = pd.DataFrame({"part": rng.integers(0, 4, n), "a": rng.normal(size=n), "b": rng.integers(0, 20, n).astype(float), "c": np.exp(rng.normal(size=n) * 3)})
    df = spark.createDataFrame(frame)
    cols, probs = ["a", "b", "c"], [i / 20 for i in range(1, 20)]
    merged = None
    for part in range(4):
        one = K.quantile_sketches(df.where(F.col("part") == part), cols)
        merged = one if merged is None else K.merge_sketches(merged.unionAll(one))
    for sketches in (merged, K.quantile_sketches(df, cols)):
        checked = K.rank_check(df, K.sketch_quantiles(sketches, probs), cols, probs, 2 * K.rank_error()).collect()
        assert len(checked) == 57 and all(r.within and r.n == n for r in checked)
    assert not all(r.within for r in K.rank_check(df, exact_quantiles(df, cols, [0.5]).withColumn("q0_5", F.lit(99.0)), cols, [0.5], 0.02).collect())
    grouped = K.sketch_quantiles(K.quantile_sketches(df, ["a"], ["part"]), [0.5], ["part"]).collect()
    assert len(grouped) == 4 and all(abs(r.q0_5) < 0.1 for r in grouped)
    assert K.quantile_sketches(df.limit(0), cols).collect() == []


def test_binned_density_is_within_its_bound(spark):
    rng = np.random.default_rng(3)
    rows = [("a", float(v)) for v in rng.normal(50, 9, 2000)] + [("b", float(v)) for v in rng.exponential(5, 500)] + [("c", 1.0)] * 5 + [("a", None), (None, 2.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    grid = [float(g) for g in range(-20, 100, 4)]
    exact = {(r.k, r.grid): r.density for r in P.kernel_density(df, "x", "k", grid).collect()}
    for bins in (64, 1024):
        got = {(r.k, r.grid): r.density for r in P.binned_density(df, "x", "k", grid, bins).collect()}
        assert got.keys() == exact.keys()
        for k in "ab":
            x = np.array([v for c, v in rows if c == k and v is not None])
            bound = P.density_error(x.std(ddof=1) * len(x) ** -0.2, (x.max() - x.min()) / (bins - 1))
            worst = max(abs(got[c, g] - exact[c, g]) for c, g in got if c == k)
            assert worst <= bound * 1.0001
            assert bins < 1024 or worst < 1e-4
    assert math.isclose(sum(got["a", g] for g in grid) * 4, 1, abs_tol=0.01)
