"""Aggregation, join-back and sequence operators against pandas, hot groups included."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import aggspec as A
from ledgerloom.operators import sequences as Q
from ledgerloom.operators import skew
from ledgerloom.operators.quantiles import exact_quantiles
from ledgerloom.operators.skew import positions


def sample(n=1500, seed=3):
    """A third and more of all rows belong to key 1; gaps include long missing runs."""
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({"k": rng.choice([1, 1, 1, 2, 3], n), "t": np.arange(n), "x": rng.normal(size=n).round(2)})
    frame.loc[rng.random(n) < 0.2, "x"] = np.nan
    frame.loc[(frame.t > 300) & (frame.t < 900), "x"] = np.nan
    return pd.concat([frame, pd.DataFrame({"k": [4, 5, 5], "t": [1, 1, 2], "x": [np.nan, np.nan, 2.0]})], ignore_index=True)


def to_spark(spark, frame):
    return spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), "k long, t long, x double")


def test_group_agg_matches_pandas_with_missing(spark):
    frame = sample()
    spec = {"x": ["min", "max", "mean", "sum", "var", "std", "count", "size", "nunique", "median"]}
    got = A.group_agg(to_spark(spark, frame), spec, "k").toPandas().set_index("k").sort_index()
    want = frame.groupby("k")["x"].agg(spec["x"])
    for fn in spec["x"]:
        np.testing.assert_allclose(got[f"x_{fn.upper()}"].astype(float), want[fn].astype(float), rtol=1e-9, err_msg=fn)


def test_null_keys_are_dropped(spark):
    df = spark.createDataFrame([(None, 1.0), (1, 2.0)], "k int, x double")
    assert [tuple(r) for r in A.group_agg(df, {"x": ["sum"]}, "k").collect()] == [(1, 2.0)]


def test_fused_segments_equal_separate_aggregates(spark):
    df = to_spark(spark, sample())
    spec = {"x": ["sum", "mean", "var", "count", "size"], "t": ["nunique"]}
    fused = A.segmented_agg(df, "k", [A.Segment("a_", spec), A.Segment("b_", spec, F.col("x") > 0.5)])
    apart = A.group_agg(df, spec, "k", "a_").join(A.group_agg(df.where(F.col("x") > 0.5), spec, "k", "b_"), "k", "left")
    a, b = (x.toPandas().set_index("k").sort_index().astype(float) for x in (fused, apart))
    pd.testing.assert_frame_equal(a, b[a.columns], rtol=1e-9)
    assert np.isnan(a.loc[4, "b_x_SUM"])


def test_fused_segments_use_one_exchange(spark):
    df = to_spark(spark, sample())
    segs = [A.Segment(f"s{i}_", {"x": ["sum", "mean"]}, F.col("t") > i) for i in range(6)]
    plan = A.segmented_agg(df, "k", segs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan


@pytest.mark.parametrize("budget", [1_000_000, 100])
def test_ewma_matches_pandas(spark, budget):
    frame = sample()
    got = Q.ewma(to_spark(spark, frame), ["x"], 0.7, ["k"], ["t"], rows_per_piece=budget).toPandas().sort_values(["k", "t"])
    want = frame.sort_values(["k", "t"]).groupby("k")["x"].transform(lambda s: s.ewm(alpha=0.7).mean())
    np.testing.assert_allclose(got["EXP_x"].to_numpy(float), want.to_numpy(float), rtol=1e-9)


@pytest.mark.parametrize("alpha", [0.05, 0.5, 0.99])
def test_ewma_long_group_does_not_overflow(spark, alpha):
    frame = pd.DataFrame({"k": 1, "t": np.arange(6000), "x": np.random.default_rng(5).normal(size=6000)})
    got = Q.ewma(to_spark(spark, frame), ["x"], alpha, ["k"], ["t"]).toPandas().sort_values("t")
    np.testing.assert_allclose(got["EXP_x"], frame["x"].ewm(alpha=alpha).mean(), rtol=1e-8, atol=1e-12)


@pytest.mark.parametrize("budget", [1_000_000, 3000])
@pytest.mark.parametrize("alpha", [0.0005, 0.005, 0.05, 0.7])
def test_ewma_remembers_all_rows(spark, alpha, budget):
    x = np.random.default_rng(6).normal(size=21_000)
    x[:4000] = 100
    x[::11] = np.nan
    x[9000:9500] = np.nan
    frame = pd.DataFrame({"k": 1, "t": np.arange(len(x)), "x": x})
    got = Q.ewma(to_spark(spark, frame), ["x"], alpha, ["k"], ["t"], rows_per_piece=budget).toPandas().sort_values("t")
    np.testing.assert_allclose(got["EXP_x"], frame["x"].ewm(alpha=alpha).mean(), rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("budget", [1_000_000, 50])
def test_exact_quantiles(spark, budget):
    frame = sample()
    probs = [0, 0.25, 0.5, 0.9, 1]
    got = exact_quantiles(to_spark(spark, frame), ["x"], probs, ["k"], budget).toPandas().set_index("k").sort_index()
    want = frame.dropna().groupby("k")["x"].quantile(probs).unstack()
    np.testing.assert_allclose(got.iloc[:, 2:].to_numpy(float), want.to_numpy(float), rtol=1e-12)
    overall = exact_quantiles(to_spark(spark, frame), ["x"], [0.99], (), budget).first()
    assert overall["q0_99"] == pytest.approx(frame["x"].quantile(0.99))


@pytest.mark.parametrize("budget", [1_000_000, 40])
def test_positions_are_exact(spark, budget):
    frame = sample()
    got = positions(to_spark(spark, frame), ["k"], [F.col("t")], F.col("t"), "p", budget).toPandas()
    want = frame.sort_values("t").groupby("k").cumcount() + 1
    merged = got.merge(frame.assign(w=want), on=["k", "t"])
    assert (merged["p"] == merged["w"]).all() and len(merged) == len(frame)


@pytest.mark.parametrize("budget", [1_000_000, 40])
def test_empirical_cdf(spark, budget):
    frame = sample().dropna()
    got = Q.empirical_cdf(to_spark(spark, frame), "x", ["k"], budget).toPandas()
    for k, part in frame.groupby("k"):
        values = np.sort(part["x"])
        pos = {v: (np.searchsorted(values, v), np.searchsorted(values, v, "right") - 1) for v in values}
        for r in got[got.k == k].itertuples():
            if len(values) > 1:
                assert (r.cdf_first * (len(values) - 1), r.cdf_last * (len(values) - 1)) == pytest.approx(pos[r.x])


def test_group_stats_join_back(spark):
    frame = sample()
    got = Q.group_stats(to_spark(spark, frame), ["k"], {"m": ("x", "median"), "s": ("x", "sum"), "d": ("x", "std")}).toPandas()
    g = frame.groupby("k")["x"]
    for out, fn in (("m", "median"), ("s", "sum"), ("d", "std")):
        want = dict(g.agg(fn))
        np.testing.assert_allclose(got[out].astype(float), got["k"].map(want).astype(float), rtol=1e-9)


def test_last_k_trend(spark):
    frame = sample().assign(y=lambda f: f["t"] % 7 * 1.0)
    df = spark.createDataFrame(frame[["k", "t", "y"]])
    got = Q.last_k_trend(df, "k", [F.col("t").desc()], ["y"], [3, 12]).toPandas().set_index("k")
    for k, part in frame.groupby("k"):
        y = part.sort_values("t", ascending=False)["y"].to_numpy()
        for n in (3, 12):
            cut = y[:n]
            want = 0.0 if len(cut) == 1 else np.polyfit(np.arange(len(cut)), cut, 1)[0]
            assert got.loc[k, f"{n}_TREND_y"] == pytest.approx(want, abs=1e-9)


def test_last_k_trend_missing_cell_gives_missing(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, None), (1, 3, 2.0)], "k int, t int, y double")
    row = Q.last_k_trend(df, "k", [F.col("t").desc()], ["y"], [1, 3]).first()
    assert row["1_TREND_y"] == 0.0 and row["3_TREND_y"] is None


def test_top_k_limit_is_applied_before_the_shuffle(spark):
    df = to_spark(spark, sample())
    plan = Q.last_k_trend(df, "k", [F.col("t").desc()], ["x"], [12])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_first_last_ignore_missing(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5.0), (1, 3, 7.0), (1, 4, None), (2, 1, None)], "k int, t int, x double")
    out = A.group_agg(df, {"x": ["first", "last"]}, "k", order=[F.col("t")])
    assert sorted(map(tuple, out.collect())) == [(1, 5.0, 7.0), (2, None, None)]


def test_latest_row_and_recent_entities(spark):
    df = spark.createDataFrame([(1, -40, 1.0), (1, -5, 2.0), (2, -90, 3.0)], "e int, day int, x double")
    assert sorted(map(tuple, A.latest_row(df, "e", ["day"]).collect())) == [(1, -5, 2.0), (2, -90, 3.0)]
    assert Q.recent_entities(df, "e", "day", -30).count() == 2
    assert {r["e"]: r["LAST_DAY"] for r in Q.entities_active_since(df, "e", "day").collect()} == {1: -5, 2: -90}


@pytest.mark.parametrize("kind", ["string", "date", "int"])
def test_hot_group_with_constant_first_order_column_is_cut(spark, kind):
    """The pieces come from the whole order, whatever its types, and the result equals pandas."""
    rng = np.random.default_rng(4)
    n = 400
    frame = pd.DataFrame({"k": ["a"] * 300 + ["b"] * 60 + [None] * 40, "t": 7, "u": rng.permutation(n), "x": rng.normal(size=n)})
    frame.loc[rng.random(n) < 0.2, "x"] = None
    rows = frame.astype(object).where(frame.notna(), None).values.tolist()
    df = spark.createDataFrame(rows, "k string, t int, u int, x double").withColumn("u", F.expr({"string": "lpad(u, 5, '0')", "date": "date_add(date '2020-01-01', cast(u as int))", "int": "cast(u as int)"}[kind]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_cut(df, frame)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def check_cut(df, frame):
    tagged, cut = skew.split_hot_groups(df, ["k"], [F.col("t"), F.col("u")], 50)
    pieces = tagged.groupBy("k").agg(F.countDistinct("__piece").alias("n"), F.max("__piece").alias("top")).collect()
    assert cut and {r.k: r.n > 1 for r in pieces if r.k} == {"a": True, "b": True} and [r.top for r in pieces if r.k is None] == [-1]
    got = Q.ewma(df, ["x"], 0.3, ["k"], ["t", "u"], rows_per_piece=50).toPandas()
    want = frame.sort_values("u").groupby("k", dropna=False)["x"].transform(lambda s: s.ewm(alpha=0.3, ignore_na=False).mean())
    order = frame["u"].argsort()
    got = got.sort_values("u")["EXP_x"].to_numpy(float)
    np.testing.assert_allclose(got, want.loc[frame.index[order]].to_numpy(float), rtol=1e-9)
    placed = skew.positions(df, ["k"], [F.col("t"), F.col("u")], F.col("t"), "p", 50).toPandas().sort_values(["k", "u"])
    assert placed.groupby("k", dropna=False)["p"].apply(list).map(lambda v: v == list(range(1, len(v) + 1))).all()


def test_interactions_from_one_pass(spark):
    rng = np.random.default_rng(9)
    pick = lambda *v: rng.choice(np.array(v, object), 300)
    frame = pd.DataFrame({"id": range(300), "a": pick("x", "y", None), "b": pick("u", "v", "w"), "c": pick(1, 2, None), "n": rng.normal(size=300)})
    frame.loc[rng.random(300) < 0.3, "n"] = np.nan
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), "id int, a string, b string, c int, n double")
    lists, spec = [["a", "b"], ["c"], ["b", "c"], ["a", "b", "c"]], {"n": ["mean", "max", "sum"]}
    got = Q.interaction_stats(df, lists, spec).toPandas().sort_values("id")
    for keys in lists:
        want = frame.groupby(keys)["n"]
        for fn in spec["n"]:
            name = f"n_{fn.upper()}_AGG_{'_'.join(keys)}"
            np.testing.assert_allclose(got[name].to_numpy(float), want.transform(fn).where(frame[keys].notna().all(axis=1)).to_numpy(float), rtol=1e-12)
    table, gids = Q.grouping_table(df, lists, spec)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert len(set(gids)) == 4 and plan.count("Exchange") == 1 and plan.count("Expand") == 1 and plan.count("Scan") == 1
