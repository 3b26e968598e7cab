"""Missing-value, zero and edge rules of the row expressions, against pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom import functions as X
from ledgerloom.operators import clean, encode
from ledgerloom.operators.binning import below_percentile, quantile_cut


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_division_by_zero_and_missing_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 2.0), (3.0, None), (3.0, 2.0)], "a double, b double")
    assert rows(X.ratios(df, [("r", "a", "b")]), "r") == [(None,), (None,), (None,), (None,), (1.5,)]


def test_sum_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (None, None)], "a double, b double")
    assert rows(X.sums(df, {"s": ["a", "b"]}), "s") == [(3.0,), (None,), (None,)]
    assert rows(X.sums(df, {"s": ["a", "b"]}, skip_missing=True), "s") == [(3.0,), (2.0,), (0.0,)]


def test_row_statistics_match_numpy(spark):
    data = [(1.0, 5.0, 3.0), (None, 2.0, 8.0), (None, None, 4.0), (None, None, None)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = rows(df, *[X.row_stat(["a", "b", "c"], fn).alias(fn) for fn in ("min", "max", "mean", "median", "var")])
    assert got[0] == pytest.approx((1.0, 5.0, 3.0, 3.0, np.var([1, 5, 3])))
    assert got[1] == (2.0, 8.0, 5.0, None, 9.0)
    assert got[2] == (4.0, 4.0, 4.0, None, 0.0)
    assert got[3] == (None, None, None, None, None)


def test_row_kurtosis_matches_pandas(spark):
    frame = pd.DataFrame(np.random.default_rng(1).integers(0, 2, (40, 8)).astype(float))
    frame.iloc[0] = 1.0
    frame.columns = [f"c{i}" for i in range(8)]
    df = spark.createDataFrame(frame.reset_index())
    got = [r[1] for r in sorted(rows(df, "index", X.row_kurtosis(list(frame.columns)).alias("k")))]
    assert got == pytest.approx(frame.kurtosis(axis=1).tolist(), abs=1e-9)
    assert got[0] == 0.0


def test_flags_treat_missing_as_false(spark):
    df = spark.createDataFrame([(5.0,), (0.0,), (None,)], "x double")
    got = rows(df, X.flag(F.col("x") > 1), X.flag_unless_zero("x"), X.clamp_at_zero("x"))
    assert got == [(1, 1, 5.0), (0, 0, 0.0), (0, 1, None)]


def test_cut_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 12.0, 13.0, 60.0, 120.0, 121.0, None)], "x double")
    right = X.cut("x", [0, 12, 60, 120], labels=["S", "M", "L"])
    assert [r[0] for r in rows(df, right)] == [None, "S", "M", "M", "L", None, None]
    left = X.cut("x", [0, 12, 60, math.inf], right=False)
    assert [r[0] for r in rows(df, left)] == [0, 1, 1, 2, 2, 2, None]
    steps = X.step_label("x", [12, 60], 9, missing=0)
    assert [r[0] for r in rows(df, steps)] == [1, 1, 2, 2, 9, 9, 0]


@pytest.mark.parametrize("budget", [1_000_000, 20])
def test_quantile_cut_matches_qcut(spark, budget, monkeypatch):
    monkeypatch.setattr("ledgerloom.operators.skew.ROWS_PER_PIECE", budget)
    values = pd.Series(np.random.default_rng(2).normal(size=200)).round(3)
    df = spark.createDataFrame(pd.DataFrame({"i": range(200), "x": values}))
    got = [r[1] for r in sorted(rows(quantile_cut(df, "x", 5, "q"), "i", "q"))]
    assert got == pd.qcut(values, 5, labels=False).tolist()


def test_below_percentile(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "x double")
    assert below_percentile(df, {"x": 0.99}).count() == 99


def test_one_hot_and_label_encode(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "c string")
    hot, names = encode.one_hot(df)
    assert names == ["c_a", "c_b", "c_nan"]
    assert rows(hot, *names) == [(0, 1, 0), (0, 0, 1), (1, 0, 0), (0, 1, 0)]
    unseen, _ = encode.one_hot(df, ["c"], {"c": ["z"]}, null_as_category=False)
    assert rows(unseen, "c_z") == [(0,)] * 4
    assert sorted(rows(encode.label_encode(df), "c")) == [(-1,), (0,), (1,), (1,)]
    assert sorted(rows(encode.label_encode(df, limit=1), "c")) == [(-1,), (0,), (1,), (1,)]
    with pytest.raises(ValueError):
        encode.domains_of(df, ["c"], limit=1)


def test_cleaning(spark):
    df = spark.createDataFrame([(365243.0, 5), (-20000.0, 40), (3.0, None)], "d double, n int")
    out = clean.null_outside(clean.null_sentinels(df, {"d": 365243.0}), {"d": (-18250, None), "n": (None, 30)})
    assert rows(out, "d", "n") == [(None, 5), (None, None), (3.0, None)]
    inf = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,)], "x double")
    assert rows(clean.inf_to_null(inf), "x") == [(None,), (None,), (1.0,)]
    with pytest.raises(ValueError):
        clean.sanitize_names(spark.createDataFrame([(1, 2)], "`a b` int, ab int"))


def test_narrow_keeps_values(spark):
    df = spark.createDataFrame([(1, 300, 70000, 1 << 40, 0.5), (126, 2, 3, 4, None)], "a long, b long, c long, d long, e double")
    out = clean.narrow(df)
    assert [t for _, t in out.dtypes] == ["tinyint", "smallint", "int", "bigint", "float"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_drop_sparse(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1)], "a int, b int")
    assert clean.drop_sparse_columns(df, 0.6).columns == ["a"]


def test_label_codes_of_a_large_domain_are_ranked_by_several_tasks(spark):
    values = [f"Customer#{i:05d}" for i in range(700)]
    df = spark.createDataFrame([(v, v[::-1]) for v in values * 2] + [(None, "x")], "a string, b string")
    table = encode.code_table(df, ["a", "b"], values_per_task=50)
    got = {(r["column"], r["value"]): r["code"] for r in table.collect()}
    assert got == {("a", v): i for i, v in enumerate(values)} | {("b", v): i for i, v in enumerate(sorted([*(v[::-1] for v in values), "x"]))}
    coded = encode.label_encode(df, ["a"], limit=50)
    assert sorted(r["a"] for r in coded.collect()) == sorted([-1, *[i for i in range(700)] * 2])


def test_one_hot_domains(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (1, "x")], "k long, c string")
    assert encode.domains_of(df, ["c"]) == {"c": ["x", "y"]}
    with pytest.raises(ValueError, match="one_hot_long"):
        encode.domains_of(df, ["c"], limit=1)
    assert sorted(tuple(r) for r in encode.one_hot_long(df, "k", ["c"]).collect()) == [(1, "c", "x", 2 / 3), (1, "c", "y", 1 / 3)]


def test_label_encode_of_wide_frames_by_key(spark):
    df = spark.createDataFrame([(1, "b", None, 5), (2, None, "x", 6), (3, "a", "x", 7), (4, None, None, 8)], "id int, a string, b string, n int")
    assert sorted(tuple(r) for r in encode.label_encode(df, key="id").collect()) == sorted(tuple(r) for r in encode.label_encode(df).collect())
    assert encode.label_encode(df, ["b"], key="id").columns == ["id", "a", "b", "n"]
    assert encode.label_encode(df.limit(0), key="id").collect() == []
