"""Carried-state transforms against one pandas frame of each group."""

import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle

from ledgerloom.operators import udfs as U

ALPHA, LIMIT = 0.3, 16
# workers can't import this file
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def summarise(rows):
    assert 0 < len(rows) <= LIMIT, "a run is never larger than the limit"
    num = den = 0.0
    for v in rows["v"]:
        num, den = num * (1 - ALPHA), den * (1 - ALPHA)
        if v is not None and not np.isnan(v):
            num, den = num + v, den + 1
    return {"num": num, "den": den, "n": len(rows)}


def merge(a, b):
    fade = (1 - ALPHA) ** b["n"]
    return {"num": a["num"] * fade + b["num"], "den": a["den"] * fade + b["den"], "n": a["n"] + b["n"]}


def step(before, rows):
    num, den = (before["num"], before["den"]) if before else (0.0, 0.0)
    out = []
    for v in rows["v"]:
        num, den = num * (1 - ALPHA), den * (1 - ALPHA)
        if v is not None and not np.isnan(v):
            num, den = num + v, den + 1
        out.append(num / den if den else np.nan)
    return pd.Series(out, index=rows.index)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_weighted_mean_of_a_hot_group(spark, coalesce):
    rng = np.random.default_rng(6)
    rows = [("hot", i // 5, i, float(rng.normal()) if rng.random() > 0.2 else None) for i in range(400)]
    rows += [(k, 0, i, float(i)) for k in ("a", "b") for i in range(30)] + [(None, i % 3 or None, i, 1.0 + i) for i in range(40)] + [("one", 1, 1, 2.0)]
    df = spark.createDataFrame(rows, "k string, day int, id int, v double").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = U.grouped_scan(df, ["k"], ["day", "id"], "m", summarise, merge, step, "num double, den double, n bigint", run=LIMIT).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {}
    frame = pd.DataFrame(rows, columns=["k", "day", "id", "v"])
    for k, part in frame.groupby("k", dropna=False):
        part = part.sort_values(["day", "id"], na_position="first")
        want |= {(None if pd.isna(k) else k, i): m for i, m in zip(part["id"], step(None, part), strict=True)}
    assert len(got) == len(rows) and list(got[0].asDict()) == ["k", "day", "id", "v", "m"]
    for r in got:
        assert r.m == pytest.approx(want[r.k, r.id], nan_ok=True), r


def test_scan_of_nothing(spark):
    df = spark.createDataFrame([], "k string, day int, id int, v double")
    assert U.grouped_scan(df, ["k"], ["id"], "m", summarise, merge, step, "num double, den double, n bigint").collect() == []
