"""Nearest-neighbour mutual information, global positions and running totals against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import neighbours as N
from ledgerloom.operators.skew import global_positions, running_total


def psi(m):
    return -0.57721566490153286 + sum(1 / i for i in range(1, m))


def brute(values, labels, k=3):
    rows = [(x, y) for x, y in zip(values, labels, strict=True) if x is not None and y is not None and math.isfinite(x)]
    by = {c: [x for x, y in rows if y == c] for c in {y for _, y in rows}}
    rows = [(x, y) for x, y in rows if len(by[y]) > 1]
    if not rows:
        return 0.0
    total = psi(len(rows))
    for x, y in rows:
        have = min(k, len(by[y]) - 1)
        r = sorted(abs(x - o) for o in by[y])[have]
        m = sum(x - r < o < x + r for o, _ in rows) if r > 0 else sum(o == x for o, _ in rows)
        total += (psi(have) - psi(len(by[y])) - psi(m)) / len(rows)
    return max(0.0, total)


def columns():
    rng = random.Random(4)
    label = [rng.choice([0, 0, 0, 1, None]) for _ in range(400)]
    return label, {
        "even": [rng.random() for _ in label],
        "tied": [float(rng.randint(0, 5)) for _ in label],
        "told": [(y or 0) * 2 + rng.random() for y in label],
        "gaps": [rng.choice([None, float("nan"), float("inf"), rng.gauss(0, 1)]) for _ in label],
        "same": [1.0] * len(label),
        "none": [None] * len(label),
        "steps.64": [rng.randint(0, 200) / 64 for _ in label],
    }


@pytest.mark.parametrize(("k", "run"), [(3, N.RUN), (3, 7), (1, 2)])
def test_mutual_information_equals_brute_force(spark, k, run):
    label, data = columns()
    df = spark.createDataFrame(list(zip(label, *data.values(), strict=True)), "TARGET int, " + ", ".join(f"`{c}` double" for c in data)).repartition(5)
    got = {r.feature: r.mutual_information for r in N.mutual_information_neighbours(df, list(data), k=k, run=run).collect()}
    assert got.keys() == data.keys()
    for c, values in data.items():
        assert got[c] == pytest.approx(brute(values, label, k), abs=1e-9), c


def test_classes_of_few_rows(spark):
    rows = [("a", 1.0), ("a", 2.0), ("b", 5.0), ("c", 1.5), ("c", 1.5), ("c", 9.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "TARGET string, x double")
    got = N.mutual_information_neighbours(df, ["x"]).first().mutual_information
    assert got == pytest.approx(brute([x for _, x in rows], [y for y, _ in rows]), abs=1e-9)
    assert N.mutual_information_neighbours(df.limit(0), ["x"]).first().mutual_information == 0
    with pytest.raises(ValueError, match="k must"):
        N.mutual_information_neighbours(df, ["x"], k=0)


def test_digamma(spark):
    got = spark.range(1, 400).select(N.digamma(F.col("id"))).collect()
    assert max(abs(r[0] - psi(i)) for i, r in enumerate(got, 1)) < 1e-12


def test_positions_and_totals_of_the_whole_table(spark):
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(0, 3)), f"t{rng.integers(0, 4)}", i, int(rng.integers(0, 9))) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, c int, n int").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = global_positions(df, ["a", "b", "c"]).collect()
        summed = running_total(df, ["a", "b", "c"], "n").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(rows)
    assert {r.position: (r.a, r.b, r.c, r.n) for r in placed} == dict(enumerate(want))
    assert {(r.a, r.b, r.c): r.total for r in summed} == {w[:3]: s for w, s in zip(want, np.cumsum([w[3] for w in want]), strict=True)}
