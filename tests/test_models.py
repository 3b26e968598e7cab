"""Modelling operators against closed forms and NumPy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.normal import phik_of_table
from ledgerloom.operators import modelling as M
from ledgerloom.operators import profile as P
from ledgerloom.plans.scoring import train_and_score


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    n = 600
    a, b, c = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    y = (a - 0.5 * b + rng.normal(scale=0.7, size=n) > 0.6).astype(float)
    frame = pd.DataFrame({"SK_ID_CURR": range(n), "TARGET": y, "a": a, "b": b, "c": c, "d": 2 * a + 0.01 * c})
    return frame, spark.createDataFrame(frame)


def test_logistic_equals_newton(table):
    frame, df = table
    weights, strength = (0.5, 5.0), 0.7
    model = M.fit_logistic(M.assemble(df, ["a", "b"], ["TARGET"]), weights=weights, c=strength, tol=1e-10, max_iter=500)
    x = np.column_stack([np.ones(len(frame)), frame["a"], frame["b"]])
    y = frame["TARGET"].to_numpy()
    w = np.where(y == 1, weights[1], weights[0])
    beta, ridge = np.zeros(3), np.diag([0.0, 1.0, 1.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ beta))
        grad = strength * x.T @ (w * (p - y)) + ridge @ beta
        hess = strength * (x.T * (w * p * (1 - p))) @ x + ridge
        beta -= np.linalg.solve(hess, grad)
    assert [model.intercept, *model.coefficients] == pytest.approx(beta.tolist(), abs=1e-4)


@pytest.mark.parametrize("budget", [1_000_000, 30])
def test_rank_auc_equals_evaluator(table, budget, monkeypatch):
    monkeypatch.setattr("ledgerloom.operators.skew.ROWS_PER_PIECE", budget)
    _, df = table
    model = M.fit_logistic(M.assemble(df, ["a", "b"], ["TARGET"]))
    scored = M.score(model, M.assemble(df, ["a", "b"], ["TARGET"])).withColumn("score", F.round("score", 2))
    want = M.auc_of(scored.withColumn("rawPrediction", F.col("score")))
    assert M.auc(scored).first()["auc"] == pytest.approx(want, abs=1e-9)


def test_folds_are_stratified_and_stable(table):
    _, df = table
    first = {r["SK_ID_CURR"]: r["fold"] for r in M.stratified_folds(df, "SK_ID_CURR").collect()}
    again = {r["SK_ID_CURR"]: r["fold"] for r in M.stratified_folds(df.repartition(7), "SK_ID_CURR").collect()}
    assert first == again
    sizes = M.stratified_folds(df, "SK_ID_CURR").groupBy("TARGET", "fold").count().toPandas()
    assert (sizes.groupby("TARGET")["count"].agg(lambda s: s.max() - s.min()) <= 1).all()


def test_vif_matches_regression(table):
    frame, df = table
    cols = ["a", "b", "d"]
    x = frame[cols].to_numpy()
    for i, c in enumerate(cols):
        rest = np.delete(x, i, 1)
        fit = rest @ np.linalg.lstsq(rest, x[:, i], rcond=None)[0]
        want = (x[:, i] @ x[:, i]) / ((x[:, i] - fit) @ (x[:, i] - fit))
        assert M.vif(df, cols)[c] == pytest.approx(want, rel=1e-6)
    assert M.vif_filter(df, cols) == ["b"]
    assert M.vif(df, cols, centred=True)["b"] == pytest.approx(1.0, abs=0.05)


def test_impute_and_scale(spark):
    train = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (3.0, 5.0)], "x double, k double")
    other = spark.createDataFrame([(None, 6.0)], "x double, k double")
    a, b = M.impute_scale(train, other, ["x", "k"])
    assert [r["x"] for r in a.collect()] == pytest.approx([-np.sqrt(1.5), 0.0, np.sqrt(1.5)])
    assert tuple(b.first()) == (0.0, 1.0)


def test_phik_limits():
    rng = np.random.default_rng(0)
    assert phik_of_table(np.array([[50.0, 0], [0, 50.0]]))[1] > 0.95
    assert phik_of_table(np.array([[25.0, 25], [25, 25]]))[1] == 0.0
    x = rng.multivariate_normal([0, 0], [[1, 0.6], [0.6, 1]], 200_000)
    counts, *_ = np.histogram2d(x[:, 0], x[:, 1] > 0.5, bins=[np.linspace(-3, 3, 11), [-0.5, 0.5, 1.5]])
    assert phik_of_table(counts)[1] == pytest.approx(0.6, abs=0.08)


def test_correlation_ignores_incomplete_pairs(spark):
    frame = pd.DataFrame({"a": [1.0, 2, 3, 4, None], "b": [2.0, 1, None, 5, 6], "k": [1.0] * 5})
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), "a double, b double, k double")
    got = {(r["row"], r["column"]): r["corr"] for r in P.correlation(df, ["a", "b", "k"], block=2).collect()}
    assert got[("b", "a")] == pytest.approx(frame["a"].corr(frame["b"]))
    assert got[("k", "a")] is None


@pytest.mark.parametrize("how", ["all", "vif", "mutual_information", "importance"])
def test_train_and_score(table, how):
    _, df = table
    unlabelled = df.withColumn("TARGET", F.when(F.col("SK_ID_CURR") % 4 != 0, F.col("TARGET")))
    result = train_and_score(unlabelled, select=how, search="random", folds=3, trials=1)
    assert result.scores.count() == 150
    assert result.scores.where("TARGET between 0 and 1").count() == 150
    assert result.valid_auc > 0.7 and set(result.features) <= {"a", "b", "c", "d"}
