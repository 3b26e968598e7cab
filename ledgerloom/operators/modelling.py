"""Imputation, scaling, feature selection, training and scoring."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import newton
from ledgerloom.operators.gram import column_moments, means, pair_sums
from ledgerloom.operators.quantiles import value_ladder
from ledgerloom.operators.skew import positions
from ledgerloom.session import durable

# The class-weight pairs and regularisation strengths of the grid.
GRID_C = [0.1, 1.0]
GRID_WEIGHTS = [(0.3, 4.5), (0.525, 5.25), (0.75, 6.0)]


def split_by_label(df: DataFrame, label: str = "TARGET") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(label).isNotNull()), df.where(F.col(label).isNull())


def train_means(train: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Column means of the training rows: two numbers for each column."""
    return {c: mean for c, (_, mean, _) in zip(cols, column_moments(train, cols))}


def mean_impute(df: DataFrame, means: dict[str, float]) -> DataFrame:
    """Fill missing cells with training means; columns never seen become 0."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(m if m is not None else 0.0)))
                           for c, m in means.items()})


def train_scales(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column; constant columns scale by 1."""
    return {c: (mean or 0.0, (m / n) ** 0.5 or 1.0 if n else 1.0) for c, (n, mean, m) in zip(cols, column_moments(train, cols))}


def standard_scale(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in scales.items()})


def impute_scale(train: DataFrame, other: DataFrame | None, cols: Sequence[str]):
    """Fit on train, apply to both; returns (train, other).

    Filled cells lie on the mean, so one pass over the training rows tells both means
    and scales: the squares of the present cells, spread over all rows.
    """
    found = column_moments(train.withColumn("__one", F.lit(1.0)), [*cols, "__one"])
    rows = max(found[-1][0], 1)
    means = {c: mean for c, (_, mean, _) in zip(cols, found)}
    scales = {c: (mean or 0.0, (m / rows) ** 0.5 or 1.0) for c, (_, mean, m) in zip(cols, found)}
    return tuple(None if df is None else standard_scale(mean_impute(df, means), scales) for df in (train, other))


def assemble(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(df).select(*keep, "features")


def fit_logistic(train: DataFrame, label: str = "TARGET", weights: tuple[float, float] = (1.0, 1.0), c: float = 1.0,
                 tol: float = 1e-6, max_iter: int = 100, intercept: bool = True) -> LogisticRegressionModel:
    """L2 logistic regression with class weights.

    ``c`` scales the weighted loss against half the squared coefficients, so the
    penalty handed to Spark (which averages the loss) is 1 / (c * sum of weights).
    """
    weighted = train.withColumn("__w", F.when(F.col(label) == 1, F.lit(float(weights[1]))).otherwise(
        F.lit(float(weights[0]))))
    total = weighted.agg(F.sum("__w")).first()[0]
    return LogisticRegression(
        featuresCol="features", labelCol=label, weightCol="__w", elasticNetParam=0.0, standardization=False,
        regParam=1.0 / (c * total), tol=tol, maxIter=max_iter, fitIntercept=intercept).fit(weighted)


def score(model, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of class 1 as a plain column."""
    return model.transform(df).withColumn(out, vector_to_array("probability")[1])


def auc(df: DataFrame, score_col: str = "score", label: str = "TARGET") -> DataFrame:
    """Exact area under the ROC curve from tie-averaged ranks of distinct scores."""
    ladder = value_ladder(df, [score_col], keep=[label],
                          extras={"pos": F.sum(F.when(F.col(label) == 1, 1.0).otherwise(0.0))})
    rank = F.col("first_pos") + (F.col("cnt") + F.lit(1.0)) / F.lit(2.0)
    sums = ladder.agg(F.sum(F.col("pos") * rank).alias("r"), F.sum("pos").alias("p"),
                      F.sum(F.col("cnt") - F.col("pos")).alias("n"))
    return sums.select(F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / F.lit(2.0),
                                    F.col("p") * F.col("n")).alias("auc"))


def auc_of(df: DataFrame, label: str = "TARGET") -> float:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", numBins=0).evaluate(df)


def _dealt(key: str, seed: int) -> Column:
    """A number of 52 bits from the key's text: the same in every engine that has md5."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def train_valid_split(df: DataFrame, key: str, seed: int, train_share: int = 75) -> DataFrame:
    """Attach ``is_train``; depends on the key only, not on partitioning."""
    return df.withColumn("is_train", (_dealt(key, seed) % 100 < train_share).cast("int"))


def stratified_folds(df: DataFrame, key: str, label: str = "TARGET", k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Fold numbers 0..k-1 dealt in hash order within each class."""
    hashed = df.withColumn("__h", _dealt(key, seed))
    placed = positions(hashed, [label], [F.col("__h"), F.col(key)], F.col("__h"), "__p")
    return placed.withColumn(out, F.pmod(F.col("__p") - 1, F.lit(k)).cast("int")).drop("__h", "__p")


@dataclass(frozen=True)
class Trial:
    params: dict
    auc: float


def _arrays(df: DataFrame) -> DataFrame:
    """``features`` as an array of doubles, written once: the shared passes read it again and again."""
    if isinstance(df.schema["features"].dataType, VectorUDT):
        df = df.withColumn("features", vector_to_array("features"))
        return durable(df)
    return df


def _trial(params: dict, aucs: Sequence[float | None]) -> Trial:
    known = [a for a in aucs if a is not None]
    return Trial(params, float(np.mean(known)) if known else 0.5)


def grid_search(df: DataFrame, label: str = "TARGET", grid_c: Sequence[float] = tuple(GRID_C),
                grid_weights: Sequence[tuple[float, float]] = tuple(GRID_WEIGHTS), folds: int = 5) -> list[Trial]:
    """Cross-validated AUC of every (C, class weights) pair, best first; all fits share their passes.

    A fold with one class only has no AUC and is left out of the mean.
    """
    candidates = [newton.Candidate(c, tuple(w)) for c in grid_c for w in grid_weights]
    found = newton.cross_validated(_arrays(df), candidates, folds, label)
    return sorted((_trial({"c": c.c, "weights": c.weights}, aucs) for c, _, aucs in found), key=lambda t: -t.auc)


def random_candidates(trials: int = 7, seed: int = 42) -> list[newton.Candidate]:
    """Seeded draws over tolerance, iterations, C, intercept and class weights."""
    rng = random.Random(seed)
    drawn = []
    for _ in range(trials):
        tol, steps, c = rng.uniform(1e-6, 1e-3), rng.randint(100, 2500), 10 ** rng.uniform(-3, 2)
        intercept, weights = rng.random() < 0.5, (rng.uniform(0.3, 0.95), rng.uniform(4, 7))
        drawn.append(newton.Candidate(c, weights, intercept, tol=tol, max_iter=steps))
    return drawn


def random_search(df: DataFrame, label: str = "TARGET", trials: int = 7, seed: int = 42, valid_fold: int = 0) -> list[Trial]:
    """The drawn candidates, judged on a held-out fold, best first; all fits share their passes.

    A tolerance applies to a Newton step's gain relative to the objective, squared: the
    last step from there leaves an error below it.
    """
    candidates = random_candidates(trials, seed)
    rows = _arrays(df)
    fits = newton.fit_together(rows, [replace(c, held_out=valid_fold, tol=c.tol ** 2) for c in candidates], label, fold="fold")
    outs = [f"__s{i}" for i in range(len(fits))]
    aucs = newton.auc_table(newton.with_scores(rows.where(F.col("fold") == valid_fold), fits, outs).select(label, *outs), outs, label)
    params = [{"tol": c.tol, "max_iter": c.max_iter, "c": c.c, "intercept": c.intercept, "weights": c.weights} for c in candidates]
    return sorted((_trial(p, [aucs[o]]) for p, o in zip(params, outs, strict=True)), key=lambda t: -t.auc)


def _boosted(train: DataFrame, label: str, seed: int, max_iter: int, max_depth: int, rate: float = 0.1, held_out: str | None = None):
    """Boosted trees; with a ``held_out`` flag column they stop when those rows no longer gain."""
    trees = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, seed=seed, stepSize=rate)
    if held_out:
        trees = trees.setValidationIndicatorCol(held_out)
    return trees.fit(train)


def zero_importance(df: DataFrame, cols: Sequence[str], key: str, label: str = "TARGET", seeds: Sequence[int] = (0, 1),
                    max_iter: int = 100, max_depth: int = 5, rate: float = 0.1) -> dict[str, float]:
    """Boosted-tree importances averaged over seeded splits; zero means droppable.

    Up to ``max_iter`` trees are grown on the larger part of each split; the smaller
    part stops them early.
    """
    data = durable(assemble(df, cols, [key, label]))
    total = np.zeros(len(cols))
    for seed in seeds:
        parts = train_valid_split(data, key, seed).withColumn("held_out", F.col("is_train") == 0)
        total += _boosted(parts, label, seed, max_iter, max_depth, rate, "held_out").featureImportances.toArray()
    return dict(zip(cols, (total / len(seeds)).tolist()))


def iterative_select(df: DataFrame, cols: Sequence[str], key: str, label: str = "TARGET", folds: int = 5, seed: int = 42,
                     keep_above: float = 0.70, go_on_above: float = 0.75, max_iter: int = 10, max_depth: int = 4) -> list[str]:
    """Repeat: boosted trees on the features not chosen yet, keep the used ones
    while the cross-validated AUC allows it."""
    data = durable(stratified_folds(df.select(key, label, *cols), key, label, folds, seed))
    chosen: list[str] = []
    value = 1.0
    while value > go_on_above:
        left = [c for c in cols if c not in chosen]
        if not left:
            break
        vectors = assemble(data, left, [key, label, "fold"])
        importance, value = np.zeros(len(left)), 0.0
        for f in range(folds):
            model = _boosted(vectors.where(F.col("fold") != f), label, seed, max_iter, max_depth)
            importance += model.featureImportances.toArray() / folds
            value += auc_of(model.transform(vectors.where(F.col("fold") == f)), label) / folds
        used = [c for c, v in zip(left, importance) if v > 0]
        if value > keep_above:
            chosen += used
        if not used:
            break
    return chosen


def gram_matrix(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Sums of products of all column pairs (d x d numbers) in one pass."""
    return pair_sums(df, cols).products


#: a column of which no larger part than this is left beside the earlier ones is their combination
DEPENDENT = 1e-9


def sweep_inverse(gram: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(inverse over the independent columns, those columns) of a gram matrix with unit diagonal.

    Columns are swept in order; one that is a combination of earlier ones isn't swept.
    Rows and columns of the result that aren't independent hold no meaning.
    """
    a, independent = gram.astype(float).copy(), []
    for k in range(len(a)):
        pivot = a[k, k]
        if pivot < DEPENDENT:
            continue
        column = a[:, k].copy()
        a -= np.outer(column, column) / pivot
        a[:, k] = a[k, :] = column / pivot
        a[k, k] = -1.0 / pivot
        independent.append(k)
    return -a, independent


def _unit_gram(df: DataFrame, cols: Sequence[str], centred: bool) -> np.ndarray:
    if centred:
        sums = pair_sums(df, cols, means(df, cols))
        gram = sums.products - sums.sums * sums.sums.T / np.maximum(sums.count, 1)
    else:
        gram = gram_matrix(df, cols)
    # correlation scale; factors are unchanged by it
    size = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    return gram / np.outer(size, size)


def vif(df: DataFrame, cols: Sequence[str], centred: bool = False) -> dict[str, float]:
    """Variance inflation factor per feature; uncentred like a regression without intercept.

    A feature that is a combination of earlier ones (or all zero) has an infinite factor;
    the others are judged without it, so the first features of a singular group can stay.
    """
    inverse, independent = sweep_inverse(_unit_gram(df, cols, centred))
    return {c: float(inverse[i, i]) if i in independent else float("inf") for i, c in enumerate(cols)}


def vif_filter(df: DataFrame, cols: Sequence[str], limit: float = 10.0) -> list[str]:
    """Features whose factor, judged beside all others, is below ``limit``."""
    return [c for c, v in vif(df, cols).items() if v < limit]


def vif_eliminate(df: DataFrame, cols: Sequence[str], limit: float = 10.0) -> list[str]:
    """Features that are left when the one with the largest factor goes, again and again, until all are below ``limit``.

    Of features that are combinations of each other the first ones stay; of equal factors
    the later one goes.  One pass over the data; each step then takes one row and column
    out of the inverse.
    """
    full, left = sweep_inverse(_unit_gram(df, cols, False))
    inverse = full[np.ix_(left, left)]
    while left:
        worst = len(left) - 1 - int(np.argmax(np.diag(inverse)[::-1]))
        if inverse[worst, worst] < limit:
            break
        inverse = inverse - np.outer(inverse[:, worst], inverse[worst]) / inverse[worst, worst]
        inverse = np.delete(np.delete(inverse, worst, 0), worst, 1)
        left.pop(worst)
    return [cols[i] for i in left]


def mutual_information(df: DataFrame, cols: Sequence[str], label: str = "TARGET", bins: int = 10) -> DataFrame:
    """Mutual information of each quantile-binned feature with a binary label.

    A value goes to the bin of its first sorted position, so ties stay together.
    """
    ladder = value_ladder(df.where(F.col(label).isNotNull()), cols, keep=[label],
                          extras={"pos": F.sum(F.when(F.col(label) == 1, 1.0).otherwise(0.0))})
    code = F.floor(F.col("first_pos") * F.lit(bins) / F.col("n"))
    cells = ladder.withColumn("bin", code).groupBy("feature", "bin").agg(
        F.sum(F.col("cnt").cast("double")).alias("all"), F.sum("pos").alias("pos"))
    totals = cells.groupBy("feature").agg(F.sum("all").alias("total"), F.sum("pos").alias("total_pos"))
    joined = cells.join(totals, "feature")
    n = F.col("total")

    def part(count, margin):
        return F.when(count > 0, count / n * F.ln(count * n / (F.col("all") * margin))).otherwise(F.lit(0.0))

    positive = part(F.col("pos"), F.col("total_pos"))
    negative = part(F.col("all") - F.col("pos"), n - F.col("total_pos"))
    return joined.groupBy("feature").agg(F.sum(positive + negative).alias("mutual_information"))


def mutual_info_top(df: DataFrame, cols: Sequence[str], label: str = "TARGET", share: float = 0.75, bins: int = 10) -> DataFrame:
    k = int(share * len(cols))
    return mutual_information(df, cols, label, bins).orderBy(F.desc("mutual_information"), "feature").limit(k)


def coefficient_importance(df: DataFrame, names: Sequence[str], model: LogisticRegressionModel, top: int = 20) -> DataFrame:
    """Largest absolute coefficients by feature name (one row per feature)."""
    rows = [(n, float(abs(v))) for n, v in zip(names, model.coefficients.toArray())]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def class_balance(df: DataFrame, label: str = "TARGET") -> DataFrame:
    total = df.agg(F.count(label).cast("double")).scalar()
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "share", F.col("rows") / total)
