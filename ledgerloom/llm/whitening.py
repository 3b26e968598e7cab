"""Whitening of embeddings with a weighted multiplicity covariance.

Identical vectors are grouped first (combined before the shuffle, so a vector that a
third of the rows share is one row per task).  The distinct vectors are fitted with
their counts or with one as weights: tasks centre their vectors and multiply them as
matrices, the JVM adds up the tasks' products.  The driver sees one covariance matrix,
whose size is the square of the dimensions.  Each distinct vector is whitened once and
joined back to the rows that have it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import durable

#: vectors that a task multiplies at a time
BLOCK = 4096
#: components with a smaller share of the largest eigenvalue are numerically zero and can't be whitened
RANK = 1e-12
#: entries beyond have no exact place in a double
LARGEST = float(1 << 52)


def matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def quantised(df: DataFrame, vector: str, scale: float, shift: int) -> DataFrame:
    """``df`` with x = floor(scale * entry) + shift, without rows that have no such vector.

    Out go missing vectors, vectors with missing or non-finite entries, with entries too
    large for an exact integer, without entries, and of another length than most rows
    have (of equally common lengths the greatest stays).
    """
    v = F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda e: e * F.lit(scale))
    usable = df.withColumn("x", v).where(
        (F.size("x") > 0) & F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST)))
    sizes = usable.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "d")).alias("most"))
    whole = F.transform("x", lambda e: F.floor(e).cast("bigint") + F.lit(shift).cast("bigint"))
    return usable.where(F.size("x") == sizes.select("most.d").scalar()).withColumn("x", whole)


@dataclass
class Moments:
    """Weight, sums and covariance (divisor: the weight) of vectors; sums are exact for integers."""

    weight: int
    sums: list
    covariance: np.ndarray


def _per_task(add: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, ...]], schema: pa.Schema, name: str):
    """Adds up what ``add`` makes of each block of (vectors, weights): arrays of fixed sizes, one row for each entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                made = add(matrix(part.column(name)), part.column("weight").to_numpy())
                total = made if total is None else tuple(a + b for a, b in zip(total, made, strict=True))
        if total is not None:
            size = max(len(t) for t in total)
            columns = [pa.array(np.arange(size, dtype=np.int64))] + [pa.array(np.broadcast_to(t, size)) for t in total]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def moments(vectors: DataFrame, name: str) -> Moments | None:
    """Of the array column ``name`` with the column ``weight``; None where there are no rows.

    Every block is centred with the mean of all before it is multiplied.  Integer sums
    are exact; the mean's whole part is taken off in integers.
    """
    whole = dict(vectors.dtypes)[name] == "array<bigint>"
    number = "bigint" if whole else "double"
    kind = pa.int64() if whole else pa.float64()
    given = vectors.select(name, "weight")

    def sums(x, w):
        return (w[:, None] * x).sum(0), np.array([w.sum()])

    first = given.mapInArrow(_per_task(sums, pa.schema([("i", pa.int64()), ("s", kind), ("w", pa.int64())]), name), f"i bigint, s {number}, w bigint")
    rows = first.groupBy("i").agg(F.sum("s").alias("s"), F.sum("w").alias("w")).orderBy("i").collect()
    if not rows:
        return None
    weight, total = rows[0].w, [r.s for r in rows]
    base = np.array([s // weight for s in total], np.int64) if whole else np.array([s / weight for s in total])
    rest = np.array([s % weight / weight for s in total]) if whole else np.zeros(len(total))
    upper = np.triu_indices(len(total))

    def products(x, w):
        y = (x - base).astype(float) - rest
        return (((w[:, None] * y).T @ y)[upper],)

    second = given.mapInArrow(_per_task(products, pa.schema([("at", pa.int64()), ("p", pa.float64())]), name), "at bigint, p double")
    made = second.groupBy("at").agg(F.sum("p").alias("p")).collect()
    flat = np.zeros(len(upper[0]))
    flat[[r.at for r in made]] = [r.p for r in made]
    covariance = np.zeros((len(total), len(total)))
    covariance[upper] = flat / weight
    return Moments(weight, total, np.where(np.tri(len(total), k=-1, dtype=bool), covariance.T, covariance))


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; each vector's largest entry is positive."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    good = values > max(RANK * values[0], 0.0)
    values, vectors = values[good][:most], vectors[:, good][:, :most]
    lead = np.abs(vectors).argmax(0) if vectors.size else np.zeros(0, int)
    return values, vectors * np.sign(vectors[lead, np.arange(len(values))])


def _whiten(weight: int, sums: list, directions: np.ndarray):
    """(key, white, deviation) for each distinct vector."""
    base = np.array([s // weight for s in sums], np.int64)
    rest = np.array([s % weight / weight for s in sums])
    over = np.array([s % weight for s in sums], np.int64)

    def deviation(x: np.ndarray) -> pa.Array:
        # n * x - sums = n * (x - base) - over
        bound = float(weight) * (float(np.abs(x - base).max()) + 1)
        if bound * bound * x.shape[1] < 2.0 ** 62:
            return pa.array(np.square(weight * (x - base) - over).sum(1))
        exact = [sum((weight * a - b) ** 2 for a, b in zip(r, over.tolist(), strict=True)) for r in (x - base).tolist()]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = matrix(part.column("x"))
                white = ((x - base).astype(float) - rest) @ directions
                ends = np.arange(0, white.size + 1, white.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("weight"), pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel())), deviation(x)],
                    ["key", "weight", "white", "deviation"])

    return run


RESULT = "id {id}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", most: int = 16, weights: str = "one",
           scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """One row for each usable row of ``df`` and component, numbered from 1 by falling eigenvalue.

    Vectors are taken as integers floor(scale * entry) + shift.  ``weights`` is "one"
    (each distinct vector counts once) or "count" (as often as rows have it); ``n`` is the
    weight of all.  ``deviation`` is the sum over dimensions of (n * x - sums)^2, exact, or
    missing where 64 bits can't hold it; ``explained`` is the eigenvalue's part of the
    trace; ``identity_error`` is the largest absolute entry of the whitened vectors'
    covariance minus the identity, over the fitted vectors.  Components without variance
    can't be whitened and have no rows, so one distinct vector alone gives none.  Rows
    that ``quantised`` names are left out; missing and repeated ids are kept as they are.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights must be 'one' or 'count'")
    id_type = df.select(F.col(f"`{id_col}`")).dtypes[0][1]
    usable = quantised(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").alias("v")), "v", scale, shift)
    keyed = durable(usable.select("id", F.unhex(F.sha2(F.array_join(F.col("x").cast("array<string>"), " ").cast("binary"), 256)).alias("key"), "x"))
    count = F.count(F.lit(1)) if weights == "count" else F.lit(1).cast("bigint")
    distinct = durable(keyed.groupBy("key", "x").agg(count.alias("weight")))
    fit = moments(distinct, "x")
    empty = df.sparkSession.createDataFrame([], RESULT.format(id=id_type)).withColumnRenamed("id", id_col)
    if fit is None:
        return empty
    values, directions = components(fit.covariance, most)
    if not len(values):
        return empty
    white = durable(distinct.mapInArrow(
        _whiten(fit.weight, fit.sums, directions / np.sqrt(values)), "key binary, weight bigint, white array<double>, deviation bigint"))
    error = float(np.abs(moments(white, "white").covariance - np.eye(len(values))).max())
    explained = F.array(*[F.lit(float(v / np.trace(fit.covariance))) for v in values])
    # a vector that many rows share is split on the rows' side by the adaptive skew join; each row then yields its components
    back = keyed.select("id", "key").join(white.select("key", "white", "deviation").hint("merge"), "key")
    return back.select("id", "deviation", F.posexplode("white").alias("c", "whitened")).select(
        F.col("id").alias(id_col), (F.col("c") + 1).alias("component"), F.lit(fit.weight).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("c")).alias("explained"), F.lit(error).alias("identity_error"))
