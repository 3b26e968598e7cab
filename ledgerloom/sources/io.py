"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.clean import drop_index_columns
from ledgerloom.operators.relations import stack_tables
from ledgerloom.sources.schemas import FILES, schema_of


# Texts that stand for a missing value in tables written by pandas or R.
MISSING_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                  "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _present(column: str) -> Column:
    text = F.col(f"`{column}`")
    return F.when(~F.trim(text).isin(MISSING_TOKENS), text)


def _parsed(column: str, kind: T.DataType) -> Column:
    """The cell as ``kind``; whole numbers may be written with decimals ("1.0"), others may not be cut."""
    text = _present(column)
    if isinstance(kind, T.StringType):
        return text
    if not isinstance(kind, T.IntegralType):
        return text.try_cast(kind)
    decimal = text.try_cast("decimal(38,6)")
    decimal = F.coalesce(decimal, F.when(text.rlike("[eE]"), text.try_cast("double").try_cast("decimal(38,6)")))
    return F.coalesce(text.try_cast(kind), F.when(decimal == F.floor(decimal), decimal.try_cast(kind)))


def _cell(field: T.StructField) -> Column:
    parsed, text = _parsed(field.name, field.dataType), _present(field.name)
    complaint = F.concat(F.lit(f"{field.name}: not a {field.dataType.simpleString()}: "), text)
    return F.when(parsed.isNull() & text.isNotNull(), F.raise_error(complaint).cast(field.dataType)).otherwise(parsed)


def rejected_cells(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(column, rejected, example) for every column of a CSV table with cells that are not of its type."""
    texts = spark.read.csv(path, header=True)
    bad = {f.name: _parsed(f.name, f.dataType).isNull() & _present(f.name).isNotNull() for f in schema.fields}
    rows = texts.agg(*[F.struct(F.lit(c).alias("column"), F.count_if(b).alias("rejected"),
                                F.min(F.when(b, F.col(f"`{c}`"))).alias("example")).alias(f"r{i}") for i, (c, b) in enumerate(bad.items())])
    return rows.select(F.inline(F.array(*rows.columns))).where("rejected > 0")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
               drop_index: bool = False) -> DataFrame:
    """Read one table.

    CSV files carry a header and are matched to ``schema`` by column name, in
    whatever order and with whatever extra columns the file has; a column that the
    file lacks is an error.  The usual words for a missing value are missing, also in
    text, and a missing number is never NaN.  A cell that is not of its column's type
    fails the read that meets it (``rejected_cells`` lists all such).  Types are
    inferred only when no schema is given.
    """
    if fmt != "csv":
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.format(fmt).load(path)
    elif schema is None:
        raw = spark.read.csv(path, header=True, inferSchema=True, nanValue="NaN")
        of = {"double": lambda c: F.when(~F.isnan(c), F.col(f"`{c}`")), "string": _present}
        df = raw.select(*[of.get(t, lambda c: F.col(f"`{c}`"))(c).alias(c) for c, t in raw.dtypes])
    else:
        texts = spark.read.csv(path, header=True)
        absent = [f.name for f in schema.fields if f.name not in texts.columns]
        if absent:
            raise ValueError(f"{path} has no column {', '.join(absent)}")
        df = texts.select(*[_cell(f).alias(f.name) for f in schema.fields])
    return drop_index_columns(df) if drop_index else df


def table_catalog(spark: SparkSession, base: str, fmt: str = "csv", files: Mapping[str, str] | None = None,
                  prefix: str = "") -> dict[str, DataFrame]:
    """All source tables below one directory, train and test applicants stacked."""
    names = dict(files or FILES)
    tables = {
        table: read_table(spark, f"{base.rstrip('/')}/{prefix}{name}.{fmt}", fmt, schema_of(table))
        for table, name in names.items()
    }
    if "application_train" in tables:
        tables["application"] = stack_tables(tables.pop("application_train"), tables.pop("application_test"))
    return tables


def write_features(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a feature table; the number of files follows the partitioning of ``df``."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.csv(path, header=True)
    else:
        writer.format(fmt).save(path)
    return path


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write a stage to shared storage and continue from the written table."""
    write_features(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_scores(scored: DataFrame, path: str, key: str, score: str, label: str = "TARGET") -> str:
    """Write ``(key, label = score)`` as headed CSV."""
    return write_features(scored.select(key, F.col(score).alias(label)), path, "csv")


def write_report(rows: DataFrame, path: str) -> str:
    """Write a small per-feature report as one headed CSV file."""
    return write_features(rows.coalesce(1), path, "csv")
