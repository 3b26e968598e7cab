"""Query registration."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from catalog.compare import features_sql, fixed, fixed_features, r
from catalog.roles import BASE, base_table, role, role_sql
from ledgerloom.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Benchmark tables and credit roles by name."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return base_table(self.spark, self.sf_dir, name) if name in BASE else role(self.spark, self.sf_dir, name)

    def scratch(self) -> str:
        """A new folder that all executors can reach."""
        return shared_folder(self.spark)


def query(sql: str | None = None, rnd: str = "", keys: str = ""):
    """Register a query; ``rnd`` columns (or all but ``keys``) are rounded on both sides."""
    rounded, key_list = rnd.split(), keys.split()

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(Tables(spark, sf_dir))
            if key_list:
                return fixed_features(df, key_list)
            return fixed(df, *rounded) if rounded else df

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = _round_sql(sql, rounded, key_list)
        return fn

    return register


def _round_sql(sql: str, rounded: Sequence[str], keys: Sequence[str]) -> str:
    if keys:
        return features_sql(sql, keys)
    if rounded:
        return f"select * replace ({', '.join(r(f'\"{c}\"', c) for c in rounded)}) from ({sql})"
    return sql


S = role_sql
