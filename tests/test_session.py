"""Written stages: named, reused by plan and input, deleted at the end."""

import os
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.skew import global_positions
from ledgerloom.session import SHUFFLES_END, Stages, durable, shared_folder


@pytest.fixture
def folder(monkeypatch, tmp_path):
    shared = tmp_path / "shared"
    os.makedirs(shared)
    monkeypatch.setattr("ledgerloom.session.shared_folder", lambda spark: f"file://{shared}/{uuid.uuid4().hex}")
    return shared


def test_stages_go_at_the_end_and_results_stay(spark, folder):
    with Stages(spark) as stages:
        rows = stages.stage("rows", spark.range(100).withColumn("x", F.col("id") % 7))
        placed = global_positions(rows, ["x", "id"])
        assert len(os.listdir(folder)) == 2
        result = stages.keep(placed.where("position < 3"))
    assert len(os.listdir(folder)) == 1
    assert sorted(tuple(r) for r in result.select("position", "id").collect()) == [(0, 0), (1, 7), (2, 14)]


def test_stages_go_after_an_error(spark, folder):
    with pytest.raises(ZeroDivisionError), Stages(spark) as stages:
        stages.stage("rows", spark.range(5))
        durable(spark.range(6))
        assert len(os.listdir(folder)) == 2
        1 / 0  # noqa: B018
    assert os.listdir(folder) == []
    durable(spark.range(3))
    assert len(os.listdir(folder)) == 1, "outside of stages a table stays"


def test_equal_plans_over_equal_files_are_written_once(spark, folder, tmp_path):
    source = f"{tmp_path}/in"
    spark.range(10).write.parquet(source)
    with Stages(spark) as stages:
        a = stages.stage("a", spark.read.parquet(source).where("id > 3"))
        assert stages.stage("a", spark.read.parquet(source).where("id > 3")) is a
        assert stages.stage("b", spark.read.parquet(source).where("id > 3")) is not a
        assert stages.stage("a", spark.read.parquet(source).where("id > 4")) is not a
        assert stages.stage("a", spark.read.parquet(source).where("id > 3").withColumnRenamed("id", "x")) is not a
        spark.range(5, 9).write.mode("append").parquet(source)
        again = stages.stage("a", spark.read.parquet(source).where("id > 3"))
        assert (a.count(), again.count()) == (6, 10)
        assert len(os.listdir(folder)) == 5


def test_kept_results_belong_to_the_stages_around(spark, folder):
    with Stages(spark) as outer:
        with Stages(spark) as inner:
            kept = inner.keep(inner.stage("x", spark.range(4)))
        assert kept.count() == 4 and len(os.listdir(folder)) == 1
        durable(spark.range(2))
        assert len(outer.paths) == 2
    assert os.listdir(folder) == []


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Elsewhere:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

        class sparkContext:  # noqa: N801
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Elsewhere)


def test_durable_leaves_no_shuffle_files(spark):
    folder = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    files = lambda: {f.name for f in folder.rglob("shuffle_*.data")}
    before = files()
    rows = durable(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):  # they go in the background
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and rows.count() == 7
    assert spark.conf.get(SHUFFLES_END) == "false"
