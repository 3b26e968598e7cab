"""Session defaults and reliable lineage cutting."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from contextvars import ContextVar
from types import TracebackType

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "ledgerloom", cores: int | str = 8, **conf: str) -> SparkSession:
    """A session for laptops and tests; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # generated projections of several hundred columns exceed the default JIT size limit
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master without that setting falls back to a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{base.rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"


_OPEN: ContextVar[Stages | None] = ContextVar("stages", default=None)


#: Spark's own setting: a query's shuffle files go when it ends, not when the driver happens to collect its garbage
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str, codec: str = "snappy") -> DataFrame:
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_END, "false")
    conf.set(SHUFFLES_END, "true")  # the written rows are all that is needed of this query
    try:
        df.write.mode("errorifexists").parquet(path, compression=codec)
    finally:
        conf.set(SHUFFLES_END, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Cut the lineage of ``df``: write it once to shared storage, continue from there.

    The written table survives lost executors and, unlike a row checkpoint, later
    steps read only the columns they need.  Inside ``Stages`` it goes when they end;
    else it stays, as the caller's result may be read at any later time.
    """
    path = shared_folder(df.sparkSession)
    owner = _OPEN.get()
    if owner is not None:
        owner.paths.append(path)
    return _write(df, path, codec)


def row_keys(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a key (file, place) for each row; rerun tasks and later reads see the same keys.

    Rows read from files are named by file and place, so that nothing is written; other
    rows are numbered and written.
    """
    try:
        return docs.withColumn(name, F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")))
    except AnalysisException:  # not read from files
        return durable(docs.withColumn(name, F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("place"))))


class Stages:
    """Written stages of one job, deleted at its end, also when it fails.

        with Stages(spark) as stages:
            rows = stages.stage("rows", features)
            ...
            result = stages.keep(report)

    ``stage`` gives a table that it has written before again if name, plan and input
    files are the same.  Every ``durable`` table written meanwhile belongs to the stages
    too.  What is needed afterwards is written by ``keep``; it belongs to the enclosing
    stages, if there are any.  Frames that read deleted stages can't be used any more.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []
        self._known: dict[tuple[str, str], DataFrame] = {}

    def __enter__(self) -> Stages:
        self._outer = _OPEN.get()
        self._token = _OPEN.set(self)
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        _OPEN.reset(self._token)
        while self.paths:
            remove(self.spark, self.paths.pop())

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        files = hashlib.sha256("\n".join(sorted(df.inputFiles())).encode()).hexdigest()
        key = name, f"{df.semanticHash()}-{df.schema.simpleString()}-{files}"
        if key not in self._known:
            self._known[key] = durable(df)
        return self._known[key]

    def keep(self, df: DataFrame) -> DataFrame:
        path = shared_folder(self.spark)
        if self._outer is not None:
            self._outer.paths.append(path)
        return _write(df, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write one."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
