"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Rows of a task that are worth a task of their own, and the most that one should hold.
TASK_ROWS, MOST_TASK_ROWS = 10_000, 1_000_000


def get_spark(app_name: str = "clientela", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings the jobs rely on (UTC, AQE with skew handling)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: there the driver
    and the tasks share one disk.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clientela-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_run_folder: str | None = None


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder, inside the run's own folder if there is one."""
    return f"{_run_folder or shared_folder(spark) + '/clientela'}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Keep everything that is materialised meanwhile in one folder, and delete that at the end.

    For jobs whose results are written elsewhere: afterwards no lazy table may still
    read from the folder.
    """
    global _run_folder
    before, _run_folder = _run_folder, f"{shared_folder(spark)}/clientela/run-{uuid.uuid4().hex}"
    try:
        yield _run_folder
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(_run_folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _run_folder = before


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so a lost executor never re-runs what came before, and
    keeps the result columnar so later passes read only the columns they use.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` in even partitions by a hash of ``columns``: one for each core, fewer for few rows, more for very many.

    For tables that are scanned very often: as many tasks as the stored files happen to have splits leave cores
    idle in every scan. Only rows equal in all ``columns`` are bound to one partition. Counts the rows once.
    """
    rows = df.count()
    cores = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.repartition(max(1, cores, -(-rows // MOST_TASK_ROWS)), *columns)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package (what ``--py-files`` does).

    Spark itself distributes the archive to the executors.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="clientela-package-")) / package.name
    spark.sparkContext.addPyFile(
        shutil.make_archive(str(archive), "zip", package.parent, package.name)
    )
    _shipped.add(app)
