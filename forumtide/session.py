"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "forumtide", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the settings this library is tuned for.

    Partition counts are left to adaptive execution; pass ``conf`` to override.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers on other machines, or started from another folder, cannot import it otherwise.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="spark-", dir="/tmp")) / package.name
    archive = shutil.make_archive(str(base), "zip", root_dir=package.parent, base_dir=package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    The cluster names it. A fresh local folder is used only for a local master
    that names none, which is how the tests run.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            return existing
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the executors")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, noted for :func:`clear_scratch`."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this process stored below the shared folder.

    Call it when the results that read those tables have been written or collected.
    """
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    For a frame several later steps use: its lineage is cut there and a lost executor does
    not bring it back. Its stored size is exact, so a small one is broadcast by Spark's own
    threshold and a large one is joined by shuffle; a reduced side stored this way spares
    the large side a shuffle on a skewed key. This runs a job.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete what :func:`materialize` stored, once nothing reads the frame any more."""
    spark = frame.sparkSession
    for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
