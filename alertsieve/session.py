"""SparkSession helpers shared by tests, bench and the entry module."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "alertsieve",
              shuffle_partitions: int | None = None) -> SparkSession:
    """The active session as it is, or a new local one for tests and bench.

    An existing session belongs to its owner: none of its settings is changed."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        cpus = os.environ.get("BENCH_CPUS", "8")
        spark = (
            SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", "16g")
            .getOrCreate()
        )
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """All tasks run inside this driver process (``local[...]``, not ``local-cluster``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``, registered with Spark.

    Where the setting is missing, a local master gets a scratch folder; any other master
    is an error, since executors would each write to a disk of their own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not is_local(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="alertsieve-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


#: Folders written by this process, by application.
_FOLDERS: dict[str, list[str]] = {}


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder name inside the shared folder, remembered for ``clear_run_folders``."""
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _hadoop_path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whichever store the path names."""
    target, fs = _hadoop_path(spark, path)
    return bool(fs.exists(target))


def _text_of(spark: SparkSession, statuses) -> str:
    """File statuses as text, in one call."""
    return spark.sparkContext._jvm.scala.runtime.ScalaRunTime.stringOf(statuses)


def file_marks(spark: SparkSession, path: str) -> str:
    """Path, length and modification time of a file, or of the files of a folder and its direct
    sub-folders, as one text: it changes when a table is written again, also under the same names."""
    target, fs = _hadoop_path(spark, path)
    seen = _text_of(spark, fs.globStatus(target))
    if "isDirectory=true" in seen:
        for pattern in ("*", "*/*"):
            inner = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, pattern)
            seen += _text_of(spark, fs.globStatus(inner))
    return re.sub(r"access_time=\d+", "", seen)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file; its folders are made."""
    target, fs = _hadoop_path(spark, path)
    fs.create(target, False).close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly inside a folder, in order; none where there is no such folder."""
    target, fs = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder and what is in it; whether it was there."""
    target, fs = _hadoop_path(spark, path)
    return bool(fs.delete(target, True))


def clear_run_folders(spark: SparkSession) -> int:
    """Delete the folders that ``run_folder`` named for this application, and only those.

    For the end of a job: DataFrames and streams that read them can't be used afterwards."""
    gone = 0
    for path in _FOLDERS.pop(spark.sparkContext.applicationId, []):
        target, fs = _hadoop_path(spark, path)
        gone += bool(fs.delete(target, True))
    return gone
