"""Folders on whatever file system a path names, through Hadoop's own client."""

import logging
import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

SHARED_DIR_SETTING = "spark.checkpoint.dir"
#: Spark else keeps what a write shuffled until the driver collects its plan as garbage, so
#: that the writes of a job add up on the executors' disks.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _path_and_fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Create the folder if it is missing. Best effort: the stream itself will tell."""
    try:
        hadoop_path, fs = _path_and_fs(spark, path)
        if not fs.exists(hadoop_path):
            fs.mkdirs(hadoop_path)
    except Exception:
        log.warning("could not check or create %s", path, exc_info=True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path_and_fs(spark, path)
    return fs.exists(hadoop_path)


def matching_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with ``*`` for any one name."""
    hadoop_path, fs = _path_and_fs(spark, pattern)
    return [str(status.getPath()) for status in fs.globStatus(hadoop_path) or ()]


def files_and_bytes(spark: SparkSession, pattern: str) -> tuple[int, int]:
    """Number and size of all files below the folders, counted by the file system."""
    hadoop_path, fs = _path_and_fs(spark, pattern)
    found = [fs.getContentSummary(s.getPath()) for s in fs.globStatus(hadoop_path) or ()]
    return sum(f.getFileCount() for f in found), sum(f.getLength() for f in found)


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path_and_fs(spark, path)
    if not fs.delete(hadoop_path, True) and fs.exists(hadoop_path):
        raise OSError(f"could not delete {path}")


@contextmanager
def set_for_now(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session that hold inside the block only."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def new_shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    It lies under the cluster's ``spark.checkpoint.dir``. Only where that is unset on a
    single machine is it a local temporary folder; on a cluster that is an error.
    """
    shared = spark.conf.get(SHARED_DIR_SETTING, None)
    if not shared:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"{SHARED_DIR_SETTING} must name a folder all executors share")
        return tempfile.mkdtemp(prefix=f"{purpose}-")
    folder = f"{shared.rstrip('/')}/{purpose}-{uuid4().hex}"
    ensure_folder(spark, folder)
    return folder
