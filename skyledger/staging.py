"""Tables written to the cluster's shared folder.

A written table cuts the lineage of a long plan and outlives any executor. The
folder is the one the cluster names in ``spark.checkpoint.dir``; only a local
session without that setting gets a folder of its own.
"""

from __future__ import annotations

import atexit
import contextlib
import itertools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Written tables are read a few times at most and stay on disk for a whole run.
CODEC = "zstd"

_LOCAL_FOLDERS: dict[str, str] = {}
_OPEN: set[StagingArea] = set()


@atexit.register
def release_all() -> None:
    """Delete the folders of all runs whose results can no longer be read: at the end of the program."""
    for area in list(_OPEN):
        with contextlib.suppress(Exception):  # the session may have ended first
            area.release()


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL_FOLDERS.setdefault(
        context.applicationId, "file:" + tempfile.mkdtemp(prefix="skyledger-")
    )


class StagingArea:
    """One run's folder of written tables."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_folder(spark)}/skyledger-{uuid.uuid4().hex}"
        self._number = itertools.count()
        _OPEN.add(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{next(self._number):03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a scan of what was written."""
        path = self.path(name)
        df.write.parquet(path, compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete the folder once nothing reads from it any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        _OPEN.discard(self)

    def __enter__(self) -> "StagingArea":
        return self

    def __exit__(self, *exc) -> None:
        self.release()
