"""Working folders for intermediate tables.

Intermediate results that several later steps read are written as Parquet below the
shared folder named by ``spark.checkpoint.dir``, so they outlive any lost executor and
come back with real file sizes for the planner.
"""

from __future__ import annotations

import atexit
import contextlib
import itertools
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it, else one in the default
    file system."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = fs.FileSystem.get(hadoop)
    alone = spark.sparkContext.master.startswith("local")
    if files.getUri().getScheme() == "file" and not alone:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return files.makeQualified(fs.Path("/tmp/inspectstar")).toString()


class Scratch:
    """A private folder holding the intermediate tables of one build.

    The folder is deleted when the application ends, or at the end of a ``with`` block;
    frames that read from it must be consumed before that. Its name holds the application's
    id: what a crash leaves behind can be told from the folders of running applications.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        app = spark.sparkContext.applicationId
        self.root = f"{shared_folder(spark)}/inspectstar-{app}-{uuid.uuid4().hex}"
        self._ids = itertools.count()
        self._hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        self._paths = spark.sparkContext._jvm.org.apache.hadoop.fs
        atexit.register(self._discard)

    def path(self, label: str) -> str:
        return f"{self.root}/{next(self._ids):03d}-{label}"

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` once and return a scan of what was written."""
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self) -> None:
        atexit.unregister(self._discard)
        path = self._paths.Path(self.root)
        path.getFileSystem(self._hadoop).delete(path, True)

    def _discard(self) -> None:
        with contextlib.suppress(Py4JError, OSError):  # the JVM may be gone already
            self.delete()

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_exc) -> None:
        self.delete()
