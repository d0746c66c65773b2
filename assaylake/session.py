"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps and ``year()`` must not depend on the cluster's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# per task; a join side whose measured partitions all fit is hashed, not sorted
HASH_JOIN_BYTES = "64m"


def tuned(spark: SparkSession) -> SparkSession:
    """Settings for the load jobs; anything the cluster has set is left alone.

    A merge of few rows into a large history then hashes the incoming rows
    instead of sorting the history. The size is checked at run time.
    """
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    if spark.conf.get(key, "0").rstrip("b") == "0":
        spark.conf.set(key, HASH_JOIN_BYTES)
    return pin_utc(spark)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies in the folder named by ``spark.checkpoint.dir``. Only a local
    master, where driver and executors are one process, may fall back to the
    machine's temporary folder. The folder lives as long as the session: the
    file system removes it when the driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.gettempdir()
    folder = f"{root.rstrip('/')}/assaylake-{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(path)  # only a path that exists can be marked
    fs.deleteOnExit(path)
    return folder


_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, computed once and read back from the scratch folder.

    For intermediate results that a plan uses several times. Nothing is
    recomputed if an executor is lost, and the size is known to the planner.
    The folder stays until ``release`` or the end of the session.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[back] = path
    return back


def release(*frames: DataFrame) -> None:
    """Delete the folders of settled frames that no frame still to be computed reads."""
    for df in frames:
        if folder := _folders.pop(df, None):
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
