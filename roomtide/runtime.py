"""Intermediate tables that several later steps read."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_STAGED: dict[str, list[str]] = {}


@functools.lru_cache(maxsize=None)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="roomtide-")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is missing, a single-machine session uses a folder of its own; a
    cluster must name one, because executors cannot see each other's local disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master.startswith("local") and not master.startswith("local-cluster"):
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession) -> str:
    """Name of a fresh folder below ``shared_folder``, known to ``release``."""
    path = f"{shared_folder(spark)}/roomtide-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Later steps scan only the columns they need, see exact sizes, and lose nothing when
    an executor goes away.  ``release`` deletes the tables.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete every table staged by this application; returns their number.

    Call it when no frame that reads them is needed any more.
    """
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(paths)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash ``df`` over all shuffle partitions, whatever its size in bytes.

    For small rows that stand for much work, such as a range about to be exploded: tasks
    sized by bytes would put far too much of that work into one task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys)
