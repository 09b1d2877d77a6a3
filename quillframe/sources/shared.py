"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. A local session without one gets a temporary folder, a
    cluster must name one."""
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder; what is there when the driver ends is deleted."""
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


#: For ``settings``: shuffle files go when the write that made them is done, and not when the driver happens to collect its garbage.
FREED = {"classic__shuffleDependency__fileCleanup__enabled": "true"}


@contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Settings of the session by their names below ``spark.sql`` (``__`` for a dot), as they were afterwards. For writes: frames
    made meanwhile shouldn't be handed out."""
    names = {f"spark.sql.{k.replace('__', '.')}": str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once, for several readers."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
