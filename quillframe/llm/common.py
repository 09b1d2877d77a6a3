"""Shared helpers: table access, written intermediate tables, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of rows in one Arrow batch, about, where ``small_batches`` was called.
BATCH_BYTES = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as set in ``spark.checkpoint.dir``.

    Only where that is unset on a local master (in tests) a temporary folder is made, once a
    session; on a cluster a folder of one machine would lose what the others write.
    """
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def _path(spark: SparkSession, path: str):
    """(file system, path) of a path, in the JVM."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def written(df: DataFrame, path_list: list | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    This cuts the lineage: a lost executor costs a re-read, not the work before it. The
    path is added to ``path_list`` so that the caller can ``forget`` it; what isn't forgotten
    is deleted when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if path_list is not None:
        path_list.append(path)
    files, at = _path(spark, path)
    files.deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, paths: list) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    while paths:
        files, at = _path(spark, paths.pop())
        files.delete(at, True)


def small_batches(spark: SparkSession) -> None:
    """Lets the session send Python workers ``BATCH_BYTES`` or so at once (passed by one row at most).

    By default that is 10,000 rows or 64 MB. Such a batch of texts takes several times its bytes, in the JVM and
    in the worker, and neither gives back what it once took. The setting stays, since frames run later than
    they are made; a smaller one is left as it is. Results don't depend on it.
    """
    now = spark.conf.get(_BATCH_SETTING, None)
    if not now or not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def is_held_out(id_col: Column, mod: int, held: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``held``; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % mod == held, F.lit(False))


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, root) of each vertex that has an edge; root is the smallest vertex reachable.

    ``edges`` has two long columns, ``a`` and ``b``; rows with a null or a = b count for
    nothing. Large-star and small-star steps alternate until the edges stay the same. Each
    step keeps only minima of a vertex's neighbours (combined before the shuffle), never a
    list of them; the joins are plain equi-joins of written tables, so that Spark broadcasts
    small sides by their size on disk and splits skewed partitions of large ones.
    """
    spark = edges.sparkSession
    old: list = []
    e = written(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        old,
    )

    def signature(df: DataFrame) -> tuple:
        x = df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        return tuple(x)

    before = signature(e)
    while before[0]:
        new: list = []
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(
            e.select(F.col("v").alias("x"), F.col("u").alias("y"))
        )
        least = written(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")), new)
        large = written(
            both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct(), new
        )
        down = written(large.groupBy("u").agg(F.min("v").alias("m")), new)
        small = (
            large.join(down, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(down.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        keep: list = []
        e = written(small, keep)
        after = signature(e)
        forget(spark, old + new)
        old = keep
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
    )
