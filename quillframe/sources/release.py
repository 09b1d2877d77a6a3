"""Released reports: sorted files behind an envelope and a manifest, and the check of what was released."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.functions.columns import first_true

#: What a manifest says of a file.
MANIFEST = "path string, bytes long, records long, digest string"
#: Words of 32 bits in a sha256.
_WORDS = 8


def scan_records(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, records, digest) of all files of lines below ``root``, read as a stream: a file may be of any
    size, a line must fit into a row.

    The digest is the sha256 of the number of lines and of the sums of their sha256, word by word: blocks of one
    file are summed by several tasks. It doesn't tell the order of the lines; a repeated or missing
    one shows. Paths are those below ``root``; files without lines have no row.
    """
    base = root.rstrip("/") + "/"
    lines = spark.read.option("recursiveFileLookup", True).text(root)
    files = digests(lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), "value"), ["path", "bytes"])
    return files.select(F.substring_index("path", base, -1).alias("path"), "bytes", "records", "digest")


def digests(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, records, digest) of lines (keys, value); see ``scan_records``."""
    words = [F.conv(F.substring("sha", 8 * k + 1, 8), 16, 10).cast("long").alias(f"w{k}") for k in range(_WORDS)]
    sums = lines.select(*keys, F.sha2("value", 256).alias("sha")).select(*keys, *words).groupBy(*keys).agg(F.count("*").alias("records"), *(F.sum(f"w{k}").alias(f"w{k}") for k in range(_WORDS)))
    return sums.select(*keys, "records", F.sha2(F.concat_ws(",", "records", *(f"w{k}" for k in range(_WORDS))), 256).alias("digest"))


def write_release(df: DataFrame, path: str, part: Column, order_by: list[str], envelope: dict[str, str]) -> None:
    """``df`` as JSON lines in ``path``/records, a folder for each value of ``part`` and sorted by ``order_by``; a manifest of its
    files in ``path``/manifest; in ``path``/envelope a row with the strings of ``envelope`` and the release's own totals
    (files, records, bytes). The manifest is taken from the files, not from ``df``.

    Rows are dealt by ranges of part and order, so a part of any size is several files. An empty ``df`` has an empty
    manifest. ``part`` is a column of its own and not in the records.
    """
    spark = df.sparkSession
    keyed = df.withColumn("__part", part).repartitionByRange("__part", *order_by).sortWithinPartitions("__part", *order_by)
    keyed.withColumnRenamed("__part", "part").write.partitionBy("part").json(f"{path}/records")
    scan_records(spark, f"{path}/records").coalesce(1).sortWithinPartitions("path").write.json(f"{path}/manifest")
    totals = _totals(manifest(spark, path))
    totals.select(*(F.lit(v).alias(k) for k, v in envelope.items()), "*").coalesce(1).write.json(f"{path}/envelope")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a release: a row a file."""
    return spark.read.schema(MANIFEST).json(f"{path}/manifest")


def envelope(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """The envelope of a release: one row of ``fields`` and totals."""
    return spark.read.schema(", ".join([f"{f} string" for f in fields] + ["files long", "records long", "bytes long"])).json(f"{path}/envelope")


def records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The records of a release, with their ``part``."""
    return spark.read.schema(schema).json(f"{path}/records")


def _totals(files: DataFrame) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return files.agg(F.count("*").alias("files"), total("records"), total("bytes"))


def verify_release(spark: SparkSession, path: str) -> DataFrame:
    """(path, problem) of every file of a release that isn't as its manifest says - missing, unlisted, size, records or
    digest - and of an envelope whose totals aren't the manifest's (a row with an empty path). None: the release is whole."""
    listed = manifest(spark, path)
    found = scan_records(spark, f"{path}/records").toDF("f_path", "f_bytes", "f_records", "f_digest")
    both = listed.join(found, F.col("path") == F.col("f_path"), "full_outer")
    problem = first_true(
        (F.col("f_path").isNull(), "missing_artifact"),
        (F.col("path").isNull(), "unlisted"),
        (F.col("records") != F.col("f_records"), "record_count_mismatch"),
        (F.col("digest") != F.col("f_digest"), "checksum_mismatch"),
        (F.col("bytes") != F.col("f_bytes"), "size_mismatch"),
    )
    files = both.select(F.coalesce("path", "f_path").alias("path"), problem.alias("problem")).where("problem IS NOT NULL")
    names = ["files", "records", "bytes"]
    row = lambda df: df.select(F.struct(*names).alias("t"))
    differ = row(_totals(listed)).exceptAll(row(envelope(spark, path, [])))
    return files.unionAll(differ.select(F.lit("").alias("path"), F.lit("envelope_totals_mismatch").alias("problem")))
