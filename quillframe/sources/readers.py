"""Readers and writers: catalogue JSON, enveloped reports, released files, unions of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.sources import model


def read_specs(spark: SparkSession, path: str, schema: str = model.SPECS) -> DataFrame:
    """A JSON array of nested specs. What is no object becomes a row with ``_corrupt_record``.

    A multi-line JSON file is one task; ``json_arrays.read_json_array`` reads large ones in several.
    """
    return spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def quarantined(df: DataFrame) -> DataFrame:
    """The rows that could not be read as records."""
    return df.where(F.col("_corrupt_record").isNotNull())


def read_report(spark: SparkSession, path: str, array_field: str, record: str) -> DataFrame:
    """The records of the array ``array_field`` of enveloped reports, with ``report_path`` and ``ordinal``.

    ``path`` may be a wildcard; ``record`` is the record's schema as DDL.
    """
    read = spark.read.schema(f"{array_field} array<struct<{_struct(record)}>>").option("multiLine", True).json(path)
    rows = read.select(F.col("_metadata.file_path").alias("report_path"), F.posexplode(array_field).alias("ordinal", "record"))
    return rows.select("record.*", "report_path", "ordinal")


def _struct(ddl: str) -> str:
    """Column DDL as fields of a struct type."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).simpleString().removeprefix("struct<").removesuffix(">")


def read_source_reports(spark: SparkSession, pattern: str, array_field: str, record: str, own_output: str = "") -> DataFrame:
    """The records of every source's report but ``own_output``; an error if there is no other report. Reports
    without records are reports."""
    rows = read_report(spark, pattern, array_field, record)
    if own_output and all(f.endswith(own_output) for f in rows.inputFiles()):
        raise ValueError(f"no report but the output matches {pattern}")
    return rows.where(~F.endswith("report_path", F.lit(own_output))) if own_output else rows


def scan_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, sha256) of all files below ``root``. Spark lists no empty files; a file must fit
    into a task's memory."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_report(df: DataFrame, path: str, order_by: list[str], small: bool = False) -> None:
    """Writes rows in a stable order: JSON in one file for a ``small`` report, else sorted Parquet."""
    if small:
        df.coalesce(1).sortWithinPartitions(*order_by).write.json(path)
    else:
        df.orderBy(*order_by).write.parquet(path)


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources' rows, by column name, with their ``source_id``; missing columns are null."""
    tagged = [df.withColumn("source_id", F.lit(name)) for name, df in sorted(sources.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
