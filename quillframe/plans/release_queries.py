"""Queries of released reports, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.plans.lens import Lens
from quillframe.plans.report_queries import query
from quillframe.sources import release
from quillframe.sources.shared import scratch_path

_LINE = """'{"k":' || CAST(c_custkey AS VARCHAR) || ',"name":"' || c_name || '","segment":"' || c_mktsegment || '"}'"""
_WORDS = ", ".join(f"sum(CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT))" for k in range(8))


@query(f"""WITH l AS (SELECT c_custkey % 8 AS part, sha256({_LINE}) AS h FROM customer WHERE c_custkey % 8 <> 5 OR c_custkey % 3 <> 0)
SELECT CAST(part AS VARCHAR) AS part, count(*) AS records, sha256(concat_ws(',', count(*), {_WORDS})) AS digest, CASE WHEN part = 5 THEN 'missing_artifact,unlisted' ELSE '' END AS problems FROM l GROUP BY part""", views=False)
def released_customers(lens: Lens) -> DataFrame:
    """Customers released in eight parts, one of them replaced afterwards; what each part holds and what the check says of it."""
    path, k = scratch_path(lens.spark), F.col("c_custkey")
    rows = lens.table("customer").select(k.alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    release.write_release(rows, path, F.col("k") % 8, ["k"], {"schema_version": "1"})
    other = rows.where((F.col("k") % 8 == 5) & (F.col("k") % 3 != 0)).withColumn("part", F.col("k") % 8)
    other.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").json(f"{path}/records")
    part = F.regexp_extract("path", "part=([^/]*)/", 1)
    problems = release.verify_release(lens.spark, path).groupBy(part.alias("p")).agg(F.array_join(F.array_sort(F.collect_set("problem")), ",").alias("problems"))
    lines = lens.spark.read.option("recursiveFileLookup", True).text(f"{path}/records").select(F.regexp_extract("_metadata.file_path", "part=([^/]*)/", 1).alias("part"), "value")
    held = release.digests(lines, ["part"])
    return held.join(problems, F.col("part") == F.col("p"), "left").select("part", "records", "digest", F.coalesce("problems", F.lit("")).alias("problems"))
