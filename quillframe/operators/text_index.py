"""An inverted index of trigrams for searches of any part of a text.

``texts`` holds each row's folded text and the columns kept with it, in buckets by the hash of its
key; ``postings`` a row for each distinct trigram of a text (a text of one or two characters is its
own), in segments: what a task reads of the texts is one file, sorted by the trigrams' hash ``code``, so that a
filter reads few pages of each and postings are never shuffled; ``grams`` how many
texts have each. A search reads the postings of its rarest trigrams, keeps the keys that have all,
reads the buckets of those and looks at their texts, so what it costs follows what it finds. Queries of one or
two characters look for the trigrams that hold them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.functions.grams import GRAM, grams, grams_or_whole
from quillframe.sources.shared import settings

BUCKETS = 256
#: Bytes of texts in their files that make a segment, or more where a row group has more; each becomes some fifty times as many in postings.
SEGMENT = 4 << 20
#: Trigrams of a query whose postings are read.
RAREST = 6


def write_text_index(rows: DataFrame, path: str, key: str, fields: list[str], keep: list[str] | None = None, buckets: int = BUCKETS) -> None:
    """Writes the index of ``rows`` under ``path``: of their ``fields``, joined by line ends, in lower case.

    ``key`` names a row; rows without one are left out, of a repeated key all rows are found. The
    columns ``keep`` are returned by searches.
    """
    folded = F.lower(F.concat_ws("\n", *fields))
    kept = F.struct(*keep) if keep else F.lit(None).cast("string")
    texts = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), folded.alias("text"), kept.alias("kept"), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"))
    texts.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/texts")
    spark = rows.sparkSession
    written = spark.read.schema(texts.schema).parquet(f"{path}/texts")
    with settings(spark, files__maxPartitionBytes=SEGMENT, files__openCostInBytes=SEGMENT // 32):
        postings = _postings(written).select("gram", "key", F.xxhash64("gram").alias("code")).sortWithinPartitions("code")
        # The bucket follows from the key, so it isn't sorted along.
        postings = postings.select("*", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"))
        postings.write.option("compression", "zstd").parquet(f"{path}/postings")
    counts = spark.read.schema(postings.schema).parquet(f"{path}/postings").groupBy("gram").agg(F.count("*").alias("n"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/grams")


def _postings(texts: DataFrame) -> DataFrame:
    """(key, gram), each once. Only repeated keys can have a gram from several texts, and are shuffled."""
    own = lambda df: df.select("key", F.explode(grams_or_whole(F.col("text"))).alias("gram")).where("gram <> ''")
    repeated = texts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    if repeated.isEmpty():
        return own(texts)
    return own(texts.join(repeated, "key", "left_anti")).unionAll(own(texts.join(repeated, "key", "left_semi")).distinct())


def candidates(spark: SparkSession, path: str, query: str) -> DataFrame | None:
    """(key, bucket) of the rows that may hold ``query``; None if all may."""
    folded, own = spark.range(1).select(F.lower(F.lit(query)), grams(F.lower(F.lit(query)))).first()
    postings, counts = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/grams")
    if not folded:
        return None
    if not own:
        holding = counts.where(F.contains("gram", F.lit(folded))).select("gram")
        return postings.join(holding, "gram", "left_semi").select("key", "bucket").distinct()
    found = sorted((n, g) for g, n in counts.where(F.col("gram").isin(own)).select("gram", "n").collect())  # the query's own
    rarest = [g for _, g in found[:RAREST]] if len(found) == len(own) else []
    codes = [r[0] for r in spark.createDataFrame([(g,) for g in rarest], "g string").select(F.xxhash64("g")).collect()]
    read = postings.where(F.col("code").isin(codes) & F.col("gram").isin(rarest))
    return read.groupBy("key", "bucket").agg(F.count("*").alias("n")).where(F.col("n") == len(rarest)).select("key", "bucket")


def indexed_search(spark: SparkSession, path: str, query: str) -> DataFrame:
    """(key, kept columns) of all rows in whose indexed fields ``query`` occurs, in either case: what a scan of
    all rows finds."""
    texts = spark.read.parquet(f"{path}/texts")
    own = candidates(spark, path, query)
    if own is not None:
        own = own.persist()
        buckets = [r[0] for r in own.select("bucket").distinct().collect()]  # BUCKETS at most
        texts = texts.where(F.col("bucket").isin(buckets)).join(own, ["bucket", "key"], "left_semi").where(F.contains("text", F.lower(F.lit(query))))
    kept = ["kept.*"] if "struct" in dict(texts.dtypes)["kept"] else []
    return texts.select("key", *kept)
