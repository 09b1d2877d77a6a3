"""Differences of large snapshots by digests of blocks.

A snapshot's index has a row for each record: its key, the digest of its canonical form and half of one of
each field, which tells what has changed in a record that did. Rows lie in buckets by the hash of their key, a Parquet partition each. Above them is a
tree of nodes: how many records a bucket has and the sum of their digests, then the same for every
``FANOUT`` buckets, up to one root. Two indexes are compared from the root: below a node that is
equal on both sides nothing is read. Only the buckets that differ are joined, so a difference costs
what has changed and not what there is. Sums don't depend on the order of rows, and equal rows add
up instead of cancelling out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.functions.canonical import canonical_column, column_text, nested_digest
from quillframe.functions.columns import first_true
from quillframe.sources.shared import FREED, settings

BUCKETS = 4096
FANOUT = 16
#: Bytes of a field's digest that are kept.
FIELD_BYTES = 16
#: Bits of a digest that are summed in one column: 60, so that sums of 10^20 records are exact.
_PIECES = 3


def _pieces(digest: Column) -> list[Column]:
    """A digest of hexadecimal digits as whole numbers, most of it."""
    return [F.conv(F.substring(digest, 15 * k + 1, 15), 16, 10).cast("decimal(38,0)") for k in range(_PIECES)]


def _levels(buckets: int) -> list[int]:
    """Buckets that one node of each level stands for, the root's first."""
    wide = [1]
    while wide[-1] < buckets:
        wide.append(wide[-1] * FANOUT)
    return wide[::-1]


_NODE = ["n", *(f"s{k}" for k in range(_PIECES))]


def _tree(leaves: DataFrame, buckets: int) -> DataFrame:
    """(level, node, n, s0, ...): level 0 is the root; the last has a node for each bucket that has records."""
    levels = _levels(buckets)
    at = F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.floor(F.col("bucket") / wide).cast("int").alias("node")) for k, wide in enumerate(levels))))
    rows = leaves.select(at.alias("at"), *_NODE)
    return rows.groupBy("at.level", "at.node").agg(*(F.sum(c).cast(leaves.schema[c].dataType).alias(c) for c in _NODE))


def write_index(records: DataFrame, path: str, columns: list[str], key: str = "id", buckets: int = BUCKETS, json_columns: tuple[str, ...] = ()) -> None:
    """Writes the index of ``records`` under ``path``: ``rows``, partitioned by bucket, and ``tree``.

    ``columns`` may be nested to any depth. Records without a key are left out; keys should be unique.
    """
    fields = F.concat(*(F.unhex(F.substring(F.sha2(column_text(records, c, json_columns), 256), 1, 2 * FIELD_BYTES)) for c in sorted(columns)))
    rows = records.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.unhex(nested_digest(records, columns, json_columns)).alias("digest"), fields.alias("fields"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int").alias("bucket"),
    )
    with settings(records.sparkSession, **FREED):
        rows.repartition("bucket").sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(f"{path}/rows")
        kept = records.sparkSession.read.schema(rows.schema).parquet(f"{path}/rows")
        whole = F.sha2(F.concat(canonical_column(kept, "key"), F.hex("digest")), 256)
        leaves = kept.groupBy("bucket").agg(F.count("*").alias("n"), *(F.sum(p).alias(p_) for p, p_ in zip(_pieces(whole), _NODE[1:], strict=True)))
        _tree(leaves, buckets).write.partitionBy("level").parquet(f"{path}/tree")


def _read_tree(spark: SparkSession, path: str) -> DataFrame:
    sums = ", ".join(f"{c} decimal(38,0)" for c in _NODE[1:])
    return spark.read.schema(f"node int, n long, {sums}, level int").parquet(f"{path}/tree")


def changed_buckets(spark: SparkSession, old: str, new: str, buckets: int = BUCKETS) -> list[int]:
    """The buckets (of ``buckets``, the most that the driver gets) that aren't equal in two indexes, found from the root down."""
    sides = [_read_tree(spark, p) for p in (old, new)]
    below: list[int] = [0]
    for level in range(len(_levels(buckets))):
        a, b = (s.where((F.col("level") == level) & F.col("node").isin(below)).select("node", F.struct(*_NODE).alias(side)) for s, side in zip(sides, "ab", strict=True))
        differ = a.join(b, "node", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("node")
        found = sorted(r[0] for r in differ.collect())
        if not found:
            return []
        below = [n * FANOUT + k for n in found for k in range(FANOUT)]
    return found


def index_rows(spark: SparkSession, path: str, key_type: str = "string") -> DataFrame:
    """(key, digest, fields, bucket) of an index, ``fields`` with the digests of all columns one behind the other; a filter on ``bucket`` leaves out whole files."""
    return spark.read.schema(f"key {key_type}, digest binary, fields binary, bucket int").parquet(f"{path}/rows")


def diff_indexes(spark: SparkSession, old: str, new: str, columns: list[str], key: str = "id", buckets: int = BUCKETS, stable: bool = True, key_type: str = "string") -> DataFrame:
    """(``key``, change, old_digest, new_digest, fields) of two indexes of the same ``columns``: added, removed, changed and,
    if asked for, stable records; those of equal buckets are listed from one side, without a join."""
    differ = changed_buckets(spark, old, new, buckets)
    both = _both(spark, old, new, differ, key_type, "digest", "fields")
    part = lambda side, k: F.substring(f"{side}.fields", FIELD_BYTES * k + 1, FIELD_BYTES)
    changed = F.concat_ws(",", *(F.when(part("o", k) != part("n", k), c) for k, c in enumerate(sorted(columns))))
    text = lambda digest: F.lower(F.hex(digest))
    out = both.select("key", _change().alias("change"), text("o.digest").alias("old_digest"), text("n.digest").alias("new_digest"), changed.alias("fields"))
    if stable:
        rest = index_rows(spark, old, key_type).where(~F.col("bucket").isin(differ))
        out = out.unionAll(rest.select("key", F.lit("stable"), text("digest"), text("digest"), F.lit("")))
    else:
        out = out.where("change <> 'stable'")
    return out.select(F.col("key").alias(key), "change", "old_digest", "new_digest", F.when(F.col("change") == "changed", F.col("fields")).otherwise("").alias("fields"))


def _change() -> Column:
    return first_true((F.col("o").isNull(), "added"), (F.col("n").isNull(), "removed"), (F.col("o.digest") != F.col("n.digest"), "changed"), otherwise="stable")


def _both(spark: SparkSession, old: str, new: str, differ: list[int], key_type: str, *columns: str) -> DataFrame:
    """(key, o, n) of the buckets ``differ``: the ``columns`` of each side, null where it has no such record."""
    x, y = (index_rows(spark, p, key_type).where(F.col("bucket").isin(differ)).select("bucket", "key", F.struct(*columns).alias(side)) for p, side in ((old, "o"), (new, "n")))
    return x.join(y, ["bucket", "key"], "full_outer")


def diff_counts(spark: SparkSession, old: str, new: str, columns: list[str], buckets: int = BUCKETS, key_type: str = "string") -> DataFrame:
    """One row: added, removed, changed and stable records. Stable ones are counted by the roots, not read; of the others keys and digests are."""
    found = _both(spark, old, new, changed_buckets(spark, old, new, buckets), key_type, "digest").select(_change().alias("change"))
    counts = found.agg(*(F.count_if(F.col("change") == c).alias(c) for c in ("added", "removed", "changed")))
    total = _read_tree(spark, old).where("level = 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return counts.join(total).select("added", "removed", "changed", (F.col("n") - F.col("removed") - F.col("changed")).alias("stable"))


def stale(expected: DataFrame, actual: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows by which a regenerated report and a kept one differ, with the side that has them; repeated rows count.

    Both are read twice: once for the sum of each bucket's digests, which is all that is shuffled, and
    once for the rows of buckets that differ. The list of those is broadcast; it has ``buckets`` numbers at most.
    """
    actual = actual.select(*expected.columns)
    sides = []
    for df in (expected, actual):
        digest = nested_digest(df, df.columns)
        sides.append(df.select("*", digest.alias("digest_")).select("*", F.conv(F.substring("digest_", 46, 15), 16, 10).cast("decimal(20,0)").alias("b_")))
    rows = [s.withColumn("b_", (F.col("b_") % buckets).cast("int")) for s in sides]
    sums = [r.groupBy("b_").agg(F.struct(F.count("*"), *(F.sum(p) for p in _pieces(F.col("digest_")))).alias(side)) for r, side in zip(rows, "xy", strict=True)]
    differ = F.broadcast(sums[0].join(sums[1], "b_", "full_outer").where(~F.col("x").eqNullSafe(F.col("y"))).select("b_"))
    x, y = (r.join(differ, "b_", "left_semi").select(*expected.columns) for r in rows)
    return x.exceptAll(y).withColumn("side", F.lit("regenerated")).unionAll(y.exceptAll(x).withColumn("side", F.lit("kept")))
