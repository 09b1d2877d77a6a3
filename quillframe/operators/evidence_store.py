"""Evidence that grows by batches, kept in hash buckets of its key.

The store is a Parquet table with one row for each evidence key, bucketed by the key and
partitioned by groups of buckets. A batch is shuffled once, to a table in the same buckets for the time of the merge,
and meets only the groups that its keys fall into: their rows
are joined with the batch's as they lie, without a shuffle, and only these partitions are written
again; the files of all others stay as they are. Shuffle files go as soon as a step is done. Operations are held against the store in the same
way, so the large side of a join is never moved. A merge that fails leaves the store as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillframe.operators.evidence import with_key
from quillframe.sources.model import EVIDENCE_KEY
from quillframe.sources.shared import FREED, settings


def _orderable(kind: T.DataType) -> bool:
    """Whether values of a type can be compared."""
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return isinstance(kind, T.AtomicType) and not isinstance(kind, T.VariantType)


class EvidenceStore:
    """The table ``name`` at ``path``; of ``buckets``, each partition holds ``buckets / parts``."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 256, parts: int = 64, columns: tuple[str, ...] = EVIDENCE_KEY, order: tuple[str, ...] = ("verified_at", "batch", "ordinal")):
        if buckets % parts:
            raise ValueError("buckets must be a multiple of parts")
        self.spark, self.name, self.path, self.buckets, self.parts = spark, name, path, buckets, parts
        self.columns, self.order, self.keys = columns, order, [f"k_{c}" for c in columns]

    def _part(self) -> Column:
        """The group of the key's bucket."""
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets))  # as Spark deals rows to buckets
        return F.floor(bucket / (self.buckets // self.parts)).cast("int")

    def _last(self, batch: DataFrame) -> DataFrame:
        """The last row of each key by ``order``, with the key, missing values as empty, and ``part``. Nothing is
        shuffled twice in a row: the key's texts stand for its columns, and the order is part of the row if it can be."""
        kinds = {f.name: f.dataType for f in batch.schema}
        own = [c for c in self.columns if isinstance(kinds[c], T.StringType)]
        missing = sum((F.when(F.col(c).isNull(), 1 << k).otherwise(0) for k, c in enumerate(own)), F.lit(0)).alias("missing_")
        rest = [c for c in batch.columns if c not in own]
        if all(_orderable(kinds[c]) for c in rest):
            best = F.max(F.struct(*self.order, missing, *(c for c in rest if c not in self.order)))
        else:
            best = F.max_by(F.struct(missing, *rest), F.struct(*self.order))
        last = with_key(batch, self.columns).groupBy(*self.keys).agg(best.alias("e"))
        there = lambda c: F.when(F.col("e.missing_").bitwiseAND(1 << own.index(c)) == 0, F.col(f"k_{c}")) if c in own else F.col(f"e.{c}")
        return last.select(*(there(c).alias(c) for c in batch.columns), *self.keys, self._part().alias("part"))

    def _create(self, rows: DataFrame, name: str, **options: str) -> None:
        """A table of rows of ``_last`` in buckets."""
        rows.write.format("parquet").partitionBy("part").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).options(compression="zstd", **options).saveAsTable(name)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def rows(self) -> DataFrame:
        """What is kept: the columns of the batches and ``batch``, the key as ``k_...``, and ``part``."""
        return self.spark.table(self.name)

    def merge(self, batch: DataFrame, number: int) -> list[int]:
        """Adds a batch: of each key the last row by ``order`` stays, of equal ones the later batch's. Batches
        have the same columns; ``number`` says which comes later. Returns the partitions that were written, ``parts`` at most."""
        # As many partitions as buckets: what groups the batch by key also deals it to the buckets.
        with settings(self.spark, sources__partitionOverwriteMode="dynamic", shuffle__partitions=self.buckets, **FREED):
            new = self._last(batch.withColumn("batch", F.lit(number)))
            if not self.exists():
                self._create(new, self.name, path=self.path)
                return self._parts(self.name)
            taken = f"{self.name}_{uuid.uuid4().hex}"
            try:
                self._create(new, taken)
                touched = self._parts(taken)
                if touched:
                    self._merged(taken, touched).write.mode("overwrite").insertInto(self.name)
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {taken}")
        self.spark.catalog.refreshTable(self.name)
        return touched

    def _parts(self, name: str) -> list[int]:
        return sorted(r[0] for r in self.spark.table(name).select("part").distinct().collect())

    def _merged(self, taken: str, touched: list[int]) -> DataFrame:
        """The partitions ``touched`` of the store with the rows of the table ``taken``."""
        old, new = self.rows().where(F.col("part").isin(touched)), self.spark.table(taken)
        names = [c for c in old.columns if c not in (*self.keys, "part")]
        a = old.select(*self.keys, F.struct(*names).alias("old"), F.struct(*self.order).alias("old_at"))
        b = new.select(*self.keys, F.struct(*names).alias("new"), F.struct(*self.order).alias("new_at"))
        stays = F.col("new").isNull() | (F.col("old_at") > F.col("new_at"))
        last = a.join(b, self.keys, "full_outer").select(*self.keys, F.when(stays, F.col("old")).otherwise(F.col("new")).alias("e"))
        return last.select("*", "e.*", self._part().alias("part")).select(*old.columns)

    def _matched(self, df: DataFrame, side: DataFrame, how: str) -> DataFrame:
        keyed = with_key(df, self.columns, "d_")
        return keyed.join(side, [F.col(f"d_{c}") == F.col(f"k_{c}") for c in self.columns], how)

    def attach(self, deps: DataFrame, keep: list[str]) -> DataFrame:
        """``deps`` with the kept evidence of its key as the struct ``evidence``, null if there is none."""
        side = self.rows().select(*self.keys, F.struct(*keep).alias("evidence"))
        return self._matched(deps, side, "left").select(*deps.columns, "evidence")

    def uncovered(self, candidates: DataFrame) -> DataFrame:
        """Candidates whose key has no evidence."""
        return self._matched(candidates, self.rows().select(*self.keys), "left_anti").select(*candidates.columns)
