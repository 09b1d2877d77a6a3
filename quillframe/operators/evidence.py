"""Runtime evidence: merging, attaching, summaries, growth and plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillframe.functions.columns import percent
from quillframe.sources.model import EVIDENCE_KEY, EVIDENCE_STATUSES

SUMMARY_KEYS = ("status", "reason", "provider", "endpoint_host", "dependency_class")


def with_key(df: DataFrame, columns: tuple[str, ...] = EVIDENCE_KEY, prefix: str = "k_") -> DataFrame:
    """``df`` with the evidence key, missing values as empty."""
    return df.select("*", *(F.coalesce(F.col(c), F.lit("")).alias(f"{prefix}{c}") for c in columns))


def latest(evidence: DataFrame, order: list[str], columns: tuple[str, ...] = EVIDENCE_KEY, keep: list[str] | None = None) -> DataFrame:
    """One row per evidence key: the last by ``order``, which should be total; of its columns those in
    ``keep`` (all). An aggregate, not a window: each task keeps one row per key, so a key with many
    rows is no hot partition."""
    keyed = with_key(evidence, columns)
    keys = [f"k_{c}" for c in columns]
    best = keyed.groupBy(*keys).agg(F.max_by(F.struct(*(keep or evidence.columns)), F.struct(*order)).alias("e"))
    return best.select("e.*") if keep is None else best.select(*keys, "e")


def merge_evidence(batches: list[DataFrame], order: str = "verified_at", columns: tuple[str, ...] = EVIDENCE_KEY) -> DataFrame:
    """All batches in input order, the last per key kept: by ``order``, then batch, then ordinal."""
    tagged = [b.withColumn("batch", F.lit(k)) for k, b in enumerate(batches)]
    merged = reduce(lambda a, b: a.unionByName(b), tagged)
    return latest(merged, [order, "batch", "ordinal"], columns)


def merged_summary(batches: list[DataFrame], merged: DataFrame, limits: list[int]) -> DataFrame:
    """One row: the merged report's limit (the sum of its batches' limits), the rows read, and counts of
    ``merged`` anew: in all and by status."""
    read = reduce(lambda a, b: a.unionAll(b), [b.agg(F.count("*").alias("n")) for b in batches]).agg(F.sum("n").alias("rows_read"))
    counts = merged.agg(F.count("*").alias("total"), *status_counts())
    return counts.join(read).withColumn("limit", F.lit(sum(limits)).cast("long"))


def attach_evidence(
    deps: DataFrame, evidence: DataFrame, order: list[str], columns: tuple[str, ...] = EVIDENCE_KEY, keep: list[str] | None = None
) -> DataFrame:
    """``deps`` with the evidence of its key as the struct ``evidence`` (null if there is none), which has
    the columns in ``keep`` (all): only these are shuffled and joined."""
    last = latest(evidence, order, columns, keep or evidence.columns)
    last = last.select(*(F.col(f"k_{c}").alias(f"e_{c}") for c in columns), F.col("e").alias("evidence"))
    keyed = with_key(deps, columns, "d_")
    joined = keyed.join(last, [F.col(f"d_{c}") == F.col(f"e_{c}") for c in columns], "left")
    return joined.select(*deps.columns, "evidence")


def uncovered(candidates: DataFrame, evidence: DataFrame, columns: tuple[str, ...] = EVIDENCE_KEY) -> DataFrame:
    """Candidates whose key has no evidence."""
    known = with_key(evidence, columns, "e_").select(*(f"e_{c}" for c in columns))
    keyed = with_key(candidates, columns, "d_")
    return keyed.join(known, [F.col(f"d_{c}") == F.col(f"e_{c}") for c in columns], "left_anti").select(*candidates.columns)


def status_counts(status: str = "status") -> list[Column]:
    """Counts of each evidence status."""
    return [F.count_if(F.col(status) == s).alias(s) for s in EVIDENCE_STATUSES]


def grouped_counts(df: DataFrame, keys: tuple[str, ...], limit: int = 0) -> DataFrame:
    """(grouping, value, n, place) for each key on its own: null values dropped, count descending,
    then value; the first ``limit`` of each, 0 for all. One scan and one shuffle for all keys."""
    values = F.explode(F.array(*(F.struct(F.lit(k).alias("grouping"), F.col(k).cast("string").alias("value")) for k in keys)))
    counts = df.select(values.alias("g")).select("g.*").where("value is not null").groupBy("grouping", "value").agg(F.count("*").alias("n"))

    ranked = counts.withColumn("place", F.row_number().over(Window.partitionBy("grouping").orderBy(F.desc("n"), "value")))
    return ranked.where(F.col("place") <= limit) if limit else ranked


def verification_summary(results: DataFrame, keys: tuple[str, ...] = SUMMARY_KEYS, limit: int = 0) -> DataFrame:
    """``grouped_counts`` of the results, and their total under the grouping ``total``."""
    total = results.agg(F.count("*").alias("n")).select(
        F.lit("total").alias("grouping"), F.lit("").alias("value"), "n", F.lit(1).alias("place")
    )
    return grouped_counts(results, keys, limit).unionByName(total)


def evidence_growth(operations: Column, evidence: Column, target_percent: float) -> list[Column]:
    """Columns percent, target, remaining and state of evidence against a target share of operations."""
    tenths = round(target_percent * 10)
    target = F.ceil(operations * tenths / 1000)
    return [
        percent(evidence, operations).alias("evidence_percent"),
        target.alias("target"),
        F.greatest(F.lit(0), target - evidence).cast("long").alias("remaining"),
        F.when(evidence < target, "below").when(evidence == target, "at").otherwise("above").alias("state"),
    ]


def verification_plan(candidates: DataFrame, evidence: DataFrame, batch: Column, batch_size: int) -> DataFrame:
    """Per batch: candidates, those without evidence, and how many of them the next run takes."""
    left = uncovered(candidates, evidence).select(batch.alias("batch"), F.lit(0).alias("c"), F.lit(1).alias("u"))
    every = candidates.select(batch.alias("batch"), F.lit(1).alias("c"), F.lit(0).alias("u"))
    out = every.unionAll(left).where("batch is not null").groupBy("batch").agg(F.sum("c").alias("candidates"), F.sum("u").alias("uncovered"))
    return out.withColumn("planned", F.least(F.col("uncovered"), F.lit(batch_size).cast("long")))


def planned_by_kind(plan: DataFrame, kind: Column) -> DataFrame:
    """Planned operations per kind of batch."""
    return plan.groupBy(kind.alias("kind")).agg(F.sum("planned").alias("planned"))


ROLLUP_TOTALS = ("evidence_total", "verified", "failed", "skipped", "unknown", "blocking_count", "warning_count")


def rollup_sources(plans: DataFrame) -> DataFrame:
    """A row per source of ``plans`` (source_id, provider, evidence_total, verified, failed, skipped,
    unknown, next_action_count, blockers and warnings: arrays of struct<id, severity>): its counts and its sorted ids."""
    ids = lambda c: F.array_sort(F.transform(c, lambda x: x["id"]))
    return plans.select(
        "source_id", "provider", "evidence_total", "verified", "failed", "skipped", "unknown",
        F.size(F.filter("blockers", lambda b: b["severity"] == "blocking")).cast("long").alias("blocking_count"),
        F.size("warnings").cast("long").alias("warning_count"),
        ids("blockers").alias("blocker_ids"),
        ids("warnings").alias("warning_ids"),
        "next_action_count",
    )


def rollup_summary(sources: DataFrame) -> DataFrame:
    """The nine totals over ``rollup_sources``, one row."""
    return sources.agg(
        F.count("*").alias("sources"),
        F.count_if(F.col("evidence_total") == 0).alias("sources_without_evidence"),
        *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ROLLUP_TOTALS),
    )


def rollup_index(sources: DataFrame) -> DataFrame:
    """(kind, id, n, source_ids) of every blocker and warning in ``rollup_sources``: the inverted index."""
    sides = [sources.select(F.lit(k).alias("kind"), F.explode(c).alias("id"), "source_id") for k, c in (("blocker", "blocker_ids"), ("warning", "warning_ids"))]
    return sides[0].unionAll(sides[1]).groupBy("kind", "id").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list("source_id")).alias("source_ids")
    )


def rollup_warning_gaps(index: DataFrame, warnings: DataFrame) -> DataFrame:
    """(id, problem): warnings of the plans (``rollup_index``) that a rollup's ``warnings`` (warning_id, affected_sources)
    lack or give other sources, and those that no plan has. Sources are compared row by row, in any
    order; a warning listed twice has the sources of both."""
    planned = index.where(F.col("kind") == "warning").select(F.col("id"), F.explode("source_ids").alias("source_id")).distinct()
    listed = warnings.select(F.col("warning_id").alias("id"), F.explode_outer("affected_sources").alias("source_id")).distinct()
    sides = planned.withColumn("p", F.lit(1)).unionByName(listed.withColumn("l", F.lit(1)), allowMissingColumns=True)
    per_source = sides.groupBy("id", "source_id").agg(F.count("p").alias("p"), F.count("l").alias("l"))
    counts = per_source.groupBy("id").agg(F.sum("p").alias("p"), F.sum("l").alias("l"), F.bool_or((F.col("p") != F.col("l")) & F.col("source_id").isNotNull()).alias("differ"))
    problem = F.when(F.col("l") == 0, "missing").when(F.col("p") == 0, "unknown").when(F.col("differ"), "affected_sources")
    return counts.select("id", problem.alias("problem")).where("problem IS NOT NULL")
