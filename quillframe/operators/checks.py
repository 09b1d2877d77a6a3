"""Constraints of tables; every violation becomes a row (rule, row_key, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions.columns import first_true

# Row constraints: (rule, whether a row violates it). Null values violate only ``required``.


def required(c: str) -> tuple[str, Column]:
    return f"required {c}", F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) == 0


def one_of(c: str, values: tuple[str, ...]) -> tuple[str, Column]:
    return f"one_of {c}", ~F.col(c).isin(*values)


def matches(c: str, pattern: str) -> tuple[str, Column]:
    return f"matches {c}", ~F.col(c).rlike(pattern)


def between(c: str, low: float, high: float) -> tuple[str, Column]:
    return f"between {c}", ~F.col(c).between(low, high)


def unique_items(c: str, least: int = 0) -> tuple[str, Column]:
    return f"unique_items {c}", (F.size(F.array_distinct(c)) != F.size(c)) | (F.size(c) < least)


def sums_to(parts: list[str], total: str) -> tuple[str, Column]:
    return f"sums_to {total}", reduce(lambda a, b: a + b, (F.coalesce(F.col(p), F.lit(0)) for p in parts)) != F.col(total)


def business(rule: str, violated: Column) -> tuple[str, Column]:
    """Any rule of its own; ``violated`` says which rows break it."""
    return rule, violated


def source_scope(rule: str, scope: Column, same: dict[str, str]) -> tuple[str, Column]:
    """A plan of one source speaks of that source alone: the columns named in ``same`` equal those of
    the plan. Plans of release scope are exempt."""
    differs = reduce(lambda a, b: a | b, (~F.col(own).eqNullSafe(F.col(plan)) for own, plan in same.items()))
    return rule, ~scope.eqNullSafe("release") & differs


def check(df: DataFrame, key: Column, constraints: list[tuple[str, Column]]) -> DataFrame:
    """All violations of row constraints, in one pass over ``df``."""
    found = F.explode(F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(rule)) for rule, bad in constraints))))
    return df.select(key.cast("string").alias("row_key"), found.alias("rule"))


def unique_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    key = F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    return df.groupBy(key.alias("row_key")).agg(F.count("*").alias("n")).where("n > 1")


def foreign_key(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, both_ways: bool = False) -> DataFrame:
    """(row_key, problem): children without a parent and, if asked, parents without a child."""
    c, p = child.select(F.col(child_key).alias("k")).distinct(), parent.select(F.col(parent_key).alias("k")).distinct()
    out = c.join(p, "k", "left_anti").select(F.col("k").cast("string").alias("row_key"), F.lit("no parent").alias("problem"))
    if both_ways:
        out = out.unionAll(p.join(c, "k", "left_anti").select(F.col("k").cast("string").alias("row_key"), F.lit("no child").alias("problem")))
    return out.where("row_key is not null")


def unknown_columns(df: DataFrame, allowed: list[str]) -> list[str]:
    """Columns that the contract doesn't have, in order."""
    return [c for c in df.columns if c not in allowed]


def reconcile(expected: DataFrame, actual: DataFrame, fields: list[str]) -> DataFrame:
    """(field, expected, actual) of the fields in which two one-row summaries differ."""
    def long(df: DataFrame, name: str) -> DataFrame:
        rows = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(name)) for f in fields)))
        return df.select(rows.alias("x")).select("x.*")

    return long(expected, "expected").join(long(actual, "actual"), "field").where(~F.col("expected").eqNullSafe(F.col("actual")))


IDENTITY = ("source_id", "provider")


def identity_mismatches(reports: DataFrame, profiles: DataFrame, on: str = "source_profile") -> DataFrame:
    """The rows of ``reports`` (``on``, source_id, provider) that name no profile, or one of another
    source or provider, with ``problem``: no_profile, or what differs."""
    p = profiles.select(F.col(on).alias("profile_key"), *(F.col(c).alias(f"profile_{c}") for c in IDENTITY))
    found = F.array_join(F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"profile_{c}")), F.lit(c)) for c in IDENTITY))), ",")
    joined = reports.join(p, F.col(on) == F.col("profile_key"), "left")
    problem = F.when(F.col("profile_key").isNull(), "no_profile").otherwise(found)
    return joined.withColumn("problem", problem).where("problem <> ''").select(*reports.columns, "problem")


def verify_artifacts(manifest: DataFrame, actual: DataFrame, listed: int | None = None) -> DataFrame:
    """(path, problem) for each path of a manifest (path, bytes, sha256) or a scan that isn't as it should be.

    With ``listed``, the manifest's own count of its artifacts, a row with an empty path and
    ``artifact_count_mismatch`` says that it has more or fewer.
    """
    m = manifest.groupBy("path").agg(F.count("*").alias("n"), F.max("bytes").alias("m_bytes"), F.max("sha256").alias("m_sha"))
    a = actual.select(F.col("path").alias("a_path"), F.col("bytes").alias("a_bytes"), F.col("sha256").alias("a_sha"))
    both = m.join(a, F.col("path") == F.col("a_path"), "full_outer")
    problem = first_true(
        (F.col("path") == "", "invalid_path"),
        (F.col("n") > 1, "duplicate_artifact_path"),
        (~F.col("m_sha").rlike("^[a-f0-9]{64}$"), "invalid_checksum"),
        (F.col("m_bytes") < 0, "invalid_size"),
        (F.col("a_path").isNull(), "missing_artifact"),
        (F.col("path").isNull(), "unlisted"),
        (F.col("m_bytes") != F.col("a_bytes"), "size_mismatch"),
        (F.col("m_sha") != F.col("a_sha"), "checksum_mismatch"),
    )
    out = both.select(F.coalesce("path", "a_path").alias("path"), problem.alias("problem")).where("problem is not null")
    if listed is None:
        return out
    count = manifest.agg(F.count("*").alias("n")).where(F.col("n") != listed)
    return out.unionAll(count.select(F.lit("").alias("path"), F.lit("artifact_count_mismatch").alias("problem")))


def readiness(gates: DataFrame) -> DataFrame:
    """One row: passing gates, warnings, failures, and whether all required ones pass.

    A gate (gate, required, expected, actual, exact) passes if actual reaches expected, or equals
    it where ``exact`` holds.
    """
    passed = F.coalesce(F.when(F.col("exact"), F.col("actual") == F.col("expected")).otherwise(F.col("actual") >= F.col("expected")), F.lit(False))
    return gates.withColumn("passed", passed).agg(
        F.count("*").alias("gates"),
        F.count_if("passed").alias("passing"),
        F.count_if(~F.col("passed") & ~F.col("required")).alias("warnings"),
        F.count_if(~F.col("passed") & F.col("required")).alias("failures"),
        F.bool_and(F.col("passed") | ~F.col("required")).alias("ready"),
    )


def missing_actions(
    changes: DataFrame,
    name: str,
    required_actions: dict[str, str],
    grew: Column,
    category: str | None = None,
    automation: dict[str, str] | None = None,
    registry_only: bool = False,
    idle: tuple[str, ...] = (),
) -> DataFrame:
    """(row_key, rule) where a growth needs exactly one change ``name`` with an action for each target.

    Further rules, each where it is asked for: the change's ``category``; the ``automation`` of a target's
    action; ``registry_only``: neither promoted nor served (nulls are neither false nor true, so they
    break the rule); ``idle`` targets, whose action must be ``no_action``. Of several actions of one
    target the last counts. Without the change, only its being missing is reported beside its actions.
    """
    own = changes.where(F.col("change_id") == name)
    last = lambda t: F.try_element_at(F.filter("actions", lambda a: a["target"] == t), F.lit(-1))
    rules = {f"action for {t}": F.coalesce(last(t)["action"] == a, F.lit(False)) for t, a in sorted(required_actions.items())}
    rules |= {f"automation of {t}": F.coalesce(last(t)["automation"] == a, F.lit(False)) for t, a in sorted((automation or {}).items())}
    rules |= {f"no action for {t}": F.coalesce(last(t)["action"] == "no_action", F.lit(False)) for t in sorted(idle)}
    if category is not None:
        rules["category"] = F.col("category").eqNullSafe(F.lit(category))
    if registry_only:
        rules["registry only"] = F.coalesce(~F.col("promoted") & ~F.col("served"), F.lit(False))
    counts = own.agg(F.count("*").alias("n"), *(F.coalesce(F.bool_or(met), F.lit(False)).alias(f"has_{k}") for k, met in enumerate(rules.values())))
    found = [business("exactly one change", F.col("n") != 1)] + [business(rule, ~F.col(f"has_{k}")) for k, rule in enumerate(rules)]
    return check(counts.where(grew), F.lit(name), found)
