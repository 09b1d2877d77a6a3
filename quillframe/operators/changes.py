"""Snapshot differences, change impact, error rules and reference drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions.columns import digest, first_true, has_all, template_placeholders
from quillframe.functions.grams import GRAM, grams

SERVED_TARGETS = ("dataset-api", "sdk", "mcp")
#: The kinds of references, and the parts of the contract that a change of each touches.
REFERENCE_IMPACTS = {
    "homepage_url": ["source_identity"],
    "api_docs_url": ["catalogue", "auth", "runtime"],
    "key_request_url": ["auth"],
    "notice_url": ["notice", "runtime"],
    "terms_url": ["terms"],
    "metadata_standard_url": ["metadata_standard"],
}


def with_digest(specs: DataFrame, columns: list[str]) -> DataFrame:
    """``specs`` with ``digest``, the hash of ``columns`` in the order of their names."""
    return specs.withColumn("digest", digest(*(F.col(c) for c in sorted(columns))))


def diff_specs(old: DataFrame, new: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """(key, change, fields, old_digest, new_digest): added, removed, changed or stable, and which columns differ."""
    a = with_digest(old, columns).select(F.col(key).alias("old_key"), F.col("digest").alias("old_digest"), F.struct(*columns).alias("o"))
    b = with_digest(new, columns).select(F.col(key).alias("new_key"), F.col("digest").alias("new_digest"), F.struct(*columns).alias("n"))
    both = a.join(b, F.col("old_key") == F.col("new_key"), "full_outer")
    fields = F.array_compact(F.array(*(F.when(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")), F.lit(c)) for c in sorted(columns))))
    change = first_true(
        (F.col("old_key").isNull(), "added"), (F.col("new_key").isNull(), "removed"), (F.col("old_digest") != F.col("new_digest"), "changed"), otherwise="stable"
    )
    out = both.select(F.coalesce("old_key", "new_key").alias(key), change.alias("change"), "old_digest", "new_digest", fields.alias("fields"))
    return out.withColumn("fields", F.when(F.col("change") == "changed", F.array_join("fields", ",")).otherwise(""))


def set_diff(expected: DataFrame, actual: DataFrame, column: str) -> DataFrame:
    """(value, side): names that only one side has; repeated names count as often as they are repeated."""
    a, b = expected.select(column), actual.select(column)
    sides = [x.exceptAll(y).select(F.col(column).alias("value"), F.lit(side).alias("side")) for x, y, side in ((a, b, "missing"), (b, a, "extra"))]
    return sides[0].unionAll(sides[1])


def changed_keys(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that both sides have with different values."""
    x, y = a.select(key, F.col(value).alias("left_value")), b.select(key, F.col(value).alias("right_value"))
    return x.join(y, key).where(~F.col("left_value").eqNullSafe(F.col("right_value")))


# Error rules

#: Rules that are broadcast at most. A rule catalogue is written by hand; a larger one is refused
#: rather than joined row by row with all results.
MAX_RULES = 10_000
#: Kinds of rules that a result's reason names.
REASON_KINDS = ("timeout", "dns_error", "tls_error", "parse_error")
#: Columns of a result and the scope of a rule that each is held against.
SCOPES = {"host": "hosts", "dataset_id": "dataset_ids", "operation": "operation_ids", "cls": "dependency_classes"}


def _folded(rule: dict[str, Column], text: Column) -> Column:
    """``text`` as a rule reads it: in either case, unless the rule is case sensitive."""
    return F.when(F.coalesce(rule["case_sensitive"], F.lit(False)), text).otherwise(F.lower(text))


def in_scope(result: dict[str, Column], rule: dict[str, Column]) -> Column:
    """Whether every scope of a rule that isn't null or empty lists what the result has."""
    out = F.lit(True)
    for column, scope in SCOPES.items():
        listed = rule[scope]
        out = out & (listed.isNull() | (F.size(listed) == 0) | F.coalesce(F.array_contains(listed, result[column]), F.lit(False)))
    return out


#: Results from which it is learned how frequent parts of texts are; that decides how fast rules are matched, and nothing else.
SAMPLE_RESULTS = 10_000
#: Kinds of rules that look for a part of a text, and the letter of their keys.
PART_KINDS = {"message_contains": "m", "field_contains": "f"}


def _part_keys(letter: str, text: Column, sizes: list[int]) -> Column:
    """Keys of all parts of a text of the sizes given; size 0 is any text."""
    none = F.array().cast("array<string>")

    def of_size(q: int) -> Column:
        if q == 0:
            return F.when(text.isNotNull(), F.array(F.lit(f"{letter}0 "))).otherwise(none)
        return F.transform(grams(text, q), lambda g: F.concat(F.lit(f"{letter}{q} "), g))

    return F.concat(none, *map(of_size, sizes))


def _result_parts(letter: str, sizes: list[int]) -> Column:
    """The part keys of a result's message (m) or of all its fields (f); capital letters keep capitals apart."""
    fold = F.lower if letter.islower() else lambda text: text
    if letter in "mM":
        return _part_keys(letter, fold(F.col("message")), sizes)
    values = F.coalesce(F.map_values("fields"), F.array().cast("array<string>"))
    return F.flatten(F.transform(values, lambda v: _part_keys(letter, fold(v), sizes)))


def _rule_keys(results: DataFrame, rules: DataFrame, kind: Column, rule: dict[str, Column]) -> tuple[DataFrame, Column]:
    """``rules`` with the one key of each (rule_key), and the array of keys of a result."""
    exact = F.coalesce(rule["case_sensitive"], F.lit(False))
    letter = F.create_map(*(F.lit(x) for kv in PART_KINDS.items() for x in kv))[kind]
    needle = F.when(exact, rule["contains"]).otherwise(F.lower(rule["contains"]))
    size = F.least(F.length(needle), F.lit(GRAM))
    every_rule = rules.select("rule_row", F.when(exact, F.upper(letter)).otherwise(letter).alias("letter"), size.alias("q"), needle.alias("needle"))
    rows = every_rule.select("letter", "q").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    used: dict[str, set[int]] = {}
    for r in rows:
        if r["letter"] is not None and r["q"] is not None:
            used.setdefault(r["letter"], set()).add(r["q"])
    parts = every_rule.where("letter is not null and q is not null")
    own = [_result_parts(x, sorted(sizes)) for x, sizes in sorted(used.items())]
    named = (kind == "field_equals") & rule["field"].isNotNull()
    other = first_true(
        (kind == "http_status", F.concat(F.lit("status "), rule["http_status"].cast("string"))),
        (kind.isin(*REASON_KINDS), F.concat(F.lit("reason "), kind)),
        (named, F.concat(F.lit("field "), F.lower(rule["value"]), F.lit(" "), rule["field"])),
        (kind == "field_equals", F.concat(F.lit("value "), F.lower(rule["value"]))),
        (kind == "unknown", F.lit("any")),
    )
    entries = F.map_entries(F.coalesce("fields", F.create_map().cast("map<string,string>")))
    keys = F.array_compact(
        F.concat(
            F.array(F.lit("any"), F.concat(F.lit("status "), F.col("http_status").cast("string")), F.concat(F.lit("reason "), "reason")),
            F.transform(entries, lambda e: F.concat(F.lit("field "), F.lower(e["value"]), F.lit(" "), e["key"])),
            F.transform(entries, lambda e: F.concat(F.lit("value "), F.lower(e["value"]))),
            *own,
        )
    )
    if not used:
        return rules.withColumn("rule_key", other).where("rule_key is not null"), keys
    # Of a rule's parts the one that the fewest results of the sample have.
    every = F.when(F.col("q") == 0, F.array(F.lit(""))).otherwise(first_true(*((F.col("q") == q, grams(F.col("needle"), q)) for q in range(1, GRAM + 1))))
    spread = parts.select("rule_row", F.explode(F.transform(every, lambda g: F.concat("letter", F.col("q").cast("string"), F.lit(" "), g))).alias("part"))
    seen = results.limit(SAMPLE_RESULTS).select(F.explode(F.array_distinct(F.concat(*own))).alias("part")).groupBy("part").agg(F.count("*").alias("seen"))
    rarest = spread.join(seen, "part", "left").groupBy("rule_row").agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "part")).alias("x")).select("rule_row", F.col("x.part").alias("part"))
    return rules.join(rarest, "rule_row", "left").withColumn("rule_key", F.coalesce(other, "part")).where("rule_key is not null"), keys


def match_error_rules(results: DataFrame, rules: DataFrame) -> DataFrame:
    """Every (result_id, rule_id, classification) of results and rules that fit.

    ``results``: result_id, host, dataset_id, operation, cls, http_status, reason, message, fields
    (map of strings: what the provider's reply says). ``rules``: rule_id, hosts, dataset_ids,
    operation_ids, dependency_classes, kind, http_status, field, value, contains, case_sensitive,
    classification. A scope that is null or empty admits all. field_equals compares ``value``,
    field_contains and message_contains look for ``contains``; a null one fits nothing.

    Each rule has one key, and results are hashed by their keys in one pass: a status, a reason, a field's
    value, or three characters of a text (fewer, where a rule looks for fewer). A rule that looks for
    a part of a text has the rarest three of it as its key; what meets there is tested in full.
    """
    r = rules.select(*(F.col(c).alias(f"rule_{c}") for c in rules.columns)).withColumn("rule_row", F.monotonically_increasing_id())
    result = {c: F.col(c) for c in (*SCOPES, "message", "fields")}
    rule = {c: F.col(f"rule_{c}") for c in rules.columns}
    kind = rule["kind"]
    keyed, keys = _rule_keys(results, r, kind, rule)
    fields = F.coalesce(F.map_values(result["fields"]), F.array().cast("array<string>"))
    values = F.when(rule["field"].isNull(), fields).otherwise(F.array(F.try_element_at(result["fields"], rule["field"])))
    part = _folded(rule, rule["contains"])
    holds = first_true(
        (kind == "message_contains", F.contains(_folded(rule, result["message"]), part)),
        (kind == "field_contains", F.exists(values, lambda v: F.contains(_folded(rule, v), part))),
        (kind == "field_equals", F.exists(values, lambda v: _folded(rule, v) == _folded(rule, rule["value"]))),
        otherwise=F.lit(True),
    )
    met = results.withColumn("rule_key_", F.explode(F.array_distinct(keys))).join(
        F.broadcast(keyed), (F.col("rule_key_") == F.col("rule_key")) & in_scope(result, rule) & F.coalesce(holds, F.lit(False))
    )
    return met.select("result_id", F.col("rule_rule_id").alias("rule_id"), F.col("rule_classification").alias("classification"))


def unmatched(results: DataFrame, matches: DataFrame) -> DataFrame:
    """Results that no rule fits."""
    return results.join(matches.select("result_id").distinct(), "result_id", "left_anti")


def rule_flags(rules: DataFrame) -> DataFrame:
    """(rule_id, blocking, manual, unknown) of rules with status, severity, classification and actions (automation)."""
    some = lambda v: F.exists("actions", lambda a: a["automation"] == v)
    blocking = (F.col("status") == "blocked") | (F.col("severity") == "blocking") | some("blocked")
    flags = rules.select("rule_id", blocking.alias("blocking"), some("manual_review").alias("m"), (F.col("classification") == "unknown").alias("unknown"))
    return flags.select("rule_id", "blocking", (~F.col("blocking") & F.col("m")).alias("manual"), "unknown")


def rule_summary(rules: DataFrame) -> DataFrame:
    """Rules in all, blocking, for manual review, unknown, and ids that occur more than once."""
    flags = rule_flags(rules)
    out = flags.agg(F.count("*").alias("rules"), *(F.count_if(c).alias(c) for c in ("blocking", "manual", "unknown")))
    twice = flags.groupBy("rule_id").count().where("count > 1").agg(F.count("*").alias("duplicate_ids"))
    return out.join(twice)


# Impact


def impact_actions(changes: DataFrame) -> DataFrame:
    """One row per change and action."""
    return changes.select("*", F.explode("actions").alias("a")).select(*changes.columns, "a.target", "a.action", "a.automation").drop("actions")


def impact_summary(changes: DataFrame) -> DataFrame:
    """(metric, value, n): changes in all and by category, and actions by target, for manual review
    (or blocked), for a database review, and that regenerate what is served. One change counts as
    often as it has such actions."""
    actions = impact_actions(changes)
    served = F.col("target").isin(*SERVED_TARGETS) & (F.col("action") == "regenerate")
    flags = actions.agg(
        F.count_if(F.col("automation").isin("manual_review", "blocked")).alias("manual"),
        F.count_if(F.col("action") == "db_migration_review").alias("database"),
        F.count_if(served).alias("served"),
    )

    def grouped(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(name).isNotNull()).groupBy(F.lit(name).alias("metric"), F.col(name).alias("value")).agg(F.count("*").alias("n"))

    total = changes.agg(F.lit("total").alias("metric"), F.lit("").alias("value"), F.count("*").alias("n"))
    long = F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.lit("").alias("value"), F.col(c).alias("n")) for c in flags.columns)))
    return total.unionByName(flags.select(long.alias("x")).select("x.*")).unionByName(grouped(changes, "category")).unionByName(grouped(actions, "target"))


def common_value(column: str, fallback: str) -> Column:
    """Aggregate: the one value of ``column``; ``fallback`` for none or several."""
    return F.when(F.min(column).eqNullSafe(F.max(column)), F.coalesce(F.min(column), F.lit(fallback))).otherwise(fallback)


#: Columns of a source's plan that a rollup keeps where all sources agree.
COMMON_COLUMNS = ("library_version", "registry_version_from", "registry_version_to")


def rolled_changes(plans: DataFrame) -> DataFrame:
    """The changes of all sources' plans (path, changes) with their source's path and their place in it."""
    rest = [c for c in plans.columns if c != "changes"]
    return plans.select(*rest, F.posexplode("changes").alias("place", "c")).select(*rest, "place", "c.*")


def impact_rollup(plans: DataFrame) -> DataFrame:
    """(metric, value, n) over all sources' plans (path, generated_at, ``COMMON_COLUMNS``, changes):
    ``impact_summary`` of the union of their changes, the number of plans, the latest generated_at
    and the columns on which all plans agree (``mixed`` otherwise)."""
    summary = impact_summary(rolled_changes(plans))
    head = plans.agg(F.count("*").alias("plans"), F.max("generated_at").cast("string").alias("generated_at"), *(common_value(c, "mixed").alias(c) for c in COMMON_COLUMNS))
    rows = [F.struct(F.lit("plans").alias("metric"), F.lit("").alias("value"), F.col("plans").alias("n"))] + [
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"), F.lit(None).cast("long").alias("n")) for c in ("generated_at", *COMMON_COLUMNS)
    ]
    return head.select(F.explode(F.array(*rows)).alias("x")).select("x.*").unionByName(summary)


# References


def _urls(kinds: list[str]) -> Column:
    return F.filter(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("url")) for k in kinds)), lambda x: x["url"].isNotNull())


def profile_references(profiles: DataFrame) -> DataFrame:
    """(source_id, kind, url, reviewed_at) from wide profiles with one column for each kind of
    reference; nulls and other columns dropped."""
    kinds = sorted(k for k in REFERENCE_IMPACTS if k in profiles.columns)
    return profiles.select("source_id", F.explode(_urls(kinds)).alias("r"), "reviewed_at").select("source_id", "r.kind", "r.url", "reviewed_at")


def official_urls(profiles: DataFrame) -> DataFrame:
    """(source_id, urls): the distinct values of every ``*_url`` column of each source, sorted; an
    empty list for a source without any."""
    kinds = sorted(c for c in profiles.columns if c.endswith("_url"))
    return profiles.select("source_id", F.array_sort(F.array_distinct(F.transform(_urls(kinds), lambda x: x["url"]))).alias("urls"))


def drift_status(status: Column, final_url: Column, url: Column, content_hash: Column | None = None, previous_hash: Column | None = None) -> Column:
    """How a fetched reference compares: not found before other errors; with two hashes, changed content counts."""
    cases: list[tuple[Column, str | Column]] = [
        (status.isNull(), "error"),
        (status.isin(404, 410), "missing"),
        (status >= 400, "error"),
        (final_url.isNotNull() & (final_url != "") & (final_url != url), "redirected"),
    ]
    if content_hash is not None and previous_hash is not None:
        cases.append((content_hash != previous_hash, "changed"))
    return first_true(*cases, otherwise="unchanged")


def reference_impact(kind: Column) -> Column:
    """The contracts that a change of a reference touches."""
    impacts = F.create_map(*(x for k, v in REFERENCE_IMPACTS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    return F.coalesce(F.try_element_at(impacts, kind), F.array(F.lit("unknown")))


def drift_summary(references: DataFrame) -> DataFrame:
    """Counts over references with ``drift`` (null: not fetched) and ``impacts``. A reference that
    was fetched counts as checked, errors included."""
    drift = F.col("drift")
    touching = drift.isin("changed", "redirected", "missing") & ~F.array_contains("impacts", "unknown")
    return references.agg(
        F.count("*").alias("references"),
        F.count_if(drift.isNotNull()).alias("checked"),
        F.count_if(drift.isin("changed", "redirected")).alias("changed"),
        F.count_if(drift == "missing").alias("missing"),
        F.count_if(touching).alias("contract_affecting"),
        F.count_if(drift.isin("missing", "error")).alias("failures"),
    )


def compare_references(report: DataFrame, profiles: DataFrame) -> DataFrame:
    """(source_id, kind, problem): references that one side lacks, or whose URL differs."""
    a = profile_references(profiles).select(F.col("source_id").alias("s1"), F.col("kind").alias("k1"), F.col("url").alias("u1"))
    b = report.select(F.col("source_id").alias("s2"), F.col("kind").alias("k2"), F.col("url").alias("u2"))
    both = a.join(b, (F.col("s1") == F.col("s2")) & (F.col("k1") == F.col("k2")), "full_outer")
    problem = first_true((F.col("s2").isNull(), "missing"), (F.col("s1").isNull(), "extra"), (~F.col("u1").eqNullSafe(F.col("u2")), "changed"))
    return both.select(F.coalesce("s1", "s2").alias("source_id"), F.coalesce("k1", "k2").alias("kind"), problem.alias("problem")).where("problem is not null")


# Source readiness


def required_blockers(profiles: DataFrame) -> DataFrame:
    """(source_id, blocker): what keeps a source from having evidence; six independent tests.

    ``profiles``: verification_mode, adapter_status, capabilities, auth_type, sample_param_policy,
    evidence_total, materialized, taxonomy_status. A null counts as not the value asked for.
    """
    is_ = lambda c, v: F.coalesce(F.col(c) == v, F.lit(False))
    able = has_all(F.array(F.lit("verification"), F.lit("call")), F.col("capabilities"))
    tests = [
        (is_("verification_mode", "metadata_only"), "metadata_only_verification"),
        (~is_("adapter_status", "registered") | ~able, "adapter_not_registered"),
        (~is_("auth_type", "none"), "credential_required"),
        (is_("sample_param_policy", "manual"), "sample_parameters_not_pinned"),
        (is_("evidence_total", 0) & ~F.coalesce("materialized", F.lit(False)), "runtime_catalog_not_materialized"),
        (~is_("taxonomy_status", "verified"), "source_specific_error_taxonomy_pending"),
    ]
    found = F.explode(F.array_compact(F.array(*(F.when(t, F.lit(b)) for t, b in tests))))
    return profiles.select("source_id", found.alias("blocker"))


#: Warnings that a plan must have because of a blocker it lists. Fixed values.
BLOCKER_WARNINGS = {
    "adapter_not_registered": "source_runtime_adapter_not_registered",
    "sample_parameters_not_pinned": "source_runtime_manual_samples_unpinned",
    "source_specific_error_taxonomy_pending": "source_runtime_error_taxonomy_pending",
}
NO_EVIDENCE_WARNING = "non_data_runtime_evidence_not_collected"


def required_warnings(plans: DataFrame) -> DataFrame:
    """(source_id, warning) that plans (source_id, evidence_total, blockers: array of ids) must list."""
    listed = lambda b: F.coalesce(F.array_contains("blockers", b), F.lit(False))
    cases = [F.when(listed(b), F.lit(w)) for b, w in BLOCKER_WARNINGS.items()]
    cases.append(F.when(F.col("evidence_total") == 0, F.lit(NO_EVIDENCE_WARNING)))
    return plans.select("source_id", F.explode(F.array_compact(F.array(*cases))).alias("warning"))


def missing_ids(plans: DataFrame, profiles: DataFrame) -> DataFrame:
    """(source_id, kind, id): required blockers and warnings that a plan (source_id, evidence_total,
    blockers, warnings: arrays of ids) doesn't list. ``profiles`` as for ``required_blockers``; a
    plan's own blockers decide which warnings it needs."""
    def lacking(required: DataFrame, kind: str, column: str) -> DataFrame:
        listed = plans.select("source_id", F.explode(column).alias("id"))
        own = plans.select("source_id").distinct()
        rows = required.toDF("source_id", "id").join(own, "source_id", "left_semi").join(listed, ["source_id", "id"], "left_anti")
        return rows.select("source_id", F.lit(kind).alias("kind"), "id")

    return lacking(required_blockers(profiles), "blocker", "blockers").unionAll(lacking(required_warnings(plans), "warning", "warnings"))


def attach_plan_batches(plans: DataFrame, candidates: DataFrame) -> DataFrame:
    """Plans (source_id, provider) with the number of their candidates, whether providers agree, and
    whether they are materialised: candidates, but no evidence yet."""
    batches = candidates.groupBy(F.col("source_id").alias("batch_source")).agg(
        F.count("*").alias("candidates"), F.count_if(F.col("has_evidence")).alias("evidence"), F.min("provider").alias("p1"), F.max("provider").alias("p2")
    )
    out = plans.join(batches, plans["source_id"] == batches["batch_source"], "left")
    agrees = F.coalesce((F.col("p1") == F.col("provider")) & (F.col("p2") == F.col("provider")), F.lit(True))
    n, e = F.coalesce("candidates", F.lit(0)), F.coalesce("evidence", F.lit(0))
    return out.select("source_id", n.alias("candidates"), e.alias("evidence"), agrees.alias("agrees"), ((n > 0) & (e == 0)).alias("materialized"))


def candidate_problems(candidates: DataFrame, profiles: DataFrame) -> DataFrame:
    """(source_id, candidate_id, problem): where a candidate disagrees with its source's profile.

    ``candidates``: source_id, candidate_id, method, format, endpoint_template, credential_required,
    key_names, injection_location, evidence_status, promotion_status. ``profiles``: source_id,
    methods, formats, auth_type, key_parameter_names, key_locations, sample_param_policy.
    Candidates of unknown sources have the one problem ``no_profile``.
    """
    p = profiles.select("source_id", *(F.col(c).alias(f"p_{c}") for c in ("methods", "formats", "auth_type", "key_parameter_names", "key_locations", "sample_param_policy")), F.lit(True).alias("known"))
    empty = F.array().cast("array<string>")
    allows = lambda allowed, value: F.coalesce(F.array_contains(allowed, value), F.lit(False))
    names = F.array_sort(F.coalesce("p_key_parameter_names", empty))
    location = F.coalesce(F.try_element_at("p_key_locations", F.lit(1)), F.lit("none"))
    needs = ~F.coalesce(F.col("p_auth_type") == "none", F.lit(False))
    in_path = has_all(names, template_placeholders(F.col("endpoint_template")))
    tests = [
        (~F.coalesce(F.col("p_sample_param_policy").isin("static", "catalogue_sample", "generated"), F.lit(False)), "sample_policy_not_pinned"),
        (~allows(F.col("p_methods"), F.col("method")), "method"),
        (~allows(F.col("p_formats"), F.col("format")), "format"),
        (~F.col("credential_required").eqNullSafe(needs), "credential_required"),
        (F.array_sort(F.coalesce("key_names", empty)) != names, "key_names"),
        (~F.col("injection_location").eqNullSafe(location), "injection_location"),
        ((location == "path") & ~in_path, "path_placeholders"),
        (~F.col("evidence_status").eqNullSafe("not_collected"), "evidence_status"),
        (~F.col("promotion_status").eqNullSafe("registry_only"), "promotion_status"),
    ]
    problems = F.when(F.col("known").isNull(), F.array(F.lit("no_profile"))).otherwise(F.array_compact(F.array(*(F.when(t, F.lit(n)) for t, n in tests))))
    return candidates.join(p, "source_id", "left").select("source_id", "candidate_id", F.explode(problems).alias("problem"))


def candidate_summary(candidates: DataFrame) -> DataFrame:
    """Candidates, those with pinned sample parameters, and ids that occur more than once."""
    out = candidates.agg(F.count("*").alias("candidates"), F.count_if(F.coalesce(F.size("sample_parameters") > 0, F.lit(False))).alias("pinned"))
    return out.join(candidates.groupBy("candidate_id").count().where("count > 1").agg(F.count("*").alias("duplicate_ids")))
