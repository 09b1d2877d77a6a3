"""Queries of differences, rules, impact, drift, constraints and search, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.functions import columns as C
from quillframe.operators import changes, checks, evidence, reports, search, snapshots, text_index
from quillframe.plans.lens import ORDER, Lens
from quillframe.plans.report_queries import query
from quillframe.sources.shared import scratch_path

# Differences: parts as two snapshots of a registry.

_OLD = "SELECT 'p' || CAST(p_partkey AS STRING) AS id, p_name AS title, p_brand AS organization, p_type AS kind, p_size AS size FROM {part} WHERE p_partkey % 10 <> 3"
_NEW = """SELECT 'p' || CAST(p_partkey AS STRING) AS id, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_name END AS title, p_brand AS organization, p_type AS kind,
  CASE WHEN p_partkey % 7 = 0 THEN p_size + 1 ELSE p_size END AS size FROM {part} WHERE p_partkey % 10 <> 4"""
_FIELDS = ["title", "organization", "kind", "size"]
_SNAPSHOTS = f"WITH old AS ({_OLD.format(part='part')}), new AS ({_NEW.format(part='part')})\n"
_DIGEST = "sha256(concat_ws(',', " + ", ".join(
    f"coalesce(CAST(length(CAST({{a}}.{c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({{a}}.{c} AS VARCHAR), '-')" for c in sorted(_FIELDS)
) + "))"
_CHANGED = ", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END" for c in sorted(_FIELDS))


def _snapshots(lens: Lens) -> tuple[DataFrame, DataFrame]:
    part = lens.table("part")
    return lens.spark.sql(_OLD, part=part), lens.spark.sql(_NEW, part=part)


@query(
    _SNAPSHOTS
    + f"""SELECT id, change, old_digest, new_digest, CASE WHEN change = 'changed' THEN fields ELSE '' END AS fields FROM (
  SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN {_DIGEST.format(a="o")} <> {_DIGEST.format(a="n")} THEN 'changed' ELSE 'stable' END AS change,
    CASE WHEN o.id IS NOT NULL THEN {_DIGEST.format(a="o")} END AS old_digest, CASE WHEN n.id IS NOT NULL THEN {_DIGEST.format(a="n")} END AS new_digest, concat_ws(',', {_CHANGED}) AS fields
  FROM old o FULL JOIN new n ON o.id = n.id)""",
    views=False,
)
def snapshot_diff(lens: Lens) -> DataFrame:
    """J4, P22."""
    return changes.diff_specs(*_snapshots(lens), _FIELDS)


@query(_SNAPSHOTS + "SELECT id AS value, 'missing' AS side FROM (SELECT id FROM old EXCEPT ALL SELECT id FROM new) UNION ALL SELECT id, 'extra' FROM (SELECT id FROM new EXCEPT ALL SELECT id FROM old)", views=False)
def snapshot_names(lens: Lens) -> DataFrame:
    """U2."""
    return changes.set_diff(*_snapshots(lens), "id")


@query(_SNAPSHOTS + "SELECT o.id, o.size AS left_value, n.size AS right_value FROM old o JOIN new n ON o.id = n.id WHERE o.size IS DISTINCT FROM n.size", views=False)
def snapshot_changed_sizes(lens: Lens) -> DataFrame:
    """U3."""
    return changes.changed_keys(*_snapshots(lens), "id", "size")


@query(_SNAPSHOTS + "SELECT *, 'regenerated' AS side FROM (SELECT id, size FROM old EXCEPT ALL SELECT id, size FROM new) UNION ALL SELECT *, 'kept' FROM (SELECT id, size FROM new EXCEPT ALL SELECT id, size FROM old)", views=False)
def stale_rows(lens: Lens) -> DataFrame:
    """C16."""
    old, new = _snapshots(lens)
    return snapshots.stale(old.select("id", "size"), new.select("id", "size"))


@query("""SELECT p_partkey, len(list_distinct(regexp_extract_all(t, '\\{([^{}]+)\\}', 1))) AS n, array_to_string(list_sort(list_distinct(regexp_extract_all(t, '\\{([^{}]+)\\}', 1))), ',') AS placeholders,
  nullif(regexp_extract(f, '^[^.]+\\.(.+)\\.(v[0-9]+)\\.schema\\.json$', 1), '') AS contract, nullif(regexp_extract(f, '^[^.]+\\.(.+)\\.(v[0-9]+)\\.schema\\.json$', 2), '') AS version
FROM (SELECT p_partkey, '/v1/{' || p_brand || '}/items/{id}/{' || p_type || '}/{id}' AS t, 'family.' || lower(p_brand) || CASE WHEN p_size % 9 = 0 THEN '.json' ELSE '.v' || CAST(p_size AS VARCHAR) || '.schema.json' END AS f FROM part)""", views=False)
def endpoint_templates(lens: Lens) -> DataFrame:
    """P13, P14."""
    template = F.concat(F.lit("/v1/{"), "p_brand", F.lit("}/items/{id}/{"), "p_type", F.lit("}/{id}"))
    ending = F.when(F.col("p_size") % 9 == 0, ".json").otherwise(F.concat(F.lit(".v"), F.col("p_size").cast("string"), F.lit(".schema.json")))
    name = F.concat(F.lit("family."), F.lower("p_brand"), ending)
    rows = lens.table("part").select("p_partkey", template.alias("t"), name.alias("f"))
    found = C.template_placeholders(F.col("t"))
    contract, version = C.contract_version(F.col("f"))
    return rows.select("p_partkey", F.size(found).alias("n"), F.array_join(found, ",").alias("placeholders"), contract.alias("contract"), version.alias("version"))


# Error rules over events.

_RESULTS = """SELECT event_id AS result_id, 'api' || CAST(user_id % 5 AS STRING) || '.example' AS host, 'ds' || CAST(user_id % 50 AS STRING) AS dataset_id, 'op' || CAST(event_id % 3 AS STRING) AS operation,
  CASE WHEN user_id % 2 = 0 THEN 'gateway' ELSE 'external_endpoint' END AS cls,
  CASE WHEN event_id % 6 = 0 THEN 404 WHEN event_id % 6 = 1 THEN 200 ELSE 500 END AS http_status, CASE WHEN event_id % 13 = 0 THEN 'timeout' WHEN event_id % 7 = 0 THEN 'parse_error' END AS reason,
  CASE WHEN event_id % 4 = 0 THEN 'E22' WHEN event_id % 4 = 1 THEN '00' END AS code, CASE WHEN event_id % 9 = 0 THEN 'e22' END AS note,
  CASE WHEN event_id % 5 = 0 THEN 'Daily LIMIT exceeded' ELSE event_type END AS message FROM {events}"""
_RULE = "rule_id kind classification status severity automations http_status field value contains case_sensitive hosts dataset_ids operation_ids dependency_classes".split()
_RULES = [
    {"rule_id": "not_found", "kind": "http_status", "http_status": 404, "classification": "not_found", "automations": ["manual_review"]},
    {"rule_id": "gone_gateway", "kind": "http_status", "http_status": 404, "dependency_classes": ["gateway"], "classification": "not_found", "status": "blocked", "automations": ["automated"]},
    {"rule_id": "one_dataset", "kind": "http_status", "http_status": 500, "dataset_ids": ["ds7", "ds8"], "classification": "upstream_outage", "automations": ["automated"]},
    {"rule_id": "one_operation", "kind": "http_status", "http_status": 500, "dataset_ids": ["ds7"], "operation_ids": ["op1"], "classification": "upstream_outage", "automations": []},
    {"rule_id": "quota", "kind": "message_contains", "contains": "limit", "classification": "rate_limit", "severity": "blocking", "automations": ["manual_review"]},
    {"rule_id": "quota_exact", "kind": "message_contains", "contains": "limit", "case_sensitive": True, "classification": "rate_limit", "automations": []},
    {"rule_id": "bad_key", "kind": "field_equals", "field": "resultCode", "value": "e22", "hosts": ["api1.example", "api2.example"], "classification": "credential", "automations": ["blocked"]},
    {"rule_id": "bad_key_exact", "kind": "field_equals", "field": "resultCode", "value": "e22", "case_sensitive": True, "classification": "credential", "automations": []},
    {"rule_id": "any_field", "kind": "field_equals", "value": "E22", "case_sensitive": True, "classification": "credential", "automations": ["manual_review"]},
    {"rule_id": "field_part", "kind": "field_contains", "field": "note", "contains": "E2", "classification": "credential", "automations": ["automated", "manual_review"]},
    {"rule_id": "slow", "kind": "timeout", "classification": "upstream_outage", "automations": ["automated"]},
    {"rule_id": "broken", "kind": "parse_error", "hosts": ["api3.example"], "dependency_classes": ["external_endpoint"], "classification": "unknown", "automations": ["automated"]},
    {"rule_id": "other", "kind": "unknown", "hosts": ["api4.example"], "operation_ids": ["op2"], "classification": "unknown", "automations": ["manual_review"]},
]
_MATCH = f"""WITH r AS ({_RESULTS.format(events="events")}),
m AS (SELECT result_id, 'not_found' AS rule_id, 'not_found' AS classification FROM r WHERE http_status = 404
UNION ALL SELECT result_id, 'gone_gateway', 'not_found' FROM r WHERE http_status = 404 AND cls = 'gateway'
UNION ALL SELECT result_id, 'one_dataset', 'upstream_outage' FROM r WHERE http_status = 500 AND dataset_id IN ('ds7', 'ds8')
UNION ALL SELECT result_id, 'one_operation', 'upstream_outage' FROM r WHERE http_status = 500 AND dataset_id = 'ds7' AND operation = 'op1'
UNION ALL SELECT result_id, 'quota', 'rate_limit' FROM r WHERE contains(lower(message), 'limit')
UNION ALL SELECT result_id, 'quota_exact', 'rate_limit' FROM r WHERE contains(message, 'limit')
UNION ALL SELECT result_id, 'bad_key', 'credential' FROM r WHERE lower(code) = 'e22' AND host IN ('api1.example', 'api2.example')
UNION ALL SELECT result_id, 'bad_key_exact', 'credential' FROM r WHERE code = 'e22'
UNION ALL SELECT result_id, 'any_field', 'credential' FROM r WHERE code = 'E22' OR note = 'E22'
UNION ALL SELECT result_id, 'field_part', 'credential' FROM r WHERE contains(lower(note), 'e2')
UNION ALL SELECT result_id, 'slow', 'upstream_outage' FROM r WHERE reason = 'timeout'
UNION ALL SELECT result_id, 'broken', 'unknown' FROM r WHERE reason = 'parse_error' AND host = 'api3.example' AND cls = 'external_endpoint'
UNION ALL SELECT result_id, 'other', 'unknown' FROM r WHERE host = 'api4.example' AND operation = 'op2')
"""


def _results(lens: Lens) -> DataFrame:
    fields = F.map_filter(F.create_map(F.lit("resultCode"), F.col("code"), F.lit("note"), F.col("note")), lambda k, v: v.isNotNull())
    return lens.spark.sql(_RESULTS, events=lens.spread("events", "event_id")).withColumn("fields", fields)


def _rules(lens: Lens) -> DataFrame:
    schema = (
        "rule_id string, kind string, classification string, status string, severity string, automations array<string>, http_status int, field string, value string, "
        "contains string, case_sensitive boolean, hosts array<string>, dataset_ids array<string>, operation_ids array<string>, dependency_classes array<string>"
    )
    filled = [{"status": "verified", "severity": "medium", "hosts": []} | r for r in _RULES]
    rows = lens.spark.createDataFrame([tuple(r.get(c) for c in _RULE) for r in filled], schema)
    return rows.withColumn("actions", F.transform("automations", lambda a: F.struct(a.alias("automation")))).drop("automations")


def _matches(lens: Lens) -> DataFrame:
    return changes.match_error_rules(_results(lens), _rules(lens).drop("actions", "status", "severity"))


@query(_MATCH + "SELECT * FROM m", views=False)
def error_rule_matches(lens: Lens) -> DataFrame:
    """J7."""
    return _matches(lens)


@query(_MATCH + "SELECT http_status, reason, code, count(*) AS n FROM r WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.result_id = r.result_id) GROUP BY 1, 2, 3", views=False)
def unmatched_signatures(lens: Lens) -> DataFrame:
    """Results without a rule, by signature."""
    return changes.unmatched(_results(lens), _matches(lens)).groupBy("http_status", "reason", "code").agg(F.count("*").alias("n"))


_FLAGS = """f AS (SELECT * FROM (VALUES ('not_found', false, true, false), ('gone_gateway', true, false, false), ('one_dataset', false, false, false), ('one_operation', false, false, false), ('quota', true, false, false),
  ('quota_exact', false, false, false), ('bad_key', true, false, false), ('bad_key_exact', false, false, false), ('any_field', false, true, false), ('field_part', false, true, false), ('slow', false, false, false),
  ('broken', false, false, true), ('other', false, true, true)) f(rule_id, blocking, manual, unknown))"""


@query(f"{_MATCH}, {_FLAGS} SELECT f.rule_id, f.blocking, f.manual, f.unknown, count(m.result_id) AS results FROM f LEFT JOIN m ON m.rule_id = f.rule_id GROUP BY 1, 2, 3, 4", views=False)
def error_rule_use(lens: Lens) -> DataFrame:
    """Each rule's flags and how many results it fits."""
    used = _matches(lens).groupBy("rule_id").agg(F.count("*").alias("results"))
    return changes.rule_flags(_rules(lens)).join(used, "rule_id", "left").withColumn("results", F.coalesce("results", F.lit(0)))


_EVENT_RULES = """SELECT 'r' || CAST(event_id - event_id % 3 * CAST(event_id % 50 = 1 AS INT) AS STRING) AS rule_id, CASE WHEN event_id % 17 = 0 THEN 'blocked' ELSE 'draft' END AS status,
  CASE WHEN event_id % 5 = 0 THEN 'blocking' ELSE 'medium' END AS severity, CASE WHEN event_id % 4 = 0 THEN 'unknown' ELSE 'parser' END AS classification,
  CASE event_id % 7 WHEN 0 THEN 'manual_review' WHEN 1 THEN 'blocked' ELSE 'automated' END AS automation, event_id % 11 = 0 AS reviewed FROM {events}"""


@query(f"""WITH e AS ({_EVENT_RULES.format(events="events")}), x AS (SELECT *, status = 'blocked' OR severity = 'blocking' OR automation = 'blocked' AS blocking FROM e)
SELECT count(*) AS rules, count(*) FILTER (blocking) AS blocking, count(*) FILTER (NOT blocking AND (automation = 'manual_review' OR reviewed)) AS manual, count(*) FILTER (classification = 'unknown') AS unknown,
  (SELECT count(*) FROM (SELECT rule_id FROM e GROUP BY 1 HAVING count(*) > 1)) AS duplicate_ids FROM x""", views=False)
def error_rule_summary(lens: Lens) -> DataFrame:
    """Events as rules."""
    rows = lens.spark.sql(_EVENT_RULES, events=lens.table("events"))
    action = lambda a: F.struct(a.alias("automation"))
    more = F.when(F.col("reviewed"), F.array(action(F.col("automation")), action(F.lit("manual_review"))))
    return changes.rule_summary(rows.withColumn("actions", F.coalesce(more, F.array(action(F.col("automation"))))))


# Impact: customers as changes.

_CHANGES = """SELECT 'c' || CAST(c_custkey AS STRING) AS change_id, 'source' || CAST(c_nationkey % 4 AS STRING) AS source_id, CASE WHEN c_custkey % 40 = 0 THEN 'other' ELSE 'provider' || CAST(c_nationkey % 4 AS STRING) END AS provider,
  c_mktsegment AS category, c_custkey % 3 = 0 AS promoted, c_custkey % 4 = 0 AS served, c_custkey AS k FROM {customer}"""
_ACTIONS = """, acts AS (SELECT change_id, category, promoted, served, k, CASE k % 4 WHEN 0 THEN 'sdk' WHEN 1 THEN 'docs' WHEN 2 THEN 'mcp' ELSE 'dataset-api' END AS target,
  CASE k % 3 WHEN 0 THEN 'regenerate' WHEN 1 THEN 'review' ELSE 'db_migration_review' END AS action, CASE WHEN k % 5 = 0 THEN 'manual_review' WHEN k % 11 = 0 THEN 'blocked' ELSE 'automatic' END AS automation FROM c
  UNION ALL SELECT change_id, category, promoted, served, k, 'sdk', 'regenerate', 'blocked' FROM c WHERE k % 6 = 0 UNION ALL SELECT change_id, category, promoted, served, k, 'registry', 'record', 'automatic' FROM c WHERE k % 2 = 0)
"""
#: One count for every action, as often as a change has it.
_IMPACT = """, i AS (SELECT 'total' AS metric, '' AS value, count(*) AS n FROM c UNION ALL SELECT 'category', category, count(*) FROM c GROUP BY 2 UNION ALL SELECT 'target', target, count(*) FROM acts GROUP BY 2
UNION ALL SELECT 'manual', '', count(*) FROM acts WHERE automation IN ('manual_review', 'blocked') UNION ALL SELECT 'database', '', count(*) FROM acts WHERE action = 'db_migration_review'
UNION ALL SELECT 'served', '', count(*) FROM acts WHERE action = 'regenerate' AND target IN ('dataset-api', 'sdk', 'mcp'))
"""
_CHANGE_VIEWS = f"WITH c AS ({_CHANGES.format(customer='customer')}){_ACTIONS}"


def _changes(lens: Lens) -> DataFrame:
    rows = lens.spark.sql(_CHANGES, customer=lens.table("customer"))
    k = F.col("k")
    action = F.struct(
        F.when(k % 4 == 0, "sdk").when(k % 4 == 1, "docs").when(k % 4 == 2, "mcp").otherwise("dataset-api").alias("target"),
        F.when(k % 3 == 0, "regenerate").when(k % 3 == 1, "review").otherwise("db_migration_review").alias("action"),
        F.when(k % 5 == 0, "manual_review").when(k % 11 == 0, "blocked").otherwise("automatic").alias("automation"),
    )
    more = F.struct(F.lit("registry").alias("target"), F.lit("record").alias("action"), F.lit("automatic").alias("automation"))
    again = F.struct(F.lit("sdk").alias("target"), F.lit("regenerate").alias("action"), F.lit("blocked").alias("automation"))
    return rows.withColumn("actions", F.array_compact(F.array(action, F.when(k % 6 == 0, again), F.when(k % 2 == 0, more))))


@query(_CHANGE_VIEWS + _IMPACT + "SELECT * FROM i", views=False)
def impact_summary(lens: Lens) -> DataFrame:
    """A17."""
    return changes.impact_summary(_changes(lens))


@query(_CHANGE_VIEWS + _IMPACT + """, p AS (SELECT DISTINCT source_id, k // 200 AS part FROM c)
SELECT * FROM i UNION ALL SELECT 'plans', '', count(*) FROM p UNION ALL SELECT 'generated_at', CAST(max(k) AS VARCHAR), NULL FROM c UNION ALL SELECT 'library_version', '1.0', NULL
UNION ALL SELECT 'registry_version_from', CASE WHEN count(DISTINCT part) > 1 THEN 'mixed' ELSE CAST(min(part) AS VARCHAR) END, NULL FROM p UNION ALL SELECT 'registry_version_to', 'mixed', NULL""", views=False)
def impact_rollup(lens: Lens) -> DataFrame:
    """Plans of at most 200 changes each, over all of which A17 counts."""
    part = F.floor(F.col("k") / 200)
    plans = _changes(lens).groupBy("source_id", part.alias("part")).agg(
        F.max("k").alias("generated_at"), F.array_sort(F.collect_list(F.struct("change_id", "category", "actions"))).alias("changes")
    )
    plans = plans.select(
        F.concat_ws("/", F.lit("reports"), "source_id", F.col("part").cast("string")).alias("path"), "generated_at", F.lit("1.0").alias("library_version"),
        F.col("part").cast("string").alias("registry_version_from"), F.lit(None).cast("string").alias("registry_version_to"), "changes",
    )
    return changes.impact_rollup(plans)


@query(_CHANGE_VIEWS + "SELECT source_id, CASE count(DISTINCT provider) WHEN 1 THEN min(provider) ELSE 'several' END AS provider, count(*) AS n FROM c GROUP BY 1", views=False)
def common_providers(lens: Lens) -> DataFrame:
    """A19 per source."""
    return _changes(lens).groupBy("source_id").agg(changes.common_value("provider", "several").alias("provider"), F.count("*").alias("n"))


@query(_CHANGE_VIEWS + """SELECT change_id AS row_key, 'database review of an unpromoted dataset' AS rule FROM acts WHERE action = 'db_migration_review' AND NOT promoted
UNION ALL SELECT DISTINCT change_id, 'regeneration of what is not served' FROM acts WHERE action = 'regenerate' AND target IN ('dataset-api', 'sdk', 'mcp') AND NOT served
UNION ALL SELECT change_id, 'identity of another source' FROM c WHERE k % 8 <> 0 AND (k % 40 = 0 OR k % 27 = 0)""", views=False)
def impact_rule_violations(lens: Lens) -> DataFrame:
    """C11, C12."""
    rows = _changes(lens).withColumns(
        {
            "scope": F.when(F.col("k") % 8 == 0, "release").otherwise("source"),
            "identity_source": F.when(F.col("k") % 27 == 0, "elsewhere").otherwise(F.col("source_id")),
            "plan_provider": F.concat(F.lit("provider"), F.substring("source_id", 7, 9)),
        }
    )
    acts = F.col("actions")
    database = F.exists(acts, lambda a: a["action"] == "db_migration_review") & ~F.col("promoted")
    regenerated = F.exists(acts, lambda a: (a["action"] == "regenerate") & a["target"].isin(*changes.SERVED_TARGETS)) & ~F.col("served")
    return checks.check(
        rows,
        F.col("change_id"),
        [
            checks.business("database review of an unpromoted dataset", database),
            checks.business("regeneration of what is not served", regenerated),
            checks.source_scope("identity of another source", F.col("scope"), {"provider": "plan_provider", "identity_source": "source_id"}),
        ],
    )


@query(_CHANGE_VIEWS + """, n AS (SELECT count(DISTINCT change_id) AS n, coalesce(bool_or(target = 'mcp' AND action = 'review'), false) AS a, coalesce(bool_or(target = 'registry' AND action = 'record'), false) AS b FROM acts WHERE change_id = 'c10')
SELECT 'c10' AS row_key, rule FROM (SELECT 'exactly one change' AS rule, n <> 1 AS bad FROM n UNION ALL SELECT 'action for mcp', NOT a FROM n UNION ALL SELECT 'action for sdk', true FROM n) WHERE bad""", views=False)
def required_change_actions(lens: Lens) -> DataFrame:
    """A growth needs one change with its actions."""
    return checks.missing_actions(_changes(lens), "c10", {"mcp": "review", "sdk": "regenerate"}, F.lit(True))


@query(_CHANGE_VIEWS + """, one AS (SELECT k, category, promoted, served FROM c WHERE change_id = 'c30'), last AS (SELECT target, arg_max(action, place) AS action, arg_max(automation, place) AS automation FROM (
  SELECT CASE k % 4 WHEN 0 THEN 'sdk' WHEN 1 THEN 'docs' WHEN 2 THEN 'mcp' ELSE 'dataset-api' END AS target, CASE k % 3 WHEN 0 THEN 'regenerate' WHEN 1 THEN 'review' ELSE 'db_migration_review' END AS action,
    CASE WHEN k % 5 = 0 THEN 'manual_review' WHEN k % 11 = 0 THEN 'blocked' ELSE 'automatic' END AS automation, 1 AS place FROM one
  UNION ALL SELECT 'sdk', 'regenerate', 'blocked', 2 FROM one WHERE k % 6 = 0 UNION ALL SELECT 'registry', 'record', 'automatic', 3 FROM one WHERE k % 2 = 0) GROUP BY 1),
r AS (SELECT 'exactly one change' AS rule, (SELECT count(*) FROM one) = 1 AS met UNION ALL SELECT 'action for mcp', EXISTS (FROM last WHERE target = 'mcp' AND action = 'investigate')
  UNION ALL SELECT 'action for registry', EXISTS (FROM last WHERE target = 'registry' AND action = 'record') UNION ALL SELECT 'automation of mcp', EXISTS (FROM last WHERE target = 'mcp' AND automation = 'manual_review')
  UNION ALL SELECT 'automation of registry', EXISTS (FROM last WHERE target = 'registry' AND automation = 'manual_review') UNION ALL SELECT 'no action for docs', EXISTS (FROM last WHERE target = 'docs' AND action = 'no_action')
  UNION ALL SELECT 'no action for sdk', EXISTS (FROM last WHERE target = 'sdk' AND action = 'no_action')
  UNION ALL SELECT 'category', EXISTS (FROM one WHERE category = 'release_schema_changed') UNION ALL SELECT 'registry only', EXISTS (FROM one WHERE NOT promoted AND NOT served))
SELECT 'c30' AS row_key, rule FROM r WHERE NOT met""", views=False)
def schema_growth_gate(lens: Lens) -> DataFrame:
    """All that a grown set of schemas asks of its change."""
    return checks.missing_actions(
        _changes(lens), "c30", {"mcp": "investigate", "registry": "record"}, F.lit(True), category="release_schema_changed",
        automation={"mcp": "manual_review", "registry": "manual_review"}, registry_only=True, idle=("docs", "sdk"),
    )


# Drift and sources: suppliers as source profiles.

_S = "CAST(s_suppkey AS STRING)"
_PROFILES = f"""SELECT 's' || {_S} AS source_id, 'provider' || CAST(s_nationkey AS STRING) AS provider, s_suppkey AS k, 'sources/s' || {_S} AS source_profile,
  'https://s' || {_S} || '.example/docs' AS api_docs_url, 'https://s' || {_S} || '.example/' AS homepage_url, 'https://s' || {_S} || '.example/blog' AS blog_url,
  CASE WHEN s_suppkey % 2 = 0 THEN 'https://s' || {_S} || '.example/key' END AS key_request_url, CASE WHEN s_suppkey % 3 = 0 THEN 'https://s' || {_S} || '.example/docs' END AS metadata_standard_url,
  CAST(NULL AS STRING) AS notice_url, CASE WHEN s_suppkey % 5 = 0 THEN 'https://s' || {_S} || '.example/terms' END AS terms_url, '2020-01-01' AS reviewed_at,
  CASE WHEN s_suppkey % 4 = 0 THEN 'planned' WHEN s_suppkey % 29 = 0 THEN NULL ELSE 'registered' END AS adapter_status, s_suppkey % 3 <> 0 AS can_call,
  CASE WHEN s_suppkey % 6 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN 'draft' ELSE 'verified' END AS taxonomy_status,
  CASE WHEN s_suppkey % 7 = 0 THEN 'metadata_only' ELSE 'live' END AS verification_mode, CASE WHEN s_suppkey % 9 = 0 THEN 'none' ELSE 'key' END AS auth_type,
  CASE WHEN s_suppkey % 8 = 0 THEN 'manual' WHEN s_suppkey % 8 = 1 THEN 'generated' ELSE 'static' END AS sample_param_policy, CAST(s_suppkey % 4 AS BIGINT) AS evidence_total, s_suppkey % 8 <> 4 AS materialized
FROM {{supplier}}"""
_KINDS = ("api_docs_url", "homepage_url", "key_request_url", "metadata_standard_url", "notice_url", "terms_url")
_REFERENCES = " UNION ALL ".join(f"SELECT source_id, '{k}' AS kind, {k} AS url, k FROM p WHERE {k} IS NOT NULL" for k in _KINDS)
_DRIFT = f"""WITH p AS ({_PROFILES.format(supplier="supplier")}), r AS ({_REFERENCES}),
f AS (SELECT *, CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN 404 WHEN k % 9 = 2 THEN 500 WHEN k % 9 = 3 THEN 410 ELSE 200 END AS status, CASE WHEN k % 9 = 4 THEN url || '/new' WHEN k % 9 = 5 THEN url ELSE '' END AS final_url FROM r),
d AS (SELECT *, CASE WHEN k % 14 = 13 THEN NULL WHEN status IS NULL THEN 'error' WHEN status IN (404, 410) THEN 'missing' WHEN status >= 400 THEN 'error' WHEN final_url <> '' AND final_url <> url THEN 'redirected' WHEN k % 10 = 6 THEN 'changed' ELSE 'unchanged' END AS drift FROM f)
"""


def _profiles(lens: Lens) -> DataFrame:
    caps = F.when(F.col("can_call"), F.array(F.lit("call"), F.lit("verification"))).otherwise(F.array(F.lit("verification")))
    return lens.spark.sql(_PROFILES, supplier=lens.table("supplier")).withColumn("capabilities", caps)


def _drift(lens: Lens) -> DataFrame:
    """References as fetched; those of every 14th source weren't."""
    refs = changes.profile_references(_profiles(lens)).withColumn("k", F.substring("source_id", 2, 20).cast("long"))
    k = F.col("k")
    status = F.when(k % 9 == 0, None).when(k % 9 == 1, 404).when(k % 9 == 2, 500).when(k % 9 == 3, 410).otherwise(200)
    final = F.when(k % 9 == 4, F.concat("url", F.lit("/new"))).when(k % 9 == 5, F.col("url")).otherwise("")
    drift = changes.drift_status(status, final, F.col("url"), F.when(k % 10 == 6, "b").otherwise("a"), F.lit("a"))
    return refs.withColumn("drift", F.when(k % 14 != 13, drift)).withColumn("impacts", changes.reference_impact(F.col("kind")))


@query(_DRIFT + """SELECT source_id, kind, url, drift, CASE kind WHEN 'homepage_url' THEN 'source_identity' WHEN 'api_docs_url' THEN 'catalogue,auth,runtime' WHEN 'key_request_url' THEN 'auth'
  WHEN 'notice_url' THEN 'notice,runtime' WHEN 'terms_url' THEN 'terms' WHEN 'metadata_standard_url' THEN 'metadata_standard' END AS impacts FROM d""", views=False)
def reference_drift(lens: Lens) -> DataFrame:
    """P16, P17, P18."""
    return _drift(lens).select("source_id", "kind", "url", "drift", F.array_join("impacts", ",").alias("impacts"))


@query(_DRIFT + """SELECT count(*) AS "references", count(drift) AS checked, count(*) FILTER (drift IN ('changed', 'redirected')) AS changed, count(*) FILTER (drift = 'missing') AS missing,
  count(*) FILTER (drift IN ('changed', 'redirected', 'missing')) AS contract_affecting, count(*) FILTER (drift IN ('missing', 'error')) AS failures FROM d""", views=False)
def drift_summary(lens: Lens) -> DataFrame:
    """A24."""
    return changes.drift_summary(_drift(lens))


@query(_DRIFT + "SELECT source_id, array_to_string(list_sort(list_distinct(list(url))), ' ') AS urls FROM (SELECT source_id, url FROM r UNION ALL SELECT source_id, blog_url FROM p) GROUP BY 1", views=False)
def official_urls(lens: Lens) -> DataFrame:
    """Of known kinds and others."""
    return changes.official_urls(_profiles(lens)).withColumn("urls", F.array_join("urls", " "))


@query(_DRIFT + """, b AS (SELECT source_id, kind, CASE WHEN k % 11 = 0 THEN url || '?old' ELSE url END AS url FROM r WHERE k % 13 <> 0 UNION ALL SELECT source_id, 'blog', 'x' FROM p WHERE k % 12 = 0)
SELECT coalesce(a.source_id, b.source_id) AS source_id, coalesce(a.kind, b.kind) AS kind, CASE WHEN b.source_id IS NULL THEN 'missing' WHEN a.source_id IS NULL THEN 'extra' ELSE 'changed' END AS problem
FROM r a FULL JOIN b ON a.source_id = b.source_id AND a.kind = b.kind WHERE b.source_id IS NULL OR a.source_id IS NULL OR a.url IS DISTINCT FROM b.url""", views=False)
def reference_differences(lens: Lens) -> DataFrame:
    """J9."""
    profiles = _profiles(lens)
    refs = changes.profile_references(profiles).withColumn("k", F.substring("source_id", 2, 20).cast("long"))
    report = refs.where("k % 13 <> 0").select("source_id", "kind", F.when(F.col("k") % 11 == 0, F.concat("url", F.lit("?old"))).otherwise(F.col("url")).alias("url"))
    report = report.unionAll(profiles.where("k % 12 = 0").select("source_id", F.lit("blog"), F.lit("x")))
    return changes.compare_references(report, profiles)


_BLOCKERS = """, b AS (SELECT source_id, 'metadata_only_verification' AS blocker FROM p WHERE verification_mode = 'metadata_only'
UNION ALL SELECT source_id, 'adapter_not_registered' FROM p WHERE adapter_status IS DISTINCT FROM 'registered' OR NOT can_call
UNION ALL SELECT source_id, 'credential_required' FROM p WHERE auth_type <> 'none'
UNION ALL SELECT source_id, 'sample_parameters_not_pinned' FROM p WHERE sample_param_policy = 'manual'
UNION ALL SELECT source_id, 'runtime_catalog_not_materialized' FROM p WHERE evidence_total = 0 AND NOT materialized
UNION ALL SELECT source_id, 'source_specific_error_taxonomy_pending' FROM p WHERE taxonomy_status IS DISTINCT FROM 'verified'),
w AS (SELECT source_id, 'source_runtime_adapter_not_registered' AS warning FROM b WHERE blocker = 'adapter_not_registered'
UNION ALL SELECT source_id, 'source_runtime_manual_samples_unpinned' FROM b WHERE blocker = 'sample_parameters_not_pinned'
UNION ALL SELECT source_id, 'source_runtime_error_taxonomy_pending' FROM b WHERE blocker = 'source_specific_error_taxonomy_pending'
UNION ALL SELECT source_id, 'non_data_runtime_evidence_not_collected' FROM p WHERE evidence_total = 0)
"""


@query(_DRIFT + _BLOCKERS + "SELECT * FROM b", views=False)
def source_blockers(lens: Lens) -> DataFrame:
    """P20, U4."""
    return changes.required_blockers(_profiles(lens))


def _plan_ids(lens: Lens) -> DataFrame:
    """Plans with the ids of the blockers and warnings that they need: six and four at most."""
    profiles = _profiles(lens)
    none = F.array().cast("array<string>")
    blockers = changes.required_blockers(profiles).groupBy("source_id").agg(F.array_sort(F.collect_set("blocker")).alias("blockers"))
    plans = profiles.join(blockers, "source_id", "left").withColumn("blockers", F.coalesce("blockers", none))
    warnings = changes.required_warnings(plans).groupBy("source_id").agg(F.array_sort(F.collect_set("warning")).alias("warnings"))
    return plans.join(warnings, "source_id", "left").withColumn("warnings", F.coalesce("warnings", none))


@query(_DRIFT + _BLOCKERS + """SELECT source_id, 'blocker' AS kind, blocker AS id FROM b JOIN p USING (source_id) WHERE k % 5 = 0 AND blocker = 'credential_required'
UNION ALL SELECT source_id, 'warning', warning FROM w JOIN p USING (source_id) WHERE k % 7 = 0""", views=False)
def plan_gaps(lens: Lens) -> DataFrame:
    """Plans that lack a blocker or all their warnings."""
    plans, none = _plan_ids(lens), F.array().cast("array<string>")
    listed = F.when(F.col("k") % 5 == 0, F.array_remove("blockers", "credential_required")).otherwise(F.col("blockers"))
    given = plans.select("source_id", "evidence_total", listed.alias("blockers"), F.when(F.col("k") % 7 == 0, none).otherwise(F.col("warnings")).alias("warnings"))
    return changes.missing_ids(given, _profiles(lens))


def _rolled(lens: Lens) -> DataFrame:
    rows = _plan_ids(lens)
    severity = lambda x: F.when(x == "source_specific_error_taxonomy_pending", "non_blocking").otherwise("blocking")
    e = F.col("evidence_total")
    plans = rows.select(
        "source_id", "provider", "evidence_total", F.least(e, F.lit(1)).alias("verified"), F.when(e >= 2, 1).otherwise(0).cast("long").alias("failed"),
        F.when(e >= 3, 1).otherwise(0).cast("long").alias("skipped"), F.lit(0).cast("long").alias("unknown"), F.lit(4).cast("long").alias("next_action_count"),
        F.transform("blockers", lambda x: F.struct(x.alias("id"), severity(x).alias("severity"))).alias("blockers"),
        F.transform("warnings", lambda x: F.struct(x.alias("id"), F.lit("warning").alias("severity"))).alias("warnings"),
    )
    return evidence.rollup_sources(plans)


_ROLLED = """, s AS (SELECT p.source_id, p.provider, evidence_total, CAST(evidence_total >= 1 AS BIGINT) AS verified, CAST(evidence_total >= 2 AS BIGINT) AS failed, CAST(evidence_total >= 3 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS unknown,
  (SELECT count(*) FROM b WHERE b.source_id = p.source_id AND blocker <> 'source_specific_error_taxonomy_pending') AS blocking_count, (SELECT count(*) FROM w WHERE w.source_id = p.source_id) AS warning_count,
  coalesce((SELECT string_agg(blocker, ',' ORDER BY blocker) FROM b WHERE b.source_id = p.source_id), '') AS blocker_ids, coalesce((SELECT string_agg(warning, ',' ORDER BY warning) FROM w WHERE w.source_id = p.source_id), '') AS warning_ids,
  CAST(4 AS BIGINT) AS next_action_count FROM p)
"""


@query(_DRIFT + _BLOCKERS + _ROLLED + "SELECT * FROM s", views=False)
def rollup_sources(lens: Lens) -> DataFrame:
    """A row per source."""
    return _rolled(lens).withColumns({c: F.array_join(c, ",") for c in ("blocker_ids", "warning_ids")})


@query(_DRIFT + _BLOCKERS + _ROLLED + """SELECT count(*) AS sources, count(*) FILTER (evidence_total = 0) AS sources_without_evidence, CAST(sum(evidence_total) AS BIGINT) AS evidence_total, CAST(sum(verified) AS BIGINT) AS verified,
  CAST(sum(failed) AS BIGINT) AS failed, CAST(sum(skipped) AS BIGINT) AS skipped, CAST(sum(unknown) AS BIGINT) AS unknown, CAST(sum(blocking_count) AS BIGINT) AS blocking_count, CAST(sum(warning_count) AS BIGINT) AS warning_count FROM s""", views=False)
def rollup_totals(lens: Lens) -> DataFrame:
    """The nine totals."""
    return evidence.rollup_summary(_rolled(lens))


@query(_DRIFT + _BLOCKERS + """SELECT kind, id, count(*) AS n, array_to_string(list_sort(list(source_id)), ',') AS source_ids FROM (
  SELECT 'blocker' AS kind, blocker AS id, source_id FROM b UNION ALL SELECT 'warning', warning, source_id FROM w) GROUP BY 1, 2""", views=False)
def evidence_rollup(lens: Lens) -> DataFrame:
    """The inverted index."""
    return evidence.rollup_index(_rolled(lens)).withColumn("source_ids", F.array_join("source_ids", ","))


@query(_DRIFT + _BLOCKERS + """, i AS (SELECT warning AS id, array_to_string(list_sort(list(source_id)), ',') AS expected, array_to_string(list_sort(list(source_id) FILTER (source_id NOT LIKE '%7')), ',') AS actual FROM w GROUP BY 1)
SELECT id, 'missing' AS problem FROM i WHERE id = 'non_data_runtime_evidence_not_collected' UNION ALL SELECT id, 'affected_sources' FROM i WHERE id <> 'non_data_runtime_evidence_not_collected' AND expected <> coalesce(actual, '')
UNION ALL SELECT id, 'unknown' FROM (SELECT 'made_up' AS id)""", views=False)
def rollup_warning_gaps(lens: Lens) -> DataFrame:
    """A rollup that lacks one warning, has one that no plan has, and forgets sources."""
    index = evidence.rollup_index(_rolled(lens))
    kept = F.filter("source_ids", lambda s: ~F.endswith(s, F.lit("7")))
    given = index.where((F.col("kind") == "warning") & (F.col("id") != changes.NO_EVIDENCE_WARNING)).select(F.col("id").alias("warning_id"), kept.alias("affected_sources"))
    more = lens.spark.createDataFrame([("made_up", ["s1"])], "warning_id string, affected_sources array<string>")
    return evidence.rollup_warning_gaps(index, given.unionAll(more))


_CANDIDATES = """SELECT 's' || CAST(l_suppkey AS STRING) AS source_id, 'provider' || CAST(CASE WHEN l_suppkey % 19 = 0 THEN -1 ELSE s_nationkey END AS STRING) AS provider, l_suppkey % 2 = 0 AND l_linenumber = 1 AS has_evidence,
  l_orderkey AS k, l_linenumber AS n, l_partkey AS part, l_suppkey AS supp FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey"""


def _candidates(lens: Lens) -> DataFrame:
    rows = lens.spark.sql(_CANDIDATES, lineitem=lens.table("lineitem"), supplier=lens.table("supplier"))
    given = F.when(F.col("n") % 3 == 0, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("page"), F.lit("1")))
    return rows.withColumn("candidate_id", F.concat_ws("-", "source_id", "k", "n")).withColumn("sample_parameters", given)


@query(_DRIFT + f""", c AS ({_CANDIDATES.format(lineitem="lineitem", supplier="supplier")}), g AS (SELECT source_id, count(*) AS candidates, count(*) FILTER (has_evidence) AS evidence, min(provider) AS p1, max(provider) AS p2 FROM c GROUP BY 1)
SELECT p.source_id, coalesce(candidates, 0) AS candidates, coalesce(evidence, 0) AS evidence, coalesce(p1 = provider AND p2 = provider, true) AS agrees, coalesce(candidates, 0) > 0 AND coalesce(evidence, 0) = 0 AS materialized
FROM p LEFT JOIN g ON p.source_id = g.source_id""", views=False)
def plan_batches(lens: Lens) -> DataFrame:
    """J11."""
    return changes.attach_plan_batches(_profiles(lens), _candidates(lens))


@query(f"""WITH c AS ({_CANDIDATES.format(lineitem="lineitem", supplier="supplier")}) SELECT count(*) AS candidates, count(*) FILTER (n % 3 <> 0) AS pinned,
  (SELECT count(*) FROM (SELECT source_id, k, n FROM c GROUP BY 1, 2, 3 HAVING count(*) > 1)) AS duplicate_ids FROM c""", views=False)
def candidate_summary(lens: Lens) -> DataFrame:
    """A26."""
    return changes.candidate_summary(_candidates(lens))


@query(_DRIFT + f""", c AS (SELECT source_id, source_id || '-' || CAST(k AS STRING) || '-' || CAST(n AS STRING) AS candidate_id, k AS o, n, part, supp FROM ({_CANDIDATES.format(lineitem="lineitem", supplier="supplier")})),
j AS (SELECT c.*, sample_param_policy, auth_type, k % 2 = 0 AS keyed, k % 3 = 0 AS in_path FROM c JOIN p USING (source_id))
SELECT source_id, candidate_id, unnest(list_filter([CASE WHEN sample_param_policy = 'manual' THEN 'sample_policy_not_pinned' END, CASE WHEN n = 6 THEN 'method' END, CASE WHEN n = 7 OR part % 31 = 0 THEN 'format' END,
  CASE WHEN part % 5 = 0 THEN 'credential_required' END, CASE WHEN part % 7 = 0 AND keyed THEN 'key_names' END,
  CASE WHEN part % 11 = 0 THEN 'injection_location' END, CASE WHEN in_path AND keyed AND part % 2 = 0 THEN 'path_placeholders' END, CASE WHEN part % 13 = 0 THEN 'evidence_status' END, CASE WHEN part % 17 = 0 THEN 'promotion_status' END], lambda x: x IS NOT NULL)) AS problem
FROM j UNION ALL SELECT 'nowhere', candidate_id, 'no_profile' FROM c WHERE n = 5 AND part % 50 = 0""", views=False)
def candidate_problems(lens: Lens) -> DataFrame:
    """C14."""
    k, part = F.col("k"), F.col("part")
    keyed = F.array(F.lit("b"), F.lit("a"))
    none = F.array().cast("array<string>")
    profiles = _profiles(lens).select(
        "source_id", F.array(F.lit("GET"), F.lit("POST")).alias("methods"), F.array(F.lit("json")).alias("formats"), "auth_type", "sample_param_policy",
        F.when(k % 2 == 0, keyed).otherwise(none).alias("key_parameter_names"),
        F.when(k % 3 == 0, F.array(F.lit("path"), F.lit("query"))).when(k % 3 == 1, F.array(F.lit("query"))).otherwise(none).alias("key_locations"),
    )
    supp = F.col("supp")
    location = F.when(supp % 3 == 0, "path").when(supp % 3 == 1, "query").otherwise("none")
    rows = _candidates(lens).select(
        "source_id", "candidate_id", "n", "part", F.when(F.col("n") == 6, "DELETE").otherwise("GET").alias("method"),
        F.when((F.col("n") == 7) | (part % 31 == 0), "xml").otherwise("json").alias("format"),
        F.when(part % 2 == 0, "/v1/{a}").otherwise("/v1/{a}/{b}/{page}").alias("endpoint_template"),
        ((part % 5 == 0) != (supp % 9 != 0)).alias("credential_required"),
        F.when(supp % 2 != 0, none).when(part % 7 == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("key_names"),
        F.when(part % 11 == 0, "header").otherwise(location).alias("injection_location"),
        F.when(part % 13 == 0, "collected").otherwise("not_collected").alias("evidence_status"),
        F.when(part % 17 == 0, None).otherwise("registry_only").alias("promotion_status"),
    )
    strays = rows.where("n = 5 AND part % 50 = 0").withColumn("source_id", F.lit("nowhere"))
    return changes.candidate_problems(rows.unionAll(strays).drop("n", "part"), profiles)


@query(_DRIFT + f""", c AS ({_CANDIDATES.format(lineitem="lineitem", supplier="supplier")}),
x AS (SELECT k, n, provider, CASE WHEN k % 61 = 0 THEN 'other' ELSE source_id END AS source_id, CASE WHEN k % 67 = 0 THEN 'sources/none' ELSE 'sources/' || source_id END AS source_profile FROM c)
SELECT * FROM (SELECT x.source_id, x.provider, k, n, CASE WHEN q.source_profile IS NULL THEN 'no_profile' ELSE concat_ws(',', CASE WHEN x.source_id <> q.source_id THEN 'source_id' END, CASE WHEN x.provider <> q.provider THEN 'provider' END) END AS problem
FROM x LEFT JOIN (SELECT source_profile, source_id, provider FROM p) q ON x.source_profile = q.source_profile) WHERE problem <> ''""", views=False)
def identity_mismatches(lens: Lens) -> DataFrame:
    """J8."""
    k = F.col("k")
    profile = F.when(k % 67 == 0, "sources/none").otherwise(F.concat(F.lit("sources/"), "source_id"))
    rows = _candidates(lens).select(F.when(k % 61 == 0, "other").otherwise(F.col("source_id")).alias("source_id"), "provider", "k", "n", profile.alias("source_profile"))
    return checks.identity_mismatches(rows, _profiles(lens)).drop("source_profile")


@query("""WITH o AS (SELECT o_custkey AS k, 'reports/' || CAST(o_orderkey AS VARCHAR) AS path FROM orders),
g AS (SELECT k, list_sort(list(path)) AS files FROM o GROUP BY 1)
SELECT k, CASE WHEN k % 7 = 0 THEN len(files) = 1 WHEN k % 11 = 0 THEN false ELSE true END AS covered FROM g""", views=False)
def listed_inputs(lens: Lens) -> DataFrame:
    """The inputs that a rollup lists, against the files of its source (a customer's few orders)."""
    path = F.concat(F.lit("reports/"), F.col("o_orderkey").cast("string"))
    files = lens.table("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.array_sort(F.collect_list(path)).alias("files"))
    listed = F.when(F.col("k") % 7 == 0, F.reverse("files")).when(F.col("k") % 11 == 0, F.slice("files", 2, 1_000_000)).otherwise(F.col("files"))
    return files.select("k", C.covers_all(F.col("files"), listed).alias("covered"))


# Artifacts, gates and constraints.

_MANIFEST = """SELECT 'data/' || CAST(o_orderkey % 14000 AS STRING) || '.json' AS path, CAST(CASE WHEN o_orderkey % 31 = 0 THEN -1 ELSE o_custkey END AS BIGINT) AS bytes,
  CASE WHEN o_orderkey % 37 = 0 THEN 'XYZ' ELSE {hash} END AS sha256 FROM {orders} WHERE o_orderkey % 23 <> 0"""
_ACTUAL = """SELECT 'data/' || CAST(o_orderkey AS STRING) || '.json' AS path, CAST(CASE WHEN o_orderkey % 41 = 0 THEN 0 ELSE o_custkey END AS BIGINT) AS bytes,
  CASE WHEN o_orderkey % 43 = 0 THEN {other} ELSE {hash} END AS sha256 FROM {orders}"""


def _artifact_sql(text: str, hash_of: str) -> str:
    return text.replace("{hash}", hash_of.format("CAST(o_orderkey % 14000 AS STRING)")).replace("{other}", hash_of.format("'x'"))


@query(f"""WITH m0 AS ({_artifact_sql(_MANIFEST, "sha256({})").format(orders="orders")}), m AS (SELECT path, count(*) AS n, max(bytes) AS mb, max(sha256) AS ms FROM m0 GROUP BY 1),
a AS ({_artifact_sql(_ACTUAL, "sha256({})").format(orders="orders")})
SELECT path, problem FROM (SELECT coalesce(m.path, a.path) AS path, CASE WHEN m.path = '' THEN 'invalid_path' WHEN n > 1 THEN 'duplicate_artifact_path' WHEN NOT regexp_matches(ms, '^[a-f0-9]{{64}}$') THEN 'invalid_checksum' WHEN mb < 0 THEN 'invalid_size'
  WHEN a.path IS NULL THEN 'missing_artifact' WHEN m.path IS NULL THEN 'unlisted' WHEN mb <> a.bytes THEN 'size_mismatch' WHEN ms <> a.sha256 THEN 'checksum_mismatch' END AS problem
  FROM m FULL JOIN a ON m.path = a.path) WHERE problem IS NOT NULL""", views=False)
def artifact_problems(lens: Lens) -> DataFrame:
    """J10."""
    orders = lens.table("orders")
    manifest = lens.spark.sql(_artifact_sql(_MANIFEST, "sha2({}, 256)"), orders=orders)
    actual = lens.spark.sql(_artifact_sql(_ACTUAL, "sha2({}, 256)"), orders=orders)
    return checks.verify_artifacts(manifest, actual)


@query("""
, g AS (SELECT (SELECT count(*) FROM specs) AS specs, (SELECT count(*) FROM deps) AS deps, (SELECT count(*) FROM deps WHERE adapter_status = 'missing') AS missing, (SELECT count(*) FROM evidence) AS evidence)
SELECT 4 AS gates, CAST((specs >= 1) AS INT) + CAST((deps >= specs) AS INT) + CAST((missing = 0) AS INT) + CAST((evidence >= deps) AS INT) AS passing,
  CAST((NOT missing = 0) AS INT) + CAST((NOT evidence >= deps) AS INT) AS warnings, CAST((NOT specs >= 1) AS INT) + CAST((NOT deps >= specs) AS INT) AS failures, specs >= 1 AND deps >= specs AS ready FROM g""")
def release_readiness(lens: Lens) -> DataFrame:
    """A25."""
    deps = lens.deps()
    n = lambda df, name: df.agg(F.count("*").alias(name))
    counts = n(lens.specs(), "specs").join(n(deps, "deps")).join(n(deps.where("adapter_status = 'missing'"), "missing")).join(n(lens.evidence(deps), "evidence"))

    def gate(name: str, needed: bool, expected, actual: str, exact: bool):
        return F.struct(F.lit(name).alias("gate"), F.lit(needed).alias("required"), expected.cast("long").alias("expected"), F.col(actual).alias("actual"), F.lit(exact).alias("exact"))

    gates = [
        gate("specs present", True, F.lit(1), "specs", False),
        gate("operations for specs", True, F.col("specs"), "deps", False),
        gate("no missing adapter", False, F.lit(0), "missing", True),
        gate("all with evidence", False, F.col("deps"), "evidence", False),
    ]
    rows = counts.select(F.explode(F.array(*gates)).alias("g")).select("g.*")
    out = checks.readiness(rows)
    return out.select(*(F.col(c).cast("int").alias(c) for c in ("gates", "passing", "warnings", "failures")), "ready")


@query("""
, v AS (SELECT dataset_id || '/' || operation || '/' || CAST(part_key AS VARCHAR) AS row_key, * FROM deps)
SELECT row_key, 'required dataset_id' AS rule FROM v WHERE coalesce(dataset_id, '') = '' UNION ALL SELECT row_key, 'required organization' FROM v WHERE coalesce(organization, '') = ''
UNION ALL SELECT row_key, 'one_of dependency_class' FROM v WHERE dependency_class NOT IN ('gateway', 'external_endpoint', 'service_root', 'no_endpoint') UNION ALL SELECT row_key, 'matches dataset_id' FROM v WHERE NOT regexp_matches(dataset_id, '^ds[0-9]+$')
UNION ALL SELECT row_key, 'between request_params_count' FROM v WHERE request_params_count NOT BETWEEN 0 AND 2 UNION ALL SELECT row_key, 'unique_items names' FROM v WHERE organization = source_category OR supp_key % 10 = 0
UNION ALL SELECT row_key, 'sums_to part_key' FROM v WHERE request_params_count + response_params_count + part_key <> part_key AND part_key % 50 = 0""")
def operation_violations(lens: Lens) -> DataFrame:
    """C1, C2, C3, C4, C6, C9."""
    rows = lens.deps().withColumn("names", F.array(F.lit("a"), F.when(F.col("supp_key") % 10 == 0, "a").otherwise("b")))
    rows = rows.withColumn("total", F.when(F.col("part_key") % 50 == 0, F.lit(0)))
    rule, bad = checks.sums_to(["request_params_count", "response_params_count"], "total")
    constraints = [
        checks.required("dataset_id"),
        checks.required("organization"),
        checks.one_of("dependency_class", ("gateway", "external_endpoint", "service_root", "no_endpoint")),
        checks.matches("dataset_id", "^ds[0-9]+$"),
        checks.between("request_params_count", 0, 2),
        checks.unique_items("names"),
        ("sums_to part_key", bad),
    ]
    key = F.concat("dataset_id", F.lit("/"), "operation", F.lit("/"), F.col("part_key").cast("string"))
    return checks.check(rows, key, constraints).select("row_key", "rule")


@query("SELECT coalesce(dataset_id, '') || '/' || operation AS row_key, count(*) AS n FROM deps GROUP BY 1 HAVING count(*) > 1")
def repeated_operations(lens: Lens) -> DataFrame:
    """C5."""
    return checks.unique_key(lens.deps(), ["dataset_id", "operation"])


@query("""SELECT DISTINCT dataset_id AS row_key, 'no parent' AS problem FROM deps WHERE dataset_id IS NOT NULL AND dataset_id NOT IN (SELECT id FROM specs)
UNION ALL SELECT DISTINCT id, 'no child' FROM specs WHERE id NOT IN (SELECT dataset_id FROM deps WHERE dataset_id IS NOT NULL)""")
def orphaned_keys(lens: Lens) -> DataFrame:
    """C8."""
    return checks.foreign_key(lens.deps(), "dataset_id", lens.specs(), "id", both_ways=True)


@query("""
, a AS (SELECT count(*) AS n_total, count(*) FILTER (status = 'verified') AS n_verified, count(*) FILTER (status = 'failed') AS n_failed FROM evidence),
b AS (SELECT count(*) AS n_total, count(*) FILTER (status = 'verified') AS n_verified, count(*) FILTER (status = 'failed') AS n_failed FROM latest)
SELECT * FROM (SELECT 'n_total' AS field, CAST(a.n_total AS VARCHAR) AS expected, CAST(b.n_total AS VARCHAR) AS actual FROM a, b UNION ALL SELECT 'n_verified', CAST(a.n_verified AS VARCHAR), CAST(b.n_verified AS VARCHAR) FROM a, b
UNION ALL SELECT 'n_failed', CAST(a.n_failed AS VARCHAR), CAST(b.n_failed AS VARCHAR) FROM a, b) WHERE expected IS DISTINCT FROM actual""")
def reconciled_summaries(lens: Lens) -> DataFrame:
    """J12, C10."""
    def summary(df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n_total"), F.count_if(F.col("status") == "verified").alias("n_verified"), F.count_if(F.col("status") == "failed").alias("n_failed"))

    every = lens.evidence()
    return checks.reconcile(summary(every), summary(evidence.latest(every, ORDER)), ["n_total", "n_verified", "n_failed"])


@query("""
, f AS (SELECT dataset_id, operation, part_key, supp_key, price, dependency_class FROM deps WHERE dependency_class = 'soap' AND provider = 'portal')
SELECT *, (SELECT count(*) FROM f) AS filtered_count, (SELECT count(*) FROM f) > 500 AS truncated FROM f ORDER BY dataset_id, operation, part_key, supp_key, price LIMIT 500""")
def filtered_operations(lens: Lens) -> DataFrame:
    """Equality filters and a limit."""
    rows = lens.deps().select("dataset_id", "operation", "part_key", "supp_key", "price", "dependency_class", "provider")
    return search.apply_filters(rows, 500, ["dataset_id", "operation", "part_key", "supp_key", "price"], dependency_class="soap", provider="portal").drop("provider")


@query("SELECT doc_id, lang, source FROM documents WHERE contains(lower(concat_ws(chr(10), text, source)), 'thation')", views=False)
def document_search(lens: Lens) -> DataFrame:
    """P4."""
    return search.search(lens.table("documents"), "ThaTion", ["text", "source"]).select("doc_id", "lang", "source")


def _indexed(lens: Lens, name: str, query_text: str) -> DataFrame:
    """``document_search`` of all documents through an index of their trigrams."""
    path = scratch_path(lens.spark)
    text_index.write_text_index(lens.table(name), path, "doc_id", ["text", "source"], ["lang", "source"])
    return text_index.indexed_search(lens.spark, path, query_text).withColumnRenamed("key", "doc_id")


@query("SELECT doc_id, lang, source FROM documents WHERE contains(lower(concat_ws(chr(10), text, source)), 'thation')", views=False)
def indexed_document_search(lens: Lens) -> DataFrame:
    """P4 by an inverted index of trigrams."""
    return _indexed(lens, "documents", "ThaTion")


@query("SELECT doc_id, lang, source FROM documents WHERE contains(lower(concat_ws(chr(10), text, source)), 'éa')", views=False)
def indexed_short_search(lens: Lens) -> DataFrame:
    """P4 by the index, for fewer characters than its trigrams have."""
    return _indexed(lens, "documents", "Éa")


@query("""
, o AS (SELECT dataset_id, count(*) AS n, bool_or(callable) AS callable FROM deps WHERE dataset_id <> '' GROUP BY 1)
SELECT id, title, provider, organization, source_category, coalesce(n, 0) AS operations_count, coalesce(callable, false) AS callable FROM specs LEFT JOIN o ON id = dataset_id
WHERE source_category = '1-URGENT' AND contains(lower(concat_ws(chr(10), id, title, provider, organization, source_category)), 'customer#0000001')""")
def indexed_dataset_search(lens: Lens) -> DataFrame:
    """All cards found by the index, and an equality filter."""
    path = scratch_path(lens.spark)
    cards, fields = search.cards(lens.nested_specs())
    text_index.write_text_index(cards, path, "id", fields, [c for c in cards.columns if c != "id"])
    return text_index.indexed_search(lens.spark, path, "Customer#0000001").where("source_category = '1-URGENT'").withColumnRenamed("key", "id")


#: A credential in DuckDB's dialect, written apart from the operator's own pattern.
_LEAK = "(?i)(servicekey|api-?key|api_key|authkey|access_token|secret|token|password)\\s*(=|:)\\s*([\"'']?)[A-Za-z0-9%+/_.\\-]{8,}"


@query(f"SELECT doc_id, len(regexp_extract_all(text, '{_LEAK}')) AS leaks FROM documents WHERE regexp_matches(text, '{_LEAK}')", views=False)
def credential_leaks(lens: Lens) -> DataFrame:
    """P12."""
    return search.credential_leaks(lens.table("documents"), "text").select("doc_id", "leaks")


@query("""
, o AS (SELECT dataset_id, count(*) AS n, bool_or(callable) AS callable FROM deps WHERE dataset_id <> '' GROUP BY 1)
SELECT id, title, provider, organization, source_category, coalesce(n, 0) AS operations_count, coalesce(callable, false) AS callable FROM specs LEFT JOIN o ON id = dataset_id
WHERE source_category = '1-URGENT' AND contains(lower(concat_ws(chr(10), id, title, provider, organization, source_category)), 'customer#000000') ORDER BY id LIMIT 500""")
def dataset_search(lens: Lens) -> DataFrame:
    """Cards of specs found by text and an equality filter, the first 500 by id."""
    return search.search_datasets(lens.nested_specs(), "Customer#000000", 500, source_category="1-URGENT")
