"""Known answers: rows and results of published reports, transcribed with neutral names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillframe.operators import changes, checks, classify, evidence, reports

EVIDENCE = "dataset_id string, operation string, endpoint_host string, dependency_class string, provider string, status string, reason string, http_status int, verified_at string, ordinal int"


def rows(df):
    return [tuple(r) for r in df.collect()]


def results(spark, data):
    return spark.createDataFrame([(*r, k) for k, r in enumerate(data)], EVIDENCE)


def result(op, host, cls, status, reason=None, http=None, at="2026-06-25", provider="p"):
    return ("d", op, host, cls, provider, status, reason, http, at)


def test_merge_of_two_batches(spark):
    """Seven external rows and nineteen of service roots, limits 7 and 26: 26 rows, limit 33."""
    a = results(spark, [result(f"a{k}", "h.example", "external_endpoint", "failed", "key_not_registered") for k in range(7)])
    b = results(spark, [result(f"b{k}", None, "service_root", "skipped", "missing_operation_path") for k in range(19)])
    merged = evidence.merge_evidence([a, b])
    assert merged.count() == 26
    got = evidence.merged_summary([a, b], merged, [7, 26]).first().asDict()
    assert got == {"total": 26, "verified": 0, "failed": 7, "skipped": 19, "unknown": 0, "rows_read": 26, "limit": 33}


def test_summary_of_41_results(spark):
    data = [result(f"m{k}", "h.example", "external_endpoint", "skipped", "missing_required_params") for k in range(25)]
    data += [result(f"k{k}", "h.example", "external_endpoint", "skipped", "missing_auth") for k in range(14)]
    data += [result(f"v{k}", "h.example", "external_endpoint", "verified") for k in range(2)]
    got = {(r[0], r[1]): (r[2], r[3]) for r in rows(evidence.verification_summary(results(spark, data)))}
    assert got == {
        ("total", ""): (41, 1), ("status", "skipped"): (39, 1), ("status", "verified"): (2, 2), ("reason", "missing_required_params"): (25, 1),
        ("reason", "missing_auth"): (14, 2), ("provider", "p"): (41, 1), ("endpoint_host", "h.example"): (41, 1), ("dependency_class", "external_endpoint"): (41, 1),
    }


#: (host, routes, reason, status) of the 28 probed routes.
PROBES = [
    ("lib.example", 1, "probe_http_503", 503), ("dg.example:8080", 1, "probe_http_404", 404), ("rd.example", 4, "probe_http_404", 404), ("wj.example", 2, "probe_timeout", None),
    ("ci.example", 2, "probe_timeout", None), ("its.example:81", 3, "probe_timeout", None), ("co.example", 6, "probe_request_error", None), ("car.example", 4, "probe_http_404", 404),
    ("pr.example", 4, "probe_http_404", 404), ("si.example", 1, "probe_http_404", 404),
]


@pytest.fixture(scope="module")
def probed(spark):
    data = [result(f"{host}-{k}", host, "external_endpoint", "failed", reason, http) for host, n, reason, http in PROBES for k in range(n)]
    probe = results(spark, data)
    deps = probe.select("dataset_id", "operation", "endpoint_host", "dependency_class", F.col("endpoint_host").alias("route_host"), F.lit("missing").alias("adapter_status"), F.array().cast("array<string>").alias("missing_params"))
    return probe, reports.routes(deps, probe, ["verified_at", "ordinal"])


def test_summary_of_the_probe(probed):
    got = {(r[0], r[1]): r[2] for r in rows(evidence.verification_summary(probed[0], ("status", "reason", "endpoint_host")))}
    assert got[("total", "")] == got[("status", "failed")] == 28
    assert [got[("reason", f"probe_{x}")] for x in ("http_404", "timeout", "request_error", "http_503")] == [14, 7, 6, 1]
    assert got[("endpoint_host", "co.example")] == 6 and len(got) == 16


def test_dispositions_of_the_probe(probed):
    routes = probed[1]
    assert routes.count() == 28
    got = {(r[0], r[1]): (r[2], r[3]) for r in rows(reports.route_summary(routes))}
    assert got[("disposition", "dead_route_candidate")] == (14, 1) and got[("disposition", "transient_failure")] == (14, 2)
    assert [got[("route_host", h)][1] for h in ("co.example", "car.example", "pr.example", "rd.example", "its.example:81")] == [1, 2, 3, 4, 5]
    totals = ("routes_total", "hosts", "with_probe_evidence", "without_probe_evidence", "dead_route_candidates", "transient_failures", "parameter_blocked_routes", "adapter_candidates")
    assert [got[(t, "")][0] for t in totals] == [28, 10, 28, 0, 14, 14, 0, 0]
    actions = {r[0]: r[1] for r in rows(routes.select("disposition", "recommended_action").distinct())}
    assert actions == {
        "dead_route_candidate": "confirm upstream metadata or mark the route stale before adapter work",
        "transient_failure": "retry with bounded evidence before building a provider adapter",
    }
    # The order of the published list: disposition first, then host.
    first = routes.orderBy(*reports.ROUTE_ORDER).select("route_host").collect()
    assert [r[0] for r in first][:5] == ["car.example"] * 4 + ["dg.example:8080"] and first[-1][0] == "wj.example"
    reported = routes.sparkSession.createDataFrame([(h, n) for h, n, *_ in PROBES], "host string, operations long")
    assert reports.missing_host_differences(routes, reported).isEmpty()


def test_last_of_six_rows_wins(spark):
    data = [result("list", "m.example", "external_endpoint", "failed", "key_not_registered")] + [result(o, "m.example", "external_endpoint", "skipped", "missing_required_params") for o in ("detail", "codes")]
    data += [result("list", "m.example", "external_endpoint", "skipped", "missing_auth", at="2026-06-29")]
    data += [result(o, "m.example", "external_endpoint", "skipped", "missing_required_params", at="2026-06-29") for o in ("detail", "codes")]
    got = evidence.latest(results(spark, data), ["verified_at", "ordinal"])
    assert sorted(rows(got.select("operation", "status", "reason", "verified_at"))) == [
        ("codes", "skipped", "missing_required_params", "2026-06-29"), ("detail", "skipped", "missing_required_params", "2026-06-29"), ("list", "skipped", "missing_auth", "2026-06-29"),
    ]


def test_split_readiness_of_26_adapters(spark):
    """All 26 can verify, all but five can call; they claim 30 hosts."""
    only_verify, two_hosts, three_hosts = {0, 2, 5, 12, 20}, {4, 18}, {20}
    data = []
    for k in range(26):
        hosts = [f"h{k}-{n}.example" for n in range(3 if k in three_hosts else 2 if k in two_hosts else 1)]
        data.append((f"a{k}", "registered", hosts, ["verification"] if k in only_verify else ["call", "verification"]))
    adapters = spark.createDataFrame(data, "name string, status string, hosts array<string>, capabilities array<string>")
    assert rows(reports.split_readiness(adapters)) == [(26, 26, 21, True, "")]
    assert classify.adapter_hosts(adapters).count() == 30


ACTIONS = "array<struct<target:string,action:string,automation:string>>"


def impact(df):
    return {(r[0], r[1]): r[2] for r in rows(df)}


def test_impact_of_three_changes(spark):
    none = [(t, "no_action", "automated") for t in ("data", "dataset-api", "sdk", "mcp")]
    cli, release = ("cli", "refresh_verification", "automated"), ("registry-release", "refresh_verification", "automated")
    plan = spark.createDataFrame([("c1", "added", [cli, *none]), ("c2", "added", [release, *none]), ("c3", "added", [cli, release, *none])], f"change_id string, category string, actions {ACTIONS}")
    want = {
        ("total", ""): 3, ("category", "added"): 3, ("target", "cli"): 2, ("target", "data"): 3, ("target", "dataset-api"): 3, ("target", "sdk"): 3, ("target", "mcp"): 3,
        ("target", "registry-release"): 2, ("manual", ""): 0, ("database", ""): 0, ("served", ""): 0,
    }
    assert impact(changes.impact_summary(plan)) == want
    plans = plan.groupBy().agg(F.collect_list(F.struct(*plan.columns)).alias("changes")).select(
        F.lit("a").alias("path"), F.lit("2026-06-30").alias("generated_at"), F.lit("1").alias("library_version"), F.lit("x").alias("registry_version_from"), F.lit(None).cast("string").alias("registry_version_to"), "changes"
    )
    both = plans.unionAll(plans.withColumns({"path": F.lit("b"), "generated_at": F.lit("2026-06-29"), "registry_version_from": F.lit("y")}))
    got = impact(changes.impact_rollup(both))
    assert {k: v for k, v in got.items() if v is not None} == {k: 2 * v for k, v in want.items()} | {("plans", ""): 2}
    assert {k for k, v in got.items() if v is None} == {("generated_at", "2026-06-30"), ("library_version", "1"), ("registry_version_from", "mixed"), ("registry_version_to", "mixed")}


def test_a_change_counts_once_an_action(spark):
    actions = [("sdk", "regenerate", "manual_review"), ("mcp", "regenerate", "blocked"), ("docs", "db_migration_review", "automated")]
    got = impact(changes.impact_summary(spark.createDataFrame([("c", None, actions)], f"change_id string, category string, actions {ACTIONS}")))
    assert (got[("manual", "")], got[("served", "")], got[("database", "")], got[("total", "")]) == (2, 2, 1, 1)


def test_rollup_of_four_plans(spark):
    """Four sources of metadata alone: 12 blocking, 8 warnings, none with evidence."""
    profile = ("metadata_only", "planned", None, "key", "static", 0, True, "verified")
    names = ["s1", "s2", "s3", "s4"]
    schema = "source_id string, verification_mode string, adapter_status string, capabilities array<string>, auth_type string, sample_param_policy string, evidence_total long, materialized boolean, taxonomy_status string"
    profiles = spark.createDataFrame([(n, *profile) for n in names], schema)
    blockers = changes.required_blockers(profiles).groupBy("source_id").agg(F.array_sort(F.collect_list("blocker")).alias("blockers"))
    ids = ["adapter_not_registered", "credential_required", "metadata_only_verification"]
    assert sorted(rows(blockers)) == [(n, ids) for n in names]
    plans = profiles.join(blockers, "source_id")
    warnings = changes.required_warnings(plans).groupBy("source_id").agg(F.collect_list("warning").alias("warnings"))
    zero = F.lit(0).cast("long")
    full = plans.join(warnings, "source_id").select(
        "source_id", F.lit("p").alias("provider"), "evidence_total", *(zero.alias(c) for c in ("verified", "failed", "skipped", "unknown")), F.lit(4).alias("next_action_count"),
        F.transform("blockers", lambda x: F.struct(x.alias("id"), F.lit("blocking").alias("severity"))).alias("blockers"), F.transform("warnings", lambda x: F.struct(x.alias("id"), F.lit("x").alias("severity"))).alias("warnings"),
    )
    sources = evidence.rollup_sources(full)
    assert rows(evidence.rollup_summary(sources)) == [(4, 4, 0, 0, 0, 0, 0, 12, 8)]
    want = [("blocker", b, 4, names) for b in ids] + [("warning", w, 4, names) for w in ("non_data_runtime_evidence_not_collected", "source_runtime_adapter_not_registered")]
    assert sorted(rows(evidence.rollup_index(sources))) == want
    assert changes.missing_ids(plans.join(warnings, "source_id"), profiles).isEmpty()
    lacking = plans.join(warnings, "source_id").withColumn("blockers", F.array_remove("blockers", "credential_required"))
    assert sorted(rows(changes.missing_ids(lacking, profiles))) == [(n, "blocker", "credential_required") for n in names]


#: (status, severity, classification, automations) of the rules of five catalogues, and (rules, blocking, manual, unknown).
M = "manual_review"
CATALOGUES = [
    ([("draft", "blocking", "credential", [M, M]), ("draft", "blocking", "credential", [M]), ("draft", "medium", "rate_limit", [M, M]), ("draft", "medium", "not_found", [M, "automated"]), ("draft", "medium", "upstream_outage", [M]), ("draft", "high", "unknown", [M])], (6, 2, 4, 1)),
    ([("verified", "blocking", "credential", [M, M])] + [("verified", "medium", "bad_request", [M])] * 2 + [("draft", "medium", "bad_request", [M]), ("draft", "medium", "rate_limit", [M]), ("draft", "medium", "upstream_outage", [M]), ("draft", "high", "parser", [M])], (7, 1, 6, 0)),
    ([("verified", "blocking", "credential", [M, M])] * 2 + [("verified", "medium", "bad_request", [M]), ("draft", "medium", "rate_limit", [M]), ("draft", "medium", "upstream_outage", [M]), ("draft", "high", "parser", [M])], (6, 2, 4, 0)),
    ([("verified", "blocking", "credential", [M, M]), ("verified", "medium", "not_found", [M]), ("draft", "medium", "rate_limit", [M]), ("draft", "medium", "upstream_outage", [M]), ("draft", "high", "parser", [M])], (5, 1, 4, 0)),
    ([("verified", "blocking", "credential", [M, M]), ("verified", "medium", "bad_request", [M]), ("verified", "medium", "not_found", [M]), ("verified", "medium", "upstream_outage", [M]), ("draft", "medium", "rate_limit", [M]), ("draft", "medium", "upstream_outage", [M]), ("draft", "high", "parser", [M])], (7, 1, 6, 0)),
]


@pytest.mark.parametrize(("rules", "want"), CATALOGUES)
def test_summaries_of_rule_catalogues(spark, rules, want):
    df = spark.createDataFrame([(f"r{k}", *r) for k, r in enumerate(rules)], "rule_id string, status string, severity string, classification string, automations array<string>")
    df = df.withColumn("actions", F.transform("automations", lambda a: F.struct(a.alias("automation"))))
    assert rows(changes.rule_summary(df)) == [(*want, 0)]


RULES = (
    "rule_id string, kind string, classification string, http_status int, field string, value string, contains string, case_sensitive boolean, "
    "hosts array<string>, dataset_ids array<string>, operation_ids array<string>, dependency_classes array<string>"
)


def test_rules_of_a_published_catalogue(spark):
    """The six rules of one catalogue against results that each of them is about, and their neighbours."""
    none = (None, None, None)
    rules = [
        ("key", "field_equals", "credential", None, "resultCode", "30", None, False, *none, ["gateway", "external_endpoint"]),
        ("key message", "message_contains", "credential", None, None, None, "SERVICE KEY IS NOT REGISTERED", False, *none, None),
        ("too many", "http_status", "rate_limit", 429, None, None, None, None, *none, None),
        ("gone", "http_status", "not_found", 404, None, None, None, None, *none, ["external_endpoint"]),
        ("slow", "timeout", "upstream_outage", None, None, None, None, None, *none, ["external_endpoint"]),
        ("unreadable", "parse_error", "unknown", None, None, None, None, None, *none, None),
    ]
    schema = "result_id int, host string, dataset_id string, operation string, cls string, http_status int, reason string, message string, fields map<string,string>"
    data = [
        (1, "h", "d", "o", "gateway", 200, None, "service key is not registered error", {"resultCode": "30", "other": "00"}),
        (2, "h", "d", "o", "soap", 200, None, "", {"resultCode": "30"}), (3, "h", "d", "o", "gateway", 200, None, None, {"resultCode": "00", "other": "30"}),
        (4, "h", "d", "o", "gateway", 404, None, None, None), (5, "h", "d", "o", "external_endpoint", 404, "timeout", None, {}),
        (6, None, None, None, None, 429, "parse_error", None, None),
    ]
    got = changes.match_error_rules(spark.createDataFrame(data, schema), spark.createDataFrame(rules, RULES))
    assert sorted(rows(got.select("result_id", "rule_id"))) == [(1, "key"), (1, "key message"), (5, "gone"), (5, "slow"), (6, "too many"), (6, "unreadable")]
    left = changes.unmatched(spark.createDataFrame(data, schema), got)
    assert sorted(r["result_id"] for r in left.collect()) == [2, 3, 4]


def test_published_arithmetic(spark):
    """586 of 614 operations that need an adapter have one: 95.4; 12,063 of 12,205 can be called: 98.8."""
    deps = spark.range(12205).select(
        F.when(F.col("id") < 11419, "gateway").when(F.col("id") < 12014, "external_endpoint").when(F.col("id") < 12033, "service_root").when(F.col("id") < 12156, "no_endpoint").when(F.col("id") < 12198, "soap").otherwise("malformed_endpoint").alias("dependency_class"),
        F.when((F.col("id") >= 11419) & (F.col("id") < 12033), F.when(F.col("id") < 12005, "adapter").otherwise("missing")).otherwise("builtin").alias("adapter_status"),
        (F.col("id") < 4142).alias("approval_required"), (F.col("id") % 10).cast("string").alias("route_host"),
    )
    deps = deps.withColumn("callable", classify.is_callable(F.col("dependency_class")))
    adapters = spark.createDataFrame([(f"a{k}", [f"h{k}"], ["call", "verification"][k >= 21 :]) for k in range(26)], "name string, hosts array<string>, capabilities array<string>")
    got = reports.coverage(deps, spark.range(12060), adapters, spark.range(1221).select(F.when(F.col("id") < 22, "verified").otherwise("skipped").alias("status"))).first()
    figures = "operations callable_operations callable_operation_percent external_adapter_coverage_percent unsupported_protocol_operations no_endpoint_operations service_root_operations missing_adapter_operations missing_adapter_hosts adapter_count call_capable_adapters"
    assert [got[c] for c in figures.split()] == [12205, 12063, 98.8, 95.4, 42, 123, 19, 28, 10, 26, 21]
    assert (got["evidence_total"], got["verified"], got["verified_percent"], got["evidence_operation_percent"], got["provider_split_ready"]) == (1221, 22, 1.8, 10.0, True)
    growth = spark.range(1).select(*evidence.evidence_growth(F.lit(12205), F.lit(1221), 10.0)).first()
    assert tuple(growth) == (10.0, 1221, 0, "at")


def test_identity_of_reports(spark):
    profiles = spark.createDataFrame([("x.json", "s1", "p1"), ("y.json", "s2", "p2")], "source_profile string, source_id string, provider string")
    given = spark.createDataFrame([("x.json", "s1", "p1"), ("x.json", "s2", "p1"), ("y.json", "s1", None), ("z.json", "s1", "p1")], "source_profile string, source_id string, provider string")
    assert sorted(r["problem"] for r in checks.identity_mismatches(given, profiles).collect()) == ["no_profile", "source_id", "source_id,provider"]
