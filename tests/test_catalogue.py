"""Known-answer cases of the catalogue operators on small rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quillframe.functions import columns as C
from quillframe.operators import changes, checks, classify, evidence, reports, search
from quillframe.sources import model, readers

EVIDENCE = "dataset_id string, operation string, endpoint_host string, dependency_class string, provider string, status string, reason string, verified_at string, ordinal int"


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def repeated(spark):
    """Three keys, each twice: a failure, later a skip."""
    out = [("d1", f"op{k}", "h.example", "external_endpoint", "p", "failed", "http_error", "2026-06-25", k) for k in range(3)]
    out += [("d1", f"op{k}", "h.example", "external_endpoint", "p", "skipped", "missing_auth", "2026-06-29", k) for k in range(3)]
    return spark.createDataFrame(out, EVIDENCE)


def test_last_evidence_wins(repeated):
    got = evidence.latest(repeated, ["verified_at", "ordinal"])
    assert rows(got.groupBy("status", "reason").count()) == [("skipped", "missing_auth", 3)]


def test_merge_keeps_input_order_among_equal_stamps(spark):
    a = spark.createDataFrame([("d", "o", None, "soap", "p", "failed", None, "2026-01-01", 0)], EVIDENCE)
    b = spark.createDataFrame([("d", "o", "", "soap", "p", "verified", None, "2026-01-01", 0)], EVIDENCE)
    assert [r["status"] for r in evidence.merge_evidence([a, b]).collect()] == ["verified"]
    assert [r["status"] for r in evidence.merge_evidence([b, a]).collect()] == ["failed"]


def test_one_evidence_row_attaches_to_every_equal_key(spark, repeated):
    deps = spark.createDataFrame([("d1", "op0", "h.example", "external_endpoint", k) for k in range(3)] + [("d2", "op0", None, "soap", 9)], "dataset_id string, operation string, endpoint_host string, dependency_class string, k int")
    got = {r["k"]: r["evidence"] and r["evidence"]["status"] for r in evidence.attach_evidence(deps, repeated, ["verified_at", "ordinal"]).collect()}
    assert got == {0: "skipped", 1: "skipped", 2: "skipped", 9: None}
    assert [r["k"] for r in evidence.uncovered(deps, repeated).collect()] == [9]


def test_summary_drops_nulls_and_breaks_ties_by_value(spark):
    data = [("verified", None), ("failed", "b"), ("failed", "a"), ("skipped", "c"), ("skipped", "c")]
    df = spark.createDataFrame(data, "status string, reason string")
    got = sorted(rows(evidence.verification_summary(df, ("status", "reason"), 2)))
    assert got == [("reason", "a", 1, 2), ("reason", "c", 2, 1), ("status", "failed", 2, 1), ("status", "skipped", 2, 2), ("total", "", 5, 1)]
    assert rows(evidence.verification_summary(df.limit(0), ("status",))) == [("total", "", 0, 1)]


@pytest.mark.parametrize(
    ("part", "whole", "want"), [(586, 614, 95.4), (12063, 12205, 98.8), (1221, 12205, 10.0), (1, 16, 6.3), (0, 5, 0.0), (3, 0, 0.0), (5, 5, 100.0)]
)
def test_percent(spark, part, whole, want):
    assert spark.range(1).select(C.percent(F.lit(part), F.lit(whole))).first()[0] == want


def test_url_functions(spark):
    urls = ["http://its.example:81/a", "http://http://x.kr/a", "no url", None, "https://h.example", "http://h.example/?serviceKey=abc&x=1", "http://h/a?x=1&ServiceKEY=q#f"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = rows(df.select(C.url_authority(F.col("u")), C.redact_url(F.col("u"))))
    assert [r[0] for r in got] == ["its.example:81", "http:", None, None, "h.example", "h.example", "h"]
    assert got[5][1] == "http://h.example/?serviceKey=REDACTED&x=1" and got[6][1] == "http://h/a?x=1&ServiceKEY=REDACTED#f"
    assert rows(spark.range(1).select(C.template_placeholders(F.lit("/{b}/{a}/{b}")))) == [(["a", "b"],)]


def test_digest_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("", "a"), ("a,1:b", "c"), ("a", "b,1:c")], "x string, y string")
    assert df.select(C.digest(F.col("x"), F.col("y")).alias("d")).distinct().count() == 5


def test_classes_and_adapters(spark):
    endpoints = {
        None: "no_endpoint", " ": "no_endpoint", "see the guide": "malformed_endpoint", "http://h.example/s?wsdl": "soap", "http://h.example/wms?a=1": "wms",
        "http://h.example": "service_root", "http://h.example/": "service_root", "https://apis.gateway.example/1": "gateway", "http://h.example:81/x": "external_endpoint",
    }
    deps = spark.createDataFrame([(e, "s.example", "manual" if e else None, None) for e in endpoints], "endpoint string, source_host string, dev_approval string, prod_approval string")
    adapters = spark.createDataFrame([("a2", "registered", ["h.example:81", "s.example"], ["call", "verification"], 1), ("a1", "registered", ["h.example:81"], ["verification"], 0)], model.ADAPTERS + ", ordinal int")
    got = {r["endpoint"]: r for r in classify.classify(deps, adapters).collect()}
    assert {e: r["dependency_class"] for e, r in got.items()} == endpoints
    assert got["http://h.example:81/x"]["adapter"] == "a2"  # the last adapter of a host in the input
    assert got["http://h.example"]["adapter_status"] == "adapter" and got["http://h.example"]["route_host"] == "s.example"
    assert got["https://apis.gateway.example/1"]["adapter_status"] == "builtin" and not got["http://h.example"]["callable"]
    assert [r["approval_required"] for r in got.values()].count(True) == 8
    assert rows(reports.split_readiness(adapters)) == [(2, 2, 1, True, "")]
    short = rows(reports.split_readiness(adapters.where("name = 'a1'")))
    assert short == [(1, 1, 0, False, "need_at_least_two_external_adapters,need_at_least_two_verification_capable_adapters,need_at_least_one_call_capable_adapter")]


def test_flatten_keeps_specs_without_operations(spark):
    data = [("a", [("x", "http://h/1", {"k": ""}, [("p", "l")], [("resultCode", "l"), ("y", "l")], ("s", None, '{"a": {"b": 1}}'))]), ("b", []), ("c", None)]
    specs = spark.createDataFrame(data, f"id string, operations array<{model.OPERATION}>")
    ops = classify.operations(specs)
    assert sorted((r["id"], r["operation"]) for r in ops.collect()) == [("a", "x"), ("b", None), ("c", None)]
    params = classify.params(ops).withColumn("role", classify.status_field_role(F.col("name")))
    assert sorted((r["direction"], r["name"], r["role"]) for r in params.collect()) == [("request", "p", None), ("response", "resultCode", "result_code"), ("response", "y", None)]
    assert rows(ops.where("id = 'a'").select(classify.missing_params(F.col("default_params")))) == [(["k"],)]


def test_open_objects_and_stamps(spark, tmp_path):
    (tmp_path / "specs.json").write_text(json.dumps([{"id": "a", "operations": [{"name": "x", "source": {"system": "s", "raw": {"b": {"c": 2}, "a": [1]}}}]}]))
    raw = readers.read_specs(spark, str(tmp_path / "specs.json")).select(F.explode("operations").alias("o")).select("o.source.raw")
    assert rows(raw.select(C.raw_field(F.col("raw"), "$.b.c"), C.raw_field(F.col("raw"), "$.a[0]"), C.raw_field(F.col("raw"), "$.z"))) == [("2", "1", None)]
    df = spark.createDataFrame([('{"b": "2", "a": "1"}', "2026-06-29T09:22:07Z"), ("no", "soon"), (None, None)], "j string, s string")
    got = rows(df.select(C.canonical_json(F.col("j")), C.iso_stamp(C.stamp(F.col("s")))))
    assert got == [('{"a":"1","b":"2"}', "2026-06-29T09:22:07Z"), (None, None), (None, None)]


def test_covers_all_in_order(spark):
    df = spark.createDataFrame([(["b", "a"], ["a", "b"]), (["a", "b"], ["b", "a"]), (["a"], ["a", "b"]), (None, []), (["a"], None)], "files array<string>, listed array<string>")
    assert [r[0] for r in df.select(C.covers_all(F.col("files"), F.col("listed"))).collect()] == [True, False, False, True, False]


def test_dispositions(spark):
    data = [("failed", "http_error", 404, []), ("failed", "probe_timeout", None, []), ("failed", "http_error", 503, []), (None, None, None, ["p"]), ("verified", None, 200, []), (None, None, None, [])]
    df = spark.createDataFrame(data, "s string, r string, h int, m array<string>")
    got = [r[0] for r in df.select(reports.disposition(F.col("s"), F.col("r"), F.col("h"), F.col("m"))).collect()]
    assert got == ["dead_route_candidate", "transient_failure", "transient_failure", "parameter_blocked", "adapter_candidate", None]


def test_institutions_from_either_side(spark):
    specs = spark.createDataFrame([("a", "X"), ("b", "X"), ("", None)], "id string, organization string")
    deps = spark.createDataFrame([("a", "o", None, "soap", "X", True), ("z", "o", "h", "gateway", "Y", None)], "dataset_id string, operation string, endpoint_host string, dependency_class string, organization string, approval_required boolean")
    none = spark.createDataFrame([], EVIDENCE)
    got = {r["organization"]: (r["api_count"], r["operation_count"], r["approval_count"]) for r in reports.institution_overview(specs, deps, none, ["verified_at"]).collect()}
    assert got == {"X": (2, 1, 1), "Unknown": (0, 0, 0), "Y": (0, 1, 0)}


def test_diff(spark):
    old = spark.createDataFrame([("a", "1", None), ("b", "1", "x"), ("c", "1", "x")], "id string, p string, q string")
    new = spark.createDataFrame([("b", "1", "x"), ("c", "2", None), ("d", "1", "x")], "id string, p string, q string")
    got = {r["id"]: (r["change"], r["fields"]) for r in changes.diff_specs(old, new, ["p", "q"]).collect()}
    assert got == {"a": ("removed", ""), "b": ("stable", ""), "c": ("changed", "p,q"), "d": ("added", "")}
    assert sorted(rows(changes.set_diff(old, new, "id"))) == [("a", "missing"), ("d", "extra")]


def test_drift(spark):
    data = [(None, "", "u"), (404, "", "u"), (410, "x", "u"), (500, "", "u"), (200, "v", "u"), (200, "u", "u"), (200, "", "u")]
    df = spark.createDataFrame(data, "s int, f string, u string").withColumn("drift", changes.drift_status(F.col("s"), F.col("f"), F.col("u")))
    assert [r["drift"] for r in df.collect()] == ["error", "missing", "missing", "error", "redirected", "unchanged", "unchanged"]
    got = changes.drift_summary(df.withColumn("impacts", changes.reference_impact(F.lit("api_docs_url")))).first()
    assert tuple(got) == (7, 7, 1, 2, 3, 4)
    assert rows(spark.range(1).select(changes.reference_impact(F.lit("blog")))) == [(["unknown"],)]


def test_rule_summary(spark):
    data = [("a", "blocked", "info", "x", ["automatic"]), ("b", "active", "blocking", "x", ["manual_review"]), ("c", "active", "info", "unknown", ["manual_review"]), ("c", "active", "info", "x", [])]
    rules = spark.createDataFrame(data, "rule_id string, status string, severity string, classification string, automations array<string>")
    rules = rules.withColumn("actions", F.transform("automations", lambda a: F.struct(a.alias("automation"))))
    assert rows(changes.rule_summary(rules)) == [(4, 2, 1, 1, 1)]


def test_artifacts(spark, tmp_path):
    for name, content in (("a.json", b"{}"), ("b.json", b"[1]"), ("c.json", b"x")):
        (tmp_path / name).write_bytes(content)
    found = readers.scan_artifacts(spark, str(tmp_path)).withColumn("path", F.element_at(F.split("path", "/"), -1))
    by = {r["path"]: (r["bytes"], r["sha256"]) for r in found.collect()}
    manifest = [("a.json", *by["a.json"]), ("b.json", 9, by["b.json"][1]), ("d.json", 1, "0" * 64), ("e.json", 1, "no"), ("f.json", 1, "0" * 64), ("f.json", 1, "0" * 64)]
    listed = spark.createDataFrame(manifest, "path string, bytes long, sha256 string")
    got = sorted(rows(checks.verify_artifacts(listed, found)))
    assert rows(checks.verify_artifacts(listed, found, listed=7))[-1] == ("", "artifact_count_mismatch")
    assert checks.verify_artifacts(listed, found, listed=6).where("path = ''").isEmpty()
    assert got == [("b.json", "size_mismatch"), ("c.json", "unlisted"), ("d.json", "missing_artifact"), ("e.json", "invalid_checksum"), ("f.json", "duplicate_artifact_path")]


def test_readers(spark, tmp_path):
    (tmp_path / "specs.json").write_text(json.dumps([{"id": "a", "operations": [{"name": "x"}]}, {"id": "b"}]))
    assert readers.read_specs(spark, str(tmp_path / "specs.json")).count() == 2
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "report.json").write_text(json.dumps({"n": 1, "results": [{"status": name}, {"status": "x"}]}))
    got = readers.read_source_reports(spark, str(tmp_path / "*" / "report.json"), "results", "status string", own_output="two/report.json")
    assert sorted((r["status"], r["ordinal"]) for r in got.collect()) == [("one", 0), ("x", 1)]
    readers.write_report(got.select("status"), str(tmp_path / "out"), ["status"], small=True)
    assert [r["status"] for r in spark.read.json(str(tmp_path / "out")).collect()] == ["one", "x"]
    both = readers.union_sources({"s1": spark.createDataFrame([(1,)], "a int"), "s2": spark.createDataFrame([(2,)], "b int")})
    assert sorted((r["source_id"], r["a"], r["b"]) for r in both.collect()) == [("s1", 1, None), ("s2", None, 2)]


def test_readiness_and_checks(spark):
    gates = spark.createDataFrame([("a", True, 1, 2, False), ("b", False, 5, 2, False), ("c", True, 0, 0, True)], "gate string, required boolean, expected long, actual long, exact boolean")
    assert rows(checks.readiness(gates)) == [(3, 2, 1, 0, True)]
    df = spark.createDataFrame([("k1", None, 3, ["a", "a"]), ("k2", "x", 900, ["a"])], "k string, s string, n int, l array<string>")
    got = sorted(rows(checks.check(df, F.col("k"), [checks.required("s"), checks.one_of("s", ("y",)), checks.between("n", 100, 599), checks.unique_items("l")])))
    assert got == [("k1", "between n"), ("k1", "required s"), ("k1", "unique_items l"), ("k2", "between n"), ("k2", "one_of s")]
    assert checks.unknown_columns(df, ["k", "s"]) == ["n", "l"]


def test_filters_and_search(spark):
    df = spark.createDataFrame([(k, "AbC" if k % 2 else "x", None) for k in range(10)], "k int, t string, u string")
    got = search.apply_filters(df, 2, ["k"], t="AbC").collect()
    assert [(r["k"], r["filtered_count"], r["truncated"]) for r in got] == [(1, 5, True), (3, 5, True)]
    assert search.apply_filters(df, 0).count() == 10
    assert search.search(df, "bc", ["t", "u"]).count() == 5


def test_growth(spark):
    df = spark.createDataFrame([(12205, 1221), (12205, 100), (0, 0)], "o long, e long")
    got = rows(df.select(*evidence.evidence_growth(F.col("o"), F.col("e"), 10.0)))
    assert got == [(10.0, 1221, 0, "at"), (0.8, 1221, 1121, "below"), (0.0, 0, 0, "at")]
