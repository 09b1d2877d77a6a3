"""Release gates on small tables."""

from __future__ import annotations

import json

import pytest

from pyspark.sql import functions as F

from quillframe.operators import checks, evidence, reports
from quillframe.sources import readers

CHANGE = "change_id string, category string, promoted boolean, served boolean, actions array<struct<target:string,action:string,automation:string>>"
WANTED = {"category": "grown", "automation": {"cli": "manual"}, "registry_only": True, "idle": ("sdk",)}


def gate(spark, rows):
    found = checks.missing_actions(spark.createDataFrame(rows, CHANGE), "c", {"cli": "investigate"}, F.lit(True), **WANTED)
    return sorted(r["rule"] for r in found.collect())


def test_a_growth_with_all_it_needs(spark):
    actions = [("cli", "investigate", "manual"), ("sdk", "no_action", None)]
    assert gate(spark, [("c", "grown", False, False, actions), ("other", None, True, None, [])]) == []


def test_each_rule_of_a_growth_by_itself(spark):
    good = [("cli", "investigate", "manual"), ("sdk", "no_action", None)]
    assert gate(spark, [("c", None, False, False, good)]) == ["category"]
    assert gate(spark, [("c", "grown", None, False, good)]) == ["registry only"]
    assert gate(spark, [("c", "grown", False, False, [("cli", "investigate", "auto"), good[1]])]) == ["automation of cli"]
    assert gate(spark, [("c", "grown", False, False, [*good, ("sdk", "regenerate", None)])]) == ["no action for sdk"]
    assert gate(spark, [("c", "grown", False, False, good)] * 2) == ["exactly one change"]
    every = ["action for cli", "automation of cli", "category", "exactly one change", "no action for sdk", "registry only"]
    assert gate(spark, []) == every
    assert gate(spark, [("c", None, None, None, None)]) == [r for r in every if r != "exactly one change"]


def test_a_rollup_names_the_sources_of_its_warnings(spark):
    index = spark.createDataFrame([("warning", "w1", ["a", "b"]), ("warning", "w2", ["a"]), ("warning", "w3", ["c"]), ("blocker", "x", ["a"])], "kind string, id string, source_ids array<string>")

    def gaps(rows):
        given = spark.createDataFrame(rows, "warning_id string, affected_sources array<string>")
        return sorted((r["id"], r["problem"]) for r in evidence.rollup_warning_gaps(index, given).collect())

    assert gaps([("w1", ["b", "a"]), ("w2", ["a"]), ("w3", ["c", "c"])]) == []
    assert gaps([("w1", ["a"]), ("w2", None), ("w4", ["a"])]) == [("w1", "affected_sources"), ("w2", "affected_sources"), ("w3", "missing"), ("w4", "unknown")]
    assert gaps([("w1", ["a"]), ("w1", ["b"]), ("w2", ["a", "z"]), ("w3", ["c"])]) == [("w2", "affected_sources")]


def test_cross_checks_of_external_coverage(spark):
    figures = spark.createDataFrame([(5, 2, 3)], "missing_adapter_operations long, missing_adapter_hosts long, registered_adapter_hosts long")
    index = spark.createDataFrame([("a", ["x", "y"]), ("b", ["y", None]), ("c", None)], "name string, hosts array<string>")
    targets = spark.createDataFrame([("h", 4), ("i", 1)], "host string, operations long")
    got = {r["check"]: (r["expected"], r["actual"], r["same"]) for r in reports.external_cross_checks(figures, targets, index).collect()}
    assert got == {"target_operations": (5, 5, True), "target_hosts": (2, 2, True), "index_hosts": (3, 2, False)}
    got = {r["check"]: r["actual"] for r in reports.external_cross_checks(figures, targets.limit(0), index.limit(0)).collect()}
    assert got == {"target_operations": 0, "target_hosts": 0, "index_hosts": 0}


def test_a_report_of_its_own_alone_is_no_source(spark, tmp_path):
    (tmp_path / "rollup.json").write_text(json.dumps({"results": [{"status": "x"}]}))
    with pytest.raises(ValueError, match="no report but the output"):
        readers.read_source_reports(spark, str(tmp_path / "*.json"), "results", "status string", own_output="rollup.json")
    (tmp_path / "a.json").write_text(json.dumps({"results": []}))
    assert readers.read_source_reports(spark, str(tmp_path / "*.json"), "results", "status string", own_output="rollup.json").isEmpty()
