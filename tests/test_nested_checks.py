"""Constraints at any depth: each violation with its place, in one pass."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillframe.operators.nested_checks import MAX_CONSTRAINTS, SPEC_CONTRACT, check_nested
from quillframe.sources import model

SCHEMA = "id string, n int, tags array<string>, ops array<struct<name:string,params:map<string,string>,fields:array<struct<name:string,extra:string>>>>, raw string"
ROWS = [
    ("a", 5, ["x", "y"], [("list", {"p": "1"}, [("f", None)])], '{"k": {"z": 1}}'),
    ("b", None, None, None, None),
    ("c", 11, ["x", None, None], [("", {"p": "", "q": None, "odd": "1"}, [("g", "e"), (None, None)]), (None, {}, []), None], '{"k": 1, "bad": null}'),
    ("", -1, [], [], "no json"),
]


def found(spark, constraints, rows=ROWS, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return sorted(((r["row_key"], r["path"], r["rule"], r["detail"]) for r in check_nested(df, F.col("id"), constraints).collect()), key=repr)


@pytest.mark.parametrize(
    ("constraint", "want"),
    [
        (("n", "required", None), [("b", "n", None)]),
        (("n", "between", "[0, 10]"), [("", "n", "-1"), ("c", "n", "11")]),
        (("n", "one_of", "[5, 11]"), [("", "n", "-1")]),
        (("id", "min_length", "1"), [("", "id", "")]),
        (("tags", "unique_items", None), [("c", "tags", "1")]),
        (("tags", "min_items", "1"), [("", "tags", "0")]),
        (("tags[]", "required", None), [("c", "tags[1]", None), ("c", "tags[2]", None)]),
        (("tags[]", "matches", "^x$"), [("a", "tags[1]", "y")]),
        (("ops[].name", "required", None), [("c", "ops[1].name", None)]),
        (("ops[]", "required", None), [("c", "ops[2]", None)]),
        (("ops[].name", "min_length", "1"), [("c", "ops[0].name", "")]),
        (("ops[].fields[].name", "required", None), [("c", "ops[0].fields[1].name", None)]),
        (("ops[].fields", "min_items", "1"), [("c", "ops[1].fields", "0")]),
        (("ops[].fields[]", "closed", '["name"]'), [("c", "ops[0].fields[0]", "extra")]),
        (("ops[].params{}", "min_length", "1"), [("c", "ops[0].params{p}", "")]),
        (("ops[].params{}", "required", None), [("c", "ops[0].params{q}", None)]),
        (("ops[].params", "closed", '["p", "q"]'), [("c", "ops[0].params", "odd")]),
        (("raw", "closed", '["k"]'), [("c", "raw", "bad")]),
        (("", "closed", '["id", "n", "ops", "raw"]'), [("", "", "tags"), ("a", "", "tags"), ("c", "", "tags")]),
        (("ops[].label", "required", None), [("a", "ops[0].label", None), ("c", "ops[0].label", None), ("c", "ops[1].label", None)]),
        (("ops[].label", "min_length", "3"), []),
        (("none[].x", "required", None), []),
    ],
)
def test_each_rule_names_the_place(spark, constraint, want):
    assert found(spark, [constraint]) == sorted(((k, p, constraint[1], d) for k, p, d in want), key=repr)


def test_constraints_are_one_pass_and_may_be_a_table(spark):
    constraints = [("ops[].name", "required", None), ("ops[].name", "min_length", "1"), ("ops[].fields[].name", "required", None), ("tags[]", "required", None)]
    each = sorted((v for c in constraints for v in found(spark, [c])), key=repr)
    assert found(spark, constraints) == each and len(each) == 5
    table = spark.createDataFrame(constraints, "path string, rule string, argument string")
    df = spark.createDataFrame(ROWS, SCHEMA)
    checked = check_nested(df, F.col("id"), table)
    assert checked.count() == 5
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Exchange" not in plan
    with pytest.raises(ValueError, match="more than"):
        check_nested(df, F.col("id"), spark.range(MAX_CONSTRAINTS + 1).selectExpr("'n' AS path", "'required' AS rule", "cast(null AS string) AS argument"))
    with pytest.raises(ValueError, match="no such rule"):
        check_nested(df, F.col("id"), [("n", "odd", None)])
    assert found(spark, constraints, []) == [] and found(spark, []) == []


def test_the_contract_of_specs(spark):
    op = {"name": "list", "request_params": [{"name": "", "label": "x"}], "response_params": [{"name": "ok"}], "source": {"url": "u", "raw": "{}"}}
    rows = [{"id": "d1", "title": "t", "provider": "p", "priority": "1", "operations": [op, {"name": None}]}, {"id": "d2", "title": "", "provider": None}]
    got = found(spark, SPEC_CONTRACT, rows, model.SPECS)
    assert [v[:3] for v in got] == [
        ("d1", "operations[0].request_params[0].name", "min_length"), ("d1", "operations[0].source.system", "required"), ("d1", "operations[1].name", "required"),
        ("d2", "operations", "required"), ("d2", "priority", "required"), ("d2", "provider", "required"), ("d2", "title", "min_length"),
    ]
    more = [f for f in ("updated_at", "url") if f in model.SPECS]
    rows = [{"id": "d3", "title": "t", "provider": "p", "priority": "1", "operations": [], "updated_at": "2026", "url": "u"}]
    assert [(v[2], v[3]) for v in found(spark, SPEC_CONTRACT, rows, model.SPECS)] == [("closed", f) for f in more]
