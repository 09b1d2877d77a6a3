"""Canonical forms of nested values, and differences by digests of blocks."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from quillframe.functions.canonical import canonical_column, nested_digest
from quillframe.operators import changes, snapshots
from quillframe.sources import model

PARAM = {"name": "q", "label": "a"}


def spec(**other):
    op = {
        "name": "list", "endpoint": "https://h.example/a", "default_params": {"b": "1", "a": ""}, "request_params": [PARAM, {"name": "r", "label": None}], "response_params": [],
        "source": {"system": "s", "url": None, "raw": '{"x": [1, {"b": 2, "a": null}]}'},
    }
    return {"id": "d", "title": "t", "source_keywords": ["k", "l"], "operations": [op, op | {"name": "get"}]} | other


def changed(path, value):
    """The spec with the value at a path replaced (or its entry removed by ``...``)."""
    out = json.loads(json.dumps(spec()))
    at = out
    for step in path[:-1]:
        at = at[step]
    if value is ...:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return out


COLUMNS = ["title", "provider", "source_keywords", "operations"]


def digests(spark, specs):
    rows = spark.createDataFrame(specs, model.SPECS)
    return [r[0] for r in rows.select(nested_digest(rows, COLUMNS)).collect()]


def test_key_order_does_not_matter(spark):
    same = spec()
    for op in same["operations"]:
        op["default_params"] = {"a": "", "b": "1"}
    a, b = digests(spark, [spec(), same])
    assert a == b


@pytest.mark.parametrize(
    ("path", "value"),
    [
        (("title",), "u"), (("title",), None), (("title",), ""), (("provider",), ""), (("source_keywords",), ["l", "k"]), (("source_keywords",), []), (("source_keywords",), None),
        (("source_keywords",), ["kl"]), (("source_keywords",), ["k", "l", None]), (("operations", 0, "name"), "lis"), (("operations", 1, "endpoint"), None),
        (("operations", 0, "default_params", "a"), None), (("operations", 0, "default_params", "a"), "1"), (("operations", 0, "default_params", "a"), ...),
        (("operations", 0, "request_params", 1, "label"), ""), (("operations", 0, "request_params"), [PARAM]), (("operations", 0, "response_params"), None),
        (("operations", 1, "source", "raw"), "{}"), (("operations", 1, "source"), None), (("operations",), []), (("operations",), None),
    ],
)
def test_any_leaf_matters(spark, path, value):
    a, b = digests(spark, [spec(), changed(path, value)])
    assert a != b


def test_order_of_operations_matters(spark):
    a, b = digests(spark, [spec(), spec(operations=spec()["operations"][::-1])])
    assert a != b


def test_open_objects_count_by_value(spark):
    """JSON text of any depth: keys and blanks don't matter, the order of arrays does; a VARIANT column gives the same."""
    texts = ['{"a": 1, "b": [1, {"d": "x", "c": null}]}', '{"b":[1,{"c":null,"d":"x"}],"a":1}', '{"a": 1, "b": [{"d": "x", "c": null}, 1]}', '{"a": 2, "b": []}', "no json", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    got = [r[0] for r in df.select(nested_digest(df, ["raw"], ("raw",))).collect()]
    assert got[0] == got[1] and len(set(got)) == 6
    variants = spark.createDataFrame([(t,) for t in texts[:4]], "raw string").select(F.parse_json("raw").alias("raw"))
    assert [r[0] for r in variants.select(nested_digest(variants, ["raw"])).collect()] == got[:4]


def test_texts_cannot_imitate_structure(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a1:b"],), (["a", "1:b"],), (["[0:]"],), ([],), (None,), ([None],), (["-"],)], "x array<string>")
    assert df.select(canonical_column(df, "x").alias("c")).distinct().count() == 8


def records(seed, n, touched):
    rng = random.Random(seed)
    old = {f"k{i}": (i, [{"name": f"n{i}", "label": None}], {"a": "1", "b": str(i)}) for i in range(n)}
    new = dict(old)
    for k in rng.sample(sorted(old), touched):
        match rng.randrange(4):
            case 0:
                del new[k]
            case 1:
                new[f"{k}x"] = old[k]
            case 2:
                new[k] = (old[k][0], [*old[k][1], PARAM], old[k][2])
            case _:
                new[k] = (old[k][0] + 1, old[k][1], old[k][2] | {"a": ""})
    return old, new


SCHEMA = f"id string, size int, params {model.PARAM}, defaults map<string,string>"


@pytest.mark.parametrize("touched", [0, 6, 400])
def test_blocks_find_what_the_full_join_finds(spark, tmp_path, touched):
    """Whatever has changed, the same rows as comparing all; what is read follows the changes."""
    old, new = records(7, 400, touched)
    frames = [spark.createDataFrame([(k, *v) for k, v in x.items()], SCHEMA).repartition(3) for x in (old, new)]
    paths = [str(tmp_path / name) for name in ("old", "new")]
    columns = ["size", "params", "defaults"]
    for df, path in zip(frames, paths, strict=True):
        snapshots.write_index(df, path, columns, buckets=64)
    got = {r["id"]: (r["change"], r["fields"], r["old_digest"] == r["new_digest"]) for r in snapshots.diff_indexes(spark, *paths, columns, buckets=64).collect()}
    want = {}
    for k in old.keys() | new.keys():
        if k not in new or k not in old:
            want[k] = ("added" if k in new else "removed", "", False)
        else:
            fields = sorted(c for c, x, y in zip(columns, old[k], new[k], strict=True) if x != y)
            want[k] = ("changed" if fields else "stable", ",".join(fields), not fields)
    assert {k: (c, f, bool(same)) for k, (c, f, same) in got.items()} == want
    kinds = [c for c, _, _ in want.values()]
    counts = snapshots.diff_counts(spark, *paths, columns, buckets=64).first()
    assert tuple(counts) == tuple(kinds.count(c) for c in ("added", "removed", "changed", "stable"))
    buckets = snapshots.changed_buckets(spark, *paths, 64)
    read = snapshots.index_rows(spark, paths[0]).where(F.col("bucket").isin(buckets))
    differing = sum(c != "stable" for c in kinds)
    assert len(buckets) <= differing and (touched > 6 or read.count() <= 20 * differing)
    if buckets:
        plan = snapshots.diff_indexes(spark, *paths, columns, buckets=64, stable=False)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in plan


def test_indexes_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([(None, 1, None, None)], SCHEMA)
    for name in ("a", "b"):
        snapshots.write_index(df, str(tmp_path / name), ["size"], buckets=8)
    assert snapshots.diff_indexes(spark, str(tmp_path / "a"), str(tmp_path / "b"), ["size"], buckets=8).collect() == []
    assert tuple(snapshots.diff_counts(spark, str(tmp_path / "a"), str(tmp_path / "b"), ["size"], 8).first()) == (0, 0, 0, 0)


def test_counts_leave_the_fields_where_they_are(spark, tmp_path):
    """Keys and digests are shuffled, a digest as its bytes; settings are as before."""
    old, new = records(9, 60, 20)
    columns, kept = ["size", "params", "defaults"], spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    for name, x in (("old", old), ("new", new)):
        snapshots.write_index(spark.createDataFrame([(k, *v) for k, v in x.items()], SCHEMA), str(tmp_path / name), columns, buckets=8)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept
    row = snapshots.index_rows(spark, str(tmp_path / "old")).first()
    assert len(row["digest"]) == 32 and len(row["fields"]) == 16 * len(columns)
    plan = snapshots.diff_counts(spark, str(tmp_path / "old"), str(tmp_path / "new"), columns, 8)._jdf.queryExecution().executedPlan().toString()
    assert "digest#" in plan and "fields#" not in plan


def test_stale_rows_count_repeats(spark):
    a = [(1, "x", None), (1, "x", None), (2, None, [1]), (3, "y", [2, 1])] + [(k, "z", [k]) for k in range(10, 400)]
    b = [(1, "x", None), (2, None, [1]), (3, "y", [1, 2]), (None, None, None), (None, None, None)] + [(k, "z", [k]) for k in range(10, 400)]
    schema = "k int, t string, v array<int>"
    got = snapshots.stale(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema).select("v", "t", "k"), 64).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(
        map(repr, [(1, "x", None, "regenerated"), (3, "y", [2, 1], "regenerated"), (3, "y", [1, 2], "kept"), (None, None, None, "kept"), (None, None, None, "kept")])
    )
    same = spark.createDataFrame(a, schema)
    assert snapshots.stale(same, same).collect() == [] and snapshots.stale(same.limit(0), same.limit(0)).collect() == []


def test_digests_of_flat_columns_tell_what_diff_specs_tells(spark):
    old, new = records(9, 60, 20)
    frames = [spark.createDataFrame([(k, v[0]) for k, v in x.items()], "id string, size int") for x in (old, new)]
    assert sorted(r["change"] for r in changes.diff_specs(*frames, ["size"]).collect() if r["change"] in ("added", "removed")) == sorted(
        "added" if k in new else "removed" for k in old.keys() ^ new.keys()
    )
