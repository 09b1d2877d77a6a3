"""The store of evidence in buckets against one merge of all batches."""

from __future__ import annotations

import os
import random

import pytest

from quillframe.operators import evidence
from quillframe.operators.evidence_store import EvidenceStore

SCHEMA = "dataset_id string, operation string, endpoint_host string, dependency_class string, status string, verified_at string, ordinal int"


def batch(spark, rng, n, ids):
    rows = []
    for k in range(n):
        key = (f"d{rng.choice(ids)}", rng.choice(["o", None, ""]), rng.choice(["h", None]), rng.choice(["soap", "wms"]))
        rows.append((*key, rng.choice(["verified", "failed", None]), rng.choice(["2026-01-01", "2026-01-02", None]), k))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def store(spark, tmp_path):
    own = EvidenceStore(spark, f"evidence_{tmp_path.name.replace('-', '_')}", str(tmp_path / "store"), buckets=16, parts=8)
    yield own
    spark.sql(f"DROP TABLE IF EXISTS {own.name}")


def test_batches_add_up_to_one_merge(spark, store):
    rng = random.Random(61)
    batches = [batch(spark, rng, 300, range(60)), batch(spark, rng, 5, [3]), batch(spark, rng, 40, range(50, 70)), batch(spark, rng, 0, [1])]
    batches[3] = spark.createDataFrame([], SCHEMA)
    written = [store.merge(b, k) for k, b in enumerate(batches)]
    want = evidence.merge_evidence(batches).collect()
    columns = [*SCHEMA.replace(" string", "").replace(" int", "").split(", "), "batch"]
    got = store.rows().select(*columns).collect()
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in want))) == sorted(map(repr, map(tuple, got)))
    assert len(written[1]) < 8 and written[3] == []
    again = store.merge(batches[2], 2)  # a batch that comes twice changes nothing
    assert again == written[2] and sorted(map(repr, map(tuple, store.rows().select(*columns).collect()))) == sorted(map(repr, map(tuple, got)))


def test_other_partitions_keep_their_files(spark, store):
    rng = random.Random(62)
    store.merge(batch(spark, rng, 400, range(100)), 0)
    before = files(store.path)
    written = store.merge(batch(spark, rng, 1, [7]), 1)
    after = files(store.path)
    assert len(written) == 1
    changed = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert changed and all(f"part={written[0]}/" in f for f in changed)


def test_joins_leave_the_store_where_it_is(spark, store):
    """Only the other side is exchanged; results equal those of the plain operators."""
    rng = random.Random(63)
    batches = [batch(spark, rng, 200, range(40)), batch(spark, rng, 60, range(40))]
    for k, b in enumerate(batches):
        store.merge(b, k)
    deps = batch(spark, rng, 300, range(60)).drop("status", "verified_at")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        gaps, attached = store.uncovered(deps), store.attach(deps, ["status", "verified_at"])
        for df in (gaps, attached):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.enabled")
    merged = evidence.merge_evidence(batches)
    assert sorted(map(repr, gaps.collect())) == sorted(map(repr, evidence.uncovered(deps, merged).collect()))
    want = evidence.attach_evidence(deps, merged, ["verified_at", "batch", "ordinal"], keep=["status", "verified_at"])
    assert sorted(map(repr, attached.collect())) == sorted(map(repr, want.collect()))


def test_a_batch_is_read_and_shuffled_once(spark, store):
    """Nothing but the store's own table is left of a merge; columns that can't be compared are kept too."""
    seen = spark.sparkContext.accumulator(0)

    def counted(row):
        seen.add(1)
        return row

    schema = f"{SCHEMA}, more map<string,int>"
    rows = [(f"d{k % 20}", None if k % 3 else "", "h", "soap", "verified", "2026-01-01", k, {"a": k}) for k in range(60)]
    names = ("spark.sql.shuffle.partitions", "spark.sql.sources.partitionOverwriteMode", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = [spark.conf.get(c) for c in names], spark.catalog.listTables()
    for number in (0, 1):
        store.merge(spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).map(counted), schema), number)
        assert seen.value == 60 * (number + 1)
    assert [spark.conf.get(c) for c in names] == before[0]
    assert {t.name for t in spark.catalog.listTables()} - {t.name for t in before[1]} == {store.name}
    got = sorted((r["dataset_id"], r["operation"], r["ordinal"], r["more"]["a"], r["batch"]) for r in store.rows().collect())
    last = {r[0]: r for r in rows}
    assert got == sorted((r[0], r[1], r[6], r[6], 1) for r in last.values())
    plan = store._last(spark.createDataFrame(rows, schema).drop("more").selectExpr("*", "0 AS batch"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "max_by" not in plan
