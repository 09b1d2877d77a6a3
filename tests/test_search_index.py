"""Searches by an index of trigrams and error rules by parts of texts, against plain versions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quillframe.functions.grams import grams, grams_or_whole
from quillframe.operators import changes, search, text_index


def test_grams(spark):
    texts = ["añb\U0001d4b3c", "aaaa", "ab", "", None, "abc"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [(sorted(a), None if b is None else sorted(b), sorted(c)) for a, b, c in df.select(grams(F.col("t")), grams_or_whole(F.col("t")), grams(F.col("t"), 1)).collect()]
    for t, (three, whole, one) in zip(texts, got, strict=True):
        want = sorted({t[i : i + 3] for i in range(len(t) - 2)}) if t is not None else []
        assert three == want and whole == (want if t is None or len(t) >= 3 else [t]) and one == sorted(set(t or ""))


def test_grams_of_a_long_text_take_linear_time(spark):
    df = spark.range(1).select(F.repeat(F.lit("all the same words again "), 20_000).alias("t"))
    assert df.select(F.size(grams(F.col("t")))).first()[0] == len({("all the same words again " * 2)[i : i + 3] for i in range(25)})


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = random.Random(51)
    words = ["Alpha", "beta", "ÉTÉ", "x", "yz", "data", "Database", "a\nb"]
    rows = [(f"k{i}", " ".join(rng.choices(words, k=rng.randint(0, 6))), rng.choice(["s1", "S2", None]), i) for i in range(150)]
    rows += [("k1", "another alpha of one key", "s", 200), (None, "alpha without a key", "s", 201), ("n", None, None, 202), ("e", "", "", 203), ("z", "yz", None, 204)]
    df = spark.createDataFrame(rows, "k string, t string, s string, i int").repartition(3)
    path = str(tmp_path_factory.mktemp("index") / "at")
    text_index.write_text_index(df, path, "k", ["t", "s"], ["i"], buckets=8)
    return df, path


@pytest.mark.parametrize("query", ["alpha", "ATA", "étÉ", "Z", "b", "", "zzz", "alphax", "a\ns2", "atabase x yz beta", "yz"])
def test_index_finds_what_a_scan_finds(spark, indexed, query):
    df, path = indexed
    want = search.search(df.where("k is not null"), query, ["t", "s"]).select("k", "i").collect()
    assert sorted(map(tuple, text_index.indexed_search(spark, path, query).collect())) == sorted(map(tuple, want))


def test_index_covers_every_row_and_reads_what_it_needs(spark, indexed):
    df, path = indexed
    kept = df.where("k is not null")
    assert spark.read.parquet(f"{path}/texts").count() == kept.count()
    own = spark.read.parquet(f"{path}/postings").groupBy("key").agg(F.sort_array(F.collect_list("gram")).alias("g"))
    folded = kept.groupBy("k").agg(F.collect_list(F.lower(F.concat_ws("\n", "t", "s"))).alias("t")).collect()
    got = {r["key"]: r["g"] for r in own.collect()}
    for k, texts in folded:
        assert got.get(k, []) == sorted({g for t in texts for g in ([t] if 0 < len(t) < 3 else [t[i : i + 3] for i in range(len(t) - 2)])})
    found = text_index.candidates(spark, path, "database")
    assert found.count() < kept.count()
    plan = text_index.indexed_search(spark, path, "database")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(", "")


def test_postings_stay_where_the_texts_are(spark, indexed, tmp_path):
    """Those of keys that aren't repeated; files are sorted, so that a search reads few of their pages."""
    df, _ = indexed
    names = df.where("k is not null").dropDuplicates(["k"])
    path = str(tmp_path / "at")
    text_index.write_text_index(names, path, "k", ["t", "s"], buckets=8)
    texts = spark.read.parquet(f"{path}/texts")
    assert "Exchange" not in text_index._postings(texts)._jdf.queryExecution().executedPlan().toString()
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    files = list((tmp_path / "at" / "postings").glob("*.parquet"))
    assert files and kept == spark.conf.get("spark.sql.files.maxPartitionBytes") != str(text_index.SEGMENT)
    for f in files:
        codes = [r["code"] for r in spark.read.parquet(str(f)).coalesce(1).collect()]
        assert codes == sorted(codes)
    twice = spark.createDataFrame([("a", "abcd"), ("a", "bcde"), ("b", "abc")], "key string, text string")
    assert sorted(map(tuple, text_index._postings(twice).collect())) == [("a", "abc"), ("a", "bcd"), ("a", "cde"), ("b", "abc")]


RULE = "rule_id kind classification http_status field value contains case_sensitive hosts dataset_ids operation_ids dependency_classes".split()
RULES = "rule_id string, kind string, classification string, http_status int, field string, value string, contains string, case_sensitive boolean, hosts array<string>, dataset_ids array<string>, operation_ids array<string>, dependency_classes array<string>"
RESULTS = "result_id long, host string, dataset_id string, operation string, cls string, http_status int, reason string, message string, fields map<string,string>"


def fits(result, rule):
    for column, scope in (("host", "hosts"), ("dataset_id", "dataset_ids"), ("operation", "operation_ids"), ("cls", "dependency_classes")):
        if rule.get(scope) and result[column] not in rule[scope]:
            return False
    fold = (lambda x: x) if rule.get("case_sensitive") else str.lower
    fields = result["fields"] or {}
    values = [v for v in ([fields.get(rule["field"])] if rule.get("field") is not None else fields.values()) if v is not None]
    match rule["kind"]:
        case "http_status":
            return rule.get("http_status") is not None and result["http_status"] == rule["http_status"]
        case "field_equals":
            return rule.get("value") is not None and any(fold(v) == fold(rule["value"]) for v in values)
        case "field_contains":
            return rule.get("contains") is not None and any(fold(rule["contains"]) in fold(v) for v in values)
        case "message_contains":
            return rule.get("contains") is not None and result["message"] is not None and fold(rule["contains"]) in fold(result["message"])
        case "unknown":
            return True
        case kind:
            return result["reason"] == kind


def test_rules_against_every_result(spark):
    rng = random.Random(52)
    texts = ["Daily LIMIT exceeded", "limit", "LI", "É limité", "", None, "x", "no such key: serviceKey", "SERVICE key"]
    results = []
    for k in range(120):
        fields = {f: rng.choice(texts) or "" for f in rng.sample(["code", "note", "msg"], rng.randint(0, 3))}
        results.append((k % 100, rng.choice(["a", "b", None]), rng.choice(["d1", "d2"]), rng.choice(["o", None]), rng.choice(["soap", "wms"]), rng.choice([200, 404, None]), rng.choice(["timeout", None]), rng.choice(texts), fields if k % 9 else None))
    results = list({r[0]: r for r in results}.values())
    rules = []
    for k in range(150):
        rule = {"rule_id": f"r{k}", "kind": rng.choice(["message_contains"] * 3 + ["field_contains"] * 3 + ["field_equals"] * 2 + ["http_status", "timeout", "unknown"]), "classification": "c"}
        rule |= {"contains": rng.choice(["limit", "LIMIT", "li", "É", "é L", "", None, "key", "ervice", "zzz", "y: s"]), "value": rng.choice([*texts, "LIMIT"]), "field": rng.choice([None, "code", "note"])}
        rule |= {"http_status": rng.choice([404, 200, None]), "case_sensitive": rng.choice([True, False, None]), "hosts": rng.choice([None, [], ["a"], ["a", "b"]]), "dependency_classes": rng.choice([None, ["soap"]])}
        rules.append(rule)
    df = spark.createDataFrame(results, RESULTS).repartition(3)
    names = RESULTS.replace(",string>", ">").split(", ")
    own = [dict(zip((n.split()[0] for n in names), r, strict=True)) for r in results]
    found = changes.match_error_rules(df, spark.createDataFrame([tuple(r.get(c) for c in RULE) for r in rules], RULES))
    got = sorted((r["result_id"], r["rule_id"]) for r in found.collect())
    assert got == sorted((x["result_id"], r["rule_id"]) for x in own for r in rules if fits(x, r)) and len(got) > 1000
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert changes.match_error_rules(df, spark.createDataFrame([], RULES)).collect() == []
    assert changes.match_error_rules(df.limit(0), spark.createDataFrame([tuple(r.get(c) for c in RULE) for r in rules], RULES)).collect() == []
