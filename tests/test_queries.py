"""Every catalogue query against its SQL on the smallest tables, and plans that must not change."""

from __future__ import annotations

import math

import duckdb
import pytest

from pyspark.sql import functions as F

from quillframe import catalogue_queries
from quillframe.sources import shared

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def comparable(value):
    if isinstance(value, float):
        return "None" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value)


@pytest.mark.parametrize("name", sorted(catalogue_queries.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    found = catalogue_queries.queries()[name](spark, SF)
    relation = db.execute(catalogue_queries.oracle_sql()[name])
    columns = [d[0] for d in relation.description]
    assert sorted(found.columns) == sorted(columns)
    order = sorted(columns)
    got = sorted(tuple(comparable(r[c]) for c in order) for r in found.collect())
    want = sorted(tuple(comparable(r[columns.index(c)]) for c in order) for r in relation.fetchall())
    assert got == want


def test_every_query_has_sql():
    assert set(catalogue_queries.queries()) == set(catalogue_queries.oracle_sql())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    """A filter on a part's key and the two columns asked for, and nothing else, are read."""
    from quillframe.operators import search

    part = spark.read.parquet(f"{SF}/part.parquet").withColumn("id", F.col("p_partkey"))
    text = plan(search.apply_filters(part, p_brand="Brand#12").select("id", "p_name"))
    assert "PushedFilters: [IsNotNull(p_brand), EqualTo(p_brand,Brand#12)]" in text
    assert "p_retailprice" not in text


@pytest.mark.parametrize("name", ["adapter_targets", "classified_operations", "catalog_audit"])
def test_urls_are_cut_once_a_row(spark, name):
    """One cut of the endpoint and one of the guide for each time that the operations are read, whatever filters follow."""
    text = catalogue_queries.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    reads = sum("Relation" in line and "l_orderkey" in line for line in text.splitlines())
    assert 0 < text.count("regexp_replace(") <= 2 * reads


def reads(df):
    """How often a plan reads the table of operations."""
    return sum("Relation" in line and "l_orderkey" in line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines())


@pytest.mark.parametrize("name", ["institution_overview", "provider_backlog", "coverage", "external_coverage", "external_cross_checks", "route_dispositions"])
def test_reports_classify_operations_once(spark, monkeypatch, name):
    """Classified operations are written once a job; what follows reads them alone."""
    from quillframe.plans import lens

    written = []

    def counted(df):
        written.append(df)
        return shared.stored(df)

    monkeypatch.setattr(lens, "stored", counted)
    assert reads(catalogue_queries.queries()[name](spark, SF)) == 0
    assert [reads(df) for df in written] == [1]


def test_an_audit_reads_operations_once(spark):
    assert reads(catalogue_queries.queries()["catalog_audit"](spark, SF)) == 1


def test_an_audit_of_repeated_and_nameless_specs(spark):
    """Two specs of one id share its operations, which count once; neither null ids nor null data sets meet."""
    from quillframe.operators import reports

    specs = spark.createDataFrame([("a", "o", "u", "t"), ("a", None, "u", " "), (None, "o", "", None), ("b", "o", "u", "t")], "id string, organization string, url string, updated_at string")
    deps = spark.createDataFrame(
        [("a", "http://x/y", "external_endpoint", True), ("a", " ", "no_endpoint", False), (None, "http://x/y", "external_endpoint", True), ("z", None, "no_endpoint", False)],
        "dataset_id string, endpoint string, dependency_class string, callable boolean",
    ).selectExpr("*", "CAST(0 AS BIGINT) AS request_params_count", "CAST(1 AS BIGINT) AS response_params_count", "'manual' AS dev_approval", "CAST(NULL AS STRING) AS prod_approval", "'no url' AS guide_url", "CAST(NULL AS STRING) AS guide_host")
    got = {r["metric"]: r["value"] for r in reports.catalog_audit(specs, deps).collect()}
    want = {"specs_total": 4, "specs_without_operations": 2, "specs_without_callable_operation": 2, "specs_missing_organization": 1, "specs_missing_source_url": 1, "specs_missing_updated_at": 2, "external_endpoint_specs": 2, "gateway_with_external_guide_specs": 0}
    want |= {"operations_total": 4, "callable_operations": 2, "operations_without_endpoint": 2, "operations_without_request_params": 4, "operations_without_response_params": 0, "external_endpoint_operations": 2, "malformed_guide_url_count": 4, "dev_approval_required_operations": 4, "prod_approval_required_operations": 0}
    assert {k: got[k] for k in want} == want
    assert set(reports.catalog_audit(specs.limit(0), deps.limit(0)).toPandas()["value"]) == {0.0}


def test_no_query_runs_python(spark):
    for name, query in catalogue_queries.queries().items():
        text = plan(query(spark, SF))
        assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text, name


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
