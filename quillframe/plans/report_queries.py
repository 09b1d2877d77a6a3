"""Queries of classification, evidence and the reports, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.functions import columns as C
from quillframe.operators import checks, classify, evidence, reports, search
from quillframe.operators.evidence_store import EvidenceStore
from quillframe.plans.lens import ORDER, SAME_KEY_SQL, Lens, with_views
from quillframe.sources import readers
from quillframe.sources.shared import scratch_path

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, views: bool = True):
    """Registers a query of a ``Lens`` under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Lens(spark, sf_dir))
        QUERIES[f.__name__].__doc__ = f.__doc__
        if sql is not None:
            SQL[f.__name__] = with_views(sql) if views else sql
        return f

    return add


PCT = "CASE WHEN {w} > 0 THEN ((2000 * CAST({p} AS BIGINT) + CAST({w} AS BIGINT)) // (2 * CAST({w} AS BIGINT))) / 10.0 ELSE 0.0 END"
ORG = "coalesce(nullif(organization, ''), 'Unknown')"


def pct(p: str, w: str) -> str:
    return f"CAST({PCT.format(p=p, w=w)} AS DOUBLE)"


@query(f"""
, a AS (SELECT {ORG} AS organization, count(DISTINCT nullif(id, '')) AS api_count FROM specs GROUP BY 1),
o AS (SELECT {ORG} AS organization, count(DISTINCT nullif(dataset_id, '')) AS operation_api_count, count(*) AS operation_count,
  count(*) FILTER (has_evidence) AS evidence_count,
  count(*) FILTER (status = 'verified') AS verified_count, count(*) FILTER (status = 'failed') AS failed_count,
  count(*) FILTER (status = 'skipped') AS skipped_count,
  count(*) FILTER (has_evidence AND coalesce(nullif(status, ''), 'unknown') = 'unknown') AS unknown_count,
  count(*) FILTER (approval_required) AS approval_count, count(*) FILTER (dependency_class = 'no_endpoint') AS no_endpoint_count
  FROM attached GROUP BY 1)
SELECT coalesce(a.organization, o.organization) AS organization, coalesce(api_count, 0) AS api_count,
  coalesce(operation_api_count, 0) AS operation_api_count, coalesce(operation_count, 0) AS operation_count,
  coalesce(evidence_count, 0) AS evidence_count, coalesce(verified_count, 0) AS verified_count, coalesce(failed_count, 0) AS failed_count,
  coalesce(skipped_count, 0) AS skipped_count, coalesce(unknown_count, 0) AS unknown_count, coalesce(approval_count, 0) AS approval_count,
  coalesce(no_endpoint_count, 0) AS no_endpoint_count, {pct("coalesce(evidence_count, 0)", "coalesce(operation_count, 0)")} AS evidence_percent
FROM a FULL JOIN o ON a.organization = o.organization""")
def institution_overview(lens: Lens) -> DataFrame:
    """A1, J1, J3, W1, T1."""
    deps = lens.kept()
    return reports.institution_overview(lens.specs(), deps, lens.evidence(deps), ORDER)


@query(f"SELECT {ORG} AS organization, coalesce(nullif(dependency_class, ''), 'unknown') AS value, count(*) AS n FROM deps GROUP BY 1, 2")
def institution_classes(lens: Lens) -> DataFrame:
    """A1: class histogram."""
    return reports.institution_histogram(lens.deps(), "dependency_class")


def _top_sql(value: str) -> str:
    return f"""SELECT organization, value, n, place FROM (SELECT *, row_number() OVER (PARTITION BY organization ORDER BY n DESC, value) AS place FROM
      (SELECT {ORG} AS organization, {value} AS value, count(*) AS n FROM deps WHERE coalesce({value}, '') <> '' GROUP BY 1, 2)) WHERE place <= 5"""


@query("SELECT t.*, adapter, can_call FROM (" + _top_sql("route_host") + ") t LEFT JOIN (SELECT b.host, b.name AS adapter, a.can_call FROM by_host b JOIN adapters a ON a.name = b.name) h ON h.host = t.value")
def institution_top_hosts(lens: Lens) -> DataFrame:
    """Hosts with their adapters."""
    top = reports.top_hosts_with_adapters(reports.institution_top(lens.deps(), "route_host"), lens.adapters())
    return top.select("organization", "value", "n", "place", "adapter", F.array_contains("capabilities", "call").alias("can_call"))


@query(_top_sql("source_category"))
def institution_top_categories(lens: Lens) -> DataFrame:
    """Categories."""
    return reports.institution_top(lens.deps(), "source_category", default="unknown")


@query(f"""SELECT (SELECT count(DISTINCT o) FROM (SELECT {ORG} AS o FROM specs UNION ALL SELECT {ORG} FROM deps)) AS institutions,
  (SELECT count(DISTINCT nullif(id, '')) FROM specs) AS apis, (SELECT count(*) FROM deps) AS operations, (SELECT count(*) FROM deps WHERE callable) AS callable_operations,
  (SELECT count(*) FROM deps WHERE dependency_class = 'external_endpoint') AS external_endpoint_operations, (SELECT count(*) FROM deps WHERE adapter_status = 'adapter') AS registered_adapter_operations,
  (SELECT count(*) FROM deps WHERE adapter_status = 'missing') AS missing_adapter_operations, (SELECT count(DISTINCT route_host) FROM deps WHERE adapter_status = 'missing') AS missing_adapter_hosts,
  (SELECT count(*) FROM evidence) AS evidence, (SELECT count(*) FROM evidence WHERE status = 'verified') AS verified,
  {pct("(SELECT count(*) FROM evidence)", "(SELECT count(*) FROM deps)")} AS evidence_percent""")
def overview_summary(lens: Lens) -> DataFrame:
    """A3."""
    deps = lens.kept()
    return reports.overview_summary(lens.specs(), deps, lens.evidence(deps))


_TOP = """SELECT grouping, value, n, place FROM (SELECT *, row_number() OVER (PARTITION BY grouping ORDER BY n DESC, value) AS place FROM (
  SELECT 'route_host' AS grouping, route_host AS value, count(*) AS n FROM deps WHERE route_host IS NOT NULL GROUP BY 2 UNION ALL
  SELECT 'source_category', coalesce(nullif(source_category, ''), 'unknown'), count(*) FROM deps GROUP BY 2)) WHERE place <= 20"""


@query(_TOP)
def top_values(lens: Lens) -> DataFrame:
    """Hosts and categories."""
    return reports.top_values(lens.deps())


@query(f"SELECT value AS host, n AS operations FROM ({_TOP}) WHERE grouping = 'route_host'")
def top_hosts(lens: Lens) -> DataFrame:
    """Hosts alone."""
    return reports.top_values(lens.deps()).where("grouping = 'route_host'").select(F.col("value").alias("host"), F.col("n").alias("operations"))


@query(f"""
, a AS (SELECT {ORG} AS organization, count(DISTINCT nullif(id, '')) AS api_count FROM specs GROUP BY 1),
o AS (SELECT {ORG} AS organization, count(*) AS operation_count FROM deps GROUP BY 1)
SELECT organization, coalesce(api_count, 0) AS api_count, coalesce(operation_count, 0) AS operation_count FROM a FULL JOIN o USING (organization)
ORDER BY 2 DESC, 3 DESC, 1 LIMIT 30""")
def institutions_by_apis(lens: Lens) -> DataFrame:
    """T3."""
    deps = lens.kept()
    overview = reports.institution_overview(lens.specs(), deps, lens.evidence(deps), ORDER)
    return reports.ranking_by_apis(overview).select("organization", "api_count", "operation_count")


@query("""
, o AS (SELECT dataset_id, operation, row_number() OVER (PARTITION BY dataset_id ORDER BY part_key, supp_key, price, operation) - 1 AS ordinal, endpoint
  FROM raw_deps WHERE dataset_id <> '')
SELECT s.id, o.operation, CAST(o.ordinal AS INTEGER) AS ordinal FROM specs s LEFT JOIN o ON s.id = o.dataset_id""")
def operations_flat(lens: Lens) -> DataFrame:
    """Every spec and operation."""
    return lens.operations().select("id", "operation", "ordinal")


@query("""
, q AS (SELECT dataset_id AS id, request_params_count AS n FROM raw_deps JOIN specs ON dataset_id = id)
SELECT direction, name, count(*) AS n FROM (
  SELECT 'request' AS direction, 'q' || CAST(unnest(range(1, n + 1)) AS VARCHAR) AS name FROM q UNION ALL
  SELECT 'response', CASE part_key % 5 WHEN 0 THEN 'resultCode' WHEN 1 THEN 'resultMsg' WHEN 2 THEN 'returnAuthMsg' WHEN 3 THEN 'errMsg' ELSE 'total' END
  FROM raw_deps JOIN specs ON dataset_id = id) GROUP BY 1, 2""")
def parameters(lens: Lens) -> DataFrame:
    """Request and response parameters by name."""
    return classify.params(lens.operations()).groupBy("direction", "name").agg(F.count("*").alias("n"))


_RESPONSES = """
, r AS (SELECT dataset_id AS id, operation, CASE part_key % 5 WHEN 0 THEN 'resultCode' WHEN 1 THEN 'resultMsg' WHEN 2 THEN 'returnAuthMsg' WHEN 3 THEN 'errMsg' ELSE 'total' END AS name
  FROM raw_deps JOIN specs ON dataset_id = id),
x AS (SELECT *, CASE name WHEN 'resultCode' THEN 'result_code' WHEN 'resultMsg' THEN 'result_message' WHEN 'returnAuthMsg' THEN 'auth_message' WHEN 'errMsg' THEN 'error_message' END AS role FROM r)
"""


def _responses(lens: Lens) -> DataFrame:
    return classify.params(lens.operations()).where("direction = 'response'")


@query(_RESPONSES + """SELECT name, role, count(DISTINCT id) AS specs, count(DISTINCT id || '/' || operation) AS operations,
  array_to_string(list_sort(list_distinct(list(id)))[1:3], ',') AS sample_ids FROM x WHERE role IS NOT NULL GROUP BY 1, 2""")
def error_catalog(lens: Lens) -> DataFrame:
    """A15, P10."""
    return reports.error_catalog(_responses(lens)).withColumn("sample_ids", F.array_join("sample_ids", ","))


@query(_RESPONSES + """SELECT id, operation, array_to_string(list_sort(list_distinct(list(name || ':' || role))), ',') AS fields FROM x WHERE role IS NOT NULL GROUP BY 1, 2""")
def error_operations(lens: Lens) -> DataFrame:
    """The fields of each operation."""
    return reports.error_operations(_responses(lens)).withColumn("fields", F.array_join("fields", ","))


@query(_RESPONSES + """, o AS (SELECT id, operation, bool_or(role = 'result_code') AS a, bool_or(role = 'result_message') AS b, bool_or(role = 'auth_message') AS c, bool_or(role = 'error_message') AS d FROM x WHERE role IS NOT NULL GROUP BY 1, 2)
SELECT metric, CAST(value AS DOUBLE) AS value FROM (SELECT 'specs_total' AS metric, (SELECT count(*) FROM specs) AS value UNION ALL SELECT 'operations_total', (SELECT count(*) FROM r)
  UNION ALL SELECT 'operations_with_status_fields', (SELECT count(*) FROM o) UNION ALL SELECT 'operations_with_result_code', (SELECT count(*) FROM o WHERE a)
  UNION ALL SELECT 'operations_with_result_message', (SELECT count(*) FROM o WHERE b) UNION ALL SELECT 'operations_with_reason_code', 0
  UNION ALL SELECT 'operations_with_auth_message', (SELECT count(*) FROM o WHERE c) UNION ALL SELECT 'operations_with_error_message', (SELECT count(*) FROM o WHERE d)
  UNION ALL SELECT 'distinct_status_field_names', (SELECT count(DISTINCT name) FROM x WHERE role IS NOT NULL)
  UNION ALL SELECT 'distinct_status_field_name_roles', (SELECT count(DISTINCT name || role) FROM x WHERE role IS NOT NULL))""")
def error_totals(lens: Lens) -> DataFrame:
    """The ten totals."""
    ops = lens.operations()
    return reports.error_totals(lens.specs(), ops.select("id", "operation"), classify.params(ops).where("direction = 'response'"))


@query("SELECT dataset_id, operation, part_key, supp_key, dependency_class, endpoint_host, route_host, adapter, adapter_status, approval_required, callable FROM deps")
def classified_operations(lens: Lens) -> DataFrame:
    """P6, P7, P8, P9, J2."""
    return lens.deps().select(
        "dataset_id", "operation", "part_key", "supp_key", "dependency_class", "endpoint_host", "route_host", "adapter", "adapter_status", "approval_required", "callable"
    )


@query("""
, m AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ['key', 'page'] WHEN event_id % 3 = 1 THEN ['key'] ELSE [] END AS missing,
  CASE event_id % 9 WHEN 0 THEN 'soap' WHEN 1 THEN 'no_endpoint' WHEN 2 THEN 'service_root' WHEN 3 THEN 'wms' WHEN 4 THEN 'malformed_endpoint' ELSE 'gateway' END AS cls,
  event_id % 11 = 0 AS approval, event_id % 2 = 0 AS has_key, event_id % 13 = 0 AS mutates,
  CASE WHEN event_id % 5 = 0 THEN true WHEN event_id % 5 = 1 THEN false END AS ok,
  CASE WHEN event_id % 4 = 0 THEN 404 WHEN event_id % 4 = 1 THEN 200 WHEN event_id % 4 = 2 THEN 500 END AS http_status,
  CASE WHEN event_id % 3 = 0 THEN 'html' ELSE 'json' END AS body_shape FROM events)
SELECT event_id, array_to_string(missing, ',') AS missing,
  CASE WHEN cls = 'soap' OR cls = 'wms' THEN 'unsupported_protocol' WHEN cls = 'no_endpoint' OR cls = 'malformed_endpoint' THEN 'metadata_only' WHEN mutates THEN 'mutation_endpoint'
    WHEN cls = 'service_root' THEN 'missing_operation_path' WHEN approval THEN 'approval_required' WHEN len(missing) > 0 THEN 'missing_required_params' WHEN NOT has_key THEN 'missing_auth' END AS reason,
  CASE WHEN ok THEN 'provider_ok' WHEN NOT ok THEN 'provider_error' WHEN http_status BETWEEN 400 AND 499 THEN 'http_error'
    WHEN http_status BETWEEN 200 AND 299 AND body_shape = 'html' THEN 'html_response' END AS semantic_status
FROM m""")
def preflight(lens: Lens) -> DataFrame:
    """P23, P24, P25 over events."""
    k = F.col("event_id")
    cls = F.when(k % 9 == 0, "soap").when(k % 9 == 1, "no_endpoint").when(k % 9 == 2, "service_root").when(k % 9 == 3, "wms").when(k % 9 == 4, "malformed_endpoint").otherwise("gateway")
    given = F.create_map(F.lit("key"), F.when(k % 3 < 2, "").otherwise("x"), F.lit("page"), F.when(k % 3 == 0, "").otherwise("1"))
    rows = lens.table("events").select("event_id", classify.missing_params(given).alias("missing"), cls.alias("cls"))
    http = F.when(k % 4 == 0, 404).when(k % 4 == 1, 200).when(k % 4 == 2, 500)
    ok = F.when(k % 5 == 0, True).when(k % 5 == 1, False)
    return rows.select(
        "event_id",
        F.array_join("missing", ",").alias("missing"),
        classify.preflight_reason(F.col("cls"), k % 11 == 0, F.col("missing"), k % 2 == 0, k % 13 == 0).alias("reason"),
        classify.semantic_status(ok, http, F.when(k % 3 == 0, "html").otherwise("json")).alias("semantic_status"),
    )


@query(f"SELECT dataset_id, operation, part_key, supp_key, price, has_evidence, status, reason FROM attached")
def operations_with_evidence(lens: Lens) -> DataFrame:
    """J1, W1."""
    deps = lens.kept()
    own = deps.select("dataset_id", "operation", "endpoint_host", "dependency_class", "part_key", "supp_key", "price")
    out = evidence.attach_evidence(own, lens.evidence(deps), ORDER, keep=["status", "reason"])
    return out.select("dataset_id", "operation", "part_key", "supp_key", "price", F.col("evidence").isNotNull().alias("has_evidence"), "evidence.status", "evidence.reason")


@query(f"SELECT dataset_id, operation, endpoint_host, dependency_class, status, reason, part_key, supp_key FROM latest")
def latest_evidence(lens: Lens) -> DataFrame:
    """W1."""
    return evidence.latest(lens.evidence(), ORDER).select("dataset_id", "operation", "endpoint_host", "dependency_class", "status", "reason", "part_key", "supp_key")


_MERGED = """
, b AS (SELECT *, CASE WHEN part_key % 2 = 0 THEN 0 ELSE 1 END AS batch FROM evidence),
m AS (SELECT *, row_number() OVER (PARTITION BY coalesce(dataset_id, ''), coalesce(operation, ''), coalesce(endpoint_host, ''), coalesce(dependency_class, '')
  ORDER BY verified_at DESC, batch DESC, part_key DESC, supp_key DESC, price DESC) AS rn FROM b)
"""


def _batches(lens: Lens) -> list[DataFrame]:
    every = lens.evidence().withColumn("ordinal", F.struct("part_key", "supp_key", "price"))
    return [every.where("part_key % 2 = 0"), every.where("part_key % 2 = 1")]


@query(_MERGED + "SELECT status, batch, count(*) AS n FROM m WHERE rn = 1 GROUP BY 1, 2")
def merged_evidence(lens: Lens) -> DataFrame:
    """Two batches merged, the last per key kept."""
    return evidence.merge_evidence(_batches(lens)).groupBy("status", "batch").agg(F.count("*").alias("n"))


@query(_MERGED + """SELECT count(*) FILTER (rn = 1) AS total, count(*) FILTER (rn = 1 AND status = 'verified') AS verified, count(*) FILTER (rn = 1 AND status = 'failed') AS failed,
  count(*) FILTER (rn = 1 AND status = 'skipped') AS skipped, count(*) FILTER (rn = 1 AND status = 'unknown') AS unknown, CAST(count(*) AS BIGINT) AS rows_read, CAST(50 AS BIGINT) AS "limit" FROM m""")
def merged_evidence_summary(lens: Lens) -> DataFrame:
    """The merged report's limit and counts."""
    batches = _batches(lens)
    return evidence.merged_summary(batches, evidence.merge_evidence(batches), [20, 30])


def _store(lens: Lens) -> EvidenceStore:
    """The batches of ``merged_evidence``, each merged into a store of its own name."""
    path = scratch_path(lens.spark)
    store = EvidenceStore(lens.spark, f"evidence_{path.rpartition('-')[2]}", path, buckets=16, parts=8)
    for k, batch in enumerate(_batches(lens)):
        store.merge(batch, k)
    return store


@query(_MERGED + "SELECT status, batch, count(*) AS n FROM m WHERE rn = 1 GROUP BY 1, 2")
def stored_evidence(lens: Lens) -> DataFrame:
    """U1 in buckets: what is kept after two batches."""
    return _store(lens).rows().groupBy("status", "batch").agg(F.count("*").alias("n"))


@query(_MERGED + f"""SELECT d.dependency_class, count(*) AS operations, count(*) FILTER (e.dataset_id IS NULL) AS uncovered, count(*) FILTER (e.status = 'verified') AS verified
FROM deps d LEFT JOIN (SELECT * FROM m WHERE rn = 1) e ON {SAME_KEY_SQL} GROUP BY 1""")
def stored_evidence_use(lens: Lens) -> DataFrame:
    """J1, J6 against the store: operations by class with and without evidence."""
    attached = _store(lens).attach(lens.deps(), ["status"])
    return attached.groupBy("dependency_class").agg(
        F.count("*").alias("operations"), F.count_if(F.col("evidence").isNull()).alias("uncovered"), F.count_if(F.col("evidence.status") == "verified").alias("verified")
    )


@query("SELECT source_id, count(*) AS specs, count(region) AS with_region FROM (SELECT 'a' AS source_id, NULL AS region FROM specs UNION ALL SELECT 'b', r_name FROM nation JOIN region ON n_regionkey = r_regionkey) GROUP BY 1")
def united_sources(lens: Lens) -> DataFrame:
    """Two registries with different columns in one release."""
    other = lens.table("nation").join(lens.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("id"), F.col("r_name").alias("region"))
    both = readers.union_sources({"a": lens.specs().select("id", "title"), "b": other})
    return both.groupBy("source_id").agg(F.count("*").alias("specs"), F.count("region").alias("with_region"))


_GROUPS = "status reason provider endpoint_host dependency_class".split()
_GROUPED = " UNION ALL ".join(f"SELECT '{g}' AS grouping, CAST({g} AS VARCHAR) AS value, count(*) AS n FROM {{t}} WHERE {g} IS NOT NULL GROUP BY {g}" for g in _GROUPS)


@query(f"""
, g AS ({_GROUPED.format(t="evidence")}),
r AS (SELECT *, row_number() OVER (PARTITION BY grouping ORDER BY n DESC, value) AS place FROM g)
SELECT grouping, value, n, place FROM r WHERE place <= 40 UNION ALL SELECT 'total', '', count(*), 1 FROM evidence""")
def verification_summary(lens: Lens) -> DataFrame:
    """A4, A2: five groupings, each cut to 40."""
    return evidence.verification_summary(lens.evidence(), limit=40)


@query("""
, k AS (SELECT DISTINCT coalesce(dataset_id, '') AS a, coalesce(operation, '') AS b, coalesce(endpoint_host, '') AS c, coalesce(dependency_class, '') AS d FROM evidence)
SELECT dataset_id, operation, part_key, supp_key, price FROM deps x WHERE NOT EXISTS (SELECT 1 FROM k WHERE a = coalesce(x.dataset_id, '') AND b = coalesce(x.operation, '')
  AND c = coalesce(x.endpoint_host, '') AND d = coalesce(x.dependency_class, ''))""")
def operations_without_evidence(lens: Lens) -> DataFrame:
    """J6."""
    deps = lens.deps()
    return evidence.uncovered(deps, lens.evidence(deps)).select("dataset_id", "operation", "part_key", "supp_key", "price")


_PLAN = """
, k AS (SELECT DISTINCT coalesce(dataset_id, '') AS a, coalesce(operation, '') AS b, coalesce(endpoint_host, '') AS c, coalesce(dependency_class, '') AS d FROM evidence),
c AS (SELECT x.*, CASE WHEN dependency_class = 'gateway' THEN 'gateway' ELSE adapter END AS batch, k.a IS NULL AS open FROM deps x
  LEFT JOIN k ON a = coalesce(x.dataset_id, '') AND b = coalesce(x.operation, '') AND c = coalesce(x.endpoint_host, '') AND d = coalesce(x.dependency_class, '') WHERE callable),
p AS (SELECT batch, count(*) AS candidates, count(*) FILTER (open) AS uncovered, least(count(*) FILTER (open), 100) AS planned FROM c WHERE batch IS NOT NULL GROUP BY 1)
"""


def _plan(lens: Lens) -> DataFrame:
    deps = lens.deps()
    batch = F.when(F.col("dependency_class") == "gateway", "gateway").otherwise(F.col("adapter"))
    return evidence.verification_plan(deps.where("callable"), lens.evidence(deps), batch, 100)


@query(_PLAN + "SELECT * FROM p")
def verification_plan(lens: Lens) -> DataFrame:
    """A13."""
    return _plan(lens)


@query(_PLAN + "SELECT CASE WHEN batch = 'gateway' THEN 'gateway' ELSE 'adapter' END AS kind, CAST(sum(planned) AS BIGINT) AS planned FROM p GROUP BY 1")
def planned_by_kind(lens: Lens) -> DataFrame:
    """A14."""
    return evidence.planned_by_kind(_plan(lens), F.when(F.col("batch") == "gateway", "gateway").otherwise("adapter"))


@query(f"""
, x AS (SELECT organization, count(*) AS operations, count(*) FILTER (has_evidence) AS e FROM attached GROUP BY 1)
SELECT organization, {pct("e", "operations")} AS evidence_percent, CAST(ceil(operations * 350 / 1000) AS BIGINT) AS target,
  CAST(greatest(0, ceil(operations * 350 / 1000) - e) AS BIGINT) AS remaining,
  CASE WHEN e < ceil(operations * 350 / 1000) THEN 'below' WHEN e = ceil(operations * 350 / 1000) THEN 'at' ELSE 'above' END AS state FROM x""")
def evidence_growth(lens: Lens) -> DataFrame:
    """A11 per organization, target 35 %."""
    deps = lens.deps()
    x = evidence.attach_evidence(deps, lens.evidence(deps), ORDER, keep=["status"]).groupBy("organization").agg(F.count("*").alias("operations"), F.count("evidence").alias("e"))
    return x.select("organization", *evidence.evidence_growth(F.col("operations"), F.col("e"), 35.0))


@query("SELECT dependency_class, count(*) AS n FROM evidence GROUP BY 1")
def evidence_by_kind(lens: Lens) -> DataFrame:
    """A12, A2."""
    return reports.count_by(lens.evidence(), "dependency_class")


@query("""
, n AS (SELECT dataset_id, count(*) FILTER (callable) AS n_callable, count(*) FILTER (dependency_class = 'gateway' AND guide_host <> 'apis.gateway.example') AS n_guided,
  count(*) FILTER (dependency_class = 'external_endpoint') AS n_external FROM deps GROUP BY 1),
s AS (SELECT * FROM specs LEFT JOIN n ON id = dataset_id),
a AS (SELECT count(*) AS specs_total, count(*) FILTER (dataset_id IS NULL) AS specs_without_operations, count(*) FILTER (coalesce(n_callable, 0) = 0) AS specs_without_callable_operation,
  count(*) FILTER (coalesce(organization, '') = '') AS specs_missing_organization, count(*) FILTER (coalesce(url, '') = '') AS specs_missing_source_url,
  count(*) FILTER (coalesce(updated_at, '') = '') AS specs_missing_updated_at, count(*) FILTER (n_guided > 0) AS gateway_with_external_guide_specs, count(*) FILTER (n_external > 0) AS external_endpoint_specs FROM s),
b AS (SELECT count(*) AS operations_total, count(*) FILTER (callable) AS callable_operations, count(*) FILTER (coalesce(trim(endpoint), '') = '') AS operations_without_endpoint,
  count(*) FILTER (request_params_count = 0) AS operations_without_request_params, count(*) FILTER (response_params_count = 0) AS operations_without_response_params,
  count(*) FILTER (dependency_class = 'gateway') AS gateway_operations, count(*) FILTER (dependency_class = 'external_endpoint') AS external_endpoint_operations,
  count(*) FILTER (dependency_class = 'service_root') AS service_root_operations, count(*) FILTER (dependency_class = 'soap') AS soap_operations, count(*) FILTER (dependency_class = 'wms') AS wms_operations,
  count(*) FILTER (dev_approval = 'manual') AS dev_approval_required_operations, count(*) FILTER (prod_approval = 'manual') AS prod_approval_required_operations,
  count(*) FILTER (dependency_class = 'malformed_endpoint') AS malformed_endpoint_url_count, count(*) FILTER (guide_url = 'ask the office') AS malformed_guide_url_count FROM deps)
SELECT metric, CAST(value AS DOUBLE) AS value FROM (UNPIVOT a ON COLUMNS(*) INTO NAME metric VALUE value) UNION ALL SELECT metric, CAST(value AS DOUBLE) FROM (UNPIVOT b ON COLUMNS(*) INTO NAME metric VALUE value)""")
def catalog_audit(lens: Lens) -> DataFrame:
    """A5."""
    return reports.catalog_audit(lens.specs(), lens.deps())


@query("""
, h AS (SELECT 'endpoint_host' AS grouping, endpoint_host AS value FROM deps UNION ALL SELECT 'external_endpoint_host', endpoint_host FROM deps WHERE dependency_class = 'external_endpoint'
  UNION ALL SELECT 'external_guide_host', guide_host FROM deps WHERE guide_host <> 'apis.gateway.example'),
c AS (SELECT grouping, value, count(*) AS n FROM h WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grouping ORDER BY n DESC, value) AS place FROM c) WHERE place <= 20""")
def audit_hosts(lens: Lens) -> DataFrame:
    """A5: the three lists of hosts."""
    return reports.audit_hosts(lens.deps())


@query("""
, n AS (SELECT dataset_id, count(*) AS n_ops, count(*) FILTER (callable) AS n_callable, bool_or(dependency_class = 'external_endpoint') AS e, bool_or(dependency_class = 'service_root') AS r, bool_or(dependency_class = 'soap') AS s,
  bool_or(dependency_class = 'wms') AS w, bool_or(dependency_class = 'gateway' AND coalesce(guide_host, 'apis.gateway.example') <> 'apis.gateway.example') AS g FROM deps GROUP BY 1),
j AS (SELECT * FROM specs LEFT JOIN n ON id = dataset_id),
d AS (SELECT 'without_operations' AS defect, * FROM j WHERE dataset_id IS NULL UNION ALL SELECT 'without_callable_operation', * FROM j WHERE coalesce(n_callable, 0) = 0
  UNION ALL SELECT 'missing_organization', * FROM j WHERE coalesce(organization, '') = '' UNION ALL SELECT 'missing_updated_at', * FROM j WHERE updated_at IS NULL
  UNION ALL SELECT 'external_endpoint', * FROM j WHERE e UNION ALL SELECT 'service_root_only', * FROM j WHERE r UNION ALL SELECT 'soap', * FROM j WHERE s UNION ALL SELECT 'wms', * FROM j WHERE w
  UNION ALL SELECT 'gateway_with_external_guide', * FROM j WHERE g)
SELECT defect, id, organization, coalesce(n_ops, 0) AS operations_count, coalesce(n_callable, 0) AS callable_operations, place FROM (SELECT *, row_number() OVER (PARTITION BY defect ORDER BY id) AS place FROM d) WHERE place <= 5""")
def audit_samples(lens: Lens) -> DataFrame:
    """The first five specs of each defect."""
    return reports.audit_samples(lens.specs(), lens.deps(), 5)


@query("SELECT dependency_class, dataset_id, place FROM (SELECT *, row_number() OVER (PARTITION BY dependency_class ORDER BY dataset_id) AS place FROM (SELECT DISTINCT dependency_class, dataset_id FROM deps)) WHERE place <= 10")
def class_samples(lens: Lens) -> DataFrame:
    """The first ten specs of each class."""
    return reports.samples(lens.deps().select("dependency_class", "dataset_id").distinct(), "dependency_class", ["dataset_id"], 10)


_CLASSES = "gateway external_endpoint service_root no_endpoint malformed_endpoint soap wms".split()


@query(f"""SELECT count(*) AS operations, {", ".join(f"count(*) FILTER (dependency_class = '{c}') AS {c}" for c in _CLASSES)},
  count(*) FILTER (approval_required) AS approval_required, {", ".join(f"count(*) FILTER (adapter_status = '{a}') AS adapter_{a}" for a in ("builtin", "adapter", "missing"))} FROM deps""")
def dependency_summary(lens: Lens) -> DataFrame:
    """A6."""
    return reports.dependency_summary(lens.deps())


_BACKLOG = """
, h AS (SELECT route_host AS host, true AS own, * EXCLUDE (route_host) FROM deps WHERE route_host IS NOT NULL UNION ALL
  SELECT guide_host, false, * EXCLUDE (route_host) FROM deps WHERE guide_host <> 'apis.gateway.example'),
p AS (SELECT host, count(DISTINCT nullif(dataset_id, '')) AS specs, count(*) FILTER (own) AS operations, count(*) FILTER (own AND dependency_class = 'external_endpoint') AS external_endpoint_operations,
  count(*) FILTER (own AND dependency_class = 'service_root') AS service_root_operations, count(*) FILTER (own AND dependency_class = 'soap') AS soap_operations, count(*) FILTER (own AND dependency_class = 'wms') AS wms_operations,
  count(*) FILTER (own AND dependency_class = 'gateway') AS gateway_operations, count(DISTINCT nullif(dataset_id, '')) FILTER (NOT own) AS external_guide_specs, count(*) FILTER (own AND approval_required) AS approval_required_operations,
  concat_ws(',', CASE WHEN bool_or(own AND dependency_class = 'external_endpoint') THEN 'external_endpoint' END, CASE WHEN bool_or(NOT own) THEN 'external_guide' END,
    CASE WHEN bool_or(own AND dependency_class = 'gateway') THEN 'gateway' END, CASE WHEN bool_or(own AND dependency_class = 'service_root') THEN 'service_root' END) AS kinds,
  CASE WHEN NOT bool_or(own) THEN 'guide_only' WHEN bool_or(own AND adapter_status = 'builtin') THEN 'builtin' WHEN bool_or(own AND adapter_status = 'adapter') THEN 'adapter'
    WHEN bool_or(own AND adapter_status = 'missing') THEN 'missing' ELSE 'not_applicable' END AS adapter_status,
  array_to_string(list_sort(list_distinct(list(dataset_id) FILTER (dataset_id <> '')))[1:3], ',') AS sample_ids FROM h GROUP BY 1)
"""


@query(_BACKLOG + "SELECT * FROM p")
def provider_backlog(lens: Lens) -> DataFrame:
    """A7."""
    return reports.provider_backlog(lens.kept()).withColumn("sample_ids", F.array_join("sample_ids", ","))


@query(_BACKLOG + """
, a AS (SELECT count(*) AS hosts, count(*) FILTER (contains(kinds, 'gateway')) AS gateway_hosts, count(*) FILTER (contains(kinds, 'external_endpoint')) AS external_endpoint_hosts,
  count(*) FILTER (contains(kinds, 'external_guide')) AS external_guide_hosts, count(*) FILTER (adapter_status = 'adapter') AS registered_adapter_hosts, count(*) FILTER (operations > 0) AS operation_hosts,
  count(*) FILTER (adapter_status = 'guide_only') AS guide_only_hosts, count(*) FILTER (adapter_status = 'missing') AS missing_adapter_hosts FROM p),
b AS (SELECT count(*) FILTER (adapter_status = 'missing') AS needs_adapter_operations, count(*) FILTER (dependency_class = 'service_root') AS service_root_operations,
  count(*) FILTER (dependency_class IN ('soap', 'wms')) AS unsupported_protocol_operations, count(*) FILTER (approval_required) AS approval_required_operations,
  count(*) FILTER (dependency_class = 'malformed_endpoint') AS malformed_source_url_count FROM deps)
SELECT metric, CAST(value AS DOUBLE) AS value FROM (UNPIVOT a ON COLUMNS(*) INTO NAME metric VALUE value) UNION ALL SELECT metric, CAST(value AS DOUBLE) FROM (UNPIVOT b ON COLUMNS(*) INTO NAME metric VALUE value)""")
def backlog_summary(lens: Lens) -> DataFrame:
    """The hosts' summary."""
    deps = lens.kept()
    return reports.backlog_summary(reports.provider_backlog(deps), deps)


_TARGETS = """
, m AS (SELECT * FROM deps WHERE adapter_status = 'missing' AND route_host IS NOT NULL),
t AS (SELECT route_host AS host, count(*) AS operations, count(DISTINCT nullif(dataset_id, '')) AS specs, count(*) FILTER (approval_required) AS approval_required_operations,
  count(*) FILTER (lacks_params) AS missing_param_operations, count(*) FILTER (dependency_class IN ('soap', 'wms')) AS unsupported_protocol_operations, {sets} FROM m GROUP BY 1)
""".format(sets=", ".join(f"array_to_string(list_sort(list_distinct(list({c}) FILTER ({c} <> ''))), ',') AS {a}" for c, a in (
    ("dependency_class", "kinds"), ("organization", "organizations"), ("source_category", "source_categories"), ("api_type", "api_types"), ("data_format", "data_formats"))))


@query(_TARGETS + "SELECT *, row_number() OVER (ORDER BY operations DESC, specs DESC, host) AS rank FROM t")
def adapter_targets(lens: Lens) -> DataFrame:
    """A8, W2."""
    out = reports.adapter_targets(lens.deps())
    return out.withColumns({c: F.array_join(c, ",") for c in ("kinds", "organizations", "source_categories", "api_types", "data_formats")})


@query(_TARGETS + """SELECT route_host AS host, dataset_id, organization, operation, dependency_class, endpoint, place FROM (
  SELECT *, row_number() OVER (PARTITION BY route_host ORDER BY dataset_id, operation, part_key, supp_key, price) AS place FROM m) WHERE place <= 3""")
def target_samples(lens: Lens) -> DataFrame:
    """Three sample operations a host."""
    found = reports.target_samples(lens.deps(), ["dataset_id", "operation", "part_key", "supp_key", "price"])
    return found.select("host", "dataset_id", "organization", "operation", "dependency_class", "endpoint", "place")


@query(_TARGETS + """SELECT metric, CAST(value AS DOUBLE) AS value FROM (SELECT 'target_hosts' AS metric, (SELECT count(*) FROM t) AS value UNION ALL SELECT 'target_operations', (SELECT count(*) FROM m)
  UNION ALL SELECT 'approval_required_operations', (SELECT count(*) FROM m WHERE approval_required) UNION ALL SELECT 'missing_param_operations', (SELECT count(*) FROM m WHERE lacks_params)
  UNION ALL SELECT 'unsupported_protocol_operations', 0 UNION ALL SELECT 'external_endpoint_operations', (SELECT count(*) FROM m WHERE dependency_class = 'external_endpoint')
  UNION ALL SELECT 'service_root_operations', (SELECT count(*) FROM m WHERE dependency_class = 'service_root'))""")
def targets_summary(lens: Lens) -> DataFrame:
    """The totals."""
    deps = lens.kept()
    return reports.targets_summary(reports.adapter_targets(deps), deps)


_ROUTES = """
, probed AS (SELECT *, CASE WHEN http_status = 404 THEN 'dead_route_candidate' WHEN reason LIKE '%timeout' OR http_status = 503 THEN 'transient_failure'
  WHEN status = 'verified' THEN 'adapter_candidate' WHEN lacks_params THEN 'parameter_blocked' END AS disposition FROM attached WHERE adapter_status = 'missing')
"""


def _routes(lens: Lens) -> DataFrame:
    deps = lens.kept()
    return reports.routes(deps, lens.evidence(deps), ORDER)


@query(_ROUTES + """SELECT dataset_id, operation, part_key, supp_key, price, route_host, disposition, CASE disposition WHEN 'dead_route_candidate' THEN 'confirm upstream metadata or mark the route stale before adapter work'
  WHEN 'transient_failure' THEN 'retry with bounded evidence before building a provider adapter' WHEN 'parameter_blocked' THEN 'provide sample parameters before probing again'
  WHEN 'adapter_candidate' THEN 'build a provider adapter' END AS recommended_action FROM probed""")
def route_dispositions(lens: Lens) -> DataFrame:
    """J5, P15; whoever shows them sorts them (T4: disposition, host, dataset, operation)."""
    rows = _routes(lens)
    return rows.select("dataset_id", "operation", "part_key", "supp_key", "price", "route_host", "disposition", "recommended_action")


@query(_ROUTES + """SELECT disposition, route_host, dataset_id, operation, part_key, supp_key, price FROM probed
ORDER BY disposition NULLS FIRST, route_host NULLS FIRST, dataset_id NULLS FIRST, operation, part_key, supp_key, price LIMIT 50""")
def first_routes(lens: Lens) -> DataFrame:
    """T4: the first fifty routes in the report's order."""
    rows = _routes(lens).select(*reports.ROUTE_ORDER, "part_key", "supp_key", "price")
    return search.apply_filters(rows, 50, [*reports.ROUTE_ORDER, "part_key", "supp_key", "price"]).drop("filtered_count", "truncated")


_ROUTE_TOTALS = """(SELECT count(*) AS routes_total, count(DISTINCT route_host) AS hosts, count(*) FILTER (has_evidence) AS with_probe_evidence, count(*) FILTER (NOT has_evidence) AS without_probe_evidence,
  count(*) FILTER (disposition = 'dead_route_candidate') AS dead_route_candidates, count(*) FILTER (disposition = 'transient_failure') AS transient_failures,
  count(*) FILTER (disposition = 'parameter_blocked') AS parameter_blocked_routes, count(*) FILTER (disposition = 'adapter_candidate') AS adapter_candidates FROM probed)"""


@query(_ROUTES + f""", g AS (SELECT 'disposition' AS grouping, disposition AS value, count(*) AS n FROM probed WHERE disposition IS NOT NULL GROUP BY 2 UNION ALL
  SELECT 'probe_reason', reason, count(*) FROM probed WHERE reason IS NOT NULL GROUP BY 2 UNION ALL SELECT 'route_host', route_host, count(*) FROM probed WHERE route_host IS NOT NULL GROUP BY 2),
t AS (SELECT * FROM {_ROUTE_TOTALS})
SELECT grouping, value, n, row_number() OVER (PARTITION BY grouping ORDER BY n DESC, value) AS place FROM g UNION ALL SELECT metric, '', n, 1 FROM (UNPIVOT t ON COLUMNS(*) INTO NAME metric VALUE n)""")
def route_summary(lens: Lens) -> DataFrame:
    """A21."""
    return reports.route_summary(_routes(lens))


@query(_ROUTES + """SELECT route_host, count(*) AS routes, CASE count(DISTINCT disposition) WHEN 0 THEN 'unknown' WHEN 1 THEN min(disposition) ELSE 'mixed' END AS dominant FROM probed GROUP BY 1""")
def host_dispositions(lens: Lens) -> DataFrame:
    """A27."""
    return reports.host_disposition(_routes(lens))


_COVERAGE = f"""
, d AS (SELECT count(*) AS operations, count(*) FILTER (callable) AS callable_operations, count(*) FILTER (dependency_class = 'gateway') AS gateway_operations,
  count(*) FILTER (dependency_class = 'external_endpoint') AS external_endpoint_operations, count(*) FILTER (adapter_status = 'adapter') AS registered_adapter_operations,
  count(*) FILTER (adapter_status = 'missing') AS missing_adapter_operations, count(*) FILTER (approval_required) AS approval_required_operations,
  count(*) FILTER (dependency_class = 'no_endpoint') AS no_endpoint_operations, count(*) FILTER (dependency_class = 'service_root') AS service_root_operations,
  count(*) FILTER (dependency_class IN ('soap', 'wms')) AS unsupported_protocol_operations, count(DISTINCT route_host) FILTER (adapter_status = 'missing') AS missing_adapter_hosts,
  (SELECT count(*) FROM specs) AS specs, (SELECT count(DISTINCT host) FROM adapter_hosts) AS registered_adapter_hosts, (SELECT count(*) FROM adapters) AS adapter_count,
  (SELECT count(*) FROM adapters WHERE can_call) AS call_capable_adapters FROM deps),
v AS (SELECT count(*) AS evidence_total, count(*) FILTER (status = 'verified') AS verified, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
  count(*) FILTER (status = 'unknown') AS unknown FROM evidence),
f AS (SELECT *, adapter_count >= 2 AND call_capable_adapters >= 1 AS provider_split_ready, {pct("callable_operations", "operations")} AS callable_operation_percent,
  {pct("registered_adapter_operations", "(registered_adapter_operations + missing_adapter_operations)")} AS external_adapter_coverage_percent,
  {pct("verified", "evidence_total")} AS verified_percent, {pct("evidence_total", "operations")} AS evidence_operation_percent FROM d, v)
"""


def _coverage(lens: Lens) -> DataFrame:
    deps = lens.kept()
    return reports.coverage(deps, lens.specs(), lens.adapters(), lens.evidence(deps))


@query(_COVERAGE + "SELECT * FROM f")
def coverage(lens: Lens) -> DataFrame:
    """A9."""
    return _coverage(lens)


@query(_COVERAGE + _ROUTES + f"""SELECT external_endpoint_operations, registered_adapter_operations, missing_adapter_operations, registered_adapter_hosts, missing_adapter_hosts,
  external_adapter_coverage_percent AS raw_external_adapter_coverage_percent, routes_total, with_probe_evidence, without_probe_evidence, dead_route_candidates, transient_failures, adapter_candidates,
  with_probe_evidence AS route_evidence_covered_operations, adapter_candidates AS evidence_adjusted_adapter_candidate_operations,
  CASE WHEN without_probe_evidence = 0 THEN 'passing' ELSE 'action_required' END AS gate FROM f, {_ROUTE_TOTALS}""")
def external_coverage(lens: Lens) -> DataFrame:
    """A22, C17."""
    return reports.external_coverage(_coverage(lens), _routes(lens))


@query(_COVERAGE + """, x AS (SELECT host FROM adapter_hosts WHERE name IN (SELECT name FROM adapters WHERE ordinal % 3 <> 0)),
m AS (SELECT route_host FROM deps WHERE adapter_status = 'missing' AND route_host IS NOT NULL)
SELECT *, expected IS NOT DISTINCT FROM actual AS same FROM (
  SELECT 'target_operations' AS "check", missing_adapter_operations AS expected, (SELECT count(*) FROM m) AS actual FROM f
  UNION ALL SELECT 'target_hosts', missing_adapter_hosts, (SELECT count(DISTINCT route_host) FROM m) FROM f
  UNION ALL SELECT 'index_hosts', registered_adapter_hosts, (SELECT count(DISTINCT host) FROM x) FROM f)""")
def external_cross_checks(lens: Lens) -> DataFrame:
    """Targets and an index that lacks adapters against the coverage report."""
    index = lens.adapters().where("ordinal % 3 <> 0")
    return reports.external_cross_checks(_coverage(lens), reports.adapter_targets(lens.kept()), index)


@query(_ROUTES + """, e AS (SELECT route_host AS host, count(*) AS n FROM probed WHERE route_host IS NOT NULL GROUP BY 1),
r AS (SELECT 'portal' || CAST(s_suppkey % 9 AS VARCHAR) || '.example' AS host, count(*) AS operations FROM supplier GROUP BY 1)
SELECT coalesce(e.host, r.host) AS host, e.n AS expected, r.operations AS actual FROM e FULL JOIN r ON e.host = r.host WHERE e.n IS DISTINCT FROM r.operations""")
def missing_host_differences(lens: Lens) -> DataFrame:
    """The map of missing hosts against the routes."""
    host = F.concat(F.lit("portal"), (F.col("s_suppkey") % 9).cast("string"), F.lit(".example"))
    reported = lens.table("supplier").groupBy(host.alias("host")).agg(F.count("*").alias("operations"))
    return reports.missing_host_differences(_routes(lens), reported)


_GOALS = [
    ("callable_operation_percent", 99.0, True), ("external_adapter_coverage_percent", 98.0, True), ("evidence_operation_percent", 10.0, True),
    ("missing_adapter_operations", 10.0, False), ("call_capable_adapters", 25.0, True), ("provider_split_ready", 1.0, True),
]


@query(_COVERAGE + """, g AS (SELECT 'callable_operation_percent' AS metric, 99 AS target, callable_operation_percent AS value, callable_operation_percent >= 99 AS met FROM f
  UNION ALL SELECT 'external_adapter_coverage_percent', 98, external_adapter_coverage_percent, external_adapter_coverage_percent >= 98 FROM f
  UNION ALL SELECT 'evidence_operation_percent', 10, evidence_operation_percent, evidence_operation_percent >= 10 FROM f UNION ALL SELECT 'missing_adapter_operations', 10, missing_adapter_operations, missing_adapter_operations <= 10 FROM f
  UNION ALL SELECT 'call_capable_adapters', 25, call_capable_adapters, call_capable_adapters >= 25 FROM f UNION ALL SELECT 'provider_split_ready', 1, CAST(provider_split_ready AS INT), provider_split_ready FROM f)
SELECT metric, CAST(target AS DOUBLE) AS target, CAST(value AS DOUBLE) AS value, met FROM g""")
def coverage_goals(lens: Lens) -> DataFrame:
    """A10."""
    goals = lens.spark.createDataFrame(_GOALS, "metric string, target double, at_least boolean")
    return reports.coverage_goals(_coverage(lens), goals)


@query("""
, c AS (SELECT count(*) AS adapter_count, count(*) AS verification_capable_adapters, count(*) FILTER (can_call) AS call_capable_adapters FROM adapters)
SELECT *, adapter_count >= 2 AND call_capable_adapters >= 1 AS ready, concat_ws(',', CASE WHEN adapter_count < 2 THEN 'need_at_least_two_external_adapters' END,
  CASE WHEN verification_capable_adapters < 2 THEN 'need_at_least_two_verification_capable_adapters' END, CASE WHEN call_capable_adapters < 1 THEN 'need_at_least_one_call_capable_adapter' END) AS reasons FROM c""")
def split_readiness(lens: Lens) -> DataFrame:
    """A23."""
    return reports.split_readiness(lens.adapters())


@query("SELECT page_id, nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '') AS authority, regexp_replace(url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'serviceKey=abc' || CAST(page_id AS VARCHAR) || '&x=1', '([?&]serviceKey=)[^&#]*', '\\1REDACTED') AS redacted FROM pages", views=False)
def page_urls(lens: Lens) -> DataFrame:
    """P5, P11 over page URLs."""
    mark = F.when(F.contains("url", F.lit("?")), "&").otherwise("?")
    signed = F.concat("url", mark, F.lit("serviceKey=abc"), F.col("page_id").cast("string"), F.lit("&x=1"))
    return lens.table("pages").select("page_id", C.url_authority(F.col("url")).alias("authority"), C.redact_url(signed).alias("redacted"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS missing, CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'v' || CAST(event_id % 4 AS VARCHAR) END AS nested,
  '{"a":"1","k":"' || json_extract_string(props, '$.k') || '"}' AS canonical FROM events""", views=False)
def raw_fields(lens: Lens) -> DataFrame:
    """Section 2.9, JSON: values of open objects kept as text, and text that is none; canonical form."""
    props = F.col("props")
    raw = F.when(F.col("event_id") % 4 == 0, "{no json").otherwise(F.concat(F.lit('{"source": {"raw": "v'), (F.col("event_id") % 4).cast("string"), F.lit('"}}')))
    both = F.concat(F.lit('{"k":"'), C.raw_field(props, "$.k"), F.lit('","a":"1"}'))
    return lens.table("events").select(
        "event_id", C.raw_field(props, "$.k").alias("k"), C.raw_field(props, "$.none").alias("missing"), C.raw_field(raw, "$.source.raw").alias("nested"), C.canonical_json(both).alias("canonical")
    )


@query("""SELECT event_type, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS latest, count(*) FILTER (user_id % 3 <> 0) AS stamped, CAST(max(date_diff('day', TIMESTAMP '2020-01-01', date_trunc('day', ts))) AS BIGINT) AS days
FROM events GROUP BY 1""", views=False)
def event_stamps(lens: Lens) -> DataFrame:
    """Section 2.9, dates: stamps written and read, the latest of each type, days since a date."""
    rows = lens.table("events").select("event_type", "user_id", C.iso_stamp(F.col("ts")).alias("text"))
    read = C.stamp(F.when(F.col("user_id") % 3 == 0, "no stamp").otherwise(F.col("text")))
    days = F.datediff(C.stamp(F.col("text")), F.lit("2020-01-01").cast("date")).cast("long")
    return rows.groupBy("event_type").agg(F.max("text").alias("latest"), F.count(read).alias("stamped"), F.max(days).alias("days"))


@query("SELECT unnest(['dataset_id', 'operation']) AS missing, (SELECT count(*) FROM deps WHERE dataset_id IS NULL) AS nulls")
def contract_columns(lens: Lens) -> DataFrame:
    """Columns of the contract that a projection of the operations lacks, found before anything is read."""
    deps = lens.deps()
    lacking = checks.unknown_columns(deps.select("dataset_id", "operation"), ["id", "title"])
    names = F.explode(F.array(*map(F.lit, lacking))).alias("missing")
    return deps.agg(F.count_if(F.col("dataset_id").isNull()).alias("nulls")).select(names, "nulls")
