"""Reports over classified operations: audit, backlog, targets, routes, coverage and institutions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillframe.functions.columns import first_true, or_default, percent
from quillframe.operators.classify import GATEWAY_HOSTS, attach_adapter, status_field_role
from quillframe.operators.evidence import attach_evidence, grouped_counts, status_counts

#: What to do about a route, by its disposition. The last two have no published text; these are ours.
ACTIONS = {
    "dead_route_candidate": "confirm upstream metadata or mark the route stale before adapter work",
    "transient_failure": "retry with bounded evidence before building a provider adapter",
    "parameter_blocked": "provide sample parameters before probing again",
    "adapter_candidate": "build a provider adapter",
}


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per value of ``key``, by value."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(key)


def long_form(df: DataFrame, names: list[str]) -> DataFrame:
    """A row of counts as rows (metric, value)."""
    return df.select(F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names))).alias("m")).select("m.*")


def dependency_summary(deps: DataFrame) -> DataFrame:
    """Operations in all, by class, with approval, and by adapter status: one pass, one row."""
    cls, adapter = F.col("dependency_class"), F.col("adapter_status")
    classes = ("gateway", "external_endpoint", "service_root", "no_endpoint", "malformed_endpoint", "soap", "wms")
    return deps.agg(
        F.count("*").alias("operations"),
        *(F.count_if(cls == c).alias(c) for c in classes),
        F.count_if("approval_required").alias("approval_required"),
        *(F.count_if(adapter == a).alias(f"adapter_{a}") for a in ("builtin", "adapter", "missing")),
    )


def _blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""


def _external_guide() -> Column:
    """The host of an operation's guide, if that isn't the gateway's."""
    return F.when(~F.col("guide_host").isin(*GATEWAY_HOSTS), F.col("guide_host"))


def catalog_audit(specs: DataFrame, deps: DataFrame) -> DataFrame:
    """Quality counts of specs and operations as (metric, value). ``specs_without_operations`` are those that no
    operation names; an endpoint of spaces counts as none.

    The operations are read once: counted per spec, where all counts of operations are sums, and joined with
    the specs counted per id, so that an id of several specs doesn't count its operations twice."""
    cls = F.col("dependency_class")
    guided = (cls == "gateway") & _external_guide().isNotNull()
    classes = ("gateway", "external_endpoint", "service_root", "soap", "wms")
    counted = {
        "callable_operations": F.col("callable"),
        "operations_without_endpoint": _blank("endpoint"),
        "operations_without_request_params": F.col("request_params_count") == 0,
        "operations_without_response_params": F.col("response_params_count") == 0,
        **{f"{c}_operations": cls == c for c in classes},
        "dev_approval_required_operations": F.col("dev_approval") == "manual",
        "prod_approval_required_operations": F.col("prod_approval") == "manual",
        "malformed_endpoint_url_count": cls == "malformed_endpoint",
        "malformed_guide_url_count": ~_blank("guide_url") & F.col("guide_host").isNull(),
    }
    per_spec = deps.groupBy("dataset_id").agg(
        F.lit(True).alias("has_operations"), F.count("*").alias("operations_total"), F.count_if(guided).alias("n_guided"), *(F.count_if(c).alias(n) for n, c in counted.items())
    )
    blanks = {"specs_missing_organization": "organization", "specs_missing_source_url": "url", "specs_missing_updated_at": "updated_at"}
    per_id = specs.groupBy("id").agg(F.count("*").alias("n_specs"), *(F.count_if(_blank(c)).alias(n) for n, c in blanks.items()))
    joined = per_id.join(per_spec, per_id["id"] == per_spec["dataset_id"], "full_outer")

    def specs_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n_specs")))

    sums = {
        "specs_total": F.sum("n_specs"),
        "specs_without_operations": specs_where(F.col("has_operations").isNull()),
        "specs_without_callable_operation": specs_where(F.coalesce("callable_operations", F.lit(0)) == 0),
        **{n: F.sum(n) for n in blanks},
        "gateway_with_external_guide_specs": specs_where(F.col("n_guided") > 0),
        "external_endpoint_specs": specs_where(F.col("external_endpoint_operations") > 0),
        **{n: F.sum(n) for n in ("operations_total", *counted)},
    }
    totals = joined.agg(*(F.coalesce(c, F.lit(0)).alias(n) for n, c in sums.items()))
    return long_form(totals, totals.columns)


def audit_hosts(deps: DataFrame, n: int = 20) -> DataFrame:
    """(grouping, value, n, place): the hosts with most operations, of all, of external endpoints and of external guides."""
    hosts = deps.select(
        F.col("endpoint_host"),
        F.when(F.col("dependency_class") == "external_endpoint", F.col("endpoint_host")).alias("external_endpoint_host"),
        _external_guide().alias("external_guide_host"),
    )
    return grouped_counts(hosts, ("endpoint_host", "external_endpoint_host", "external_guide_host"), n)


def audit_samples(specs: DataFrame, deps: DataFrame, n: int) -> DataFrame:
    """(defect, place, id, organization, operations_count, callable_operations): of each defect the
    ``n`` specs that come first by id."""
    cls = F.col("dependency_class")
    has = {"external_endpoint": cls == "external_endpoint", "service_root_only": cls == "service_root", "soap": cls == "soap", "wms": cls == "wms"}
    has["gateway_with_external_guide"] = (cls == "gateway") & _external_guide().isNotNull()
    per_spec = deps.groupBy("dataset_id").agg(
        F.count("*").alias("operations_count"), F.count_if("callable").alias("callable_operations"), *(F.bool_or(F.coalesce(c, F.lit(False))).alias(f"has_{d}") for d, c in has.items())
    )
    joined = specs.join(per_spec, specs["id"] == per_spec["dataset_id"], "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    defects = {
        "without_operations": F.col("dataset_id").isNull(),
        "without_callable_operation": count("callable_operations") == 0,
        "missing_organization": _blank("organization"),
        "missing_updated_at": _blank("updated_at"),
    } | {d: F.col(f"has_{d}") for d in has}
    found = F.explode(F.array_compact(F.array(*(F.when(c, F.lit(d)) for d, c in defects.items()))))
    rows = joined.select(
        found.alias("defect"), "id", "organization", count("operations_count").alias("operations_count"), count("callable_operations").alias("callable_operations")
    )
    return samples(rows, "defect", ["id"], n)


def samples(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, with their ``place``."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def first_values(df: DataFrame, key: str, value: str, n: int = 3) -> DataFrame:
    """(key, sample_ids): the ``n`` smallest distinct values of each key. Distinct values are
    aggregated first and ranked then, so no key's values are ever collected into one list."""
    distinct = df.select(key, value).where(F.col(key).isNotNull() & F.col(value).isNotNull()).distinct()
    top = samples(distinct, key, [value], n)
    return top.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("sample_ids"))


def _host_rows(deps: DataFrame) -> DataFrame:
    """One row for an operation's own host, and one for the host of its guide if that is external."""
    op = F.struct(F.col("route_host").alias("host"), F.lit(True).alias("own"))
    guide = F.struct(_external_guide().alias("host"), F.lit(False).alias("own"))
    columns = ("dataset_id", "dependency_class", "adapter_status", "approval_required")
    return deps.select(*columns, F.explode(F.array(op, guide)).alias("h")).select(*columns, "h.host", "h.own").where("host is not null")


def provider_backlog(deps: DataFrame) -> DataFrame:
    """Per host of endpoints or guides: kinds, adapter status, distinct specs, operations and their
    classes, specs with a guide there, approvals and sample ids; the busiest first.

    Rows are counted per host and spec before they are counted per host, so a host that most
    operations share is spread over its specs.
    """
    own, cls = F.col("own"), F.col("dependency_class")
    classes = {"external_endpoint": "external_endpoint", "service_root": "service_root", "soap": "soap", "wms": "wms", "gateway": "gateway"}
    rows = _host_rows(deps)
    per_spec = rows.groupBy("host", F.nullif("dataset_id", F.lit("")).alias("spec")).agg(
        F.count_if(own).alias("operations"),
        *(F.count_if(own & (cls == c)).alias(f"n_{name}") for name, c in classes.items()),
        F.count_if(own & F.col("approval_required")).alias("approval"),
        F.count_if(~own).alias("guides"),
        *(F.count_if(own & (F.col("adapter_status") == a)).alias(f"a_{a}") for a in ("builtin", "adapter", "missing")),
    )
    counts = per_spec.groupBy("host").agg(
        F.count("spec").alias("specs"),
        F.sum("operations").alias("operations"),
        *(F.sum(f"n_{name}").alias(f"{name}_operations") for name in classes),
        F.count_if((F.col("guides") > 0) & F.col("spec").isNotNull()).alias("external_guide_specs"),
        F.sum("guides").alias("guides"),
        F.sum("approval").alias("approval_required_operations"),
        *(F.sum(f"a_{a}").alias(f"a_{a}") for a in ("builtin", "adapter", "missing")),
    )
    kinds = [F.when(F.col(f"{k}_operations") > 0, F.lit(k)) for k in ("external_endpoint", "gateway", "service_root")]
    kinds.insert(1, F.when(F.col("guides") > 0, F.lit("external_guide")))
    status = first_true(
        (F.col("operations") == 0, "guide_only"), (F.col("a_builtin") > 0, "builtin"), (F.col("a_adapter") > 0, "adapter"), (F.col("a_missing") > 0, "missing"),
        otherwise="not_applicable",
    )
    ids = first_values(rows.select("host", F.nullif("dataset_id", F.lit("")).alias("spec")), "host", "spec")
    out = counts.withColumns({"kinds": F.array_join(F.array_compact(F.array(*kinds)), ","), "adapter_status": status})
    return out.join(ids.withColumnRenamed("host", "ids_host"), F.col("host") == F.col("ids_host"), "left").drop("ids_host", "guides", "a_builtin", "a_adapter", "a_missing").orderBy(
        F.desc("operations"), F.desc("specs"), F.desc("external_guide_specs"), "host"
    )


def backlog_summary(backlog: DataFrame, deps: DataFrame) -> DataFrame:
    """Hosts of ``provider_backlog`` by kind and adapter status, and operations of ``deps``, as (metric, value)."""
    has = lambda k: F.count_if(F.array_contains(F.split("kinds", ","), k))
    status = F.col("adapter_status")
    hosts = backlog.agg(
        F.count("*").alias("hosts"),
        *(has(k).alias(f"{k}_hosts") for k in ("gateway", "external_endpoint", "external_guide")),
        F.count_if(status == "adapter").alias("registered_adapter_hosts"),
        F.count_if(F.col("operations") > 0).alias("operation_hosts"),
        F.count_if(status == "guide_only").alias("guide_only_hosts"),
        F.count_if(status == "missing").alias("missing_adapter_hosts"),
    )
    cls = F.col("dependency_class")
    operations = deps.agg(
        F.count_if(F.col("adapter_status") == "missing").alias("needs_adapter_operations"),
        F.count_if(cls == "service_root").alias("service_root_operations"),
        F.count_if(cls.isin("soap", "wms")).alias("unsupported_protocol_operations"),
        F.count_if("approval_required").alias("approval_required_operations"),
        F.count_if(cls == "malformed_endpoint").alias("malformed_source_url_count"),
    )
    return long_form(hosts, hosts.columns).unionAll(long_form(operations, operations.columns))


def adapter_targets(deps: DataFrame) -> DataFrame:
    """Hosts that lack an adapter, ranked: operations, then specs, descending, then host.

    organizations, source_categories, api_types and data_formats are sorted sets: values of closed
    lists, few for any host.
    """
    backlog = deps.where((F.col("adapter_status") == "missing") & F.col("route_host").isNotNull())
    cls = F.col("dependency_class")
    sets = {"kinds": "dependency_class", "organizations": "organization", "source_categories": "source_category", "api_types": "api_type", "data_formats": "data_format"}
    targets = backlog.groupBy(F.col("route_host").alias("host")).agg(
        F.count("*").alias("operations"),
        F.count_distinct(F.nullif("dataset_id", F.lit(""))).alias("specs"),
        *(F.array_sort(F.collect_set(F.nullif(c, F.lit("")))).alias(name) for name, c in sets.items()),
        F.count_if("approval_required").alias("approval_required_operations"),
        F.count_if(F.size("missing_params") > 0).alias("missing_param_operations"),
        F.count_if(cls.isin("soap", "wms")).alias("unsupported_protocol_operations"),
    )
    # A rank over all hosts: one row a host is left here.
    return targets.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("operations"), F.desc("specs"), "host")))


def target_samples(deps: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    """The first ``n`` operations by ``order`` of each host that lacks an adapter, with their ``place``."""
    backlog = deps.where((F.col("adapter_status") == "missing") & F.col("route_host").isNotNull())
    return samples(backlog.withColumnRenamed("route_host", "host"), "host", order, n)


def targets_summary(targets: DataFrame, deps: DataFrame) -> DataFrame:
    """Figures over ``adapter_targets`` as (metric, value)."""
    totals = targets.agg(
        F.count("*").alias("target_hosts"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (("operations", "target_operations"), ("approval_required_operations",) * 2, ("missing_param_operations",) * 2, ("unsupported_protocol_operations",) * 2)),
    )
    cls = F.col("dependency_class")
    missing = deps.where((F.col("adapter_status") == "missing") & F.col("route_host").isNotNull())
    kinds = missing.agg(*(F.count_if(cls == c).alias(f"{c}_operations") for c in ("external_endpoint", "service_root")))
    return long_form(totals, totals.columns).unionAll(long_form(kinds, kinds.columns))


def disposition(status: Column, reason: Column, http_status: Column, missing: Column) -> Column:
    """What a probe says about a route without an adapter; null without a probe and without missing
    parameters. A reason may have a prefix that names the probe."""
    return first_true(
        (http_status == 404, "dead_route_candidate"),
        (reason.rlike("(^|_)(timeout|request_error)$") | (http_status == 503), "transient_failure"),
        (status == "verified", "adapter_candidate"),
        (F.size(missing) > 0, "parameter_blocked"),
    )


#: The order in which a report lists its routes.
ROUTE_ORDER = ("disposition", "route_host", "dataset_id", "operation")


def routes(deps: DataFrame, probe: DataFrame, order: list[str]) -> DataFrame:
    """Operations that lack an adapter with their probe, disposition and recommended action."""
    missing = attach_evidence(deps.where(F.col("adapter_status") == "missing"), probe, order, keep=["status", "reason", "http_status"])
    out = missing.withColumn(
        "disposition",
        disposition(F.col("evidence.status"), F.col("evidence.reason"), F.col("evidence.http_status"), F.coalesce("missing_params", F.array().cast("array<string>"))),
    )
    action = F.create_map(*(F.lit(x) for pair in ACTIONS.items() for x in pair))
    return out.withColumns(
        {"recommended_action": F.try_element_at(action, F.col("disposition")), "probe_reason": F.col("evidence.reason"), "http_status": F.col("evidence.http_status")}
    )


def route_summary(route_rows: DataFrame) -> DataFrame:
    """(grouping, value, n, place): routes by disposition, reason and host, and the totals, each a grouping of its own."""
    d = F.col("disposition")
    totals = route_rows.agg(
        F.count("*").alias("routes_total"),
        F.count_distinct("route_host").alias("hosts"),
        F.count("evidence").alias("with_probe_evidence"),
        F.count_if(F.col("evidence").isNull()).alias("without_probe_evidence"),
        F.count_if(d == "dead_route_candidate").alias("dead_route_candidates"),
        F.count_if(d == "transient_failure").alias("transient_failures"),
        F.count_if(d == "parameter_blocked").alias("parameter_blocked_routes"),
        F.count_if(d == "adapter_candidate").alias("adapter_candidates"),
    )
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("grouping"), F.lit("").alias("value"), F.col(c).alias("n"), F.lit(1).alias("place")) for c in totals.columns)))
    return grouped_counts(route_rows, ("disposition", "probe_reason", "route_host")).unionByName(totals.select(rows.alias("x")).select("x.*"))


def missing_host_differences(route_rows: DataFrame, reported: DataFrame) -> DataFrame:
    """(host, expected, actual): hosts of routes without an adapter whose number of operations isn't
    the reported one (host, operations)."""
    counts = route_rows.where("route_host is not null").groupBy(F.col("route_host").alias("h1")).agg(F.count("*").alias("expected"))
    r = reported.select(F.col("host").alias("h2"), F.col("operations").alias("actual"))
    both = counts.join(r, F.col("h1") == F.col("h2"), "full_outer")
    return both.where(~F.col("expected").eqNullSafe(F.col("actual"))).select(F.coalesce("h1", "h2").alias("host"), "expected", "actual")


def host_disposition(route_rows: DataFrame) -> DataFrame:
    """Per host the one disposition of its routes, ``mixed`` for several, ``unknown`` for none."""
    d = F.col("disposition")
    kinds = F.count_distinct(d)
    return route_rows.groupBy("route_host").agg(
        F.count("*").alias("routes"),
        F.when(kinds == 0, "unknown").when(kinds == 1, F.min(d)).otherwise("mixed").alias("dominant"),
    )


def coverage(deps: DataFrame, specs: DataFrame, adapters: DataFrame, evidence: DataFrame) -> DataFrame:
    """The coverage report's figures as one row: one aggregate a table."""
    cls, status = F.col("dependency_class"), F.col("adapter_status")
    d = deps.agg(
        F.count("*").alias("operations"),
        F.count_if("callable").alias("callable_operations"),
        F.count_if(cls == "gateway").alias("gateway_operations"),
        F.count_if(cls == "external_endpoint").alias("external_endpoint_operations"),
        F.count_if(status == "adapter").alias("registered_adapter_operations"),
        F.count_if(status == "missing").alias("missing_adapter_operations"),
        F.count_if("approval_required").alias("approval_required_operations"),
        F.count_if(cls == "no_endpoint").alias("no_endpoint_operations"),
        F.count_if(cls == "service_root").alias("service_root_operations"),
        F.count_if(cls.isin("soap", "wms")).alias("unsupported_protocol_operations"),
        F.count_distinct(F.when(status == "missing", F.col("route_host"))).alias("missing_adapter_hosts"),
    )
    ready = split_readiness(adapters)
    hosts = adapters.select(F.explode("hosts").alias("host")).agg(F.count_distinct("host").alias("registered_adapter_hosts"))
    others = [
        specs.agg(F.count("*").alias("specs")),
        hosts,
        ready.select("adapter_count", F.col("call_capable_adapters"), F.col("ready").alias("provider_split_ready")),
        evidence.agg(F.count("*").alias("evidence_total"), *status_counts()),
    ]
    for o in others:  # single rows
        d = d.join(o)
    registered = F.col("registered_adapter_operations")
    return d.select(
        "*",
        percent(F.col("callable_operations"), F.col("operations")).alias("callable_operation_percent"),
        percent(registered, registered + F.col("missing_adapter_operations")).alias("external_adapter_coverage_percent"),
        percent(F.col("verified"), F.col("evidence_total")).alias("verified_percent"),
        percent(F.col("evidence_total"), F.col("operations")).alias("evidence_operation_percent"),
    )


def coverage_goals(figures: DataFrame, goals: DataFrame) -> DataFrame:
    """Goals (metric, target, at_least) with the actual value and whether they are met."""
    actual = long_form(figures, [c for c in figures.columns])
    met = F.when(F.col("at_least"), F.col("value") >= F.col("target")).otherwise(F.col("value") <= F.col("target"))
    return goals.join(actual, "metric", "left").select("metric", "target", "value", F.coalesce(met, F.lit(False)).alias("met"))


def external_coverage(figures: DataFrame, route_rows: DataFrame) -> DataFrame:
    """External operations as registered (from ``coverage``), and what evidence says about the routes
    that lack an adapter; passing if every one of them has a probe."""
    d = F.col("disposition")
    routed = route_rows.agg(
        F.count("*").alias("routes_total"),
        F.count("evidence").alias("with_probe_evidence"),
        F.count_if(F.col("evidence").isNull()).alias("without_probe_evidence"),
        F.count_if(d == "dead_route_candidate").alias("dead_route_candidates"),
        F.count_if(d == "transient_failure").alias("transient_failures"),
        F.count_if(d == "adapter_candidate").alias("adapter_candidates"),
    )
    kept = ("external_endpoint_operations", "registered_adapter_operations", "missing_adapter_operations", "registered_adapter_hosts", "missing_adapter_hosts")
    raw = figures.select(*kept, F.col("external_adapter_coverage_percent").alias("raw_external_adapter_coverage_percent"))
    return raw.join(routed).withColumns(
        {
            "route_evidence_covered_operations": F.col("with_probe_evidence"),
            "evidence_adjusted_adapter_candidate_operations": F.col("adapter_candidates"),
            "gate": F.when(F.col("without_probe_evidence") == 0, "passing").otherwise("action_required"),
        }
    )


def external_cross_checks(figures: DataFrame, targets: DataFrame, index: DataFrame) -> DataFrame:
    """(check, expected, actual, same): the figures of ``coverage`` against those of ``adapter_targets`` and against the
    hosts of the index of adapters (name, hosts). One row a check, whether it holds or not."""
    found = targets.agg(F.coalesce(F.sum("operations"), F.lit(0)).alias("target_operations"), F.count("*").alias("target_hosts"))
    hosts = index.select(F.explode("hosts").alias("host")).agg(F.count_distinct("host").alias("index_hosts"))
    pairs = (("target_operations", "missing_adapter_operations"), ("target_hosts", "missing_adapter_hosts"), ("index_hosts", "registered_adapter_hosts"))
    one = figures.select(*(e for _, e in pairs)).join(found).join(hosts)
    rows = F.array(*(F.struct(F.lit(a).alias("check"), F.col(e).alias("expected"), F.col(a).alias("actual"), F.col(e).eqNullSafe(F.col(a)).alias("same")) for a, e in pairs))
    return one.select(F.explode(rows).alias("c")).select("c.*")


#: What a split needs, and the reason given where it isn't reached.
SPLIT_NEEDS = (
    ("adapter_count", 2, "need_at_least_two_external_adapters"),
    ("verification_capable_adapters", 2, "need_at_least_two_verification_capable_adapters"),
    ("call_capable_adapters", 1, "need_at_least_one_call_capable_adapter"),
)


def split_readiness(adapters: DataFrame) -> DataFrame:
    """Whether the adapters can go into a package of their own, with the reasons why not."""
    has = lambda c: F.count_if(F.array_contains("capabilities", c))
    counts = adapters.agg(F.count("*").alias("adapter_count"), has("verification").alias("verification_capable_adapters"), has("call").alias("call_capable_adapters"))
    unmet = F.array_compact(F.array(*(F.when(F.col(c) < least, F.lit(reason)) for c, least, reason in SPLIT_NEEDS)))
    return counts.select("*", (F.size(unmet) == 0).alias("ready"), F.array_join(unmet, ",").alias("reasons"))


def status_fields(response_params: DataFrame) -> DataFrame:
    """``response_params`` (id, operation, name) that are status-like, with their role."""
    return response_params.withColumn("role", status_field_role(F.col("name"))).where(F.col("role").isNotNull())


def error_catalog(response_params: DataFrame) -> DataFrame:
    """(name, role): distinct specs, operations and sample ids of status-like response fields.
    Fields are counted per spec first, so that a name that most specs use is no hot key."""
    rows = status_fields(response_params)
    per_spec = rows.groupBy("name", "role", "id").agg(F.count_distinct("operation").alias("operations"))
    counts = per_spec.groupBy("name", "role").agg(F.count("id").alias("specs"), F.sum("operations").alias("operations"))
    ids = first_values(rows.select(F.concat_ws("/", "name", "role").alias("field"), "id"), "field", "id")
    return counts.join(ids, F.concat_ws("/", "name", "role") == ids["field"], "left").drop("field")


def error_operations(response_params: DataFrame) -> DataFrame:
    """(id, operation, fields): the status-like fields of each operation that has any, as ``name:role``, sorted."""
    found = F.array_sort(F.collect_set(F.concat_ws(":", "name", "role")))
    return status_fields(response_params).groupBy("id", "operation").agg(found.alias("fields"))


ROLES = ("result_code", "result_message", "reason_code", "auth_message", "error_message")


def error_totals(specs: DataFrame, ops: DataFrame, response_params: DataFrame) -> DataFrame:
    """The ten totals of the error catalogue as (metric, value); ``ops`` are (id, operation)."""
    rows = status_fields(response_params)
    per_op = rows.groupBy("id", "operation").agg(*(F.bool_or(F.col("role") == r).alias(r) for r in ROLES))
    with_fields = per_op.agg(F.count("*").alias("operations_with_status_fields"), *(F.count_if(r).alias(f"operations_with_{r}") for r in ROLES))
    names = rows.select("name", "role").distinct().agg(F.count_distinct("name").alias("distinct_status_field_names"), F.count("*").alias("distinct_status_field_name_roles"))
    parts = [specs.agg(F.count("*").alias("specs_total")), ops.where("operation is not null").agg(F.count("*").alias("operations_total")), with_fields, names]
    out = long_form(parts[0], parts[0].columns)
    for p in parts[1:]:
        out = out.unionAll(long_form(p, p.columns))
    return out


# Institutions


def institution_overview(specs: DataFrame, deps: DataFrame, evidence: DataFrame, order: list[str]) -> DataFrame:
    """Per organization, from specs or operations: distinct APIs, operations, evidence by status, approvals
    and operations without an endpoint. Evidence without a status is unknown; a status outside the
    closed list counts only in the total."""
    org = or_default(F.col("organization"), "Unknown").alias("organization")
    apis = specs.select(org, F.nullif("id", F.lit("")).alias("id")).groupBy("organization").agg(F.count_distinct("id").alias("api_count"))
    ops = attach_evidence(deps, evidence, order, keep=["status"]).select(
        org,
        F.nullif("dataset_id", F.lit("")).alias("dataset_id"),
        "dependency_class",
        "approval_required",
        F.when(F.col("evidence").isNotNull(), or_default(F.col("evidence.status"), "unknown")).alias("evidence_status"),
    )
    counts = ops.groupBy("organization").agg(
        F.count_distinct("dataset_id").alias("operation_api_count"),
        F.count("*").alias("operation_count"),
        F.count("evidence_status").alias("evidence_count"),
        *(F.count_if(F.col("evidence_status") == s).alias(f"{s}_count") for s in ("verified", "failed", "skipped", "unknown")),
        F.count_if("approval_required").alias("approval_count"),
        F.count_if(F.col("dependency_class") == "no_endpoint").alias("no_endpoint_count"),
    )
    both = apis.join(counts, "organization", "full_outer")
    names = [c for c in both.columns if c != "organization"]
    both = both.select("organization", *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in names))
    return both.withColumn("evidence_percent", percent(F.col("evidence_count"), F.col("operation_count"))).orderBy(
        F.desc("operation_count"), F.desc("api_count"), "organization"
    )


def institution_histogram(deps: DataFrame, column: str) -> DataFrame:
    """Operations per organization and value of ``column`` (``unknown`` where it is null or empty)."""
    return deps.groupBy(or_default(F.col("organization"), "Unknown").alias("organization"), or_default(F.col(column), "unknown").alias("value")).agg(
        F.count("*").alias("n")
    )


def institution_top(deps: DataFrame, column: str, n: int = 5, default: str | None = None) -> DataFrame:
    """The ``n`` most frequent values of ``column`` in each organization; ties by value; empty ones don't count."""
    value = F.col(column) if default is None else or_default(F.col(column), default)
    rows = deps.select(or_default(F.col("organization"), "Unknown").alias("organization"), value.alias("value"))
    counts = rows.where("value is not null and value <> ''").groupBy("organization", "value").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("organization").orderBy(F.desc("n"), "value"))
    return counts.withColumn("place", place).where(F.col("place") <= n)


def top_hosts_with_adapters(top: DataFrame, adapters: DataFrame) -> DataFrame:
    """``top`` (value: a host) with the host's adapter, its status and its capabilities."""
    return attach_adapter(top, adapters, "value")


def overview_summary(specs: DataFrame, deps: DataFrame, evidence: DataFrame) -> DataFrame:
    """Global figures. Evidence is the evidence report's own total: rows that match no operation count too."""
    org = or_default(F.col("organization"), "Unknown").alias("organization")
    institutions = specs.select(org).unionAll(deps.select(org)).agg(F.count_distinct("organization").alias("institutions"))
    cls, adapter = F.col("dependency_class"), F.col("adapter_status")
    out = institutions
    for part in (
        specs.agg(F.count_distinct(F.nullif("id", F.lit(""))).alias("apis")),
        deps.agg(
            F.count("*").alias("operations"),
            F.count_if("callable").alias("callable_operations"),
            F.count_if(cls == "external_endpoint").alias("external_endpoint_operations"),
            F.count_if(adapter == "adapter").alias("registered_adapter_operations"),
            F.count_if(adapter == "missing").alias("missing_adapter_operations"),
            F.count_distinct(F.when(adapter == "missing", F.col("route_host"))).alias("missing_adapter_hosts"),
        ),
        evidence.agg(F.count("*").alias("evidence"), F.count_if(F.col("status") == "verified").alias("verified")),
    ):
        out = out.join(part)
    return out.withColumn("evidence_percent", percent(F.col("evidence"), F.col("operations")))


def top_values(deps: DataFrame, n: int = 20) -> DataFrame:
    """(grouping, value, n, place): the ``n`` hosts and the ``n`` categories with most operations; ties by value."""
    rows = deps.select(F.col("route_host"), or_default(F.col("source_category"), "unknown").alias("source_category"))
    return grouped_counts(rows, ("route_host", "source_category"), n)


def ranking_by_apis(overview: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` institutions with most APIs; ties by operations, then name."""
    return overview.orderBy(F.desc("api_count"), F.desc("operation_count"), "organization").limit(n)
