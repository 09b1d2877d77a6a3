"""Flattening of specs and classification of operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions.columns import computed_once, first_true, is_root, parts_of, url_cut, url_parts

GATEWAY_HOSTS = ("apis.gateway.example",)
#: Roles of status-like response fields, by lower-case name. Fixed values.
STATUS_FIELDS = {
    "result_code": ("resultcode", "result_code", "code", "errcode"),
    "result_message": ("resultmsg", "result_msg", "resultmessage", "message"),
    "reason_code": ("returnreasoncode",),
    "auth_message": ("returnauthmsg",),
    "error_message": ("errmsg", "errormessage", "error_message"),
}


def operations(specs: DataFrame) -> DataFrame:
    """One row per spec and operation, with its ordinal; a spec without operations has one row of nulls."""
    rest = [c for c in specs.columns if c != "operations"]
    rows = specs.select(*rest, F.posexplode_outer("operations").alias("ordinal", "op"))
    return rows.select(*rest, "ordinal", F.col("op.name").alias("operation"), *(F.col(f"op.{c}") for c in ("endpoint", "default_params", "request_params", "response_params")))


def params(ops: DataFrame, keys: tuple[str, ...] = ("id", "operation")) -> DataFrame:
    """One row per request or response parameter: keys, direction, ordinal, name, label."""
    sides = [
        ops.select(*keys, F.lit(direction).alias("direction"), F.posexplode(column).alias("ordinal", "p")).select(
            *keys, "direction", "ordinal", "p.name", "p.label"
        )
        for direction, column in (("request", "request_params"), ("response", "response_params"))
    ]
    return sides[0].unionByName(sides[1])


def dependency_class(endpoint: Column, gateway_hosts: tuple[str, ...] = GATEWAY_HOSTS, parts: Column | None = None) -> Column:
    """The class of an endpoint URL; the first that fits of: blank, unparsable, SOAP, WMS, host only, gateway, external.

    SOAP: the query asks for a ``wsdl``, or the path ends in ``.asmx``. WMS: the query has
    ``service=wms`` or the path ends in ``/wms``. ``parts`` may be given where they are known.
    """
    trimmed = F.trim(endpoint)
    parts = url_parts(trimmed) if parts is None else parts
    low = F.lower(trimmed)
    return first_true(
        (F.coalesce(trimmed, F.lit("")) == "", "no_endpoint"),
        (parts["authority"].isNull(), "malformed_endpoint"),
        (low.rlike(r"[?&]wsdl|\.asmx([?#]|$)"), "soap"),
        (low.rlike(r"[?&]service=wms|/wms([?#]|$)"), "wms"),
        (is_root(parts), "service_root"),
        (parts["authority"].isin(*gateway_hosts), "gateway"),
        otherwise="external_endpoint",
    )


def approval_required(dev: Column, prod: Column) -> Column:
    """Whether development or production use needs an approval; unknown counts as no."""
    return F.coalesce(dev == "manual", F.lit(False)) | F.coalesce(prod == "manual", F.lit(False))


def is_callable(cls: Column) -> Column:
    """Whether an operation has an endpoint that isn't only a host."""
    return ~cls.isin("no_endpoint", "service_root")


def adapter_hosts(adapters: DataFrame) -> DataFrame:
    """(host, adapter, adapter_state, capabilities): one row per host; of several adapters the last
    by ``ordinal``, the place in the input that ``read_report`` gives (by name where there is none)."""
    place = F.col("ordinal" if "ordinal" in adapters.columns else "name")
    hosts = adapters.select(F.explode("hosts").alias("host"), F.struct("name", "status", "capabilities").alias("a"), F.struct(place, "name").alias("place"))
    last = hosts.groupBy("host").agg(F.max_by("a", "place").alias("a"))
    return last.select("host", F.col("a.name").alias("adapter"), F.col("a.status").alias("adapter_state"), F.col("a.capabilities").alias("capabilities"))


def attach_adapter(df: DataFrame, adapters: DataFrame, host: str = "endpoint_host") -> DataFrame:
    """``df`` with the adapter of its host, if one is registered. Spark broadcasts the adapters if they are small."""
    hosts = adapter_hosts(adapters).withColumnRenamed("host", "adapter_host")
    return df.join(hosts, F.col(host) == F.col("adapter_host"), "left").drop("adapter_host")


def adapter_status(cls: Column, adapter: Column) -> Column:
    """builtin for the gateway; adapter or missing where calls need one; else not_applicable."""
    needs = cls.isin("external_endpoint", "service_root")
    return first_true(
        (cls == "gateway", "builtin"), (needs & adapter.isNotNull(), "adapter"), (needs, "missing"), otherwise="not_applicable"
    )


def classify(deps: DataFrame, adapters: DataFrame, gateway_hosts: tuple[str, ...] = GATEWAY_HOSTS) -> DataFrame:
    """``deps`` (endpoint, dev_approval, prod_approval, source_host; guide_url if there is one) with
    endpoint_host, guide_host, route_host, dependency_class, adapter, adapter_status,
    approval_required and callable.

    A URL is cut and judged once a row, whatever reads or filters the result."""
    guide = F.col("guide_url") if "guide_url" in deps.columns else F.lit(None).cast("string")
    out = computed_once(deps, "url_cut", F.struct(url_cut(F.trim("endpoint")).alias("own"), url_cut(F.trim(guide)).alias("guide")))
    own = parts_of(F.col("url_cut.own"))
    out = computed_once(out, "cls", dependency_class(F.col("endpoint"), gateway_hosts, own))
    out = out.withColumns(
        {
            "dependency_class": F.col("cls"),
            "endpoint_host": F.when(F.col("cls") != "service_root", own["authority"]),
            "guide_host": parts_of(F.col("url_cut.guide"))["authority"],
        }
    ).drop("cls", "url_cut")
    out = out.withColumn("route_host", F.coalesce(F.nullif("endpoint_host", F.lit("")), F.nullif("source_host", F.lit(""))))
    out = attach_adapter(out, adapters, "route_host")
    return out.withColumns(
        {
            "adapter_status": adapter_status(F.col("dependency_class"), F.col("adapter")),
            "approval_required": approval_required(F.col("dev_approval"), F.col("prod_approval")),
            "callable": is_callable(F.col("dependency_class")),
        }
    ).drop("adapter_state", "capabilities")


def status_field_role(name: Column) -> Column:
    """The role of a response field by its name; null for other fields."""
    return first_true(*((F.lower(name).isin(*names), role) for role, names in STATUS_FIELDS.items()))


def missing_params(params_map: Column) -> Column:
    """Names of parameters whose value is empty, sorted."""
    return F.array_sort(F.map_keys(F.map_filter(params_map, lambda k, v: v == "")))


def preflight_reason(cls: Column, approval: Column, missing: Column, has_key: Column, mutates: Column | None = None) -> Column:
    """Why an operation isn't called at all; null if it may be.

    Protocol, metadata only, mutation (``mutates``: a call would change data), service root and
    approval come before parameters, and these before the key.
    """
    return first_true(
        (cls.isin("soap", "wms"), "unsupported_protocol"),
        (cls.isin("no_endpoint", "malformed_endpoint"), "metadata_only"),
        (F.lit(False) if mutates is None else mutates, "mutation_endpoint"),
        (cls == "service_root", "missing_operation_path"),
        (approval, "approval_required"),
        (F.size(missing) > 0, "missing_required_params"),
        (~has_key, "missing_auth"),
    )


def semantic_status(ok: Column, http_status: Column, body_shape: Column) -> Column:
    """What a reply means: the provider's own verdict first, then HTTP errors, then HTML where data was due."""
    return first_true(
        (ok, "provider_ok"),
        (~ok, "provider_error"),
        (http_status.between(400, 499), "http_error"),
        (http_status.between(200, 299) & (body_shape == "html"), "html_response"),
    )
