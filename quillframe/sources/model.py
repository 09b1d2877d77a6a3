"""Schemas of the catalogue's tables as Spark DDL, and its closed sets of values."""

from __future__ import annotations

PARAM = "array<struct<name:string,label:string>>"
#: ``raw`` is an open object, kept as JSON text (see ``functions.columns.raw_field``).
SOURCE = "struct<system:string,url:string,raw:string>"
OPERATION = f"struct<name:string,endpoint:string,default_params:map<string,string>,request_params:{PARAM},response_params:{PARAM},source:{SOURCE}>"
SPECS = (
    "id string, title string, provider string, organization string, source_category string, priority string, "
    f"source_keywords array<string>, description string, updated_at string, url string, operations array<{OPERATION}>"
)
DEPENDENCIES = (
    "dataset_id string, title string, organization string, source_category string, operation string, provider string, "
    "endpoint string, endpoint_host string, source_host string, guide_host string, dependency_class string, adapter_status string, "
    "api_type string, data_format string, dev_approval string, prod_approval string, approval_required boolean, skip_reason string, "
    "request_params_count bigint, response_params_count bigint, missing_params array<string>"
)
EVIDENCE = (
    "dataset_id string, title string, operation string, provider string, endpoint_host string, dependency_class string, status string, "
    "reason string, verified_at timestamp, http_status int, semantic_status string, "
    "provider_status struct<ok:boolean,source:string,code:string,message:string>, url string, params map<string,string>, "
    "missing_params array<string>, body_shape string"
)
ADAPTERS = "name string, status string, hosts array<string>, capabilities array<string>"

#: The key that matches an operation to evidence; missing values count as empty.
EVIDENCE_KEY = ("dataset_id", "operation", "endpoint_host", "dependency_class")

DEPENDENCY_CLASSES = (
    "gateway", "external_endpoint", "service_root", "no_endpoint", "malformed_endpoint", "soap", "wms",
)
ADAPTER_STATUSES = ("builtin", "missing", "adapter", "not_applicable")
EVIDENCE_STATUSES = ("verified", "failed", "skipped", "unknown")
DISPOSITIONS = ("adapter_candidate", "dead_route_candidate", "transient_failure", "parameter_blocked")
