"""Queries of nested digests and of differences by blocks, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.functions.canonical import nested_digest
from quillframe.operators import nested_checks, snapshots
from quillframe.plans.lens import Lens
from quillframe.plans.report_queries import query
from quillframe.sources.json_arrays import CORRUPT, read_json_array, write_json_arrays
from quillframe.sources.shared import FREED, scratch_path, settings, stored

_COLUMNS = ["operations", "organization", "provider", "source_category", "title", "updated_at", "url"]
#: Fewer buckets than in production, as the given tables are small.
_BUCKETS = 256


def _leaf(e: str) -> str:
    return f"coalesce(length(CAST({e} AS VARCHAR)) || ':' || CAST({e} AS VARCHAR), '-')"


def _operation(name: str) -> str:
    """SQL of an operation's canonical text."""
    return (
        "'{14:default_params(2:6:pageNo1:16:region' || CASE WHEN part_key % 2 = 0 THEN '0:' ELSE '1:x' END || ')8:endpoint' || " + _leaf("endpoint")
        + f" || '4:name' || {_leaf(name)}"
        + " || '14:request_params[' || request_params_count || ':' || array_to_string(list_transform(range(1, CAST(request_params_count AS BIGINT) + 1), lambda k: '{5:label7:a label4:name' || length('q' || k) || ':q' || k || '}'), '') || ']'"
        + " || '15:response_params[1:{5:label7:a label4:name' || " + _leaf("['resultCode', 'resultMsg', 'returnAuthMsg', 'errMsg', 'total'][CAST(part_key % 5 + 1 AS BIGINT)]") + " || '}]}'"
    )


_ORDER = "part_key {d}, supp_key {d}, price {d}, operation {d}, endpoint {d} NULLS {n}"
_FORWARD, _BACKWARD = _ORDER.format(d="ASC", n="FIRST"), _ORDER.format(d="DESC", n="LAST")
_NESTED = f"""
, op_texts AS (SELECT dataset_id, count(*) AS n, string_agg({_operation("operation")}, '' ORDER BY {_FORWARD}) AS forward, string_agg({_operation("operation")}, '' ORDER BY {_BACKWARD}) AS backward,
  string_agg({_operation("operation || 'x'")}, '' ORDER BY {_FORWARD}) AS renamed, string_agg({_operation("operation || 'x'")}, '' ORDER BY {_BACKWARD}) AS renamed_backward
  FROM raw_deps WHERE dataset_id <> '' GROUP BY 1),
nested AS (SELECT specs.*, CAST(substr(id, 3) AS BIGINT) AS k, n, forward, backward, renamed, renamed_backward FROM specs LEFT JOIN op_texts ON id = dataset_id),
"""


def _digest(operations: str, title: str) -> tuple[str, dict[str, str]]:
    """SQL of a spec's digest, and of the text of each column."""
    texts = {c: _leaf(c) for c in _COLUMNS} | {"operations": f"coalesce('[' || n || ':' || {operations} || ']', '-')", "title": _leaf(title)}
    return "sha256(" + " || ".join(f"'{len(c)}:{c}' || {texts[c]}" for c in sorted(_COLUMNS)) + ")", texts


_OLD_DIGEST, _OLD_TEXTS = _digest("forward", "title")
_NEW_TITLE = "CASE WHEN k % 17 = 0 THEN NULL ELSE title END"
_NEW_OPERATIONS = "CASE WHEN k % 13 = 0 AND k % 19 = 0 THEN renamed_backward WHEN k % 13 = 0 THEN backward WHEN k % 19 = 0 THEN renamed ELSE forward END"
_NEW_DIGEST, _NEW_TEXTS = _digest(_NEW_OPERATIONS, _NEW_TITLE)
_SIDES = _NESTED + f"""o AS (SELECT id, {_OLD_DIGEST} AS digest, {_OLD_TEXTS["operations"]} AS ops, {_OLD_TEXTS["title"]} AS title_text FROM nested WHERE k % 10 <> 3),
n AS (SELECT id, {_NEW_DIGEST} AS digest, {_NEW_TEXTS["operations"]} AS ops, {_NEW_TEXTS["title"]} AS title_text FROM nested WHERE k % 10 <> 4),
d AS (SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN o.digest <> n.digest THEN 'changed' ELSE 'stable' END AS change,
  o.digest AS old_digest, n.digest AS new_digest, concat_ws(',', CASE WHEN o.ops <> n.ops THEN 'operations' END, CASE WHEN o.title_text <> n.title_text THEN 'title' END) AS fields
  FROM o FULL JOIN n ON o.id = n.id)
"""


def _sides(lens: Lens) -> tuple[DataFrame, DataFrame]:
    """Specs with nested operations as two snapshots: names and titles that change, operations in another order
    (a change), and maps whose keys were put in another order (none)."""
    with settings(lens.spark, **FREED):
        specs = stored(lens.nested_specs())  # for both sides
    k = F.substring("id", 3, 20).cast("long")

    def changed(op):
        swapped = F.map_from_entries(F.reverse(F.map_entries(op["default_params"])))
        return op.withField("name", F.when(k % 19 == 0, F.concat(op["name"], F.lit("x"))).otherwise(op["name"])).withField("default_params", swapped)

    ops = F.transform("operations", changed)
    new = specs.withColumns({"title": F.when(k % 17 != 0, F.col("title")), "operations": F.when(k % 13 == 0, F.reverse(ops)).otherwise(ops)})
    return specs.where(k % 10 != 3), new.where(k % 10 != 4)


@query(_NESTED + f"d AS (SELECT id, {_OLD_DIGEST} AS digest FROM nested)\nSELECT * FROM d")
def nested_digests(lens: Lens) -> DataFrame:
    """P22 of nested specs."""
    specs = lens.nested_specs()
    return specs.select("id", nested_digest(specs, _COLUMNS).alias("digest"))


@query(_NESTED + f"""d AS (SELECT id, {_OLD_DIGEST} AS digest FROM nested)\nSELECT *, false AS quarantined FROM d""")
def specs_from_arrays(lens: Lens) -> DataFrame:
    """Specs written as JSON arrays and read back in byte ranges, by their digests."""
    specs, path = lens.nested_specs().select("id", *_COLUMNS), scratch_path(lens.spark)
    write_json_arrays(specs, path, ["id"])
    back = read_json_array(lens.spark, f"{path}/*", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in specs.schema))
    return back.select("id", nested_digest(back, _COLUMNS).alias("digest"), F.col(CORRUPT).isNotNull().alias("quarantined"))


def _indexes(lens: Lens) -> tuple[str, str]:
    paths = scratch_path(lens.spark), scratch_path(lens.spark)
    for side, path in zip(_sides(lens), paths, strict=True):
        snapshots.write_index(side, path, _COLUMNS, buckets=_BUCKETS)
    return paths


@query(_SIDES + "SELECT id, change, old_digest, new_digest, CASE WHEN change = 'changed' THEN fields ELSE '' END AS fields FROM d")
def nested_snapshot_diff(lens: Lens) -> DataFrame:
    """J4, P22 of nested specs, by digests of blocks."""
    return snapshots.diff_indexes(lens.spark, *_indexes(lens), _COLUMNS, buckets=_BUCKETS)


@query(_SIDES + "SELECT count(*) FILTER (change = 'added') AS added, count(*) FILTER (change = 'removed') AS removed, count(*) FILTER (change = 'changed') AS changed, count(*) FILTER (change = 'stable') AS stable FROM d")
def nested_snapshot_counts(lens: Lens) -> DataFrame:
    """J4's totals; stable specs are counted, not read."""
    return snapshots.diff_counts(lens.spark, *_indexes(lens), _COLUMNS, buckets=_BUCKETS)


# Constraints on nested specs.

_CONSTRAINTS = [
    ("", "closed", '["id", "title", "provider", "organization", "source_category", "updated_at", "url", "operations"]'),
    ("title", "required", None),
    ("organization", "min_length", "1"),
    ("operations", "required", None),
    ("operations", "min_items", "2"),
    ("operations[]", "closed", '["name", "endpoint", "default_params", "request_params", "response_params"]'),
    ("operations[].name", "min_length", "1"),
    ("operations[].endpoint", "required", None),
    ("operations[].endpoint", "matches", "^https?://"),
    ("operations[].default_params{}", "min_length", "1"),
    ("operations[].default_params", "closed", '["pageNo", "region"]'),
    ("operations[].request_params", "min_items", "1"),
    ("operations[].response_params[].name", "one_of", '["resultCode", "resultMsg", "returnAuthMsg", "errMsg"]'),
]


@query(f"""
, o AS (SELECT dataset_id AS id, CAST(substr(dataset_id, 3) AS BIGINT) AS k, row_number() OVER (PARTITION BY dataset_id ORDER BY {_FORWARD}) - 1 AS i, * EXCLUDE (dataset_id) FROM raw_deps
  WHERE dataset_id <> '' AND dataset_id IN (SELECT id FROM specs)),
n AS (SELECT id, count(*) AS n FROM o GROUP BY 1),
s AS (SELECT specs.*, CAST(substr(specs.id, 3) AS BIGINT) AS k, n FROM specs LEFT JOIN n USING (id)),
v AS (
  SELECT id, 'title' AS path, 'required' AS rule, NULL AS detail FROM s WHERE k % 17 = 0
  UNION ALL SELECT id, 'organization', 'min_length', '' FROM s WHERE organization = ''
  UNION ALL SELECT id, 'operations', 'required', NULL FROM s WHERE n IS NULL
  UNION ALL SELECT id, 'operations', 'min_items', '1' FROM s WHERE n = 1
  UNION ALL SELECT id, 'operations[' || i || ']', 'closed', 'hint' FROM o WHERE k % 23 = 0
  UNION ALL SELECT id, 'operations[' || i || '].name', 'min_length', '' FROM o WHERE k % 19 = 0
  UNION ALL SELECT id, 'operations[' || i || '].endpoint', 'required', NULL FROM o WHERE endpoint IS NULL
  UNION ALL SELECT id, 'operations[' || i || '].endpoint', 'matches', endpoint FROM o WHERE NOT regexp_matches(endpoint, '^https?://')
  UNION ALL SELECT id, 'operations[' || i || '].default_params{{region}}', 'min_length', '' FROM o WHERE part_key % 2 = 0
  UNION ALL SELECT id, 'operations[' || i || '].default_params', 'closed', 'odd' FROM o WHERE k % 13 = 0
  UNION ALL SELECT id, 'operations[' || i || '].request_params', 'min_items', '0' FROM o WHERE request_params_count = 0
  UNION ALL SELECT id, 'operations[' || i || '].response_params[0].name', 'one_of', 'total' FROM o WHERE part_key % 5 = 4)
SELECT id AS row_key, path, rule, detail FROM v""")
def nested_violations(lens: Lens) -> DataFrame:
    """C1-C4, C6, C7 at any depth: specs with unnamed operations, fields that the contract doesn't have and the rest that the views hold."""
    specs = lens.nested_specs()
    k = F.substring("id", 3, 20).cast("long")

    def odd(op):
        op = op.withField("name", F.when(k % 19 == 0, F.lit("")).otherwise(op["name"])).withField("hint", F.when(k % 23 == 0, F.lit("a hint")))
        more = F.map_concat(op["default_params"], F.create_map(F.lit("odd"), F.lit("1")))
        return op.withField("default_params", F.when(k % 13 == 0, more).otherwise(op["default_params"]))

    changed = specs.withColumns({"title": F.when(k % 17 != 0, F.col("title")), "operations": F.transform("operations", odd)})
    constraints = lens.spark.createDataFrame(_CONSTRAINTS, "path string, rule string, argument string")
    return nested_checks.check_nested(changed, F.col("id"), constraints)
