"""Constraints on values at any depth, given as a table and checked in one pass.

A constraint is a row (path, rule, argument). A path names fields by dots, ``[]`` stands for all
elements of an array and ``{}`` for all values of a map: ``operations[].request_params[].name``,
``operations[].default_params{}``; the empty path is the record. Paths become a tree, and the tree one
expression: each array and map is walked once, whatever the number of constraints below it. A
violation names where it is: ``operations[3].request_params[0].name``.

| rule | argument | violated by |
| --- | --- | --- |
| ``required`` | | a missing or null value |
| ``min_length`` | number | a shorter text |
| ``min_items`` | number | an array or map of fewer elements |
| ``unique_items`` | | an array that has equal elements (null is equal to null) |
| ``one_of`` | JSON array | any other value |
| ``matches`` | pattern | a text in which it isn't found |
| ``between`` | JSON array of two numbers | a number outside |
| ``closed`` | JSON array of names | a field of a struct, a key of a map or of an object kept as JSON text, of another name, that isn't null |

Null values violate ``required`` alone, and nothing below a null is required. Without a record,
constraint or violation there are no rows; repeated records are checked each time.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Constraints that the driver takes at most; they are written by hand.
MAX_CONSTRAINTS = 10_000
_FOUND = "array<struct<path:string,rule:string,detail:string>>"

#: The contract of specs, level by level.
SPEC_FIELDS = (
    "id title provider organization source_category priority source_keywords search_terms operations smoke source description".split()
)
OPERATION_FIELDS = "name endpoint default_params request_params response_params source".split()
SPEC_CONTRACT = [
    ("", "closed", json.dumps(SPEC_FIELDS)),
    ("id", "required", None), ("id", "min_length", "1"), ("title", "required", None), ("title", "min_length", "1"),
    ("provider", "required", None), ("provider", "min_length", "1"), ("priority", "required", None), ("operations", "required", None),
    ("operations[]", "closed", json.dumps(OPERATION_FIELDS)),
    ("operations[].name", "required", None), ("operations[].name", "min_length", "1"),
    ("operations[].request_params[]", "closed", '["name", "label"]'),
    ("operations[].request_params[].name", "required", None), ("operations[].request_params[].name", "min_length", "1"),
    ("operations[].response_params[]", "closed", '["name", "label"]'),
    ("operations[].response_params[].name", "required", None), ("operations[].response_params[].name", "min_length", "1"),
    ("operations[].source", "closed", '["system", "url", "raw"]'),
    ("operations[].source.system", "required", None), ("operations[].source.system", "min_length", "1"),
    ("smoke", "closed", '["operation", "params"]'),
    ("source", "closed", '["system", "url", "raw"]'), ("source.system", "required", None), ("source.system", "min_length", "1"),
]


class _Node:
    """What is asked of the values at one place, and the places below it."""

    def __init__(self) -> None:
        self.rules: list[tuple[str, str | None]] = []
        self.below: dict[str, _Node] = {}


def _steps(path: str) -> list[str]:
    return [s for s in path.replace("[]", ".[]").replace("{}", ".{}").split(".") if s]


def _tree(constraints: list[tuple[str, str, str | None]]) -> _Node:
    root = _Node()
    for path, rule, argument in constraints:
        node = root
        for step in _steps(path):
            node = node.below.setdefault(step, _Node())
        node.rules.append((rule, argument))
    return root


def _violated(value: Column, kind: T.DataType | None, rule: str, argument: str | None) -> tuple[Column, Column]:
    """Whether a value that isn't null breaks a rule (null and false: no), and what to say about it."""
    text = value.cast("string") if kind is None or not isinstance(kind, T.ArrayType | T.MapType | T.StructType) else F.lit(None).cast("string")
    if rule == "min_length":
        return F.length(text) < int(argument), text
    if rule == "min_items":
        return F.size(value) < int(argument), F.size(value).cast("string")
    if rule == "unique_items":
        return F.size(F.array_distinct(value)) < F.size(value), (F.size(value) - F.size(F.array_distinct(value))).cast("string")
    if rule == "one_of":
        return ~text.isin([str(x) for x in json.loads(argument)]), text
    if rule == "matches":
        return ~text.rlike(argument), text
    if rule == "between":
        low, high = json.loads(argument)
        return ~value.between(low, high), text
    raise ValueError(f"no such rule: {rule}")


def _unknown(value: Column, kind: T.DataType | None, names: list[str]) -> Column:
    """The names that a closed object shouldn't have, as an array."""
    none = F.array().cast("array<string>")
    if isinstance(kind, T.StructType):
        return F.concat(none, F.array_compact(F.array(*(F.when(value[f.name].isNotNull(), F.lit(f.name)) for f in kind.fields if f.name not in names), F.lit(None).cast("string"))))
    keys = F.map_keys(value) if isinstance(kind, T.MapType) else F.json_object_keys(value.cast("string"))
    return F.coalesce(F.array_sort(F.filter(keys, lambda k: ~k.isin(names))), none)


def _found(value: Column, kind: T.DataType | None, node: _Node, at: Column) -> Column:
    """The violations at one place and below it."""
    none = F.array().cast(_FOUND)
    here: list[Column] = []
    parts: list[Column] = []
    for rule, argument in node.rules:
        if rule == "required":
            bad, detail = value.isNull(), F.lit(None).cast("string")
        elif rule == "closed":
            if kind is not None:
                parts.append(F.transform(_unknown(value, kind, json.loads(argument)), lambda k: F.struct(at.alias("path"), F.lit("closed").alias("rule"), k.alias("detail"))))
            continue
        elif kind is None:
            continue
        else:
            bad, detail = _violated(value, kind, rule, argument)
        here.append(F.when(F.coalesce(bad, F.lit(False)), F.struct(at.alias("path"), F.lit(rule).alias("rule"), detail.alias("detail"))))
    if here:
        parts.append(F.array_compact(F.array(*here)))
    for step, below in node.below.items():
        if step == "[]":
            if isinstance(kind, T.ArrayType):
                parts.append(F.flatten(_elements(value, kind.elementType, below, at)))
        elif step == "{}":
            if isinstance(kind, T.MapType):
                parts.append(F.flatten(_values(value, kind.valueType, below, at)))
        else:
            field = next((f.dataType for f in kind.fields if f.name == step), None) if isinstance(kind, T.StructType) else None
            inner = value[step] if field is not None else F.lit(None).cast("string")
            where = F.when(at == "", F.lit(step)).otherwise(F.concat(at, F.lit(f".{step}")))
            parts.append(_found(inner, field, below, where))
    if not parts:
        return none
    found = F.concat(none, *(F.coalesce(p, none) for p in parts))
    # Nothing but the value itself is required where there is no value.
    own = F.array_compact(F.array(*here)) if here else none
    return F.when(value.isNull(), own).otherwise(found)


def _elements(value: Column, kind: T.DataType, below: _Node, at: Column) -> Column:
    return F.transform(value, lambda x, i: _found(x, kind, below, F.concat(at, F.lit("["), i.cast("string"), F.lit("]"))))


def _values(value: Column, kind: T.DataType, below: _Node, at: Column) -> Column:
    entry = lambda e: _found(e["value"], kind, below, F.concat(at, F.lit("{"), e["key"].cast("string"), F.lit("}")))
    return F.transform(F.map_entries(value), entry)


def check_nested(records: DataFrame, key: Column, constraints: list[tuple[str, str, str | None]] | DataFrame) -> DataFrame:
    """(row_key, path, rule, detail) of every violation in ``records``. ``constraints`` are rows (path, rule,
    argument): a list, or a table of ``MAX_CONSTRAINTS`` at most."""
    if isinstance(constraints, DataFrame):
        rows = constraints.select("path", "rule", "argument").limit(MAX_CONSTRAINTS + 1).collect()
        if len(rows) > MAX_CONSTRAINTS:
            raise ValueError(f"more than {MAX_CONSTRAINTS} constraints")
        constraints = sorted(map(tuple, rows), key=repr)
    tree = _tree(constraints)
    record = F.struct(*(F.col(c) for c in records.columns))
    found = _found(record, records.schema, tree, F.lit(""))
    return records.select(key.cast("string").alias("row_key"), F.explode(found).alias("v")).select("row_key", "v.path", "v.rule", "v.detail")
