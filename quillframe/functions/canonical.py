"""One text for each nested value, whatever the order in which its keys were written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaf(text: Column) -> Column:
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def canonical(value: Column, kind: T.DataType) -> Column:
    """The canonical text of a value of type ``kind``: equal for two values if and only if they are equal.

    Structs give their fields by name, maps and the objects of VARIANT values their entries by key, arrays
    their elements in order; a leaf stands behind its length, null is ``-``. So neither the order of
    keys nor of fields matters, that of arrays does, and null, empty and missing elements differ (a
    missing field of a struct is null). The text is built by the schema, in built-in functions only.
    """
    null = F.lit("-")
    if isinstance(kind, T.StructType):
        fields = [F.concat(F.lit(f"{len(f.name)}:{f.name}"), canonical(value[f.name], f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNull(), null).otherwise(F.concat(F.lit("{"), *fields, F.lit("}")))
    if isinstance(kind, T.ArrayType):
        inner = F.array_join(F.transform(value, lambda x: canonical(x, kind.elementType)), "")
        return F.coalesce(F.concat(F.lit("["), F.size(value).cast("string"), F.lit(":"), inner, F.lit("]")), null)
    if isinstance(kind, T.MapType):
        entry = lambda e: F.concat(canonical(e["key"], kind.keyType), canonical(e["value"], kind.valueType))
        inner = F.array_join(F.array_sort(F.transform(F.map_entries(value), entry)), "")
        return F.coalesce(F.concat(F.lit("("), F.size(value).cast("string"), F.lit(":"), inner, F.lit(")")), null)
    if isinstance(kind, T.VariantType):  # whose objects keep their keys sorted
        return F.coalesce(_leaf(F.to_json(value)), null)
    if isinstance(kind, T.BinaryType):
        return F.coalesce(_leaf(F.hex(value)), null)
    return F.coalesce(_leaf(value.cast("string")), null)


def canonical_json_text(raw: Column) -> Column:
    """JSON text of any depth in canonical form: keys sorted in every object, no blanks; null for what is no JSON."""
    return F.to_json(F.try_parse_json(raw))


def canonical_column(df: DataFrame, column: str) -> Column:
    """The canonical text of a column of ``df``."""
    return canonical(df[column], df.schema[column].dataType)


def nested_digest(df: DataFrame, columns: list[str], json_columns: tuple[str, ...] = ()) -> Column:
    """sha256 of the canonical text of ``columns`` of ``df``, in the order of their names. ``json_columns`` among them
    hold JSON text, of which the value counts and not the spelling; text that is no JSON counts as it is."""
    return F.sha2(F.concat(*(F.concat(F.lit(f"{len(c)}:{c}"), column_text(df, c, json_columns)) for c in sorted(columns))), 256)


def column_text(df: DataFrame, column: str, json_columns: tuple[str, ...] = ()) -> Column:
    """``canonical_column``, or the canonical JSON of a column of JSON text."""
    if column not in json_columns:
        return canonical_column(df, column)
    return F.coalesce(_leaf(F.coalesce(canonical_json_text(df[column]), df[column])), F.lit("-"))
