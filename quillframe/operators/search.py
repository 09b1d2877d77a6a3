"""Filters, text search and credential scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.operators.classify import dependency_class, is_callable

#: A credential parameter or assignment with a value.
LEAK = r"(?i)(?:servicekey|api[_-]?key|authkey|access_token|secret|token|password)\s*[=:]\s*[\"']?[A-Za-z0-9%+/_.-]{8,}"


def apply_filters(df: DataFrame, limit: int = 0, order_by: list[str] | None = None, **equal: object) -> DataFrame:
    """Rows whose columns equal the values given (None: no filter), the first ``limit`` by ``order_by``
    (0: all), with filtered_count (before the limit) and truncated."""
    for column, value in equal.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    total = df.agg(F.count("*").alias("filtered_count"))
    rows = df.orderBy(*(order_by or df.columns)).limit(limit) if limit else df
    return rows.join(F.broadcast(total)).withColumn("truncated", F.lit(bool(limit)) & (F.col("filtered_count") > limit))


def search(df: DataFrame, query: str, fields: list[str], limit: int = 0, order_by: list[str] | None = None) -> DataFrame:
    """Rows in one of whose ``fields`` the query occurs, in either case; the first ``limit`` by ``order_by`` (0: all)."""
    found = df.where(F.contains(F.lower(F.concat_ws("\n", *fields)), F.lower(F.lit(query))))
    return found.orderBy(*(order_by or fields)).limit(limit) if limit else found


CARD_FIELDS = ("id", "title", "provider", "organization", "source_category", "description")


def cards(specs: DataFrame) -> tuple[DataFrame, list[str]]:
    """Cards of specs (with nested ``operations``): ``CARD_FIELDS``, operations_count and callable (some
    operation is); and the names of those fields that a search looks at."""
    fields = [c for c in CARD_FIELDS if c in specs.columns]
    some = F.exists("operations", lambda o: is_callable(dependency_class(o["endpoint"])))
    out = specs.select(*fields, F.coalesce(F.size("operations"), F.lit(0)).alias("operations_count"), F.coalesce(some, F.lit(False)).alias("callable"))
    return out.withColumn("operations_count", F.greatest("operations_count", F.lit(0))), fields


def search_datasets(specs: DataFrame, query: str, limit: int = 0, **equal: object) -> DataFrame:
    """``cards`` of the specs in which the query occurs and whose columns equal the values given; the
    first ``limit`` by id (0: all)."""
    for column, value in equal.items():
        if value is not None:
            specs = specs.where(F.col(column) == value)
    found, fields = cards(specs)
    return search(found, query, fields, limit, ["id"])


def credential_leaks(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` holds what looks like a credential, with the number of places."""
    n = F.size(F.regexp_extract_all(column, F.lit(LEAK), F.lit(0)))
    return df.where(F.col(column).rlike(LEAK)).withColumn("leaks", n)
