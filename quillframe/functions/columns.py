"""Small column functions: defaults, percentages, URLs, templates, digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Query parameters whose value is a credential.
CREDENTIAL_KEYS = ("serviceKey", "api_key", "apikey", "authKey", "access_token", "token", "crtfc_key")


def or_default(c: Column, default: str) -> Column:
    """``c``, or ``default`` where it is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, to one decimal; halves go up; 0.0 where ``whole`` isn't positive.

    Tenths are computed in whole numbers, so no binary fraction decides a tie.
    """
    part, whole = part.cast("long"), whole.cast("long")
    tenths = F.call_function("div", 2000 * part + whole, F.nullif(2 * whole, F.lit(0)))
    return F.when(whole > 0, tenths.cast("double") / 10).otherwise(0.0)


#: Scheme, user, authority, path, query with its mark, fragment; white space is in none of them.
_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@\s]*@)?([^/?#\s]*)([^?#\s]*)(\?[^#\s]*)?(?:#\S*)?$"


def url_cut(url: Column) -> Column:
    """Array of ``host[:port]``, path, and query with its ``?``, cut by one regular expression (no parser
    throws on dirty rows); of another size for what is no URL."""
    return F.split(F.regexp_replace(F.translate(url, "\n", " "), _URL, "$1\n$2\n$3"), "\n")


def parts_of(cut: Column) -> Column:
    """struct<authority, path, query> of ``url_cut``; all null for what is no URL (no ``scheme://``, no
    host, or white space inside)."""
    found = (F.size(cut) == 3) & (F.element_at(cut, 1) != "")
    return F.struct(*(F.when(found, F.element_at(cut, k + 1)).alias(name) for k, name in enumerate(("authority", "path", "query"))))


def url_parts(url: Column) -> Column:
    """struct<authority, path, query> of a URL; all null for what is none."""
    return parts_of(url_cut(url))


def url_authority(url: Column) -> Column:
    """``host[:port]`` of a URL; null where there is none."""
    return url_parts(url)["authority"]


def is_root(parts: Column) -> Column:
    """Whether ``url_parts`` name a host only: no path but ``/`` and no query."""
    return parts["path"].isin("", "/") & (parts["query"] == "")


def redact_url(url: Column, keys: tuple[str, ...] = CREDENTIAL_KEYS) -> Column:
    """``url`` with the value of every credential parameter replaced by ``REDACTED``."""
    return F.regexp_replace(url, rf"(?i)([?&](?:{'|'.join(keys)})=)[^&#]*", "$1REDACTED")


def template_placeholders(template: Column) -> Column:
    """The distinct ``{name}`` tokens of an endpoint template, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(template, F.lit(r"\{([^{}]+)\}"), F.lit(1))))


def contract_version(name: Column) -> tuple[Column, Column]:
    """(contract, version) of a schema file's name: ``<family>.<contract>.<version>.schema.json``."""
    pattern = r"^[^.]+\.(.+)\.(v[0-9]+)\.schema\.json$"
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")), F.nullif(F.regexp_extract(name, pattern, 2), F.lit(""))


def raw_field(raw: Column, path: str) -> Column:
    """The value at a JSON path (``$.a.b``) of an open object kept as JSON text, as a string; null where the
    text is no JSON or has no such value."""
    return F.try_variant_get(F.try_parse_json(raw), path, "string")


def canonical_json(raw: Column) -> Column:
    """An object of string values with its keys sorted; null for other JSON."""
    entries = F.array_sort(F.map_entries(F.from_json(raw, "map<string,string>", {"mode": "PERMISSIVE"})))
    return F.to_json(F.map_from_entries(entries))


def stamp(c: Column) -> Column:
    """An ISO 8601 stamp (``...Z``) as a timestamp; null for other text."""
    return F.try_to_timestamp(c)


def iso_stamp(c: Column) -> Column:
    """A timestamp as an ISO 8601 stamp in UTC, to the second (the session's zone must be UTC)."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def digest(*columns: Column) -> Column:
    """sha256 of columns in the order given: each value as text behind its length, nulls apart from empty.

    Two rows have equal digests if and only if all their columns are equal. Maps and arrays are
    given as text by the caller (maps with their entries sorted).
    """
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws(",", *parts), 256)


def has_all(required: Column, present: Column) -> Column:
    """Whether every element of ``required`` is in ``present``; null arrays count as empty."""
    empty = F.array().cast("array<string>")
    return F.size(F.array_except(F.coalesce(required, empty), F.coalesce(present, empty))) == 0


def covers_all(expected: Column, listed: Column) -> Column:
    """Whether ``listed`` names exactly what is in ``expected``, in sorted order; null arrays count as empty."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.coalesce(expected, empty)) == F.coalesce(listed, empty)


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row. The optimizer copies a projected expression
    into every filter and column that uses it; a generated row is beyond its reach."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def first_true(*cases: tuple[Column, str | Column], otherwise: str | Column | None = None) -> Column:
    """The value of the first case that holds; a null condition doesn't."""
    out = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    assert out is not None
    if otherwise is None:
        return out
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
