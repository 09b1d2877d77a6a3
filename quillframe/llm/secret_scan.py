"""Secret scans: fixed patterns, and strings that compression finds new in a sensitive context.

A candidate is a long run of key-like characters, letters and digits mixed, with a sensitive
word shortly before it; in NAME=value the value alone is one, and the name counts as before it. A
sensitive word also counts for the candidates that adjoin the one it stands before: the further
lines of a block, and parts joined by dots. A candidate's novelty is the marginal size: zstandard, primed with a dictionary of
common identifiers and code, compresses the text around it with and without the candidate, and
the difference is divided by the candidate's length. Identifiers, repeated values and words
compress well; random strings don't. Candidates at or above ``min_novelty`` are reported.

One pass over Arrow batches; nothing is shuffled and nothing goes through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The order of kinds at one start.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE, MIN_ACCESS = 6, 20
SENSITIVE_WORDS = (
    "password", "passwd", "pwd", "secret", "token", "api", "key", "credential", "auth", "bearer", "private", "access", "signature",
)
SENSITIVE = re.compile("|".join(SENSITIVE_WORDS), re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: The parts of a candidate: names and values between signs of assignment, with the padding of base 64.
PART = re.compile(r"[A-Za-z0-9+/_-]+=*")
MIN_CANDIDATE = 16
#: What stands between candidates that adjoin: a dot, or the end of a line (escaped or quoted ones, and marks of a margin, too).
ADJOINS = re.compile(r"""\.|\\|["']?[\x20\t]*[+,\\]?[\x20\t]*\r?\n[\x20\t>#*|]*["']?""")
#: The last line of a block, which may be too short to tell its novelty.
TAIL = re.compile(r"""(?:\\n|\s){1,8}([A-Za-z0-9+/=]+)(?=(?:\\n|\s){1,8}-----END)""")
#: Characters before a candidate in which a sensitive word must stand.
REACH = 48
#: Characters around a candidate that it is compared with.
AROUND = 256
#: Marginal compressed bytes per character from which a candidate is reported. A random base-64
#: string needs 0.75 or more; names made of known identifiers need 0.5 at most.
MIN_NOVELTY = 0.65
#: Identifiers, words of configuration files and common placeholders.
DICTIONARY = """
import export return function class const static public private protected final void string integer boolean
if else for while switch case break continue try catch finally throw throws new delete this self super
true false null none undefined default value values name names key keys token tokens secret secrets password
passwords username user users account accounts access_key access_token api_key api_token auth_token bearer
authorization Authorization: Bearer client_id client_secret private_key public_key refresh_token session_id
csrf_token content-type application/json charset=utf-8 https://www.example.com/ http://localhost:8080/ index.html
config.yaml settings.json package.json requirements.txt environment production development staging testing
your_password_here your-api-key-here changeme placeholder example_token xxxxxxxxxxxxxxxx 0000000000000000
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890 aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa
getElementById addEventListener toString valueOf hashCode equals compareTo parseInt parseFloat utf8 sha256 md5
""".encode()

SPAN = "array<struct<kind:string,first:int,end:int,novelty:double>>"
SPAN_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("first", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())])
)


def compressor(dictionary: bytes = DICTIONARY) -> zstandard.ZstdCompressor:
    """A compressor primed with ``dictionary``."""
    primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False)


def novelty(text: str, first: int, end: int, by: zstandard.ZstdCompressor) -> float:
    """Marginal compressed bytes per character of ``text[first:end]`` in its surroundings."""
    before, after = text[max(0, first - AROUND) : first], text[end : end + AROUND]
    whole = by.compress((before + text[first:end] + after).encode("utf-8", "replace"))
    rest = by.compress((before + after).encode("utf-8", "replace"))
    return (len(whole) - len(rest)) / max(1, end - first)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by start, then kind."""
    found: list[tuple[str, int, int]] = []
    lowered = text.lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def in_context(text: str) -> Iterator[tuple[int, int, int, int]]:
    """(first, end, first and end of the run they are part of) of the candidates with a sensitive word before them.

    A run of several parts follows its parts, for those whose parts are too short.
    """
    before, sensitive = -1, False
    for m in CANDIDATE.finditer(text):
        first, end = m.span()
        parts = [p.span() for p in PART.finditer(text, first, end)]
        own = sensitive and len(parts) == 1 and ADJOINS.fullmatch(text, before, first) is not None
        before, at = end, max(0, first - REACH)
        sensitive = own or SENSITIVE.search(text, at, first) is not None
        if sensitive and parts != [(first, end)]:
            parts.append((first, end))
        for a, b in parts:
            if b - a >= MIN_CANDIDATE:
                if not sensitive:
                    sensitive = SENSITIVE.search(text, at, a) is not None
                    at = max(at, a - REACH)
                if sensitive:
                    yield a, b, first, end


def spans_of(text: str, by: zstandard.ZstdCompressor, min_novelty: float) -> list[tuple[str, int, int, float]]:
    """All spans of a text with their novelty, by start, then kind."""
    found = [(kind, a, b, novelty(text, a, b, by)) for kind, a, b in base_spans(text)]
    lowered = text.lower()
    if any(w in lowered for w in SENSITIVE_WORDS):
        taken = bytearray(len(text))  # which characters a span covers

        def take(a: int, b: int) -> None:
            taken[a:b] = b"\x01" * (b - a)

        for _, a, b, _ in found:
            take(a, b)
        for a, b, first, end in in_context(text):
            own = text[a:b]
            if not any(map(str.isdigit, own)) or not any(map(str.isalpha, own)) or taken.find(1, a, b) >= 0:
                continue
            new = novelty(text, a, b, by)
            if new >= min_novelty:
                found.append(("novel", a, b, new))
                if (a, b) != (first, end):
                    take(a, b)  # its run isn't reported again
                tail = TAIL.match(text, b)
                if tail and taken.find(1, *tail.span(1)) < 0:
                    found.append(("novel", *tail.span(1), novelty(text, *tail.span(1), by)))
                    take(*tail.span(1))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def masked(text: str, spans: list[tuple[str, int, int, float]], mark: str) -> str:
    """``text`` with the spans, joined where they overlap, replaced by ``mark``: each character is copied once."""
    out, at = [], 0
    for _, first, end, _ in spans:
        if first >= at:
            out += [text[at:first], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_novelty: float = MIN_NOVELTY,
    dictionary: bytes = DICTIONARY,
    keep: list[str] | None = None,
) -> DataFrame:
    """For each row of ``docs``: ``id_col``, the columns named in ``keep``, and spans (array of
    struct<kind, first, end, novelty>, by first, then kind; places in code points, end exclusive).

    kind is assign, access or hex (the fixed patterns) or novel. Null and empty texts have no
    spans; repeated rows stay; an empty table gives an empty one; columns not named are left out.
    """
    columns = [id_col, *(keep or [])]
    own = docs.select(*columns)
    schema = T.StructType([*own.schema.fields, T.StructField("spans", T._parse_datatype_string(SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = compressor(dictionary)
        for batch in batches:
            out = []
            for text in batch.column(len(columns)):
                text = text.as_py()
                found = spans_of(text, by, min_novelty) if text else []
                out.append([{"kind": k, "first": a, "end": b, "novelty": n} for k, a, b, n in found])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(columns))), pa.array(out, SPAN_ARROW)], names=[*columns, "spans"]
            )

    return docs.select(*columns, F.col(text_col).cast("string").alias("scanned text")).mapInArrow(run, schema)


def redacted(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]", min_novelty: float = MIN_NOVELTY, dictionary: bytes = DICTIONARY
) -> DataFrame:
    """``docs`` with every span (joined where they overlap) of ``text_col`` replaced by ``mark``.

    All rows and columns stay; a null text stays null; other types of text become strings.
    """
    # Columns get names of their own meanwhile, so that they may have any names.
    columns = docs.columns
    text_at = columns.index(text_col)
    own = docs.select(*(F.col(c).cast("string").alias(f"c{k}") if k == text_at else F.col(c).alias(f"c{k}") for k, c in enumerate(columns)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = compressor(dictionary)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(text_at)]
            clean = [masked(t, spans_of(t, by, min_novelty), mark) if t else t for t in texts]
            yield batch.set_column(text_at, batch.schema.field(text_at), pa.array(clean, batch.schema.field(text_at).type))

    return own.mapInArrow(run, own.schema).toDF(*columns)
