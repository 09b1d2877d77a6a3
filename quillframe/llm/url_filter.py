"""URL filter: rules first, else logistic regression on hashed character n-grams.

Host and path are cut out of the URL and rules are applied with built-in functions. The rest is
judged by a logistic regression on n-grams of 3 to 5 characters of host and path (hashed apart),
trained by gradient steps on a small table of labelled URLs (``labelled_urls``), where the query is planned. Scoring
is one Arrow pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 1 << 15
SIZES = (3, 4, 5)
#: The bound of the training table, in rows.
MAX_LABELLED = 20_000
#: Score from which a URL is blocked, chosen on held-out labelled URLs.
THRESHOLD = 0.5
#: Rows and characters scored at once.
SLICE_ROWS, SLICE_CHARS = 4096, 1 << 20
#: (verdict, host, path): a rule fits its host and the host's subdomains.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    mark = F.locate("://", url)
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits (of equally long ones the first by text), else null."""
    found = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if found is None else found


def _buckets(texts: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, bucket) of all n-grams of the texts, each text between ``^`` and ``$``; digits are all alike."""
    parts = [np.frombuffer(f"^{t}$".encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    size = np.array([len(p) for p in parts])
    codes = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    codes = np.where((codes >= 48) & (codes <= 57), np.uint32(48), codes)
    owner = np.repeat(np.arange(len(parts)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(codes))  # characters up to the end, this one included
    h = np.full(len(codes), seed, np.uint32)
    owners, found = [], []
    for n in range(max(SIZES)):
        h = (h ^ (codes if n == 0 else np.r_[codes[n:], np.zeros(n, np.uint32)][: len(codes)])) * np.uint32(0x01000193)
        h = h ^ (h >> np.uint32(13))
        if n + 1 in SIZES:
            ok = left > n
            owners.append(owner[ok])
            found.append((h[ok] * np.uint32(0x9E3779B1)) >> np.uint32(17))
    return np.concatenate(owners), np.concatenate(found)


class Model:
    """A weight per bucket and a bias; a URL's n-grams weigh as much in all as one."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """The probability that each URL is to be blocked."""
        return 1 / (1 + np.exp(-(_means(hosts, paths, self.weights) + self.bias)))


def _features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, x = _buckets(hosts, 0x811C9DC5)
    b, y = _buckets(paths, 0x1000193)
    owner, bucket = np.concatenate([a, b]), np.concatenate([x, y])
    return owner, bucket, np.maximum(1, np.bincount(owner, minlength=len(hosts)))


def _means(hosts: list[str], paths: list[str], weights: np.ndarray) -> np.ndarray:
    owner, bucket, n = _features(hosts, paths)
    return np.bincount(owner, weights[bucket], len(hosts)) / np.sqrt(n)


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label", steps: int = 250, rate: float = 0.7, ridge: float = 3e-6) -> Model:
    """The model learned from rows with a URL and a label of 0 or 1; without any it scores 0.

    The table may have ``MAX_LABELLED`` rows at most.
    """
    host, path = host_and_path(F.col(url_col))
    rows = (
        labelled.where(F.col(url_col).isNotNull() & F.col(label_col).isin(0, 1))
        .select(host.alias("host"), path.alias("path"), F.col(label_col).cast("int").alias("y"))
        .limit(MAX_LABELLED + 1)
        .collect()
    )
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled URLs")
    if not rows:
        return Model(np.zeros(BUCKETS), -50.0)
    rows = sorted(tuple(r) for r in rows)
    return _fitted(rows, steps, rate, ridge)


def _fitted(rows: list[tuple[str, str, int]], steps: int, rate: float, ridge: float) -> Model:
    """The model of sorted (host, path, label): steps of each weight shrink with its own past gradients."""
    y = np.array([r[2] for r in rows], float)
    owner, bucket, n = _features([r[0] for r in rows], [r[1] for r in rows])
    value = 1 / np.sqrt(n[owner])
    w, bias = np.zeros(BUCKETS), 0.0
    past_w, past_b = np.full(BUCKETS, 1e-12), 1e-12
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(np.bincount(owner, w[bucket] * value, len(y)) + bias)))
        miss = (y - p) / len(y)
        gw, gb = np.bincount(bucket, miss[owner] * value, BUCKETS) - ridge * w, miss.sum()
        past_w += gw * gw
        past_b += gb * gb
        w += rate * gw / np.sqrt(past_w)
        bias += rate * gb / np.sqrt(past_b)
    return Model(w, float(bias))


def judge(
    urls: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", rules: tuple = RULES, threshold: float = THRESHOLD
) -> DataFrame:
    """For each row: ``id_col``, host, path, rule (null if none fits), block_score and verdict.

    verdict is the rule's, else block if block_score (of the model) is ``threshold`` or more. A
    null URL, and one without ``://``, has an empty host and path, which are judged like others.
    Repeated rows stay; other columns are left out; an empty table gives an empty one.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    base = urls.select(F.col(id_col), host.alias("host"), path.alias("path"))
    schema = T.StructType([*base.schema.fields, T.StructField("block_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out: list[np.ndarray] = [np.zeros(0)]
            start = chars = 0
            for k, (h, p) in enumerate(zip(hosts, paths, strict=True)):
                chars += len(h) + len(p)
                if chars >= SLICE_CHARS or k + 1 - start >= SLICE_ROWS or k + 1 == len(hosts):
                    out.append(model.score(hosts[start : k + 1], paths[start : k + 1]))
                    start, chars = k + 1, 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out), pa.float64())], names=schema.names)

    scored = base.mapInArrow(run, schema).withColumn("found", matched_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("block_score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        id_col, "host", "path", F.col("found.rule").alias("rule"), "block_score", F.coalesce("found.verdict", own).alias("verdict")
    )
