"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of 1 to ``MAX_N`` code points of the lower-cased text; a feature's
value is its share of the text's n-grams times its inverse document frequency. Weights are fitted
by follow-the-regularised-leader with elastic-net penalties (per-coordinate steps; L1 leaves most
weights at zero), on about ``PER_LANGUAGE`` labelled texts of each language, chosen by a hash. A fifth of these is kept back to choose the temperature that the scores are
divided by. Executors count the sample's n-grams; only sparse counts reach the driver. Prediction
is one Arrow pass over whole texts with the weights in the closure (``BUCKETS`` rows at most).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_N = 3
BUCKETS = 1 << 16
#: The bound of the training sample, in texts of each language.
PER_LANGUAGE = 600
#: Labels that may be learned; a table with more isn't one of languages, and is refused.
MAX_LANGUAGES = 1000
EPOCHS = 4
#: FTRL: step size, its smoothing, and the penalties on absolute and squared weights.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.002, 0.001
#: Code points and rows handled at once.
SLICE = 1 << 18
SLICE_ROWS = 512
UNDETERMINED = "und"


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts, each between spaces, and where each one's n-grams start and end."""
    parts = [np.frombuffer(f" {t.lower()}  ".encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    size = np.array([len(p) for p in parts])
    ends = np.cumsum(size)
    return np.concatenate(parts), ends - size, ends - (MAX_N - 1)


def _grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """The bucket of the n-gram that starts at each place, for n = 1 to ``MAX_N``."""
    h = np.full(len(codes), 0x9E3779B9, np.uint32)
    for n in range(MAX_N):
        shifted = codes if n == 0 else np.r_[codes[n:], np.full(n, 32, np.uint32)]
        h = (h ^ shifted) * np.uint32(0x85EBCA6B)
        h = h ^ (h >> np.uint32(15))
        yield (h * np.uint32(0xC2B2AE35)) >> np.uint32(16)


def _slices(texts: list[str]) -> Iterator[list[str]]:
    part: list[str] = []
    size = 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= SLICE:
            yield part
            part, size = [], 0
    if part:
        yield part


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    codes, first, end = _codes([text])
    buckets = np.concatenate([g[first[0] : end[0]] for g in _grams(codes)])
    return np.unique(buckets, return_counts=True)


class Model:
    """Languages, idf-weighted weights (buckets x languages), bias and temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0):
        self.languages, self.weights, self.bias, self.temperature = languages, weights, bias, temperature

    def logits(self, texts: list[str]) -> np.ndarray:
        """A row of logits for each text."""
        out = [np.zeros((0, len(self.languages)))]
        for part in _slices(texts):
            codes, first, end = _codes(part)
            bounds = np.stack([first, end], 1).reshape(-1)
            total = np.zeros((len(part), len(self.languages)))
            for g in _grams(codes):
                # Sums in double precision of a text's own places: no text depends on its neighbours.
                total += np.add.reduceat(self.weights[g], bounds, axis=0, dtype=np.float64)[::2]
            out.append(total / (MAX_N * (end - first))[:, None] + self.bias)
        return np.concatenate(out)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The most likely language of each text and its calibrated probability."""
        known = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.languages else []
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if known:
            p = _softmax(self.logits([texts[k] for k in known]) / self.temperature)
            for k, best, row in zip(known, p.argmax(1), p, strict=True):
                names[k], scores[k] = self.languages[best], float(row[best])
        return names, scores


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after ``EPOCHS`` passes over (features, values, language); the last feature is the bias."""
    z = np.zeros((BUCKETS + 1, n_languages))
    n = np.zeros((BUCKETS + 1, n_languages))

    def weights(at: np.ndarray) -> np.ndarray:
        own, sums = z[at], n[at]
        return np.where(np.abs(own) <= L1, 0.0, -(own - np.sign(own) * L1) / ((BETA * 1e-2 + np.sqrt(sums)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, x, y in rows:
            w = weights(at)
            p = _softmax(x @ w)
            p[y] -= 1.0
            g = x[:, None] * p[None, :]
            sums = n[at]
            z[at] += g - (np.sqrt(sums + g * g) - np.sqrt(sums)) / ALPHA * w
            n[at] = sums + g * g
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1], w[-1]


def sample_counts(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> list:
    """(lang, order, features, counts) of about ``per_language`` texts a language, chosen by a hash of id and
    text, so that rows that share an id are chosen one by one and equal rows count once."""
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("order"), F.col(text_col).cast("string").alias("t"))
    rows = rows.where("lang is not null and t is not null")
    sizes = sorted(tuple(r) for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect())
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return []
    share = F.create_map(*(F.lit(x) for lang, n in sizes for x in (lang, math.ceil(1_000_000 * min(1.0, per_language / n)))))
    picked = rows.where(F.pmod("order", F.lit(1_000_000)) < share[F.col("lang")]).select("lang", "order", "t").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [_counts(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([c[0].astype(np.int32).tolist() for c in counted], pa.list_(pa.int32())),
                    pa.array([c[1].astype(np.int32).tolist() for c in counted], pa.list_(pa.int32())),
                ],
                names=["lang", "order", "features", "counts"],
            )

    return picked.mapInArrow(run, "lang string, order long, features array<int>, counts array<int>").collect()


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE
) -> Model:
    """The model learned from rows with a label and a text; without such rows it knows no language."""
    sample = sorted(sample_counts(labelled, id_col, text_col, lang_col, per_language), key=lambda r: (r["order"], r["lang"]))
    languages = sorted({r["lang"] for r in sample})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    seen = np.zeros(BUCKETS)
    rows = []
    for r in sample:
        at = np.array(r["features"])
        seen[at] += 1
        rows.append((at, np.array(r["counts"], float), languages.index(r["lang"])))
    idf = np.log((1 + len(rows)) / (1 + seen)) + 1

    def valued(at: np.ndarray, counts: np.ndarray, y: int) -> tuple[np.ndarray, np.ndarray, int]:
        return np.r_[at, BUCKETS], np.r_[counts / counts.sum() * idf[at], 0.05], y

    valued_rows = [valued(*r) for r in rows]
    held = valued_rows[::5] if len(valued_rows) >= 20 else valued_rows
    used = [r for k, r in enumerate(valued_rows) if k % 5] if len(valued_rows) >= 20 else valued_rows
    w, bias = _ftrl(used, len(languages))
    model = Model(languages, (w * idf[:, None]).astype(np.float32), bias * 0.05)
    logits = np.array([x[:-1] @ w[at[:-1]] + bias * x[-1] for at, x, _ in held])
    right = np.array([y for *_, y in held])
    steps = np.exp(np.linspace(math.log(0.25), math.log(20), 121))
    loss = [-np.log(_softmax(logits / t)[np.arange(len(right)), right] + 1e-12).mean() for t in steps]
    model.temperature = float(steps[int(np.argmin(loss))])
    return model


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """For each row: ``id_col``, the columns named in ``keep``, lang_pred and lang_score (0 to 1).

    A text that is null or has no letter (Unicode L; numbers and signs are none) gets ``und`` and 0, as does every text where the model
    knows no language. Ties go to the language first by name. Repeated rows stay; other columns
    are left out; an empty table gives an empty one.
    """
    columns = [id_col, *(keep or [])]
    schema = T.StructType(
        [*docs.select(*columns).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                names, scores = model.predict(part.column(len(columns)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(len(columns))), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=schema.names,
                )

    return docs.select(*columns, F.col(text_col).cast("string").alias("judged text")).mapInArrow(run, schema)

