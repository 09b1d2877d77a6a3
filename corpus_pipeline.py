"""The corpus pipeline: documents that the language model rejects go, one text of each group of
near duplicates stays, contaminated texts go, secrets are cut out, and what is left becomes pieces.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns the
columns of ``docs``; the last returns pieces. Rows with null ids or texts, empty and very long
texts, repeated rows, empty tables and further columns are all allowed; see each stage. Stages with Python workers make the
session's Arrow batches small (``small_batches``), so that one stage's workers leave room for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.llm import decontaminate, language, secret_scan, sentence_pieces, simhash_texts
from quillframe.llm.common import is_held_out, small_batches, table, written

#: Calibrated probability below which a text counts as of no known language.
LEAST_LANGUAGE_SCORE = 0.35
SHINGLE, SIMILARITY = 5, 0.8
#: Row numbers that are broadcast at most, 8 bytes each.
BROADCAST_ROWS = 2_000_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts of no known language: null texts, texts without a letter, and those whose most
    likely language has a probability below ``LEAST_LANGUAGE_SCORE``. Where no row has a label,
    nothing can be learned and only texts without a letter go."""
    small_batches(spark)
    text = F.col("text").cast("string")
    docs_with_letters = docs.where(text.rlike(r"\p{L}"))
    model = language.fit(docs.where(~is_held_out(F.col("doc_id"), 4, 2)))
    if not model.languages:
        return docs_with_letters
    # The judged columns get names of their own, so that columns of these names may exist.
    own = [F.col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)]
    judged = language.identify(
        docs.select(*own), model, f"c{docs.columns.index('doc_id')}", f"c{docs.columns.index('text')}",
        keep=[f"c{k}" for k, c in enumerate(docs.columns) if c != "doc_id"],
    )
    kept = judged.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)))


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs``, written with a number for every row in ``row`` and its columns under names of their own; those names."""
    at = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return written(docs.select(*(F.col(c).alias(a) for c, a in at.items()), F.monotonically_increasing_id().alias("row"))), at


def _without(numbered: DataFrame, gone: DataFrame, at: dict[str, str]) -> DataFrame:
    """``numbered`` but for the rows in ``gone``, under the columns' own names. Up to ``BROADCAST_ROWS`` row
    numbers are broadcast, so that no text is shuffled; more go through a join."""
    gone = written(gone.select("row"))
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return numbered.join(gone, "row", "left_anti").select(*(F.col(a).alias(c) for c, a in at.items()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates (five-word shingles, similarity 0.8): the one with
    the smallest doc_id, of several the one whose text has the least hash, of equal ones any. Rows are compared
    by their texts alone, so different texts under one id (or none) stay, and repeated rows become
    one; a row without an id stays only if no row with one is in its group."""
    small_batches(spark)
    numbered, at = _numbered(docs)
    found = written(simhash_texts.near_duplicates(numbered, "row", at["text"], shingle=SHINGLE, similarity=SIMILARITY))
    # Only groups of several rows need a choice; texts go no further than their digests.
    several = found.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    grouped = written(found.join(several, "component_id").select("row", "component_id"))
    digest = F.xxhash64(F.col(at["text"]).cast("string"))
    keys = written(numbered.select("row", F.col(at["doc_id"]).isNull().alias("nameless"), F.col(at["doc_id"]).alias("id"), digest.alias("digest")))
    kept = keys.join(grouped, "row").groupBy("component_id").agg(F.min_by("row", F.struct("nameless", "id", "digest", "row")).alias("row"))
    return _without(numbered, grouped.join(kept, ["component_id", "row"], "left_anti"), at)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that count as contaminated with the benchmark: a twentieth of their words or
    more lie in 13-word windows of its items."""
    numbered, at = _numbered(docs)
    found = decontaminate.contamination(numbered, table(spark, sf_dir, "benchmark"), "row", at["text"])
    return _without(numbered, found.where("contaminated"), at)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts ``[secret]`` in place of every secret, and the new length in n_chars; all rows stay."""
    small_batches(spark)
    clean = secret_scan.redacted(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return clean.select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every text: doc_id, ids, n_tokens, n_byte_tokens, ids_sha256 and round_trip."""
    small_batches(spark)
    return sentence_pieces.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("pieces", pieces),
]

#: SQL can't express the learned model, the components or the automaton; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
