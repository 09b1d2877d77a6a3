"""The pipeline on planted cases and odd rows, and the registered queries on the smallest tables."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

import corpus_pipeline
from quillframe.llm import queries
from quillframe.llm.common import BATCH_BYTES, written

SF = "/root/testdata/sf0.001"


@pytest.fixture
def bench_dir(spark, tmp_path):
    text = " ".join(f"bench{k}" for k in range(30))
    spark.createDataFrame([(1, text), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), text


def planted(words, text):
    rng = random.Random(21)
    docs = [(k, " ".join(rng.choice(words) for _ in range(90)), "en", "a", None) for k in range(40)]
    near = docs[0][1].split(" ")
    near[50] = "changed"
    docs += [
        (40, docs[0][1].upper(), "en", "a", None),  # a copy
        (41, " ".join(near), "en", "a", None),  # a near copy
        (42, docs[1][1] + " " + text[:200], "en", "a", None),  # contaminated
        (43, " ".join(rng.choice(words) for _ in range(60)) + " password = hunter2secret end", "en", "a", None),
        (44, "12345 ---", "en", "a", None),
        (45, None, None, None, None),
        (None, " ".join(rng.choice(words) for _ in range(50)), None, None, None),
        (46, " ".join(rng.choice(words) for _ in range(50)), "en", "a", 1),
    ]
    return docs + [docs[-1]]


def test_stages_keep_clean_documents_only(spark, words, bench_dir):
    sf_dir, text = bench_dir
    rows = planted(words, text)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, c0 string")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf_dir))
        if name != "pieces":
            assert out.columns == docs.columns
        kept[name] = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in out.collect())
        docs = out
        if name == "secret_scans":
            by = {r["doc_id"]: r for r in out.collect()}
            assert "hunter2secret" not in by[43]["text"] and "[secret]" in by[43]["text"] and by[43]["n_chars"] == len(by[43]["text"])
    clean = [-1, *range(40), 43, 46]
    assert kept["language_id"] == sorted([-1, *range(44), 46, 46])
    assert kept["near_duplicates"] == sorted([*clean, 42])
    assert kept["decontamination"] == kept["secret_scans"] == kept["pieces"] == clean
    assert all(r["round_trip"] for r in docs.collect())


def test_stages_bear_odd_rows_and_no_rows(spark, odd_docs, no_docs, bench_dir):
    sf_dir, _ = bench_dir
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, docs, sf_dir))
            assert name == "pieces" or out.columns == docs.columns
            docs = out
        assert docs.count() == (4 if docs.where("doc_id = 4").count() else 0)


def test_rows_that_share_an_id_are_compared_by_text(spark, words, bench_dir):
    """Different texts of one id stay, equal ones become one, and the least id of a group stays."""
    rng = random.Random(22)
    a, b, c = (" ".join(rng.choice(words) for _ in range(80)) for _ in range(3))
    rows = [(1, a), (1, b), (1, a), (5, c), (3, c + " more"), (None, c), (None, b), (7, b.upper())]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    out = corpus_pipeline.near_duplicates(spark, docs.repartition(4), bench_dir[0]).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == sorted([(1, a), (1, b), (3, c + " more")])


BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def batch_setting(spark):
    """Puts the session's bound on Arrow batches back as it was, before a test and after it."""
    spark.conf.unset(BATCH_SETTING)
    yield
    spark.conf.unset(BATCH_SETTING)


@pytest.mark.parametrize("name", ["language_id", "near_duplicates", "secret_scans", "pieces"])
def test_stages_send_texts_to_python_in_small_batches(spark, odd_docs, bench_dir, batch_setting, name):
    """5,000 texts of 2,000 bytes went as one batch of 10 MB; a batch passes the bound by one row at most."""

    def batch_sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    text = spark.range(0, 5000, 1, 1).selectExpr("repeat('ab cd ef ', 222) t")
    sent = text.unionAll(spark.range(0, 1, 1, 1).selectExpr(f"repeat('a', {2 * BATCH_BYTES}) t"))
    written(dict(corpus_pipeline.STAGES)[name](spark, odd_docs, bench_dir[0]))
    found = sent.mapInArrow(batch_sizes, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 5001
    sizes = sorted(r["size"] for r in found)
    assert sizes[-1] < 1.1 * 3 * BATCH_BYTES and sizes[-2] < 1.1 * BATCH_BYTES


def test_a_smaller_bound_on_batches_stays(spark, odd_docs, bench_dir, batch_setting):
    for given, kept in (("64k", "64k"), ("1g", str(BATCH_BYTES))):
        spark.conf.set(BATCH_SETTING, given)
        corpus_pipeline.secret_scans(spark, odd_docs, bench_dir[0])
        assert spark.conf.get(BATCH_SETTING) == kept


def test_no_stages_shape():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secret_scans", "pieces"]


CONTRACTS = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_sentence_pieces": ["doc_id", "ids", "n_tokens", "n_byte_tokens", "ids_sha256", "round_trip"],
    "op3_html_text": ["page_id", "url", "text", "n_chars"],
    "op4_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op5_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op6_lm_score": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op7_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op10_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op13_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_query_keeps_its_contract(spark, name):
    found = queries.queries()[name](spark, SF)
    assert found.columns[: len(CONTRACTS[name])] == CONTRACTS[name]
    rows = found.collect()
    table = {"page_id": "pages", "vec_id": "embeddings"}.get(found.columns[0], "documents")
    ids = [r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(found.columns[0]).collect()]
    assert sorted(r[0] for r in rows) == sorted(ids)


def test_decontamination_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = queries.queries()["op10_decontaminate"](spark, SF)
    relation = con.execute(queries.oracle_sql()["op10_decontaminate"])
    columns = [d[0] for d in relation.description]
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(relation.fetchall())
