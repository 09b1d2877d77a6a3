"""The registered queries' values on the smallest tables, row by row, against plain versions."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from test_dedup import components, fingerprint, pairs_of
from test_texts import host_path, spans_by_brute_force

from quillframe.llm import queries, url_filter

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def result(spark, name):
    rows = queries.queries()[name](spark, SF).collect()
    return {r[0]: r for r in rows}


def held(doc_id, mod, remainder):
    return zlib.crc32(str(doc_id).encode()) % mod == remainder


def test_simhash_values(spark, texts):
    got = result(spark, "op1_simhash")
    fps = {k: fingerprint(t, 3) for k, t in texts.items()}
    assert {k: r["fingerprint"] for k, r in got.items()} == {k: f"{fp:016x}" for k, fp in fps.items()}
    links = pairs_of(sorted(fps.items()), lambda x, y: (x ^ y).bit_count() <= 2)
    assert {k: r["component_id"] for k, r in got.items()} == components(fps, links)


def test_page_values(spark):
    urls = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    for k, r in result(spark, "op3_html_text").items():
        assert r["url"] == urls[k] and r["n_chars"] == len(r["text"]) and r["text"] == " ".join(r["text"].split())
    for k, r in result(spark, "op4_url_filter").items():
        host, path = host_path(urls[k])
        fits = [(h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, key=lambda x: len(x[0]), default=(None, "block" if r["block_score"] >= url_filter.THRESHOLD else "allow"))
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, *rule)


def test_secret_values(spark, texts):
    for k, r in result(spark, "op5_secrets").items():
        base = spans_by_brute_force(texts[k] or "")
        line = ",".join(f"{kind}:{a}:{b}" for kind, a, b in base)
        n = Counter(kind for kind, *_ in base)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (n["assign"], n["access"], n["hex"])
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert ",".join(x for x in r["spans"].split(",") if not x.startswith("novel")) == line


def test_language_model_values(spark, texts):
    tokens = {k: [*(t or "").encode().lower().split(), b"\n"] for k, t in texts.items()}
    counts = Counter(w for k, ws in tokens.items() if not held(k, 10, 0) for w in ws)
    n, v = sum(counts.values()), len(counts)
    for k, r in result(spark, "op6_lm_score").items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[k])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(k, 10, 0), len(tokens[k]), sum(w in counts for w in tokens[k]), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)


def test_language_values(spark, texts):
    langs = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = result(spark, "op7_language")
    assert {k: r["held_out"] for k, r in got.items()} == {k: held(k, 4, 2) for k in texts}
    for k, r in got.items():
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] == "und") == (not any(map(str.isalpha, texts[k] or "")))
    known = [k for k in texts if held(k, 4, 2) and langs[k] is not None and got[k]["lang_pred"] != "und"]
    assert sum(got[k]["lang_pred"] == langs[k] for k in known) >= 0.95 * len(known)


def test_toxicity_values(spark, texts):
    toxic = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect()}
    got = result(spark, "op8_toxicity")
    for k, r in got.items():
        assert r["held_out"] == held(k, 5, 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    clean = [k for k, y in toxic.items() if y == 0 and k in got and held(k, 5, 0)]
    assert sum(got[k]["predicted"] for k in clean) <= 0.05 * len(clean)


def test_embedding_values(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    sound = [r for r in rows if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])]
    unit = np.array([r[1] for r in sound], float)
    unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
    near = np.triu(unit @ unit.T >= 0.93, 1) & (np.array([r[2] for r in sound])[:, None] == np.array([r[2] for r in sound])[None, :])
    links = [(sound[i][0], sound[j][0]) for i, j in zip(*np.nonzero(near), strict=True)]
    n = Counter(x for pair in links for x in pair)
    root = components([r[0] for r in rows], links)
    got = result(spark, "op9_embedding_dedup")
    assert {k: (r["n_links"], r["component_id"], r["kept"]) for k, r in got.items()} == {k: (n[k], root[k], root[k] == k) for k, *_ in rows}


def test_a_null_id_is_held_out_of_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(None, "some text that is here", "en"), (1, "another text that is there", "en")], "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name in ("op6_lm_score", "op7_language", "op8_toxicity"):
        by = {r["doc_id"]: r for r in queries.queries()[name](spark, str(tmp_path)).collect()}
        assert by[None]["held_out"] is False and len(by) == 2
