"""Near texts that few candidates a text would miss."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from test_dedup import components, fingerprint, jaccard, pairs_of

from quillframe.llm import simhash_texts


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r["component_id"] for r in simhash_texts.near_duplicates(df).collect()}


def test_a_hub_keeps_all_its_near_copies(spark, words):
    """400 copies, each similar to one original only, and pairs among texts that share a long passage."""
    rng = random.Random(31)
    base = [f"{rng.choice(words)}{k}" for k in range(300)]
    texts = []
    for k in range(400):
        copy = list(base)
        for at in rng.sample(range(5, 295), 6):
            copy[at] = f"new{k}x{at}"
        texts.append(" ".join(copy))
    texts.insert(211, " ".join(base))
    passage = [f"p{k}" for k in range(150)]
    for k in range(60):
        own = [f"o{k}y{j}" for j in range(80)]
        texts.append(" ".join(passage + own))
        texts.append(" ".join(passage + own[:70] + [f"q{k}z{j}" for j in range(10)]))
    rows = list(enumerate(texts))
    shingles = [set(simhash_texts._shingle_hashes(t.encode(), 5)) for t in texts]
    links = pairs_of(list(enumerate(shingles)), lambda x, y: len(x & y) >= 0.8 * len(x | y))
    near = sum(211 not in p for p in links if max(p) <= 400)
    assert sum(211 in p for p in links) == 400 and near < 4000
    assert found(spark, rows) == components(range(len(rows)), links)


def test_texts_of_one_fingerprint_are_all_compared(spark, words):
    """y and z are similar; both have the fingerprint of a text that is similar to neither, and no part fingerprint in common."""
    rng = random.Random(32)
    phrase = "one two three four five six seven " * 200

    def parts(text):
        return simhash_texts.part_fingerprints(np.unique(np.array(simhash_texts._shingle_hashes(text.encode(), 5), np.uint64)))

    rows = [(0, phrase + " ".join(f"u{k}" for k in range(90)))]
    while len(rows) < 7:
        own = [f"{rng.choice(words)}{rng.randrange(10**6)}" for _ in range(90)]
        other = list(own)
        other[30] = other[60] = "changed"
        y, z = phrase + " ".join(own), phrase + " ".join(other)
        if not any(a == b for a, b in zip(parts(y), parts(z), strict=True)):
            rows += [(len(rows), y), (len(rows) + 1, z)]
    assert len({fingerprint(t, 5) for _, t in rows}) == 1
    links = pairs_of(rows, lambda x, y: jaccard(x, y) >= 0.8)
    assert links == [(1, 2), (3, 4), (5, 6)]
    assert found(spark, rows) == components(range(7), links)


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_components_do_not_depend_on_partitions(spark, words, monkeypatch, partitions):
    """Groups of copies, hubs and passages, with tiles of few rows, on any number of partitions."""
    monkeypatch.setattr(simhash_texts, "MEET_ROWS", 40)
    monkeypatch.setattr(simhash_texts, "BLOCK_ROWS", 3)
    rng = random.Random(34)
    texts = []
    for _ in range(4):
        base = [rng.choice(words) for _ in range(rng.randint(60, 120))]
        for _ in range(60):
            copy = list(base)
            for at in rng.sample(range(len(base)), rng.randint(0, 4)):
                copy[at] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    rows = list(enumerate(texts))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == components(range(len(rows)), pairs_of(rows, lambda x, y: jaccard(x, y) >= 0.8))


def test_live_rows_are_those_of_mixed_shingles(spark):
    """A shingle in hundreds of texts, others in few, in Arrow batches of three rows: whole groups, with the least of all pairs' needs or less."""
    rng = random.Random(36)
    rows = [(h, rng.randint(1, 60), rep, rng.randint(1, 3) if h % 3 else h) for h in range(30) for rep in rng.sample(range(1000), 400 if h == 4 else rng.randint(1, 6))]
    df = spark.createDataFrame(rows, "h long, n long, rep long, root long").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {tuple(r)[:4]: r["need"] for r in simhash_texts.live_rows(df, 0.8).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    roots = {h: {r[3] for r in rows if r[0] == h} for h in range(30)}
    assert Counter(got) == Counter({r: got.get(r) for r in rows if len(roots[r[0]]) > 1})
    for h, n, rep, root in got:
        sizes = [r[1] for r in rows if r[0] == h and min(n, r[1]) >= 0.8 * max(n, r[1])]
        assert 1 <= got[h, n, rep, root] <= min(int(simhash_texts._prefix_need(np.array([n]), np.array([m]), 0.8)[0]) for m in sizes)


def test_cross_pairs_are_all_pairs(monkeypatch):
    monkeypatch.setattr(simhash_texts, "BLOCK_ROWS", 4)
    monkeypatch.setattr(simhash_texts, "SLICE_PAIRS", 50)
    rng = np.random.default_rng(35)
    for _ in range(30):
        n_rows = int(rng.integers(1, 90))
        rows = sorted(zip(rng.integers(0, 4, n_rows).tolist(), rng.integers(1, 30, n_rows).tolist(), rng.integers(0, 5, n_rows).tolist(), strict=True))
        group, n, root = (np.array(x) for x in zip(*rows, strict=True))
        group = np.unique(group, return_inverse=True)[1]
        got = Counter(tuple(sorted(p)) for i, j in simhash_texts.cross_pairs(group, n, root, 0.8) for p in zip(i.tolist(), j.tolist(), strict=True))
        want = {(i, j) for i in range(n_rows) for j in range(i + 1, n_rows) if group[i] == group[j] and root[i] != root[j] and n[i] >= 0.8 * n[j] - 1e-9}
        assert set(got) == want and set(got.values()) <= {1}
