"""SimHash and embedding components against brute force."""

from __future__ import annotations

import random

import numpy as np
import xxhash

from quillframe.llm import embedding_dedup, simhash, simhash_texts
from quillframe.llm.common import connected_components


def components(ids, linked):
    """Smallest id reachable, by brute force over all pairs."""
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def fingerprint(text, k):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def pairs_of(rows, ok):
    return [(a, b) for k, (a, x) in enumerate(rows) for b, y in rows[k + 1 :] if ok(x, y)]


def test_fingerprints_and_components(spark, words):
    rng = random.Random(1)
    texts = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append("  ".join(copy).upper())
    rows = list(enumerate(texts))
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fps = {i: fingerprint(t, 3) for i, t in rows}
    assert {r["doc_id"]: r["fp"] % 2**64 for r in got} == fps
    links = pairs_of(sorted(fps.items()), lambda x, y: bin(x ^ y).count("1") <= 2)
    assert {r["doc_id"]: r["component_id"] for r in got} == components(fps, links)
    assert links


def test_crowded_nodes_lose_no_link(spark, monkeypatch):
    """Many fingerprints that share segments: the index with small nodes gives what brute force gives."""
    rng = random.Random(2)
    fps = set()
    for base in (0, 0xDEADBEEFCAFEF00D, 1 << 63):
        for _ in range(150):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    rng.shuffle(fps)
    signed = [(x - 2**64 if x >= 2**63 else x, k) for k, x in enumerate(fps)]
    reps = spark.createDataFrame(signed, "fp long, rep long")
    for size, bits in ((8, 2), (256, 2), (8, 1)):
        want = components(range(len(fps)), pairs_of(list(enumerate(fps)), lambda x, y: bin(x ^ y).count("1") <= bits))  # noqa: B023
        monkeypatch.setattr(simhash, "NODE_ROWS", size)
        roots = {r["vertex"]: r["root"] for r in connected_components(simhash.links(reps, bits)).collect()}
        assert {k: roots.get(k, k) for k in range(len(fps))} == want


def test_tree_pairs_are_exact():
    rng = np.random.default_rng(3)
    node = np.sort(rng.integers(0, 6, 400))
    fps = rng.integers(0, 2**63, 6, dtype=np.uint64)[node]
    for _ in range(3):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
    a, b = simhash._linked(fps, node, 2)
    got = set(zip(a.tolist(), b.tolist(), strict=True))
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if node[i] == node[j] and int(fps[i] ^ fps[j]).bit_count() <= 2}
    assert got == want


def test_simhash_bears_odd_rows(spark, odd_docs, no_docs, odd_rows):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == len(odd_rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fp"] == by[2]["fp"] == by[3]["fp"] == 0
    assert by[1]["component_id"] == by[2]["component_id"] == by[3]["component_id"] == 1
    assert by[6]["component_id"] == 5
    assert sum(r["doc_id"] == 5 for r in got) == 2
    assert simhash.near_duplicates(no_docs).count() == 0


def jaccard(a, b, k=5):
    def s(t):
        w = (t or "").encode().lower().split()
        return {b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    x, y = s(a), s(b)
    return 1.0 if not x and not y else len(x & y) / len(x | y)


def test_near_texts_against_all_pairs(spark, words):
    rng = random.Random(4)
    texts = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(40, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            copy = list(base)
            for _ in range(rng.randint(1, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["component_id"] for r in simhash_texts.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    links = pairs_of(rows, lambda x, y: jaccard(x, y) >= 0.8)
    assert len(links) > 20
    assert got == components(got, links)


def test_near_texts_bear_odd_rows(odd_docs, no_docs, odd_rows):
    got = simhash_texts.near_duplicates(odd_docs).collect()
    assert len(got) == len(odd_rows) - 1  # the row without an id
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert by[1] == by[2] == by[3] == 1 and by[5] == by[6] == 5 and by[4] == 4
    assert simhash_texts.near_duplicates(no_docs).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(60)]
    star = [(100, k) for k in range(101, 160)]
    edges = spark.createDataFrame([*path, *star, (None, 3), (7, 7)], "a long, b long")
    got = {r["vertex"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)}
    assert connected_components(edges.limit(0)).count() == 0


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 24))
    rows = []
    for k in range(160):
        v = centres[k % 12] + rng.normal(size=24) * (0.02 if k % 3 else 0.35)
        rows.append((k, [float(x) for x in v.astype(np.float32)], k % 2))
    rows += [(200 + k, rows[0][1], 0) for k in range(20)]
    rows += [(300, None, 0), (301, [0.0] * 24, 0), (302, [float("nan")] * 24, 0), (303, rows[0][1], None), (304, [None] * 24, 0), (305, [float("inf")] + [1.0] * 23, 0), (306, [1.0, 2.0], 0), (307, [2.0, 4.0], 0), (308, [], 0)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<float>, label int, rep string, n int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect()}

    def links(x, y):
        (v, a), (w, b) = x, y
        if a is None or a != b or not v or not w or len(v) != len(w) or None in v or None in w:
            return False
        v, w = np.array(v), np.array(w)
        with np.errstate(all="ignore"):
            return bool(v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93)

    linked = pairs_of([(r[0], (r[1], r[2])) for r in rows], links)
    n = {r[0]: 0 for r in rows}
    for a, b in linked:
        n[a] += 1
        n[b] += 1
    root = components(n, linked)
    assert got == {i: (n[i], root[i]) for i in n}
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_doubles_are_compared_as_doubles(spark):
    """Vectors of doubles that floats can't hold, or can't tell apart."""
    rows = [(1, [1e300, 0.0], 0), (2, [1e300, 1e299], 0), (3, [0.93, (1 - 0.93**2) ** 0.5 * (1 - 1e-9)], 1), (4, [0.93, (1 - 0.93**2) ** 0.5 * (1 + 1e-9)], 1), (5, [1.0, 0.0], 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (2, 3), 4: (1, 3), 5: (1, 3)}


def test_quantisation_bound_holds():
    rng = np.random.default_rng(7)
    x = embedding_dedup.unit(rng.normal(size=(200, 64)).astype(np.float32))
    q, scale, error = embedding_dedup.quantise(x)
    about = embedding_dedup._scaled_product(q, q) * scale[:, None] * scale[None, :]
    bound = error[:, None] + (1 + error[:, None]) * error[None, :]
    assert (np.abs(x @ x.T - about) <= bound + 1e-12).all()
