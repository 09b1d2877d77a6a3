"""Spelling variants, collocations and licence notices against plain versions, and on odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillframe.llm import collocations, license_scan, queries, spelling
from quillframe.llm.decontaminate import words_of

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_collocations", "op13_license_scan"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    relation = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in relation.description]
    found = queries.queries()[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(repr, ([r[c] for c in columns] for r in found.collect()))) == sorted(map(repr, map(list, relation.fetchall())))


# Spelling variants


def one_edit_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_by_brute_force(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: sorted((v for v in n if one_edit_apart(w, v)), key=lambda v: (-n[v], v)) for w in n}
    form = {w: v[0] if v and n[v[0]] >= 5 * n[w] else None for w, v in near.items()}
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def corrupted(rng, word):
    at = rng.randrange(len(word))
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abcé") + word[at:], word[:at] + rng.choice("abcü") + word[at + 1 :]])


def test_variants_against_brute_force(spark, monkeypatch):
    """Chains of forms, words of equal letters, and cells so small that words meet across many of them."""
    monkeypatch.setattr(spelling, "CELL_WORDS", 12)
    rng = random.Random(41)
    base = ["".join(rng.choice("abcdeéÀß") for _ in range(rng.randint(6, 12))) for _ in range(60)]
    base += ["".join(rng.sample("aabbcc", 6)) for _ in range(30)]
    bag = []
    for word in base:
        often = rng.choice([5, 40, 400])
        bag += [word] * often
        for _ in range(3):
            other = corrupted(rng, word)
            bag += [other] * rng.choice([5, 6, 9])
            bag += [corrupted(rng, other)] * 5
    bag += ["chained"] * 6 + ["chainid"] * 40 + ["chaixid"] * 300
    rng.shuffle(bag)
    docs = [(k, rng.choice(["{}", "{}!", "<{}>"]).format(" ".join(bag[at : at + 50]).upper() if k % 7 == 0 else "-".join(bag[at : at + 50]))) for k, at in enumerate(range(0, len(bag), 50))]
    docs += [docs[0], (None, docs[1][1]), (3, None), (4, "")]
    got = {tuple(r) for r in spelling.variants(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    want = variants_by_brute_force(docs)
    assert got == want
    assert any(r[2] not in (r[0], r[1]) for r in want) and any(r[4] > 3 for r in want)


def test_near_pairs_are_all_pairs():
    rng = random.Random(42)
    for length in (6, 7, 30):
        words = {"".join(rng.choice("abÿ") for _ in range(length)) for _ in range(150)}
        words |= {corrupted(rng, w) for w in list(words)}
        points = sorted(w for w in words if len(w) == length)
        for size in (length, length - 1):
            own = sorted(w for w in words if len(w) == size)
            got = Counter((own[a], points[b]) for i, j in spelling.near_pairs(points, own) for a, b in zip(i.tolist(), j.tolist(), strict=True))
            assert set(got) == {(a, b) for a in own for b in points if one_edit_apart(a, b)} and set(got.values()) <= {1}


def test_cells_reach_every_near_word(monkeypatch):
    """A word goes to one tile as a point, and to the tiles of all near words as a query, sampled or not."""
    monkeypatch.setattr(spelling, "CELL_WORDS", 9)
    rng = random.Random(43)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(6, 8))) for _ in range(300)})
    cells = spelling.Cells(words[::3], 3)
    held = {role: defaultdict(set) for role in (spelling.POINT, spelling.SAME, spelling.SHORTER)}
    for length in (6, 7, 8):
        own = [w for w in words if len(w) == length]
        for rows, of, cell, tile, role in cells.routed(own):
            for r, c, t in zip(rows.tolist(), cell.tolist(), tile.tolist(), strict=True):
                held[role][own[r]].add((of, c, t))
    assert all(len(held[spelling.POINT][w]) == 1 for w in words)
    for a in words:
        for b in words:
            if one_edit_apart(a, b) and len(a) <= len(b):
                assert held[spelling.POINT][b] <= held[spelling.SAME if len(a) == len(b) else spelling.SHORTER][a]


def test_variants_of_odd_rows(odd_docs, no_docs):
    assert spelling.variants(no_docs).collect() == []
    words = {r["word"]: r["n"] for r in spelling.variants(odd_docs).collect()}
    assert words["repeats"] >= 3900 and words["itself"] >= 3900 and set(words) == {"repeats", "itself"}


# Collocations


def counts_by_brute_force(docs):
    f = defaultdict(Counter)
    for lang, text in docs:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]", piece) if x]
            for k in range(1, 5):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f


def collocations_by_brute_force(docs, least, top):
    out = []
    for lang, f in counts_by_brute_force(docs).items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if any(b >= least and len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in f.items()):
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), a, left, right))
        n = sum(k for p, k in f.items() if len(p) == 1)
        out += [(lang, rank, p.decode(), a, left, right, n, -s) for rank, (s, _, p, a, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def phrase_docs(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "\xa0x", "漢", "a\x1cb", "new", "york", "city"]
    docs = []
    for _ in range(n):
        out = []
        for _ in range(rng.randint(0, 40)):
            out.append(rng.choice([rng.choice(words), "new york", "new york city hall", "of the"]))
            out.append(rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "!? "]))
        docs.append((rng.choice(["en", "en", "fr", None]), "".join(out)))
    return docs


@pytest.mark.parametrize(("least", "top"), [(5, 2000), (12, 7)])
def test_collocations_against_brute_force(spark, least, top):
    docs = phrase_docs(44, 150) + [("en", None), ("fr", ""), ("xx", "..."), (None, "new york " * 40)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "lang string, text string, word string").repartition(5)
    got = collocations.collocations(df, least=least, top=top).collect()
    assert sorted(map(tuple, got)) == collocations_by_brute_force(docs, least, top)


def test_stripes_do_not_depend_on_slices_or_merging(monkeypatch):
    """Texts cut into small parts and slices, stripes merged a few entries at a time: the same counts."""
    monkeypatch.setattr(collocations, "SLICE_TOKENS", 11)
    monkeypatch.setattr(collocations, "PART_BYTES", 9)
    monkeypatch.setattr(collocations, "HELD", 3)
    docs = [(lang or "und", text) for lang, text in phrase_docs(45, 40)]
    every = np.full(1024, -1, np.int64).view(np.uint64)
    got = defaultdict(Counter)
    names = {}
    for bits in (None, every):
        own, groups = collocations.Stripes(3, 8, bits), {}
        batches = [b for lang, text in docs for b in own.add(lang, text.encode())] + list(own.flush())
        for b in batches:
            ends, flat = [b.column(k).offsets.to_numpy() for k in range(3, 8)], [b.column(k).values.to_numpy(zero_copy_only=False) for k in range(3, 8)]
            for k, key in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)), strict=True)):
                groups.setdefault(key, collocations._Merged(key[2])).add(*(x[e[k] : e[k + 1]] for x, e in zip(flat, ends, strict=True)))
        for (lang, _, size), group in groups.items():
            for r in group.result(lang, 1).to_pylist():
                if r["size"] == 1:
                    names[r["phrase"][0]] = r["word"].decode()
                if r["size"] > 0:
                    assert r["size"] == size + 1
                    got[lang][tuple(r["phrase"])] += r["n"]
    want = counts_by_brute_force(docs)
    assert {lang: {tuple(names[c] for c in p): n for p, n in f.items()} for lang, f in got.items()} == {lang: dict(f) for lang, f in want.items()}


def test_words_of_one_hash_are_told_apart():
    merged = collocations._Merged(0)
    one = np.array([7], np.int64)
    for word in (b"a", b"b"):
        merged.add(np.zeros(0, np.int64), np.ones(1, np.int32), one, one, np.array([word], object))
    assert -1 in merged.result("en", 1).column("size").to_pylist()


def test_collocations_of_odd_rows(odd_docs, no_docs):
    assert collocations.collocations(no_docs).collect() == []
    got = {r["phrase"]: (r["lang"], r["a"], r["l"], r["r"]) for r in collocations.collocations(odd_docs).collect()}
    assert got["a long text repeats"] == ("en", 4000, 4000, 4000) and "long text" not in got


# Licence notices


def scanned(df):
    return {r["doc_id"]: r for r in license_scan.scan(df).collect()}


def wrapped(notice, width, mark):
    words = notice.split()
    return "\n".join(mark + " ".join(words[at : at + width]) for at in range(0, len(words), width))


def test_every_notice_is_found(spark, words):
    """Each notice, wrapped as a comment among other words, with a word changed; its label and no other licence's."""
    rng = random.Random(46)
    rows, want = [], {}
    for k, (label, notice) in enumerate(license_scan.NOTICES):
        own = notice.split()
        own[len(own) // 2] = "other"
        text = " ".join(rng.choices(words, k=rng.randint(0, 200))) + "\n" + wrapped(" ".join(own), 7, " * # ") + "\n" + " ".join(rng.choices(words, k=90))
        rows.append((k, text.upper() if k % 2 else text))
        want[k] = label
    got = scanned(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    for k, label in want.items():
        assert label in got[k]["found"] and 0.8 <= got[k]["score"] <= 1, k
        assert set(got[k]["found"]) <= {label, "cc-by"}, k


def test_half_a_notice_is_none(spark, words):
    rng = random.Random(47)
    rows = []
    for k, (_, notice) in enumerate(license_scan.NOTICES):
        own = notice.split()
        rows.append((k, " ".join(rng.choices(words, k=50) + own[: len(own) // 2] + rng.choices(words, k=50))))
        rows.append((100 + k, " ".join(rng.choices(words, k=4000))))
    assert all(not r["found"] for r in scanned(spark.createDataFrame(rows, "doc_id long, text string")).values())


def test_blocks_against_brute_force(spark):
    """Texts of the notices' own words, so that prefixes, lengths and positions all decide."""
    rng = random.Random(48)
    own = license_scan.templates()
    rows = []
    for k in range(60):
        out = []
        for _ in range(rng.randint(0, 6)):
            w = re.findall("[a-z0-9]+", rng.choice(license_scan.NOTICES)[1].lower())
            out += [x for x in w if rng.random() < rng.choice([0.6, 0.8, 0.95])] + rng.choices(w, k=rng.randint(0, 20))
        rows.append((k, " ".join(out)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts, order = license_scan.scanned(df, own, "doc_id", "text")
    ids = {r["row"]: r["id"] for r in texts.collect()}
    got = Counter((ids[r["row"]], r["length"], r["block"], r["template"], r["overlap"]) for r in license_scan.met(texts.select("row", F.inline("blocks")), own, order).collect())
    want = set()
    for k, text in rows:
        w = text.split()
        for t in own:
            for b in range(0, len(w), t.length // 2):
                n = len({*w[b : b + t.length // 2 * 3]} & {*t.words})
                if n >= t.need:
                    want.add((k, t.length, b // (t.length // 2), t.number, n))
    assert set(got) == want and set(got.values()) <= {1} and len(want) > 100


def test_phrases_and_odd_rows(spark, odd_docs, no_docs):
    rows = [(1, "Under the MIT License. Not the MIT-license: mit licence"), (2, "CC BY-NC 4.0, GNU General PUBLIC License"), (3, None), (4, "mit"), (4, "mit"), (5, "license mit\nlicense")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_words"], sorted(r["starts"]), sorted(r["base"]), r["score"]) for r in got) == [
        (1, 10, [2, 6], ["mit"], 1.0), (2, 9, [0, 5], ["cc-by", "gpl"], 1.0), (3, 0, [], [], 0.0), (4, 1, [], [], 0.0), (4, 1, [], [], 0.0), (5, 3, [1], ["mit"], 1.0)
    ]
    assert license_scan.scan(no_docs).collect() == []
    odd = license_scan.scan(odd_docs).collect()
    want = sorted((repr(r["doc_id"]), r["n"]) for r in odd_docs.select("doc_id", F.size(words_of(F.col("text"))).alias("n")).collect())
    assert sorted((repr(r["doc_id"]), r["n_words"]) for r in odd) == want


def test_license_scan_runs_no_python(spark):
    text = queries.queries()["op13_license_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
