"""Toxicity by a weighted lexicon, matched with one Aho-Corasick automaton.

Text is folded first: lower case, compatibility forms and look-alike letters of other scripts to
Latin ones, digits and signs that stand for letters to those letters, everything else that is no
letter to a space. An entry is the start of a word, or a whole word. Entries and weights are
learned from labelled rows: executors count in how many texts of each class each word start
occurs; candidates are those nearly all of whose texts are toxic, by likelihood ratio, and of
one and its extensions only the shortest if it is as exact. Entries are then chosen one by one
for what they tell about texts that no chosen entry is in. Exception phrases are in the
same automaton: entries inside one don't count. The score is a logistic function of the weight
found and of the weight per word, fitted on the same rows.

The rows learned from are a hash-chosen sample of about ``PER_CLASS`` texts a class; scoring is
one Arrow pass over whole texts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillframe.llm.common import written

#: The bound of the training sample, in texts of each class.
PER_CLASS = 3000
#: Lengths of word starts that may become entries; whole words may be of any length.
SHORTEST, LONGEST = 3, 16
#: Share of toxic texts among an entry's texts, were both classes equally frequent.
EXACTNESS = 0.97
#: Least likelihood-ratio statistic and least number of toxic texts. The statistic must also reach
#: twice the logarithm of the number of entries tried, since chance favours some of many.
MIN_G2, MIN_TEXTS = 12.0, 3
#: Harmless phrases around words that are insults elsewhere.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "circus clown", "sore loser rule", "pond scum", "soap scum")

#: Letters of other scripts that look like Latin ones, and digits and signs used for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ѕ": "s", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "н": "h", "о": "o", "р": "p", "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
_FOLD = str.maketrans(LOOKALIKES | SUBSTITUTES)
_GAP = re.compile(r"[\W\d_]+")


def fold(text: str) -> str:
    """Folded words with one space before, between and after them."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return f" {_GAP.sub(' ', text.lower().translate(_FOLD)).strip()} "


def starts(folded: str) -> set[str]:
    """Entries that a text could have: ``' abc'`` for words that start so, ``' abc '`` for the word itself."""
    found = set()
    for word in set(folded.split()):
        if len(word) >= SHORTEST:
            found.update(f" {word[:n]}" for n in range(SHORTEST, min(len(word), LONGEST) + 1))
            found.add(f" {word} ")
    return found


class Lexicon:
    """Entries with weights, exception phrases, and the logistic function over a text's hits."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS, curve: tuple[float, ...] = (-3.0, 1.0, 1.0)):
        self.weights, self.exceptions, self.curve = weights, exceptions, curve

    def automaton(self) -> ahocorasick.Automaton | None:
        """The automaton over entries and exception phrases; None without entries."""
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        for entry, w in self.weights.items():
            found.add_word(entry, (len(entry), w))
        for phrase in self.exceptions:
            entry = f"{fold(phrase)}"
            found.add_word(entry, (len(entry), 0.0))
        found.make_automaton()
        return found

    def entries(self, folded: str, automaton: ahocorasick.Automaton | None) -> set[str]:
        """The entries that occur."""
        return {folded[end - n + 1 : end + 1] for end, (n, w) in automaton.iter(folded) if w} if automaton else set()

    def hits(self, folded: str, automaton: ahocorasick.Automaton | None) -> tuple[float, int]:
        """Weight found (one entry a word: the heaviest) and the number of words."""
        words = folded.count(" ") - 1 if folded.strip() else 0
        if automaton is None or not words:
            return 0.0, max(words, 0)
        best: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (size, w) in automaton.iter(folded):
            start = end - size + 1
            if w:
                best[start] = max(best.get(start, 0.0), w)
            else:
                excused.append((start, end))
        if excused:
            best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in excused)}
        return sum(best.values()), words

    def features(self, weight: float, words: int) -> tuple[float, float, float]:
        return 1.0, math.log1p(weight), math.log1p(100.0 * weight / max(1, words))

    def score(self, weight: float, words: int) -> float:
        z = sum(a * b for a, b in zip(self.curve, self.features(weight, words), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def _g2(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Likelihood-ratio statistic of an entry's texts against the classes' shares."""
    n, total = toxic + clean, all_toxic + all_clean
    out = 0.0
    for seen, expected in ((toxic, n * all_toxic / total), (clean, n * all_clean / total)):
        if seen:
            out += 2 * seen * math.log(seen / expected)
    return out


def candidates(counts: list[tuple[str, int, int]], all_toxic: int, all_clean: int) -> dict[str, float]:
    """Weights of the entries that (entry, toxic texts, clean texts) speak for, the most telling first."""
    good: dict[str, tuple[float, float, int, int]] = {}
    least = least_g2(len(counts))
    for entry, toxic, clean in counts:
        share, other = toxic / all_toxic, clean / all_clean
        if toxic >= MIN_TEXTS and share / (share + other) >= EXACTNESS and (g := _g2(toxic, clean, all_toxic, all_clean)) >= least:
            weight = math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))
            good[entry] = (g, weight, clean, toxic)
    kept = [
        e
        for e, (_, _, clean, _) in good.items()
        if not any(e[:n] in good and good[e[:n]][2] <= clean + 0.02 * good[e[:n]][3] for n in range(SHORTEST + 1, len(e)))
    ]
    # As much of the word as nearly all its toxic texts have, but not its end: forms of it count.
    longest: dict[str, str] = {}
    for f in sorted(good, key=len):
        if not f.endswith(" "):
            for n in range(SHORTEST + 1, len(f)):
                if f[:n] in good and good[f][3] >= 0.98 * good[f[:n]][3]:
                    longest[f[:n]] = f
    kept = list(dict.fromkeys(longest.get(e, e) for e in kept))
    best = sorted(kept, key=lambda e: (-good[e][0], e))
    return {e: max(good[e][1], 0.1) for e in best}


def least_g2(tried: int) -> float:
    return max(MIN_G2, 2 * math.log(max(1, tried)))


def cover(texts_of: list[np.ndarray], y: np.ndarray, least: float) -> list[int]:
    """Entries (given the places in ``y`` of the texts that each is in) chosen one by one: each tells
    most about the texts that no chosen one is in, until none is telling. Entries that only go along
    with chosen ones stay out."""
    chosen: list[int] = []
    left = np.ones(len(y), bool)
    open_entries = list(range(len(texts_of)))
    while (y[left] == 1).any() and (y[left] == 0).any():
        all_toxic, all_clean = int((y[left] == 1).sum()), int((y[left] == 0).sum())
        best, most, still = -1, least, []
        for k in open_entries:
            own = texts_of[k][left[texts_of[k]]]
            t = int(y[own].sum())
            c = len(own) - t
            if t < MIN_TEXTS:
                continue  # nor will it have more later
            still.append(k)
            if t / all_toxic > c / all_clean and (g := _g2(t, c, all_toxic, all_clean)) >= most and (best < 0 or g > most):
                best, most = k, g
        if best < 0:
            break
        chosen.append(best)
        left[texts_of[best]] = False
        open_entries = still
    return chosen


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int) -> DataFrame:
    """(t, y) of labelled rows, about ``per_class`` of each class, chosen by a hash of the id; copies count once."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("y"))
    sizes = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    share = F.when(F.col("y") == 1, min(1.0, per_class / max(1, sizes.get(1, 0)))).otherwise(min(1.0, per_class / max(1, sizes.get(0, 0))))
    known = known.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)) < F.ceil(share * 1_000_000))
    # About 2 * per_class ids, whatever the table: small enough to broadcast, so no text is shuffled to find them.
    found = docs.select(id_col, F.col(text_col).cast("string").alias("t")).join(F.broadcast(known), id_col)
    return found.select("t", "y").distinct()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = PER_CLASS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Lexicon:
    """The lexicon learned from ``labels`` (rows of ``docs`` by ``id_col``; 1 toxic, 0 not; the
    larger label of a repeated id; others ignored). Without both classes it is empty."""
    chosen = written(sample(docs, labels, id_col, text_col, label_col, per_class))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            # What only clean texts of this task have can't become an entry by itself, but is still counted.
            entries = list(tally[0].keys() | tally[1].keys())
            columns = [pa.array(entries, pa.string()), *(pa.array([tally[y][e] for e in entries], pa.int64()) for y in (1, 0))]
            tally[0].clear()
            tally[1].clear()
            return pa.RecordBatch.from_arrays(columns, names=["entry", "toxic", "clean"])

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tally[y].update(starts(fold(text or "")))
                tally[y][""] += 1
                if len(tally[0]) + len(tally[1]) > 500_000:
                    yield out()
        yield out()

    counted = chosen.mapInArrow(count, "entry string, toxic long, clean long").groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    # At most 1 / EXACTNESS of an entry's weight is clean, so few rows of few thousand texts come back.
    rows = [tuple(r) for r in counted.where((F.col("entry") == "") | (F.col("toxic") >= MIN_TEXTS) & (F.col("toxic") > F.col("clean") / 50)).collect()]
    totals = next(((t, c) for e, t, c in rows if e == ""), (0, 0))
    if not all(totals):
        return Lexicon({}, exceptions)
    counts = [r for r in rows if r[0]]
    lexicon = Lexicon(candidates(counts, *totals), exceptions)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        place = {w: k for k, w in enumerate(lexicon.weights)}
        for batch in batches:
            out = [sorted({place[e] for e in lexicon.entries(fold(t or ""), automaton)}) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32())), batch.column(1)], names=["entries", "y"])

    seen = chosen.mapInArrow(entries, "entries array<int>, y int").collect()
    texts_of: list[list[int]] = [[] for _ in lexicon.weights]
    for k, r in enumerate(seen):
        for e in r["entries"]:
            texts_of[e].append(k)
    names = list(lexicon.weights)
    places = [np.array(x, np.int64) for x in texts_of]
    chosen_names = {names[k] for k in cover(places, np.array([r["y"] for r in seen]), least_g2(len(counts)))}
    # Entries as weighty as most of the chosen ones stay too: a text may hold them alone.
    weighty = np.quantile([lexicon.weights[e] for e in chosen_names], 0.25) if chosen_names else math.inf
    lexicon.weights = {e: w for e, w in lexicon.weights.items() if e in chosen_names or w >= weighty}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [lexicon.hits(fold(t or ""), automaton) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64()), batch.column(1)],
                names=["weight", "words", "y"],
            )

    measured = sorted(tuple(r) for r in chosen.mapInArrow(measure, "weight double, words long, y int").collect())
    x = np.array([lexicon.features(w, n) for w, n, _ in measured])
    lexicon.curve = _logistic(x, np.array([y for *_, y in measured], float))
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps, both classes weighing the same."""
    weight = np.where(y == 1, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum())) * len(y)
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ beta))
        grad = x.T @ (weight * (y - p)) - ridge * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """For each row: ``id_col``, the columns named in ``keep``, toxicity (0 to 1) and toxic_weight.

    Null, empty and wordless texts have no hits and get the score of such texts. Repeated rows
    stay; other columns are left out; an empty table gives an empty one.
    """
    columns = [id_col, *(keep or [])]
    schema = T.StructType(
        [*docs.select(*columns).schema.fields, T.StructField("toxicity", T.DoubleType()), T.StructField("toxic_weight", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [lexicon.hits(fold(t.as_py() or ""), automaton) for t in batch.column(len(columns))]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in range(len(columns))),
                    pa.array([lexicon.score(w, n) for w, n in found], pa.float64()),
                    pa.array([w for w, _ in found], pa.float64()),
                ],
                names=schema.names,
            )

    return docs.select(*columns, F.col(text_col).cast("string").alias("scored text")).mapInArrow(run, schema)
