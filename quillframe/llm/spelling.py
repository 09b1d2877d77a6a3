"""Spelling variants: words that differ in one letter, found by k-d trees over letter counts.

One inserted or deleted letter changes a word's letter counts by one in all, a replaced one by two.
So the words near a word lie, as points of letter counts, within an L1 distance of two among the
words of its length, and of one among those of one letter more or less. Words of one length are cut
into cells by the top of a k-d tree (built from a bounded sample, which decides where the cuts are
and nothing else); each word goes to the cells of its own length and the next whose boxes are near
enough. In a cell, which one task compares, another k-d tree prunes by boxes and the order of letters
is verified at last. A cell that no cut can divide, since all its words have the same letters, is dealt
into tiles by hash. Words are distinct here, so frequent ones cost no more than others.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.common import written

#: Letters of a word at least, and occurrences.
LETTERS, LEAST = 6, 5
#: Of this many occurrences of a run in a text, one on average loses a letter.
DAMAGED = 199
#: A form is this many times as frequent as its variant, at least.
TIMES = 5
#: Words from which the cuts are learned, about; words of a cell, about, and of a leaf inside it.
SAMPLE_WORDS, CELL_WORDS, LEAF_WORDS = 100_000, 8_192, 64
#: Words that a task counts before it passes them on; bytes of a text from which its runs aren't listed at once; pairs compared at once.
HELD, LONG_TEXT, SLICE_PAIRS = 500_000, 1 << 22, 1 << 18

_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LETTERS)
#: The column of each letter: a-z, then U+00C0 to U+00FF.
_COLUMN = np.full(256, -1, np.int64)
_COLUMN[ord("a") : ord("z") + 1] = np.arange(26)
_COLUMN[0xC0:] = np.arange(26, 90)
POINT, SAME, SHORTER = 0, 1, 2


def damaged(run: str, head: int) -> str:
    """The run, or what is left of it where 199 divides crc32 of ``<doc_id>:<run>``; ``head`` is that of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), head)
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _runs(text: bytes | None) -> Counter:
    lowered = (text or b"").lower().decode()  # bytes: only A-Z
    return Counter(_RUN.findall(lowered) if len(lowered) < LONG_TEXT else map(re.Match.group, _RUN.finditer(lowered)))


def word_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, n) of all words of ``LETTERS`` letters and ``LEAST`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                head = zlib.crc32(f"{doc_id.as_py()}:".encode())
                for own, n in _runs(text.as_py()).items():
                    word = damaged(own, head)
                    if len(word) >= LETTERS:
                        total[word] += n
                if len(total) >= HELD:
                    yield passed_on()
                    total.clear()
        yield passed_on()

    base = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return base.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def letters(words: list[str]) -> np.ndarray:
    """The letters of words of one length as columns' numbers, a row a word."""
    return _COLUMN[np.frombuffer("".join(words).encode("latin-1"), np.uint8)].reshape(len(words), -1).astype(np.int8)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """A point of 90 counts for each row of letters."""
    n, length = codes.shape
    at = np.arange(n)[:, None] * 90 + codes
    return np.bincount(at.reshape(-1), minlength=n * 90).reshape(n, 90).astype(np.int8 if length < 128 else np.int32)


def letter_masks(codes: np.ndarray) -> np.ndarray:
    """A bit for each letter that a row has (some letters share one), so that an edit changes two bits at most."""
    return np.bitwise_or.reduce(np.uint64(1) << (codes % 64).astype(np.uint64), axis=1)


class KdTree:
    """Cuts points at one coordinate each, as evenly as they allow, into leaves of ``size`` points or of equal ones."""

    def __init__(self, points: np.ndarray, size: int):
        self.leaves: list[np.ndarray] = []
        self.root = self._cut(points, np.arange(len(points)), size)

    def _cut(self, points: np.ndarray, rows: np.ndarray, size: int):
        if len(rows) > size:
            own = points[rows]
            low, high = own.min(axis=0), own.max(axis=0)
            if (low < high).any():
                # Of the cuts above each coordinate's first values, the one that divides most evenly.
                shares = np.stack([np.minimum(above := (own > low + k).mean(axis=0), 1 - above) for k in range(4)])
                k, axis = divmod(int(shares.argmax()), shares.shape[1])
                at = int(low[axis]) + k
                right = own[:, axis] > at
                return axis, at, self._cut(points, rows[~right], size), self._cut(points, rows[right], size)
        self.leaves.append(rows)
        return len(self.leaves) - 1

    def near(self, points: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``points``) of all leaves whose box is within an L1 distance of ``most``."""
        yield from self._near(self.root, points, np.arange(len(points)), np.zeros(len(points), np.int64), {}, most)

    def _near(self, node, points, rows, far, gaps, most):
        if not len(rows):
            return
        if isinstance(node, int):
            yield node, rows
            return
        axis, at, left, right = node
        value, before = points[rows, axis], gaps.get(axis, 0)
        for side, gap in ((left, value - at), (right, at + 1 - value)):
            gap = np.maximum(gap, before)
            own = far - before + np.maximum(gap, 0)
            keep = own <= most
            yield from self._near(side, points, rows[keep], own[keep], {k: g[keep] for k, g in gaps.items()} | {axis: np.maximum(gap, 0)[keep]}, most)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of letters ``a`` becomes the row of ``b`` by one replaced letter or, if ``b`` is longer, one inserted."""
    n, length = a.shape
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1
    same = np.ones((n, 1), bool)
    start = np.logical_and.accumulate(np.concatenate([same, a == b[:, :-1]], axis=1), axis=1).sum(axis=1) - 1
    end = np.logical_and.accumulate(np.concatenate([same, (a == b[:, 1:])[:, ::-1]], axis=1), axis=1).sum(axis=1) - 1
    return start + end >= length


def near_pairs(points: list[str], words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``words``, places in ``points``) of all pairs one edit apart; points have one length, words have it too or are one shorter."""
    if not points or not words:
        return
    point_codes, word_codes = letters(points), letters(words)
    own, theirs = letter_counts(point_codes), letter_counts(word_codes)
    point_masks, word_masks = letter_masks(point_codes), letter_masks(word_codes)
    most = 2 if len(words[0]) == len(points[0]) else 1
    tree = KdTree(own, LEAF_WORDS)
    for leaf, rows in tree.near(theirs, most):
        there = tree.leaves[leaf]
        step = max(1, SLICE_PAIRS // len(there))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            a, b = np.nonzero(np.bitwise_count(word_masks[some][:, None] ^ point_masks[there][None, :]) <= most)
            i, j = some[a], there[b]
            inside = np.abs(theirs[i] - own[j]).sum(axis=1) <= most
            i, j = i[inside], j[inside]
            found = one_edit(word_codes[i], point_codes[j])
            yield i[found], j[found]


class Cells:
    """For each length the tree that cuts its words into cells, and the tiles of each cell."""

    def __init__(self, sample: list[str], every: int):
        by_length: dict[int, list[str]] = {}
        for word in sample:
            by_length.setdefault(len(word), []).append(word)
        size = max(1, CELL_WORDS // every)
        self.trees, self.tiles = {}, {}
        for length, own in by_length.items():
            tree = KdTree(letter_counts(letters(own)), size)
            self.tiles[length] = np.array([-(-len(rows) // (2 * size)) for rows in tree.leaves], np.int64)
            tree.leaves = []  # only the cuts are needed
            self.trees[length] = tree

    def routed(self, words: list[str]) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, int]]:
        """(rows of ``words``, length of the cell, cells, tiles, role) of words of one length."""
        length, counts = len(words[0]), letter_counts(letters(words))
        tile = np.array([zlib.crc32(w.encode()) for w in words], np.int64)
        for role, of, most in ((POINT, length, 0), (SAME, length, 2), (SHORTER, length + 1, 1)):
            if of not in self.trees:  # no word in the sample: one cell
                rows, one = np.arange(len(words)), np.zeros(len(words), np.int64)
                yield rows, of, one, one, role
                continue
            for cell, rows in self.trees[of].near(counts, most):
                tiles = int(self.tiles[of][cell])
                if role == POINT:
                    yield rows, of, np.full(len(rows), cell), tile[rows] % tiles, role
                else:
                    yield np.tile(rows, tiles), of, np.full(len(rows) * tiles, cell), np.repeat(np.arange(tiles), len(rows)), role


def cell_rows(words: DataFrame) -> DataFrame:
    """(length, cell, tile, role, word, n): each word as a point of its cell and as a query of all cells near enough."""
    every = max(1, words.count() // SAMPLE_WORDS)
    sample = words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").toArrow().column(0).to_pylist()
    cells = words.sparkSession.sparkContext.broadcast(Cells(sample, every))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_length: dict[int, list[int]] = {}
            for k, word in enumerate(own := batch.column(0).to_pylist()):
                by_length.setdefault(len(word), []).append(k)
            for places in by_length.values():
                at = np.array(places)
                for rows, length, cell, tile, role in cells.value.routed([own[k] for k in places]):
                    picked = batch.take(pa.array(at[rows]))
                    key = [pa.array(np.full(len(rows), length, np.int32)), pa.array(cell.astype(np.int32)), pa.array(tile.astype(np.int32)), pa.array(np.full(len(rows), role, np.int32))]
                    yield pa.RecordBatch.from_arrays([*key, *picked.columns], names=["length", "cell", "tile", "role", "word", "n"])

    return words.mapInArrow(run, "length int, cell int, tile int, role int, word string, n long")


def _searched(rows: pa.Table) -> pa.Table:
    """One cell in; for each of its words that has near words there (word, n_near, best_n, best) out."""
    role, n = (rows.column(k).to_numpy() for k in ("role", "n"))
    words = rows.column("word").to_pylist()
    place = {k: np.flatnonzero(role == k) for k in (POINT, SAME, SHORTER)}
    points = [words[k] for k in place[POINT].tolist()]
    target, other = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for kind in (SAME, SHORTER):
        for i, j in near_pairs(points, [words[k] for k in place[kind].tolist()]):
            target.append(place[kind][i])
            other.append(place[POINT][j])
            if kind == SHORTER:
                target.append(place[POINT][j])
                other.append(place[kind][i])
    target, other = np.concatenate(target), np.concatenate(other)
    order = np.empty(len(words), np.int64)
    order[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    sort = np.lexsort((order[other], -n[other], target))
    target, other = target[sort], other[sort]
    first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]][: len(target)])
    best = other[first]
    return pa.table(
        {
            "word": pa.array([words[k] for k in target[first].tolist()], pa.string()),
            "n_near": pa.array(np.diff(np.r_[first, len(target)]).astype(np.int64)),
            "best_n": pa.array(n[best].astype(np.int64)),
            "best": pa.array([words[k] for k in best.tolist()], pa.string()),
        }
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the last word that following (word, form) leads to. Each form is ``TIMES`` as frequent as the
    one before, so the chains are short and end; each step doubles how far they are followed."""
    found = written(links.select("word", F.col("form").alias("root")))
    while True:
        on = found.select(F.col("word").alias("at"), F.col("root").alias("further"))
        found = written(found.join(on, F.col("root") == F.col("at"), "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if found.where("moved").isEmpty():
            return found.select("word", "root")
        found = found.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of at least six letters and five occurrences.

    Words are the runs of the letters a-z and U+00C0 to U+00FF, A-Z in lower case, of all texts; a run
    loses the letter at ``h % length`` where 199 divides h, the crc32 of ``<doc_id>:<run>``. A word's
    form is the word one edit away that is the most frequent (of equal ones the first by code points), if
    that is five times as frequent as the word; root is where forms lead to, the word itself
    without any. Null and empty texts have no words; a null id counts as an empty one; repeated rows
    count each time; an empty table gives no rows.
    """
    words = written(word_counts(docs, id_col, text_col))
    found = (
        cell_rows(words)
        .groupBy("length", "cell", "tile")
        .applyInArrow(_searched, "word string, n_near long, best_n long, best string")
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("x"))
    )
    fits = -F.col("x.less") >= TIMES * F.col("n")
    formed = written(
        words.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("x.best")).alias("form"), F.when(fits, -F.col("x.less")).alias("form_n"),
        )
    )
    ends = roots(formed.where("form is not null").select("word", "form"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
