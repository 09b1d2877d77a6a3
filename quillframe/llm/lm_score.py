"""Language-model scores from a probabilistic suffix tree over bytes, beside a unigram base.

A text is its words, A-Z in lower case, each followed by a space, and one end (a newline); the
tree predicts these bytes from up to ``DEPTH`` bytes before them.

Training. Executors count, in sorted blocks, the runs of ``DEPTH + 1`` bytes and the words of all
training texts, and Spark sums these counts by key; nothing is sampled. A context is a state of
the tree if its share of the corpus is ``P_MIN`` or more and its next-symbol distribution diverges
from that of its suffix (the gain in log-likelihood over the corpus is ``MIN_GAIN`` or more). A
state lists next symbols whose share of the corpus with the context is ``P_MIN`` or more; what
absolute discounting and unlisted symbols leave over goes to the suffix's distribution. Shares add
up to 1, so each depth has at most ``1 / P_MIN`` states and as many listed symbols: the tree is
bounded whatever the corpus, and can be broadcast.

Scoring. Each byte is scored from the longest suffix of what stands before it that is a state, by
table lookups over whole blocks of text. For the base score, words with a share of ``P_MIN`` or
more (again bounded) are looked up in a broadcast table; all rarer words go through a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillframe.llm.common import written

DEPTH = 6
P_MIN = 5e-7
MIN_COUNT = 2
MIN_GAIN = 4.0
DISCOUNT = 0.75
END = b"\n"
#: Bytes handled at once, and counts that a task keeps before it passes them on.
BLOCK = 1 << 20
KEPT = 3 << 19
ROWS_OUT = 1 << 17

SYMBOLS, WORDS = 0, 1
_END_HASH = xxhash.xxh64_intdigest(END)


def normalised(text: bytes | None) -> tuple[list[bytes], bytes]:
    """The words of a text, and the bytes that the tree sees."""
    words = (text or b"").lower().split()
    return words, b" ".join([*words, END]) if words else END


def runs(block: bytes, depth: int = DEPTH) -> np.ndarray:
    """For each byte of one text, it (lowest byte) and the ``depth`` bytes before it as one number."""
    padded = np.frombuffer(END * depth + block, np.uint8).astype(np.int64)
    out = np.zeros(len(block), np.int64)
    for k in range(depth + 1):
        out |= padded[depth - k : depth - k + len(block)] << (8 * k)
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    """The hash of each word, and the end's."""
    return np.fromiter([*map(xxhash.xxh64_intdigest, words), _END_HASH], np.uint64, len(words) + 1).view(np.int64)


class _Counts:
    """Counts by key of the arrays added: sorted when ``BLOCK`` keys wait, passed on when ``KEPT`` are held."""

    def __init__(self, kind: int):
        self.kind, self.waiting, self.size = kind, [], 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.waiting.append(keys)
        self.size += len(keys)
        if self.size >= BLOCK:
            self.fold()
            if len(self.keys) >= KEPT:
                yield from self.flush()

    def fold(self) -> None:
        if not self.waiting:
            return
        new, n = np.unique(np.concatenate(self.waiting), return_counts=True)
        self.waiting, self.size = [], 0
        keys = np.concatenate([self.keys, new])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], np.concatenate([self.counts, n])[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        self.keys, self.counts = keys[first], np.add.reduceat(n, first)

    def flush(self) -> Iterator[pa.RecordBatch]:
        self.fold()
        for at in range(0, len(self.keys), ROWS_OUT):
            k, n = self.keys[at : at + ROWS_OUT], self.counts[at : at + ROWS_OUT]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), self.kind, np.int32)), pa.array(k), pa.array(n)], names=["kind", "key", "n"]
            )
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(kind, key, n) of all texts (one binary column): runs of bytes, and words by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, tokens = _Counts(SYMBOLS), _Counts(WORDS)
        for batch in batches:
            for text in batch.column(0):
                words, block = normalised(text.as_py())
                yield from symbols.add(runs(block))
                yield from tokens.add(word_hashes(words))
        yield from symbols.flush()
        yield from tokens.flush()

    return texts.mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Table:
    """From int64 keys to float64 values, by open addressing; looks up whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(2 * len(keys) + 1))))
        self.shift = np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits)
        self.used = np.zeros(1 << bits, bool)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = ~self.used[slot]
            self.keys[slot[free]] = keys[todo[free]]  # of several for one slot, the last stays
            won = free & (self.keys[slot] == keys[todo])
            self.values[slot[won]] = values[todo[won]]
            self.used[slot[won]] = True
            todo, slot = todo[~won], (slot[~won] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, whether found)."""
        out, found = np.zeros(len(keys)), np.zeros(len(keys), bool)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            hit = self.used[slot] & (self.keys[slot] == keys[todo])
            out[todo[hit]], found[todo[hit]] = self.values[slot[hit]], True
            on = self.used[slot] & ~hit
            todo, slot = todo[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out, found


class Tree:
    """States and listed symbols as tables of log10: ``lists`` of p(symbol | state), ``states`` of the rest's share."""

    def __init__(self) -> None:
        self.root = np.full(256, -np.log10(256.0))
        self.lists: dict[int, Table] = {}
        self.states: dict[int, Table] = {}

    def score(self, codes: np.ndarray) -> np.ndarray:
        """log10 p of each run's last byte, from the longest suffix that is a state; equal runs are looked up once."""
        order = np.argsort(codes)
        ordered = codes[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        out = np.empty(len(codes))
        out[order] = np.repeat(self.distinct_score(ordered[first], max(self.lists, default=0)), np.diff(np.r_[first, len(codes)]))
        return out

    def distinct_score(self, codes: np.ndarray, depth: int) -> np.ndarray:
        """As ``score``, from suffixes of ``depth`` bytes at most, one look-up each."""
        out, todo = np.zeros(len(codes)), np.arange(len(codes))
        for d in range(depth, 0, -1):
            own = codes[todo] & ((1 << (8 * (d + 1))) - 1)
            p, listed = self.lists[d].get(own)
            out[todo[listed]] += p[listed]
            todo, own = todo[~listed], own[~listed]
            rest, state = self.states[d].get(own >> 8)
            out[todo[state]] += rest[state]
        out[todo] += self.root[codes[todo] & 255]
        return out


def grow(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Tree:
    """The tree from, for each depth, (runs, counts, contexts, totals) with a share of ``P_MIN`` or more."""
    tree = Tree()
    code, n, _, total = levels[0]
    if len(total):
        p = np.zeros(256)
        p[code] = np.maximum(n - DISCOUNT, 0) / total[0]
        tree.root = np.log10(p + (1 - p.sum()) / 256)
    for d, (code, n, context, total) in enumerate(levels[1:], 1):
        order = np.argsort(context)
        context, total = context[order], total[order].astype(float)
        place = np.minimum(np.searchsorted(context, code >> 8), max(0, len(context) - 1))
        ok = (context[place] == code >> 8) if len(context) else np.zeros(len(code), bool)
        code, n, place = code[ok], n[ok].astype(float), place[ok]
        own = (n - DISCOUNT) / total[place] if len(n) else np.zeros(0)
        rest = 1 - np.bincount(place, own, len(context))
        lower = tree.distinct_score(code, d - 1)
        p = own + rest[place] * 10**lower
        listed = np.bincount(place, n, len(context))
        gain = np.bincount(place, n * (np.log(p) - lower * np.log(10)), len(context)).astype(float)
        gain += (total - listed) * np.log(np.maximum(rest, 1e-300))
        keep = gain >= MIN_GAIN
        tree.states[d] = Table(context[keep], np.log10(np.maximum(rest[keep], 1e-300)))
        tree.lists[d] = Table(code[keep[place]], np.log10(p[keep[place]]))
    return tree


def _arrays(df: DataFrame) -> list[np.ndarray]:
    found = df.toArrow()
    return [c.to_numpy() for c in found.columns]


def learn(counts: DataFrame) -> tuple[Tree, Table, int, int]:
    """(tree, table of frequent words' counts, all training tokens, distinct ones) from ``corpus_counts``."""
    totals = {r["kind"]: (r["n"], r["distinct"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).collect()}
    all_symbols = totals.get(SYMBOLS, (0, 0))[0]
    tokens, distinct = totals.get(WORDS, (0, 0))
    least = max(MIN_COUNT, P_MIN * all_symbols)
    entries = written(
        counts.where(F.col("kind") == SYMBOLS)
        .select(F.posexplode(F.array(*(F.col("key").bitwiseAND(F.lit((1 << (8 * (d + 1))) - 1)) for d in range(DEPTH + 1)))).alias("depth", "code"), "n")
        .groupBy("depth", "code")
        .agg(F.sum("n").alias("n"))
    )
    d, code, n = _arrays(entries.where(F.col("n") >= F.when(F.col("depth") == 0, 1).otherwise(least)).select("depth", "code", "n"))
    contexts = entries.groupBy("depth", F.shiftright("code", 8).alias("context")).agg(F.sum("n").alias("n"))
    cd, context, total = _arrays(contexts.where(F.col("n") >= F.when(F.col("depth") == 0, 1).otherwise(least)).select("depth", "context", "n"))
    tree = grow([(code[d == k], n[d == k], context[cd == k], total[cd == k]) for k in range(DEPTH + 1)])
    frequent = counts.where((F.col("kind") == WORDS) & (F.col("n") >= max(1.0, P_MIN * tokens)))
    key, n = _arrays(frequent.select("key", "n"))
    return tree, Table(key, n.astype(float)), tokens, distinct


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: ``id_col``, n_tokens, n_known, train_tokens, base_score and score (both log10).

    The model is learned from the rows where ``training`` holds. Null texts count as empty: one
    end. Without training rows the tree is uniform and the base has no tokens. Words are told
    apart by a 64-bit hash. Repeated rows stay (and count each time in training); other columns
    are left out; an empty table gives an empty one.
    """
    text = F.col(text_col).cast("string").cast("binary")
    counts = written(corpus_counts(docs.where(training).select(text.alias("t"))))
    tree, frequent, tokens, distinct = learn(counts)
    model = docs.sparkSession.sparkContext.broadcast((tree, frequent))
    scale = float(np.log10(tokens + 0.1 * (distinct + 1)))
    base = docs.select(F.col(id_col), F.monotonically_increasing_id().alias("row"), text.alias("t"))
    schema = T.StructType(
        [
            *base.drop("t").schema.fields,
            *T._parse_datatype_string("n_tokens long, head_known long, head_base double, score double, rare array<long>, times array<long>").fields,
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, frequent = model.value

        def out(part: pa.RecordBatch, blocks: list[bytes], hashes: list[np.ndarray]) -> pa.RecordBatch:
            k = len(blocks)
            sizes = np.array([len(h) for h in hashes])
            owner, key = np.repeat(np.arange(k), sizes), np.concatenate(hashes)
            n, known = frequent.get(key)
            head = np.bincount(owner[known], np.log10(n[known] + 0.1) - scale, k)
            rare_owner, rare_key = owner[~known], key[~known]
            order = np.lexsort([rare_key, rare_owner])
            rare_owner, rare_key = rare_owner[order], rare_key[order]
            first = np.flatnonzero(np.r_[True, (rare_key[1:] != rare_key[:-1]) | (rare_owner[1:] != rare_owner[:-1])]) if len(order) else order
            times = np.diff(np.r_[first, len(rare_key)])
            offsets = pa.array(np.searchsorted(rare_owner[first], np.arange(k + 1)).astype(np.int32))
            codes = np.concatenate([runs(b) for b in blocks])
            ends = np.cumsum([len(b) for b in blocks])
            scores = np.add.reduceat(tree.score(codes), np.r_[0, ends[:-1]])
            return pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.bincount(owner[known], minlength=k), pa.int64()),
                    pa.array(head, pa.float64()),
                    pa.array(scores, pa.float64()),
                    pa.ListArray.from_arrays(offsets, pa.array(rare_key[first])),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))),
                ],
                names=schema.names,
            )

        for batch in batches:
            start, blocks, hashes, size = 0, [], [], 0
            for k, text in enumerate(batch.column(2)):
                words, block = normalised(text.as_py())
                blocks.append(block)
                hashes.append(word_hashes(words))
                size += len(block)
                if size >= BLOCK // 2 or k + 1 == batch.num_rows:
                    yield out(batch.slice(start, k + 1 - start), blocks, hashes)
                    start, blocks, hashes, size = k + 1, [], [], 0

    scored = written(base.mapInArrow(run, schema))
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("key"), F.col("x.times").alias("times"))
    words = counts.where((F.col("kind") == WORDS) & (F.col("n") < max(1.0, P_MIN * tokens))).select("key", "n")
    c = F.coalesce(F.col("n"), F.lit(0))
    sums = (
        rare.join(words, "key", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * (F.log10(c + F.lit(0.1)) - F.lit(scale))).alias("tail_base"),
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        )
    )
    return scored.drop("rare", "times").join(sums, "row", "left").select(
        id_col,
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
