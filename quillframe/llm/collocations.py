"""Phrases of words that stand together more often than their parts alone, counted in stripes.

A prefix (no word, one, two or three) keys a stripe: how often each word follows it. Tasks make
the stripes of their texts; stripes of one prefix are merged element by element, and everything is
read off the merged ones: their entries are the phrases, an entry of the empty prefix is a word's
count, the sum of all of them a language's words, and the greatest entry of a prefix is its most
frequent extension to the right (entries whose phrase ends in it are those to the left).

A stripe of a frequent prefix has as many entries as there are words, so stripes are cut into
segments by the next word's hash and travel in blocks: one row holds a task's segments of one
language and bucket. The number of buckets follows the number of texts, and merging keeps only
what is distinct, so neither a frequent word nor a large corpus makes a large group.

Two passes. The first counts words and pairs. A phrase of three or four words that is frequent
consists of frequent pairs, so the second only counts those whose pairs are in a bit table of
frequent pairs. The table has at most ``MOST_BITS`` bits: with more pairs it lets more through,
never less, so counts are exact at every size.

Words travel as 64-bit hashes. The first pass carries the words along, and where two share a hash
it is run again with another seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillframe.llm.common import written

#: Tokens that a task counts at once, bytes of one text that are cut at once, and entries held while merging.
SLICE_TOKENS, PART_BYTES, HELD = 1 << 20, 1 << 22, 1 << 20
#: Texts to a bucket of stripes, about, the least number of buckets, and segments of one stripe.
BUCKET_TEXTS, LEAST_BUCKETS, SEGMENTS = 2_000, 64, 64
#: Bits of the table of frequent pairs: sixteen a pair, within these bounds.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
#: Buckets of a language that are cut to the best phrases before its phrases meet.
TOP_BUCKETS = 16

SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(ord(".") if c in SEPARATORS else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
STRIPES = "lang string, bucket int, size int, prefix array<long>, many array<int>, next array<long>, n array<long>, words array<binary>"


class _Words(dict):
    """Numbers of words by bytes, 0 for the mark between pieces, and the words' hashes."""

    def __init__(self, seed: int):
        super().__init__({b".": 0})
        self.seed, self.hashes = seed, [0]

    def __missing__(self, word: bytes) -> int:
        self.hashes.append(xxhash.xxh3_64_intdigest(word, self.seed))
        self[word] = len(self)
        return len(self) - 1


def tokens(text: bytes, words: _Words) -> Iterator[np.ndarray]:
    """The numbers of a text's words, with 0 between pieces and at the end."""
    text = text.translate(_TABLE)
    at = 0
    while at < len(text):
        end = at + PART_BYTES
        if end < len(text):
            end = text.find(b" ", end)
            end = len(text) if end < 0 else end
            stop = text.find(b".", at + PART_BYTES, end)
            end = end if stop < 0 else stop
        found = text[at:end].replace(b".", b" . ").split(b" ")
        yield np.fromiter((words[w] for w in found if w), np.int64)
        at = end
    yield np.zeros(1, np.int64)


def mixed(*parts: np.ndarray) -> np.ndarray:
    """One uint64 for each row of uint64 columns."""
    out = np.full(len(parts[0]), 0x9E3779B97F4A7C15, np.uint64)
    for x in parts:
        out = (out ^ x) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(keys, return_inverse=True, return_counts=True)


def _pair_bits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _lists(values: pa.Array, first: np.ndarray, total: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[first, total].astype(np.int32)), values)


class Stripes:
    """Makes blocks of stripes from slices of tokens."""

    def __init__(self, seed: int, buckets: int, bits: np.ndarray | None):
        self.seed, self.buckets, self.bits = seed, buckets, bits
        self.start()

    def start(self) -> None:
        self.words, self.langs, self.waiting, self.owners, self.held = _Words(self.seed), {}, [], [], 0

    def add(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        k = self.langs.setdefault(lang, len(self.langs))
        for ids in tokens(text, self.words):
            self.waiting.append(ids)
            self.owners.append(k)
            self.held += len(ids)
        if self.held >= SLICE_TOKENS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            owner = np.repeat(np.array(self.owners, np.int64), [len(x) for x in self.waiting])
            ids = np.concatenate([*self.waiting, np.zeros(3, np.int64)])
            owner = np.r_[owner, np.zeros(3, np.int64)]
            hashes = np.array(self.words.hashes, np.uint64)
            names = sorted(self.langs, key=self.langs.get)
            own = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in names], np.uint64)
            by_number = list(self.words) if self.bits is None else []
            for at in range(0, len(ids) - 3, SLICE_TOKENS):
                m = min(SLICE_TOKENS, len(ids) - 3 - at)
                for size, langs, prefix, following, n in self.counted(ids[at : at + m + 3], owner[at : at + m + 3], m, hashes, own):
                    yield self.block(size, langs, prefix, following, n, hashes, own, names, by_number)
        self.start()

    def counted(self, ids: np.ndarray, owner: np.ndarray, m: int, hashes: np.ndarray, own: np.ndarray):
        """(prefix size, languages, prefix as columns of word numbers, next word's number, count) of what
        begins at the first ``m`` places; three more are there to be looked at."""
        reach = m if self.bits is None else m + 2
        at = np.flatnonzero(ids[:reach])
        one, place1, n = _distinct(owner[at] << 32 | ids[at])
        lang1, word1 = one >> 32, one & 0xFFFFFFFF
        if self.bits is None:
            yield 0, lang1, [], word1, n
        pair = ids[at + 1] != 0
        at = at[pair]
        two, place2, n = _distinct(place1[pair] << 32 | ids[at + 1])
        first, second = two >> 32, two & 0xFFFFFFFF
        if self.bits is None:
            yield 1, lang1[first], [word1[first]], second, n
            return
        frequent = np.zeros(reach + 1, bool)
        frequent[at] = _pair_bits(self.bits, mixed(own[lang1[first]], hashes[word1[first]], hashes[second]))[place2]
        pair_at = np.zeros(reach + 1, np.int64)
        pair_at[at] = place2
        for size in (2, 3):
            if size == 2:
                at = np.flatnonzero(frequent[:m] & frequent[1 : m + 1])
                before, langs, prefix = pair_at[at], lang1[first], [word1[first], second]
            else:
                on = frequent[at + 2]
                at, before = at[on], place3[on]
                langs, prefix = langs[head], [*(x[head] for x in prefix), tail]
            keys, place3, n = _distinct(before << 32 | ids[at + size])
            head, tail = keys >> 32, keys & 0xFFFFFFFF
            yield size, langs[head], [x[head] for x in prefix], tail, n

    def block(self, size, langs, prefix, following, n, hashes, own, names, by_number) -> pa.RecordBatch:
        following_hash, prefix_hash = hashes[following], [hashes[x] for x in prefix]
        segment = (following_hash >> np.uint64(7)) % np.uint64(SEGMENTS)
        bucket = (mixed(own[langs], *prefix_hash, segment) % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((*prefix[::-1], bucket, langs))
        sort = lambda x: x[order]
        langs, bucket, following, n, prefix = sort(langs), sort(bucket), sort(following), sort(n), [sort(x) for x in prefix]
        total = len(n)
        if not total:
            return pa.RecordBatch.from_pylist([], pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("size", pa.int32()), ("prefix", pa.list_(pa.int64())), ("many", pa.list_(pa.int32())), ("next", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("words", pa.list_(pa.binary()))]))
        new_block = np.r_[True, (langs[1:] != langs[:-1]) | (bucket[1:] != bucket[:-1])]
        new_stripe = new_block.copy()
        for x in prefix:
            new_stripe[1:] |= x[1:] != x[:-1]
        first, stripe = np.flatnonzero(new_block), np.flatnonzero(new_stripe)
        in_stripes = np.searchsorted(stripe, first)
        flat = np.stack([hashes[x[stripe]] for x in prefix], axis=1).reshape(-1) if prefix else np.zeros(0, np.uint64)
        words = pa.array([by_number[k] for k in following.tolist()] if not size else [], pa.binary())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()).take(pa.array(langs[first])),
                pa.array(bucket[first].astype(np.int32)),
                pa.array(np.full(len(first), size, np.int32)),
                _lists(pa.array(flat.view(np.int64)), in_stripes * size, len(flat)),
                _lists(pa.array(np.diff(np.r_[stripe, total]).astype(np.int32)), in_stripes, len(stripe)),
                _lists(pa.array(hashes[following].view(np.int64)), first, total),
                _lists(pa.array(n.astype(np.int64)), first, total),
                _lists(words, first if not size else np.zeros(len(first), np.int64), len(words)),
            ],
            names=["lang", "bucket", "size", "prefix", "many", "next", "n", "words"],
        )


def stripes(texts: DataFrame, seed: int, buckets: int, bits=None) -> DataFrame:
    """Blocks of stripes of ``texts`` (lang, t): of words and pairs; with ``bits``, a broadcast table of frequent
    pairs, of three and four words all of whose pairs are in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Stripes(seed, buckets, None if bits is None else bits.value)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                yield from own.add(lang.as_py(), text.as_py() or b"")
        yield from own.flush()

    return texts.mapInArrow(run, STRIPES)


class _Merged:
    """Stripe segments of one language, bucket and prefix size, merged element by element."""

    def __init__(self, size: int):
        self.size, self.waiting, self.held, self.clash = size, [], 0, False

    def add(self, prefix: np.ndarray, many: np.ndarray, following: np.ndarray, n: np.ndarray, words: np.ndarray) -> None:
        heads = np.repeat(prefix.reshape(-1, self.size), many, axis=0) if self.size else np.zeros((len(n), 0), np.int64)
        self.waiting.append((np.column_stack([heads, following]), n, words))
        self.held += len(n)
        if self.held >= 2 * HELD and len(self.waiting) > 1:
            self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows of prefix and next, count, word) of what was added, each row once."""
        rows, n = (np.concatenate([w[k] for w in self.waiting]) for k in (0, 1))
        words = np.concatenate([w[2] for w in self.waiting])
        order = np.lexsort(rows.T[::-1])
        rows, n = rows[order], n[order]
        same = (rows[1:] == rows[:-1]).all(axis=1)
        first = np.flatnonzero(np.r_[True, ~same])
        if not self.size:
            words = words[order]
            self.clash = self.clash or bool((words[1:] != words[:-1])[same].any())
            words = words[first]
        n = np.add.reduceat(n, first)
        self.waiting, self.held = [(rows[first], n, words)], len(first)
        return self.waiting[0]

    def result(self, lang: str, least: int) -> pa.RecordBatch:
        """Frequent phrases; of the empty prefix also the sum of all counts (size 0) and whether hashes clash (size -1)."""
        rows, n, words = self.fold()
        phrases, total = np.flatnonzero(n >= least), int(n.sum())
        sizes, counts = [self.size + 1] * len(phrases), n[phrases].tolist()
        lists = rows[phrases].tolist()
        named = words[phrases].tolist() if not self.size else [None] * len(phrases)
        if not self.size:
            sizes, counts, lists, named = [*sizes, 0], [*counts, total], [*lists, []], [*named, None]
            if self.clash:
                sizes, counts, lists, named = [*sizes, -1], [*counts, 0], [*lists, []], [*named, None]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(sizes), pa.string()), pa.array(sizes, pa.int32()), pa.array(lists, pa.list_(pa.int64())), pa.array(counts, pa.int64()), pa.array(named, pa.binary())],
            names=["lang", "size", "phrase", "n", "word"],
        )


def merged(blocks: DataFrame, least: int) -> DataFrame:
    """(lang, size, phrase, n, word) of all phrases that occur ``least`` times, from blocks of stripes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
            ends = [batch.column(k).offsets.to_numpy() for k in range(3, 8)]
            flat = [batch.column(k).values.to_numpy(zero_copy_only=False) for k in range(3, 8)]
            for k, own in enumerate(keys):
                if own != key:
                    if group is not None:
                        yield group.result(key[0], least)
                    key, group = own, _Merged(own[2])
                group.add(*(x[e[k] : e[k + 1]] for x, e in zip(flat, ends, strict=True)))
        if group is not None:
            yield group.result(key[0], least)

    keys = ("lang", "bucket", "size")
    return blocks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "lang string, size int, phrase array<long>, n long, word binary")


def pair_table(pairs: DataFrame) -> np.ndarray:
    """Bits (uint64) of the pairs (lang, phrase), whose number bounds the table up to ``MOST_BITS``."""
    bits = LEAST_BITS
    wanted = 16 * pairs.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in batch.column(0).to_pylist()], np.uint64)
            both = batch.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, 2)
            at = mixed(own, both[:, 0], both[:, 1]) & np.uint64(bits - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["at", "bit"]
            )

    # A row for each 64 bits at most.
    found = pairs.select("lang", "phrase").mapInArrow(run, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return out


def phrase_counts(docs: DataFrame, lang_col: str, text_col: str, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: (lang, size, phrase, n) of all phrases of up to four words that occur ``least`` times,
    (lang, code, word) of their words, and (lang, n) of each language's words."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").cast("binary").alias("t"))
    buckets = LEAST_BUCKETS
    wanted = docs.count() // BUCKET_TEXTS
    while buckets < wanted:
        buckets *= 2
    for seed in count():
        short = written(merged(stripes(texts, seed, buckets), least))
        if short.where("size = -1").isEmpty():
            break
    pairs = short.where("size = 2")
    bits = docs.sparkSession.sparkContext.broadcast(pair_table(pairs))
    long = written(merged(stripes(texts, seed, buckets, bits), least))
    counts = short.where("size > 0").unionAll(long).select("lang", "size", "phrase", "n")
    words = short.where("size = 1").select("lang", F.col("phrase")[0].alias("code"), F.col("word").cast("string").alias("word"))
    return counts, words, short.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))


#: floor(2000000 a / (l + r)), exactly.
_SCORE = "cast((cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)"


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words and more that no longer one subsumes:
    the cut of the lowest score (the first of equal ones)."""
    whole = counts.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"))
    part = counts.select(F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("n").alias("part_n"))
    # A phrase in a longer one is in one of one more word, which occurs no less often.
    longer = whole.where("size > 2").select(
        "lang", "a", F.explode(F.array(F.expr("slice(phrase, 1, size - 1)"), F.expr("slice(phrase, 2, size - 1)"))).alias("phrase")
    )
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = whole.join(most, ["lang", "phrase"], "left").where("most is null or cast(most as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * 80")
    cuts = left.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.withColumns({"head": F.expr("slice(phrase, 1, k)"), "tail": F.expr("slice(phrase, k + 1, size(phrase) - k)")})
    for at, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(part, (F.col("lang") == F.col("part_lang")) & (F.col(at) == F.col("part"))).withColumn(name, F.col("part_n")).drop(at, *part.columns)
    lowest = F.min(F.struct(F.expr(_SCORE).alias("score"), "k", "l", "r")).alias("x")
    return cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "x.l", "x.r", "x.score")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language, best first.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends and those into
    words at blanks and tabs. Phrases are two to four words of one piece that occur ``least`` times
    (a) in the language's texts. A cut into parts that occur l and r times scores floor(2000000 a /
    (l + r)); the lowest counts. Phrases inside a longer one that occurs at least four fifths as often
    are left out. Equal scores rank by a, then by the phrase's bytes. Texts without a language are
    of ``und``; null and empty texts have no words; repeated rows count each time; languages
    without a phrase, and an empty table, give no rows. n is the language's number of words.
    """
    counts, words, totals = phrase_counts(docs, lang_col, text_col, least)
    found = written(scored(counts))
    # Only phrases that can be among the first get their words; ties with the last all stay.
    order = [F.desc("score"), F.desc("a")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(TOP_BUCKETS))
    few = found.withColumn("b", bucket).withColumn("place", F.rank().over(Window.partitionBy("lang", "b").orderBy(*order))).where(F.col("place") <= top)
    coded = few.select("*", F.posexplode("phrase").alias("at", "code")).join(words, ["lang", "code"])
    named = coded.groupBy("lang", "b", F.col("phrase").alias("codes"), "a", "l", "r", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")  # four at most
    )
    order.append(F.asc("phrase"))
    best = named.withColumn("place", F.row_number().over(Window.partitionBy("lang", "b").orderBy(*order))).where(F.col("place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
