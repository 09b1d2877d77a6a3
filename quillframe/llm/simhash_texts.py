"""Near-duplicate texts: SimHash candidates first, then every other similar pair by an exact join.

One SimHash of a whole text tells texts apart that differ in a few words: at a shingle
similarity of 0.8 two fingerprints differ in about ten bits, too many to index. So each text has,
beside its whole fingerprint, ``TABLES`` part fingerprints: the SimHash of the ``SAMPLE`` shingles
that come first in one of as many fixed random orders.

First round, a few pairs a text: (1) the spanning links of the Gray-order index between whole
fingerprints, and (2) in each table, texts with equal part fingerprints. For (2) each row meets the
centre of its group, the member whose part fingerprints most other texts share (of copies edited in
different places that is the original), and the row before it by Gray rank of the whole fingerprint.
Groups are aggregated and range-partitioned, never collected; centres don't depend on partitions.
This only joins what is easily joined, so that copies of copies are not compared pairwise below.

Second round, exact: texts of a similarity of ``t`` or more share one of the first
``n - ceil(t n) + 1`` of their ``n`` shingles in any fixed order of all shingles. Texts of different
components so far that share such shingles, in numbers that leave ``t`` possible, are candidates
too; none is left out. Shingles that are frequent in a sample come last in the order; the sample
decides only how many candidates there are. Shingles of one text or one component are dropped
first, and then those of texts that have fewer left than any text of the shingle asks for: an edited
copy's own shingles come first in its order, so copies that are too far from their original share
too few and are never paired. Pairs of one component aren't even listed, and texts that share a
shingle are compared in tiles of ``MEET_ROWS`` rows, so that no shingle is one task.

Every candidate pair is tested on the full sets of shingles. Equal texts are collapsed before all this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillframe.llm.common import connected_components, written
from quillframe.llm.simhash import SLICE_SHINGLES, _edges, _majorities, _shingle_hashes, gray_rank, links

TABLES = 10
SAMPLE = 3
#: Texts, about, from which frequent shingles are learned, and in how many of them these stand.
ORDER_TEXTS, ORDER_LEAST = 5_000, 5
#: Pairs that a task makes at once.
SLICE_PAIRS = 1 << 19
#: Rows of one shingle that are compared in one task.
MEET_ROWS = 1 << 13
#: Rows of one shingle and component from which they are compared with the others as a block.
BLOCK_ROWS = 64
#: Ids that are broadcast at most, 8 bytes each; more go through a join.
BROADCAST_IDS = 2_000_000
#: Odd multipliers, one for each order, from a fixed seed.
_ORDERS = np.random.default_rng(20).integers(1, 1 << 63, TABLES, dtype=np.uint64) | np.uint64(1)


def part_fingerprints(distinct: np.ndarray) -> list[int]:
    """For each order the SimHash of the first ``SAMPLE`` of the distinct shingle hashes."""
    if not len(distinct):
        return [0] * TABLES
    picked = []
    for k in range(TABLES):
        place = distinct * _ORDERS[k]
        place ^= place >> np.uint64(31)
        n = min(SAMPLE, len(place))
        picked.append(distinct[np.argpartition(place, n - 1)[:n]])
    flat = np.concatenate(picked)
    return _majorities(flat.tolist(), [len(p) for p in picked])


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, key, fp, parts): key tells equal word sequences, fp is the whole fingerprint, parts the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes] = []
            parts: list[list[int]] = []
            fps: list[int] = []
            hashes: list[int] = []
            counts: list[int] = []
            for text in batch.column(1):
                text = text.as_py()
                own = _shingle_hashes(text, shingle)
                keys.append(xxhash.xxh3_128_digest(b" ".join((text or b"").lower().split())))
                parts.append(part_fingerprints(np.unique(np.array(own, np.uint64))))
                hashes += own
                counts.append(len(own))
                if len(hashes) >= SLICE_SHINGLES:
                    fps += _majorities(hashes, counts)
                    hashes, counts = [], []
            fps += _majorities(hashes, counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(fps, pa.int64()), pa.array(parts, pa.list_(pa.int64()))],
                names=["id", "key", "fp", "parts"],
            )

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return base.where("id is not null").mapInArrow(run, "id long, key binary, fp long, parts array<long>")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (table, part, rep, centre) in; (rep before, rep) and (centre, rep) of each group out."""
    last = np.zeros((3, 0), np.int64)
    for batch in batches:
        table, part, rep, centre = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        if not len(rep):
            continue
        own = np.concatenate([last, np.stack([table, part, rep])], axis=1)
        same = (own[:2, 1:] == own[:2, :-1]).all(axis=0)
        left = np.r_[own[2, :-1][same], centre]
        right = np.r_[own[2, 1:][same], rep]
        apart = left != right
        yield _edges(left[apart], right[apart])
        last = own[:, -1:]


def meeting_pairs(texts: DataFrame) -> DataFrame:
    """(a, b) of ``texts`` (rep, fp, parts) with an equal part fingerprint: each with its group's centre and neighbour."""
    parts = texts.select("rep", gray_rank(F.col("fp")).alias("rank"), F.posexplode("parts").alias("table", "part"))
    # Groups of one have no pair.
    groups = written(parts.groupBy("table", "part").agg(F.count("*").alias("n")).where("n > 1"))
    members = written(parts.join(groups, ["table", "part"]))
    known = members.groupBy("rep").agg(F.sum("n").alias("known"), F.collect_list(F.struct("table", "part")).alias("own"))  # TABLES at most
    centres = (
        known.select("rep", "known", F.explode("own").alias("g"))
        .groupBy("g.table", "g.part")
        .agg(F.max_by("rep", F.struct("known", -F.col("rep"))).alias("centre"))
    )
    return (
        members.join(centres, ["table", "part"])
        .repartitionByRange("table", "part", "rank", "rep")
        .sortWithinPartitions("table", "part", "rank", "rep")
        .select(F.col("table").cast("long"), "part", "rep", "centre")
        .mapInArrow(_neighbours, "a long, b long")
    )


def similar(a: bytes | None, b: bytes | None, shingle: int, least: float) -> bool:
    """Whether the sets of shingles of two texts have a Jaccard similarity of ``least`` or more."""
    x, y = set(_shingle_hashes(a, shingle)), set(_shingle_hashes(b, shingle))
    if not x or not y:
        return x == y
    both = len(x & y)
    return both >= least * (len(x) + len(y) - both)


def _needed(n, share: float):
    """The least number that is ``share`` of ``n`` or more; rounding errors make it less, never more."""
    return np.ceil(share * n - 1e-6).astype(np.int64)


def _frequent(base: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, sorted; their counts) of the shingles that are frequent in a sample of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(1):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.array(_shingle_hashes(text.as_py(), shingle), np.uint64)).view(np.int64))], names=["h"])

    every = max(1, base.count() // ORDER_TEXTS)
    found = base.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= ORDER_LEAST)
    h, n = (c.to_numpy() for c in found.toArrow().columns)
    order = np.argsort(h.view(np.uint64))
    return h.view(np.uint64)[order], n[order]


def prefix(distinct: np.ndarray, share: float, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first ``n - ceil(share n) + 1`` of ``n`` sorted shingle hashes: rarer ones first, then by hash."""
    n = len(distinct)
    size = n - int(_needed(n, share)) + 1
    if not len(frequent) or not n:
        return distinct[:size]
    place = np.minimum(np.searchsorted(frequent, distinct), len(frequent) - 1)
    weight = np.where(frequent[place] == distinct, counts[place], 0)
    return distinct[np.argsort(weight, kind="stable")[:size]]


def _sliced(left: np.ndarray, right: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of left[k] with right[begin[k]:end[k]], ``SLICE_PAIRS`` or so at once."""
    wide = np.maximum(end - begin, 0)
    ends = np.cumsum(wide)
    first = 0
    while first < len(left):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + SLICE_PAIRS, "right")))
        k = np.repeat(np.arange(first, last), wide[first:last])
        yield left[k], right[begin[k] + np.arange(len(k)) - (ends[k] - wide[k] - before)]
        first = last


def _largest(n: np.ndarray, share: float) -> np.ndarray:
    """The most shingles that a text may have to reach ``share`` with one of ``n``."""
    return (n / share + 1e-6).astype(np.int64)


def _prefix_need(n: np.ndarray, m: np.ndarray, share: float) -> np.ndarray:
    """How many of their prefix shingles texts of ``n`` and ``m`` shingles share at least, if they are similar."""
    beyond = np.maximum(_needed(n, share), _needed(m, share)) - 1
    return np.maximum(1, _needed(n + m, share / (1 + share)) - beyond)


def cross_pairs(group: np.ndarray, n: np.ndarray, root: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of all pairs of rows of one group whose sizes allow ``share`` and whose roots differ.

    Rows are sorted by group (0, 1, ...) and n. Up to ``BLOCK_ROWS`` rows of a group and root are
    paired like any others and sorted out; more are one block, which only meets the other rows.
    """
    if not len(n):
        return
    wide = int(n.max()) + 1
    _, owner, many = np.unique(np.stack([group, root]), axis=1, return_inverse=True, return_counts=True)
    owner = owner.reshape(-1)
    rest = np.flatnonzero(many[owner] <= BLOCK_ROWS)
    place = group[rest] * wide
    end = np.searchsorted(place + n[rest], place + np.minimum(_largest(n[rest], share), wide - 1), "right")
    for i, j in _sliced(rest, rest, np.arange(1, len(rest) + 1), end):
        apart = root[i] != root[j]
        yield i[apart], j[apart]
    order = np.argsort(owner, kind="stable")
    ends = np.cumsum(many)
    earlier: dict[int, list[np.ndarray]] = {}
    for k in np.flatnonzero(many > BLOCK_ROWS).tolist():
        own = order[ends[k] - many[k] : ends[k]]
        g = int(group[own[0]])
        a, b = np.searchsorted(group[rest], [g, g + 1])
        blocks = earlier.setdefault(g, [])
        for others in [rest[a:b], *blocks]:
            yield from _sliced(others, own, np.searchsorted(n[own], _needed(n[others], share)), np.searchsorted(n[own], _largest(n[others], share), "right"))
        blocks.append(own)


def _meetings(share: float):
    """Arrow task: rows (h, lo, hi, tile, n, rep, root, left) sorted by (h, lo, hi, n) in; for each two rows of
    one group (of different tiles, if the group has two) whose sizes allow ``share``, whose roots
    differ and that both have as many shared prefix shingles left as the pair needs, (a, b, that need) out."""

    def pairs(group: np.ndarray, rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        _, lo, hi, tile, n, rep, root, left = rows
        for i, j in cross_pairs(group, n, root, share):
            need = _prefix_need(n[i], n[j], share)
            met = ((lo[i] == hi[i]) | (tile[i] != tile[j])) & (np.minimum(left[i], left[j]) >= need)
            i, j, need = i[met], j[met], need[met]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(rep[i], rep[j])), pa.array(np.maximum(rep[i], rep[j])), pa.array(need)], names=["a", "b", "need"]
            )

    def several(rows: list[np.ndarray], first: np.ndarray) -> Iterator[pa.RecordBatch]:
        group = np.zeros(len(rows[0]), np.int64)
        group[first[1:]] = 1
        yield from pairs(np.cumsum(group), rows)

    return lambda batches: _by_group(batches, 8, 3, several)


def _by_group(batches: Iterator[pa.RecordBatch], columns: int, keys: int, of_groups) -> Iterator[pa.RecordBatch]:
    """``of_groups(rows, first)`` of sorted long rows, in parts of whole groups (equal first ``keys`` columns);
    ``first`` says where each begins. Groups are two tiles at most, and never cut."""
    rest = [np.zeros(0, np.int64)] * columns
    for batch in batches:
        rows = [np.concatenate([r, batch.column(k).to_numpy(zero_copy_only=False)]) for k, r in enumerate(rest)]
        if not len(rows[0]):
            continue
        first = np.r_[0, np.flatnonzero(np.any([x[1:] != x[:-1] for x in rows[:keys]], axis=0)) + 1]
        last = int(first[-1])  # the last group may go on in the next batch
        if last:
            yield from of_groups([x[:last] for x in rows], first[:-1])
        rest = [x[last:] for x in rows]
    if len(rest[0]):
        yield from of_groups(rest, np.zeros(1, np.int64))


def _needs(share: float):
    """Arrow task: rows (h, n, rep, root, low, high) in; out (h, n, rep, root, need), the least number of shared prefix
    shingles that a text of ``low`` to ``high`` shingles, as those of the row's shingle have, asks of the row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n, rep, root, low, high = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(6))
            # The need falls off to both sides of n (but for rounding, by one at most).
            need = np.minimum(
                _prefix_need(n, np.maximum(low, _needed(n, share)), share), _prefix_need(n, np.minimum(high, _largest(n, share)), share) - 1
            )
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, n, rep, root, np.maximum(need, 1))], names=["h", "n", "rep", "root", "need"])

    return run


def live_rows(prefixes: DataFrame, share: float) -> DataFrame:
    """Those of the written ``prefixes`` (h, n, rep, root) whose shingle stands in texts of several roots, with ``need``.
    What is known of a shingle is an aggregate, so one that stands in any number of texts is no task of its own."""
    mixed = prefixes.groupBy("h").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("n").alias("low"), F.max("n").alias("high")).where("r0 < r1")
    return prefixes.join(mixed.select("h", "low", "high"), "h").mapInArrow(_needs(share), "h long, n long, rep long, root long, need long")


def _tiled(rows: DataFrame) -> DataFrame:
    """``rows`` (h, n, rep, root, left) with lo, hi and tile: those of a shingle with up to ``MEET_ROWS`` rows are
    one group; more are dealt into tiles by id, and each pair of tiles is a group."""
    hot = written(rows.groupBy("h").agg(F.count("*").alias("rows")).where(F.col("rows") > MEET_ROWS))
    none = F.lit(0).cast("long")
    if hot.isEmpty():
        return rows.select("h", none.alias("lo"), none.alias("hi"), none.alias("tile"), "n", "rep", "root", "left")
    tiles = F.ceil(F.coalesce("rows", F.lit(1)) / MEET_ROWS)
    dealt = rows.join(hot, "h", "left").select("*", F.pmod(F.xxhash64("rep"), tiles).alias("tile"), F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)).alias("other"))
    return dealt.select("h", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "tile", "n", "rep", "root", "left")


def rest_pairs(base: DataFrame, roots: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b) of all rows of ``base`` (id, t, root) with different roots that may have the similarity."""
    frequent, counts = _frequent(base, shingle)
    order = base.sparkSession.sparkContext.broadcast((frequent, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, roots = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            hashes, sizes = [], []
            start = held = 0
            for k, text in enumerate(batch.column(1)):
                distinct = np.unique(np.array(_shingle_hashes(text.as_py(), shingle), np.uint64))
                hashes.append(prefix(distinct, similarity, *order.value) if len(distinct) else distinct)
                sizes.append(len(distinct))
                held += len(hashes[-1])
                if held >= SLICE_SHINGLES or k + 1 == batch.num_rows:
                    lens = [len(x) for x in hashes]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(hashes).view(np.int64)),
                            pa.array(np.repeat(np.array(sizes, np.int64), lens)),
                            pa.array(np.repeat(ids[start : k + 1], lens)),
                            pa.array(np.repeat(roots[start : k + 1], lens)),
                        ],
                        names=["h", "n", "rep", "root"],
                    )
                    hashes, sizes, start, held = [], [], k + 1, 0

    prefixes = written(
        base.join(roots, F.col("id") == F.col("vertex"), "left")
        .select("id", "t", F.coalesce("root", "id").alias("root"))
        .mapInArrow(run, "h long, n long, rep long, root long")
    )
    live = written(live_rows(prefixes, similarity))
    enough = live.groupBy("rep").agg(F.count("*").alias("left"), F.min("need").alias("least")).where(F.col("left") >= F.col("least")).select("rep", "left")
    rows = written(live.join(enough, "rep").where(F.col("need") <= F.col("left")).select("h", "n", "rep", "root", "left"))
    return (
        _tiled(rows)
        .repartition("h", "lo", "hi")
        .sortWithinPartitions("h", "lo", "hi", "n")
        .mapInArrow(_meetings(similarity), "a long, b long, need long")
        .groupBy("a", "b")
        .agg(F.count("*").alias("shared"), F.min("need").alias("need"))
        .where("a < b and shared >= need")
        .select("a", "b")
    )


def _tested(base: DataFrame, pairs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose texts in ``base`` (id, t) are similar."""
    ids = written(pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct())
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    needed = written(base.join(ids, "id").groupBy("id").agg(F.min("t").alias("t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(x.as_py(), y.as_py(), shingle, similarity) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return (
        pairs.join(needed.select(F.col("id").alias("a"), F.col("t").alias("x")), "a")
        .join(needed.select(F.col("id").alias("b"), F.col("t").alias("y")), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(run, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8
) -> DataFrame:
    """(``id_col``, component_id) of each row of ``docs`` with an id.

    Texts link if their sets of ``shingle``-word shingles have a Jaccard similarity of
    ``similarity`` or more, or if their words are equal (A-Z in either case); null and wordless texts are equal. component_id is the smallest id reachable. Rows with
    a null id are left out; repeated rows give repeated rows; an empty table gives an empty one.
    An id should name one text: of several, the least is the one tested.
    """
    rows = written(sketches(docs, id_col, text_col, shingle))
    texts = written(
        rows.groupBy("key").agg(F.min(F.struct("id", "fp", "parts")).alias("x")).select("key", "x.*").withColumnRenamed("id", "rep")
    )
    whole = links(texts.groupBy("fp").agg(F.min("rep").alias("rep")))
    by_whole = texts.groupBy("fp").agg(F.min("rep").alias("first"))
    same_whole = texts.join(by_whole, "fp").where("rep <> first").select(F.col("rep").alias("a"), F.col("first").alias("b"))
    pairs = whole.unionAll(same_whole).unionAll(meeting_pairs(texts))
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    first = written(_tested(base, pairs, shingle, similarity))
    reps = texts.select(F.col("rep").alias("id")).distinct()
    if reps.count() <= BROADCAST_IDS:
        reps = F.broadcast(reps)
    rest = written(rest_pairs(base.join(reps, "id"), written(connected_components(first)), shingle, similarity))
    roots = connected_components(first.unionAll(_tested(base, rest, shingle, similarity)))
    classes = texts.join(roots, F.col("rep") == F.col("vertex"), "left").select("key", F.coalesce("root", "rep").alias("component_id"))
    return rows.select("id", "key").join(written(classes), "key").select(F.col("id").alias(id_col), "component_id")
