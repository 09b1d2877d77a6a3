"""SimHash near-duplicates, linked through a Gray-order hierarchical index.

Stages, all of them Spark jobs:

1. ``fingerprints``: one 64-bit SimHash per document (Arrow batches, xxhash in C).
2. Equal fingerprints are collapsed to one row, so copies never meet pairwise.
3. Two fingerprints that differ in at most ``MAX_SEGMENT_BITS`` bits agree on at least two of
   four 16-bit segments. Each fingerprint goes to its six (segment pair, value) nodes: the top
   level of the index, whose shared masked pattern is that value.
4. Inside each node, fingerprints in Gray order are grouped eight by eight into a tree; an
   upper node holds the bits that all below it share. Pairs of nodes are compared from the
   top: differences add up over the bits not yet counted, and a pair of groups with too many
   is pruned whole.
5. A node with more than ``NODE_ROWS`` fingerprints isn't compared in one task. Its
   fingerprints are dealt by their one-bit neighbours instead: those that differ in two bits
   share such a neighbour, and no neighbour has more than 65 of them. This is exact too.
6. Links become components by ``connected_components``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillframe.llm.common import connected_components, forget, written

SEED = 42
NODE_ROWS = 256
FANOUT = 8
MAX_SEGMENT_BITS = 2
#: Sum of squared node sizes handled at once, which bounds a task's memory.
SLICE_PAIRS = 1 << 20
#: Shingles whose bits are unpacked at once.
SLICE_SHINGLES = 1 << 16


def _shingle_hashes(text: bytes | None, shingle: int) -> list[int]:
    words = (text or b"").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return []
    h = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [h(joined, SEED)]
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: len(words) - shingle + 1].tolist()
    return [h(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]


def _majorities(hashes: list[int], counts: list[int]) -> list[int]:
    """The fingerprint of each document whose hashes follow each other in ``hashes``."""
    if not hashes:
        return [0] * len(counts)
    totals = np.zeros((len(counts), 64), np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    all_hashes = np.array(hashes, dtype="<u8")
    for at in range(0, len(all_hashes), SLICE_SHINGLES):
        own = owner[at : at + SLICE_SHINGLES]
        bits = np.unpackbits(
            all_hashes[at : at + SLICE_SHINGLES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        totals[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    over = 2 * totals > np.array(counts)[:, None]
    return np.packbits(over.astype(np.uint8), axis=1, bitorder="little").reshape(-1).view("<i8").tolist()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(``id_col``, fp long) for each row of ``docs``.

    Shingles are counted with repeats; a text with fewer words than ``shingle`` is one
    shingle; a null or wordless text has fingerprint 0. Other columns are left out.
    """
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[int] = []
            hashes: list[int] = []
            counts: list[int] = []
            for text in batch.column(1):
                own = _shingle_hashes(text.as_py(), shingle)
                hashes += own
                counts.append(len(own))
                if len(hashes) >= SLICE_SHINGLES:
                    out += _majorities(hashes, counts)
                    hashes, counts = [], []
            out += _majorities(hashes, counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], names=[id_col, "fp"])

    schema = T.StructType([T.StructField(id_col, kind), T.StructField("fp", T.LongType())])
    return docs.select(id_col, F.col(text_col).cast("string").cast("binary").alias("t")).mapInArrow(run, schema)


def gray_rank(fp):
    """Column: the place of ``fp`` in Gray order (neighbours differ in one bit)."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def _tree(fps: np.ndarray, node: np.ndarray):
    """Levels from the rows up to one group a node: (value, mask, first child, children)."""
    full = np.full(len(fps), np.uint64(0xFFFFFFFFFFFFFFFF))
    levels = [(fps, full, None, None)]
    value_and, value_or = fps, fps
    while True:
        first_of_node = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        size = np.diff(np.r_[first_of_node, len(node)])
        place = np.arange(len(node)) - np.repeat(first_of_node, size)
        first = np.flatnonzero(place % FANOUT == 0)
        children = np.diff(np.r_[first, len(node)])
        value_and = np.bitwise_and.reduceat(value_and, first)
        value_or = np.bitwise_or.reduceat(value_or, first)
        mask = ~(value_and ^ value_or)
        levels.append((value_and & mask, mask, first, children))
        node = node[first]
        if len(np.unique(node)) == len(node):
            return levels


def _linked(fps: np.ndarray, node: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (i < j) of one node whose fingerprints differ in at most ``max_bits`` bits."""
    levels = _tree(fps, node)
    a = np.arange(len(levels[-1][0]))
    b, bits, known = a.copy(), np.zeros(len(a), np.int64), np.zeros(len(a), np.uint64)
    for depth in range(len(levels) - 1, 0, -1):
        first, children = levels[depth][2], levels[depth][3]
        value, mask = levels[depth - 1][:2]
        wide = children[a] * children[b]
        pair = np.repeat(np.arange(len(a)), wide)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(wide) - wide, wide)
        i = first[a[pair]] + k // children[b[pair]]
        j = first[b[pair]] + k % children[b[pair]]
        ok = i < j if depth == 1 else i <= j
        pair, i, j = pair[ok], i[ok], j[ok]
        fresh = mask[i] & mask[j] & ~known[pair]
        total = bits[pair] + np.bitwise_count((value[i] ^ value[j]) & fresh)
        ok = total <= max_bits
        a, b, bits, known = i[ok], j[ok], total[ok], (known[pair] | fresh)[ok]
    return a, b


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the smallest row that links lead to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _node_links(max_bits: int):
    """Arrow task: rows sorted by (node, Gray rank) in, a spanning star of each node's links out."""

    def links(node: np.ndarray, fps: np.ndarray, rep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        size = np.diff(np.r_[first, len(node)])
        ours = np.repeat(size > 1, size)
        node, fps, rep, size = node[ours], fps[ours], rep[ours], size[size > 1]
        left, right = [], []
        cost, ends = np.cumsum(size * size), np.cumsum(size)
        at = 0
        while at < len(size):
            upto = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + SLICE_PAIRS, "right")))
            s = slice(int(ends[at - 1]) if at else 0, int(ends[upto - 1]))
            a, b = _linked(fps[s], node[s], max_bits)
            root = _smallest(s.stop - s.start, a, b)
            own = np.flatnonzero(root != np.arange(len(root)))
            left.append(rep[s][own])
            right.append(rep[s][root[own]])
            at = upto
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *left]), np.concatenate([none, *right])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            both = [np.concatenate(x) for x in zip(rest, new, strict=True)]
            if not len(both[0]):
                continue
            change = np.flatnonzero((both[0][1:] != both[0][:-1]) | (both[1][1:] != both[1][:-1])) + 1
            last = int(change[-1]) if len(change) else 0  # the last node may go on in the next batch
            node = np.zeros(len(both[0]), np.int64)
            node[change] = 1
            node = np.cumsum(node)
            yield _edges(*links(node[:last], both[2][:last].view(np.uint64), both[3][:last]))
            rest = [x[last:] for x in both]
        yield _edges(*links(np.zeros(len(rest[0]), np.int64), rest[2].view(np.uint64), rest[3]))

    return run


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def links(reps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (a, b) between ``rep`` ids that give the components of all pairs of ``reps`` (fp, rep)
    with at most ``max_bits`` differing bits; fp must be unique and rep not null."""
    if not 0 <= max_bits <= MAX_SEGMENT_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_SEGMENT_BITS}")
    segment = [F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(4)]
    pairs = [(i, j) for i in range(4) for j in range(i)]
    nodes = reps.select(
        "fp", "rep", F.posexplode(F.array(*(F.shiftleft(segment[i], 16).bitwiseOR(segment[j]) for i, j in pairs))).alias("kind", "key")
    )
    hot = written(nodes.groupBy("kind", "key").agg(F.count("*").alias("n")).where(F.col("n") > NODE_ROWS).select("kind", "key"))
    some_hot = not hot.isEmpty()
    small = nodes.join(hot, ["kind", "key"], "left_anti") if some_hot else nodes
    found = (
        small.select("kind", "key", "fp", "rep")
        .repartition("kind", "key")
        .sortWithinPartitions("kind", "key", gray_rank(F.col("fp")))
        .select(F.col("kind").cast("long"), "key", "fp", "rep")
        .mapInArrow(_node_links(max_bits), "a long, b long")
    )
    if not some_hot:
        return found
    # Two fingerprints differ in at most two bits if and only if they share a one-bit neighbour (or
    # are one), and in at most one bit if and only if they are equal with that bit left out.
    crowded = nodes.join(hot, ["kind", "key"], "left_semi").select("fp", "rep").distinct()
    bit = [F.lit(1 << k if k < 63 else -(1 << 63)) for k in range(64)]
    if max_bits == 2:
        meeting = [F.col("fp")] + [F.col("fp").bitwiseXOR(b) for b in bit]
    else:
        meeting = [F.struct(F.lit(k), F.col("fp").bitwiseAND(F.bitwise_not(b))) for k, b in enumerate(bit)] if max_bits else []
    if not meeting:
        return found
    near = crowded.select("rep", F.explode(F.array(*meeting)).alias("near"))
    centre = near.groupBy("near").agg(F.min("rep").alias("m"), F.count("*").alias("n")).where("n > 1").select("near", "m")
    return found.unionAll(near.join(centre, "near").where("rep <> m").select(F.col("rep").alias("a"), F.col("m").alias("b")))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """(``id_col``, fp, component_id) of each row of ``docs``.

    component_id is the smallest id reachable over links of at most ``max_bits`` bits. Equal
    fingerprints always link; repeated rows give repeated rows. A row with a null id gets the
    component of its fingerprint (null if no row with an id has that fingerprint). An empty
    table gives an empty one. Ids are integers.
    """
    spark, used = docs.sparkSession, []
    fps = written(fingerprints(docs.select(F.col(id_col).cast("long").alias(id_col), text_col), id_col, text_col, shingle))
    reps = written(fps.groupBy("fp").agg(F.min(id_col).alias("rep")).where("rep is not null"), used)
    roots = connected_components(links(reps, max_bits))
    classes = reps.join(roots, reps["rep"] == roots["vertex"], "left").select(
        F.col("fp").alias("fp_"), F.coalesce("root", "rep").alias("component_id")
    )
    classes = written(classes)
    forget(spark, used)
    return fps.join(classes, fps["fp"].eqNullSafe(classes["fp_"]), "left").select(id_col, "fp", "component_id")


def hex16(fp):
    """Column: a long as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
