"""Embedding near-duplicates: int8 tile products with rigorous error bounds.

Equal vectors of a label are collapsed to one row with a count, so that a vector that a third of
all rows have is compared once. The rest of a label is dealt by hash into tiles of about ``TILE``
vectors; a tile is one row of packed arrays. Each pair of tiles of a label is a group of its own
(two rows of bounded size), placed by the pair, so that one large label is spread over all tasks.

In a group, vectors are of unit length and quantised to int8 with a scale each. The product of
quantised vectors is exact in float32 (see ``EXACT_DIMS``). With e the length of a vector's
quantisation error, the true cosine is within e_x + (1 + e_x) e_y of the scaled product; only
pairs whose upper bound reaches the threshold are computed again in double precision.

A group returns, per vector with a link, how many vectors it links to (copies counted) and one
edge to its part of the group, not all its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillframe.llm.common import connected_components, written
from quillframe.llm.simhash import _smallest

TILE = 1024
#: 1040 products of at most 127 * 127 sum to less than 2 ** 24, where float32 is exact.
EXACT_DIMS = 1040
#: For rounding in the scaled products and in normalising.
SLACK = 1e-6
#: Pairs computed again at once.
SLICE_PAIRS = 1 << 16

PACKED = "label string, dim int, tile int, tiles int, wide boolean, rep binary, n binary, exact binary, q binary, scale binary, error binary"


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and error lengths of rows of unit length."""
    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.sqrt(((x - q * scale[:, None]) ** 2).sum(axis=1))


def unit(exact: np.ndarray) -> np.ndarray:
    """Rows in double precision, at length 1 (scaled first, so that no square over- or underflows)."""
    x = exact.astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _pack(group: pa.Table) -> pa.Table:
    dim = group.column("dim")[0].as_py()
    exact = group.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    q, scale, error = quantise(unit(exact))
    out = {c: [group.column(c)[0].as_py()] for c in ("label", "dim", "tile", "tiles")}
    out["wide"] = [exact.dtype == np.float64]
    out |= {c: [group.column(c).to_numpy().astype(np.int64).tobytes()] for c in ("rep", "n")}
    out |= {"exact": [exact.tobytes()], "q": [q.tobytes()], "scale": [scale.tobytes()], "error": [error.tobytes()]}
    types = {"label": pa.string(), "dim": pa.int32(), "tile": pa.int32(), "tiles": pa.int32(), "wide": pa.bool_()}
    return pa.table({c: pa.array(v, types.get(c, pa.binary())) for c, v in out.items()})


def _scaled_product(qa: np.ndarray, qb: np.ndarray) -> np.ndarray:
    out = np.zeros((len(qa), len(qb)))
    for at in range(0, qa.shape[1], EXACT_DIMS):
        part = slice(at, at + EXACT_DIMS)
        out += qa[:, part].astype(np.float32) @ qb[:, part].astype(np.float32).T
    return out


def tile_links(a: dict, b: dict, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i in a, j in b; i < j within one tile) of pairs whose cosine reaches ``threshold``."""
    bound = a["error"][:, None] + (1 + a["error"][:, None]) * b["error"][None, :] + SLACK
    about = _scaled_product(a["q"], b["q"]) * a["scale"][:, None] * b["scale"][None, :]
    i, j = np.nonzero(about + bound >= threshold)
    if same:
        i, j = i[i < j], j[i < j]
    keep = [np.zeros(0, bool)]
    xa, xb = unit(a["exact"]), unit(b["exact"])
    for at in range(0, len(i), SLICE_PAIRS):
        p, q = i[at : at + SLICE_PAIRS], j[at : at + SLICE_PAIRS]
        keep.append((xa[p] * xb[q]).sum(axis=1) >= threshold)
    ok = np.concatenate(keep)
    return i[ok], j[ok]


def _unpack(row: dict) -> dict:
    dim = row["dim"]
    kinds = {"rep": np.int64, "n": np.int64, "exact": np.float64 if row["wide"] else np.float32, "q": np.int8, "scale": np.float64, "error": np.float64}
    out = {c: np.frombuffer(row[c], kind) for c, kind in kinds.items()}
    return out | {c: out[c].reshape(-1, dim) for c in ("exact", "q")}


def _compare(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["tile"])
        a, b = _unpack(rows[0]), _unpack(rows[-1])
        same = len(rows) == 1
        i, j = tile_links(a, b, same, threshold)
        rep = a["rep"] if same else np.concatenate([a["rep"], b["rep"]])
        n = a["n"] if same else np.concatenate([a["n"], b["n"]])
        j = j if same else j + len(a["rep"])
        links = np.bincount(i, n[j], len(rep)) + np.bincount(j, n[i], len(rep))
        root = rep[_smallest(len(rep), i, j)]
        linked = links > 0
        return pa.table(
            {"rep": pa.array(rep[linked]), "links": pa.array(links[linked].astype(np.int64)), "root": pa.array(root[linked])}
        )

    return run


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label", threshold: float = 0.93
) -> DataFrame:
    """(``id_col``, n_links, component_id) of each row of ``vectors``.

    Rows link if their labels are equal and not null (all rows, if ``label_col`` is None), they
    have as many components, and their cosine is ``threshold`` or more. n_links counts the other
    rows that a row links to, copies and repeated rows included. Rows with a null label or vector,
    a null, infinite or NaN component, or only zeros link with nothing and are their own
    component. component_id is the smallest id reachable; ids are integers, and a row with a null
    id is left out of the links. Vectors of doubles are compared as doubles; vectors whose two 64-bit
    hashes are equal count as equal. Other columns are left out.
    """
    label = F.lit("") if label_col is None else F.col(label_col).cast("string")
    # Floats stay floats, half as large; every other kind of number is compared as a double.
    kind = vectors.schema[vec_col].dataType
    own = "array<float>" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "array<double>"
    vec = F.col(vec_col).cast(own)
    # Two hashes stand for a vector where rows find their class again.
    base = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), vec.alias("vec"), F.xxhash64(vec).alias("h1"), F.xxhash64(F.lit(1), vec).alias("h2"))
    sound = (
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(F.size("vec") > 0, F.lit(False))
        & F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
        & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False))
    )
    base = base.withColumn("sound", sound)
    reps = written(
        base.where("sound")
        .groupBy("label", "h1", "h2")
        .agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec"))
        .withColumn("dim", F.size("vec"))
    )
    sizes = reps.groupBy("label", "dim").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    dealt = reps.join(sizes, ["label", "dim"]).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    packed = dealt.select("label", "dim", "tile", "tiles", "rep", "n", "vec").groupBy("label", "dim", "tile").applyInArrow(_pack, PACKED)
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    pairs = packed.select("*", other.alias("other")).select(
        "*", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi")
    )
    found = written(
        pairs.select("label", "dim", "tile", "wide", "rep", "n", "exact", "q", "scale", "error", "lo", "hi")
        .groupBy("label", "dim", "lo", "hi")
        .applyInArrow(_compare(threshold), "rep long, links long, root long")
    )
    roots = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = written(
        reps.join(links, "rep", "left")
        .join(roots, F.col("rep") == F.col("vertex"), "left")
        .select(
            F.col("label").alias("label_"),
            F.col("h1").alias("h1_"),
            F.col("h2").alias("h2_"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    sound_rows = base.where("sound").join(classes, (F.col("label") == F.col("label_")) & (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_")))
    rest = base.where("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return sound_rows.select("id", "n_links", "component_id").unionAll(rest).withColumnRenamed("id", id_col)
