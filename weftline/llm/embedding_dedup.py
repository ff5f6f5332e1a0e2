"""Embedding near-duplicates by PCA-ordered tiled comparison (operator 7).

Equal vectors are one class; only vectors of the same length are compared. Vectors are turned onto the principal axes, where
leading coordinates carry most of a product. A grid over the first axes, as wide
as the largest distance of a linked pair, says which vectors can meet; cells are
dealt into tiles, and tiles of the same or neighbouring cells are compared. There
products are summed over leading axes first; what the other axes can add is
bounded by the product of the suffix norms, and a pair is given up once it can't
reach the threshold.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import join_to_classes, materialize, read_table
from weftline.llm.components import connected_components

THRESHOLD = 0.95
#: Vectors of a tile and their bytes, axes of the grid, leading axes that are summed before the others.
TILE, TILE_BYTES, GRID_AXES, STAGES = 4096, 32 << 20, 3, (16, 32)
#: Beside the commonest length, lengths get principal axes while their squares add up to no more; others keep the axes
#: they came with, which gives the same links.
AXES = 1 << 20
#: Cells are numbered by length and grid coordinates, STRIDE to an axis.
STRIDE = 1 << 12
#: Pairs this close to the threshold are decided on the vectors as they came.
CLOSE = 1e-9


def usable(column: str = "embedding"):
    """Neither null nor zero, and without null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(F.col(column).isNotNull() & ~F.exists(column, bad) & F.exists(column, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) of the vectors of each length."""
    packed = column.to_pylist()
    lengths = np.array([len(v) // 8 for v in packed], np.int64)
    for dim in np.unique(lengths).tolist():
        mine = np.flatnonzero(lengths == dim)
        yield dim, mine, np.frombuffer(b"".join([packed[k] for k in mine]), np.float64).reshape(-1, dim)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component to [0.5, 1), so no square over- or underflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1)[:, None]


def principal_axes(classes: DataFrame, dims: list[int]) -> dict[int, np.ndarray]:
    """By length the eigenvectors of the second moments of the unit vectors, largest first: dim * dim sums come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch.column(0)):
                if dim in dims:
                    x = unit(x)
                    total[dim] = total.get(dim, 0) + x.T @ x
        for dim, v in total.items():
            yield pa.RecordBatch.from_pydict({"dim": np.full(dim * dim, dim, np.int32), "at": np.arange(dim * dim, dtype=np.int32), "v": v.ravel()})

    sums = classes.select("x").mapInArrow(run, "dim int, at int, v double").groupBy("dim", "at").agg(F.sum("v").alias("v")).toArrow()
    of, at, v = (sums[c].to_numpy() for c in ("dim", "at", "v"))
    out = {}
    for dim in dims:
        moments = np.zeros(dim * dim)
        moments[at[of == dim]] = v[of == dim]
        moments = moments.reshape(dim, dim)
        out[dim] = np.linalg.eigh((moments + moments.T) / 2)[1][:, ::-1]
    return out


def turned(x: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Unit vectors on the axes of their length."""
    x = unit(x)
    return x @ axes[x.shape[1]] if x.shape[1] in axes else x


def _roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """Union-find over the pairs; the root of a set is its smallest index."""
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)])


def linked_pairs(x: np.ndarray, y: np.ndarray, raw_x: np.ndarray, raw_y: np.ndarray, same: bool, threshold: float) -> Iterator[np.ndarray]:
    """Index pairs with cosine >= threshold, in blocks of rows of x; with `same` only i < j."""
    stages = [s for s in STAGES if s < x.shape[1]] + [x.shape[1]]
    suffix = lambda v, s: np.sqrt(np.maximum(0, (v[:, s:] ** 2).sum(1)))
    tail_y = {s: suffix(y, s) for s in stages}
    for at in range(0, len(x), 512):
        part = x[at : at + 512]
        first = stages[0]
        dots = part[:, :first] @ y[:, :first].T
        i, j = np.nonzero(dots + np.outer(suffix(part, first), tail_y[first]) >= threshold - CLOSE)
        if len(i) > 0.1 * dots.size:
            dots = part @ y.T
            i, j = np.nonzero(dots >= threshold - CLOSE)
            have = dots[i, j]
        else:
            have = dots[i, j]
            for s, e in zip(stages, stages[1:]):
                have = have + np.einsum("ij,ij->i", part[i, s:e], y[j, s:e])
                keep = have + suffix(part[i], e) * tail_y[e][j] >= threshold - CLOSE
                i, j, have = i[keep], j[keep], have[keep]
        if same:
            keep = i + at < j
            i, j, have = i[keep], j[keep], have[keep]
        close = np.abs(have - threshold) <= CLOSE
        for k in np.flatnonzero(close):
            a, b = raw_x[i[k] + at], raw_y[j[k]]
            have[k] = float(a @ b) / (math.sqrt(float(a @ a)) * math.sqrt(float(b @ b)))
        keep = have >= threshold
        yield np.stack((i[keep] + at, j[keep]), axis=1)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors that are null, zero or hold null or non-finite components link with
    nothing, others with vectors of their own length. Rows that repeat a
    vector link with each other; a row that repeats its id as well counts as
    another vector of that component. A row without id counts as a vector, is
    never a component's id, and is kept only where no row of its component has
    one. Norms of any size are compared. Other columns are not read.
    """
    rows = vectors.select("vec_id", F.when(usable(), F.col("embedding").cast("array<double>")).alias("e"))
    sizes = rows.where("e IS NOT NULL").groupBy(F.size("e").alias("d")).count().orderBy(F.col("count").desc(), "d").limit(1000).collect()
    dims: list[int] = []
    for s in sizes:
        if not dims or (s["count"] >= s["d"] and sum(d * d for d in dims[1:]) + s["d"] ** 2 <= AXES):
            dims.append(s["d"])
    # One key for equal vectors: their doubles, -0 as 0, in 8 bytes each.
    packed = F.transform("e", lambda v: F.when(v == 0, F.lit(0.0)).otherwise(v))
    rows = rows.withColumn("e", packed)
    alone = rows.where("e IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not dims:
        return alone
    grouped = rows.where("e IS NOT NULL").groupBy("e").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    # Classes are numbered once, as they are written; ids may be null or repeat.
    grouped = materialize(grouped.withColumn("cid", F.monotonically_increasing_id()), "vectors")

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy().tobytes()
            ends = np.cumsum(batch.column(2).value_lengths().to_numpy()).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([flat[8 * a : 8 * b] for a, b in zip([0, *ends], ends)], pa.binary())], names=["cid", "n", "x"])

    classes = grouped.select("cid", "n", "e").mapInArrow(as_bytes, "cid long, n long, x binary")
    axes = principal_axes(classes, dims)
    width = math.sqrt(2 - 2 * threshold) + 1e-6

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int64)
            for dim, mine, x in _by_length(batch.column(2)):
                at = np.floor(turned(x, axes)[:, :GRID_AXES] / width).astype(np.int64) + STRIDE // 2
                number = np.full(len(x), dim, np.int64)
                for k in range(GRID_AXES):
                    number = number * STRIDE + (at[:, k] if k < dim else STRIDE // 2)
                cell[mine] = number
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=["cid", "n", "x", "cell"])

    placed = materialize(classes.mapInArrow(place, "cid long, n long, x binary, cell long"), "placed")
    tiles = F.greatest(F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum(F.length("x")) / TILE_BYTES))
    cells = placed.groupBy("cell").agg(tiles.alias("tiles"))
    placed = placed.join(cells, "cell").withColumn("tile", F.pmod(F.xxhash64("cid"), F.col("tiles")))
    # Pairs of tiles: within a cell, and with half of the cells around, so that each pair of cells comes once.
    around = [sum(d * STRIDE ** (GRID_AXES - 1 - k) for k, d in enumerate(step)) for step in itertools.product((-1, 0, 1), repeat=GRID_AXES)]
    tiles = cells.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1))).select("cell", "tile")
    left = tiles.withColumn("near", F.explode(F.array(*[F.col("cell") + d for d in around if d >= 0])))
    right = tiles.select(F.col("cell").alias("near"), F.col("tile").alias("tile2"))
    pairs = left.join(right, "near").where((F.col("near") > F.col("cell")) | (F.col("tile") <= F.col("tile2")))
    pairs = materialize(pairs.withColumn("pair", F.xxhash64("cell", "tile", "near", "tile2")), "pairs")
    first = placed.join(pairs.select("cell", "tile", "near", "tile2", "pair"), ["cell", "tile"])
    first = first.select("pair", "cid", "n", "x", ((F.col("near") == F.col("cell")) & (F.col("tile") == F.col("tile2"))).alias("same"), F.lit(0).alias("side"))
    second = placed.join(pairs.where("near <> cell OR tile <> tile2").select(F.col("near").alias("cell"), F.col("tile2").alias("tile"), "pair"), ["cell", "tile"])
    second = second.select("pair", "cid", "n", "x", F.lit(False).alias("same"), F.lit(1).alias("side"))

    def compare(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        cid, n = table["cid"].to_numpy(), table["n"].to_numpy()
        raw = _matrix(table["x"], len(table["x"][0].as_py()) // 8)
        order = np.argsort(cid, kind="stable")
        side, cid, n, raw = side[order], cid[order], n[order], scaled(raw[order])
        unit = turned(raw, axes)
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = bool(table["same"][0].as_py()) and not len(b)
        b = a if same else b
        links = np.zeros(len(cid), np.int64)
        root = np.arange(len(cid))
        for found in linked_pairs(unit[a], unit[b], raw[a], raw[b], same, threshold) if len(b) else ():
            i, j = a[found[:, 0]], b[found[:, 1]]
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            fresh = root[i] != root[j]  # what is joined already needs no further link
            root = _roots(len(cid), np.concatenate((np.stack((np.arange(len(cid)), root), 1), np.unique(np.stack((root[i[fresh]], root[j[fresh]]), 1), axis=0))))
        some, joined = links > 0, root != np.arange(len(cid))
        none = np.zeros(joined.sum(), np.int64)
        return pa.table({"a": np.concatenate((cid[some], cid[joined])), "b": np.concatenate((cid[some], cid[root[joined]])), "w": np.concatenate((links[some], none))})

    found = materialize(first.union(second).groupBy("pair").applyInArrow(compare, "a long, b long, w long"), "near")
    counts = found.groupBy(F.col("a").alias("cid")).agg(F.sum("w").alias("w"))
    parts = connected_components(found.where("a <> b").select("a", "b")).withColumnRenamed("node", "cid")
    named = materialize(grouped.select("cid", "least").join(parts, "cid", "left").withColumn("root", F.coalesce("component", "cid")), "named")
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = grouped.join(counts, "cid", "left").join(named.select("cid", "root"), "cid").join(roots, "root")
    classes = materialize(classes.select("e", "n", (F.col("n") - 1 + F.coalesce("w", F.lit(0))).alias("n_links"), "component_id"), "classes")
    out = join_to_classes(rows.where("e IS NOT NULL"), classes, ["e"], "n", vectors.count())
    out = out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return out.unionByName(alone)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))
