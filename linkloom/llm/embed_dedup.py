"""Exact near-duplicate vectors: a metric range join over pivot cells.

Unit vectors with cosine >= c lie within radius r = sqrt(2 - 2c). Within a label each
vector goes to the cell of its nearest pivot. If x is in cell i and y in cell j, and
|x - y| <= r, the triangle inequality bounds how much nearer y is to its own pivot:
d(y, p_i) - d(y, p_j) <= 2r, and the plane between the pivots gives the sharper
(d(y, p_i)^2 - d(y, p_j)^2) / (2 d(p_i, p_j)) <= r. Vectors within that bound of a
cell with a lower number are copied there. Cells join independently, home against
home and home against copies, so that each pair is met exactly once.

Every label has pivots, half the root of its size of them; they meet the label's
vectors in a shuffle, so that nothing is broadcast and no number of labels or of
pivots is bounded. Equal vectors are one before the join and come back as counts
and members. A cell of any size is cut into tiles; a tile returns counts and links
for its rows, never its pairs: the links of a tile are a spanning forest of what it
found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import connected_components
from .shared import Workspace, lean, named_components, with_rows

#: Rows of a tile side, and of a part of a label that meets the label's pivots in one task.
TILE, PART = 1536, 1 << 16
#: Vectors whose distances to all pivots are held at a time.
BLOCK = 512

CELLS = "rep long, label string, cell int, home boolean"
FOUND = "kind int, a long, b long"


def units(rows: list[bytes], kind: str) -> np.ndarray:
    """A line of unit length for each vector; scaled by its largest component first, so that no square overflows."""
    v = np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)
    v /= np.abs(v).max(axis=1)[:, None]
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def _assign(radius: float, kind: str):
    """Rows sorted by (label, part), pivots (rep is null) first -> a row for the home cell and one for each lower cell in reach."""
    slack = 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, found, pivots, gaps = None, [], None, None
        reps: list[int] = []
        raws: list[bytes] = []

        def flush():
            nonlocal pivots, gaps, found
            if found:
                pivots = units(found, kind)
                gaps, found = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0)), []
            out = [], [], []
            if reps:
                square = 2 - 2 * (units(raws, kind) @ pivots.T)
                for k, rep in enumerate(reps):
                    home = int(square[k].argmin())
                    near = square[k, :home] - square[k, home] <= 2 * gaps[home, :home] * radius + slack
                    cells = [home, *np.flatnonzero(near).tolist()]
                    out[0].extend([rep] * len(cells))
                    out[1].extend(cells)
                    out[2].extend([True] + [False] * (len(cells) - 1))
            names = ["rep", "label", "cell", "home"]
            batch = pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array([at and at[0]] * len(out[0]), pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.bool_())], names=names)
            reps.clear()
            raws.clear()
            return batch

        for batch in batches:
            for label, part, rep, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (label, part) != at:
                    yield flush()
                    at = label, part
                if rep is None:
                    found.append(raw)
                else:
                    reps.append(rep)
                    raws.append(raw)
                    if len(reps) >= BLOCK:
                        yield flush()
        yield flush()

    return run


def forest(link: np.ndarray) -> list[tuple[int, int]]:
    """Links that span the components of a symmetric matrix."""
    out, fresh = [], np.ones(len(link), bool)
    for start in np.flatnonzero(link.any(axis=1)).tolist():
        stack = [start] if fresh[start] else []
        fresh[start] = False
        while stack:
            x = stack.pop()
            found = np.flatnonzero(link[x] & fresh)
            fresh[found] = False
            stack += found.tolist()
            out += [(x, y) for y in found.tolist()]
    return out


def _join(cosine: float, kind: str):
    """Rows sorted by tile: (tile, rep, n, side, home, raw); side 0: one block against itself, 1 and 2: two blocks."""

    def tile(rows: list[tuple]) -> tuple[list[int], list[int], list[int]]:
        rep, n, side, home = (np.array([r[k] for r in rows]) for k in (1, 2, 3, 4))
        unit = units([r[5] for r in rows], kind)
        link = np.zeros((len(rows), len(rows)), bool)
        if side[0] == 0:
            link[:] = unit @ unit.T >= cosine
            link[np.diag_indices(len(rows))] = False
        else:
            left, right = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
            hit = unit[left] @ unit[right].T >= cosine
            link[np.ix_(left, right)] = hit
            link[np.ix_(right, left)] = hit.T
        # Two copies meet in the home cell of one of them.
        link &= home[:, None] | home[None, :]
        count = link @ n
        linked = np.flatnonzero(count)
        pairs = forest(link)
        kinds = [0] * len(linked) + [1] * len(pairs)
        return kinds, [*rep[linked].tolist(), *(int(rep[a]) for a, _ in pairs)], [*count[linked].tolist(), *(int(rep[b]) for _, b in pairs)]

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array(found[0], pa.int32()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.int64())], names=["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != at:
                    if len(rows) > 1:
                        yield batch_of(tile(rows))
                    at, rows = row[0], []
                rows.append(row)
        yield batch_of(tile(rows) if len(rows) > 1 else ([], [], []))

    return run


def _packed(wide: bool):
    """(row, label, vector) -> the vector's numbers as bytes, negative zeros as zeros."""
    kind = np.float64 if wide else np.float32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = np.asarray(lists.flatten(), kind) + kind(0)
            ends = np.cumsum([0, *(len(x) for x in lists)])
            raw = [flat[a:b].tobytes() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["_row", "label", "raw"])

    return run


def pivot_count(size: Column) -> Column:
    """How many pivots a label of ``size`` different vectors has, about: half the root."""
    return F.ceil(F.sqrt(size) / 2)


def vector_links(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Links and groups of ``vectors`` (vec_id long, embedding array of numbers, label; more columns are ignored).

    Vectors of equal, non-null labels are linked if their cosine in double precision
    is at least ``cosine``. Null vectors, zero vectors and vectors with null or
    non-finite components link with nothing; neither do vectors of different length.
    Returns a row for each row: vec_id, n_links (other vectors linked directly),
    component_id (least vec_id reachable), kept. Rows of null or repeated vec_id are
    vectors of their own: they link like all others, component_id is the least id
    that is given in the group (null if none is), and one row of a group is kept.
    An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ws = Workspace(spark, "vectors")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wide = vectors.schema["embedding"].dataType.simpleString() != "array<float>"
    kind = "<f8" if wide else "<f4"
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>" if wide else "array<float>").alias("v"), F.col("label").cast("string").alias("label"))
    plain, unique = with_rows(ws, plain, "vec_id")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = plain.where(F.col("label").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    # Vectors of one label and one length meet each other.
    usable = usable.select("_row", F.concat_ws("/", "label", F.size("v")).alias("label"), "v").mapInArrow(lean(_packed(wide)), "_row long, label string, raw binary")
    # Equal vectors of a label are one.
    usable = usable.withColumn("same", F.sha2("raw", 256))
    groups = ws.table(usable.groupBy("label", "same").agg(F.min("_row").alias("rep"), F.count("*").alias("n"), F.min("raw").alias("raw")), "groups")
    member = usable.select("_row", "label", "same").join(groups.select("label", "same", "rep", "n"), ["label", "same"]).select("_row", "rep", "n")

    sizes = ws.table(groups.groupBy("label").agg(F.count("*").alias("size"), F.min("rep").alias("least")), "sizes")
    sized = groups.select("label", "rep", "raw").join(sizes, "label")
    drawn = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < pivot_count(F.col("size")) / F.col("size") * (1 << 30)
    parts = F.ceil(F.col("size") / PART).cast("int")
    pivots = sized.where(drawn | (F.col("rep") == F.col("least"))).select("label", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(None).cast("long").alias("rep"), "raw")
    parted = sized.select("label", F.pmod(F.xxhash64("rep", F.lit(1)), parts).cast("int").alias("part"), "rep", "raw")
    dealt = pivots.unionByName(parted).repartition(n, "label", "part").sortWithinPartitions("label", "part", F.col("rep").asc_nulls_first(), "raw")
    radius = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    cells = ws.table(dealt.mapInArrow(lean(_assign(radius, kind)), CELLS), "cells")

    place = ["label", "cell"]
    count = ws.table(cells.groupBy(*place).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "counts")
    spread = cells.join(count, place).withColumn("t", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    side = F.when(F.col("t") == F.col("o"), 0).when(F.col("t") < F.col("o"), 1).otherwise(2)
    spread = spread.select(F.concat_ws("/", "label", "cell", F.least("t", "o"), F.greatest("t", "o")).alias("tile"), "rep", side.alias("side"), "home")
    tiles = spread.join(groups.select("rep", "n", "raw"), "rep").select("tile", "rep", "n", "side", "home", "raw")
    found = ws.table(tiles.repartition(n, "tile").sortWithinPartitions("tile").mapInArrow(lean(_join(cosine, kind)), FOUND), "found")
    links = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("links"))
    comp = connected_components(ws, found.where("kind = 1").select(F.col("a").alias("u"), F.col("b").alias("v")))
    joined = member.join(links, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    joined = joined.select("_row", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    out = plain.select("_row", "vec_id").join(joined, "_row", "left").select("_row", "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "_row").alias("component"))
    return named_components(ws, out, "vec_id", unique).select("vec_id", "n_links", "component_id", "kept")
