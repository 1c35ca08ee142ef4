"""Scores of all pairs of two sides within a key, by tiles of matrices; only what is kept leaves a task.

The rows of a key are dealt to tiles by a hash of their id, so that a tile holds about ``rows``
of them whatever the key's size; a left row meets every right tile of its key and the other way
round. A task multiplies the two matrices of a tile pair and returns, for each left row, the
pairs at or above a threshold and its k best ones. A pair of rank r <= k is among the k best of
its tile, and so are all that are better: ranks among the returned rows are ranks among all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.session import scratch

#: Rows of a side in a tile; two of them and their scores are in memory at a time.
ROWS = 2048
#: Scores may leave [-1, 1] by so much, and differ by so much from an independent sum.
SLACK = 1e-5


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column in double precision; all must have one length."""
    if vectors.null_count:
        raise ValueError("a vector is null")
    flat, lengths = vectors.flatten(), pc.min_max(pc.list_value_length(vectors))
    if flat.null_count or lengths["min"] != lengths["max"]:
        raise ValueError("vectors differ in length or hold nulls")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def scored(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot products, held to [-1, 1]; non-finite ones, ones out of range, and a matrix product that an independent sum contradicts raise."""
    if left.shape[1] != right.shape[1]:
        raise ValueError("vectors differ in length")
    with np.errstate(all="ignore"):
        raw = left @ right.T
    if not np.isfinite(raw).all() or np.abs(raw).max() > 1 + SLACK:
        raise ValueError("a score is no cosine of unit vectors")
    for i, j in {(0, 0), (len(left) - 1, len(right) - 1), divmod(int(raw.argmax()), len(right))}:
        if abs(raw[i, j] - float(np.sum(left[i] * right[j]))) > SLACK:
            raise ValueError("a matrix product differs from the sum of its terms")
    return np.clip(raw, -1.0, 1.0)


def kept(scores: np.ndarray, k: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, rank from 1) of what each row keeps: its ``k`` largest, the first columns among equals, and all from ``threshold`` on."""
    n = scores.shape[1]
    least = np.partition(scores, n - k, axis=1)[:, n - k] if 0 < k < n else np.full(len(scores), -np.inf if k else np.inf)
    row, column = np.nonzero(scores >= np.minimum(least, threshold)[:, None])
    value = scores[row, column]
    order = np.lexsort((column, -value, row))
    row, column, value = row[order], column[order], value[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
    keep = (rank <= k) | (value >= threshold)
    return row[keep], column[keep], rank[keep]


def _tile(k: int, threshold: float):
    """Rows of tiles, in order, to kept pairs; rows of a tile follow each other, left ones (side 0) first."""

    def answer(rows: pa.Table) -> pa.RecordBatch | None:
        side = rows["side"].to_numpy()
        cut = int(np.searchsorted(side, 1))
        if cut == 0 or cut == len(side):
            return None
        left, right = rows.slice(0, cut), rows.slice(cut)
        scores = scored(*(_matrix(x["embedding"].combine_chunks()) for x in (left, right)))
        row, column, rank = kept(scores, k, threshold)
        take = lambda t, c, i: t[c].combine_chunks().take(pa.array(i))
        one = rows["tiles"][0].as_py() == 1
        columns = [take(left, "gene", row), take(left, "id", row), take(right, "id", column), pa.array(scores[row, column]), pa.array(rank.astype(np.int32)), take(left, "size", row), pa.array([one] * len(row), pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, names=["gene", "left_id", "right_id", "score", "retrieval_rank", "group_size", "whole"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not len(b):
                continue
            keys = [b.column(i) for i in range(3)]
            change = np.zeros(len(b), bool)
            for key in keys:
                change[1:] |= pc.not_equal(key.slice(1), key.slice(0, len(b) - 1)).to_numpy(zero_copy_only=False)
            edges = [0, *np.flatnonzero(change).tolist(), len(b)]
            for begin, end in zip(edges[:-1], edges[1:]):
                part = b.slice(begin, end - begin)
                if held and any(held[-1].column(i)[0] != part.column(i)[0] for i in range(3)):
                    if (out := answer(pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                held.append(part)
        if held and (out := answer(pa.Table.from_batches(held))) is not None:
            yield out

    return run


def _scored_tiles(left: DataFrame, right: DataFrame, k: int, threshold: float, rows: int) -> DataFrame:
    """What the tile pairs keep, with ranks within a tile; whole says that the tile has all right rows of the gene."""
    spark = left.sparkSession
    n = left.groupBy("gene").agg(F.count("*").alias("n_left")).join(right.groupBy("gene").agg(F.count("*").alias("size")), "gene")
    path = scratch(spark, "tiles")
    # Written, so that the join below knows its size: vectors are not sent to one task of their gene.
    n.select("gene", F.ceil(F.col("n_left") / rows).cast("int").alias("left_tiles"), F.ceil(F.col("size") / rows).cast("int").alias("tiles"), "size").write.parquet(path)
    genes = spark.read.parquet(path)

    def side(df: DataFrame, number: int, own: str, other: str) -> DataFrame:
        at = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        met = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        i, j = (at, met) if number == 0 else (met, at)
        return df.select("gene", "id", "embedding").join(genes, "gene").select("gene", i.alias("i"), j.alias("j"), F.lit(number).alias("side"), "id", "embedding", "tiles", "size")

    both = side(left, 0, "left_tiles", "tiles").unionByName(side(right, 1, "tiles", "left_tiles"))
    tiles = both.repartition("gene", "i", "j").sortWithinPartitions("gene", "i", "j", "side", "id")
    kind = {c: left.schema[c].dataType.simpleString() for c in ("gene", "id")}
    return tiles.mapInArrow(_tile(k, threshold), f"gene {kind['gene']}, left_id {kind['id']}, right_id {right.schema['id'].dataType.simpleString()}, score double, retrieval_rank int, group_size long, whole boolean")


#: Rows of a side in a tile that returns every pair.
ALL_ROWS = 512


def pairs_from(left: DataFrame, right: DataFrame, threshold: float = -1.0, rows: int = ALL_ROWS) -> DataFrame:
    """gene, left_id, right_id and score of all pairs within a gene from ``threshold`` on; without one, of every pair. No ranks are made, so that nothing is sorted or written."""
    return _scored_tiles(left, right, 0, threshold, rows).select("gene", "left_id", "right_id", "score")


def best_pairs(left: DataFrame, right: DataFrame, k: int, threshold: float, rows: int = ROWS) -> DataFrame:
    """gene, left_id, right_id, score, retrieval_rank and group_size of the pairs within a gene that have rank <= ``k`` for their
    left row (by score, then right_id), or a score from ``threshold`` on.

    Both sides have gene, id (unique in the gene), embedding (unit vectors of one length). group_size is the number
    of right rows of the gene. Rows without a gene meet nothing. A null vector, a non-finite score or one beyond
    1 raises. Genes with one right tile are ranked in their task; the rest are ranked over what their tiles returned.
    """
    spark = left.sparkSession
    path = scratch(spark, "pairs")
    found = _scored_tiles(left, right, k, threshold, rows)
    # Written once: whole genes are done, the others' tiles are merged.
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    rank = F.row_number().over(Window.partitionBy("gene", "left_id").orderBy(F.desc("score"), "right_id"))
    merged = found.where("not whole").withColumn("retrieval_rank", rank).where((F.col("retrieval_rank") <= k) | (F.col("score") >= threshold))
    return found.where("whole").unionByName(merged).drop("whole")
