"""Scores by tiles against all pairs in plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.operators import tiles
from linkloom.plans import semantic
from linkloom.settings import DEFAULT

SIDE = "gene string, id string, embedding array<float>"


def unit(rng, n, ties):
    v = rng.normal(size=(n, 5))
    if ties and n > 3:
        v[n // 2 :] = v[0]
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def made(rng, sizes, prefix):
    return [(g, f"{prefix}{g}{i:04d}", v.tolist()) for k, (g, n) in enumerate(sizes.items()) for i, v in enumerate(unit(rng, n, k % 2))]


def brute(left, right, k, threshold):
    out = set()
    for g, a, v in left:
        scores = sorted((-float(np.clip(np.dot(np.float64(v), np.float64(w)), -1, 1)), b) for h, b, w in right if h == g and g is not None)
        out |= {(g, a, b, rank, len(scores)) for rank, (s, b) in enumerate(scores, 1) if rank <= k or -s >= threshold}
    return out


@pytest.mark.parametrize("k, threshold", [(3, 0.9), (0, 0.5), (500, 2.0), (2, -1.0)])
def test_equals_all_pairs(spark, k, threshold):
    """Genes of one tile and of many, one with most of the rows, with many equal vectors."""
    rng = np.random.default_rng(3)
    left, right = made(rng, {"a": 4, "b": 60, "c": 9, "only left": 3}, "l"), made(rng, {"a": 5, "b": 40, "c": 1, "only right": 2}, "r")
    left.append((None, "x", left[0][2]))
    right.append((None, "y", left[0][2]))
    got = tiles.best_pairs(spark.createDataFrame(left, SIDE), spark.createDataFrame(right, SIDE), k, threshold, rows=8).collect()
    assert {(r["gene"], r["left_id"], r["right_id"], r["retrieval_rank"], r["group_size"]) for r in got} == brute(left, right, k, threshold) and len(got) == len(brute(left, right, k, threshold))


def test_what_leaves_the_tiles(spark):
    """One gene with half of all rows: its tiles return k a row and tile at most, and each pair is scored in one place."""
    rng = np.random.default_rng(5)
    left, right = (spark.createDataFrame(made(rng, {"hot": 300, "b": 2}, p), SIDE) for p in "lr")
    rows = tiles.best_pairs(left, right, 2, 1.5, rows=50)
    assert rows.count() == 300 * 2 + 2 * 2
    same = semantic.matches(semantic.scored_pairs(left, right), DEFAULT.with_values(top_k=2))
    new = semantic.gene_matches(left, right, DEFAULT.with_values(top_k=2))
    key = lambda df: {(r["gene"], r["left_id"], r["right_id"], round(r["score"], 9), r["retrieval_rank"], r["group_size"], r["cosine_class"]) for r in df.collect()}
    assert key(same) == key(new)


def test_a_tile_keeps_ties_in_order():
    row, column, rank = tiles.kept(np.array([[0.5, 0.9, 0.9, 0.9, 0.1], [0.2, 0.2, 0.2, 0.2, 0.2]]), 2, 0.9)
    assert list(zip(row.tolist(), column.tolist(), rank.tolist())) == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (1, 0, 1), (1, 1, 2)]


@pytest.mark.parametrize("bad", [None, [float("nan")] * 5, [9.0] * 5, [1.0]])
def test_scores_that_are_none(spark, bad):
    right = spark.createDataFrame([("a", "r", [1.0, 0.0, 0.0, 0.0, 0.0]), ("a", "s", bad)], SIDE)
    with pytest.raises(Exception, match="vector|score"):
        tiles.best_pairs(right.withColumn("id", F.concat(F.lit("l"), "id")), right, 1, 0.5).collect()


def test_a_product_that_is_wrong(monkeypatch):
    class Wrong(np.ndarray):
        def __matmul__(self, other):
            return np.asarray(self) @ np.asarray(other) + 1e-3

    with pytest.raises(ValueError, match="differs"):
        tiles.scored(np.eye(3).view(Wrong) * 0.5, np.eye(3))


def test_empty_sides(spark):
    none, one = spark.createDataFrame([], SIDE), spark.createDataFrame([("a", "r", [1.0])], SIDE)
    assert tiles.best_pairs(none, one, 3, 0.5).count() == tiles.best_pairs(one, none, 3, 0.5).count() == 0
