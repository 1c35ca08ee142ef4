"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Workspace


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """What tells one set of links from another: their number and a sum of hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(u, v) links of long ids -> (id, component), component the least id reached.

    Every node of a link is returned; self links and repeated links do no harm and
    an empty table gives an empty one. Each node's minimum is an aggregate with a
    map-side part and the join back may be split by the skew rule, so that a node
    with very many links is no single task. Each round is written to the shared
    folder; a round that changes nothing ends the loop.
    """
    cur = ws.table(
        edges.where("u <> v").select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).distinct(),
        "links",
    )
    known = _state(cur)
    while True:
        star = ws.table(_large_star(cur), "large")
        nxt = ws.table(_small_star(star), "small")
        state = _state(nxt)
        ws.drop(star)
        ws.drop(cur)
        cur = nxt
        if state == known:
            break
        known = state
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(cur.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
