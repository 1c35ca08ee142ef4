"""Deterministic choice among rows of one key; the order is explicit, never that of arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranked(df: DataFrame, keys: list, order: list) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_wins(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key. Ranks of 1 are cut before the shuffle, so that a hot key sends one row a task."""
    return _ranked(df, keys, order).where("_rank = 1").drop("_rank")


def last_wins(df: DataFrame, keys: list, order: list) -> DataFrame:
    return first_wins(df, keys, [F.desc(o) if isinstance(o, str) else o.desc() for o in order])


def repeats(df: DataFrame, keys: list, order: list) -> DataFrame:
    """``df`` with is_repeat: true for the second and later rows of a key."""
    return _ranked(df, keys, order).withColumn("is_repeat", F.col("_rank") > 1).drop("_rank")


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """``df`` with ``name``, 1, 2, ... by the distinct values of ``order``: sorted by range, numbered in each range, and
    the sizes of the ranges before it added. One size for each partition comes to the driver; a lost range is made anew
    from the written keys."""
    from pyspark.sql import functions as F

    from linkloom.session import scratch

    spark = df.sparkSession
    path = scratch(spark, "numbered")
    df.select(order).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    keys = spark.read.parquet(path)
    sizes, base, rows = {r["_range"]: r["n"] for r in keys.groupBy("_range").agg(F.count("*").alias("n")).collect()}, 0, []
    for k in sorted(sizes):
        rows.append((k, base))
        base += sizes[k]
    bases = spark.createDataFrame(rows, "_range int, _base long")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(order)) + F.col("_base")
    keys = keys.join(F.broadcast(bases), "_range").select(order, place.cast("long").alias(name))
    return df.join(keys, order)


def joined_set(x: Column) -> Column:
    """Sorted distinct values of a group as a | list."""
    return F.array_join(F.array_sort(F.collect_set(x)), "|")


def top_k_or_threshold(df: DataFrame, group: list, order: list, score: str, k: int, threshold: float) -> DataFrame:
    """Rows of rank <= k of each group and all rows from ``threshold`` on; adds retrieval_rank and group_size."""
    w = Window.partitionBy(*group)
    out = df.withColumn("retrieval_rank", F.row_number().over(w.orderBy(*order))).withColumn("group_size", F.count("*").over(w))
    return out.where((F.col("retrieval_rank") <= k) | (F.col(score) >= threshold))
