"""The shared working folder, written tables and Arrow helpers of the operators."""

from __future__ import annotations

import atexit
import ctypes
import json
import shutil
import urllib.parse
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.session import shared_root


class Workspace:
    """Tables written to the shared folder, so that lost executors cost no lineage.

    ``table`` writes a DataFrame as Parquet and reads it again; ``drop`` deletes a
    table that nothing refers to any more; the rest goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/linkloom/{name}-{uuid.uuid4().hex[:12]}"
        self.count = 0
        atexit.register(self._end)

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._linkloom_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_linkloom_path", None)
        if path:
            self._delete(path)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

    def _end(self) -> None:
        """At the driver's end; a session that has been stopped leaves only local folders to delete."""
        if self.root.startswith("file:"):
            shutil.rmtree(urllib.parse.urlparse(self.root).path, ignore_errors=True)
        elif self.spark.sparkContext._jsc is not None:
            self._delete(self.root)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_rows(ws: Workspace, df: DataFrame, key: str, name: str = "_row") -> tuple[DataFrame, bool]:
    """``df`` with column ``name``, a long that is unique and not null, and whether it is the key itself.

    It is where every key is given and no two are equal. Elsewhere rows are numbered and written once,
    so that every pass over them sees the same numbers.
    """
    odd = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n")).where("k is null or n > 1")
    if odd.isEmpty():
        return df.withColumn(name, F.col(key).cast("long")), True
    return ws.table(df.withColumn(name, F.monotonically_increasing_id()), "rows"), False


def named_components(ws: Workspace, rows: DataFrame, key: str, plain: bool) -> DataFrame:
    """``rows`` (_row, ``key``, component: the least _row of the group) with component_id and kept.

    component_id is the least ``key`` of the group, null if none has one; kept is the row that has it, the
    first of several.
    """
    if plain:
        return rows.withColumn("component_id", F.col("component")).withColumn("kept", F.col("_row") == F.col("component"))
    first = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("_row").alias("first")))
    heads = ws.table(rows.groupBy("component").agg(first.alias("f")).select("component", F.col("f.key").alias("component_id"), F.col("f.first").alias("_first")), "heads")
    return rows.join(heads, "component").withColumn("kept", F.col("_row") == F.col("_first")).drop("_first")


def filesystem(uri: str):
    """(pyarrow filesystem, path) for a shared folder; works in any executor."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_small(uri: str, payload: dict) -> None:
    """Write JSON under a temporary name, then rename."""
    store, path = filesystem(uri)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(part) as f:
        f.write(json.dumps(payload, sort_keys=True).encode())
    store.move(part, path)


def read_small(uri: str) -> dict:
    store, path = filesystem(uri)
    with store.open_input_stream(path, compression=None) as f:
        return json.loads(f.read())


def lean(run):
    """``run``, a function of Arrow batches, after which the worker gives back what it freed: workers outlive their tasks."""

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return trimmed


def batch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples."""
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, int64 offsets of n + 1) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo, hi = int(offsets[0]), int(offsets[-1])
    return raw[lo:hi], offsets - lo


def text_chunks(column: pa.Array, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of whole rows of about ``limit`` bytes."""
    data, offsets = text_buffer(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
