"""Text sources that one task could not share: block-compressed gzip, and tables whose quoted cells hold line ends.

A file is cut into ranges of bytes, each read by a task of its own. A range owns the lines (records) that
begin after its first byte and up to the first byte behind it: it skips what the range before it completes, and
reads on behind its end until its last one is whole.

Block gzip is a row of gzip members of at most 64 KB, each of which tells its own size, so that a reader finds
the next one from anywhere. In a quoted table a line end counts only outside quotes. Whether a range begins inside
is the parity of the quotes before it: ranges are counted first, and their parities composed in order.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from linkloom.sources.files import created, files, opened, renamed

#: Bytes of a range; of a file's header; rows of a batch.
RANGE = 32 << 20
MAGIC = b"\x1f\x8b\x08\x04"
ROWS = 8192
#: A member's most data, and the member that ends a file (fixed values: the format).
BLOCK = 0xFF00
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def member_size(head: bytes) -> int | None:
    """The size of the gzip member that ``head`` begins, from its extra field, or None where it is no such member."""
    if len(head) < 18 or not head.startswith(MAGIC):
        return None
    length = struct.unpack_from("<H", head, 10)[0]
    at, end = 12, 12 + length
    while at + 4 <= min(end, len(head)):
        kind, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if kind == b"BC" and size == 2:
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return None


def _first_member(f, low: int, size: int) -> int:
    """Where the first member at or after ``low`` begins: its size must lead to another one, or to the file's end."""
    f.seek(low)
    data = f.read(min(size - low, 1 << 17))
    at = data.find(MAGIC)
    while at >= 0:
        own = member_size(data[at : at + 64])
        if own is not None:
            f.seek(low + at + own)
            if low + at + own == size or member_size(f.read(64)) is not None:
                return low + at
        at = data.find(MAGIC, at + 1)
    return size


def _members(f, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, data) of the members from ``at`` on."""
    held, place = b"", at
    f.seek(at)
    while place < size:
        own = member_size(held[:64])
        while own is None or len(held) < own:
            more = f.read(1 << 20)
            if not more:
                raise ValueError(f"a block at {place} is cut off")
            held += more
            own = member_size(held[:64])
            if own is None and len(held) >= 64:
                raise ValueError(f"no block at {place}")
        yield place, zlib.decompress(held[:own], 31)
        held, place = held[own:], place + own


def range_lines(f, low: int, high: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that a range owns; a place is the block's place in the file and the line's in the block."""
    begin = 0 if low == 0 else _first_member(f, low, size)
    if begin >= min(high, size):
        return
    skip, kept, at = low > 0, b"", None
    for place, data in _members(f, begin, size):
        pieces = data.split(b"\n")
        offset = 0
        for piece in pieces[:-1]:
            line = kept + piece
            if skip:
                skip = False
            else:
                yield (place << 16 | offset) if at is None else at, line
            kept, at = b"", None
            offset += len(piece) + 1
            if place >= high:
                return
        if pieces[-1]:
            at = (place << 16 | offset) if at is None else at
            kept += pieces[-1]
    if kept and not skip:
        yield at, kept


class BlockLines(DataSource):
    """Lines of block-gzip files: file, line (its place), value. Option files: JSON of (path, length) pairs; range: bytes of a range."""

    @classmethod
    def name(cls) -> str:
        return "block_gzip_lines"

    def schema(self) -> str:
        return "file string, line long, value string"

    def reader(self, schema) -> DataSourceReader:
        return _BlockReader(json.loads(self.options["files"]), int(self.options.get("range", RANGE)))


class _Range(InputPartition):
    def __init__(self, path: str, low: int, high: int, size: int):
        super().__init__((path, low, high, size))


class _BlockReader(DataSourceReader):
    def __init__(self, files: list, size: int):
        self.files, self.size = files, size

    def partitions(self) -> list[InputPartition]:
        return [_Range(path, low, min(low + self.size, length), length) for path, length in self.files for low in range(0, length, self.size)] or [_Range("", 0, 0, 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, low, high, size = partition.value
        if not size:
            return
        places, lines = [], []

        def batch() -> pa.RecordBatch:
            text = [x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines]
            return pa.RecordBatch.from_arrays([pa.array([path] * len(lines)), pa.array(places, pa.int64()), pa.array(text, pa.string())], names=["file", "line", "value"])

        with opened(path) as f:
            for place, line in range_lines(f, low, high, size):
                places.append(place)
                lines.append(line)
                if len(lines) == ROWS:
                    yield batch()
                    places, lines = [], []
        if lines:
            yield batch()


def _kinds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path in batch["path"]:
            with opened(path) as f:
                found.append(member_size(f.read(64)) is not None)
        yield batch.assign(blocks=found)


def gzip_lines(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """file, line and value of .gz files. Block gzip is read by ranges; a plain one is one task for each file, dealt out afterwards.

    A line is what "\\n" ends; a "\\r" before it is cut.
    """
    found = files(spark, path).mapInPandas(_kinds, "path string, length long, blocks boolean").orderBy("path").collect()  # a line for each file
    blocks, plain = [[r["path"], r["length"]] for r in found if r["blocks"]], [r["path"] for r in found if not r["blocks"]]
    out = None
    if blocks or not plain:
        spark.dataSource.register(BlockLines)
        out = spark.read.format(BlockLines.name()).option("files", json.dumps(blocks)).option("range", str(size)).load()
    if plain:
        place = [F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line")]
        lines = spark.read.text(plain).select(*place, F.regexp_replace("value", "\r$", "").alias("value"))
        if sum(r["length"] for r in found if not r["blocks"]) > size:
            lines = lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        out = lines if out is None else out.unionByName(lines)
    return out


def compressed(data: bytes) -> bytes:
    """``data`` as members of block gzip, without the file's end."""
    out = []
    for at in range(0, len(data), BLOCK):
        piece = data[at : at + BLOCK]
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(piece) + packer.flush()
        out.append(MAGIC + bytes(4) + b"\x00\xff" + struct.pack("<H2sHH", 6, b"BC", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(piece), len(piece)))
    return b"".join(out)


def _packed(root: str, suffix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name, held, rows, sink = f"{root}/part-{TaskContext.get().partitionId():05d}{suffix}", bytearray(), 0, None
        part = f"{root}/_{uuid.uuid4().hex}"
        for batch in batches:
            for value in batch.column(0).to_pylist():
                held += (value or "").encode() + b"\n"
                rows += 1
            if sink is None:
                sink = created(part)
            whole = len(held) // BLOCK * BLOCK
            sink.write(compressed(bytes(held[:whole])))
            del held[:whole]
        if sink is None:
            return
        sink.write(compressed(bytes(held)) + END)
        sink.close()
        renamed(part, name)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows], pa.int64())], names=["file", "rows"])

    return run


def write_block_gzip(df: DataFrame, path: str, suffix: str = ".gz") -> int:
    """The one text column of ``df`` as lines of block-gzip files, one for each partition, in its order, under temporary names first; the rows written."""
    done = df.mapInArrow(_packed(path, suffix), "file string, rows long")
    return done.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


# --- quoted tables ----------------------------------------------------------------------------

_CUT = re.compile(b"\r\n|\n|\r")


def _edge(f, at: int, size: int) -> int:
    """``at`` moved behind a run of quotes, so that no pair of them is cut."""
    f.seek(at)
    while at < size and f.read(1) == b'"':
        at += 1
    return at


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ranges with their true edges and whether they have an odd number of quotes."""
    for batch in batches:
        rows = []
        for path, low, high, size, start in batch[["path", "low", "high", "size", "start"]].itertuples(index=False):
            with opened(path) as f:
                begin, end = _edge(f, low, size) if low > start else start, _edge(f, high, size)
                f.seek(begin)
                left, quotes = end - begin, 0
                while left > 0 and (data := f.read(min(left, 1 << 20))):
                    quotes += data.count(b'"')
                    left -= len(data)
            rows.append((begin, max(begin, end), quotes % 2))
        edges = pd.DataFrame(rows, columns=["begin", "end", "odd"])
        yield pd.concat([batch.reset_index(drop=True), edges], axis=1)


def records(data: bytes, sep: bytes, quoted: bool) -> Iterator[tuple[int, list[bytes], bool]]:
    """(end, cells, whole) of the records of ``data``, read from inside quotes or outside: where each ends; the last may not be whole.

    A quote changes the state wherever it stands, and two inside quotes are one quote; separators and line ends count outside.
    """
    pieces, cells, cell = data.split(b'"'), [], []
    at, i = 0, 0
    while i < len(pieces):
        piece = pieces[i]
        if quoted:
            cell.append(piece)
            at += len(piece)
            if i + 2 < len(pieces) and not pieces[i + 1]:
                cell.append(b'"')
                at += 2
                i += 2
                continue
        else:
            begin = 0
            for cut in _CUT.finditer(piece):
                first, *rest = piece[begin : cut.start()].split(sep)
                cells += [b"".join([*cell, first]), *rest]
                cell = []
                yield at + cut.end(), cells, True
                cells, begin = [], cut.end()
            first, *rest = piece[begin:].split(sep)
            if rest:
                cells += [b"".join([*cell, first]), *rest[:-1]]
                cell = [rest[-1]]
            else:
                cell.append(first)
            at += len(piece)
        quoted = not quoted
        at += 1
        i += 1
    last = b"".join(cell)
    if last or cells:
        yield len(data), [*cells, last], False


def _read_range(f, sep: bytes, begin: int, end: int, size: int, quoted: bool, start: int = 0) -> Iterator[tuple[int, list[bytes]]]:
    """(place, cells) of the records that a range owns; the table begins at ``start``. The range is held whole, with as much behind it as its last record needs."""
    f.seek(begin)
    data = f.read(end - begin)
    reach = end
    while True:
        found, last_end, done = [], begin if begin == start else None, False
        for stop, cells, whole in records(data, sep, quoted):
            if not whole and reach < size:
                break
            if last_end is not None:
                found.append((last_end, cells))
            last_end = begin + stop
            if last_end > end or (last_end == size):
                done = True
                break
        if done or reach >= size:
            break
        more = f.read(max(1 << 20, len(data)))
        data, reach = data + more, reach + len(more)
        # A line end of two bytes and a pair of quotes are not cut at the reach.
        while reach < size and data[-1:] in b'"\r':
            one = f.read(1)
            data, reach = data + one, reach + 1
    yield from ((place, cells) for place, cells in found if place <= end)


def _parsed(sep: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, begin, end, size, quoted, start in batch[["path", "begin", "end", "size", "quoted", "start"]].itertuples(index=False):
                if begin >= size:
                    continue
                rows: list[tuple[int, list[str]]] = []
                with opened(path) as f:
                    for place, cells in _read_range(f, sep.encode(), begin, end, size, bool(quoted), start):
                        if any(cells):
                            rows.append((place, [c.decode("utf-8", "replace") for c in cells]))
                for at in range(0, len(rows), ROWS):
                    part = rows[at : at + ROWS]
                    yield pd.DataFrame({"file": path, "line": [p for p, _ in part], "first": [p == start for p, _ in part], "cells": [c for _, c in part]})

    return run


def _begun(marker: str):
    """Files with the place where the first line that ``marker`` matches begins; those without one have no table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = re.compile(marker.encode())
        for batch in batches:
            starts = []
            for path in batch["path"]:
                with opened(path) as f:
                    at, kept, found = 0, b"", None
                    while found is None and (data := f.read(1 << 16)):
                        *lines, kept = (kept + data).split(b"\n")
                        for line in lines:
                            if wanted.match(line.removeprefix(b"\xef\xbb\xbf")):
                                found = at
                                break
                            at += len(line) + 1
                    starts.append(at if found is None and wanted.match(kept) else found)
            yield batch.assign(start=pd.array(starts, "Int64"))

    return run


def quoted_rows(spark: SparkSession, path: str, sep: str = "\t", size: int = RANGE, marker: str = "") -> DataFrame:
    """file, line (place of the record), first (of its file) and cells of quoted tables, read by ranges of ``size`` bytes; records of
    empty cells are left out. With ``marker``, a table begins at the first line that it matches; quotes before do not count."""
    some = files(spark, path).where("length > 0").select("path", F.col("length").alias("size"))
    if marker:
        some = some.mapInPandas(_begun(marker), "path string, size long, start long").where("start is not null")
    else:
        some = some.withColumn("start", F.lit(0).cast("long"))
    some = some.select("path", "size", "start", F.explode(F.sequence(F.col("start"), F.col("size") - 1, F.lit(size).cast("long"))).alias("low")).withColumn("high", F.least(F.col("low") + size, F.col("size")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = some.repartition(n, "path", "low").mapInPandas(_counted, "path string, size long, start long, low long, high long, begin long, end long, odd int")
    before = F.coalesce(F.sum("odd").over(Window.partitionBy("path").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    states = counted.withColumn("quoted", before % 2 == 1)
    return states.repartition(n, "path", "low").mapInPandas(_parsed(sep), "file string, line long, first boolean, cells array<string>")
