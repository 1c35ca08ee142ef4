"""Sharded WARC archives: a deterministic writer with deduplicated payloads, and a reader.

Prefix sums of payload bytes in the order of page_id cut the pages into shards, so
that the table alone says where a shard begins: neither its partitioning nor what
ran before does. A task writes whole shards and rolls to the next file of a shard
when the compressed size reaches the limit. Every record is its own gzip member
whose headers and digests are made from the payload, with fixed ids and dates: the
same table gives the same files, byte for byte. Files are written under temporary
names and renamed by their task; the manifest, a table of the files that Spark
commits at last, says which count. A task that runs twice makes the same files, and
what a lost one left goes with the temporary folder.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from .shared import Workspace, filesystem, lean

DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "name string, records long, bytes long, sha256 string"
ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
#: Compressed bytes after which a file is closed.
ROLL = 64 << 20
#: Payload bytes of a shard at least, and the most shards: the first page of each goes to every task.
SHARD_BYTES, MOST_SHARDS = 1 << 20, 1 << 16


def sha1_base32(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(page: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page}')}>"


def _clean(url: str | None, page: int) -> str:
    """One header line: line ends and other control characters are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page}"


def record(page: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """A response, or a revisit of ``refers_to`` that has the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page),
        "WARC-Date": date,
        "WARC-Target-URI": _clean(url, page),
        "WARC-Page-ID": str(page),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{sha1_base32(block)}",
    }
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to), "WARC-Refers-To-Page-ID": str(refers_to)}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(raw: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def _write(root: str, least: int, roll: int, date: str):
    """Rows sorted by (shard, page_id, kind): (shard, page_id, kind, url, html, sha, ref) -> a line for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = filesystem(root)
        task, shard, part, sink, done = uuid.uuid4().hex, None, 0, None, []
        page, refs, count, size, digest = None, {}, 0, 0, None

        def close():
            nonlocal sink, part
            if sink is not None:
                sink.close()
                name = f"pages-{shard:05d}-{part:05d}.warc.gz"
                store.move(temporary, f"{path}/{name}")
                done.append((name, count, size, digest.hexdigest()))
                sink, part = None, part + 1

        for batch in batches:
            for where, page_id, kind, url, html, sha, ref in zip(*(batch.column(i) for i in range(7))):
                where, page_id, kind = where.as_py(), page_id.as_py(), kind.as_py()
                if where != shard:
                    close()
                    shard, part = where, 0
                if page_id != page:
                    page, refs = page_id, {}
                if kind == 0:
                    # What this page's payload, known by its digest, refers to; none: it is the response itself.
                    refs[sha.as_py()] = ref.as_py()
                    continue
                payload = (html.as_py() or "").encode()
                hexed = hashlib.sha1(payload).hexdigest()
                target = refs.get(hexed)
                if target is None and len(payload) >= least:
                    refs[hexed] = page  # a repeated row of the response revisits it
                raw = _member(record(page, url.as_py(), payload, base64.b32encode(bytes.fromhex(hexed)).decode(), target, date))
                if sink is not None and size >= roll:
                    close()
                if sink is None:
                    temporary = f"{path}/_temporary/{task}-{shard}-{part}"
                    sink, digest, count, size = store.open_output_stream(temporary, compression=None), hashlib.sha256(), 0, 0
                sink.write(raw)
                digest.update(raw)
                count += 1
                size += len(raw)
        close()
        cols = list(zip(*done)) or [()] * 4
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["name", "records", "bytes", "sha256"])

    return run


def shard_heads(sizes: DataFrame, least: int = SHARD_BYTES, most: int = MOST_SHARDS) -> list[int]:
    """The first page_id of each shard of ``sizes`` (page_id, size), ascending; a page's rows share a shard.

    A shard begins with the page in which the prefix sum of bytes passes a multiple of
    the shard size, ``least`` or a ``most``-th of all. Sums of ranges of pages, one for
    each partition, meet in the driver; so do the heads.
    """
    ws = Workspace(sizes.sparkSession, "shards")
    n = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = sizes.groupBy("page_id").agg(F.sum("size").alias("size")).repartitionByRange(n, "page_id")
    # Written with its range, as another run may sample other ranges; sums over them are the same.
    ranged = ws.table(ranged.withColumn("range", F.spark_partition_id()), "ranged")
    sums = sorted((r["least"], r["range"], r["size"]) for r in ranged.groupBy("range").agg(F.min("page_id").alias("least"), F.sum("size").alias("size")).collect())
    total = sum(s for _, _, s in sums)
    step = max(least, -(-total // most))
    bases = np.cumsum([0, *(s for _, _, s in sums)])[:-1].tolist()
    base = sizes.sparkSession.createDataFrame([(r, b) for (_, r, _), b in zip(sums, bases)], "range int, base long")
    before = F.col("base") + F.sum("size").over(Window.partitionBy("range").orderBy("page_id")) - F.col("size")
    shards = ranged.join(F.broadcast(base), "range").select("page_id", F.floor(before / step).alias("shard"))
    heads = sorted(r["head"] for r in shards.groupBy("shard").agg(F.min("page_id").alias("head")).collect())
    ws.drop(ranged)
    return heads


def write_archives(pages: DataFrame, root: str, least: int = 0, roll: int = ROLL, date: str = DATE, shard: int = SHARD_BYTES) -> DataFrame:
    """Write ``pages`` (page_id long, url string, html string; more columns are ignored) under ``root``; returns the manifest: name, records, bytes and sha256 of each file.

    Of records with equal payloads of at least ``least`` bytes, that with the largest
    page_id is the response and the others revisit it; smaller payloads are all
    responses. A null html is an empty payload, a null url becomes urn:page:N;
    rows without page_id are left out; repeated rows of the response revisit it. An empty
    table gives a manifest without files. The payload crosses the network once: the
    references, made from digests only, are sorted in beside it.
    """
    spark = pages.sparkSession
    store, path = filesystem(root)
    store.create_dir(f"{path}/_temporary", recursive=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).where("page_id is not null")
    ws = Workspace(spark, "payloads")
    digests = ws.table(rows.select("page_id", F.sha1(F.encode("html", "UTF-8")).alias("sha"), F.octet_length("html").cast("long").alias("size")), "digests")
    heads = np.array(shard_heads(digests.select("page_id", "size"), shard) or [0], np.int64)

    @pandas_udf("int")
    def place(page):  # only the ids cross to Python
        return page.map(lambda p: max(int(np.searchsorted(heads, p, "right")) - 1, 0)).astype("int32")

    large = digests.where(F.col("size") >= least)
    first = large.groupBy("sha").agg(F.max("page_id").alias("ref"), F.count("*").alias("n")).where("n > 1").select("sha", "ref")
    # Written before the join, so that a payload of very many pages can be split by the skew rule.
    first = ws.table(first, "first")
    refs = large.select("page_id", "sha").join(first, "sha").where("page_id <> ref").distinct()
    refs = refs.select("page_id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "sha", "ref")
    rows = rows.select("page_id", F.lit(1).alias("kind"), "url", "html", F.lit(None).cast("string").alias("sha"), F.lit(None).cast("long").alias("ref"))
    both = rows.unionByName(refs).select(place("page_id").alias("shard"), "*").repartition(n, "shard").sortWithinPartitions("shard", "page_id", "kind", "url", "html", "sha")
    both.mapInArrow(lean(_write(root, least, roll, date)), FILES).write.json(f"{root}/manifest")
    store.delete_dir(f"{path}/_temporary")
    return manifest_of(spark, root)


def manifest_of(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(FILES).json(f"{root}/manifest")


def parse(raw: bytes) -> tuple:
    """(page_id, payload bytes, digest, type, refers_to, url, payload or None) of a record; a wrong digest raises."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(field["Content-Length"])]
    if field["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}":
        raise ValueError(f"block digest of {field['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, digest = field["WARC-Type"], field["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"payload digest of {field['WARC-Record-ID']}")
    ref = field.get("WARC-Refers-To-Page-ID")
    return int(field["WARC-Page-ID"]), size, digest, kind, int(ref) if ref else None, field["WARC-Target-URI"], payload if kind == "response" else None


def members(stream) -> Iterator[bytes]:
    """The content of each gzip member of a file, read in pieces."""
    held = b""
    while True:
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            held = held or stream.read(1 << 20)
            if not held:
                if out:
                    raise ValueError("truncated archive")
                return
            out.append(unpack.decompress(held))
            held = unpack.unused_data
        yield b"".join(out)


def _read(root: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
        width = 7 if payloads else 6

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows))[:width], types)], names=names[:width])

        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, path = filesystem(f"{root}/{name}")
                with store.open_input_stream(path, compression=None) as f:
                    rows, size = [], 0
                    for raw in members(f):
                        rows.append(parse(raw))
                        size += rows[-1][1]
                        if size > 8 << 20 or len(rows) >= 2000:
                            yield batch_of(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch_of(rows)

    return run


def read_archives(spark: SparkSession, root: str, payloads: bool = False) -> DataFrame:
    """A row for each record of the archives that the manifest lists."""
    schema = ROWS if payloads else ROWS.rpartition(",")[0]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest_of(spark, root).select("name").repartition(n, "name").mapInArrow(lean(_read(root, payloads)), schema)


def archive_table(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes the archives of ``pages`` to the shared folder and reads them back."""
    root = Workspace(pages.sparkSession, "warc").path("files")
    write_archives(pages, root, least)
    return read_archives(pages.sparkSession, root)
