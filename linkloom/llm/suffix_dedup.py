"""Removal of byte spans that repeat anywhere in the corpus, by suffix arrays of anchored contexts.

Every window of ``length`` bytes has one anchor, its least ``gram``-byte hash (the
leftmost of equals), which depends on nothing but the window's bytes. Consecutive
windows with one anchor form a context of fewer than 2 * ``length`` bytes. Equal
windows have equal anchors at equal distances, so only contexts of one anchor hash
can hold them: anchors cut the corpus into independent buckets.

1. Contexts seen more than once repeat as a whole; counting them needs no text, only
   a 128-bit BLAKE2b digest of their bytes.
2. Of a bucket with several different contexts, one copy of each is aligned at the
   anchor and cut where any two of them part (the branches of the sorted contexts);
   equal blocks get equal symbols. The suffix array of these sequences, built by
   grouping, and its common prefixes give, for every left reach, the farthest right
   reach shared with another context, on the bytes themselves.
3. A bucket of very many different contexts is split by the bytes around its anchor.
   The windows whose left reach lies in one range of ``g`` share a core of
   ``length - g + 1`` bytes: each range of a context goes to the bucket of its core,
   and only cores seen twice go on. Every two contexts with an equal window meet in
   the bucket of that window's core, and there the same two steps decide. ``g`` falls
   until the buckets fit; at 1 a bucket is one window, and holds nothing different.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import RangeHash
from .shared import Workspace, lean, text_buffer, with_rows
from .suffix_array import common_prefixes, suffix_array

CHUNK = 1 << 20
#: Longer texts are cut into segments that overlap by one window.
SEGMENT = 1 << 22
#: Different contexts of a bucket that a task may hold; larger buckets are split by the bytes around the anchor,
#: by ranges of so many left reaches.
BUCKET, RANGES = 512, (200, 50, 7, 1)
#: Symbols of buckets that one suffix array covers.
BATCH = 1 << 17

CONTEXTS = "key long, a long, b long, row long, start int, len int, off int"
SLICES = "key long, a long, b long, row long, start int, off int, one boolean, bytes binary"
CORES = "key long, a long, b long, row long, start int, off int, one boolean, core binary, bytes binary"
SPANS = "row long, s int, e int"
_POSITION = np.uint64((1 << 24) - 1)


def _pieces(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """(bytes, [(row, offset in the row, begin, end in bytes)]) of whole texts, or of segments of long ones."""
    data, offsets = text_buffer(column)
    todo, size, base = [], 0, 0
    for row, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if hi - lo < length:
            continue
        for at in range(lo, max(lo + 1, hi - length + 1), SEGMENT):
            end = min(hi, at + SEGMENT + length - 1)
            todo.append((row, at - lo, at, end))
            size += end - at
            if size >= CHUNK:
                yield _joined(data, todo)
                todo, size = [], 0
    if todo:
        yield _joined(data, todo)


def _joined(data, todo):
    out, parts, at = [], [], 0
    for row, off, lo, hi in todo:
        parts.append(data[lo:hi])
        out.append((row, off, at, at + hi - lo))
        at += hi - lo
    return np.concatenate(parts), out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def digests(parts: Iterator[bytes]) -> np.ndarray:
    """128 bits of each as a line of two 64-bit numbers."""
    return np.frombuffer(b"".join([hashlib.blake2b(p, digest_size=16).digest() for p in parts]), np.int64).reshape(-1, 2)


def _contexts(length: int, gram: int):
    """(row, text) -> the contexts of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = RangeHash(31)
        width = length - gram + 1
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for data, spans in _pieces(batch.column(1), length):
                p1 = one.prefix(data)
                n = len(data) - gram + 1
                at = np.arange(n)
                grams = one.ranges(p1, at, at + gram)
                packed = (grams & ~_POSITION) | at.astype(np.uint64)
                anchor = (_least(packed, width) & _POSITION).astype(np.int64)
                begin = np.array([s[2] for s in spans])
                end = np.array([s[3] for s in spans])
                # Windows that start in a span and end in it; runs of one anchor.
                valid = np.zeros(len(anchor) + 1, np.int64)
                np.add.at(valid, begin, 1)
                np.add.at(valid, end - length + 1, -1)
                starts = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
                mine = anchor[starts]
                cut = np.flatnonzero((np.diff(mine, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1))
                first, last = starts[cut], starts[np.append(cut[1:], len(starts)) - 1]
                pos = anchor[first]
                raw = memoryview(np.ascontiguousarray(data))
                ctx = digests(raw[lo:hi] for lo, hi in zip(first.tolist(), (last + length).tolist()))
                span = np.searchsorted(begin, first, "right") - 1
                rows = np.array([s[0] for s in spans])[span]
                offset = np.array([s[1] for s in spans])[span] - begin[span]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[pos].view(np.int64)), pa.array(ctx[:, 0].copy()), pa.array(ctx[:, 1].copy()), pa.array(ids[rows].astype(np.int64)), pa.array((first + offset).astype(np.int32)), pa.array((last - first + length).astype(np.int32)), pa.array((pos - first).astype(np.int32))],
                    names=["key", "a", "b", "row", "start", "len", "off"],
                )

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, wanted) -> the bytes of each wanted context."""
    names = ["key", "a", "b", "row", "start", "off", "one", "bytes"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
    for batch in batches:
        out, size = [], 0
        for row, text, wanted in zip(*(batch.column(i) for i in range(3))):
            raw, row = (text.as_py() or "").encode(), row.as_py()
            for w in wanted.as_py():
                out.append((w["key"], w["a"], w["b"], row, w["start"], w["off"], w["one"], raw[w["start"] : w["start"] + w["len"]]))
                size += w["len"]
                if size > 8 * CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def _cores(length: int, g: int, texts: bool):
    """Contexts of hot buckets -> for each range of ``g`` left reaches the part that holds its windows, by bucket and core.

    Without ``texts`` only the new keys are returned. The anchor's key is part of the new one, and so is the range.
    """
    names = ["key", "a", "b", "row", "start", "off", "one", "core", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, row, start, off, one, raw in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 5, 6, 7))):
                for least in range(0, min(length, off + 1), g):
                    # Windows that begin from least to least + g - 1 bytes before the anchor.
                    lo, hi = max(0, off - least - g + 1), min(len(raw), off - least + length)
                    if hi - lo >= length:
                        out.append((key, row, start + lo, off - lo, one, least, raw[off - least : off - least + length - g + 1], raw[lo:hi]))
            if texts:
                # What a core is aligned at stays the anchor; the core says which range it is of.
                cores = [hashlib.blake2b(core, digest_size=16, salt=key.to_bytes(8, "little", signed=True) + least.to_bytes(8, "little")).digest() for key, _, _, _, _, least, core, _ in out]
                ab = digests(x[7] for x in out)
                cols = [[int.from_bytes(c[:8], "little", signed=True) for c in cores], ab[:, 0].tolist(), ab[:, 1].tolist(), [x[1] for x in out], [x[2] for x in out], [x[3] for x in out], [x[4] for x in out], cores, [x[7] for x in out]]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
            else:
                cores = [hashlib.blake2b(x[6], digest_size=16, salt=x[0].to_bytes(8, "little", signed=True) + x[5].to_bytes(8, "little")).digest() for x in out]
                yield pa.RecordBatch.from_arrays([pa.array(cores, pa.binary())], names=["core"])

    return run


def _prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def _branches(parts: list[bytes]) -> list[int]:
    """Ascending lengths above 0 at which two of the byte strings part."""
    parts = sorted(parts)
    return sorted({_prefix(a, b) for a, b in zip(parts, parts[1:])} - {0})


class Buckets:
    """Aligned buckets as one integer text, and what its suffix array says of each context."""

    def __init__(self, length: int):
        self.length, self.symbols = length, {}
        self.text: list[int] = []
        self.weights: list[int] = []
        self.marks: list[tuple[int, int, tuple]] = []  # first symbol, left reach in bytes, context

    def add(self, bucket: int, rows: list[tuple]) -> None:
        """rows: (row, start, off, one, bytes) of one bucket, all different."""
        rights = [r[4][r[2] :] for r in rows]
        lefts = [r[4][: r[2]][::-1] for r in rows]
        right, left = _branches(rights), _branches(lefts)
        # The most that any two share; below the length no window repeats here.
        if (right[-1] if right else 0) + (left[-1] if left else 0) < self.length:
            return
        lows, highs = [0, *left], [0, *right]
        for row, r, back in zip(rows, rights, lefts):
            reach = [i for i in range(1, len(lows)) if lows[i] <= len(back)]
            for i in reversed(reach):
                if row[3]:
                    self.marks.append((len(self.text), lows[i], row))
                self._put((bucket, -i, back[lows[i - 1] : lows[i]]))
            if row[3]:
                self.marks.append((len(self.text), 0, row))
            for i in range(1, len(highs)):
                if highs[i] > len(r):
                    break
                self._put((bucket, i, r[highs[i - 1] : highs[i]]))
            self._put((bucket, len(highs), len(self.text)))  # ends the row; equal to nothing

    def _put(self, symbol: tuple) -> None:
        self.text.append(self.symbols.setdefault(symbol, len(self.symbols)))
        self.weights.append(len(symbol[2]) if isinstance(symbol[2], bytes) else 0)

    def spans(self) -> Iterator[tuple[int, int, int]]:
        """(row, begin, end) of runs whose every window occurs in another context too."""
        order = suffix_array(self.text)
        shared = common_prefixes(self.text, order)
        rank = [0] * len(order)
        for i, p in enumerate(order):
            rank[p] = i
        total = [0]
        for w in self.weights:
            total.append(total[-1] + w)
        for first, left, (doc, start, off, _, _) in self.marks:
            i = rank[first]
            most = max(shared[i], shared[i + 1] if i + 1 < len(shared) else 0)
            reach = total[first + most] - total[first]
            if reach >= self.length and reach >= left:
                yield doc, start + off - left, start + off - left + reach


def _search(length: int):
    """Slices sorted by key, one of each context -> repeated spans of the contexts that occur once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            cols = list(zip(*found)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32()))], names=["row", "s", "e"])

        at, rows, work = None, [], Buckets(length)
        for batch in batches:
            for key, row, start, off, one, raw in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 5, 6, 7))):
                if key != at:
                    if len(rows) > 1:
                        work.add(at, rows)
                    at, rows = key, []
                    if len(work.text) >= BATCH:
                        yield out(list(work.spans()))
                        work = Buckets(length)
                rows.append((row, start, off, one, raw))
        if len(rows) > 1:
            work.add(at, rows)
        yield out(list(work.spans()))

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) -> counts and the hash of the kept bytes."""
    for batch in batches:
        rows = []
        for doc, text, spans in zip(*(batch.column(i) for i in range(3))):
            raw = (text.as_py() or "").encode()
            merged: list[list[int]] = []
            for x in sorted((x["s"], x["e"]) for x in spans.as_py() or ()):
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append(list(x))
            kept, at = hashlib.sha256(), 0
            for s, e in merged:
                kept.update(raw[at:s])
                at = e
            kept.update(raw[at:])
            rows.append((doc.as_py(), len(raw), sum(e - s for s, e in merged), len(merged), kept.hexdigest(), [{"s": s, "e": e} for s, e in merged]))
        span = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), span]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def _split(ws: Workspace, slices: DataFrame, length: int, bucket: int) -> tuple[DataFrame, list[DataFrame]]:
    """Slices of buckets of at most ``bucket`` different contexts, and spans found where larger ones were split."""
    small, spans = None, []
    for g in (*(r for r in RANGES if r < length), None):
        hot = slices.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).select("key") if g else None
        hot = ws.table(hot, "hot") if g else None
        last = g is None or hot.isEmpty()
        part = slices if last else slices.join(hot, "key", "left_anti")
        small = part if small is None else small.unionByName(part)
        if last:
            break
        large = ws.table(slices.join(hot, "key", "left_semi").select(*slices.columns), "large")
        # First the cores alone are counted: most occur once, and their bytes go nowhere.
        live = ws.table(large.mapInArrow(lean(_cores(length, g, False)), "core binary").groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "live")
        cut = ws.table(large.mapInArrow(lean(_cores(length, g, True)), CORES).join(live, "core", "left_semi"), "cut")
        kinds = ws.table(cut.groupBy("core", "a", "b").agg(F.count("*").alias("n"), F.min(F.struct("row", "start")).alias("at")), "kinds")
        again = kinds.where("n > 1").select("core", "a", "b")
        whole = cut.where("one").join(again, ["core", "a", "b"], "left_semi")
        spans.append(whole.select("row", F.col("start").alias("s"), (F.col("start") + F.length("bytes")).alias("e")))
        heads = kinds.select("core", "a", "b", "at.row", "at.start", (F.col("n") == 1).alias("alone"))
        slices = cut.join(heads, ["core", "a", "b", "row", "start"]).withColumn("one", F.col("one") & F.col("alone"))
        slices = ws.table(slices.select("key", "a", "b", "row", "start", "off", "one", "bytes"), "slices")
    return small, spans


def repeated_spans(docs: DataFrame, length: int = 400, gram: int = 64, bucket: int = BUCKET) -> DataFrame:
    """Byte spans of ``docs`` (doc_id long, text string; more columns are ignored) that repeat.

    A byte is removed if a ``length``-byte string over it also starts anywhere else,
    in the same document or another; strings are judged on the whole input. Returns
    a row for each row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 (of the remaining bytes), spans (array of begin and end). Null texts
    are empty; texts shorter than ``length`` lose nothing; rows of null or repeated
    doc_id are documents of their own, which lose bytes and make others lose them
    like all; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "suffix")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    plain, _ = with_rows(ws, plain, "doc_id")
    plain = plain.select(F.col("_row").alias("row"), "text", "doc_id")
    every = ws.table(plain.select("row", "text").mapInArrow(lean(_contexts(length, gram)), CONTEXTS), "contexts")
    # Written before the join, so that an anchor of very many contexts can be split by the skew rule.
    again = ws.table(every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "anchors")
    seen = ws.table(every.join(again, "key", "left_semi"), "again")
    ws.drop(every)
    name = ["key", "a", "b"]
    kinds = ws.table(seen.groupBy(*name).agg(F.count("*").alias("n"), F.min(F.struct("row", "start", "len", "off")).alias("at")), "kinds")
    whole = seen.join(kinds.where("n > 1").select(*name), name, "left_semi").select("row", F.col("start").alias("s"), (F.col("start") + F.col("len")).alias("e"))
    several = ws.table(kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1").select("key"), "several")
    chosen = kinds.join(several, "key").select("at.row", F.struct(*name, "at.start", "at.len", "at.off", (F.col("n") == 1).alias("one")).alias("w"))
    chosen = chosen.groupBy("row").agg(F.collect_list("w").alias("wanted"))
    slices = ws.table(plain.join(chosen, "row").select("row", "text", "wanted").mapInArrow(lean(_slices), SLICES), "slices")
    few, parts = _split(ws, slices, length, bucket)
    found = ws.table(few.repartition(n, "key").sortWithinPartitions("key").mapInArrow(lean(_search(length)), SPANS), "found")
    spans = whole.unionByName(found)
    for part in parts:
        spans = spans.unionByName(part)
    spans = spans.groupBy("row").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<s:int,e:int>>"
    return plain.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(lean(_cut), out)
