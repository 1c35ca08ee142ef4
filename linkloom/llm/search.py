"""Exact ranked search in an index of bit-sliced impacts.

Documents are cut into blocks. For each term of a block the index has the places of its
documents and, for every bit of their impacts, a bitmap. A query is answered block by
block: the bitmaps of its terms are spread to the block's width and added by carry-save
arithmetic on whole words, 64 documents at a time, and the best k are found from the
most significant slice of the sums downwards, ties by the place, which follows doc_id.

Queries go in batches of bounded bytes of terms, so that what is sent to every task (the
terms of a batch, their weights and the terms' numbers of each query) has a bound; each
batch reads the documents once. Null texts have no terms. Rows of null or repeated ids
are documents, or queries, of their own; a null doc_id is the last among equal scores.
Very long texts are counted piece by piece. An empty table on either side gives no row;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Workspace, lean, text_buffer

#: Documents of a block, a multiple of 64 and at most 65,536.
BLOCK = 4096
#: Bytes of terms in a batch of queries; one larger query is a batch of its own.
BATCH_BYTES = 4 << 20
#: Bytes of a text that are counted at once.
PIECE = 1 << 20
#: Separators become spaces, A-Z become a-z; bytes of other characters than ASCII belong to terms.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
INDEX = "block long, term int, places binary, bits int, slices binary"
FOUND = "query long, doc_id long, score long"


def counted(text: bytes) -> tuple[Counter, int]:
    """How often each term occurs in a text, and the number of all."""
    counts, total, begin = Counter(), 0, 0
    while begin < len(text):
        end = begin + PIECE
        if end < len(text):
            # A piece ends at a separator, so that no term is cut.
            while end < len(text) and FOLD[text[end]] != 32:
                end += 1
        words = text[begin:end].translate(FOLD).split()
        counts.update(words)
        total += len(words)
        begin = end
    return counts, total


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = text_buffer(column)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[a:b].tobytes()


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        terms = [[w.decode() for w in sorted(counted(t)[0])] for t in _texts(b.column(2))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(terms, pa.list_(pa.string()))], names=["query", "item_id", "terms"])


def query_table(ws: Workspace, items: DataFrame) -> DataFrame:
    """query (a number), item_id, terms (distinct, sorted) and batch of each row of ``items`` (item_id, text), written."""
    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select(F.monotonically_increasing_id().alias("query"), "item_id", F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(lean(_query_terms), f"query long, item_id {kind}, terms array<string>")
    size = F.octet_length(F.array_join("terms", " ")).cast("long")
    table = ws.table(rows.withColumn("part", F.shiftright("query", 33)).withColumn("bytes", size), "queries")
    before = F.sum("bytes").over(Window.partitionBy("part").orderBy("query"))
    return table.withColumn("batch", F.concat_ws("-", "part", F.floor(before / BATCH_BYTES)))


def _batches(queries: DataFrame) -> list[list[str]]:
    """Names of batches, put together up to the bound."""
    out, room = [], 0
    for name, size in sorted((r["batch"], r["bytes"]) for r in queries.groupBy("batch").agg(F.sum("bytes").alias("bytes")).collect()):
        if size > room or not out:
            out.append([])
            room = BATCH_BYTES
        out[-1].append(name)
        room -= size
    return out


def _postings(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            sizes, terms, counts, ends = [], [], [], [0]
            for text in _texts(b.column(1)):
                found, n = counted(text)
                own = sorted((known[w], c) for w, c in found.items() if w in known)
                sizes.append(n)
                terms.extend(t for t, _ in own)
                counts.extend(c for _, c in own)
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    return run


def postings(ws: Workspace, docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms of the document) and the known terms' numbers and counts, a row for each document, written."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ws.table(rows.mapInArrow(lean(_postings(shared)), POSTINGS), "postings")


def sliced(values: np.ndarray) -> tuple[int, bytes]:
    """(slices, their bitmaps, least significant first) of positive numbers."""
    bits = int(values.max()).bit_length()
    planes = (values[None, :] >> np.arange(bits)[:, None]) & 1
    return bits, np.packbits(planes.astype(np.uint8), axis=1, bitorder="little").tobytes()


def spread(places: np.ndarray, bits: int, slices: bytes, width: int) -> np.ndarray:
    """Slices of a term's documents as bitmaps over a whole block of ``width`` documents, as 64-bit words."""
    packed = np.frombuffer(slices, np.uint8).reshape(bits, -1)
    planes = np.zeros((bits, width), np.uint8)
    planes[:, places] = np.unpackbits(packed, axis=1, count=len(places), bitorder="little")
    return np.packbits(planes, axis=1, bitorder="little").view(np.uint64)


def _indexed(shared, n_docs: int, n_terms: int):
    def block(number: int, rows: list[tuple]) -> Iterator[tuple]:
        """Rows of the index: the documents' ids under term -1, then each term."""
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
        weights = shared.value
        terms = np.concatenate([np.asarray(r[2], np.int64) for r in rows])
        counts = np.concatenate([np.asarray(r[3], np.int64) for r in rows])
        place = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
        length = np.array([50 + 50 * r[1] * n_docs // n_terms for r in rows], np.int64)
        impact = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 20 * length[place]))
        order = np.lexsort((place, terms))
        order = order[impact[order] > 0]
        if not len(order):
            return
        terms, place, impact = terms[order], place[order], impact[order]
        yield number, -1, np.array([r[0] or 0 for r in rows], "<i8").tobytes(), 0, bytes(r[0] is None for r in rows)
        edges = np.flatnonzero(np.diff(terms, prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:]):
            bits, planes = sliced(impact[a:b])
            yield number, int(terms[a]), place[a:b].astype("<u2").tobytes(), bits, planes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, rows, out, size = TaskContext.get().partitionId() << 32, 0, [], [], 0
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary()))], names=["block", "term", "places", "bits", "slices"])

        def filled(batches):
            nonlocal rows, made
            for b in batches:
                ends = b.column(2).offsets.to_numpy()
                terms, counts = (b.column(i).values.to_numpy() for i in (2, 3))
                for i, (doc, n) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                    rows.append((doc, n, terms[ends[i] : ends[i + 1]].copy(), counts[ends[i] : ends[i + 1]].copy()))
                    if len(rows) == BLOCK:
                        yield from block(base + made, rows)
                        rows, made = [], made + 1
            if rows:
                yield from block(base + made, rows)

        for row in filled(batches):
            out.append(row)
            size += len(row[2]) + len(row[4])
            if size >= 1 << 20:
                yield pack(out)
                out, size = [], 0
        if out:
            yield pack(out)

    return run


def build_index(ws: Workspace, found: DataFrame, n_terms_known: int) -> DataFrame:
    """The index of ``postings``: block, term (-1: the documents), places, bits, slices; written.

    Weights are floor(1000 ln((2 N + 2) / (2 df + 1))) of N documents with terms, one number for each known term.
    """
    spark = found.sparkSession
    total = found.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"] or 0
    weights = np.zeros(n_terms_known, np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        weights[r["t"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
    shared = spark.sparkContext.broadcast(weights)
    return ws.table(found.where("size(terms) > 0").mapInArrow(lean(_indexed(shared, n_docs, n_terms)), INDEX), "index")


def summed(planes: list[np.ndarray], words: int) -> np.ndarray:
    """Slices of the sums of numbers in slices: full adders on whole bitmaps, carries kept apart until the end."""
    bits = max(len(p) for p in planes) + len(planes).bit_length()
    total, carry = np.zeros((bits, words), np.uint64), np.zeros((bits, words), np.uint64)
    for p in planes:
        k = len(p)
        half, over = total ^ carry, total & carry
        over[:k] |= p & half[:k]
        half[:k] ^= p
        total = half
        carry[1:] = over[:-1]
    rest = np.zeros(words, np.uint64)
    for i in range(bits):
        half = total[i] ^ carry[i]
        total[i], rest = half ^ rest, (total[i] & carry[i]) | (half & rest)
    return total


def top(slices: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, numbers) of the k largest positive numbers of ``slices``, the first places among equals, in the order of places."""
    count = lambda x: int(np.bitwise_count(x).sum())
    sure, open_ = np.zeros(slices.shape[1], np.uint64), np.bitwise_or.reduce(slices, axis=0)
    if count(open_) <= k:
        sure, open_ = open_, sure
    else:
        have = 0
        for plane in slices[::-1]:
            high = open_ & plane
            n = count(high)
            if have + n > k:
                open_ = high
            else:
                sure, have, open_ = sure | high, have + n, open_ & ~plane
                if have == k:
                    break
    places = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
    if len(places) < k:
        ties = np.flatnonzero(np.unpackbits(open_.view(np.uint8), bitorder="little"))[: k - len(places)]
        places = np.sort(np.concatenate([places, ties]))
    bit = (slices[:, places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)
    return places, (bit.astype(np.int64) << np.arange(len(slices))[:, None]).sum(axis=0)


def _searched(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, best = shared.value, {}

        def answer(rows: list[tuple]) -> None:
            ids, none = np.frombuffer(rows[0][1], "<i8"), np.frombuffer(rows[0][3], np.uint8)
            width = -(-len(ids) // 64) * 64
            known = {r[0]: r for r in rows[1:]}
            wide: dict[int, np.ndarray] = {}
            for number, terms in queries:
                own = [t for t in terms if t in known]
                if not own:
                    continue
                for t in own:
                    if t not in wide:
                        _, places, bits, slices = known[t]
                        wide[t] = spread(np.frombuffer(places, "<u2"), bits, slices, width)
                places, scores = top(summed([wide[t] for t in own], width // 64), k)
                held = best.get(number)
                score, doc, null = (scores, ids[places], none[places])
                if held is not None:
                    score, doc, null = (np.concatenate(x) for x in zip(held, (score, doc, null)))
                if len(score) > k:
                    order = np.lexsort((doc, null, -score))[:k]
                    score, doc, null = score[order], doc[order], null[order]
                best[number] = (score, doc, null)

        block, rows = None, []
        for b in batches:
            for at, *row in zip(*(c.to_pylist() for c in b.columns)):
                if at != block and rows:
                    answer(rows)
                    rows = []
                block = at
                rows.append(row)
        if rows:
            answer(rows)
        for number, (score, doc, null) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array([number] * len(score), pa.int64()), pa.array(doc, mask=null.astype(bool)), pa.array(score, pa.int64())], names=["query", "doc_id", "score"])

    return run


def search(index: DataFrame, queries: list[tuple[int, list[int]]], k: int) -> DataFrame:
    """query, doc_id and score of the ``k`` best documents of each part of the index for each of ``queries`` (number, terms)."""
    shared = index.sparkSession.sparkContext.broadcast(queries)
    rows = index.repartition("block").sortWithinPartitions("block", "term")
    return rows.mapInArrow(lean(_searched(shared, k)), FOUND)


def ranked(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` documents of ``docs`` (doc_id, text) with the highest scores above 0 for each of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    ws = Workspace(spark, "search")
    queries = query_table(ws, items)
    parts = []
    for names in _batches(queries):
        own = [(r["query"], r["terms"]) for r in queries.where(F.col("batch").isin(names)).select("query", "terms").collect()]
        known = {w.encode(): i for i, w in enumerate(sorted({w for _, terms in own for w in terms}))}
        found = postings(ws, docs, known)
        index = build_index(ws, found, len(known))
        ws.drop(found)
        parts.append(ws.table(search(index, [(q, [known[w.encode()] for w in terms]) for q, terms in own], k), "found"))
        ws.drop(index)
    if not parts:
        parts.append(spark.createDataFrame([], FOUND))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k).join(queries.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
