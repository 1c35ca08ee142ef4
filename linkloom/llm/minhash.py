"""MinHash near-duplicate groups with exact confirmation.

Many universal hash minima per document are cut into bands; documents that share a
band are candidates, compared by signature first and by their full shingle sets at
last; linked documents form groups by alternating large-star and small-star.

A band shared by very many documents never becomes all pairs. First each member is
compared with the band's least member only (a star), and the confirmed links are
contracted to components. Only then do bands that still hold several components
compare members of different components, in tiles of bounded size: work that grows
with the square of the components left in one band, cut into as many tasks. Members
of one component need no further link, so no group is lost. A tile returns a
spanning forest of the links it found, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import connected_components
from .hashing import RangeHash, constants, mix, separators, word_spans
from .shared import Workspace, fresh, lean, named_components, text_chunks, with_rows

#: Words are runs of bytes other than these: space and 09-0D.
SPACE = separators((0x20, 0x20), (0x09, 0x0D))
CHUNK = 1 << 20
#: Rows of a tile side, and links to one document that meet its set in one task.
TILE, LINKS = 512, 256

SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sig binary"
SETS = "doc_id long, shingles binary"
PAIRS = "u long, v long"


class Shingler:
    """Distinct word shingles of documents as sorted 64-bit hashes."""

    def __init__(self, words: int):
        self.words, self.hash, self.mult = words, RangeHash(11, fold=True), constants(12, 64 + words)

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """A sorted array for each row: with fewer words than a shingle has, one hash of all; without words, none."""
        k = self.words
        starts, ends, rows = word_spans(data, offsets, SPACE)
        word = self.hash.ranges(self.hash.prefix(data), starts, ends)
        n = len(word)
        grams = np.zeros(max(n - k + 1, 0), np.uint64)
        for j in range(k if len(grams) else 0):
            grams += word[j : n - k + 1 + j] * self.mult[j]
        grams = mix(grams)
        first = np.searchsorted(rows, np.arange(len(offsets)))
        out = []
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
            if hi - lo >= k:
                out.append(np.unique(grams[lo : hi - k + 1]))
            elif hi > lo:
                short = word[lo:hi] * self.mult[k : k + hi - lo]
                out.append(mix(np.array([short.sum(dtype=np.uint64) + np.uint64(hi - lo)], np.uint64)))
            else:
                out.append(grams[:0])
        return out


class Minima:
    """hashes universal minima: (a * x + b) mod 2**64, a odd, of which the high bits are kept."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        self.a, self.b, self.c = constants(21, bands * rows), constants(22, bands * rows), constants(23, rows + 1)

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """uint32, one line for each non-empty set."""
        sizes = np.array([len(s) for s in sets], np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        every, out = np.concatenate(sets), np.empty((len(sets), len(self.a)), np.uint32)
        work = np.empty_like(every)
        for j, (a, b) in enumerate(zip(self.a, self.b)):
            np.multiply(every, a, out=work)
            np.add(work, b, out=work)
            out[:, j] = np.minimum.reduceat(work, at) >> np.uint64(32)
        return out

    def band_keys(self, signatures: np.ndarray) -> np.ndarray:
        lines = signatures.reshape(len(signatures), self.bands, self.rows).astype(np.uint64)
        key = (lines * self.c[: self.rows]).sum(axis=2, dtype=np.uint64)
        return mix(key + np.arange(self.bands, dtype=np.uint64) * self.c[self.rows]).view(np.int64)


def _sketch(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, minima = Shingler(words), Minima(bands, rows)
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column(1), CHUNK):
                ids = batch.column(0).slice(row, len(offsets) - 1)
                sets = shingler.sets(data, offsets)
                full = [i for i, s in enumerate(sets) if len(s)]
                band_lists, sigs = [[]] * len(sets), [None] * len(sets)
                if full:
                    signatures = minima.signatures([sets[i] for i in full])
                    keys, short = minima.band_keys(signatures), (signatures & 0xFFFF).astype(np.uint16)
                    for j, i in enumerate(full):
                        band_lists[i], sigs[i] = keys[j], short[j].tobytes()
                a = [int(s.sum(dtype=np.uint64).view(np.int64)) for s in sets]
                b = [int(mix(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [ids.cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(band_lists, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sig"],
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column(1), CHUNK):
                sets = [s.tobytes() for s in shingler.sets(data, offsets)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)).cast(pa.int64()), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])

    return run


def _confirm(num: int, den: int):
    """Rows sorted by (v, salt, u): the set of v comes first (u is null), then each u with its own set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            us, vs = [], []
            for v, salt, u, shingles in zip(*(batch.column(i).to_pylist() for i in range(4))):
                mine = np.frombuffer(shingles, np.uint64)
                if u is None:
                    at, held = (v, salt), mine
                elif at == (v, salt):
                    # Both are sorted and distinct: the shared ones are found by binary search in the larger.
                    small, large = (mine, held) if len(mine) <= len(held) else (held, mine)
                    place = np.searchsorted(large, small)
                    place[place == len(large)] = 0
                    shared = int((large[place] == small).sum())
                    if den * shared >= num * (len(mine) + len(held) - shared):
                        us.append(u)
                        vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def _tiles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[tuple]]:
    """Rows of each tile, from rows sorted by tile, their first column; an empty list after each batch."""
    at, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(width))):
            if row[0] != at:
                if len(rows) > 1:
                    yield rows
                at, rows = row[0], []
            rows.append(row)
        yield []
    if len(rows) > 1:
        yield rows


def agreeing(sig: np.ndarray, comp: np.ndarray, least: int) -> np.ndarray:
    """Which rows have, in another component, a signature that agrees with theirs in ``least`` places."""
    near = np.zeros(len(sig), bool)
    for i in range(len(sig) - 1):
        hit = (np.count_nonzero(sig[i + 1 :] == sig[i], axis=1) >= least) & (comp[i + 1 :] != comp[i])
        near[i] |= hit.any()
        near[i + 1 :] |= hit
    return near


def _agreeing(least: int):
    """(tile, doc_id, comp, sig) -> the rows that have, in another component of their tile, a signature like theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _tiles(batches, 4):
            if rows:
                comp = np.array([r[2] for r in rows])
                if (comp == comp[0]).all():
                    continue
                sig = np.frombuffer(b"".join(r[3] for r in rows), np.uint16).reshape(len(rows), -1)
                out += [r[:3] for r, near in zip(rows, agreeing(sig, comp, least).tolist()) if near]
            else:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["tile", "doc_id", "comp"])
                out = []
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["tile", "doc_id", "comp"])

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs: products of blocks of the incidence matrix of shingles that two sets have."""
    n, every = len(sets), np.concatenate(sets)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, rows = every[order], rows[order]
    first = np.concatenate([[True], every[1:] != every[:-1]])
    column = np.cumsum(first) - 1
    twice = np.bincount(column)[column] > 1
    rows, column = rows[twice], np.unique(column[twice], return_inverse=True)[1]
    out, block = np.zeros((n, n), np.float32), 4096
    edges = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + block, block))
    for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        has = np.zeros((n, block), np.float32)
        has[rows[lo:hi], column[lo:hi] - k * block] = 1
        used = np.unique(rows[lo:hi])
        out[np.ix_(used, used)] += has[used] @ has[used].T
    return out


def _linked(num: int, den: int):
    """(tile, doc_id, comp, shingles) -> a spanning forest of the tile's links between components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs = [], []
        for rows in _tiles(batches, 4):
            if rows:
                comp = np.array([r[2] for r in rows])
                sets = [np.frombuffer(r[3], np.uint64) for r in rows]
                size = np.array([len(s) for s in sets])
                both = shared_counts(sets)
                link = den * both >= num * (size[:, None] + size[None, :] - both)
                link |= comp[:, None] == comp[None, :]
                fresh = np.ones(len(rows), bool)
                for start in range(len(rows)):
                    stack = [start] if fresh[start] else []
                    fresh[start] = False
                    while stack:
                        x = stack.pop()
                        found = np.flatnonzero(link[x] & fresh)
                        fresh[found] = False
                        stack += found.tolist()
                        for y in found[comp[found] != comp[x]].tolist():
                            us.append(max(rows[x][1], rows[y][1]))
                            vs.append(min(rows[x][1], rows[y][1]))
            else:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
                us, vs = [], []
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def _confirmed(ws: Workspace, sets: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """The candidate pairs (u, v) that hold on full sets. The set of v travels once for each salt, one for every LINKS pairs, that of u once for each pair."""
    pairs = ws.table(pairs, "close")
    salts = ws.table(pairs.groupBy("v").agg(F.ceil(F.count("*") / LINKS).cast("int").alias("salts")), "salts")
    salted = ws.table(pairs.join(salts, "v").select("v", F.pmod(F.xxhash64("u"), F.col("salts")).cast("int").alias("salt"), "u"), "pairs")
    right = salted.join(sets.withColumnRenamed("doc_id", "u"), "u").select("v", "salt", "u", "shingles")
    left = salted.select("v", "salt").distinct().join(sets.withColumnRenamed("doc_id", "v"), "v").select("v", "salt", F.lit(None).cast("long").alias("u"), "shingles")
    n = ws.spark.conf.get("spark.sql.shuffle.partitions")
    rows = left.unionByName(right).repartition(int(n), "v", "salt").sortWithinPartitions("v", "salt", F.col("u").asc_nulls_first())
    return ws.table(rows.mapInArrow(lean(_confirm(num, den)), PAIRS), "confirmed")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75, bands: int = 40, rows: int = 4, slack: float = 0.2) -> DataFrame:
    """Near-duplicate groups of ``docs`` (doc_id long, text string; more columns are ignored).

    Texts are lower-cased in A-Z and cut into words at space and 09-0D; a document's
    set is its distinct ``words``-word shingles, with fewer words the whole sequence
    as one. Two documents are linked if 100 * intersection >= ``percent`` * union on
    full sets. ``bands`` x ``rows`` minima find candidates: at 0.75 a pair shares no
    band with probability (1 - 0.75**rows)**bands, 2.5e-7 here. Pairs whose signatures
    agree in less than percent/100 - ``slack`` of the places (over 5 standard
    deviations, 5e-9 here) are not confirmed.

    Returns a row for each row: doc_id, n_shingles, component_id (least doc_id
    reachable), kept. Null and empty texts and texts without words have 0 shingles
    and stand alone. Rows of null or repeated doc_id are documents of their own:
    component_id is the least doc_id that is given in the group (null if none is),
    and one row of a group is kept. An empty table gives an empty result.
    """
    ws = Workspace(docs.sparkSession, "minhash")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    plain, unique = with_rows(ws, plain, "doc_id")
    out = _groups(ws, plain, words, percent, bands, rows, slack)
    if not unique:
        out = out.join(plain.select("_row", "doc_id"), "_row")
    else:
        out = out.withColumn("doc_id", F.col("_row"))
    return named_components(ws, out, "doc_id", unique).select("doc_id", "n_shingles", "component_id", "kept")


def first_of_groups(docs: DataFrame, **options) -> DataFrame:
    """Those rows of ``docs``, with all columns, that ``near_duplicates`` keeps."""
    ws = Workspace(docs.sparkSession, "minhash")
    row = fresh(docs, "_number")
    numbered, unique = with_rows(ws, docs, "doc_id", row)
    plain = numbered.select(F.col(row).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = _groups(ws, plain, **options)
    out = out.withColumn("doc_id", F.col("_row")) if unique else out.join(plain.select("_row", "doc_id"), "_row")
    # Written, so that a small table of what goes is sent to the texts, and not the texts to it.
    gone = ws.table(named_components(ws, out, "doc_id", unique).where("not kept").select(F.col("_row").alias(row)), "gone")
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def _groups(ws: Workspace, plain: DataFrame, words: int = 5, percent: int = 75, bands: int = 40, rows: int = 4, slack: float = 0.2) -> DataFrame:
    """(_row unique, text) -> _row, n_shingles, component (the least _row of the group)."""
    spark = ws.spark
    plain = plain.select(F.col("_row").alias("doc_id"), "text")
    sketch = ws.table(plain.mapInArrow(lean(_sketch(words, bands, rows)), SKETCH), "sketch")
    # Documents with equal sets are one: the least id stands for them.
    same = ["n_shingles", "set_a", "set_b"]
    some = sketch.where("n_shingles > 0")
    # Written before the join, so that a set of very many copies can be split by the skew rule.
    rep = ws.table(some.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n"), "copies")
    member = ws.table(some.select("doc_id", *same).join(rep, same, "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep")), "members")
    reps = member.where("doc_id = rep").select("doc_id")
    light = ws.table(some.join(reps, "doc_id", "left_semi").select("doc_id", "bands", "sig"), "reps")
    entries = light.select("doc_id", F.explode("bands").alias("band"))
    heads = entries.groupBy("band").agg(F.min("doc_id").alias("head"), F.count("*").alias("n")).where("n > 1").select("band", "head")
    heads = ws.table(heads, "heads")
    shared = ws.table(entries.join(heads, "band"), "bands")
    sigs = light.select("doc_id", "sig")

    # The sets of all candidates, made once; their texts are shuffled at any size of the table.
    wanted = shared.select("doc_id").distinct().hint("merge")
    sets = ws.table(plain.join(wanted, "doc_id", "left_semi").mapInArrow(lean(_sets(words)), SETS), "sets")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = bands * rows
    least = int((percent / 100 - slack) * places)

    star = shared.where("doc_id <> head").select(F.col("doc_id").alias("u"), F.col("head").alias("v")).distinct()
    a, b = sigs.select(F.col("doc_id").alias("u"), F.col("sig").alias("su")), sigs.select(F.col("doc_id").alias("v"), F.col("sig").alias("sv"))
    agree = F.aggregate(F.sequence(F.lit(0), F.lit(places - 1)), F.lit(0), lambda s, i: s + (F.substring("su", 2 * i + 1, F.lit(2)) == F.substring("sv", 2 * i + 1, F.lit(2))).cast("int"))
    close = star.join(a, "u").join(b, "v").where(agree >= least).select("u", "v")
    links = _confirmed(ws, sets, close, percent, 100)
    comp = connected_components(ws, links)

    # Bands that still hold several components: members of different components are compared in tiles,
    # by signature first, then those that agree with any other by full sets.
    labelled = shared.join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("band", "doc_id", F.coalesce("component", "doc_id").alias("comp"))
    labelled = ws.table(labelled, "labelled")
    mixed = labelled.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    mixed = ws.table(mixed.select("band", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")), "mixed")
    spread = labelled.join(mixed, "band").select("band", "doc_id", "comp", "tiles", F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int").alias("t"))
    spread = spread.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    spread = spread.select(F.concat_ws("/", "band", F.least("t", "o"), F.greatest("t", "o")).alias("tile"), "doc_id", "comp")
    tiles = spread.join(sigs, "doc_id").select("tile", "doc_id", "comp", "sig").repartition(n, "tile").sortWithinPartitions("tile")
    near = ws.table(tiles.mapInArrow(lean(_agreeing(least)), "tile string, doc_id long, comp long"), "agreeing")
    full = near.join(sets, "doc_id").select("tile", "doc_id", "comp", "shingles").repartition(n, "tile").sortWithinPartitions("tile")
    more = ws.table(full.mapInArrow(lean(_linked(percent, 100)), PAIRS), "crossing")
    if not more.isEmpty():
        comp = connected_components(ws, links.unionByName(more))

    group = member.join(comp, member.rep == comp.id, "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    out = sketch.select("doc_id", "n_shingles").join(group, "doc_id", "left")
    return out.select(F.col("doc_id").alias("_row"), "n_shingles", F.coalesce("component", "doc_id").alias("component"))
