"""Embedding, suffix-array and MinHash deduplication against brute force."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import embed_dedup, graph, minhash, suffix_dedup
from linkloom.llm.shared import Workspace
from linkloom.llm.suffix_array import common_prefixes, suffix_array

DOCS = "doc_id long, text string, lang string, key string, rep string, w string"


def documents(spark, texts):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "k", "r", "w") for i, t in enumerate(texts)], DOCS)


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def words(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_suffix_array():
    rng = random.Random(5)
    for _ in range(1500):
        t = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(45))] * rng.randrange(1, 3)
        order = suffix_array(t)
        assert order == sorted(range(len(t)), key=lambda i: t[i:])
        shared = common_prefixes(t, order)
        for i in range(1, len(order)):
            a, b = t[order[i] :], t[order[i - 1] :]
            n = shared[i]
            assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])
    assert suffix_array([]) == [] and suffix_array([10**9, 5, 10**9, 5]) == [3, 1, 2, 0]


def repeated(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bucket, ranges", [(2048, (200, 50, 7, 1)), (1, (20, 3, 1)), (1, (1,)), (4, (30, 7, 1))])
def test_repeated_spans(spark, bucket, ranges, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGES", ranges)
    rng = random.Random(7)
    passage = words(rng, 40)
    texts = [None, "", "é" * 30, "a" * 130, "ab" * 50 + "x" + "ab" * 40, passage, passage, passage[3:] + "é"]
    for _ in range(40):
        a = rng.randrange(len(passage) - 60)
        texts.append(words(rng, rng.randrange(25)) + passage[a : a + rng.randrange(20, 60)] + words(rng, rng.randrange(25)) + rng.choice(["", passage[:50]]))
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffix_dedup.repeated_spans(documents(spark, texts), 40, 8, bucket).collect()}
    assert [got[i] for i in range(len(texts))] == repeated(texts, 40)


def test_repeated_spans_of_null_and_repeated_ids(spark):
    """Rows without a doc_id, or with one that others have, are documents of their own; long texts and clashing columns."""
    rng = random.Random(10)
    shared, other = words(rng, 30, 5000), words(rng, 25, 5000)
    rows = [(None, f"x {shared}"), (1, f"{shared} y"), (None, None), (2, f"a {other}"), (2, f"{other} b"), (3, words(rng, 30_000, 5000) + other), (4, "")]
    got = suffix_dedup.repeated_spans(spark.createDataFrame([(*r, 1, "k", 2) for r in rows], "doc_id long, text string, row long, key string, _row int"), 60, 16).collect()
    want = repeated([t for _, t in rows], 60)
    assert sorted(((r["doc_id"], *tuple(r)[1:5]) for r in got), key=str) == sorted(((d, *w) for (d, _), w in zip(rows, want)), key=str)
    assert sum(w[1] > 0 for w in want) == 5


def test_an_anchor_of_very_many_contexts(spark):
    """2,100 different contexts around one line, some of which share a window."""
    rng = random.Random(12)
    line = "the very common line of many documents"
    texts = [f"{words(rng, 8, 9000)} {line} {words(rng, 8, 9000)}" for _ in range(2100)]
    texts += [f"one {words(rng, 2)} tail of some {line} head of others", f"{words(rng, 4)} tail of some {line} head of others and more"]
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffix_dedup.repeated_spans(documents(spark, texts), 60, 30, 500).collect()}
    want = repeated(texts, 60)
    assert [got[i] for i in range(len(texts))] == want and sum(w[1] > 0 for w in want) >= 2


def test_repeated_spans_of_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 64)
    rng = random.Random(8)
    texts = [words(rng, 60), words(rng, 60)]
    texts.append(texts[0][20:150] + texts[1][5:90])
    import pyarrow as pa

    found = [b for b in suffix_dedup._contexts(40, 8)(iter([pa.record_batch([pa.array([0, 1, 2]), pa.array(texts)], ["row", "text"])]))]
    windows = collections.Counter()
    for b in found:
        for r in b.to_pylist():
            windows.update((r["row"], p) for p in range(r["start"], r["start"] + r["len"] - 39))
    assert windows == collections.Counter((d, p) for d, t in enumerate(texts) for p in range(len(t) - 39))


def test_dedup_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert suffix_dedup.repeated_spans(none).count() == 0 and minhash.near_duplicates(none).count() == 0
    assert embed_dedup.vector_links(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def shingles(text, k=5):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ") if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.mark.parametrize("tile", [512, 4])
def test_near_duplicates(spark, tile, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = random.Random(9)
    texts = [None, "", " \n", "one two", "One  TWO", "two one", "É a", "é a"]
    for _ in range(6):
        base = words(rng, 60, 400).split(" ")
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(99)}"
            texts.append(" ".join(copy))
    texts += [texts[20]] * 3 + [words(rng, 9000, 3000)]
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = components(range(len(texts)), links)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(documents(spark, texts)).collect()}
    assert {i: got[i]["component_id"] for i in got} == want
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_near_duplicates_of_null_and_repeated_ids(spark):
    """Rows without a doc_id, or with one that others have: each is a document, one of a group is kept."""
    rng = random.Random(11)
    one, two, three = (words(rng, 80, 900) for _ in range(3))
    rows = [(None, one), (None, one), (7, f"{one} end"), (7, two), (7, f"{two} end"), (3, two + " fin"), (None, three), (None, three + " x"), (None, None), (9, "word " * 50_000)]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, _row int, band string")
    sets = [shingles(t) for _, t in rows]
    got = sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=str)
    groups = [(7, True, [0, 1, 2]), (3, True, [3, 4, 5]), (None, False, [6, 7]), (None, False, [8]), (9, True, [9])]
    want = [(rows[i][0], len(sets[i]), c) for c, _, members in groups for i in members]
    assert sorted((r[:3] for r in got), key=str) == sorted(want, key=str)
    assert sorted((r[2] for r in got if r[3]), key=str) == sorted((c for c, _, _ in groups), key=str)
    kept = minhash.first_of_groups(df)
    assert kept.columns == df.columns
    left = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert [r for r in left if r[0] is not None] == [(3, two + " fin"), (7, f"{one} end"), (9, "word " * 50_000)] and len(left) == 5


def test_shared_counts():
    """Off the diagonal each entry is the size of an intersection."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 9000, n)).astype(np.uint64) for n in (1, 50, 6000, 7000, 300)]
    found = minhash.shared_counts(sets)
    assert all(found[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(5) for j in range(5) if i != j)


def test_agreeing():
    rng = np.random.default_rng(4)
    sig, comp = rng.integers(0, 3, (40, 12)).astype(np.uint16), rng.integers(0, 6, 40)
    want = [any((sig[i] == sig[j]).sum() >= 7 and comp[i] != comp[j] for j in range(40)) for i in range(40)]
    assert minhash.agreeing(sig, comp, 7).tolist() == want and 0 < sum(want) < 40


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 160)]
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + chain + [(5, 5)]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = graph.connected_components(Workspace(spark, "test"), spark.createDataFrame(links, "u long, v long"))
    assert {r["id"]: r["component"] for r in got.collect()} == components(nodes, [x for x in links if x[0] != x[1]])


def good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    x, y = (np.array(v, float) / max(map(abs, v)) for v in (a, b))
    return x @ y / math.sqrt(x @ x) / math.sqrt(y @ y)


def linked_vectors(table):
    """Links by place in ``table`` (vec_id, vector, label)."""
    out = []
    for i, (_, va, la) in enumerate(table):
        for j, (_, vb, lb) in enumerate(table[:i]):
            if la is not None and la == lb and good(va) and good(vb) and len(va) == len(vb) and cosine(va, vb) >= 0.98:
                out.append((i, j))
    return out


@pytest.mark.parametrize("part, block, tile", [(1 << 16, 512, 2048), (20, 7, 16)])
def test_vector_links(spark, part, block, tile, monkeypatch):
    monkeypatch.setattr(embed_dedup, "PART", part)
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    rng = np.random.default_rng(2)
    rows, label = [], [0, 1, None]
    for c in range(12):
        centre = rng.normal(size=8)
        for _ in range(10):
            rows.append([float(np.float32(x)) for x in centre + rng.normal(size=8) * rng.choice([0.0, 0.05, 0.1, 0.2])])
    rows += [[0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, None, [], rows[0], [2 * x for x in rows[0]], [1.0, 2.0]]
    table = [(i * 3, v, label[i % 5 % 3]) for i, v in enumerate(rows)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit("x")).withColumn("n", F.lit(1)).withColumn("_row", F.lit(1))
    links = [(table[a][0], table[b][0]) for a, b in linked_vectors(table)]
    want = components([t[0] for t in table], links)
    degree = collections.Counter(x for p in links for x in p)
    got = {r["vec_id"]: r for r in embed_dedup.vector_links(df).collect()}
    assert {k: r["component_id"] for k, r in got.items()} == want
    assert {k: r["n_links"] for k, r in got.items()} == {t[0]: degree[t[0]] for t in table}


def test_vectors_of_extreme_size_and_without_ids(spark):
    """Squares that overflow or vanish; null and repeated vec_ids are vectors of their own."""
    table = [(9, [1e200, 1e200], 1), (4, [1e200, 1.01e200], 1), (None, [1e-300, 1e-300], 1), (4, [-1.0, 1.0], 1), (4, [-1.0, 1.0], 1), (None, [5.0, -1.0], 1), (7, [1.0, 1.0], 2)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int")
    got = sorted((tuple(r) for r in embed_dedup.vector_links(df).collect()), key=str)
    assert got == sorted([(9, 2, 4, False), (4, 2, 4, True), (None, 2, 4, False), (4, 1, 4, True), (4, 1, 4, False), (None, 0, None, True), (7, 0, 7, True)], key=str)


def test_forest():
    link = np.zeros((6, 6), bool)
    for a, b in ((0, 1), (1, 2), (0, 2), (4, 5)):
        link[a, b] = link[b, a] = True
    found = embed_dedup.forest(link)
    assert len(found) == 3 and components(range(6), found) == components(range(6), [(0, 1), (1, 2), (4, 5)])
