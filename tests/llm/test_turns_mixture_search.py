"""Conversation repair, source mixing and ranked search against brute force."""

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import mixture, search, turns
from linkloom.llm.shared import Workspace

TURN = "conv_id long, turn long, role string, text string"


def brute_repair(rows):
    """Cheapest edits of [(role, text)] by a search over all edits, least cost first, then least audit."""
    seen, flagged = set(), []
    for role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else ""
        seen.add((role, text))
        flagged.append((role, text, fault))
    heap, done = [(0, "", 0, "e", ())], set()
    while True:
        cost, audit, i, state, said = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in "ea":
            break
        after = {("e", "s"): "s", ("e", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
        for name in ("user", "assistant"):
            if (state, name[0]) in after:
                heapq.heappush(heap, (cost + 2, audit + "I", i, name[0], (*said, f"{name}:")))
        if i < len(rows):
            role, text, fault = flagged[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, said))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                for name, price, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if (state, name[:1]) in after:
                        heapq.heappush(heap, (cost + price + late, audit + letter, i + 1, after[state, name[:1]], (*said, f"{name}:{text}")))
    faults = [f for _, _, f in flagged]
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(rows))
    return (*(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def repair(spark, given, schema=TURN):
    rows = spark.createDataFrame(given, schema)
    return {r["conv_id"]: tuple(r)[1:] for r in turns.repair_table(rows, rows).collect()}


@pytest.mark.parametrize("bits", [1, 8])
def test_repair_equals_a_search_over_all_edits(spark, monkeypatch, bits):
    """Also where a conversation is cut into pieces of two rows, over several partitions."""
    monkeypatch.setattr(turns, "PIECE_BITS", bits)
    draw = random.Random(3)
    roles, texts = ["user", "assistant", "system", "tool", "", " "], ["One.", "Two", "", " \t", "Three!", "Four? \n", "a", "."]
    given, want = [], {}
    for conv in range(60):
        rows = [(draw.choices(roles, [6, 6, 2, 1, 1, 1])[0], draw.choice(texts) + (str(draw.randrange(9)) + "." if draw.random() < 0.5 else "")) for _ in range(draw.randrange(1, 14))]
        given += [(conv, i, role, text) for i, (role, text) in enumerate(rows)]
        want[conv] = (0, *brute_repair(rows))
    draw.shuffle(given)
    assert repair(spark, given) == want


def test_long_conversation_over_many_pieces(spark, monkeypatch):
    """One conversation has nearly all rows; it goes through the folds of pieces, parts and the whole."""
    monkeypatch.setattr(turns, "PIECE_BITS", 3)
    draw = random.Random(5)
    rows = [(draw.choice(["user", "assistant"]), f"{draw.randrange(150)}" + draw.choice(["", ".", "."])) for _ in range(400)]
    got = repair(spark, [(1, i, *r) for i, r in enumerate(rows)] + [(2, 0, "user", "x.")])
    assert got[1] == (0, *brute_repair(rows)) and got[2][6] == "KI"


def test_repair_of_nulls_ties_and_empty_tables(spark):
    null, space = None, " "
    given = [(null, null, null, null), (null, 1, "user", "x."), (7, 3, "user", "a."), (7, 3, "user", "a."), (7, 9, "assistant", "b."), (8, null, "user", "q."), (8, null, "assistant", "r.")]
    got = repair(spark, given)
    assert got[None] == (0, *brute_repair([(space, space), ("user", "x.")]))
    assert got[7] == (9 - 3 + 1 - 2, 0, 1, 0, 1, 3, "KDK", hashlib.sha256(b"user:a.\nassistant:b.").hexdigest())
    # Rows of one turn are in the order of role and text.
    assert got[8] == (0, *brute_repair([("assistant", "r."), ("user", "q.")]))
    assert repair(spark, []) == {}
    wide = spark.createDataFrame([(1, 0, "user", "x" * 2_000_000 + ".", 5, "z")], TURN + ", at long, c string")
    assert [r["audit"] for r in turns.repair_table(wide, wide).collect()] == ["KI"]


def test_damage(spark):
    given = spark.createDataFrame([(c, t, "assistant", "Hm. Yes!") for c in range(40) for t in range(5)] + [(None, None, None, None)], TURN)
    got = {}
    for r in turns.damaged(given).collect():
        got.setdefault((r["conv_id"], r["turn"]), []).append((r["role"], r["text"]))
    for c, t in [(c, t) for c in range(40) for t in range(5)]:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        want = {0: None, 1: [("assistant", "")], 2: [("assistant", "Hm Yes")], 3: [("assistant", "Hm. Yes!")] * 2, 4: [("user", "Hm. Yes!")]}.get(kind, [("assistant", "Hm. Yes!")])
        assert got.get((c, t)) == want
    kind = zlib.crc32(b" : ") % 20
    assert kind > 4 and got[None, None] == [(" ", " ")]


DOC = "doc_id long, text string, source string"


def made_docs(draw, n=600, sources=5):
    return [(i, " ".join(["w"] * draw.randrange(0, 40)), draw.choice([None, *"abcdefgh"[: sources - 1]])) for i in range(n)]


def literal_targets(sizes):
    """Shares by weight; what is above a source's stop is shared again among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, out, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        share = {s: (total - sum(out.values())) * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not above:
            return out | share
        out |= {s: 2.0 * sizes[s] for s in above}
        open_ -= above
    return out


def test_mixing_meets_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixture, "BLOCK_WORDS", 64)
    monkeypatch.setattr(mixture, "BUCKET_WORDS", 256)
    docs = made_docs(random.Random(2))
    rows = spark.createDataFrame(docs, DOC)
    out = mixture.mix_table(rows, 8).collect()
    again = mixture.mix_table(rows.repartition(7), 8).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(key, out)) == sorted(map(key, again)) and len(out) == len(docs)
    size = {d: len((t or "").split()) for d, t, _ in docs}
    source = {d: s for d, _, s in docs}
    sizes = {s: sum(size[d] for d in size if source[d] == s) for s in set(source.values())}
    want = literal_targets(sizes)
    for r in out:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], sizes[s]) and r["target"] == pytest.approx(want[s], rel=1e-9)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    for s in sizes:
        assert abs(sum(r["taken"] for r in out if source[r["doc_id"]] == s) - want[s]) <= 5


def test_shards_are_disjoint_and_whole(spark, monkeypatch):
    monkeypatch.setattr(mixture, "BLOCK_WORDS", 32)
    rows = spark.createDataFrame(made_docs(random.Random(4)), DOC).withColumn("_shard", F.lit("mine"))
    axis, sources, taken = mixture.mix(rows, 16)
    ws = Workspace(spark, "test")
    dealt = mixture.tree(ws, sources, 16, 0).collect()
    quota = {r["rank"]: r["quota"] for r in sources.collect()}
    for rank, q in quota.items():
        assert sum(r["blocks"] for r in dealt if r["rank"] == rank) == q
    shards = {}
    for r in dealt:
        shards[r["shard"]] = shards.get(r["shard"], 0) + r["blocks"]
    total = sum(quota.values())
    n = -(-total // 16)
    assert shards == {i: (i + 1) * total // n - i * total // n for i in range(n)}
    texts = mixture.with_texts(rows, axis, taken).collect()
    assert len(texts) == taken.count()
    places = {}
    for r in texts:
        assert r["_shard"] == "mine"
        places.setdefault(r["_shard_"], []).append(r["_position"])
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in places.values())


def test_hypergeometric_draws(spark):
    """Against the exact distribution, at many quantiles, and at sizes where probabilities underflow."""
    cases = [(20, 7, 9), (50, 50, 10), (50, 0, 10), (13, 5, 13), (1000, 300, 20), (9, 4, 1)]
    given = spark.createDataFrame([(*c, (i + 0.5) / 200) for c in cases for i in range(200)], "n long, k long, m long, u double")
    got = {}
    for r in given.select("n", "k", "m", mixture.hypergeometric(F.col("n"), F.col("k"), F.col("m"), F.col("u")).alias("x")).collect():
        got.setdefault((r["n"], r["k"], r["m"]), []).append(r["x"])
    for (n, k, m), xs in got.items():
        for x in range(max(0, m + k - n), min(k, m) + 1):
            p = math.comb(k, x) * math.comb(n - k, m - x) / math.comb(n, m)
            assert abs(xs.count(x) / 200 - p) <= 2 / 200
    wide = spark.range(300).select(mixture.hypergeometric(F.lit(1_000_000), F.lit(400_000), F.lit(500_000), mixture.uniform(F.lit(1), "id")).alias("x"))
    xs = np.array([r["x"] for r in wide.collect()])
    deviation = math.sqrt(500_000 * 0.4 * 0.6 * 0.5)
    assert abs(xs.mean() - 200_000) < 4 * deviation / math.sqrt(300) and 0.8 < xs.std() / deviation < 1.2


def test_mixing_of_odd_tables(spark):
    assert mixture.mix_table(spark.createDataFrame([], DOC)).count() == 0
    empty = mixture.mix_table(spark.createDataFrame([(1, None, None), (2, "", "a")], DOC)).collect()
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in empty) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    # Equal rows, rows without an id, and one source that has nearly everything.
    same = spark.createDataFrame([(None, "a b", "x")] * 400 + [(5, "c d e", "x")] * 3 + [(6, "f", None)], DOC)
    out = mixture.mix_table(same).collect()
    assert len(out) == 404 and all(r["taken"] <= 2 * r["size"] for r in out)
    assert abs(sum(r["taken"] for r in out) - 1.5 * (800 + 9 + 1)) <= 4


def brute_search(docs, items, k):
    """[(item, rank, doc, score)] by the definition, with Python's integers."""
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    bags = [(d, split(t)) for d, t in docs]
    n_docs, n_terms = sum(1 for _, w in bags if w), sum(len(w) for _, w in bags)
    out = []
    for item, text in items:
        scored = []
        terms = sorted(set(split(text)))
        df = {t: sum(t in w for _, w in bags) for t in terms}
        for d, w in bags:
            m = 50 + 50 * len(w) * n_docs // n_terms if n_terms else 50
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 20 * m)) for t in terms if t in w)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def found(spark, docs, items, k):
    d, b = spark.createDataFrame(docs, "doc_id long, text string, score string, block string"), spark.createDataFrame(items, "item_id long, text string, query string")
    return sorted((tuple(r) for r in search.ranked(d, b, k).collect()), key=str)


@pytest.mark.parametrize("bytes_", [1 << 20, 40])
def test_search_equals_brute_force(spark, monkeypatch, bytes_):
    """In blocks of 64 documents, with queries in one batch and in several."""
    monkeypatch.setattr(search, "BLOCK", 64)
    monkeypatch.setattr(search, "BATCH_BYTES", bytes_)
    monkeypatch.setattr(search, "PIECE", 50)
    draw = random.Random(9)
    words = [f"w{i}" for i in range(30)] + ["Ünïcode", "ABC", "x_y", "né"]
    text = lambda n: draw.choice([" ", "-", "\n"]).join(draw.choices(words, [40 / (1 + i) for i in range(len(words))], k=n))
    docs = [(draw.choice([i, i, i, None, 7]), draw.choice([None, "", "..."]) if i % 17 == 0 else text(draw.randrange(1, 60)), "s", "b") for i in range(400)]
    docs += [(1000 + i, "w1 w2 w3", "s", "b") for i in range(70)]
    items = [(i, text(draw.randrange(1, 9)), "q") for i in range(8)] + [(50, None, "q"), (51, "?!", "q"), (52, "nowhere", "q"), (None, "w1 w29", "q")]
    want = sorted(brute_search([d[:2] for d in docs], [i[:2] for i in items], 10), key=str)
    assert found(spark, docs, items, 10) == want and len(want) > 60


def test_search_of_empty_tables_and_long_texts(spark):
    assert found(spark, [], [(1, "a", "q")], 5) == [] and found(spark, [(1, "a", "s", "b")], [], 5) == []
    long = "Lorem " * 600_000
    docs = [(1, long + "ipsum", "s", "b"), (2, "ipsum", "s", "b"), (3, "x" * 3_000_000, "s", "b"), (4, "dolor", "s", "b")]
    assert found(spark, docs, [(1, "lorem ipsum", "q")], 5) == sorted(brute_search([d[:2] for d in docs], [(1, "lorem ipsum")], 5), key=str)


def test_bit_slices():
    """Sums in slices and the descent through them, against plain numbers with many ties."""
    draw = np.random.default_rng(1)
    for _ in range(30):
        parts = []
        plain = np.zeros(192, np.int64)
        for _ in range(draw.integers(1, 12)):
            places = np.flatnonzero(draw.random(192) < draw.random())
            if len(places):
                values = draw.integers(1, draw.choice([2, 9, 1 << 30]), len(places))
                plain[places] += values
                parts.append(search.spread(places, *search.sliced(values), 192))
        if parts:
            k = int(draw.integers(1, 80))
            places, scores = search.top(search.summed(parts, 3), k)
            order = np.lexsort((np.arange(192), -plain))[:k]
            want = np.sort(order[plain[order] > 0])
            assert places.tolist() == want.tolist() and scores.tolist() == plain[want].tolist()
