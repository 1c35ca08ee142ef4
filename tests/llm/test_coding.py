"""SentencePiece, token files and WARC: exact against the libraries, and round trips."""

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from linkloom.llm import sentencepiece_codec as spc
from linkloom.llm import tokenbin, warc
from linkloom.llm.shared import Workspace

public_tokenizers = pytest.importorskip("public_tokenizers")
TEXTS = [None, "", " ", "  a  b ", "Hello, world!\nNew\tline", "▁raw ▁ mark", "naïve 日本語 🙂", "<s></s><unk>", "x" * 3000, "don't 12345 ###", "<|endoftext|> a<|startoftext|>b", " a b c", "ǅ İ ß ﬁ é", "a b\x85c\x1cd"]


def documents(spark, texts):
    rng = random.Random(1)
    rows = [(i * 2 + 1, t, "en") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_sentencepiece(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r["doc_id"]: r for r in spc.encode_decode(documents(spark, TEXTS), path, keep=True).collect()}
    for i, text in enumerate(TEXTS):
        r, raw = got[2 * i + 1], (text or "").encode()
        ids = library.encode(text or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == library.decode(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
        # The spans follow each other and cover the whole text.
        assert b"".join(raw[b:e] for b, e in zip(r["begins"], r["ends"])) == raw
        for b, e, k in zip(r["begins"], r["ends"], ids):
            piece = library.id_to_piece(k).replace("▁", " ")
            if not piece.startswith("<0x") and "▁" not in (text or ""):
                assert raw[b:e].decode() in (piece, piece[1:] if b == 0 else piece)


def _trie(keys):
    """A double array for single-byte and longer keys, built by hand: (units, texts)."""
    texts, values = b"", {}
    for k, v in keys.items():
        values[k] = len(texts)
        texts += v + b"\0"
    size, units, used, nodes = 4096, [0] * 4096, {0}, {b"": 0}
    prefixes = sorted({k[:i] for k in keys for i in range(len(k) + 1)}, key=len)
    for p in prefixes:
        here = nodes[p]
        kids = sorted({k[len(p)] for k in keys if k.startswith(p) and len(k) > len(p)}) + ([0] if p in values else [])
        offset = next(o for o in range(256, size, 256) if all((here ^ o ^ c) not in used for c in kids) and (here ^ o) not in used)
        units[here] |= offset << 10 if offset < 1 << 21 else 0
        for c in kids:
            at = here ^ offset ^ c
            used.add(at)
            if c == 0 and p in values:
                units[here] |= 1 << 8
                units[at] = values[p] | 1 << 31
            else:
                units[at] |= c
                nodes[p + bytes([c])] = at
    return struct.pack("<I", size * 4) + struct.pack(f"<{size}I", *units) + texts


def test_character_map():
    blob = _trie({b"A": b"a", b"AB": b"xy", b"\xe3\x80\x80": b" ", b"z": b""})
    m = spc.CharacterMap(blob)
    assert m.longest(b"ABC", 0) == (2, b"xy") and m.longest(b"AC", 0) == (1, b"a") and m.longest(b"Q", 0) is None

    class Spec:
        precompiled_charsmap, add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces = blob, True, True, True

    out, source = spc.Normaliser(Spec).aligned("  AB　 Azq ".encode())
    assert out.decode() == "▁xy▁aq"
    assert source.tolist() == [2, 2, 2, 2, 2, 4, 4, 4, 8, 10, 11]
    for raw, end in ((b"", 0), (b"  ", 2)):
        out, source = spc.Normaliser(Spec).aligned(raw)
        assert out == b"" and source.tolist() == [end]


def test_alignment_by_arrays():
    """Where the map is empty the array form gives what the longest-prefix form gives."""

    class Spec:
        precompiled_charsmap, add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces = b"", True, False, True

    normaliser = spc.Normaliser(Spec)
    for text in TEXTS:
        raw = (text or "").encode()
        out, source = normaliser.aligned(raw)
        slow, places = normaliser._mapped(raw)
        assert (out, source.tolist()) == (slow, places)


def test_sentencepiece_of_repeated_rows(spark):
    """Rows are coded one by one: null and repeated doc_ids, and a text of two million characters."""
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(None, "one two"), (4, "one two"), (4, "one two"), (4, None), (9, "wörd and ▁ " * 200_000)]
    got = sorted((r["doc_id"], r["n_tokens"]) for r in spc.encode_decode(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int"), path).where("doc_id is not null").collect())
    n = len(library.encode("one two"))
    assert got == [(4, 0), (4, n), (4, n), (9, len(library.encode(rows[4][1])))]
    assert spc.encode_decode(spark.createDataFrame(rows, "doc_id long, text string"), path).where("doc_id is null").first()["n_tokens"] == n

def test_letters_before_and_after_marks():
    """Every letter up to U+2FFFF, alone, before and after sentence marks and spaces, against the library."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), tokenbin.UnitEncoder(path, "<u2")
    letters = [c for c in map(chr, range(0x80, 0x30000)) if c.isalpha() and not 0x4E10 < ord(c) < 0x9FF0 and not 0xAC10 < ord(c) < 0xD7A0 and not 0x20010 < ord(c)]
    texts = [f"{c}. a{c}?! .{c}, {c}" for c in letters]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [c for c, t, ids in zip(letters, texts, want) if np.frombuffer(encoder.encode(t), "<u2").tolist() != ids] == []


def test_token_files_of_repeated_ids_and_long_texts(spark):
    """Shards of a few ids, repeated and null doc_ids, a text of a million characters: starts are prefix sums in order."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [(5, "b"), (5, "a a"), (None, "left out"), (-3, None), (9, "word " * 200_000), (7, ""), (5, "a a")] + [(i, f"text {i}.") for i in range(20, 60)]
    root = Workspace(spark, "test").path("tokens")
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS first")
    manifest = tokenbin.write_token_files(df, root, path, roll=64)
    start, want = 0, []
    for doc, text in sorted((d, t or "") for d, t in rows if d is not None):
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, tokenbin.read_token_files(spark, root).collect()), key=lambda r: r[1]) == want
    assert len(manifest["shards"]) > 4 and manifest["ids"] == start
    store, folder = tokenbin.filesystem(root)
    from pyarrow import fs

    names = sorted(f.base_name for f in store.get_file_info(fs.FileSelector(folder, recursive=True)) if not f.base_name.startswith("."))
    assert names == sorted(["manifest.json", *(f"{s['name']}.{k}" for s in manifest["shards"] for k in ("bin", "idx"))])


@pytest.mark.parametrize("most", [400_000, 2])
def test_token_files(spark, most, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    monkeypatch.setattr(tokenbin.UnitEncoder, "MOST", most)
    encoder = tokenbin.UnitEncoder(path, "<u2")
    for text in TEXTS:
        assert np.frombuffer(encoder.encode(text or ""), "<u2").tolist() == library.encode(text or "", add_special_tokens=False).ids
    root = Workspace(spark, "test").path("tokens")
    manifest = tokenbin.write_token_files(documents(spark, TEXTS), root, path)
    got = {r["doc_id"]: tuple(r)[1:] for r in tokenbin.read_token_files(spark, root).collect()}
    start = 0
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert got[2 * i + 1] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert manifest["ids"] == start and manifest["dtype"] == "<u2"


def test_coding_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spc.encode_decode(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert tokenbin.token_table(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert warc.archive_table(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


PAGES = [(1, "http://a/1", "same"), (7, "http://a/7 x\r\ny", "same"), (3, None, None), (4, "u", ""), (5, "u", "é" * 5000), (9, "u", "tiny"), (2, "u", "tiny"), (7, "http://a/7 x\r\ny", "same"), (None, "u", "x")]


@pytest.mark.parametrize("least, roll", [(0, 1 << 20), (5, 1)])
def test_archives(spark, tmp_path, least, roll):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS kind", "'x' AS sha", "2 AS shard", "3 AS size")
    roots = [f"file://{tmp_path}/{k}" for k in "ab"]
    manifests = [sorted(warc.write_archives(df.repartition(3) if r.endswith("b") else df, r, least, roll, shard=4000).collect()) for r in roots]
    assert manifests[0] == manifests[1] and len(manifests[0]) > 1
    got = sorted(tuple(r) for r in warc.read_archives(spark, roots[0], payloads=True).collect())
    heads = {}
    for page, _, html in PAGES:
        if page is not None and len((html or "").encode()) >= least:
            heads[html or ""] = max(page, heads.get(html or "", page))
    seen, want = set(), []
    for page, url, html in sorted((p for p in PAGES if p[0] is not None), key=lambda p: p[0]):
        raw, head = (html or "").encode(), heads.get(html or "")
        first = head is None or (page == head and (page, raw) not in seen)
        seen.add((page, raw))
        want.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit", None if first else head, raw if first else None))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((*r[:5], bytes(r[6]) if r[6] is not None else None) for r in got), key=key) == sorted(want, key=key)
    names = sorted(p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith("."))
    assert names == sorted(["manifest", *(f["name"] for f in manifests[0])])


def test_archives_are_the_same_bytes(spark, tmp_path):
    """Thousands of pages, written again in other partitionings and after other jobs: the same files, byte for byte."""
    rng = random.Random(5)
    rows = [(rng.randrange(10**9), f"http://h{i % 7}/{i}", "".join(rng.choice("abcdef ") for _ in range(rng.randrange(600))) if i % 5 else "shared page") for i in range(4000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = []
    for k, (given, parts) in enumerate(((df, "3"), (df.repartition(7, "url"), "5"), (df.orderBy("html").repartition(2), "2"))):
        held = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        warc.write_archives(given, f"file://{tmp_path}/{k}", roll=30_000, shard=200_000)
        spark.conf.set("spark.sql.shuffle.partitions", held)
        found.append({p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in (tmp_path / str(k)).glob("*.warc.gz")})
        spark.range(1000).repartition(3).count()
    assert found[0] == found[1] == found[2] and len(found[0]) > 8
    assert warc.read_archives(spark, f"file://{tmp_path}/1").count() == len(rows)


def test_shards_of_prefix_sums(spark):
    sizes = spark.createDataFrame([(5, 10), (1, 4), (9, 3), (7, 25), (8, 0), (5, 2)], "page_id long, size long")
    # Before them: 1: 0, 5: 4, 7: 16, 8: 41, 9: 41.
    assert warc.shard_heads(sizes, 10) == [1, 7, 8] and warc.shard_heads(sizes, 1, 2) == [1, 8] and warc.shard_heads(sizes.limit(0)) == []


def test_damaged_record():
    raw = warc.record(1, "u", b"abc", warc.sha1_base32(b"abc"), None)
    assert warc.parse(raw)[:2] == (1, 3)
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"abc\r\n", b"abd\r\n"))


def test_columns_that_clash_and_a_long_payload(spark, tmp_path):
    """Columns named as those that are made inside are ignored; an html of several million characters."""
    names = "doc_id long, text string, n_tokens string, ids_sha256 long, start string, shard string, batch int, _row string"
    docs = spark.createDataFrame([(2, "two words", "x", 1, "y", "z", 3, "r"), (1, None, "x", 1, "y", "z", 3, "r")], names)
    plain = docs.select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    key = lambda rows: sorted(map(tuple, rows.collect()))
    assert key(spc.encode_decode(docs, path)) == key(spc.encode_decode(plain, path))
    words = public_tokenizers.path("word_bpe_49k.json")
    assert key(tokenbin.token_table(docs, words, 1)) == key(tokenbin.token_table(plain, words, 1))
    long = "<p>é</p>" * 500_000
    pages = spark.createDataFrame([(1, "u", long, "a", 5), (2, "u", long, "b", 6), (3, "u", "x", "c", 7)], "page_id long, url string, html string, record_type string, size int")
    got = {r["page_id"]: r for r in warc.archive_table(pages, 0).collect()}
    raw = long.encode()
    digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
    assert (got[2]["payload_bytes"], got[2]["payload_digest"], got[2]["record_type"]) == (len(raw), digest, "response")
    assert (got[1]["record_type"], got[1]["refers_to"], got[3]["record_type"]) == ("revisit", 2, "response")
