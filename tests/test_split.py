"""Sources read by ranges against the same read in one piece."""

import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from linkloom.sources import readers, split


def toggled(text):
    """Records of a text, one character after the other: a quote changes the state, two inside quotes are one."""
    rows, row, cell, inside, i = [], [], "", False, 0
    while i < len(text):
        c = text[i]
        if c == '"' and inside and text[i + 1 : i + 2] == '"':
            cell += c
            i += 1
        elif c == '"':
            inside = not inside
        elif c == "\t" and not inside:
            row.append(cell)
            cell = ""
        elif c in "\r\n" and not inside:
            i += text[i : i + 2] == "\r\n"
            rows.append([*row, cell])
            row, cell = [], ""
        else:
            cell += c
        i += 1
    if cell or row:
        rows.append([*row, cell])
    return [r for r in rows if any(r)]


@pytest.mark.parametrize("seed", range(40))
def test_records_by_ranges(seed):
    draw = random.Random(seed)
    text = "".join(draw.choices(['"', '""', "\t", "\n", "\r\n", "\r", "a", "bc", "é", " "], [2, 1, 3, 3, 1, 0.3, 6, 4, 1, 1], k=draw.randrange(1, 120)))
    data = text.encode()
    for size in (1, 2, 3, 7, 40, 1000):
        got, odd = [], 0
        for low in range(0, len(data), size):
            f = io.BytesIO(data)
            begin, end = split._edge(f, low, len(data)) if low else 0, split._edge(f, min(low + size, len(data)), len(data))
            end = max(begin, end)
            if begin < len(data):
                got += [cells for _, cells in split._read_range(f, b"\t", begin, end, len(data), odd % 2 == 1) if any(cells)]
            odd += data[begin:end].count(b'"')
        assert [[c.decode() for c in r] for r in got] == toggled(text), size


def test_toggled_table(spark, tmp_path):
    """Several files, each with its header; a quote inside a cell, short rows, a table without a row, no file at all."""
    (tmp_path / "a.tsv").write_bytes('﻿k\tv\n1\ta"b\tc"d\n2\n\t\n'.encode())
    (tmp_path / "b.tsv").write_bytes(b'k\tv\r\n"3\n"\t""""\r\n4\tx')
    rows = readers.toggled_tsv(spark, str(tmp_path)).orderBy("_ord").drop("_ord")
    assert [tuple(r) for r in rows.collect()] == [("1", "ab\tcd"), ("2", ""), ("3\n", '"'), ("4", "x")] and rows.columns == ["k", "v"]
    body = split.quoted_rows(spark, str(tmp_path), size=5).where("not first").orderBy("file", "line")
    assert [r["cells"] for r in body.collect()] == [["1", "ab\tcd"], ["2"], ["3\n", '"'], ["4", "x"]]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "c.tsv").write_bytes(b"")
    assert readers.toggled_tsv(spark, str(tmp_path / "empty")).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_block_lines_by_ranges(seed):
    draw = random.Random(seed)
    lines = [draw.choice("abcd").encode() * draw.choice([0, 1, 3, 50, 400, 70_000]) for _ in range(draw.randrange(0, 60))]
    data = b"\n".join(lines) + b"\n" * draw.randrange(2)
    file = b""
    at = 0
    while at < len(data):
        step = draw.choice([1, 10, 1000, split.BLOCK])
        file += split.compressed(data[at : at + step])
        at += step
    file += split.END
    assert gzip.decompress(file) == data
    want = data.split(b"\n")
    want = want[:-1] if not want[-1] else want
    for size in (30, 1000, 1 << 30):
        got = [x for low in range(0, len(file), size) for x in split.range_lines(io.BytesIO(file), low, min(low + size, len(file)), len(file))]
        assert [x for _, x in got] == want and [p for p, _ in got] == sorted({p for p, _ in got})


def test_block_files(spark, tmp_path):
    """Written by ranges and read by ranges; a plain gzip file among them; the same as Spark's own reader."""
    path = str(tmp_path / "out")
    rows = spark.range(3000, numPartitions=3).select(F.concat(F.lit("line "), "id", F.repeat(F.lit(" é"), (F.col("id") % 90).cast("int"))).alias("value"))
    assert split.write_block_gzip(rows, path) == 3000
    found = split.gzip_lines(spark, f"{path}/*.gz", 512)
    assert found.rdd.getNumPartitions() > 10
    assert [r["value"] for r in found.orderBy("file", "line").collect()] == [r["value"] for r in rows.collect()]
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == sorted(r["value"] for r in rows.collect())
    with gzip.open(f"{path}/plain.gz", "wb") as f:
        f.write(b"##h\r\n9\t1\tx\n")
    both = readers.lines(spark, f"{path}/*.gz")
    assert both.count() == 3002 and sorted(r["value"] for r in both.where(~F.startswith("value", F.lit("line"))).collect()) == ["##h", "9\t1\tx"]
    assert split.gzip_lines(spark, f"{path}/plain.gz", 1).count() == 2
    none = str(tmp_path / "none")
    assert split.write_block_gzip(rows.limit(0), none) == 0


def test_a_cut_off_block():
    file = split.compressed(b"x\n" * 100)
    with pytest.raises(ValueError, match="cut off"):
        list(split.range_lines(io.BytesIO(file[:-9]), 0, len(file), len(file)))
    assert split.member_size(gzip.compress(b"x")) is None


def test_mappings_with_a_preamble_and_quoted_cells(spark, tmp_path):
    """Quotes before the table do not count; a cell over two lines is one."""
    text = '#odd " quote\n# curie_map:\nsubject_id\tsubject_label\tpredicate_id\tobject_id\tobject_label\tconfidence\n' + 'HP:1\t"a\nlabel"\tskos:exactMatch\tMP:1\t"m ""q"""\t0.9\nMP:2\tm2\tskos:closeMatch\thttp://x/obo/HP_2\th2\t\nHP:3\tx\tp\tHP:4\ty\t1\n'
    (tmp_path / "m.tsv").write_text(text)
    rows = readers.sssom(spark, str(tmp_path / "m.tsv"), "s").orderBy("_ord").collect()
    assert [(r["hpo_id"], r["hpo_label"], r["mp_id"], r["mp_label"], r["confidence"]) for r in rows] == [("HP:1", "a\nlabel", "MP:1", 'm "q"', "0.9"), ("HP:2", "h2", "MP:2", "m2", "")]
    for size in (7, 50):
        again = split.quoted_rows(spark, str(tmp_path / "m.tsv"), size=size, marker="(subject_id|object_id)\t").where("not first").orderBy("line").collect()
        assert [r["cells"][0] for r in again] == ["HP:1", "MP:2", "HP:3"]
    (tmp_path / "none.tsv").write_text("# only a preamble\n")
    with pytest.raises(ValueError, match="header"):
        readers.sssom(spark, str(tmp_path / "none.tsv"), "s")
