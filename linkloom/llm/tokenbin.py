"""Token-id files: flat unsigned integers beside 64-bit document offsets.

A shard ``tokens-*.bin`` holds the ids of a range of doc_id values in ascending
order as little-endian 16-bit integers, or 32-bit if the vocabulary needs them;
``tokens-*.idx`` holds its document count, the doc_id values and the 64-bit
offsets (in ids, from the shard's begin), all 64-bit. A task closes a shard at the
document that takes it past its size and goes on with the next. ``manifest.json``
lists the shards in order with the base of each, a prefix sum of the counts before
it. A task writes into a folder of temporary files and renames what is complete;
names are never used twice, and only the manifest, written last, says which shards
count: a lost task leaves nothing that is read.
"""

from __future__ import annotations

import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Workspace, filesystem, lean, read_small, write_small

DONE = "first long, part int, docs long, ids long, name string"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Bytes of ids after which a shard is closed.
ROLL = 256 << 20


def byte_letters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 ones for themselves, the others from 256 on in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def _ends_in_letter(core: str) -> bool:
    """Whether the last character of ``core`` is a letter, and still ends in one in normal form and lower case."""
    last = core[-1]
    if last.isascii():
        return last.isalpha()
    return last.isalpha() and unicodedata.normalize("NFC", last.lower())[-1].isalpha() and unicodedata.normalize("NFC", last)[-1].isalpha()


class UnitEncoder(dict):
    """Unit of text -> its ids as bytes. A unit is what stands between two spaces.

    The tokenizer's normaliser turns white space into single spaces, and its split
    never joins across them, so a text's ids are those of its units in order. A unit
    is cut before its closing sentence marks where a letter stands that normal form
    and lower case leave a letter (or it is ASCII), and both parts are looked up, in
    lower case; a word of Latin letters is one piece for the tokenizer's merges,
    everything else goes through the whole tokenizer. The table is emptied when it
    is full; ids never depend on it.
    """

    MOST = 600_000
    TAIL = ",.;:!?"

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.dtype = Tokenizer.from_file(path), dtype
        self.merge, self.letters = self.tokenizer.model.tokenize, byte_letters()

    def __missing__(self, unit: str) -> bytes:
        core = unit.rstrip(self.TAIL)
        low = unit if "<|" in unit or "Σ" in unit else unit.lower()
        if core and len(core) < len(unit) and _ends_in_letter(core):
            ids = self[core] + self[unit[len(core) :]]
        elif low != unit:
            ids = self[low]
        elif unit.isalpha() and max(unit) < "ɐ" and len(unit) <= 64:
            # Latin letters are composed already, and lower case has kept them letters.
            word = unit if unit.isascii() else "".join([self.letters[b] for b in unit.encode()])
            ids = np.array([t.id for t in self.merge(word)], self.dtype).tobytes()
        else:
            ids = np.array(self.tokenizer.encode(unit, add_special_tokens=False).ids, self.dtype).tobytes()
        if len(unit) <= 64:
            self[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if len(self) >= self.MOST:
            self.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


#: Encoders that this worker process keeps from task to task, by file and type.
_ENCODERS: dict[tuple[str, str], UnitEncoder] = {}


def encoder_of(path: str, dtype: str) -> UnitEncoder:
    if (path, dtype) not in _ENCODERS:
        _ENCODERS[path, dtype] = UnitEncoder(path, dtype)
    return _ENCODERS[path, dtype]


def id_type(path: str, extra: int) -> str:
    """The smallest unsigned type that holds every id."""
    from tokenizers import Tokenizer

    most = max(Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) - 1, extra)
    return "<u2" if most < 1 << 16 else "<u4"


def _write(root: str, tokenizer: str, end_id: int, dtype: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(tokenizer, dtype), np.array([end_id], dtype).tobytes()
        width, task, part = np.dtype(dtype).itemsize, uuid.uuid4().hex, 0
        store = path = sink = None
        ids, offsets, total = [], [], 0

        def close():
            """Completes the shard: the index beside it, then both get their names."""
            nonlocal sink, ids, offsets, total, part
            sink.close()
            name, part_file = f"tokens-{task}-{part:05d}", f"{path}/_temporary/{task}-{part}"
            with store.open_output_stream(f"{part_file}.idx") as f:
                f.write(np.array([len(ids), *ids, *offsets, total], "<i8").tobytes())
            for kind in ("bin", "idx"):
                store.move(f"{part_file}.{kind}", f"{path}/{name}.{kind}")
            row = pa.RecordBatch.from_arrays([pa.array([ids[0]], pa.int64()), pa.array([part], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([total], pa.int64()), pa.array([name])], names=["first", "part", "docs", "ids", "name"])
            sink, ids, offsets, total, part = None, [], [], 0, part + 1
            return row

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if sink is None:
                    store, path = filesystem(root)
                    sink = store.open_output_stream(f"{path}/_temporary/{task}-{part}.bin")
                found = encoder.encode(text.as_py() or "") + end
                sink.write(found)
                ids.append(doc)
                offsets.append(total)
                total += len(found) // width
                if total * width >= roll:
                    yield close()
        if sink is not None:
            yield close()

    return run


def _mapped(store, path: str):
    """(begin, end) -> those bytes of a file: memory-mapped where the store is a local folder, else read from there on."""
    if store.type_name == "local":
        import os

        whole = np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
        return lambda begin, end: whole[begin:end]
    file = store.open_input_file(path)
    return lambda begin, end: np.frombuffer(file.read_at(end - begin, begin), np.uint8)


def _read(root: str, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base in zip(*(c.to_pylist() for c in batch.columns)):
                store, path = filesystem(f"{root}/{shard}")
                index, ids, width = _mapped(store, f"{path}.idx"), _mapped(store, f"{path}.bin"), np.dtype(dtype).itemsize
                n = int(index(0, 8).view("<i8")[0])
                docs, offsets = index(8, 8 * n + 8).view("<i8"), index(8 * n + 8, 16 * n + 16).view("<i8")
                for lo in range(0, n, 4096):
                    hi = min(n, lo + 4096)
                    crc = [zlib.crc32(ids(width * int(offsets[i]), width * int(offsets[i + 1])).view(dtype).astype("<u4")) for i in range(lo, hi)]
                    yield pa.RecordBatch.from_arrays([pa.array(docs[lo:hi]), pa.array(offsets[lo:hi] + base), pa.array(offsets[lo + 1 : hi + 1] - offsets[lo:hi]), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def write_token_files(docs: DataFrame, root: str, tokenizer: str, end_id: int = 1, roll: int = ROLL) -> dict:
    """Write ``docs`` (doc_id long, text string; more columns are ignored) to shards under ``root``; returns the manifest.

    Null and empty texts have the end id only. Rows without doc_id have no place in
    the order and are left out; repeated values stand side by side, in the order of
    their texts. Special-token strings in a text are what the tokenizer makes of
    them. An empty table gives a manifest without shards. A shard is closed at
    ``roll`` bytes of ids, so that the driver gets one line for so many.
    """
    spark = docs.sparkSession
    dtype = id_type(tokenizer, end_id)
    store, path = filesystem(root)
    store.create_dir(f"{path}/_temporary", recursive=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("doc_id is not null").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    # Ranges do not overlap, and a task's shards follow each other: first ids and numbers give their order.
    done = sorted(tuple(r) for r in rows.mapInArrow(lean(_write(root, tokenizer, end_id, dtype, roll)), DONE).collect())
    store.delete_dir(f"{path}/_temporary")
    shards, base = [], 0
    for _, _, count, ids, name in done:
        shards.append({"name": name, "base": base, "docs": count, "ids": ids})
        base += ids
    manifest = {"dtype": dtype, "end_id": end_id, "ids": base, "shards": shards}
    write_small(f"{root}/manifest.json", manifest)
    return manifest


def read_token_files(spark: SparkSession, root: str) -> DataFrame:
    """A row for each document of the shards: doc_id, start (ids before it), n_tokens, ids_crc32 (of 32-bit ids)."""
    manifest = read_small(f"{root}/manifest.json")
    shards = [(s["name"], s["base"]) for s in manifest["shards"]]
    if not shards:
        return spark.createDataFrame([], ROWS)
    table = spark.createDataFrame(shards, "shard string, base long").repartition(len(shards), "shard")
    return table.mapInArrow(lean(_read(root, manifest["dtype"])), ROWS)


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Writes the token files of ``docs`` to the shared folder and reads them back."""
    root = Workspace(docs.sparkSession, "tokens").path("files")
    write_token_files(docs, root, tokenizer, end_id)
    return read_token_files(docs.sparkSession, root)
