"""SentencePiece encoding with byte spans of the original text, and decoding.

The normaliser takes the longest prefix that the compiled character map knows, then
records, for every normalised byte, the original byte it came from; pieces are found
on the normalised text and projected back through that record. Every text goes that
way; where the map is empty, and only spaces change, the record is made by array
operations.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import lean

SPACE = "▁"
MARK = SPACE.encode()


class CharacterMap:
    """A compiled map: a double-array trie of byte strings, then their replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob) if blob else (0,)
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement) of the longest key that ``raw`` has at ``at``."""
        if not self.units:
            return None
        unit, found = self.units[0], None
        node = _jump(unit)
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != raw[i]:
                break
            node ^= _jump(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, self.units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.texts.index(b"\0", found[1])
        return found[0], self.texts[found[1] : end]


def _jump(unit: int) -> int:
    return (unit >> 10) << ((unit & 1 << 9) >> 6)


class Normaliser:
    """Normalised bytes and, for each and for their end, the original byte offset."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.plain = not self.map.units and self.prefix and not self.squeeze and self.escape

    def aligned(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, original offset of each and of their end)."""
        if self.plain and raw:
            widths = np.where(np.frombuffer(raw, np.uint8) == 0x20, len(MARK), 1)
            widths[0] += len(MARK)
            source = np.append(np.repeat(np.arange(len(raw)), widths), len(raw))
            return MARK + raw.replace(b" ", MARK), source
        out, source = self._mapped(raw)
        return out, np.array(source, np.int64)

    def _mapped(self, raw: bytes) -> tuple[bytes, list[int]]:
        out, source, at, n = bytearray(), [], 0, len(raw)
        steps = []
        while at < n:
            hit = self.map.longest(raw, at)
            if hit is None:
                width = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
                hit = (width, raw[at : at + width])
            # A character that stays as it is goes byte by byte, a replacement to its key's begin.
            steps.append((at, int(raw[at : at + hit[0]] == hit[1]), hit[1]))
            at += hit[0]
        if self.squeeze:
            while steps and steps[0][2] == b" ":
                steps.pop(0)
            if not steps:
                return b"", [n]
        elif not steps:
            return b"", [0]
        mark = MARK if self.escape else b" "
        if self.prefix:
            out += mark
            source += [steps[0][0]] * len(mark)
        blank = self.squeeze
        for lo, each, text in steps:
            if self.squeeze and blank:
                text = text.lstrip(b" ")
            if not text:
                continue
            for k, byte in enumerate(text):
                piece = mark if byte == 0x20 else bytes((byte,))
                out += piece
                source += [lo + each * k] * len(piece)
            blank = text.endswith(b" ")
        end = n
        if self.squeeze:
            while out.endswith(mark):
                end = source[-1]
                del out[-len(mark) :], source[-len(mark) :]
        return bytes(out), [*source, end]


class Codec:
    """Encodes and decodes with one model file.

    Where no piece of the model has a space mark after another character, merges
    cannot cross a run of marks: a text's ids are those of its units (marks and the
    characters up to the next mark) in order, and a table of units met before saves
    the repeated work. Other models take the whole text as one unit. The table is
    emptied when it is full; ids never depend on it.
    """

    MOST = 300_000

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normaliser = Normaliser(model.normalizer_spec)
        self.mark = self.library.piece_to_id(SPACE)
        self.apart = self.normaliser.plain and self.mark != self.library.unk_id() and not any(re.search(f"[^{SPACE}]{SPACE}", p.piece) for p in model.pieces)
        self.pieces = [p.piece.encode() for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.units: dict[str, tuple[bytes, bytes, bytes]] = {}
        self.split = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def _lengths(self, ids: list[int], raw: bytes) -> list[int]:
        """Normalised bytes of each id: a byte piece is one byte; an unknown piece takes what stands before the next known one."""
        out, at = [], 0
        for k, i in enumerate(ids):
            if self.kinds[i] == 6:
                size = 1
            elif self.kinds[i] == 2:
                rest = next((raw.find(self.pieces[j], at + 1) for j in ids[k + 1 :] if self.kinds[j] not in (2, 6)), len(raw))
                size = (rest if rest > at else len(raw)) - at
            else:
                size = len(self.pieces[i])
            out.append(size)
            at += size
        return out

    def _unit(self, unit: str) -> tuple[bytes, bytes, bytes]:
        """(ids, their decimals joined by commas, normalised bytes of each); the unit's first mark is put there by the library."""
        # The library makes nothing of an empty text: a lone mark is its own piece.
        ids = self.library.encode(unit[1:].replace(SPACE, " ")) if len(unit) > 1 else [self.mark]
        found = (np.array(ids, "<i4").tobytes(), ",".join(map(str, ids)).encode(), np.array(self._lengths(ids, unit.encode()), "<i4").tobytes())
        if len(self.units) >= self.MOST:
            self.units.clear()
        if len(unit) <= 64:
            self.units[unit] = found
        return found

    def encode(self, text: str) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
        """(ids, decimals joined by commas, first and past-the-last original byte of each piece)."""
        raw, source = self.normaliser.aligned(text.encode())
        if self.apart and raw and SPACE not in text:
            known = self.units
            found = [known.get(u) or self._unit(u) for u in self.split(raw.decode())]
            ids = np.frombuffer(b"".join([f[0] for f in found]), "<i4")
            joined = b",".join([f[1] for f in found])
            sizes = np.frombuffer(b"".join([f[2] for f in found]), "<i4")
        else:
            ids = np.array(self.library.encode(text), np.int32)
            joined = ",".join(map(str, ids.tolist())).encode()
            sizes = np.array(self._lengths(ids.tolist(), raw), np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        places = source[np.minimum(edges, len(source) - 1)]
        return ids, joined, places[:-1], places[1:]

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


#: Codecs that this worker process keeps from task to task, by file.
_CODECS: dict[str, Codec] = {}


def codec_of(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _code(path: str, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                docs, rows = batch.column(0).slice(lo, 256), []
                for text in batch.column(1).slice(lo, 256):
                    ids, joined, begin, end = codec.encode(text.as_py() or "")
                    decoded = codec.decode(ids)
                    covered = int((end - begin).sum())
                    row = (len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), covered)
                    rows.append((*row, ids, begin, end, decoded) if keep else row)
                cols = [docs.cast(pa.int64()), *(pa.array(c) for c in list(zip(*rows))[:4])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes"]
                if keep:
                    tail = list(zip(*rows))[4:]
                    cols += [pa.array(list(tail[0]), pa.list_(pa.int32())), *(pa.array(list(c), pa.list_(pa.int64())) for c in tail[1:3]), pa.array(tail[3], pa.string())]
                    names += ["ids", "begins", "ends", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, span_bytes long"


def encode_decode(docs: DataFrame, model: str, keep: bool = False) -> DataFrame:
    """Encodes and decodes ``docs`` (doc_id long, text string; more columns are ignored) with the model file ``model``.

    Returns doc_id, n_tokens, ids_sha256 (decimal ids joined by commas),
    decoded_sha256, span_bytes (original bytes covered by the pieces' spans); with
    ``keep`` also ids, begins and ends (original byte spans), decoded. No begin or
    end ids, no sampling. Null and empty texts have no ids and decode to the empty
    text. Rows are independent: repeated ids and an empty table need no care.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(_code(model, keep)), DIGEST + (", ids array<int>, begins array<long>, ends array<long>, decoded string" if keep else ""))
