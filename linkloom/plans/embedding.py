"""Vectors of short texts from a fitted model: hashed character trigrams, weighed by how rare they are, in a space of few dimensions.

The space is that of the largest singular vectors of the texts' matrix, found by random projection: each pass multiplies
the texts' rows, where they are, with a narrow matrix, and sums the products by blocks of features in a shuffle. The
driver holds matrices of features times dimensions only, whatever the number of texts.

``VectorStore`` keeps vectors by text and model: only texts that it does not have are embedded.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.sources import writers
from linkloom.sources.files import opened

#: Features, the rows of a block of them, dimensions, and dimensions more that the search for the space has.
FEATURES, BLOCK, DIMENSIONS, MORE = 8192, 256, 64, 10
#: Texts that are turned into features at a time.
TEXTS = 2048


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of every three bytes that follow each other in the lower-case texts, with two blanks before and one behind."""
    raw = [f"  {t.lower()} ".encode() for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    row = np.repeat(np.arange(len(raw)), sizes)
    inside = row[:-2] == row[2:] if len(row) > 2 else np.zeros(0, bool)
    codes = (data[:-2] << 16 | data[1:-1] << 8 | data[2:])[inside]
    return row[: len(inside)][inside], codes


def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, times) of the features of texts."""
    row, codes = trigrams(texts)
    feature = (codes * 0x9E3779B1 & 0xFFFFFFFF) >> 19
    keys, times = np.unique(row * FEATURES + feature, return_counts=True)
    return keys // FEATURES, keys % FEATURES, times


def weighed(texts: list[str], rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, weight): rows of length 1."""
    row, feature, times = counted(texts)
    weight = (1 + np.log(times)) * rarity[feature]
    length = np.sqrt(np.bincount(row, weight**2, len(texts)))
    return row, feature, weight / np.maximum(length[row], 1e-12)


def projected(texts: list[str], rarity: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The texts' rows times a matrix of FEATURES rows."""
    out = np.zeros((len(texts), matrix.shape[1]))
    row, feature, weight = weighed(texts, rarity)
    if len(row):
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        out[row[starts]] = np.add.reduceat(matrix[feature] * weight[:, None], starts, axis=0)
    return out


@dataclass
class Embedder:
    """The rarity of each feature, and the space: FEATURES rows of as many columns as a vector has numbers."""

    rarity: np.ndarray
    space: np.ndarray

    def vectors(self, texts: list[str]) -> np.ndarray:
        """Unit vectors; a text without a share in the space has the first unit vector."""
        out = projected(texts, self.rarity, self.space)
        length = np.linalg.norm(out, axis=1, keepdims=True)
        out = np.where(length > 1e-9, out / np.maximum(length, 1e-12), np.eye(1, out.shape[1]))
        return out.astype(np.float32)

    def udf(self):
        """A pandas UDF of text to array<float>."""
        model = self

        @F.pandas_udf("array<float>")
        def embed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for part in parts:
                texts = part.fillna("").tolist()
                rows = [v for at in range(0, len(texts), TEXTS) for v in model.vectors(texts[at : at + TEXTS]).tolist()]
                yield pd.Series(rows)

        return embed

    def save(self, spark: SparkSession, path: str) -> None:
        raw = io.BytesIO()
        np.savez(raw, rarity=self.rarity, space=self.space)
        writers.write_bytes(spark, path, raw.getvalue())

    @classmethod
    def load(cls, path: str) -> "Embedder":
        with opened(path) as f, np.load(io.BytesIO(f.read())) as z:
            return cls(z["rarity"], z["space"])

    @property
    def name(self) -> str:
        return "fitted-" + hashlib.sha256(self.rarity.tobytes() + self.space.tobytes()).hexdigest()[:16]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, rows = np.zeros(FEATURES, np.int64), 0
    for b in batches:
        texts = [t or "" for t in b.column(0).to_pylist()]
        for at in range(0, len(texts), TEXTS):
            seen += np.bincount(counted(texts[at : at + TEXTS])[1], minlength=FEATURES)
        rows += len(texts)
    used = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array([*used, -1], pa.int32()), pa.array([*seen[used], rows], pa.int64())], names=["feature", "n"])


def _product(shared):
    """Rows of texts to blocks of their transposed matrix times itself times the shared one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, matrix = shared.value
        total = np.zeros_like(matrix)
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            for at in range(0, len(texts), TEXTS):
                row, feature, weight = weighed(texts[at : at + TEXTS], rarity)
                near = projected(texts[at : at + TEXTS], rarity, matrix)
                order = np.argsort(feature, kind="stable")
                if len(order):
                    own = feature[order]
                    starts = np.flatnonzero(np.diff(own, prepend=-1))
                    total[own[starts]] += np.add.reduceat(near[row[order]] * weight[order][:, None], starts, axis=0)
        blocks = [(i // BLOCK, total[i : i + BLOCK].tobytes()) for i in range(0, FEATURES, BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())], names=["block", "sums"])

    return run


def _added(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order, summed as a stream."""
    at, total = None, None
    for b in rows:
        for block, sums in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if block != at:
                if total is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "sums"])
                at, total = block, np.zeros(len(sums) // 8)
            total += np.frombuffer(sums)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "sums"])


def fit(texts: DataFrame, dimensions: int = DIMENSIONS, seed: int = 1, passes: int = 3) -> Embedder:
    """A model of ``texts`` (label). Texts are read once for the features' frequencies and once for each pass."""
    spark = texts.sparkSession
    labels = texts.select("label")
    found = labels.mapInArrow(_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()  # at most FEATURES + 1 lines
    counts = {r["feature"]: r["n"] for r in found}
    rows, rarity = counts.pop(-1, 0), np.zeros(FEATURES)
    for feature, n in counts.items():
        rarity[feature] = np.log((1 + rows) / (1 + n)) + 1
    space = np.random.default_rng(seed).normal(size=(FEATURES, dimensions + MORE))
    for _ in range(passes):
        before = np.linalg.qr(space)[0]
        shared = spark.sparkContext.broadcast((rarity, before))
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts = labels.mapInArrow(_product(shared), "block int, sums binary")
        blocks = parts.repartition(min(n, FEATURES // BLOCK), "block").sortWithinPartitions("block").mapInArrow(_added, "block int, sums binary").collect()  # FEATURES / BLOCK lines
        space = np.zeros_like(before)
        for r in blocks:
            at = r["block"] * BLOCK
            space[at : at + BLOCK] = np.frombuffer(r["sums"]).reshape(BLOCK, -1)
    values, turned = np.linalg.eigh((before.T @ space + space.T @ before) / 2)
    return Embedder(rarity, before @ turned[:, np.argsort(-values, kind="stable")[:dimensions]])


def piece_count(text: Column) -> Column:
    """About how many pieces a subword model makes of a text: one for every four characters of a word, and two for the ends."""
    words = F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    return F.aggregate(words, F.lit(2), lambda n, w: n + F.ceil(F.length(w) / 4).cast("int"))


class VectorStore:
    """Vectors by text id below a folder, for each model and length limit: batches, of which only finished ones count."""

    def __init__(self, spark: SparkSession, folder: str, model: str, max_length: int):
        self.spark = spark
        self.path = f"{folder}/{hashlib.sha256(f'{model}|{max_length}'.encode()).hexdigest()[:24]}"

    def batches(self) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.path)
        store = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not store.exists(place):
            return []
        found = [str(s.getPath()) for s in store.listStatus(place) if s.isDirectory()]
        return sorted(p for p in found if store.exists(jvm.org.apache.hadoop.fs.Path(f"{p}/_SUCCESS")))

    def stored(self) -> DataFrame | None:
        found = self.batches()
        return self.spark.read.parquet(*found) if found else None

    def vectors(self, texts: DataFrame, embedder) -> DataFrame:
        """``texts`` (text_id, label) with their vectors; those that are not stored are embedded, those of one length together, and stored."""
        known = self.stored()
        fresh = texts if known is None else texts.join(known.select("text_id"), "text_id", "left_anti")
        if not fresh.isEmpty():
            ranged = fresh.withColumn("_n", F.length("label")).repartitionByRange("_n", "text_id").sortWithinPartitions("_n").drop("_n")
            writers.write_table(ranged.withColumn("embedding", embedder("label")), f"{self.path}/{uuid.uuid4().hex}")
        known = self.stored()
        if known is None:
            return texts.withColumn("embedding", embedder("label"))
        return texts.join(known.select("text_id", "embedding").dropDuplicates(["text_id"]), "text_id")
