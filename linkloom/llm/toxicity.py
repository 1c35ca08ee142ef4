"""Toxicity by a weighted lexicon: folded text, Aho-Corasick matching, exception phrases, length.

The lexicon is learned from labelled documents. A word's evidence is the number of
different neighbourhoods (the word before and the word after) it has in toxic and in
clean documents, so that a passage copied a thousand times counts once. Exception
phrases are learned with it: pairs of words that only clean documents have. The score
is calibrated on labelled documents that the lexicon did not see.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Workspace, batch_rows, lean

#: Look-alikes of Latin letters in Greek and Cyrillic, and digits and signs that stand for letters.
LOOKALIKES = str.maketrans("аеорсухіјѕԁһӏ" + "αεοριυνκτ" + "0134578@$!", "aeopcyxijsdhl" + "aeopiuvkt" + "oieastbasi")
#: Phrases in which a word of the lexicon says nothing about a person; more are learned.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "moron test", "pathetic fallacy", "scum layer", "pond scum", "loser bracket")
#: Labelled rows that a model is learned from if not told otherwise: the bound of the sample, and of all that is gathered from it.
LABEL_ROWS = 32_768
#: One text in so many, by its hash, calibrates the score; the lexicon is learned from the others.
CALIBRATION_PART = 4
#: A word enters the lexicon with so many toxic neighbourhoods and this share of toxic ones.
LEAST_CONTEXTS, LEAST_SHARE = 6, 0.7
#: A pair of words is an exception with so many different clean texts, and no toxic one.
LEAST_CLEAN = 4
#: Neighbourhoods that a task holds at a time, and words that go to the tasks at a time.
FLUSH, PART_WORDS = 300_000, 100_000

_WORD = re.compile(r"[^\W_]+(?:[@$!][^\W_]+)*")
OUT = "doc_id long, score double, predicted int, weight double, n_words long, matches array<string>"


def fold(text: str) -> str:
    """Lower case, look-alikes and digit substitutions undone; one character for one of the lower-cased text."""
    return text.lower().translate(LOOKALIKES)


def terms(text: str) -> list[str]:
    """Folded words of a text; pure numbers are left out."""
    return [w.translate(LOOKALIKES) for w in _WORD.findall(text.lower()) if not w.isdigit()]


@dataclass
class Lexicon:
    """Weights of words (log odds), exception phrases, and the coefficients of the score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    bias: float = -3.0
    slopes: tuple[float, float, float] = (3.0, 1.0, 0.1)
    machine: object = field(default=None, repr=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "machine"}

    def __setstate__(self, state):
        self.__dict__.update(state, machine=None)

    def automaton(self):
        if self.machine is None:
            import ahocorasick

            self.machine = ahocorasick.Automaton()
            for phrase in self.exceptions:
                self.machine.add_word(fold(phrase), (len(phrase), 0.0, fold(phrase)))
            for word, weight in self.weights.items():
                self.machine.add_word(word, (len(word), weight, word))
            self.machine.make_automaton()
        return self.machine

    def matches(self, text: str) -> list[tuple[float, str]]:
        """Whole words of the lexicon outside every exception phrase; digits are part of words, as in ``terms``."""
        low = text.lower()
        machine = self.automaton()
        if not len(machine):
            return []
        found, shields = [], []
        for end, (size, weight, word) in machine.iter(low.translate(LOOKALIKES)):
            begin = end + 1 - size
            if (begin and low[begin - 1].isalnum()) or (end + 1 < len(low) and low[end + 1].isalnum()):
                continue
            if weight:
                found.append((begin, end, weight, word))
            else:
                shields.append((begin, end))
        # Of the phrases that begin at or before a word, the one that reaches farthest decides.
        shields.sort()
        starts, reach = [s for s, _ in shields], list(itertools.accumulate((t for _, t in shields), max))
        at = [bisect.bisect_right(starts, b) - 1 for b, _, _, _ in found]
        return [(w, x) for i, (b, e, w, x) in zip(at, found) if i < 0 or reach[i] < e]

    def features(self, total: float, hits: int, words: int) -> tuple[float, float, float]:
        """Any hit; the total weight; the weight for each hundred words."""
        return float(hits > 0), math.log1p(max(total, 0.0)), min(100.0 * total / max(words, 1), 20.0)

    def score(self, total: float, hits: int, words: int) -> float:
        x = self.bias + sum(a * b for a, b in zip(self.slopes, self.features(total, hits, words)))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> words with how many of the texts have them."""
    counts = Counter()
    for (text,) in batch_rows(batches):
        counts.update(set(terms(text)))
        if len(counts) > 500_000:
            yield _table(zip(*counts.items()), "word", "n")
            counts = Counter()
    yield _table(zip(*counts.items()), "word", "n")


def _table(columns, *names: str) -> pa.RecordBatch:
    """Columns of strings, but for n, which is a number."""
    cols = list(columns) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if x == "n" else pa.string()) for c, x in zip(cols, names)], names=list(names))


def _around(text: str) -> Iterator[tuple[str, str, str]]:
    """(word, word before, word after); no neighbour is the empty string."""
    seq = ["", *terms(text), ""]
    return zip(seq[1:-1], seq, seq[2:])


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> (word, side, neighbour): different ones of a part of the rows."""
    rows = set()
    for (text,) in batch_rows(batches):
        for word, before, after in _around(text):
            rows.add((word, "before", before))
            rows.add((word, "after", after))
        if len(rows) > FLUSH:
            yield _table(zip(*rows), "word", "side", "near")
            rows = set()
    yield _table(zip(*rows), "word", "side", "near")


def _pairs(most: dict[str, int]):
    """(text) -> (word, before, after): different ones of a part of the rows, for the words of ``most``.

    A word that has more than ``most`` of them needs no more: whatever else it has, it stays over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, left = defaultdict(set), dict(most)
        size = 0
        for (text,) in batch_rows(batches):
            for word, before, after in _around(text):
                if word in left and (before, after) not in (own := rows[word]):
                    own.add((before, after))
                    size += 1
                    if len(own) > left[word]:
                        del left[word]
            if size > FLUSH:
                yield _table(zip(*((w, *x) for w, own in rows.items() for x in own)), "word", "before", "after")
                rows, size = defaultdict(set), 0
        yield _table(zip(*((w, *x) for w, own in rows.items() for x in own)), "word", "before", "after")

    return run


def _phrases(words: set[str]):
    """(toxic, text) -> pairs of neighbours with a word of ``words``, how many texts have them and how many toxic ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, toxic = Counter(), Counter()

        def table():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64()), pa.array([toxic[p] for p in counts], pa.int64())], names=["phrase", "n", "toxic"])

        for label, text in batch_rows(batches):
            seq = terms(text)
            found = {f"{a} {b}" for a, b in zip(seq, seq[1:]) if a in words or b in words}
            counts.update(found)
            if label:
                toxic.update(found)
            if len(counts) > FLUSH:
                yield table()
                counts, toxic = Counter(), Counter()
        yield table()

    return run


def training_rows(docs: DataFrame, labels: DataFrame, most: int = LABEL_ROWS) -> DataFrame:
    """(toxic, text) of at most ``most`` labelled documents, chosen by a hash; all of them where there are fewer.

    The chosen labels are bounded and go to every task, so that no text is shuffled;
    the texts are written once, for the passes over them. ``docs`` has doc_id and
    text, ``labels`` doc_id and toxic.
    """
    known = labels.where("doc_id is not null and toxic is not null").select("doc_id", "toxic")
    rate = min(1.0, 1.25 * most / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20)).orderBy(F.xxhash64("doc_id"), "toxic").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    return Workspace(docs.sparkSession, "toxicity").table(rows, "training")


def learn(labelled: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon from ``labelled`` (toxic 0 or 1, text); null labels and texts teach nothing.

    Exact copies are one text (toxic if any copy is). A word, of any length, enters
    with LEAST_CONTEXTS different toxic texts, neighbours before and neighbours after,
    of which the fewer neighbours are LEAST_SHARE of them and its clean neighbourhoods.
    Pairs of neighbours with such a word that LEAST_CLEAN texts have, and no toxic one,
    are exceptions besides ``exceptions``. One text in CALIBRATION_PART is kept from
    all that and calibrates the score. Without toxic rows the lexicon is empty and
    every score low. What is gathered is bounded by the labelled rows given (see
    ``training_rows``): their words with enough toxic texts, and three numbers for
    each calibration text.
    """
    given = labelled.where("toxic is not null and text is not null").select(F.col("toxic").cast("int").alias("toxic"), F.col("text").cast("string").alias("text"))
    ws = Workspace(labelled.sparkSession, "lexicon")
    rows = ws.table(given.groupBy(F.sha2("text", 256).alias("h")).agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text", (F.pmod(F.crc32("h"), F.lit(CALIBRATION_PART)) == 0).alias("held")), "distinct")
    seen = rows.where("not held")
    toxic, clean = seen.where("toxic <> 0").select("text"), seen.where("toxic = 0").select("text")
    texts = toxic.mapInArrow(lean(_count), "word string, n long").groupBy("word").agg(F.sum("n").alias("texts")).where(F.col("texts") >= LEAST_CONTEXTS)
    sides = toxic.mapInArrow(lean(_sides), "word string, side string, near string").distinct()
    sides = sides.groupBy("word").agg(F.count_if(F.col("side") == "before").alias("a0"), F.count_if(F.col("side") == "after").alias("a1"))
    likely = sides.select("word", F.least("a0", "a1").alias("a")).where(F.col("a") >= LEAST_CONTEXTS).join(texts.select("word"), "word")
    likely = ws.table(likely, "likely")
    # Words go to the tasks in parts of about PART_WORDS; all of them go.
    parts = -(-likely.count() // PART_WORDS)
    weights = {}
    for part in range(parts):
        a = {r["word"]: r["a"] for r in likely.where(F.pmod(F.xxhash64("word"), F.lit(parts)) == part).collect()}
        most = {w: math.floor(n * (1 - LEAST_SHARE) / LEAST_SHARE + 1e-9) for w, n in a.items()}
        near = clean.mapInArrow(lean(_pairs(most)), "word string, before string, after string").distinct().groupBy("word").agg(F.count("*").alias("b"))
        b = {r["word"]: r["b"] for r in near.collect()}
        weights |= {w: math.log((n + 0.5) / (b.get(w, 0) + 0.5)) for w, n in sorted(a.items()) if b.get(w, 0) <= most[w]}
    if not weights:
        return Lexicon({}, exceptions)
    pairs = seen.select("toxic", "text").mapInArrow(lean(_phrases(set(weights))), "phrase string, n long, toxic long")
    learned = pairs.groupBy("phrase").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).where((F.col("n") >= LEAST_CLEAN) & (F.col("toxic") == 0))
    lexicon = Lexicon(weights, (*exceptions, *sorted(r["phrase"] for r in learned.collect())))
    table = rows.where("held").select("toxic", "text").mapInArrow(lean(_measure(lexicon)), "toxic int, total double, hits long, words long").collect()
    _fit(lexicon, sorted(map(tuple, table)))
    return lexicon


def _measure(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = lexicon.matches(text)
                out.append((label, sum(w for w, _ in found), len(found), len(text.split())))
            types = (pa.int32(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 4, types)], names=["toxic", "total", "hits", "words"])

    return run


def _fit(lexicon: Lexicon, table: list) -> None:
    """Logistic regression by Newton steps with a small penalty on the three features."""
    y = np.array([r[0] for r in table], float)
    if not len(y) or y.min() == y.max():
        return
    x = np.array([(1.0, *lexicon.features(*r[1:])) for r in table])
    beta, penalty = np.zeros(4), np.diag([1e-6, 1e-2, 1e-2, 1e-2])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    lexicon.bias, lexicon.slopes = float(beta[0]), tuple(float(b) for b in beta[1:])


def _score(held, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = held.value
        for batch in batches:
            scores, totals, words, found = [], [], [], []
            for text in batch.column(1):
                raw = text.as_py() or ""
                hits = lexicon.matches(raw)
                totals.append(sum(w for w, _ in hits))
                words.append(len(raw.split()))
                scores.append(lexicon.score(totals[-1], len(hits), words[-1]))
                found.append(sorted({x for _, x in hits}))
            cols = [batch.column(0).cast(pa.int64()), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(totals, pa.float64()), pa.array(words, pa.int64()), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "predicted", "weight", "n_words", "matches"])

    return run


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """Scores of ``docs`` (doc_id long, text string; more columns are ignored) by their whole texts.

    Returns doc_id, score (0 to 1), predicted (1 from ``threshold`` on), weight (sum
    over matches), n_words, matches (different words found). Null and empty texts
    score as texts without a match. Rows are independent of each other.
    """
    held = docs.sparkSession.sparkContext.broadcast(lexicon)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(_score(held, threshold)), OUT)
