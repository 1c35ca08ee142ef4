"""Language identification by interpolated Kneser-Ney character models.

Each language has a character model; all share one sorted array of n-gram hashes
for each order, beside which stands, for every language, the fully interpolated log
probability of the n-gram's last character. The language of the lowest cross-entropy
a character is chosen. Scores and rejection are calibrated on texts that the counts
did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import constants, mix
from .shared import Workspace, lean

ORDER = 4
#: Characters and texts of each language that ``fit`` gathers if not told otherwise, two thirds for the counts and the rest to calibrate.
SAMPLE_CHARS, SAMPLE_ROWS = 1_500_000, 2_400
#: Languages that are learned at most.
LANGUAGES = 8192
#: Languages that share one set of arrays, which grow with its n-grams times its languages.
BLOCK = 16
UNDETERMINED = "und"
_MULT = constants(41, ORDER + 1)

OUT = "doc_id long, lang_pred string, score double, entropy double, rejected boolean"


def fold(text: str) -> str:
    """Lower case with each run of white space as one space."""
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_hashes(chars: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each place from ORDER - 1 on."""
    lo = ORDER - 1
    out = np.full(len(chars) - lo, np.uint64(order), np.uint64)
    for j in range(order):
        out = out * _MULT[ORDER] + (chars[lo - j : len(chars) - j].astype(np.uint64) + np.uint64(1)) * _MULT[j]
    return mix(out)


def padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(characters of all texts, each after ORDER - 1 spaces, first place of each)."""
    parts = [codes(" " * (ORDER - 1) + t) for t in texts]
    return np.concatenate(parts), np.cumsum([0, *(len(p) for p in parts)])


@dataclass
class Model:
    """hashes[k - 1], logs[k - 1]: sorted n-grams of order k and a column of log probabilities for each language;
    contexts[k - 1], weights[k - 1]: contexts of k characters and their log back-off weights; floor: of a character that none knows.
    The arrays have the first BLOCK languages; ``more`` has models of the others, block by block."""

    languages: list[str]
    hashes: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    floor: np.ndarray
    scale: float = 1.0
    limits: np.ndarray | None = None
    more: list[Model] = field(default_factory=list)

    def char_logs(self, chars: np.ndarray) -> np.ndarray:
        """A line of log probabilities for each place from ORDER - 1 on."""
        n = len(chars) - ORDER + 1
        out = np.zeros((n, self.logs[0].shape[1]), np.float32)
        todo = np.arange(n)
        for k in range(ORDER, 0, -1):
            grams = gram_hashes(chars, k)[todo]
            at, hit = _find(self.hashes[k - 1], grams)
            out[todo[hit]] += self.logs[k - 1][at[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            if k > 1:
                back = gram_hashes(np.concatenate([chars[:1], chars[:-1]]), k - 1)[todo]
                at, hit = _find(self.contexts[k - 2], back)
                out[todo[hit]] += self.weights[k - 2][at[hit]]
        out[todo] += self.floor
        return out

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Mean negative log probability a character: a line for each non-empty text."""
        chars, starts = padded(texts)
        logs = self.char_logs(chars)
        # The places that pad a text are no part of it.
        logs = np.concatenate([logs, np.zeros((1, logs.shape[1]), np.float32)])
        edges = np.ravel(np.column_stack([starts[:-1], starts[1:] - ORDER + 1]))
        sums = np.add.reduceat(logs, edges, axis=0, dtype=np.float64)[::2]
        h = -sums / (np.diff(starts) - ORDER + 1)[:, None]
        return np.hstack([h, *(m.entropies(texts) for m in self.more)])

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, entropy, rejected) of each non-empty text."""
        h = self.entropies(texts)
        best = h.argmin(axis=1)
        size = np.sqrt([min(len(t), 400) for t in texts])
        z = (h.min(axis=1)[:, None] - h) * size[:, None] * self.scale
        score = 1 / np.exp(z).sum(axis=1)
        least = h[np.arange(len(h)), best]
        over = (least - self.limits[best, 0]) * size > self.limits[best, 1] if self.limits is not None else np.zeros(len(h), bool)
        return best, score, least, over


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def _counts(chars: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """For each order: (n-gram hash, context hash, shorter n-gram hash, count) of distinct n-grams."""
    inside = np.ones(len(chars) - ORDER + 1, bool)
    for s in starts[1:-1].tolist():
        inside[max(0, s - ORDER + 1) : s] = False
    out, before = [], np.concatenate([chars[:1], chars[:-1]])
    for k in range(1, ORDER + 1):
        grams, first, n = np.unique(gram_hashes(chars, k)[inside], return_index=True, return_counts=True)
        ctx = gram_hashes(before, k - 1)[inside][first] if k > 1 else np.zeros(len(grams), np.uint64)
        low = gram_hashes(chars, k - 1)[inside][first] if k > 1 else np.zeros(len(grams), np.uint64)
        out.append((grams, ctx, low, n))
    return out


def train(samples: dict[str, list[str]]) -> Model:
    """Interpolated Kneser-Ney: counts at the highest order, numbers of different predecessors below it."""
    languages = sorted(samples)
    # Every block knows the characters of all, so that entropies compare across blocks.
    alphabet = np.unique(np.concatenate([np.unique(gram_hashes(padded(samples[x])[0], 1)) for x in languages]))
    first, *more = (_block(languages[i : i + BLOCK], samples, alphabet) for i in range(0, len(languages), BLOCK))
    first.languages, first.more = languages, more
    return first


def _block(languages: list[str], samples: dict[str, list[str]], alphabet: np.ndarray) -> Model:
    """The model of some of the languages; ``alphabet``: sorted hashes of the characters of all."""
    counted = {lang: _counts(*padded(samples[lang])) for lang in languages}
    every = [np.unique(np.concatenate([counted[x][k][0] for x in languages])) for k in range(ORDER)]
    every[0] = alphabet
    heads = [np.unique(np.concatenate([counted[x][k + 1][1] for x in languages])) for k in range(ORDER - 1)]
    # Context and shorter n-gram of each n-gram; n-grams of one hash have the same ones.
    parts = []
    for k in range(ORDER):
        ctx, low = np.zeros(len(every[k]), np.uint64), np.zeros(len(every[k]), np.uint64)
        for x in languages:
            at = np.searchsorted(every[k], counted[x][k][0])
            ctx[at], low[at] = counted[x][k][1], counted[x][k][2]
        parts.append((ctx, low))
    floor = -np.log(len(every[0]) + 1)
    logs = [np.empty((len(e), len(languages)), np.float32) for e in every]
    weights = [np.zeros((len(h), len(languages)), np.float32) for h in heads]
    unseen = np.empty(len(languages), np.float32)
    for j, lang in enumerate(languages):
        lower = None
        for k in range(ORDER):
            grams, ctx, low, n = counted[lang][k]
            if k < ORDER - 1:  # how many different characters come before
                up = counted[lang][k + 1][2]
                use = np.bincount(np.searchsorted(grams, up[np.isin(up, grams)]), minlength=len(grams)).astype(float)
                use[use == 0] = 1
            else:
                use = n.astype(float)
            ones, twos = max(1, int((use == 1).sum())), int((use == 2).sum())
            discount = ones / (ones + 2 * twos)
            if k == 0:
                total, kinds = use.sum(), len(use)
                gamma = np.full(len(every[0]), discount * kinds / total)
                unseen[j] = floor + np.log(max(discount * kinds / total, 1e-9))
                base = np.full(len(every[0]), np.exp(floor))
                share = np.zeros(len(every[0]))
                share[np.searchsorted(every[0], grams)] = np.maximum(use - discount, 0) / total
            else:
                names, inverse = np.unique(ctx, return_inverse=True)
                total, kinds = np.bincount(inverse, use), np.bincount(inverse)
                g = discount * kinds / total
                where = np.searchsorted(heads[k - 1], names)
                weights[k - 1][where, j] = np.log(np.maximum(g, 1e-9))
                at, hit = _find(names, parts[k][0])
                gamma = np.where(hit, g[at], 1.0)
                near, known = _find(every[k - 1], parts[k][1])
                base = np.where(known, lower[near], np.exp(floor))
                share = np.zeros(len(every[k]))
                share[np.searchsorted(every[k], grams)] = np.maximum(use - discount, 0) / total[inverse]
            lower = share + gamma * base
            logs[k][:, j] = np.log(np.maximum(lower, 1e-12))
    return Model(languages, every, logs, heads, weights, unseen)


def calibrate(model: Model, held: dict[str, list[str]], margin: float = 6.0, least: int = 10) -> Model:
    """Sets the scale of the scores by likelihood, and each language's rejection limit.

    A text is rejected if its entropy lies further above its language's mean, in
    units that shrink with the root of its length, than ``margin`` times what all
    but one in a hundred texts of the calibration sample stay under, so that some
    mislabelled ones do not loosen it. A language of fewer than ``least`` calibration
    texts rejects nothing.
    """
    texts = [(lang, t) for lang in model.languages for t in held.get(lang, []) if t]
    if not texts:
        return model
    # Some texts at a time, as their places times the languages of a block are held.
    cuts, size = [0], 0
    for i, (_, t) in enumerate(texts, 1):
        size += len(t)
        if size > 1 << 18 or i == len(texts):
            cuts.append(i)
            size = 0
    h = np.vstack([model.entropies([t for _, t in texts[a:b]]) for a, b in zip(cuts, cuts[1:])])
    truth = np.array([model.languages.index(lang) for lang, _ in texts])
    size = np.sqrt([min(len(t), 400) for _, t in texts])
    gap = (h.min(axis=1)[:, None] - h) * size[:, None]

    def loss(scale: float) -> float:
        z = gap * scale
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean())

    model.scale = min((0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0), key=loss)
    model.limits = np.zeros((len(model.languages), 2))
    for j in range(len(model.languages)):
        own, w = h[truth == j, j], size[truth == j]
        if len(own) >= least:
            mean = float(np.average(own, weights=w**2))
            model.limits[j] = mean, margin * max(1.0, float(np.quantile((own - mean) * w, 0.99)))
        else:
            model.limits[j] = 0, np.inf
    return model


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, most_languages: int = LANGUAGES) -> Model:
    """A model of ``labelled`` (lang, text): the bounded sample of each language is chosen by the text's hash.

    The sample of a language has about ``rows`` different texts and ``chars``
    characters at most, and one text at least; with more than 64 languages each has
    an equal share of 64 such samples, or about twelve texts. Every language that has a
    usable row is learned, up to ``most_languages``: of more, those with the most different
    texts, the first by name among equals; texts of the others are rejected or taken for
    the nearest. A text longer than its language's share teaches by its first characters. Exact copies count once, also for the sample's share. Rows
    of null language, and texts without a letter, teach nothing. Without any usable
    row the model has no language. No text is shuffled but those of the sample.
    """
    ws = Workspace(labelled.sparkSession, "languages")
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    usable = usable.where(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    known = ws.table(usable.select("lang", "h", F.length("text").alias("size")), "known")
    kinds = ws.table(known.groupBy("lang").agg(F.approx_count_distinct("h").alias("kinds")), "kinds")
    languages = kinds.count()
    if languages > most_languages:
        kinds = ws.table(kinds.orderBy(F.desc("kinds"), "lang").limit(most_languages), "most")
        languages = most_languages
    if not languages:
        return Model([], [], [], [], [], np.zeros(0, np.float32))
    want, most = min(rows, max(12, 64 * rows // languages)), min(chars, 64 * chars // languages)
    # Three times what is wanted, by the hash; of these the share that rows and characters leave, by another one.
    share = F.least(F.lit(1.0), F.lit(3.0 * want) / F.col("kinds"))
    some = known.join(kinds, "lang").where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).groupBy("lang", "h").agg(F.min("size").alias("size"))
    some = ws.table(some, "some")
    sums = ws.table(some.groupBy("lang").agg(F.count("*").alias("n"), F.sum("size").alias("sum"), F.min("h").alias("first")), "sums")
    part = F.least(F.lit(1.0), F.lit(float(want)) / F.col("n"), F.lit(float(most)) / F.col("sum"))
    picks = some.join(F.broadcast(sums), "lang").where((F.pmod(F.xxhash64("h"), F.lit(1 << 20)) < part * (1 << 20)) | (F.col("h") == F.col("first")))
    picks = ws.table(picks.select("lang", "h", ((F.pmod(F.xxhash64("h", F.lit(1)), F.lit(3)) == 0) & (F.col("h") != F.col("first"))).alias("held")), "picks")
    texts = usable.withColumn("text", F.substring("text", 1, most)).join(F.broadcast(picks), ["lang", "h"]).groupBy("lang", "h", "held").agg(F.min("text").alias("text"))
    samples: dict[str, list[str]] = {}
    held: dict[str, list[str]] = {}
    for lang, text, apart in sorted(tuple(r) for r in texts.select("lang", "text", "held").collect()):
        (held if apart else samples).setdefault(lang, []).append(fold(text))
    return calibrate(train(samples), held)


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            ids, texts, size, last = [], [], 0, batch.num_rows - 1
            for i, text in enumerate(batch.column(1)):
                raw = text.as_py() or ""
                ids.append(i)
                texts.append(fold(raw))
                size += len(raw)
                if size > 1 << 18 or i == last:
                    yield _rows(m, batch.column(0).take(pa.array(ids)), texts)
                    ids, texts, size = [], [], 0

    return run


def _rows(m: Model, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    n = len(texts)
    lang, score, entropy, rejected = [UNDETERMINED] * n, np.zeros(n), np.zeros(n), np.ones(n, bool)
    some = [i for i, t in enumerate(texts) if has_letter(t)]
    if some and m.languages:
        best, s, h, r = m.predict([texts[i] for i in some])
        for i, b in zip(some, best.tolist()):
            lang[i] = m.languages[b]
        score[some], entropy[some], rejected[some] = s, h, r
    cols = [ids.cast(pa.int64()), pa.array(lang), pa.array(score), pa.array(entropy), pa.array(rejected)]
    return pa.RecordBatch.from_arrays(cols, names=["doc_id", "lang_pred", "score", "entropy", "rejected"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The language of each of ``docs`` (doc_id long, text string; more columns are ignored) by its whole text.

    Returns doc_id, lang_pred, score (0 to 1), entropy (nats a character of the best
    language) and rejected. A null text, or one without letters, is ``und`` with
    score 0 and rejected; so is every text if the model has no language. Ties go to
    the first language by name. Rows are independent of each other.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(_predict(held)), OUT)


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """Those rows of ``docs`` (text; all columns stay) that ``identify`` does not reject, whatever their doc_id; no row is shuffled."""
    held, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column(at).cast(pa.string())], names=["doc_id", "text"])
            rejected = [x for part in _predict(held)(iter([rows])) for x in part.column(4).to_pylist()]
            yield batch.filter(pa.array([not x for x in rejected], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(parts)) == part
