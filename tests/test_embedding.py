"""The fitted embedder and the vector store."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from linkloom.plans import embedding, semantic

TEXT = "text_id string, label string"


def corpus():
    organs = ["heart", "kidney", "liver", "retina", "cochlea", "thymus", "spleen", "cortex"]
    signs = ["abnormal {} morphology", "increased {} weight", "decreased size of the {}", "{} inflammation", "absent {}", "{} hemorrhage"]
    return [s.format(o) for o in organs for s in signs] + ["hearing loss", "hearing impairment", "loss of hearing", "increased blood glucose level", "elevated blood glucose concentration"]


def test_features_against_plain_python():
    texts = ["Ab c", "", "é", "abab", "x" * 50]
    row, codes = embedding.trigrams(texts)
    want = [(i, raw[k] << 16 | raw[k + 1] << 8 | raw[k + 2]) for i, t in enumerate(texts) for raw in [f"  {t.lower()} ".encode()] for k in range(len(raw) - 2)]
    assert list(zip(row.tolist(), codes.tolist())) == want
    assert embedding.trigrams([])[1].tolist() == []


def test_hashed_embedding_against_a_loop(spark):
    texts = ["Some label", "", "b", "café au lait"]
    got = [r["v"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("v", semantic.hashed_embedding(16)("t")).orderBy("i").collect()]
    for t, v in zip(texts, got):
        want, raw = np.zeros(16), f"  {t.lower()} ".encode()
        for i in range(len(raw) - 2):
            h = zlib.crc32(raw[i : i + 3])
            want[h % 16] += 1 if h >> 16 & 1 else -1
        assert np.allclose(v, want / np.linalg.norm(want), atol=1e-6)


def test_space_is_that_of_the_largest_singular_vectors(spark):
    """Against numpy's decomposition of the whole matrix, from texts in one part and in several."""
    texts = corpus()
    rows = spark.createDataFrame([(t,) for t in texts], "label string")
    model = embedding.fit(rows.repartition(5), 8, passes=6)
    full = np.zeros((len(texts), embedding.FEATURES))
    row, feature, weight = embedding.weighed(texts, model.rarity)
    full[row, feature] = weight
    best = np.linalg.svd(full, full_matrices=False)[1][:8]
    assert np.allclose(np.linalg.norm(full @ model.space, axis=0), best, rtol=2e-2) and np.allclose(model.space.T @ model.space, np.eye(8), atol=1e-8)
    other = embedding.fit(rows.coalesce(1), 8, passes=6)
    assert np.allclose(np.abs(model.space), np.abs(other.space), atol=1e-6)


def test_paraphrases_rank_above_other_texts(spark):
    texts = corpus()
    model = embedding.fit(spark.createDataFrame([(t,) for t in texts], "label string"), 16)
    v = model.vectors(texts)
    assert np.allclose(np.linalg.norm(v, axis=1), 1, atol=1e-5)
    at = {t: i for i, t in enumerate(texts)}
    near = lambda a, b: float(v[at[a]] @ v[at[b]])
    for a, b in (("hearing loss", "hearing impairment"), ("increased blood glucose level", "elevated blood glucose concentration")):
        assert near(a, b) > max(near(a, t) for t in ("abnormal heart morphology", "kidney inflammation", "absent thymus"))
    assert np.allclose(model.vectors(["", "hearing loss"])[1], v[at["hearing loss"]], atol=1e-6) and np.isfinite(model.vectors(["", "\u4e2d"])).all()


def test_only_new_texts_are_embedded(spark, tmp_path):
    """By text and model; a batch that was not finished does not count; the model is fitted once."""
    folder, seen = str(tmp_path / "v"), spark.sparkContext.accumulator(0)
    rows = lambda *texts: spark.createDataFrame([(f"t{t}", t) for t in texts], TEXT)
    fitted = semantic.fitted_embedder(rows("one label", "two labels", "three"), folder)
    assert semantic.fitted_embedder(rows("others"), folder).name == fitted.name

    def counting(c):
        import pandas as pd

        @F.pandas_udf("array<float>")
        def embed(part: pd.Series) -> pd.Series:
            seen.add(len(part))
            return pd.Series(fitted.vectors(part.tolist()).tolist())

        return embed(c)

    first = {r["text_id"]: r["embedding"] for r in semantic.kept_vectors(rows("one label", "two labels"), folder, fitted.name, 128, counting).collect()}
    assert seen.value == 2
    (tmp_path / "v" / embedding.VectorStore(spark, folder, fitted.name, 128).path.rsplit("/", 1)[1] / "lost").mkdir()
    again = {r["text_id"]: r["embedding"] for r in semantic.kept_vectors(rows("two labels", "one label", "three"), folder, fitted.name, 128, counting).collect()}
    assert seen.value == 3 and set(again) == {"tone label", "ttwo labels", "tthree"} and all(again[k] == v for k, v in first.items())
    assert semantic.kept_vectors(rows("one label"), folder, "another", 128, counting).count() == 1 and seen.value == 4
    assert semantic.kept_vectors(rows("one label").limit(0), folder, "third", 128, counting).count() == 0


def test_piece_counts(spark):
    got = spark.createDataFrame([("a bb",), ("",), ("twelve-letter wordpieces",), ("x" * 400,)], "t string").select(embedding.piece_count(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in got] == [4, 2, 2 + 2 + 2 + 3, 102]
