"""Vector linkage: distinct texts, exact cosine within a gene, banded and ranked pairs, views over them."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.operators.keys import top_k_or_threshold
from linkloom.operators.tiles import ROWS, best_pairs, pairs_from  # noqa: F401
from linkloom.plans import embedding
from linkloom.settings import DEFAULT, ORTHOLOG_SOURCE, PHRASE_AUDITS, Settings


def collapse_orthologs(orthologs: DataFrame) -> DataFrame:
    """One row for each (human id, marker): mouse ids as a sorted union; any other difference raises."""
    other = [c for c in orthologs.columns if c not in ("human_ncbi_gene_id", "mgi_marker_id", "mouse_ncbi_gene_id", "_ord")]
    union = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(X.pipe_list("mouse_ncbi_gene_id"))))), "|")
    same = [F.when(F.count_distinct(c) > 1, F.raise_error(F.lit(f"orthologs differ in {c}"))).otherwise(F.min(c)).alias(c) for c in other]
    return orthologs.groupBy("human_ncbi_gene_id", "mgi_marker_id").agg(*same, union.alias("mouse_ncbi_gene_id"))


def usable_annotations(rows: DataFrame, label: str, settings: Settings = DEFAULT) -> DataFrame:
    """Rows with a label that is no placeholder: cleaned label and its text id."""
    out = rows.withColumn("label", X.clean_text(label)).where((F.col("label") != "") & ~F.lower("label").isin(*settings.placeholders))
    return out.withColumn("text_id", X.content_id("PT:", "label"))


def text_catalog(**annotations: DataFrame) -> DataFrame:
    """Distinct texts with the sorted uses (argument names) of each."""
    every = None
    for use, df in annotations.items():
        part = df.select("text_id", "label", F.lit(use).alias("use"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy("text_id", "label").agg(F.array_join(F.array_sort(F.collect_set("use")), "|").alias("usage"))


#: CRC-32 of a byte after another state (a fixed value: the polynomial).
CRC = np.array([functools.reduce(lambda c, _: c >> 1 ^ (0xEDB88320 if c & 1 else 0), range(8), i) for i in range(256)], np.int64)


def hashed_embedding(dimensions: int = 64):
    """A deterministic embedder of character trigrams that nothing is fitted for: each adds 1 or -1 to a number chosen by its CRC-32."""

    @F.pandas_udf("array<float>")
    def embed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            out = []
            for at in range(0, len(texts), embedding.TEXTS):
                some = texts.iloc[at : at + embedding.TEXTS].fillna("").tolist()
                row, codes = embedding.trigrams(some)
                h = np.full(len(codes), 0xFFFFFFFF, np.int64)
                for shift in (16, 8, 0):
                    h = CRC[(h ^ codes >> shift) & 255] ^ h >> 8
                h ^= 0xFFFFFFFF
                v = np.bincount(row * dimensions + h % dimensions, np.where(h >> 16 & 1, 1.0, -1.0), len(some) * dimensions).reshape(len(some), dimensions)
                n = np.linalg.norm(v, axis=1, keepdims=True)
                out += np.divide(v, n, out=v, where=n > 0).astype(np.float32).tolist()
            yield pd.Series(out)

    return embed


def embed_texts(texts: DataFrame, embedder=None) -> DataFrame:
    """``texts`` with an embedding column. Any pandas UDF of text to array<float> serves; texts come to it by length, so
    that those of one batch are of about one length."""
    return texts.sortWithinPartitions(F.length("label")).withColumn("embedding", (embedder or hashed_embedding())("label"))


def scored_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Cosine of every (left, right) pair of unit vectors within a gene: gene, left_id, right_id, score.

    Both sides have gene, id, embedding. Scores are dot products in double precision,
    held to [-1, 1]; a score beyond that by more than 1e-5, or none, raises later in
    the band. The score is made below a window, so it is computed once.
    """
    pairs = left.select("gene", F.col("id").alias("left_id"), F.col("embedding").alias("_l")).join(right.select("gene", F.col("id").alias("right_id"), F.col("embedding").alias("_r")), "gene")
    return pairs.select("gene", "left_id", "right_id", X.dot("_l", "_r").alias("score"))


def gene_matches(left: DataFrame, right: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """What ``matches(scored_pairs(left, right))`` has, scored by tiles: no other pair leaves a task, and a gene may have any size."""
    kept = best_pairs(left, right, settings.top_k, settings.band_b)
    return kept.withColumn("cosine_class", X.cosine_band("score", settings.band_a, settings.band_b, settings.band_c))


def matches(pairs: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Pairs of rank <= top_k of their (gene, left_id), and all from the B band on, with their band."""
    kept = top_k_or_threshold(pairs, ["gene", "left_id"], [F.desc("score"), "right_id"], "score", settings.top_k, settings.band_b)
    return kept.withColumn("cosine_class", X.cosine_band("score", settings.band_a, settings.band_b, settings.band_c))


def flagged_matches(found: DataFrame, texts: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """``matches`` by text ids with directions, negation, review status, match_id and eligible_for_default_use."""
    side = lambda s: texts.select(F.col("text_id").alias(f"{s}_id"), F.col("label").alias(f"{s}_label"), F.col("truncated").alias(f"{s}_truncated"))
    out = found.join(side("left"), "left_id").join(side("right"), "right_id")
    out = out.withColumns({"left_direction": X.direction("left_label"), "right_direction": X.direction("right_label"), "negation_flag": X.has_negation("left_label", "right_label").cast("int")})
    conflict = X.directions_conflict("left_direction", "right_direction")
    out = out.withColumn("direction_conflict", conflict.cast("int"))
    status = X.review_status(conflict, F.col("negation_flag") == 1, F.col("left_truncated") | F.col("right_truncated"))
    return out.withColumns({
        "review_status": status,
        "match_id": X.content_id("SM:", "gene", "gene", "left_id", "right_id", F.lit(settings.revision)),
        "eligible_for_default_use": F.col("cosine_class").isin(*settings.default_bands).cast("int"),
    })


#: Columns of a published match (fixed values), and of the narrower stored table.
PAIRS = ["match_id", "human_gene", "mouse_gene", "human_text_id", "mouse_text_id", "human_phenotype_label", "mouse_phenotype_label", "cosine_similarity", "cosine_class", "retrieval_rank", "mouse_texts_in_gene", "human_direction", "mouse_direction", "direction_conflict", "negation_flag", "review_status", "human_text_truncated", "mouse_text_truncated", "model_id", "model_revision", "ortholog_source", "eligible_for_default_use"]
STORED = [c for c in PAIRS if c not in ("human_phenotype_label", "mouse_phenotype_label", "model_id", "model_revision", "ortholog_source")]


def published_matches(flagged: DataFrame, orthologs: DataFrame, model_id: str, revision: str) -> DataFrame:
    """Flagged matches (gene is the human gene) with both gene names, labels and the model that scored them."""
    out = flagged.join(orthologs.select(F.col("human_gene").alias("gene"), "mouse_gene").distinct(), "gene")
    side = {"human_gene": "gene", "human_text_id": "left_id", "mouse_text_id": "right_id", "human_phenotype_label": "left_label", "mouse_phenotype_label": "right_label", "cosine_similarity": "score", "mouse_texts_in_gene": "group_size", "human_direction": "left_direction", "mouse_direction": "right_direction", "human_text_truncated": "left_truncated", "mouse_text_truncated": "right_truncated"}
    given = {"match_id": X.content_id("SM:", "gene", "mouse_gene", "left_id", "right_id", F.lit(revision)), "model_id": F.lit(model_id), "model_revision": F.lit(revision), "ortholog_source": F.lit(ORTHOLOG_SOURCE)}
    return out.select(*(given[c].alias(c) if c in given else F.col(side.get(c, c)).alias(c) for c in PAIRS))


def phenotype_pairs(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Matches with both labels."""
    t = texts.select("text_id", "label")
    return found.join(t.toDF("left_id", "human_label"), "left_id").join(t.toDF("right_id", "mouse_label"), "right_id")


def variant_correspondence(found: DataFrame, human: DataFrame, mouse: DataFrame) -> DataFrame:
    """Matches spread over the annotations of their texts, within the gene only."""
    h = human.withColumnRenamed("text_id", "left_id")
    m = mouse.withColumnRenamed("text_id", "right_id")
    return found.join(h, ["gene", "left_id"]).join(m, ["gene", "right_id"])


def active(found: DataFrame) -> DataFrame:
    return found.where("eligible_for_default_use = 1")


def avoided_comparisons(human: DataFrame, mouse: DataFrame) -> DataFrame:
    """Sum over genes of rows on one side times rows on the other."""
    n = human.groupBy("gene").agg(F.count("*").alias("a")).join(mouse.groupBy("gene").agg(F.count("*").alias("b")), "gene")
    return n.agg(F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("comparisons"))


def gene_texts(human: DataFrame, mouse: DataFrame) -> DataFrame:
    """Genes that both sides (gene, text_id) have: distinct texts and rows of each, text pairs compared, row pairs avoided by it."""
    side = lambda df, s: df.groupBy("gene").agg(F.count_distinct("text_id").alias(f"{s}_texts"), F.count("*").alias(f"{s}_rows"))
    out = side(human, "human").join(side(mouse, "mouse"), "gene")
    return out.select("gene", "human_texts", "mouse_texts", "human_rows", "mouse_rows", (F.col("human_texts") * F.col("mouse_texts")).alias("compared"), (F.col("human_rows") * F.col("mouse_rows")).alias("avoided"))


def compared_totals(genes: DataFrame, found: DataFrame) -> DataFrame:
    """One line: genes with both sides, text pairs compared, and those of them that were not kept."""
    total = genes.agg(F.count("*").alias("genes"), F.coalesce(F.sum("compared"), F.lit(0)).alias("compared"))
    kept = found.agg(F.count("*").alias("kept"))
    return total.crossJoin(F.broadcast(kept)).select("genes", "compared", (F.col("compared") - F.col("kept")).alias("omitted"))  # one line each


def norm_audit(vectors: DataFrame) -> DataFrame:
    """vectors, and the least, the largest and the largest error of their lengths against 1; a non-finite one makes it infinite."""
    length = F.sqrt(X.dot("embedding", "embedding"))
    error = F.when(F.isnan(length) | length.isNull(), F.lit(float("inf"))).otherwise(F.abs(length - 1))
    return vectors.agg(F.count("*").alias("vectors"), F.min(length).alias("least"), F.max(length).alias("largest"), F.max(error).alias("largest_error"))


def rescored(found: DataFrame, vectors: DataFrame, rows: int = 1000) -> DataFrame:
    """The first ``rows`` matches by id, scored again, with the difference: a check of tolerance 1e-5."""
    some = found.orderBy("match_id").limit(rows)
    v = vectors.select("text_id", "embedding")
    some = some.join(v.toDF("left_id", "_l"), "left_id").join(v.toDF("right_id", "_r"), "right_id")
    return some.select("match_id", "score", F.abs(F.col("score") - X.dot("_l", "_r")).alias("difference"))


def kept_vectors(texts: DataFrame, folder: str, model: str, max_length: int, embedder=None) -> DataFrame:
    """``texts`` (text_id, label) with their vectors, kept below ``folder`` by text and model: only texts that are not there are embedded."""
    return embedding.VectorStore(texts.sparkSession, folder, model, max_length).vectors(texts, embedder or hashed_embedding())


def fitted_embedder(texts: DataFrame, folder: str) -> embedding.Embedder:
    """The model below ``folder``; where there is none, one is fitted to ``texts`` and kept, so that later runs add to its vectors."""
    from linkloom.sources import readers

    path = f"{folder}/embedder.npz"
    if readers.missing_inputs(texts.sparkSession, [path]):
        embedding.fit(texts).save(texts.sparkSession, path)
    return embedding.Embedder.load(path)


def phrase_audits(spark, embedder=None, settings: Settings = DEFAULT) -> DataFrame:
    """Fixed phrase pairs scored by the embedder, with band and flags: what a reader should know of the model."""
    p = spark.createDataFrame(PHRASE_AUDITS, "audit_id string, human_text string, mouse_text string, expected_relation string")
    f = embedder or hashed_embedding()
    p = p.withColumn("_1", f("human_text")).withColumn("_2", f("mouse_text")).withColumn("cosine_similarity", X.dot("_1", "_2")).drop("_1", "_2")
    p = p.withColumn("cosine_class", X.cosine_band("cosine_similarity", settings.band_a, settings.band_b, settings.band_c))
    conflict, negation = X.directions_conflict(X.direction("human_text"), X.direction("mouse_text")), X.has_negation("human_text", "mouse_text")
    p = p.withColumn("direction_conflict", conflict.cast("int")).withColumn("negation_flag", negation.cast("int"))
    return p.withColumn("review_status", X.review_status(conflict, negation, F.lit(False)))
