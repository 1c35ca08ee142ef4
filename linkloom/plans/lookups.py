"""Questions to the stored matches and correspondences. Those with ``rows`` are top lists: their limit is what they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_first(rows: DataFrame, *then: str) -> DataFrame:
    """Sorted by cosine, the highest first, then by ``then``: a sort by range over all partitions."""
    return rows.orderBy(F.desc("cosine_similarity"), *then)


def of_variant(correspondence: DataFrame, texts: DataFrame, human_gene: str, rs_id: str) -> DataFrame:
    """Correspondences of one variant with the labels of both texts, best first."""
    some = correspondence.where((F.col("human_gene") == human_gene) & (F.col("rs_id") == rs_id))
    label = lambda s: texts.select(F.col("text_id").alias(f"{s}_text_id"), F.col("label").alias(f"{s}_phenotype"))
    return best_first(some.join(label("human"), "human_text_id").join(label("mouse"), "mouse_text_id"), "match_id")


def of_status(pairs: DataFrame, cosine_class: str, review_status: str, rows: int = 100) -> DataFrame:
    """The best pairs of a band and a review status."""
    return best_first(pairs.where((F.col("cosine_class") == cosine_class) & (F.col("review_status") == review_status)), "match_id").limit(rows)


def conflicting(pairs: DataFrame, rows: int = 100) -> DataFrame:
    """Pairs whose texts name opposite directions, the first by id."""
    return pairs.where("direction_conflict = 1").orderBy("match_id").limit(rows)


def archived(pairs: DataFrame, rows: int = 100) -> DataFrame:
    """Pairs of band D, which is kept but not used, the first by id."""
    return pairs.where("cosine_class = 'D'").orderBy("match_id").limit(rows)


def by_curation(correspondence: DataFrame, curated: bool = False) -> DataFrame:
    """Correspondences whose human side was put in by hand, or was not."""
    return correspondence.where(F.col("curated_input") == int(curated))
