"""Linkage by a shared disease identifier: curated models of one side, conditions of the other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.operators.keys import first_wins, joined_set, last_wins
from linkloom.settings import ORTHOLOG_SOURCE, SAYS_DISEASE

#: Columns of a link (fixed values: a published table); columns that neither side has are left out.
LINKS = ["category_id", "subcategory_id", "connection_basis", "human_gene", "human_ncbi_gene_id", "rs_id", "human_variant_source", "human_source_record_id", "human_chromosome", "human_position", "human_condition_label", "human_condition_identifiers", "human_evidence_class", "human_clinical_significance", "mouse_gene", "mouse_ncbi_gene_id", "mgi_marker_id", "mouse_allele", "mgi_allele_id", "mouse_allele_name", "mouse_allele_attribute", "allelic_composition", "genetic_background", "mgi_genotype_id", "shared_disease_id", "mouse_doid", "mouse_omim_ids", "mouse_mp_ids", "mouse_pubmed_ids", "ortholog_source", "interpretation"]
MODEL = ["human_gene", "mgi_allele_id", "genetic_background", "mgi_genotype_id", "mouse_doid", "mouse_omim_ids"]


def disease_models(rows: DataFrame, orthologs: DataFrame, alleles: DataFrame) -> DataFrame:
    """One model for each key: phenotype and publication ids as sorted sets, other columns of the first row, allele names by id."""
    one = rows.where(X.single_marker("marker_ids", distinct=True)).withColumn("mgi_marker_id", F.element_at(X.identifiers("marker_ids"), 1))
    pairs = last_wins(orthologs, ["mgi_marker_id"], ["_ord"]).select("mgi_marker_id", "human_gene", "mouse_gene", "mouse_ncbi_gene_id")
    one = one.join(pairs, "mgi_marker_id")
    first = F.min_by(F.struct("mouse_gene", "mouse_ncbi_gene_id", "mgi_marker_id", "mouse_allele", "allelic_composition"), "_ord")
    publications = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(X.identifiers("pubmed_ids"))))), "|")
    models = one.groupBy(*MODEL).agg(first.alias("f"), F.min("_ord").alias("_ord"), joined_set(F.nullif("mp_id", F.lit(""))).alias("mouse_mp_ids"), publications.alias("mouse_pubmed_ids"))
    named = models.select(*MODEL, F.posexplode(X.identifiers("mgi_allele_id")).alias("at", "allele_id")).join(alleles.select("allele_id", "allele_name", "allele_attribute"), "allele_id")
    lists = named.groupBy(*MODEL).agg(F.array_sort(F.collect_list(F.struct("at", "allele_name", "allele_attribute"))).alias("a"))
    names = F.array_join(F.filter(F.transform("a", lambda x: x["allele_name"]), lambda v: v != ""), "|")
    kinds = F.array_join(F.array_distinct(F.flatten(F.transform("a", lambda x: X.identifiers(x["allele_attribute"])))), "|")
    lists = lists.select(*MODEL, names.alias("mouse_allele_name"), kinds.alias("mouse_allele_attribute"))
    out = models.join(lists, MODEL, "left").na.fill("", ["mouse_allele_name", "mouse_allele_attribute"])
    return out.select("_ord", *MODEL, "f.*", "mouse_allele_name", "mouse_allele_attribute", "mouse_mp_ids", "mouse_pubmed_ids")


def disease_sides(human: DataFrame, models: DataFrame, prefix: str = "OMIM:", source: str = "ClinVar", evidence: str = "clinvar_supported") -> tuple[DataFrame, DataFrame]:
    """Human conditions (with _ord) and models by identifier, as shared_disease_id; the first of equal signatures stays."""
    h = human.where((F.col("variant_source") == source) & (F.col("evidence_class") == evidence))
    h = h.withColumn("_h", F.col("_ord")).drop("_ord").withColumn("shared_disease_id", F.explode(X.identifiers("condition_identifiers", prefix)))
    m = models.withColumn("_m", F.col("_ord")).drop("_ord").withColumn("shared_disease_id", F.explode(X.identifiers("mouse_omim_ids", prefix)))
    # Each side is made unique by its part of the signature, so that the fan-out of the join has no repeats to sort out.
    return first_wins(h, ["human_gene", "rs_id", "source_record_id", "shared_disease_id"], ["_h"]), first_wins(m, ["human_gene", "mgi_genotype_id", "shared_disease_id"], ["_m"])


def disease_links(human: DataFrame, models: DataFrame, prefix: str = "OMIM:", source: str = "ClinVar", evidence: str = "clinvar_supported") -> DataFrame:
    """Human conditions (with _ord) and models of one gene that share an identifier; the first of equal signatures stays."""
    h, m = disease_sides(human, models, prefix, source, evidence)
    out = h.join(m, ["human_gene", "shared_disease_id"])
    named = {"human_variant_source": "variant_source", "human_source_record_id": "source_record_id", "human_chromosome": "chromosome", "human_position": "position", "human_condition_label": "phenotype_label", "human_condition_identifiers": "condition_identifiers", "human_evidence_class": "evidence_class", "human_clinical_significance": "clinical_significance"}
    given = {"category_id": "category2", "subcategory_id": "category2-2", "connection_basis": "shared_disease_identifier_and_curated_mouse_model", "ortholog_source": ORTHOLOG_SOURCE, "interpretation": SAYS_DISEASE}
    return out.select(*(F.lit(given[c]).alias(c) if c in given else F.col(named.get(c, c)).alias(c) for c in LINKS if c in given or named.get(c, c) in out.columns))


def disease_counts(human: DataFrame, models: DataFrame, prefix: str = "OMIM:", source: str = "ClinVar", evidence: str = "clinvar_supported") -> DataFrame:
    """What ``disease_links`` has by (human_gene, shared_disease_id): links, different variants and models.

    Each side is counted before the join: a link is a pair of one row of each, so that no fan-out is built.
    """
    h, m = disease_sides(human, models, prefix, source, evidence)
    keys = ["human_gene", "shared_disease_id"]
    one = h.groupBy(*keys).agg(F.count("*").alias("_h"), F.count_distinct("rs_id").alias("variants"))
    two = m.groupBy(*keys).agg(F.count("*").alias("_m"), F.count_distinct("mgi_genotype_id").alias("models"))
    return one.join(two, keys).select(*keys, (F.col("_h") * F.col("_m")).alias("links"), "variants", "models")


def disease_linked(human: DataFrame, models: DataFrame, prefix: str = "OMIM:", source: str = "ClinVar", evidence: str = "clinvar_supported") -> tuple[DataFrame, DataFrame]:
    """The rows of ``disease_sides`` that have links."""
    h, m = disease_sides(human, models, prefix, source, evidence)
    keys = ["human_gene", "shared_disease_id"]
    return h.join(m.select(*keys).distinct(), keys, "left_semi"), m.join(h.select(*keys).distinct(), keys, "left_semi")


def with_shared_disease(human: DataFrame, models: DataFrame, prefix: str = "OMIM:") -> DataFrame:
    """Number of (row, disease) pairs that some model shares, before any removal of repeats."""
    h = human.select("human_gene", F.explode(X.identifiers("condition_identifiers", prefix)).alias("d"))
    m = models.select("human_gene", F.explode(X.identifiers("mouse_omim_ids", prefix)).alias("d")).distinct()
    return h.join(m, ["human_gene", "d"], "left_semi").agg(F.count("*").alias("rows_with_shared_disease"))
