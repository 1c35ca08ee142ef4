"""Stored tables of the integrated model, their views, and their constraints as audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.plans import audits, bridge, contract, disease, lexical, semantic

# Columns of the published tables.
HUMAN_ANNOTATION = ["evidence_id", "human_gene", "human_ncbi_gene_id", "rs_id", "variant_source", "source_record_id", "text_id", "phenotype_id", "evidence_class", "publication_id", "curated_input", "source_row", "chromosome", "position", "reference_allele", "alternate_allele", "evidence_detail", "p_value", "clinical_significance", "condition_identifiers", "reported_genes", "mapped_genes"]
MOUSE_ANNOTATION = ["evidence_id", "mouse_gene", "mgi_allele_id", "mgi_genotype_id", "genetic_background", "text_id", "phenotype_id", "phenotype_source", "pubmed_ids", "mouse_allele", "source_row", "mouse_ncbi_gene_id", "mgi_marker_id", "allele_name", "allele_type", "allelic_composition", "phenotype_definition", "evidence_detail"]
#: What a correspondence shows of the match, the human annotation and the mouse annotation, and under which name where another.
CORRESPONDENCE = {
    "p": ["match_id", "cosine_class", "cosine_similarity", "review_status", "direction_conflict", "negation_flag", "human_gene", "mouse_gene", "human_text_id", "mouse_text_id", "eligible_for_default_use"],
    "h": ["evidence_id AS human_evidence_id", "rs_id", "variant_source", "evidence_class", "source_record_id", "chromosome", "position", "reference_allele", "alternate_allele", "phenotype_id AS human_phenotype_id", "clinical_significance", "p_value", "curated_input", "publication_id"],
    "m": ["evidence_id AS mouse_evidence_id", "mgi_allele_id", "mgi_genotype_id", "genetic_background", "mouse_allele", "phenotype_source", "pubmed_ids", "phenotype_id AS mouse_phenotype_id", "mgi_marker_id", "allele_type"],
}

TABLES = {
    "variant_pair": "pair_id string, human_gene string, human_variant_id string, mouse_gene string, mouse_variant_or_allele_id string, human_ncbi_gene_id string, mouse_ncbi_gene_id string, mgi_marker_id string, ortholog_source string",
    "connection_evidence": "evidence_id long, pair_id string, route_id string, human_phenotype_id string, human_phenotype_label string, mouse_phenotype_id string, mouse_phenotype_label string, ontology_predicate string, shared_disease_id string, match_level string, score double, evidence_class string, source_dataset string, source_record_id string, review_flag string, evidence_detail string",
    "tier_catalog": "category_id string, name string, connection_basis string, output_file string, row_count long, interpretation string",
    "tier_validation": "control_id string, category_id string, expected string, found_rows long, within_tier_support string, status string, interpretation string",
    "bridge_links": ", ".join(f"{c} string" for c in ["category_id", "subcategory_id", "connection_basis", *bridge.HUMAN, "predicate", "mapping_confidence", "mapping_justification", "mapping_date", "mapping_source", "mp_id", "mp_label", *bridge.ALLELE, "mouse_pubmed_ids", "mgi_genotype_id", "ortholog_source"]),
    "lexical_links": ", ".join(f"{c} string" for c in lexical.LINKS),
    "disease_links": ", ".join(f"{c} string" for c in disease.LINKS),
    "tier0_exact_variant": ", ".join(f"{c} string" for c in contract.COLUMNS),
    "phenotype_match": ", ".join(f"{c} {'double' if c == 'cosine_similarity' else 'int' if c in ('retrieval_rank', 'direction_conflict', 'negation_flag', 'eligible_for_default_use') else 'boolean' if c.endswith('truncated') else 'long' if c == 'mouse_texts_in_gene' else 'string'}" for c in semantic.STORED),
    "phenotype_text": "text_id string, label string, embedding_truncated int",
    "ortholog": "human_gene string, human_ncbi_gene_id string, human_ensembl_gene_id string, hgnc_id string, mouse_gene string, mouse_ncbi_gene_id string, mgi_marker_id string, source string",
    "human_annotation": ", ".join(f"{c} {'int' if c in ('curated_input', 'source_row') else 'string'}" for c in HUMAN_ANNOTATION),
    "mouse_annotation": ", ".join(f"{c} {'int' if c == 'source_row' else 'string'}" for c in MOUSE_ANNOTATION),
}
#: Unique keys, and references (table, column, other table, other column).
KEYS = {"variant_pair": [["pair_id"], ["human_gene", "human_variant_id", "mouse_gene", "mouse_variant_or_allele_id"]], "connection_evidence": [["evidence_id"]], "tier_catalog": [["category_id"]], "tier_validation": [["control_id", "category_id"]], "phenotype_match": [["match_id"]], "phenotype_text": [["text_id"], ["label"]], "ortholog": [["human_gene"], ["mouse_gene"]], "human_annotation": [["evidence_id"]], "mouse_annotation": [["evidence_id"]]}
REFERENCES = [("connection_evidence", "pair_id", "variant_pair", "pair_id"), ("phenotype_match", "human_text_id", "phenotype_text", "text_id"), ("phenotype_match", "mouse_text_id", "phenotype_text", "text_id"), ("phenotype_match", "human_gene", "ortholog", "human_gene"), ("human_annotation", "text_id", "phenotype_text", "text_id"), ("mouse_annotation", "text_id", "phenotype_text", "text_id")]
VIEWS = {
    "active_tier0_exact_variant": "SELECT * FROM tier0_exact_variant WHERE qc_status = 'passed'",
    "phenotype_pairs": "SELECT m.*, h.label AS human_label, x.label AS mouse_label FROM phenotype_match m JOIN phenotype_text h ON h.text_id = m.human_text_id JOIN phenotype_text x ON x.text_id = m.mouse_text_id",
    "active_phenotype_pairs": "SELECT * FROM phenotype_pairs WHERE eligible_for_default_use = 1",
    "variant_correspondence": f"SELECT {', '.join(f'{t}.{c}' for t, cs in CORRESPONDENCE.items() for c in cs)} FROM phenotype_match p JOIN human_annotation h ON h.human_gene = p.human_gene AND h.text_id = p.human_text_id JOIN mouse_annotation m ON m.mouse_gene = p.mouse_gene AND m.text_id = p.mouse_text_id",
    "active_variant_correspondence": "SELECT * FROM variant_correspondence WHERE eligible_for_default_use = 1",
}
#: Where Spark has no index, the layout serves: tables are bucketed by what they are looked up with.
BUCKETS = {"variant_pair": ["human_gene", "human_variant_id"], "connection_evidence": ["pair_id"], "bridge_links": ["human_gene", "rs_id"], "lexical_links": ["human_gene", "rs_id"], "disease_links": ["human_gene", "rs_id"], "tier0_exact_variant": ["human_gene", "human_variant_id"], "phenotype_match": ["human_gene"], "human_annotation": ["human_gene", "text_id"], "mouse_annotation": ["mouse_gene", "text_id"]}


def columns(table: str) -> list[str]:
    """Names of a table's columns, in order."""
    return [c.split(" ")[0] for c in TABLES[table].split(", ")]


def store(df: DataFrame, table: str, buckets: int = 64) -> None:
    """Writes a table of the model with its bucketing; columns are put in order and checked."""
    names = columns(table)
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"{table} lacks {missing}")
    w = df.select(*names).write.mode("overwrite").format("parquet")
    (w.bucketBy(buckets, *BUCKETS[table]).sortBy(*BUCKETS[table]) if table in BUCKETS else w).saveAsTable(table)


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Temporary views of the given tables, empty ones of the others, and the views over them."""
    for name, schema in TABLES.items():
        (tables[name] if name in tables else spark.createDataFrame([], schema)).createOrReplaceTempView(name)
    for name, sql in VIEWS.items():
        spark.sql(sql).createOrReplaceTempView(name)


def constraint_audits(spark: SparkSession) -> DataFrame:
    """Violations of every key and reference of the registered tables, all in one shuffle: each count must be 0."""
    tags: dict[str, list] = {}
    for table, keys in KEYS.items():
        tags.setdefault(table, []).extend(audits.once(f"unique {table} {','.join(k)}", *k) for k in keys)
    for table, column, other, target in REFERENCES:
        rule = f"reference {table} {column}"
        tags.setdefault(table, []).append(audits.refers(rule, column, nullable=True))
        tags.setdefault(other, []).append(audits.known(rule, target))
    return audits.violations(spark, *((spark.table(table), some) for table, some in tags.items()))
