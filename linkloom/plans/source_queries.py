"""The linkage steps on the driver's tables, cast into the shapes of source files: each calls one operator of the library.

Genes, markers and ids are made of nation keys: C7 is the human gene of nation 7, m7 its mouse gene, MGI:7 the marker.
"""

from __future__ import annotations

import io
import json
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.operators.keys import numbered
from linkloom.plans import bridge, catalog, contract, disease, lexical, lookups, reports, semantic
from linkloom.plans.driver_queries import BANDS, CONTROL_SQL, FLAG_SQL, SELECTIVE_SQL, _control_links, _found, _matrix, _sides, query, selective, sql_lexical
from linkloom.session import scratch
from linkloom.settings import DEFAULT
from linkloom.sources import readers, writers
from linkloom.sources.files import created
from linkloom.sources.split import gzip_lines, write_block_gzip


def _text(*parts) -> F.Column:
    """Columns and literals as one text; names stand for columns, other texts are in F.lit."""
    return F.concat(*((F.col(p) if isinstance(p, str) else p).cast("string") for p in parts))


def _l(x: str):
    return F.lit(x)


# --- source shapes ----------------------------------------------------------------------------


def _orthologs(t) -> DataFrame:
    """A pair for each nation; later rows give the markers of the first five other mouse genes."""
    k = F.col("n_nationkey")
    one = t.nation.select(k.cast("long").alias("_ord"), _text(_l("MGI:"), k).alias("mgi_marker_id"), _text(_l("m"), k).alias("mouse_gene"), _text(_l("1"), k).alias("mouse_ncbi_gene_id"), _text(_l("HGNC:"), k).alias("hgnc_id"), _text(_l("C"), k).alias("human_gene"), k.cast("string").alias("human_ncbi_gene_id"))
    r = F.col("r_regionkey")
    two = t.region.select((r + 100).cast("long").alias("_ord"), _text(_l("MGI:"), r).alias("mgi_marker_id"), _text(_l("r"), r).alias("mouse_gene"), _text(_l("2"), r).alias("mouse_ncbi_gene_id"), _l("").alias("hgnc_id"), _text(_l("R"), r).alias("human_gene"), _text(_l("9"), r).alias("human_ncbi_gene_id"))
    return one.unionByName(two)


_MOUSE_SQL = "CASE WHEN {k} < 5 THEN 'r' ELSE 'm' END || {k}"


def _mappings(t) -> DataFrame:
    k = F.col("s_suppkey")
    mp = _text(_l("MP:"), k % 6)
    return t.supplier.select(_text(_l("HP:"), k % 8).alias("hpo_id"), mp.alias("mp_id"), _l("skos:exactMatch").alias("predicate"), F.when(k % 8 < 6, F.concat(_l("label of "), mp)).otherwise("").alias("hpo_label")).distinct()


_MAPPED_SQL = """mapped AS (SELECT DISTINCT 'HP:' || s_suppkey % 8 AS hpo_id, 'MP:' || s_suppkey % 6 AS mp_id, s_suppkey % 8 < 6 AS named FROM supplier),
label AS (SELECT hpo_id, max(CASE WHEN named THEN 'label of ' || mp_id END) AS hpo_label FROM mapped GROUP BY hpo_id)"""


def _annotations(t) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(
        k.cast("long").alias("_ord"), _text(_l("MIM:"), k % 7).alias("database_id"), F.when(k % 4 == 0, "").otherwise(F.col("p_type")).alias("disease_name"), F.when(k % 11 == 0, "NOT").otherwise("").alias("qualifier"), _text(F.when(k % 2 == 0, " http://x.org/obo/HP_").otherwise("HP:"), F.col("p_size") % 10).alias("hpo_id"),
        k.cast("string").alias("reference"), F.col("p_brand").alias("evidence"), _l("").alias("frequency"), F.when(k % 5 == 0, "I").otherwise("P").alias("aspect"), _l("b").alias("biocuration"),
    )


_NOTED_SQL = f"""{_MAPPED_SQL},
noted AS (SELECT * FROM (SELECT 'OMIM:' || p_partkey % 7 AS disease_id, 'HP:' || p_size % 10 AS hpo_id, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type END AS disease_name, p_brand AS evidence, p_partkey AS reference,
  row_number() OVER (PARTITION BY p_partkey % 7, p_size % 10 ORDER BY p_partkey) AS r FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 5 <> 0) WHERE r = 1 AND hpo_id IN (SELECT hpo_id FROM mapped))"""


def _vcf(t) -> DataFrame:
    """A variant for each order: two rs ids, a gene with an ortholog under two ids and one without, three diseases in two groups, two condition labels."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    significance = F.when(F.col("o_orderpriority") == "1-URGENT", "Pathogenic|risk_factor").when(F.col("o_orderpriority") == "2-HIGH", "protective").otherwise("Benign")
    info = F.concat(_l("RS="), _text(c % 50), _l(",x,"), _text(k), _l(";GENEINFO=C"), _text(c % 25), _l(":"), _text(c % 25), _l("|X:Y:1|.|C"), _text(c % 25), _l(":77;CLNDISDB=MIM:"), _text(c % 7), _l("|MedGen:M1,Orphanet:9;CLNDN=cond_"), _text(c % 4), _l("%2C_x|not_provided;CLNSIG="), significance, F.when(c % 2 == 0, ";CLNREVSTAT=one_star").otherwise(""))
    return t.orders.select(k.cast("long").alias("_ord"), F.col("o_orderstatus").alias("chrom"), _text(c).alias("pos"), _text(k).alias("id"), _l("A").alias("ref"), _l("G").alias("alt"), _l(".").alias("qual"), _l(".").alias("filter"), info.alias("info"))


_VARIANT_SQL = """variant AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, unnest([(o_custkey % 50)::VARCHAR, o_orderkey::VARCHAR]) AS rs FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
one_variant AS (SELECT DISTINCT * FROM variant)"""


def _genotypes(t) -> DataFrame:
    """A genotype for each customer; every fifth has two markers."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    return t.customer.select(
        k.cast("long").alias("_ord"), F.col("c_name").alias("allelic_composition"), _text(_l("al"), k % 4).alias("mouse_allele"), _text(_l("A"), k % 10, _l("|A"), k % 3).alias("mgi_allele_id"), F.col("c_mktsegment").alias("genetic_background"), _text(_l("MP:"), k % 9).alias("mp_id"),
        _text(k).alias("pubmed_ids"), F.concat(_l("MGI:"), n.cast("string"), F.when(k % 5 == 0, "|MGI:99").otherwise("")).alias("marker_ids"), _text(_l("G"), k % 40).alias("mgi_genotype_id"),
    )


def _alleles(t) -> DataFrame:
    r = F.col("r_regionkey")
    return t.region.select(r.cast("long").alias("_ord"), _text(_l("A"), r).alias("allele_id"), F.when(r == 4, "").otherwise(_text(_l("sym"), r)).alias("symbol"), F.when(r == 2, "").otherwise(F.col("r_name")).alias("allele_name"), _text(_l("t"), r).alias("allele_type"), F.when(r == 3, "").otherwise(_text(_l("J:"), r)).alias("reference"), _text(_l("x|"), r % 2).alias("allele_attribute"), _text(_l("MGI:"), r).alias("marker_id"))


# --- bridge -----------------------------------------------------------------------------------


@query(f"WITH {_NOTED_SQL} SELECT disease_id, hpo_id, disease_name, evidence, reference::VARCHAR AS reference FROM noted")
def pl_disease_annotations(t):
    return bridge.disease_annotations(_annotations(t), _mappings(t)).select("disease_id", "hpo_id", "disease_name", "evidence", "reference")


_SHOWN_SQL = "CASE o_orderpriority WHEN '1-URGENT' THEN 'Pathogenic; risk factor' ELSE 'protective' END"


@query(f"""WITH {_NOTED_SQL}, {_VARIANT_SQL}
SELECT 'C' || o_custkey % 25 AS human_gene, (o_custkey % 25)::VARCHAR AS human_ncbi_gene_id, 'rs' || rs AS rs_id, o_orderkey::VARCHAR AS clinvar_variation_id, o_orderstatus AS chromosome, o_custkey::VARCHAR AS position, 'A' AS reference_allele, 'G' AS alternate_allele,
  {_SHOWN_SQL} AS clinical_significance, CASE WHEN o_custkey % 2 = 0 THEN 'one star' ELSE '' END AS review_status, n.disease_id, CASE WHEN disease_name = '' THEN 'cond ' || o_custkey % 4 || ', x; not provided' ELSE disease_name END AS disease_name,
  n.hpo_id, coalesce(hpo_label, '') AS hpo_label, evidence AS hpo_annotation_evidence, reference::VARCHAR AS hpo_annotation_reference, '' AS hpo_frequency, 'b' AS hpo_biocuration
FROM one_variant JOIN noted n ON n.disease_id = 'OMIM:' || o_custkey % 7 LEFT JOIN label USING (hpo_id)""")
def pl_variant_phenotypes(t):
    return bridge.variant_phenotypes(_vcf(t), _annotations(t), _orthologs(t), _mappings(t))


@query(f"""SELECT {_MOUSE_SQL.format(k='c_nationkey')} AS mouse_gene, CASE WHEN c_nationkey < 5 THEN '2' ELSE '1' END || c_nationkey AS mouse_ncbi_gene_id, 'MGI:' || c_nationkey AS mgi_marker_id, c_name AS allelic_composition, 'MP:' || c_custkey % 9 AS mp_id, c_custkey::VARCHAR AS pubmed_ids
FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 9 IN (SELECT s_suppkey % 6 FROM supplier)""")
def pl_allele_phenotypes(t):
    return bridge.allele_phenotypes(_genotypes(t), _orthologs(t), _mappings(t)).select("mouse_gene", "mouse_ncbi_gene_id", "mgi_marker_id", "allelic_composition", "mp_id", "pubmed_ids")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN '' WHEN s_suppkey % 4 = 1 THEN s_acctbal::VARCHAR ELSE '0.' || s_suppkey % 10 END AS confidence FROM supplier
WHERE s_suppkey % 3 <> 0 AND (s_suppkey % 4 = 0 OR (s_suppkey % 4 = 1 AND s_acctbal >= 0.8) OR (s_suppkey % 4 > 1 AND s_suppkey % 10 >= 8)) AND list_contains(['a', 'b'], ['a', 'b|c', 'c'][1 + s_suppkey % 3][1:1])""")
def pl_accepted_mappings(t):
    """Predicate, confidence (blank counts as 1) and source of a route."""
    k = F.col("s_suppkey")
    confidence = F.when(k % 4 == 0, "").when(k % 4 == 1, F.col("s_acctbal").cast("string")).otherwise(F.concat(_l("0."), (k % 10).cast("string")))
    rows = t.supplier.select("s_suppkey", confidence.alias("confidence"), F.when(k % 3 == 0, "other").otherwise("skos:closeMatch").alias("predicate"), F.element_at(F.array(_l("a"), _l("b|c"), _l("c")), (k % 3 + 1).cast("int")).alias("mapping_source"))
    return bridge.accepted_mappings(rows, bridge.BridgeRoute("x", "y", DEFAULT.predicates, 0.8, ("a", "b"))).select("s_suppkey", "confidence")


# --- evidence ---------------------------------------------------------------------------------


def _nomenclature(t) -> DataFrame:
    k = F.col("n_nationkey")
    rows = t.nation.where(k < 15).select(k.cast("long").alias("_ord"), _text(_l("HGNC:"), k).alias("hgnc_id"), _text(_l("ENSG"), k + 1000).alias("ensembl_gene_id"))
    return rows.unionByName(t.nation.where(k < 5).select((k + 50).cast("long").alias("_ord"), _text(_l("HGNC:"), k).alias("hgnc_id"), _text(_l("ENSG"), k + 2000).alias("ensembl_gene_id")))


@query("""SELECT 'C' || n_nationkey AS human_gene, 'm' || n_nationkey AS mouse_gene, CASE WHEN n_nationkey < 5 THEN 'ENSG' || (n_nationkey + 2000) WHEN n_nationkey < 15 THEN 'ENSG' || (n_nationkey + 1000) ELSE '' END AS human_ensembl_gene_id FROM nation
UNION ALL SELECT 'R' || r_regionkey, 'r' || r_regionkey, '' FROM region""")
def pl_enriched_orthologs(t):
    return lexical.enrich_orthologs(_orthologs(t), _nomenclature(t)).select("human_gene", "mouse_gene", "human_ensembl_gene_id")


@query(f"""WITH {_VARIANT_SQL} SELECT 'C' || o_custkey % 25 AS human_gene, (o_custkey % 25)::VARCHAR AS human_ncbi_gene_id, 'rs' || rs AS rs_id, o_orderstatus AS chromosome, o_custkey::VARCHAR AS position, 'A' AS reference_allele, 'G' AS alternate_allele, 'ClinVar' AS variant_source, o_orderkey::VARCHAR AS source_record_id,
  'OMIM:' || o_custkey % 7 || '|MEDGEN:M1' AS phenotype_id, 'cond ' || o_custkey % 4 || ', x' AS phenotype_label, 'clinvar_supported' AS evidence_class, 'ClinVar aggregate classification; review status: ' || CASE WHEN o_custkey % 2 = 0 THEN 'one star' ELSE 'not reported' END AS evidence_detail,
  '' AS p_value, '' AS publication_id, {_SHOWN_SQL} AS clinical_significance, 'OMIM:' || o_custkey % 7 || '|MEDGEN:M1' AS condition_identifiers, '' AS reported_genes, '' AS mapped_genes FROM one_variant""")
def pl_variant_conditions(t):
    return lexical.variant_conditions(_vcf(t), _orthologs(t)).drop("_ord")


def _associations(t) -> DataFrame:
    k = F.col("p_partkey")
    p = F.element_at(F.array(_l("1E-9"), _l(" "), _l("0.5"), _l("bad")), (k % 4 + 1).cast("int"))
    columns = {"P-VALUE": p, "SNPS": _text(_l("RS"), k % 30), "STRONGEST SNP-RISK ALLELE": _text(_l("rs"), k % 30, _l("-A; rs7-C")), "SNP_GENE_IDS": _text(_l("ENSG"), k % 25 + 1000, _l(", ENSG9")), "STUDY ACCESSION": _text(_l("S"), k % 100), "MAPPED_TRAIT": F.when(k % 3 == 0, "").otherwise(F.col("p_type")), "DISEASE/TRAIT": F.col("p_brand"), "CHR_ID": _l("1"), "CHR_POS": _l("2"), "MAPPED_TRAIT_URI": _l("u"), "PUBMEDID": F.when(k % 5 == 0, "").otherwise(_text(k)), "REPORTED GENE(S)": _text(_l("g"), k), "MAPPED_GENE": _text(_l("h"), k)}
    return t.part.select(k.cast("long").alias("_ord"), *(c.alias(n) for n, c in columns.items()))


@query("""WITH a AS (SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN '1E-9' ELSE ' ' END AS p_value, unnest(list_distinct(['rs' || p_partkey % 30, 'rs7'])) AS rs_id, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_type END AS phenotype_label, p_brand AS detail FROM part WHERE p_partkey % 4 < 2 AND p_partkey % 25 < 15)
SELECT 'C' || min(k) % 25 AS human_gene, (min(k) % 25)::VARCHAR AS human_ncbi_gene_id, rs_id, '1' AS chromosome, '2' AS position, '' AS reference_allele, '' AS alternate_allele, 'GWAS_Catalog' AS variant_source, 'S' || min(k) % 100 AS source_record_id, 'u' AS phenotype_id, phenotype_label, 'gwas_significant' AS evidence_class, arg_min(detail, k) AS evidence_detail,
  p_value, CASE WHEN min(k) % 5 = 0 THEN '' ELSE 'PMID:' || min(k) END AS publication_id, '' AS clinical_significance, 'u' AS condition_identifiers, 'g' || min(k) AS reported_genes, 'h' || min(k) AS mapped_genes FROM a GROUP BY k % 100, k % 25, rs_id, phenotype_label, p_value""")
def pl_association_evidence(t):
    genes = _orthologs(t).where("human_gene like 'C%'").withColumn("human_ensembl_gene_id", F.when(F.substring("human_gene", 2, 9).cast("int") < 15, F.concat(_l("ENSG"), (F.substring("human_gene", 2, 9).cast("int") + 1000).cast("string"))).otherwise(""))
    return lexical.association_evidence(_associations(t), genes).drop("_ord")


_MICE_SQL = f"""geno AS (SELECT c_custkey AS k, {_MOUSE_SQL.format(k='c_nationkey')} AS mouse_gene, CASE WHEN c_nationkey < 5 THEN '2' ELSE '1' END || c_nationkey AS mouse_ncbi, c_nationkey AS n, c_name AS composition, 'al' || c_custkey % 4 AS listed, 'A' || c_custkey % 10 || '|A' || c_custkey % 3 AS ids,
  c_mktsegment AS background, 'MP:' || c_custkey % 9 AS mp_id, 'G' || c_custkey % 40 AS genotype, unnest([1, 2]) AS place, [c_custkey % 10, c_custkey % 3] AS pair FROM customer WHERE c_custkey % 5 <> 0),
allele AS (SELECT r_regionkey AS a, CASE r_regionkey WHEN 4 THEN '' ELSE 'sym' || r_regionkey END AS symbol, CASE r_regionkey WHEN 2 THEN '' ELSE r_name END AS name, 't' || r_regionkey AS kind, CASE r_regionkey WHEN 3 THEN 'not reported' ELSE 'J:' || r_regionkey END AS reference FROM region),
known AS (SELECT g.*, allele.* FROM geno g LEFT JOIN allele ON a = pair[place])"""


def _mouse(t) -> DataFrame:
    terms = t.nation.where("n_nationkey < 8").select(_text(_l("MP:"), "n_nationkey").alias("mp_id"), F.when(F.col("n_nationkey") == 3, "").otherwise(F.col("n_name")).alias("mp_label"), F.lit(None).cast("string").alias("mp_definition"))
    return lexical.mouse_evidence(_genotypes(t), _orthologs(t), _alleles(t).drop("_ord"), terms)


@query(f"""WITH {_MICE_SQL},
best AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY a IS NULL, a IS DISTINCT FROM n, place) AS choice FROM known),
term AS (SELECT *, row_number() OVER (PARTITION BY mouse_gene, ids, background, mp_id, genotype ORDER BY k) AS r FROM best JOIN nation ON 'MP:' || n_nationkey = mp_id WHERE choice = 1 AND n_nationkey < 8 AND n_nationkey <> 3),
named AS (SELECT *, row_number() OVER (PARTITION BY mouse_gene, a, background, genotype ORDER BY k, place) AS r FROM known WHERE name <> '')
SELECT mouse_gene, mouse_ncbi AS mouse_ncbi_gene_id, 'MGI:' || n AS mgi_marker_id, listed AS mouse_allele, ids AS mgi_allele_id, coalesce(name, '') AS allele_name, coalesce(kind, '') AS allele_type, composition AS allelic_composition, background AS genetic_background, mp_id AS phenotype_id, n_name AS phenotype_label, '' AS phenotype_definition,
  'MGI_MP' AS phenotype_source, 'Specific MP annotation from MGI_GenePheno' AS evidence_detail, k::VARCHAR AS pubmed_ids, genotype AS mgi_genotype_id FROM term WHERE r = 1
UNION ALL SELECT mouse_gene, mouse_ncbi, 'MGI:' || n, CASE symbol WHEN '' THEN listed ELSE symbol END, 'A' || a, name, kind, composition, background, '', name, '', 'MGI_allele_name', 'MGI phenotypic allele name; original reference ' || reference, k::VARCHAR, genotype FROM named WHERE r = 1""")
def pl_mouse_evidence(t):
    return _mouse(t)


@query(f"""WITH {_VARIANT_SQL} SELECT 'ClinVar' AS variant_source, evidence_class, count(*) AS n, count(DISTINCT rs_id) AS rs_ids FROM (SELECT 'clinvar_supported' AS evidence_class, 'rs' || rs AS rs_id FROM one_variant) GROUP BY ALL
UNION ALL SELECT 'GWAS_Catalog', 'gwas_significant', count(*), count(DISTINCT rs_id) FROM (SELECT DISTINCT p_partkey % 100, p_partkey % 25, rs_id, label, p FROM (SELECT p_partkey, unnest(list_distinct(['rs' || p_partkey % 30, 'rs7'])) AS rs_id, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_type END AS label, p_partkey % 4 AS p FROM part WHERE p_partkey % 4 < 2 AND p_partkey % 25 < 15))""")
def st_human_evidence(t):
    """Both kinds of evidence as one table, counted."""
    genes = _orthologs(t).where("human_gene like 'C%'").withColumn("human_ensembl_gene_id", F.when(F.substring("human_gene", 2, 9).cast("int") < 15, F.concat(_l("ENSG"), (F.substring("human_gene", 2, 9).cast("int") + 1000).cast("string"))).otherwise(""))
    both = lexical.human_evidence(lexical.variant_conditions(_vcf(t), _orthologs(t)), lexical.association_evidence(_associations(t), genes))
    return both.groupBy("variant_source", "evidence_class").agg(F.count("*").alias("n"), F.count_distinct("rs_id").alias("rs_ids"))


def _shaped(df: DataFrame, names: list[str], **columns) -> DataFrame:
    return df.select(*(columns.get(n, _l("")).cast("string").alias(n) for n in names))


@query(sql_lexical("part", "p_brand", "p_partkey", SELECTIVE_SQL, "p_partkey % 10 <> 0", "true", "['size']", DEFAULT and {"economy": "budget"}) + " SELECT gene AS human_gene, lower(gene) AS mouse_gene, left_id::VARCHAR AS human_source_record_id, right_id::VARCHAR AS mgi_genotype_id, support AS within_tier_support, token_jaccard FROM m")
def pl_lexical_links(t):
    """All parts on both sides; every tenth human row is of a class that does not count."""
    human = _shaped(t.part, lexical.HUMAN, human_gene=F.col("p_brand"), source_record_id=F.col("p_partkey"), phenotype_label=selective(), evidence_class=F.when(F.col("p_partkey") % 10 == 0, "other").otherwise("gwas_significant"))
    mouse = _shaped(t.part, lexical.MOUSE, mouse_gene=F.lower("p_brand"), mgi_genotype_id=F.col("p_partkey"), phenotype_label=selective())
    genes = t.part.select(F.col("p_brand").alias("human_gene"), F.lower("p_brand").alias("mouse_gene")).distinct().withColumn("_ord", _l(1))
    out = lexical.lexical_links(human, mouse, genes, DEFAULT.with_values(uninformative=("size",)), {"economy": "budget"})
    return out.select("human_gene", "mouse_gene", "human_source_record_id", "mgi_genotype_id", "within_tier_support", "token_jaccard")


@query("""WITH g AS (SELECT c_custkey AS k, c_nationkey AS n, CASE WHEN c_nationkey < 5 THEN 'R' ELSE 'C' END || c_nationkey AS human_gene, 'A' || c_custkey % 10 || '|A' || c_custkey % 3 AS ids, c_mktsegment AS background, 'G' || c_custkey % 40 AS genotype, 'D' || c_custkey % 2 AS doid, 'OMIM:' || c_custkey % 4 AS omim, 'MP:' || c_custkey % 9 AS mp, c_name FROM customer WHERE c_custkey % 5 <> 0),
m AS (SELECT human_gene, ids, background, genotype, doid, omim, string_agg(DISTINCT mp, '|' ORDER BY mp) AS mps, arg_min(c_name, k) AS composition, list_sort(list_distinct(list(k::VARCHAR))) AS pubs FROM g GROUP BY ALL),
a AS (SELECT human_gene, ids, background, genotype, doid, omim, unnest(list_sort(list_distinct(string_split(ids, '|')))) AS allele FROM m),
l AS (SELECT a.human_gene, a.ids, a.background, a.genotype, a.doid, a.omim, coalesce(string_agg(CASE WHEN r_regionkey <> 2 THEN r_name END, '|' ORDER BY allele), '') AS names FROM a JOIN region ON 'A' || r_regionkey = allele GROUP BY ALL)
SELECT m.human_gene, m.ids AS mgi_allele_id, m.background AS genetic_background, m.genotype AS mgi_genotype_id, m.doid AS mouse_doid, m.omim AS mouse_omim_ids, mps AS mouse_mp_ids, array_to_string(pubs, '|') AS mouse_pubmed_ids, composition AS allelic_composition, coalesce(names, '') AS mouse_allele_name FROM m LEFT JOIN l USING (human_gene, ids, background, genotype, doid, omim)""")
def pl_disease_models(t):
    k = F.col("_ord")
    rows = _genotypes(t).withColumn("mouse_doid", _text(_l("D"), k % 2)).withColumn("mouse_omim_ids", _text(_l("OMIM:"), k % 4))
    return disease.disease_models(rows, _orthologs(t), _alleles(t)).select("human_gene", "mgi_allele_id", "genetic_background", "mgi_genotype_id", "mouse_doid", "mouse_omim_ids", "mouse_mp_ids", "mouse_pubmed_ids", "allelic_composition", "mouse_allele_name")


@query("""SELECT count(*) AS rows_with_shared_disease FROM (SELECT DISTINCT o_custkey % 7 AS g, o_orderkey, unnest(list_distinct([o_custkey % 5, o_orderkey % 6]::BIGINT[])) AS d FROM orders) WHERE (g, d) IN (SELECT user_id % 7, user_id % 4 FROM events)""")
def ag_shared_disease_rows(t):
    human = t.orders.select((F.col("o_custkey") % 7).alias("human_gene"), _text(_l("OMIM:"), F.col("o_custkey") % 5, _l("|OMIM:"), F.col("o_orderkey") % 6, _l("|MONDO:1")).alias("condition_identifiers"))
    models = t.events.select((F.col("user_id") % 7).alias("human_gene"), _text(_l("OMIM:"), F.col("user_id") % 4).alias("mouse_omim_ids"))
    return disease.with_shared_disease(human, models)


# --- exchange contract, controls, audits ------------------------------------------------------


def _exchange(t) -> DataFrame:
    """Exchange rows of the orders: blank genes, a wrong status, repeated records, pairs that are no orthologs."""
    k = F.col("o_orderkey")
    v = {c: _l("x") for c in contract.COLUMNS} | {c: _l(x) for c, x in contract.CONSTANTS.items()}
    v |= {"match_level": _l("protein_exact"), "allele_orientation": _l("forward"), "reciprocal_mapping": _l("1"), "source_sha256": F.sha2(k.cast("string"), 256)}
    v |= {"qc_status": F.element_at(F.array(_l("passed"), _l("pending"), _l("rejected"), _l("odd")), (k % 4 + 1).cast("int")), "source_record_id": _text(F.when(k % 10 == 0, 0).otherwise(k)), "human_gene": F.when(k % 7 == 0, "").otherwise(_text(_l("C"), F.col("o_custkey") % 30)), "mouse_gene": _text(_l("m"), F.col("o_custkey") % 30)}
    return t.orders.select(*(c.alias(n) for n, c in v.items()), k.alias("_ord"))


_EXCHANGE_SQL = """exchange AS (SELECT o_orderkey AS k, ['passed', 'pending', 'rejected', 'odd'][1 + o_orderkey % 4] AS qc, o_orderkey % 7 = 0 AS blank, o_custkey % 30 >= 25 OR o_orderkey % 7 = 0 AS unpaired,
  o_orderkey % 10 = 0 AND row_number() OVER (PARTITION BY o_orderkey % 10 = 0 ORDER BY o_orderkey) > 1 AS again FROM orders)"""


@query(f"""WITH {_EXCHANGE_SQL} SELECT count(*) AS "rows", count(*) FILTER (blank OR qc = 'odd' OR unpaired OR again) AS invalid, count(*) FILTER (qc = 'pending') AS pending, count(*) FILTER (qc = 'passed') AS passed, count(*) FILTER (qc = 'rejected') AS rejected, 'FAIL' AS status FROM exchange""")
def va_contract_report(t):
    return contract.contract_report(contract.contract_errors(_exchange(t), ["_ord"], _orthologs(t)))


@query(f"""WITH {_EXCHANGE_SQL}, numbered AS (SELECT *, row_number() OVER (ORDER BY k) AS n FROM exchange)
SELECT (n + 1)::BIGINT AS row, array_to_string(list_filter([CASE WHEN k % 13 = 0 THEN 'expected 36 columns; found 37' END, CASE WHEN blank THEN 'missing human_gene' END, CASE WHEN qc = 'odd' THEN 'invalid qc_status' END,
  CASE WHEN unpaired THEN 'human and mouse genes are not an accepted 1:1 ortholog pair' END, CASE WHEN again THEN 'duplicate source_dataset/source_version/source_record_id' END], lambda x: x IS NOT NULL), '; ') AS errors
FROM numbered WHERE k % 13 = 0 OR blank OR qc = 'odd' OR unpaired OR again UNION ALL SELECT 1, 'header does not exactly match the Tier 0 template'""".replace("36", "{w}").replace("37", "{x}").format(w=len(contract.COLUMNS), x=len(contract.COLUMNS) + 1))
def va_contract_file(t):
    """A written exchange file with a wrong header and some lines too long, read and checked."""
    names = list(contract.COLUMNS)
    head = t.spark.createDataFrame([(-1, "\t".join([*names[1:], names[0]]))], "_ord long, value string")
    line = F.concat(F.concat_ws("\t", *names), F.when(F.col("_ord") % 13 == 0, "\textra").otherwise(""))
    path = scratch(t.spark, "exchange")
    head.unionByName(_exchange(t).select(F.col("_ord").cast("long").alias("_ord"), line.alias("value"))).orderBy("_ord").select("value").write.text(path)
    return contract.file_issues(readers.lines(t.spark, path), names, _orthologs(t)).select("row", F.array_join("errors", "; ").alias("errors"))


@query("""SELECT n_nationkey::VARCHAR AS control_id, n_nationkey < 20 AS human_found, n_nationkey % 2 = 0 AS ortholog_found, n_nationkey < 10 AND n_nationkey % 3 <> 0 AS mouse_found, n_nationkey % 5 <> 0 AS distinct_substitutions,
  CASE WHEN n_nationkey < 10 AND n_nationkey % 2 = 0 AND n_nationkey % 3 <> 0 AND n_nationkey % 5 <> 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM nation""")
def va_positive_control(t):
    k = F.col("n_nationkey")
    gene, mouse = _text(_l("C"), k).alias("human_gene"), _text(_l("m"), k).alias("mouse_gene")
    controls = t.nation.select(_text(k).alias("control_id"), gene, mouse, _text(_l("rs"), k).alias("human_variant"), _text(_l("A"), k).alias("mouse_allele_id"), _l("p.1").alias("human_protein_change"), F.when(k % 5 == 0, "p.1").otherwise("p.2").alias("mouse_protein_change"))
    human = t.nation.where(k < 20).select(gene, _text(_l("rs"), k).alias("rs_id"))
    mice = t.nation.where(k < 10).select(mouse, _text(_l("A0|A"), k).alias("mgi_allele_id"), F.when(k % 3 == 0, "wild").otherwise("Tlr4<Lps-d>").alias("mouse_allele"), _l("on C3H/HeJ").alias("genetic_background"))
    return reports.positive_control(controls, human, mice, t.nation.where(k % 2 == 0).select(gene, mouse), "Lps-d", "C3H/HeJ")


@query("SELECT count(*) FILTER (o_orderpriority = '1-URGENT' AND l_returnflag = 'R') AS invalid_rows FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def va_forbidden_pairs(t):
    return reports.forbidden_pairs(_control_links(t)[0], "1-URGENT", "R")


@query("SELECT 'n' || i AS control_id, CASE i WHEN 1 THEN 'PASS' WHEN 2 THEN 'PASS' ELSE 'FAIL' END AS status FROM range(1, 4) r(i)")
def va_negative_controls(t):
    rows = [("n1", "non_orthologous_gene"), ("n2", "different_residue_and_substitution"), ("n3", "other")]
    invalid = reports.forbidden_pairs(_control_links(t)[0], "no gene", "R").first()["invalid_rows"]
    return reports.negative_controls(t.spark.createDataFrame(rows, "control_id string, expected_rejection_reason string"), invalid, "p.1", "p.2").select("control_id", "status")


@query(f"WITH {CONTROL_SQL} SELECT control_id, category_id, CASE WHEN want AND found_rows > 0 THEN 'Expected positive control recovered.' WHEN want THEN 'Expected positive control was not recovered.' WHEN found_rows > 0 THEN 'Additional cross-tier recovery; retained for review.' ELSE 'No recovery expected for this basis.' END AS interpretation FROM mat")
def va_expectation_texts(t):
    return _matrix(t)[1].select("control_id", "category_id", "interpretation")


@query(f"""WITH {FLAG_SQL}, bad AS (SELECT *, row_number() OVER (ORDER BY match_id) AS i FROM m)
SELECT unnest(['band_A','band_B','band_C','band_D','rank_beyond_k','flag_differs','eligibility_differs','unknown_gene','unknown_left_text','unknown_right_text','no_human_annotation','no_mouse_annotation','repeated_match','hand_curated_rows']) AS audit,
  unnest([count(*) FILTER (band = 'A'), count(*) FILTER (band = 'B'), count(*) FILTER (band = 'C'), 0, count(*) FILTER (s < 0.2), count(*) FILTER (conflict = 0) , count(*) FILTER (band <> 'D'), count(*) FILTER (gene = '1'), count(*) FILTER (left_id[-1:] = '4'), count(*) FILTER (right_id[-1:] = '4'), count(*) FILTER (left_id[-1:] = '6'), count(*) FILTER (right_id[-1:] = '7'), count(*), (SELECT count(*) FROM embeddings WHERE vec_id % 10 IN (0, 2, 8))]) AS violations FROM bad""")
def va_broken_invariants(t):
    """A result in which every rule but one is broken: scores lowered by a half, ranks, flags and grades changed, genes, texts and annotations left out, matches repeated."""
    found = _found(t).withColumn("score", F.col("score") - 2).withColumn("retrieval_rank", F.when(F.col("score") < 0.2 - 2, 99).otherwise(F.col("retrieval_rank"))).withColumn("direction_conflict", F.lit(1)).withColumn("review_status", F.when(F.col("review_status") == "direction_conflict", "direction_conflict").otherwise("unreviewed")).withColumn("eligible_for_default_use", F.lit(0))
    found = found.withColumn("retrieval_rank", F.when(F.col("score") + 2 < 0.2, 99).otherwise(0))
    e = t.embeddings.select(F.col("label").cast("string").alias("gene"), F.format_string("T%06d", "vec_id").alias("text_id"), "vec_id")
    genes = e.select(F.col("gene").alias("human_gene")).distinct().where("human_gene <> '1'")
    human = e.where("vec_id % 2 = 0 and vec_id % 10 <> 6").withColumn("evidence_class", F.when(F.col("vec_id") % 10 != 4, "literature_curated").otherwise("gwas_significant"))
    return reports.semantic_audits(found.unionByName(found.limit(0)).unionByName(found), human, e.where("vec_id % 2 = 1 and vec_id % 10 <> 7"), e.where("vec_id % 10 <> 4"), genes, BANDS).withColumn("violations", F.when(F.col("audit").isin("repeated_match", "hand_curated_rows"), F.col("violations")).otherwise(F.floor(F.col("violations") / 2)).cast("long"))


@query("""WITH p AS (SELECT 'V' || c_custkey % 500 AS pair_id, c_nationkey AS g, c_custkey AS v FROM customer),
c(audit, violations) AS (SELECT 'unique variant_pair pair_id', (SELECT count(*) FROM (SELECT pair_id FROM p GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'unique variant_pair human_gene,human_variant_id,mouse_gene,mouse_variant_or_allele_id', 0
UNION ALL SELECT 'unique connection_evidence evidence_id', (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'reference connection_evidence pair_id', (SELECT count(*) FROM orders WHERE 'V' || o_orderkey % 700 NOT IN (SELECT pair_id FROM p)))
SELECT audit, violations::BIGINT AS violations FROM c""")
def va_constraints(t):
    """Keys and references of stored tables, with repeated pairs and evidence of unknown ones."""
    shape = lambda name, df, **c: df.select(*(c.get(x.split(" ")[0], F.lit(None)).cast(x.split(" ")[1]).alias(x.split(" ")[0]) for x in catalog.TABLES[name].split(", ")))
    pairs = shape("variant_pair", t.customer, pair_id=_text(_l("V"), F.col("c_custkey") % 500), human_gene=_text("c_nationkey"), human_variant_id=_text("c_custkey"), mouse_gene=_l("m"), mouse_variant_or_allele_id=_l("a"))
    evidence = shape("connection_evidence", t.orders, evidence_id=F.col("o_custkey"), pair_id=_text(_l("V"), F.col("o_orderkey") % 700))
    catalog.register(t.spark, {"variant_pair": pairs, "connection_evidence": evidence})
    return catalog.constraint_audits(t.spark).where(F.col("audit").contains("variant_pair") | F.col("audit").contains("connection_evidence"))


@query(f"""WITH {FLAG_SQL}, ann AS (SELECT vec_id, printf('T%06d', vec_id) AS id, label::VARCHAR AS gene FROM embeddings)
SELECT match_id, band AS cosine_class, status AS review_status, h.vec_id AS human_evidence_id, x.vec_id AS mouse_evidence_id, 'rs' || h.vec_id AS rs_id FROM m JOIN ann h ON h.gene = m.gene AND h.id = left_id JOIN ann x ON x.gene = m.gene AND x.id = right_id WHERE eligible = 1""")
def vw_stored_correspondence(t):
    """The view active_variant_correspondence over stored matches and annotations."""
    e = t.embeddings.select(F.col("label").cast("string").alias("gene"), F.format_string("T%06d", "vec_id").alias("text_id"), "vec_id")
    flagged = _found(t)
    genes = e.select(F.col("gene").alias("human_gene"), F.concat(_l("m"), "gene").alias("mouse_gene")).distinct()
    # The published id names both genes; here the flagged one stands for it.
    stored = semantic.published_matches(flagged, genes, "model", "1").drop("match_id").withColumn("match_id", X.content_id("SM:", "human_gene", "human_gene", "human_text_id", "mouse_text_id", _l("1")))
    shape = lambda name, df, **c: df.select(*(c.get(x.split(" ")[0], F.lit(None)).cast(x.split(" ")[1]).alias(x.split(" ")[0]) for x in catalog.TABLES[name].split(", ")))
    human = shape("human_annotation", e, evidence_id=F.col("vec_id"), human_gene=F.col("gene"), text_id=F.col("text_id"), rs_id=_text(_l("rs"), "vec_id"))
    mouse = shape("mouse_annotation", e, evidence_id=F.col("vec_id"), mouse_gene=F.concat(_l("m"), "gene"), text_id=F.col("text_id"))
    catalog.register(t.spark, {"phenotype_match": stored.select(*semantic.STORED), "human_annotation": human, "mouse_annotation": mouse})
    out = t.spark.table("active_variant_correspondence")
    return out.select("match_id", "cosine_class", "review_status", F.col("human_evidence_id").cast("long").alias("human_evidence_id"), F.col("mouse_evidence_id").cast("long").alias("mouse_evidence_id"), "rs_id")


@query(f"""WITH {CONTROL_SQL}, h AS (SELECT control_id, o_orderkey, l_linenumber, row_number() OVER (PARTITION BY control_id ORDER BY o_orderkey, l_linenumber) AS r FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN controls ON g = o_orderpriority AND v = o_custkey::VARCHAR AND mg = l_returnflag AND al IN ('L' || l_linenumber, 'S' || l_suppkey % 10))
SELECT control_id, 'O' || o_orderkey AS human, 'line ' || l_linenumber AS mouse, o_orderkey || ' / ' || l_linenumber AS detail FROM h WHERE r = 1""")
def pl_representative_evidence(t):
    """The first link of each control, in the words of its route."""
    links, controls = _control_links(t)
    links = links.select("*", _text(_l("O"), "o_orderkey").alias("hpo_label"), _text(_l("line "), "l_linenumber").alias("mp_label"), _text("o_orderkey").alias("hpo_id"), _l("").alias("predicate"), _text("l_linenumber").alias("mp_id"))
    return reports.representative_evidence(reports.first_links(links, controls, ["o_orderkey", "l_linenumber"]), "category1-1").select("control_id", "human", "mouse", "detail")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'category1-1|category2-2|semantic_B' WHEN n_nationkey % 3 = 1 THEN 'category1-1|category2-2' ELSE 'semantic_B' END AS routes FROM nation")
def va_primary_routes(t):
    k = F.col("n_nationkey")
    n = t.nation.select("n_nationkey", F.when(k % 3 < 2, "category1-1|category2-2").otherwise("").alias("e"), F.when(k % 3 == 1, F.lit(None)).otherwise("B").alias("s"))
    return n.select("n_nationkey", F.array_join(reports.primary_routes(F.col("e"), F.col("s")), "|").alias("routes"))


# --- texts and counts -------------------------------------------------------------------------


@query("""WITH u AS (SELECT c_mktsegment AS l, 'human' AS u FROM customer UNION ALL SELECT p_type, 'human' FROM part UNION ALL SELECT p_type, 'mouse' FROM part UNION ALL SELECT p_brand, 'mouse' FROM part)
SELECT 'PT:' || substr(sha256(l), 1, 24) AS text_id, l AS label, string_agg(DISTINCT u, '|' ORDER BY u) AS usage FROM u WHERE lower(l) NOT IN ('economy') GROUP BY l""")
def ag_text_catalog(t):
    s = DEFAULT.with_values(placeholders=("economy",))
    use = lambda df, c: semantic.usable_annotations(df.select(F.concat(_l("  "), c, _l("\t ")).alias("x")), "x", s)
    human = use(t.customer, "c_mktsegment").unionByName(use(t.part, "p_type"))
    return semantic.text_catalog(human=human, mouse=use(t.part, "p_type").unionByName(use(t.part, "p_brand")))


@query("""WITH h AS (SELECT c_nationkey AS gene, count(DISTINCT c_mktsegment) AS texts, count(*) AS n FROM customer GROUP BY 1), m AS (SELECT s_nationkey AS gene, count(DISTINCT s_suppkey % 7) AS texts, count(*) AS n FROM supplier GROUP BY 1)
SELECT gene, h.texts AS human_texts, m.texts AS mouse_texts, h.n AS human_rows, m.n AS mouse_rows, h.texts * m.texts AS compared, h.n * m.n AS avoided FROM h JOIN m USING (gene)""")
def ag_gene_texts(t):
    """Distinct texts, rows and comparisons of each gene."""
    return semantic.gene_texts(t.customer.select(F.col("c_nationkey").alias("gene"), F.col("c_mktsegment").alias("text_id")), t.supplier.select(F.col("s_nationkey").alias("gene"), (F.col("s_suppkey") % 7).cast("string").alias("text_id")))


@query(f"WITH {FLAG_SQL} SELECT (SELECT count(DISTINCT gene) FROM pairs) AS genes, (SELECT count(*) FROM pairs) AS compared, (SELECT count(*) FROM pairs) - count(*) AS omitted FROM m")
def ag_compared_omitted(t):
    left, right = _sides(t)
    ids = lambda df: df.select("gene", F.col("id").alias("text_id"))
    return semantic.compared_totals(semantic.gene_texts(ids(left), ids(right)), _found(t))


@query("SELECT max(abs(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1)) < 1e-5 AS unit_norms, count(*) AS vectors FROM embeddings")
def va_unit_norms(t):
    return semantic.norm_audit(t.embeddings.select("embedding")).select((F.col("largest_error") < 1e-5).alias("unit_norms"), "vectors")


@query(f"WITH {FLAG_SQL} SELECT band AS cosine_class, count(*) AS stored, count(*) AS exported, true AS agrees FROM m GROUP BY band")
def va_export_counts(t):
    """Matches written by class, read back and counted beside the stored ones."""
    found = _found(t).select("match_id", "cosine_class", "score")
    path = scratch(t.spark, "export")
    writers.write_gzip_tsv(found, path, ["cosine_class"])
    back = t.spark.read.csv(path, sep="\t", header=True)
    return reports.export_counts(found, back, "cosine_class").select("cosine_class", "stored", "exported", "agrees")


@query("SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END, ''), c_name) AS first, replace(replace('a<b>&\"' || c_name || '''', '&', '&amp;'), '<', '&lt;').replace('>', '&gt;').replace('\"', '&quot;').replace('''', '&#39;') AS safe, printf('%,d', c_custkey * 1000) AS grouped FROM customer")
def fn_first_escape_group(t):
    k = F.col("c_custkey")
    return t.customer.select("c_custkey", X.first_text(F.when(k % 3 == 0, "").otherwise(F.col("c_mktsegment")), "c_name").alias("first"), X.escaped(F.concat(_l('a<b>&"'), "c_name", _l("'"))).alias("safe"), X.grouped_number(k * 1000).alias("grouped"))


@query("SELECT s_suppkey, 'A:B' || s_suppkey AS symbol, (s_suppkey % 9)::VARCHAR AS id FROM supplier UNION ALL SELECT s_suppkey, 'X', '7' FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, unnest(['plain', 'Q']), '' FROM supplier")
def fn_gene_list(t):
    s = t.supplier.select("s_suppkey", F.concat(_text(_l("A:B"), "s_suppkey", _l(":"), F.col("s_suppkey") % 9, _l("|.||plain|:3|Q:")), F.when(F.col("s_suppkey") % 2 == 0, "|X:7").otherwise("")).alias("g"))
    return s.select("s_suppkey", F.explode(X.gene_list("g")).alias("x")).select("s_suppkey", "x.symbol", "x.id")


# --- sources and sinks ------------------------------------------------------------------------


def _lines(t, name: str, rows: DataFrame, *head: str) -> str:
    """A folder of text files of ``rows`` (_ord, value) after the lines ``head``: ranges of _ord, a file each, in their order."""
    path = scratch(t.spark, name)
    ahead = t.spark.createDataFrame([(i - len(head), h) for i, h in enumerate(head)], "_ord long, value string") if head else None
    rows = rows.select(F.col("_ord").cast("long").alias("_ord"), "value")
    (rows if ahead is None else ahead.unionByName(rows)).orderBy("_ord").select("value").write.text(path)
    return path


def _written(rows: DataFrame, write, path: str) -> str:
    """Files below ``path``, written by the tasks that have their rows: ``write`` makes (name, bytes) pairs of the rows of a partition."""

    def run(batches):
        from pyspark import TaskContext

        part = list(batches)
        if not part:
            return
        made = []
        for name, content in write(TaskContext.get().partitionId(), pd.concat(part)):
            with created(f"{path}/{name}") as f:
                f.write(content)
            made.append(name)
        yield pd.DataFrame({"name": made})

    assert rows.mapInPandas(run, "name string").count() >= 0
    return path


@query("SELECT o_orderstatus AS chrom, o_custkey::VARCHAR AS pos, o_orderkey::VARCHAR AS id, 'C' || o_custkey % 25 AS gene FROM orders WHERE o_orderkey % 9 <> 0")
def src_vcf(t):
    """Variants as text after comment lines, some with too few cells."""
    v = _vcf(t)
    line = F.when(F.col("_ord") % 9 == 0, F.concat_ws("\t", "chrom", "pos", "id")).otherwise(F.concat_ws("\t", "chrom", "pos", "id", "ref", "alt", "qual", "filter", "info"))
    rows = readers.vcf(t.spark, _lines(t, "vcf", v.select("_ord", line.alias("value")), "##fileformat=VCFv4.1", "#CHROM\tPOS\tID"))
    return rows.select("chrom", "pos", "id", F.get(X.gene_list(X.info_value("info", "GENEINFO")), F.lit(0))["symbol"].alias("gene"))


@query("""SELECT 'HP:' || s_suppkey % 8 AS hpo_id, 'MP:' || s_suppkey % 6 AS mp_id, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'mouse' END AS hpo_label, CASE WHEN s_suppkey % 2 = 0 THEN 'mouse' ELSE s_name END AS mp_label, 'skos:exactMatch' AS predicate, '0.' || s_suppkey % 10 AS confidence, 'set' AS mapping_source FROM supplier WHERE s_suppkey % 5 <> 0""")
def src_mapping_table(t):
    """Mappings in both directions after a preamble; every fifth pair is of other ontologies."""
    k = F.col("s_suppkey")
    hp, mp = _text(_l("http://purl.obolibrary.org/obo/HP_"), k % 8), _text(_l("MP:"), k % 6)
    line = F.when(k % 5 == 0, F.concat_ws("\t", _l("DOID:1"), "s_name", _l("skos:exactMatch"), mp, _l("x"), _l("1"))).when(k % 2 == 0, F.concat_ws("\t", hp, "s_name", _l("http://www.w3.org/2004/02/skos/core#exactMatch"), mp, _l("mouse"), _text(_l("0."), k % 10)))
    line = F.coalesce(line, F.concat_ws("\t", mp, "s_name", _l("skos:exactMatch"), hp, _l("mouse"), _text(_l("0."), k % 10)))
    path = _lines(t, "mappings", t.supplier.select(k.alias("_ord"), line.alias("value")), "#mapping_set: x", "# license", "subject_id\tsubject_label\tpredicate_id\tobject_id\tobject_label\tconfidence")
    return readers.sssom(t.spark, path, "set").select("hpo_id", "mp_id", "hpo_label", "mp_label", "predicate", "confidence", "mapping_source")


@query("SELECT 'OMIM:' || p_partkey % 7 AS database_id, p_type AS disease_name, 'HP:' || p_size % 10 AS hpo_id, 'P' AS aspect, p_partkey::VARCHAR AS reference FROM part")
def src_annotations(t):
    """Disease annotations behind a commented header."""
    k = F.col("p_partkey")
    cells = {"database_id": _text(_l("OMIM:"), k % 7), "disease_name": F.col("p_type"), "hpo_id": _text(_l("HP:"), F.col("p_size") % 10), "reference": _text(k), "aspect": _l("P")}
    line = F.concat_ws("\t", *(cells.get(c, _l("")) for c in readers.ANNOTATION))
    path = _lines(t, "annotations", t.part.select(k.alias("_ord"), line.alias("value")), "#version: 1", "#" + "\t".join(readers.ANNOTATION))
    return readers.annotations(t.spark, path).select("database_id", "disease_name", "hpo_id", "aspect", "reference")


@query("SELECT 'MGI:' || c_custkey AS mgi_marker_id, c_name AS mouse_gene, c_custkey::VARCHAR AS mouse_ncbi_gene_id, upper(c_name) AS human_gene FROM customer WHERE c_custkey % 4 <> 0 AND c_custkey % 3 <> 0")
def src_orthologs(t):
    """Pairs without a marker id, or without a symbol, are no rows."""
    k = F.col("c_custkey")
    line = F.concat_ws("\t", F.when(k % 4 == 0, "none").otherwise(_text(_l("MGI:"), k)), F.when(k % 3 == 0, "").otherwise(F.col("c_name")), _text(k), _text(_l("HGNC:"), k), F.upper("c_name"), _text(_l("1"), k))
    return readers.orthologs(t.spark, _lines(t, "orthologs", t.customer.select(k.alias("_ord"), line.alias("value")), "MGI Marker ID\tsymbol\tid\tHGNC\thuman\tid")).select("mgi_marker_id", "mouse_gene", "mouse_ncbi_gene_id", "human_gene")


@query("SELECT 'MGI:' || c_custkey % 50 AS allele_id, max_by(c_name, c_custkey) AS allele_name, max_by(c_mktsegment, c_custkey) AS allele_type FROM customer WHERE c_custkey % 7 <> 0 GROUP BY 1")
def src_allele_metadata(t):
    """The last line of each allele; comments and short lines are none."""
    k = F.col("c_custkey")
    line = F.when(k % 7 == 0, F.concat(_l("#"), "c_name")).otherwise(F.concat_ws("\t", _text(_l("MGI:"), k % 50), _l("s"), "c_name", "c_mktsegment", _l("x"), _l("r"), _l("MGI:1"), _l("m")))
    return readers.allele_metadata(t.spark, _lines(t, "alleles", t.customer.select(k.alias("_ord"), line.alias("value")))).select("allele_id", "allele_name", "allele_type")


@query("SELECT 'MP:' || p_partkey % 90 AS mp_id, max_by(p_name, p_partkey) AS mp_label, '' AS mp_definition FROM part WHERE p_partkey % 4 <> 0 GROUP BY 1")
def src_vocabulary(t):
    k = F.col("p_partkey")
    line = F.concat_ws("\t", F.when(k % 4 == 0, "HP:1").otherwise(_text(_l("MP:"), k % 90)), "p_name")
    return readers.vocabulary(t.spark, _lines(t, "terms", t.part.select(k.alias("_ord"), line.alias("value")))).select("mp_id", "mp_label", "mp_definition")


@query("SELECT c_name AS allelic_composition, 'MGI:' || c_nationkey AS marker_ids, 'DOID:' || c_custkey % 5 AS mouse_doid, 'OMIM:' || c_custkey % 4 AS mouse_omim_ids FROM customer WHERE c_custkey % 6 <> 0")
def src_disease_models(t):
    k = F.col("c_custkey")
    cells = F.concat_ws("\t", "c_name", _l("a"), _l("A1"), "c_mktsegment", _l("MP:1"), _l("1"), _text(_l("MGI:"), "c_nationkey"), _text(_l("DOID:"), k % 5), _text(_l("OMIM:"), k % 4))
    line = F.when(k % 6 == 0, cells).otherwise(F.concat(cells, _l("\tG1")))
    return readers.disease_models(t.spark, _lines(t, "models", t.customer.select(k.alias("_ord"), line.alias("value")), "Allelic Composition\tx\tx\tx\tx\tx\tx\tx\tx\tx")).select("allelic_composition", "marker_ids", "mouse_doid", "mouse_omim_ids")


@query("SELECT c_custkey::VARCHAR AS k, 'a \"quoted\"' || chr(9) || 'cell' || chr(10) || c_name AS cell, c_mktsegment AS plain FROM customer")
def src_quoted_tsv(t):
    """Quoted cells with separators, line ends and doubled quotes; files by ranges of the key, each with its header."""
    cells = t.customer.select(F.col("c_custkey").alias("k"), F.concat(_l('a "quoted"\tcell\n'), "c_name").alias("cell"), F.col("c_mktsegment").alias("plain"))
    path = scratch(t.spark, "quoted")
    writers.write_quoted_tsv(cells, path, "none", order=["k"])
    return readers.quoted_tsv(t.spark, path)


@query("SELECT c_custkey::VARCHAR AS k, 'a quo' || chr(9) || 'ted cell \"' || chr(10) || c_name AS cell, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS plain FROM customer")
def src_toggled_tsv(t):
    """Quotes inside cells, around separators and line ends, doubled ones, short rows; files by ranges of the key."""
    cell = F.concat(_l('a q"uo\t"ted cell """\n"'), "c_name")
    line = F.concat_ws("\t", F.col("c_custkey").cast("string"), cell, F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")))
    path = scratch(t.spark, "toggled")
    rows = t.customer.select("c_custkey", line.alias("value")).orderBy("c_custkey")
    _written(rows, lambda n, part: [(f"part-{n:05d}.tsv", ("k\tcell\tplain\n" + "\r\n".join(part["value"]) + "\n").encode())], path)
    return readers.toggled_tsv(t.spark, path).drop("_ord")


@query("SELECT p_partkey::VARCHAR AS \"STUDY ACCESSION\", 'ENSG' || p_partkey % 25 AS SNP_GENE_IDS, p_brand AS trait FROM part")
def src_zipped_associations(t):
    """ZIP files of ranges of the table, each made by a task, with two members that have a header each, and one that is no table."""

    def zipped(n, part):
        raw, rows = io.BytesIO(), [f"{k}\tENSG{k % 25}\t{brand}" for k, brand in zip(part["p_partkey"], part["p_brand"])]
        with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
            for name, some in (("a.tsv", rows[: len(rows) // 2]), ("b.tsv", rows[len(rows) // 2 :]), ("c.txt", ["no row"])):
                z.writestr(name, "\n".join(["STUDY ACCESSION\tSNP_GENE_IDS\ttrait", *some]) + "\n")
        yield f"{n:05d}.zip", raw.getvalue()

    path = _written(t.part.select("p_partkey", "p_brand").repartitionByRange(4, "p_partkey"), zipped, scratch(t.spark, "associations"))
    return readers.associations(readers.zip_lines(t.spark, path)).drop("_ord")


@query("SELECT vec_id, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings")
def src_npy_vectors(t):
    """Matrices of ranges of the table, each made by a task, with the key as first column."""
    import numpy as np

    def saved(n, part):
        raw = io.BytesIO()
        np.save(raw, np.column_stack([part["vec_id"].to_numpy(np.float64), np.array(part["embedding"].tolist(), np.float32).astype(np.float64)]))
        yield f"{n:05d}.npy", raw.getvalue()

    path = _written(t.embeddings.select("vec_id", "embedding").repartitionByRange(4, "vec_id"), saved, scratch(t.spark, "matrix"))
    rows = readers.npy_vectors(t.spark, path)
    total = F.aggregate(F.slice("embedding", F.lit(2), F.size("embedding") - 1), F.lit(0.0), lambda s, x: s + x.cast("double"))
    return rows.select(F.get("embedding", F.lit(0)).cast("long").alias("vec_id"), F.round(total, 4).alias("total"))


@query("SELECT n_nationkey::VARCHAR AS id, CASE WHEN n_nationkey >= 20 THEN 'new' WHEN n_nationkey % 3 = 0 THEN 'changed' ELSE 'same' END AS change FROM nation")
def src_manifest_changes(t):
    n = t.nation.select(_text("n_nationkey").alias("id"), F.sha2("n_name", 256).alias("sha256"), "n_nationkey")
    old = n.where("n_nationkey < 20").withColumn("sha256", F.when(F.col("n_nationkey") % 3 == 0, "x").otherwise(F.col("sha256")))
    return readers.manifest_changes(n, old).select("id", "change")


@query("SELECT 'main' AS part, count(*) AS n FROM orders UNION ALL SELECT 'side', count(*) FROM orders WHERE o_orderstatus = 'F'")
def snk_both(t):
    """One scan to two tables, read back and counted."""
    parts = writers.fan_out(t.orders, scratch(t.spark, "both"), main=F.lit(True), side=F.col("o_orderstatus") == "F")
    one = lambda p: parts[p].agg(F.count("*").alias("n")).select(F.lit(p).alias("part"), "n")
    return one("main").unionByName(one("side"))


@query("SELECT count(*) AS scanned, count(*) FILTER (o_orderstatus = 'F') AS accepted, count(DISTINCT o_custkey) AS customers FROM orders")
def snk_statistics(t):
    """Named counts as a line of JSON, written, read and parsed again."""
    text = writers.statistics(t.orders, scanned=F.count("*"), accepted=F.count_if(F.col("o_orderstatus") == "F"), customers=F.count_distinct("o_custkey"))
    path = scratch(t.spark, "statistics") + "/statistics.json"
    writers.write_bytes(t.spark, path, text.encode())
    row = readers.read_json(path, spark=t.spark)
    assert readers.read_json(path + ".none", fallback={}, spark=t.spark) == {} and json.loads(text) == row
    return t.spark.createDataFrame([(row["scanned"], row["accepted"], row["customers"])], "scanned long, accepted long, customers long")


@query("SELECT n_name || '.txt' AS file, length(n_name)::BIGINT AS bytes, sha256(n_name) AS sha256 FROM nation")
def snk_file_manifest(t):
    """A file for each nation, written by the tasks that have them; path, size and digest of each."""
    path = _written(t.nation.select("n_name"), lambda n, part: [(f"{name}.txt", name.encode()) for name in part["n_name"]], scratch(t.spark, "files"))
    return writers.file_manifest(t.spark, path, "*.txt").select(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("%20"), F.lit(" ")).alias("file"), "bytes", "sha256")


@query("SELECT o_orderstatus AS chrom, o_custkey::VARCHAR AS pos, o_orderkey::VARCHAR AS id, row_number() OVER (ORDER BY o_orderkey) AS place FROM orders WHERE o_orderkey % 9 <> 0")
def src_block_gzip(t):
    """Variants in block-gzip files, written by ranges and read by ranges of 64 KB: the order of lines is that of the table."""
    v = _vcf(t)
    line = F.when(F.col("_ord") % 9 == 0, F.concat(_l("#"), "info")).otherwise(F.concat_ws("\t", *(F.col(c) for c in readers.VCF)))
    path = scratch(t.spark, "blocks")
    write_block_gzip(v.select("_ord", line.alias("value")).orderBy("_ord").select("value"), path)
    lines = gzip_lines(t.spark, f"{path}/*.gz", 1 << 16).where(~F.startswith("value", _l("#")))
    cells = F.split("value", "\t")
    rows = numbered(lines.select(F.struct("file", "line").alias("_ord"), *(F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(readers.VCF[:3]))), "_ord", "place")
    return rows.select("chrom", "pos", "id", "place")


# --- the semantic result in use ---------------------------------------------------------------


def _correspondence(t) -> DataFrame:
    """Matches spread over annotations: vector v is variant rs(v % 40) on one side and alleles A(v % 6)|A9 on the other."""
    f = _found(t).select("gene", "left_id", "right_id", F.col("score").alias("cosine_similarity"), "cosine_class", "match_id", "review_status", "direction_conflict", "eligible_for_default_use")
    k = lambda c: F.substring(c, 2, 6).cast("int")
    return f.select(
        F.concat(_l("G"), "gene").alias("human_gene"), F.concat(_l("m"), "gene").alias("mouse_gene"), F.col("left_id").alias("human_text_id"), F.col("right_id").alias("mouse_text_id"), _text(_l("rs"), k("left_id") % 40).alias("rs_id"), _text(_l("A"), k("right_id") % 6, _l("|A9")).alias("mgi_allele_id"),
        (k("left_id") % 7 == 0).cast("int").alias("curated_input"), "cosine_similarity", "cosine_class", "match_id", "review_status", "direction_conflict", "eligible_for_default_use",
    )


_CORRESPONDENCE_SQL = f"""{FLAG_SQL},
v AS (SELECT 'G' || gene AS human_gene, left_id, right_id, 'rs' || left_id[2:]::INT % 40 AS rs_id, 'A' || right_id[2:]::INT % 6 AS allele, (left_id[2:]::INT % 7 = 0)::INT AS curated, s, band, match_id, status, conflict, eligible FROM m)"""


def _semantic_controls(t) -> DataFrame:
    """A control for each nation; those of 20 and up expect band A of a variant that no vector has."""
    k = F.col("n_nationkey")
    return t.nation.select(
        _text(_l("c"), k).alias("control_id"), _text(_l("G"), k % 5).alias("human_gene"), _text(_l("rs"), F.when(k < 20, k * 2).otherwise(99)).alias("human_variant"), _text(_l("m"), k % 5).alias("mouse_gene"), F.when(k % 2 == 0, "A9").otherwise(_text(_l("A"), k % 6)).alias("mouse_allele_id"),
        F.when(k % 3 == 0, "D").when(k >= 20, "A").when(k % 3 == 1, "C").otherwise("").alias("expected_semantic_class"), F.when(k % 4 == 0, "category1-1").otherwise("").alias("expected_categories"), _l("p").alias("human_protein_change"), _l("a").alias("mouse_allele"), _l("q").alias("mouse_protein_change"),
    )


_SEMANTIC_CONTROL_SQL = f"""{_CORRESPONDENCE_SQL},
ctl AS (SELECT n_nationkey AS k, 'c' || n_nationkey AS control_id, 'G' || n_nationkey % 5 AS g, 'rs' || CASE WHEN n_nationkey < 20 THEN n_nationkey * 2 ELSE 99 END AS rs, CASE WHEN n_nationkey % 2 = 0 THEN 'A9' ELSE 'A' || n_nationkey % 6 END AS al, CASE WHEN n_nationkey % 3 = 0 THEN 'D' WHEN n_nationkey >= 20 THEN 'A' WHEN n_nationkey % 3 = 1 THEN 'C' ELSE '' END AS want FROM nation),
hit AS (SELECT ctl.*, v.* FROM ctl LEFT JOIN v ON v.human_gene = g AND v.rs_id = rs AND (al = 'A9' OR al = v.allele)),
recovery AS (SELECT control_id, k, want, count(*) FILTER (band = 'A') AS a, count(*) FILTER (band = 'B') AS b, count(*) FILTER (band = 'C') AS c, count(*) FILTER (band = 'D') AS d, round(max(CASE WHEN eligible = 1 THEN s END), 6) AS best,
  count(*) FILTER (eligible = 1 AND curated = 1) AS hand, count(*) FILTER (eligible = 1 AND conflict = 1) AS conflicts, count(*) FILTER (eligible = 1 AND curated = 0 AND band = want) AS expected_rows FROM hit GROUP BY ALL)"""


@query(f"""WITH {_SEMANTIC_CONTROL_SQL} SELECT control_id, a AS "class_A_rows", b AS "class_B_rows", c AS "class_C_rows", d AS "class_D_archive_rows", best AS best_active_cosine, hand AS active_curated_input_rows, conflicts AS active_direction_conflict_rows, want AS expected_semantic_class, expected_rows AS expected_class_noncurated_rows,
CASE WHEN want <> '' AND expected_rows = 0 THEN 'FAIL' ELSE 'PASS' END AS semantic_expectation_status FROM recovery""")
def va_semantic_recovery(t):
    """Controls over the correspondences: rows of each band, the best, and whether the expected band was met."""
    out = reports.semantic_recovery(_semantic_controls(t), _correspondence(t))
    return out.drop("human_gene", "rs_id", "mgi_allele_id").withColumn("best_active_cosine", F.round("best_active_cosine", 6))


@query(f"""WITH {_SEMANTIC_CONTROL_SQL} SELECT control_id, CASE WHEN (k % 4 <> 0 OR k % 8 = 0) AND (want = '' OR (want = 'A' AND a > 0) OR (want = 'B' AND b > 0) OR (want = 'C' AND c > 0)) THEN 'FOUND' ELSE 'NOT_FOUND' END AS case_study_status,
array_to_string(list_filter([CASE WHEN k % 4 = 0 THEN 'category1-1' END, CASE WHEN want <> '' THEN 'semantic_' || want END], lambda x: x IS NOT NULL), '|') AS primary_connection_routes, CASE WHEN k % 8 = 0 THEN 3 ELSE 0 END::BIGINT AS category1_1_evidence_rows, c AS "semantic_class_C_evidence_rows", d AS "semantic_class_D_archive_rows",
CASE WHEN k < 10 THEN 'category1-1' ELSE 'category2-2' END AS representative_route, CASE WHEN k < 10 THEN 'h' || k ELSE '' END AS representative_human_phenotype, CASE WHEN k < 10 THEN 'HP:' || k || ' / p' ELSE '' END AS representative_evidence_detail FROM recovery""")
def pl_case_studies(t):
    """A line for each control; every eighth has rows of category1-1, the first ten a link that stands for it."""
    k, controls = F.col("n_nationkey"), _semantic_controls(t)
    matrix = t.nation.select(_text(_l("c"), k).alias("control_id"), _l("category1-1").alias("category_id"), F.when(k % 8 == 0, 3).otherwise(0).cast("long").alias("found_rows"))
    narratives = t.nation.select(_text(_l("c"), k).alias("control_id"), F.when(k < 10, "category1-1").otherwise("category2-2").alias("representative_route"), _l("i").alias("interpretation"), _l("l").alias("limitation"))
    links = t.nation.where("n_nationkey < 12").select(_text(_l("c"), k).alias("control_id"), _text(_l("h"), k).alias("hpo_label"), _l("").alias("mp_label"), _text(_l("HP:"), k).alias("hpo_id"), _l("p").alias("predicate"), _l("").alias("mp_id"))
    out = reports.case_studies(controls, matrix, reports.semantic_recovery(controls, _correspondence(t)), narratives, {"category1-1": links})
    return out.select("control_id", "case_study_status", "primary_connection_routes", "category1_1_evidence_rows", "semantic_class_C_evidence_rows", "semantic_class_D_archive_rows", "representative_route", "representative_human_phenotype", "representative_evidence_detail")


@query(f"""WITH {_CORRESPONDENCE_SQL} SELECT match_id, left_id AS human_phenotype, right_id AS mouse_phenotype, round(s, 6) AS score FROM v WHERE human_gene = 'G1' AND rs_id = 'rs2' AND eligible = 1""")
def flt_of_variant(t):
    """Correspondences of one variant of one gene, with the labels of their texts."""
    texts = t.embeddings.select(F.format_string("T%06d", "vec_id").alias("text_id"), F.format_string("T%06d", "vec_id").alias("label"))
    out = lookups.of_variant(semantic.active(_correspondence(t)), texts, "G1", "rs2")
    return out.select("match_id", "human_phenotype", "mouse_phenotype", F.round("cosine_similarity", 6).alias("score"))


@query(f"""WITH {_CORRESPONDENCE_SQL},
best AS (SELECT 'best' AS list, match_id, row_number() OVER (ORDER BY s DESC, match_id) AS r FROM v WHERE band = 'A' AND status = 'unreviewed'),
odd AS (SELECT 'conflicts', match_id, row_number() OVER (ORDER BY match_id) AS r FROM v WHERE conflict = 1),
old AS (SELECT 'archive', match_id, row_number() OVER (ORDER BY match_id) AS r FROM v WHERE band = 'D')
SELECT list, match_id FROM best WHERE r <= 100 UNION ALL SELECT 'conflicts', match_id FROM odd WHERE r <= 100 UNION ALL SELECT 'archive', match_id FROM old WHERE r <= 100""")
def so_top_lists(t):
    """The hundred best unreviewed pairs of band A, the first hundred of opposite directions, and of the archive."""
    v = _correspondence(t)
    lists = {"best": lookups.of_status(v, "A", "unreviewed"), "conflicts": lookups.conflicting(v), "archive": lookups.archived(v)}
    out = None
    for name, df in lists.items():
        part = df.select(_l(name).alias("list"), "match_id")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"WITH {_CORRESPONDENCE_SQL} SELECT curated = 1 AS curated, count(*) AS n, count(DISTINCT rs_id) AS variants FROM v GROUP BY 1")
def flt_by_curation(t):
    """Correspondences whose human side was put in by hand, and the others."""
    v = _correspondence(t)
    one = lambda hand: lookups.by_curation(v, hand).groupBy(F.lit(hand).alias("curated")).agg(F.count("*").alias("n"), F.count_distinct("rs_id").alias("variants"))
    return one(True).unionByName(one(False))


@query("SELECT (row_number() OVER (ORDER BY s_nationkey, s_name))::BIGINT AS place, s_name FROM supplier")
def so_sorted_table(t):
    """A table written in one order over all of its files; read back, lines are in that order."""
    path = scratch(t.spark, "sorted")
    writers.write_tsv(t.supplier.select("s_nationkey", "s_name"), path, order=["s_nationkey", "s_name"])
    return numbered(readers.tsv(t.spark, path), "_ord", "place").select("place", "s_name")


@query("SELECT c_custkey::VARCHAR AS k, 'a \"q\"' || chr(9) || chr(10) || c_name AS cell, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END AS plain FROM customer")
def snk_quoted_tsv(t):
    """Cells with tabs, line ends and quotes, written with quoting and read back."""
    path = scratch(t.spark, "quoted-sink")
    writers.write_quoted_tsv(t.customer.select(F.col("c_custkey").alias("k"), F.concat(_l('a "q"\t\n'), "c_name").alias("cell"), F.when(F.col("c_custkey") % 2 == 0, None).otherwise(F.col("c_mktsegment")).alias("plain")), path)
    return readers.quoted_tsv(t.spark, path)


@query("SELECT batch, count(*) AS texts FROM (SELECT CASE WHEN min(p_size) <= 25 THEN 1 ELSE 2 END AS batch FROM part GROUP BY p_type, p_brand) GROUP BY batch")
def pl_kept_vectors(t):
    """Vectors of the labels of the smaller parts, then of all: each batch that the store has is of the texts that were new."""
    labels = lambda df: semantic.text_catalog(human=semantic.usable_annotations(df.withColumn("label", F.concat_ws(" ", "p_type", "p_brand")), "label")).select("text_id", "label")
    store = semantic.embedding.VectorStore(t.spark, scratch(t.spark, "vectors"), "hashed-trigrams", 128)
    out = t.spark.createDataFrame([], "batch int, texts long")
    for i, some in enumerate((t.part.where("p_size <= 25"), t.part)):
        seen, texts = set(store.batches()), labels(some)
        assert store.vectors(texts, semantic.hashed_embedding()).count() == texts.count()
        # No batch where the store had all texts.
        for path in set(store.batches()) - seen:
            out = out.unionByName(t.spark.read.parquet(path).agg(F.count("*").alias("texts")).select(F.lit(i + 1).alias("batch"), "texts"))
    return out


@query(sql_lexical("first_lines", "gene", "doc_id", "label", "true", "true", "[]::VARCHAR[]", {"htm": "html"}).replace("WITH l AS", "WITH sentences AS (SELECT lang || source AS s, doc_id, unnest(string_split(text, '.')) AS label FROM documents), first_lines AS (SELECT s || '/' || len(string_split(label, ' ')) AS gene, label, min(doc_id) AS doc_id FROM sentences GROUP BY 1, 2), l AS") + " SELECT gene, support, token_jaccard, count(*) AS n, min(left_id) AS first_left, max(right_id) AS last_right FROM m WHERE left_id < right_id GROUP BY ALL")
def jn_token_index_docs(t):
    """All different sentences of the documents, as labels: those of one language, source and number of words, each against those of later documents."""
    s = t.documents.select("doc_id", F.concat("lang", "source").alias("s"), F.explode(F.split("text", "[.]")).alias("label"))
    d = s.groupBy(F.concat("s", F.lit("/"), F.size(F.split("label", " ")).cast("string")).alias("gene"), "label").agg(F.min("doc_id").alias("id"))
    m = lexical.label_matches(d, d, DEFAULT.with_values(uninformative=()), {"htm": "html"}).where("left_id < right_id")
    return m.groupBy("gene", "support", "token_jaccard").agg(F.count("*").alias("n"), F.min("left_id").alias("first_left"), F.max("right_id").alias("last_right"))
