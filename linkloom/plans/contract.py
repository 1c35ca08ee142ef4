"""Row contracts of an exchange file: every broken rule as text, duplicates, and a verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators.keys import repeats

# The rules of the exchange contract.
REQUIRED = ("tier_id", "connection_basis", "match_level", "exact_match_definition", "human_gene", "human_variant_id", "human_assembly", "mouse_gene", "mouse_variant_id", "mouse_assembly", "ortholog_source", "cross_species_alignment_source", "alignment_version", "allele_orientation", "reciprocal_mapping", "qc_status", "source_dataset", "source_version", "source_record_id", "source_sha256")
CONSTANTS = {"tier_id": "tier0", "connection_basis": "exact_variant_correspondence"}
ENUMS = {"match_level": ("genomic_reciprocal_exact", "coding_exact", "protein_exact"), "allele_orientation": ("forward", "reverse_complement"), "qc_status": ("pending", "passed", "rejected")}
LEVEL_COLUMNS = {
    "genomic_reciprocal_exact": ("human_chromosome", "human_position", "human_reference_allele", "human_alternate_allele", "mouse_chromosome", "mouse_position", "mouse_reference_allele", "mouse_alternate_allele"),
    "coding_exact": ("human_transcript", "human_hgvs_c", "mouse_transcript", "mouse_hgvs_c"),
    "protein_exact": ("human_transcript", "human_hgvs_p", "mouse_transcript", "mouse_hgvs_p"),
}
#: Columns of the exchange file, in order.
COLUMNS = (
    "tier_id", "connection_basis", "match_level", "exact_match_definition", "human_gene", "human_ncbi_gene_id", "human_hgnc_id", "human_variant_id", "human_assembly", "human_chromosome", "human_position", "human_reference_allele", "human_alternate_allele", "human_transcript", "human_hgvs_c", "human_hgvs_p",
    "mouse_gene", "mouse_ncbi_gene_id", "mgi_marker_id", "mouse_variant_id", "mouse_assembly", "mouse_chromosome", "mouse_position", "mouse_reference_allele", "mouse_alternate_allele", "mouse_transcript", "mouse_hgvs_c", "mouse_hgvs_p",
    "ortholog_source", "cross_species_alignment_source", "alignment_version", "allele_orientation", "reciprocal_mapping", "qc_status", "source_dataset", "source_version", "source_record_id", "source_url", "source_sha256", "license", "contributor", "notes",
)
NOT_ORTHOLOGOUS = "human and mouse genes are not an accepted 1:1 ortholog pair"


def _value(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")


def row_errors(df: DataFrame, orthologs: DataFrame | None = None) -> DataFrame:
    """``df`` with errors, an array of the distinct rules that a row breaks.

    With ``orthologs``, a pair of genes must be known by ids or by symbols: two
    lookups by key, not one join on either.
    """
    v = lambda n: _value(df, n)
    rules = [(F.trim(v(n)) == "", f"missing {n}") for n in REQUIRED]
    rules += [(v(n) != want, f"{n} must be {want}") for n, want in CONSTANTS.items()]
    rules += [(~v("match_level").isin(*ENUMS["match_level"]), "invalid match_level"), (~v("allele_orientation").isin(*ENUMS["allele_orientation"]), "invalid allele_orientation")]
    rules += [(~v("reciprocal_mapping").isin("0", "1"), "reciprocal_mapping must be 0 or 1"), (~v("qc_status").isin(*ENUMS["qc_status"]), "invalid qc_status")]
    rules += [(~v("source_sha256").rlike("^[A-Fa-f0-9]{64}$"), "source_sha256 must be 64 hexadecimal characters")]
    for level, names in LEVEL_COLUMNS.items():
        rules += [((v("match_level") == level) & (F.trim(v(n)) == ""), f"{level} requires {n}") for n in names]
    rules += [((v("match_level") == "genomic_reciprocal_exact") & (v("reciprocal_mapping") != "1"), "genomic_reciprocal_exact requires reciprocal_mapping=1")]
    if orthologs is not None:
        ids = orthologs.where("human_ncbi_gene_id <> '' and mouse_ncbi_gene_id <> ''").select(F.col("human_ncbi_gene_id").alias("_hi"), F.col("mouse_ncbi_gene_id").alias("_mi"), F.lit(True).alias("_by_id")).distinct()
        names = orthologs.select(F.col("human_gene").alias("_hg"), F.col("mouse_gene").alias("_mg"), F.lit(True).alias("_by_name")).distinct()
        df = df.join(ids, (v("human_ncbi_gene_id") == F.col("_hi")) & (v("mouse_ncbi_gene_id") == F.col("_mi")), "left").join(names, (v("human_gene") == F.col("_hg")) & (v("mouse_gene") == F.col("_mg")), "left")
        rules += [(F.col("_by_id").isNull() & F.col("_by_name").isNull(), NOT_ORTHOLOGOUS)]
    out = df.withColumn("errors", F.array_distinct(F.array_compact(F.array(*(F.when(bad, F.lit(msg)) for bad, msg in rules)))))
    return out.drop("_hi", "_mi", "_by_id", "_hg", "_mg", "_by_name")


def contract_errors(df: DataFrame, order: list, orthologs: DataFrame | None = None) -> DataFrame:
    """row_errors, with repeated record keys (second and later rows) as errors too."""
    out = repeats(row_errors(df, orthologs), ["source_dataset", "source_version", "source_record_id"], order)
    more = F.when(F.col("is_repeat"), F.array(F.lit("duplicate source_dataset/source_version/source_record_id"))).otherwise(F.array().cast("array<string>"))
    return out.withColumn("errors", F.concat("errors", more)).drop("is_repeat")


def contract_report(checked: DataFrame) -> DataFrame:
    """Rows, invalid rows, counts by qc_status, and PASS or FAIL (FAIL for an empty table has no reason: PASS)."""
    status = [F.count_if(F.col("qc_status") == s).alias(s) for s in ENUMS["qc_status"]]
    return checked.agg(F.count("*").alias("rows"), F.count_if(F.size("errors") > 0).alias("invalid"), *status).withColumn("status", F.when(F.col("invalid") == 0, "PASS").otherwise("FAIL"))


def file_issues(lines: DataFrame, columns: tuple[str, ...] | list[str] = COLUMNS, orthologs: DataFrame | None = None) -> DataFrame:
    """What is wrong with an exchange file: row (1 for the header), source_record_id, errors.

    ``lines`` are _ord and value, blank ones are skipped. The first line must be ``columns`` exactly; every other
    one must have as many cells and keep the contract, with cells taken by their place.
    """
    some = lines.where(F.trim("value") != "")
    spark, width = lines.sparkSession, len(columns)
    head = some.orderBy("_ord").limit(1)
    found = head.select("value").collect()
    if not found:
        return spark.createDataFrame([(1, "", ["file has no header"])], "row long, source_record_id string, errors array<string>")
    body = some.join(F.broadcast(head.select("_ord")), "_ord", "left_anti")
    # Lines are numbered by range: counts of ranges meet in the driver, one for each partition.
    from linkloom.operators.keys import numbered

    cells = F.split("value", "\t")
    rows = numbered(body, "_ord", "_line").select("_ord", "_line", F.size(cells).alias("_n"), *(F.coalesce(F.get(cells, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)))
    checked = contract_errors(rows, ["_ord"], orthologs)
    many = F.when(F.col("_n") != width, F.array(F.concat(F.lit(f"expected {width} columns; found "), F.col("_n").cast("string")))).otherwise(F.array().cast("array<string>"))
    out = checked.select((F.col("_line") + 1).alias("row"), "source_record_id", F.concat(many, "errors").alias("errors")).where(F.size("errors") > 0)
    if found[0][0].split("\t") != list(columns):
        out = out.unionByName(spark.createDataFrame([(1, "", ["header does not exactly match the Tier 0 template"])], "row long, source_record_id string, errors array<string>"))
    return out


def header_errors(columns: list[str], expected: list[str]) -> list[str]:
    """What is wrong with a header: missing, unexpected or misplaced names."""
    out = [f"missing column {c}" for c in expected if c not in columns] + [f"unexpected column {c}" for c in columns if c not in expected]
    return out or (["columns are out of order"] if columns != expected else [])
