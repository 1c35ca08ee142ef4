"""Controls, audits, catalogues and the integrated pair model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.operators.keys import first_wins
from linkloom.plans import audits


def matches_control(df: DataFrame) -> Column:
    """Rows of ``df`` joined to controls: gene, variant, other gene, and the allele among the row's alleles."""
    return (F.col("human_gene") == F.col("c_human_gene")) & (F.col("rs_id") == F.col("c_variant")) & (F.col("mouse_gene") == F.col("c_mouse_gene")) & X.in_pipe_list("mgi_allele_id", F.col("c_allele"))


def _controls(controls: DataFrame) -> DataFrame:
    return controls.select("control_id", F.col("human_gene").alias("c_human_gene"), F.col("human_variant").alias("c_variant"), F.col("mouse_gene").alias("c_mouse_gene"), F.col("mouse_allele_id").alias("c_allele"))


def control_hits(links: DataFrame, controls: DataFrame) -> DataFrame:
    """Links of each control. Genes and variant are equi keys; membership of the allele is a residual filter."""
    c = _controls(controls)
    return links.join(c, (links.human_gene == c.c_human_gene) & (links.rs_id == c.c_variant) & (links.mouse_gene == c.c_mouse_gene)).where(X.in_pipe_list("mgi_allele_id", F.col("c_allele"))).drop("c_human_gene", "c_variant", "c_mouse_gene", "c_allele")


def inspect_category(links: DataFrame, controls: DataFrame, category: str, support: str | None = None) -> DataFrame:
    """found_rows and sorted supports of every control in one category."""
    hits = control_hits(links, controls).groupBy("control_id").agg(F.count("*").alias("found_rows"), (F.array_join(F.array_sort(F.collect_set(support)), "|") if support else F.lit("")).alias("within_tier_support"))
    out = controls.select("control_id").join(hits, "control_id", "left")
    return out.select("control_id", F.lit(category).alias("category_id"), F.coalesce("found_rows", F.lit(0)).alias("found_rows"), F.coalesce("within_tier_support", F.lit("")).alias("within_tier_support"))


def expectation_matrix(controls: DataFrame, inspections: DataFrame) -> DataFrame:
    """Expected and found for each control and category, PASS or FAIL, and what it means."""
    want = F.array_contains(X.pipe_list("expected_categories"), F.col("category_id"))
    found = F.col("found_rows") > 0
    # What the matrix says of each case.
    text = F.when(want & found, "Expected positive control recovered.").when(want, "Expected positive control was not recovered.").when(found, "Additional cross-tier recovery; retained for review.").otherwise("No recovery expected for this basis.")
    out = inspections.join(controls.select("control_id", "expected_categories"), "control_id")
    return out.select("control_id", "category_id", F.when(want, "found").otherwise("not_required").alias("expected"), "found_rows", "within_tier_support", F.when(want & ~found, "FAIL").otherwise("PASS").alias("status"), text.alias("interpretation"))


def positive_control(controls: DataFrame, human: DataFrame, mouse: DataFrame, orthologs: DataFrame, allele_pattern: str, background_pattern: str) -> DataFrame:
    """Whether each part of a control exists in the data, and that the two substitutions differ."""
    h = human.select(F.col("human_gene"), F.col("rs_id").alias("human_variant"), F.lit(True).alias("human_found")).distinct()
    o = orthologs.select("human_gene", "mouse_gene", F.lit(True).alias("ortholog_found")).distinct()
    m = mouse.where(F.col("mouse_allele").rlike(allele_pattern) & F.col("genetic_background").rlike(background_pattern)).select("mouse_gene", F.explode(X.pipe_list("mgi_allele_id")).alias("mouse_allele_id"), F.lit(True).alias("mouse_found")).distinct()
    out = controls.join(h, ["human_gene", "human_variant"], "left").join(o, ["human_gene", "mouse_gene"], "left").join(m, ["mouse_gene", "mouse_allele_id"], "left").na.fill(False, ["human_found", "ortholog_found", "mouse_found"])
    out = out.withColumn("distinct_substitutions", F.col("human_protein_change") != F.col("mouse_protein_change"))
    ok = F.col("human_found") & F.col("ortholog_found") & F.col("mouse_found") & F.col("distinct_substitutions")
    return out.select("control_id", "human_found", "ortholog_found", "mouse_found", "distinct_substitutions", F.when(ok, "PASS").otherwise("FAIL").alias("status"))


# Columns of the published summary of controls.
RECOVERY = ["control_id", "human_gene", "rs_id", "mgi_allele_id", "class_A_rows", "class_B_rows", "class_C_rows", "class_D_archive_rows", "best_active_cosine", "active_curated_input_rows", "active_direction_conflict_rows", "expected_semantic_class", "expected_class_noncurated_rows", "semantic_expectation_status"]


def semantic_recovery(controls: DataFrame, correspondence: DataFrame) -> DataFrame:
    """Correspondences of each control by band, the best one in use, and FAIL where an expected band has none that was not put in by hand.

    Controls are equi keys by gene and variant; the allele is a residual filter. Controls without rows have zeros.
    """
    c = controls.select("control_id", F.col("human_gene").alias("c_gene"), F.col("human_variant").alias("c_variant"), F.col("mouse_allele_id").alias("c_allele"), F.coalesce("expected_semantic_class", F.lit("")).alias("c_expected"))
    v = correspondence
    hits = v.join(c, (v.human_gene == F.col("c_gene")) & (v.rs_id == F.col("c_variant"))).where(X.in_pipe_list("mgi_allele_id", F.col("c_allele")))
    active, band = F.col("eligible_for_default_use") == 1, F.col("cosine_class")
    counts = hits.groupBy("control_id").agg(
        *(F.count_if(band == b).alias(f"class_{b}{'_archive' if b == 'D' else ''}_rows") for b in "ABCD"),
        F.max(F.when(active, F.col("cosine_similarity"))).alias("best_active_cosine"),
        F.count_if(active & (F.col("curated_input") == 1)).alias("active_curated_input_rows"),
        F.count_if(active & (F.col("direction_conflict") == 1)).alias("active_direction_conflict_rows"),
        F.count_if(active & (F.coalesce("curated_input", F.lit(0)) == 0) & (band == F.col("c_expected"))).alias("expected_class_noncurated_rows"),
    )
    out = controls.select("control_id", "human_gene", F.col("human_variant").alias("rs_id"), F.col("mouse_allele_id").alias("mgi_allele_id"), F.coalesce("expected_semantic_class", F.lit("")).alias("expected_semantic_class")).join(counts, "control_id", "left")
    out = out.na.fill(0, [n for n in RECOVERY if n.endswith("_rows")])
    failed = (F.col("expected_semantic_class") != "") & (F.col("expected_class_noncurated_rows") == 0)
    return out.withColumn("semantic_expectation_status", F.when(failed, "FAIL").otherwise("PASS")).select(*RECOVERY)


def case_studies(controls: DataFrame, matrix: DataFrame, recovery: DataFrame, narratives: DataFrame, representatives: dict[str, DataFrame]) -> DataFrame:
    """One line a control: FOUND if every route it is expected in has rows, the rows of each route, and what stands for it.

    ``narratives`` (control_id, representative_route, interpretation, limitation) say which route's evidence is shown;
    ``representatives`` are links of each route, one a control. A control without a narrative raises.
    """
    categories = list(SHOWN)
    wide = matrix.groupBy("control_id").pivot("category_id", categories).agg(F.first("found_rows"))
    out = controls.join(narratives.select("control_id", "representative_route", "interpretation", "limitation"), "control_id", "left")
    require(out, "control_id", F.col("representative_route").isNotNull())
    expected = F.coalesce("expected_semantic_class", F.lit(""))
    out = out.withColumn("_routes", primary_routes(F.coalesce("expected_categories", F.lit("")), expected)).drop("expected_semantic_class")
    bands = ["class_A_rows", "class_B_rows", "class_C_rows", "class_D_archive_rows"]
    out = out.join(wide, "control_id", "left").join(recovery.select("control_id", *bands, "best_active_cosine"), "control_id", "left").na.fill(0, [*categories, *bands])
    rows = {**{c: F.col(f"`{c}`") for c in categories}, **{f"semantic_{b}": F.col(f"class_{b}_rows") for b in "ABC"}}
    table = F.create_map(*(x for k, v in rows.items() for x in (F.lit(k), v)))
    found = F.forall("_routes", lambda r: F.coalesce(F.try_element_at(table, r), F.lit(0)) > 0)
    shown = None
    for route, links in representatives.items():
        part = representative_evidence(links, route)
        shown = part if shown is None else shown.unionByName(part)
    if shown is None:
        shown = controls.sparkSession.createDataFrame([], "control_id string, route_id string, human string, mouse string, detail string")
    out = out.join(shown.withColumnRenamed("route_id", "representative_route"), ["control_id", "representative_route"], "left").na.fill("", ["human", "mouse", "detail"])
    return out.select(
        "control_id", "human_gene", "human_variant", "human_protein_change", "mouse_gene", "mouse_allele_id", "mouse_allele", "mouse_protein_change", F.when(found, "FOUND").otherwise("NOT_FOUND").alias("case_study_status"), F.array_join("_routes", "|").alias("primary_connection_routes"),
        *(F.col(f"`{c}`").alias(f"{c.replace('-', '_')}_evidence_rows") for c in categories), *(F.col(f"class_{b}_rows").alias(f"semantic_class_{b}_evidence_rows") for b in "ABC"), F.col("class_D_archive_rows").alias("semantic_class_D_archive_rows"), "best_active_cosine",
        "representative_route", F.col("human").alias("representative_human_phenotype"), F.col("mouse").alias("representative_mouse_phenotype"), F.col("detail").alias("representative_evidence_detail"), "interpretation", "limitation",
    )


def forbidden_pairs(links: DataFrame, human_gene: str, mouse_gene: str) -> DataFrame:
    """Rows of a gene pair that must not occur."""
    return links.agg(F.count_if((F.col("human_gene") == human_gene) & (F.col("mouse_gene") == mouse_gene)).alias("invalid_rows"))


def negative_controls(controls: DataFrame, invalid_rows: int, human_change: str, mouse_change: str) -> DataFrame:
    reason = F.col("expected_rejection_reason")
    rejected = F.when(reason == "non_orthologous_gene", F.lit(invalid_rows == 0)).when(reason == "different_residue_and_substitution", F.lit(human_change != mouse_change)).otherwise(False)
    return controls.withColumn("status", F.when(rejected, "PASS").otherwise("FAIL"))


def first_links(links: DataFrame, controls: DataFrame, order: list) -> DataFrame:
    """The first link of each control."""
    return first_wins(control_hits(links, controls), ["control_id"], order)


def primary_routes(control_columns: Column, semantic: Column) -> Column:
    """The routes that a control is expected in: its categories, and semantic_<band> if it names a band."""
    return F.concat(X.pipe_list(control_columns), F.when(F.coalesce(semantic, F.lit("")) != "", F.array(F.concat(F.lit("semantic_"), semantic))).otherwise(F.array().cast("array<string>")))


#: What stands for the evidence of a link by its route: columns of the human side and the mouse side (the first that has a
#: text), and of the detail (those that have one, joined).
SHOWN = {
    "category1-1": (("hpo_label",), ("mp_label",), ("hpo_id", "predicate", "mp_id")),
    "category1-2": (("hpo_label",), ("mp_label",), ("hpo_id", "predicate", "mp_id")),
    "category2-1": (("human_phenotype_label",), ("mouse_phenotype_label", "allele_name"), ("match_method", "within_tier_support")),
    "category2-2": (("human_condition_label",), ("mouse_allele_name",), ("shared_disease_id",)),
}


def representative_evidence(links: DataFrame, route: str) -> DataFrame:
    """control_id, route_id and the human text, mouse text and detail of one link a control, by the columns of its route; ''
    for what it lacks. Routes other than the categories are semantic and show the cosine."""
    has = lambda names: [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in links.columns]
    first = lambda names: F.coalesce(*has(names), F.lit(""))
    human, mouse, detail = SHOWN.get(route, (("human_phenotype_label",), ("mouse_phenotype_label",), ()))
    shown = F.array_join(F.array_compact(F.array(*has(detail))), " / ") if detail else F.lit("")
    if route not in SHOWN and "cosine_similarity" in links.columns:
        shown = F.coalesce(F.concat(F.lit("cosine "), X.fixed3("cosine_similarity")), F.lit(""))
    return links.select("control_id", F.lit(route).alias("route_id"), first(human).alias("human"), first(mouse).alias("mouse"), shown.alias("detail"))


def export_counts(stored: DataFrame, exported: DataFrame, by: str) -> DataFrame:
    """Rows of each value of ``by`` in a stored table and in its export, and whether they agree."""
    one = lambda df, name: df.groupBy(F.col(by).cast("string").alias(by)).agg(F.count("*").alias(name))
    out = one(stored, "stored").join(one(exported, "exported"), by, "full_outer").na.fill(0, ["stored", "exported"])
    return out.withColumn("agrees", F.col("stored") == F.col("exported"))


def require(checks: DataFrame, name: str, ok: Column) -> None:
    """Raises if a row of ``checks`` breaks the rule; names of at most 20 such rows come to the driver for the message."""
    bad = [r[0] for r in checks.where(~F.coalesce(ok, F.lit(False))).select(F.col(name).cast("string")).limit(20).collect()]
    if bad:
        raise ValueError(f"failed: {sorted(bad)}")


def case_summary(controls: DataFrame, matrix: DataFrame, categories: list[str], semantic: DataFrame | None = None) -> DataFrame:
    """One line for each control: found rows by category, and FOUND if every expected route has some."""
    wide = matrix.groupBy("control_id").pivot("category_id", categories).agg(F.first("found_rows"))
    out = controls.select("control_id", "expected_categories").join(wide, "control_id", "left").na.fill(0, categories)
    if semantic is not None:
        out = out.join(semantic, "control_id", "left")
    table = F.create_map(*(x for c in categories for x in (F.lit(c), F.col(f"`{c}`"))))
    recovered = F.forall(X.pipe_list("expected_categories"), lambda c: F.coalesce(F.try_element_at(table, c), F.lit(0)) > 0)
    return out.withColumn("recovery_status", F.when(recovered, "FOUND").otherwise("NOT_FOUND"))


def category_catalog(spark: SparkSession, **links: DataFrame) -> DataFrame:
    """Row counts of several tables, and the bar length of each: log10(n + 1) over the largest."""
    out = None
    for name, df in links.items():
        part = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("category_id"), "rows")
        out = part if out is None else out.unionByName(part)
    # One line for each table: the global maximum is over a handful of rows.
    most = out.agg(F.max(F.log10(F.col("rows") + 1)).alias("most"))
    return out.crossJoin(F.broadcast(most)).select("category_id", "rows", F.when(F.col("most") == 0, 0.0).otherwise(F.log10(F.col("rows") + 1) / F.col("most")).alias("bar"))


def semantic_audits(found: DataFrame, human: DataFrame, mouse: DataFrame, texts: DataFrame, orthologs: DataFrame, settings) -> DataFrame:
    """Invariants of the semantic result, all in one shuffle: each count must be 0."""
    s, band = F.col("score"), F.col("cosine_class")
    limits = {"A": s < settings.band_a, "B": (s < settings.band_b) | (s >= settings.band_a), "C": (s < settings.band_c) | (s >= settings.band_b), "D": s >= settings.band_c}
    rows = [audits.never(f"band_{b}", (band == b) & bad) for b, bad in limits.items()]
    rows += [
        audits.never("rank_beyond_k", (F.col("retrieval_rank") > settings.top_k) & (s < settings.band_b)),
        audits.never("flag_differs", (F.col("direction_conflict") == 1) != (F.col("review_status") == "direction_conflict")),
        audits.never("eligibility_differs", (F.col("eligible_for_default_use") == 1) != band.isin(*settings.default_bands)),
        audits.refers("unknown_gene", "gene"),
        audits.refers("unknown_left_text", "left_id"),
        audits.refers("unknown_right_text", "right_id"),
        audits.refers("no_human_annotation", "gene", "left_id"),
        audits.refers("no_mouse_annotation", "gene", "right_id"),
        audits.once("repeated_match", "match_id"),
    ]
    curated = F.col("evidence_class") == "literature_curated" if "evidence_class" in human.columns else F.lit(False)
    return audits.violations(
        found.sparkSession,
        (found, rows),
        (orthologs, [audits.known("unknown_gene", "human_gene")]),
        (texts, [audits.known("unknown_left_text", "text_id"), audits.known("unknown_right_text", "text_id")]),
        (human, [audits.known("no_human_annotation", "gene", "text_id"), audits.never("hand_curated_rows", curated)]),
        (mouse, [audits.known("no_mouse_annotation", "gene", "text_id")]),
    )


#: Buckets that two sides are compared by first.
BUCKETS = 4096


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """The buckets (of a row's hash, at most ``BUCKETS``) in which two sides with equal columns have other rows, by their number and the sums of two hashes."""
    hashes = [F.xxhash64(*left.columns), F.xxhash64(F.lit("again"), *left.columns)]
    sums = lambda df, sign: df.select(*(h.alias(n) for h, n in zip(hashes, ("h", "g")))).groupBy(F.pmod("h", F.lit(BUCKETS)).cast("int").alias("bucket")).agg(*(F.sum(F.col(c).cast("decimal(38,0)") * sign).alias(c) for c in ("h", "g")), F.sum(F.lit(sign)).alias("n"))
    both = sums(left, 1).unionByName(sums(right, -1)).groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("h", "g", "n")))
    return both.where("h <> 0 or g <> 0 or n <> 0").select("bucket")


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """How many rows of the left side are missing on the right, and extra there; repeated rows count.

    Sums of hashes by bucket are compared first, and rows are exchanged for the buckets that differ only: two equal sides
    exchange no row. Other rows with equal sums of two 64-bit hashes would not be seen.
    """
    right = right.select(*left.columns)
    some = F.broadcast(differing(left, right))  # at most BUCKETS lines
    in_them = lambda df: df.withColumn("bucket", F.pmod(F.xxhash64(*left.columns), F.lit(BUCKETS)).cast("int")).join(some, "bucket", "left_semi").drop("bucket")
    count = in_them(left).withColumn("_n", F.lit(1)).unionByName(in_them(right).withColumn("_n", F.lit(-1))).groupBy(*left.columns).agg(F.sum("_n").alias("_n"))
    zero = F.lit(0).cast("long")
    return count.agg(F.coalesce(F.sum(F.greatest(F.col("_n"), zero)), zero).alias("missing"), F.coalesce(F.sum(F.greatest(-F.col("_n"), zero)), zero).alias("extra"))


def pair_evidence(keys: list[str], **routes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, evidence): each pair once with its sorted routes and evidence count; every evidence row with its route."""
    rows = None
    for route, df in routes.items():
        part = df.select(*keys, F.lit(route).alias("route"))
        rows = part if rows is None else rows.unionByName(part)
    pair_id = X.content_id("VP:", *keys)
    rows = rows.withColumn("pair_id", pair_id)
    pairs = rows.groupBy("pair_id", *keys).agg(F.array_join(F.array_sort(F.collect_set("route")), "|").alias("routes"), F.count("*").alias("evidence_rows"))
    return pairs, rows
