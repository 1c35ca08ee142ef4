"""The whole linkage run over source files: steps in a fixed order, each writing its table below one folder.

``python -m linkloom.workflow (--sources sources.json [--settings FILE] | --config workflow.json) --out DIR [--skip-semantic] [--dry-run]``
"""

from __future__ import annotations

import argparse
import hashlib
import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.operators.keys import first_wins, last_wins, numbered
from linkloom.plans import bridge, catalog, contract, counts, disease, lexical, reports, semantic
from linkloom.settings import DEFAULT, ORTHOLOG_SOURCE, STRICT_ROUTE, UNSCORED_ROUTE, Settings, configured_paths, validate_configuration
from linkloom.sources import readers, writers

#: Source ids that a run needs.
SOURCES = ("variants", "annotations", "mappings", "unscored_mappings", "genotypes", "orthologs", "associations", "alleles", "vocabulary", "disease_models", "nomenclature")
#: Source ids that a run may have: without one, the steps that read it do nothing.
OPTIONAL = ("positive_controls", "negative_controls", "case_narratives", "exchange")
UNSCORED = UNSCORED_ROUTE.sources[0]
CATEGORIES = ("category1-1", "category1-2", "category2-1", "category2-2")
# The control that must be there, what its mouse side must match, and names that results had before.
PRIMARY, PRIMARY_ALLELE, PRIMARY_BACKGROUND = "TLR4_LPS_001", "Lps-d", "C3H/HeJ"
PRIMARY_GENES, PRIMARY_RS = ("TLR4", "Tlr4"), "rs4986790"
PHRASE_AUDIT = ["audit_id", "human_text", "mouse_text", "expected_relation", "cosine_similarity", "cosine_class", "direction_conflict", "negation_flag", "review_status"]
FORMER_NAMES = {"tier1_monarch_phenotype": "links_category1-1", "monarch_upheno_phenotype": "links_category1-2", "tier2_ortholog_phenotype": "links_category2-1", "tier3_disease_model": "links_category2-2"}


def _associations(spark: SparkSession, path: str) -> DataFrame:
    return readers.associations(readers.zip_lines(spark, path) if path.endswith(".zip") else readers.lines(spark, path))


PARSERS: dict[str, Callable[..., DataFrame]] = {
    "variants": readers.vcf,
    "annotations": readers.annotations,
    "mappings": lambda spark, path: readers.sssom(spark, path, "mhmi_mgi"),
    "unscored_mappings": lambda spark, path: readers.sssom(spark, path, UNSCORED),
    "genotypes": readers.genotype_report,
    "orthologs": readers.orthologs,
    "associations": _associations,
    "alleles": readers.allele_metadata,
    "vocabulary": readers.vocabulary,
    "disease_models": readers.disease_models,
    "nomenclature": lambda spark, path: readers.tsv(spark, path).select("_ord", "hgnc_id", "ensembl_gene_id"),
}
#: Sources whose counted lines are more than their rows.
WATCHED = ("variants",)


@dataclass
class Run:
    spark: SparkSession
    paths: dict[str, str]
    out: str
    settings: Settings = DEFAULT
    tables: dict[str, DataFrame] = field(default_factory=dict)
    parsed: dict[str, DataFrame] = field(default_factory=dict)
    scanned: dict[str, int] = field(default_factory=dict)
    statistics: dict[str, dict] = field(default_factory=dict)
    manifest: dict = field(default_factory=dict)
    place: str = ""
    ran: list[str] = field(default_factory=list)
    written: dict[str, str] = field(default_factory=dict)

    def source(self, name: str) -> DataFrame:
        """A source's rows. It is parsed once, written as Parquet, and its rows are counted on the way, in the tasks that write them."""
        if name not in self.parsed:
            seen, inside = Observation(f"{name} {uuid.uuid4().hex}"), name in WATCHED
            watch = lambda df: df.observe(seen, F.count(F.lit(1)).alias("rows"))
            df = PARSERS[name](self.spark, self.paths[name], watch) if inside else watch(PARSERS[name](self.spark, self.paths[name]))
            path = self.folder(f"sources/{name}")
            writers.write_table(df, path)
            self.scanned[name] = seen.get["rows"]
            self.parsed[name] = self.spark.read.schema(df.schema).parquet(path)
        return self.parsed[name]

    def count(self, step: str, rows: DataFrame, **seen: int) -> None:
        """Writes what a step counted, with the settings that it ran with."""
        self.statistics[step] = counts.nested(rows, **seen)
        text = json.dumps({"counts": self.statistics[step], "settings": json.loads(self.settings.to_json())}, indent=2, sort_keys=True)
        writers.write_bytes(self.spark, f"{self.out}/statistics/{step}.json", text.encode())

    def folder(self, name: str) -> str:
        """Where a step's table goes: below a folder named after the step's key, so that no step writes over another run's tables."""
        return f"{self.out}/store/{self.place}/{name}" if self.place else f"{self.out}/{name}"

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Writes a table as Parquet and goes on from the written one."""
        path = self.folder(f"tables/{name}")
        writers.write_table(df, path)
        return self.known(name, self.spark.read.schema(df.schema).parquet(path), path)

    def known(self, name: str, df: DataFrame, path: str) -> DataFrame:
        self.tables[name] = df
        self.written[name] = path
        return df


def prepare_bridge(run: Run) -> None:
    # The unscored source comes first: its labels, dates and justifications are the ones that stay.
    first = run.source("unscored_mappings").withColumn("_ord", F.struct(F.lit(1).alias("file"), "_ord"))
    second = run.source("mappings").withColumn("_ord", F.struct(F.lit(2).alias("file"), "_ord"))
    both = first.unionByName(second)
    order = F.row_number().over(bridge_order())
    merged = run.keep("mappings", bridge.merge_mappings(both.withColumn("_ord", order)))
    writers.write_tsv(merged, f"{run.out}/mappings", order=["hpo_id", "mp_id", "predicate"])
    pairs = run.keep("orthologs", run.source("orthologs"))
    noted = run.keep("disease_annotations", bridge.disease_annotations(run.source("annotations"), merged, run.settings))
    variants, genotypes = run.source("variants"), run.source("genotypes")
    human = run.keep("human_bridge", bridge.variant_phenotypes(variants, None, pairs, merged, run.settings, noted, ordered=True))
    sinks = run.folder("tables/mouse_alleles")
    parts = bridge.allele_sinks(bridge.allele_rows(genotypes, pairs, run.settings), merged, sinks, PRIMARY_GENES[1], PRIMARY_ALLELE, PRIMARY_BACKGROUND)
    run.known("mouse_bridge", parts["main"], f"{sinks}/_sink=main")
    control_mice = parts["control"]
    controls = run.keep("control_human_variants", bridge.control_variants(variants, pairs, PRIMARY_GENES[0], PRIMARY_RS))
    writers.write_tsv(controls, f"{run.out}/control_human_variants")
    writers.write_tsv(control_mice, f"{run.out}/control_mouse_variants")
    seen = {"hpoMp__uphenoRows": run.scanned["unscored_mappings"], "hpoMp__mhmiRows": run.scanned["mappings"], "hpoAnnotations__totalRows": run.scanned["annotations"], "humanVariants__totalVariants": run.scanned["variants"], "humanVariants__tlr4ControlRows": controls.count(), "mousePhenotypes__tlr4ControlRows": control_mice.count()}
    run.count("preparation", counts.bridge_preparation(merged, noted, pairs, genotypes, parts["main"], variants, human, run.settings), **seen)


def bridge_order():
    """An ordinal inside each mapping: first file first, then its lines."""
    from pyspark.sql import Window

    return Window.partitionBy("hpo_id", "mp_id", "predicate").orderBy("_ord")


def map_bridge(run: Run) -> None:
    t = run.tables
    for route in (STRICT_ROUTE, UNSCORED_ROUTE):
        links = run.keep(f"links_{route.subcategory}", bridge.bridge_links(t["human_bridge"], t["mappings"], t["orthologs"], t["mouse_bridge"], route))
        run.count(f"mapping_{route.subcategory}", counts.bridge_mapping(t["human_bridge"], t["mappings"], t["orthologs"], t["mouse_bridge"], links, route))


def prepare_evidence(run: Run) -> None:
    pairs = run.keep("orthologs_enriched", lexical.enrich_orthologs(run.tables["orthologs"], run.source("nomenclature")))
    variants, genotypes, alleles, terms = (run.source(s) for s in ("variants", "genotypes", "alleles", "vocabulary"))
    conditions = lexical.variant_conditions(variants, pairs, run.settings)
    found = lexical.association_evidence(run.source("associations"), pairs, run.settings)
    place = lambda df, n: df.withColumn("_ord", F.struct(F.lit(n).alias("file"), F.col("_ord").cast("struct<at:struct<file:string,line:bigint>,part:int,rs:int>").alias("at")))
    human = run.keep("human_evidence", place(conditions, 1).unionByName(place(found, 2)))
    mouse = run.keep("mouse_evidence", lexical.mouse_evidence(genotypes, pairs, alleles, terms, ordered=True))
    seen = {"clinvar__scanned": run.scanned["variants"], "gwas__scanned": run.scanned["associations"], "mouse__scanned": run.scanned["genotypes"]}
    run.count("evidence", counts.evidence_preparation(human, mouse, pairs, alleles, terms, variants), **seen)


def map_lexical(run: Run) -> None:
    t = run.tables
    links = run.keep("links_category2-1", lexical.lexical_links(t["human_evidence"], t["mouse_evidence"], t["orthologs_enriched"], run.settings))
    run.count("mapping_category2-1", counts.lexical_mapping(t["human_evidence"], t["mouse_evidence"], t["orthologs_enriched"], links, run.settings))


def map_disease(run: Run) -> None:
    t = run.tables
    rows = run.source("disease_models")
    models = run.keep("disease_models", disease.disease_models(rows, t["orthologs_enriched"], run.source("alleles")))
    links = run.keep("links_category2-2", disease.disease_links(t["human_evidence"], models))
    used = t["human_evidence"].where("variant_source = 'ClinVar' and evidence_class = 'clinvar_supported'")
    run.count("mapping_category2-2", counts.disease_mapping(rows, models, t["human_evidence"], links, disease.with_shared_disease(used, models)))


def annotated(rows: DataFrame, prefix: str) -> DataFrame:
    """Evidence with source_row, its place in the order of the sources, and an evidence id made of it."""
    out = numbered(rows, "_ord", "source_row").withColumn("evidence_id", X.ordinal_id(prefix, "source_row"))
    return out.withColumn("source_row", F.col("source_row").cast("int"))


def map_semantic(run: Run, embedder=None, model: str = "", max_length: int = 128) -> None:
    """Annotations, texts and their vectors, and the matches of texts within a gene.

    Without an ``embedder`` a model is fitted to the texts, the first time. Vectors are kept by text and model, so that
    only new texts are embedded. A text of more than ``max_length`` subword pieces counts as truncated.
    """
    t, s = run.tables, run.settings
    pairs = semantic.collapse_orthologs(t["orthologs_enriched"].drop("_ord"))
    genes = run.keep("ortholog", pairs.select(*(F.lit(ORTHOLOG_SOURCE).alias(c) if c == "source" else F.col(c) for c in catalog.columns("ortholog"))))
    human = semantic.usable_annotations(annotated(t["human_evidence"], "HE:"), "phenotype_label", s).join(genes.select("human_gene"), "human_gene", "left_semi")
    human = human.withColumn("curated_input", (F.col("evidence_class") == "literature_curated").cast("int"))
    mouse = semantic.usable_annotations(annotated(t["mouse_evidence"], "ME:"), "phenotype_label", s).join(genes.select("mouse_gene"), "mouse_gene", "left_semi")
    human, mouse = run.keep("human_texts", human), run.keep("mouse_texts", mouse)
    run.keep("human_annotation", human.select(*catalog.columns("human_annotation")))
    run.keep("mouse_annotation", mouse.select(*catalog.columns("mouse_annotation")))
    texts = run.keep("texts", semantic.text_catalog(human=human, mouse=mouse))
    if embedder is None:
        fitted = semantic.fitted_embedder(texts, f"{run.out}/vectors")
        embedder, model = fitted.udf(), fitted.name
    vectors = semantic.kept_vectors(texts, f"{run.out}/vectors", model, max_length, embedder)
    run.tables["vectors"] = vectors
    long = semantic.embedding.piece_count(F.col("label")) > max_length
    run.keep("phenotype_text", texts.select("text_id", "label", long.cast("int").alias("embedding_truncated")))
    side = lambda df: df.select("gene", "text_id").distinct().join(vectors, "text_id").select("gene", F.col("text_id").alias("id"), "embedding")
    left = side(human.withColumnRenamed("human_gene", "gene"))
    right = side(mouse.join(genes.select("human_gene", "mouse_gene"), "mouse_gene").withColumnRenamed("human_gene", "gene"))
    found = semantic.gene_matches(left, right, s)
    flagged = semantic.flagged_matches(found, texts.select("text_id", "label", long.alias("truncated")), s)
    out = run.keep("links_semantic", semantic.published_matches(flagged, genes, model, s.revision))
    writers.write_gzip_tsv(out, f"{run.out}/links_semantic_by_class", ["cosine_class"])
    audits = run.keep("phrase_audit", semantic.phrase_audits(run.spark, embedder, s).select(*PHRASE_AUDIT))
    writers.write_tsv(audits, f"{run.out}/phrase_audit", order=["audit_id"])
    own = lambda df, gene: df.select(F.col(gene).alias("gene"), "text_id")
    both = semantic.gene_texts(own(human, "human_gene"), own(mouse.join(genes.select("human_gene", "mouse_gene"), "mouse_gene"), "human_gene"))
    run.count("mapping_semantic", counts.semantic_mapping(out, both, s))
    catalog.register(run.spark, {"phenotype_match": out.select(*semantic.STORED), **{n: t[n] for n in ("human_annotation", "mouse_annotation", "phenotype_text", "ortholog")}})


def controls_of(run: Run, name: str = "positive_controls") -> DataFrame | None:
    return readers.tsv(run.spark, run.paths[name]).drop("_ord") if name in run.paths else None


def validate(run: Run) -> None:
    """Controls against the categories: what was expected must be found, what must not occur must not. Raises where it is not so."""
    controls = controls_of(run)
    if controls is None:
        return
    t = run.tables
    matrix = None
    for c in CATEGORIES:
        links = t[f"links_{c}"]
        part = reports.inspect_category(links, controls, c, "within_tier_support" if "within_tier_support" in links.columns else None)
        matrix = part if matrix is None else matrix.unionByName(part)
    matrix = run.keep("tier_validation", reports.expectation_matrix(controls, matrix))
    writers.write_tsv(matrix, f"{run.out}/category_validation_results", order=["control_id", "category_id"])
    primary = controls.where(F.col("control_id") == PRIMARY)
    if primary.isEmpty():
        raise ValueError(f"the control {PRIMARY} is required")
    variants = run.source("variants").select(X.gene_list(F.coalesce(X.info_value("info", "GENEINFO"), F.lit(""))).alias("genes"), X.rs_numbers(F.coalesce(X.info_value("info", "RS"), F.lit(""))).alias("rs"))
    human = variants.select(F.explode("genes").alias("gene"), "rs").select(F.col("gene.symbol").alias("human_gene"), F.explode("rs").alias("rs_id"))
    human = human.join(primary.select("human_gene", F.col("human_variant").alias("rs_id")), ["human_gene", "rs_id"], "left_semi")
    pairs = t["orthologs"]
    mouse = run.source("genotypes").where(X.single_marker("marker_ids")).withColumn("mgi_marker_id", F.element_at(X.pipe_list("marker_ids"), 1))
    mouse = mouse.join(last_wins(pairs, ["mgi_marker_id"], ["_ord"]).select("mgi_marker_id", "mouse_gene"), "mgi_marker_id").join(primary.select("mouse_gene"), "mouse_gene", "left_semi")
    positive = run.keep("positive_control", reports.positive_control(primary, human, mouse, pairs, PRIMARY_ALLELE, PRIMARY_BACKGROUND))
    negative = controls_of(run, "negative_controls")
    if negative is not None:
        both = primary.select("human_gene", "human_protein_change", "mouse_protein_change").first()
        strangers = [r["mouse_gene"] for r in negative.where("expected_rejection_reason = 'non_orthologous_gene'").select("mouse_gene").distinct().collect()]  # controls are a short list
        invalid = sum(reports.forbidden_pairs(t[f"links_{c}"], both["human_gene"], g).first()["invalid_rows"] for c in CATEGORIES for g in strangers)
        refused = run.keep("negative_controls", reports.negative_controls(negative, invalid, both["human_protein_change"], both["mouse_protein_change"]))
        reports.require(refused, "control_id", F.col("status") == "PASS")
    reports.require(positive, "control_id", F.col("status") == "PASS")
    reports.require(matrix, "control_id", F.col("status") == "PASS")


def verify_semantic(run: Run) -> None:
    """The semantic result against its rules, its export, its vectors and the controls; a broken one raises."""
    spark, t, s = run.spark, run.tables, run.settings
    found = t["links_semantic"]
    by_ids = found.select(F.col("human_gene").alias("gene"), F.col("human_text_id").alias("left_id"), F.col("mouse_text_id").alias("right_id"), F.col("cosine_similarity").alias("score"), "match_id", "cosine_class", "retrieval_rank", "direction_conflict", "review_status", "eligible_for_default_use")
    human = t["human_annotation"].withColumnRenamed("human_gene", "gene")
    genes = t["ortholog"].select("human_gene", "mouse_gene")
    mouse = t["mouse_annotation"].join(genes, "mouse_gene").withColumnRenamed("human_gene", "gene")
    checks = run.keep("semantic_audits", reports.semantic_audits(by_ids, human, mouse, t["phenotype_text"], genes, s).unionByName(catalog.constraint_audits(spark)))
    reports.require(checks, "audit", F.col("violations") == 0)
    exported = spark.read.csv(f"{run.out}/links_semantic_by_class", sep="\t", header=True, quote="")
    reports.require(reports.export_counts(found, exported, "cosine_class"), "cosine_class", F.col("agrees"))
    reports.require(semantic.norm_audit(t["vectors"]), "vectors", (F.col("vectors") == 0) | (F.col("largest_error") < 1e-5))
    reports.require(semantic.rescored(by_ids, t["vectors"]), "match_id", F.col("difference") < 1e-5)
    side = lambda df: df.select("gene", "text_id").distinct().join(t["vectors"], "text_id").select("gene", F.col("text_id").alias("id"), "embedding")
    k = ["gene", "left_id", "right_id"]
    # Other tiles than the result's, so that one that went wrong is seen.
    above = semantic.pairs_from(side(human), side(mouse), s.band_b, semantic.ROWS // 3).select(*k)
    kept = by_ids.where(F.col("cosine_class").isin("A", "B")).select(*k)
    reports.require(reports.symmetric_difference(above, kept), "missing", (F.col("missing") == 0) & (F.col("extra") == 0))
    controls = controls_of(run)
    if controls is not None:
        recovery = run.keep("controls_summary", reports.semantic_recovery(controls, spark.table("variant_correspondence")))
        writers.write_tsv(recovery, f"{run.out}/controls_summary", order=["control_id"])
        reports.require(recovery, "control_id", F.col("semantic_expectation_status") == "PASS")


def report_cases(run: Run) -> None:
    """A line for each control over all routes, with the link that stands for it."""
    controls, narratives = controls_of(run), controls_of(run, "case_narratives")
    if controls is None or narratives is None or "controls_summary" not in run.tables:
        return
    t = run.tables
    shown = {c: reports.first_links(t[f"links_{c}"], controls, sorted(t[f"links_{c}"].columns)) for c in CATEGORIES}
    labels = run.spark.table("phenotype_text")
    label = lambda side: labels.select(F.col("text_id").alias(f"{side}_text_id"), F.col("label").alias(f"{side}_phenotype_label"))
    pairs = run.spark.table("variant_correspondence").join(label("human"), "human_text_id").join(label("mouse"), "mouse_text_id")
    for b in "ABC":
        shown[f"semantic_{b}"] = first_wins(reports.control_hits(pairs.where(F.col("cosine_class") == b), controls), ["control_id"], [F.desc("cosine_similarity"), "match_id", "human_evidence_id", "mouse_evidence_id"])
    cases = run.keep("case_studies", reports.case_studies(controls, t["tier_validation"], t["controls_summary"], narratives, shown))
    writers.write_tsv(cases, f"{run.out}/case_study_summary", order=["control_id"])


def check_exchange(run: Run) -> None:
    """The exchange file against its contract, if there is one; its faults are written, then raise."""
    if "exchange" not in run.paths:
        return
    faults = run.keep("exchange_faults", contract.file_issues(readers.lines(run.spark, run.paths["exchange"]), contract.COLUMNS, run.tables["orthologs"]))
    reports.require(faults, "row", F.lit(False))


def report(run: Run) -> None:
    """Each link table as compressed TSV, the row counts of all, and views of the names that results had before."""
    for former, name in FORMER_NAMES.items():
        run.tables[name].createOrReplaceTempView(former)
    counts = {}
    for name, df in run.tables.items():
        if name.startswith("links_"):
            writers.write_gzip_tsv(df, f"{run.out}/{name}")
            counts[name] = df.count()
    rows = run.spark.createDataFrame(sorted(counts.items()), "category_id string, rows long")
    writers.write_tsv(rows.coalesce(1), f"{run.out}/category_catalog")


def record_sources(run: Run) -> None:
    """Path, size and digest of every source file, and whether it changed since the run before into the same folder."""
    kept = f"{run.out}/source_manifest"
    earlier = run.spark.read.parquet(kept) if not readers.missing_inputs(run.spark, [f"{kept}/_SUCCESS"]) else None
    every = None
    for name in sorted(run.paths):
        part = writers.file_manifest(run.spark, run.paths[name]).select(F.lit(name).alias("name"), "path", "bytes", "sha256")
        every = part if every is None else every.unionByName(part)
    every = every.withColumn("id", F.concat_ws(" ", "name", "path"))
    old = run.spark.createDataFrame([], "id string, sha256 string") if earlier is None else earlier.select("id", "sha256")
    rows = every.join(readers.manifest_changes(every.select("id", "sha256"), old).select("id", "change"), "id", "left")
    # Written beside the earlier one first, which is read until then.
    writers.write_table(rows, f"{kept}.new")
    rows = run.spark.read.parquet(f"{kept}.new")
    writers.write_table(rows, kept)
    run.tables["source_manifest"] = rows
    writers.write_tsv(rows.drop("id"), f"{run.out}/sources_manifest", order=["name", "path"])
    writers.write_bytes(run.spark, f"{run.out}/DATA_VERSIONS.md", writers.version_table(rows).encode())


def store_pairs(run: Run) -> None:
    """The integrated model: every pair of a variant and an allele once with its routes, and a row for each piece of evidence."""
    keys = ["human_gene", "rs_id", "mouse_gene", "mgi_allele_id"]
    pairs, evidence = reports.pair_evidence(keys, **{c: run.tables[f"links_{c}"] for c in CATEGORIES})
    run.keep("variant_pairs", pairs)
    run.keep("pair_evidence", evidence)


def record_outputs(run: Run) -> None:
    """Path, size and digest of every file that the run has written."""
    found = writers.file_manifest(run.spark, run.out).where(~F.contains("path", F.lit("/output_manifest/")))
    writers.write_tsv(found, f"{run.out}/output_manifest", order=["path"])


STEPS: list[tuple[str, Callable[[Run], None]]] = [
    ("record_sources", record_sources),
    ("prepare_bridge", prepare_bridge),
    ("map_bridge", map_bridge),
    ("prepare_evidence", prepare_evidence),
    ("map_lexical", map_lexical),
    ("map_disease", map_disease),
    ("store_pairs", store_pairs),
    ("report", report),
    ("validate", validate),
    ("map_semantic", map_semantic),
    ("verify_semantic", verify_semantic),
    ("report_cases", report_cases),
    ("check_exchange", check_exchange),
    ("record_outputs", record_outputs),
]
SEMANTIC = ("map_semantic", "verify_semantic", "report_cases")


#: What a step reads: sources, and steps before it. A step that is not here runs every time: it checks, records or exports.
NEEDS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "prepare_bridge": (("unscored_mappings", "mappings", "orthologs", "annotations", "variants", "genotypes"), ()),
    "map_bridge": ((), ("prepare_bridge",)),
    "prepare_evidence": (("nomenclature", "variants", "genotypes", "alleles", "vocabulary", "associations"), ("prepare_bridge",)),
    "map_lexical": ((), ("prepare_evidence",)),
    "map_disease": (("disease_models", "alleles"), ("prepare_evidence",)),
    "store_pairs": ((), ("map_bridge", "map_lexical", "map_disease")),
}


def code_digest() -> str:
    """A digest of the library's own files, without the training-data operators."""
    root, found = os.path.dirname(os.path.abspath(__file__)), hashlib.sha256()
    for folder, names, files in sorted(os.walk(root)):
        names[:] = sorted(n for n in names if n not in ("llm", "__pycache__"))
        for name in sorted(f for f in files if f.endswith(".py")):
            with open(f"{folder}/{name}", "rb") as f:
                found.update(f"{os.path.relpath(folder, root)}/{name}".encode() + f.read())
    return found.hexdigest()


def step_key(run: Run, name: str, digests: dict[str, str], keys: dict[str, str], code: str) -> str:
    """A digest of what a step's tables depend on: its sources' digests, the keys of the steps before it, the settings and the code."""
    sources, before = NEEDS[name]
    given = [name, code, run.settings.to_json(), *(f"{s}={digests[s]}" for s in sources), *(f"{s}={keys[s]}" for s in before)]
    return hashlib.sha256("\n".join(given).encode()).hexdigest()[:24]


def source_digests(run: Run) -> dict[str, str]:
    """A digest of all files of each source, from the manifest of sources."""
    rows = run.tables["source_manifest"].groupBy("name").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "path", "sha256"))), "|"), 256).alias("digest"))
    return {r["name"]: r["digest"] for r in rows.collect()}


def resume(run: Run, name: str, key: str) -> bool:
    """Takes over a step's tables and counts from the last finished run, if it made them under the same key and they are all there."""
    made = run.manifest.get("steps", {}).get(name, {})
    if made.get("key") != key or readers.missing_inputs(run.spark, [*made["tables"].values(), *made["sources"].values()]):
        return False
    for table, path in made["tables"].items():
        run.known(table, run.spark.read.parquet(path), path)
    for source, path in made["sources"].items():
        run.parsed[source] = run.spark.read.parquet(path)
        run.scanned[source] = made["scanned"][source]
    run.statistics |= made["statistics"]
    return True


def steps(skip_semantic: bool = False) -> list[tuple[str, Callable[[Run], None]]]:
    return [s for s in STEPS if not (skip_semantic and s[0] in SEMANTIC)]


def execute(spark: SparkSession, paths: dict[str, str], out: str, settings: Settings = DEFAULT, skip_semantic: bool = False) -> Run:
    """Runs all steps. Sources that are not declared, or not there, raise before the first one."""
    if missing := [s for s in SOURCES if s not in paths]:
        raise ValueError(f"sources not declared: {missing}")
    if absent := readers.missing_inputs(spark, [paths[s] for s in (*SOURCES, *OPTIONAL) if s in paths]):
        raise FileNotFoundError(f"sources not found: {absent}")
    run = Run(spark, paths, out, settings)
    record = f"{out}/run_manifest.json"
    run.manifest = readers.read_json(record, {}, spark)
    keys: dict[str, str] = {}
    made: dict[str, dict] = {}
    for name, step in steps(skip_semantic):
        if name not in NEEDS:
            run.place = ""
            step(run)
            run.ran.append(name)
            if name == "record_sources":
                digests, code = source_digests(run), code_digest()
            continue
        keys[name] = step_key(run, name, digests, keys, code)
        run.place = f"{name}-{keys[name]}"
        before = (set(run.written), set(run.parsed), set(run.statistics))
        if not resume(run, name, keys[name]):
            step(run)
            run.ran.append(name)
            stored = {s: f"{out}/store/{run.place}/sources/{s}" for s in set(run.parsed) - before[1]}
        else:
            stored = run.manifest["steps"][name]["sources"]
        made[name] = {
            "key": keys[name],
            "tables": {t: p for t, p in run.written.items() if t not in before[0] or f"/store/{run.place}/" in p},
            "sources": stored,
            "scanned": {s: run.scanned[s] for s in stored},
            "statistics": {s: run.statistics[s] for s in set(run.statistics) - before[2]},
        }
    # One rename publishes the run: until then the last one's manifest and tables stand.
    writers.write_bytes(spark, record, json.dumps({"steps": made, "ran": run.ran}, indent=2, sort_keys=True).encode())
    return run


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="linkloom", description="Link two catalogues by several kinds of evidence.")
    given = parser.add_mutually_exclusive_group(required=True)
    given.add_argument("--sources", help="JSON object of source id and path")
    given.add_argument("--config", help="a run's configuration: sources, thresholds, and whether the semantic steps run")
    parser.add_argument("--out", required=True)
    parser.add_argument("--settings")
    parser.add_argument("--skip-semantic", action="store_true")
    parser.add_argument("--dry-run", action="store_true")
    a = parser.parse_args(arguments)
    if a.dry_run:
        print("\n".join(name for name, _ in steps(a.skip_semantic)))
        return
    settings, skip = DEFAULT, a.skip_semantic
    found = readers.read_json(a.config or a.sources)
    if found is None:
        raise FileNotFoundError(a.config or a.sources)
    if a.config:
        paths = configured_paths(validate_configuration(found), os.path.dirname(os.path.dirname(os.path.abspath(a.config))))
        settings = Settings.from_configuration(found)
        execution = found["execution"]
        skip = skip or not execution.get("run_semantic", True)
        if execution.get("tier0_input"):
            paths["exchange"] = execution["tier0_input"]
    else:
        paths = found
    if a.settings:
        with open(a.settings) as f:
            settings = Settings.from_json(f.read())
    spark = SparkSession.builder.appName("linkloom").getOrCreate()
    run = execute(spark, paths, a.out, settings, skip)
    print(json.dumps({n: df.count() for n, df in run.tables.items() if n.startswith("links_")}))


if __name__ == "__main__":
    main()
