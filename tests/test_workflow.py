"""The whole run over small source files, against known answers."""

import zipfile
from dataclasses import replace

import numpy as np
import pytest

from linkloom import workflow
from linkloom.functions import text as X
from linkloom.plans import contract, semantic
from linkloom.settings import DEFAULT, PHRASE_AUDITS, Settings, configured_paths, validate_configuration
from linkloom.sources import readers


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    d = tmp_path_factory.mktemp("sources")
    files = {
        "variants": "##x\n#CHROM\tPOS\n9\t100\t77\tA\tG\t.\t.\tRS=4986790;GENEINFO=TLR4:7099;CLNDISDB=MedGen:C1|OMIM:5;CLNDN=Reduced_LPS_response;CLNSIG=Pathogenic;CLNREVSTAT=r\n",
        "annotations": "#database_id\tdisease_name\tqualifier\thpo_id\treference\tevidence\tonset\tfrequency\tsex\tmodifier\taspect\tbiocuration\nOMIM:5\td\t\tHP:1\tr\te\t\t\t\t\tP\tb\nOMIM:5\td\t\tHP:2\tr\te\t\t\t\t\tP\tb\n",
        "mappings": "subject_id\tsubject_label\tpredicate_id\tobject_id\tobject_label\tconfidence\nMP:1\tm\tskos:exactMatch\tHP:1\th\t0.9\n",
        "unscored_mappings": "subject_id\tsubject_label\tpredicate_id\tobject_id\tobject_label\nHP:2\th\tsemapv:crossSpeciesExactMatch\tMP:2\tm\n",
        "genotypes": "c\tTlr4<Lps-d>\tMGI:9\tC3H/HeJ\tMP:1\tp\tMGI:1\tg1\nc\tTlr4<Lps-d>\tMGI:9\tC3H/HeJ\tMP:2\tp\tMGI:1\tg1\n",
        "orthologs": "MGI:1\tTlr4\t21898\tHGNC:1\tTLR4\t7099\n",
        "alleles": "MGI:9\ts\tdefective lipopolysaccharide response\tt\ta\tr\tMGI:1\tTlr4\n",
        "vocabulary": "MP:1\treduced lipopolysaccharide response\td\nMP:2\tother\td\n",
        "disease_models": "c\tTlr4<Lps-d>\tMGI:9\tC3H/HeJ\tMP:1\tp\tMGI:1\tDOID:1\tOMIM:5\tg1\n",
        "nomenclature": "hgnc_id\tensembl_gene_id\nHGNC:1\tENSG00000136869\n",
    }
    paths = {}
    for name, text in files.items():
        (d / f"{name}.tsv").write_text(text)
        paths[name] = str(d / f"{name}.tsv")
    paths["associations"] = str(d / "a.zip")
    with zipfile.ZipFile(paths["associations"], "w") as z:
        z.writestr("a.tsv", "P-VALUE\tSNP_GENE_IDS\tSNPS\tSTRONGEST SNP-RISK ALLELE\tMAPPED_TRAIT\tDISEASE/TRAIT\tSTUDY ACCESSION\tCHR_ID\tCHR_POS\tMAPPED_TRAIT_URI\tPUBMEDID\tREPORTED GENE(S)\tMAPPED_GENE\n1e-9\tENSG00000136869\trs1\trs1-A\ttrait x\t\tG1\t9\t1\tu\t1\tr\tm\n")
    return paths


CONTROLS = ["control_id", "human_gene", "human_variant", "human_protein_change", "mouse_gene", "mouse_allele_id", "mouse_allele", "mouse_protein_change", "expected_categories", "expected_semantic_class"]


CONTROL = ["TLR4_LPS_001", "TLR4", "rs4986790", "p.Asp299Gly", "Tlr4", "MGI:9", "Tlr4<Lps-d>", "p.Pro712His"]


def table(folder, name, *rows):
    (folder / name).write_text("".join("\t".join(r) + "\n" for r in rows))
    return str(folder / name)


@pytest.fixture(scope="module")
def run(spark, sources, tmp_path_factory):
    """A run with controls that are met and an exchange file without rows."""
    d = tmp_path_factory.mktemp("run")
    tsv = lambda *x: table(d, *x)
    paths = sources | {
        "positive_controls": tsv("positive.tsv", CONTROLS, [*CONTROL, "category1-1|category2-1|category2-2", "C"]),
        "negative_controls": tsv("negative.tsv", ["control_id", "human_gene", "mouse_gene", "expected_rejection_reason"], ["n1", "TLR4", "Trp53", "non_orthologous_gene"], ["n2", "TLR4", "Tlr4", "different_residue_and_substitution"]),
        "case_narratives": tsv("cases.tsv", ["control_id", "representative_route", "interpretation", "limitation"], ["TLR4_LPS_001", "category2-1", "i", "l"]),
        "exchange": tsv("exchange.tsv", contract.COLUMNS),
    }
    return workflow.execute(spark, paths, str(d / "out"), DEFAULT.with_values(band_a=0.999, band_b=0.99, band_c=-1.0))


def test_links(spark, run):
    n = {k: df.count() for k, df in run.tables.items()}
    assert (n["links_category1-1"], n["links_category1-2"], n["links_category2-1"], n["links_category2-2"], n["human_evidence"], n["mouse_evidence"]) == (1, 1, 1, 1, 2, 3)
    assert run.tables["links_category2-1"].first()["within_tier_support"] == "B"
    assert run.tables["links_semantic"].columns == semantic.PAIRS and n["links_semantic"] == 6
    assert readers.tsv(spark, f"{run.out}/links_category1-1").first()["mgi_allele_id"] == "MGI:9"


def test_controls(spark, run):
    t = run.tables
    assert {r["category_id"]: (r["found_rows"], r["status"]) for r in t["tier_validation"].collect()} == {"category1-1": (1, "PASS"), "category1-2": (1, "PASS"), "category2-1": (1, "PASS"), "category2-2": (1, "PASS")}
    assert [r["status"] for r in t["negative_controls"].collect()] == ["PASS", "PASS"] and t["positive_control"].first()["status"] == "PASS"
    case = t["case_studies"].first().asDict()
    assert case["case_study_status"] == "FOUND" and case["primary_connection_routes"] == "category1-1|category2-1|category2-2|semantic_C"
    assert case["representative_human_phenotype"] == "Reduced LPS response" and case["representative_evidence_detail"] == "exact_normalized_label / B"
    assert t["controls_summary"].first()["class_C_rows"] == case["semantic_class_C_evidence_rows"] > 0
    assert [r["evidence_id"] for r in t["human_annotation"].orderBy("source_row").collect()] == ["HE:0000000001", "HE:0000000002"]
    assert spark.table("tier2_ortholog_phenotype").count() == 1 and t["exchange_faults"].isEmpty()
    # Vectors of the same texts and model are read the next time, others are made.
    calls = []
    model = semantic.fitted_embedder(t["texts"], f"{run.out}/vectors")
    again = semantic.kept_vectors(t["texts"], f"{run.out}/vectors", model.name, 128, lambda c: calls.append(c))
    assert again.count() == t["texts"].count() and not calls


def test_statistics_and_manifests(spark, run, sources):
    """Every step's counts, from one parse of each source; digests of what went in and came out; the integrated pairs."""
    s = run.statistics
    assert sorted(s) == ["evidence", "mapping_category1-1", "mapping_category1-2", "mapping_category2-1", "mapping_category2-2", "mapping_semantic", "preparation"]
    assert s["preparation"]["humanVariants"] == {"totalVariants": 1, "variantsWithRsid": 1, "variantsWithOrtholog": 1, "variantsWithAcceptedSignificance": 1, "variantsWithHpoBridge": 1, "retainedRows": 2, "tlr4ControlRows": 1}
    assert s["preparation"]["mousePhenotypes"] == {"totalRows": 2, "singleGeneRows": 2, "retainedRows": 2, "tlr4ControlRows": 2}
    assert s["preparation"]["hpoMp"]["uphenoRows"] == s["preparation"]["hpoMp"]["mhmiRows"] == 1 and s["preparation"]["hpoAnnotations"]["totalRows"] == 2
    assert s["evidence"]["clinvar"] == {"scanned": 1, "rows": 1, "identities": 1} and s["evidence"]["gwas"] == {"scanned": 1, "rows": 1}
    assert s["mapping_category1-1"]["finalRows"] == 1 and s["mapping_category1-1"]["unique"]["humanVariants"] == 1
    assert s["mapping_category2-1"]["supportGrades"] == {"A": 0, "B": 1, "C": 0} and s["mapping_category2-1"]["candidateComparisons"] >= 1
    assert sum(s["mapping_semantic"]["classes"].values()) == 6 and s["mapping_semantic"]["omitted_low_similarity_text_pairs"] == 0
    kept = readers.read_json(f"{run.out}/statistics/evidence.json", spark=spark)
    assert kept["counts"] == s["evidence"] and kept["settings"]["top_k"] == 20
    first = {r["name"]: (r["change"], len(r["sha256"])) for r in run.tables["source_manifest"].collect()}
    assert set(first) >= set(sources) and set(first.values()) == {("new", 64)}
    workflow.record_sources(replace(run, tables={}))
    assert {r["change"] for r in spark.read.parquet(f"{run.out}/source_manifest").collect()} == {"same"}
    assert "orthologs | same | " in spark.read.text(f"{run.out}/DATA_VERSIONS.md", wholetext=True).head()[0]
    outputs = [r["path"] for r in readers.tsv(spark, f"{run.out}/output_manifest").collect()]
    assert any("links_category1-1" in p for p in outputs) and any(p.endswith("statistics/evidence.json") for p in outputs)
    control = readers.tsv(spark, f"{run.out}/control_human_variants").drop("_ord").collect()
    assert [tuple(r)[:4] + (r["condition_names"], r["condition_identifiers"]) for r in control] == [("TLR4", "7099", "rs4986790", "77", "Reduced LPS response", "MEDGEN:C1|OMIM:5")] and len(control[0]) == 13
    assert readers.tsv(spark, f"{run.out}/control_mouse_variants").count() == 2
    assert [r["audit_id"] for r in readers.tsv(spark, f"{run.out}/phrase_audit").collect()] == sorted(a[0] for a in PHRASE_AUDITS)
    pairs = run.tables["variant_pairs"].collect()
    assert sorted((r["rs_id"], r["mgi_allele_id"]) for r in pairs) == [("rs4986790", "MGI:9")] and run.tables["pair_evidence"].count() == sum(r["evidence_rows"] for r in pairs)


def test_steps_run_when_what_they_read_changes(spark, sources, tmp_path):
    """The same sources: nothing is made again. One changed source: its dependants are. A run that is lost leaves the last one's manifest."""
    import shutil

    own = {}
    for name, path in sources.items():
        own[name] = str(tmp_path / path.rsplit("/", 1)[1])
        shutil.copy(path, own[name])
    out = str(tmp_path / "out")
    go = lambda: workflow.execute(spark, own, out, DEFAULT, skip_semantic=True)
    first = go()
    assert set(workflow.NEEDS) <= set(first.ran)
    again = go()
    assert not set(workflow.NEEDS) & set(again.ran)
    rows = lambda run: {n: sorted(map(str, run.tables[n].collect())) for n in first.tables if n.startswith("links_") or n == "variant_pairs"}
    assert rows(again) == rows(first) and again.statistics == first.statistics
    with open(own["vocabulary"], "a") as f:
        f.write("MP:3\tnew term\td\n")
    third = go()
    assert set(workflow.NEEDS) & set(third.ran) == {"prepare_evidence", "map_lexical", "map_disease", "store_pairs"}
    assert third.statistics["evidence"]["mpVocabulary"] == 3 and third.statistics["preparation"] == first.statistics["preparation"]
    kept = readers.read_json(f"{out}/run_manifest.json")
    with open(own["disease_models"], "a") as f:
        f.write("c\tx\tMGI:9\tb\tMP:1\tp\tMGI:1\tDOID:1\tOMIM:5\tg2\n")
    lost = [(n, step if n != "store_pairs" else lambda run: 1 / 0) for n, step in workflow.STEPS]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(workflow, "STEPS", lost)
        with pytest.raises(ZeroDivisionError):
            go()
    assert readers.read_json(f"{out}/run_manifest.json") == kept and all(not readers.missing_inputs(spark, list(s["tables"].values())) for s in kept["steps"].values())
    assert set(workflow.NEEDS) & set(go().ran) == {"map_disease", "store_pairs"}


def test_configuration():
    """Another layout of a run's settings: sections with thresholds, and declared sources."""
    config = {"schema_version": 1, "data_sources": [{"id": "mgi_orthologs", "name": "o", "url": "u", "path": "data/o.rpt"}, {"id": "other", "name": "x", "url": "u", "path": "/abs"}], "monarch_mapping": {}, "category_definitions": [], "execution": {}}
    config |= {"strict_mapping": {"minimum_mapping_confidence": 0.9, "accepted_predicates": ["p"]}, "ortholog_first_mapping": {"minimum_token_jaccard": 0.7}, "semantic_mapping": {"class_a_min": 0.95, "low_similarity_top_k_per_human_text_per_ortholog": 3}}
    assert configured_paths(validate_configuration(config), "/base") == {"orthologs": "/base/data/o.rpt", "other": "/abs"}
    s = Settings.from_configuration(config)
    assert (s.min_confidence, s.predicates, s.min_jaccard, s.band_a, s.top_k, s.aspect) == (0.9, ("p",), 0.7, 0.95, 3, "P")
    for bad in ({"schema_version": 2}, {"data_sources": []}, {"execution": None}, {"data_sources": config["data_sources"] * 2}):
        broken = {k: v for k, v in (config | bad).items() if v is not None}
        with pytest.raises(ValueError):
            validate_configuration(broken)


def test_controls_that_fail(run, tmp_path):
    other = lambda **paths: replace(run, paths=run.paths | paths, out=str(tmp_path), tables=dict(run.tables))
    lost = table(tmp_path, "lost.tsv", CONTROLS, [*CONTROL, "", ""], ["other", "TLR4", "rs9", "a", "Tlr4", "MGI:9", "x", "b", "category1-1", ""])
    with pytest.raises(ValueError, match="other"):
        workflow.validate(other(positive_controls=lost))
    with pytest.raises(ValueError, match="required"):
        workflow.validate(other(positive_controls=table(tmp_path, "none.tsv", CONTROLS, ["x", *CONTROL[1:], "", ""])))
    with pytest.raises(ValueError, match="failed: \\['1'\\]"):
        workflow.check_exchange(other(exchange=table(tmp_path, "bad.tsv", ["tier"])))


def test_refused(spark, sources):
    with pytest.raises(ValueError):
        workflow.execute(spark, {}, "x")
    with pytest.raises(FileNotFoundError):
        workflow.execute(spark, sources | {"variants": "/nowhere"}, "x")


def test_command_line(capsys):
    workflow.main(["--sources", "s", "--out", "o", "--dry-run", "--skip-semantic"])
    assert capsys.readouterr().out.split() == ["record_sources", "prepare_bridge", "map_bridge", "prepare_evidence", "map_lexical", "map_disease", "store_pairs", "report", "validate", "check_exchange", "record_outputs"]
    with pytest.raises(SystemExit):
        workflow.main(["--no-such-flag"])


def test_vectors_and_audits(spark, tmp_path):
    np.save(tmp_path / "v.npy", np.eye(3, dtype=np.float32))
    assert [r["embedding"] for r in readers.npy_vectors(spark, str(tmp_path / "v.npy")).orderBy("row").collect()][1] == [0.0, 1.0, 0.0]
    got = {r["audit_id"]: r["review_status"] for r in semantic.phrase_audits(spark).collect()}
    assert got["negation"] == "negation_review" and got["opposite_glucose"] == "direction_conflict" and len(got) == 6
    old, new = (spark.createDataFrame(r, "id string, sha256 string") for r in ([("a", "1"), ("b", "1")], [("a", "1"), ("b", "2"), ("c", "3")]))
    assert {r["id"]: r["change"] for r in readers.manifest_changes(new, old).collect()} == {"a": "same", "b": "changed", "c": "new"}
    row = spark.createDataFrame([("<a&b>", 1234567)], "t string, n long").select(X.escaped("t"), X.grouped_number("n")).first()
    assert tuple(row) == ("&lt;a&amp;b&gt;", "1,234,567")
