"""Representative evidence, checks that raise, configurations, order of lines over files, counts before joins."""

import pytest
from pyspark.sql import functions as F

from linkloom import settings
from linkloom.operators.keys import numbered
from linkloom.plans import bridge, contract, reports, semantic
from linkloom.sources import readers


def test_representative_evidence(spark):
    """What stands for a link depends on its route; a missing column or text is ''."""
    row = {"control_id": "c", "hpo_label": "h", "mp_label": None, "hpo_id": "HP:1", "predicate": "", "mp_id": "MP:2", "human_phenotype_label": "x", "mouse_phenotype_label": "", "allele_name": "al", "match_method": "m", "within_tier_support": "B", "cosine_similarity": 0.81249}
    df = spark.createDataFrame([row], ", ".join(f"{k} {'double' if k == 'cosine_similarity' else 'string'}" for k in row))
    shown = {r: tuple(reports.representative_evidence(df, r).first())[2:] for r in ("category1-1", "category1-2", "category2-1", "category2-2", "semantic_A")}
    assert shown == {"category1-1": ("h", "", "HP:1 / MP:2"), "category1-2": ("h", "", "HP:1 / MP:2"), "category2-1": ("x", "al", "m / B"), "category2-2": ("", "", ""), "semantic_A": ("x", "", "cosine 0.812")}


def test_require(spark):
    checks = spark.createDataFrame([("a", "PASS"), ("b", "FAIL"), ("c", None)], "name string, status string")
    reports.require(checks.where("name = 'a'"), "name", F.col("status") == "PASS")
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        reports.require(checks, "name", F.col("status") == "PASS")


def configuration(**changes):
    source = {"id": "a", "name": "n", "url": "u", "path": "p"}
    return {"schema_version": 1, "data_sources": [source], **{s: {} for s in settings.SECTIONS}, **changes}


def test_configuration():
    assert settings.validate_configuration(configuration())["a"].path == "p"
    for bad in (configuration(schema_version=2), configuration(data_sources=[]), configuration(data_sources=[{"id": "a"}]), configuration(data_sources=configuration()["data_sources"] * 2)):
        with pytest.raises(ValueError):
            settings.validate_configuration(bad)
    for section in settings.SECTIONS:
        lacking = configuration()
        del lacking[section]
        with pytest.raises(ValueError, match=section):
            settings.validate_configuration(lacking)


def test_lines_of_several_files(spark, tmp_path):
    """Files by path, whatever their size, then lines."""
    for name, n in (("c.txt", 3), ("a.txt", 2), ("b.txt", 9000)):
        (tmp_path / name).write_text("".join(f"{name} {i}\r\n" for i in range(n)))
    got = [r["value"] for r in readers.lines(spark, str(tmp_path)).orderBy("_ord").collect()]
    assert got == [f"{name} {i}" for name, n in (("a.txt", 2), ("b.txt", 9000), ("c.txt", 3)) for i in range(n)]


def test_numbered(spark):
    df = spark.range(0, 5000, 7, 6).withColumn("k", F.struct(F.lit("f").alias("file"), F.col("id").alias("line")))
    rows = numbered(df, "k", "n").orderBy("id").collect()
    assert [r["n"] for r in rows] == list(range(1, len(rows) + 1)) and numbered(df.limit(0), "k", "n").count() == 0


def test_contract_files(spark):
    """No header, a wrong one, and lines of other widths."""
    lines = lambda *values: spark.createDataFrame([(i, v) for i, v in enumerate(values)], "_ord long, value string")
    empty = [tuple(r) for r in contract.file_issues(lines("", " ")).collect()]
    assert empty == [(1, "", ["file has no header"])]
    found = {r["row"]: r["errors"] for r in contract.file_issues(lines("\t".join(contract.COLUMNS), "", "tier0\tx"), contract.COLUMNS).collect()}
    assert set(found) == {2} and found[2][0] == "expected 42 columns; found 2" and "missing human_gene" in found[2]
    assert contract.file_issues(lines("a\tb")).first()["errors"] == ["header does not exactly match the Tier 0 template"]


def test_counts_before_the_join(spark):
    """The counts are those of the links themselves, also where genes and alleles repeat."""
    human = spark.createDataFrame([("G", "r1", "H1"), ("G", "r1", "H1"), ("G", "r2", "H1"), ("K", "r3", "H2")], "human_gene string, rs_id string, hpo_id string")
    human = human.select(*(F.col(c) if c in human.columns else F.lit("").alias(c) for c in bridge.HUMAN))
    merged = spark.createDataFrame([("H1", "M1", "p", "0.9"), ("H1", "M1", "q", ""), ("H2", "M2", "p", "0.1")], "hpo_id string, mp_id string, predicate string, confidence string")
    for c in ("mapping_justification", "mapping_date", "mapping_source", "mp_label"):
        merged = merged.withColumn(c, F.lit(""))
    pairs = spark.createDataFrame([("G", "g1"), ("G", "g2"), ("K", "k")], "human_gene string, mouse_gene string")
    mice = spark.createDataFrame([("g1", "a1", "M1"), ("g2", "a1", "M1"), ("g2", "a2", "M1"), ("k", "a", "M2")], "mouse_gene string, mgi_allele_id string, mp_id string")
    mice = mice.select(*(F.col(c) if c in mice.columns else F.lit("").alias(c) for c in bridge.ALLELE), "mp_id", F.lit("").alias("pubmed_ids"), F.lit("").alias("mgi_genotype_id"))
    route = bridge.BridgeRoute("x", "y", ("p", "q"), 0.5)
    links = bridge.bridge_links(human, merged, pairs, mice, route).groupBy("human_gene", "hpo_id", "mp_id").agg(F.count("*").alias("n"), F.count_distinct("rs_id"), F.count_distinct("mgi_allele_id"), F.max("mapping_confidence"))
    counts = [tuple(r) for r in bridge.bridge_counts(human, merged, pairs, mice, route).collect()]
    assert counts == [tuple(r) for r in links.collect()] == [("G", "H1", "M1", 18, 2, 2, "0.9")]


def test_norms_and_totals(spark):
    bad = semantic.norm_audit(spark.createDataFrame([([0.6, 0.8],), ([float("nan"), 1.0],), ([0.0, 2.0],)], "embedding array<double>")).first()
    assert bad["vectors"] == 3 and bad["least"] == 1.0 and bad["largest_error"] == float("inf")
    none = semantic.gene_texts(spark.createDataFrame([], "gene string, text_id string"), spark.createDataFrame([], "gene string, text_id string"))
    assert tuple(semantic.compared_totals(none, none).first()) == (0, 0, 0)
