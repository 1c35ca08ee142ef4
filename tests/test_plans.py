"""Linkage plans on small tables."""

import pytest
from pyspark.sql import functions as F

from linkloom.plans import bridge, contract, disease, lexical, reports, semantic
from linkloom.settings import DEFAULT, STRICT_ROUTE, UNSCORED_ROUTE


def table(spark, columns, *rows):
    names = columns.split()
    return spark.createDataFrame([dict(zip(names, r)) for r in rows] or [], ", ".join(f"{n} {'long' if n == '_ord' else 'string'}" for n in names))


MAP = "_ord hpo_id hpo_label mp_id mp_label predicate confidence mapping_justification mapping_date mapping_source"
ORTHO = "_ord human_gene human_ncbi_gene_id hgnc_id mouse_gene mouse_ncbi_gene_id mgi_marker_id"


@pytest.fixture(scope="module")
def mappings(spark):
    return table(
        spark, MAP,
        (1, "HP:1", "", "MP:1", "m", "skos:exactMatch", "0.8", "j1", "", "a"),
        (2, "HP:1", "h", "MP:1", "m", "skos:exactMatch", "1", "j2", "d", "b"),
        (3, "HP:1", "h", "MP:1", "m", "skos:exactMatch", "1.0", "j3", "e", "b"),
        (4, "HP:2", "h", "MP:2", "m", "semapv:crossSpeciesExactMatch", "", "j", "d", "monarch_upheno"),
        (5, "HP:3", "h", "MP:3", "m", "skos:closeMatch", "0.79", "j", "d", "a"),
        (6, "HP:4", "h", "MP:4", "m", "skos:closeMatch", "abc", "j", "d", "a"),
    )


@pytest.fixture(scope="module")
def orthologs(spark):
    return table(spark, ORTHO, (1, "TLR4", "7099", "HGNC:1", "Tlr4", "21898", "MGI:1"), (2, "TLR4", "7099", "HGNC:1", "Tlr4", "999", "MGI:1"))


def test_merge(mappings):
    m = {r["hpo_id"]: r for r in bridge.merge_mappings(mappings).collect()}
    one = m["HP:1"]
    assert (one["confidence"], one["mapping_source"], one["hpo_label"], one["mapping_justification"], one["mapping_date"]) == ("1", "a|b", "h", "j1", "d")
    assert m["HP:2"]["confidence"] == ""


def test_routes(mappings):
    m = bridge.merge_mappings(mappings)
    assert [r["hpo_id"] for r in bridge.accepted_mappings(m, STRICT_ROUTE).collect()] == ["HP:1"]
    assert [r["hpo_id"] for r in bridge.accepted_mappings(m, UNSCORED_ROUTE).collect()] == ["HP:2"]


def test_bridge_route(spark, mappings, orthologs):
    vcf = table(spark, "_ord chrom pos id ref alt qual filter info", (1, "9", "100", "77", "A", "G", ".", ".", "RS=4986790;GENEINFO=TLR4:7099|ABO:28;CLNDISDB=MedGen:C1|MIM:5,OMIM:5;CLNSIG=Pathogenic;CLNREVSTAT=x"), (2, "9", "1", "78", "A", "G", ".", ".", "RS=1;GENEINFO=TLR4:7099;CLNDISDB=OMIM:5;CLNSIG=Benign"))
    notes = table(spark, "_ord database_id disease_name qualifier hpo_id reference evidence onset frequency sex modifier aspect biocuration", (1, "OMIM:5", "d", "", "HP:1", "r1", "PCS", "", "", "", "", "P", ""), (2, "OMIM:5", "d", "", "HP:1", "r2", "PCS", "", "", "", "", "P", ""), (3, "OMIM:5", "d", "NOT", "HP:2", "r", "PCS", "", "", "", "", "P", ""))
    merged = bridge.merge_mappings(mappings)
    human = bridge.variant_phenotypes(vcf, notes, orthologs, merged)
    assert [(r["human_gene"], r["rs_id"], r["disease_id"], r["hpo_id"], r["hpo_annotation_reference"], r["hpo_label"]) for r in human.collect()] == [("TLR4", "rs4986790", "OMIM:5", "HP:1", "r1", "h")]
    geno = table(spark, "_ord allelic_composition mouse_allele mgi_allele_id genetic_background mp_id pubmed_ids marker_ids mgi_genotype_id", (1, "c", "Tlr4<Lps-d>", "MGI:9", "C3H/HeJ", "MP:1", "p", "MGI:1", "g"), (2, "c", "x", "MGI:8", "b", "MP:1", "p", "MGI:1|MGI:1", "g2"))
    alleles = bridge.allele_phenotypes(geno, orthologs, merged)
    assert [(r["mouse_gene"], r["mouse_ncbi_gene_id"], r["mgi_genotype_id"]) for r in alleles.collect()] == [("Tlr4", "999", "g")]
    links = bridge.bridge_links(human, merged, orthologs, alleles, STRICT_ROUTE)
    assert len(links.columns) == 38 and links.count() == 2  # an ortholog row repeated doubles the evidence


def test_lexical(spark, orthologs):
    vcf = table(spark, "_ord chrom pos id ref alt qual filter info", (1, "9", "100", "77", "A", "G", ".", ".", "RS=1,1;GENEINFO=TLR4:7099;CLNDISDB=OMIM:5,MedGen:C2;CLNDN=Reduced_LPS_responsiveness|not_provided;CLNSIG=association"))
    h = lexical.variant_conditions(vcf, orthologs)
    assert [(r["human_ncbi_gene_id"], r["phenotype_id"], r["phenotype_label"]) for r in h.collect()] == [("7099", "OMIM:5", "Reduced LPS responsiveness")]
    names = table(spark, "_ord hgnc_id ensembl_gene_id", (1, "HGNC:1", "ENSG1"), (2, "HGNC:1", "ENSG2"))
    rich = lexical.enrich_orthologs(orthologs, names)
    cols = ["_ord", "P-VALUE", "SNP_GENE_IDS", "SNPS", "STRONGEST SNP-RISK ALLELE", "MAPPED_TRAIT", "DISEASE/TRAIT", "STUDY ACCESSION", "CHR_ID", "CHR_POS", "MAPPED_TRAIT_URI", "PUBMEDID", "REPORTED GENE(S)", "MAPPED_GENE"]
    rows = [(i, p, "ENSG2, ENSG9", "rs5", "rs5-A", "", f"t{i}", "G1", "1", "2", "u", "3", "r", "m") for i, p in enumerate(["", "5e-8", "5.1e-8", "abc", "1d"])]
    gwas = lexical.association_evidence(spark.createDataFrame(rows, cols), rich)
    assert sorted(r["phenotype_label"] for r in gwas.collect()) == ["t0", "t1"]
    geno = table(spark, "_ord allelic_composition mouse_allele mgi_allele_id genetic_background mp_id pubmed_ids marker_ids mgi_genotype_id", (1, "c", "a", "MGI:8|MGI:9", "b", "MP:1", "p1", "MGI:1", "g"), (2, "c", "a", "MGI:8|MGI:9", "b", "MP:1", "p2", "MGI:1", "g"))
    alleles = table(spark, "allele_id marker_id allele_name allele_type allele_attribute", ("MGI:8", "MGI:7", "other", "t", "x"), ("MGI:9", "MGI:1", "lipopolysaccharide response defective", "t", "y"))
    terms = table(spark, "mp_id mp_label mp_definition", ("MP:1", "reduced lipopolysaccharide response", "def"))
    m = lexical.mouse_evidence(geno, orthologs, alleles, terms)
    got = {(r["phenotype_source"], r["phenotype_label"], r["mgi_allele_id"], r["pubmed_ids"]) for r in m.collect()}
    # Each known allele with a name gives a row, not only the primary one.
    assert got == {("MGI_MP", "reduced lipopolysaccharide response", "MGI:8|MGI:9", "p1"), ("MGI_allele_name", "lipopolysaccharide response defective", "MGI:9", "p1"), ("MGI_allele_name", "other", "MGI:8", "p1")}
    links = lexical.lexical_links(lexical.human_evidence(h, gwas), m, orthologs)
    assert [(r["within_tier_support"], r["mouse_phenotype_label"]) for r in links.collect()] == [("B", "reduced lipopolysaccharide response")]
    assert links.columns == lexical.LINKS and len(lexical.LINKS) == 40


@pytest.mark.parametrize("rows", [4096, 3])
def test_bridge_against_all_rows(spark, rows):
    """Rings with a hot (mouse gene, phenotype), equal rows on every side, and keys without a partner; squares of three rows."""
    import itertools
    import random

    draw = random.Random(4)
    human = [("G1", "HP:1", f"rs{i % 30}") for i in range(60)] + [(f"G{draw.randrange(5)}", f"HP:{draw.randrange(6)}", f"rs{i}") for i in range(40)]
    mice = [("m1", "MP:1", f"a{i % 9}") for i in range(25)] + [(f"m{draw.randrange(5)}", f"MP:{draw.randrange(6)}", f"a{i}") for i in range(30)]
    pairs = [("G1", "m1"), ("G1", "m1"), ("G2", "m2"), ("G3", "m1"), ("G4", "m9")]
    near = sorted({("HP:1", "MP:1")} | {(f"HP:{draw.randrange(7)}", f"MP:{draw.randrange(7)}") for _ in range(14)})
    full = lambda names, row: [row.get(c, "") for c in names]
    h = spark.createDataFrame([full(bridge.HUMAN, {"human_gene": g, "hpo_id": p, "rs_id": r}) for g, p, r in human], bridge.HUMAN)
    names = [*bridge.ALLELE, "mp_id", "pubmed_ids", "mgi_genotype_id"]
    m = spark.createDataFrame([full(names, {"mouse_gene": g, "mp_id": p, "mgi_allele_id": a}) for g, p, a in mice], names)
    columns = ["hpo_id", "mp_id", "predicate", "confidence", "hpo_label", "mp_label", "mapping_justification", "mapping_date", "mapping_source"]
    b = spark.createDataFrame([(p, q, "skos:exactMatch", "1", "", "", "", "", "s") for p, q in near], columns)
    o = spark.createDataFrame(pairs, ["human_gene", "mouse_gene"])
    got = bridge.bridge_links(h, b, o, m, STRICT_ROUTE, rows=rows).select("human_gene", "hpo_id", "rs_id", "mouse_gene", "mp_id", "mgi_allele_id").collect()
    want = [(g, p, r, k, q, a) for (g, p, r), (g2, k), (p2, q), (k2, q2, a) in itertools.product(human, pairs, near, mice) if g == g2 and p == p2 and k == k2 and q == q2]
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 3000
    keys = bridge.bridge_keys(h, o, b, m).collect()
    assert {tuple(r)[:4] for r in keys} == {(g, p, k, q) for g, p, _, k, q, _ in want} and sum(r["h"] * r["p"] * r["m"] for r in keys) == len(want)


def test_evidence_values(spark, orthologs):
    """Values that are shown, fall-backs of empty ones, and the first gene id of a symbol that has two."""
    info = "RS=1;GENEINFO=TLR4:9|TLR4:10|OTHER;CLNDISDB=OMIM:5|MedGen:C2,.;CLNDN=Reduced_LPS%2C_x|not_provided;CLNSIG=Likely_pathogenic|risk_factor"
    vcf = table(spark, "_ord chrom pos id ref alt qual filter info", (1, "9", "100", "77", "A", "G", ".", ".", info + ";CLNREVSTAT=no_assertion"), (2, "9", "100", "78", "A", "G", ".", ".", info))
    h = {r["source_record_id"]: r for r in lexical.variant_conditions(vcf, orthologs).collect()}
    assert (h["77"]["clinical_significance"], h["77"]["evidence_detail"]) == ("Likely pathogenic; risk factor", "ClinVar aggregate classification; review status: no assertion")
    assert (h["78"]["evidence_detail"], h["78"]["phenotype_id"], h["78"]["phenotype_label"]) == ("ClinVar aggregate classification; review status: not reported", "OMIM:5|MEDGEN:C2", "Reduced LPS, x")
    merged = table(spark, "hpo_id mp_id predicate hpo_label", ("HP:1", "MP:1", "skos:exactMatch", "h"))
    notes = table(spark, "_ord database_id disease_name qualifier hpo_id reference evidence frequency aspect biocuration", (1, "MIM:5", "", "", " http://x/obo/HP_1", "r", "e", "f", "P", "b"), (2, "", "d", "", "HP:1", "r", "e", "f", "P", "b"))
    got = bridge.variant_phenotypes(vcf.where("id = '77'"), notes, orthologs, merged).collect()
    assert [(r["human_ncbi_gene_id"], r["disease_name"], r["clinical_significance"], r["review_status"], r["hpo_id"]) for r in got] == [("9", "Reduced LPS, x; not provided", "Likely pathogenic; risk factor", "no assertion", "HP:1")]
    geno = table(spark, "_ord allelic_composition mouse_allele mgi_allele_id genetic_background mp_id pubmed_ids marker_ids mgi_genotype_id", (1, "c", "a", "MGI:8|MGI:7|MGI:9", "b", "MP:1", "p1", "MGI:1", "g"))
    alleles = table(spark, "allele_id symbol marker_id allele_name allele_type reference", ("MGI:8", "s8", "MGI:7", "n8", "t8", ""), ("MGI:9", "", "MGI:1", "n9", "t9", "J:1"))
    rows = {r["mgi_allele_id"]: r for r in lexical.mouse_evidence(geno, orthologs, alleles, table(spark, "mp_id mp_label mp_definition", ("MP:1", "l", "d"))).collect()}
    shown = {k: (r["mouse_allele"], r["allele_name"], r["allele_type"], r["phenotype_source"], r["evidence_detail"]) for k, r in rows.items()}
    assert shown == {
        "MGI:8|MGI:7|MGI:9": ("a", "n9", "t9", "MGI_MP", "Specific MP annotation from MGI_GenePheno"),
        "MGI:8": ("s8", "n8", "t8", "MGI_allele_name", "MGI phenotypic allele name; original reference not reported"),
        "MGI:9": ("a", "n9", "t9", "MGI_allele_name", "MGI phenotypic allele name; original reference J:1"),
    }


@pytest.mark.parametrize("a, b, want", [("decreased response to LPS", "some long allele name with lps tested", None), ("abnormal immune response", "abnormal tactile response", None), ("a b c d", "a b c e", ("C", "0.600")), ("!!!", "...", None), ("x y", "Y x", ("C", "1.000")), ("Hearing Loss", "hearing  loss", ("B", "1.000"))])
def test_label_match(spark, a, b, want):
    side = lambda s: spark.createDataFrame([("g", 1, s)], "gene string, id int, label string")
    got = lexical.label_matches(side(a), side(b)).collect()
    assert [(r["support"], r["token_jaccard"]) for r in got] == ([want] if want else [])


@pytest.mark.parametrize("rows", [4096, 5])
def test_labels_of_one_gene_that_share_a_token(spark, rows):
    """Nearly all labels have one token, and it is the rarest of many; entries in squares of five; against all pairs."""
    import random

    draw = random.Random(6)
    words = [f"w{i}" for i in range(12)]
    made = lambda n: [("g", i, " ".join(["common"] * (draw.random() < 0.9) + draw.sample(words, draw.randrange(1, 5)))) for i in range(n)]
    left, right = made(90), made(70)
    frame = lambda some: spark.createDataFrame(some, "gene string, id int, label string")
    got = {(r["left_id"], r["right_id"], r["support"], r["token_jaccard"]) for r in lexical.label_matches(frame(left), frame(right), rows=rows).collect()}
    want = set()
    for _, i, a in left:
        for _, j, b in right:
            x, y = set(a.split()), set(b.split())
            if a == b:
                want.add((i, j, "B", "1.000"))
            elif len(x & y) >= 2 and len(x & y) / len(x | y) >= 0.6:
                want.add((i, j, "C", f"{len(x & y) / len(x | y):.3f}"))
    assert got == want and len(want) > 100


def shuffled(spark, run):
    """What ``run`` returns, with the rows and bytes that its stages wrote for a shuffle; no join is a broadcast."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    stages = lambda: {x.stageId(): x for x in (seq.apply(i) for seq in [sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)] for i in range(seq.size()))}
    seen = set(stages())
    try:
        out = run()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    new = [x for k, x in stages().items() if k not in seen]
    return out, sum(x.shuffleWriteRecords() for x in new), sum(x.shuffleWriteBytes() for x in new)


def test_index_of_long_labels_is_small(spark):
    """An entry has no tokens of its label: what is shuffled grows with the labels' length, not with its square. In squares and
    whole, against all pairs."""
    import random

    draw = random.Random(5)
    base = [draw.sample([f"word{i}" for i in range(2000)], 300) for _ in range(20)]
    texts = [" ".join(w[k:] + draw.sample([f"word{i}" for i in range(2000)], k)) for w in base for k in (0, 40, 90)]
    df = spark.createDataFrame([("g", i, x) for i, x in enumerate(texts)], "gene string, id int, label string").repartition(3).cache()
    df.count()
    sets = [set(x.split()) for x in texts]
    want = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j and len(a & b) / len(a | b) >= 0.6}
    for rows in (4096, 7):
        got, _, size = shuffled(spark, lambda: lexical.label_matches(df, df, rows=rows).where("support = 'C'").collect())  # noqa: B023
        assert {(r["left_id"], r["right_id"]) for r in got} == want and len(got) == len(want) >= 40
        if rows == 4096:
            # 60 labels of 300 tokens have 7,260 entries: with their tokens 27.8 MB, without them 1.0 MB.
            assert size < 1_500_000


def test_ids_come_back_as_lists(spark, monkeypatch):
    """Rows that meet in the last joins are lists of ids, not pairs; more rows than a list holds, null ids and equal rows stay."""
    monkeypatch.setattr(lexical, "IDS", 6, raising=False)
    names = [f"a b c d {x}" for x in "efghijklmnop"]
    side = lambda: spark.createDataFrame([("g", i if i else None, x) for x in names for i in [*range(19), 7]], "gene string, id int, label string")
    got, rows, _ = shuffled(spark, lambda: lexical.label_matches(side(), side()).groupBy("left_id", "support").agg(F.count("*").alias("n")).collect())
    ids = {None, *range(1, 19)}
    assert {(r["left_id"], r["support"], r["n"]) for r in got} == {(i, g, 20 * (1 + (i == 7)) * n) for i in ids for g, n in (("B", 12), ("C", 132))}
    # Twelve labels make 144 pairs of labels and 57,600 of rows: 4,150 rows shuffled with ids that come one by one, 1,536 with lists.
    assert rows < 2500


def test_counts_of_labels_without_links(spark, sf_dir, monkeypatch):
    """Equal rows, labels that differ before they are normalised, blank and unlinked ones; against the counts of the links."""
    from linkloom.plans import counts, registry

    words = ["x y", "X  y", "y x", "x y z", "q", "", "!!"]
    human = spark.createDataFrame([{c: "" for c in lexical.HUMAN} | {"human_gene": g, "rs_id": f"rs{i % 3}", "phenotype_label": words[i % 7], "evidence_class": "other" if i % 5 == 4 else "gwas_significant"} for g in ("G", "H") for i in range(24)]).select(*lexical.HUMAN)
    mouse = spark.createDataFrame([{c: "" for c in lexical.MOUSE} | {"mouse_gene": g, "mgi_allele_id": f"a{i % 4}", "phenotype_label": words[i % 7]} for g in ("g", "k") for i in range(30)]).select(*lexical.MOUSE)
    genes = table(spark, "human_gene mouse_gene _ord", ("G", "g", 1), ("H", "h", 2))
    want = {tuple(r) for r in counts.lexical_mapping(human, mouse, genes, lexical.lexical_links(human, mouse, genes)).collect()}
    assert {tuple(r) for r in counts.lexical_mapping_of(human, mouse, genes).collect()} == want and dict(want)["finalRows"] > 100
    # The query makes no links: they grow with the square of its table.
    monkeypatch.setattr(lexical, "lexical_links", None)
    assert registry.QUERIES["ag_lexical_counts"](spark, sf_dir).count() == 15


def test_sides_that_differ(spark):
    """Against a multiset difference; equal sides exchange no row."""
    import random
    from collections import Counter

    draw = random.Random(8)
    a = [(draw.randrange(50), draw.choice(["x", None])) for _ in range(300)]
    b = a[5:] + [(7, "x"), (99, "new"), (99, "new")]
    draw.shuffle(b)
    left, right = (spark.createDataFrame(r, "k int, v string") for r in (a, b))
    row = reports.symmetric_difference(left, right.select("v", "k")).first()
    assert (row["missing"], row["extra"]) == (sum((Counter(a) - Counter(b)).values()), sum((Counter(b) - Counter(a)).values())) and row["extra"] >= 2
    assert reports.differing(left, left.repartition(3)).count() == 0 and reports.differing(left, right).count() <= 8
    assert tuple(reports.symmetric_difference(left, left).first()) == (0, 0) == tuple(reports.symmetric_difference(left.limit(0), left.limit(0)).first())


def test_retired_support(spark):
    with pytest.raises(Exception, match="retired"):
        spark.range(1).select(lexical.interpretation(F.lit("A"))).collect()


def test_disease(spark, orthologs):
    rows = table(spark, "_ord allelic_composition mouse_allele mgi_allele_id genetic_background mp_id pubmed_ids marker_ids mouse_doid mouse_omim_ids mgi_genotype_id", (1, "c", "a", "MGI:9|MGI:8", "b", "MP:2", "2|1", "MGI:1|MGI:1", "DOID:1", "OMIM:5|OMIM:5", "g"), (2, "c2", "a2", "MGI:9|MGI:8", "b", "MP:1", "3", "MGI:1", "DOID:1", "OMIM:5|OMIM:5", "g"))
    alleles = table(spark, "allele_id allele_name allele_attribute", ("MGI:8", "n8", "x|y"), ("MGI:9", "n9", "y"))
    m = disease.disease_models(rows, orthologs, alleles)
    r = m.first()
    assert m.count() == 1 and (r["mouse_mp_ids"], r["mouse_pubmed_ids"], r["mouse_allele_name"], r["mouse_allele_attribute"], r["allelic_composition"]) == ("MP:1|MP:2", "1|2|3", "n8|n9", "x|y", "c")
    human = table(spark, "_ord human_gene rs_id source_record_id variant_source evidence_class condition_identifiers", (1, "TLR4", "rs1", "7", "ClinVar", "clinvar_supported", "OMIM:5|MEDGEN:C"), (2, "TLR4", "rs1", "7", "ClinVar", "clinvar_supported", "OMIM:5"), (3, "TLR4", "rs2", "7", "GWAS Catalog", "gwas_significant", "OMIM:5"))
    assert [(x["rs_id"], x["shared_disease_id"], x["human_condition_identifiers"]) for x in disease.disease_links(human, m).collect()] == [("rs1", "OMIM:5", "OMIM:5|MEDGEN:C")]
    assert disease.with_shared_disease(human, m).first()[0] == 3


def test_semantic(spark):
    def pairs(scores):
        return spark.createDataFrame([("g", "h", f"m{i}", s) for i, s in enumerate(scores)], "gene string, left_id string, right_id string, score double")

    top = semantic.matches(pairs([0.9, 0.85, 0.8, 0.75, 0.7, 0.6]), DEFAULT.with_values(top_k=2))
    assert [r["right_id"] for r in top.orderBy("retrieval_rank").collect()] == ["m0", "m1", "m2", "m3", "m4"]
    low = semantic.matches(pairs([0.2, 0.6, 0.4, 0.9]), DEFAULT.with_values(top_k=3))
    assert [r["right_id"] for r in low.orderBy("retrieval_rank").collect()] == ["m3", "m1", "m2"]
    assert semantic.matches(pairs([]), DEFAULT).count() == 0
    unit = spark.createDataFrame([("g", "a", [1.0, 0.0]), ("h", "b", [0.0, 1.0])], "gene string, id string, embedding array<float>")
    assert [r["score"] for r in semantic.scored_pairs(unit, unit).collect()] == [1.0, 1.0]
    with pytest.raises(Exception, match="out of range"):
        semantic.matches(pairs([2.0])).collect()


def test_collapse(spark, orthologs):
    assert semantic.collapse_orthologs(orthologs).first()["mouse_ncbi_gene_id"] == "21898|999"
    bad = table(spark, ORTHO, (1, "A", "1", "H", "a", "2", "M"), (2, "B", "1", "H", "a", "3", "M"))
    with pytest.raises(Exception, match="orthologs differ"):
        semantic.collapse_orthologs(bad).collect()


def test_views(spark):
    texts = spark.createDataFrame([("t1", "hearing loss", False), ("t2", "no hearing loss", False)], "text_id string, label string, truncated boolean")
    found = spark.createDataFrame([("g", "t1", "t2", 0.9), ("g", "t1", "t1", 0.1)], "gene string, left_id string, right_id string, score double")
    m = semantic.flagged_matches(semantic.matches(found), texts)
    assert {r["review_status"] for r in semantic.active(m).collect()} == {"negation_review"}
    ann = spark.createDataFrame([("g", "t1", 1), ("other", "t1", 2)], "gene string, text_id string, v int")
    got = semantic.variant_correspondence(semantic.active(m), ann, ann.withColumn("text_id", F.lit("t2")).withColumnRenamed("v", "w"))
    assert [(r["v"], r["w"]) for r in got.collect()] == [(1, 1)]
    assert [r["human_label"] for r in semantic.phenotype_pairs(semantic.active(m), texts).collect()] == ["hearing loss"]


def test_contract(spark):
    good = {c: "x" for c in contract.REQUIRED} | contract.CONSTANTS | {"match_level": "protein_exact", "allele_orientation": "forward", "reciprocal_mapping": "1", "qc_status": "passed", "source_sha256": "a" * 64, "human_transcript": "x", "human_hgvs_p": "x", "mouse_transcript": "x", "mouse_hgvs_p": "x", "human_ncbi_gene_id": "", "mouse_ncbi_gene_id": ""}
    rows = [good, good | {"source_record_id": "2", "mouse_hgvs_p": " "}, good | {"source_record_id": "3", "match_level": "genomic_reciprocal_exact", "reciprocal_mapping": "0"}, good | {"human_gene": "other"}]
    df = spark.createDataFrame([r | {"n": str(i)} for i, r in enumerate(rows)])
    known = spark.createDataFrame([("x", "", "x", "")], "human_gene string, human_ncbi_gene_id string, mouse_gene string, mouse_ncbi_gene_id string")
    e = {r["n"]: r["errors"] for r in contract.contract_errors(df, ["n"], known).collect()}
    assert e["0"] == [] and e["1"] == ["protein_exact requires mouse_hgvs_p"]
    assert "genomic_reciprocal_exact requires reciprocal_mapping=1" in e["2"] and "genomic_reciprocal_exact requires human_chromosome" in e["2"]
    assert e["3"] == [contract.NOT_ORTHOLOGOUS, "duplicate source_dataset/source_version/source_record_id"]
    r = contract.contract_report(contract.contract_errors(df, ["n"], known)).first()
    assert (r["rows"], r["invalid"], r["passed"], r["status"]) == (4, 3, 4, "FAIL")
    assert contract.header_errors(["a", "b"], ["b", "a"]) == ["columns are out of order"] and contract.header_errors(["a"], ["a"]) == []


def test_reports(spark):
    controls = spark.createDataFrame([("c1", "TLR4", "rs1", "Tlr4", "MGI:1", "2-1|2-2", "p.A", "p.B")], "control_id string, human_gene string, human_variant string, mouse_gene string, mouse_allele_id string, expected_categories string, human_protein_change string, mouse_protein_change string")
    links = spark.createDataFrame([("TLR4", "rs1", "Tlr4", "MGI:2|MGI:1", "B"), ("TLR4", "rs1", "Tlr4", "MGI:11", "C")], "human_gene string, rs_id string, mouse_gene string, mgi_allele_id string, support string")
    seen = reports.inspect_category(links, controls, "2-1", "support").unionByName(reports.inspect_category(links.limit(0), controls, "2-2")).unionByName(reports.inspect_category(links, controls, "1-1"))
    m = reports.expectation_matrix(controls, seen)
    assert {(r["category_id"], r["found_rows"], r["status"], r["within_tier_support"]) for r in m.collect()} == {("2-1", 1, "PASS", "B"), ("2-2", 0, "FAIL", ""), ("1-1", 1, "PASS", "")}
    assert reports.case_summary(controls, m, ["1-1", "2-1", "2-2"]).first()["recovery_status"] == "NOT_FOUND"
    mouse = spark.createDataFrame([("Tlr4", "Tlr4<Lps-d>", "MGI:1", "C3H/HeJ")], "mouse_gene string, mouse_allele string, mgi_allele_id string, genetic_background string")
    ortho = spark.createDataFrame([("TLR4", "Tlr4")], "human_gene string, mouse_gene string")
    assert reports.positive_control(controls, links, mouse, ortho, "Lps-d", "C3H/HeJ").first()["status"] == "PASS"
    neg = spark.createDataFrame([("n1", "non_orthologous_gene"), ("n2", "different_residue_and_substitution"), ("n3", "?")], "control_id string, expected_rejection_reason string")
    assert [r["status"] for r in reports.negative_controls(neg, 0, "a", "a").orderBy("control_id").collect()] == ["PASS", "FAIL", "FAIL"]
    assert reports.forbidden_pairs(links, "TLR4", "Tlr4").first()[0] == 2
    assert reports.first_links(links, controls, ["mgi_allele_id"]).count() == 1
    assert spark.range(1).select(reports.primary_routes(F.lit("a|b"), F.lit("A")).alias("r")).first()["r"] == ["a", "b", "semantic_A"]
