"""Lexical linkage: evidence rows of both sides, a token index inside each ortholog gene, graded label matches."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.operators.keys import first_wins, last_wins
from linkloom.session import written
from linkloom.settings import ALIASES, DEFAULT, ORTHOLOG_SOURCE, SAYS_B, SAYS_C, Settings

# Columns of published tables.
HUMAN = ["human_gene", "human_ncbi_gene_id", "rs_id", "chromosome", "position", "reference_allele", "alternate_allele", "variant_source", "source_record_id", "phenotype_id", "phenotype_label", "evidence_class", "evidence_detail", "p_value", "publication_id", "clinical_significance", "condition_identifiers", "reported_genes", "mapped_genes"]
MOUSE = ["mouse_gene", "mouse_ncbi_gene_id", "mgi_marker_id", "mouse_allele", "mgi_allele_id", "allele_name", "allele_type", "allelic_composition", "genetic_background", "phenotype_id", "phenotype_label", "phenotype_definition", "phenotype_source", "evidence_detail", "pubmed_ids", "mgi_genotype_id"]

# What evidence rows say of where they come from.
REVIEW, NOT_REPORTED = "ClinVar aggregate classification; review status: ", "not reported"
BY_TERM, TERM_DETAIL = "MGI_MP", "Specific MP annotation from MGI_GenePheno"
BY_NAME, NAME_DETAIL = "MGI_allele_name", "MGI phenotypic allele name; original reference "

#: Columns of a link (fixed values: a published table), and what the mouse side's columns are called there.
LINKS = ["category_id", "subcategory_id", "connection_basis", "human_gene", "human_ncbi_gene_id", "rs_id", "human_variant_source", "human_source_record_id", "human_chromosome", "human_position", "human_phenotype_id", "human_phenotype_label", "human_evidence_class", "human_evidence_detail", "human_p_value", "human_publication_id", "human_clinical_significance", "mouse_gene", "mouse_ncbi_gene_id", "mgi_marker_id", "mouse_allele", "mgi_allele_id", "allele_name", "allele_type", "allelic_composition", "genetic_background", "mouse_phenotype_id", "mouse_phenotype_label", "mouse_phenotype_definition", "mouse_phenotype_source", "mouse_evidence_detail", "mouse_pubmed_ids", "mgi_genotype_id", "ortholog_source", "within_tier_support", "match_method", "matched_concept", "shared_informative_tokens", "token_jaccard", "interpretation"]
RENAMED = {c: f"mouse_{c}" for c in ("phenotype_id", "phenotype_label", "phenotype_definition", "phenotype_source", "evidence_detail", "pubmed_ids")}


def enrich_orthologs(orthologs: DataFrame, nomenclature: DataFrame) -> DataFrame:
    """Orthologs with the Ensembl id of their (last) nomenclature row, '' without one."""
    names = last_wins(nomenclature, ["hgnc_id"], ["_ord"]).select("hgnc_id", F.col("ensembl_gene_id").alias("human_ensembl_gene_id"))
    return orthologs.join(names, "hgnc_id", "left").na.fill("", ["human_ensembl_gene_id"])


def _named(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select("_ord", *(columns.get(c, F.lit("")).cast("string").alias(c) for c in HUMAN))


def variant_conditions(vcf: DataFrame, orthologs: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Variants x genes x rs ids x (condition label, ids by position); the first of equal rows stays."""
    info = {k: X.decoded_info("info", k) for k in ("RS", "GENEINFO", "CLNDISDB", "CLNDN", "CLNSIG", "CLNREVSTAT")}
    rows = vcf.select("_ord", "chrom", "pos", "id", "ref", "alt", *(v.alias(k) for k, v in info.items()))
    rows = rows.where(X.accepted_significance("CLNSIG", settings.significance)).withColumn("rs", X.rs_numbers("RS")).where(F.size("rs") > 0)
    pairs = last_wins(orthologs, ["human_gene"], ["_ord"]).select("human_gene", F.col("human_ncbi_gene_id").alias("ncbi"))
    rows = rows.select("*", F.explode(X.gene_list("GENEINFO")).alias("gene")).withColumn("human_gene", F.col("gene.symbol")).join(pairs, "human_gene")
    ids = F.transform(F.split("CLNDISDB", ","), lambda g: F.array_join(X.disease_ids(g), "|"))
    rows = rows.select("*", F.posexplode(X.zip_labels(X.condition_labels("CLNDN"), ids)).alias("at", "condition"))
    rows = rows.where((F.col("condition.label") != "") & (F.lower("condition.label") != "not provided")).select("*", F.posexplode("rs").alias("rs_at", "rs_id"))
    out = _named(
        rows.withColumn("_ord", F.struct("_ord", "at", "rs_at")),
        human_gene=F.col("human_gene"), human_ncbi_gene_id=F.col("ncbi"), rs_id=F.col("rs_id"), chromosome=F.col("chrom"), position=F.col("pos"), reference_allele=F.col("ref"), alternate_allele=F.col("alt"), variant_source=F.lit("ClinVar"), source_record_id=F.col("id"),
        phenotype_id=F.col("condition.id"), phenotype_label=F.col("condition.label"), evidence_class=F.lit("clinvar_supported"), evidence_detail=F.concat(F.lit(REVIEW), X.first_text(X.display_value("CLNREVSTAT"), F.lit(NOT_REPORTED))), clinical_significance=X.display_value("CLNSIG"), condition_identifiers=F.col("condition.id"),
    )
    return first_wins(out, ["human_gene", "rs_id", "source_record_id", "phenotype_id", "phenotype_label"], ["_ord"])


def association_evidence(associations: DataFrame, orthologs: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Associations with p up to the limit (blank p counts as 0), by Ensembl gene and rs id."""
    p = X.number_or("P-VALUE", 0.0)
    rows = associations.withColumn("p", p).where(F.col("p") <= settings.max_p_value)
    genes = last_wins(orthologs.where("human_ensembl_gene_id <> ''"), ["human_ensembl_gene_id"], ["_ord"]).select("human_ensembl_gene_id", "human_gene", "human_ncbi_gene_id")
    rs = X.extracted(F.concat_ws(" ", "SNPS", "STRONGEST SNP-RISK ALLELE"), "(?i)rs[0-9]+", lower=True)
    rows = rows.select("*", F.posexplode(X.extracted("SNP_GENE_IDS", "ENSG[0-9]+")).alias("g_at", "human_ensembl_gene_id")).join(genes, "human_ensembl_gene_id")
    rows = rows.select("*", F.posexplode(rs).alias("r_at", "rs_id")).withColumn("label", X.first_text("MAPPED_TRAIT", "DISEASE/TRAIT")).where("label <> ''")
    out = _named(
        rows.withColumn("key_p", F.col("p")).withColumn("_ord", F.struct("_ord", "g_at", "r_at")),
        human_gene=F.col("human_gene"), human_ncbi_gene_id=F.col("human_ncbi_gene_id"), rs_id=F.col("rs_id"), chromosome=F.col("CHR_ID"), position=F.col("CHR_POS"), variant_source=F.lit("GWAS_Catalog"), source_record_id=F.col("STUDY ACCESSION"),
        phenotype_id=F.col("MAPPED_TRAIT_URI"), phenotype_label=F.col("label"), evidence_class=F.lit("gwas_significant"), evidence_detail=F.col("DISEASE/TRAIT"), p_value=F.col("P-VALUE"), publication_id=F.when(F.col("PUBMEDID") != "", F.concat(F.lit("PMID:"), "PUBMEDID")).otherwise(""), condition_identifiers=F.col("MAPPED_TRAIT_URI"), reported_genes=F.col("REPORTED GENE(S)"), mapped_genes=F.col("MAPPED_GENE"),
    ).withColumn("key_p", X.number_or("p_value", 0.0))
    return first_wins(out, ["source_record_id", "human_gene", "rs_id", "phenotype_label", "key_p"], ["_ord"]).drop("key_p")


def human_evidence(*parts: DataFrame) -> DataFrame:
    """Evidence of several kinds as one table."""
    out = parts[0].select(*HUMAN)
    for p in parts[1:]:
        out = out.unionByName(p.select(*HUMAN))
    return out


ALLELE = ["allele_id", "symbol", "allele_name", "allele_type", "reference", "marker_id"]


def known_alleles(genotypes: DataFrame, alleles: DataFrame) -> DataFrame:
    """Each genotype (unique _ord) with known: its listed alleles that ``alleles`` has, in the order of the list."""
    listed = genotypes.select("_ord", F.posexplode(X.pipe_list("mgi_allele_id")).alias("at", "allele_id"))
    found = listed.join(alleles.select(*(F.col(c) if c in alleles.columns else F.lit("").alias(c) for c in ALLELE)), "allele_id")
    lists = found.groupBy("_ord").agg(F.array_sort(F.collect_list(F.struct("at", *ALLELE))).alias("known"))
    return genotypes.join(lists, "_ord", "left")


def primary_allele(genotypes: DataFrame, alleles: DataFrame) -> DataFrame:
    """Each genotype (unique _ord) with its primary allele: the first listed whose marker fits, else the first known, else none."""
    rows = known_alleles(genotypes, alleles)
    fits = F.filter("known", lambda a: a["marker_id"] == F.col("mgi_marker_id"))
    return rows.withColumn("primary", F.coalesce(F.get(fits, F.lit(0)), F.get("known", F.lit(0))))


def mouse_evidence(genotypes: DataFrame, orthologs: DataFrame, alleles: DataFrame, terms: DataFrame, ordered: bool = False) -> DataFrame:
    """Evidence by phenotype term, and by the name of each known allele, from one scan of the genotypes; with its place as _ord if ``ordered``."""
    rows = genotypes.where(X.single_marker("marker_ids")).withColumn("mgi_marker_id", F.element_at(X.pipe_list("marker_ids"), 1))
    rows = rows.join(last_wins(orthologs, ["mgi_marker_id"], ["_ord"]).select("mgi_marker_id", "mouse_gene", "mouse_ncbi_gene_id"), "mgi_marker_id")
    rows = primary_allele(rows, alleles)
    place = lambda at: [F.struct("_ord", at.cast("int").alias("kind")).alias("_ord")] if ordered else []
    shape = lambda df, at, **c: df.select(*place(at), *(c.get(n, F.col(n) if n in df.columns else F.lit("")).cast("string").alias(n) for n in MOUSE))
    by_term = rows.join(terms.where("mp_label <> ''").select("mp_id", "mp_label", "mp_definition"), "mp_id")
    by_term = first_wins(by_term, ["mouse_gene", "mgi_allele_id", "genetic_background", "mp_id", "mgi_genotype_id"], ["_ord"])
    own = lambda c: F.coalesce(f"primary.{c}", F.lit(""))
    one = shape(by_term, F.lit(0), allele_name=own("allele_name"), allele_type=own("allele_type"), phenotype_id=F.col("mp_id"), phenotype_label=F.col("mp_label"), phenotype_definition=F.coalesce("mp_definition", F.lit("")), phenotype_source=F.lit(BY_TERM), evidence_detail=F.lit(TERM_DETAIL))
    named = rows.select("*", F.explode("known").alias("a")).where("a.allele_name <> ''")
    named = named.withColumn("mgi_allele_id", F.col("a.allele_id")).withColumn("mouse_allele", X.first_text("a.symbol", "mouse_allele"))
    by_name = first_wins(named, ["mouse_gene", "mgi_allele_id", "genetic_background", "mgi_genotype_id"], ["_ord", "a.at"])
    detail = F.concat(F.lit(NAME_DETAIL), X.first_text("a.reference", F.lit(NOT_REPORTED)))
    two = shape(by_name, F.col("a.at") + 1, allele_name=F.col("a.allele_name"), allele_type=F.col("a.allele_type"), phenotype_label=F.col("a.allele_name"), phenotype_source=F.lit(BY_NAME), evidence_detail=detail)
    return one.unionByName(two)


#: Labels of an index entry that meet in one task; hash buckets that tokens are weighed in, a byte each; rows in one list of ids.
ROWS, BUCKETS, IDS = 4096, 65536, 1024


def _weights(tokens: DataFrame) -> bytes:
    """For each bucket of (gene, token), eight times the binary logarithm of its labels, rounded up. One number a bucket comes to the driver."""
    out = bytearray(BUCKETS)
    for bucket, labels in tokens.groupBy(_bucket("gene", "token").alias("bucket")).agg(F.count("*").alias("labels")).collect():
        out[bucket] = min(255, math.ceil(8 * math.log2(labels)))
    return bytes(out)


def _bucket(gene: Column | str, token: Column | str) -> Column:
    return F.pmod(F.xxhash64(gene, token), F.lit(BUCKETS)).cast("int")


def _half(bits: Column, low: int) -> Column:
    """Those of the numbers that are in [low, low + 64) as bits of a long."""
    bit = lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b - low)
    return F.aggregate(bits, F.lit(0).cast("long"), lambda x, b: x.bitwiseOR(F.when((b >= low) & (b < low + 64), bit(b)).otherwise(F.lit(0).cast("long"))))


def graded_labels(left: DataFrame, right: DataFrame, settings: Settings = DEFAULT, aliases: dict[str, str] = ALIASES, rows: int = ROWS) -> DataFrame:
    """Graded matches of different normal labels within a gene, each once. Both sides have gene, label.

    Support B: equal non-empty normal labels. Support C: enough shared informative
    tokens and a large enough Jaccard. Distinct labels are compared once, through an
    index of (gene, token). A label of n tokens is in the index by its rarest n - m + 1
    ones only, m being how many it must share at least: two labels that share m tokens
    have one of those in common, and a token that most labels of a gene have brings no
    candidates. Tokens are weighed by hash buckets: any one order of a gene's tokens gives
    all pairs. An entry has no tokens but 128 bits of their hashes: a bit that only one of
    two labels has is a token that they don't share, so that these bound what they can
    share. Pairs within that bound meet with their labels and are judged by their tokens.
    An entry of more than ``rows`` labels is dealt to squares of so many a side.
    Returns gene, l_norm, r_norm, support, method, shared_tokens, token_jaccard.
    """
    # Written once: a label's number is that of the file.
    labels = _sides(left, right, aliases).groupBy("gene", "norm").agg(F.bit_or("side").alias("side")).withColumn("label", F.monotonically_increasing_id())
    return _graded(written(labels, "labels"), settings, aliases, rows).drop("l_label", "r_label")


def _sides(left: DataFrame, right: DataFrame, aliases: dict[str, str], more: tuple[list[Column], list[Column]] = ([], [])) -> DataFrame:
    """The rows of both with a normal label and ``more`` of each; side is 1, 2, or 3 where both are one table."""
    normal = lambda df, side: df.select("gene", X.normal_label("label", aliases).alias("norm"), F.lit(side).alias("side"), *more[side == 2]).where("gene IS NOT NULL AND norm <> ''")
    return normal(left, 3) if left is right else normal(left, 1).unionByName(normal(right, 2))


def _graded(labels: DataFrame, settings: Settings, aliases: dict[str, str], rows: int) -> DataFrame:
    """``graded_labels`` of a written table of different labels (gene, norm, side, label), with the numbers of both."""
    least_j, least_n = settings.min_jaccard, settings.min_shared_tokens
    informative = lambda norm: X.informative(F.split(norm, " "), settings.uninformative, aliases)
    least = F.greatest(F.lit(least_n), F.ceil(F.col("size") * least_j - 1e-9).cast("int"))
    sized = labels.withColumn("tokens", informative("norm")).withColumn("size", F.size("tokens")).where(F.col("size") >= least)
    weights = F.lit(_weights(sized.select("gene", F.explode("tokens").alias("token"))))
    ranked = F.array_sort(F.transform("tokens", lambda t: F.struct(F.substring(weights, _bucket("gene", t) + 1, 1).alias("weight"), F.xxhash64("gene", t).alias("key"))))
    bits = F.transform("tokens", lambda t: F.pmod(F.xxhash64(t), F.lit(128)).cast("int"))
    entries = sized.select("label", "side", "size", _half(bits, 0).alias("low"), _half(bits, 64).alias("high"), F.explode(F.slice(ranked, 1, F.col("size") - least + 1)).alias("e"))
    # A bucket has no fewer labels than each of its entries.
    squares = F.ceil(F.pow(F.lit(2.0), F.conv(F.hex("e.weight"), 16, 10).cast("int") / 8) / rows).cast("int")
    entries = entries.select("*", F.pmod(F.xxhash64("label"), squares).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), squares - 1)).alias("other"))
    entries = entries.select(F.col("e.key").alias("key"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "label", "side", "size", "low", "high")
    x, y = entries.alias("x"), entries.alias("y")
    c = F.col
    # Labels of one block meet in its own square only.
    met = x.join(y, (c("x.key") == c("y.key")) & (c("x.i") == c("y.i")) & (c("x.j") == c("y.j")) & (c("x.label") < c("y.label")) & ((c("x.own") != c("y.own")) | (c("x.i") == c("x.j"))))
    faces = lambda a, b: (c(f"{a}.side").bitwiseAND(F.lit(1)) != 0) & (c(f"{b}.side").bitwiseAND(F.lit(2)) != 0)
    met = met.where(faces("x", "y") | faces("y", "x")).where(F.least("x.size", "y.size") >= F.greatest("x.size", "y.size") * least_j - 1e-9)
    alone = lambda a, b: sum(F.bit_count(c(f"{a}.{h}").bitwiseAND(F.bitwise_not(f"{b}.{h}"))) for h in ("low", "high"))
    most = F.least(c("x.size") - alone("x", "y"), c("y.size") - alone("y", "x"))
    met = met.where((most >= least_n) & (most * (1 + least_j) >= (c("x.size") + c("y.size")) * least_j - 1e-6))
    # Written, so that their size is known: a few pairs go to the labels, not the labels to them.
    pairs = written(met.select(c("x.label").alias("a"), c("y.label").alias("b")).distinct(), "pairs")
    named = lambda k: labels.select(*(c(n).alias(v) for n, v in (("label", k), ("gene", f"{k}_gene"), ("norm", f"{k}_norm"), ("side", f"{k}_side"))))
    near = pairs.join(named("a"), "a").join(named("b"), "b").where("a_gene = b_gene")
    ways = F.array(*(F.struct(c(k).alias("l_label"), c(o).alias("r_label"), c(f"{k}_norm").alias("l_norm"), c(f"{o}_norm").alias("r_norm"), ((c(f"{k}_side").bitwiseAND(F.lit(1)) != 0) & (c(f"{o}_side").bitwiseAND(F.lit(2)) != 0)).alias("faces")) for k, o in (("a", "b"), ("b", "a"))))
    near = near.select(c("a_gene").alias("gene"), F.explode(ways).alias("w")).where("w.faces").select("gene", "w.l_label", "w.r_label", "w.l_norm", "w.r_norm").withColumn("l", informative("l_norm")).withColumn("r", informative("r_norm")).withColumn("both", F.array_intersect("l", "r"))
    near = near.withColumn("jaccard", F.size("both") / (F.size("l") + F.size("r") - F.size("both"))).where((F.size("both") >= least_n) & (c("jaccard") >= least_j))
    graded = lambda df, support, method, words, jaccard: df.select("l_label", "r_label", "gene", "l_norm", "r_norm", F.lit(support).alias("support"), F.lit(method).alias("method"), words.alias("shared_tokens"), X.fixed3(jaccard).alias("token_jaccard"))
    equal = labels.where("side = 3").select(c("label").alias("l_label"), c("label").alias("r_label"), "gene", c("norm").alias("l_norm"), c("norm").alias("r_norm"))
    return graded(near, "C", "controlled_lexical_overlap", F.array_join("both", "|"), c("jaccard")).unionByName(graded(equal, "B", "exact_normalized_label", c("l_norm"), F.lit(1.0)))


def label_matches(left: DataFrame, right: DataFrame, settings: Settings = DEFAULT, aliases: dict[str, str] = ALIASES, rows: int = ROWS) -> DataFrame:
    """Rows of both sides (gene, id, label) whose labels match by ``graded_labels``. Ids are written with the labels, in lists
    of up to ``IDS``, and come back by a label's number, so that what is joined does not grow with the pairs. Returns gene,
    left_id, right_id, support, method, shared_tokens, token_jaccard."""
    label, one = Window.partitionBy("gene", "norm"), F.struct("id")
    empty = lambda df: F.lit(None).cast(df.select(one.alias("row")).schema["row"].dataType)
    more = ([one.alias("l_row"), *([] if left is right else [empty(right).alias("r_row")])], [empty(left).alias("l_row"), one.alias("r_row")])
    held = {"l_rows": "l_row"} if left is right else {"l_rows": "l_row", "r_rows": "r_row"}
    # Any order of a label's rows: lists need only be short.
    lists = _sides(left, right, aliases, more).withColumn("list", F.floor((F.row_number().over(label.orderBy(F.lit(0))) - 1) / IDS))
    lists = lists.groupBy("gene", "norm", "list").agg(F.bit_or("side").alias("side"), *(F.collect_list(v).alias(k) for k, v in held.items())).withColumn("number", F.monotonically_increasing_id())
    lists = written(lists.withColumn("label", F.min("number").over(label)).withColumn("side", F.bit_or("side").over(label)).drop("number"), "lists")
    rows_of = lambda side, rows: lists.select(F.col("label").alias(f"{side}_label"), F.col(rows).alias(f"{side}_rows"))
    out = _graded(lists.where("list = 0").select("gene", "norm", "side", "label"), settings, aliases, rows)
    out = out.join(rows_of("l", "l_rows"), "l_label").join(rows_of("r", list(held)[-1]), "r_label")
    kept = ["gene", "support", "method", "shared_tokens", "token_jaccard"]
    out = out.select(*kept, "r_rows", F.explode("l_rows").alias("l")).select(*kept, "l", F.explode("r_rows").alias("r"))
    return out.select("gene", F.col("l.id").alias("left_id"), F.col("r.id").alias("right_id"), "support", "method", "shared_tokens", "token_jaccard")


def jaccard_pairs(labels: DataFrame, rows: int = 128, ids: int = 64) -> DataFrame:
    """Every two rows (gene, id, tokens) of a gene whose ids differ, once: left_id, the smaller one, right_id, the tokens that they
    share and their Jaccard in three decimals, whatever it is (0.000 of nothing). Tokens are different ones. Where those of left_id
    are null, so are both numbers; null ones of right_id are none.

    Rows with equal tokens are one label with its ids in lists of up to ``ids``: tokens are compared by list, and ids come
    together after that. The lists of a gene are dealt to squares of ``rows`` a side.
    """
    label = Window.partitionBy("gene", "tokens")
    lists = labels.where("gene IS NOT NULL AND id IS NOT NULL").select("gene", "id", F.array_sort("tokens").alias("tokens"))
    lists = lists.withColumn("list", F.floor((F.row_number().over(label.orderBy(F.lit(0))) - 1) / ids)).groupBy("gene", "tokens", "list").agg(F.collect_list("id").alias("ids"))
    # Written once: a list's number is that of the file.
    lists = written(lists.select("gene", "tokens", "ids", F.monotonically_increasing_id().alias("number")), "lists")
    squares = lists.groupBy("gene").agg(F.ceil(F.count("*") / rows).cast("int").alias("squares"))
    entries = lists.join(squares, "gene").select("*", F.pmod(F.xxhash64("number"), "squares").cast("int").alias("own"), F.explode(F.sequence(F.lit(0), F.col("squares") - 1)).alias("other"))
    keys = ["gene", "i", "j"]
    entries = entries.select("gene", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "number", "tokens", "ids")
    # Few bytes become many pairs: a number of partitions that is given is not made smaller by what they weigh.
    entries = entries.repartition(int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    x, y, c = entries.alias("x"), entries.alias("y"), F.col
    # Lists of one block meet in its own square only.
    met = x.join(y, [c(f"x.{k}") == c(f"y.{k}") for k in keys] + [c("x.number") <= c("y.number"), (c("x.own") != c("y.own")) | (c("x.i") == c("x.j"))])
    tokens = lambda side: F.coalesce(c(f"{side}.tokens"), F.array().cast("array<string>"))
    known = [c(f"{side}.tokens").isNotNull().alias(f"{k}_known") for side, k in (("x", "l"), ("y", "r"))]
    met = met.select(c("x.ids").alias("l"), c("y.ids").alias("r"), (c("x.number") == c("y.number")).alias("same"), *known, (F.size(tokens("x")) + F.size(tokens("y"))).alias("both"), F.size(F.array_intersect(tokens("x"), tokens("y"))).alias("shared"))
    kept = ["same", "l_known", "r_known", "shared", "jaccard"]
    met = met.select("l", "r", *kept[:3], c("shared").cast("long").alias("shared"), X.ratio3("shared", c("both") - c("shared")).alias("jaccard"))
    out = met.select("r", *kept, F.explode("l").alias("l")).select("l", *kept, F.explode("r").alias("r")).where("l < r OR (l > r AND NOT same)")
    shown = lambda k: F.when(F.when(c("l") < c("r"), c("l_known")).otherwise(c("r_known")), c(k)).alias(k)
    return out.select(F.least("l", "r").alias("left_id"), F.greatest("l", "r").alias("right_id"), shown("shared"), shown("jaccard"))


def interpretation(support: Column) -> Column:
    """What a grade says; the retired grade A raises."""
    return (
        F.when(support == "A", F.raise_error(F.lit("support A is retired")))
        .when(support == "B", SAYS_B)
        .otherwise(SAYS_C)
    )


def link_sides(human: DataFrame, mouse: DataFrame, orthologs: DataFrame, settings: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Human rows of the classes that count with a label, and mouse rows with their human_gene; the last ortholog row of a mouse gene counts."""
    pairs = last_wins(orthologs, ["mouse_gene"], ["_ord"]).select("human_gene", "mouse_gene")
    return human.where(F.col("evidence_class").isin(*settings.evidence_classes) & (F.col("phenotype_label") != "")), mouse.join(pairs, "mouse_gene")


def lexical_links(human: DataFrame, mouse: DataFrame, orthologs: DataFrame, settings: Settings = DEFAULT, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Evidence rows of orthologous genes whose labels match; the last ortholog row of a mouse gene counts."""
    h, m = link_sides(human, mouse, orthologs, settings)
    h = h.withColumn("id", F.struct(*HUMAN)).select(F.col("human_gene").alias("gene"), "id", F.col("phenotype_label").alias("label"))
    m = m.withColumn("id", F.struct(*MOUSE)).select(F.col("human_gene").alias("gene"), "id", F.col("phenotype_label").alias("label"))
    found = label_matches(h, m, settings, aliases)
    out = found.select("left_id.*", *(F.col(f"right_id.{c}").alias(RENAMED.get(c, c)) for c in MOUSE), F.col("support").alias("within_tier_support"), F.col("method").alias("match_method"), F.col("shared_tokens").alias("shared_informative_tokens"), "token_jaccard", interpretation(F.col("support")).alias("interpretation"))
    given = {"category_id": "category2", "subcategory_id": "category2-1", "connection_basis": "ortholog_constrained_phenotype_evidence", "ortholog_source": ORTHOLOG_SOURCE, "matched_concept": ""}
    return out.select(*(F.lit(given[c]).alias(c) if c in given else F.col(c.removeprefix("human_") if c not in out.columns else c).alias(c) for c in LINKS))
