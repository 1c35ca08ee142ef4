"""What each step counts: rows that came in, passed each condition, were met and came out, and exact numbers of different entities.

Every function returns (name, n); a dot in a name stands for nesting in the written statistics. Counts come
from tables that a step has written, several in one aggregate, so that no source is read again for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.operators.keys import last_wins
from linkloom.plans import disease, lexical
from linkloom.plans.bridge import accepted_mappings, bridge_keys
from linkloom.session import written
from linkloom.settings import ALIASES, DEFAULT, BridgeRoute, Settings


def counted(df: DataFrame, **counts: Column) -> DataFrame:
    """The named aggregates of a table, in one pass, as rows; a double underscore in a name is a dot."""
    one = df.agg(*(F.coalesce(c.cast("long"), F.lit(0)).alias(k) for k, c in counts.items()))
    pairs = F.array(*(F.struct(F.lit(k.replace("__", ".")).alias("name"), F.col(k).alias("n")) for k in counts))
    return one.select(F.explode(pairs).alias("x")).select("x.name", "x.n")


def by_value(df: DataFrame, prefix: str, column: str, where: Column | None = None, values: tuple[str, ...] = ()) -> DataFrame:
    """Rows of each value of a column; those of ``values`` are there with 0 where no row has them."""
    rows = df if where is None else df.where(where)
    found = rows.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    if values:
        every = df.sparkSession.createDataFrame([(v, 0) for v in values], "v string, n long")
        found = found.unionByName(every).groupBy("v").agg(F.sum("n").alias("n"))
    return found.select(F.concat(F.lit(prefix + "."), "v").alias("name"), "n")


def together(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rows_of(df: DataFrame, name: str) -> DataFrame:
    return counted(df, **{name: F.count("*")})


def nested(rows: DataFrame, **seen: int) -> dict:
    """The counts of a step (some tens of lines), nested by the dots of their names, with those that were seen on the way; a double underscore is a dot."""
    out: dict = {}
    for name, n in [*((r["name"], r["n"]) for r in rows.collect()), *((k.replace("__", "."), n) for k, n in seen.items())]:
        *above, last = name.split(".")
        place = out
        for k in above:
            place = place.setdefault(k, {})
        place[last] = n
    return out


def different(*columns: str, **named: str) -> dict[str, Column]:
    """Exact numbers of different values, as unique.name."""
    return {f"unique__{k}": F.count_distinct(c) for k, c in {**{c: c for c in columns}, **named}.items()}


def variant_funnel(vcf: DataFrame, orthologs: DataFrame, human: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Variants with an rs id, of those with a gene that has an ortholog, of those with an accepted class, and with a link to a
    phenotype; ``human`` is ``variant_phenotypes`` with _ord. Each of them once."""
    info = {k: X.decoded_info("info", k) for k in ("RS", "GENEINFO", "CLNSIG")}
    rows = vcf.select("_ord", *(v.alias(k) for k, v in info.items())).where(F.size(X.rs_numbers("RS")) > 0)
    known = rows.select("_ord", X.accepted_significance("CLNSIG", settings.significance).alias("accepted"), F.explode(X.gene_list("GENEINFO")).alias("g"))
    known = known.join(orthologs.select(F.col("human_gene").alias("_g")).distinct(), F.col("g.symbol") == F.col("_g"), "left_semi").groupBy("_ord").agg(F.first("accepted").alias("accepted"))
    return together(
        counted(rows, humanVariants__variantsWithRsid=F.count("*")),
        counted(known, humanVariants__variantsWithOrtholog=F.count("*"), humanVariants__variantsWithAcceptedSignificance=F.count_if("accepted")),
        counted(human, humanVariants__variantsWithHpoBridge=F.count_distinct("_ord"), humanVariants__retainedRows=F.count("*")),
    )


def bridge_preparation(merged: DataFrame, noted: DataFrame, orthologs: DataFrame, genotypes: DataFrame, alleles: DataFrame, vcf: DataFrame, human: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Counts of the bridge's tables: mappings, annotations, orthologs, alleles, variants."""
    return together(
        counted(merged, hpoMp__uniqueRows=F.count("*"), hpoMp__uniqueHpoTerms=F.count_distinct("hpo_id"), hpoMp__uniqueMpTerms=F.count_distinct("mp_id")),
        counted(noted, hpoAnnotations__retainedRows=F.count("*"), hpoAnnotations__diseasesWithMappedPhenotypes=F.count_distinct("disease_id")),
        rows_of(orthologs, "orthologs__oneToOnePairs"),
        counted(genotypes, mousePhenotypes__totalRows=F.count("*"), mousePhenotypes__singleGeneRows=F.count_if(X.single_marker("marker_ids"))),
        rows_of(alleles, "mousePhenotypes__retainedRows"),
        variant_funnel(vcf, orthologs, human, settings),
    )


def bridge_mapping(human: DataFrame, merged: DataFrame, orthologs: DataFrame, alleles: DataFrame, links: DataFrame, route: BridgeRoute) -> DataFrame:
    """Counts of a bridge route from its links: what each side offers to the human rows, and what came out."""
    made = counted(links, mousePhenotypeCandidateRows=F.count("*"), finalRows=F.count("*"), **different(humanVariants="rs_id", humanGenes="human_gene", mouseGenes="mouse_gene", hpoTerms="hpo_id", mpTerms="mp_id"))
    return together(_bridge_rows(human, merged, orthologs, alleles, route), made)


def bridge_mapping_of(human: DataFrame, merged: DataFrame, orthologs: DataFrame, alleles: DataFrame, route: BridgeRoute) -> DataFrame:
    """What ``bridge_mapping`` counts, where no links are there: a key has the product of its rows, mappings and ortholog rows as links."""
    bridge = accepted_mappings(merged, route)
    keys = written(bridge_keys(human, orthologs, bridge, alleles), "keys")
    mapped = bridge.groupBy("hpo_id", "mp_id").agg(F.count("*").alias("b"))
    links = F.sum(F.col("h") * F.col("p") * F.col("m") * F.col("b"))
    variants = human.join(keys.select("human_gene", "hpo_id").distinct(), ["human_gene", "hpo_id"], "left_semi")
    return together(
        _bridge_rows(human, merged, orthologs, alleles, route),
        counted(keys.join(mapped, ["hpo_id", "mp_id"]), mousePhenotypeCandidateRows=links, finalRows=links, **different(humanGenes="human_gene", mouseGenes="mouse_gene", hpoTerms="hpo_id", mpTerms="mp_id")),
        counted(variants, **different(humanVariants="rs_id")),
    )


def _bridge_rows(human: DataFrame, merged: DataFrame, orthologs: DataFrame, alleles: DataFrame, route: BridgeRoute) -> DataFrame:
    bridge = accepted_mappings(merged, route)
    offers = lambda other, key: human.groupBy(key).agg(F.count("*").alias("h")).join(other.groupBy(key).agg(F.count("*").alias("o")), key)
    return together(
        rows_of(bridge, "acceptedHpoMpRows"),
        rows_of(alleles, "indexedMouseRows"),
        rows_of(orthologs, "indexedOrthologRows"),
        rows_of(human, "humanVariantHpoRows"),
        counted(offers(bridge, "hpo_id"), hpoMpCandidateRows=F.sum(F.col("h") * F.col("o"))),
        counted(offers(orthologs, "human_gene"), orthologGeneCandidateRows=F.sum(F.col("h") * F.col("o"))),
    )


def evidence_preparation(human: DataFrame, mouse: DataFrame, orthologs: DataFrame, alleles: DataFrame, terms: DataFrame, vcf: DataFrame) -> DataFrame:
    """Counts of the evidence tables; identities are the different (gene, rs id) of all variants, of any class."""
    info = {k: X.decoded_info("info", k) for k in ("RS", "GENEINFO")}
    pairs = vcf.select(*(v.alias(k) for k, v in info.items())).select(F.explode(X.gene_list("GENEINFO")).alias("g"), X.rs_numbers("RS").alias("rs"))
    pairs = pairs.join(orthologs.select(F.col("human_gene").alias("_g")).distinct(), F.col("g.symbol") == F.col("_g"), "left_semi").select(F.col("g.symbol").alias("gene"), F.explode("rs").alias("rs"))
    source = lambda c, v: F.count_if(F.col(c) == v)
    return together(
        counted(human, clinvar__rows=source("variant_source", "ClinVar"), gwas__rows=source("variant_source", "GWAS_Catalog"), uniqueHumanVariants=F.count_distinct("rs_id")),
        counted(mouse, mouse__mpRows=source("phenotype_source", "MGI_MP"), mouse__alleleNameRows=source("phenotype_source", "MGI_allele_name")),
        rows_of(orthologs, "orthologPairs"),
        rows_of(alleles, "alleleMetadata"),
        rows_of(terms, "mpVocabulary"),
        rows_of(pairs.distinct(), "clinvar__identities"),
    )


def candidate_comparisons(left: DataFrame, right: DataFrame, settings: Settings = DEFAULT, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """candidateComparisons: row pairs of a gene whose normal labels are equal or share an informative token (both sides: gene, label).

    Different labels are compared once and weigh as many rows as have them; a pair counts under the least token that it shares.
    """

    def labels(df: DataFrame, side: str) -> DataFrame:
        norm, tokens = X.normal_label("label", aliases), X.informative_tokens("label", settings.uninformative, aliases)
        # Equal texts are normalised once.
        texts = df.groupBy("gene", "label").agg(F.count("*").alias("rows"))
        return texts.groupBy("gene", norm.alias(f"{side}_norm")).agg(F.sum("rows").alias(f"{side}_rows"), F.any_value(tokens).alias(f"{side}_tokens"))

    l, r = labels(left, "l"), labels(right, "r")
    equal = l.join(r, (l.gene == r.gene) & (l.l_norm == r.r_norm)).select(F.col("l_rows") * F.col("r_rows"))
    met = l.withColumn("token", F.explode("l_tokens")).join(r.withColumn("token", F.explode("r_tokens")), ["gene", "token"])
    met = met.where((F.col("l_norm") != F.col("r_norm")) & (F.array_min(F.array_intersect("l_tokens", "r_tokens")) == F.col("token"))).select(F.col("l_rows") * F.col("r_rows"))
    return counted(equal.union(met).toDF("n"), candidateComparisons=F.sum("n"))


def lexical_mapping(human: DataFrame, mouse: DataFrame, orthologs: DataFrame, links: DataFrame, settings: Settings = DEFAULT, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Counts of the label route from its links."""
    return together(
        _lexical_rows(human, orthologs, *_lexical_sides(human, mouse, orthologs, settings), settings, aliases),
        counted(links, finalRows=F.count("*"), **different(humanVariants="rs_id", humanGenes="human_gene", mouseAlleles="mgi_allele_id", mouseGenes="mouse_gene")),
        by_value(links, "supportGrades", "within_tier_support", values=("A", "B", "C")),
        by_value(links, "methods", "match_method"),
    )


def lexical_mapping_of(human: DataFrame, mouse: DataFrame, orthologs: DataFrame, settings: Settings = DEFAULT, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """What ``lexical_mapping`` counts, where no links are there: two labels that match have the product of their rows as links."""
    used, indexed = (written(df, name) for df, name in zip(_lexical_sides(human, mouse, orthologs, settings), ("used", "indexed"), strict=True))
    # Equal texts are normalised once, and weigh as many rows as have them.
    texts = lambda df, norm: written(df.groupBy("gene", "label").agg(F.count("*").alias("n")).withColumn(norm, X.normal_label("label", aliases)), norm)
    h, m = texts(used, "l_norm"), texts(indexed, "r_norm")
    graded = written(lexical.graded_labels(h, m, settings, aliases), "graded")
    per = lambda df, norm, n: df.groupBy("gene", norm).agg(F.sum("n").alias(n))
    linked = lambda rows, df, norm: rows.join(df.join(graded, ["gene", norm], "left_semi"), ["gene", "label"], "left_semi")
    totals = graded.join(per(h, "l_norm", "h"), ["gene", "l_norm"]).join(per(m, "r_norm", "m"), ["gene", "r_norm"]).groupBy("support", "method").agg(F.sum(F.col("h") * F.col("m")).alias("n"))
    totals = written(totals, "totals")
    none = totals.sparkSession.createDataFrame([(g, 0) for g in ("A", "B", "C")], "support string, n long")
    of = lambda df, prefix, c: df.groupBy(F.concat(F.lit(prefix + "."), c).alias("name")).agg(F.sum("n").alias("n"))
    return together(
        _lexical_rows(human, orthologs, used, indexed, settings, aliases),
        counted(totals, finalRows=F.sum("n")),
        counted(linked(used, h, "l_norm"), **different(humanVariants="rs_id", humanGenes="gene")),
        counted(linked(indexed, m, "r_norm"), **different(mouseAlleles="mgi_allele_id", mouseGenes="mouse_gene")),
        of(totals.select("support", "n").unionByName(none), "supportGrades", "support"),
        of(totals, "methods", "method"),
    )


def _lexical_sides(human: DataFrame, mouse: DataFrame, orthologs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that have a label, with what is counted of their links."""
    h, m = lexical.link_sides(human, mouse, orthologs, settings)
    gene, label = F.col("human_gene").alias("gene"), F.col("phenotype_label").alias("label")
    return h.select(gene, label, "rs_id"), m.where("phenotype_label <> ''").select(gene, label, "mouse_gene", "mgi_allele_id")


def _lexical_rows(human: DataFrame, orthologs: DataFrame, used: DataFrame, indexed: DataFrame, settings: Settings, aliases: dict[str, str]) -> DataFrame:
    used = used.join(indexed.select("gene").distinct(), "gene", "left_semi")
    return together(
        rows_of(orthologs, "orthologPairs"),
        rows_of(indexed, "indexedMouseEvidenceRows"),
        rows_of(human, "humanEvidenceRows"),
        rows_of(used, "humanRowsWithOrtholog"),
        candidate_comparisons(used, indexed, settings, aliases),
    )


def disease_mapping(scanned: DataFrame, models: DataFrame, human: DataFrame, links: DataFrame, shared: DataFrame) -> DataFrame:
    """Counts of the route by shared identifiers from its links; ``shared`` is ``with_shared_disease``."""
    made = counted(links, finalRows=F.count("*"), **different(humanVariants="rs_id", genes="human_gene", mouseGenotypes="mgi_genotype_id", diseases="shared_disease_id"))
    return together(_disease_rows(scanned, models, human, shared), made)


def disease_mapping_of(scanned: DataFrame, models: DataFrame, human: DataFrame, prefix: str = "OMIM:") -> DataFrame:
    """What ``disease_mapping`` counts, where no links are there: from the rows of each side that have some."""
    h, m = disease.disease_linked(human, models, prefix)
    totals = disease.disease_counts(human, models, prefix)
    return together(
        _disease_rows(scanned, models, human, disease.with_shared_disease(human, models, prefix)),
        counted(totals, finalRows=F.sum("links"), **different(genes="human_gene", diseases="shared_disease_id")),
        counted(h, **different(humanVariants="rs_id")),
        counted(m, **different(mouseGenotypes="mgi_genotype_id")),
    )


def _disease_rows(scanned: DataFrame, models: DataFrame, human: DataFrame, shared: DataFrame) -> DataFrame:
    return together(
        rows_of(scanned, "diseaseRowsScanned"),
        rows_of(models, "uniqueMouseDiseaseModels"),
        rows_of(human, "humanEvidenceRows"),
        counted(shared, humanRowsWithSharedDisease=F.max("rows_with_shared_disease")),
    )


def semantic_mapping(found: DataFrame, genes: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Counts of the vector route; ``genes`` is ``gene_texts``."""
    default = F.col("eligible_for_default_use") == 1
    kept = counted(found, kept=F.count("*")).withColumnRenamed("n", "kept").drop("name")
    compared = genes.agg(F.count("*").alias("genes"), F.coalesce(F.sum("compared"), F.lit(0)).alias("compared")).crossJoin(F.broadcast(kept))  # one line each
    return together(
        by_value(found, "classes", "cosine_class", values=("A", "B", "C", "D")),
        by_value(found, "review_status", "review_status"),
        by_value(found, "default_use_review_status", "review_status", default),
        counted(found, default_use_rows=F.count_if(default), archive_only_rows=F.count_if(F.col("cosine_class") == "D"), direction_conflicts=F.sum("direction_conflict"), negations=F.sum("negation_flag")),
        counted(compared, orthologs_with_both_species_evidence=F.max("genes"), gene_constrained_text_comparisons=F.max("compared"), omitted_low_similarity_text_pairs=F.max(F.col("compared") - F.col("kept"))),
    )
