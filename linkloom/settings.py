"""Thresholds and word lists of a linkage run; every operator takes them as an argument."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields, replace

# Results depend on them.
SKOS_PREDICATES = ("skos:exactMatch", "skos:closeMatch", "skos:broadMatch", "skos:narrowMatch")
SIGNIFICANCE = ("Pathogenic", "Likely_pathogenic", "Pathogenic/Likely_pathogenic", "risk_factor", "association", "drug_response", "confers_sensitivity", "protective", "Affects")
UNINFORMATIVE = ("abnormal", "abnormality", "associated", "association", "disease", "disorder", "mouse", "phenotype", "response", "trait")
ALIASES = {"lps": "lipopolysaccharide", "endotoxin": "lipopolysaccharide", "hyporesponsiveness": "hyporesponsive", "responsiveness": "response", "responsive": "response"}
PLACEHOLDERS = ("not provided", "not specified", "not available", "unknown", "none")
UP_WORDS = ("increased", "elevated", "enhanced", "greater", "higher", "high")
DOWN_WORDS = ("decreased", "reduced", "diminished", "defective", "impaired", "blunted", "lower", "low", "absent", "loss", "hyporesponsive")
PHRASE_AUDITS = (
    ("hearing_paraphrase", "hearing loss", "hearing impairment", "related_example"),
    ("glucose_paraphrase", "increased blood glucose level", "elevated blood glucose concentration", "related_example"),
    ("opposite_glucose", "increased blood glucose level", "decreased blood glucose level", "opposite_direction"),
    ("different_stimulus", "decreased response to acoustic stimulation", "decreased response to tactile stimulation", "different_target"),
    ("unrelated_organ", "abnormal heart morphology", "abnormal kidney morphology", "different_organ"),
    ("negation", "hearing loss", "no hearing loss", "negated"),
)


@dataclass(frozen=True)
class BridgeRoute:
    """Which mappings of the bridge a route accepts, and how its rows are labelled."""

    subcategory: str
    basis: str
    predicates: tuple[str, ...]
    min_confidence: float
    sources: tuple[str, ...] = ()
    category: str = "category1"


@dataclass(frozen=True)
class Settings:
    predicates: tuple[str, ...] = SKOS_PREDICATES
    min_confidence: float = 0.8
    exclude_negated: bool = True
    aspect: str = "P"
    require_rsid: bool = True
    require_single_marker: bool = True
    significance: tuple[str, ...] = SIGNIFICANCE
    max_p_value: float = 5e-8
    min_shared_tokens: int = 2
    min_jaccard: float = 0.6
    evidence_classes: tuple[str, ...] = ("gwas_significant", "clinvar_supported")
    uninformative: tuple[str, ...] = UNINFORMATIVE
    band_a: float = 0.8
    band_b: float = 0.7
    band_c: float = 0.5
    top_k: int = 20
    default_bands: tuple[str, ...] = ("A", "B", "C")
    placeholders: tuple[str, ...] = PLACEHOLDERS
    revision: str = "1"

    def __post_init__(self):
        if not self.band_a > self.band_b > self.band_c:
            raise ValueError("band thresholds must descend")
        if self.top_k < 1 or self.min_shared_tokens < 1:
            raise ValueError("top_k and min_shared_tokens must be positive")

    def with_values(self, **values) -> "Settings":
        return replace(self, **values)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "Settings":
        known = {f.name: f for f in fields(cls)}
        values = json.loads(text)
        if unknown := set(values) - set(known):
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})

    @classmethod
    def from_configuration(cls, config: dict) -> "Settings":
        """The thresholds and lists of a run's configuration; its sections are those of ``validate_configuration``."""
        strict, first, vectors = config["strict_mapping"], config["ortholog_first_mapping"], config["semantic_mapping"]
        named = {
            "predicates": strict.get("accepted_predicates"), "min_confidence": strict.get("minimum_mapping_confidence"), "exclude_negated": strict.get("exclude_negated_hpo_annotations"), "aspect": strict.get("hpo_aspect"),
            "require_rsid": strict.get("require_rsid"), "significance": strict.get("accepted_clinvar_significance"), "require_single_marker": strict.get("require_single_gene_mouse_genotype"),
            "max_p_value": first.get("maximum_gwas_p_value"), "min_shared_tokens": first.get("minimum_informative_token_overlap"), "min_jaccard": first.get("minimum_token_jaccard"), "evidence_classes": first.get("included_human_evidence_classes"), "uninformative": first.get("uninformative_tokens"),
            "band_a": vectors.get("class_a_min"), "band_b": vectors.get("class_b_min"), "band_c": vectors.get("class_c_min"), "default_bands": vectors.get("default_use_classes"), "top_k": vectors.get("low_similarity_top_k_per_human_text_per_ortholog"), "placeholders": vectors.get("excluded_placeholder_labels"),
        }
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in named.items() if v is not None})


DEFAULT = Settings()
# Labels of the routes and what their rows say.
STRICT_ROUTE = BridgeRoute("category1-1", "mhmi_high_confidence_hpo_mp_phenotype", SKOS_PREDICATES, 0.8)
UNSCORED_ROUTE = BridgeRoute("category1-2", "monarch_upheno_cross_species_hpo_mp_phenotype", ("semapv:crossSpeciesExactMatch",), 0.0, ("monarch_upheno",))
ORTHOLOG_SOURCE = "MGI_HOM_ProteinCoding"
SAYS_B = "Candidate correspondence: 1:1 ortholog plus the same normalized phenotype label; review allele direction and experimental context."
SAYS_C = "Hypothesis-level correspondence: 1:1 ortholog plus controlled lexical phenotype overlap; manual review required."
SAYS_DISEASE = "Candidate correspondence supported by an exact ClinVar-MGI OMIM identifier and an MGI-curated mouse disease model; not variant equivalence."


@dataclass(frozen=True)
class SourceSpec:
    """A declared input file."""

    id: str
    name: str
    url: str
    path: str
    scope: str = ""
    license: str = ""


#: Sections that a run's configuration must have. Fixed values.
SECTIONS = ("strict_mapping", "monarch_mapping", "ortholog_first_mapping", "semantic_mapping", "category_definitions", "execution")


def validate_configuration(config: dict) -> dict[str, SourceSpec]:
    """Sources of a run's configuration by id; another schema version, no sources, bad ones or missing sections raise."""
    if config.get("schema_version") != 1:
        raise ValueError("schema_version must be 1")
    if not isinstance(config.get("data_sources"), list) or not config["data_sources"]:
        raise ValueError("data_sources must be a non-empty array")
    sources = validate_sources(config["data_sources"])
    for section in SECTIONS:
        if section not in config:
            raise ValueError(f"configuration is missing {section}")
    return sources


def validate_sources(entries: list[dict]) -> dict[str, SourceSpec]:
    """Declared sources by id; missing fields and repeated ids raise."""
    out: dict[str, SourceSpec] = {}
    for entry in entries:
        for name in ("id", "name", "url", "path"):
            if not entry.get(name):
                raise ValueError(f"source without {name}: {entry}")
        if entry["id"] in out:
            raise ValueError(f"source id used twice: {entry['id']}")
        out[entry["id"]] = SourceSpec(**{f.name: entry.get(f.name, "") for f in fields(SourceSpec)})
    return out


# Source ids of a published configuration, and what a run calls them.
CONFIGURED = {"clinvar_grch38": "variants", "hpo_annotations": "annotations", "mhmi_mgi": "mappings", "monarch_upheno": "unscored_mappings", "mgi_gene_pheno": "genotypes", "mgi_orthologs": "orthologs", "gwas_catalog_associations": "associations", "mgi_phenotypic_alleles": "alleles", "mgi_mp_vocabulary": "vocabulary", "mgi_genotype_disease_models": "disease_models", "hgnc_complete_set": "nomenclature"}


def configured_paths(sources: dict[str, SourceSpec], base: str) -> dict[str, str]:
    """Paths of the declared sources below ``base``, by the names that a run has for them."""
    return {CONFIGURED.get(i, i): s.path if "://" in s.path or s.path.startswith("/") else f"{base}/{s.path}" for i, s in sources.items()}
