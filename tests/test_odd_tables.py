"""Queries on tables of odd values and of many equal ones, against their SQL."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from linkloom.functions import text as X
from linkloom.plans import bridge, counts, disease, lexical, registry
from linkloom.settings import BridgeRoute


@pytest.fixture
def check(spark, tmp_path):
    """Writes tables and compares a query on them with its SQL; returns the rows."""

    def run(name: str, **tables):
        con = duckdb.connect()
        for table, df in tables.items():
            df.write.parquet(f"file://{tmp_path}/{table}.parquet")
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
        cur = con.execute(registry.SQL[name])
        columns = [d[0] for d in cur.description]
        rows = registry.QUERIES[name](spark, f"file://{tmp_path}").select(*columns).collect()
        assert sorted(tuple(map(str, r)) for r in rows) == sorted(tuple(map(str, r)) for r in cur.fetchall())
        return rows

    return run


def test_sizes_beyond_the_units_of_a_query(spark, check):
    rows = check("fn_byte_size", events=spark.createDataFrame([(n,) for n in (0, 1023, 1024, 1536, (1 << 20) - 1, 1 << 20, 5999999, 1 << 31)], "event_id long"))
    assert {r["event_id"]: r["size"] for r in rows}[1 << 20] == "1024.0 KB"
    assert spark.range(1).select(X.byte_size(F.lit(1 << 50))).first()[0] == "1024.0 TB"


def test_negation_beside_letters_that_are_not_ascii(spark, check):
    """A letter with an accent ends a word, as in the SQL; without a text or a role nothing is said of a negation."""
    texts = ["noñ el", "ñno", "no", "nota not_a", "sin x", "of the no", None, "É without", "knot"]
    rows = [(i, i % 4, "user", t) for i, t in enumerate(texts)] + [(20, None, "no", "x"), (21, 1, None, "no")]
    found = {r["conv_id"]: r["negation"] for r in check("fn_direction_flags", conversations=spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))}
    assert [found[i] for i in range(9)] == [True, True, True, False, False, True, None, True, False] and found[21] is None


@pytest.mark.parametrize("sizes", [(1, 2), (30, 40), (1, 30), ()])
def test_batches_without_a_new_text(spark, check, sizes):
    """Where the smaller parts have all labels, there is no second batch; where there are none, no first one."""
    rows = [(i, "small", f"Brand#{i}", "large", s) for i, s in enumerate(sizes)] + [(10, "x", "Brand#0", "large", 50)] * bool(sizes)
    found = check("pl_kept_vectors", part=spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int"))
    assert len(found) == len({s <= 25 for s in sizes})


def test_every_pair_of_a_gene_whatever_its_score(spark, check):
    """Opposite, orthogonal and equal vectors of one label, and a label without a left side."""
    at = [(1.0, 0.0), (-1.0, 0.0), (0.0, 1.0), (0.6, -0.8), (1.0, 0.0), (0.0, -1.0)]
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(at)] + [(7, [1.0, 0.0], 2), (9, [0.0, 1.0], 2)]
    found = check("jn_gene_block_cosine", embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert len(found) == 9 and min(r["score"] for r in found) == -1.0


def test_disease_counts_are_those_of_the_links(spark):
    """Repeated and null ids, identifiers of one side only, and a fan-out of 10^10 links, which is counted from its sides."""
    columns = "human_gene string, rs_id string, source_record_id string, condition_identifiers string, _ord long"
    human = [("g", "r1", "a", "OMIM:1|OMIM:2", 1), ("g", "r1", "a", "OMIM:1", 2), ("g", "r1", "b", "OMIM:1", 3), ("g", None, "a", "OMIM:1", 4), ("h", "r2", "a", "OMIM:1|OMIM:9", 5), (None, "r", "a", "OMIM:1", 6), ("k", "r3", "a", None, 7)]
    models = [("g", "m1", "OMIM:1|OMIM:3", 1), ("g", "m1", "OMIM:1", 2), ("g", None, "OMIM:1|OMIM:2", 3), ("h", "m2", "OMIM:8", 4), (None, "m", "OMIM:1", 5), ("h", "m1", "OMIM:9", 6)]
    h = spark.createDataFrame(human, columns).withColumns({"variant_source": F.lit("ClinVar"), "evidence_class": F.lit("clinvar_supported")})
    m = spark.createDataFrame(models, "human_gene string, mgi_genotype_id string, mouse_omim_ids string, _ord long")
    links = disease.disease_links(h, m)
    want = links.groupBy("human_gene", "shared_disease_id").agg(F.count("*"), F.count_distinct("rs_id"), F.count_distinct("mgi_genotype_id"))
    assert sorted(map(tuple, disease.disease_counts(h, m).collect())) == sorted(map(tuple, want.collect())) == [("g", "OMIM:1", 6, 1, 1), ("g", "OMIM:2", 1, 1, 0), ("h", "OMIM:9", 1, 1, 1)]
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(counts.disease_mapping_of(m, m, h)) == rows(counts.disease_mapping(m, m, h, links, disease.with_shared_disease(h, m)))
    many = spark.range(100_000).select(F.lit("g").alias("human_gene"), F.col("id").cast("string").alias("rs_id"), F.lit("a").alias("source_record_id"), F.lit("OMIM:1").alias("condition_identifiers"), F.col("id").alias("_ord"), F.lit("ClinVar").alias("variant_source"), F.lit("clinvar_supported").alias("evidence_class"))
    both = many.withColumnsRenamed({"rs_id": "mgi_genotype_id", "condition_identifiers": "mouse_omim_ids"}).select("human_gene", "mgi_genotype_id", "mouse_omim_ids", "_ord")
    assert disease.disease_counts(many, both).first()["links"] == 10**10


def test_bridge_counts_are_those_of_the_links(spark):
    """Repeated ortholog rows, a second predicate of a pair, keys of one side only, null ids; and 10^12 links, counted from their keys."""
    human = spark.createDataFrame([("g", "hp1", "r1"), ("g", "hp1", "r1"), ("g", "hp2", None), ("g", "hp3", "r3"), ("x", "hp1", "r4"), ("k", "hp1", "r5")], "human_gene string, hpo_id string, rs_id string")
    wide = human.select(*(F.col(c) if c in human.columns else F.lit("-").alias(c) for c in bridge.HUMAN))
    merged = spark.createDataFrame([("hp1", "mp1", "p", "0.9"), ("hp1", "mp1", "q", ""), ("hp1", "mp2", "p", "0.1"), ("hp2", "mp1", "p", "0.8"), ("hp3", "mp3", "p", "1")], "hpo_id string, mp_id string, predicate string, confidence string")
    merged = merged.select("*", *(F.lit(c).alias(c) for c in ("hpo_label", "mp_label", "mapping_justification", "mapping_date", "mapping_source")))
    pairs = spark.createDataFrame([("g", "m"), ("g", "m"), ("x", "n"), ("k", "m")], "human_gene string, mouse_gene string")
    mice = spark.createDataFrame([("m", "mp1"), ("m", "mp1"), ("m", "mp2"), ("o", "mp1")], "mouse_gene string, mp_id string")
    alleles = mice.select(*(F.col(c) if c in mice.columns else F.lit("-").alias(c) for c in [*bridge.ALLELE, "mp_id", "pubmed_ids", "mgi_genotype_id"]))
    route = BridgeRoute("s", "b", ("p", "q"), 0.5)
    links = bridge.bridge_links(wide, merged, pairs, alleles, route)
    want = dict(map(tuple, counts.bridge_mapping(wide, merged, pairs, alleles, links, route).collect()))
    assert dict(map(tuple, counts.bridge_mapping_of(human, merged, pairs, mice, route).collect())) == want and want["finalRows"] == 2 * 2 * 2 * 2 + 2 * 2 + 2 * 2
    many = lambda c, **v: spark.range(1_000_000).select(*(F.lit(x).alias(k) for k, x in v.items()), F.col("id").cast("string").alias(c))
    found = counts.bridge_mapping_of(many("rs_id", human_gene="k", hpo_id="hp2"), merged, pairs, many("id", mouse_gene="m", mp_id="mp1"), route)
    assert dict(map(tuple, found.collect()))["finalRows"] == 10**12


def test_shares_in_three_decimals(spark):
    """Integers give what the formatted quotient gives."""
    pairs = spark.range(1, 201).select(F.col("id").alias("whole")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))))
    assert pairs.where(X.ratio3("part", "whole") != X.fixed3(F.col("part") / F.col("whole"))).count() == 0
    assert spark.range(1).select(X.ratio3(F.lit(0), F.lit(0))).first()[0] == "0.000"


@pytest.mark.parametrize("rows,ids", [(128, 64), (3, 2)])
def test_every_pair_of_a_brand(spark, check, monkeypatch, rows, ids):
    """Sizes that differ, keys of equal parity, many copies of a label, keys that are there twice, nulls, and labels that share nothing but their brand."""
    pairs = lexical.jaccard_pairs
    monkeypatch.setattr(lexical, "jaccard_pairs", lambda labels: pairs(labels, rows, ids))
    part = [(2 * i, "red pin", "Brand#1", "ECONOMY", i) for i in range(9)] + [(2 * i + 1, f"{w} pin", "Brand#1", "Budget", i) for i, w in enumerate(("blue", "red", "red red", "PIN"))]
    part += [(30, "a b", "Brand#2", "x", 1), (30, "b a", "Brand#2", "x", 1), (30, "a", "Brand#2", "x", 1), (31, "c", "Brand#2", "y", 2), (33, None, "Brand#2", "y", 2), (35, None, "Brand#2", "y", 2), (None, "a", "Brand#2", "x", 1), (37, "a", None, "x", 1), (39, "a", None, "x", 1), (41, "é", "Brand#3", "-", None)]
    found = check("fn_jaccard", part=spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int"))
    assert len(found) == 13 * 12 // 2 + 3 * 3 + 3
    assert {(r["left_id"], r["right_id"]): r["jaccard"] for r in found}[2, 4] == "1.000"


@pytest.mark.parametrize("rows", [4096, 3])
def test_lines_of_links_are_those_of_the_rows(spark, monkeypatch, rows):
    """Repeated ortholog rows, equal rows on both sides, two predicates, nulls and text that is not ASCII; no row of a link is made and no mapping is looked for twice."""
    columns = lambda names, given: [F.col(c) if c in given.columns else F.lit("-").alias(c) for c in names]
    human = spark.createDataFrame([("g", "hp1", f"r{i // 2}", f"Ä{i % 3}") for i in range(20)] + [("g", "hp2", None, None), ("h", "hp1", "r9", "x"), ("k", "hp9", "r1", "x")], "human_gene string, hpo_id string, rs_id string, disease_name string")
    human = human.select(*columns(bridge.HUMAN, human))
    merged = spark.createDataFrame([("hp1", "mp1", "p", "0.9"), ("hp1", "mp1", "q", ""), ("hp1", "mp2", "p", "0.1"), ("hp2", "mp1", "p", "0.8")], "hpo_id string, mp_id string, predicate string, confidence string")
    merged = merged.select("*", *(F.lit(c).alias(c) for c in ("hpo_label", "mp_label", "mapping_justification", "mapping_date", "mapping_source")))
    pairs = spark.createDataFrame([("g", "m"), ("g", "m"), ("g", "n"), ("h", "m")], "human_gene string, mouse_gene string")
    mice = spark.createDataFrame([("m", "mp1", f"a{i % 5}") for i in range(11)] + [("m", "mp2", "a1"), ("n", "mp1", None), ("o", "mp1", "a2")], "mouse_gene string, mp_id string, mgi_allele_id string")
    alleles = mice.select(*columns([*bridge.ALLELE, "mp_id", "pubmed_ids", "mgi_genotype_id"], mice))
    route = BridgeRoute("s", "b", ("p", "q"), 0.5)
    line = F.conv(F.substring(F.md5(F.concat_ws("|", *bridge.LINKS).cast("binary")), 1, 8), 16, 10).cast("long")
    want = bridge.bridge_links(human, merged, pairs, alleles, route).groupBy("human_gene", "hpo_id", "mp_id").agg(F.count("*"), F.count_distinct("rs_id"), F.count_distinct("mgi_allele_id"), F.max("mapping_confidence"), F.sum(line))
    want = sorted(map(tuple, want.collect()))
    made, merges = [], spark.sparkContext.accumulator(0)
    keep = bridge.written
    monkeypatch.setattr(bridge, "written", lambda df, name: made.append(name) or keep(df, name))

    def seen(batches):
        merges.add(1)
        yield from batches

    once = merged.coalesce(1).mapInArrow(seen, merged.schema)
    assert sorted(map(tuple, bridge.bridge_digest(human, once, pairs, alleles, route, rows=rows).collect())) == want
    assert merges.value == 1 and len(want) == 3 and made == ["merged", "human", "alleles"]
