"""Stored model, constraint audits, published matches and the incremental path."""

import pytest

import __spark_entry__
from linkloom.plans import catalog, lexical, registry, semantic
from linkloom.streaming import incremental


def test_catalog(spark):
    pairs = spark.createDataFrame([("p1", "g", "v", "m", "a", "", "", "", "s"), ("p1", "g", "v", "m", "b", "", "", "", "s")], catalog.TABLES["variant_pair"])
    evidence = spark.createDataFrame([(1, "p1", "r") + ("",) * 7 + (None, "", "d", "i", "", ""), (2, "p9", "r") + ("",) * 7 + (None, "", "d", "i", "", "")], catalog.TABLES["connection_evidence"])
    catalog.register(spark, {"variant_pair": pairs, "connection_evidence": evidence})
    bad = {r["audit"]: r["violations"] for r in catalog.constraint_audits(spark).collect() if r["violations"]}
    assert bad == {"unique variant_pair pair_id": 1, "reference connection_evidence pair_id": 1}
    assert spark.table("active_phenotype_pairs").count() == 0
    with pytest.raises(ValueError):
        catalog.store(pairs.drop("pair_id"), "variant_pair")


def test_published(spark):
    texts = spark.createDataFrame([("t1", "a", False)], "text_id string, label string, truncated boolean")
    found = spark.createDataFrame([("g", "t1", "t1", 0.9)], "gene string, left_id string, right_id string, score double")
    o = spark.createDataFrame([("g", "m")], "human_gene string, mouse_gene string")
    out = semantic.published_matches(semantic.flagged_matches(semantic.matches(found), texts), o, "model", "7")
    assert out.columns == semantic.PAIRS and out.first()["mouse_gene"] == "m" and len(semantic.STORED) == 17


def test_stream(spark, tmp_path):
    row = {c: "" for c in lexical.HUMAN} | {"human_gene": "G", "rs_id": "rs1", "phenotype_label": "Hearing loss", "evidence_class": "clinvar_supported"}
    mouse = spark.createDataFrame([{c: "" for c in lexical.MOUSE} | {"mouse_gene": "g", "phenotype_label": "hearing loss"}])
    o = spark.createDataFrame([(1, "G", "g")], "_ord long, human_gene string, mouse_gene string")
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for rs in ("rs1", "rs2"):
        spark.createDataFrame([row | {"rs_id": rs}]).select(*lexical.HUMAN).write.mode("append").parquet(src)
        incremental.link_stream(incremental.evidence_stream(spark, src), mouse, o, out, cp).awaitTermination(120)
    assert sorted(r["rs_id"] for r in spark.read.parquet(out).collect()) == ["rs1", "rs2"]


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_runs_with_sql_columns(spark, sf_dir, name):
    import duckdb

    df = registry.QUERIES[name](spark, sf_dir)
    if name not in registry.SQL:
        assert df.count() >= 0
        return
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(registry.SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    show = lambda r: tuple(repr(round(x, 6)) if isinstance(x, float) else str(x) for x in r)
    assert sorted(show(r) for r in df.select(*columns).collect()) == sorted(show(r) for r in cur.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
