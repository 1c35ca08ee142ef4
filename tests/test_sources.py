"""Source layouts and sinks through temporary files."""

import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from linkloom.sources import readers, writers


def rows(df, *cols):
    return [tuple(r) for r in (df.orderBy("_ord") if "_ord" in df.columns else df).select(*cols).collect()]


def test_tsv(spark, tmp_path):
    p = tmp_path / "a.tsv.gz"
    p.write_bytes(gzip.compress('﻿x\ty\tz\r\n1\t"q\t\r\n\r\n2\n'.encode()))
    assert rows(readers.tsv(spark, str(p)), "x", "y", "z") == [("1", '"q', ""), ("2", "", "")]


def test_quoted_tsv(spark, tmp_path):
    p = tmp_path / "q.tsv"
    p.write_text('a\tb\n1\t"x\ny ""z"""\n2\t\n')
    assert sorted(tuple(r) for r in readers.quoted_tsv(spark, str(p)).collect()) == [("1", 'x\ny "z"'), ("2", "")]


def test_vcf_and_reports(spark, tmp_path):
    v = tmp_path / "v.vcf"
    v.write_text("##x\n#CHROM\n1\t5\t9\tA\tG\t.\t.\tRS=7\n1\t5\n")
    assert rows(readers.vcf(spark, str(v)), "id", "info") == [("9", "RS=7")]
    o = tmp_path / "o.rpt"
    o.write_text("MGI ID\tS\tN\tH\tG\tX\nMGI:1\tTlr4\t2\tHGNC:1\tTLR4\t3\nMGI:2\t\t2\tH\tG\t3\nMGI:3\ta\n")
    assert rows(readers.orthologs(spark, str(o)), "mouse_gene", "human_gene") == [("Tlr4", "TLR4")]
    a = tmp_path / "a.rpt"
    a.write_text("# c\nMGI:1\ts\told\tt\ta\tr\tm\tg\nMGI:1\ts\tnew\tt\ta\tr\tm\tg\n")
    assert rows(readers.allele_metadata(spark, str(a)), "allele_name") == [("new",)]
    m = tmp_path / "m.rpt"
    m.write_text("MP:1\tone\td\nX\tn\td\nMP:1\ttwo\td\n")
    assert rows(readers.vocabulary(spark, str(m)), "mp_label") == [("two",)]
    g = tmp_path / "g.rpt"
    g.write_text("Allelic Composition\t" + "\t".join("abcdefg") + "\nc\ts\ti\tb\tMP:1\tp\tMGI:1\tgt\n")
    assert rows(readers.genotype_report(spark, str(g)), "mp_id", "mgi_genotype_id") == [("MP:1", "gt")]


def test_annotations(spark, tmp_path):
    p = tmp_path / "h.tsv"
    p.write_text("#desc\n#database_id\tdisease_name\tqualifier\thpo_id\nOMIM:1\td\tNOT\tHP:1\n")
    assert rows(readers.annotations(spark, str(p)), "database_id", "qualifier", "hpo_id") == [("OMIM:1", "NOT", "HP:1")]


def test_sssom(spark, tmp_path):
    p = tmp_path / "s.tsv"
    p.write_text("# pre\nsubject_id\tsubject_label\tpredicate_id\tobject_id\tobject_label\tconfidence\nMP:1\tm\tskos:exactMatch\thttp://x/obo/HP_2\th\t0.9\nHP:3\th3\thttp://x/skos/core#broadMatch\tMP:4\tm4\t\nHP:1\ta\tp\tHP:2\tb\t1\n")
    assert rows(readers.sssom(spark, str(p), "src"), "hpo_id", "hpo_label", "mp_id", "mp_label", "predicate", "confidence", "mapping_source") == [("HP:2", "h", "MP:1", "m", "skos:exactMatch", "0.9", "src"), ("HP:3", "h3", "MP:4", "m4", "skos:broadMatch", "", "src")]


def test_zip_associations(spark, tmp_path):
    p = tmp_path / "z.zip"
    with zipfile.ZipFile(p, "w") as z:
        z.writestr("a.tsv", "﻿P-VALUE\tSNP_GENE_IDS\n1e-9\tENSG1\nP-VALUE\tSNP_GENE_IDS\n\tENSG2\n")
    df = readers.associations(readers.zip_lines(spark, str(p)))
    assert rows(df, "P-VALUE", "SNP_GENE_IDS") == [("1e-9", "ENSG1"), ("", "ENSG2")]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("A", "x\t\ny ", None), ("B", "", "2")], "k string, v string, n string")
    out = str(tmp_path / "t")
    writers.write_gzip_tsv(df, out)
    assert rows(readers.tsv(spark, out).orderBy("k"), "k", "v", "n") == [("A", "x y", ""), ("B", "", "2")]
    writers.write_tsv(df, str(tmp_path / "p"), ["k"])
    assert sorted(x.name for x in (tmp_path / "p").glob("k=*")) == ["k=A", "k=B"]
    parts = writers.fan_out(df, str(tmp_path / "m"), all=F.lit(True), some=F.col("k") == "B", none=F.lit(None).cast("boolean"))
    assert {k: sorted(r["k"] for r in p.collect()) for k, p in parts.items()} == {"all": ["A", "B"], "some": ["B"], "none": []}
    assert all(p.columns == df.columns for p in parts.values())
    man = writers.file_manifest(spark, out, "*.gz")
    named = man.withColumn("name", F.concat(F.lit("n"), F.monotonically_increasing_id())).withColumn("change", F.lit(None).cast("string"))
    assert man.first()["bytes"] > 0 and "n0 | not reported | " in writers.version_table(named)
    assert writers.version_table(named.unionByName(named), 1).endswith(f"and {2 * man.count() - 1} more files\n")
    assert writers.statistics(df, rows=F.count("*")) == '{"rows": 2}'
    assert readers.missing_inputs(spark, [out, "/nowhere/x"]) == ["/nowhere/x"]


def test_reuse():
    s = {"url": "u"}
    assert readers.can_reuse(s, {"url": "u", "etag": "1"}, {"etag": "1"}) and not readers.can_reuse(s, {"url": "u", "etag": "1"}, {"etag": "2"})
    old = {"url": "u", "content_disposition": "f1", "bytes": 5, "last_modified": "m"}
    assert readers.can_reuse(s, old, {"content_disposition": "f1", "content_length": 5}) and not readers.can_reuse(s, old, {"content_disposition": "f2", "last_modified": "m"})
    assert readers.can_reuse(s, old, {"last_modified": "m"}) and not readers.can_reuse(s, old, {"last_modified": "m", "content_length": 6}) and not readers.can_reuse(s, old, {})
    assert not readers.can_reuse(s, None, None) and not readers.can_reuse(s, {"url": "u"}, None, True)


def test_shared_folder(spark, monkeypatch):
    """A folder that the session names is used; on one machine there is one; a cluster without one is refused, and nothing is set."""
    from linkloom import session

    class Context:
        def __init__(self, master):
            self.master = master
            self._jsc = type("J", (), {"sc": lambda s: type("S", (), {"getCheckpointDir": lambda s: type("O", (), {"isDefined": lambda s: False})()})()})()

    class Session:
        def __init__(self, master, folder=None):
            self.sparkContext = Context(master)
            self.conf = type("C", (), {"get": lambda s, k, d: folder})()

    assert session.shared_root(Session("spark://host:7077", "s3://x/y/")) == "s3://x/y"
    assert session.shared_root(Session("local[4]")) == session.LOCAL_FALLBACK
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            session.shared_root(Session(master))
