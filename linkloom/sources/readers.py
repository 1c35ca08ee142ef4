"""Readers of the source layouts. Columns are texts, an absent cell is ''; _ord is the row's place where order decides."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import ontology_curie, skos_predicate
from linkloom.sources.files import files, opened
from linkloom.sources.split import gzip_lines, quoted_rows

#: Rows of a matrix that a task reads at a time.
NPY_ROWS = 4096
BOM = "﻿"
VCF = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info"]
ANNOTATION = ["database_id", "disease_name", "qualifier", "hpo_id", "reference", "evidence", "onset", "frequency", "sex", "modifier", "aspect", "biocuration"]
ORTHOLOG = ["mgi_marker_id", "mouse_gene", "mouse_ncbi_gene_id", "hgnc_id", "human_gene", "human_ncbi_gene_id"]
GENOTYPE = ["allelic_composition", "mouse_allele", "mgi_allele_id", "genetic_background", "mp_id", "pubmed_ids", "marker_ids", "mgi_genotype_id"]
DISEASE_MODEL = [*GENOTYPE[:7], "mouse_doid", "mouse_omim_ids", "mgi_genotype_id"]
ALLELE = ["allele_id", "symbol", "allele_name", "allele_type", "allele_attribute", "reference", "marker_id", "marker_symbol"]
VOCABULARY = ["mp_id", "mp_label", "mp_definition"]


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of plain or .gz files: _ord (order within the input: files by path, then lines), value. A trailing CR is cut.

    A path that ends in .gz is read by many tasks where its files are block gzip."""
    if path.endswith(".gz"):
        return gzip_lines(spark, path).select(F.struct("file", "line").alias("_ord"), "value")
    # Spark packs files into partitions by size, so that the path comes before the number; inside a file the numbers go up.
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(path).select(place.alias("_ord"), F.regexp_replace("value", "\r$", "").alias("value"))


def _cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """Tab cells by position; missing ones are ''. _n is how many there were."""
    cells = F.split("value", "\t")
    return df.select("_ord", F.size(cells).alias("_n"), *(F.coalesce(F.get(cells, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)))


def header_of(df: DataFrame, marker: str | None = None) -> list[str]:
    """Names in the first non-blank line, or the first that matches ``marker``; one line comes to the driver."""
    rows = df.where(F.trim("value") != "")
    if marker:
        rows = rows.where(F.col("value").rlike(marker))
    first = rows.orderBy("_ord").select("value").head()
    return first[0].removeprefix(BOM).lstrip("#").split("\t") if first else []


def tsv(spark: SparkSession, path: str) -> DataFrame:
    """A table with a header line and no quoting; blank lines are skipped, short rows are filled with ''.

    Lines equal to the header are no rows: each file of a folder has its own.
    """
    df = lines(spark, path).withColumn("value", F.regexp_replace("value", f"^{BOM}", ""))
    names = header_of(df)
    line = "\t".join(names)
    body = df.where((F.trim("value") != "") & (F.regexp_replace("value", "^#+", "") != line))
    return _cells(body, names).drop("_n")


def quoted_tsv(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A table, plain or gzip, with a header and quoted cells, which may hold separators, line ends and doubled quotes. A quote inside a cell is kept."""
    df = spark.read.csv(path, sep=sep, header=True, quote='"', escape='"', multiLine=True)
    return df.na.fill("")


def toggled_tsv(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A table with a header and quoted cells, as ``quoted_tsv``, but that a quote changes the state wherever it stands.

    A quote inside a cell begins or ends a quoted stretch like one at its edge. The first record of each file is its header; the
    first file's names hold. Missing cells are ''. Files are cut into ranges, so that one of any size is read by many tasks."""
    rows = quoted_rows(spark, path, sep)
    return _headed(rows)


def _headed(rows: DataFrame) -> DataFrame:
    """Records of files that begin with a header; the first file's names hold, without blanks around them."""
    first = rows.where("first").orderBy("file").select("cells").head()
    names = [c.removeprefix(BOM).strip() for c in first["cells"]] if first else []
    body = rows.where("not first").select(F.struct("file", "line").alias("_ord"), "cells")
    return body.select("_ord", *(F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(names)))


def report(spark: SparkSession, path: str, columns: list[str], least: int, header_cell: str | None = None, comment: str | None = None, watch=lambda df: df) -> DataFrame:
    """A headerless positional table: rows of at least ``least`` cells whose first cell is not ``header_cell``. ``watch`` sees all its lines."""
    df = lines(spark, path).where(F.trim("value") != "")
    if comment:
        df = df.where(~F.startswith("value", F.lit(comment)))
    df = watch(df)
    out = _cells(df, columns).where(F.col("_n") >= least)
    return (out.where(F.col(columns[0]) != header_cell) if header_cell else out).drop("_n")


def vcf(spark: SparkSession, path: str, watch=lambda df: df) -> DataFrame:
    return report(spark, path, VCF, 8, comment="#", watch=watch)


def orthologs(spark: SparkSession, path: str) -> DataFrame:
    df = report(spark, path, ORTHOLOG, 6)
    return df.where(F.startswith("mgi_marker_id", F.lit("MGI:")) & (F.col("mouse_gene") != "") & (F.col("human_gene") != ""))


def genotype_report(spark: SparkSession, path: str) -> DataFrame:
    return report(spark, path, GENOTYPE, 8, "Allelic Composition")


def disease_models(spark: SparkSession, path: str) -> DataFrame:
    return report(spark, path, DISEASE_MODEL, 10, "Allelic Composition")


def allele_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The last row of each allele id."""
    from linkloom.operators.keys import last_wins

    df = report(spark, path, ALLELE, 8, comment="#").where(F.startswith("allele_id", F.lit("MGI:")))
    return last_wins(df, ["allele_id"], ["_ord"])


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """The last row of each term."""
    from linkloom.operators.keys import last_wins

    return last_wins(report(spark, path, VOCABULARY, 2).where(F.startswith("mp_id", F.lit("MP:"))), ["mp_id"], ["_ord"])


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """Disease annotations. The header is the first line that names database_id and hpo_id, wherever they stand, commented out
    or not, if no row comes before it; else the usual columns hold. Other comment lines are skipped."""
    df = lines(spark, path).where(F.trim("value") != "")
    cells = F.split(F.regexp_replace("value", "^#", ""), "\t", -1)
    is_header = F.array_contains(cells, "database_id") & F.array_contains(cells, "hpo_id")
    first = df.where(is_header | ~F.startswith("value", F.lit("#"))).orderBy("_ord").select("value", is_header.alias("is_header")).head()
    found = first is not None and first["is_header"]
    names = [c.strip().lower() for c in first["value"].removeprefix("#").split("\t")] if found else ANNOTATION
    body = df.where(~F.startswith("value", F.lit("#")))
    return _cells(body.where(F.col("value") != first["value"]) if found else body, names).drop("_n")


def sssom(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Mappings oriented HP to MP. The table begins at the line that names subject_id or object_id, and has quoted cells;
    pairs of other kinds are dropped. A file without such a line raises."""
    raw = _headed(quoted_rows(spark, path, marker="(subject_id|object_id)\t"))
    names = raw.columns
    if "subject_id" not in names or "object_id" not in names:
        raise ValueError(f"no header of mappings in {path}")
    for name in ("subject_label", "object_label", "confidence", "mapping_justification", "mapping_date"):
        if name not in names:
            raw = raw.withColumn(name, F.lit(""))
    s, o = ontology_curie("subject_id"), ontology_curie("object_id")
    raw = raw.withColumn("_s", s).withColumn("_o", o)
    ahead = F.startswith("_s", F.lit("HP:")) & F.startswith("_o", F.lit("MP:"))
    back = F.startswith("_s", F.lit("MP:")) & F.startswith("_o", F.lit("HP:"))
    pick = lambda x, y: F.when(ahead, F.col(x)).otherwise(F.col(y))
    return raw.where(ahead | back).select(
        "_ord",
        pick("_s", "_o").alias("hpo_id"),
        pick("subject_label", "object_label").alias("hpo_label"),
        pick("_o", "_s").alias("mp_id"),
        pick("object_label", "subject_label").alias("mp_label"),
        skos_predicate("predicate_id").alias("predicate"),
        "confidence",
        "mapping_justification",
        "mapping_date",
        F.lit(source).alias("mapping_source"),
    )


def _unzipped(suffix: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, member in zip(batch["path"], batch["member"]):
                with opened(path) as raw, zipfile.ZipFile(raw) as z, z.open(member) as f:
                    rows: list[str] = []
                    for line in io.TextIOWrapper(f, "utf-8", newline="\n"):
                        rows.append(line.rstrip("\r\n"))
                        if len(rows) >= 10_000:
                            yield pd.DataFrame({"path": path, "member": member, "value": rows})
                            rows = []
                    yield pd.DataFrame({"path": path, "member": member, "value": rows})

    return run


def _members(suffix: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with opened(path) as raw, zipfile.ZipFile(raw) as z:
                    names = [n for n in z.namelist() if n.endswith(suffix)]
                yield pd.DataFrame({"path": path, "member": names})

    return run


def zip_lines(spark: SparkSession, path: str, suffix: str = ".tsv") -> DataFrame:
    """Lines of the members of ZIP files, in the order of files, members and lines. A member is decompressed in pieces, in
    a task of its own; an archive is never held whole, so that its size is not bounded."""
    some = files(spark, path).select("path").mapInPandas(_members(suffix), "path string, member string")
    lines = some.repartition(F.col("path"), F.col("member")).mapInPandas(_unzipped(suffix), "path string, member string, value string")
    return lines.select(F.struct(F.concat_ws("!", "path", "member").alias("file"), F.monotonically_increasing_id().alias("line")).alias("_ord"), "value")


def associations(df: DataFrame) -> DataFrame:
    """A table of association lines; every line that names SNP_GENE_IDS is a header and no row."""
    df = df.withColumn("value", F.regexp_replace("value", f"^{BOM}", ""))
    names = header_of(df, "SNP_GENE_IDS")
    return _cells(df.where(~F.contains("value", F.lit("SNP_GENE_IDS")) & (F.trim("value") != "")), names).drop("_n")


def read_json(path: str, fallback=None, spark: SparkSession | None = None):
    """A small JSON file; ``fallback`` if it is not there. With ``spark``, from any file system Spark knows."""
    if spark is not None:
        if missing_inputs(spark, [path]):
            return fallback
        return json.loads(spark.read.text(path, wholetext=True).head()[0])
    try:
        with open(path) as f:
            return json.load(f)
    except FileNotFoundError:
        return fallback


def missing_inputs(spark: SparkSession, paths: list[str]) -> list[str]:
    """Which of the paths do not exist, in any file system Spark knows."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        place = jvm.org.apache.hadoop.fs.Path(p)
        if not place.getFileSystem(conf).exists(place):
            out.append(p)
    return out


def can_reuse(source: dict, previous: dict | None, remote: dict | None, force: bool = False) -> bool:
    """Whether a downloaded file is still the server's release: by its file name, else by ETag, else by date, and by length where that
    is told. What neither side can tell is no release."""
    if force or not previous or previous.get("url") != source.get("url"):
        return False
    remote = remote or {}
    told = lambda k: remote.get(k) and previous.get(k)
    as_long = not remote.get("content_length") or remote["content_length"] == previous.get("bytes")
    if told("content_disposition"):
        if remote["content_disposition"] != previous["content_disposition"]:
            return False
        if as_long:
            return True
    if told("etag"):
        return remote["etag"] == previous["etag"]
    return bool(told("last_modified")) and remote["last_modified"] == previous["last_modified"] and as_long


def npy_header(f) -> tuple[tuple[int, ...], str, int]:
    """Shape and number type of an open .npy file in C order, and where its numbers begin."""
    import numpy as np

    version = np.lib.format.read_magic(f)
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, fortran, kind = read(f)
    if fortran or kind.hasobject or len(shape) != 2:
        raise ValueError("only matrices of numbers in C order")
    return shape, kind.str, f.tell()


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            with opened(path) as f:
                (rows, width), kind, start = npy_header(f)
            at = range(0, rows, NPY_ROWS)
            yield pd.DataFrame({"path": path, "first": at, "rows": [min(NPY_ROWS, rows - x) for x in at], "width": width, "kind": kind, "start": start})


def _npy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import numpy as np

    for batch in batches:
        for path, first, rows, width, kind, start in batch.itertuples(index=False):
            size = np.dtype(kind).itemsize * width
            with opened(path) as f:
                f.seek(start + first * size)
                part = np.frombuffer(f.read(rows * size), kind).reshape(rows, width)
            yield pd.DataFrame({"path": path, "row": range(first, first + rows), "embedding": [v.astype("float32").tolist() for v in part]})


def npy_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Rows of .npy matrices: path, row, embedding. Blocks of rows are read where they stand, by tasks of their own; a
    matrix is never held whole."""
    some = files(spark, path).select("path").mapInPandas(_blocks, "path string, first long, rows long, width long, kind string, start long")
    return some.repartition(F.col("path"), F.col("first")).mapInPandas(_npy, "path string, row long, embedding array<float>")


def manifest_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Entries of a manifest (id, sha256) as new, same or changed against an earlier one."""
    old = previous.select("id", F.col("sha256").alias("_old"))
    change = F.when(F.col("_old").isNull(), "new").when(F.col("_old") == F.col("sha256"), "same").otherwise("changed")
    return current.join(old, "id", "left").withColumn("change", change).drop("_old")
