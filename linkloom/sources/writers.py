"""Sinks: clean TSV, files by class, manifests of files, statistics."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import byte_size
from linkloom.sources.files import files, opened


def clean_cell(x: Column) -> Column:
    """Runs of tabs and line ends as one space, trimmed; null is ''."""
    return F.trim(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), "[\t\r\n]+", " "))


def write_tsv(df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str = "none", order: list | None = None) -> None:
    """Unquoted TSV with a header; ``partition_by`` makes a folder for each value, ``order`` sorts the rows over all files."""
    keys = partition_by or []
    df = df.orderBy(*order) if order else df
    out = df.select(*(F.col(c) if c in keys else clean_cell(F.col(c)).alias(c) for c in df.columns))
    w = out.write.mode("overwrite").options(sep="\t", header=True, quote="", emptyValue="", nullValue="", compression=compression)
    (w.partitionBy(*keys) if keys else w).csv(path)


def write_quoted_tsv(df: DataFrame, path: str, compression: str = "gzip", order: list | None = None) -> None:
    """TSV with a header whose cells are quoted where they hold a separator, a quote or a line end; quotes are doubled."""
    df = df.orderBy(*order) if order else df
    df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns)).write.mode("overwrite").options(sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue="", compression=compression, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_gzip_tsv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    write_tsv(df, path, partition_by, "gzip")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet; the commit protocol publishes it as a whole."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def fan_out(df: DataFrame, path: str, **sinks: Column) -> dict[str, DataFrame]:
    """One scan to several tables of its columns: a row goes to every sink whose condition holds, by one job. Returns them, read again."""
    named = F.array_compact(F.array(*(F.when(condition, F.lit(name)) for name, condition in sinks.items())))
    df.withColumn("_sink", F.explode(named)).write.mode("overwrite").partitionBy("_sink").parquet(path)
    schema = df.withColumn("_sink", F.lit("")).schema
    written = df.sparkSession.read.schema(schema).parquet(path)
    return {name: written.where(F.col("_sink") == name).drop("_sink") for name in sinks}


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sums = []
        for path in batch["path"]:
            h = hashlib.sha256()
            with opened(path) as f:
                while piece := f.read(1 << 20):
                    h.update(piece)
            sums.append(h.hexdigest())
        yield batch.assign(sha256=sums)


def file_manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, bytes and SHA-256 of each file below a folder; files of any size, read piece by piece."""
    found = files(spark, path, pattern).select("path", F.col("length").alias("bytes"))
    return found.repartition(F.col("path")).mapInPandas(_digests, "path string, bytes long, sha256 string")


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file in any file system Spark knows, under a temporary name first."""
    jvm = spark.sparkContext._jvm
    place, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = store.create(part, True)
    out.write(bytearray(content))
    out.close()
    store.delete(place, False)
    store.rename(part, place)


def statistics(df: DataFrame, **counts: Column) -> str:
    """The named aggregates of a table as one line of JSON."""
    row = df.agg(*(c.alias(k) for k, c in counts.items())).first()
    return json.dumps(row.asDict(), sort_keys=True, default=str)


def version_table(manifest: DataFrame, most: int = 1000) -> str:
    """The files of a manifest (name, path, bytes, sha256 and change) as a Markdown table of at most ``most`` lines, and how many more there are."""
    rows = manifest.select("name", F.coalesce("change", F.lit("not reported")).alias("change"), byte_size(F.col("bytes")).alias("size"), "sha256").orderBy("name").limit(most).collect()
    more = manifest.count() - len(rows)
    lines = ["Dataset | Against the run before | Size | SHA-256", "--- | --- | --- | ---", *(f"{r['name']} | {r['change']} | {r['size']} | `{r['sha256']}`" for r in rows)]
    return "\n".join([*lines, *([f"and {more} more files"] if more else []), ""])
