"""Linking of evidence files as they arrive. The mouse side is static; a batch is linked once, whatever is retried."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from linkloom.plans import lexical
from linkloom.settings import DEFAULT, Settings


def evidence_stream(spark: SparkSession, folder: str, files_per_batch: int = 16) -> DataFrame:
    """A stream of human evidence rows from Parquet files that are added to a folder."""
    schema = ", ".join(f"{c} string" for c in lexical.HUMAN)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def link_stream(evidence: DataFrame, mouse: DataFrame, orthologs: DataFrame, out: str, checkpoint: str, settings: Settings = DEFAULT) -> StreamingQuery:
    """Writes the lexical links of every batch to its own folder below ``out``: a repeated batch overwrites itself."""

    def link(batch: DataFrame, number: int) -> None:
        lexical.lexical_links(batch, mouse, orthologs, settings).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return evidence.writeStream.foreachBatch(link).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
