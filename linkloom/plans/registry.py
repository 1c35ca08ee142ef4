"""Every query by name, with its SQL."""

from pyspark.sql import DataFrame, SparkSession

from . import count_queries, source_queries  # noqa: F401  their queries register themselves
from .driver_queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "entry"]


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: lexical linkage by a token index."""
    return QUERIES["jn_token_index_dense"](spark, sf_dir)
