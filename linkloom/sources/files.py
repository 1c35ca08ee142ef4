"""Files below a path, and one of them opened by a task: local ones, and what Arrow's file systems know by its scheme."""

from __future__ import annotations

import os
import re
import urllib.parse

from pyspark.sql import DataFrame, SparkSession


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path and length of the files at or below a path; their content is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length")


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return urllib.parse.unquote("/" + path.removeprefix("file:").lstrip("/"))
    return path if path.startswith("/") else None


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


def opened(path: str):
    """A file for reading and seeking."""
    if place := _local(path):
        return open(place, "rb")
    store, place = _store(path)
    return store.open_input_file(place)


def created(path: str):
    """A file for writing; its folders are made."""
    if place := _local(path):
        os.makedirs(os.path.dirname(place), exist_ok=True)
        return open(place, "wb")
    store, place = _store(path)
    store.create_dir(os.path.dirname(place), recursive=True)
    return store.open_output_stream(place)


def renamed(path: str, to: str) -> None:
    if place := _local(path):
        os.replace(place, _local(to))
    else:
        store, place = _store(path)
        store.move(place, _store(to)[1])
