"""File inventories and entity tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.functions.text import extension
from archivolt.operators.fixity import checksum
from archivolt.operators.sets import outside_prefixes


def files(spark: SparkSession, path: str, algorithm: str | None = None, exclude: Sequence[str] = (), glob: str | None = None) -> DataFrame:
    """Files below a path: path, name, extension, size, modified and, on demand, digest.

    Without an algorithm the contents aren't read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.load(path)
    out = [F.regexp_replace("path", r"^file:/*", "/").alias("path"), F.regexp_replace("path", r"^.*/", "").alias("name")]
    out += [extension(F.col("path")).alias("extension"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")]
    if algorithm:
        out.append(checksum(F.col("content"), algorithm).alias("digest"))
    listed = rows.select(*out)
    return outside_prefixes(listed, "path", exclude) if exclude else listed


def entities(rows: DataFrame, wanted: DataFrame | None = None, key: str = "ref") -> DataFrame:
    """Entities of a repository table, all or those whose refs are wanted."""
    return rows if wanted is None else rows.join(wanted.select(key).distinct(), key, "left_semi")
