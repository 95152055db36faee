"""Checksums: known files, comparison, downloads and deletions that a run would make."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.functions.text import or_empty, strip

HASHES = {
    "md5": lambda c: F.md5(c),
    "sha1": lambda c: F.sha1(c),
    "sha224": lambda c: F.sha2(c, 224),
    "sha256": lambda c: F.sha2(c, 256),
    "sha384": lambda c: F.sha2(c, 384),
    "sha512": lambda c: F.sha2(c, 512),
}


def checksum(content: Column, algorithm: str = "sha256") -> Column:
    """Hex digest of a text or binary column.

    MD5 and the SHA family are built in; any other algorithm of Python's hashlib runs as an Arrow UDF.
    """
    algorithm = algorithm.lower().replace("-", "")
    if algorithm in HASHES:
        return HASHES[algorithm](content)
    import hashlib

    hashlib.new(algorithm)

    @F.pandas_udf("string")
    def digest(values):
        return values.map(lambda v: None if v is None else hashlib.new(algorithm, bytes(v)).hexdigest())

    return digest(content.cast("binary"))


def known_duplicates(files: DataFrame, known: DataFrame, digest: str, known_digest: str, is_link: str | None = None) -> DataFrame:
    """Files whose digest is known, whatever its case; links are never duplicates."""
    wanted = known.select(F.lower(strip(F.col(known_digest))).alias("_d")).where("_d <> ''").distinct()
    rows = files if is_link is None else files.where(~F.col(is_link))
    return rows.withColumn("_d", F.lower(strip(F.col(digest)))).join(wanted, "_d", "left_semi").drop("_d")


def unknown_files(files: DataFrame, known: DataFrame, digest: str, known_digest: str, width: int = 32) -> DataFrame:
    """Files whose digest, compared on its first ``width`` characters, nobody knows."""
    wanted = known.select(F.lower(F.substring(strip(F.col(known_digest)), 1, width)).alias("_d")).distinct()
    return files.withColumn("_d", F.lower(F.substring(strip(F.col(digest)), 1, width))).join(wanted, "_d", "left_anti").drop("_d")


def fixity_holds(expected: Column, actual: Column) -> Column:
    """True where nothing is expected or the digests agree."""
    return F.when(strip(or_empty(expected)) == "", True).otherwise(F.coalesce(F.lower(strip(expected)) == F.lower(strip(actual)), F.lit(False)))


def fixity_listing(entities: DataFrame, algorithm: str) -> DataFrame:
    """(value, title) of every bitstream that has a digest of the algorithm.

    ``entities`` nests title, representations, content_objects, generations, bitstreams and a map fixity.
    """
    r = entities.select("title", F.explode("representations").alias("r"))
    c = r.select("title", F.explode("r.content_objects").alias("c"))
    g = c.select("title", F.explode("c.generations").alias("g"))
    b = g.select("title", F.explode("g.bitstreams").alias("b"))
    return b.select(F.try_element_at("b.fixity", F.lit(algorithm)).alias("value"), "title").where("value IS NOT NULL")


def is_preservation(name: Column, kind: Column) -> Column:
    """Whether a representation is a preservation copy; one without name and type counts as one."""
    n, k = F.lower(F.coalesce(name, F.lit(""))), F.lower(F.coalesce(kind, F.lit("")))
    return ((n == "") & (k == "")) | F.contains(n, F.lit("preservation")) | F.contains(k, F.lit("preservation"))


def first_generations(bitstreams: DataFrame, keys: Sequence[str], generation: str) -> DataFrame:
    """Bitstreams of the first generation of each content object."""
    first = bitstreams.groupBy(*keys).agg(F.min(generation).alias("_g"))
    return bitstreams.join(first, list(keys)).where(F.col(generation) == F.col("_g")).drop("_g")


def without_extensions(df: DataFrame, name: str, extensions: Sequence[str]) -> DataFrame:
    """Rows whose extension isn't among those given, by any case and with or without dot."""
    drop = [e.lower().lstrip(".") for e in extensions]
    return df.where(~F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).isin(drop))


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose output isn't there yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def deletion_plan(paths: DataFrame, inventory: DataFrame, path: str) -> DataFrame:
    """What deleting each path would do: missing, file, empty_folder, full_folder or other.

    ``inventory``: path, is_dir, is_link.
    """
    used = inventory.select(F.regexp_replace(path, r"/[^/]*$", "").alias(path)).distinct().withColumn("_used", F.lit(True))
    found = paths.select(path).distinct().join(inventory.select(path, "is_dir", "is_link").withColumn("_there", F.lit(True)), path, "left").join(used, path, "left")
    decision = (
        F.when(F.col("_there").isNull(), "missing")
        .when(F.col("is_link"), "other")
        .when(~F.col("is_dir"), "file")
        .when(F.col("_used").isNull(), "empty_folder")
        .otherwise("full_folder")
    )
    return found.select(path, decision.alias("decision"))


def bitstream_rows(bitstreams: DataFrame, asset: str, ord_: str, originals_first: str, descriptive: Sequence[str]) -> DataFrame:
    """Export rows of assets: the first bitstream's row is full, later ones have blank descriptive cells.

    Originals precede derived bitstreams, each in their order.
    """
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy(asset).orderBy(F.col(originals_first).desc(), F.col(ord_)))
    out = bitstreams.withColumn("row_in_asset", n)
    for c in descriptive:
        out = out.withColumn(c, F.when(F.col("row_in_asset") == 1, F.col(c)).otherwise(F.lit("")))
    return out
