"""Queries of the general data problems 1 to 4 and 6, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.functions.text import blank_to_null, drop_extension
from archivolt.operators import drift, profile, setrecon, unpack, widen
from archivolt.session import scratch_path, table

PROFILED = {
    "dc_date": profile.PARTIAL_DATE,
    "dc_format": profile.MEDIA_TYPE,
    "entity_title": profile.TEXT,
    "dc_description": profile.TEXT,
}


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.schema_changes(table(spark, sf_dir, "export_line"))


def p1_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"asset_id": ("assetid", "string"), "total_metadata_fragments": ("total_metadata_fragments", "bigint"), "dc_subject": ("dc:subject", "array<string>")}
    wide = drift.consistent_table(table(spark, sf_dir, "export_line"), columns)
    return wide.select("file_name", "line_no", *columns, F.coalesce(F.size("misfits"), F.lit(0)).alias("n_misfits"), F.size("others").alias("n_others"))


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "metadata_export").where("trim(entity_type) <> ''")


def _load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of a value-count store after the deltas of all loads. A load's delta is keyed by the load, so loads that have arrived
    together are applied as one change.
    """
    store = profile.ValueCountStore(spark, scratch_path(spark, "value-counts"))
    return store.apply(profile.value_counts(_described(spark, sf_dir), ["feed", "load_id"], PROFILED))


def p2_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of each load, from the maintained value counts."""
    return profile.profile(_load_counts(spark, sf_dir), ["feed", "load_id"], PROFILED).withColumn("entropy_bits", F.round("entropy_bits", 6))


def p2_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of each feed after all loads: a row delivered again is retracted and added under its last delivery."""
    rows = _described(spark, sf_dir)
    again = rows.groupBy("feed", "asset_id", "content_ord").agg(F.max("record_id").alias("record_id"))
    stale = rows.join(again, ["feed", "record_id"], "left_anti")
    store = profile.ValueCountStore(spark, scratch_path(spark, "value-counts"))
    store.apply(profile.value_counts(rows, ["feed"], PROFILED))
    state = store.apply(profile.value_counts(stale, ["feed"], PROFILED, sign=-1))
    return profile.profile(state, ["feed"], PROFILED).withColumn("entropy_bits", F.round("entropy_bits", 6))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = ("entity_title", "dc_description")
    return profile.breaks(
        profile.profile(_load_counts(spark, sf_dir), ["feed", "load_id"], PROFILED),
        "feed",
        "load_id",
        null_rate=dict.fromkeys(PROFILED, 0.20),
        pattern_rate={"dc_date": 0.20, "dc_format": 0.20},
        distinct_rate=dict.fromkeys(texts, 0.30),
        top_share=dict.fromkeys(PROFILED, 0.33),
        middle_step={"dc_date": 12},
        middle_factor=dict.fromkeys(texts, 1.6),
    )


def p3_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = widen.widen(table(spark, sf_dir, "classifier_score"), table(spark, sf_dir, "classifier_class"))
    return wide.withColumn("n_issues", F.size("issues")).drop("issues").withColumnRenamed("entity", "document")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widen.unfillable(table(spark, sf_dir, "classifier_score"), table(spark, sf_dir, "classifier_class"))


def _composed(col: F.Column) -> F.Column:
    """Text in composed Unicode form. Spark has no such function, so names beyond ASCII go through Python."""

    @F.pandas_udf(T.StringType())
    def nfc(names):
        return names.str.normalize("NFC")

    wide = col.rlike(r"[^\x00-\x7F]")
    return F.when(wide, nfc(F.when(wide, col))).otherwise(col)


def _bitstreams(df: DataFrame, asset) -> DataFrame:
    low = lambda c: F.lower(blank_to_null(F.col(c))).alias(c)
    return df.where("content_ord IS NOT NULL").select(
        asset.alias("asset_id"), "content_ord", low("md5_checksum"), low("sha256_checksum"), _composed(blank_to_null(F.col("filename"))).alias("filename")
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    asset = F.lower(blank_to_null(F.col("asset_id")))
    sides = []
    for name, key in (("metadata_export", asset), ("metadata_mirror", drop_extension(asset))):
        # read several times below, so it is kept once, normalised, in the shared folder
        path = scratch_path(spark, name)
        _bitstreams(table(spark, sf_dir, name), key).write.parquet(path)
        sides.append(spark.read.parquet(path))
    return setrecon.differences(
        *sides, keys=["asset_id", "content_ord"], fields=["md5_checksum", "sha256_checksum", "filename"], names=("only_export", "only_mirror")
    )


def p6_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = unpack.known_terms(table(spark, sf_dir, "subject_taxonomy"), "subject_term")
    return unpack.unpack_values(table(spark, sf_dir, "metadata_export"), "record_id", ["dc_subject", "dc_relation"], terms, ["dc_subject"])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_values(spark, sf_dir).drop("error")


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_consistent, p2_found, p2_profile, p2_maintained, p3_found, p3_wide, p4_found, p6_found, p6_values)
}
