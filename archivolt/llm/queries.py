"""Queries of the problems 5 and 7 to 9, each over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.llm import canonical, leak, mojibake, packing, queries_sql
from archivolt.session import table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.map_free_values(
        table(spark, sf_dir, "metadata_export"),
        "record_id",
        ["icaew_content_type", "dc_type", "dc_language"],
        table(spark, sf_dir, "vocabulary").select("field_name", "term_id", "term", "alt_labels"),
    )


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "container_spec"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the containers' room that is used, by kind of container."""
    spec = table(spark, sf_dir, "container_spec").groupBy("container_kind").agg(F.max("capacity_tokens").alias("capacity"))
    used = p7_packed(spark, sf_dir).groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("n"))
    kinds = used.groupBy("container_kind").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n").alias("n_tokens"))
    return kinds.join(spec, "container_kind").select("container_kind", "n_containers", "n_tokens", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity")), 4).alias("fill"))


def p8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_passages(spark, sf_dir).select("doc_id", "item_id").distinct()


def p9_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.find_garbled(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_restored(spark, sf_dir).select("doc_id").distinct()


QUERIES = {f.__name__: f for f in (p5_found, p7_packed, p7_fill, p8_found, p8_passages, p9_found, p9_restored)}
ORACLE: dict[str, str] = {**queries_sql.ORACLE}
