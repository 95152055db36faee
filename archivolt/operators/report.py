"""Counts, histograms, summaries and ranked lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_counts(df: DataFrame, ts: str) -> DataFrame:
    """Rows per month, in order."""
    return df.groupBy(F.date_format(ts, "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n")).orderBy("month")


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(column))


def total_gib(df: DataFrame, size: str) -> DataFrame:
    """Total size in GiB, two decimals."""
    return df.agg(F.round(F.sum(F.col(size).cast("double")) / F.lit(1024.0**3), 2).alias("total_gib"))


def banded(df: DataFrame, score: str, bands: Sequence[tuple[str, float]]) -> DataFrame:
    """Rows and share of the total per band, empty bands included.

    ``bands`` are (label, lowest score), highest first.
    """
    label = None
    for name, low in bands:
        label = (F if label is None else label).when(F.col(score) >= low, name)
    # rows are counted by score first, so the score's own expression is there once and not once per band
    by_score = df.groupBy(score).agg(F.count(F.lit(1)).alias("n"))
    counts = by_score.groupBy(label.alias("band")).agg(F.sum("n").alias("n")).where("band IS NOT NULL")
    every = df.sparkSession.createDataFrame([(n,) for n, _ in bands], "band string")
    filled = every.join(counts, "band", "left").select("band", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    share = 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy())
    return filled.select("band", "n", F.round(F.coalesce(share, F.lit(0.0)), 1).alias("percent"))


def incomplete_fields(df: DataFrame, key: str, fields: Sequence[str], pos: str) -> DataFrame:
    """(key, field) where all rows of the key are blank, with the first row's position."""
    blank = lambda f: F.coalesce(F.trim(F.col(f).cast("string")) == "", F.lit(True))
    every = df.groupBy(key).agg(*[F.min(blank(f)).alias(f) for f in fields], F.min(pos).alias("first_pos"))
    names = F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in fields]))
    return every.select(key, F.explode(names).alias("field"), "first_pos")


def distinct_list(df: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """Distinct values per key in the order of their first occurrence."""
    firsts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.min(pos).alias("p"))
    ordered = F.array_sort(F.collect_list(F.struct("p", value)))
    return firsts.groupBy(key).agg(F.transform(ordered, lambda x: x[value]).alias("values"))


def message_prefixes(messages: DataFrame, column: str) -> DataFrame:
    """Messages per prefix before the first colon, ``Other`` without one."""
    kind = F.when(F.contains(F.col(column), F.lit(":")), F.substring_index(column, ":", 1)).otherwise("Other")
    return messages.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def run_summary(df: DataFrame, status: str, elapsed: str) -> DataFrame:
    """Rows by status and the gain of running side by side: sum over maximum."""
    return df.groupBy(status).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(elapsed).alias("average"),
        F.sum(elapsed).alias("total"),
        F.max(elapsed).alias("longest"),
        F.try_divide(F.sum(elapsed), F.max(elapsed)).alias("speed_up"),
    )


def joined_text(df: DataFrame, key: str, value: str, pos: str, separator: str = "; ") -> DataFrame:
    """Values per key as one text, in order."""
    ordered = F.array_sort(F.collect_list(F.struct(pos, value)))
    return df.where(F.col(value).isNotNull()).groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x[value]), separator).alias("text"))


def top_per_group(df: DataFrame, group: str, value: str, score: str, k: int) -> DataFrame:
    """The k best distinct (value, score) of each group with their rank; equal scores rank by value.

    Candidates collapse to distinct rows first, so a hot group sends each value once.
    """
    order = Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last(), F.col(value))
    return df.select(group, value, score).distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def score_filter(df: DataFrame, name: str, wanted: str, score: str, least: float) -> DataFrame:
    """Rows of a class with at least a score."""
    return df.where((F.col(name) == wanted) & (F.col(score) >= least))


def latest_per_key(df: DataFrame, key: str, value: str, ts: str, tie: str) -> DataFrame:
    """Value with the latest time per key."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(ts, tie)).alias(value), F.max(ts).alias(ts))


def page_slice(df: DataFrame, order: Sequence[str], start: int, end: int) -> DataFrame:
    """Rows start..end-1 of an ordered list."""
    return df.orderBy(*order).offset(start).limit(end - start)


def casefold_order(column: str, pos: str) -> list[Column]:
    """Order without regard to case, ties by position (O3)."""
    return [F.lower(column), F.col(pos)]
