"""Joining metadata tables on a shared identifier."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.functions.text import or_empty


def best_row(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """One row per key: the one with most non-null cells, the first by ``pos`` among equals (A1).

    Rows with a null key form one group. The order column must be unique for a defined result.
    """
    cells = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in df.columns if c != pos])
    rest = [c for c in df.columns if c not in keys]
    # combines on the map side, so a key with many rows, the null key too, sends one row per task
    best = df.withColumn("_order", F.struct((-cells).alias("cells"), F.col(pos).alias("pos"))).groupBy(*keys).agg(F.min_by(F.struct(*rest), "_order").alias("_r"))
    return best.select(*keys, "_r.*").select(*df.columns)


def first_row(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """One row per key: the first by ``pos`` (A2). Combines on the map side, unlike a window."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(pos)).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def last_row(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """One row per key: the last by ``pos`` (A5)."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(pos)).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def merge_tables(master: DataFrame, others: Sequence[tuple[DataFrame, str]], key: str) -> DataFrame:
    """Left joins of ``others`` to ``master``, in order.

    Each of ``others`` is (table, order column). Its best row per key is taken, so the number of master's rows stays;
    master itself keeps its repeated keys. Only columns that aren't there yet come in: the first table that
    has a column wins. Null keys match null keys.
    """
    out = master
    for other, pos in others:
        new = [c for c in other.columns if c not in out.columns and c != pos]
        side = best_row(other, [key], pos).select(F.col(key).alias("_k"), *new)
        out = out.join(side, out[key].eqNullSafe(side["_k"]), "left").drop("_k")
    return out


def fallback_values(master: DataFrame, preferred: DataFrame, other: DataFrame, key: str, values: str, pos: str, into: str) -> DataFrame:
    """Array ``into``: the preferred source's values if it has any, else the other's.

    Both sources are looked up by the first row of a key in their own order, not by the best one.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias(f"_k{name}")).agg(F.min_by(values, pos).alias(name))

    a, b = side(preferred, "_a"), side(other, "_b")
    joined = master.join(a, master[key].eqNullSafe(a["_k_a"]), "left").join(b, master[key].eqNullSafe(b["_k_b"]), "left")
    return joined.withColumn(into, F.when(F.size("_a") > 0, F.col("_a")).otherwise(F.col("_b"))).drop("_a", "_b", "_k_a", "_k_b")


def change_set(current: DataFrame, desired: DataFrame, key: str, fields: Sequence[str], strict: Sequence[str] = ()) -> DataFrame:
    """Fields to update: key, field, current_value, desired_value.

    Null equals '' except in ``strict`` fields. Keys on one side only have no row.
    """
    c = current.select(key, F.struct(*fields).alias("c"))
    d = desired.select(key, F.struct(*fields).alias("d"))

    def row(f: str) -> Column:
        a, b = F.col(f"c.{f}").cast("string"), F.col(f"d.{f}").cast("string")
        differs = ~a.eqNullSafe(b) if f in strict else or_empty(a) != or_empty(b)
        return F.when(differs, F.struct(F.lit(f).alias("field"), a.alias("current_value"), b.alias("desired_value")))

    return c.join(d, key).select(key, F.explode(F.array_compact(F.array(*map(row, fields)))).alias("x")).select(key, "x.*")


def resolve_entity(refs: DataFrame, assets: DataFrame, folders: DataFrame, key: str) -> DataFrame:
    """Refs with what they name: asset, else folder, else null in ``found_as``."""
    a = assets.select(key).distinct().withColumn("_a", F.lit(True))
    f = folders.select(key).distinct().withColumn("_f", F.lit(True))
    return (
        refs.join(a, key, "left")
        .join(f, key, "left")
        .withColumn("found_as", F.when(F.col("_a"), "asset").when(F.col("_f"), "folder"))
        .drop("_a", "_f")
    )


def pair_sidecars(files: DataFrame, path: str, media: Sequence[str], sidecar: str) -> DataFrame:
    """Media files with ``has_sidecar``: a file of the same stem and the sidecar's extension exists."""
    stem, ext = F.regexp_replace(path, r"\.[^./]*$", ""), F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))
    placed = files.select(path, stem.alias("_stem"), ext.alias("_ext"))
    side = placed.where(F.col("_ext") == sidecar).select("_stem").distinct().withColumn("_has", F.lit(True))
    return (
        placed.where(F.col("_ext").isin(*media)).join(side, "_stem", "left").select(path, F.coalesce("_has", F.lit(False)).alias("has_sidecar"))
    )


def rename_plan(wanted: DataFrame, present: DataFrame, name: str, title: str) -> DataFrame:
    """Renames of present files: old_name, new_name = trimmed title and the old extension."""
    new = F.concat(F.trim(title), F.regexp_extract(name, r"(\.[^.]*)$", 1))
    return wanted.join(present.select(name).distinct(), name).select(F.col(name).alias("old_name"), new.alias("new_name"))


def assert_unique(df: DataFrame, column: str) -> DataFrame:
    """Values of a key column that are repeated, null or blank, with their number (A18); empty when all is well."""
    v = F.col(column)
    return df.groupBy(v.alias(column)).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(column).isNull() | (F.trim(column) == ""))


def template_columns(columns: Sequence[str], base: str) -> list[str]:
    """Names of a repeated column, as ``base`` or ``base`` with a numeric suffix."""
    import re

    return [c for c in columns if re.fullmatch(re.escape(base) + r"(\.\d+)?", c)]
