"""Repeated fields as flat columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that a repeated field may take in a flat table.
MOST_COLUMNS = 5000


def multiplicity(values: DataFrame, entity: str, field: str) -> DataFrame:
    """Greatest number of values that one entity has of each field (A10)."""
    per_entity = values.groupBy(entity, field).agg(F.count(F.lit(1)).alias("n"))
    return per_entity.groupBy(field).agg(F.max("n").alias("width"))


def ragged_pivot(values: DataFrame, entity: str, field: str, value: str, pos: str) -> DataFrame:
    """One row per entity; a field with at most w values takes the columns field, field.2 ... field.w.

    Cells without a value are ''. The widths of all fields are read first; they make the schema, so they are bounded.
    """
    widths = sorted((r[field], r["width"]) for r in multiplicity(values, entity, field).limit(MOST_COLUMNS + 1).collect())
    if sum(w for _, w in widths) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} columns")
    lists = values.groupBy(entity, field).agg(F.transform(F.array_sort(F.collect_list(F.struct(pos, value))), lambda x: x[value]).alias("v"))
    wide = lists.groupBy(entity).agg(*[F.max(F.when(F.col(field) == f, F.col("v"))).alias(f"_{i}") for i, (f, _) in enumerate(widths)])
    cells = [
        F.coalesce(F.get(F.col(f"_{i}"), F.lit(k)), F.lit("")).alias(f if k == 0 else f"{f}.{k + 1}") for i, (f, w) in enumerate(widths) for k in range(w)
    ]
    return wide.select(entity, *cells)


def collect_repeated(df: DataFrame, base: str, columns: Sequence[str]) -> Column:
    """Array of the filled values of a repeated column's copies, in column order."""
    return F.filter(F.array(*[F.col(f"`{c}`") for c in columns]), lambda v: F.coalesce(F.trim(v) != "", F.lit(False))).alias(base)


def to_elements(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, pos, name, value) of the filled cells of each row, in column order."""
    cells = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(columns)])
    return df.select(key, F.explode(cells).alias("e")).select(key, "e.*").where("trim(value) <> ''")


def xml_escape(value: Column) -> Column:
    """Text safe in XML; the ampersand first."""
    v = F.replace(value, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(v, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def xml_changes(value: Column) -> Column:
    """'before<>after' where escaping changes a value, else null."""
    return F.when(value != xml_escape(value), F.concat(value, F.lit("<>"), xml_escape(value)))


def xml_rows(elements: DataFrame, key: str, root: str, prefix: str) -> DataFrame:
    """One XML document per key from its elements: key, xml.

    Of a repeated element only filled copies are written; a single blank one stays as an empty element.
    """
    name = F.concat(F.lit(prefix + ":"), F.col("name"))
    tag = F.concat(F.lit("<"), name, F.lit(">"), xml_escape(F.coalesce("value", F.lit(""))), F.lit("</"), name, F.lit(">"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", tag.alias("t")))), lambda x: x["t"]), "")
    return elements.groupBy(key).agg(F.concat(F.lit(f"<{root}>"), body, F.lit(f"</{root}>")).alias("xml"))


def html_list_lines(df: DataFrame, order: str, text: str) -> DataFrame:
    """The rows as lines of an HTML list: place (as ordered; the list's own tags have none), line (K5). Sort by ``part``, then place."""
    items = df.select(F.lit(1).alias("part"), F.col(order).alias("place"), F.concat(F.lit("<li>"), xml_escape(F.coalesce(text, F.lit(""))), F.lit("</li>")).alias("line"))
    tags = df.sparkSession.createDataFrame([(0, "<ul>"), (2, "</ul>")], "part int, line string")
    return items.unionByName(tags, allowMissingColumns=True)


def folder_manifests(files: DataFrame, path: str) -> DataFrame:
    """Files of each folder with their kind in a manifest, sorted by name: folder, files."""
    name, folder = F.regexp_replace(path, r"^.*/", ""), F.regexp_replace(path, r"/?[^/]*$", "")
    kind = F.when(F.contains(F.lower(name), F.lit("opex")), "metadata").otherwise("content")
    return files.groupBy(folder.alias("folder")).agg(F.array_sort(F.collect_list(F.struct(name.alias("name"), kind.alias("kind")))).alias("files"))
