"""Entity-attribute-value rows into one row per entity with typed columns, by positional stitching.

Entities get dense global ordinals. Every attribute is written as a typed column file over ordinal ranges: in the block of
an ordinal range, the value of the entity with the i-th ordinal stands at place i of an array of the attribute's type, and the
names of the entities are a column like the others. Rows are then assembled by position, block by block, reading only the columns that
are wanted. Before any of this a single-valued cell is reduced to its lowest and highest value and a multi-valued one to its
different values, on the map side first, so an entity that holds a third of all rows weighs no more than that.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.functions.text import strip
from archivolt.session import cut, scratch_path

#: Entities in an ordinal range, and attributes a schema may have.
BLOCK, MOST_ATTRIBUTES = 16384, 2000

SQL_TYPE = {"text": "string", "whole number": "bigint", "decimal number": "decimal(28,6)", "date": "date", "yes/no": "boolean"}


@dataclass(frozen=True)
class Attribute:
    name: str
    value_type: str
    multi_valued: bool

    @property
    def sql_type(self) -> str:
        kind = SQL_TYPE[self.value_type]
        return f"array<{kind}>" if self.multi_valued else kind


def attribute_key(col: Column) -> Column:
    """Spelling of an attribute without case, spacing and joining characters."""
    return F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]", "")


def entity_name(col: Column) -> Column:
    """Bare file name without path, trimmed, lower case."""
    return F.lower(strip(F.substring_index(F.replace(strip(col), F.lit("\\"), F.lit("/")), "/", -1)))


_NUMBER = r"[+-]?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)"


def _date(v: Column) -> Column:
    ymd = lambda y, m, d: F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")
    at = lambda i, n: F.substring(v, i, n)
    part = lambda i: F.split_part(v, F.lit("/"), F.lit(i))
    named = F.initcap(v)
    return (
        F.when(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9:.]+Z?)?\z"), at(1, 10).try_cast("date"))
        .when(v.rlike(r"^[0-9]{8}\z"), ymd(at(1, 4), at(5, 2), at(7, 2)))
        .when(v.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"), ymd(part(3), part(2), part(1)))
        .when(v.rlike(r"^[0-9]{1,2} \p{L}+ [0-9]{4}\z"), F.coalesce(F.try_to_date(named, "d MMMM yyyy"), F.when(v.rlike(r" \p{L}{3} "), F.try_to_date(named, "d MMM yyyy"))))
    )


def typed_value(v: Column, value_type: Column) -> Column:
    """Canonical text of a stripped term's value under its declared type; null where it has none.

    Equal values have equal texts whatever their notation. Slash dates are day first. A number may have a sign,
    thousands separators and, if decimal, a currency sign; whatever holds more or less than one number has no value.
    ``v`` should be a column, as it stands in many places.
    """
    bare = F.replace(v, F.lit(","), F.lit(""))
    whole = F.when(v.rlike(rf"^{_NUMBER}(?:[.]0+)?\z"), F.split_part(bare, F.lit("."), F.lit(1)).try_cast("bigint").cast("string"))
    amount = F.regexp_replace(v, r"^([+-]?)\s*[£$€]\s*|\s*[£$€]\z", "$1")
    decimal = F.when(
        amount.rlike(rf"^{_NUMBER}(?:[.][0-9]+)?\z|^[+-]?[.][0-9]+\z"),
        F.replace(amount, F.lit(","), F.lit("")).try_cast("decimal(28,6)").cast("string"),
    )
    low = F.lower(v)
    yes = F.when(low.isin("yes", "y", "true", "t", "1"), "true").when(low.isin("no", "n", "false", "f", "0"), "false")
    return (
        F.when(value_type == "text", F.when(v.rlike(r"[\t\n\x0B\f\r]|  "), F.regexp_replace(low, r"\s+", " ")).otherwise(low))
        .when(value_type == "whole number", whole)
        .when(value_type == "decimal number", decimal)
        .when(value_type == "date", _date(v).cast("string"))
        .when(value_type == "yes/no", yes)
    )


def attributes_of(classes: DataFrame) -> list[Attribute]:
    """The attribute list, which makes the schema and so must be small; more than MOST_ATTRIBUTES are refused."""
    rows = classes.select("rulebase_class", "value_type", "multi_valued").orderBy("rulebase_class").limit(MOST_ATTRIBUTES + 1).collect()
    if len(rows) > MOST_ATTRIBUTES:
        raise ValueError(f"more than {MOST_ATTRIBUTES} attributes")
    return [Attribute(r[0], r[1], bool(r[2])) for r in rows]


def distinct_cells(rows: DataFrame, attributes: Iterable[Attribute]) -> DataFrame:
    """Cells by entity and attribute (its number): entity, attribute, value, conflict.

    A single-valued attribute has one row, with its lowest value; ``conflict`` says that there is another. A multi-valued
    one has a row per different value. ``value`` is null where no term has a value of the declared type; texts are
    given as written, the first spelling in order. Blank terms, entities and unknown attributes are left out.
    """
    known = rows.sparkSession.createDataFrame(
        [(i, "".join(ch for ch in a.name.lower() if ch.isalnum()), a.value_type, a.multi_valued) for i, a in enumerate(attributes)],
        "attribute int, _key string, value_type string, multi boolean",
    )
    term = strip(F.col("term"))
    typed = (
        # made by a generator, as the filters below would otherwise compute every expression a second time in the scan
        rows.select(F.inline(F.array(F.struct(entity_name(F.col("document")).alias("entity"), attribute_key(F.col("rulebase_class")).alias("_key"), term.alias("term")))))
        .where("term <> '' AND entity <> ''")
        .join(F.broadcast(known), "_key")  # at most MOST_ATTRIBUTES rows
        .select("entity", "attribute", "multi", "term", F.col("value_type") == "text", typed_value(F.col("term"), F.col("value_type")).alias("value"))
        .toDF("entity", "attribute", "multi", "term", "text", "value")
    )
    shown = F.struct(F.col("value").alias("value"), F.when(F.col("text"), F.col("term")).otherwise(F.col("value")).alias("shown"))
    return (
        typed.groupBy("entity", "attribute", F.when(F.col("multi"), F.col("value")).alias("_own"))
        .agg(F.min(F.when(F.col("value").isNotNull(), shown)).alias("low"), F.max("value").alias("high"))
        .select("entity", "attribute", F.col("low.shown").alias("value"), F.coalesce(F.col("low.value") != F.col("high"), F.lit(False)).alias("conflict"))
    )


def with_ordinals(entities: DataFrame, name: str) -> DataFrame:
    """Dense global ordinals 0..n-1 of a table of distinct names, in their order.

    Ranges are numbered apart and then shifted by the sizes of those before them; no row passes through one task.
    """
    local = Window.partitionBy("_part").orderBy(name)
    placed = entities.repartitionByRange(name).withColumn("_part", F.spark_partition_id())
    # the split into ranges is drawn anew whenever it is computed, so it must be kept
    numbered = cut(placed.withColumn("_i", F.row_number().over(local) - 1))
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    shift = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_shift"))
    return numbered.join(shift, "_part").select(name, (F.col("_shift") + F.col("_i")).cast("long").alias("ordinal"))


#: The column of a block that holds an attribute's values, by their type, and how a canonical text becomes such a value.
COLUMNS = {
    "text": ("texts", "array<string>", str),
    "whole number": ("wholes", "array<bigint>", int),
    "decimal number": ("decimals", "array<decimal(28,6)>", Decimal),
    "date": ("dates", "array<date>", dt.date.fromisoformat),
    "yes/no": ("flags", "array<boolean>", "true".__eq__),
}
LISTS = ("lists", "array<array<string>>")
#: Number of the entities' names among the attributes, and codes of issues.
NAMES, CONFLICT, UNREADABLE = -1, 1, 2


def column_files(cells: DataFrame, attributes: list[Attribute], block: int = BLOCK) -> DataFrame:
    """Column files of an entity-attribute-value table, written below the shared folder by attribute.

    One row per attribute and ordinal range: attribute, block, the array of the attribute's type (the others are null), and
    issues (array of codes, 0 for none). An attribute without any value in a range has no row there.
    """
    spark = cells.sparkSession
    cells = cut(cells)  # read twice
    ordinals = cut(with_ordinals(cells.select("entity").distinct(), "entity"))
    at = (F.floor(F.col("ordinal") / block).alias("block"), (F.col("ordinal") % block).cast("int").alias("place"))
    placed = cells.join(ordinals, "entity").select("attribute", *at, "value", "conflict")
    names = ordinals.select(F.lit(NAMES).alias("attribute"), *at, F.col("entity").alias("value"), F.lit(False).alias("conflict"))
    kinds = {NAMES: ("text", False)} | {i: (a.value_type, a.multi_valued) for i, a in enumerate(attributes)}
    typed = [*((c, t) for c, t, _ in COLUMNS.values()), LISTS]
    by_type = {k: (c, f) for k, (c, _, f) in COLUMNS.items()}

    def column(rows: pd.DataFrame) -> pd.DataFrame:
        attribute, n = int(rows.attribute.iloc[0]), int(rows.place.max()) + 1
        kind, multi = kinds[attribute]
        name, read = by_type[kind]
        out, issues = [None] * n, np.zeros(n, np.int8)
        places, values = rows.place.to_numpy(), rows.value.to_numpy()
        if multi:
            name = LISTS[0]
            for place, value in sorted((p, v) for p, v in zip(places.tolist(), values) if v is not None):
                if out[place] is None:
                    out[place] = []
                out[place].append(value)
        else:
            conflict = rows.conflict.to_numpy(dtype=bool)
            for place, value, two in zip(places.tolist(), values, conflict):
                out[place] = read(value) if value is not None and not two else None
            missing = rows.value.isna().to_numpy()
            issues[places[conflict]], issues[places[missing]] = CONFLICT, UNREADABLE
        row = {"attribute": attribute, "block": int(rows.block.iloc[0])} | {c: None for c, _ in typed} | {name: out, "issues": issues.tolist()}
        return pd.DataFrame({k: pd.Series([v], dtype=object if isinstance(v, list) or v is None else None) for k, v in row.items()})

    schema = ", ".join(["attribute int, block long", *(f"{c} {t}" for c, t in typed), "issues array<tinyint>"])
    path = scratch_path(spark, "columns")
    placed.unionByName(names).groupBy("attribute", "block").applyInPandas(column, schema).write.partitionBy("attribute").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _by_position(files: DataFrame, columns: dict[str, tuple[int, str]]) -> DataFrame:
    """Rows assembled by position: the i-th elements of all the given (attribute, column) of a block make a row."""
    picked = files.groupBy("block").agg(*[F.first(F.when(F.col("attribute") == i, F.col(c)), ignorenulls=True).alias(name) for name, (i, c) in columns.items()])
    kinds = {f.name: f.dataType for f in picked.schema}
    whole = picked.select(*[F.coalesce(name, F.array().cast(kinds[name])).alias(name) for name in columns])
    return whole.select(F.inline(F.arrays_zip(*columns)))


def _issue(code: str) -> Column:
    return F.when(F.col(code) == CONFLICT, "conflict").when(F.col(code) == UNREADABLE, "unreadable")


def assemble(files: DataFrame, attributes: list[Attribute]) -> DataFrame:
    """One row per entity: entity, a typed column per attribute, ``issues`` (array of attribute and issue).

    A single-valued attribute with two or more different values is null and has the issue conflict; one that has
    terms but no readable value is null and has the issue unreadable. Multi-valued columns hold the sorted different
    values. An entity none of whose terms is readable keeps its row, one without any filled term has none.
    """
    columns = {"entity": (NAMES, "texts")}
    for i, a in enumerate(attributes):
        columns |= {f"v{i}": (i, LISTS[0] if a.multi_valued else COLUMNS[a.value_type][0]), f"i{i}": (i, "issues")}
    rows = _by_position(files, columns)
    issues = [F.when(F.col(f"i{i}") > 0, F.struct(F.lit(a.name).alias("attribute"), _issue(f"i{i}").alias("issue"))) for i, a in enumerate(attributes)]
    none = F.array().cast("array<struct<attribute:string,issue:string>>")
    return rows.select("entity", *[F.col(f"v{i}").cast(a.sql_type).alias(a.name) for i, a in enumerate(attributes)], (F.array_compact(F.array(*issues)) if issues else none).alias("issues"))


def widen(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Wide table of an entity-attribute-value table with columns document, rulebase_class and term."""
    attributes = attributes_of(classes)
    return assemble(column_files(distinct_cells(rows, attributes), attributes), attributes)


def unfillable(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Cells that cannot be filled plainly: document, rulebase_class, issue. Of the column files only names and issues are read."""
    attributes = attributes_of(classes)
    files = column_files(distinct_cells(rows, attributes), attributes)
    placed = _by_position(files, {"document": (NAMES, "texts")} | {f"i{i}": (i, "issues") for i in range(len(attributes))})
    found = F.array_compact(F.array(*[F.when(F.col(f"i{i}") > 0, F.struct(F.lit(a.name).alias("rulebase_class"), _issue(f"i{i}").alias("issue"))) for i, a in enumerate(attributes)]))
    return placed.select("document", F.explode(found).alias("x")).select("document", "x.*") if attributes else placed.select("document", F.lit("").alias("rulebase_class"), F.lit("").alias("issue")).where("false")
