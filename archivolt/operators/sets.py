"""Set operations, snapshot differences, filters and distinct rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from archivolt.session import cut


def snapshot_diff(latest: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Keys of only one of two snapshots with ``change``: added or removed (U1, I1). One shuffle for both directions."""
    sides = latest.select(key, F.lit(1).alias("_v")).unionByName(previous.select(key, F.lit(-1).alias("_v")))
    seen = sides.groupBy(key).agg(F.max("_v").alias("hi"), F.min("_v").alias("lo"))
    return seen.where("hi = lo").select(key, F.when(F.col("hi") == 1, "added").otherwise("removed").alias("change"))


def keyword_filter(df: DataFrame, column: str, all_of: Sequence[str] = (), any_of: Sequence[str] = ()) -> DataFrame:
    """Rows that contain all words or, if none are given, any of the others, by case (P5). No words: all rows."""
    hits = lambda ws: [F.coalesce(F.contains(F.col(column), F.lit(w)), F.lit(False)) for w in ws]
    if all_of:
        return df.where(reduce(lambda a, b: a & b, hits(all_of)))
    return df.where(reduce(lambda a, b: a | b, hits(any_of))) if any_of else df


def containing_any(df: DataFrame, column: str, words: Sequence[str]) -> DataFrame:
    """Distinct values with any of the words, sorted."""
    return keyword_filter(df, column, any_of=words).select(column).distinct().orderBy(column)


def excluding_any(df: DataFrame, column: str, words: Sequence[str]) -> DataFrame:
    """Rows with none of the words; repeated rows stay."""
    return df.where(~reduce(lambda a, b: a | b, [F.contains(F.col(column), F.lit(w)) for w in words]))


def in_scope(df: DataFrame, column: str, include: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Rows that match one of the include patterns and none of the exclude patterns."""
    c = F.col(column)
    keep = reduce(lambda a, b: a | b, [c.rlike(p) for p in include])
    drop = reduce(lambda a, b: a | b, [c.rlike(p) for p in exclude], F.lit(False))
    return df.where(keep & ~drop)


def outside_prefixes(df: DataFrame, column: str, prefixes: Sequence[str]) -> DataFrame:
    """Rows whose text starts with none of the prefixes (P3). A plain prefix: 'foo' also takes out 'foobar'."""
    return df.where(~reduce(lambda a, b: a | b, [F.startswith(F.col(column), F.lit(p)) for p in prefixes], F.lit(False)))


def by_entity_type(df: DataFrame, column: str, kind: str, blank_passes: bool) -> DataFrame:
    """Rows of an entity type; with ``blank_passes`` those without a type as well."""
    c = F.col(column)
    same = F.coalesce(c == kind, F.lit(False))
    return df.where(same | c.isNull() | (F.trim(c) == "") if blank_passes else same)


def between_open(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    """Rows strictly between two times."""
    return df.where((F.col(column) > F.lit(low).cast("timestamp_ntz")) & (F.col(column) < F.lit(high).cast("timestamp_ntz")))


def distinct_first_seen(df: DataFrame, column: str, pos: str) -> DataFrame:
    """Distinct values in the order in which they first occur: value, first position (A3)."""
    return df.groupBy(column).agg(F.min(pos).alias("first_pos"))


def union_wins_right(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Union in which the right side's row replaces the left's of the same key (U4)."""
    rest = [c for c in left.columns if c != key]
    both = left.withColumn("_p", F.lit(0)).unionByName(right.select(*left.columns).withColumn("_p", F.lit(1)))
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), "_p").alias("_r")).select(key, "_r.*").select(*left.columns)


def union_sources(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def seeds_with_constant(df: DataFrame, column: str, constant: str) -> DataFrame:
    """Distinct values, a constant always among them, sorted."""
    fixed = df.sparkSession.createDataFrame([(constant,)], f"{column} string")
    return df.select(column).unionByName(fixed).distinct().orderBy(column)


def merge_records(records: DataFrame, file_ord: str = "file_ord", pos: str = "pos", kind: str = "rec_type") -> DataFrame:
    """Records of several archives as one: of all information records only the first stays, others all do."""
    first = records.where(F.col(kind) == "warcinfo").agg(F.min(F.struct(file_ord, pos)).alias("_first"))
    return records.join(F.broadcast(first)).where(  # one row
        (F.col(kind) != "warcinfo") | ((F.col(file_ord) == F.col("_first").getField(file_ord)) & (F.col(pos) == F.col("_first").getField(pos)))
    ).drop("_first")


def merge_page_lists(lines: DataFrame, default_header: str) -> DataFrame:
    """Lines of several page lists as one list: file_ord, pos, line.

    The header of the first file with a readable one leads, ``default_header`` if none has; entries follow in
    their order. A file whose header can't be read contributes nothing.
    """
    header = F.get_json_object("line", "$.format")
    heads = lines.where("pos = 0").select("file_ord", F.col("line").alias("_head"), header.isNotNull().alias("_ok"))
    good = heads.where("_ok")
    lead = good.agg(F.coalesce(F.min_by("_head", "file_ord"), F.lit(default_header)).alias("line"))
    entries = lines.where("pos > 0 AND trim(line) <> ''").join(good.select("file_ord"), "file_ord", "left_semi")
    return lead.select(F.lit(-1).alias("file_ord"), F.lit(0).cast("long").alias("pos"), "line").unionByName(
        entries.select(F.col("file_ord").cast("int").alias("file_ord"), F.col("pos").cast("long").alias("pos"), "line")
    )


def dedupe_members(members: DataFrame, path: str, shard: str) -> DataFrame:
    """Member files of several shards, one per base name: the first shard's, then the first by path."""
    name = F.regexp_replace(path, r"^.*/", "")
    order = F.struct(F.col(shard), F.col(path))
    return members.groupBy(name.alias("name")).agg(F.min(order).alias("_o")).select("name", F.col("_o").getField(shard).alias(shard), F.col("_o").getField(path).alias(path))


def number_repeats(df: DataFrame, name: str, pos: str) -> DataFrame:
    """Names made unique: the n-th repetition becomes stem_n with its extension (A12). Null names stay null.

    Rows are numbered within ranges of (name, position), which split a frequent name, and shifted by the ranges before.
    """
    ranged = df.repartitionByRange(name, pos).withColumn("_part", F.spark_partition_id())
    # the split into ranges is drawn anew whenever it is computed, so it must be kept
    placed = cut(ranged.withColumn("_i", F.row_number().over(Window.partitionBy("_part", name).orderBy(pos)) - 1))
    sizes = placed.groupBy(F.col(name).alias("_name"), F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    shift = sizes.withColumn("_shift", F.sum("_n").over(Window.partitionBy("_name").orderBy("_p")) - F.col("_n")).drop("_n")
    numbered = placed.join(shift, placed[name].eqNullSafe(shift["_name"]) & (placed["_part"] == shift["_p"])).withColumn("_n", F.col("_i") + F.col("_shift"))
    stem, ext = F.regexp_replace(name, r"\.[^.]*$", ""), F.regexp_extract(name, r"(\.[^.]*)$", 1)
    unique = F.when(F.col("_n") == 0, F.col(name)).otherwise(F.concat(stem, F.lit("_"), F.col("_n").cast("string"), ext))
    return numbered.withColumn("unique_name", unique).select(*df.columns, "unique_name")
