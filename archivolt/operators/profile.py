"""Column profiles kept as value-count tables.

A value-count table has one row per key, column and distinct value with a signed count. A load is a delta of such
rows; adding deltas maintains the table, and every profile metric (null rate, distinct count, pattern violations,
range, top share, entropy, exact median) is an algebraic function of the maintained counts. Nothing is sampled and
no metric needs the base rows again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archivolt.functions.text import filled

DATE_SHAPE = r"^(?!0000)[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?\z"


def partial_date_year(value: Column) -> Column:
    """Year of a real date written YYYY, YYYY-MM or YYYY-MM-DD, else null."""
    whole = F.when(F.length(value) == 4, F.concat(value, F.lit("-01-01"))).when(
        F.length(value) == 7, F.concat(value, F.lit("-01"))
    ).otherwise(value)
    day = F.try_to_date(F.when(value.rlike(DATE_SHAPE), whole), "yyyy-MM-dd")
    return F.when(day.isNotNull(), F.substring(value, 1, 4).cast("int"))


@dataclass(frozen=True)
class ColumnRule:
    """What is measured of one column.

    ``fits`` tells whether a filled cell keeps the column's pattern (None: no pattern), ``measure`` gives the
    integer whose median is taken (None: no median).
    """

    fits: object = None
    measure: object = None


def matches(pattern: str):
    return lambda v: F.coalesce(v.rlike(rf"^(?:{pattern})\z"), F.lit(False))


#: Rules by kind of column.
PARTIAL_DATE = ColumnRule(fits=lambda v: partial_date_year(v).isNotNull(), measure=partial_date_year)
TEXT = ColumnRule(measure=lambda v: F.char_length(v))
MEDIA_TYPE = ColumnRule(fits=matches(r"[a-z]+/[a-z0-9][a-z0-9.+-]*"))


def value_counts(df: DataFrame, keys: Sequence[str], rules: Mapping[str, ColumnRule], sign: int = 1) -> DataFrame:
    """Value-count rows of ``df``: keys, column_name, value, n.

    Null and blank cells are kept as the value null, so the missing count is maintained too. ``sign`` -1 makes a
    retraction. An empty table gives no rows. Repeated rows count as often as they stand there.
    """
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.when(filled(F.col(c)), F.col(c)).alias("value")) for c in rules])
    )
    return (
        df.select(*keys, cells.alias("_c"))
        .groupBy(*keys, F.col("_c.column_name").alias("column_name"), F.col("_c.value").alias("value"))
        .agg((F.count(F.lit(1)) * F.lit(sign)).alias("n"))
    )


def apply_deltas(state: DataFrame | None, *deltas: DataFrame) -> DataFrame:
    """The value-count table after adding signed deltas; rows whose count falls to zero leave it."""
    parts = [d for d in (state, *deltas) if d is not None]
    keys = [c for c in parts[0].columns if c != "n"]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


class ValueCountStore:
    """Persistent value-count table: a folder of signed deltas over a base, Parquet by column.

    ``apply`` writes nothing but the delta of the loads it is given, so its cost follows from them and not from the state; reading adds
    the deltas to the base. After MOST_DELTAS deltas the state is written as a new base and the folders it
    replaces are deleted. A folder counts once its ``_SUCCESS`` file exists, so an interrupted write changes nothing.
    """

    #: Deltas that reading adds up at most.
    MOST_DELTAS = 16

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._schema = spark, path, None
        self._at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        root = self._at(path)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _folders(self) -> list[tuple[int, str]]:
        """(number, kind) of all complete folders in order; kind is base or delta."""
        root = self._at(self.path)
        names = [s.getPath().getName().split("-") for s in self._fs.listStatus(root)] if self._fs.exists(root) else []
        known = sorted((int(n), kind) for n, kind in (x for x in names if len(x) == 2 and x[0].isdigit()))
        return [(n, kind) for n, kind in known if self._fs.exists(self._at(f"{self.path}/{n}-{kind}/_SUCCESS"))]

    def _live(self) -> list[tuple[int, str]]:
        """The last base and the deltas after it."""
        known = self._folders()
        last = max((n for n, kind in known if kind == "base"), default=0)
        return [(n, kind) for n, kind in known if n > last or (n, kind) == (last, "base")]

    def version(self) -> int:
        """Number of the last change, 0 where there is none."""
        return max((n for n, _ in self._folders()), default=0)

    def read(self) -> DataFrame | None:
        reader = self.spark.read.schema(self._schema) if self._schema else self.spark.read
        folders = [f"{self.path}/{n}-{kind}" for n, kind in self._live()]
        if not self._schema:  # nothing can be told from a folder without rows
            folders = [x for x in folders if any("=" in s.getPath().getName() for s in self._fs.listStatus(self._at(x)))]
        parts = [reader.parquet(x) for x in folders]
        return parts[0] if len(parts) == 1 else apply_deltas(*parts) if parts else None

    def _write(self, counts: DataFrame, n: int, kind: str) -> None:
        counts.write.mode("overwrite").partitionBy("column_name").parquet(f"{self.path}/{n}-{kind}")

    def apply(self, *deltas: DataFrame) -> DataFrame:
        """Adds signed deltas, each with at most one row per key, column and value, and gives the state after them."""
        self._schema = deltas[0].schema
        self._write(apply_deltas(None, *deltas) if len(deltas) > 1 else deltas[0].where("n <> 0"), self.version() + 1, "delta")
        if len(self._live()) > self.MOST_DELTAS:
            self.compact()
        return self.read()

    def compact(self) -> None:
        """Writes the state as a base and deletes what it replaces."""
        replaced, n = self._folders(), self.version() + 1
        self._write(self.read(), n, "base")
        for m, kind in replaced:
            self._fs.delete(self._at(f"{self.path}/{m}-{kind}"), True)


def profile(counts: DataFrame, keys: Sequence[str], rules: Mapping[str, ColumnRule]) -> DataFrame:
    """Profile metrics per key and column from a value-count table.

    Columns: keys, column_name, n_rows, n_missing, n_filled, n_distinct, n_broken (null without a pattern), n_top,
    top_value (smallest of the most frequent), min_value, max_value, entropy_bits, middle (exact median of the
    column's measure; null without one or without measurable cells). A column with no filled cell has n_filled 0
    and null for whatever needs a value.
    """
    value, name, n = F.col("value"), F.col("column_name"), F.col("n")

    def per_column(kind: str) -> Column:
        out = None
        for column, rule in rules.items():
            if (f := getattr(rule, kind)) is not None:
                out = (F if out is None else out).when((name == column) & value.isNotNull(), f(value))
        return out if out is not None else F.lit(None)

    measured = counts.select(
        *keys, name, value, n, per_column("fits").cast("boolean").alias("fits"), per_column("measure").cast("long").alias("measure")
    )
    present = value.isNotNull()
    top = F.struct(n.alias("n"), value.alias("value"))
    histogram = measured.groupBy(*keys, "column_name", "measure").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~present, n)), F.lit(0)).alias("n_missing"),
        F.count_if(present).alias("n_distinct"),
        F.sum(F.when(F.col("fits").isNotNull(), F.when(F.col("fits"), 0).otherwise(n))).alias("n_broken"),
        F.max(F.when(present, n)).alias("n_top"),
        F.min(F.when(present, F.struct((-n).alias("k"), value.alias("value")))).alias("_top"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.coalesce(F.sum(F.when(present, n * F.log2(n))), F.lit(0.0)).alias("_nlogn"),
    )
    group = [*keys, "column_name"]
    upto = Window.partitionBy(*group).orderBy(F.col("measure").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    is_measured = F.when(F.col("measure").isNotNull(), F.col("n_rows"))
    ranked = histogram.withColumn("_upto", F.sum(is_measured).over(upto)).withColumn(
        "_all", F.sum(is_measured).over(Window.partitionBy(*group))
    )
    # the two middle places of an exact median; they coincide for an odd number
    low, high = (F.col("_all") + 1).cast("long") / 2, F.floor(F.col("_all") / 2) + 1
    reaches = lambda place: F.min(F.when(F.col("measure").isNotNull() & (F.col("_upto") >= F.floor(place)), F.col("measure")))
    filled_rows = F.col("n_rows") - F.col("n_missing")
    return (
        ranked.groupBy(*group)
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_missing").alias("n_missing"),
            F.sum("n_distinct").alias("n_distinct"),
            F.sum("n_broken").alias("n_broken"),
            F.coalesce(F.max("n_top"), F.lit(0)).alias("n_top"),
            F.min("_top").alias("_top"),
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
            F.sum("_nlogn").alias("_nlogn"),
            ((reaches(low) + reaches(high)) / 2).alias("middle"),
        )
        .select(
            *group,
            "n_rows",
            "n_missing",
            filled_rows.alias("n_filled"),
            "n_distinct",
            "n_broken",
            "n_top",
            F.col("_top.value").alias("top_value"),
            "min_value",
            "max_value",
            F.when(filled_rows > 0, F.greatest(F.lit(0.0), F.log2(filled_rows) - F.col("_nlogn") / filled_rows)).alias("entropy_bits"),
            "middle",
        )
    )


#: Shares are quotients of integers; a difference that equals its limit must not be lost to rounding.
ROUNDING = 1e-9


def breaks(
    profiles: DataFrame,
    series: str,
    load: str,
    null_rate: Mapping[str, float],
    pattern_rate: Mapping[str, float],
    distinct_rate: Mapping[str, float],
    top_share: Mapping[str, float],
    middle_step: Mapping[str, float],
    middle_factor: Mapping[str, float],
) -> DataFrame:
    """Findings (load, column_name, finding) where a profile breaks from the preceding load of its series.

    Each mapping gives the limit by column; a column that it lacks isn't tested. A rate that is undefined on either
    side (no filled cell) gives no finding, nor does the first load of a series.
    """
    before = Window.partitionBy(series, "column_name").orderBy(load)
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    rates = profiles.select(
        series,
        load,
        "column_name",
        share("n_missing", "n_rows").alias("null_rate"),
        share("n_broken", "n_filled").alias("pattern_rate"),
        share("n_distinct", "n_filled").alias("distinct_rate"),
        share("n_top", "n_filled").alias("top_share"),
        "middle",
    )

    def limit(by: Mapping[str, float]) -> Column:
        out = None
        for column, x in by.items():
            out = (F if out is None else out).when(F.col("column_name") == column, F.lit(float(x)))
        return out if out is not None else F.lit(None).cast("double")

    tests = []
    for metric, by in (("null_rate", null_rate), ("pattern_rate", pattern_rate), ("distinct_rate", distinct_rate), ("top_share", top_share)):
        moved = F.abs(F.col(metric) - F.lag(metric).over(before)) >= limit(by) - ROUNDING
        tests.append(F.when(moved, F.lit(metric)))
    now, last = F.col("middle"), F.lag("middle").over(before)
    step = F.abs(now - last) >= limit(middle_step) - ROUNDING
    factor = F.greatest(now, last) >= limit(middle_factor) * F.least(now, last) - ROUNDING
    tests.append(F.when(now.isNotNull() & last.isNotNull() & (F.coalesce(step, F.lit(False)) | F.coalesce(factor, F.lit(False))), F.lit("middle")))
    return rates.select(load, "column_name", F.array_compact(F.array(*tests)).alias("_f")).select(
        load, "column_name", F.explode("_f").alias("finding")
    )
