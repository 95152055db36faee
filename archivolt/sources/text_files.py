"""Line, list, CSV, JSON and log sources. Every reader keeps positions, as later steps rely on list order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.functions.text import is_url, strip

#: One record of a CSV file; quoted cells may hold line breaks.
_RECORD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^"\r\n])++'


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line) of text files, read whole per file so that positions are exact."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return text.select("file", F.posexplode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n")).alias("pos", "line"))


def lines(spark: SparkSession, path: str, comments: str | None = None) -> DataFrame:
    """Stripped lines that aren't blank (S4); with ``comments`` those that start with it are dropped."""
    rows = spark.read.text(path)
    if comments:
        rows = rows.where(~F.startswith("value", F.lit(comments)))
    return rows.select(strip(F.col("value")).alias("line")).where("line <> ''")


def url_list(spark: SparkSession, path: str, keep_blank: bool = False, only_valid: bool = False) -> DataFrame:
    """Distinct addresses of a list. A blank line is an address '' if ``keep_blank`` (S7), invalid ones go if asked."""
    url = strip(F.col("value"))
    rows = spark.read.text(path).select(url.alias("url"))
    if not keep_blank:
        rows = rows.where("url <> ''")
    return (rows.where(is_url(F.col("url"))) if only_valid else rows).distinct()


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """CSV files as raw records: file_name, line_no (0: header), raw_line, exported_at.

    The form that the drift operators read: headers may repeat names and differ from file to file.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "modificationTime", F.decode("content", "UTF-8").alias("text"))
    records = F.regexp_extract_all("text", F.lit(_RECORD), F.lit(0))
    return files.select(
        F.regexp_replace("path", r"^.*/", "").alias("file_name"), F.col("modificationTime").cast("timestamp_ntz").alias("exported_at"), F.posexplode(records).alias("line_no", "raw_line")
    ).withColumn("line_no", F.col("line_no").cast("long"))


def csv_table(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    """One CSV file with string columns; repeated names get the suffixes .1, .2 (S1, S3). Missing columns raise ValueError."""
    head = spark.read.option("header", False).option("multiLine", True).csv(path).limit(1).collect()
    names: list[str] = []
    seen: dict[str, int] = {}
    for name in [str(c or "").replace("﻿", "") for c in head[0]] if head else []:
        n = seen.get(name, 0)
        seen[name] = n + 1
        names.append(name if n == 0 else f"{name}.{n}")
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", True).option("escape", '"').csv(path)


def checksum_report(spark: SparkSession, path: str, algorithm: str) -> DataFrame:
    """Distinct lower-case digests of a report.

    A CSV file with a column whose name holds the algorithm gives that column; any other file gives its lines.
    """
    head = spark.read.option("header", False).csv(path).limit(1).collect()
    at = next((i for i, c in enumerate(head[0]) if c and algorithm.lower() in c.lower()), None) if head else None
    if at is None:
        values = spark.read.text(path).select(F.lower(strip(F.col("value"))).alias("digest"))
    else:
        values = spark.read.option("header", True).csv(path)
        values = values.select(F.lower(strip(F.col(f"`{values.columns[at]}`"))).alias("digest"))
    return values.where("digest <> ''").distinct()


def taxonomy_lines(spark: SparkSession, path: str) -> DataFrame:
    """Terms of a list in which each stands after '- ' (S28)."""
    return spark.read.text(path).where("startswith(value, '- ')").select(strip(F.expr("substring(value, 3)")).alias("term")).where("term <> ''")


def classifier_output(text: Column, start: str, end: str) -> Column:
    """(term, score) pairs of a classifier's printed result between two markers."""
    import re

    body = F.regexp_extract(text, "(?s)" + re.escape(start) + "(.*?)" + re.escape(end), 1)
    pairs = F.regexp_extract_all(body, F.lit(r"(?m)^\s*(.+?)[\t:=]\s*[0-9.]+\s*$"), F.lit(1))
    scores = F.regexp_extract_all(body, F.lit(r"(?m)^\s*.+?[\t:=]\s*([0-9.]+)\s*$"), F.lit(1))
    return F.zip_with(pairs, scores, lambda t, s: F.struct(t.alias("term"), s.cast("double").alias("score")))


def cdx_rows(spark: SparkSession, path: str, distinct_digest: bool = True) -> DataFrame:
    """Captures of a CDX answer, an array of arrays with a header row: pos, timestamp, url, digest."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<array<string>>")).alias("pos", "r")).where("pos > 0")
    out = rows.select("pos", F.get("r", F.lit(1)).alias("timestamp"), F.get("r", F.lit(2)).alias("url"), F.get("r", F.lit(5)).alias("digest"))
    if not distinct_digest:
        return out
    return out.groupBy("digest").agg(F.min_by(F.struct("pos", "timestamp", "url"), "pos").alias("x")).select("x.pos", "x.timestamp", "x.url", "digest")


PAGE = "url string, title string, status int, text string, hasText boolean, ts string"


def page_list(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a JSONL page list; the header and unreadable lines are dropped."""
    return spark.read.schema(PAGE).json(path).where("url IS NOT NULL")


def unreadable_lines(spark: SparkSession, path: str) -> DataFrame:
    """Filled lines of a JSONL page list that aren't JSON objects: file, line."""
    rows = spark.read.text(path).select(F.regexp_replace(F.input_file_name(), r"^.*/", "").alias("file"), F.col("value").alias("line"))
    parsed = F.from_json("line", "url string, format string, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return rows.where(F.trim("line") != "").where(F.coalesce(parsed["_bad"].isNotNull(), F.lit(True)))


def without_text(pages: DataFrame) -> DataFrame:
    """Page entries without their text, flagged accordingly where a flag is there (P25)."""
    out = pages.drop("text")
    return out.withColumn("hasText", F.lit(False)) if "hasText" in pages.columns else out


_ENTRY = r"(?s)--\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}--.*?(?=--\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}--|\z)"


def wget_entries(text: Column) -> Column:
    """Entries of a download log, one text each, in order."""
    return F.regexp_extract_all(text, F.lit(_ENTRY), F.lit(0))


def wget_details(entry: Column) -> Column:
    """Fields of a log entry as a struct; what an entry doesn't have is null."""
    field = lambda p: F.nullif(F.regexp_extract(entry, p, 1), F.lit(""))
    return F.struct(
        field(r"--\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}--\s+(\S+)").alias("url"),
        field(r"awaiting response\.\.\. (\d{3})").alias("status"),
        field(r"Length: (\d+)").alias("length"),
        entry.rlike(r"Length: unspecified").alias("length_unspecified"),
        field(r"saved \[(\d+)\]").alias("saved"),
        field(r"Location: (\S+)").alias("location"),
    )


def wget_log(spark: SparkSession, path: str) -> DataFrame:
    """Log entries of download logs: pos, url, status, length, length_unspecified, saved, location."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(wget_entries(F.col("value"))).alias("pos", "e")).select("pos", wget_details(F.col("e")).alias("d")).select("pos", "d.*")
