"""Expected against observed: captures of web addresses, log entries, lists of identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def classify_status(has_details: Column, status: Column) -> Column:
    """missing, redirect, non_200 or matching, by the text of a status."""
    return (
        F.when(~has_details, "missing")
        .when(status.isNull(), "non_200")
        .when(status.startswith("3"), "redirect")
        .when(status != "200", "non_200")
        .otherwise("matching")
    )


def reconcile(expected: DataFrame, observed: DataFrame, url: str = "url", status: str = "status", pos: str = "pos") -> DataFrame:
    """Every expected address with its category and the last observation's status.

    Expected addresses count once. A null address is expected like any other and is found by null. Of repeated
    observations the last by ``pos`` counts.
    """
    last = observed.groupBy(F.col(url).alias("_u")).agg(F.max_by(status, pos).alias("_status"), F.lit(True).alias("_seen"))
    want = expected.select(url).distinct()
    joined = want.join(last, want[url].eqNullSafe(last["_u"]), "left")
    seen = F.coalesce(F.col("_seen"), F.lit(False))
    return joined.select(url, classify_status(seen, F.col("_status")).alias("category"), F.col("_status").alias("status"))


def category_counts(categories: DataFrame) -> DataFrame:
    """Rows per category."""
    return categories.groupBy("category").agg(F.count(F.lit(1)).alias("n_urls"))


def multi_capture(expected: DataFrame, records: DataFrame, url: str = "url", status: str = "status", pos: str = "pos") -> DataFrame:
    """Expected addresses against all captures of several archives: url, category, status.

    Any capture with 200 puts the address under matching; any other capture puts it under non_200 with the last such
    status. An address with both has two rows, as a later success doesn't take back an earlier failure. One without a
    capture is missing.
    """
    bad = F.when(~F.col(status).eqNullSafe(F.lit("200")), F.struct(F.col(pos), F.col(status).alias("s")))
    seen = records.groupBy(F.col(url).alias("_u")).agg(F.max(F.col(status).eqNullSafe(F.lit("200"))).alias("ok"), F.max(bad).alias("bad"))
    want = expected.select(url).distinct()
    row = lambda c, s: F.struct(F.lit(c).alias("category"), s.alias("status"))
    kinds = F.array_compact(
        F.array(
            F.when(F.col("ok"), row("matching", F.lit("200"))),
            F.when(F.col("bad").isNotNull(), row("non_200", F.col("bad.s"))),
            F.when(F.col("_u").isNull(), row("missing", F.lit(None).cast("string"))),
        )
    )
    return want.join(seen, want[url] == seen["_u"], "left").select(url, F.explode(kinds).alias("k")).select(url, "k.*")


def observed_only(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """Distinct keys with ``side``: both, expected or observed."""
    sides = expected.select(key, F.lit(1).alias("e"), F.lit(0).alias("o")).unionByName(observed.select(key, F.lit(0).alias("e"), F.lit(1).alias("o")))
    found = sides.groupBy(key).agg(F.max("e").alias("e"), F.max("o").alias("o"))
    return found.select(key, F.when(F.col("e") + F.col("o") == 2, "both").when(F.col("e") == 1, "expected").otherwise("observed").alias("side"))


def validate_pages(expected: DataFrame, pages: DataFrame, extra: DataFrame, url: str = "url", status: str = "status") -> DataFrame:
    """Page lists against expected addresses: url, listed, is_200 (U4).

    Where an address is in both lists the extra list wins; a page without status isn't 200.
    """
    both = pages.select(url, status, F.lit(0).alias("_p")).unionByName(extra.select(url, status, F.lit(1).alias("_p")))
    last = both.groupBy(F.col(url).alias("_u")).agg(F.max_by(status, "_p").alias("_s"))
    want = expected.select(url).distinct()
    return want.join(last, want[url] == last["_u"], "left").select(
        url, F.col("_u").isNotNull().alias("listed"), F.coalesce(F.col("_s") == 200, F.lit(False)).alias("is_200")
    )


def retry_seeds(categories: DataFrame, url: str = "url") -> DataFrame:
    """Addresses to fetch again: missing and non_200, once each (U8)."""
    return categories.where(F.col("category").isin("missing", "non_200")).select(url).distinct()


def missing_keeping_rows(rows: DataFrame, present: DataFrame, row_key: Column, present_key: Column) -> DataFrame:
    """Rows whose derived key nobody has, repeated rows kept; rows without a key are kept too."""
    there = present.select(present_key.alias("_k")).where("_k IS NOT NULL").distinct()
    return rows.withColumn("_k", row_key).join(there, "_k", "left_anti").drop("_k")


def contains_pairs(texts: DataFrame, text: str, needles: DataFrame, needle: str, least: int = 4) -> DataFrame:
    """Distinct (text, needle) where the text contains the needle, without trying all pairs.

    The first ``least`` characters of a needle meet the texts' substrings of that length in an equality join; what meets
    is verified. A shorter needle meets the substrings of its own length; texts are cut into those lengths only that
    needles have. The empty needle is in every text.
    """
    want = needles.select(F.col(needle).alias("needle")).where("needle IS NOT NULL").distinct().select("needle", F.substring("needle", 1, least).alias("gram"))
    lengths = sorted(r[0] for r in want.select(F.length("gram")).distinct().collect())  # 0 to least, so at most least + 1
    if not lengths:
        lengths = [least]

    def grams(n: int) -> Column:
        if n == 0:
            return F.array(F.lit(""))
        at = F.sequence(F.lit(1), F.length("text") - n + 1)
        cut = F.transform(at, lambda i: F.substr(F.col("text"), i, F.lit(n)))
        return F.when(F.length("text") >= n, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))

    placed = texts.select(F.col(text).alias("text")).where("text IS NOT NULL").distinct().select("text", F.explode(F.concat(*map(grams, lengths))).alias("gram"))
    return placed.join(want, "gram").where(F.contains(F.col("text"), F.col("needle"))).select("text", "needle")


def qa_rows(records: DataFrame, content: str = "payload", drop_fragments: bool = False) -> DataFrame:
    """Quality figures from page-information JSON, sorted by both match scores, nulls last.

    A record whose ``comparison`` is an explicit null is dropped; a missing one gives nulls. With ``drop_fragments``
    addresses with '#' are left out, a null address stays.
    """
    counts = "resourceCounts: struct<crawlGood: int, crawlBad: int, replayGood: int, replayBad: int>"
    j = F.from_json(content, f"url string, status int, comparison struct<screenshotMatch: double, textMatch: double, {counts}>")
    rows = records.where(~F.coalesce(F.col(content).rlike(r'"comparison"\s*:\s*null'), F.lit(False))).select(j.alias("j"))
    if drop_fragments:
        rows = rows.where(F.coalesce(~F.contains("j.url", F.lit("#")), F.lit(True)))
    c = "j.comparison"
    out = rows.select(
        F.col("j.url").alias("url"),
        F.col("j.status").alias("status"),
        F.col(f"{c}.screenshotMatch").alias("screenshot_match"),
        F.col(f"{c}.textMatch").alias("text_match"),
        *[F.col(f"{c}.resourceCounts.{n}").alias(a) for n, a in (("crawlGood", "crawl_good"), ("crawlBad", "crawl_bad"), ("replayGood", "replay_good"), ("replayBad", "replay_bad"))],
    )
    return out.orderBy(F.asc_nulls_last("screenshot_match"), F.asc_nulls_last("text_match"))
