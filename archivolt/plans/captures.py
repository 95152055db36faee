"""Queries that compare expected with observed addresses, lists and checksums.

The test tables hold no captures, so bitstreams take their place: the export says which addresses are expected, the storage
system's rows are the observations. A row without an MD5 has no status, one on cold storage redirects, one without a
SHA-256 failed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.functions import paths
from archivolt.functions.text import drop_extension, filled, host, is_url, strip
from archivolt.operators import fixity, merge, reconcile, sets
from archivolt.plans.base import Registry
from archivolt.session import table

query = Registry()

def _asset():
    return F.lower(F.trim("asset_id"))


def _address(asset):
    return F.concat(F.lit("store://vault/"), asset, F.lit("/"), F.col("content_ord").cast("string"))


def expected(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "metadata_export").where("content_ord IS NOT NULL").select(_address(_asset()).alias("url"))


def observed(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(~filled(F.col("md5_checksum")), None).when(F.col("store_name") == "cold", "301").when(~filled(F.col("sha256_checksum")), "404").otherwise("200")
    pos = F.struct("checked_at", F.coalesce("filename", F.lit("")).alias("filename"), F.coalesce(status, F.lit("")).alias("s"))
    return table(spark, d, "metadata_mirror").select(_address(drop_extension(_asset())).alias("url"), status.alias("status"), pos.alias("pos"))


_SIDES = r"""
expected AS (SELECT DISTINCT 'store://vault/' || lower(trim(asset_id)) || '/' || content_ord AS url FROM metadata_export WHERE content_ord IS NOT NULL),
seen AS (
  SELECT 'store://vault/' || regexp_replace(lower(trim(asset_id)), '\.[^.]*$', '') || '/' || content_ord AS url,
    CASE WHEN coalesce(trim(md5_checksum), '') = '' THEN NULL WHEN store_name = 'cold' THEN '301' WHEN coalesce(trim(sha256_checksum), '') = '' THEN '404' ELSE '200' END AS status,
    checked_at, coalesce(filename, '') AS f FROM metadata_mirror),
last AS (SELECT url, status FROM seen QUALIFY row_number() OVER (PARTITION BY url ORDER BY checked_at DESC, f DESC, coalesce(status, '') DESC) = 1),
categories AS (
  SELECT e.url, CASE WHEN l.url IS NULL THEN 'missing' WHEN status IS NULL THEN 'non_200' WHEN status LIKE '3%' THEN 'redirect'
    WHEN status <> '200' THEN 'non_200' ELSE 'matching' END AS category, status
  FROM expected e LEFT JOIN last l ON e.url = l.url)
"""


@query(f"WITH {_SIDES} SELECT * FROM categories")
def url_reconcile(spark, d):
    """Category of every expected address."""
    return reconcile.reconcile(expected(spark, d), observed(spark, d))


@query(f"WITH {_SIDES} SELECT category, count(*) AS n_urls FROM categories GROUP BY ALL")
def url_category_counts(spark, d):
    """A17, K2."""
    return reconcile.category_counts(url_reconcile(spark, d))


@query(f"WITH {_SIDES} SELECT url FROM categories WHERE category IN ('missing', 'non_200')")
def retry_seeds(spark, d):
    """U8: addresses to fetch again."""
    return reconcile.retry_seeds(url_reconcile(spark, d))


@query(
    f"""WITH {_SIDES},
g AS (SELECT url, bool_or(status = '200') AS ok, bool_or(status IS DISTINCT FROM '200') AS bad FROM seen GROUP BY ALL),
lastbad AS (SELECT url, status FROM seen WHERE status IS DISTINCT FROM '200' QUALIFY row_number() OVER (PARTITION BY url ORDER BY checked_at DESC, f DESC, coalesce(status, '') DESC) = 1)
SELECT e.url, 'matching' AS category, '200' AS status FROM expected e JOIN g USING (url) WHERE ok
UNION ALL SELECT e.url, 'non_200', b.status FROM expected e JOIN lastbad b USING (url)
UNION ALL SELECT e.url, 'missing', NULL FROM expected e ANTI JOIN g USING (url)"""
)
def multi_capture(spark, d):
    """Several captures of an address."""
    return reconcile.multi_capture(expected(spark, d), observed(spark, d))


@query(
    f"""WITH {_SIDES} SELECT coalesce(e.url, s.url) AS url, CASE WHEN s.url IS NULL THEN 'expected' WHEN e.url IS NULL THEN 'observed' ELSE 'both' END AS side
FROM expected e FULL JOIN (SELECT DISTINCT url FROM seen) s ON e.url = s.url"""
)
def matched_and_unmatched(spark, d):
    """Which side has an address."""
    return reconcile.observed_only(expected(spark, d), observed(spark, d), "url")


@query(
    f"""WITH {_SIDES},
p AS (SELECT url, try_cast(status AS INT) AS status, CASE WHEN store_a THEN 0 ELSE 1 END AS prio FROM (
  SELECT s.*, s.f < 'm' AS store_a FROM seen s)),
one AS (SELECT url, prio, max(coalesce(status, -1)) AS status FROM p GROUP BY ALL),
l AS (SELECT url, status FROM one QUALIFY row_number() OVER (PARTITION BY url ORDER BY prio DESC) = 1)
SELECT e.url, l.url IS NOT NULL AS listed, coalesce(l.status = 200, false) AS is_200 FROM expected e LEFT JOIN l USING (url)"""
)
def page_list_validation(spark, d):
    """U4: two page lists, the second wins."""
    seen = observed(spark, d).select("url", F.coalesce(F.col("status").try_cast("int"), F.lit(-1)).alias("status"), (F.col("pos.filename") < "m").alias("first"))
    one = seen.groupBy("url", "first").agg(F.max("status").alias("status"))
    return reconcile.validate_pages(expected(spark, d), one.where("first").drop("first"), one.where("NOT first").drop("first"))


@query(
    """SELECT asset_id, CASE WHEN d = 1 AND m = 0 THEN 'added' ELSE 'removed' END AS change FROM (
SELECT asset_id, max(d) AS d, max(m) AS m FROM (
  SELECT asset_id, 1 AS d, 0 AS m FROM documents WHERE asset_id IS NOT NULL UNION ALL SELECT asset_id, 0, 1 FROM metadata_export) GROUP BY ALL) WHERE d + m = 1"""
)
def snapshot_diff(spark, d):
    """Assets of the texts against those of the export."""
    return sets.snapshot_diff(table(spark, d, "documents").where("asset_id IS NOT NULL"), table(spark, d, "metadata_export"), "asset_id")


@query("SELECT record_id, filename FROM metadata_export WHERE contains(filename, 'minute') AND contains(filename, '.pdf')")
def keyword_all(spark, d):
    """P5: all words."""
    return sets.keyword_filter(table(spark, d, "metadata_export").select("record_id", "filename"), "filename", all_of=["minute", ".pdf"])


@query("SELECT record_id, filename FROM metadata_export WHERE contains(filename, 'ledger') OR contains(filename, '-page')")
def keyword_any(spark, d):
    """P5: any word."""
    return sets.keyword_filter(table(spark, d, "metadata_export").select("record_id", "filename"), "filename", any_of=["ledger", "-page"])


@query("SELECT DISTINCT filename FROM metadata_export WHERE contains(filename, 'ledger') OR contains(filename, 'report')")
def containing_any(spark, d):
    """Distinct and sorted."""
    return sets.containing_any(table(spark, d, "metadata_export"), "filename", ["ledger", "report"])


@query("SELECT record_id, filename FROM metadata_export WHERE NOT (contains(filename, 'ledger') OR contains(filename, 'report'))")
def excluding_any(spark, d):
    """P7."""
    return sets.excluding_any(table(spark, d, "metadata_export").select("record_id", "filename"), "filename", ["ledger", "report"])


@query(
    r"SELECT record_id, dc_relation FROM metadata_export WHERE regexp_matches(dc_relation, '^https://[^/]+/item/[0-9]+') AND NOT regexp_matches(dc_relation, '#p[0-9]')"
)
def crawl_scope(spark, d):
    """Include and exclude patterns."""
    return sets.in_scope(table(spark, d, "metadata_export").select("record_id", "dc_relation"), "dc_relation", [r"^https://[^/]+/item/[0-9]+"], [r"#p[0-9]"])


@query("SELECT record_id, preservica_path FROM metadata_export WHERE NOT starts_with(preservica_path, 'Admin') AND NOT starts_with(preservica_path, 'Web')")
def path_prefix_exclusion(spark, d):
    """P3, S23."""
    return sets.outside_prefixes(table(spark, d, "metadata_export").select("record_id", "preservica_path"), "preservica_path", ["Admin", "Web"])


@query("SELECT record_id FROM metadata_export WHERE entity_type IS NULL OR trim(entity_type) = '' OR entity_type = 'EntityType.ASSET'")
def assets_or_untyped(spark, d):
    """P1."""
    return sets.by_entity_type(table(spark, d, "metadata_export"), "entity_type", "EntityType.ASSET", True).select("record_id")


@query("SELECT record_id FROM metadata_export WHERE entity_type = 'EntityType.FOLDER'")
def folders_only(spark, d):
    """P2."""
    return sets.by_entity_type(table(spark, d, "metadata_export"), "entity_type", "EntityType.FOLDER", False).select("record_id")


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'")
def open_interval(spark, d):
    """P11."""
    return sets.between_open(table(spark, d, "events").select("event_id", "ts"), "ts", "2024-01-05 00:00:00", "2024-01-20 12:00:00")


@query(
    r"""WITH u AS (SELECT record_id, regexp_extract(dc_relation, '(https?://[^ ;|,"\t\n\]\\]+)', 1) AS url FROM metadata_export),
h AS (SELECT *, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host FROM u WHERE url <> '')
SELECT record_id, url, host, regexp_replace(host, '^www\.', '') AS bare_host, replace(regexp_replace(host, '^www\.', ''), '.', '-') AS label,
  nullif(regexp_extract(url, '/item/([^/]*)', 1), '') AS item, contains(url, '#') AS has_fragment, 'https://replay.example/20240101000000if_/' || url AS replay FROM h"""
)
def url_parts(spark, d):
    """Parts of web addresses."""
    url = F.regexp_extract("dc_relation", r'(https?://[^ ;|,"\t\n\]\\]+)', 1)
    rows = table(spark, d, "metadata_export").select("record_id", url.alias("url")).where(is_url(F.col("url")))
    u = F.col("url")
    return rows.select(
        "record_id", "url", host(u).alias("host"), paths.bare_host(u).alias("bare_host"), paths.host_label(u).alias("label"), paths.token_after(u, "item").alias("item"),
        F.contains(u, F.lit("#")).alias("has_fragment"), paths.replay_url("https://replay.example", F.lit("20240101000000"), u, "if_").alias("replay"),
    )


@query("SELECT digest, min(doc_id) AS doc_id FROM (SELECT sha1(text) AS digest, doc_id FROM documents) GROUP BY ALL")
def digest_first_seen(spark, d):
    """First document of each digest."""
    rows = table(spark, d, "documents").select(fixity.checksum(F.col("text"), "sha1").alias("digest"), "doc_id")
    return merge.first_row(rows, ["digest"], "doc_id")


_STRIP = r"lower(regexp_replace({0}, '^\s+|\s+$', '', 'g'))"


@query(
    f"""SELECT record_id, md5_checksum FROM metadata_export WHERE {_STRIP.format('md5_checksum')} IN
(SELECT {_STRIP.format('md5_checksum')} FROM metadata_mirror WHERE trim(md5_checksum) <> '')"""
)
def known_checksums(spark, d):
    """Files whose checksum is known."""
    known = table(spark, d, "metadata_mirror").where("md5_checksum IS NOT NULL").select("md5_checksum")
    return fixity.known_duplicates(table(spark, d, "metadata_export").select("record_id", "md5_checksum"), known, "md5_checksum", "md5_checksum")


@query(
    f"""SELECT record_id, md5_checksum FROM metadata_export e WHERE NOT EXISTS (
SELECT 1 FROM metadata_mirror m WHERE left({_STRIP.format('m.md5_checksum')}, 32) = left({_STRIP.format('e.md5_checksum')}, 32))"""
)
def unknown_checksums(spark, d):
    """Files whose checksum prefix is unknown; rows without a checksum are unknown."""
    known = table(spark, d, "metadata_mirror").select("md5_checksum")
    return fixity.unknown_files(table(spark, d, "metadata_export").select("record_id", "md5_checksum"), known, "md5_checksum", "md5_checksum")


@query(
    rf"""WITH m AS (SELECT regexp_replace(lower(trim(asset_id)), '\.[^.]*$', '') AS asset_id, content_ord, max({_STRIP.format('md5_checksum')}) AS actual FROM metadata_mirror GROUP BY ALL)
SELECT record_id, CASE WHEN coalesce({_STRIP.format('e.md5_checksum')}, '') = '' THEN true ELSE coalesce({_STRIP.format('e.md5_checksum')} = m.actual, false) END AS holds
FROM metadata_export e JOIN m ON lower(trim(e.asset_id)) = m.asset_id AND e.content_ord = m.content_ord"""
)
def fixity_check(spark, d):
    """expected against actual checksum; nothing expected passes."""
    mirror = table(spark, d, "metadata_mirror").groupBy(drop_extension(_asset()).alias("asset"), "content_ord").agg(F.max(F.lower(strip(F.col("md5_checksum")))).alias("actual"))
    export = table(spark, d, "metadata_export").select("record_id", _asset().alias("asset"), "content_ord", "md5_checksum")
    return export.join(mirror, ["asset", "content_ord"]).select("record_id", fixity.fixity_holds(F.col("md5_checksum"), F.col("actual")).alias("holds"))


@query(
    "SELECT record_id, filename FROM metadata_export WHERE NOT coalesce(lower(regexp_extract(filename, '\\.([^.]*)$', 1)), '') IN ('pdf', 'jpg') AND filename IS NOT NULL"
)
def extension_exclusion(spark, d):
    """P13, P18, F4."""
    return fixity.without_extensions(table(spark, d, "metadata_export").select("record_id", "filename"), "filename", [".PDF", "jpg"])


@query("SELECT record_id FROM metadata_export e WHERE asset_id NOT IN (SELECT asset_id FROM documents WHERE asset_id IS NOT NULL)")
def pending_assets(spark, d):
    """Rows without an output yet."""
    done = table(spark, d, "documents").where("asset_id IS NOT NULL")
    return fixity.pending(table(spark, d, "metadata_export").select("record_id", "asset_id"), done, "asset_id").select("record_id")


@query(
    """WITH g AS (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY content_ord, record_id) AS n, min(content_ord) OVER (PARTITION BY asset_id) AS lo FROM metadata_export WHERE content_ord IS NOT NULL)
SELECT record_id, asset_id, content_ord FROM g WHERE content_ord = lo"""
)
def first_bitstreams(spark, d):
    """First generation per content object."""
    rows = table(spark, d, "metadata_export").where("content_ord IS NOT NULL").select("record_id", "asset_id", "content_ord")
    return fixity.first_generations(rows, ["asset_id"], "content_ord")


@query(
    """WITH t AS (SELECT DISTINCT entity_title AS text FROM metadata_export WHERE entity_title IS NOT NULL),
n AS (SELECT DISTINCT lower(term) AS needle FROM vocabulary)
SELECT text, needle FROM t JOIN n ON contains(text, needle)"""
)
def titles_naming_terms(spark, d):
    """Texts that contain a term, by equality on substrings."""
    needles = table(spark, d, "vocabulary").select(F.lower("term").alias("needle"))
    return reconcile.contains_pairs(table(spark, d, "metadata_export").where("entity_title IS NOT NULL"), "entity_title", needles, "needle")


@query(
    """SELECT doc_id, asset_id FROM documents WHERE asset_id IS NULL OR asset_id NOT IN (SELECT asset_id FROM metadata_export)"""
)
def texts_without_asset(spark, d):
    """Rows without a partner, repeated rows and rows without a key kept."""
    rows = table(spark, d, "documents").select("doc_id", "asset_id")
    return reconcile.missing_keeping_rows(rows, table(spark, d, "metadata_export"), F.col("asset_id"), F.col("asset_id"))
