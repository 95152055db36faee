"""Queries that write a table in a file format and read it back through the format's reader, and on what such files hold."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from archivolt.functions import paths
from archivolt.operators import fixity, merge, pivot, reconcile, report, sets
from archivolt.plans.base import Registry
from archivolt.session import scratch_path, table
from archivolt.sources import inventory, sinks, text_files, web_archive, xml_files

query = Registry()


def _captures(spark, d, name: str) -> str:
    path = scratch_path(spark, name)
    rows = table(spark, d, "documents").select(
        F.lit("response").alias("rec_type"), F.concat(F.lit("https://e.example/"), "doc_id").alias("target_uri"), F.lit("2024-01-01T00:00:00Z").alias("warc_date"),
        F.when(F.col("doc_kind") == "letter", "404").otherwise("200").alias("http_status"), F.coalesce("text", F.lit("")).alias("payload"),
    )
    sinks.write_archive(rows.repartition(3), path)
    return path


@query("SELECT 'https://e.example/' || doc_id AS url, CASE WHEN doc_kind = 'letter' THEN '404' ELSE '200' END AS status, CAST(length(coalesce(text, '')) AS INT) AS n_chars FROM documents")
def archive_records(spark, d):
    """Responses written to and read from web-archive files."""
    rows = web_archive.read_records(spark, _captures(spark, d, "captures").removeprefix("file://"), types="response")
    return rows.select(F.col("target_uri").alias("url"), F.col("http_status").alias("status"), F.length(F.decode("payload", "UTF-8")).alias("n_chars"))


@query("SELECT 'warcinfo' AS rec_type, CAST(1 AS BIGINT) AS n UNION ALL SELECT 'response', count(*) FROM documents HAVING count(*) > 0")
def archive_merged(spark, d):
    """Of several archives the first information record stays, all other records do."""
    rows = web_archive.read_records(spark, _captures(spark, d, "captures").removeprefix("file://"), payload="false")
    return sets.merge_records(rows).groupBy("rec_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT 'https://e.example/' || event_id || CASE WHEN event_type = 'click' THEN '#top' ELSE '' END AS url, CAST(200 AS INT) AS status, CASE WHEN value IS NOT NULL THEN floor(value) / 4 END AS screenshot_match,
  CAST(event_id % 5 AS DOUBLE) AS text_match, CAST(event_id % 7 AS INT) AS crawl_good FROM events WHERE event_type <> 'error' AND event_type <> 'click'"""
)
def capture_quality(spark, d):
    """Quality figures of page records; an explicit null comparison drops a record, a fragment an address."""
    number = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    body = F.concat(
        F.lit('{"url": "https://e.example/'), F.col("event_id").cast("string"), F.when(F.col("event_type") == "click", "#top").otherwise(""), F.lit('", "status": 200, "comparison": '),
        F.when(F.col("event_type") == "error", "null").otherwise(F.concat(
            F.lit('{"screenshotMatch": '), number(F.floor("value") / 4), F.lit(', "textMatch": '), number(F.col("event_id") % 5), F.lit(', "resourceCounts": {"crawlGood": '), number(F.col("event_id") % 7), F.lit("}}"))),
        F.lit("}"),
    )
    rows = reconcile.qa_rows(table(spark, d, "events").select(body.alias("payload")), drop_fragments=True)
    return rows.select("url", "status", "screenshot_match", "text_match", "crawl_good")


@query("SELECT CAST(r_regionkey AS INT) AS file_ord, n_name AS line FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 2 UNION ALL SELECT -1, '{\"format\": \"json-pages-1.0\", \"id\": \"0\"}'")
def page_lists_merged(spark, d):
    """One page list of several; a file whose header can't be read adds nothing."""
    n = table(spark, d, "nation")
    bodies = n.select(F.col("n_regionkey").alias("file_ord"), (F.col("n_nationkey") + 1).alias("pos"), F.col("n_name").alias("line"))
    head = F.when(F.col("r_regionkey") == 2, "{broken").otherwise(F.concat(F.lit('{"format": "json-pages-1.0", "id": "'), F.col("r_regionkey").cast("string"), F.lit('"}')))
    heads = table(spark, d, "region").select(F.col("r_regionkey").alias("file_ord"), F.lit(0).alias("pos"), head.alias("line"))
    return sets.merge_page_lists(heads.unionByName(bodies), "{}").select("file_ord", "line")


_CELL = "list_filter(list_transform(string_split_regex(coalesce(dc_subject, ''), '[;|]'), lambda x: trim(x)), lambda x: x <> '')"


@query(f"SELECT record_id, ({_CELL})[1:3] AS subjects FROM metadata_export")
def repeated_columns(spark, d):
    """Values under a repeated header, written and read."""
    parts = F.filter(F.transform(F.split(F.coalesce("dc_subject", F.lit("")), "[;|]"), lambda x: F.trim(x)), lambda x: x != "")
    wide = table(spark, d, "metadata_export").select("record_id", *[F.get(parts, F.lit(i)).alias(f"s{i}") for i in range(3)])
    path = scratch_path(spark, "repeated")
    sinks.write_csv(wide.coalesce(1), path, headers=["record_id", "dc:subject", "dc:subject", "dc:subject"])
    rows = text_files.csv_table(spark, path, required=["record_id"])
    return rows.select(F.col("record_id").cast("long").alias("record_id"), pivot.collect_repeated(rows, "subjects", merge.template_columns(rows.columns, "dc:subject")))


def _address_list(spark, d) -> str:
    path = scratch_path(spark, "addresses")
    s = table(spark, d, "documents")
    rows = s.select(F.concat(F.lit(" https://"), F.coalesce("source", F.lit("x")), F.lit("/ ")).alias("l")).unionByName(s.select(F.concat(F.lit("# "), F.col("doc_kind")).alias("l"))).unionByName(s.select(F.coalesce("lang", F.lit("")).alias("l")))
    sinks.write_lines(rows, "l", path)
    return path


_WORDS = "SELECT DISTINCT regexp_replace(l, '^\\s+|\\s+$', '', 'g') AS l FROM (SELECT 'https://' || coalesce(source, 'x') || '/' AS l FROM documents UNION ALL SELECT coalesce(lang, '') FROM documents UNION ALL SELECT '# ' || doc_kind FROM documents WHERE doc_kind IS NOT NULL)"


@query(f"SELECT l AS line, count(*) AS n FROM (SELECT 'https://' || coalesce(source, 'x') || '/' AS l FROM documents UNION ALL SELECT trim(lang) FROM documents WHERE trim(lang) <> '') GROUP BY ALL")
def lines_without_comments(spark, d):
    """Lines of a list but for comments."""
    return text_files.lines(spark, _address_list(spark, d), comments="#").groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT l AS url FROM ({_WORDS}) WHERE regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]')")
def valid_addresses(spark, d):
    """Valid addresses of a list."""
    return text_files.url_list(spark, _address_list(spark, d), only_valid=True)


@query(f"SELECT l AS url FROM ({_WORDS})")
def raw_addresses(spark, d):
    """All lines of a list as a set, the blank one too."""
    return text_files.url_list(spark, _address_list(spark, d), keep_blank=True)


@query("SELECT sha1_checksum AS digest, min(record_id) AS first_record FROM metadata_export WHERE trim(sha1_checksum) <> '' GROUP BY ALL")
def cdx_captures(spark, d):
    """The first capture of each digest of an index answer; an answer is one array, so there is one per feed."""
    rows = table(spark, d, "metadata_export").where("trim(sha1_checksum) <> ''")
    entry = F.array(F.lit("k"), F.lpad(F.col("record_id").cast("string"), 14, "0"), F.concat(F.lit("https://e.example/"), "record_id"), F.lit("t"), F.lit("200"), F.col("sha1_checksum"))
    listed = rows.groupBy("feed").agg(F.array_sort(F.collect_list(entry)).alias("a"))
    path = scratch_path(spark, "cdx")
    head = F.array(F.array(*[F.lit(x) for x in ("urlkey", "timestamp", "original", "mimetype", "statuscode", "digest")]))
    listed.select(F.to_json(F.concat(head, "a")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    found = text_files.cdx_rows(spark, path)
    return found.groupBy("digest").agg(F.min(F.col("timestamp").cast("long")).alias("first_record"))


@query("SELECT CASE WHEN parent IS NULL THEN 'sitemap' ELSE 'url' END AS kind, 'https://e.example/?a=1&r=' || ref AS loc FROM entity_folder")
def sitemap_files(spark, d):
    """Entries of sitemaps and sitemap indexes, with and without a namespace."""
    loc = F.concat(F.lit("https://e.example/?a=1&amp;r="), "ref")
    rows = table(spark, d, "entity_folder")
    one = rows.where("parent IS NULL").select(F.concat(F.lit("<s:sitemap><s:loc> "), loc, F.lit(" </s:loc></s:sitemap>")).alias("x"))
    two = rows.where("parent IS NOT NULL").select(F.concat(F.lit("<url>\n<loc>"), loc, F.lit("</loc><lastmod>2024</lastmod></url>")).alias("x"))
    paths_of = []
    for name, part, root in (("index", one, "s:sitemapindex"), ("pages", two, "urlset")):
        path = scratch_path(spark, name)
        sinks.write_lines(part.agg(F.concat(F.lit(f"<{root}>"), F.array_join(F.collect_list("x"), ""), F.lit(f"</{root}>")).alias("x")), "x", path)
        paths_of.append(path)
    return xml_files.sitemap_entries(spark, paths_of[0]).unionByName(xml_files.sitemap_entries(spark, paths_of[1])).select("kind", "loc")


@query("SELECT ref, title, security_tag FROM entity_folder")
def xml_item_table(spark, d):
    """A table of the items of an XML file; the columns are all tags of all items."""
    tag = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"<{c}>"), pivot.xml_escape(F.col(c)), F.lit(f"</{c}>"))).otherwise("")
    path = scratch_path(spark, "items")
    items = table(spark, d, "entity_folder").select(F.concat(F.lit("<item>"), tag("ref"), tag("title"), tag("security_tag"), F.lit("</item>")).alias("x"))
    sinks.write_lines(items.agg(F.concat(F.lit("<items>\n"), F.array_join(F.collect_list("x"), "\n"), F.lit("\n</items>")).alias("x")), "x", path)
    return xml_files.xml_items(spark, path, "item")


@query("SELECT DISTINCT lower(trim(sha1_checksum)) AS digest FROM metadata_export WHERE trim(sha1_checksum) <> ''")
def checksum_lists(spark, d):
    """Digests of a report, whatever its other columns hold."""
    path = scratch_path(spark, "report")
    sinks.write_csv(table(spark, d, "metadata_export").select("filename", F.upper("sha1_checksum").alias("SHA1 value"), F.lit("x, y").alias("note")).coalesce(1), path)
    return text_files.checksum_report(spark, path, "sha1")


@query("SELECT 'txt' AS extension, CAST(sum(strlen(source) + 1) AS BIGINT) AS size FROM documents WHERE source IS NOT NULL")
def file_inventory(spark, d):
    """Size and digests of the files below a path, marks of success left out."""
    path = scratch_path(spark, "inventory")
    sinks.write_lines(table(spark, d, "documents").where("source IS NOT NULL"), "source", path)
    files = inventory.files(spark, path, "md5", exclude=[path.removeprefix("file://") + "/_"])
    return files.where("length(digest) = 32").groupBy("extension").agg(F.sum("size").alias("size"))


@query("SELECT trim(subject_term) AS term FROM subject_taxonomy")
def taxonomy_terms(spark, d):
    """Terms that stand after '- ' in a list."""
    path = scratch_path(spark, "taxonomy")
    t = table(spark, d, "subject_taxonomy")
    sinks.write_lines(t.select(F.concat(F.lit("- "), "subject_term").alias("x")).unionByName(t.select(F.concat(F.lit("# "), "subject_term").alias("x"))), "x", path)
    return text_files.taxonomy_lines(spark, path)


@query("SELECT trim(rulebase_class) AS term, round(score, 3) AS score, count(*) AS n FROM classifier_score WHERE score IS NOT NULL AND regexp_matches(rulebase_class, '^[A-Za-z_]+$') GROUP BY ALL")
def classifier_printout(spark, d):
    """Terms and scores between two markers of a printed result."""
    rows = table(spark, d, "classifier_score").where("score IS NOT NULL").where(F.col("rulebase_class").rlike("^[A-Za-z_]+$"))
    text = F.concat(F.lit("log 1: 2\n<<\n"), F.trim("rulebase_class"), F.lit("\t"), F.round("score", 3).cast("decimal(4,3)").cast("string"), F.lit("\n>>\nlog: 3"))
    found = rows.select(F.explode(text_files.classifier_output(text, "<<", ">>")).alias("x")).select("x.*")
    return found.groupBy("term", "score").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT coalesce(entity_type, '') AS category, count(*) AS n FROM metadata_export GROUP BY ALL")
def category_report(spark, d):
    """K2: a report as one folder of CSV files per category, under the run's name."""
    path = scratch_path(spark, "report")
    sinks.write_report(table(spark, d, "metadata_export").select("record_id", F.when(F.trim("entity_type") == "", None).otherwise(F.col("entity_type")).alias("category")), path, run="run-1")
    rows = spark.read.option("header", True).csv(f"{path}/run-1")
    return rows.groupBy(F.coalesce(F.col("category").cast("string"), F.lit("")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT asset_id, 'first' AS taken FROM metadata_export WHERE load_id <= 1 GROUP BY ALL")
def tracked_keys(spark, d):
    """K6, K7: keys that were appended to a tracking table after a first snapshot."""
    rows = table(spark, d, "metadata_export")
    path, done = scratch_path(spark, "snapshot"), scratch_path(spark, "tracking")
    sinks.write_snapshot(rows.where("load_id <= 1").select("asset_id").distinct(), path)
    sinks.append_processed(spark.read.parquet(path), "asset_id", done)
    tracked = spark.read.parquet(done)
    return tracked.join(fixity.pending(rows.select("asset_id").distinct(), tracked, "asset_id"), "asset_id", "left_anti").select("asset_id", F.lit("first").alias("taken"))


@query("SELECT document, term, score FROM classifier_score WHERE rulebase_class = 'Generic_UPWARD' AND score >= 0.5")
def sure_terms(spark, d):
    """Rows of a class with at least a score."""
    return report.score_filter(table(spark, d, "classifier_score"), "rulebase_class", "Generic_UPWARD", "score", 0.5).select("document", "term", "score")


@query("SELECT entity_title AS title, lower(md5_checksum) AS value FROM metadata_export WHERE trim(md5_checksum) <> '' AND content_ord IS NOT NULL")
def fixity_values(spark, d):
    """Digests of all bitstreams of nested entities, preservation copies only."""
    rows = table(spark, d, "metadata_export").where("trim(md5_checksum) <> '' AND content_ord IS NOT NULL")
    stream = F.struct(F.create_map(F.lit("MD5"), F.lower("md5_checksum"), F.lit("SHA1"), F.lit("x")).alias("fixity"))
    content = F.array(F.struct(F.array(F.struct(F.array(stream).alias("bitstreams"))).alias("generations")))
    copies = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("type"), content.alias("content_objects")) for n, k in (("Preservation-1", "Preservation"), ("Access", "Access"))])
    kept = F.filter(copies, lambda r: fixity.is_preservation(r["name"], r["type"]))
    return fixity.fixity_listing(rows.select(F.col("entity_title").alias("title"), kept.alias("representations")), "MD5")


@query("SELECT ref, trim(title) AS title, trim(coalesce(security_tag, '') || ' ' || coalesce(entity_type, '')) AS box FROM entity_folder WHERE trim(title) <> ''")
def fragment_fields(spark, d):
    """Fields of a metadata fragment by local name; a container gives the texts below it."""
    e = lambda n, c: F.concat(F.lit(f"<{n}>"), pivot.xml_escape(F.coalesce(c, F.lit(""))), F.lit(f"</{n}>"))
    xml = F.concat(F.lit('<r xmlns:a="u"><a:title> '), pivot.xml_escape(F.col("title")), F.lit(" </a:title><box>"), e("a:tag", "security_tag"), e("kind", "entity_type"), F.lit("</box></r>"))
    rows = table(spark, d, "entity_folder").where("trim(title) <> ''").select("ref", xml_files.flatten_fragment(xml).alias("m"))
    return rows.select("ref", F.col("m")["title"].alias("title"), F.coalesce(F.col("m")[paths.local_name(F.lit("{u}box"))], F.lit("")).alias("box"))


@query(
    """SELECT record_id, CASE WHEN file_extension LIKE '%xml%' THEN 'xml' ELSE 'txt' END AS caption, strftime(exported_at, '%Y%m%d%H%M%S') AS stamp, 'MD5' AS md5_kind, 'SHA-256' AS sha256_kind, 'SHA-1' AS other_kind,
  regexp_replace(replace(dc_description, '�', '?'), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g') AS clean FROM metadata_export"""
)
def small_expressions(spark, d):
    """caption extensions, capture times in two layouts, digest kinds, text without control characters."""
    at = F.date_format("exported_at", "yyyyMMddHHmmss")
    iso = F.concat(F.date_format("exported_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    time = paths.capture_time(F.when(F.col("record_id") % 2 == 0, at).otherwise(iso))
    return table(spark, d, "metadata_export").select(
        "record_id", paths.caption_extension(F.coalesce("file_extension", F.lit(""))).alias("caption"), F.date_format(time, "yyyyMMddHHmmss").alias("stamp"),
        *[F.lit(paths.digest_kind(h)).alias(n) for h, n in (("MD5 checksum", "md5_kind"), ("SHA256 checksum", "sha256_kind"), ("checksum", "other_kind"))], paths.without_controls(F.col("dc_description")).alias("clean"),
    )


@query("SELECT CAST(1 AS INT) AS part, record_id AS place, '<li>' || replace(replace(replace(coalesce(entity_title, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</li>' AS line FROM metadata_export UNION ALL SELECT 0, NULL, '<ul>' UNION ALL SELECT 2, NULL, '</ul>'")
def html_titles(spark, d):
    """K5: titles as the lines of an HTML list."""
    return pivot.html_list_lines(table(spark, d, "metadata_export"), "record_id", "entity_title")


@query("SELECT ref, CAST(row_number() OVER (PARTITION BY parent ORDER BY lower(title) NULLS FIRST, ref) AS INT) AS place FROM entity_folder")
def folders_in_order(spark, d):
    """O3: places of sibling folders without regard to case."""
    order = report.casefold_order("title", "ref")
    return table(spark, d, "entity_folder").select("ref", F.row_number().over(Window.partitionBy("parent").orderBy(*order)).alias("place"))


@query("SELECT record_id, entity_title || '<>' || replace(replace(replace(entity_title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS change FROM metadata_export WHERE entity_title <> replace(replace(replace(entity_title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') UNION ALL SELECT record_id, icaew_content_type || '<>' || replace(replace(replace(icaew_content_type, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') FROM metadata_export WHERE icaew_content_type <> replace(replace(replace(icaew_content_type, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')")
def escape_changes(spark, d):
    """what escaping changes, cell by cell."""
    rows = table(spark, d, "metadata_export")
    part = lambda c: rows.select("record_id", pivot.xml_changes(F.col(c)).alias("change"))
    return part("entity_title").unionByName(part("icaew_content_type")).where("change IS NOT NULL")


@query("SELECT asset_id, arg_max(record_id, record_id) AS record_id, arg_max(load_id, record_id) AS load_id FROM metadata_export GROUP BY ALL")
def last_delivery(spark, d):
    """A5: the last row per key."""
    rows = table(spark, d, "metadata_export").select("asset_id", "load_id", "record_id", F.col("record_id").alias("pos"))
    return merge.last_row(rows, ["asset_id"], "pos").select("asset_id", "record_id", "load_id")


@query("SELECT '{broken ' || event_id AS line FROM events WHERE event_type = 'error'")
def unreadable_pages(spark, d):
    """Lines of a page list that can't be read."""
    path = scratch_path(spark, "pages")
    ok = F.to_json(F.struct(F.concat(F.lit("https://e.example/"), F.col("event_id").cast("string")).alias("url")))
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), F.col("event_id").cast("string"))).otherwise(ok)
    sinks.write_lines(table(spark, d, "events").select(line.alias("x")), "x", path)
    return text_files.unreadable_lines(spark, path).select("line")


@query(
    """SELECT record_id, CAST(row_number() OVER w AS INT) AS row_in_asset, CASE WHEN row_number() OVER w = 1 THEN dc_title ELSE '' END AS dc_title
FROM metadata_export WHERE content_ord IS NOT NULL WINDOW w AS (PARTITION BY asset_id ORDER BY coalesce(file_extension = 'pdf', false) DESC, record_id)"""
)
def bitstream_sheet(spark, d):
    """Export rows of assets: the first bitstream's row is full, later ones have blank descriptive cells."""
    rows = table(spark, d, "metadata_export").where("content_ord IS NOT NULL").withColumn("original", F.coalesce(F.col("file_extension") == "pdf", F.lit(False)))
    return fixity.bitstream_rows(rows, "asset_id", "record_id", "original", ["dc_title"]).select("record_id", "row_in_asset", "dc_title")
