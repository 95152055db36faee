"""Queries that merge, deduplicate, count and rank."""

from __future__ import annotations

from pyspark.sql import functions as F

from archivolt.functions import paths
from archivolt.functions.text import base_name, drop_extension, extension, non_ascii, strip
from archivolt.operators import merge, pivot, report, sets
from archivolt.plans.base import Registry
from archivolt.session import table
from archivolt.streaming import incremental

query = Registry()

_RICH = ["entity_title", "dc_title", "dc_creator", "dc_date", "dc_description"]
_NONNULL = " + ".join(f"({c} IS NOT NULL)::INT" for c in ["asset_id", *_RICH])


@query(
    f"SELECT asset_id, {', '.join(_RICH)}, record_id FROM metadata_export QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY {_NONNULL} DESC, record_id) = 1"
)
def best_row_dedup(spark, d):
    """A1: the fullest row per asset."""
    return merge.best_row(table(spark, d, "metadata_export").select("asset_id", *_RICH, "record_id"), ["asset_id"], "record_id")


@query(
    f"""WITH b AS (SELECT asset_id, {', '.join(_RICH)} FROM metadata_export QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY {_NONNULL} DESC, record_id) = 1),
m AS (SELECT regexp_replace(lower(trim(asset_id)), '\\.[^.]*$', '') AS asset_id, store_name, file_size FROM (
  SELECT *, row_number() OVER (PARTITION BY regexp_replace(lower(trim(asset_id)), '\\.[^.]*$', '') ORDER BY (store_name IS NOT NULL)::INT + (file_size IS NOT NULL)::INT DESC, checked_at, filename, content_ord, store_name, file_size) AS n FROM metadata_mirror) WHERE n = 1)
SELECT d.doc_id, d.asset_id, d.lang, {', '.join('b.' + c for c in _RICH)}, m.store_name, m.file_size
FROM documents d LEFT JOIN b ON d.asset_id IS NOT DISTINCT FROM b.asset_id LEFT JOIN m ON d.asset_id IS NOT DISTINCT FROM m.asset_id"""
)
def merge_on_asset(spark, d):
    """Left joins with the best row of each table; master keeps its rows."""
    master = table(spark, d, "documents").select("doc_id", "asset_id", "lang")
    rich = table(spark, d, "metadata_export").select("asset_id", *_RICH, "record_id")
    order = F.struct("checked_at", "filename", "content_ord", "store_name", "file_size")
    mirror = table(spark, d, "metadata_mirror").select(drop_extension(F.lower(F.trim("asset_id"))).alias("asset_id"), "store_name", "file_size", order.alias("pos"))
    return merge.merge_tables(master, [(rich, "record_id"), (mirror, "pos")], "asset_id")


_LISTS = """
lists AS (
  SELECT document, k, list(term ORDER BY term) AS terms FROM (
    SELECT DISTINCT trim(lower(document)) AS document, regexp_replace(lower(rulebase_class), '[^a-z]', '', 'g') AS k, trim(term) AS term FROM classifier_score WHERE trim(term) <> '') GROUP BY ALL)
"""


@query(
    f"""WITH {_LISTS}, docs AS (SELECT DISTINCT trim(lower(document)) AS document FROM classifier_score)
SELECT document, CASE WHEN len(g.terms) > 0 THEN g.terms ELSE u.terms END AS subjects FROM docs
LEFT JOIN (SELECT * FROM lists WHERE k = 'geographyupward') g USING (document) LEFT JOIN (SELECT * FROM lists WHERE k = 'genericupward') u USING (document)"""
)
def subject_fallback(spark, d):
    """The preferred source's values, else the other's."""
    s = table(spark, d, "classifier_score").select(F.trim(F.lower("document")).alias("document"), F.regexp_replace(F.lower("rulebase_class"), "[^a-z]", "").alias("k"), F.trim("term").alias("term"))
    lists = s.where("term <> ''").groupBy("document", "k").agg(F.array_sort(F.collect_set("term")).alias("terms")).withColumn("pos", F.lit(0))
    side = lambda k: lists.where(F.col("k") == k).select("document", "terms", "pos")
    return merge.fallback_values(s.select("document").distinct(), side("geographyupward"), side("genericupward"), "document", "terms", "pos", "subjects")


@query(
    r"""WITH c AS (SELECT lower(asset_id) || '/' || content_ord AS k, filename, CAST(file_size AS VARCHAR) AS file_size FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(asset_id), content_ord ORDER BY record_id) AS n FROM metadata_export WHERE content_ord IS NOT NULL) WHERE n = 1),
w AS (SELECT regexp_replace(lower(asset_id), '\.[^.]*$', '') || '/' || content_ord AS k, filename, CAST(file_size AS VARCHAR) AS file_size FROM (
  SELECT *, row_number() OVER (PARTITION BY regexp_replace(lower(asset_id), '\.[^.]*$', ''), content_ord ORDER BY checked_at, filename, file_size) AS n FROM metadata_mirror) WHERE n = 1)
SELECT k, 'filename' AS field, c.filename AS current_value, w.filename AS desired_value FROM c JOIN w USING (k) WHERE coalesce(c.filename, '') <> coalesce(w.filename, '')
UNION ALL SELECT k, 'file_size', c.file_size, w.file_size FROM c JOIN w USING (k) WHERE c.file_size IS DISTINCT FROM w.file_size"""
)
def change_set(spark, d):
    """Fields that an update would change."""
    key = lambda a: F.concat(a, F.lit("/"), F.col("content_ord").cast("string")).alias("k")
    current = table(spark, d, "metadata_export").where("content_ord IS NOT NULL").select(key(F.lower("asset_id")), "filename", "file_size", F.col("record_id").alias("pos"))
    desired = table(spark, d, "metadata_mirror").select(key(drop_extension(F.lower("asset_id"))), "filename", "file_size", F.struct("checked_at", "filename", "file_size").alias("pos"))
    return merge.change_set(merge.first_row(current, ["k"], "pos"), merge.first_row(desired, ["k"], "pos"), "k", ["filename", "file_size"], strict=["file_size"])


@query(
    """WITH r AS (SELECT DISTINCT parent_ref AS ref FROM metadata_export UNION SELECT DISTINCT asset_id FROM documents)
SELECT r.ref, CASE WHEN a.asset_id IS NOT NULL THEN 'asset' WHEN f.ref IS NOT NULL THEN 'folder' END AS found_as
FROM r LEFT JOIN (SELECT DISTINCT asset_id FROM metadata_export) a ON r.ref = a.asset_id LEFT JOIN entity_folder f ON r.ref = f.ref"""
)
def entity_resolution(spark, d):
    """Asset first, then folder."""
    refs = table(spark, d, "metadata_export").select(F.col("parent_ref").alias("ref")).unionByName(table(spark, d, "documents").select(F.col("asset_id").alias("ref"))).distinct()
    assets = table(spark, d, "metadata_export").select(F.col("asset_id").alias("ref"))
    return merge.resolve_entity(refs, assets, table(spark, d, "entity_folder"), "ref")


@query(
    r"""WITH p AS (SELECT filename AS path, regexp_replace(filename, '\.[^./]*$', '') AS stem, lower(regexp_extract(filename, '\.([^./]*)$', 1)) AS ext FROM metadata_export WHERE filename IS NOT NULL)
SELECT path, stem IN (SELECT stem FROM p WHERE ext = 'pdf') AS has_sidecar FROM p WHERE ext IN ('jpg', 'mp3', 'mp4')"""
)
def media_with_sidecar(spark, d):
    """Media files with a file of the same stem."""
    files = table(spark, d, "metadata_export").where("filename IS NOT NULL").select(F.col("filename").alias("path"))
    return merge.pair_sidecars(files, "path", ["jpg", "mp3", "mp4"], "pdf")


@query(
    r"""SELECT filename AS old_name, trim(dc_title) || regexp_extract(filename, '(\.[^.]*)$', 1) AS new_name FROM metadata_export
WHERE trim(dc_title) <> '' AND filename IN (SELECT filename FROM metadata_mirror)"""
)
def rename_plan(spark, d):
    """J13, F17, K15."""
    wanted = table(spark, d, "metadata_export").where("trim(dc_title) <> ''").select("filename", "dc_title")
    return merge.rename_plan(wanted, table(spark, d, "metadata_mirror"), "filename", "dc_title")


@query("SELECT asset_id, count(*) AS n FROM metadata_export GROUP BY ALL HAVING count(*) > 1 OR asset_id IS NULL OR trim(asset_id) = ''")
def repeated_keys(spark, d):
    """A18."""
    return merge.assert_unique(table(spark, d, "metadata_export"), "asset_id")


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY ALL")
def month_growth(spark, d):
    """A6."""
    return report.month_counts(table(spark, d, "orders"), "o_orderdate")


@query("SELECT file_extension, count(*) AS n FROM metadata_export GROUP BY ALL")
def type_counts(spark, d):
    """A7, O9."""
    return report.category_counts(table(spark, d, "metadata_export"), "file_extension")


@query("SELECT round(sum(CAST(file_size AS DOUBLE)) / 1073741824.0, 2) AS total_gib FROM metadata_export")
def total_size(spark, d):
    """A8."""
    return report.total_gib(table(spark, d, "metadata_export"), "file_size")


_BLANK = ["entity_title", "dc_date", "dc_format", "dc_language", "dc_description"]


@query(
    "SELECT asset_id, field, first_pos FROM (SELECT asset_id, min(record_id) AS first_pos, "
    + ", ".join(f"bool_and(coalesce(trim({c}) = '', true)) AS {c}" for c in _BLANK)
    + f" FROM metadata_export GROUP BY ALL) UNPIVOT (blank FOR field IN ({', '.join(_BLANK)})) WHERE blank"
)
def field_completeness(spark, d):
    """Fields that are blank in all rows of an asset."""
    return report.incomplete_fields(table(spark, d, "metadata_export"), "asset_id", _BLANK, "record_id")


@query(
    """WITH f AS (SELECT document, term, min(classified_at) AS p FROM classifier_score WHERE term IS NOT NULL GROUP BY ALL)
SELECT document, list(term ORDER BY p, term) AS "values" FROM f GROUP BY ALL"""
)
def distinct_terms(spark, d):
    """Distinct values per document in the order of their first occurrence."""
    return report.distinct_list(table(spark, d, "classifier_score"), "document", "term", "classified_at")


@query("SELECT event_type, count(*) AS n, avg(value) AS average, sum(value) AS total, max(value) AS longest, sum(value) / nullif(max(value), 0) AS speed_up FROM events GROUP BY ALL")
def run_summary(spark, d):
    """A16."""
    return report.run_summary(table(spark, d, "events"), "event_type", "value")


@query("SELECT document, string_agg(term, ' | ' ORDER BY classified_at, term) AS text FROM classifier_score WHERE term IS NOT NULL GROUP BY ALL")
def joined_terms(spark, d):
    """A20."""
    return report.joined_text(table(spark, d, "classifier_score"), "document", "term", "classified_at", " | ")


@query(
    """WITH u AS (SELECT DISTINCT document, term, score FROM classifier_score WHERE score >= 0.48)
SELECT document, term, score, CAST(row_number() OVER (PARTITION BY document ORDER BY score DESC NULLS LAST, term NULLS FIRST) AS INT) AS rank FROM u QUALIFY rank <= 10"""
)
def topk_terms(spark, d):
    """The ten best terms of each document."""
    return report.top_per_group(table(spark, d, "classifier_score").where("score >= 0.48"), "document", "term", "score", 10)


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts FROM events GROUP BY ALL")
def event_latest_per_user(spark, d):
    """A5, O6."""
    return report.latest_per_key(table(spark, d, "events"), "user_id", "event_type", "ts", "event_id")


@query("SELECT doc_id, source FROM documents ORDER BY source, doc_id LIMIT 50 OFFSET 25")
def list_slice(spark, d):
    """A slice of an ordered list; the limit is the feature."""
    return report.page_slice(table(spark, d, "documents").select("doc_id", "source"), ["source", "doc_id"], 25, 75)


@query(
    r"""SELECT record_id, filename, CASE WHEN n = 0 THEN filename ELSE regexp_replace(filename, '\.[^.]*$', '') || '_' || n || regexp_extract(filename, '(\.[^.]*)$', 1) END AS unique_name
FROM (SELECT record_id, filename, row_number() OVER (PARTITION BY filename ORDER BY record_id) - 1 AS n FROM metadata_export WHERE filename IS NOT NULL)"""
)
def unique_file_names(spark, d):
    """A12."""
    return sets.number_repeats(table(spark, d, "metadata_export").where("filename IS NOT NULL").select("record_id", "filename"), "filename", "record_id")


@query("SELECT filename, min(record_id) AS first_pos FROM metadata_export GROUP BY ALL")
def distinct_in_order(spark, d):
    """A3."""
    return sets.distinct_first_seen(table(spark, d, "metadata_export"), "filename", "record_id")


@query(
    r"""WITH e AS (SELECT lower(asset_id) AS asset_id, max(filename) AS filename FROM metadata_export GROUP BY ALL),
m AS (SELECT regexp_replace(lower(asset_id), '\.[^.]*$', '') AS asset_id, max(filename) AS filename FROM metadata_mirror GROUP BY ALL)
SELECT * FROM m UNION ALL SELECT * FROM e ANTI JOIN m USING (asset_id)"""
)
def union_right_wins(spark, d):
    """U4."""
    left = table(spark, d, "metadata_export").groupBy(F.lower("asset_id").alias("asset_id")).agg(F.max("filename").alias("filename"))
    right = table(spark, d, "metadata_mirror").groupBy(drop_extension(F.lower("asset_id")).alias("asset_id")).agg(F.max("filename").alias("filename"))
    return sets.union_wins_right(left, right, "asset_id")


@query(
    "SELECT asset_id, filename, CAST(NULL AS VARCHAR) AS doc_kind FROM metadata_mirror UNION ALL SELECT asset_id, NULL, doc_kind FROM documents"
)
def union_sources(spark, d):
    """Sources with different columns."""
    return sets.union_sources(table(spark, d, "metadata_mirror").select("asset_id", "filename"), table(spark, d, "documents").select("asset_id", "doc_kind"))


@query("SELECT DISTINCT source FROM documents UNION SELECT 'https://seed.example/'")
def seeds(spark, d):
    """U9, A4, O2."""
    return sets.seeds_with_constant(table(spark, d, "documents"), "source", "https://seed.example/")


@query(
    r"""WITH m AS (SELECT regexp_replace(document, '^.*/', '') AS name, rulebase_class AS shard, document AS path FROM classifier_score)
SELECT name, arg_min(shard, (shard, path)) AS shard, arg_min(path, (shard, path)) AS path FROM m GROUP BY ALL"""
)
def shard_members(spark, d):
    """One member per base name, the first shard's."""
    rows = table(spark, d, "classifier_score").select(F.col("document").alias("path"), F.col("rulebase_class").alias("shard"))
    return sets.dedupe_members(rows, "path", "shard")


@query(
    r"""SELECT record_id, regexp_replace(filename, '\.[^.]*$', '') AS stem, lower(regexp_extract(filename, '[^.]\.([^.]*)$', 1)) AS ext,
  regexp_replace(preservica_path, '^.*[/\\]', '') AS base, regexp_matches(dc_title, '[^\x00-\x7F]') AS beyond_ascii,
  regexp_replace(dc_title, '^\s+|\s+$', '', 'g') AS title, coalesce(nullif(entity_title, ''), nullif(dc_title, ''), 'Unknown') AS shown,
  left(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(dc_title, '<', '_'), '>', '_'), ':', '_'), '"', '_'), '/', '_'), '\', '_'), '|', '_'), '?', '_'), '*', '_'), '^[ .]+|[ .]+$', '', 'g'), 200) AS safe
FROM metadata_export WHERE filename IS NOT NULL AND dc_title IS NOT NULL"""
)
def name_parts(spark, d):
    """F1, F4, F5, F15, F36, F51."""
    rows = table(spark, d, "metadata_export").where("filename IS NOT NULL AND dc_title IS NOT NULL")
    return rows.select(
        "record_id", drop_extension(F.col("filename")).alias("stem"), extension(F.col("filename")).alias("ext"), base_name(F.col("preservica_path")).alias("base"),
        non_ascii(F.col("dc_title")).alias("beyond_ascii"), strip(F.col("dc_title")).alias("title"), paths.display_name(F.col("entity_title"), F.col("dc_title")).alias("shown"),
        paths.safe_file_name(F.col("dc_title")).alias("safe"),
    )


@query(
    r"""SELECT record_id, CASE WHEN len(string_split(filename, '-')) >= 2 THEN string_split(filename, '-')[1] || '-' || string_split(filename, '-')[2] END AS tokens,
  CASE WHEN len(string_split(preservica_path, '/')) >= 2 THEN string_split(preservica_path, '/')[-2] ELSE '' END AS folder,
  'https://v.example/' || asset_id || '/play' AS link, regexp_replace(lower(replace(replace(replace(preservica_path, 'Admin', 'https://w.example'), '%20', '-'), ' ', '-')), '\.[^./]*$', '') AS address,
  replace(regexp_replace(regexp_replace(preservica_path, '[^\p{L}\p{N} _-]', '', 'g'), ' +$', ''), ' ', '_') AS plain
FROM metadata_export WHERE filename IS NOT NULL AND preservica_path IS NOT NULL"""
)
def path_expressions(spark, d):
    """F9, F11, F12, F16, F42."""
    p = F.col("preservica_path")
    return table(spark, d, "metadata_export").where("filename IS NOT NULL AND preservica_path IS NOT NULL").select(
        "record_id", paths.leading_tokens(F.col("filename"), 2, "-").alias("tokens"), paths.parent_segment(p).alias("folder"),
        paths.from_template("https://v.example/REPLACE/play", "REPLACE", F.col("asset_id")).alias("link"),
        paths.path_to_url(p, "Admin", "https://w.example", strip_extension=True).alias("address"), paths.plain_name(p).alias("plain"),
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_props(spark, d):
    """F53."""
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query(
    "SELECT field, max(n) AS width FROM (SELECT document, regexp_replace(lower(rulebase_class), '[^a-z]', '', 'g') AS field, count(*) AS n FROM classifier_score GROUP BY ALL) GROUP BY ALL"
)
def max_multiplicity(spark, d):
    """A10."""
    rows = table(spark, d, "classifier_score").select("document", F.regexp_replace(F.lower("rulebase_class"), "[^a-z]", "").alias("field"))
    return pivot.multiplicity(rows, "document", "field")


@query(
    "WITH v AS (SELECT series_name, n, line, row_number() OVER (PARTITION BY series_name ORDER BY n, line) AS k FROM (SELECT series_name, doc_kind, n, line FROM (SELECT lang AS series_name, doc_kind, min(doc_id) AS n, doc_kind AS line FROM documents WHERE lang IS NOT NULL AND doc_kind IS NOT NULL GROUP BY ALL))) "
    "SELECT series_name AS lang, " + ", ".join(f"coalesce(max(line) FILTER (k = {k}), '') AS \"kind{'' if k == 1 else '.' + str(k)}\"" for k in range(1, 8)) + " FROM v GROUP BY ALL"
)
def ragged_pivot(spark, d):
    """Repeated values as numbered columns."""
    rows = table(spark, d, "documents").where("lang IS NOT NULL AND doc_kind IS NOT NULL").groupBy("lang", "doc_kind").agg(F.min("doc_id").alias("pos"))
    return pivot.ragged_pivot(rows.select("lang", F.lit("kind").alias("field"), F.col("doc_kind").alias("value"), "pos"), "lang", "field", "value", "pos")


@query(
    """WITH e AS (SELECT record_id, unnest([{'pos': 0, 'name': 'title', 'value': dc_title}, {'pos': 1, 'name': 'date', 'value': dc_date}, {'pos': 2, 'name': 'type', 'value': dc_type}]) AS e FROM metadata_export)
SELECT record_id, e.pos AS pos, e.name AS name, e.value AS value FROM e WHERE trim(e.value) <> ''"""
)
def element_rows(spark, d):
    """F47, K10."""
    rows = table(spark, d, "metadata_export").select("record_id", F.col("dc_title").alias("title"), F.col("dc_date").alias("date"), F.col("dc_type").alias("type"))
    return pivot.to_elements(rows, "record_id", ["title", "date", "type"])


@query(
    """WITH e AS (SELECT record_id, unnest([{'p': 0, 'n': 'title', 'v': dc_title}, {'p': 1, 'n': 'date', 'v': dc_date}, {'p': 2, 'n': 'type', 'v': dc_type}]) AS e FROM metadata_export)
SELECT record_id, '<dc>' || string_agg('<dc:' || e.n || '>' || replace(replace(replace(e.v, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</dc:' || e.n || '>', '' ORDER BY e.p) || '</dc>' AS xml
FROM e WHERE trim(e.v) <> '' GROUP BY ALL"""
)
def xml_documents(spark, d):
    """K10, F19, F48."""
    return pivot.xml_rows(element_rows(spark, d), "record_id", "dc", "dc")


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def hourly_events(spark, d):
    """Extension: tumbling windows, the same code on a stream."""
    rows = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return incremental.windowed_counts(rows, "ts", "event_type").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    """SELECT n.n_name AS nation, p.p_brand AS brand, sum(l.l_extendedprice * (1 - l.l_discount)) AS revenue, count(*) AS n FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey GROUP BY ALL"""
)
def revenue_by_nation_brand(spark, d):
    """Extension: a star join, aggregated before the small sides are joined."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    t = lambda n: table(spark, d, n)
    return (
        t("lineitem").select("l_orderkey", "l_partkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("c_nationkey", "p_brand").agg(F.sum("r").alias("revenue"), F.count(F.lit(1)).alias("n"))
        .join(t("nation").select("n_nationkey", F.col("n_name").alias("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("nation", F.col("p_brand").alias("brand"), "revenue", "n")
    )
