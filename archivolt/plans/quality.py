"""Queries on record quality and on sources that are read from text columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from archivolt.operators import report
from archivolt.operators.pivot import xml_escape
from archivolt.plans.base import Registry
from archivolt.rules import metadata as rules
from archivolt.session import scratch_path, table
from archivolt.sources import html_pages, sinks, text_files, xml_files

query = Registry()

#: Terms of a list that rules may be made of; a longer list is refused, not cut.
MOST_TERMS = 10_000
_TYPES = ("Collection", "Dataset", "Interactive Resource", "Moving Image", "Physical Object", "Software", "Sound", "Still Image", "Text")
_REQUIRED = ("dc_title", "dc_description", "dc_creator", "dc_date", "dc_type", "dc_format", "dc_language")
#: Columns that the scorecard reads as arrays.
_ARRAYS = ("dc_title", "dc_description", "dc_creator", "dc_date", "dc_type", "dc_format", "dc_language", "icaew_content_type", "dc_relation")


def _profile(spark, d) -> rules.Profile:
    terms = table(spark, d, "vocabulary").where("field_name = 'icaew_content_type'").select("term").orderBy("term").limit(MOST_TERMS + 1).collect()
    if len(terms) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms in a list that rules are made of")
    subjects = [r[0] for r in table(spark, d, "subject_taxonomy").select("subject_term").limit(MOST_TERMS + 1).collect()]
    if len(subjects) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms in a list that rules are made of")
    return rules.Profile(
        required=_REQUIRED, types=_TYPES, content_types=tuple(r[0] for r in terms), subjects=tuple(subjects), description_suffix=".", reserved=("dc_relation",),
        full_name="Committee", abbreviation="Cttee",
    )


def _records(spark, d):
    rows = table(spark, d, "metadata_export").where("entity_type = 'EntityType.ASSET'")
    arrays = [F.array_compact(F.array(c)).alias(c) for c in _ARRAYS]
    # a packed cell holds several subjects, as repeated columns do
    arrays.append(F.split(F.coalesce("dc_subject", F.lit("")), "[;|]").alias("dc_subject"))
    return rows.select("record_id", "entity_title", "entity_description", "filename", "security_tag", *arrays)


def _scored(spark, d):
    return rules.scorecard(_records(spark, d), _profile(spark, d))


_STRIP = r"regexp_replace({0}, '^[\s\x{{00a0}}]+|[\s\x{{00a0}}]+$', '', 'g')"
_V = {c: f"v_{c}" for c in ("entity_title", "entity_description", "filename", "security_tag", *_ARRAYS)}
_SCORE_SQL = rf"""
clean AS (
  SELECT record_id, {', '.join(rf"coalesce(regexp_replace({c}, '^[\s\x{{00a0}}]+|[\s\x{{00a0}}]+$', '', 'g'), '') AS {v}" for c, v in _V.items())},
    list_filter(list_transform(string_split_regex(coalesce(dc_subject, ''), '[;|]'), lambda x: {_STRIP.format('x')}), lambda x: x <> '') AS subjects, (SELECT list(subject_term) FROM subject_taxonomy) AS known,
    {', '.join(f"coalesce({c}, '') AS r_{c}" for c in _ARRAYS)}
  FROM metadata_export WHERE entity_type = 'EntityType.ASSET'),
parts AS (
  SELECT record_id,
    {' + '.join(f"CASE WHEN v_{c} <> '' THEN 5 ELSE 0 END" for c in _REQUIRED)} AS score_required,
    CASE WHEN v_entity_title = v_dc_title THEN 5 ELSE 0 END + CASE WHEN v_entity_description = v_dc_description THEN 5 ELSE 0 END AS score_consistency,
    CASE WHEN regexp_full_match(v_dc_date, '[0-9]{{4}}(-[0-9]{{2}}(-[0-9]{{2}})?)?') AND
      try_cast(CASE length(v_dc_date) WHEN 4 THEN v_dc_date || '-01-01' WHEN 7 THEN v_dc_date || '-01' ELSE v_dc_date END AS DATE) IS NOT NULL THEN 10 ELSE 0 END AS score_date,
    CASE WHEN v_dc_type IN {_TYPES} THEN 5 ELSE 0 END
      + CASE WHEN v_icaew_content_type = '' OR v_icaew_content_type IN (SELECT term FROM vocabulary WHERE field_name = 'icaew_content_type') THEN 5 ELSE 0 END
      + CASE WHEN regexp_full_match(v_dc_language, '[a-z]{{2}}(-[A-Z]{{2}})?') THEN 5 ELSE 0 END AS score_vocabulary,
    CASE WHEN len(subjects) > 10 THEN 0 WHEN len(list_filter(subjects, lambda x: NOT list_contains(known, x))) > 0 THEN 5 ELSE 10 END AS score_subjects,
    CASE WHEN v_dc_description <> '' AND v_dc_description[-1] = '.' THEN 5 ELSE 0 END
      + CASE WHEN length(v_dc_description) > 80 AND v_dc_description <> v_filename AND (v_filename = '' OR NOT starts_with(v_dc_description, string_split(v_filename, '.')[1])) THEN 5 ELSE 0 END AS score_description,
    CASE WHEN v_dc_title <> '' AND NOT contains(v_dc_title, '&') THEN 2 ELSE 0 END + CASE WHEN v_dc_title <> '' AND v_dc_title[-1] <> '.' THEN 2 ELSE 0 END
      + CASE WHEN regexp_matches(v_dc_title, '^[\p{{Lu}}\p{{Nd}}]') THEN 1 ELSE 0 END AS score_title
  FROM clean),
scored AS (SELECT *, score_required + score_consistency + score_date + score_vocabulary + score_subjects + score_description + score_title AS score FROM parts)
"""
_DIMS = ("required", "consistency", "date", "vocabulary", "subjects", "description", "title")


@query(f"WITH {_SCORE_SQL} SELECT record_id, {', '.join('CAST(score_' + x + ' AS INT) AS score_' + x for x in _DIMS)}, CAST(score AS INT) AS score FROM scored")
def scorecard(spark, d):
    """Points of every record by dimension."""
    return _scored(spark, d).select("record_id", *[f"score_{x}" for x in _DIMS], "score")


@query(
    f"""WITH {_SCORE_SQL}, b AS (SELECT CASE WHEN score >= 90 THEN '90-100' WHEN score >= 75 THEN '75-89' WHEN score >= 50 THEN '50-74' WHEN score >= 25 THEN '25-49' ELSE '0-24' END AS band FROM scored)
SELECT e.band, count(b.band) AS n, round(100.0 * count(b.band) / (SELECT count(*) FROM b), 1) AS percent FROM (VALUES ('90-100'), ('75-89'), ('50-74'), ('25-49'), ('0-24')) e(band) LEFT JOIN b ON e.band = b.band GROUP BY ALL"""
)
def score_bands(spark, d):
    """Records and share per band of the score."""
    return report.banded(_scored(spark, d), "score", rules.BANDS)


_WHITE = ("dc_title", "dc_creator", "dc_date", "dc_type", "dc_format", "dc_language", "dc_description")
_OWN = "(length(v_dc_description) > 80 AND v_dc_description <> v_filename AND (v_filename = '' OR NOT starts_with(v_dc_description, string_split(v_filename, '.')[1])))"
_DATED = "regexp_full_match(v_dc_date, '[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?') AND try_cast(CASE length(v_dc_date) WHEN 4 THEN v_dc_date || '-01-01' WHEN 7 THEN v_dc_date || '-01' ELSE v_dc_date END AS DATE) IS NOT NULL"
_LETTER = r"regexp_matches(v_dc_title, '^[\p{Lu}\p{Nd}]')"
_AMERICAN = r"(?i)\b(" + "|".join(rules.AMERICAN) + r")\b"
_FLAG_CASES = [
    *[(f"v_{c} = ''", f"'missing_{c}'") for c in _REQUIRED],
    ("v_entity_title <> v_dc_title", "'entity_title_mismatch'"), ("v_entity_description <> v_dc_description", "'entity_desc_mismatch'"),
    (f"v_dc_date <> '' AND NOT ({_DATED})", "'invalid_date_format:' || v_dc_date"),
    (f"v_dc_type <> '' AND v_dc_type NOT IN {_TYPES}", "'invalid_dc_type:' || v_dc_type"),
    ("v_icaew_content_type <> '' AND v_icaew_content_type NOT IN (SELECT term FROM vocabulary WHERE field_name = 'icaew_content_type')", "'invalid_content_type:' || v_icaew_content_type"),
    ("v_dc_language <> '' AND NOT regexp_full_match(v_dc_language, '[a-z]{2}(-[A-Z]{2})?')", "'invalid_language:' || v_dc_language"),
    ("len(subjects) > 10", "'too_many_subjects:' || len(subjects)"),
    ("len(subjects) <= 10 AND len(stray) > 0", "'invalid_subject_names:' || array_to_string(stray[1:3], '|')"),
    ("v_dc_description <> '' AND v_dc_description[-1] <> '.'", "'missing_ai_suffix'"),
    (f"v_dc_description <> '' AND NOT {_OWN}", "'description_placeholder_or_stub'"),
    ("contains(v_dc_title, '&')", "'title_contains_ampersand'"), ("v_dc_title <> '' AND v_dc_title[-1] = '.'", "'title_trailing_fullstop'"),
    (f"v_dc_title <> '' AND NOT {_LETTER}", "'title_lowercase_start'"), ("v_dc_relation <> ''", "'reserved_dc_relation_populated'"),
    (r"v_dc_description[-1] = '.' AND trim(v_dc_description[:-2]) <> '' AND trim(v_dc_description[:-2])[-1] NOT IN ('.', '?')", "'description_missing_period_before_ai_suffix'"),
    (r"regexp_matches(v_dc_title, '\b\d{4}-\d{2}-\d{2}\b')", "'title_contains_iso_date'"),
    (f"regexp_matches(v_dc_description, '{_AMERICAN}')", "'american_spelling_in_desc'"), (f"regexp_matches(v_dc_title, '{_AMERICAN}')", "'american_spelling_in_title'"),
    ("len(untidy) > 0", "'whitespace_in:' || array_to_string(untidy, '|')"),
    ("v_security_tag <> '' AND v_security_tag NOT IN ('open', 'closed', 'public')", "'invalid_security_tag:' || v_security_tag"),
    ("v_dc_format <> '' AND v_dc_format <> lower(v_dc_format)", "'format_not_lowercase:' || v_dc_format"),
    ("v_dc_format <> '' AND v_dc_format = lower(v_dc_format) AND NOT regexp_full_match(v_dc_format, '[a-z]+/[a-z0-9][a-z0-9.+-]*')", "'unrecognised_format:' || v_dc_format"),
    ("v_dc_creator <> '' AND v_dc_creator[-1] = '.'", "'creator_trailing_period'"), ("v_dc_creator[-1] <> '.' AND contains(v_dc_creator, 'Committee')", "'creator_use_Cttee_abbreviation'"),
    *[(rf"regexp_matches({v}, '[^\x00-\x7F]')", f"'non_ascii_in_{n}'") for v, n in (("v_entity_title", "entity_title"), ("v_dc_title", "dc_title"), ("v_dc_description", "dc_desc"))],
]
_UNTIDY = ", ".join(f"CASE WHEN r_{c} <> v_{c} THEN '{c}' END" for c in _WHITE)
_PROBLEMS_SQL = f"""
WITH {_SCORE_SQL}, more AS (
  SELECT c.*, s.score, list_filter(c.subjects, lambda x: NOT list_contains(c.known, x)) AS stray, list_filter([{_UNTIDY}, CASE WHEN spaced THEN 'dc_subject' END], lambda x: x IS NOT NULL) AS untidy
  FROM (SELECT a.*, len(list_filter(string_split_regex(m.dc_subject, '[;|]'), lambda x: x <> {_STRIP.format('x')})) > 0 AS spaced FROM clean a JOIN metadata_export m USING (record_id)) c JOIN scored s USING (record_id)),
f AS (SELECT record_id, CAST(score AS INT) AS score, list_filter([{', '.join(f'CASE WHEN {c} THEN {m} END' for c, m in _FLAG_CASES)}], lambda x: x IS NOT NULL) AS fl FROM more)
SELECT record_id, score, array_to_string(fl, '; ') AS flags FROM f WHERE len(fl) > 0
"""


@query(_PROBLEMS_SQL)
def problem_records(spark, d):
    """Records with flags, joined in order."""
    return _scored(spark, d).where(F.size("flags") > 0).select("record_id", "score", F.array_join("flags", "; ").alias("flags"))


def _validated(spark, d):
    rows = table(spark, d, "metadata_export").where("entity_type = 'EntityType.ASSET'")
    return rules.validator(rows, _profile(spark, d), acronyms=("VAT", "UK", "EU"), proper_nouns=("Kestrel", "Eastvale"), suffixes=("Handle with care",))


_TEXTS = ("dc_title", "dc_date", "icaew_internal_reference", "icaew_content_type", "dc_type", "dc_language", "dc_format", "dc_creator", "dc_relation", "security_tag", "entity_title", "entity_description", "dc_description", "dc_subject")
_EMPTY_ITEM = "contains({0}, ';') AND len(list_filter(string_split({0}, ';'), lambda x: trim(x) = '')) > 0"
_TITLED = "upper(x[1]) || lower(x[2:])"
_PARTS = "string_split(v_icaew_internal_reference, '-')[2:]"
_ERRORS = [
    ("len(list_filter(string_split_regex(v_dc_title, '\\s+'), lambda w: upper(regexp_replace(w, '[^\\p{L}\\p{N}]', '', 'g')) IN ('VAT', 'UK', 'EU') AND regexp_replace(w, '[^\\p{L}\\p{N}]', '', 'g') <> upper(regexp_replace(w, '[^\\p{L}\\p{N}]', '', 'g')))) > 0", "'dc_title: acronym not in capitals'"),
    (f"v_dc_title <> '' AND NOT {_LETTER}", "'dc_title: must start with a capital or a digit'"), ("regexp_matches(v_dc_title, '[—–]')", "'dc_title: dash other than a hyphen'"),
    (r"regexp_matches(v_dc_title, '\d{4}-\d{2}-\d{2}')", "'dc_title: ISO date'"),
    (r"len(list_filter(string_split(v_dc_title, ':')[2:], lambda x: regexp_matches(trim(x), '^\p{Lu}') AND string_split_regex(trim(x), '\s+')[1] NOT IN ('VAT', 'UK', 'EU'))) > 0", "'dc_title: capital after a colon'"),
    ("contains(v_dc_title, '&')", "'dc_title: ampersand'"), ("v_dc_title <> '' AND v_dc_title[-1] = '.'", "'dc_title: ends with a full stop'"),
    ("v_dc_date <> '' AND NOT regexp_full_match(v_dc_date, '[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?')", "'dc_date: not YYYY, YYYY-MM or YYYY-MM-DD'"),
    (f"regexp_full_match(v_dc_date, '[0-9]{{4}}(-[0-9]{{2}}(-[0-9]{{2}})?)?') AND NOT ({_DATED})", "'dc_date: no calendar date'"),
    ("v_entity_title <> v_dc_title", "'entity_title: differs from dc_title'"),
    ("v_icaew_internal_reference <> '' AND NOT regexp_full_match(v_icaew_internal_reference, '[0-9]{8}-[A-Za-z0-9-]+')", "'icaew_internal_reference: not YYYYMMDD-Name'"),
    ("regexp_full_match(v_icaew_internal_reference, '[0-9]{4}00[0-9]{2}-[A-Za-z0-9-]+') AND v_icaew_internal_reference[7:8] <> '00'", "'icaew_internal_reference: day without a month'"),
    ("v_icaew_content_type <> '' AND v_icaew_content_type NOT IN (SELECT term FROM vocabulary WHERE field_name = 'icaew_content_type')", "'icaew_content_type: not in the vocabulary'"),
    (f"v_dc_type <> '' AND v_dc_type NOT IN {_TYPES}", "'dc_type: not in the vocabulary'"),
    ("v_dc_language <> '' AND NOT regexp_full_match(v_dc_language, '[a-z]{2}(-[A-Z]{2})?')", "'dc_language: not a language code'"),
    ("v_dc_format <> lower(v_dc_format)", "'dc_format: not in lower case'"),
    ("v_dc_format <> '' AND NOT regexp_full_match(lower(v_dc_format), '[a-z]+/[a-z0-9][a-z0-9.+-]*')", "'dc_format: unknown format'"),
    *[(f"len(list_filter({_PARTS}, lambda x: {c})) > 0", f"'icaew_internal_reference: {t}: ' || array_to_string(list_filter({_PARTS}, lambda x: {c}), ', ')") for c, t in (
        ("upper(x) IN ('VAT', 'UK', 'EU') AND x <> upper(x)", "acronym not in capitals"), (f"({_TITLED}) IN ('Kestrel', 'Eastvale') AND x <> ({_TITLED})", "name not in title case"),
        (r"regexp_matches(x, '^[^\p{Lu}0-9]')", "word not in title case"))],
    *[(rf"regexp_matches(v_{c}, '[^\x00-\x7F]')", rf"'{c}: characters beyond ASCII: ' || array_to_string(list_sort(list_distinct(regexp_extract_all(v_{c}, '[^\x00-\x7F]'))), '')") for c in (
        "dc_title", "entity_title", "dc_creator", "dc_description", "entity_description", "dc_subject", "dc_relation", "icaew_internal_reference")],
]
_WARNINGS = [
    (_EMPTY_ITEM.format("v_dc_creator"), "'dc_creator: empty item in the list'"), ("contains(v_dc_creator, 'Committee')", "'dc_creator: use Cttee'"), ("v_dc_creator <> '' AND v_dc_creator[-1] = '.'", "'dc_creator: ends with a full stop'"),
    (_EMPTY_ITEM.format("v_dc_relation"), "'dc_relation: empty item in the list'"),
    *[(f"contains(v_{c}, '  ')", f"'{c}: double space'") for c in ("dc_title", "entity_title", "dc_creator", "dc_subject", "dc_relation")],
    *[x for c in ("entity_description", "dc_description") for x in (
        (f"contains(v_{c}, '  ')", f"'{c}: double space'"),
        (f"contains(v_{c}, 'Handle with care') AND trim(string_split(v_{c}, 'Handle with care')[1])[-1:] <> '.'", f"'{c}: no full stop before the closing remark'"),
        (f"v_{c} <> '' AND NOT contains(v_{c}, 'Handle with care') AND v_{c}[-1] NOT IN ('.', '?')", f"'{c}: doesn''t end a sentence'"))],
    ("v_security_tag <> '' AND v_security_tag NOT IN ('open', 'closed', 'public')", "'security_tag: unknown tag'"),
]
_FOUND = lambda cases: f"list_filter([{', '.join(f'CASE WHEN {c} THEN {m} END' for c, m in cases)}], lambda m: m IS NOT NULL)"
_VALID_SQL = f"""
texts AS (SELECT record_id, {', '.join(f"coalesce({_STRIP.format(c)}, '') AS v_{c}" for c in _TEXTS)} FROM metadata_export WHERE entity_type = 'EntityType.ASSET'),
judged AS (SELECT record_id, {_FOUND(_ERRORS)} AS errors, {_FOUND(_WARNINGS)} AS warnings FROM texts)
"""


@query(f"WITH {_VALID_SQL} SELECT record_id, array_to_string(errors, '; ') AS errors, array_to_string(warnings, '; ') AS warnings FROM judged")
def validation(spark, d):
    """F37, F38, R1, R3-R27 but R13: errors and warnings of every record."""
    return _validated(spark, d).select("record_id", F.array_join("errors", "; ").alias("errors"), F.array_join("warnings", "; ").alias("warnings"))


@query(f"WITH {_VALID_SQL} SELECT string_split(m, ':')[1] AS kind, count(*) AS n FROM (SELECT unnest(errors) AS m FROM judged) GROUP BY ALL")
def error_prefix_stats(spark, d):
    """Errors by the field they name."""
    return report.message_prefixes(_validated(spark, d).select(F.explode("errors").alias("message")), "message")


@query(
    r"""SELECT ref, CASE WHEN contains(lower(title), 'minutes') THEN 'minutes' WHEN contains(lower(title), 'record') THEN 'recordings' WHEN contains(lower(title), 'account') THEN 'accounts' ELSE 'other' END AS kind,
  nullif(regexp_extract(title, '\b((?:19|20)\d{2})\b', 1), '') AS year, array_to_string(list_filter([coalesce(trim(title), ''), coalesce(trim(security_tag), '')], lambda x: x <> ''), ' | ') AS description
FROM entity_folder"""
)
def folder_descriptions(spark, d):
    """kind, year and a composed description of folders."""
    cases = (("minutes", "minutes"), ("record", "recordings"), ("account", "accounts"))
    return table(spark, d, "entity_folder").select(
        "ref", rules.first_match(F.col("title"), cases, "other").alias("kind"), rules.year_in(F.col("title")).alias("year"),
        rules.described([F.col("title"), F.col("security_tag")]).alias("description"),
    )


_PAGE = "'<html><head><title>' || escaped_title || '</title></head><body><div class=\"more-link extra\"><a href=\" /a/' || record_id || '\">x</a><a>y</a></div></body></html>'"


def _pages(spark, d):
    html = F.expr(_PAGE.replace('\\"', '"'))
    rows = table(spark, d, "metadata_export").withColumn("escaped_title", xml_escape(F.coalesce("entity_title", F.lit(""))))
    return rows.select("record_id", html.alias("html"), "entity_title")


@query(
    r"""SELECT record_id, nullif(trim(coalesce(entity_title, '')), '') AS title, true AS has_link, false AS has_secure, ['/a/' || record_id] AS links
FROM metadata_export"""
)
def html_predicates(spark, d):
    """Title, elements and links of pages."""
    h = F.col("html")
    return _pages(spark, d).select(
        "record_id", html_pages.title(h).alias("title"), html_pages.has_element(h, "div", "class", "more-link").alias("has_link"),
        html_pages.has_element(h, "section", "class", "secure").alias("has_secure"), html_pages.links(h).alias("links"),
    )


@query(r"SELECT DISTINCT regexp_replace(dc_type, '^[\s\x{00a0}]+|[\s\x{00a0}]+$', '', 'g') AS value FROM metadata_export WHERE regexp_replace(dc_type, '[\s\x{00a0}]+', '', 'g') <> ''")
def html_table_column(spark, d):
    """Distinct cells of one column of the pages' tables."""
    rows = table(spark, d, "metadata_export").where("dc_type IS NOT NULL")
    row = F.concat(F.lit("<table><tr><th>a</th><th>b</th></tr><tr><td>"), F.col("record_id").cast("string"), F.lit("</td><td>"), xml_escape(F.col("dc_type")), F.lit("</td></tr></table>"))
    return html_pages.table_column(rows.select(F.col("record_id").cast("string").alias("url"), row.alias("html")), 1, 2)


@query(
    """SELECT event_id, 'https://e.example/' || event_id AS url, CASE WHEN value IS NULL THEN NULL WHEN event_type = 'error' THEN '404' ELSE '200' END AS status,
  CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS length, false AS length_unspecified, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS saved, NULL AS location FROM events"""
)
def log_fields(spark, d):
    """Fields of download-log entries."""
    size = F.floor("value").cast("string")
    entry = F.concat(
        F.lit("--2024-01-01 00:00:00--  https://e.example/"), F.col("event_id").cast("string"), F.lit("\nHTTP request sent, awaiting response... "),
        F.when(F.col("event_type") == "error", "404 Not Found").otherwise("200 OK"), F.lit("\nLength: "), size, F.lit(" (1K) [text/html]\n\n2024-01-01 (1 MB/s) - 'x' saved ["), size, F.lit("]\n"),
    )
    rows = table(spark, d, "events").select("event_id", F.explode(text_files.wget_entries(entry)).alias("e"))
    return rows.select("event_id", text_files.wget_details(F.col("e")).alias("x")).select("event_id", "x.*")


@query(
    r"""SELECT record_id, CASE WHEN trim(dc_title) <> '' THEN [regexp_replace(dc_title, '^[[:space:]]+|[[:space:]]+$', '', 'g')] ELSE [] END AS titles, CASE WHEN trim(dc_date) <> '' THEN [trim(dc_date)] ELSE [] END AS dates
FROM metadata_export"""
)
def xml_fields(spark, d):
    """Values by element name of XML fragments."""
    text = lambda c: xml_escape(F.coalesce(c, F.lit("")))
    xml = F.concat(F.lit('<oai_dc:dc xmlns:dc="u"><dc:title>'), text("dc_title"), F.lit("</dc:title><dc:date>"), text("dc_date"), F.lit("</dc:date></oai_dc:dc>"))
    rows = table(spark, d, "metadata_export")
    values = xml_files.dc_values(xml, ["title", "date"])
    return rows.select("record_id", values.alias("v")).select("record_id", F.col("v")["title"].alias("titles"), F.col("v")["date"].alias("dates"))


@query("SELECT ref, parent, title FROM entity_folder")
def csv_round_trip(spark, d):
    """A table through a CSV file."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, d, "entity_folder").select("ref", "parent", "title").coalesce(1), path)
    return text_files.csv_table(spark, path, required=["ref", "parent"]).select("ref", "parent", "title")


@query("SELECT DISTINCT source AS line FROM documents WHERE trim(source) <> ''")
def lines_round_trip(spark, d):
    """A list through a text file."""
    path = scratch_path(spark, "lines")
    sinks.write_lines(table(spark, d, "documents").where("trim(source) <> ''").select("source").distinct(), "source", path)
    return text_files.lines(spark, path)


@query("SELECT 'https://e.example/' || event_id AS url, CAST(200 + event_id % 3 AS INT) AS status FROM events")
def page_list_round_trip(spark, d):
    """A page list as JSON lines, the header and unreadable lines dropped."""
    path = scratch_path(spark, "pages")
    pages = table(spark, d, "events").select(F.to_json(F.struct(F.concat(F.lit("https://e.example/"), F.col("event_id").cast("string")).alias("url"), (200 + F.col("event_id") % 3).alias("status"), F.lit("t").alias("text"))).alias("line"))
    head = spark.createDataFrame([('{"format":"json-pages-1.0","id":"pages"}',), ("{broken",)], "line string")
    sinks.write_lines(head.unionByName(pages), "line", path)
    return text_files.without_text(text_files.page_list(spark, path)).select("url", "status")
