"""SQL twins of the queries of the general data problems."""

_P2_CELLS = """
rows AS (SELECT * FROM metadata_export WHERE trim(entity_type) <> ''),
cells AS (
  SELECT feed, load_id, 'dc_date' AS column_name, dc_date AS v FROM rows
  UNION ALL SELECT feed, load_id, 'dc_format', dc_format FROM rows
  UNION ALL SELECT feed, load_id, 'entity_title', entity_title FROM rows
  UNION ALL SELECT feed, load_id, 'dc_description', dc_description FROM rows),
kept AS (SELECT feed, load_id, column_name, CASE WHEN trim(v) <> '' THEN v END AS v FROM cells),
judged AS (
  SELECT *,
    CASE WHEN v IS NULL THEN NULL
      WHEN column_name = 'dc_date' THEN regexp_full_match(v, '[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?') AND
        try_cast(CASE length(v) WHEN 4 THEN v || '-01-01' WHEN 7 THEN v || '-01' ELSE v END AS DATE) IS NOT NULL AND v[1:4] <> '0000'
      WHEN column_name = 'dc_format' THEN regexp_full_match(v, '[a-z]+/[a-z0-9][a-z0-9.+-]*') END AS fits
  FROM kept),
measured AS (
  SELECT *, CASE WHEN column_name = 'dc_date' AND fits THEN CAST(v[1:4] AS BIGINT)
    WHEN column_name IN ('entity_title', 'dc_description') AND v IS NOT NULL THEN CAST(length(v) AS BIGINT) END AS m
  FROM judged),
"""


def _profiles(keys: str) -> str:
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    return f"""
tops AS (
  SELECT {keys}, column_name, max(n) AS n_top, CAST(count(*) AS BIGINT) AS n_distinct, arg_min(v, (-n, v)) AS top_value, sum(n * log2(n)) AS nlogn
  FROM (SELECT {keys}, column_name, v, count(*) AS n FROM measured WHERE v IS NOT NULL GROUP BY ALL) GROUP BY ALL),
sums AS (
  SELECT {keys}, column_name, count(*) AS n_rows, count(*) - count(v) AS n_missing, count(v) AS n_filled,
    CASE WHEN count(fits) > 0 THEN CAST(count(*) FILTER (NOT fits) AS BIGINT) END AS n_broken, min(v) AS min_value, max(v) AS max_value, median(m) AS middle
  FROM measured GROUP BY ALL),
profiles AS (
  SELECT a.*, coalesce(b.n_distinct, 0) AS n_distinct, coalesce(b.n_top, 0) AS n_top, b.top_value, b.nlogn
  FROM sums a LEFT JOIN tops b ON {on} AND a.column_name = b.column_name)
"""


P2_PROFILE = f"""
WITH {_P2_CELLS} {_profiles("feed, load_id")}
SELECT feed, load_id, column_name, n_rows, n_missing, n_filled, n_distinct, n_broken, n_top, top_value, min_value, max_value,
  CASE WHEN n_filled > 0 THEN round(greatest(0, log2(n_filled) - nlogn / n_filled), 6) END AS entropy_bits, middle
FROM profiles
"""

P2_MAINTAINED = f"""
WITH last AS (SELECT max(record_id) AS record_id FROM metadata_export WHERE trim(entity_type) <> '' GROUP BY feed, asset_id, content_ord),
{_P2_CELLS.replace("FROM metadata_export", "FROM metadata_export SEMI JOIN last USING (record_id)")} {_profiles("feed")}
SELECT feed, column_name, n_rows, n_missing, n_filled, n_distinct, n_broken, n_top, top_value, min_value, max_value,
  CASE WHEN n_filled > 0 THEN round(greatest(0, log2(n_filled) - nlogn / n_filled), 6) END AS entropy_bits, middle
FROM profiles
"""

P2_FOUND = f"""
WITH {_P2_CELLS} {_profiles("feed, load_id")},
rates AS (
  SELECT feed, load_id, column_name, n_missing / n_rows AS null_rate, CASE WHEN n_filled > 0 THEN n_broken / n_filled END AS pattern_rate,
    CASE WHEN n_filled > 0 THEN n_distinct / n_filled END AS distinct_rate, CASE WHEN n_filled > 0 THEN n_top / n_filled END AS top_share, middle
  FROM profiles),
pairs AS (
  SELECT *, lag(null_rate) OVER w AS p_null, lag(pattern_rate) OVER w AS p_pattern, lag(distinct_rate) OVER w AS p_distinct,
    lag(top_share) OVER w AS p_top, lag(middle) OVER w AS p_middle
  FROM rates WINDOW w AS (PARTITION BY feed, column_name ORDER BY load_id))
SELECT load_id, column_name, 'null_rate' AS finding FROM pairs WHERE abs(null_rate - p_null) >= 0.2 - 1e-9
UNION ALL SELECT load_id, column_name, 'pattern_rate' FROM pairs WHERE column_name IN ('dc_date', 'dc_format') AND abs(pattern_rate - p_pattern) >= 0.2 - 1e-9
UNION ALL SELECT load_id, column_name, 'distinct_rate' FROM pairs WHERE column_name IN ('entity_title', 'dc_description') AND abs(distinct_rate - p_distinct) >= 0.3 - 1e-9
UNION ALL SELECT load_id, column_name, 'top_share' FROM pairs WHERE abs(top_share - p_top) >= 0.33 - 1e-9
UNION ALL SELECT load_id, column_name, 'middle' FROM pairs WHERE
  (column_name = 'dc_date' AND abs(middle - p_middle) >= 12 - 1e-9) OR
  (column_name IN ('entity_title', 'dc_description') AND greatest(middle, p_middle) >= 1.6 * least(middle, p_middle) - 1e-9)
"""

_P3_TYPED = r"""
known AS (SELECT *, regexp_replace(lower(rulebase_class), '[^\p{L}\p{N}]', '', 'g') AS k FROM classifier_class),
terms AS (
  SELECT lower(regexp_replace(regexp_replace(document, '^\s+|\s+$', '', 'g'), '^.*[/\\]', '')) AS document, c.rulebase_class, c.value_type, c.multi_valued,
    regexp_replace(s.term, '^\s+|\s+$', '', 'g') AS t
  FROM classifier_score s JOIN known c ON regexp_replace(lower(s.rulebase_class), '[^\p{L}\p{N}]', '', 'g') = c.k),
typed AS (
  SELECT *, regexp_replace(t, '[£$€ ]', '', 'g') AS amount,
    CASE value_type
      WHEN 'whole number' THEN CASE WHEN regexp_full_match(t, '[+-]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.0+)?') THEN CAST(CAST(try_cast(replace(t, ',', '') AS DECIMAL(28, 6)) AS BIGINT) AS VARCHAR) END
      WHEN 'decimal number' THEN CASE WHEN regexp_full_match(regexp_replace(t, '[£$€ ]', '', 'g'), '[+-]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]+)?')
        THEN CAST(try_cast(replace(regexp_replace(t, '[£$€ ]', '', 'g'), ',', '') AS DECIMAL(28, 6)) AS VARCHAR) END
      WHEN 'date' THEN CAST(CASE
        WHEN regexp_matches(t, '^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9:.]+Z?)?$') THEN try_cast(t[1:10] AS DATE)
        WHEN regexp_full_match(t, '[0-9]{8}') THEN CAST(try_strptime(t, '%Y%m%d') AS DATE)
        WHEN regexp_full_match(t, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}') THEN CAST(try_strptime(t, '%d/%m/%Y') AS DATE)
        WHEN regexp_full_match(t, '[0-9]{1,2} [A-Za-z]+ [0-9]{4}') THEN CAST(try_strptime(t, '%d %B %Y') AS DATE) END AS VARCHAR)
      WHEN 'yes/no' THEN CASE WHEN lower(t) IN ('yes', 'y', 'true', 't', '1') THEN 'true' WHEN lower(t) IN ('no', 'n', 'false', 'f', '0') THEN 'false' END
      ELSE regexp_replace(lower(t), '\s+', ' ', 'g') END AS value
  FROM terms WHERE t <> '' AND document <> '')
"""

P3_FOUND = f"""
WITH {_P3_TYPED},
cells AS (SELECT document, rulebase_class, count(DISTINCT value) AS n FROM typed WHERE NOT multi_valued GROUP BY ALL)
SELECT document, rulebase_class, CASE WHEN n = 0 THEN 'unreadable' ELSE 'conflict' END AS issue FROM cells WHERE n <> 1
"""

P4_FOUND = r"""
WITH e AS (
  SELECT DISTINCT lower(regexp_replace(asset_id, '^\s+|\s+$', '', 'g')) AS asset_id, content_ord,
    nullif(lower(regexp_replace(md5_checksum, '^\s+|\s+$', '', 'g')), '') AS m, nullif(lower(regexp_replace(sha256_checksum, '^\s+|\s+$', '', 'g')), '') AS s,
    nullif(nfc_normalize(regexp_replace(filename, '^\s+|\s+$', '', 'g')), '') AS f
  FROM metadata_export WHERE content_ord IS NOT NULL),
x AS (
  SELECT DISTINCT regexp_replace(lower(regexp_replace(asset_id, '^\s+|\s+$', '', 'g')), '\.[^.]*$', '') AS asset_id, content_ord,
    nullif(lower(regexp_replace(md5_checksum, '^\s+|\s+$', '', 'g')), '') AS m, nullif(lower(regexp_replace(sha256_checksum, '^\s+|\s+$', '', 'g')), '') AS s,
    nullif(nfc_normalize(regexp_replace(filename, '^\s+|\s+$', '', 'g')), '') AS f
  FROM metadata_mirror WHERE content_ord IS NOT NULL),
p AS (SELECT e.*, x.m AS xm, x.s AS xs, x.f AS xf FROM e JOIN x USING (asset_id, content_ord))
SELECT asset_id, content_ord, 'only_export' AS difference FROM e ANTI JOIN x USING (asset_id, content_ord)
UNION ALL SELECT asset_id, content_ord, 'only_mirror' FROM x ANTI JOIN e USING (asset_id, content_ord)
UNION ALL SELECT asset_id, content_ord, 'md5_checksum' FROM p WHERE m IS DISTINCT FROM xm
UNION ALL SELECT asset_id, content_ord, 'sha256_checksum' FROM p WHERE s IS DISTINCT FROM xs
UNION ALL SELECT asset_id, content_ord, 'filename' FROM p WHERE f IS DISTINCT FROM xf
"""

ORACLE = {"p2_profile": P2_PROFILE, "p2_maintained": P2_MAINTAINED, "p2_found": P2_FOUND, "p3_found": P3_FOUND, "p4_found": P4_FOUND}

_P3_COLUMNS = {
    "Closed_Record": "BOOLEAN", "Document_Language": "", "Fee_Amount": "DECIMAL(28, 6)", "Issue_Date": "DATE", "Page_Count": "BIGINT", "Record_Office": "", "Volume_No": "BIGINT",
}


def _p3_cell(name: str, kind: str) -> str:
    shown = f"CAST(max(value) FILTER (rulebase_class = '{name}') AS {kind})" if kind else f"max(shown) FILTER (rulebase_class = '{name}')"
    return f"CASE WHEN count(value) FILTER (rulebase_class = '{name}') = 1 THEN {shown} END AS {name}"


P3_WIDE = f"""
WITH {_P3_TYPED},
cells AS (SELECT document, rulebase_class, multi_valued, value, min(t) AS shown FROM typed GROUP BY ALL),
issues AS (SELECT document, count(*) AS n FROM (SELECT document, rulebase_class FROM cells WHERE NOT multi_valued GROUP BY ALL HAVING count(value) <> 1) GROUP BY ALL)
SELECT c.document, {", ".join(_p3_cell(n, k) for n, k in _P3_COLUMNS.items())},
  list(shown ORDER BY shown) FILTER (rulebase_class = 'Generic_UPWARD') AS "Generic_UPWARD", list(shown ORDER BY shown) FILTER (rulebase_class = 'Geography_UPWARD') AS "Geography_UPWARD",
  CAST(coalesce(any_value(i.n), 0) AS INT) AS n_issues
FROM cells c LEFT JOIN issues i ON c.document = i.document GROUP BY c.document
"""

ORACLE |= {"p3_wide": P3_WIDE}
