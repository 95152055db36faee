"""SQL twins of the text queries: brute force over all pairs of distinct values and labels of a field."""

_TOKENS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}\p{{M}}]+[.]?')"
_SWAPS = "list_transform(range(1, length({0})), lambda i: {0}[1:i - 1] || {0}[i + 1:i + 1] || {0}[i:i] || {0}[i + 2:])"

P5_FOUND = rf"""
WITH cells AS (
  SELECT record_id, 'icaew_content_type' AS field_name, icaew_content_type AS cell FROM metadata_export
  UNION ALL SELECT record_id, 'dc_type', dc_type FROM metadata_export UNION ALL SELECT record_id, 'dc_language', dc_language FROM metadata_export),
typed AS (SELECT * FROM cells c WHERE trim(cell) <> '' AND NOT EXISTS (SELECT 1 FROM vocabulary v WHERE v.field_name = c.field_name AND v.term = c.cell)),
labels AS (
  SELECT DISTINCT field_name, term_id, words, list_aggregate(words, 'string_agg', ' ') AS label
  FROM (SELECT field_name, term_id, list_transform({_TOKENS.format('label')}, lambda w: rtrim(w, '.')) AS words
    FROM (SELECT field_name, term_id, unnest(list_prepend(term, coalesce(alt_labels, []))) AS label FROM vocabulary))),
texts AS (
  SELECT field_name, cell, list_transform(tokens, lambda w: rtrim(w, '.')) AS words, list_transform(tokens, lambda w: w LIKE '%.') AS dotted, len(tokens) AS m
  FROM (SELECT field_name, cell, {_TOKENS.format('cell')} AS tokens FROM (SELECT DISTINCT field_name, cell FROM typed))),
pairs AS (
  SELECT v.*, l.term_id, l.label, l.words AS label_words, list_aggregate(v.words, 'string_agg', ' ') AS plain,
    CASE WHEN length(label) < 4 THEN 0 WHEN length(label) < 8 THEN 1 ELSE 2 END AS ops
  FROM texts v JOIN labels l ON v.field_name = l.field_name WHERE m > 0),
readings AS (
  SELECT *, list_aggregate(list_concat(words, words)[s + 1:s + l], 'string_agg', ' ') AS reading, list_concat(dotted, dotted)[s + 1:s + l] AS d, list_concat(words, words)[s + 1:s + l] AS w, m - l AS extra
  FROM (SELECT *, unnest(range(1, m + 1)) AS l FROM (SELECT *, unnest(range(0, m)) AS s FROM pairs)) WHERE (l = m OR s + l <= m) AND m - l <= 3),
judged AS (
  SELECT *, levenshtein(reading, label) AS lev,
    extra = 0 AND list_contains(d, true) AND len(w) = len(label_words) AND len(list_filter(list_zip(w, d, label_words), lambda x: NOT CASE WHEN x[2] THEN starts_with(x[3], x[1]) ELSE x[1] = x[3] END)) = 0 AS cut_off,
    least(lev, 1 + list_min(list_transform({_SWAPS.format('reading')}, lambda x: levenshtein(x, label))), CASE WHEN list_has_any({_SWAPS.format('reading')}, {_SWAPS.format('label')}) THEN 2 END) AS n_ops
  FROM readings),
costed AS (
  SELECT *, CASE WHEN plain = label THEN 0 ELSE least(CASE WHEN cut_off THEN 1 ELSE 9 END, n_ops + CASE WHEN extra > 0 OR s > 0 THEN 1 ELSE 0 END) END AS cost
  FROM judged WHERE plain = label OR cut_off OR n_ops <= CASE WHEN extra > 0 THEN least(ops, 1) ELSE ops END),
best AS (
  SELECT field_name, cell, arg_min(term_id, (CASE WHEN plain = label THEN 0 ELSE 1 END, cost, CASE WHEN cut_off THEN 0 ELSE lev END, extra, term_id)) AS term_id FROM costed GROUP BY ALL)
SELECT record_id, t.field_name, coalesce(b.term_id, 0) AS term_id FROM typed t LEFT JOIN best b ON t.field_name = b.field_name AND t.cell = b.cell
"""

ORACLE = {"p5_found": P5_FOUND}
