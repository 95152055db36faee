"""Mapping free-entered values to the closest entry of a reference list, in SQL only.

Values and labels are compared in a plain form: lower case, words of letters and digits, one blank between them.
What isn't equal in that form goes through a partition-based join. A label that may differ by k operations (a letter
changed, lost, added, or swapped with its neighbour) is cut into k+1 segments, one of which no operation falls
into; a swap across the border of two segments counts for the left one, so a segment is also kept with its first letter
taken from across that border. An equality join on (field, slot, text), in which the slot holds the label's length, the
segment's number and so its place, finds every candidate, and Spark's levenshtein verifies it. Three more ways to write a label are slots
of the same join: a run of the value's words that is the whole label (words added around it), the value's words
in rotated order ("minutes, council"), and words cut off with a full stop, which are prefixes of the label's words at their place. What no label
reaches comes out through an anti-join with term 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from archivolt.session import cut

#: Operations allowed by label length.
OPERATIONS = "CASE WHEN length(plain) < 4 THEN 0 WHEN length(plain) < 8 THEN 1 ELSE 2 END"
#: Words that may stand around a label.
EXTRA_WORDS = 3

_WORDS = r"regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}\\p{{M}}]+[.]?', 0)"

_LABELS = """
SELECT *, {operations} AS ops, length(plain) AS len FROM (
  SELECT DISTINCT field_name, term_id, array_join(words, ' ') AS plain, words FROM (
    SELECT field_name, term_id, transform({words}, w -> rtrim('.', w)) AS words
    FROM (SELECT field_name, term_id, explode(array_compact(concat(array(term), coalesce(alt_labels, array())))) AS label FROM {{vocabulary}})))
WHERE plain <> ''
""".format(operations=OPERATIONS, words=_WORDS.format("label").replace("{", "{{").replace("}", "}}"))

_VALUES = """
SELECT field_name, cell, array_join(words, ' ') AS plain, words, dotted, size(words) AS m FROM (
  SELECT field_name, cell, transform(tokens, w -> rtrim('.', w)) AS words, transform(tokens, w -> w LIKE '%.') AS dotted FROM (
    SELECT field_name, cell, {words} AS tokens FROM (SELECT DISTINCT field_name, cell FROM {{cells}})))
""".format(words=_WORDS.format("cell").replace("{", "{{").replace("}", "}}"))

_SAME = """
SELECT v.field_name, v.cell, l.term_id FROM {values} v JOIN {labels} l ON v.field_name = l.field_name AND v.plain = l.plain
"""

# segment i of ops + 1: the last (len mod (ops + 1)) ones are one character longer
_SEGMENTS = """
SELECT field_name, len, ops, i, p, w, plain, CASE WHEN swapped THEN concat(substring(plain, p - 1, 1), substring(plain, p + 1, w - 1)) ELSE substring(plain, p, w) END AS segment
FROM (SELECT *, explode(CASE WHEN i > 1 THEN array(false, true) ELSE array(false) END) AS swapped FROM (
  SELECT *, 1 + (i - 1) * floor(len / (ops + 1)) + greatest(0, i - 1 - (ops + 1 - len % (ops + 1))) AS p,
    floor(len / (ops + 1)) + CASE WHEN i > ops + 1 - len % (ops + 1) THEN 1 ELSE 0 END AS w
  FROM (SELECT *, explode(sequence(1, ops + 1)) AS i FROM (SELECT DISTINCT field_name, plain, len, ops FROM {labels} WHERE ops > 0))))
"""

# every text of the index: segments, whole labels, prefixes of words
_INDEX = """
SELECT DISTINCT field_name, concat('s', len, '.', i) AS slot, segment AS text, plain FROM {segments}
UNION ALL SELECT DISTINCT field_name, 'whole', plain, plain FROM {labels}
UNION ALL SELECT DISTINCT field_name, concat('w', n, '.', at), substring(word, 1, c), plain FROM (
  SELECT *, explode(sequence(1, length(word))) AS c FROM (SELECT field_name, plain, size(words) AS n, posexplode(words) AS (at, word) FROM {labels}))
"""

_READINGS = """
SELECT field_name, cell, array_join(slice(concat(words, words), s + 1, l), ' ') AS reading, slice(concat(words, words), s + 1, l) AS words,
  slice(concat(dotted, dotted), s + 1, l) AS dotted, s, m - l AS extra
FROM (SELECT *, explode(sequence(0, m - 1)) AS s FROM (
  SELECT *, explode(CASE WHEN m <= widest THEN sequence(1, m) ELSE sequence(1, widest) END) AS l
  FROM (SELECT *, (SELECT coalesce(max(size(words)), 1) FROM {labels}) AS widest FROM {open} WHERE m > 0)))
WHERE (l = m OR s + l <= m) AND m - l <= {extra}
UNION ALL
SELECT field_name, cell, plain, words, dotted, 0, 0 FROM {open} WHERE m > (SELECT coalesce(max(size(words)), 1) FROM {labels})
"""

# the places a segment can stand at: what is shifted before it and after it are operations
_PROBES = """
SELECT field_name, cell, reading, extra, s, words, dotted, concat('s', len, '.', i) AS slot, substring(reading, p + shift, w) AS text
FROM (SELECT *, explode(filter(sequence(-ops, ops), d -> abs(d) + abs(n - len - d) <= ops AND p + d >= 1 AND p + d + w - 1 <= n)) AS shift
  FROM (SELECT r.*, length(r.reading) AS n, g.len, g.ops, g.i, g.p, g.w
    FROM {readings} r JOIN (SELECT DISTINCT field_name, len, ops, i, p, w FROM {segments}) g
      ON r.field_name = g.field_name AND length(r.reading) BETWEEN g.len - g.ops AND g.len + g.ops))
UNION ALL SELECT field_name, cell, reading, extra, s, words, dotted, 'whole', reading FROM {readings} WHERE extra > 0 OR s > 0
UNION ALL SELECT field_name, cell, reading, extra, s, words, dotted, concat('w', size(words), '.', at), word FROM (
  SELECT *, posexplode(words) AS (at, word) FROM {readings} WHERE extra = 0 AND array_contains(dotted, true)) WHERE dotted[at]
"""

_SWAPS = "CASE WHEN length({0}) > 1 THEN transform(sequence(1, length({0}) - 1), i -> concat(substring({0}, 1, i - 1), substring({0}, i + 1, 1), substring({0}, i, 1), substring({0}, i + 2))) ELSE array() END"

# operations: edits alone, or edits after one swap of neighbours, or two swaps (a swap undoes itself, so one on either side)
_CLOSE = """
SELECT c.field_name, c.cell, l.term_id, CASE WHEN cut_off THEN 1 ELSE c.n_ops + CASE WHEN extra > 0 OR s > 0 THEN 1 ELSE 0 END END AS cost, c.edits, c.extra
FROM (SELECT *, CASE WHEN cut_off OR edits <= 1 THEN edits
    ELSE least(edits, 1 + array_min(transform({swaps}, x -> coalesce(nullif(levenshtein(x, plain, ops), -1), 9))), CASE WHEN arrays_overlap({swaps}, {label_swaps}) THEN 2 END) END AS n_ops
  FROM (SELECT *, CASE WHEN cut_off THEN 0 ELSE levenshtein(reading, plain, 2 * ops) END AS edits
    FROM (SELECT DISTINCT p.field_name, p.cell, p.reading, p.extra, p.s, l.plain, l.ops,
        extra = 0 AND array_contains(dotted, true) AND size(p.words) = size(l.words)
          AND forall(transform(p.words, (a, at) -> coalesce(CASE WHEN get(p.dotted, at) THEN startswith(get(l.words, at), a) ELSE a = get(l.words, at) END, false)), x -> x) AS cut_off
      FROM {{probes}} p JOIN {{index}} i ON p.field_name = i.field_name AND p.slot = i.slot AND p.text = i.text
      JOIN {{shapes}} l ON i.field_name = l.field_name AND i.plain = l.plain))
  WHERE edits >= 0) c
JOIN {{labels}} l ON c.field_name = l.field_name AND c.plain = l.plain
WHERE n_ops <= CASE WHEN extra > 0 THEN least(c.ops, 1) ELSE c.ops END OR cut_off
""".format(swaps=_SWAPS.format("reading"), label_swaps=_SWAPS.format("plain"))

_MAPPED = """
SELECT field_name, cell, min(term_id) AS term_id, 'plain' AS way FROM {same} GROUP BY field_name, cell
UNION ALL
SELECT field_name, cell, min_by(term_id, struct(cost, edits, extra, term_id)) AS term_id, 'join' FROM {near} GROUP BY field_name, cell
UNION ALL
SELECT v.field_name, v.cell, CAST(0 AS BIGINT) AS term_id, 'none' FROM {open} v LEFT ANTI JOIN {near} b ON v.field_name = b.field_name AND v.cell = b.cell
"""


def map_values(cells: DataFrame, vocabulary: DataFrame, extra: int = EXTRA_WORDS) -> DataFrame:
    """Term of every distinct (field_name, cell): field_name, cell, term_id (0 where none is close enough), way.

    ``way`` is plain (equal in plain form), join (found by the partition-based join) or none. ``vocabulary`` has field_name,
    term_id, term and alt_labels (array, may be null). Of several close terms the one with the fewest operations wins
    (words around a label, of which one operation may then be left, and a rotation count as one), then the fewest edits, the fewest words around, the smallest
    term_id. Null and blank cells must be taken out before; a cell without any letter or digit maps to 0, as does every cell
    under an empty vocabulary. A cell of many words is only searched for whole labels in it.
    """
    sql = cells.sparkSession.sql
    # both sides hold each text once, however often it was typed; cut, as several branches read them
    labels, values = cut(sql(_LABELS, vocabulary=vocabulary)), cut(sql(_VALUES, cells=cells))
    same = sql(_SAME, values=values, labels=labels)
    still_open = cut(sql("SELECT * FROM {values} v LEFT ANTI JOIN {same} s ON v.field_name = s.field_name AND v.cell = s.cell", values=values, same=same))
    segments = cut(sql(_SEGMENTS, labels=labels))
    readings = sql(_READINGS, open=still_open, labels=labels, extra=extra)
    near = cut(
        sql(
            _CLOSE,
            probes=sql(_PROBES, readings=readings, segments=segments),
            index=sql(_INDEX, segments=segments, labels=labels),
            shapes=sql("SELECT DISTINCT field_name, plain, words, ops FROM {labels}", labels=labels),
            labels=labels,
        )
    )
    return sql(_MAPPED, same=same, near=near, open=still_open)


def map_free_values(df: DataFrame, key: str, fields: Sequence[str], vocabulary: DataFrame) -> DataFrame:
    """One row (key, field_name, term_id) per filled cell of ``fields`` that isn't exactly a term of its field."""
    sql = df.sparkSession.sql
    listed = ", ".join(f"named_struct('field_name', '{f}', 'cell', `{f}`)" for f in fields)
    cells = sql(f"SELECT _key, _c.field_name, _c.cell FROM (SELECT `{key}` AS _key, explode(array({listed})) AS _c FROM {{df}}) WHERE trim(_c.cell) <> ''", df=df)
    typed = sql("SELECT c.* FROM {cells} c LEFT ANTI JOIN {vocabulary} v ON c.field_name = v.field_name AND c.cell = v.term", cells=cells, vocabulary=vocabulary)
    return sql(
        f"SELECT t._key AS `{key}`, t.field_name, m.term_id FROM {{typed}} t JOIN {{mapped}} m ON t.field_name = m.field_name AND t.cell = m.cell",
        typed=typed,
        mapped=map_values(typed, vocabulary),
    )
