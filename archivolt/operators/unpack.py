"""Splitting cells that pack several values.

The grammar, in order of preference at every place (a parsing expression grammar):

    cell   <- array / piece (separator piece)*
    array  <- '[' (quoted (',' quoted)*)? ']' end
    piece  <- quoted &stop / term &stop / url &stop / bare
    quoted <- '"' ('""' / escape / [^"\\\\])* '"'
    term   <- a known term that holds separator characters, longest first
    url    <- 'http' 's'? '://' characters; ';' before name=, ',' between digits belong to it
    bare   <- (escape / [^separator])*
    stop   <- blanks (separator / end)

The strongest separator that stands between pieces cuts the cell: semicolon, bar, tab and line break before comma,
comma before slash. Pieces between two cuts are one value; a weaker separator among them is text. A quote that isn't
closed before a stop fails its alternative; the parser goes back to the start of the piece, reads it as bare text and
flags it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.functions.text import filled, strip

STRONG, COMMA, SLASH = ";|\n\t", ",", "/"
#: Characters that mean something in a packed cell; a cell without any is one plain value.
SPECIAL = r'[;|,/"\\\[\n\t]'

_QUOTED = r'"(?:[^"\\]|""|\\.)*+"'
_ESCAPE = re.compile(r'\\([;|,/"\\\[\]])')
_INNER = re.compile(r'""|\\([;|,/"\\\[\]])')
_ARRAY = re.compile(rf"\s*\[\s*(?:{_QUOTED}\s*(?:,\s*{_QUOTED}\s*)*)?\]\s*\Z", re.S)
_QUOTED_RE = re.compile(_QUOTED, re.S)


class PackedParser:
    """Parser of packed cells for one list of known terms."""

    def __init__(self, terms: Iterable[str] = (), slash: bool = True):
        self.levels = [set(STRONG), set(COMMA), set(SLASH)][: 3 if slash else 2]
        s = re.escape("".join((STRONG, COMMA, SLASH)[: 3 if slash else 2]))
        guarded = sorted({t for t in terms if t and re.search(r"[;|,/\n\t]", t)}, key=lambda t: (-len(t), t))
        stop = rf"(?=[^\S\n\t]*(?:[{s}]|\Z))"
        url = rf'https?://(?:\\.|;(?=[A-Za-z_]\w*=)|(?<=[0-9]),(?=[0-9])|/|(?![{s}])[^\s\\"])++'
        parts = [rf"(?P<quoted>{_QUOTED}){stop}"]
        if guarded:
            parts.append(rf"(?P<term>(?i:{'|'.join(r'[^\S\n\t]+'.join(map(re.escape, t.split())) for t in guarded)})){stop}")
        parts += [rf"(?P<url>{url}){stop}", rf"(?P<bare>(?:\\.|(?![{s}]).)*+)"]
        self.piece = re.compile(r"[^\S\n\t]*(?:" + "|".join(parts) + r")[^\S\n\t]*", re.S)

    def parse(self, cell: str | None) -> list[tuple[str, str]]:
        """(value, error) of each value in order; error is '' or 'malformed_quote'. None and blank give none."""
        if cell is None or not cell.strip():
            return []
        if _ARRAY.match(cell):
            return [(v, "") for m in _QUOTED_RE.finditer(cell) if (v := self._inner(m.group()))]
        pieces, at, end = [], 0, len(cell)
        while True:
            m = self.piece.match(cell, at)
            pieces.append(m)
            if (at := m.end() + 1) > end:
                break
        between = {cell[m.end()] for m in pieces[:-1]}
        cuts = next((level for level in self.levels if level & between), set())
        out, first = [], 0
        for i, m in enumerate(pieces):
            if i == len(pieces) - 1 or cell[m.end()] in cuts:
                value, error = self._value(cell, pieces[first : i + 1])
                if value:
                    out.append((value, error))
                first = i + 1
        return out

    def _value(self, cell: str, pieces: list[re.Match]) -> tuple[str, str]:
        m = pieces[0]
        if len(pieces) == 1 and m.lastgroup == "quoted":
            return self._inner(m.group("quoted")), ""
        text = cell[m.start() : pieces[-1].end()].strip()
        error = "malformed_quote" if any(p.lastgroup == "bare" and p.group("bare").startswith('"') for p in pieces) else ""
        return (_ESCAPE.sub(r"\1", text) if "\\" in text else text).strip(), error

    @staticmethod
    def _inner(quoted: str) -> str:
        return _INNER.sub(lambda m: m.group(1) or '"', quoted[1:-1]).strip()


PARSED = T.ArrayType(T.StructType([T.StructField("value", T.StringType()), T.StructField("error", T.StringType())]))


def parse_packed(cell: Column, terms: Sequence[str], slash: bool) -> Column:
    """Array of (value, error) parsed from ``cell``; the Python parser only sees cells with a special character."""
    made: dict[str, PackedParser] = {}

    @F.pandas_udf(PARSED)
    def run(cells: pd.Series) -> pd.Series:
        parser = made.get("parser") or made.setdefault("parser", PackedParser(terms, slash))
        return cells.map(lambda c: None if c is None else [{"value": v, "error": e} for v, e in parser.parse(c)])

    hard = cell.rlike(SPECIAL)
    plain = F.array(F.struct(strip(cell).alias("value"), F.lit("").alias("error")))
    return F.when(hard, run(F.when(hard, cell))).otherwise(plain)


#: Known terms are sent to every task, so their number must have a bound.
MOST_TERMS = 100_000


def known_terms(df: DataFrame, column: str, most: int = MOST_TERMS) -> list[str]:
    """The distinct terms of a reference list that hold a separator character; a longer list than ``most`` is refused."""
    rows = df.where(F.col(column).rlike(r"[;|,/\n\t]")).select(column).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} known terms with separator characters")
    return sorted(r[0] for r in rows)


def unpack_values(df: DataFrame, key: str, fields: Sequence[str], terms: Sequence[str] = (), slash_fields: Sequence[str] = ()) -> DataFrame:
    """One row per packed value: key, field_name, pos (from 1), packed_value, error.

    Empty slots take no position, repeated values stay. Null and blank cells give no row. A slash separates only in
    ``slash_fields``. The error flag is '' or 'malformed_quote'.
    """
    parsed = [
        F.when(filled(F.col(f)), parse_packed(F.col(f), terms, f in slash_fields)).alias(f"_{i}") for i, f in enumerate(fields)
    ]
    holds = F.lit(False)
    for f in fields:
        holds = holds | filled(F.col(f))
    cells = df.where(holds).select(F.col(key).alias("_key"), *parsed).select(
        "_key",
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"_{i}").alias("parsed")) for i, f in enumerate(fields)])).alias("_c"),
    )
    return cells.select("_key", "_c.field_name", F.posexplode("_c.parsed").alias("_p", "_v")).select(
        F.col("_key").alias(key), "field_name", (F.col("_p") + 1).alias("pos"), F.col("_v.value").alias("packed_value"), F.col("_v.error").alias("error")
    )
