"""Column expressions on strings, with the missing-value and Unicode rules used all over the engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str.strip`` removes it; Spark's ``trim`` by default only removes blanks.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(col: Column) -> Column:
    """``col`` without white space of any kind at both ends."""
    return F.btrim(col, F.lit(SPACES))


def filled(col: Column) -> Column:
    """True where ``col`` is neither null nor blank; never null."""
    return F.coalesce(F.trim(col) != "", F.lit(False))


def blank_to_null(col: Column) -> Column:
    """``col`` stripped, null where nothing is left."""
    return F.nullif(strip(col), F.lit(""))


def drop_extension(col: Column) -> Column:
    """Text before the last dot; text without a dot stays."""
    return F.regexp_replace(col, r"\.[^.]*$", "")


def extension(col: Column) -> Column:
    """Lower-case extension without its dot, '' where there is none or the only dot leads the name."""
    return F.lower(F.regexp_extract(base_name(col), r"[^.]\.([^.]*)$", 1))


def base_name(col: Column) -> Column:
    """Part after the last slash or backslash."""
    return F.regexp_replace(col, r"^.*[/\\]", "")


def host(url: Column) -> Column:
    """Host with port, '' where the text is no URL."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def is_url(col: Column) -> Column:
    """True for text with a scheme and a non-empty authority."""
    return F.coalesce(col.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]"), F.lit(False))


def or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def first_of(values: Column) -> Column:
    """First element of an array, '' for an empty or null one."""
    return F.coalesce(F.get(values, F.lit(0)), F.lit(""))


def stripped_values(values: Column) -> Column:
    """Elements stripped, blank and null ones removed; an empty array for null."""
    return F.filter(
        F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: strip(or_empty(v))), lambda v: v != ""
    )


def non_ascii(col: Column) -> Column:
    return F.coalesce(col.rlike(r"[^\x00-\x7F]"), F.lit(False))
