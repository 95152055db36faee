"""XML sources: sitemaps, item lists, metadata fragments."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.functions.text import strip


def sitemap_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of sitemaps and sitemap indexes: sitemap, kind (url or sitemap), loc."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace(F.input_file_name(), r"^.*/", "").alias("sitemap"), "value")
    body = F.regexp_replace("value", r"(?s)<!--.*?-->", "")

    def entries(kind: str) -> Column:
        locs = F.regexp_extract_all(body, F.lit(rf"(?s)<(?:\w+:)?{kind}\b[^>]*>\s*<(?:\w+:)?\w+[^>]*>\s*([^<]*?)\s*</"), F.lit(1))
        return F.transform(locs, lambda loc: F.struct(F.lit(kind).alias("kind"), loc.alias("loc")))

    kinds = F.array(entries("url"), entries("sitemap"))
    return text.select("sitemap", F.explode(F.flatten(kinds)).alias("e")).select("sitemap", "e.kind", F.replace("e.loc", F.lit("&amp;"), F.lit("&")).alias("loc")).where("loc <> ''")


def xml_items(spark: SparkSession, path: str, tag: str, first_item_fields: Sequence[str] | None = None) -> DataFrame:
    """One row per item element. The columns are all tags of all items, sorted (S20), or just those given."""
    rows = spark.read.format("xml").option("rowTag", tag).option("inferSchema", "false").load(path)
    names = sorted(rows.columns) if first_item_fields is None else [c for c in first_item_fields if c in rows.columns]
    return rows.select(*[F.col(f"`{c}`") for c in names])


def dc_values(xml: Column, elements: Sequence[str]) -> Column:
    """Map of the given elements, by local name, to their filled texts in order, entities and character references resolved."""

    @F.pandas_udf("array<string>")
    def resolved(values: pd.Series) -> pd.Series:
        import re

        named = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}

        def one(m):
            n = m.group(1)
            if n[0] != "#":
                return named[n]
            code = int(n[2:], 16) if n[1] == "x" else int(n[1:])
            return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else m.group()

        ref = re.compile("&(#x[0-9A-Fa-f]{1,8}|#[0-9]{1,8}|amp|lt|gt|quot|apos);")
        return values.map(lambda vs: None if vs is None else [ref.sub(one, v) if "&" in v else v for v in vs])

    pairs = [
        F.struct(
            F.lit(e).alias("k"),
            F.filter(F.transform(resolved(F.regexp_extract_all(xml, F.lit(rf"(?s)<(?:\w+:)?{e}(?:\s[^>]*)?>([^<]*)</"), F.lit(1))), lambda v: strip(v)), lambda v: v != "").alias("v"),
        )
        for e in elements
    ]
    return F.map_from_entries(F.array(*pairs))


def flatten_fragment(xml: Column) -> Column:
    """Map of a fragment's fields, by local name, to text.

    A leaf gives its text, a container the joined texts below it; leaves inside containers come up unless their name
    was filled before. Unreadable XML gives an empty map. Runs in Python, one Arrow batch at a time.
    """

    @F.pandas_udf("map<string,string>")
    def run(fragments: pd.Series) -> pd.Series:
        from xml.etree import ElementTree

        def flat(fragment):
            if fragment is None:
                return None
            try:
                root = ElementTree.fromstring(fragment)
            except ElementTree.ParseError:
                return {}
            name = lambda e: e.tag.rsplit("}", 1)[-1]
            out: dict[str, str] = {}
            for child in root:
                parts = [t.strip() for t in child.itertext() if t.strip()]
                if parts and not out.get(name(child)):
                    out[name(child)] = " ".join(parts)
            for child in root:
                for leaf in child.iter():
                    if leaf is not child and not len(leaf) and (leaf.text or "").strip() and not out.get(name(leaf)):
                        out[name(leaf)] = leaf.text.strip()
            return out

        return fragments.map(flat)

    return run(xml)
