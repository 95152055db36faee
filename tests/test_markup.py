import pytest

from archivolt.plans import registry
from archivolt.sources import xml_files
from archivolt.session import table

CELLS = ["<Text>", " Text", "Text\u00a0", "R&D", "a &amp; b", "&lt;", "1 < 2 > 0", "</td></tr>", "</title>", "plain", "\u00a0", " ", "", None, '"q" \'a\'']


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("made"))
    rows = [(i, c, c, c, c) for i, c in enumerate(CELLS)]
    spark.createDataFrame(rows, "record_id long, entity_title string, dc_title string, dc_date string, dc_type string").write.parquet(f"{d}/metadata_export.parquet")
    return d


def test_table_cells_with_markup_and_padding(spark, made):
    got = [r[0] for r in registry.QUERIES["html_table_column"](spark, made).collect()]
    assert sorted(got) == sorted({c.strip() for c in CELLS if c is not None} - {""})


def test_page_titles_with_markup(spark, made):
    got = {r.record_id: (r.title, r.has_link, r.has_secure, r.links) for r in registry.QUERIES["html_predicates"](spark, made).collect()}
    assert got == {i: ((c or "").strip(" ") or None, True, False, [f"/a/{i}"]) for i, c in enumerate(CELLS)}


def test_fragment_values_with_markup(spark, made):
    got = {r.record_id: (r.titles, r.dates) for r in registry.QUERIES["xml_fields"](spark, made).collect()}
    values = lambda c: [c.strip()] if c and c.strip() else []
    assert got == {i: (values(c), values(c)) for i, c in enumerate(CELLS)}


def test_references_in_fragments(spark):
    xml = "<a><dc:title>&#233;&#xE9; &amp;lt; &#99999999; &unknown;</dc:title><dc:title>&quot;x&apos;</dc:title></a>"
    got = spark.createDataFrame([(xml,), (None,)], "x string").select(xml_files.dc_values("x", ["title"])["title"]).collect()
    assert [r[0] for r in got] == [["éé &lt; &#99999999; &unknown;", "\"x'"], None]


def test_all_rows_are_read(spark, sf):
    cells = {r[0].strip() for r in table(spark, sf, "metadata_export").select("dc_type").collect() if r[0] is not None} - {""}
    assert {r[0] for r in registry.QUERIES["html_table_column"](spark, sf).collect()} == cells
    assert any("<" in c for c in cells)
