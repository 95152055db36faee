import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from archivolt.operators import widen as W

CLASSES = [("Pages", "whole number", False), ("Issue_Date", "date", False), ("Fee", "decimal number", False), ("Closed", "yes/no", False), ("Office", "text", False), ("Topic", "text", True)]
ROWS = [
    ("/x/A.PDF ", "Pages", "007"), ("a.pdf", "pages", " 7 "), ("c:\\y\\a.pdf", "PAGES", "n/a"), ("a.pdf", "Issue-Date", "3 March 1999"), ("a.pdf", "issue date", "03/03/1999"),
    ("a.pdf", "Fee", "£1,200.50"), ("a.pdf", "fee", "1200.500"), ("a.pdf", "Closed", "Y"), ("a.pdf", "Closed", "TRUE"), ("a.pdf", "Office", " York"), ("a.pdf", "Office", "YORK"),
    ("a.pdf", "Topic", "b"), ("a.pdf", "Topic", "a"), ("a.pdf", "Topic", "A"),
    ("b.pdf", "Pages", "1"), ("b.pdf", "Pages", "2"), ("b.pdf", "Issue_Date", "31/02/1999"), ("b.pdf", "Fee", "1.2.3"), ("b.pdf", "Closed", "maybe"), ("b.pdf", "Office", ""), ("b.pdf", "Office", None),
    (None, "Pages", "1"), ("c.pdf", None, "1"), ("c.pdf", "Unknown", "1"), ("d.pdf", "Pages", "12-14"), (" ", "Pages", "3"),
]


def wide(spark, rows=ROWS, classes=CLASSES, make=W.widen):
    df = spark.createDataFrame(rows, "document string, rulebase_class string, term string").withColumn("entity", F.lit("clash")).withColumn("value", F.lit("clash"))
    return make(df, spark.createDataFrame(classes, "rulebase_class string, value_type string, multi_valued boolean"))


def test_wide(spark):
    got = {r.entity: r for r in wide(spark).collect()}
    a = got["a.pdf"]
    assert (a.Pages, a.Issue_Date, a.Fee, a.Closed) == (7, dt.date(1999, 3, 3), Decimal("1200.500000"), True)
    assert a.Office in ("York", "YORK") and a.Topic == ["A", "b"] and a.issues == []
    b = got["b.pdf"]
    assert (b.Pages, b.Issue_Date, b.Fee, b.Closed, b.Office, b.Topic) == (None,) * 6
    assert set(got) == {"a.pdf", "b.pdf", "d.pdf"}


def test_issues(spark):
    got = {(r.document, r.rulebase_class): r.issue for r in wide(spark, make=W.unfillable).collect()}
    assert got == {
        ("b.pdf", "Pages"): "conflict", ("b.pdf", "Issue_Date"): "unreadable", ("b.pdf", "Fee"): "unreadable", ("b.pdf", "Closed"): "unreadable", ("d.pdf", "Pages"): "unreadable",
    }


def test_hot_entity_and_blocks(spark):
    rows = [("hot.pdf", "Topic", f"t{i % 7}") for i in range(3000)] + [(f"d{i}.pdf", "Pages", str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "document string, rulebase_class string, term string")
    attributes = [W.Attribute(*c) for c in CLASSES]
    got = {r.entity: r for r in W.assemble(W.column_files(W.distinct_cells(df, attributes), attributes, block=16), attributes).collect()}
    assert len(got) == 301 and got["hot.pdf"].Topic == [f"t{i}" for i in range(7)]
    assert all(got[f"d{i}.pdf"].Pages == i for i in range(300))


def test_ordinals_are_dense_and_ordered(spark):
    names = spark.createDataFrame([(f"n{i:04d}",) for i in range(500)], "entity string")
    got = sorted((r.ordinal, r.entity) for r in W.with_ordinals(names, "entity").collect())
    assert got == [(i, f"n{i:04d}") for i in range(500)]


def test_empty(spark):
    assert wide(spark, [], CLASSES).count() == 0 == wide(spark, [], CLASSES, W.unfillable).count()
    assert wide(spark, ROWS, [], W.unfillable).count() == 0
    assert wide(spark, ROWS, []).count() == 0
