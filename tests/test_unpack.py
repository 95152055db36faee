import re

from hypothesis import given, settings
from hypothesis import strategies as st

from archivolt.operators.unpack import PackedParser, unpack_values

TERMS = ["Capital, working", "Yield/return ratios", "Expenditure; capital", "Plain"]
P, NO_SLASH = PackedParser(TERMS), PackedParser(TERMS, slash=False)


def values(cell, parser=P):
    return [v for v, _ in parser.parse(cell)]


def test_separators_by_strength():
    assert values("a; b|c\td\ne") == ["a", "b", "c", "d", "e"]
    assert values("a, b; c") == ["a, b", "c"]
    assert values("a, b/c") == ["a", "b/c"]
    assert values("a/b") == ["a", "b"]
    assert values("a/b", NO_SLASH) == ["a/b"]
    assert values("a,, b,") == ["a", "b"]
    assert values("a; | b;") == ["a", "b"]


def test_protected_values():
    assert values('"a; b"; c') == ["a; b", "c"]
    assert values('"say ""x, y""", z') == ['say "x, y"', "z"]
    assert values("Capital, working") == ["Capital, working"]
    assert values("Fees, Capital, working, capital, WORKING") == ["Fees", "Capital, working", "capital, WORKING"]
    assert values("Yield/return ratios/Fees") == ["Yield/return ratios", "Fees"]
    assert values("Expenditure; capital") == ["Expenditure; capital"]
    assert values(r"x\; y; z") == ["x; y", "z"]
    assert values('["a, b", "c \\"d\\""]') == ["a, b", 'c "d"']


def test_urls():
    assert values("https://h/i?at=4,5, x", NO_SLASH) == ["https://h/i?at=4,5", "x"]
    assert values("https://h/i?view=p;seq=2; x") == ["https://h/i?view=p;seq=2", "x"]
    assert values("https://h/1;https://h/2") == ["https://h/1", "https://h/2"]
    assert values("https://h/a/b") == ["https://h/a/b"]


def test_malformed_quotes_backtrack():
    assert P.parse('"a; b') == [('"a', "malformed_quote"), ("b", "")]
    assert P.parse('"a" x; b') == [('"a" x', "malformed_quote"), ("b", "")]
    assert P.parse('5" reel; b') == [('5" reel', ""), ("b", "")]


def test_blank_and_long():
    assert P.parse(None) == P.parse("") == P.parse(" \n") == P.parse(" ; , ") [:0]
    assert values("x;" * 50_000) == ["x"] * 50_000
    assert values('"' * 99_999)
    assert values("[" * 9_999)


@given(st.lists(st.text(alphabet='ab ;,"|/', max_size=8), max_size=6))
@settings(max_examples=300, deadline=None)
def test_quoted_lists_round_trip(items):
    cell = "; ".join('"' + x.replace('"', '""') + '"' for x in items)
    assert values(cell) == [x.strip() for x in items if x.strip()]


@given(st.text(alphabet='ab;,"|/[]\\ \n', max_size=40))
@settings(max_examples=300, deadline=None)
def test_never_crashes_nor_loses_letters(cell):
    found = "".join(values(cell))
    assert re.sub(r"[^ab]", "", cell) == re.sub(r"[^ab]", "", found)


def test_rows(spark):
    rows = [(1, "a; b; a", None, "x"), (2, " ", "u, v", "x"), (3, "solo", "", "x"), (1, "a; b; a", None, "x")]
    df = spark.createDataFrame(rows, "record_id long, s string, r string, field_name string")
    out = sorted(tuple(r) for r in unpack_values(df, "record_id", ["s", "r"]).collect())
    one = [(1, "s", 1, "a", ""), (1, "s", 2, "b", ""), (1, "s", 3, "a", "")]
    assert out == sorted(one * 2 + [(2, "r", 1, "u", ""), (2, "r", 2, "v", ""), (3, "s", 1, "solo", "")])
    assert unpack_values(df.limit(0), "record_id", ["s", "r"]).count() == 0
