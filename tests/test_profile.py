import math
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from archivolt.operators import profile as P

RULES = {"d": P.PARTIAL_DATE, "f": P.MEDIA_TYPE, "t": P.TEXT}
ROWS = [
    (1, "1980", "text/html", "abc"), (1, "1980-02-30", "PDF", "abc"), (1, "1991-12", None, ""), (1, None, "text/html", "x" * 20_000), (1, " ", " ", None),
    (2, "2001-01-01", "a/b", "z"), (2, "0000", "a/", "é\U0001f600"),
]
SCHEMA = "k int, d string, f string, t string"


def profiles(df, keys=("k",)):
    counts = P.value_counts(df, keys, RULES)
    return {(r.k, r.column_name): r for r in P.profile(counts, keys, RULES).collect()}


def test_metrics(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("value", F.lit("clash")).withColumn("n", F.lit(7))
    out = profiles(df)
    d = out[(1, "d")]
    assert (d.n_rows, d.n_missing, d.n_filled, d.n_distinct, d.n_broken, d.n_top, d.middle) == (5, 2, 3, 3, 1, 1, 1985.5)
    f = out[(1, "f")]
    assert (f.n_missing, f.n_distinct, f.n_broken, f.n_top, f.top_value, f.middle) == (2, 2, 1, 2, "text/html", None)
    t = out[(1, "t")]
    assert (t.n_missing, t.n_broken, t.middle, t.min_value) == (2, None, 3.0, "abc")
    assert t.entropy_bits == pytest.approx(-(2 / 3 * math.log2(2 / 3) + 1 / 3 * math.log2(1 / 3)))
    assert out[(2, "t")].middle == 1.5 and out[(2, "d")].n_broken == 1 and out[(2, "f")].n_broken == 1


def test_median_and_entropy_against_brute_force(spark):
    words = [("w" * (i * 37 % 11 + 1)) + str(i % 3) for i in range(501)]
    out = profiles(spark.createDataFrame([(1, None, None, w) for w in words], SCHEMA))[(1, "t")]
    n = Counter(words)
    assert out.middle == median(map(len, words))
    assert out.entropy_bits == pytest.approx(-sum(c / 501 * math.log2(c / 501) for c in n.values()))
    assert out.n_distinct == len(n) and out.n_top == max(n.values())


def test_deltas_equal_recounting(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    first, second = df.where("k = 1"), df.where("k = 2")
    store = P.ValueCountStore(spark, str(tmp_path / "counts"))
    assert store.read() is None
    store.apply(P.value_counts(first, ["k"], RULES))
    store.apply(P.value_counts(second, ["k"], RULES), P.value_counts(first, ["k"], RULES, sign=-1))
    rows = lambda df: {(r.k, r.column_name, r.value, r.n) for r in df.collect()}
    assert rows(store.read()) == rows(P.value_counts(second, ["k"], RULES)) and store.version() == 2


def test_many_deltas_are_compacted(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    store = P.ValueCountStore(spark, str(tmp_path / "counts"))
    store.MOST_DELTAS = 3
    for _ in range(5):
        store.apply(P.value_counts(df, ["k"], RULES))
        store.apply(P.value_counts(df, ["k"], RULES, sign=-1))
    store.apply(P.value_counts(df, ["k"], RULES))
    want = sorted(map(repr, ((r.k, r.column_name, r.value, r.n) for r in P.value_counts(df, ["k"], RULES).collect())))
    again = P.ValueCountStore(spark, str(tmp_path / "counts"))
    assert sorted(map(repr, ((r.k, r.column_name, r.value, r.n) for r in again.read().collect()))) == want
    assert len(list((tmp_path / "counts").iterdir())) <= 4


def test_empty_delta(spark, tmp_path):
    store = P.ValueCountStore(spark, str(tmp_path / "counts"))
    assert store.apply(P.value_counts(spark.createDataFrame([], SCHEMA), ["k"], RULES)).count() == 0


def test_empty_table(spark):
    assert profiles(spark.createDataFrame([], SCHEMA)) == {}


def loads(spark, *columns):
    rows = [("a", i, None, None, t) for i, ts in enumerate(columns) for t in ts]
    df = spark.createDataFrame(rows, "feed string, load_id int, d string, f string, t string")
    counts = P.value_counts(df, ["feed", "load_id"], RULES)
    out = P.breaks(P.profile(counts, ["feed", "load_id"], RULES), "feed", "load_id", {"t": 0.2}, {"d": 0.2}, {"t": 0.3}, {"t": 0.33}, {"d": 12}, {"t": 1.6})
    return {(r.load_id, r.finding) for r in out.collect()}


def test_limits_are_inclusive(spark):
    assert loads(spark, ["a"] * 9 + [None], ["a"] * 7 + [None] * 3) == {(1, "null_rate")}
    assert loads(spark, ["aaaaa"] * 3, ["aaaaaaaa"] * 3) == {(1, "middle")}
    assert loads(spark, ["aaaaa"] * 3, ["aaaaaaa"] * 3) == set()
    assert loads(spark, [None], ["a"]) == {(1, "null_rate")}
