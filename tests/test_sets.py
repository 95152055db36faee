from collections import defaultdict

from archivolt.operators import merge, sets


def test_hot_name_is_numbered_in_order(spark):
    rows = [("hot.pdf", i) for i in range(3000)] + [(f"n{i % 7}", 5000 + i) for i in range(50)] + [(None, 9000), (None, 9001)]
    got = {r.pos: r.unique_name for r in sets.number_repeats(spark.createDataFrame(rows, "name string, pos long"), "name", "pos").collect()}
    seen, want = defaultdict(int), {}
    for name, pos in rows:
        n, seen[name] = seen[name], seen[name] + 1
        stem, dot, ext = (name or "").rpartition(".")
        want[pos] = name if n == 0 or name is None else f"{stem}_{n}.{ext}" if dot else f"{name}_{n}"
    assert got == want


def test_best_row(spark):
    rows = [("a", 1, "x", None), ("a", 2, "y", "z"), ("a", 3, "w", "v"), (None, 4, None, None), (None, 5, "q", None), ("b", 6, None, None)]
    out = merge.best_row(spark.createDataFrame(rows, "k string, pos int, p string, q string"), ["k"], "pos").collect()
    assert {(r.k, r.pos) for r in out} == {("a", 2), (None, 5), ("b", 6)}
    assert merge.best_row(spark.createDataFrame([], "k string, pos int, p string"), ["k"], "pos").count() == 0
