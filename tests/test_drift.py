import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from archivolt.operators import drift as D

LINES = "series_name string, file_name string, exported_at timestamp_ntz, loaded_at timestamp_ntz, line_no long, raw_line string"


def lines(spark, files):
    rows = []
    for i, (series, name, records) in enumerate(files):
        for n, raw in enumerate(records):
            # arrival against the order of export
            rows.append((series, name, dt.datetime(2024, 1, 1 + i), dt.datetime(2024, 3, 28 - i), n, raw))
    return spark.createDataFrame(rows, LINES).withColumn("value", F.lit("clash")).withColumn("field", F.lit("clash"))


def changes(spark, files):
    return sorted((r.file_name, r.change_kind, r.field_before, r.field_after) for r in D.schema_changes(lines(spark, files)).collect())


A = ["\ufeffassetId,dc:subject,dc:subject,Size,note", 'a1,x,y,10,"one, ""two"""', "a2,z,,20,n", 'a3,w,v,30,"line\nbreak"']


def test_changes(spark):
    b = ["note , assetid,keywords,size,dc:date", "n,a2,z,0.2 MB,2020-01-01", "m,a1,x; y,0.1 MB,2020-01-02", "k,a3,w; v,0.3 MB", "k,a3,w; v,0.3 MB"]
    c = ["assetid,keywords,size,dc:date", "a1,x; y,1.5,1 May 2020", "a2,z,2.5,2 May 2020", "a3,w; v,,"]
    got = changes(spark, [("s", "f1", A), ("s", "f2", b), ("s", "f3", c), ("t", "g1", ["assetid"])])
    assert got == [
        ("f2", "added", "", "dc:date"),
        ("f2", "renamed", "dc:subject", "keywords"),
        ("f2", "retyped", "size", "size"),
        ("f3", "removed", "note", ""),
        ("f3", "retyped", "dc:date", "dc:date"),
        ("f3", "retyped", "size", "size"),
    ]


def test_layout_is_no_change(spark):
    assert changes(spark, [("s", "f1", A), ("s", "f2", ["NOTE,size,assetId,dc:subject", "n,20,a2,z"])]) == []


def test_odd_input(spark):
    assert D.schema_changes(lines(spark, [("s", "f", ["a"])]).limit(0)).count() == 0
    assert changes(spark, [("s", "f1", ["a"]), ("s", "f2", ["a,b", "x" * 100_000, '"' * 501, ",,,,", None])]) == [("f2", "added", "", "b")]


def test_consistent_table(spark):
    b = ["assetid,keywords,size", "a1,x; y,7.0", "a1,,big"]
    c = ["assetid,topics", "a1,x|y"]
    columns = {"id": ("assetid", "string"), "subject": ("dc:subject", "array<string>"), "size": ("size", "bigint")}
    table = D.consistent_table(lines(spark, [("s", "f1", A), ("s", "f2", b), ("s", "f3", c)]), columns)
    got = {(r.file_name, r.line_no): r for r in table.collect()}
    assert len(got) == 6
    for key in (("f1", 1), ("f2", 1), ("f3", 1)):
        assert got[key].id == "a1" and got[key].subject == ["x", "y"]
    assert got[("f1", 1)].others == {"note": ['one, "two"']} and got[("f1", 1)].size == 10
    assert got[("f2", 1)].size == 7 and got[("f2", 2)].size is None and got[("f2", 2)].misfits == {"size": ["big"]} and got[("f2", 2)].subject is None
    assert D.consistent_table(lines(spark, [("s", "f", ["a"])]).limit(0), columns).count() == 0


def test_names_that_come_back(spark):
    """A name that was given up and comes back for something else is a field of its own until it's renamed."""
    f = [["assetid,a,b", "1,x,q", "2,y,r"], ["assetid,b,a", "1,x,q", "2,y,r"], ["assetid,c,a", "1,x,q", "2,y,r"]]
    table = D.consistent_table(lines(spark, [("s", f"f{i}", x) for i, x in enumerate(f)]), {"a": ("a", "string"), "b": ("b", "string")})
    assert {(r.file_name, r.line_no): (r.a, r.b) for r in table.collect() if r.line_no == 1} == {("f0", 1): ("x", "q"), ("f1", 1): ("q", "x"), ("f2", 1): ("q", "x")}


def test_records(spark):
    df = spark.createDataFrame([('a,"b ""c"", d",,"e\nf"',), ('"open,x',), ("",)], "r string")
    assert [r.c for r in df.select(D.split_record(F.col("r")).alias("c")).collect()] == [["a", 'b "c", d', "", "e\nf"], ['"open', "x"], [""]]


@given(st.lists(st.lists(st.integers(0, 9), min_size=4, max_size=4), min_size=4, max_size=4))
@settings(max_examples=100, deadline=None)
def test_assignment_is_cheapest(cost):
    from itertools import permutations

    got = D.least_assignment(cost)
    assert sorted(got) == [0, 1, 2, 3]
    assert sum(cost[i][j] for i, j in enumerate(got)) == min(sum(cost[i][j] for i, j in enumerate(p)) for p in permutations(range(4)))


def steps(*args, **more):
    return [(s.op, s.before, s.after) for s in D.edit_script(*args, **more) if s.is_field]


def test_script_prefers_evidence():
    assert steps(["a", "b"], ["c", "d"], {("a", "d"): 0.9, ("b", "d"): 0.6}) == [("add", "", "c"), ("delete", "b", ""), ("rename", "a", "d")]
    assert steps(["dc:s", "dc:t"], ["s", "dc:t"], {("dc:s", "s"): 1.0}) == [("move", "dc:s", "s")]
    assert steps(["a"], ["b"], {("a", "b"): 0.4}) == [("add", "", "b"), ("delete", "a", "")]
    assert steps(["a"], ["a"], {}, {"a": "whole"}, {"a": "text"}) == [("retype", "a", "a")]
    assert steps([], [], {}) == []


def test_subtrees():
    """A renamed namespace is one step for it, a struct that is moved goes as a whole."""
    both = {(f"dc:{x}", f"dcterms:{x}"): 1.0 for x in "abc"}
    script = D.edit_script([f"dc:{x}" for x in "abc"], [f"dcterms:{x}" for x in "abc"], both)
    assert [(s.op, s.before, s.after) for s in script if not s.is_field] == [("rename", "dc:", "dcterms:")]
    before, after = D.name_tree(["p.x.a", "p.x.b", "q.c"]), D.name_tree(["q.x.a", "q.x.b", "q.c", "p.d"])
    script = D.edit_script(before, after, {}, trust_labels=True)
    assert ("move", "p.x.", "q.x.", False) in [(s.op, s.before, s.after, s.is_field) for s in script]
    assert [(s.op, s.before, s.after) for s in script if s.is_field] == [("add", "", "p.d"), ("rename", "p.x.a", "q.x.a"), ("rename", "p.x.b", "q.x.b")]


@given(st.integers(0, 10**6))
@settings(max_examples=60, deadline=None)
def test_distance_is_least(seed):
    """Against every one-to-one mapping of small flat trees with one level of namespaces."""
    import random
    from itertools import permutations

    rnd = random.Random(seed)
    a, b = ([f"{rnd.choice('mn')}:{x}" for x in rnd.sample("abcde", rnd.randint(0, 4))] for _ in range(2))
    share = {(x, y): rnd.choice((0.0, 0.5, 0.8, 1.0)) for x in a for y in b if x not in b and y not in a}
    gone, come = [x for x in a if x not in b], [y for y in b if y not in a]
    got = steps(a, b, share)
    cost = lambda x, y: 1 - share[x, y] + (D.RELABEL if x[2:] != y[2:] else 0) + (D.MOVE if x[0] != y[0] else 0) if share[x, y] >= 0.5 else 2.0
    wide = come + [None] * len(gone)
    best = min((sum(cost(x, y) if y else 1 for x, y in zip(gone, p)) + sum(y not in p for y in come) for p in permutations(wide, len(gone))), default=len(come))
    mine = sum(1 if op in ("add", "delete") else cost(x, y) for op, x, y in got)
    # inner nodes may make another choice worth at most what they cost
    assert mine <= best + 2 * (2 * D.INNER + D.MOVE) and {x for _, x, _ in got if x} == set(gone) and {y for _, _, y in got if y} == set(come)


def test_nested_frames(spark):
    one = spark.sql("SELECT 1 AS id, named_struct('title', 'a', 'size', 5) AS meta, 'x' AS note")
    two = spark.sql("SELECT 2L AS id, named_struct('title', 'b', 'lang', named_struct('code', 'en')) AS meta, named_struct('size', 7.5D) AS file")
    three = spark.sql("SELECT 3L AS id, named_struct('title', 4, 'lang', named_struct('code', 'fr')) AS meta, named_struct('size', 8.5D) AS file")
    table, scripts = D.consistent_frames([one, two, three])
    assert [(s.op, s.before, s.after) for s in scripts[0] if s.is_field] == [("add", "", "meta.lang.code"), ("delete", "note", ""), ("move", "meta.size", "file.size"), ("retype", "id", "id")]
    assert [(s.op, s.before) for s in scripts[1]] == [("retype", "meta.title")]
    rows = {r.id: r for r in table.collect()}
    assert [rows[i].file.size for i in (1, 2, 3)] == [5.0, 7.5, 8.5] and [rows[i].meta.title for i in (1, 2, 3)] == ["a", "b", "4"]
    assert rows[1].note == "x" and rows[3].note is None and rows[1].meta.lang.code is None and rows[3].meta.lang.code == "fr"
