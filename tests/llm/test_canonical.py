from pyspark.sql import functions as F

from archivolt.llm.canonical import map_free_values, map_values

VOCAB = [("f", 1, "Council minutes", ["board minutes"]), ("f", 2, "Text", None), ("f", 3, "Portrait painting", []), ("g", 4, "en", ["English", None]), ("f", 5, "Test pieces", None)]
SCHEMA = "field_name string, term_id long, term string, alt_labels array<string>"


def mapped(spark, cells, vocab=VOCAB):
    df = spark.createDataFrame(cells, "field_name string, cell string")
    return {(r.field_name, r.cell): r.term_id for r in map_values(df, spark.createDataFrame(vocab, SCHEMA)).collect()}


def test_noise(spark):
    want = {
        ("f", "COUNCIL MINUTES"): 1, ("f", "Minutes, council"): 1, ("f", "Coun. minutes"): 1, ("f", "C0unci1 minutes"): 1, ("f", "Counci lmintues"): 1,
        ("f", "Council minutes (signed)"): 1, ("f", "bord minutes"): 1, ("f", " Text "): 2, ("f", "Tetx"): 2, ("f", "Txxt?"): 2, ("f", "Portrait_painting"): 3,
        ("g", "en-GB"): 4, ("g", "in English (mainly)"): 4, ("g", "lang: Egnlish"): 4,
    }
    none = {("f", "mixed"): 0, ("f", "xx"): 0, ("f", "???"): 0, ("g", "Harrish"): 0, ("g", "Text"): 0, ("f", "x" * 5000): 0}
    assert mapped(spark, list(want | none)) == want | none


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def operations(a, b):
    """Edits, counting a swap of neighbours once; up to two."""
    swaps = lambda x: {x[:i] + x[i + 1] + x[i] + x[i + 2 :] for i in range(len(x) - 1)}
    best = min([levenshtein(a, b), *(1 + levenshtein(x, b) for x in swaps(a))])
    return min(best, 2) if swaps(a) & swaps(b) else best


def test_segments_lose_no_close_pair(spark):
    """The join finds what comparing each value with each label finds, for labels of many lengths."""
    import random

    rnd = random.Random(7)
    labels = ["".join(rnd.choice("abcde") for _ in range(n)) for n in range(4, 24)]
    cells = set()
    for label in labels:
        for _ in range(30):
            t = list(label)
            for _ in range(rnd.randint(1, 4)):
                at = rnd.randrange(len(t))
                kind = rnd.randrange(4)
                if kind == 0:
                    t[at] = rnd.choice("abcde")
                elif kind == 1 and len(t) > 2:
                    del t[at]
                elif kind == 3 and at:
                    t[at - 1], t[at] = t[at], t[at - 1]
                else:
                    t.insert(at, rnd.choice("abcde"))
            cells.add("".join(t))
    got = mapped(spark, [("f", c) for c in cells], [("f", i + 1, x, None) for i, x in enumerate(labels)])
    for c in cells:
        best = []
        for i, label in enumerate(labels):
            ops = 1 if len(label) < 8 else 2
            edits = levenshtein(c, label)
            cost = operations(c, label)
            if c == label:
                best.append((0, 0, i + 1))
            elif cost <= ops:
                best.append((cost, edits, i + 1))
        assert got[("f", c)] == (min(best)[2] if best else 0), c


def test_rows(spark):
    rows = [(1, "Text", "eng"), (2, "text", None), (2, "text", None), (3, " ", "zz"), (4, None, "English")]
    df = spark.createDataFrame(rows, "record_id long, f string, g string").withColumn("field_name", F.lit("clash")).withColumn("term_id", F.lit(9))
    vocab = spark.createDataFrame(VOCAB, SCHEMA)
    out = sorted(tuple(r) for r in map_free_values(df, "record_id", ["f", "g"], vocab).collect())
    assert out == [(1, "g", 0), (2, "f", 2), (2, "f", 2), (3, "g", 0), (4, "g", 4)]
    assert map_free_values(df.limit(0), "record_id", ["f", "g"], vocab).count() == 0
    none = map_free_values(df, "record_id", ["f"], vocab.limit(0)).collect()
    assert {r.term_id for r in none} == {0} and len(none) == 3


def test_words_around_and_cut_off(spark):
    """A label in a longer text, words in another order, cut-off words; a long text is searched for whole labels only."""
    long = " ".join(["x"] * 3 + ["council minutes"] + ["y"] * 4000)
    got = mapped(spark, [("f", x) for x in ("the council minutes, signed", "painting portrait", "Port. paint.", "P. q.", "text and so on and on", long)])
    assert [got[("f", x)] for x in ("the council minutes, signed", "painting portrait", "Port. paint.", "P. q.", "text and so on and on", long)] == [1, 3, 3, 0, 0, 0]


def test_candidates_grow_below_values_times_terms(spark):
    """With 10,000 labels of random letters the join makes far fewer candidates than there are pairs."""
    import random

    from archivolt.llm import canonical as c

    rnd = random.Random(3)
    labels = sorted({"".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(8, 20))) for _ in range(10_000)})
    vocab = spark.createDataFrame([("f", i, x, None) for i, x in enumerate(labels)], SCHEMA)
    cells = [("f", x[:3] + "#" + x[4:]) for x in labels[::50]]
    out = {r.cell: r.term_id for r in c.map_values(spark.createDataFrame(cells, "field_name string, cell string"), vocab).collect()}
    right = sum(labels[out[x]] == labels[i * 50] for i, (_, x) in enumerate(cells))
    assert right >= 0.98 * len(cells)
