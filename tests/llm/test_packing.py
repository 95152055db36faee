from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from archivolt.llm import packing as K


def filled(rows, capacity):
    size, items = defaultdict(int), defaultdict(list)
    for r in rows:
        size[r.container_id] += r.n_tokens if "n_tokens" in r else r["size"]
        items[r.item].append((r.part, r.start, r["size"]))
    assert all(s <= capacity for s in size.values())
    return size, items


def test_whole_items_and_parts(spark):
    sizes = [(i, (i * 37) % 90 + 1) for i in range(2000)] + [(9001, 250), (9002, 100), (9003, 0)]
    df = spark.createDataFrame(sizes, "item long, size int").repartition(23)
    rows = K.pack(df, {"c": 100, "d": 1000}, most_open=8).collect()
    for kind, capacity in (("c", 100), ("d", 1000)):
        size, items = filled([r for r in rows if r.container_kind == kind], capacity)
        for item, n in sizes:
            parts = sorted(items.get(item, []))
            assert sum(p[2] for p in parts) == n
            assert len(parts) == -(-n // capacity)
            assert [p[1] for p in parts] == [capacity * k for k in range(len(parts))]
        # items of nearly half a container on average and eight open lists: the loss stays below a tenth
        assert sum(size.values()) / (len(size) * capacity) > 0.9


def test_bounded_open_list():
    packer = K.Packer(10, most_open=3)
    closed = [c for size in (6, 7, 8, 9, 9, 9) for c in packer.add(("i", 0, 0, size))]
    assert len(packer.leftovers()) == 3 and len(closed) == 3
    # the fullest is emitted first
    assert [sum(p[-1] for p in content) for _, content in closed] == [8, 9, 9]


@given(st.lists(st.integers(1, 30), max_size=60))
@settings(max_examples=100, deadline=None)
def test_nothing_is_lost(sizes):
    packer = K.Packer(30, most_open=4)
    out = [c for n, s in enumerate(sizes) for c in packer.add((n, 0, 0, s))]
    content = [p for _, c in out for p in c] + [p for _, _, c in packer.leftovers() for p in c]
    assert sorted(p[0] for p in content) == list(range(len(sizes)))
    assert all(sum(p[-1] for p in c) <= 30 for _, c in out)


def test_empty_and_null_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "one two three"), (3, "one two three"), (4, "é " * 30_000)], "doc_id long, text string")
    spec = spark.createDataFrame([("s", 64)], "container_kind string, capacity_tokens int")
    rows = K.pack_texts(docs, spec).collect()
    assert {r.doc_id for r in rows} == {3, 4} and len([r for r in rows if r.doc_id == 3]) == 2
    assert K.pack_texts(docs.limit(0), spec).count() == 0
