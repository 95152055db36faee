import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from archivolt.operators import setrecon as R

ELEMENT = st.integers(0, R._P - 1)


@given(st.lists(st.tuples(ELEMENT, ELEMENT), min_size=1, max_size=50))
@settings(max_examples=100, deadline=None)
def test_field_arithmetic(pairs):
    a, b = (np.array(x, dtype=np.uint64) for x in zip(*pairs))
    assert [int(x) for x in R.mul(a, b)] == [x * y % R._P for x, y in pairs]
    assert [int(x) for x in R.sub(a, b)] == [(x - y) % R._P for x, y in pairs]
    nonzero = np.maximum(a, np.uint64(1))
    assert (R.mul(nonzero, R.inverse(nonzero)) == 1).all()


def reconcile_buckets(sets_a, sets_b):
    """The exchange without Spark, bounds doubled for the buckets that fail."""
    n = len(sets_a)
    only_a, only_b, todo, bound = [None] * n, [None] * n, np.arange(n), R.FIRST_BOUND
    while len(todo):
        at = R.points(bound + 1 + R.CHECKS, bound)
        (a, ia), (b, ib) = R._flat([sets_a[i] for i in todo]), R._flat([sets_b[i] for i in todo])
        fa, fb = R.evaluate(a, ia, len(todo), at), R.evaluate(b, ib, len(todo), at)
        q = R.mul(fa, R.inverse(fb.ravel()).reshape(fb.shape))
        delta = np.array([len(sets_a[i]) - len(sets_b[i]) for i in todo])
        top, low, degrees = R.interpolate(q, delta, bound, at)
        ha, hb = R.zeros_of(a, ia, top, low, degrees), R.zeros_of(b, ib, low, top, degrees[:, ::-1])
        ra, rb = R.evaluate(a[ha], ia[ha], len(todo), at), R.evaluate(b[hb], ib[hb], len(todo), at)
        good = (ra == R.mul(q, rb)).all(axis=1) & (np.bincount(ia[ha], minlength=len(todo)) - np.bincount(ib[hb], minlength=len(todo)) == delta) & (degrees[:, 0] >= 0)
        for j in np.flatnonzero(good):
            only_a[todo[j]], only_b[todo[j]] = a[ha & (ia == j)], b[hb & (ib == j)]
        todo, bound = todo[~good], bound * 2
    return only_a, only_b


@given(st.lists(st.tuples(st.sets(ELEMENT, max_size=30), st.sets(ELEMENT, max_size=7), st.sets(ELEMENT, max_size=7)), max_size=5))
@settings(max_examples=25, deadline=None)
def test_recovers_the_difference(buckets):
    a = [np.array(sorted(common | x), dtype=np.int64) for common, x, _ in buckets]
    b = [np.array(sorted(common | y), dtype=np.int64) for common, _, y in buckets]
    only_a, only_b = reconcile_buckets(a, b)
    for i in range(len(buckets)):
        assert set(only_a[i].tolist()) == set(a[i].tolist()) - set(b[i].tolist())
        assert set(only_b[i].tolist()) == set(b[i].tolist()) - set(a[i].tolist())


def test_many_differences_and_one_empty_side():
    rng = np.random.default_rng(3)
    big = np.unique(rng.integers(0, R._P, 60))
    only_a, only_b = reconcile_buckets([big, big[:0]], [big[:0], big])
    assert set(only_a[0]) == set(big.tolist()) and set(only_b[1]) == set(big.tolist()) and not len(only_b[0])


def test_an_element_at_an_evaluation_point():
    at = R.points(R.FIRST_BOUND + 1 + R.CHECKS, R.FIRST_BOUND)[:3].astype(np.int64)
    only_a, only_b = reconcile_buckets([np.unique(np.r_[at, 5, 6])], [np.unique(np.r_[at, 6, 7])])
    assert list(only_a[0]) == [5] and list(only_b[0]) == [7]


SCHEMA = "k string, o int, x string, y string"


def found(spark, a, b, schema=SCHEMA):
    out = R.differences(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k", "o"], ["x", "y"], ("only_a", "only_b"))
    return sorted((r.k, r.o, r.difference) for r in out.collect())


def test_differences(spark):
    a = [("p", 1, "1", "2"), ("q", 1, "1", None), ("r", 1, "1", "2"), ("r", 1, "1", "2"), ("s", 1, None, "2"), (None, 1, "z", "z"), ("t", 2, "1", "1")]
    b = [("p", 1, "1", "2"), ("q", 1, "9", ""), ("r", 1, "1", "2"), ("u", 1, "1", "1"), ("s", 1, None, "2"), ("t", 1, "1", "1")]
    assert found(spark, a, b) == [("q", 1, "x"), ("q", 1, "y"), ("t", 1, "only_b"), ("t", 2, "only_a"), ("u", 1, "only_b")]


def test_versions_of_one_key_compare_as_sets(spark):
    assert found(spark, [("p", 1, "1", "2"), ("p", 1, "1", "3")], [("p", 1, "1", "2")]) == [("p", 1, "y")]


@pytest.mark.parametrize("a,b", [([], []), ([("p", 1, "1", "2")], []), ([], [("p", 1, "1", "2")])])
def test_empty_tables(spark, a, b):
    assert found(spark, a, b) == [("p", 1, "only_a" if a else "only_b")] * (len(a) + len(b))


def test_hot_copies_and_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [(f"k{i}", 1, str(rng.integers(9)), "y" * (i % 5)) for i in range(3000)]
    a = base[:2900] + [base[0]] * 1500
    b = [(k, o, "changed" if i % 50 == 0 else x, y) for i, (k, o, x, y) in enumerate(base[100:])]
    da, db = {r[0]: r for r in a}, {r[0]: r for r in b}
    want = [(k, 1, "only_a") for k in da.keys() - db.keys()] + [(k, 1, "only_b") for k in db.keys() - da.keys()]
    want += [(k, 1, "x") for k in da.keys() & db.keys() if da[k][2] != db[k][2]]
    assert found(spark, a, b) == sorted(want)


def test_many_differences_are_joined_back_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(R, "FEW", 1)
    test_differences(spark)
    test_versions_of_one_key_compare_as_sets(spark)
