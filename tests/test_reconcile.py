from archivolt.operators import reconcile
from archivolt.session import table


def test_needles_of_every_length_are_found(spark):
    texts = ["annual report", "en", "e", "", None, "the annex, fr", "ännchen", "annual report"]
    needles = ["en", "e", "", "fr", "ann", "annu", "annual", "report of", None, "en"]
    got = reconcile.contains_pairs(spark.createDataFrame([(t,) for t in texts], "t string"), "t", spark.createDataFrame([(n,) for n in needles], "n string"), "n")
    pairs = [tuple(r) for r in got.collect()]
    want = {(t, n) for t in texts for n in needles if t is not None and n is not None and n in t}
    assert len(pairs) == len(want) and set(pairs) == want


def test_query_keeps_short_terms(spark, sf):
    from archivolt.plans import registry

    titles = {r[0] for r in table(spark, sf, "metadata_export").select("entity_title").collect() if r[0] is not None}
    terms = {r[0].lower() for r in table(spark, sf, "vocabulary").select("term").collect() if r[0] is not None}
    got = [tuple(r) for r in registry.QUERIES["titles_naming_terms"](spark, sf).collect()]
    assert any(len(n) < 4 for _, n in got)
    assert sorted(got) == sorted((t, n) for t in titles for n in terms if n in t)
