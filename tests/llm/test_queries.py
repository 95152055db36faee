import importlib.util
import sys

import pytest

from archivolt.llm import queries



@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    rows = df.collect()
    assert rows and len(set(df.columns)) == len(df.columns)
    if name.endswith("_found"):
        assert len({tuple(r) for r in rows}) == len(rows)


def test_values_against_sql(spark, sf):
    import duckdb

    db = duckdb.connect()
    for t in ("metadata_export", "vocabulary"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")

    assert sorted(tuple(r) for r in queries.QUERIES["p5_found"](spark, sf).select("record_id", "field_name", "term_id").collect()) == sorted(
        (r, f, t) for r, f, t in db.execute(f"SELECT record_id, field_name, term_id FROM ({queries.ORACLE['p5_found']})").fetchall()
    )



def test_no_text_is_split_that_fits(spark, sf):
    spec = {r.container_kind: r.capacity_tokens for r in spark.read.parquet(f"{sf}/container_spec.parquet").collect()}
    parts = {}
    for r in queries.QUERIES["p7_packed"](spark, sf).collect():
        parts.setdefault((r.container_kind, r.doc_id), []).append((r.part, r.start_token, r.n_tokens))
    for (kind, _), p in parts.items():
        assert len(p) == 1 or sum(n for _, _, n in p) > spec[kind]
        at = 0
        for _, start, n in sorted(p):
            assert start == at and n <= spec[kind]
            at += n


def test_core_survives_a_broken_text_package(monkeypatch):
    sys.path.insert(0, importlib.util.find_spec("archivolt").submodule_search_locations[0].rpartition("/")[0])
    import __spark_entry__ as entry

    def broken(_):
        raise ImportError("no tokenizers here")

    monkeypatch.setattr(entry.importlib, "import_module", broken)
    with pytest.warns(UserWarning):
        assert "p4_found" in entry.queries() and "p8_found" not in entry.queries()
