"""Every query with an SQL twin gives the twin's rows; the others give rows of a stable schema."""

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from archivolt.plans import registry


def plain(v):
    if v is None or isinstance(v, float) and v != v:
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return [plain(x) for x in v]
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 4)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(pd.Timestamp(v))
    return v


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, db, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = Counter(repr([plain(r[c]) for c in columns]) for r in df.collect())
    if name not in registry.ORACLE:
        assert got or name == "p1_found"
        return
    cursor = db.execute(registry.ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = Counter(repr([plain(r[names.index(c)]) for c in columns]) for r in cursor.fetchall())
    assert got == want


def test_every_twin_has_a_query():
    assert set(registry.ORACLE) <= set(registry.QUERIES)
