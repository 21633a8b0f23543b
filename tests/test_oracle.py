"""Every catalogue query against its SQL on the smallest tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from foliant.plans.catalogue_queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark conversations".split()


def plain(value):
    if isinstance(value, (list, np.ndarray)):
        return str([plain(v) for v in value])
    if value is None or pd.isna(value):
        return None
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, (int, float, np.number)):
        return round(float(value), 6)
    return str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF).toPandas()
    if name in ORACLE_SQL:
        want = duck.execute(ORACLE_SQL[name]).df()
        assert sorted(found.columns) == sorted(want.columns)
        assert rows(found) == rows(want)
    else:
        assert len(found)


def test_entry_and_guard(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())
