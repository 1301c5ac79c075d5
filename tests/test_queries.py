"""Every registered query against its reference SQL on the smallest shared tables."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

from saltmarsh.queries import all_entries
from saltmarsh.queries.adapters import SCHEMAS

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ENTRIES = all_entries()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables are not here")


@pytest.fixture(scope="module")
def reference():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return f"{float(value):.6f}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, dt.date) else str(value)


def table(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in data], key=str)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query(spark, reference, name):
    entry = ENTRIES[name]
    df = entry.run(spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    if entry.sql is None:
        assert got
        return
    result = reference.execute(entry.sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert table(df.columns, got) == table(names, result.fetchall())


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(ENTRIES) <= set(entry.queries())
