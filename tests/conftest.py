"""One session for all tests, and the comparison of a query with its SQL."""

from __future__ import annotations

import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from loamstone.session import local_session

    session = local_session("tests", memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


def plain(value):
    """A value in a form that both engines share and that sorts."""
    if value is None:
        return "\0"
    if isinstance(value, bool):
        return str(value)
    if hasattr(value, "asDict"):
        return plain(list(value.asDict().values()))
    if isinstance(value, dict):
        return plain(list(value.values()))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    if isinstance(value, int):
        return f"{value}" if abs(value) >= 10**6 else f"{float(value):.6g}"
    if type(value).__name__ == "Decimal":
        return f"{float(value):.6g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for name in sorted(os.listdir(folder)):
        if name.endswith(".parquet"):
            path = f"{folder}/{name}"
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    return con


def same(spark, folder, query, sql):
    """Asserts that the query's rows are those of the SQL."""
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck(folder).execute(sql)
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]), (len(got[1]), len(want[1]))
    wrong = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    assert not wrong, (len(wrong), wrong[:3])
