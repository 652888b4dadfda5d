"""Every registered query against its SQL, row for row."""

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from wellspring.plans.oracles import ORACLES  # noqa: E402
from wellspring.plans.registry import QUERIES  # noqa: E402

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = [f.removesuffix(".parquet") for f in sorted(os.listdir(SF_DIR))]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float) and math.isnan(v):
            return "None"
        return repr(v)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    mine = df.collect()
    assert mine, "no rows"
    sql = ORACLES.get(name)
    if sql is None:
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    a, b = canonical(df.columns, mine), canonical(columns, theirs)
    assert len(a) == len(b), (len(a), len(b), a[:2], b[:2])
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    assert not wrong, wrong[:3]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
