"""The registered queries against DuckDB on the smallest tables, where these are there."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry

HERE = os.environ.get("CHARTWEAVE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(HERE), reason="no test tables")


def _norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{HERE}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_like_sql(spark, duck, name):
    df = entry.queries()[name](spark, HERE)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    left = sorted(([_norm(r[c]) for c in order] for r in df.collect()), key=str)
    right = sorted(([_norm(r[names.index(c)]) for c in order] for r in cur.fetchall()), key=str)
    assert left == right


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_the_core_doesnt_import_the_subpackage():
    root = os.path.dirname(entry.__file__)
    for f in glob.glob(f"{root}/chartweave/**/*.py", recursive=True):
        if f"{os.sep}llm{os.sep}" not in f:
            assert "chartweave.llm" not in open(f).read(), f


def test_recall_of_the_registered_index(spark):
    pairs = lambda name: {(r.query_id, r.chunk_id) for r in entry.queries()[name](spark, HERE).collect()}
    exact, near = pairs("retrieve_knn"), pairs("retrieve_knn_index")
    assert len(exact & near) >= 0.9 * len(exact) > 0 and len(near) <= len(exact)
