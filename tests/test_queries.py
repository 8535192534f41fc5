"""Each registered query against its SQL on the smallest tables; each cleaning query must change some row."""

import os

import duckdb
import pytest

from docprep.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem documents labels conversations pages benchmark".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    return repr(round(v, 6)) if isinstance(v, float) else repr(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = db.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(plain(float(r[i]) if type(r[i]).__name__ == "Decimal" else r[i]) for i in at) for r in rel.fetchall())
    assert got == want


#: Columns that are one value by what they are: totals of one row, and the parameters of a single kind of rows.
SAME_BY_NATURE = {"tokens_stripped", "context_messages"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_column_is_constant(db, name):
    """A column that has one value in all rows shows nothing: each must take two at least, unless there is one row."""
    rel = db.sql(ORACLES[name])
    rows = rel.fetchall()
    same = [c for k, c in enumerate(rel.columns) if len({repr(r[k]) for r in rows}) == 1 and c not in SAME_BY_NATURE]
    assert len(rows) == 1 or not same


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("cln", "pre"))])
def test_changes_some_row(spark, name):
    from docprep import corpora

    before = corpora.noisy(spark, SF).withColumnRenamed("text", "old")
    assert QUERIES[name](spark, SF).join(before, "doc_id").where("text <> old").limit(1).count() == 1
