"""Every query with an oracle gives the oracle's rows at the smallest scale."""

import os

import duckdb
import pytest

from corpusloom.plans import catalogue, catalogue_records  # noqa: F401

SF = "/root/testdata/sf0.001"


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)].astype(object)
    return [tuple(None if v is None or v != v else str(v) for v in r) for r in pdf.itertuples(index=False, name=None)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    if name not in catalogue.ORACLES:
        assert len(got)
        return
    with duckdb.connect() as c:
        c.execute("set timezone = 'UTC'")
        c.sql(f"create view documents as select * from '{SF}/documents.parquet'")
        wanted = c.sql(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(rows(got), key=key) == sorted(rows(wanted), key=key)


def test_entry_and_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(catalogue.QUERIES) <= set(entry.queries())
