"""Every registered query of the subpackage on the smallest tables, against its SQL where it has one."""

from pathlib import Path

import duckdb
import pytest

from nameledger.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the test tables are not here")


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in got.collect()]
    assert rows or name == "op10_secrets"  # the smallest documents hold no candidate
    if name in ORACLES:
        con = duckdb.connect()
        for file in Path(SF_DIR).glob("*.parquet"):
            con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        want = con.sql(ORACLES[name])
        assert sorted(got.columns) == sorted(want.columns)
        assert in_order(got.columns, rows) == in_order(want.columns, want.fetchall())
