"""Every query of the package that SQL can express equals its SQL."""

import duckdb
import pytest

from check import TABLES, rows_of
from civicspark.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    out = registry.QUERIES[name](spark, sf)
    cur = con.execute(registry.ORACLE[name])
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert rows_of(out.columns, [tuple(r) for r in out.collect()]) == want and want


def test_every_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in registry.QUERIES] == list(range(1, 14))
