import duckdb
import pytest
from pathlib import Path

import __spark_entry__ as entry
from compare import rows
from quillon.plans import encyclopedia, knowledge, training

CORE = {**encyclopedia.queries(), **knowledge.queries(), **training.queries()}
SQL = {**encyclopedia.oracle_sql(), **knowledge.oracle_sql(), **training.oracle_sql()}


def test_entry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(CORE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, sf, name):
    df = CORE[name](spark, sf)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in SQL:
        db = duckdb.connect()
        for p in Path(sf).glob("*.parquet"):
            db.execute(f"create view {p.stem} as from '{p}'")
        res = db.execute(SQL[name])
        assert sorted(d[0] for d in res.description) == sorted(df.columns)
        assert rows([d[0] for d in res.description], res.fetchall()) == mine
