"""Every operator's query over the given tables, against SQL where there is some."""

from __future__ import annotations

import duckdb
import pytest

from tradelake.llm import queries as llm

TABLES = "documents embeddings pages benchmark labels".split()


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = llm.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = [tuple(row) for row in df.select(*columns).collect()]
    answer = duck.execute(llm.oracle_sql()[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == columns
    wanted = [tuple(row[names.index(c)] for c in columns) for row in answer.fetchall()]
    assert in_order(found) == in_order(wanted)


def test_thirteen_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in llm.queries())
    assert numbers == list(range(1, 14))
