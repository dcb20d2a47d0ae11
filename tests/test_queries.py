"""Every registered query against its SQL twin."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from tradelake.plans import oracle, registry

TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_a_twin():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = [tuple(row) for row in df.select(*columns).collect()]
    answer = duck.execute(oracle.oracle_sql()[name])
    shape = {c[0]: str(c[1]) for c in answer.description}
    place = [[c[0] for c in answer.description].index(c) for c in columns]
    wanted = [tuple(row[i] for i in place) for row in answer.fetchall()]
    assert sorted(shape) == columns
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == shape
    assert in_order(found) == in_order(wanted)


def test_entry_has_rows(spark):
    assert driver.entry(spark).columns == [
        "exchange", "symbol", "ts", "price", "qty", "is_sell",
    ]


def test_every_branch_of_the_inputs_is_hit(spark, sf_dir):
    queries = driver.queries()
    errors = queries["venue_market_exchange"](spark, sf_dir)
    assert errors.filter("error LIKE 'unknown venue%'").count()
    assert errors.filter("error LIKE 'unknown market%'").count()
    assert errors.filter("exchange LIKE '%/%'").count()
    plan = queries["purge_plan"](spark, sf_dir)
    assert plan.filter("to_delete > 0").count()
    assert plan.filter("to_delete = 0").count()
    assert plan.filter("row_count = 0").count()
    feeds = queries["feed_health"](spark, sf_dir)
    assert feeds.filter("state = 'starting'").count()
    flags = queries["rate_limit_flags"](spark, sf_dir)
    assert {row[0] for row in flags.select("allowed").distinct().collect()} == {True, False}


@pytest.mark.parametrize(
    "name", ["trades_range_asc", "trades_latest_desc", "trades_export", "exchange_symbol_lists"]
)
def test_nothing_is_cut_at_a_larger_size(spark, name):
    large = "/root/testdata/sf0.1"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{large}/{table}.parquet'")
    test_query_equals_sql(spark, con, large, name)
