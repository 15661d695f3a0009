import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from codeloom.registry import all_queries, views  # noqa: E402
from tools import check  # noqa: E402

# The text operators have their own tests.
QUERIES = {name: build for name, (build, _) in all_queries().items()}
ORACLES = {name: sql for name, (_, sql) in all_queries().items() if sql}

# Plans that may never appear: they compare all pairs or run in one place.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
# Windows over one row per version or layer.
SINGLE_WINDOW = {"q_version_compare", "q_layer_summary"}


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [p for p in FORBIDDEN if p in plan]
    if name not in SINGLE_WINDOW:
        # A window over everything shows as a single-partition exchange right below it.
        lines = [line.strip() for line in plan.splitlines()]
        for i, line in enumerate(lines):
            if " Window [" in line or line.startswith("Window ["):
                assert "Exchange SinglePartition" not in " ".join(lines[i + 1 : i + 4]), plan
    got = check.bag(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(ORACLES[name])
    want = check.bag([d[0] for d in result.description], result.fetchall())
    assert got == want


def test_the_contract_holds_all_of_them():
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(views.TABLES))
def test_declared_schemas_equal_the_files(spark, sf, name):
    stored = spark.read.parquet(f"{sf}/{name}.parquet")
    assert [(f.name, f.dataType) for f in views.table(spark, sf, name).schema] == [(f.name, f.dataType) for f in stored.schema]
