"""Every catalog query against its SQL twin; those of the text subpackage have their own test.

The queries are small jobs, so a few run at a time, each in its own scratch folder that goes when its
rows are there. ORACLE_SF_DIR picks the data.
"""

import os
from concurrent.futures import ThreadPoolExecutor

import compare
import pytest

import __spark_entry__ as entry_module
from entrypoints.oracles import ORACLES
from entrypoints.queries import all_queries
from shelfmark.session import cut, scratch_scope

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES = all_queries()


@pytest.fixture(scope="module")
def results(spark):
    def run(name):
        with scratch_scope(spark):
            df = QUERIES[name](spark, SF_DIR)
            plan = df._jdf.queryExecution().executedPlan().toString()
            return (*compare.spark_rows(df), plan)

    with ThreadPoolExecutor(4) as pool:
        yield {name: pool.submit(run, name) for name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_scope_leaves_nothing(spark):
    with scratch_scope(spark) as folder:
        stored = cut(spark.range(5))
        assert stored.count() == 5 and stored.inputFiles()[0].startswith("file:") and os.path.exists(folder)
        with scratch_scope(spark) as inner:
            assert inner.startswith(folder)
    assert not os.path.exists(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, results, duck):
    columns, rows, plan = results[name].result()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name not in ORACLES:
        assert rows
        return
    expected_columns, expected = compare.duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected


def test_entry(spark):
    assert entry_module.entry(spark).count() == 60
