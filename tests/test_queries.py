"""Every registered query next to its SQL twin, and what its plan must not hold."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from reviewloom import catalog
from reviewloom.sources.adapters import TABLES
from scripts.check import compare

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES
# scoring goes through the ML vectors, whose conversions are JVM functions
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan, f"{word} in the plan"
    got = df.toArrow()
    if name in ORACLES:
        assert not compare(got, duck.sql(ORACLES[name]).to_arrow_table())


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    # iterative or randomised work has no SQL twin
    without = {"J07_label_model", "L02_bernoulli_by_month", "M04_document_embedding", "M11_fit_classifier", "M12_batch_scoring", "CH3_training_chain"}
    assert set(QUERIES) - set(ORACLES) == without


def test_entry_lists_the_catalog():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 11
