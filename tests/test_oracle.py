"""Every registered query that has an oracle text must equal it, row by row."""

import pytest

import __spark_entry__ as entry_module
from tests.conftest import SMALL
from tests.oracle import compare, connect

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()
# Fits and searches take longest and have no oracle; they run in test_models.
SLOW = {"train_classifier", "train_regressor", "tune_search", "feature_importance", "prediction_table", "udf_model_score", "win_elo"}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_oracle(spark, con, key):
    _, reason = compare(QUERIES[key](spark, SMALL), con, ORACLES[key])
    assert reason is None, reason


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs_without_oracle(spark, key):
    assert QUERIES[key](spark, SMALL).columns


def test_entry(spark):
    assert entry_module.entry(spark).columns == [
        "usage_date", "product", "sku_name", "usage_quantity", "unit_price", "estimated_cost_usd"]


def test_registry_needs_no_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; e.queries(); e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code], cwd=entry_module.__file__.rsplit("/", 1)[0]).returncode == 0
