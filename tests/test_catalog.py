"""Every named query against its SQL on the smallest tables; those that fit models at full size are marked slow."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from panelmill.catalog.sql import SQL
from tests.conftest import SF_SMALL

FITTED = {
    "logistic_fit", "logistic_gradient", "forest_fit", "gbt_fit", "mlp_fit", "grid_search", "training_workflow",
    "batch_scoring", "high_risk_sample", "forest_importance", "linear_attribution", "tree_attribution",
    "leafwise_boosting", "relu_network",
}
NAMES = [pytest.param(n, marks=pytest.mark.slow) if n in FITTED else n for n in sorted(SQL)]


@pytest.fixture(scope="module")
def db():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, db, name):
    assert compare(spark, db, SF_SMALL, name).startswith("ok")


def test_catalog_is_consistent(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns[:2] == ["customer_unique_id", "observation_date"]
