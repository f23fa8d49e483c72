"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from panelmill.catalog.queries import _facts
from panelmill.operators import orders as O
from panelmill.operators import panel as P
from panelmill.operators import scoring as S
from panelmill.plans.gold import ALL_BLOCKS, gold
from panelmill.plans.reports import CHURN_BY_ORDERS
from panelmill.schema import FEATURES, TARGET
from panelmill.session import apply_sql_settings
from panelmill.sources.testviews import typed_tables
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def shuffled_joins(spark):
    """Joins as they are planned for large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_panel_has_no_range_join_and_one_final_aggregation(spark, shuffled_joins):
    text = plan(gold(typed_tables(spark, SF_SMALL), "v3", ALL_BLOCKS))
    assert "CartesianProduct" not in text
    # the only nested-loop joins attach the one-row calendar bounds
    assert text.count("BroadcastNestedLoopJoin") == 2
    assert text.count("IdentityBroadcastMode") >= 1
    assert text.count("hashpartitioning(customer_unique_id#") == 2
    assert "Window" not in text and "Python" not in text and "ObjectHashAggregate" not in text


def test_report_reads_only_its_columns(spark):
    text = plan(CHURN_BY_ORDERS(gold(typed_tables(spark, SF_SMALL), "v3", ())))
    assert "lineitem" not in text and "part.parquet" not in text and "o_totalprice" not in text


def test_item_rollup_copies_no_rows(spark, shuffled_joins):
    t = typed_tables(spark, SF_SMALL)
    text = plan(O.item_rollup(O.categorised_items(t["order_items"], t["products"], t["category_translation"])))
    assert "Expand" not in text


def test_lookback_join_keeps_the_many_rows_on_the_left(spark, make_orders, shuffled_joins):
    orders = make_orders([("1", "a", "2018-01-05 09:00:00"), ("2", "a", "2018-09-05 09:00:00")])
    text = plan(P.join_to_panel(P.panel(orders, P.V3), orders, P.V3))
    assert "LeftOuter" not in text and "LeftSemi" in text and "LeftAnti" in text


def test_row_checks_have_no_lambda(spark):
    rows = spark.createDataFrame([("1",) * len(FEATURES)], ", ".join(f"{f} string" for f in FEATURES))
    for df in (S.reject_counts(rows), S.rejected_rows(rows), S.valid_rows(rows)):
        assert "lambda" not in plan(df)


def test_no_snapshot_pairing_in_the_label(make_orders, shuffled_joins):
    orders = make_orders([("1", "a", "2018-01-05 09:00:00"), ("2", "a", "2018-09-05 09:00:00")])
    text = plan(P.forward_label(orders, P.V3))
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text


def test_words_of_a_customer_meet_before_they_are_spread_over_months(spark, shuffled_joins):
    text = plan(gold(typed_tables(spark, SF_SMALL), "v3", ALL_BLOCKS))
    assert text.count("REBALANCE_PARTITIONS_BY_COL") == 1


def test_stored_items_are_not_read_again(spark):
    tables = typed_tables(spark, SF_SMALL)
    completed = O.completed_orders(tables["orders"], tables["customers"])
    owned = O.owned_items(tables["order_items"], completed)
    stored = spark.createDataFrame(owned.collect(), owned.schema)
    for generation in ("v1", "v2", "v3"):
        exact = [c for c in gold(tables, generation).columns if c.startswith(("order_count", "item_count", "unique_", "customer_", "observation_"))]
        whole, from_stored = gold(tables, generation).select(exact), gold(tables, generation, completed=completed, owned=stored).select(exact)
        assert "lineitem" not in plan(from_stored)
        assert whole.count() > 0 and whole.exceptAll(from_stored).count() == from_stored.exceptAll(whole).count() == 0


def test_no_method_is_too_large_to_be_compiled(spark):
    assert int(apply_sql_settings(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_decisions_are_checked_without_a_join(spark):
    exact = spark.createDataFrame([("a", 1, 0.7), ("b", 0, 0.2)], f"customer_unique_id string, {TARGET} int, {S.PROBABILITY} double")
    right = _facts(exact, lambda rows: S.decide(rows, 0.5), 0.5, "m")
    assert "Join" not in plan(right) and tuple(right.first()) == ("m", 2, 1, 0, 0, 0, 0)
    assert _facts(exact, lambda rows: S.decide(rows, 0.9), 0.5, "m").first()["decisions_off"] == 1
