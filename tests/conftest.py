from __future__ import annotations

import datetime as dt

import pytest

from panelmill.session import build_session

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        shared=tmp_path_factory.mktemp("shared").as_uri(),
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


ORDER_SCHEMA = (
    "order_id string, customer_unique_id string, order_purchase_timestamp timestamp,"
    " order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
)


@pytest.fixture(scope="session")
def make_orders(spark):
    """Completed orders from (id, customer, 'YYYY-MM-DD HH:MM:SS'[, delivered, estimated])."""

    def build(rows):
        def parse(x):
            return dt.datetime.fromisoformat(x) if x else None

        return spark.createDataFrame(
            [(r[0], r[1], *[parse(x) for x in (*r[2:], None, None)[:3]]) for r in rows], ORDER_SCHEMA
        )

    return build
