from __future__ import annotations

import pytest

from panelmill.functions.columns import band, finite_double, ratio, standardize_columns
from panelmill.operators import orders as O
from panelmill.operators.cleaning import clean, dedupe, require_columns
from panelmill.schema import ENTITIES, FEATURES
from pyspark.sql import functions as F


def test_standard_names_and_collisions(spark):
    df = spark.createDataFrame([(1, 2)], [" Order-ID ", "Zip Code"])
    assert standardize_columns(df).columns == ["order_id", "zip_code"]
    with pytest.raises(ValueError, match="collide"):
        standardize_columns(spark.createDataFrame([(1, 2)], ["a b", "A-b"]))


def test_dedupe_is_deterministic_for_a_hot_key(spark):
    rows = [("hot", i % 7, str(i % 11)) for i in range(500)] + [(f"k{i}", i, None) for i in range(20)]
    for n in (1, 5):
        got = dedupe(spark.createDataFrame(rows, "k string, a int, b string").repartition(n), ["k"])
        assert got.columns == ["k", "a", "b"]
        assert got.where("k = 'hot'").collect()[0][1:] == (0, "0")
        assert got.count() == 21
    null_first = spark.createDataFrame([("x", 1), ("x", None)], "k string, a int")
    assert dedupe(null_first, ["k"]).first()["a"] is None


def test_reviews_recipe_turns_bad_values_into_null(spark):
    raw = spark.createDataFrame(
        [
            (" r1 ", "o1 ", " 5", "t ", None, "2018-01-01 00:00:00", "nonsense"),
            ("r2", "o2", "five", "", "", "", "2018-13-01"),
            (None, "o3", "1", "", "", "", ""),
        ],
        "review_id string, order_id string, review_score string, review_comment_title string,"
        " review_comment_message string, review_creation_date string, review_answer_timestamp string",
    )
    rows = {r["review_id"]: r for r in clean(raw, "reviews").collect()}
    assert set(rows) == {"r1", "r2"}
    assert rows["r1"]["review_score"] == 5 and rows["r1"]["review_answer_timestamp"] is None
    assert rows["r1"]["review_comment_title"] == "t"
    assert rows["r2"]["review_score"] is None and rows["r2"]["review_comment_title"] == ""


def test_every_recipe_yields_its_schema(spark):
    for spec in ENTITIES.values():
        empty = spark.createDataFrame([], spec.raw_schema)
        got = clean(empty, spec.name).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in spec.typed_schema]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="customer_state"):
        clean(spark.createDataFrame([("1",)], ["customer_id"]), "customers")
    with pytest.raises(ValueError, match="b"):
        require_columns(spark.createDataFrame([(1,)], ["a"]), ["a", "b"])


def test_expressions(spark):
    df = spark.createDataFrame([("Infinity",), ("nan",), ("x",), ("2",)], "v string")
    assert [r[0] for r in df.select(finite_double("v")).collect()] == [None, None, None, 2.0]
    df = spark.createDataFrame([(30, 0), (31, 2)], "v int, n int")
    rows = df.select(
        band(F.col("v"), [(30, "low")], "high").alias("b"), ratio(F.col("v"), F.col("n")).alias("r")
    ).collect()
    assert [tuple(r) for r in rows] == [("low", 0.0), ("high", 15.5)]
    assert len(FEATURES) == 19 and FEATURES[0] == "order_count_180d"


def test_order_level_does_not_multiply(spark, make_orders):
    orders = make_orders([("1", "a", "2018-01-05 09:00:00"), ("2", "a", "2018-01-06 09:00:00")])
    items = spark.createDataFrame(
        [("1", "p1", "s1", 10.0, 1.0, "x"), ("1", "p2", "s1", 5.0, 1.0, "x"), ("9", "p1", "s1", 7.0, 1.0, "x")],
        "order_id string, product_id string, seller_id string, price double, freight_value double,"
        " category_name string",
    )
    payments = spark.createDataFrame(
        [("1", "card", 2, 9.0), ("1", "voucher", 1, 8.0)],
        "order_id string, payment_type string, payment_installments int, payment_value double",
    )
    rows = {
        r["order_id"]: r
        for r in O.order_level(orders, O.item_rollup(items), O.payment_rollup(payments)).collect()
    }
    assert len(rows) == 2
    assert (rows["1"]["item_count"], rows["1"]["item_revenue"], rows["1"]["payment_value"]) == (2, 15.0, 17.0)
    assert (rows["1"]["unique_products_order"], rows["1"]["avg_installments"]) == (2, 1.5)
    assert rows["2"]["item_count"] is None


def test_category_falls_back_to_the_original_name(spark, make_orders):
    products = spark.createDataFrame(
        [("p1", "a"), ("p2", "b"), ("p3", None)], "product_id string, product_category_name string"
    )
    words = spark.createDataFrame(
        [("a", "alpha")], "product_category_name string, product_category_name_english string"
    )
    got = {r[0]: r[1] for r in O.product_categories(products, words).collect()}
    assert got == {"p1": "alpha", "p2": "b", "p3": None}
