"""Entity schemas, keys and the ordered feature list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class EntitySpec:
    """How one raw table becomes a typed table.

    ``columns`` maps each column to a cleaning rule: ``id`` and ``text`` trim,
    ``lower`` and ``upper`` trim and fold case, ``int`` / ``double`` /
    ``timestamp`` cast safely (a bad value becomes NULL).
    """

    name: str
    columns: dict[str, str]
    required: tuple[str, ...] = ()
    key: tuple[str, ...] = ()

    @property
    def raw_schema(self) -> T.StructType:
        """Text columns: one pass, no inference, nothing lost before cleaning."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, RULE_TYPES[rule]) for c, rule in self.columns.items()])


RULE_TYPES: dict[str, T.DataType] = {
    "id": T.StringType(),
    "text": T.StringType(),
    "lower": T.StringType(),
    "upper": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}

# Column names, types and keys of the nine entities.
ENTITIES: dict[str, EntitySpec] = {
    e.name: e
    for e in (
        EntitySpec(
            "customers",
            {
                "customer_id": "id",
                "customer_unique_id": "id",
                "customer_zip_code_prefix": "int",
                "customer_city": "lower",
                "customer_state": "upper",
            },
            required=("customer_id",),
            key=("customer_id",),
        ),
        EntitySpec(
            "orders",
            {
                "order_id": "id",
                "customer_id": "id",
                "order_status": "lower",
                "order_purchase_timestamp": "timestamp",
                "order_approved_at": "timestamp",
                "order_delivered_carrier_date": "timestamp",
                "order_delivered_customer_date": "timestamp",
                "order_estimated_delivery_date": "timestamp",
            },
            required=("order_id",),
            key=("order_id",),
        ),
        EntitySpec(
            "order_items",
            {
                "order_id": "id",
                "order_item_id": "int",
                "product_id": "id",
                "seller_id": "id",
                "shipping_limit_date": "timestamp",
                "price": "double",
                "freight_value": "double",
            },
            required=("order_id",),
            key=("order_id", "order_item_id"),
        ),
        EntitySpec(
            "payments",
            {
                "order_id": "id",
                "payment_sequential": "int",
                "payment_type": "lower",
                "payment_installments": "int",
                "payment_value": "double",
            },
            required=("order_id",),
            key=("order_id", "payment_sequential"),
        ),
        EntitySpec(
            "reviews",
            {
                "review_id": "id",
                "order_id": "id",
                "review_score": "int",
                "review_comment_title": "text",
                "review_comment_message": "text",
                "review_creation_date": "timestamp",
                "review_answer_timestamp": "timestamp",
            },
            required=("review_id",),
            key=("review_id",),
        ),
        EntitySpec(
            "products",
            {
                "product_id": "id",
                "product_category_name": "lower",
                "product_name_lenght": "double",
                "product_description_lenght": "double",
                "product_photos_qty": "double",
                "product_weight_g": "double",
                "product_length_cm": "double",
                "product_height_cm": "double",
                "product_width_cm": "double",
            },
            required=("product_id",),
            key=("product_id",),
        ),
        EntitySpec(
            "sellers",
            {
                "seller_id": "id",
                "seller_zip_code_prefix": "int",
                "seller_city": "lower",
                "seller_state": "upper",
            },
            required=("seller_id",),
            key=("seller_id",),
        ),
        EntitySpec(
            "geolocation",
            {
                "geolocation_zip_code_prefix": "int",
                "geolocation_lat": "double",
                "geolocation_lng": "double",
                "geolocation_city": "lower",
                "geolocation_state": "upper",
            },
        ),
        EntitySpec(
            "category_translation",
            {
                "product_category_name": "lower",
                "product_category_name_english": "lower",
            },
            required=("product_category_name",),
            key=("product_category_name",),
        ),
    )
}

CUSTOMER = "customer_unique_id"
SNAPSHOT = "observation_date"
TARGET = "churn_90d"
SPLIT = "dataset_split"

# The nineteen model columns; their order is the order of the feature vector.
FEATURES: tuple[str, ...] = (
    "order_count_180d",
    "revenue_180d",
    "payment_value_180d",
    "freight_value_180d",
    "item_count_180d",
    "avg_payment_type_count_180d",
    "avg_installments_180d",
    "avg_review_score_180d",
    "review_count_180d",
    "avg_delivery_delay_180d",
    "late_delivery_rate_180d",
    "unique_products_180d",
    "unique_categories_180d",
    "unique_sellers_180d",
    "recency_days",
    "customer_lifetime_days",
    "avg_order_value_180d",
    "orders_per_month_180d",
    "revenue_per_month_180d",
)

# Columns that must never reach a model.
FUTURE_COLUMNS: tuple[str, ...] = (
    "future_orders_90d",
    "last_purchase_timestamp",
    "first_purchase_timestamp_180d",
)
ID_COLUMNS: tuple[str, ...] = (CUSTOMER,)
TIME_COLUMNS: tuple[str, ...] = (SNAPSHOT, "observation_month", "observation_year")

# Row constraints of a scoring request (lower bound, upper bound).
FEATURE_BOUNDS: dict[str, tuple[float | None, float | None]] = {
    f: (None, None)
    if f == "avg_delivery_delay_180d"
    else (0.0, 1.0)
    if f == "late_delivery_rate_180d"
    else (0.0, None)
    for f in FEATURES
}

# Decision threshold and risk bands (exclusive upper edge, label), last label open.
SCORE_THRESHOLD = 0.20
RISK_BANDS: tuple[tuple[float, str], ...] = ((0.40, "Low"), (0.70, "Medium"))
TOP_RISK_BAND = "High"
