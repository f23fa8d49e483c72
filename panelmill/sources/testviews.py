"""The nine entities as views over the supplied test tables.

``typed_tables`` gives clean tables; ``raw_tables`` gives text columns with the
dirt the cleaning recipes exist for: padding, mixed case, malformed values,
missing and repeated keys, headers with spaces and hyphens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.operators.cleaning import dedupe

PURCHASE = "cast(o_orderdate as timestamp) + make_dt_interval(0, 0, 0, (o_orderkey * 7919) % 86400)"
STATUS = (
    "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' when 'P' then 'processing' end"
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as k", "o_custkey", f"{STATUS} as status", f"{PURCHASE} as ts",
        "o_totalprice", "o_orderpriority",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) as customer_id",
        "cast(c_custkey - c_custkey % 3 as string) as customer_unique_id",  # a person has up to three ids
        "c_nationkey * 1000 + 7 as customer_zip_code_prefix",
        "lower(c_name) as customer_city",
        "upper(c_mktsegment) as customer_state",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _purchases(spark, sf_dir).selectExpr(
        "cast(k as string) as order_id",
        "cast(o_custkey as string) as customer_id",
        "status as order_status",
        "ts as order_purchase_timestamp",
        "ts + make_dt_interval(0, 1, 0, 0) as order_approved_at",
        "ts + make_dt_interval(2, 0, 0, 0) as order_delivered_carrier_date",
        "case when k % 97 <> 0 then ts + make_dt_interval(cast((k * 31) % 45 as int), 0, 0, 0) end"
        " as order_delivered_customer_date",
        "ts + make_dt_interval(20, 0, 0, 0) as order_estimated_delivery_date",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_tax"
    )
    # numbers compare faster than the text ids made of them
    return dedupe(lines, ("l_orderkey", "l_linenumber")).selectExpr(
        "cast(l_orderkey as string) as order_id",
        "l_linenumber as order_item_id",
        "cast(l_partkey as string) as product_id",
        "cast(l_suppkey as string) as seller_id",
        "cast(l_shipdate as timestamp) as shipping_limit_date",
        "l_extendedprice as price",
        "l_extendedprice * l_tax as freight_value",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _purchases(spark, sf_dir)
        .select("*", F.explode(F.expr("sequence(1, 1 + cast(k % 2 as int))")).alias("n"))
        .selectExpr(
            "cast(k as string) as order_id",
            "n as payment_sequential",
            "case when n = 1 then lower(o_orderpriority) else 'voucher' end as payment_type",
            "cast(k % 12 + 1 as int) as payment_installments",
            "o_totalprice / (1 + k % 2) as payment_value",
        )
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _purchases(spark, sf_dir)
        .where("k % 10 <> 0")
        .selectExpr(
            "cast(k as string) as review_id",
            "cast(k as string) as order_id",
            "cast(k % 5 + 1 as int) as review_score",
            "cast(null as string) as review_comment_title",
            "cast(null as string) as review_comment_message",
            "ts + make_dt_interval(25, 0, 0, 0) as review_creation_date",
            "ts + make_dt_interval(26, 0, 0, 0) as review_answer_timestamp",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as product_id",
        "lower(p_type) as product_category_name",
        "cast(length(p_name) as double) as product_name_lenght",
        "cast(length(p_brand) as double) as product_description_lenght",
        "cast(p_size % 5 as double) as product_photos_qty",
        "p_retailprice as product_weight_g",
        "cast(p_size as double) as product_length_cm",
        "cast(p_size + 1 as double) as product_height_cm",
        "cast(p_size + 2 as double) as product_width_cm",
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    return (
        read_table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .selectExpr(
            "cast(s_suppkey as string) as seller_id",
            "s_nationkey * 1000 + 7 as seller_zip_code_prefix",
            "lower(s_name) as seller_city",
            "upper(n_name) as seller_state",
        )
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(
        "c_nationkey * 1000 + 7 as geolocation_zip_code_prefix",
        "c_acctbal / 128 as geolocation_lat",
        "c_acctbal / 256 as geolocation_lng",
        "lower(c_name) as geolocation_city",
        "upper(c_mktsegment) as geolocation_state",
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one kind has no translation, so the fallback is used
    names = read_table(spark, sf_dir, "part").selectExpr("lower(p_type) as product_category_name").distinct()
    return names.where("product_category_name <> 'promo'").selectExpr(
        "product_category_name", "concat('english ', product_category_name) as product_category_name_english"
    )


TYPED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        customers, orders, order_items, payments, reviews, products, sellers, geolocation, category_translation,
    )
}


class Tables(Mapping[str, DataFrame]):
    """Entities by name, each built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, builders=TYPED):
        self._spark, self._dir, self._builders = spark, sf_dir, builders

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name](self._spark, self._dir)

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def typed_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def _repeated(df: DataFrame, key: str, every: int) -> DataFrame:
    """Every n-th key twice; the copy is told apart by ``dup``."""
    return df.select("*", F.explode(F.expr(f"sequence(0, if({key} % {every} = 0, 1, 0))")).alias("dup"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _repeated(read_table(spark, sf_dir, "customer"), "c_custkey", 10)
    return base.selectExpr(
        "case when c_custkey % 97 <> 0 then concat(' ', c_custkey, ' ') end as `Customer-ID`",
        "concat(c_custkey, '  ') as customer_unique_id",
        "case when c_custkey % 13 = 0 then 'n/a' else cast(c_nationkey * 1000 + 7 as string) end"
        " as `Customer Zip-Code Prefix`",
        "concat(' ', c_name, ' ', dup) as ` customer_city`",
        "concat(lower(c_mktsegment), ' ') as CUSTOMER_STATE",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _repeated(_purchases(spark, sf_dir), "k", 20)
    return base.selectExpr(
        "case when k % 101 <> 0 then concat(k, ' ') end as order_id",
        "concat(' ', o_custkey) as customer_id",
        "concat(' ', upper(status)) as order_status",
        "case when k % 89 = 0 then 'not a time' else cast(ts as string) end as order_purchase_timestamp",
        "case when k % 7 = 0 then '' else cast(ts + make_dt_interval(0, 1 + dup, 0, 0) as string) end"
        " as order_approved_at",
        "cast(ts + make_dt_interval(2, 0, 0, 0) as string) as order_delivered_carrier_date",
        "case when k % 97 <> 0 then"
        " cast(ts + make_dt_interval(cast((k * 31) % 45 as int), 0, 0, 0) as string) end"
        " as order_delivered_customer_date",
        "cast(ts + make_dt_interval(20, 0, 0, 0) as string) as order_estimated_delivery_date",
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").selectExpr(
        "case when l_orderkey % 211 <> 0 then concat(' ', l_orderkey) end as order_id",
        "cast(l_linenumber as string) as order_item_id",
        "concat(l_partkey, ' ') as product_id",
        "concat(' ', l_suppkey) as seller_id",
        "cast(cast(l_shipdate as timestamp) as string) as shipping_limit_date",
        "case when l_partkey % 17 = 0 then 'free' else cast(l_extendedprice as string) end as price",
        "cast(l_tax as string) as freight_value",
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _repeated(_purchases(spark, sf_dir), "k", 3)
    return base.selectExpr(
        "case when k % 103 <> 0 then concat(' ', k) end as order_id",
        "'1' as payment_sequential",
        "concat(o_orderpriority, ' ') as payment_type",
        "case when k % 11 = 0 then '1.5x' else cast(k % 12 + 1 + dup as string) end as payment_installments",
        "cast(o_totalprice as string) as payment_value",
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _repeated(_purchases(spark, sf_dir).where("k % 10 <> 0"), "k", 9)
    return base.selectExpr(
        "case when k % 107 <> 0 then concat(' ', k) end as review_id",
        "concat(k, ' ') as order_id",
        "case when k % 19 = 0 then 'great' else concat(' ', k % 5 + 1) end as review_score",
        "concat(' Title ', k % 3, ' ') as review_comment_title",
        "case when k % 4 = 0 then null else concat('Body ', dup) end as review_comment_message",
        "case when k % 23 = 0 then '31/12/1999' else cast(ts + make_dt_interval(25, 0, 0, 0) as string) end"
        " as review_creation_date",
        "cast(ts + make_dt_interval(26, 0, 0, 0) as string) as review_answer_timestamp",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _repeated(read_table(spark, sf_dir, "part"), "p_partkey", 6)
    return base.selectExpr(
        "case when p_partkey % 109 <> 0 then concat(' ', p_partkey) end as product_id",
        "case when p_partkey % 8 = 0 then null else concat(' ', p_type) end as product_category_name",
        "cast(length(p_name) + dup as string) as product_name_lenght",
        "case when p_partkey % 5 = 0 then '?' else cast(length(p_brand) as string) end"
        " as product_description_lenght",
        "cast(p_size % 5 as string) as product_photos_qty",
        "cast(p_retailprice as string) as product_weight_g",
        "cast(p_size as string) as product_length_cm",
        "cast(p_size + 1 as string) as product_height_cm",
        "cast(p_size + 2 as string) as product_width_cm",
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _repeated(read_table(spark, sf_dir, "supplier"), "s_suppkey", 4)
    return base.selectExpr(
        "case when s_suppkey % 31 <> 0 then concat(' ', s_suppkey) end as seller_id",
        "case when s_suppkey % 9 = 0 then 'zip' else cast(s_nationkey * 1000 + dup as string) end"
        " as seller_zip_code_prefix",
        "concat(' ', s_name) as seller_city",
        "concat('st', s_nationkey, ' ') as seller_state",
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _repeated(read_table(spark, sf_dir, "customer"), "c_custkey", 10)
    return base.selectExpr(
        "case when c_custkey % 13 = 0 then 'n/a' else cast(c_nationkey * 1000 + 7 as string) end"
        " as geolocation_zip_code_prefix",
        "case when c_custkey % 6 = 0 then '--' else cast(c_acctbal / 128 as string) end as geolocation_lat",
        "cast(c_acctbal / 256 as string) as geolocation_lng",
        "concat(' ', c_name) as geolocation_city",
        "concat(lower(c_mktsegment), ' ') as geolocation_state",
    )


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read_table(spark, sf_dir, "part")
        .selectExpr(
            "case when p_partkey % 10 <> 0 then concat(' ', p_type, ' ') end as `Product-Category Name`",
            "concat('English ', p_type, ' ', p_size) as product_category_name_english",
        )
    )


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__.removeprefix("raw_"): f
    for f in (
        raw_customers, raw_orders, raw_order_items, raw_payments, raw_reviews, raw_products, raw_sellers,
        raw_geolocation, raw_category_translation,
    )
}


def raw_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir, RAW)
