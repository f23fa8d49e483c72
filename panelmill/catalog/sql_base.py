"""Building blocks of the checking SQL: the entities and the panel stated literally.

The panel SQL pairs snapshots and purchases with range predicates, which is not
how the operators work; agreement is therefore a real check.
"""

from __future__ import annotations

ENTITIES = """
purchases as (
  select o_orderkey as k, o_custkey, o_totalprice, o_orderpriority,
         case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' when 'P' then 'processing' end as status,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) as ts
  from orders),
e_customers as (
  select cast(c_custkey as varchar) as customer_id, cast(c_custkey - c_custkey % 3 as varchar) as customer_unique_id
  from customer),
e_orders as (
  select cast(k as varchar) as order_id, cast(o_custkey as varchar) as customer_id, status as order_status,
         ts as order_purchase_timestamp,
         case when k % 97 <> 0 then ts + to_days(cast((k * 31) % 45 as integer)) end as order_delivered_customer_date,
         ts + to_days(20) as order_estimated_delivery_date
  from purchases),
e_items as (
  select * exclude (rn) from (
    select cast(l_orderkey as varchar) as order_id, l_linenumber as order_item_id,
           cast(l_partkey as varchar) as product_id, cast(l_suppkey as varchar) as seller_id,
           l_shipdate as shipping_limit_date, l_extendedprice as price, l_extendedprice * l_tax as freight_value,
           row_number() over (partition by l_orderkey, l_linenumber
             order by l_partkey nulls first, l_suppkey nulls first, l_shipdate nulls first,
                      l_extendedprice nulls first, l_tax nulls first) as rn
    from lineitem) where rn = 1),
e_payments as (
  select cast(k as varchar) as order_id, n as payment_sequential,
         case when n = 1 then lower(o_orderpriority) else 'voucher' end as payment_type,
         cast(k % 12 + 1 as integer) as payment_installments, o_totalprice / (1 + k % 2) as payment_value
  from purchases, lateral (select unnest(generate_series(1, 1 + k % 2)) as n)),
e_reviews as (
  select cast(k as varchar) as review_id, cast(k as varchar) as order_id, cast(k % 5 + 1 as integer) as review_score
  from purchases where k % 10 <> 0),
e_products as (
  select cast(p_partkey as varchar) as product_id, lower(p_type) as product_category_name from part),
e_translation as (
  select distinct lower(p_type) as product_category_name, 'english ' || lower(p_type) as product_category_name_english
  from part where lower(p_type) <> 'promo'),
completed as (
  select order_id, customer_unique_id, order_purchase_timestamp, order_delivered_customer_date,
         order_estimated_delivery_date
  from e_orders join e_customers using (customer_id)
  where order_status = 'delivered' and order_purchase_timestamp is not null),
items_cat as (
  select i.*, coalesce(t.product_category_name_english, p.product_category_name) as category_name
  from e_items i left join e_products p using (product_id)
       left join e_translation t using (product_category_name)),
item_roll as (
  select order_id, count(*) as item_count, sum(price) as item_revenue, sum(freight_value) as freight_value,
         count(distinct product_id) as unique_products_order, count(distinct seller_id) as unique_sellers_order,
         count(distinct category_name) as unique_categories_order
  from items_cat group by order_id),
payment_roll as (
  select order_id, sum(payment_value) as payment_value, avg(payment_installments) as avg_installments,
         count(distinct payment_type) as payment_type_count
  from e_payments group by order_id),
review_roll as (
  select order_id, avg(review_score) as review_score, count(*) as review_count from e_reviews group by order_id),
delayed as (
  select *, case when order_delivered_customer_date is not null and order_estimated_delivery_date is not null
                 then date_diff('day', cast(order_estimated_delivery_date as date),
                                cast(order_delivered_customer_date as date)) end as delivery_delay_days
  from completed),
level as (
  select * from delayed left join item_roll using (order_id) left join payment_roll using (order_id)
                        left join review_roll using (order_id)),
details as (
  select i.order_id, c.customer_unique_id, c.order_purchase_timestamp, i.product_id, i.seller_id, i.category_name
  from items_cat i join completed c using (order_id)),
data_range as (
  select cast(min(order_purchase_timestamp) as date) as first_date,
         cast(max(order_purchase_timestamp) as date) as last_date,
         cast(cast(max(order_purchase_timestamp) as date) - interval 90 day as date) as max_valid_date
  from completed)
"""

PANEL_DENSE = """
cal as (
  select last_day(cast(m as date)) as observation_date
  from data_range, lateral (select unnest(generate_series(date_trunc('month', first_date),
                                                          cast(max_valid_date as timestamp), interval 1 month)) as m)
  where last_day(cast(m as date)) <= max_valid_date),
firsts as (
  select customer_unique_id, min(order_purchase_timestamp) as first_ts from completed group by 1),
panel as (
  select customer_unique_id, observation_date from firsts cross join cal
  where observation_date >= last_day(cast(first_ts as date)))
"""

PANEL_PURCHASE = """
panel as (
  select distinct customer_unique_id, last_day(cast(order_purchase_timestamp as date)) as observation_date
  from completed)
"""

LABEL_V3 = """
future as (
  select p.customer_unique_id, p.observation_date, count(distinct o.order_id) as future_orders_90d
  from panel p left join completed o
    on p.customer_unique_id = o.customer_unique_id
   and o.order_purchase_timestamp > cast(p.observation_date as timestamp)
   and o.order_purchase_timestamp <= cast(p.observation_date as timestamp) + interval 90 day
  group by 1, 2)
"""

FEATURES_V3 = """
hist as (
  select p.customer_unique_id, p.observation_date,
         count(distinct o.order_id) as order_count_180d,
         coalesce(sum(item_revenue), 0) as revenue_180d, coalesce(sum(payment_value), 0) as payment_value_180d,
         coalesce(sum(freight_value), 0) as freight_value_180d,
         cast(coalesce(sum(item_count), 0) as bigint) as item_count_180d,
         coalesce(avg(payment_type_count), 0) as avg_payment_type_count_180d,
         coalesce(avg(avg_installments), 0) as avg_installments_180d,
         coalesce(avg(review_score), 0) as avg_review_score_180d, count(review_score) as review_count_180d,
         coalesce(avg(delivery_delay_days), 0) as avg_delivery_delay_180d,
         coalesce(avg(case when delivery_delay_days > 0 then 1.0 else 0.0 end), 0) as late_delivery_rate_180d,
         max(order_purchase_timestamp) as last_ts, min(order_purchase_timestamp) as first_ts
  from panel p left join level o
    on p.customer_unique_id = o.customer_unique_id
   and o.order_purchase_timestamp > cast(p.observation_date as timestamp) - interval 180 day
   and o.order_purchase_timestamp <= cast(p.observation_date as timestamp)
  group by 1, 2),
hist_items as (
  select p.customer_unique_id, p.observation_date, count(distinct product_id) as unique_products_180d,
         count(distinct category_name) as unique_categories_180d, count(distinct seller_id) as unique_sellers_180d
  from panel p left join details o
    on p.customer_unique_id = o.customer_unique_id
   and o.order_purchase_timestamp > cast(p.observation_date as timestamp) - interval 180 day
   and o.order_purchase_timestamp <= cast(p.observation_date as timestamp)
  group by 1, 2)
"""

# measures of an order before its review or delivery: those of an order without one
FEATURES_STRICT = FEATURES_V3
for _measure, _time in {
    "avg(review_score)": "o.order_purchase_timestamp + interval 25 day",
    "count(review_score)": "o.order_purchase_timestamp + interval 25 day",
    "avg(delivery_delay_days)": "o.order_delivered_customer_date",
}.items():
    _name, _value = _measure.rstrip(")").split("(")
    _known = f"case when {_time} <= cast(p.observation_date as timestamp) then {_value} end"
    FEATURES_STRICT = FEATURES_STRICT.replace(_measure, f"{_name}({_known})")
FEATURES_STRICT = FEATURES_STRICT.replace(
    "case when delivery_delay_days > 0 then",
    "case when delivery_delay_days > 0 and o.order_delivered_customer_date <= cast(p.observation_date as timestamp) then",
)

LEVEL_ZERO = """
level0 as (
  select order_id, customer_unique_id, order_purchase_timestamp,
         coalesce(delivery_delay_days, 0) as delivery_delay_days,
         case when delivery_delay_days > 0 then 1 else 0 end as is_late,
         coalesce(item_count, 0) as item_count, coalesce(item_revenue, 0) as item_revenue,
         coalesce(freight_value, 0) as freight_value,
         coalesce(unique_products_order, 0) as unique_products_order,
         coalesce(unique_sellers_order, 0) as unique_sellers_order,
         coalesce(unique_categories_order, 0) as unique_categories_order,
         coalesce(payment_value, 0) as payment_value, coalesce(avg_installments, 0) as avg_installments,
         coalesce(payment_type_count, 0) as payment_type_count, coalesce(review_score, 0) as review_score,
         coalesce(review_count, 0) as review_count
  from level)
"""

# lower bound inclusive, zero-filled means, sum of reviews
FEATURES_V12 = """
hist as (
  select p.customer_unique_id, p.observation_date,
         count(distinct o.order_id) as order_count_180d,
         coalesce(sum(item_revenue), 0) as revenue_180d, coalesce(sum(payment_value), 0) as payment_value_180d,
         coalesce(sum(freight_value), 0) as freight_value_180d,
         cast(coalesce(sum(item_count), 0) as bigint) as item_count_180d,
         count(distinct unique_products_order) as distinct_product_baskets_180d,
         coalesce(avg(unique_products_order), 0) as avg_products_per_order_180d,
         coalesce(avg(unique_categories_order), 0) as avg_categories_per_order_180d,
         coalesce(avg(unique_sellers_order), 0) as avg_sellers_per_order_180d,
         coalesce(avg(payment_type_count), 0) as avg_payment_type_count_180d,
         coalesce(avg(avg_installments), 0) as avg_installments_180d,
         coalesce(avg(review_score), 0) as avg_review_score_180d,
         cast(coalesce(sum(review_count), 0) as bigint) as review_count_180d,
         coalesce(avg(delivery_delay_days), 0) as avg_delivery_delay_180d,
         coalesce(avg(is_late), 0) as late_delivery_rate_180d,
         max(order_purchase_timestamp) as last_ts, min(order_purchase_timestamp) as first_ts
  from panel p left join level0 o
    on p.customer_unique_id = o.customer_unique_id
   and o.order_purchase_timestamp >= cast(p.observation_date as timestamp) - interval 180 day
   and o.order_purchase_timestamp <= cast(p.observation_date as timestamp)
  group by 1, 2),
hist_items as (
  select p.customer_unique_id, p.observation_date, count(distinct product_id) as unique_products_180d,
         count(distinct category_name) as unique_categories_180d, count(distinct seller_id) as unique_sellers_180d
  from panel p left join details o
    on p.customer_unique_id = o.customer_unique_id
   and o.order_purchase_timestamp >= cast(p.observation_date as timestamp) - interval 180 day
   and o.order_purchase_timestamp <= cast(p.observation_date as timestamp)
  group by 1, 2)
"""

LABEL_V12 = """
future as (
  select p.customer_unique_id, p.observation_date, count(o.order_purchase_timestamp) as future_orders_90d
  from panel p left join completed o
    on p.customer_unique_id = o.customer_unique_id
   and o.order_purchase_timestamp > cast(p.observation_date as timestamp)
   and o.order_purchase_timestamp <= cast(p.observation_date as timestamp) + interval 90 day
  group by 1, 2)
"""

GOLD = """
gold as (
  select h.*, i.* exclude (customer_unique_id, observation_date), f.future_orders_90d,
         case when f.future_orders_90d = 0 then 1 else 0 end as churn_90d,
         coalesce(date_diff('day', cast(last_ts as date), h.observation_date), 0) as recency_days,
         coalesce(date_diff('day', cast(first_ts as date), h.observation_date), 0) as customer_lifetime_days,
         case when order_count_180d > 0 then revenue_180d / order_count_180d else 0 end as avg_order_value_180d,
         order_count_180d / 6.0::double as orders_per_month_180d,
         revenue_180d / 6.0::double as revenue_per_month_180d
  from hist h join hist_items i using (customer_unique_id, observation_date)
       join future f using (customer_unique_id, observation_date)
  {where})
"""


def _with(*parts: str) -> str:
    return "with " + ",\n".join(p.strip() for p in parts)


BASE = _with(ENTITIES)
BASE_PANEL_V3 = _with(ENTITIES, PANEL_DENSE)
BASE_PANEL_V2 = _with(ENTITIES, PANEL_PURCHASE)
BASE_LABEL_V3 = _with(ENTITIES, PANEL_DENSE, LABEL_V3)
BASE_LABEL_V2 = _with(ENTITIES, PANEL_PURCHASE, LABEL_V12)
GOLD_V3 = _with(
    ENTITIES, PANEL_DENSE, FEATURES_V3, LABEL_V3, GOLD.format(where="where order_count_180d > 0")
)
GOLD_STRICT = _with(
    ENTITIES, PANEL_DENSE, FEATURES_STRICT, LABEL_V3, GOLD.format(where="where order_count_180d > 0")
)
GOLD_V3_ALL = _with(ENTITIES, PANEL_DENSE, FEATURES_V3, LABEL_V3, GOLD.format(where=""))
GOLD_V2 = _with(ENTITIES, LEVEL_ZERO, PANEL_PURCHASE, FEATURES_V12, LABEL_V12, GOLD.format(where=""))
GOLD_V1 = GOLD_V2

# Output rounding: money has at most four decimals, means get six.
MONEY = ("revenue_180d", "payment_value_180d", "freight_value_180d")
MEANS = (
    "avg_payment_type_count_180d", "avg_installments_180d", "avg_review_score_180d",
    "avg_delivery_delay_180d", "late_delivery_rate_180d", "avg_order_value_180d",
    "orders_per_month_180d", "revenue_per_month_180d", "avg_products_per_order_180d",
    "avg_categories_per_order_180d", "avg_sellers_per_order_180d",
)
INTS = ("recency_days", "customer_lifetime_days", "churn_90d")


def shown(column: str) -> str:
    """How a gold column is printed in both engines."""
    if column == "observation_date":
        return "cast(observation_date as varchar) as observation_date"
    if column in MONEY:
        return f"round(cast({column} as double), 4) as {column}"
    if column in MEANS:
        return f"round(cast({column} as double), 6) as {column}"
    if column in INTS:
        return f"cast({column} as integer) as {column}"
    return column
