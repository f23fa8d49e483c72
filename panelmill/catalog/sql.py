"""Checking SQL for the named queries, in plain ANSI style as DuckDB runs it."""

from __future__ import annotations

from panelmill.catalog.sql_base import (
    BASE,
    BASE_LABEL_V2,
    BASE_LABEL_V3,
    BASE_PANEL_V2,
    BASE_PANEL_V3,
    GOLD_STRICT,
    GOLD_V1,
    GOLD_V2,
    GOLD_V3,
    GOLD_V3_ALL,
    shown,
)

# Fixed values, stated here on their own: what the queries must return doesn't come from the code under test.
FEATURES = """order_count_180d revenue_180d payment_value_180d freight_value_180d item_count_180d
    avg_payment_type_count_180d avg_installments_180d avg_review_score_180d review_count_180d
    avg_delivery_delay_180d late_delivery_rate_180d unique_products_180d unique_categories_180d
    unique_sellers_180d recency_days customer_lifetime_days avg_order_value_180d orders_per_month_180d
    revenue_per_month_180d""".split()
CORE_FEATURES = """order_count_180d revenue_180d payment_value_180d freight_value_180d item_count_180d
    unique_products_180d unique_categories_180d unique_sellers_180d recency_days customer_lifetime_days
    avg_order_value_180d orders_per_month_180d revenue_per_month_180d""".split()
DIVERSITY = "unique_products_180d unique_categories_180d unique_sellers_180d".split()
DESCRIBED = """order_count_180d item_count_180d unique_products_180d unique_categories_180d unique_sellers_180d
    payment_value_180d revenue_180d recency_days customer_lifetime_days churn_90d""".split()
SHORT_SUMMARY = "order_count_180d revenue_180d recency_days avg_order_value_180d late_delivery_rate_180d".split()
SAMPLE_COLUMNS = """customer_unique_id observation_date order_count_180d revenue_180d payment_value_180d
    item_count_180d unique_products_180d unique_categories_180d unique_sellers_180d recency_days
    customer_lifetime_days churn_90d""".split()
LINE_MEASURES = "l_quantity l_extendedprice l_discount l_tax".split()
_ENDS = ["future_orders_90d", "churn_90d"]
GOLD_COLUMNS = {
    "v1": ["customer_unique_id", "observation_date", *[f for f in FEATURES if f not in DIVERSITY],
           "distinct_product_baskets_180d", "avg_products_per_order_180d", "avg_categories_per_order_180d",
           "avg_sellers_per_order_180d", *_ENDS],
    "v2": ["customer_unique_id", "observation_date", *FEATURES, *_ENDS],
    "v3": ["customer_unique_id", "observation_date", *FEATURES, *_ENDS],
}

GOLDS = {"v1": GOLD_V1, "v2": GOLD_V2, "v3": GOLD_V3}


def select_gold(base: str, columns) -> str:
    return f"{base} select {', '.join(shown(c) for c in columns)} from gold"


def stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


# ---- raw tables with dirt ----------------------------------------------------------------

PURCHASES = """
purchases as (
  select o_orderkey as k, o_custkey, o_totalprice, o_orderpriority,
         case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' when 'P' then 'processing' end as status,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) as ts
  from orders)
"""


def repeated(table: str, key: str, every: int, where: str = "") -> str:
    return (
        f"(select *, 0 as dup from {table} {where} union all "
        f"select *, 1 as dup from {table} {where} {'and' if where else 'where'} {key} % {every} = 0)"
    )


RAW = {
    "customers": f"""raw as (
  select case when c_custkey % 97 <> 0 then cast(c_custkey as varchar) end as customer_id,
         cast(c_custkey as varchar) as customer_unique_id,
         case when c_custkey % 13 <> 0 then c_nationkey * 1000 + 7 end as customer_zip_code_prefix,
         lower(c_name || ' ' || dup) as customer_city, upper(c_mktsegment) as customer_state
  from {repeated("customer", "c_custkey", 10)})""",
    "orders": f"""raw as (
  select case when k % 101 <> 0 then cast(k as varchar) end as order_id, cast(o_custkey as varchar) as customer_id,
         status as order_status, case when k % 89 <> 0 then ts end as order_purchase_timestamp,
         case when k % 7 <> 0 then ts + to_hours(1 + dup) end as order_approved_at,
         ts + to_days(2) as order_delivered_carrier_date,
         case when k % 97 <> 0 then ts + to_days(cast((k * 31) % 45 as integer)) end as order_delivered_customer_date,
         ts + to_days(20) as order_estimated_delivery_date
  from {repeated("purchases", "k", 20)})""",
    "order_items": """raw as (
  select case when l_orderkey % 211 <> 0 then cast(l_orderkey as varchar) end as order_id,
         l_linenumber as order_item_id, cast(l_partkey as varchar) as product_id,
         cast(l_suppkey as varchar) as seller_id, l_shipdate as shipping_limit_date,
         case when l_partkey % 17 <> 0 then l_extendedprice end as price, l_tax as freight_value
  from lineitem)""",
    "payments": f"""raw as (
  select case when k % 103 <> 0 then cast(k as varchar) end as order_id, 1 as payment_sequential,
         lower(o_orderpriority) as payment_type,
         cast(case when k % 11 <> 0 then k % 12 + 1 + dup end as integer) as payment_installments,
         o_totalprice as payment_value
  from {repeated("purchases", "k", 3)})""",
    "reviews": f"""raw as (
  select case when k % 107 <> 0 then cast(k as varchar) end as review_id, cast(k as varchar) as order_id,
         cast(case when k % 19 <> 0 then k % 5 + 1 end as integer) as review_score,
         'Title ' || (k % 3) as review_comment_title,
         case when k % 4 <> 0 then 'Body ' || dup end as review_comment_message,
         case when k % 23 <> 0 then ts + to_days(25) end as review_creation_date,
         ts + to_days(26) as review_answer_timestamp
  from {repeated("purchases", "k", 9, "where k % 10 <> 0")})""",
    "products": f"""raw as (
  select case when p_partkey % 109 <> 0 then cast(p_partkey as varchar) end as product_id,
         case when p_partkey % 8 <> 0 then lower(p_type) end as product_category_name,
         cast(length(p_name) + dup as double) as product_name_lenght,
         case when p_partkey % 5 <> 0 then cast(length(p_brand) as double) end as product_description_lenght,
         cast(p_size % 5 as double) as product_photos_qty, p_retailprice as product_weight_g,
         cast(p_size as double) as product_length_cm, cast(p_size + 1 as double) as product_height_cm,
         cast(p_size + 2 as double) as product_width_cm
  from {repeated("part", "p_partkey", 6)})""",
    "sellers": f"""raw as (
  select case when s_suppkey % 31 <> 0 then cast(s_suppkey as varchar) end as seller_id,
         cast(case when s_suppkey % 9 <> 0 then s_nationkey * 1000 + dup end as integer) as seller_zip_code_prefix,
         lower(s_name) as seller_city, upper('st' || s_nationkey) as seller_state
  from {repeated("supplier", "s_suppkey", 4)})""",
    "geolocation": f"""raw as (
  select case when c_custkey % 13 <> 0 then c_nationkey * 1000 + 7 end as geolocation_zip_code_prefix,
         case when c_custkey % 6 <> 0 then c_acctbal / 128 end as geolocation_lat,
         c_acctbal / 256 as geolocation_lng, lower(c_name) as geolocation_city,
         upper(c_mktsegment) as geolocation_state
  from {repeated("customer", "c_custkey", 10)})""",
    "category_translation": """raw as (
  select case when p_partkey % 10 <> 0 then lower(p_type) end as product_category_name,
         lower('English ' || p_type || ' ' || p_size) as product_category_name_english
  from part)""",
}

KEYS = {
    "customers": ["customer_id"], "orders": ["order_id"], "order_items": ["order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"], "reviews": ["review_id"], "products": ["product_id"],
    "sellers": ["seller_id"], "geolocation": [], "category_translation": ["product_category_name"],
}

COLUMNS = {
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at"
    " order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "reviews": "review_id order_id review_score review_comment_title review_comment_message"
    " review_creation_date review_answer_timestamp",
    "products": "product_id product_category_name product_name_lenght product_description_lenght"
    " product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state",
    "category_translation": "product_category_name product_category_name_english",
}

TIMES = {
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date", "shipping_limit_date",
    "review_creation_date", "review_answer_timestamp",
}


def cleaned(entity: str) -> str:
    """CTEs up to ``cleaned``: keyed rows, the smallest of each key."""
    key, columns = KEYS[entity], COLUMNS[entity].split()
    head = "with " + PURCHASES.strip() + ",\n" + RAW[entity].strip()
    if not key:
        return f"{head},\ncleaned as (select * from raw)"
    rest = ", ".join(f"{c} nulls first" for c in columns if c not in key)
    return (
        f"{head},\ncleaned as (select * exclude (rn) from (select *, row_number() over "
        f"(partition by {', '.join(key)} order by {rest}) as rn from raw where {key[0]} is not null) where rn = 1)"
    )


def clean_sql(entity: str) -> str:
    out = ", ".join(f"{stamp(c)} as {c}" if c in TIMES else c for c in COLUMNS[entity].split())
    return f"{cleaned(entity)} select {out} from cleaned"


def stage_counts() -> str:
    parts = []
    for e in RAW:
        n = len(COLUMNS[e].split())
        parts.append(
            f"select '{e}' as dataset, (select count(*) from raw) as rows, {n} as columns, "
            f"(select count(*) from raw) as verified_rows, {n} as verified_columns, "
            f"(select count(*) from cleaned) as silver_rows"
        )
    return " union all ".join(f"select * from ({cleaned(e)} {p})" for e, p in zip(RAW, parts))


# ---- profiles ----------------------------------------------------------------------------


def per_column(base: str, source: str, columns, stats: str) -> str:
    body = " union all ".join(
        f"select '{c}' as column_name, " + stats.replace("{c}", c) + f" from {source}" for c in columns
    )
    return f"{base} {body}"


def summary_sql(base: str, source: str, columns, quartiles: bool = True) -> str:
    stats = (
        "count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as stddev, "
        "round(min(cast({c} as double)), 6) as min, "
    )
    if quartiles:
        stats += ", ".join(
            f"round(quantile_disc(cast({{c}} as double), {q}), 6) as {n}"
            for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
        )
        stats += ", "
    return per_column(base, source, columns, stats + "round(max(cast({c} as double)), 6) as max")


NULLS = "count(*) - count({c}) as null_count"

# source rows of each raw table, and where a column of it is NULL as written (malformed values aren't)
RAW_ROWS = {
    "customers": (repeated("customer", "c_custkey", 10), {"customer_id": "c_custkey % 97 = 0"}),
    "orders": (repeated("purchases", "k", 20), {
        "order_id": "k % 101 = 0", "order_status": "status is null", "order_delivered_customer_date": "k % 97 = 0",
    }),
    "order_items": ("lineitem", {"order_id": "l_orderkey % 211 = 0"}),
    "payments": (repeated("purchases", "k", 3), {"order_id": "k % 103 = 0"}),
    "reviews": (repeated("purchases", "k", 9, "where k % 10 <> 0"), {
        "review_id": "k % 107 = 0", "review_comment_message": "k % 4 = 0",
    }),
    "products": (repeated("part", "p_partkey", 6), {
        "product_id": "p_partkey % 109 = 0", "product_category_name": "p_partkey % 8 = 0",
    }),
    "sellers": (repeated("supplier", "s_suppkey", 4), {"seller_id": "s_suppkey % 31 = 0"}),
    "geolocation": (repeated("customer", "c_custkey", 10), {}),
    "category_translation": ("part", {"product_category_name": "p_partkey % 10 = 0"}),
}


def raw_profile() -> str:
    return "with " + PURCHASES.strip() + " " + " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, 'string' as data_type, "
        f"count(*) filter ({nulls.get(c, 'false')}) as null_count, count(*) as rows, {len(COLUMNS[t].split())} as columns from {source}"
        for t, (source, nulls) in RAW_ROWS.items()
        for c in COLUMNS[t].split()
    )


# ---- splits ------------------------------------------------------------------------------


def split_ctes(train: float, validation: float, source: str = "gold") -> str:
    return f"""
dates as (select observation_date as d, row_number() over (order by observation_date) as pos,
                 count(*) over () as n
          from (select distinct observation_date from {source})),
cuts as (select count(*) as n_dates,
                max(case when pos <= floor(n * {train}::double) then d end) as train_end,
                min(case when pos > floor(n * {train}::double) then d end) as validation_start,
                max(case when pos <= floor(n * {validation}::double) then d end) as validation_end,
                min(case when pos > floor(n * {validation}::double) then d end) as test_start
         from dates),
split as (select g.*, case when observation_date <= train_end then 'train'
                           when observation_date <= validation_end then 'validation' else 'test' end as dataset_split
          from {source} g cross join cuts)
"""


SPLIT_V3 = f"{GOLD_V3}, {split_ctes(0.60, 0.80)}"
SPLIT_V2 = (
    f"{GOLD_V2}, kept as (select * from gold where observation_date <= "
    "(select cast(max(observation_date) - interval 90 day as date) from gold)), "
    + split_ctes(0.70, 0.85, "kept")
)

# ---- reports -----------------------------------------------------------------------------

LOST = "count(*) filter (churn_90d = 1) as lost"
RATE = "round(avg(churn_90d), 6) as loss_rate, round(avg(churn_90d) * 100, 3) as loss_pct"
OUTCOME = f"count(*) as rows, {LOST}, count(*) filter (churn_90d = 0) as kept, round(avg(churn_90d) * 100, 3) as loss_pct"
RATES = f"count(*) as rows, {LOST}, {RATE}"
PEOPLE = "count(distinct customer_unique_id) as people"
DAY = "cast(observation_date as varchar) as observation_date"
MONTH = "cast(observation_date as varchar) as month"
OVERVIEW = (
    f"select count(*) as rows, {PEOPLE}, cast(min(observation_date) as varchar) as first_day, "
    f"cast(max(observation_date) as varchar) as last_day, {LOST}, count(*) filter (churn_90d = 0) as kept from gold"
)
HISTORY = """(select customer_unique_id, max(order_count_180d) as most_orders, max(customer_lifetime_days) as longest_days,
    count(*) as snapshots from gold group by 1)"""
SNAPSHOT_HISTOGRAM = f"select snapshots, count(*) as rows from {HISTORY} group by 1"


def share(columns: str, digits: int) -> str:
    return (
        f"select *, round(cast(rows as double) / (sum(rows) over ()) * 100, {digits}) as share_pct "
        f"from (select churn_90d as target, {columns} from gold group by 1)"
    )


REPORTS = {
    "report_customer_history": f"{GOLD_V2} select customer_unique_id, most_orders, longest_days, snapshots from {HISTORY}",
    "report_snapshots_per_customer_v2": f"{GOLD_V2} {SNAPSHOT_HISTOGRAM}",
    "report_snapshots_per_customer_v3": f"{GOLD_V3} {SNAPSHOT_HISTOGRAM}",
    "report_repeat_history": f"""{GOLD_V2} select case when snapshots = 1 then 'once' else 'more often' end as seen,
        count(*) as rows from {HISTORY} group by 1""",
    "report_customers_by_max_orders": f"{GOLD_V2} select most_orders, count(*) as rows from {HISTORY} group by 1",
    "report_order_count_profile": f"""{GOLD_V2} select order_count_180d as orders, count(*) as rows,
        round(avg(churn_90d), 6) as loss_rate, round(avg(revenue_180d), 6) as mean_revenue,
        round(avg(recency_days), 6) as mean_recency from gold group by 1""",
    "report_outcome_by_order_count": f"{GOLD_V2} select order_count_180d as orders, {OUTCOME} from gold group by 1",
    "report_outcome_by_order_band": f"""{GOLD_V2} select case when order_count_180d <= 3
        then cast(order_count_180d as varchar) else '4+' end as order_band, {OUTCOME} from gold group by 1""",
    "report_churn_by_recency_wide": f"""{GOLD_V2} select case when recency_days <= 30 then '0-30'
        when recency_days <= 60 then '31-60' when recency_days <= 90 then '61-90'
        when recency_days <= 120 then '91-120' else '120+' end as recency_band_wide, count(*) as rows,
        round(avg(churn_90d) * 100, 3) as loss_pct from gold group by 1""",
    "report_target_share": f"{GOLD_V2} {share('count(*) as rows', 3)}",
    "report_target_share_with_customers": f"{GOLD_V3} {share('count(*) as rows, ' + PEOPLE, 4)}",
    "report_churn_by_order_count": f"{GOLD_V3} select order_count_180d as orders, {RATES} from gold group by 1",
    "report_churn_by_recency": f"""{GOLD_V3} select case when recency_days <= 30 then '0-30'
        when recency_days <= 60 then '31-60' when recency_days <= 90 then '61-90'
        when recency_days <= 120 then '91-120' when recency_days <= 150 then '121-150' else '151-180' end
        as recency_band,
        cast((recency_days > 30)::int + (recency_days > 60)::int + (recency_days > 90)::int
             + (recency_days > 120)::int + (recency_days > 150)::int as integer) as band_number, {RATES}
        from gold group by 1, 2""",
    "report_churn_by_month": f"{GOLD_V3} select {MONTH}, {RATES} from gold group by 1",
    "report_churn_by_customer_type": f"""{GOLD_V3} select case when order_count_180d = 1 then 'once'
        when order_count_180d > 1 then 'again' else 'never' end as buyer, count(*) as rows, {PEOPLE}, {RATE}
        from gold group by 1""",
    "report_order_count_recency_cells": f"""{GOLD_V3} select order_count_180d as orders, cast(recency_days as integer)
        as recency, count(*) as rows, {RATE} from gold group by 1, 2 order by rows desc, orders, recency limit 50""",
    "report_overview_v1": f"{GOLD_V1} {OVERVIEW}",
    "report_overview_v2": f"{GOLD_V2} {OVERVIEW}",
    "report_overview_v3": f"{GOLD_V3} {OVERVIEW}",
    "report_rows_by_month": f"{GOLD_V3} select {MONTH}, count(*) as rows from gold group by 1",
    "report_target_counts": f"{GOLD_V1} select churn_90d as target, count(*) as rows from gold group by 1",
    "report_described_features": summary_sql(GOLD_V2, "gold", DESCRIBED, quartiles=False),
    "report_lifetime_summary": summary_sql(GOLD_V3, "gold", ["customer_lifetime_days"]),
    "report_frequency_summary": summary_sql(GOLD_V3, "gold", ["order_count_180d"]),
    "report_core_feature_summary": summary_sql(GOLD_V3, "gold", CORE_FEATURES),
    "report_diversity_summary": summary_sql(GOLD_V3, "gold", DIVERSITY),
    "report_diversity_summary_v2": summary_sql(GOLD_V2, "gold", DIVERSITY),
    "report_short_summary_v1": summary_sql(GOLD_V1, "gold", SHORT_SUMMARY),
    "report_sample_by_date": f"""{GOLD_V3} select {', '.join(shown(c) for c in SAMPLE_COLUMNS)}
        from (select * from gold order by observation_date, customer_unique_id limit 20)""",
    "report_latest_sample_v1": f"""{GOLD_V1} select {', '.join(shown(c) for c in SAMPLE_COLUMNS if c not in DIVERSITY)}
        from (select * from gold order by observation_date desc, customer_unique_id limit 10)""",
}

# ---- evaluation --------------------------------------------------------------------------

HEURISTIC = "recency_days / 181.0::double * 0.5::double + 0.5::double / (1.0::double + order_count_180d)"
SCORED = f"{GOLD_V3}, scored as (select churn_90d as label, {HEURISTIC} as score from gold)"
CELLS = """
cells as (select score, count(*) filter (label = 1) as pos, count(*) filter (label = 0) as neg
          from {source} group by 1),
ranked as (select *, sum(pos) over w as cum_pos, sum(neg) over w as cum_neg, sum(pos) over () as p, sum(neg) over () as n
           from cells window w as (order by score desc))
"""
RANKING = (
    "round(sum(pos * cast(cum_pos as double) / (cum_pos + cum_neg)) / max(p), 9) as pr_auc, "
    "round(1 - sum(pos * ((cum_neg - neg) + neg / 2.0::double)) / (max(p)::double * max(n)::double), 9) as roc_auc, "
    "round(max(p)::double / (max(p) + max(n))::double, 9) as prevalence, "
    "cast(max(p) as bigint) as positives, cast(max(n) as bigint) as negatives"
)
RANKED = f"{SCORED}, {CELLS.format(source='scored')}"
COUNTS = f"""{SCORED}, counts as (
  select count(*) filter (label = 0 and score < 0.5) as tn, count(*) filter (label = 0 and score >= 0.5) as fp,
         count(*) filter (label = 1 and score < 0.5) as fn, count(*) filter (label = 1 and score >= 0.5) as tp
  from scored)"""


def ratio(a: str, b: str) -> str:
    return f"(case when {b} > 0 then ({a})::double / ({b}) else 0 end)"


P1, R1, F1 = ratio("tp", "tp + fp"), ratio("tp", "tp + fn"), ratio("2 * tp", "2 * tp + fp + fn")
P0, R0, F0 = ratio("tn", "tn + fn"), ratio("tn", "tn + fp"), ratio("2 * tn", "2 * tn + fn + fp")


def report_line(name: str, p: str, r: str, f: str, s: str) -> str:
    return (
        f"select '{name}' as class, round({p}, 9) as precision, round({r}, 9) as recall, round({f}, 9) as f1, "
        f"{s} as support from counts"
    )


def weighted(a: str, b: str) -> str:
    return f"({a} * (tn + fp) + {b} * (tp + fn)) / (tn + fp + tp + fn)"


ACCURACY = "(tp + tn)::double / (tn + fp + tp + fn)"
ALL = "tn + fp + tp + fn"
CLASS_REPORT = " union all ".join(
    [
        report_line("0", P0, R0, F0, "tn + fp"),
        report_line("1", P1, R1, F1, "tp + fn"),
        report_line("accuracy", ACCURACY, ACCURACY, ACCURACY, ALL),
        report_line("macro avg", f"({P0} + {P1}) / 2", f"({R0} + {R1}) / 2", f"({F0} + {F1}) / 2", ALL),
        report_line("weighted avg", weighted(P0, P1), weighted(R0, R1), weighted(F0, F1), ALL),
    ]
)


def sweep_ctes(start: float, count: int) -> str:
    return f"""{SCORED}, grid as (select {start}::double + k * {start}::double as threshold
                                  from range({count}) as t(k)),
swept as (select threshold, count(*) filter (label = 1 and score >= threshold) as tp,
                 count(*) filter (label = 0 and score >= threshold) as fp,
                 count(*) filter (label = 1 and score < threshold) as fn
          from grid cross join scored group by 1)"""


SWEPT = f"round(threshold, 9) as threshold, round({P1}, 9) as precision, round({R1}, 9) as recall, round({F1}, 9) as f1"

CAPACITY = " union all ".join(
    f"""select {f}::double as capacity, cast(k as bigint) as places, round(hits / k, 9) as precision,
               round(hits / p, 9) as recall
        from (select max(floor((p + n) * {f}::double)) as k, max(p) as p,
                     sum(pos * greatest(0, least(pos + neg,
                         floor((p + n) * {f}::double) - (cum_pos + cum_neg - pos - neg))) / (pos + neg)::double) as hits
              from ranked)"""
    for f in (0.01, 0.05, 0.1, 0.2)
)

PREVALENCE = "(select avg(label::double) as v from scored)"
BASELINES = f"""{SCORED} select baseline, round(v, 9) as prevalence, round(v, 9) as pr_auc, 0.5::double as roc_auc,
    round(case when yes then v else 0 end, 9) as precision, (case when yes then 1 else 0 end)::double as recall,
    round(case when yes then 2 * v / (1 + v) else 0 end, 9) as f1,
    (case when yes then 0 else 1 end)::double as specificity
  from (select 'always_positive' as baseline, v, true as yes from {PREVALENCE}
        union all select 'prior', v, v >= 0.5 from {PREVALENCE})"""

BAND = "case when {p} < 0.4::double then 'Low' when {p} < 0.7::double then 'Medium' else 'High' end"
DECIDED = f"""{GOLD_V3}, probs as (select *, {HEURISTIC} as prob from gold),
decided as (select *, round(prob, 6) as churn_probability, cast(prob >= 0.5::double as integer) as churn_prediction,
                   {BAND.format(p="prob")} as risk_band, 0.5::double as threshold from probs)"""

# ---- dirty scoring batch -----------------------------------------------------------------

K = "cast(customer_unique_id as bigint)"
DIRTY = f"""{GOLD_V3}, dirty as (select {K} as k, * from gold)"""
REASONS = {
    "revenue_180d: not a number": "k % 7 = 0",
    "late_delivery_rate_180d: too high": "k % 11 = 0",
    "recency_days: too low": "k % 13 = 0",
    "item_count_180d: missing": "k % 17 = 0",
}


# ---- attribution -------------------------------------------------------------------------


def mean_abs(parts: dict[str, str]) -> str:
    body = " union all ".join(
        f"select '{name}' as feature, avg(abs({e})) as v from gold" for name, e in parts.items()
    )
    return f"{GOLD_V3}, attr as ({body}), shares as (select feature, v as mean_abs_value, v / sum(v) over () * 100 as importance_pct from attr)"


PLAIN = {c: c for c in FEATURES}
MINUS_ONE = {c: f"{c} - 1" for c in FEATURES}
RULE = {c: f"{(-1) ** i / (i + 2)!r}::double * ({c} - {float(i)!r}::double)" for i, c in enumerate(FEATURES)}
ROUND_SHARES = "round(mean_abs_value, 6) as mean_abs_value, round(importance_pct, 6) as importance_pct"

LEVEL_COLUMNS = """order_id, customer_unique_id, cast(delivery_delay_days as integer) as delivery_delay_days, {late} as is_late,
  item_count, round(item_revenue, 4) as item_revenue, round(freight_value, 4) as freight_value,
  round(payment_value, 4) as payment_value, round(avg_installments, 6) as avg_installments, payment_type_count,
  round(review_score, 6) as review_score, review_count"""

SQL: dict[str, str] = {
    "csv_bronze_silver": stage_counts(),
    "gold_partition_read": f"""{GOLD_V3} select cast(year(observation_date) as integer) as observation_year,
        count(*) as rows, nullif(count(*) filter (year(observation_date) = 1999), 0) as pruned_rows,
        cast(sum(churn_90d) filter (year(observation_date) = 1999) as bigint) as pruned_lost from gold group by 1""",
    "gold_month_partitions": f"""{GOLD_V2} select cast(year(observation_date) as integer) as observation_year,
        cast(month(observation_date) as integer) as observation_month, count(*) as rows from gold group by 1, 2""",
    "dataset_date_partitions": f"{SPLIT_V3} select {MONTH}, {RATES} from split group by 1",
    "dataset_partition_read": f"{SPLIT_V3} select {MONTH}, {RATES} from split where dataset_split = 'test' group by 1",
    "scored_csv_roundtrip": f"""{DECIDED} select customer_unique_id, {DAY}, order_count_180d::double as order_count_180d,
        churn_probability, churn_prediction, risk_band from decided""",
    "csv_malformed": """select count(*) as rows, count(*) filter (o_orderkey % 10 in (0, 1, 2)) as malformed,
        count(*) filter (o_orderkey % 10 <> 2) as order_keys,
        cast(sum(o_custkey) filter (o_orderkey % 10 not in (0, 1, 2)) as bigint) as customer_sum from orders""",
    "raw_profile": raw_profile(),
    "schema_rows": " union all ".join(
        f"select {i} as position, '{c}' as column_name, '{'int' if 'zip' in c else 'string'}' as data_type, true as nullable"
        for i, c in enumerate(COLUMNS["customers"].split())
    ),
    "sample_rows": f"""{BASE} select order_id, customer_unique_id, {stamp("order_purchase_timestamp")}
        as order_purchase_timestamp, {stamp("order_delivered_customer_date")} as order_delivered_customer_date,
        {stamp("order_estimated_delivery_date")} as order_estimated_delivery_date
        from completed order by order_id limit 5""",
    **{f"clean_{e}": clean_sql(e) for e in RAW},
    "standardize_columns": per_column(
        "with " + RAW["customers"], "raw", ["customer_id"], NULLS
    ) + " union all " + " union all ".join(
        f"select '{c}', 0" for c in COLUMNS["customers"].split()[1:]
    ),
    "safe_casts": """select event_id,
        cast(case when event_id % 4 in (0, 3) then user_id end as integer) as as_int,
        round(case event_id % 5 when 0 then null when 1 then null when 2 then 1000.0::double else value end, 6)
          as as_double,
        case when event_id % 3 = 2 then '2024-01-31 10:00:00' end as as_time from events""",
    "null_counts": per_column(cleaned("orders"), "cleaned", COLUMNS["orders"].split(), NULLS),
    "null_zero_counts": per_column(
        GOLD_V3, "gold", [*CORE_FEATURES, "churn_90d"],
        NULLS + ", count(*) filter ({c} = 0) as zero_count",
    ),
    "numeric_summary": summary_sql("", "lineitem", LINE_MEASURES, quartiles=False),
    "quartile_ranks": " union all ".join(
        f"select '{c}' as column_name, " + ", ".join(
            f"round(quantile_disc({c}::double, {q}), 6) as {n}" for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
        ) + " from lineitem"
        for c in LINE_MEASURES
    ),
    "distinct_rows": """select count(*) as rows, (select count(*) from (select distinct l_orderkey, l_linenumber
        from lineitem)) as distinct_rows from lineitem""",
    "completed_orders": f"""{BASE} select order_id, customer_unique_id, {stamp("order_purchase_timestamp")}
        as order_purchase_timestamp, {stamp("order_delivered_customer_date")} as order_delivered_customer_date,
        {stamp("order_estimated_delivery_date")} as order_estimated_delivery_date from completed""",
    "delivery_delay": f"""{BASE} select order_id, cast(delivery_delay_days as integer) as delivery_delay_days,
        case when delivery_delay_days > 0 then 1 else 0 end as is_late,
        cast(cast(order_purchase_timestamp as date) as varchar) as purchase_date,
        cast(last_day(cast(order_purchase_timestamp as date)) as varchar) as observation_month from delayed""",
    "item_rollup": f"""{BASE} select order_id, item_count, round(item_revenue, 4) as item_revenue,
        round(freight_value, 4) as freight_value, unique_products_order, unique_sellers_order,
        unique_categories_order from item_roll""",
    "payment_rollup": f"""{BASE} select order_id, round(payment_value, 4) as payment_value,
        round(avg_installments, 4) as avg_installments, payment_type_count from payment_roll""",
    "review_rollup": f"{BASE} select order_id, round(review_score, 6) as review_score, review_count from review_roll",
    "order_level": f"{BASE} select {LEVEL_COLUMNS.format(late='case when delivery_delay_days > 0 then 1 else 0 end')} from level",
    "order_level_zero_filled": GOLD_V2.split("panel as (")[0].rstrip().rstrip(",")
    + f" select {LEVEL_COLUMNS.format(late='is_late')} from level0",
    "item_detail": f"""{BASE} select order_id, customer_unique_id, {stamp("order_purchase_timestamp")}
        as order_purchase_timestamp, product_id, seller_id, category_name from details""",
    "calendar": f"{BASE_PANEL_V3} select {DAY} from cal",
    "first_purchase": f"""{BASE_PANEL_V3} select customer_unique_id, {stamp("first_ts")} as first_purchase_timestamp,
        cast(cast(date_trunc('month', first_ts) as date) as varchar) as first_observation_month from firsts""",
    "horizon_guard": f"""{BASE} select cast(first_date as varchar) as first_date, cast(last_date as varchar) as last_date,
        cast(max_valid_date as varchar) as max_valid_date from data_range""",
    "dense_panel": f"{BASE_PANEL_V3} select customer_unique_id, {DAY} from panel",
    "purchase_month_panel": f"{BASE_PANEL_V2} select customer_unique_id, {DAY} from panel",
    "late_horizon_guard": f"""{BASE_PANEL_V2} select customer_unique_id, {DAY} from panel p
        where p.observation_date <= (select cast(max(observation_date) - interval 90 day as date) from panel)""",
    "lookback_join": f"""{BASE_PANEL_V3} select p.customer_unique_id,
        cast(p.observation_date as varchar) as observation_date, order_id,
        {stamp("order_purchase_timestamp")} as order_purchase_timestamp
        from panel p left join completed o on p.customer_unique_id = o.customer_unique_id
         and o.order_purchase_timestamp > cast(p.observation_date as timestamp) - interval 180 day
         and o.order_purchase_timestamp <= cast(p.observation_date as timestamp)""",
    "lookback_interval_join": f"""{BASE_PANEL_V3} select p.customer_unique_id,
        cast(p.observation_date as varchar) as observation_date, order_id,
        {stamp("order_purchase_timestamp")} as order_purchase_timestamp
        from panel p join completed o on p.customer_unique_id = o.customer_unique_id
         and o.order_purchase_timestamp > cast(p.observation_date as timestamp) - interval 180 day
         and o.order_purchase_timestamp <= cast(p.observation_date as timestamp)""",
    "midmonth_order_counts": f"""{BASE}, days as (
          select distinct customer_unique_id,
                 cast(date_trunc('month', order_purchase_timestamp) as timestamp) + interval 14 day as mid from completed)
        select d.customer_unique_id, cast(cast(mid as date) as varchar) as observation_date, count(*) as orders
        from days d join completed o on d.customer_unique_id = o.customer_unique_id
         and o.order_purchase_timestamp > mid - interval 14 day and o.order_purchase_timestamp <= mid
        group by all""",
    "label_v3": f"""{BASE_LABEL_V3} select customer_unique_id, {DAY}, future_orders_90d,
        case when future_orders_90d = 0 then 1 else 0 end as churn_90d from future""",
    "label_v2": f"""{BASE_LABEL_V2} select customer_unique_id, {DAY}, future_orders_90d,
        case when future_orders_90d = 0 then 1 else 0 end as churn_90d from future""",
    "distinct_item_features": f"""{GOLD_V3} select customer_unique_id, {DAY}, unique_products_180d,
        unique_categories_180d, unique_sellers_180d from hist_items
        where unique_products_180d + unique_categories_180d + unique_sellers_180d > 0""",
    "gold_v1": select_gold(GOLD_V1, GOLD_COLUMNS["v1"]),
    "gold_v2": select_gold(GOLD_V2, GOLD_COLUMNS["v2"]),
    "gold_v3": select_gold(GOLD_V3, GOLD_COLUMNS["v3"]),
    "gold_v3_strict": select_gold(GOLD_STRICT, GOLD_COLUMNS["v3"]),
    "gold_v3_full_panel": select_gold(GOLD_V3_ALL, GOLD_COLUMNS["v3"]),
    "active_history": select_gold(
        GOLD_V3,
        ("customer_unique_id", "observation_date", "order_count_180d", "recency_days", "customer_lifetime_days",
         "churn_90d"),
    ),
    "snapshot_date_parts": f"""{GOLD_V3} select cast(year(observation_date) as integer) as observation_year,
        cast(month(observation_date) as integer) as observation_month, count(*) as rows from gold group by 1, 2""",
    "split_70_15_15": f"{SPLIT_V2} select customer_unique_id, {DAY}, churn_90d, dataset_split from split",
    "split_60_20_20": f"{SPLIT_V3} select customer_unique_id, {DAY}, churn_90d, dataset_split from split",
    "split_by_dates": f"""{GOLD_V3} select dataset_split, churn_90d, count(*) as rows from (
        select *, case when observation_date <= date '1998-08-31' then 'train'
          when observation_date >= date '1998-09-30' and observation_date <= date '1999-12-31' then 'validation'
          when observation_date >= date '2000-01-31' then 'test' end as dataset_split from gold)
        where dataset_split is not null group by 1, 2""",
    "split_cuts": f"""{SPLIT_V3} select n_dates, cast(train_end as varchar) as train_end,
        cast(validation_start as varchar) as validation_start, cast(validation_end as varchar) as validation_end,
        cast(test_start as varchar) as test_start from cuts""",
    "split_distribution": f"{SPLIT_V3} select dataset_split, churn_90d, count(*) as rows from split group by 1, 2",
    "split_ranges": f"""{SPLIT_V3} select dataset_split, count(*) as rows,
        cast(min(observation_date) as varchar) as min_date, cast(max(observation_date) as varchar) as max_date,
        round(avg(churn_90d), 6) as churn_rate from split group by 1""",
    "split_completeness": f"""{SPLIT_V3} select count(*) filter (dataset_split = 'train') as train_rows,
        count(*) filter (dataset_split = 'validation') as validation_rows,
        count(*) filter (dataset_split = 'test') as test_rows, count(*) as total_rows, 1 as complete from split""",
    "split_concat": f"{GOLD_V3} select churn_90d as target, count(*) as rows from gold group by 1",
    "customer_overlap": f"""{SPLIT_V3}, c as (select distinct customer_unique_id as u, dataset_split as s from split)
        select (select count(*) from c a join c b using (u) where a.s = 'train' and b.s = 'validation')
                 as train_validation,
               (select count(*) from c a join c b using (u) where a.s = 'validation' and b.s = 'test')
                 as validation_test,
               (select count(*) from c a join c b using (u) where a.s = 'train' and b.s = 'test') as train_test""",
    "customers_in_both": f"""{SPLIT_V3} select customer_unique_id from split where dataset_split = 'train'
        intersect select customer_unique_id from split where dataset_split = 'test'""",
    "pure_feature_ranges": f"""{GOLD_V2}, long as (
          select unnest([{", ".join(f"'{f}'" for f in FEATURES)}]) as feature,
                 unnest([{", ".join(f"round(cast({f} as double), 6)" for f in FEATURES)}]) as value, churn_90d from gold),
        cells as (select feature, value, count(*) as n,
                         case when min(churn_90d) = max(churn_90d) then max(churn_90d) else -1 end as label
                  from long where value is not null group by 1, 2),
        marked as (select *, row_number() over (partition by feature order by value)
                             - row_number() over (partition by feature, label order by value) as island from cells),
        runs as (select feature, label, min(value) as low, max(value) as high, cast(sum(n) as bigint) as rows
                 from marked where label >= 0 group by feature, label, island),
        best as (select *, row_number() over (partition by feature, label order by rows desc, low) as place from runs)
        select feature, cast(label as integer) as label, round(low, 4) as low, round(high, 4) as high, rows
        from best where place = 1 and rows >= 0.01 * (select count(*) from gold)""",
    "leakage_probe": f"""{GOLD_V2} select 'order_count_180d' as feature, order_count_180d as feature_value,
        count(*) as rows, avg(churn_90d) as churn_rate from gold group by 2
        having count(*) >= 2 and avg(churn_90d) in (0, 1)""",
    "feature_nulls": per_column(GOLD_V3, "gold", FEATURES, NULLS),
    **REPORTS,
    "ranking_metrics": f"{RANKED} select {RANKING} from ranked",
    "average_precision": f"{RANKED} select {RANKING.split(', round(1 -')[0]} from ranked",
    "roc_auc": f"{RANKED} select {RANKING[RANKING.index('round(1 -'):RANKING.index(', round(max(p)')]} from ranked",
    "ranking_metrics_distinct": f"""{GOLD_V3}, scored as (select churn_90d as label,
          ('0x' || substr(md5(customer_unique_id || '|' || cast(observation_date as varchar)), 1, 8))::bigint::double as score
          from gold), {CELLS.format(source="scored")} select {RANKING} from ranked""",
    "ranking_metrics_documents": f"""with scored as (select quality as label, n_chars::double as score
        from labels join documents using (doc_id)), {CELLS.format(source="scored")} select {RANKING} from ranked""",
    "confusion_matrix": f"""{COUNTS} select 0 as actual, 0 as predicted, tn as rows from counts
        union all select 0, 1, fp from counts union all select 1, 0, fn from counts
        union all select 1, 1, tp from counts""",
    "threshold_metrics": f"""{COUNTS} select round({P1}, 9) as precision, round({R1}, 9) as recall,
        round({F1}, 9) as f1, round({R0}, 9) as specificity, tn, fp, fn, tp from counts""",
    "classification_report": f"{COUNTS} {CLASS_REPORT}",
    "threshold_sweep_fine": f"{sweep_ctes(0.01, 99)} select {SWEPT} from swept",
    "threshold_sweep_coarse": f"{sweep_ctes(0.05, 19)} select {SWEPT} from swept",
    "best_threshold": f"""{sweep_ctes(0.01, 99)} select {SWEPT} from swept
        order by {F1} desc, swept.threshold limit 1""",
    "baselines": BASELINES,
    "capacity_metrics": f"{RANKED} {CAPACITY}",
    "best_candidate": f"""{GOLD_V3}, scored as (
          select 'recency' as model, churn_90d as label, recency_days::double as score from gold
          union all select 'recency_and_count', churn_90d, {HEURISTIC} from gold),
        cells as (select model, score, count(*) filter (label = 1) as pos, count(*) filter (label = 0) as neg
                  from scored group by 1, 2),
        ranked as (select *, sum(pos) over w as cum_pos, sum(neg) over w as cum_neg,
                          sum(pos) over (partition by model) as p
                   from cells window w as (partition by model order by score desc))
        select model, round(sum(pos * cast(cum_pos as double) / (cum_pos + cum_neg)) / max(p), 9) as pr_auc
        from ranked group by 1 order by 2 desc, 1 limit 1""",
    "threshold_decision": f"""{DECIDED} select customer_unique_id, {DAY}, churn_probability, churn_prediction,
        threshold from decided""",
    "risk_band": f"""{DECIDED} select b as risk_band, count(risk_band) as customers
        from (values ('High'), ('Medium'), ('Low')) as t(b) left join decided on b = risk_band group by 1""",
    "rejected_rows": f"""{DIRTY} select customer_unique_id, {DAY}, concat_ws('; ',
        case when k % 7 = 0 then 'revenue_180d: not a number' end,
        case when k % 17 = 0 then 'item_count_180d: missing' end,
        case when k % 11 = 0 then 'late_delivery_rate_180d: too high' end,
        case when k % 13 = 0 then 'recency_days: too low' end) as reasons
        from dirty where {' or '.join(REASONS.values())}""",
    "batch_summary": f"""{DECIDED} select count(*) as total,
        count(*) filter (churn_prediction = 1) as predicted_churn, count(*) filter (risk_band = 'High') as high_risk,
        count(*) filter (risk_band = 'Medium') as medium_risk, count(*) filter (risk_band = 'Low') as low_risk,
        count(*) filter (recency_days <= 3) as rows_with_missing from decided""",
    "top100_risk": f"""{DECIDED} select customer_unique_id, {DAY}, churn_90d, churn_probability, churn_prediction,
        risk_band from (select * from decided
                        order by prob desc, observation_date, customer_unique_id limit 100)""",
    "class_weights": f"""{GOLD_V3}, c as (select count(*) filter (churn_90d = 1)::double as p,
          count(*) filter (churn_90d = 0)::double as n from gold),
        w as (select 'balanced' as scheme, (p + n) / (2 * n) as wn, (p + n) / (2 * p) as wp, p, n from c
              union all select 'retained', p / n, 1.0, p, n from c
              union all select 'scaled', 1.0, n / p, p, n from c)
        select scheme, round(wn, 6) as negative_weight, round(wp, 6) as positive_weight,
               round(wn * n + wp * p, 6) as total_weight from w""",
    "row_constraints": DIRTY + " " + " union all ".join(
        f"select '{r}' as reason, count(*) as rows from dirty where {c} having count(*) > 0"
        for r, c in REASONS.items()
    ),
    "valid_rows": f"""{DIRTY} select count(*) as rows, cast(sum(order_count_180d) as bigint) as orders from dirty
        where not ({' or '.join(REASONS.values())})""",
    "seeded_sample": f"""{GOLD_V3} select customer_unique_id, day, churn_90d from (
        select customer_unique_id, cast(observation_date as varchar) as day, churn_90d,
               md5('42|' || customer_unique_id || '|' || cast(observation_date as varchar)) as token
        from gold order by token, customer_unique_id, day limit 5000)""",
    "importance_share": f"""{mean_abs(MINUS_ONE)} select feature, {ROUND_SHARES} from shares
        order by shares.mean_abs_value desc, feature limit 2""",
    "mean_abs_attribution": f"{mean_abs(RULE)} select feature, {ROUND_SHARES} from shares",
    "attribution_headline": f"""{mean_abs(PLAIN)} select count(*) as features,
        arg_max(feature, mean_abs_value) as top_feature, round(max(mean_abs_value), 6) as top_value,
        round(max(importance_pct), 6) as top_share_pct from shares""",
}

# ---- what must hold of fitted models ------------------------------------------------------


def scored_facts(name: str, part: str) -> str:
    return f"""{SPLIT_V3} select '{name}' as model, count(*) as rows, count(*) filter (churn_90d = 1) as positives,
        0 as out_of_range, 0 as decisions_off, 0 as bands_off, 0 as rounding_off
        from split where dataset_split = '{part}'"""


ATTRIBUTED = f"{SPLIT_V3} select count(*) as rows, 0.0::double as gap, 100.0::double as total_pct from split where dataset_split = 'test'"

SQL |= {
    **{f"{name}_fit": scored_facts(f"{name}_fit", "validation") for name in ("logistic", "forest", "gbt", "mlp")},
    "leafwise_boosting": f"""{SPLIT_V3} select count(*) as rows, count(*) filter (churn_90d = 1) as positives, 0 as out_of_range,
        40 as trees, 0 as trees_too_large, 0 as draws_off, 0 as losses_not_falling
        from split where dataset_split = 'validation'""",
    "relu_network": f"""{SPLIT_V3} select count(*) as rows, count(*) filter (churn_90d = 1) as positives, 0 as out_of_range,
        0 as epochs_over, 0 as nothing_learnt from split where dataset_split = 'validation'""",
    "logistic_gradient": f"""{SPLIT_V3} select count(*) as rows, 0.0::double as steepest from split
        where dataset_split = 'train'""",
    "grid_search": f"""{SPLIT_V3} select 8 as points, 8 as distinct_points, 400.0::double as most_trees,
        count(*) as least_rows, count(*) as most_rows, 0 as out_of_range, 1 as best_is_first
        from split where dataset_split = 'validation'""",
    "training_workflow": f"""{SPLIT_V3}, n as (
          select count(*) filter (dataset_split = 'train') as train_rows,
                 count(*) filter (dataset_split = 'validation') as validation_rows,
                 count(*) filter (dataset_split = 'test') as test_rows,
                 cast(max(observation_date) filter (dataset_split = 'train') as varchar) as train_last,
                 cast(min(observation_date) filter (dataset_split = 'test') as varchar) as test_first,
                 count(*) filter (dataset_split = 'test' and churn_90d = 1) as test_positives from split)
        select 5 as candidates, 1 as champion_is_best, 99 as thresholds, 1 as threshold_is_best, train_rows,
               validation_rows, test_rows, train_last, test_first, test_rows as confusion_rows,
               test_rows as prediction_rows, test_positives, least(100, test_rows) as high_risk_rows,
               least(100, test_rows) as labelled from n""",
    "batch_scoring": scored_facts("batch_scoring", "test"),
    "high_risk_sample": f"""{SPLIT_V3} select least(100, count(*)) as rows, least(100, count(*)) as labelled,
        0 as higher_left_out from split where dataset_split = 'test'""",
    "forest_importance": "select 19 as features, 0 as negative, 100.0::double as total_pct",
    "linear_attribution": ATTRIBUTED,
    "tree_attribution": ATTRIBUTED,
}
