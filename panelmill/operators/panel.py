"""Customer by month-end snapshots: look-back features and the forward label.

A snapshot date means midnight at the start of the last day of a month, so a
purchase later that day belongs to the future of that snapshot.

The look-back and forward windows are interval joins between snapshots and
purchases. Instead of pairing rows, each purchase works out, by date arithmetic
alone, the run of month indices it belongs to: first the snapshots whose future
it is, then, adjacent to those, the snapshots whose history it is. It is
exploded over that run and everything is summed in one aggregation on
(customer, month). Cost is linear in purchases for any key, however hot: a
heavy customer is combined before the shuffle and spread over the months.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.functions.columns import fill_zero, month_end, month_index, ratio
from panelmill.operators.orders import KNOWN_AT, PURCHASE_TIME
from panelmill.schema import CUSTOMER, SNAPSHOT, TARGET

MONTHS_PER_WORD = 60


@dataclass(frozen=True)
class SnapshotSpec:
    """Window lengths and the rules that differ between generations of the panel.

    panel: ``dense`` has every month end from the first purchase month on;
    ``purchase_month`` only month ends of months with a purchase.
    guard: keep only snapshots whose forward window ends inside the data.
    active_only: drop snapshots without a purchase in the look-back window.
    missing_as_zero: an order without a review or delivery date counts as 0 in means.
    reviewed_orders: review count is the number of reviewed orders, else of reviews.
    diversity: ``entities`` counts distinct products, categories and sellers over
    the window; ``per_order`` averages the per-order distinct counts.
    strict_as_of: reviews and deliveries count from the first snapshot at which they had happened;
    before, the order counts as one without them. Each measure so has a run of months of its own, the
    meet of the look-back window and "known by then". Else they are joined by order, whenever they happened.
    """

    history_days: int = 180
    horizon_days: int = 90
    lower_inclusive: bool = False
    panel: str = "dense"
    guard: bool = True
    active_only: bool = True
    missing_as_zero: bool = False
    reviewed_orders: bool = True
    diversity: str = "entities"
    strict_as_of: bool = False

    def __post_init__(self) -> None:
        if self.panel not in ("dense", "purchase_month"):
            raise ValueError(f"unknown panel: {self.panel}")
        if self.diversity not in ("entities", "per_order"):
            raise ValueError(f"unknown diversity: {self.diversity}")
        if self.history_days <= 0 or self.horizon_days <= 0:
            raise ValueError("window lengths must be positive")

    @property
    def needs_markers(self) -> bool:
        """Whether the panel holds other rows than those with a purchase in the window."""
        return self.panel == "purchase_month" or not self.active_only


# The first two generations keep snapshots without history. Such a row exists only
# because of a purchase after midnight on its own last day, so its label is always
# 0: a leak. They stay available for comparison; V3 is the default.
V1 = SnapshotSpec(
    lower_inclusive=True,
    panel="purchase_month",
    guard=False,
    active_only=False,
    missing_as_zero=True,
    reviewed_orders=False,
    diversity="per_order",
)
V2 = SnapshotSpec(
    lower_inclusive=True,
    panel="purchase_month",
    guard=False,
    active_only=False,
    missing_as_zero=True,
    reviewed_orders=False,
)
V3 = SnapshotSpec()


def first_snapshot(time: Column) -> Column:
    """Month index of the first snapshot at or after a time."""
    day = F.to_date(time)
    on_last_day = (day == F.last_day(day)) & (time > day.cast("timestamp"))
    return month_index(day) + F.when(on_last_day, 1).otherwise(0)


def snapshot_runs(time: Column, spec: SnapshotSpec) -> dict[str, Column]:
    """Month-index runs a purchase belongs to, bounds included.

    ``future_from .. history_from - 1`` have it in their forward window,
    ``history_from .. history_to`` in their look-back window.
    """
    day = F.to_date(time)
    past_midnight = time > day.cast("timestamp")

    def is_month_end(d: Column) -> Column:
        return d == F.last_day(d)

    def step(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    far = F.date_add(day, spec.history_days)
    near = F.date_sub(day, spec.horizon_days)
    reaches_far = is_month_end(far) if spec.lower_inclusive else is_month_end(far) & past_midnight
    return {
        "future_from": month_index(near) + step(is_month_end(near) & past_midnight),
        "history_from": first_snapshot(time),
        "history_to": month_index(far) - 1 + step(reaches_far),
    }


def calendar_bounds(orders: DataFrame, spec: SnapshotSpec = V3) -> DataFrame:
    """One row: first and last purchase date, the last snapshot date with a complete
    forward window, and the month index of the last month end up to it."""
    last_valid = F.date_sub("last_date", spec.horizon_days)
    return (
        orders.agg(
            F.to_date(F.min(PURCHASE_TIME)).alias("first_date"),
            F.to_date(F.max(PURCHASE_TIME)).alias("last_date"),
        )
        .withColumn("max_valid_date", last_valid)
        .withColumn(
            "last_index",
            month_index(F.col("max_valid_date"))
            - F.when(F.col("max_valid_date") == F.last_day("max_valid_date"), 0).otherwise(1),
        )
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """Month ends from the first purchase month to the last valid snapshot."""
    return (
        bounds.select(F.col("last_index"), month_index(F.col("first_date")).alias("first_index"))
        .where(F.col("first_index") <= F.col("last_index"))
        .select(F.explode(F.sequence("first_index", "last_index")).alias("index"))
        .select(month_end(F.col("index")).alias(SNAPSHOT))
    )


def first_purchase(orders: DataFrame) -> DataFrame:
    """First completed purchase per customer and the month it opens."""
    return (
        orders.groupBy(CUSTOMER)
        .agg(F.min(PURCHASE_TIME).alias("first_purchase_timestamp"))
        .withColumn("first_observation_month", F.trunc(F.to_date("first_purchase_timestamp"), "month"))
    )


def _dense_markers(orders: DataFrame, bounds: DataFrame) -> DataFrame:
    return (
        first_purchase(orders)
        .select(CUSTOMER, month_index(F.col("first_observation_month")).alias("_from"))
        # one aggregate row, so the broadcast is bounded whatever the data
        .crossJoin(F.broadcast(bounds.select("last_index")))
        .where(F.col("_from") <= F.col("last_index"))
        .select(CUSTOMER, F.explode(F.sequence("_from", "last_index")).alias("_index"))
    )


def _purchase_month_markers(orders: DataFrame) -> DataFrame:
    return orders.select(CUSTOMER, month_index(F.to_date(PURCHASE_TIME)).alias("_index"))


def panel(orders: DataFrame, spec: SnapshotSpec = V3) -> DataFrame:
    """The (customer, snapshot) rows of a generation before any feature is attached."""
    if spec.panel == "dense":
        rows = _dense_markers(orders, calendar_bounds(orders, spec))
    else:
        rows = _purchase_month_markers(orders).distinct()
    return rows.select(CUSTOMER, month_end(F.col("_index")).alias(SNAPSHOT))


def _with_runs(facts: DataFrame, spec: SnapshotSpec, bounds: DataFrame | None) -> DataFrame:
    """Attach the month runs, cut at the last valid snapshot where there is a guard."""
    out = facts.withColumns(snapshot_runs(F.col(PURCHASE_TIME), spec))
    if bounds is None:
        return out
    return (
        out.crossJoin(F.broadcast(bounds.select("last_index")))
        .withColumn("history_to", F.least("history_to", "last_index"))
        .drop("last_index")
    )


def _as_known(rows: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """Measures that were not known yet at a row's snapshot, as those of an order that has none."""
    empty = {m: 0 if spec.missing_as_zero or m == "is_late" else None for measures in KNOWN_AT.values() for m in measures}
    out = {}
    for time, measures in KNOWN_AT.items():
        if time in rows.columns:
            known = F.coalesce(F.col("_index") >= first_snapshot(F.col(time)), F.lit(False))
            out |= {m: F.when(known, F.col(m)).otherwise(F.lit(empty[m])) for m in measures if m in rows.columns}
    return rows.withColumns(out)


def order_contributions(orders: DataFrame, spec: SnapshotSpec, bounds: DataFrame | None) -> DataFrame:
    """Each order once per snapshot it is history or future of; ``_past`` tells which."""
    run = _with_runs(orders, spec, bounds)
    rows = (
        run.where(F.col("future_from") <= F.col("history_to"))
        .withColumn("_index", F.explode(F.sequence("future_from", "history_to")))
        .withColumn("_past", F.col("_index") >= F.col("history_from"))
        .drop("future_from", "history_from", "history_to")
    )
    return _as_known(rows, spec) if spec.strict_as_of else rows


def entity_contributions(
    facts: DataFrame, entities: Mapping[str, str], spec: SnapshotSpec, bounds: DataFrame | None
) -> DataFrame:
    """One row per (customer, snapshot, distinct entity) seen in the look-back window.

    ``entities`` maps an output name to the column holding the entity. A purchase
    covers a run of months; runs of the same entity are merged as bits of a 64-bit
    word (60 months each), which is a fixed-size state that combines before the
    shuffle. That replaces a distinct count over the exploded rows, which would
    move every row once per month and per entity.
    """
    names = list(entities)
    run = _with_runs(facts, spec, bounds).where(F.col("history_from") <= F.col("history_to"))
    values = F.array(
        *[
            F.struct(F.lit(i).alias("_kind"), F.col(entities[n]).cast("string").alias("_value"))
            for i, n in enumerate(names)
        ]
    )
    words = F.sequence(
        F.floor(F.col("history_from") / MONTHS_PER_WORD), F.floor(F.col("history_to") / MONTHS_PER_WORD)
    )
    covered = (
        run.select(CUSTOMER, "history_from", "history_to", F.inline(values))
        .where(F.col("_value").isNotNull())
        .withColumn("_word", F.explode(words))
        .withColumn("_base", (F.col("_word") * MONTHS_PER_WORD).cast("int"))
        .withColumn("_lo", F.greatest(F.col("history_from"), F.col("_base")))
        .withColumn("_hi", F.least(F.col("history_to"), F.col("_base") + MONTHS_PER_WORD - 1))
        .withColumn("_bits", F.expr("shiftleft(shiftleft(1L, _hi - _lo + 1) - 1L, _lo - _base)"))
        .groupBy(CUSTOMER, "_kind", "_value", "_base")
        .agg(F.bit_or("_bits").alias("_bits"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    )
    # a customer's words next to each other, so that the counts combine before the shuffle; a hot one is split again
    together = covered.select(CUSTOMER, "_kind", "_base", "_bits", "_lo", "_hi").hint("rebalance", "_base", CUSTOMER)
    return (
        together.withColumn("_index", F.explode(F.sequence("_lo", "_hi")))
        .where(F.expr("shiftright(_bits, _index - _base) & 1L = 1L"))
        .select(
            CUSTOMER,
            "_index",
            *[F.when(F.col("_kind") == i, 1).alias(n) for i, n in enumerate(names)],
        )
    )


def count_entities(contributions: DataFrame, entities: Mapping[str, str]) -> DataFrame:
    """Distinct entities per (customer, snapshot) that has any."""
    return (
        contributions.groupBy(CUSTOMER, "_index")
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in entities])
        .select(CUSTOMER, month_end(F.col("_index")).alias(SNAPSHOT), *entities)
    )


def forward_label(orders: DataFrame, spec: SnapshotSpec = V3) -> DataFrame:
    """Label of every panel row: orders in the forward window, and whether there is none."""
    bounds = calendar_bounds(orders, spec) if spec.guard else None
    ahead = _with_runs(orders, spec, bounds).withColumn("_to", F.col("history_from") - 1)
    if bounds is not None:
        # history_to is already cut at the guard; the forward run needs the same cut
        ahead = ahead.withColumn("_to", F.least("_to", "history_to"))
    seen = (
        ahead.where(F.col("future_from") <= F.col("_to"))
        .select(CUSTOMER, F.explode(F.sequence("future_from", "_to")).alias("_index"))
        .withColumn("_ahead", F.lit(1))
    )
    if spec.panel == "dense":
        markers = _dense_markers(orders, bounds if bounds is not None else calendar_bounds(orders, spec))
    else:
        markers = _purchase_month_markers(orders)
    return (
        seen.unionByName(markers.withColumn("_in_panel", F.lit(1)), allowMissingColumns=True)
        .groupBy(CUSTOMER, "_index")
        .agg(F.count("_ahead").alias("future_orders_90d"), F.max("_in_panel").alias("_in_panel"))
        .where(F.col("_in_panel") == 1)
        .select(
            CUSTOMER,
            month_end(F.col("_index")).alias(SNAPSHOT),
            "future_orders_90d",
            F.when(F.col("future_orders_90d") == 0, 1).otherwise(0).alias(TARGET),
        )
    )


ENTITY_FEATURES = {
    "unique_products_180d": "product_id",
    "unique_categories_180d": "category_name",
    "unique_sellers_180d": "seller_id",
}


def _measures(columns: list[str], spec: SnapshotSpec) -> list[Column]:
    """Aggregates over the union of contributions; a missing input leaves its feature out."""
    past = F.col("_past")

    def seen(name: str) -> Column:
        return F.when(past, F.col(name))

    def total(name: str) -> Column:
        return F.coalesce(F.sum(seen(name)), F.lit(0))

    def mean(name: str) -> Column:
        return F.coalesce(F.avg(seen(name)), F.lit(0.0))

    review_count = F.count(seen("review_score")) if spec.reviewed_orders else total("review_count")
    plan: list[tuple[str, str, Column]] = [
        ("order_count_180d", "order_id", F.count(F.when(past, 1))),
        ("revenue_180d", "item_revenue", total("item_revenue")),
        ("payment_value_180d", "payment_value", total("payment_value")),
        ("freight_value_180d", "freight_value", total("freight_value")),
        ("item_count_180d", "item_count", total("item_count")),
        ("avg_payment_type_count_180d", "payment_type_count", mean("payment_type_count")),
        ("avg_installments_180d", "avg_installments", mean("avg_installments")),
        ("avg_review_score_180d", "review_score", mean("review_score")),
        ("review_count_180d", "review_count", review_count),
        ("avg_delivery_delay_180d", "delivery_delay_days", mean("delivery_delay_days")),
        ("late_delivery_rate_180d", "is_late", mean("is_late")),
        ("last_purchase_timestamp", PURCHASE_TIME, F.max(seen(PURCHASE_TIME))),
        ("first_purchase_timestamp_180d", PURCHASE_TIME, F.min(seen(PURCHASE_TIME))),
        ("future_orders_90d", "order_id", F.count(F.when(~past, 1))),
    ]
    if spec.diversity == "per_order":
        plan += [
            ("avg_products_per_order_180d", "unique_products_order", mean("unique_products_order")),
            ("avg_categories_per_order_180d", "unique_categories_order", mean("unique_categories_order")),
            ("avg_sellers_per_order_180d", "unique_sellers_order", mean("unique_sellers_order")),
        ]
    return [expr.alias(name) for name, source, expr in plan if source in columns]


def snapshot_features(
    orders: DataFrame,
    details: DataFrame | None = None,
    spec: SnapshotSpec = V3,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Features and label per (customer, snapshot), from the order-level fact.

    ``orders`` is the output of ``order_level``; ``details`` the item rows with
    owner, needed for the distinct-entity features. All contributions meet in one
    union and one aggregation, so there is no join between feature groups, label
    and panel. ``bounds`` may be passed in to skip the pass over the orders that
    finds the last purchase.
    """
    if bounds is None and (spec.guard or (spec.panel == "dense" and spec.needs_markers)):
        bounds = calendar_bounds(orders, spec)
    cut = bounds if spec.guard else None

    rows = order_contributions(orders, spec, cut)
    distinct_names: list[str] = []
    if spec.diversity == "entities" and details is not None:
        distinct_names = list(ENTITY_FEATURES)
        rows = rows.unionByName(
            entity_contributions(details, ENTITY_FEATURES, spec, cut), allowMissingColumns=True
        )
    elif spec.diversity == "per_order" and "unique_products_order" in orders.columns:
        distinct_names = ["distinct_product_baskets_180d"]
        sizes = {"distinct_product_baskets_180d": "unique_products_order"}
        rows = rows.unionByName(entity_contributions(orders, sizes, spec, cut), allowMissingColumns=True)
    if spec.needs_markers:
        markers = _dense_markers(orders, bounds) if spec.panel == "dense" else _purchase_month_markers(orders)
        rows = rows.unionByName(markers.withColumn("_in_panel", F.lit(1)), allowMissingColumns=True)

    measures = _measures(orders.columns, spec)
    measures += [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in distinct_names]
    if spec.needs_markers:
        measures.append(F.max("_in_panel").alias("_in_panel"))
    grouped = rows.groupBy(CUSTOMER, "_index").agg(*measures)
    if spec.needs_markers:
        grouped = grouped.where(F.col("_in_panel") == 1).drop("_in_panel")
    if spec.active_only:
        grouped = grouped.where(F.col("order_count_180d") > 0)
    return _derive(grouped.withColumn(SNAPSHOT, month_end(F.col("_index"))).drop("_index"), spec)


def _derive(df: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """Recency, lifetime inside the window, ratios, label and date parts."""
    months = F.lit(spec.history_days / 30)
    columns = {
        "recency_days": F.datediff(F.col(SNAPSHOT), F.to_date("last_purchase_timestamp")),
        "customer_lifetime_days": F.datediff(F.col(SNAPSHOT), F.to_date("first_purchase_timestamp_180d")),
        "orders_per_month_180d": F.col("order_count_180d") / months,
        TARGET: F.when(F.col("future_orders_90d") == 0, 1).otherwise(0),
        "observation_year": F.year(SNAPSHOT),
        "observation_month": F.month(SNAPSHOT),
    }
    if "revenue_180d" in df.columns:
        columns["avg_order_value_180d"] = ratio(F.col("revenue_180d"), F.col("order_count_180d"))
        columns["revenue_per_month_180d"] = F.col("revenue_180d") / months
    out = fill_zero(df.withColumns(columns), ["recency_days", "customer_lifetime_days"])
    lead = [CUSTOMER, SNAPSHOT]
    return out.select(*lead, *[c for c in out.columns if c not in lead])


def active_history(df: DataFrame) -> DataFrame:
    """Snapshots with at least one order in the look-back window."""
    return df.where(F.col("order_count_180d") > 0)


def join_to_panel(snapshots: DataFrame, orders: DataFrame, spec: SnapshotSpec = V3) -> DataFrame:
    """Left interval join: every snapshot with the orders of its look-back window, one row each.

    The general form for callers who need the pairs themselves; the features above
    never materialise them. A purchase spreads over the snapshots that look back on it,
    so the pairs need no join: only snapshots that there are stay, by a semi join
    whose many-rows side adaptive execution can split, and snapshots without a purchase
    come in by an anti join with the distinct keys.
    """
    run = _with_runs(orders, spec, None)
    spread = (
        run.where(F.col("history_from") <= F.col("history_to"))
        .withColumn(SNAPSHOT, F.explode(F.sequence("history_from", "history_to")))
        .withColumn(SNAPSHOT, month_end(F.col(SNAPSHOT)))
        .drop("future_from", "history_from", "history_to")
    )
    keys = [CUSTOMER, SNAPSHOT]
    matched = spread.join(snapshots.select(*keys), keys, "left_semi")
    if set(snapshots.columns) - set(keys):  # whatever else a snapshot carries; the many rows stay on the left
        matched = matched.join(snapshots, keys)
    alone = snapshots.join(spread.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)
