"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmill.catalog.sql_base import INTS, MEANS, MONEY
from panelmill.functions.columns import finite_double, safe_cast, standardize_columns
from panelmill.operators import dataset as D
from panelmill.operators import intervals as I
from panelmill.operators import metrics as M
from panelmill.operators import orders as O
from panelmill.operators import panel as P
from panelmill.operators import profile as Q
from panelmill.operators import scoring as S
from panelmill.operators.cleaning import clean
from panelmill.operators.leakage import purest_ranges
from panelmill.plans import reports as R
from panelmill.plans.gold import ALL_BLOCKS, GOLD_PARTITIONS, gold, order_facts
from panelmill.plans.medallion import ingest, refine
from panelmill.schema import CUSTOMER, ENTITIES, FEATURES, SNAPSHOT, SPLIT, TARGET
from panelmill.session import apply_sql_settings, scratch_folder, scratch_path, shuffles_removed, size_tasks
from panelmill.sources import tables as X
from panelmill.sources.testviews import raw_tables, read_table, typed_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(size_tasks(apply_sql_settings(spark), sf_dir), sf_dir)

        QUERIES[name] = run
        return f

    return add


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Columns as both engines print them: dates as text, money to 4 places, means to 6."""
    types = dict(df.dtypes)

    def one(c: str):
        if types[c] == "date":
            return F.col(c).cast("string").alias(c)
        if types[c] == "timestamp":
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
        if c in MONEY:
            return F.round(F.col(c), 4).alias(c)
        if c in MEANS:
            return F.round(F.col(c), 6).alias(c)
        if c in INTS:
            return F.col(c).cast("int").alias(c)
        return F.col(c)

    return df.select(*[one(c) for c in columns or df.columns])


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return shown(df.withColumns({c: F.round(F.col(c), digits) for c in columns}))


def panel(spark: SparkSession, sf_dir: str, generation="v3", blocks: Collection[str] = ()) -> DataFrame:
    """The feature table; completed orders, and their items where read twice, are stored first, as several branches start from them."""
    tables, orders = typed_tables(spark, sf_dir), X.staged(completed(spark, sf_dir), "completed-orders")
    owned = X.staged(O.owned_items(tables["order_items"], orders), "owned-items") if {"items", "diversity"} <= set(blocks) else None
    return gold(tables, generation, blocks, orders, owned)


def stored_panel(spark: SparkSession, sf_dir: str, generation="v3", blocks: Collection[str] = ()) -> DataFrame:
    """The same as a table, for what reads it more than once."""
    return X.staged(panel(spark, sf_dir, generation, blocks), "panel")


def completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = typed_tables(spark, sf_dir)
    return O.completed_orders(t["orders"], t["customers"])


# ---- sources and sinks -------------------------------------------------------------------


@query("csv_bronze_silver")
def csv_bronze_silver(spark, sf_dir):
    """All nine raw files: CSV to bronze to silver; rows of each stage as verified after the write."""
    silver, verified = scratch_path(spark, "silver"), scratch_path(spark, "verified")
    with scratch_folder(spark), shuffles_removed(spark):  # each stage goes when the next one has been written and verified
        bronze = scratch_path(spark, "bronze")
        with scratch_folder(spark):
            raw = scratch_path(spark, "raw")
            for name, df in raw_tables(spark, sf_dir).items():
                df.write.options(
                    header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip"
                ).csv(f"{raw}/{name}.csv")
            first = ingest(spark, raw, bronze)
        X.write_parquet(first, verified)
        second = refine(spark, bronze, silver)
    return X.read_parquet(spark, verified).select(
        "dataset", "rows", "columns", "verified_rows", "verified_columns"
    ).join(second.select("dataset", F.col("verified_rows").alias("silver_rows")), "dataset")


@query("gold_partition_read")
def gold_partition_read(spark, sf_dir):
    """Feature table written by year: rows per year as stored, and of one year as read through partition pruning."""
    path = X.write_parquet(panel(spark, sf_dir), scratch_path(spark, "gold"), ["observation_year"])
    every = X.read_parquet(spark, path).groupBy("observation_year").agg(F.count("*").alias("rows"))
    pruned = X.read_part(spark, path, observation_year=1999).groupBy("observation_year").agg(
        F.count("*").alias("pruned_rows"), F.sum(TARGET).alias("pruned_lost")
    )
    return every.join(pruned, "observation_year", "left")


@query("gold_month_partitions")
def gold_month_partitions(spark, sf_dir):
    """Feature table of the second generation in directories per year and month; rows of each."""
    path = X.write_parquet(panel(spark, sf_dir, "v2"), scratch_path(spark, "gold-v2"), GOLD_PARTITIONS["v2"])
    return X.read_parquet(spark, path).groupBy(*GOLD_PARTITIONS["v2"]).agg(F.count("*").alias("rows"))


@query("dataset_date_partitions")
def dataset_date_partitions(spark, sf_dir):
    """Dataset in directories per snapshot date; rows and positives of each."""
    path = X.write_parquet(dataset_v3(spark, sf_dir), scratch_path(spark, "dataset"), [SNAPSHOT])
    stored = X.read_parquet(spark, path).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))
    return rounded(R.BY_MONTH(stored), 6, "loss_rate")


@query("dataset_partition_read")
def dataset_partition_read(spark, sf_dir):
    """Dataset written by split, the test part read back."""
    path = X.write_parquet(dataset_v3(spark, sf_dir), scratch_path(spark, "dataset"), [SPLIT])
    return rounded(R.BY_MONTH(X.read_part(spark, path, dataset_split="test")), 6, "loss_rate")


@query("scored_csv_roundtrip")
def scored_csv_roundtrip(spark, sf_dir):
    """A scoring batch read from CSV, scored by a rule, written with its extra columns, read again."""
    path = scratch_path(spark, "scored")
    with scratch_folder(spark), shuffles_removed(spark):  # the batch goes when its scores have been written
        source = scratch_path(spark, "batch")
        with scratch_folder(spark):  # and what it is made of before
            batch = panel(spark, sf_dir, "v3", ALL_BLOCKS).select(CUSTOMER, SNAPSHOT, *FEATURES)
            X.write_csv(batch, source, compression="gzip")
        rows = S.numeric_features(X.read_scoring_batch(spark, source))
        scored = S.decide(rows.withColumn(S.PROBABILITY, _heuristic()), 0.5)
        X.write_csv(scored, path, compression="gzip")
    back = X.read_csv(spark, path, infer=True)
    return shown(back, CUSTOMER, SNAPSHOT, "order_count_180d", S.PROBABILITY, "churn_prediction", "risk_band").withColumn(
        CUSTOMER, F.col(CUSTOMER).cast("string")
    )


@query("csv_malformed")
def csv_malformed(spark, sf_dir):
    """A CSV with short, long and mistyped lines: rows read, lines set aside, and what is left of them."""
    k = F.col("o_orderkey")
    line = (
        F.when(k % 10 == 0, k.cast("string"))
        .when(k % 10 == 1, F.concat_ws(",", k, "o_custkey", F.lit("9"), F.lit("more")))
        .when(k % 10 == 2, F.concat(F.lit("no-number,"), F.col("o_custkey")))
        .otherwise(F.concat_ws(",", k, "o_custkey"))
    )
    path = scratch_path(spark, "malformed")
    read_table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("order_key", T.LongType()), T.StructField("customer_key", T.LongType())])
    # without a header line: every file would have to start with one
    rows = X.staged(X.read_csv(spark, path, schema, keep_malformed=True, header=False), "read")
    return rows.agg(
        F.count("*").alias("rows"),
        F.count(X.CORRUPT).alias("malformed"),
        F.count("order_key").alias("order_keys"),
        F.sum(F.when(F.col(X.CORRUPT).isNull(), F.col("customer_key"))).alias("customer_sum"),
    )


@query("raw_profile")
def raw_profile(spark, sf_dir):
    """Rows, columns, types and NULLs of all nine raw tables."""
    out = None
    for name, df in raw_tables(spark, sf_dir).items():
        one = Q.table_profile(standardize_columns(df)).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("schema_rows")
def schema_rows(spark, sf_dir):
    return Q.schema_rows(clean(raw_tables(spark, sf_dir)["customers"], "customers"))


@query("sample_rows")
def sample_rows(spark, sf_dir):
    return shown(Q.sample_rows(completed(spark, sf_dir), 5, "order_id"))


# ---- cleaning ----------------------------------------------------------------------------


def _clean_query(entity: str) -> None:
    @query(f"clean_{entity}")
    def run(spark, sf_dir):
        return shown(clean(raw_tables(spark, sf_dir)[entity], entity))


for _entity in ENTITIES:
    _clean_query(_entity)


@query("standardize_columns")
def standardized(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)["customers"]
    return Q.null_counts(standardize_columns(raw))


@query("safe_casts")
def safe_casts(spark, sf_dir):
    """Malformed integers, doubles and times become NULL; infinities are not finite."""
    dirty = read_table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case event_id % 4 when 0 then concat(' ', user_id, ' ') when 1 then '' when 2 then 'x1'"
        " else cast(user_id as string) end as as_int",
        "case event_id % 5 when 0 then 'Infinity' when 1 then 'abc' when 2 then '1e3'"
        " else cast(value as string) end as as_double",
        "case event_id % 3 when 0 then 'yesterday' when 1 then '2024-13-01 00:00:00'"
        " else '2024-01-31 10:00:00' end as as_time",
    )
    return dirty.select(
        "event_id",
        safe_cast("as_int", "int").alias("as_int"),
        F.round(finite_double("as_double"), 6).alias("as_double"),
        F.date_format(safe_cast("as_time", "timestamp"), "yyyy-MM-dd HH:mm:ss").alias("as_time"),
    )


# ---- profiles ----------------------------------------------------------------------------


@query("null_counts")
def null_counts(spark, sf_dir):
    return Q.null_counts(clean(raw_tables(spark, sf_dir)["orders"], "orders"))


@query("null_zero_counts")
def null_zero_counts(spark, sf_dir):
    return Q.null_zero_counts(panel(spark, sf_dir, "v3", ALL_BLOCKS), [*R.CORE_FEATURES, TARGET])


LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("numeric_summary")
def numeric_summary(spark, sf_dir):
    return summary(Q.numeric_summary(read_table(spark, sf_dir, "lineitem"), LINE_MEASURES, quartiles=False))


@query("quartile_ranks")
def quartile_ranks(spark, sf_dir):
    """Exact quartiles of the line measures."""
    marks = Q.numeric_summary(read_table(spark, sf_dir, "lineitem"), LINE_MEASURES)
    return rounded(marks.select("column_name", "p25", "p50", "p75"), 6, "p25", "p50", "p75")


def summary(df: DataFrame) -> DataFrame:
    return rounded(df, 6, *[c for c in df.columns if c not in ("column_name", "n")])


@query("distinct_rows")
def distinct_rows(spark, sf_dir):
    return Q.distinct_rows(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---- order grain -------------------------------------------------------------------------


@query("completed_orders")
def completed_orders(spark, sf_dir):
    return shown(completed(spark, sf_dir))


@query("delivery_delay")
def delivery_delay(spark, sf_dir):
    delays = O.with_calendar(O.with_delivery(completed(spark, sf_dir)))
    return shown(delays, "order_id", "delivery_delay_days", "is_late", "purchase_date", "observation_month")


@query("item_rollup")
def item_rollup(spark, sf_dir):
    t = typed_tables(spark, sf_dir)
    rows = O.item_rollup(O.categorised_items(t["order_items"], t["products"], t["category_translation"]))
    return rounded(rows, 4, "item_revenue", "freight_value")


@query("payment_rollup")
def payment_rollup(spark, sf_dir):
    rows = O.payment_rollup(typed_tables(spark, sf_dir)["payments"])
    return rounded(rows, 4, "payment_value", "avg_installments")


@query("review_rollup")
def review_rollup(spark, sf_dir):
    return rounded(O.review_rollup(typed_tables(spark, sf_dir)["reviews"]), 6, "review_score")


def _level(spark, sf_dir, spec) -> DataFrame:
    facts, _ = order_facts(typed_tables(spark, sf_dir), spec)
    return facts.select(
        "order_id",
        CUSTOMER,
        "delivery_delay_days",
        "is_late",
        F.col("item_count").cast("long").alias("item_count"),
        F.round("item_revenue", 4).alias("item_revenue"),
        F.round("freight_value", 4).alias("freight_value"),
        F.round("payment_value", 4).alias("payment_value"),
        F.round("avg_installments", 6).alias("avg_installments"),
        "payment_type_count",
        F.round("review_score", 6).alias("review_score"),
        "review_count",
    )


@query("order_level")
def order_level(spark, sf_dir):
    return _level(spark, sf_dir, P.V3)


@query("order_level_zero_filled")
def order_level_zero_filled(spark, sf_dir):
    return _level(spark, sf_dir, P.V2)


@query("item_detail")
def item_detail(spark, sf_dir):
    _, details = order_facts(typed_tables(spark, sf_dir), P.V3)
    return shown(details)


# ---- panel -------------------------------------------------------------------------------


@query("calendar")
def calendar(spark, sf_dir):
    return shown(P.calendar(P.calendar_bounds(completed(spark, sf_dir))))


@query("first_purchase")
def first_purchase(spark, sf_dir):
    return shown(P.first_purchase(completed(spark, sf_dir)))


@query("horizon_guard")
def horizon_guard(spark, sf_dir):
    return shown(P.calendar_bounds(completed(spark, sf_dir)).drop("last_index"))


@query("dense_panel")
def dense_panel(spark, sf_dir):
    return shown(P.panel(completed(spark, sf_dir), P.V3))


@query("purchase_month_panel")
def purchase_month_panel(spark, sf_dir):
    return shown(P.panel(completed(spark, sf_dir), P.V2))


@query("late_horizon_guard")
def late_horizon_guard(spark, sf_dir):
    """The guard applied afterwards, from the last snapshot."""
    return shown(D.complete_horizon(P.panel(completed(spark, sf_dir), P.V2)))


@query("lookback_join")
def lookback_join(spark, sf_dir):
    """Snapshots left-joined with the orders of their window."""
    orders = completed(spark, sf_dir)
    pairs = P.join_to_panel(P.panel(orders, P.V3), orders, P.V3)
    return shown(pairs, CUSTOMER, SNAPSHOT, "order_id", "order_purchase_timestamp")


@query("lookback_interval_join")
def lookback_interval_join(spark, sf_dir):
    """The same pairs by bins of time instead of runs of months."""
    orders = X.staged(completed(spark, sf_dir), "completed-orders")
    pairs = I.lookback_pairs(P.panel(orders, P.V3), orders, P.V3)
    return shown(pairs, CUSTOMER, SNAPSHOT, "order_id", "order_purchase_timestamp")


@query("midmonth_order_counts")
def midmonth_order_counts(spark, sf_dir):
    """Orders in the two weeks before the 15th of each month with a purchase: a window that isn't a run of month ends."""
    orders = X.staged(completed(spark, sf_dir), "completed-orders")
    day = F.date_add(F.trunc(F.col(P.PURCHASE_TIME), "month"), 14).alias(SNAPSHOT)
    pairs = I.lookback_pairs(orders.select(CUSTOMER, day).distinct(), orders, P.SnapshotSpec(history_days=14), days=14)
    return shown(pairs.groupBy(CUSTOMER, SNAPSHOT).agg(F.count("*").alias("orders")))


@query("label_v3")
def label_v3(spark, sf_dir):
    return shown(P.forward_label(completed(spark, sf_dir), P.V3))


@query("label_v2")
def label_v2(spark, sf_dir):
    return shown(P.forward_label(completed(spark, sf_dir), P.V2))


@query("distinct_item_features")
def distinct_item_features(spark, sf_dir):
    _, details = order_facts(typed_tables(spark, sf_dir), P.V3)
    bound = P.calendar_bounds(completed(spark, sf_dir))
    rows = P.entity_contributions(details, P.ENTITY_FEATURES, P.V3, bound)
    return shown(P.count_entities(rows, P.ENTITY_FEATURES))


V1_ONLY = (
    "distinct_product_baskets_180d", "avg_products_per_order_180d", "avg_categories_per_order_180d",
    "avg_sellers_per_order_180d",
)
GOLD_COLUMNS = {
    "v1": (CUSTOMER, SNAPSHOT, *[f for f in FEATURES if not f.startswith("unique_")], *V1_ONLY,
           "future_orders_90d", TARGET),
    "v2": (CUSTOMER, SNAPSHOT, *FEATURES, "future_orders_90d", TARGET),
    "v3": (CUSTOMER, SNAPSHOT, *FEATURES, "future_orders_90d", TARGET),
}


@query("gold_v1")
def gold_v1(spark, sf_dir):
    return shown(panel(spark, sf_dir, "v1", ALL_BLOCKS), *GOLD_COLUMNS["v1"])


@query("gold_v2")
def gold_v2(spark, sf_dir):
    return shown(panel(spark, sf_dir, "v2", ALL_BLOCKS), *GOLD_COLUMNS["v2"])


@query("gold_v3")
def gold_v3(spark, sf_dir):
    return shown(panel(spark, sf_dir, "v3", ALL_BLOCKS), *GOLD_COLUMNS["v3"])


@query("gold_v3_full_panel")
def gold_v3_full_panel(spark, sf_dir):
    """All snapshots of the dense panel, those without history included."""
    spec = P.SnapshotSpec(active_only=False)
    return shown(panel(spark, sf_dir, spec, ALL_BLOCKS), *GOLD_COLUMNS["v3"])


@query("gold_v3_strict")
def gold_v3_strict(spark, sf_dir):
    """Reviews and deliveries only from the time on at which they had happened."""
    spec = P.SnapshotSpec(strict_as_of=True)
    return shown(panel(spark, sf_dir, spec, ALL_BLOCKS), *GOLD_COLUMNS["v3"])


@query("active_history")
def active_history(spark, sf_dir):
    rows = P.active_history(panel(spark, sf_dir, P.SnapshotSpec(active_only=False)))
    return shown(rows, CUSTOMER, SNAPSHOT, "order_count_180d", "recency_days", "customer_lifetime_days", TARGET)


@query("snapshot_date_parts")
def snapshot_date_parts(spark, sf_dir):
    return panel(spark, sf_dir).groupBy("observation_year", "observation_month").agg(F.count("*").alias("rows"))


# ---- dataset -----------------------------------------------------------------------------


def dataset_v3(spark, sf_dir, blocks: Collection[str] = ()) -> DataFrame:
    """The dataset; its panel is stored first, since the split dates are those of its rows."""
    return D.model_dataset(stored_panel(spark, sf_dir, "v3", blocks), D.SPLIT_60_20_20)


@query("split_70_15_15")
def split_70_15_15(spark, sf_dir):
    rows = D.model_dataset(stored_panel(spark, sf_dir, "v2"), D.SPLIT_70_15_15, guard_last_dates=True)
    return shown(rows, CUSTOMER, SNAPSHOT, TARGET, SPLIT)


@query("split_60_20_20")
def split_60_20_20(spark, sf_dir):
    return shown(dataset_v3(spark, sf_dir), CUSTOMER, SNAPSHOT, TARGET, SPLIT)


@query("split_by_dates")
def split_by_dates(spark, sf_dir):
    rows = D.split_by_dates(panel(spark, sf_dir), "1998-08-31", "1998-09-30", "1999-12-31", "2000-01-31")
    return D.split_distribution(rows)


@query("split_cuts")
def split_cuts(spark, sf_dir):
    return shown(D.split_cuts(panel(spark, sf_dir), D.SPLIT_60_20_20))


@query("split_distribution")
def split_distribution(spark, sf_dir):
    return D.split_distribution(dataset_v3(spark, sf_dir))


@query("split_ranges")
def split_ranges(spark, sf_dir):
    return rounded(D.split_ranges(dataset_v3(spark, sf_dir)), 6, "churn_rate")


@query("split_completeness")
def split_completeness(spark, sf_dir):
    return D.split_completeness(dataset_v3(spark, sf_dir))


@query("split_concat")
def split_concat(spark, sf_dir):
    """Parts taken apart and put together again."""
    parts = D.split_frames(dataset_v3(spark, sf_dir))
    return R.TARGET_COUNTS(D.concat_splits(list(parts.values())))


@query("customer_overlap")
def customer_overlap(spark, sf_dir):
    return D.customer_overlap(dataset_v3(spark, sf_dir))


@query("customers_in_both")
def customers_in_both(spark, sf_dir):
    parts = D.split_frames(dataset_v3(spark, sf_dir))
    return D.overlap_between(parts["train"], parts["test"])


@query("pure_feature_ranges")
def pure_feature_ranges(spark, sf_dir):
    """All 19 features of the second generation at once: ranges of a label with a hundredth of the rows. Its leak is among them."""
    rows = stored_panel(spark, sf_dir, "v2", ALL_BLOCKS)
    return rounded(purest_ranges(rows, digits=6), 4, "low", "high")


@query("leakage_probe")
def leakage_probe(spark, sf_dir):
    """The second generation's zero-history rows share one label."""
    return D.leakage_probe(panel(spark, sf_dir, "v2"), "order_count_180d")


@query("feature_nulls")
def feature_nulls(spark, sf_dir):
    data = dataset_v3(spark, sf_dir, ALL_BLOCKS)
    return Q.null_counts(data, D.numeric_columns(data, D.feature_columns(data)))


# ---- reports -----------------------------------------------------------------------------


def _grouped_query(name: str) -> None:
    generation, blocks, report = R.GROUPED[name]

    @query(name)
    def run(spark, sf_dir):
        df = report(panel(spark, sf_dir, generation, blocks))
        return rounded(df, 6, *[c for c in ("loss_rate", "mean_revenue", "mean_recency") if c in df.columns])


def _summary_query(name: str) -> None:
    generation, blocks, columns, quartiles = R.SUMMARIES[name]

    @query(name)
    def run(spark, sf_dir):
        return summary(R.summary(panel(spark, sf_dir, generation, blocks), columns, quartiles))


for _name in R.GROUPED:
    _grouped_query(_name)
for _name in R.SUMMARIES:
    _summary_query(_name)


@query("report_sample_by_date")
def report_sample_by_date(spark, sf_dir):
    return shown(R.sample_by_date(panel(spark, sf_dir, "v3", ALL_BLOCKS)))


@query("report_latest_sample_v1")
def report_latest_sample_v1(spark, sf_dir):
    return shown(R.sample_by_date(panel(spark, sf_dir, "v1", ALL_BLOCKS), 10, latest=True))


# ---- evaluation --------------------------------------------------------------------------


def _heuristic():
    """A score both engines compute to the last bit: recent and frequent buyers score low."""
    return F.col("recency_days") / F.lit(181.0) * F.lit(0.5) + F.lit(0.5) / (
        F.lit(1.0) + F.col("order_count_180d")
    )


def scored_panel(spark, sf_dir) -> DataFrame:
    return panel(spark, sf_dir).select(
        CUSTOMER, SNAPSHOT, F.col(TARGET).alias("label"), _heuristic().alias("score")
    )


@query("ranking_metrics")
def ranking_metrics(spark, sf_dir):
    return rounded(M.ranking_metrics(scored_panel(spark, sf_dir)), 9, "pr_auc", "roc_auc", "prevalence")


@query("average_precision")
def average_precision(spark, sf_dir):
    return rounded(M.average_precision(scored_panel(spark, sf_dir)), 9, "pr_auc")


@query("roc_auc")
def roc_auc(spark, sf_dir):
    return rounded(M.roc_auc(scored_panel(spark, sf_dir)), 9, "roc_auc")


@query("ranking_metrics_distinct")
def ranking_metrics_distinct(spark, sf_dir):
    """A score that is another one in nearly every row: a hash of customer and date."""
    token = F.md5(F.concat_ws("|", CUSTOMER, F.col(SNAPSHOT).cast("string")))
    score = F.conv(F.substring(token, 1, 8), 16, 10).cast("double")
    rows = panel(spark, sf_dir).select(F.col(TARGET).alias("label"), score.alias("score"))
    return rounded(M.ranking_metrics(rows), 9, "pr_auc", "roc_auc", "prevalence")


@query("ranking_metrics_documents")
def ranking_metrics_documents(spark, sf_dir):
    """A second frame: document quality against length."""
    pairs = (
        read_table(spark, sf_dir, "labels")
        .join(read_table(spark, sf_dir, "documents"), "doc_id")
        .select(F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("score"))
    )
    return rounded(M.ranking_metrics(pairs), 9, "pr_auc", "roc_auc", "prevalence")


@query("confusion_matrix")
def confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(M.confusion_counts(scored_panel(spark, sf_dir), 0.5))


@query("threshold_metrics")
def threshold_metrics(spark, sf_dir):
    rows = M.threshold_metrics(M.confusion_counts(scored_panel(spark, sf_dir), 0.5))
    return rounded(rows, 9, "precision", "recall", "f1", "specificity")


@query("classification_report")
def classification_report(spark, sf_dir):
    rows = M.classification_report(M.confusion_counts(scored_panel(spark, sf_dir), 0.5))
    return rounded(rows, 9, "precision", "recall", "f1")


def _sweep(spark, sf_dir, grid) -> DataFrame:
    return rounded(M.threshold_sweep(scored_panel(spark, sf_dir), grid), 9, "threshold", "precision", "recall", "f1")


@query("threshold_sweep_fine")
def threshold_sweep_fine(spark, sf_dir):
    return _sweep(spark, sf_dir, M.FINE_SWEEP)


@query("threshold_sweep_coarse")
def threshold_sweep_coarse(spark, sf_dir):
    return _sweep(spark, sf_dir, M.COARSE_SWEEP)


@query("best_threshold")
def best_threshold(spark, sf_dir):
    rows = M.best_threshold(M.threshold_sweep(scored_panel(spark, sf_dir), M.FINE_SWEEP))
    return rounded(rows, 9, "threshold", "precision", "recall", "f1")


@query("baselines")
def baselines(spark, sf_dir):
    rows = M.baselines(scored_panel(spark, sf_dir))
    return rounded(rows, 9, "prevalence", "pr_auc", "roc_auc", "precision", "recall", "f1", "specificity")


@query("capacity_metrics")
def capacity_metrics(spark, sf_dir):
    return rounded(M.capacity_metrics(scored_panel(spark, sf_dir)), 9, "precision", "recall")


@query("best_candidate")
def best_candidate(spark, sf_dir):
    """Two rules compared by average precision, the better one kept."""
    rows = panel(spark, sf_dir)
    by_recency = M.ranking_metrics(rows.withColumn("s", F.col("recency_days")), TARGET, "s")
    by_both = M.ranking_metrics(rows.withColumn("s", _heuristic()), TARGET, "s")
    both = by_recency.select(F.lit("recency").alias("model"), "pr_auc").unionByName(
        by_both.select(F.lit("recency_and_count").alias("model"), "pr_auc")
    )
    return rounded(M.best_row(both, "pr_auc", "model"), 9, "pr_auc")


# ---- scoring -----------------------------------------------------------------------------


def decided_panel(spark, sf_dir) -> DataFrame:
    rows = panel(spark, sf_dir).withColumn(S.PROBABILITY, _heuristic())
    return S.decide(rows.select(CUSTOMER, SNAPSHOT, TARGET, S.PROBABILITY), 0.5)


@query("threshold_decision")
def threshold_decision(spark, sf_dir):
    return shown(decided_panel(spark, sf_dir), CUSTOMER, SNAPSHOT, S.PROBABILITY, "churn_prediction", "threshold")


@query("risk_band")
def risk_band(spark, sf_dir):
    return S.band_histogram(decided_panel(spark, sf_dir))


@query("batch_summary")
def batch_summary(spark, sf_dir):
    rows = panel(spark, sf_dir, "v3", ALL_BLOCKS).withColumn(S.PROBABILITY, _heuristic())
    rows = rows.withColumn("recency_days", F.when(F.col("recency_days") > 3, F.col("recency_days")))
    return S.batch_summary(S.decide(rows, 0.5))


@query("top100_risk")
def top100_risk(spark, sf_dir):
    rows = panel(spark, sf_dir).select(CUSTOMER, SNAPSHOT, TARGET, _heuristic().alias(S.PROBABILITY))
    top = S.decide(S.top_risk(rows, 100, ties=[SNAPSHOT, CUSTOMER]), 0.5)
    return shown(top, CUSTOMER, SNAPSHOT, TARGET, S.PROBABILITY, "churn_prediction", "risk_band")


def _dirty_batch(spark, sf_dir) -> DataFrame:
    """The panel as text with broken values in some rows."""
    rows = panel(spark, sf_dir, "v3", ALL_BLOCKS).select(
        CUSTOMER, SNAPSHOT, *[F.col(f).cast("string").alias(f) for f in FEATURES]
    )
    k = F.col(CUSTOMER).cast("long")
    return rows.withColumns(
        {
            "revenue_180d": F.when(k % 7 == 0, "invalid").otherwise(F.col("revenue_180d")),
            "late_delivery_rate_180d": F.when(k % 11 == 0, "1.5").otherwise(F.col("late_delivery_rate_180d")),
            "recency_days": F.when(k % 13 == 0, "-1").otherwise(F.col("recency_days")),
            "item_count_180d": F.when(k % 17 != 0, F.col("item_count_180d")),
        }
    )


@query("row_constraints")
def row_constraints(spark, sf_dir):
    """Broken constraints counted by reason."""
    return S.reject_counts(_dirty_batch(spark, sf_dir))


@query("rejected_rows")
def rejected_rows(spark, sf_dir):
    """Rows set aside, with their reasons."""
    rows = S.rejected_rows(_dirty_batch(spark, sf_dir))
    return shown(rows.withColumn("reasons", F.array_join("reject_reasons", "; ")), CUSTOMER, SNAPSHOT, "reasons")


@query("valid_rows")
def valid_rows(spark, sf_dir):
    good = S.valid_rows(_dirty_batch(spark, sf_dir))
    return good.agg(F.count("*").alias("rows"), F.sum("order_count_180d").cast("long").alias("orders"))


@query("seeded_sample")
def seeded_sample(spark, sf_dir):
    rows = panel(spark, sf_dir).withColumn("day", F.col(SNAPSHOT).cast("string"))
    return shown(S.seeded_sample(rows.select(CUSTOMER, "day", TARGET), [CUSTOMER, "day"]))


# ---- attribution tables ------------------------------------------------------------------


@query("importance_share")
def importance_share(spark, sf_dir):
    """Mean absolute deviation from 1 of each feature as a stand-in importance; the two strongest."""
    from panelmill.operators.explain import mean_absolute, top_features

    table = mean_absolute(panel(spark, sf_dir, "v3", ALL_BLOCKS).select(*[(F.col(n) - 1).alias(n) for n in FEATURES]))
    return rounded(top_features(table, 2, "mean_abs_value"), 6, "mean_abs_value", "importance_pct")


@query("mean_abs_attribution")
def mean_abs_attribution(spark, sf_dir):
    from panelmill.operators.explain import mean_absolute

    # attributions of a fixed linear rule: coefficient times distance from a centre, both from the place of the feature
    rows = panel(spark, sf_dir, "v3", ALL_BLOCKS).select(
        *[(F.lit((-1) ** i / (i + 2)) * (F.col(f) - F.lit(float(i)))).alias(f) for i, f in enumerate(FEATURES)]
    )
    return rounded(mean_absolute(rows), 6, "mean_abs_value", "importance_pct")


@query("attribution_headline")
def attribution_headline(spark, sf_dir):
    from panelmill.operators.explain import headline, mean_absolute

    table = mean_absolute(panel(spark, sf_dir, "v3", ALL_BLOCKS).select(*FEATURES))
    return rounded(headline(table), 6, "top_value", "top_share_pct")


# ---- models ------------------------------------------------------------------------------
#
# What a fitted model says can't be stated in SQL, but what must hold of it can: how many rows it
# scores, that decisions follow from its probabilities, that attributions add up to its output.

_DATASETS: dict[tuple[str, str], DataFrame] = {}
_MODELS: dict[tuple[str, str, str], object] = {}


def _dataset(spark, sf_dir) -> DataFrame:
    """The stored dataset, once for each application and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DATASETS:
        _DATASETS[key] = X.staged(dataset_v3(spark, sf_dir, ALL_BLOCKS), "dataset")
    return _DATASETS[key]


def _parts(spark, sf_dir) -> dict[str, DataFrame]:
    return D.split_frames(_dataset(spark, sf_dir))


def _once(spark, sf_dir, kind: str, make):
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _MODELS:
        _MODELS[key] = make()
    return _MODELS[key]


def _model(spark, sf_dir, kind: str):
    """A candidate of full size, fitted once for each application and input."""
    from panelmill.operators import models as L

    train = _parts(spark, sf_dir)["train"]
    shared = _once(spark, sf_dir, "prepared", lambda: L.prepared(train))
    total = L.class_weights(shared[1]).first()["total_weight"]
    estimator, scheme = {
        "logistic": (L.logistic(total), "balanced"),
        "forest": (L.forest(), "balanced"),
        "boosting": (L.boosting(), "retained"),
        "perceptron": (L.perceptron(), None),
    }[kind]
    return _once(spark, sf_dir, kind, lambda: L.fit(train, estimator, scheme=scheme, shared=shared))


def _facts(exact: DataFrame, decide: Callable[[DataFrame], DataFrame], threshold: float, name: str) -> DataFrame:
    """One row: rows and positives scored, probabilities out of range, decisions and bands that don't follow from them.

    What is expected rides along with the rows that are decided, so that both meet without a join.
    """
    p = F.col(S.PROBABILITY)
    expected = exact.select("*", p.alias("_p"), (p >= F.lit(threshold)).cast("int").alias("_yes"), S.risk_band(p).alias("_band"))
    return decide(expected).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(TARGET) == 1).alias("positives"),
        F.count_if(~F.coalesce(F.col("_p").between(0, 1), F.lit(False))).alias("out_of_range"),
        F.count_if(F.col("_yes") != F.col("churn_prediction")).alias("decisions_off"),
        F.count_if(F.col("_band") != F.col("risk_band")).alias("bands_off"),
        F.count_if(F.abs(F.col("_p") - p) > 5.1e-7).alias("rounding_off"),
    ).select(F.lit(name).alias("model"), "*")


def _scored(spark, sf_dir, kind: str, part: str) -> DataFrame:
    rows = _parts(spark, sf_dir)[part]
    return X.staged(S.with_probability(rows, _model(spark, sf_dir, kind)), "scored")


def _fit_query(name: str, kind: str) -> None:
    @query(name)
    def run(spark, sf_dir):
        exact = _scored(spark, sf_dir, kind, "validation")
        return _facts(exact, lambda rows: S.decide(rows, 0.5), 0.5, name)


_fit_query("logistic_fit", "logistic")
_fit_query("forest_fit", "forest")
_fit_query("gbt_fit", "boosting")
_fit_query("mlp_fit", "perceptron")


@query("leafwise_boosting")
def leafwise_boosting(spark, sf_dir):
    """Boosting best leaf first, 40 trees of 31 leaves: validation rows scored, and trees or losses that break a bound."""
    from panelmill.operators import boosting as B
    from panelmill.operators.models import class_weights

    parts = _parts(spark, sf_dir)

    def make():
        w = class_weights(parts["train"], "retained").first()  # one row
        return B.fit(parts["train"], B.Growth(trees=40, rate=0.1), weights=(w["negative_weight"], w["positive_weight"]))

    model = _once(spark, sf_dir, "leafwise", make)
    losses = [model.losses[k] for k in sorted(model.losses)]
    return B.scored(parts["validation"], model).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(TARGET) == 1).alias("positives"),
        F.count_if(~F.coalesce(F.col(S.PROBABILITY).between(0, 1), F.lit(False))).alias("out_of_range"),
    ).select(
        "*",
        F.lit(len(model.trees)).alias("trees"),
        F.lit(sum(len(t.values) > 31 for t in model.trees)).alias("trees_too_large"),
        F.lit(sum(len(t.columns) != 15 for t in model.trees)).alias("draws_off"),
        F.lit(sum(b >= a for a, b in zip(losses, losses[1:]))).alias("losses_not_falling"),
    )


@query("relu_network")
def relu_network(spark, sf_dir):
    """The network of rectified units, at most 30 epochs: validation rows scored, and what breaks a bound of its training."""
    from panelmill.operators import models as L
    from panelmill.operators import network as N

    parts = _parts(spark, sf_dir)
    prepared, vectors = _once(spark, sf_dir, "prepared", lambda: L.prepared(parts["train"]))
    model = _once(spark, sf_dir, "relu", lambda: N.fit(vectors, N.Training(rate=0.002, epochs=30)))
    rows = prepared.transform(parts["validation"]).select(TARGET, N.probability(model).alias("p"))
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(TARGET) == 1).alias("positives"),
        F.count_if(~F.coalesce(F.col("p").between(0, 1), F.lit(False))).alias("out_of_range"),
    ).select(
        "*",
        F.lit(int(len(model.losses) > 30)).alias("epochs_over"),
        F.lit(int(min(model.losses) >= model.losses[0])).alias("nothing_learnt"),
    )


@query("logistic_gradient")
def logistic_gradient(spark, sf_dir):
    """Largest slope of the penalised weighted loss at the fitted coefficients, and rows it is taken over."""
    from pyspark.ml.functions import vector_to_array

    from panelmill.operators import models as L

    last = _model(spark, sf_dir, "logistic").stages[-1]
    vectors = _once(spark, sf_dir, "prepared", lambda: None)[1]
    rows = L.weighted(vectors).select(vector_to_array("features").alias("x"), F.col(TARGET).alias("y"), F.col(L.WEIGHT).alias("w"))
    coefficients = [float(c) for c in last.coefficients]
    margin = sum((F.col("x")[i] * F.lit(c) for i, c in enumerate(coefficients)), F.lit(float(last.intercept)))
    error = rows.select("x", "w", (F.col("w") * (1 / (1 + F.exp(-margin)) - F.col("y"))).alias("e"))
    penalty = last.getRegParam()
    total = F.sum("w")
    slopes = [F.abs(F.sum(F.col("e") * F.col("x")[i]) / total + F.lit(penalty * c)) for i, c in enumerate(coefficients)]
    return error.agg(
        F.count("*").alias("rows"), F.round(F.greatest(F.abs(F.sum("e") / total), *slopes), 3).alias("steepest")
    )


@query("class_weights")
def class_weights(spark, sf_dir):
    from panelmill.operators.models import class_weights

    rows = panel(spark, sf_dir)
    out = None
    for scheme in ("balanced", "retained", "scaled"):
        one = class_weights(rows, scheme).select(F.lit(scheme).alias("scheme"), "*")
        out = one if out is None else out.unionByName(one)
    return rounded(out, 6, "negative_weight", "positive_weight", "total_weight")


@query("grid_search")
def grid_search(spark, sf_dir):
    """The whole grid: points tried, rows each was scored on, metrics out of range, and whether the first row is the best."""
    from panelmill.operators.models import grid_search as search

    parts = _parts(spark, sf_dir)
    table = X.staged(search(parts["train"], parts["validation"])[0], "grid")
    best = F.max_by("point", F.struct("pr_auc", -F.col("point"))).alias("best")
    first = Q.sample_rows(table.orderBy(F.desc("pr_auc"), "point"), 1).select("point")
    return table.agg(
        F.count("*").alias("points"),
        F.count_distinct("depth", "rate", "trees").alias("distinct_points"),
        F.max("trees").alias("most_trees"),
        F.min("scored_rows").alias("least_rows"),
        F.max("scored_rows").alias("most_rows"),
        F.count_if(~F.col("pr_auc").between(0, 1) | ~F.col("roc_auc").between(0, 1)).alias("out_of_range"),
        best,
    ).join(first, F.col("best") == F.col("point"), "left").select(
        "points", "distinct_points", "most_trees", "least_rows", "most_rows", "out_of_range", F.col("point").isNotNull().cast("int").alias("best_is_first")
    )


@query("training_workflow")
def training_workflow(spark, sf_dir):
    """Candidates, champion, threshold, one test, explanations: the stored run read back and checked against itself."""
    from panelmill.plans.training import explain, store, train

    path = scratch_path(spark, "run")
    run = train(_dataset(spark, sf_dir))
    store(run, path)
    explain(run, path)

    def read(name: str) -> DataFrame:
        return X.read_csv(spark, f"{path}/{name}", infer=True)

    record = spark.read.json(f"{path}/run_record")
    results = read("model_results").agg(F.count("*").alias("candidates"), F.max_by("model", F.struct("pr_auc")).alias("best"))
    sweep = read("threshold_results").agg(F.count("*").alias("thresholds"), F.max("f1").alias("top"))
    chosen = read("threshold_results").select(F.col("threshold").alias("_t"), F.col("f1").alias("_f1"))
    matrix = read("test_confusion").agg(F.sum("rows").cast("long").alias("confusion_rows"))
    predictions = X.read_parquet(spark, f"{path}/test_predictions").agg(
        F.count("*").alias("prediction_rows"), F.count_if(F.col(TARGET) == 1).alias("test_positives")
    )
    risky = read("high_risk").agg(F.count("*").alias("high_risk_rows"), F.count(TARGET).alias("labelled"))
    # one row each
    one = record.crossJoin(results).crossJoin(sweep).crossJoin(matrix).crossJoin(predictions).crossJoin(risky)
    return one.join(chosen, F.abs(F.col("threshold") - F.col("_t")) < 1e-9).select(
        "candidates",
        (F.col("best") == F.col("champion_model")).cast("int").alias("champion_is_best"),
        "thresholds",
        (F.col("_f1") == F.col("top")).cast("int").alias("threshold_is_best"),
        "train_rows", "validation_rows", "test_rows", "train_last", "test_first",
        "confusion_rows", "prediction_rows", "test_positives", "high_risk_rows", "labelled",
    )


@query("batch_scoring")
def batch_scoring(spark, sf_dir):
    """Test period as a batch: features checked, probability, decision, band."""
    exact = _scored(spark, sf_dir, "logistic", "test")
    model = _model(spark, sf_dir, "logistic")
    return _facts(exact, lambda rows: S.score(rows.drop(S.PROBABILITY), model), S.SCORE_THRESHOLD, "batch_scoring")


@query("high_risk_sample")
def high_risk_sample(spark, sf_dir):
    """The hundred highest probabilities of the test period: how many, and rows left out that are higher."""
    exact = _scored(spark, sf_dir, "boosting", "test").select(CUSTOMER, SNAPSHOT, TARGET, S.PROBABILITY)
    top = X.staged(S.top_risk(exact, 100, ties=[SNAPSHOT, CUSTOMER]), "top")
    floor = top.agg(F.count("*").alias("rows"), F.count(TARGET).alias("labelled"), F.min(S.PROBABILITY).alias("least"))
    others = exact.join(top.select(CUSTOMER, SNAPSHOT), [CUSTOMER, SNAPSHOT], "left_anti").crossJoin(F.broadcast(floor))
    missed = others.agg(F.count_if(F.col(S.PROBABILITY) > F.col("least")).alias("higher_left_out"))
    return floor.crossJoin(missed).select("rows", "labelled", "higher_left_out")


@query("forest_importance")
def forest_importance(spark, sf_dir):
    from panelmill.operators.explain import model_importance

    table = model_importance(spark, _model(spark, sf_dir, "forest"))
    return table.agg(
        F.count("*").alias("features"),
        F.count_if(F.col("importance") < 0).alias("negative"),
        F.round(F.sum("importance_pct"), 3).alias("total_pct"),
    )


def _attribution_facts(spark, sf_dir, kind: str, output) -> DataFrame:
    """Rows attributed, and the largest gap between base value plus attributions and the model's output."""
    from panelmill.operators.explain import linear_attribution, mean_absolute, tree_attribution

    model, test = _model(spark, sf_dir, kind), _parts(spark, sf_dir)["test"]
    attribute = linear_attribution if kind == "logistic" else tree_attribution
    # the output rides along with its row, so that both meet without a join
    said = model.transform(test).select(*test.columns, output.alias("_said"))
    values = X.staged(attribute(said, model, (CUSTOMER, SNAPSHOT, "_said")), "attributions")
    whole = sum((F.col(f) for f in FEATURES), F.col("base_value"))
    gap = values.agg(
        F.count("*").alias("rows"), F.round(F.max(F.abs(whole - F.col("_said"))), 6).alias("gap")
    )
    shares = mean_absolute(values.drop("_said")).agg(F.round(F.sum("importance_pct"), 3).alias("total_pct"))
    return gap.crossJoin(shares)  # one row each


@query("linear_attribution")
def linear_attribution(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    return _attribution_facts(spark, sf_dir, "logistic", vector_to_array("rawPrediction")[1])


@query("tree_attribution")
def tree_attribution(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    return _attribution_facts(spark, sf_dir, "boosting", 2 * vector_to_array("rawPrediction")[1])
