"""Evaluation of (label, score) frames as aggregates.

Rows are first collapsed to one cell per distinct score. Ranking metrics then
need running sums over scores in descending order. Those are taken in two
levels: cells fall into score ranges of about equal size, sums run inside each
range in parallel, and each range starts from the total of the ranges above.
No window ever spans the whole data.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.sources.tables import staged

#: Cells of one range at least; and ranges at most, which bounds the edges that go through the driver.
RANGE_CELLS, MOST_RANGES = 10_000, 10_000


def score_cells(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def stored_cells(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Cells as a stored table: scoring and collapsing run once for all metrics."""
    return staged(score_cells(df.where(F.col(score).isNotNull()), label, score), "score-cells")


def ranked_cells(cells: DataFrame, ranges: int | None = None) -> DataFrame:
    """Cells with positives and negatives at the same or a higher score, and the totals.

    ``cells`` should be stored, four jobs read it. There are as many ranges as their number
    asks for. The range edges are driver-side numbers, so every branch of the plan sees the same.
    """
    if ranges is None:
        ranges = min(MOST_RANGES, 1 + cells.count() // RANGE_CELLS)
    grid = [i / ranges for i in range(1, ranges)]
    inner = cells.approxQuantile("score", grid, 1 / (4 * ranges)) if ranges > 1 else []
    if inner:
        edges = [float("-inf"), *sorted(set(inner)), float("inf")]
        ranged = Bucketizer(splits=edges, inputCol="score", outputCol="_range").transform(cells)
    else:
        ranged = cells.withColumn("_range", F.lit(0.0))

    # at most one row per range
    totals = ranged.groupBy("_range").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    above = Window.partitionBy().orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        "_range",
        F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_pos_above"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_neg_above"),
        F.sum("_p").over(everything).alias("total_pos"),
        F.sum("_n").over(everything).alias("total_neg"),
    )
    inside = Window.partitionBy("_range").orderBy(F.desc("score"))
    return (
        ranged.withColumn("_cum_pos", F.sum("pos").over(inside))
        .withColumn("_cum_neg", F.sum("neg").over(inside))
        .join(F.broadcast(offsets), "_range")  # bounded by the number of ranges
        .select(
            "score",
            "pos",
            "neg",
            (F.col("_cum_pos") + F.col("_pos_above")).alias("cum_pos"),
            (F.col("_cum_neg") + F.col("_neg_above")).alias("cum_neg"),
            "total_pos",
            "total_neg",
        )
    )


def _ratio(a: Column, b: Column) -> Column:
    """0 where undefined."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def ranking_metrics(df: DataFrame, label: str = "label", score: str = "score", ranges: int | None = None) -> DataFrame:
    """Average precision and area under the ROC curve, beside their trivial baselines.

    Average precision is the step-wise sum of precision over gains in recall, not
    a trapezoid. Equal scores form one step, and share half credit in the ROC area.
    """
    return ranking_of_cells(stored_cells(df, label, score), ranges)


def ranking_of_cells(cells: DataFrame, ranges: int | None = None) -> DataFrame:
    ranked = ranked_cells(cells, ranges)
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    neg_above = F.col("cum_neg") - F.col("neg")
    summed = ranked.agg(
        F.sum(F.col("pos") * precision).alias("_ap"),
        F.sum(F.col("pos") * (neg_above + F.col("neg") / 2)).alias("_lost"),
        F.max("total_pos").alias("positives"),
        F.max("total_neg").alias("negatives"),
    )
    p, n = F.col("positives"), F.col("negatives")
    return summed.select(
        F.when(p > 0, F.col("_ap") / p).alias("pr_auc"),
        F.when((p > 0) & (n > 0), 1 - F.col("_lost") / (p.cast("double") * n)).alias("roc_auc"),
        _ratio(p, p + n).alias("prevalence"),
        "positives",
        "negatives",
    )


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return ranking_metrics(df, label, score).select("pr_auc")


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return ranking_metrics(df, label, score).select("roc_auc")


def confusion_counts(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """One row tn, fp, fn, tp at ``score >= threshold``."""
    said, is_ = F.col(score) >= F.lit(threshold), F.col(label) == 1
    return df.agg(
        F.count_if(~is_ & ~said).alias("tn"),
        F.count_if(~is_ & said).alias("fp"),
        F.count_if(is_ & ~said).alias("fn"),
        F.count_if(is_ & said).alias("tp"),
    )


def confusion_of_cells(cells: DataFrame, threshold: float) -> DataFrame:
    """The same from cells."""
    said, pos, neg = F.col("score") >= F.lit(threshold), F.col("pos"), F.col("neg")

    def total(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))

    return cells.agg(
        total(~said, neg).alias("tn"),
        total(said, neg).alias("fp"),
        total(~said, pos).alias("fn"),
        total(said, pos).alias("tp"),
    )


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """All four cells as rows, empty ones included."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("rows"))
                    for a, p, c in cells
                ]
            )
        )
    )


def _prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    return _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn)


def threshold_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and specificity from confusion counts; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall, f1 = _prf(tp, fp, fn)
    return counts.select(
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        _ratio(tn, tn + fp).alias("specificity"),
        "tn",
        "fp",
        "fn",
        "tp",
    )


def classification_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p1, r1, f1 = _prf(tp, fp, fn)
    p0, r0, f0 = _prf(tn, fn, fp)
    s0, s1 = tn + fp, tp + fn
    accuracy = _ratio(tp + tn, s0 + s1)

    def line(name: str, p: Column, r: Column, f: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            support.alias("support"),
        )

    def weighted(a: Column, b: Column) -> Column:
        return _ratio(a * s0 + b * s1, s0 + s1)

    return counts.select(
        F.inline(
            F.array(
                line("0", p0, r0, f0, s0),
                line("1", p1, r1, f1, s1),
                line("accuracy", accuracy, accuracy, accuracy, s0 + s1),
                line("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1),
                line("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), s0 + s1),
            )
        )
    )


# First threshold, step and number of steps of the two sweeps.
COARSE_SWEEP = (0.05, 0.05, 19)
FINE_SWEEP = (0.01, 0.01, 99)


def threshold_sweep(
    df: DataFrame,
    sweep: tuple[float, float, int] = FINE_SWEEP,
    label: str = "label",
    score: str = "score",
) -> DataFrame:
    """Precision, recall and F1 at each threshold of a regular grid.

    Each row only learns the highest threshold it reaches; the rest runs on that
    histogram of at most ``count + 1`` rows.
    """
    return sweep_of_cells(score_cells(df, label, score), sweep)


def sweep_of_cells(cells: DataFrame, sweep: tuple[float, float, int] = FINE_SWEEP) -> DataFrame:
    """The same from cells, which combine equal scores."""
    start, step, count = sweep

    def at(k: Column) -> Column:
        return F.lit(start) + k * F.lit(step)

    s = F.col("score")
    guess = F.floor((s - F.lit(start)) / F.lit(step)).cast("int")
    # the division may be one off in the last bit, the comparison decides
    exact = F.when(s >= at(guess + 1), guess + 1).when(s >= at(guess), guess).otherwise(guess - 1)
    reached = F.greatest(F.lit(-1), F.least(F.lit(count - 1), exact))
    histogram = cells.groupBy(reached.alias("k")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    grid = cells.sparkSession.range(-1, count, 1, 1).select(F.col("id").cast("int").alias("k"))
    filled = grid.join(F.broadcast(histogram), "k", "left").select(
        "k", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg")
    )
    up = Window.partitionBy().orderBy(F.desc("k"))
    whole = Window.partitionBy()
    counted = filled.select(
        "k",
        F.sum("pos").over(up).alias("tp"),
        F.sum("neg").over(up).alias("fp"),
        F.sum("pos").over(whole).alias("_positives"),
    ).where(F.col("k") >= 0)
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("_positives") - F.col("tp"))
    return counted.select(
        at(F.col("k")).alias("threshold"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
    )


def best_threshold(swept: DataFrame) -> DataFrame:
    """Highest F1; the lowest threshold among equals."""
    return swept.orderBy(F.desc("f1"), "threshold").limit(1)


def best_row(metrics: DataFrame, metric: str, *ties: str) -> DataFrame:
    """Row with the highest value of a metric."""
    return metrics.orderBy(F.desc(metric), *ties).limit(1)


def baselines(df: DataFrame, label: str = "label") -> DataFrame:
    """What two constant rules reach: calling every row positive, and scoring by the prior."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n")
    )
    p, n = F.col("_p"), F.col("_n")
    prevalence = _ratio(p, p + n)
    zero, one, half = F.lit(0.0), F.lit(1.0), F.lit(0.5)
    says_yes = prevalence >= 0.5

    def line(name: str, precision: Column, recall: Column, specificity: Column) -> Column:
        return F.struct(
            F.lit(name).alias("baseline"),
            prevalence.alias("prevalence"),
            prevalence.alias("pr_auc"),
            half.alias("roc_auc"),
            precision.alias("precision"),
            recall.alias("recall"),
            _ratio(2 * precision * recall, precision + recall).alias("f1"),
            specificity.alias("specificity"),
        )

    return counts.select(
        F.inline(
            F.array(
                line("always_positive", prevalence, one, zero),
                line(
                    "prior",
                    F.when(says_yes, prevalence).otherwise(zero),
                    F.when(says_yes, one).otherwise(zero),
                    F.when(says_yes, zero).otherwise(one),
                ),
            )
        )
    )


def capacity_metrics(
    df: DataFrame, fractions: tuple[float, ...] = (0.01, 0.05, 0.10, 0.20), label: str = "label", score: str = "score"
) -> DataFrame:
    """Precision and recall when only a fixed share of rows, best scores first, can be treated.

    Where the last place falls inside a group of equal scores, that group counts
    by its share: the mean over all orders of the tied rows.
    """
    ranked = ranked_cells(stored_cells(df, label, score))
    size = F.col("pos") + F.col("neg")
    before = F.col("cum_pos") + F.col("cum_neg") - size

    def places(f: float) -> Column:
        return F.floor((F.col("total_pos") + F.col("total_neg")) * F.lit(f))

    def hits(f: float) -> Column:
        taken = F.greatest(F.lit(0), F.least(size, places(f) - before))
        return F.sum(F.col("pos") * taken / size)

    row = ranked.agg(
        *[hits(f).alias(f"_h{i}") for i, f in enumerate(fractions)],
        *[F.max(places(f)).alias(f"_k{i}") for i, f in enumerate(fractions)],
        F.max("total_pos").alias("_p"),
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f).alias("capacity"),
                        F.col(f"_k{i}").alias("places"),
                        _ratio(F.col(f"_h{i}"), F.col(f"_k{i}")).alias("precision"),
                        _ratio(F.col(f"_h{i}"), F.col("_p")).alias("recall"),
                    )
                    for i, f in enumerate(fractions)
                ]
            )
        )
    )
