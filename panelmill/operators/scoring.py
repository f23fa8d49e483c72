"""Scoring: row constraints, ordered feature vector, decision, risk band, summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.functions.columns import band, finite_double, safe_cast
from panelmill.operators.cleaning import require_columns
from panelmill.schema import FEATURE_BOUNDS, FEATURES, RISK_BANDS, SCORE_THRESHOLD, TOP_RISK_BAND

PROBABILITY = "churn_probability"


REASONS = ("missing", "not a number", "too low", "too high")


def _broken(name: str, low: float | None, high: float | None) -> list[Column]:
    """One flag per reason, in their order; at most one holds. ``_v_{name}`` is the value as a number."""
    value, missing = F.col(f"_v_{name}"), F.col(name).isNull()
    text = ~missing & value.isNull()
    # NaN compares as the largest number here, but satisfies no bound
    unordered = F.isnan(value) if (low, high) != (None, None) else F.lit(False)
    below = unordered if low is None else unordered | (value < F.lit(low))
    above = F.lit(False) if high is None else ~unordered & (value > F.lit(high))
    return [missing, text, F.coalesce(below, F.lit(False)), F.coalesce(above, F.lit(False))]


def _with_numbers(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    require_columns(df, list(bounds), "features")
    return df.withColumns({f"_v_{name}": safe_cast(name, "double") for name in bounds})


def reject_reasons(
    df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]] = FEATURE_BOUNDS
) -> DataFrame:
    """Add ``reject_reasons``: one entry per broken constraint, empty for a valid row."""
    entries = []
    for name, (low, high) in bounds.items():
        entry = F  # one case for a feature: its flags exclude each other
        for flag, reason in zip(_broken(name, low, high), REASONS):
            entry = entry.when(flag, f"{name}: {reason}")
        entries.append(entry)
    nothing = F.array(F.lit(None).cast("string"))  # an expression of its own code, unlike a filter by function
    checked = _with_numbers(df, bounds).withColumn("reject_reasons", F.array_except(F.array(*entries), nothing))
    return checked.drop(*[f"_v_{name}" for name in bounds])


def reject_counts(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]] = FEATURE_BOUNDS) -> DataFrame:
    """Rows per broken constraint: one aggregation, without a row for each reason."""
    counts, rows = [], []
    for i, (name, (low, high)) in enumerate(bounds.items()):
        for k, (flag, reason) in enumerate(zip(_broken(name, low, high), REASONS)):
            counts.append(F.count_if(flag).alias(f"_{i}_{k}"))
            rows.append(F.struct(F.lit(f"{name}: {reason}").alias("reason"), F.col(f"_{i}_{k}").alias("rows")))
    counted = _with_numbers(df, bounds).agg(*counts)
    return counted.select(F.inline(F.array(*rows))).where("rows > 0")


def valid_rows(df: DataFrame, bounds=FEATURE_BOUNDS) -> DataFrame:
    """Rows that keep every constraint, features as doubles."""
    broken = F.lit(False)
    for name, (low, high) in bounds.items():
        for flag in _broken(name, low, high):
            broken = broken | flag
    kept = _with_numbers(df, bounds).where(~broken)
    return kept.withColumns({name: F.col(f"_v_{name}") for name in bounds}).drop(*[f"_v_{name}" for name in bounds])


def rejected_rows(df: DataFrame, bounds=FEATURE_BOUNDS) -> DataFrame:
    """Rows that break a constraint, with their reasons."""
    return reject_reasons(df, bounds).where(F.size("reject_reasons") > 0)


def numeric_features(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Features as finite doubles; malformed text and infinities become NULL for the imputer."""
    require_columns(df, features, "features")
    return df.withColumns({f: finite_double(f) for f in features})


def risk_band(probability: Column) -> Column:
    return band(probability, RISK_BANDS, TOP_RISK_BAND, inclusive=False)


def decide(df: DataFrame, threshold: float = SCORE_THRESHOLD, probability: str = PROBABILITY) -> DataFrame:
    """Prediction, band and threshold from the exact probability; rounding comes last."""
    p = F.col(probability)
    return df.select(
        *[c for c in df.columns if c != probability],
        (p >= F.lit(threshold)).cast("int").alias("churn_prediction"),
        risk_band(p).alias("risk_band"),
        F.lit(threshold).alias("threshold"),
        F.round(p, 6).alias(probability),
    )


def with_probability(df: DataFrame, model: Model, name: str = PROBABILITY) -> DataFrame:
    """Probability of the positive class from a fitted pipeline; helper columns are dropped."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


def score(
    df: DataFrame, model: Model, threshold: float = SCORE_THRESHOLD, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Batch scoring: features checked and ordered, then probability, decision and band."""
    return decide(with_probability(numeric_features(df, features), model), threshold)


def batch_summary(scored: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """One row: total, predicted churn, rows per band, rows with any missing feature."""
    any_missing = F.lit(False)
    for f in features:
        if f in scored.columns:
            any_missing = any_missing | F.col(f).isNull()
    return scored.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("churn_prediction") == 1).alias("predicted_churn"),
        F.count_if(F.col("risk_band") == "High").alias("high_risk"),
        F.count_if(F.col("risk_band") == "Medium").alias("medium_risk"),
        F.count_if(F.col("risk_band") == "Low").alias("low_risk"),
        F.count_if(any_missing).alias("rows_with_missing"),
    )


def band_histogram(scored: DataFrame) -> DataFrame:
    """Rows per band, empty bands included."""
    counted = scored.agg(
        *[F.count_if(F.col("risk_band") == b).alias(b) for b in ("High", "Medium", "Low")]
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(b).alias("risk_band"), F.col(b).alias("customers"))
                    for b in ("High", "Medium", "Low")
                ]
            )
        )
    )


def top_risk(scored: DataFrame, n: int = 100, probability: str = PROBABILITY, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the highest probability.

    For the exact probability: rounded values tie where the exact ones don't, so ``decide`` comes after.
    """
    return scored.orderBy(F.desc(probability), *ties).limit(n)


def seeded_sample(df: DataFrame, ids: Sequence[str], n: int = 5000, seed: int = 42) -> DataFrame:
    """At most n rows, the same ones on every run: smallest hash of seed and id."""
    token = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]))
    return df.withColumn("_token", token).orderBy("_token", *ids).limit(n).drop("_token")
