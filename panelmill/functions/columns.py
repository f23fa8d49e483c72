"""Casts, cleaning rules, bands and guarded arithmetic as plain column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def clean_text(name: str) -> Column:
    """Trimmed string; an empty string stays an empty string."""
    return F.trim(F.col(quoted(name)).cast("string"))


def safe_cast(name: str, type_name: str) -> Column:
    """Cast that turns a malformed value into NULL, also with ANSI mode on."""
    return F.expr(f"try_cast({quoted(name)} AS {type_name})")


def apply_rule(name: str, rule: str) -> Column:
    """One cleaning rule of :class:`panelmill.schema.EntitySpec`."""
    if rule in ("int", "double", "timestamp"):
        return safe_cast(name, rule)
    text = clean_text(name)
    if rule == "lower":
        return F.lower(text)
    if rule == "upper":
        return F.upper(text)
    return text


def standard_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Snake-case all column names in one projection; two names that meet are an error."""
    names = [standard_name(c) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"column names collide after standardising: {clash}")
    return df.toDF(*names)


def band(value: Column, edges: Sequence[tuple[float, str]], last: str, inclusive: bool = True) -> Column:
    """Label of the first edge the value stays under (``<=`` or ``<``), else ``last``."""
    out: Column | None = None
    for edge, label in edges:
        hit = value <= F.lit(edge) if inclusive else value < F.lit(edge)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(last) if out is None else out.otherwise(last)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0 where the denominator is 0 or NULL."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def percent(fraction: Column, digits: int = 3) -> Column:
    return F.round(fraction * 100, digits)


def fill_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Zero for NULL in one projection."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def finite_double(name: str) -> Column:
    """Number or NULL: malformed text, NaN and the infinities all become NULL."""
    number = safe_cast(name, "double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def month_index(day: Column) -> Column:
    """Months since year 0, so month arithmetic is integer arithmetic."""
    return F.year(day) * 12 + F.month(day) - 1


def month_end(index: Column) -> Column:
    """Last calendar day of a month index."""
    first = F.make_date((F.floor(index / 12)).cast("int"), (index % 12 + 1).cast("int"), F.lit(1))
    return F.last_day(first)
