"""Amount features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Steps of the amount scales (upper bound, result).
CATEGORY_UPTO = ((50.0, "Low"), (200.0, "Medium"), (1000.0, "High"))
CATEGORY_REST = "Very_High"
PERCENTILE_UPTO = (
    (0.0, 0.1),
    (5.0, 0.25),
    (25.0, 0.5),
    (50.0, 0.7),
    (100.0, 0.85),
    (200.0, 0.95),
    (500.0, 0.99),
    (1000.0, 1.0),
)
PERCENTILE_REST = 1.0
RANGE_BELOW = ((10.0, 0), (100.0, 1), (500.0, 2), (1000.0, 3))
RANGE_REST = 4
BAND_BELOW = ((10.0, "< $10"), (50.0, "$10-$50"), (100.0, "$50-$100"), (500.0, "$100-$500"))
BAND_REST = "> $500"
ZSCORE_MEAN = 88.35
ZSCORE_STD = 250.12


def _steps(x: Column, steps: Sequence[tuple], rest, inclusive: bool) -> Column:
    """First step whose bound lies above ``x``; null falls to ``rest``."""
    out = None
    for bound, value in steps:
        hit = x <= bound if inclusive else x < bound
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out.otherwise(F.lit(rest))


def amount_log(amount: Column) -> Column:
    """``log(1 + amount)``, with amounts below zero taken as zero."""
    return F.log1p(F.when(amount < 0, F.lit(0.0)).otherwise(amount))


def amount_category(amount: Column) -> Column:
    return _steps(amount, CATEGORY_UPTO, CATEGORY_REST, inclusive=True)


def amount_percentile_step(amount: Column) -> Column:
    return _steps(amount, PERCENTILE_UPTO, PERCENTILE_REST, inclusive=True)


def amount_range_flag(amount: Column) -> Column:
    return _steps(amount, RANGE_BELOW, RANGE_REST, inclusive=False)


def amount_band(amount: Column) -> Column:
    return _steps(amount, BAND_BELOW, BAND_REST, inclusive=False)


def amount_zscore(amount: Column, mean: float = ZSCORE_MEAN, std: float = ZSCORE_STD) -> Column:
    if std <= 0:
        return F.lit(0.0)
    return (amount - F.lit(mean)) / F.lit(std)


def exact_mean(column: str) -> Column:
    """A mean from an exact sum of six decimals, so that its last digit does not depend on the order of the rows."""
    return F.try_divide(F.sum(F.col(column).cast("decimal(20,6)")).cast("double"), F.count(column))


def rounded_mean(column: str, digits: int = 2) -> Column:
    """The mean rounded half up in decimals, where a border is a border."""
    total = F.sum(F.col(column).cast("decimal(20,6)"))
    return F.round(F.try_divide(total, F.count(column)), digits).cast("double")
