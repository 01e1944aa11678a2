"""Features over the 28 anonymised components of one row."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 3.0
# Sums of squares below this count as zero, so that a constant row has no skew or kurtosis.
NEAR_ZERO = 1e-14


# Sums over many columns are written as one SQL text each: same plan, far fewer driver calls.


def summed(terms: Sequence[str]) -> str:
    """Left-to-right sum."""
    return " + ".join(terms)


def is_outlier(x: Column, low: Column | float = -LIMIT, high: Column | float = LIMIT) -> Column:
    return ((x < low) | (x > high)).cast("int")


def outlier_share(cols: Sequence[str], limit: float = LIMIT) -> Column:
    """Share of the columns whose absolute value exceeds ``limit``."""
    hits = summed([f"IF(abs({c}) > {limit}D, 1, 0)" for c in cols])
    return F.expr(f"({hits}) / {float(len(cols))}D")


def flag_share(flags: Sequence[str]) -> Column:
    """Share of 0/1 flags that are set."""
    return F.expr(f"({summed([f'CAST({c} AS INT)' for c in flags])}) / {float(len(flags))}D")


def with_component_stats(df: DataFrame, cols: Sequence[str], prefix: str = "pca_") -> DataFrame:
    """Mean, population deviation, corrected skew and corrected excess kurtosis over one row.

    Two projections: the mean first, then power sums about it, all in generated code.
    """
    n = float(len(cols))
    mean = f"{prefix}mean"
    kept = df.columns

    def power(k: int) -> str:
        return summed([" * ".join([f"({c} - {mean})"] * k) for c in cols])

    centred = df.selectExpr("*", f"({summed(cols)}) / {n}D AS {mean}")
    sums = centred.selectExpr("*", *[f"{power(k)} AS _s{k}" for k in (2, 3, 4)])
    s2, s3, s4 = F.col("_s2"), F.col("_s3"), F.col("_s4")
    flat = s2 < F.lit(NEAR_ZERO)
    skew = F.lit(n * (n - 1) ** 0.5 / (n - 2)) * s3 / (s2 * F.sqrt(s2))
    kurt = F.lit(n * (n + 1) * (n - 1) / ((n - 2) * (n - 3))) * s4 / (s2 * s2) - F.lit(
        3 * (n - 1) ** 2 / ((n - 2) * (n - 3))
    )
    return sums.select(
        *kept,
        mean,
        F.sqrt(s2 / F.lit(n)).alias(f"{prefix}std"),
        F.when(flat, F.lit(0.0)).otherwise(skew).alias(f"{prefix}skewness"),
        F.when(flat, F.lit(0.0)).otherwise(kurt).alias(f"{prefix}kurtosis"),
    )


def unpivoted(df: DataFrame, cols: Sequence[str], *keep: str, kind: str = "DOUBLE") -> DataFrame:
    """Rows ``(column, value)`` beside the kept columns.

    A grouping by ``column`` then folds any number of columns before its shuffle, in compact code.
    """
    parts = ", ".join(f"named_struct('column', '{c}', 'value', CAST(`{c}` AS {kind}))" for c in cols)
    return df.selectExpr(*keep, f"inline(array({parts}))")
