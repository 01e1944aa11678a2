"""Row scores: data quality, risk, anomaly. Sums run left to right, so that doubles agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnlake.functions.components import summed
from txnlake.functions.timing import NIGHT

EXTREME_AMOUNT = 25000.0
EXTREME_COMPONENT = 10.0
ANOMALY_SHARE = 0.3
ALERT_RISK = 0.8


def data_quality_score(amount: str, components: Sequence[str]) -> Column:
    """1 less penalties for a missing or extreme amount and missing or extreme components.

    Takes the columns as received: a null is a missing value.
    """
    n = float(len(components))
    missing = summed([f"IF({c} IS NULL, 1, 0)" for c in components])
    extreme = summed([f"IF(abs({c}) > {EXTREME_COMPONENT}D, 1, 0)" for c in components])
    return F.expr(
        f"greatest(0D, 1D - IF({amount} IS NULL OR {amount} <= 0, 0.3D, 0D) - IF({amount} > {EXTREME_AMOUNT}D, 0.2D, 0D)"
        f" - ({missing}) / {n}D * 0.3D - ({extreme}) / {n}D * 0.2D)"
    )


def risk_score(amount: Column, cluster: Column, weekend: Column, outliers: Column, quality: Column) -> Column:
    by_amount = (
        F.when(amount > 1000, F.lit(0.3)).when(amount > 500, F.lit(0.2)).when(amount < 1, F.lit(0.4)).otherwise(F.lit(0.0))
    )
    score = (
        by_amount
        + F.when(cluster == NIGHT, F.lit(0.2)).otherwise(F.lit(0.0))
        + F.when(weekend == 1, F.lit(0.1)).otherwise(F.lit(0.0))
        + F.when(outliers > 0.5, F.lit(0.3)).otherwise(F.lit(0.0))
        + F.when(quality < 0.7, F.lit(0.2)).otherwise(F.lit(0.0))
    )
    return F.least(F.lit(1.0), score)


def is_anomaly(outliers: Column) -> Column:
    """Our definition: more than ``ANOMALY_SHARE`` of the components are outliers."""
    return outliers > ANOMALY_SHARE


def is_alert(risk: Column, anomaly: Column) -> Column:
    return (risk > ALERT_RISK) | anomaly
