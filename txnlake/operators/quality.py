"""Data-quality rules: each group is one aggregation pass, returned as rows
``(check, column, value, passed, severity)``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.hashing import in_share
from txnlake.schemas import BRONZE_COLS, REQUIRED_BRONZE, SILVER_ENGINEERED, V_COLS

FAIL, WARN = "fail", "warn"
# Bounds of the rules.
MIN_ROWS = 1_000
AMOUNT_MAX = 100_000.0
EXPECTED_AMOUNT_MAX = 50_000.0
BRONZE_COMPONENT, SILVER_COMPONENT = 100.0, 50.0
VALIDATION_SHARE, SAMPLE_SEED = 0.1, 42


@dataclass(frozen=True)
class Rule:
    check: str
    column: str
    value: Column
    ok: Callable[[Column], Column]
    severity: str = FAIL


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All values in one pass, then one row per rule. A rule without data does not pass."""
    wide = df.agg(*[r.value.cast("double").alias(f"v{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(r.check).alias("check"),
            F.lit(r.column).alias("column"),
            F.col(f"v{i}").alias("value"),
            F.coalesce(r.ok(F.col(f"v{i}")), F.lit(False)).alias("passed"),
            F.lit(r.severity).alias("severity"),
        )
        for i, r in enumerate(rules)
    ]
    return wide.select(F.inline(F.array(*rows)))


def _rows() -> Column:
    return F.count(F.lit(1))


def _nulls(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def _not_binary(c: str = "Class") -> Column:
    return F.count_if(~F.coalesce(F.col(c).isin(0, 1), F.lit(False)))


def _none(v: Column) -> Column:
    return v == 0


def _component_rules(cols: Sequence[str], limit: float, severity: str, name: str) -> list[Rule]:
    out = []
    for c in cols:
        out.append(Rule(f"{name}_min", c, F.min(c), lambda v: v >= -limit, severity))
        out.append(Rule(f"{name}_max", c, F.max(c), lambda v: v <= limit, severity))
    return out


def component_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c[:1] == "V" and c[1:].isdigit()]


def row_count_rules(low: int = MIN_ROWS, high: int | None = None) -> list[Rule]:
    rules = [Rule("row_count_min", "*", _rows(), lambda v: v >= low)]
    if high is not None:
        rules.append(Rule("row_count_max", "*", _rows(), lambda v: v <= high))
    return rules


def class_rules() -> list[Rule]:
    return [Rule("class_binary", "Class", _not_binary(), _none), Rule("class_nulls", "Class", _nulls("Class"), _none)]


def amount_rules() -> list[Rule]:
    return [
        Rule("amount_min", "Amount", F.min("Amount"), lambda v: v >= 0, WARN),
        Rule("amount_max", "Amount", F.max("Amount"), lambda v: v <= AMOUNT_MAX, WARN),
        Rule("amount_nulls", "Amount", _nulls("Amount"), _none),
    ]


def time_rules() -> list[Rule]:
    return [Rule("time_nonnegative", "Time", F.min("Time"), lambda v: v >= 0)]


def component_rules(cols: Sequence[str] = V_COLS) -> list[Rule]:
    return _component_rules(cols, BRONZE_COMPONENT, WARN, "pca_range")


def bronze_rules() -> list[Rule]:
    return [*row_count_rules(), *class_rules(), *amount_rules(), *time_rules(), *component_rules()]


def silver_nonempty_rules() -> list[Rule]:
    return [Rule("silver_nonempty", "*", _rows(), lambda v: v > 0)]


def silver_null_rules() -> list[Rule]:
    return [Rule("silver_critical_nulls", c, _nulls(c), _none) for c in ("Class", "Amount")]


def silver_class_rules() -> list[Rule]:
    return [Rule("silver_class", "Class", _not_binary(), _none)]


def silver_amount_rules() -> list[Rule]:
    return [
        Rule("silver_amount_min", "Amount", F.min("Amount"), lambda v: v >= 0),
        Rule("silver_amount_max", "Amount", F.max("Amount"), lambda v: v <= AMOUNT_MAX),
    ]


def silver_hour_rules() -> list[Rule]:
    return [
        Rule("silver_hour_min", "Hour", F.min("Hour"), lambda v: v >= 0),
        Rule("silver_hour_max", "Hour", F.max("Hour"), lambda v: v <= 23),
    ]


def silver_component_rules(cols: Sequence[str] = V_COLS) -> list[Rule]:
    return _component_rules(cols, SILVER_COMPONENT, FAIL, "silver_pca_range")


def silver_rules() -> list[Rule]:
    return [
        *silver_nonempty_rules(),
        *silver_null_rules(),
        *silver_class_rules(),
        *silver_amount_rules(),
        *silver_hour_rules(),
        *silver_component_rules(),
    ]


def component_offenders(df: DataFrame, cols: Sequence[str] = V_COLS, limit: float = SILVER_COMPONENT) -> DataFrame:
    """Columns whose range leaves the limits, with that range."""
    wide = df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"lo_{c}").alias("min_value"), F.col(f"hi_{c}").alias("max_value"))
        for c in cols
    ]
    return wide.select(F.inline(F.array(*rows))).where((F.col("min_value") < -limit) | (F.col("max_value") > limit))


def report(checks: DataFrame) -> DataFrame:
    """Counts of passed and failed checks and the status of the run, which never stops it."""
    errors = F.count_if(~F.col("passed"))
    return checks.agg(
        F.count_if("passed").alias("checks_passed"),
        errors.alias("errors_found"),
        F.when(F.count(F.lit(1)) == 0, "ERROR").when(errors == 0, "PASSED").otherwise("FAILED_BUT_CONTINUING").alias("status"),
    )


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_BRONZE) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def features_present(df: DataFrame, expected: Sequence[str] = SILVER_ENGINEERED) -> DataFrame:
    """One row per expected column: whether it is there, and how many rows hold a value."""
    filled = [F.count(c).alias(f"n_{i}") if c in df.columns else F.lit(0).cast("long").alias(f"n_{i}") for i, c in enumerate(expected)]
    rows = [
        F.struct(F.lit(c).alias("feature"), F.lit(c in df.columns).alias("present"), F.col(f"n_{i}").alias("filled"))
        for i, c in enumerate(expected)
    ]
    return df.agg(*filled).select(F.inline(F.array(*rows)))


def bronze_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, nulls per column and duplicate rows, from one grouping over whole rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    nulls = [F.expr(f"coalesce(sum(IF(`{c}` IS NULL, _n, 0L)), 0L) AS `null_{c}`") for c in df.columns]
    wide = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("dups"), *nulls
    )

    def row(metric: str, column: str, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), F.lit(column).alias("column"), value.cast("long").alias("value"))

    rows = [row("rows", "*", F.col("rows")), row("columns", "*", F.lit(len(df.columns))), row("duplicates", "*", F.col("dups"))]
    rows += [row("nulls", c, F.col(f"null_{c}")) for c in df.columns]
    return wide.select(F.inline(F.array(*rows)))


def column_types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def invalid_classes(df: DataFrame) -> DataFrame:
    """Distinct labels outside 0 and 1, null included."""
    return df.where(~F.coalesce(F.col("Class").isin(0, 1), F.lit(False))).select("Class").distinct()


def _expectation(df: DataFrame, name: str, column: str, unexpected: Column) -> DataFrame:
    present = F.count(column)
    bad = F.count_if(F.col(column).isNotNull() & unexpected)
    return df.agg(
        F.lit(name).alias("expectation"),
        F.lit(column).alias("column"),
        F.count(F.lit(1)).alias("element_count"),
        (F.count(F.lit(1)) - present).alias("missing_count"),
        bad.alias("unexpected_count"),
        F.when(present > 0, bad / present * 100).otherwise(F.lit(0.0)).alias("unexpected_percent"),
        (bad == 0).alias("success"),
    )


def expect_in_set(df: DataFrame, column: str = "Class", values: Sequence = (0, 1)) -> DataFrame:
    return _expectation(df, "in_set", column, ~F.col(column).isin(*values))


def expect_between(df: DataFrame, column: str = "Amount", low: float = 0.0, high: float = EXPECTED_AMOUNT_MAX) -> DataFrame:
    return _expectation(df, "between", column, ~F.col(column).between(low, high))


def validation_sample(df: DataFrame, share: float = VALIDATION_SHARE, key: str = "id") -> DataFrame:
    """A repeatable share of the keys, above 0 and up to 1."""
    if share is None or not 0 < share <= 1:
        raise ValueError(f"a share lies above 0 and up to 1, not {share}")
    return df.where(in_share(F.col(key), share, SAMPLE_SEED))


ACCURATE_AMOUNT, ACCURATE_COMPONENT = 25_000.0, 10.0


def scores(df: DataFrame) -> DataFrame:
    """Completeness, accuracy, consistency and their mean.

    Completeness is the share of filled cells, accuracy the share of filled cells inside the usual
    range, consistency the share of rows with a valid label, amount and time.
    """
    cells = float(len(BRONZE_COLS))
    filled = " + ".join(f"IF({c} IS NULL, 0, 1)" for c in BRONZE_COLS)
    good = [f"IF(abs({c}) <= {ACCURATE_COMPONENT}D, 1, 0)" for c in V_COLS]
    good += [f"IF(Amount BETWEEN 0 AND {ACCURATE_AMOUNT}D, 1, 0)", "IF(Time >= 0, 1, 0)", "IF(Class IN (0, 1), 1, 0)"]
    row_ok = "IF(Class IN (0, 1) AND Amount >= 0 AND Time >= 0, 1, 0)"
    per_row = df.selectExpr(f"{filled} AS filled", f"{' + '.join(good)} AS good", f"{row_ok} AS row_ok")
    parts = per_row.agg(
        (F.sum("filled") / (F.count(F.lit(1)) * cells)).alias("completeness"),
        (F.sum("good") / F.sum("filled")).alias("accuracy"),
        (F.sum("row_ok") / F.count(F.lit(1))).alias("consistency"),
    )
    return parts.withColumn("overall", (F.col("completeness") + F.col("accuracy") + F.col("consistency")) / F.lit(3.0))
