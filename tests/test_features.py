"""Column expressions on edge values."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txnlake.functions import amount as amt
from txnlake.functions import components as comp
from txnlake.functions import scoring, timing
from txnlake.operators import scale


def values(spark, xs, kind="double"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}")


def apply(spark, xs, fn, kind="double"):
    return [r["y"] for r in values(spark, xs, kind).select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_amount_category(spark):
    assert apply(spark, [0.0, 50.0, 50.01, 200.0, 1000.0, 1000.01, None], amt.amount_category) == [
        "Low", "Low", "Medium", "Medium", "High", "Very_High", "Very_High",
    ]


def test_amount_percentile_and_range(spark):
    xs = [-1.0, 0.0, 0.01, 5.0, 25.0, 50.0, 100.0, 200.0, 500.0, 1000.0, 5000.0]
    assert apply(spark, xs, amt.amount_percentile_step) == [0.1, 0.1, 0.25, 0.25, 0.5, 0.7, 0.85, 0.95, 0.99, 1.0, 1.0]
    assert apply(spark, [9.99, 10.0, 100.0, 500.0, 1000.0], amt.amount_range_flag) == [0, 1, 2, 3, 4]


def test_amount_log_and_zscore(spark):
    assert apply(spark, [-3.0, 0.0, 1.0, None], amt.amount_log) == [0.0, 0.0, pytest.approx(math.log(2)), None]
    assert apply(spark, [88.35], amt.amount_zscore) == [0.0]
    assert apply(spark, [5.0], lambda c: amt.amount_zscore(c, std=0.0)) == [0.0]


def test_amount_band(spark):
    assert apply(spark, [9.0, 10.0, 50.0, 100.0, 500.0], amt.amount_band) == ["< $10", "$10-$50", "$50-$100", "$100-$500", "> $500"]


def test_offset_time(spark):
    day = 86400.0
    xs = [0.0, 3599.0, 3600.0, day - 1, day * 5, day * 6, day * 7]
    assert apply(spark, xs, timing.offset_hour) == [0, 0, 1, 23, 0, 0, 0]
    assert apply(spark, xs, timing.offset_day) == [0, 0, 0, 0, 5, 6, 0]
    assert apply(spark, xs, lambda c: timing.is_weekend(timing.offset_day(c))) == [0, 0, 0, 0, 1, 1, 0]


def test_time_cluster(spark):
    got = apply(spark, list(range(24)), timing.time_cluster, "int")
    assert got == [0] * 9 + [1] * 9 + [2] * 5 + [0]


def test_created_text(spark):
    when = dt.datetime(2024, 1, 6, 18, 30)
    forms = ["2024-01-06 18:30:00", "2024-01-06T18:30:00+07:00", "2024-01-06", "2024-01-06T18:30", "2024-01-06T18:30:00.250000", "garbage", "", "2024-13-40"]
    assert apply(spark, forms, timing.parse_created_text, "string") == [
        when, when, dt.datetime(2024, 1, 6), when, when.replace(microsecond=250000), None, None, None,
    ]


def test_created_epoch(spark):
    seconds = 1704565800
    when = dt.datetime(2024, 1, 6, 18, 30)
    got = apply(spark, [float(seconds), seconds * 1e3, seconds * 1e6], timing.parse_created_epoch)
    assert got == [when, when, when]
    legacy = apply(spark, [float(seconds), seconds * 1e3], lambda c: timing.parse_created_epoch(c, "legacy"))
    assert legacy == [dt.datetime(1970, 1, 20, 17, 29, 25, 800000)] * 2


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(50, 28)).tolist()
    return rows + [[2.5] * 28, [0.0] * 28, [0.1] * 28, [1.0] * 27 + [9.0]]


def test_component_statistics_equal_pandas(spark, vectors):
    cols = [f"v{i}" for i in range(1, 29)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(vectors)], ["i", *cols])
    for r in comp.with_component_stats(df, cols).orderBy("i").collect():
        s = pd.Series(vectors[r["i"]])
        assert r["pca_mean"] == pytest.approx(s.mean(), abs=1e-12)
        assert r["pca_std"] == pytest.approx(np.std(s), abs=1e-12)
        assert r["pca_skewness"] == pytest.approx(s.skew(), abs=1e-9)
        assert r["pca_kurtosis"] == pytest.approx(s.kurtosis(), abs=1e-9)


def test_quality_and_outlier_share(spark):
    cols = [f"v{i}" for i in range(1, 29)]
    base = [0.0] * 28
    rows = [
        (10.0, *base),
        (None, *base),
        (0.0, *base),
        (25000.0, *base),
        (25000.01, *base),
        (10.0, None, *base[1:]),
        (10.0, 10.5, -11.0, *base[2:]),
        (None, *[None] * 28),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, amount double, " + ", ".join(f"{c} double" for c in cols))
    got = df.select("i", scoring.data_quality_score("amount", cols).alias("q"), comp.outlier_share(cols).alias("o")).orderBy("i").collect()
    want = [1.0, 0.7, 0.7, 1.0, 0.8, 1 - 0.3 / 28, 1 - 2 / 28 * 0.2, 0.4]
    assert [r["q"] for r in got] == pytest.approx(want)
    # 1 - 0.3 keeps its exact double value, which is not below 0.7.
    assert got[1]["q"] == 1.0 - 0.3
    assert got[6]["o"] == pytest.approx(2 / 28)


def test_risk_is_capped_and_ordered(spark):
    rows = [(0, 0.5, 0, 1, 0.6, 0.1), (1, 1500.0, 1, 0, 0.0, 1.0), (2, 700.0, 2, 1, 0.0, 0.69), (3, 100.0, 1, 0, 0.5, 0.7)]
    df = spark.createDataFrame(rows, "i int, a double, c int, w int, o double, q double")
    risk = scoring.risk_score(*[F.col(c) for c in "acwoq"])
    got = [r["r"] for r in df.select("i", risk.alias("r")).orderBy("i").collect()]
    assert got == pytest.approx([1.0, 0.3, 0.5, 0.0])


@pytest.mark.parametrize("size", [1, 4, 100])
def test_frame_statistics(spark, size):
    rng = np.random.default_rng(size)
    values = [None if i % 17 == 3 else float(v) for i, v in enumerate(rng.normal(scale=1e3, size=250))]
    df = spark.createDataFrame([(k, i, v) for k in (1, 2, None) for i, v in enumerate(values[: 250 if k == 1 else 60])], "k int, i int, v double")
    kinds = {"a": "mean", "s": "std", "lo": "min", "hi": "max", "n": "rows"}
    rows = scale._framed(df, ["k"], ["i"], size, "v", kinds).collect()
    assert len(rows) == 370
    for r in rows:
        frame = [v for v in values[max(0, r["i"] - size + 1) : r["i"] + 1] if v is not None]
        assert r["n"] == min(r["i"] + 1, size)
        if frame:
            assert [r["a"], r["s"], r["lo"], r["hi"]] == pytest.approx([np.mean(frame), np.std(frame), min(frame), max(frame)], abs=1e-6)
        else:
            assert [r["a"], r["s"], r["lo"], r["hi"]] == [None] * 4
