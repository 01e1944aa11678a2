"""Time features, from a seconds offset (batch) or from ``created_at`` (stream)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400.0
HOUR = 3600.0

# Hours of the clusters (first, last, cluster); every other hour is 0.
CLUSTERS = ((9, 17, 1), (18, 22, 2))
NIGHT = 0


def offset_hour(time: Column) -> Column:
    return F.floor((time % F.lit(DAY)) / F.lit(HOUR)).cast("int")


def offset_day(time: Column) -> Column:
    return F.floor((time / F.lit(DAY)) % F.lit(7)).cast("int")


def is_weekend(day: Column) -> Column:
    """Days 5 and 6 of a week counted from 0."""
    return F.when(day.isin(5, 6), F.lit(1)).otherwise(F.lit(0))


def cyclic_sin(x: Column, period: float) -> Column:
    return F.sin(F.lit(2.0) * F.pi() * x / F.lit(period))


def cyclic_cos(x: Column, period: float) -> Column:
    return F.cos(F.lit(2.0) * F.pi() * x / F.lit(period))


def time_cluster(hour: Column) -> Column:
    out = None
    for first, last, cluster in CLUSTERS:
        hit = hour.between(first, last)
        out = F.when(hit, F.lit(cluster)) if out is None else out.when(hit, F.lit(cluster))
    return out.otherwise(F.lit(NIGHT))


def hour_bucket(ts: Column) -> Column:
    """Folder name of the hour a record belongs to."""
    return F.date_format(ts, "yyyy-MM-dd--HH")


def seconds_to_ntz(seconds: Column) -> Column:
    """Timestamp of a numeric seconds offset counted from 1970 (session time zone UTC)."""
    return F.timestamp_micros(F.round(seconds * F.lit(1e6)).cast("bigint")).cast("timestamp_ntz")


def micros(ts_ntz: Column) -> Column:
    """Microseconds since 1970 of a timestamp without time zone (session time zone UTC)."""
    return F.unix_micros(ts_ntz.cast("timestamp"))


def parse_created_text(text: Column) -> Column:
    """ISO text: a blank for the ``T``, a bare date and a ``+offset`` (cut off) are accepted."""
    iso = F.split_part(F.replace(text, F.lit(" "), F.lit("T")), F.lit("+"), F.lit(1))
    with_time = F.when(iso.contains("T"), iso).otherwise(F.concat(iso, F.lit("T00:00:00")))
    return F.when(
        with_time.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?$"),
        F.try_to_timestamp(F.regexp_replace(with_time, r"T(\d{2})$", "T$1:00")).cast("timestamp_ntz"),
    )


# Epoch numbers above these are microseconds and milliseconds; the rest are seconds.
EPOCH_UNITS = {"calendar": (1e14, 1e11), "legacy": (1e12, 1e9)}


def parse_created_epoch(number: Column, units: str = "calendar") -> Column:
    """Epoch number in seconds, milliseconds or microseconds, told apart by size.

    ``legacy`` keeps the narrow thresholds under which present-day seconds read as milliseconds.
    """
    above_us, above_ms = EPOCH_UNITS[units]
    whole = number.cast("bigint")
    us = (
        F.when(whole > F.lit(above_us), whole)
        .when(whole > F.lit(above_ms), whole * F.lit(1000))
        .otherwise(whole * F.lit(1_000_000))
    )
    return F.timestamp_micros(us).cast("timestamp_ntz")


def stream_time_features(parsed: Column, present: Column) -> dict[str, Column]:
    """The eight stream time features.

    ``present`` is false when the record has no ``created_at``: all features stay 0. A value that is
    present but unreadable (``parsed`` null) gives the neutral noon-weekday defaults.
    """
    hour = F.hour(parsed)
    day = F.weekday(parsed)

    def pick(value: Column, unreadable, missing) -> Column:
        return (
            F.when(~present, F.lit(missing))
            .when(parsed.isNull(), F.lit(unreadable))
            .otherwise(value)
        )

    return {
        "hour": pick(hour, 12, 0),
        "day_of_week": pick(day, 1, 0),
        "is_weekend": pick(is_weekend(day), 0, 0),
        "hour_sin": pick(cyclic_sin(hour, 24.0), 0.0, 0.0),
        "hour_cos": pick(cyclic_cos(hour, 24.0), 1.0, 0.0),
        "day_of_week_sin": pick(cyclic_sin(day, 7.0), 0.0, 0.0),
        "day_of_week_cos": pick(cyclic_cos(day, 7.0), 1.0, 0.0),
        "time_cluster": pick(time_cluster(hour), 1, 0),
    }
