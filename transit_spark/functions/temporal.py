"""Time expressions. All of them work on TIMESTAMP_NTZ, so no session zone leaks in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_spark.config import HOLIDAY_DATES

def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_time(df: DataFrame, cols) -> DataFrame:
    """Coerce columns to TIMESTAMP_NTZ; text that is no timestamp becomes NULL."""
    types = dict(df.dtypes)
    other = {c: F.col(c).try_cast("timestamp_ntz") for c in cols if types[c] != "timestamp_ntz"}
    return df.withColumns(other) if other else df


def minute_of_day(ts: str | Column) -> Column:
    ts = _col(ts)
    return F.hour(ts) * 60 + F.minute(ts)


def start_of_day(ts: str | Column) -> Column:
    return _col(ts).cast("date").cast("timestamp_ntz")


def plus_minutes(ts: str | Column, minutes: int | Column) -> Column:
    minutes = F.lit(minutes) if isinstance(minutes, int) else minutes
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0))


def floor_time(ts: str | Column, minutes: int = 15) -> Column:
    """Start of the slot a time lies in. Unlike ``window()`` it keeps NULL times."""
    if 1440 % minutes:
        raise ValueError("the slot length must divide a day")
    slot = F.floor(minute_of_day(ts) / F.lit(minutes)) * minutes
    return plus_minutes(start_of_day(ts), slot)


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp."""
    ts = _col(ts)
    seconds = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86400 + (
        F.hour(ts) * 3600 + F.minute(ts) * 60
    )
    within = F.extract(F.lit("SECOND"), ts) * 1000000
    return seconds * 1000000 + within.cast("long")


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of a zone-less timestamp."""
    return F.floor(epoch_micros(ts) / 1000000)


def minutes_between(later: str | Column, earlier: str | Column) -> Column:
    return (epoch_micros(later) - epoch_micros(earlier)) / 60000000


def hhmm(ts: str | Column) -> Column:
    return F.date_format(_col(ts), "HH:mm")


def align_time(df: DataFrame, col: str = "time", tz: str = "+07:00", minutes: int = 5) -> DataFrame:
    """UTC times moved to ``tz`` and floored to ``minutes``."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(col))
    return df.withColumn(col, floor_time(local, minutes))


# Right-closed hour bins (-1,6] (6,12] (12,18] (18,24].
TIME_OF_DAY = """
    CASE WHEN hour <= 6 THEN 'night' WHEN hour <= 12 THEN 'morning'
         WHEN hour <= 18 THEN 'afternoon' WHEN hour <= 24 THEN 'evening' END"""

RUSH_HOUR_INTENSITY = """
    (CASE WHEN day_of_week >= 5 THEN 0.3D ELSE 1.0D END)
    * (CASE WHEN hour IN (8, 17) THEN 1.0D
            WHEN hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 18 THEN 0.8D
            WHEN hour IN (6, 15) THEN 0.5D ELSE 0.2D END)"""


def temporal_features(df: DataFrame, time_col: str = "time", holidays=HOLIDAY_DATES) -> DataFrame:
    """Calendar, peak, cyclic and holiday columns of ``time_col``. Without a time the flags are 0, the rest is NULL."""
    ts = f"`{time_col}`"
    days = ", ".join(f"DATE '{day}'" for day in holidays) or "NULL"
    calendar = {
        "hour": f"hour({ts})",
        "day_of_week": f"weekday({ts})",
        "day_of_month": f"dayofmonth({ts})",
        "month": f"month({ts})",
        "week_of_year": f"weekofyear({ts})",
        "quarter": f"quarter({ts})",
    }
    derived = {
        "is_weekend": "CAST(coalesce(day_of_week >= 5, false) AS INT)",
        "is_peak_hour": "CAST(coalesce(hour IN (7, 8, 16, 17), false) AS INT)",
        "is_morning_peak": "CAST(coalesce(hour IN (7, 8), false) AS INT)",
        "is_evening_peak": "CAST(coalesce(hour IN (16, 17), false) AS INT)",
        "time_of_day": TIME_OF_DAY,
        "hour_sin": "sin(2 * pi() * hour / 24)",
        "hour_cos": "cos(2 * pi() * hour / 24)",
        "dow_sin": "sin(2 * pi() * day_of_week / 7)",
        "dow_cos": "cos(2 * pi() * day_of_week / 7)",
        "time_since_midnight": f"hour * 60 + minute({ts})",
        "is_holiday": f"CAST(coalesce(CAST({ts} AS DATE) IN ({days}), false) AS INT)",
        "rush_hour_intensity": RUSH_HOUR_INTENSITY,
    }
    based = df.withColumns({c: F.expr(text) for c, text in calendar.items()})
    return based.withColumns({c: F.expr(text) for c, text in derived.items()})


def time_spine(df: DataFrame, keys, start: str, end: str, minutes: int = 15) -> DataFrame:
    """Every distinct key combination at every step from ``start`` to ``end`` inclusive."""
    steps = F.sequence(
        F.lit(start).cast("timestamp_ntz"),
        F.lit(end).cast("timestamp_ntz"),
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0)),
    )
    return df.select(*keys).distinct().select(*keys, F.explode(steps).alias("time"))


def densify(df: DataFrame, keys, start: str, end: str, fill: str, minutes: int = 15) -> DataFrame:
    """Left join of the spine with summed ``fill``; missing steps hold 0."""
    totals = (
        df.groupBy(*keys, floor_time("time", minutes).alias("time")).agg(F.sum(fill).alias(fill))
    )
    return (
        time_spine(df, keys, start, end, minutes)
        .join(totals, [*keys, "time"], "left")
        .withColumn(fill, F.coalesce(F.col(fill), F.lit(0)))
    )
