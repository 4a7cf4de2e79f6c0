"""Validation, repair and deduplication. Every filter keeps rows whose value is missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transit_spark import config as C
from transit_spark.functions.temporal import to_time
from transit_spark.operators.series import ffill, interpolate, interpolate_and_fill
from transit_spark.operators.summary import attach, exact_quantiles, to_long


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and NULL both mean "missing" in the sources; keep one of them."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def dedupe_first(df: DataFrame, keys, order=("seq",)) -> DataFrame:
    """First row per key along ``order``. The ``= 1`` filter lets Spark cut every map partition to
    one row per key before the shuffle, so a key with many copies costs nothing extra."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def _known(df: DataFrame, c: str) -> Column:
    """The column with NaN as NULL: NaN would compare as larger than everything."""
    return F.when(~F.isnan(c), F.col(c)) if dict(df.dtypes)[c] in ("float", "double") else F.col(c)


def clamp_negative(df: DataFrame, cols=C.DEMAND_COUNTS, lo=C.MIN_PASSENGERS) -> DataFrame:
    return df.withColumns(
        {c: F.when(F.col(c) < lo, F.lit(lo)).otherwise(F.col(c)) for c in _present(df, cols)}
    )


def drop_above(df: DataFrame, cols=C.DEMAND_COUNTS, hi=C.MAX_PASSENGERS) -> DataFrame:
    keep = [F.coalesce(_known(df, c) <= hi, F.lit(True)) for c in _present(df, cols)]
    return df.where(reduce(lambda a, b: a & b, keep, F.lit(True)))


def drop_outside(df: DataFrame, col: str, lo, hi) -> DataFrame:
    return df.where(F.coalesce(_known(df, col).between(lo, hi), F.lit(True)))


def in_bounds(df: DataFrame, box: C.Box = C.Box()) -> DataFrame:
    if "latitude" in df.columns:
        df = drop_outside(df, "latitude", box.lat_lo, box.lat_hi)
    if "longitude" in df.columns:
        df = drop_outside(df, "longitude", box.lng_lo, box.lng_hi)
    return df


def clip(df: DataFrame, col: str, lo, hi) -> DataFrame:
    c = _known(df, col)
    return df.withColumn(col, F.when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c))


def impute_median(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Out-of-range values become the exact median of the in-range ones."""
    valid = df.where(F.col(col).between(lo, hi))
    median = exact_quantiles(valid, col, [0.5]).select("value").scalar()
    return df.withColumn(
        col, F.when(~F.col(col).between(lo, hi), median).otherwise(F.col(col).cast("double"))
    )


def require(df: DataFrame, cols) -> DataFrame:
    return df.na.drop(subset=list(cols))


def valid_intervals(df: DataFrame) -> DataFrame:
    return df.where(F.col("end_time") > F.col("start_time"))


def _tie_break(df: DataFrame, order) -> list[str]:
    return list(order) if order else (["seq"] if "seq" in df.columns else [c for c in df.columns])


def _not_filled(df: DataFrame, keys, order) -> list[str]:
    """Keys, and the columns that only number the rows; values that merely broke a tie are filled."""
    return [*keys, *(order or ["seq"])]


def clean_demand(df: DataFrame, order=None) -> DataFrame:
    """Coerce, dedupe on (route, stop, time), clamp, drop >200, forward fill, drop incomplete."""
    kept = _not_filled(df, C.DEMAND_KEYS, order)
    df = dedupe_first(to_time(nan_to_null(df), ["time"]), C.DEMAND_KEYS, _tie_break(df, order))
    df = drop_above(clamp_negative(df))
    fill = [c for c in df.columns if c not in kept]
    return ffill(df, ["route", "stop"], ["time"], fill).na.drop()


def clean_gps(df: DataFrame, order=None) -> DataFrame:
    """Coerce, dedupe on (route, bus, time), bounds, clip speed, interpolate up to 3 rows."""
    order = _tie_break(df, order)
    df = dedupe_first(to_time(nan_to_null(df), ["time"]), C.GPS_KEYS, order)
    df = in_bounds(df)
    if "speed" in df.columns:
        df = clip(df, "speed", float(C.MIN_SPEED_KMH), float(C.MAX_SPEED_KMH))
    numeric = _present(df, C.GPS_NUMERIC)
    return interpolate(df, ["route", "bus_id"], ["time"], numeric, limit=3).na.drop()


def clean_weather(df: DataFrame, order=None) -> DataFrame:
    """Coerce, dedupe on time, drop bad temperature, repair humidity, interpolate, fill."""
    kept = _not_filled(df, ["time"], order)
    df = dedupe_first(to_time(nan_to_null(df), ["time"]), ["time"], _tie_break(df, order))
    if "temperature" in df.columns:
        df = drop_outside(df, "temperature", C.MIN_TEMPERATURE_C, C.MAX_TEMPERATURE_C)
    if "humidity" in df.columns:
        df = impute_median(df, "humidity", C.MIN_HUMIDITY, C.MAX_HUMIDITY)
    numeric = _present(df, C.WEATHER_NUMERIC)
    other = [c for c in df.columns if c not in (*numeric, *kept)]
    return interpolate_and_fill(df, [], ["time"], numeric, other)


def clean_events(df: DataFrame, order=("event_id",)) -> DataFrame:
    """Coerce, dedupe on (name, start), end after start, bounds, both times present."""
    df = to_time(nan_to_null(df), ["start_time", "end_time"])
    df = dedupe_first(df, ["name", "start_time"], order)
    return require(in_bounds(valid_intervals(df)), ["start_time", "end_time"])


def cleaning_report(raw: DataFrame, clean: DataFrame, keys, name: str) -> DataFrame:
    """One row: initial, final, duplicates removed, dropped."""
    per_key = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    before = per_key.select(F.col("n").alias("initial"), F.lit(1).alias("kept"), F.lit(0).alias("final"))
    after = clean.select(F.lit(0).alias("initial"), F.lit(0).alias("kept"), F.lit(1).alias("final"))
    total = before.unionByName(after).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("initial", "kept", "final")]
    )
    return total.select(
        F.lit(name).alias("table"),
        F.col("initial").alias("initial_records"),
        F.col("final").alias("final_records"),
        (F.col("initial") - F.col("kept")).alias("duplicates_removed"),
        (F.col("initial") - F.col("final")).alias("records_dropped"),
    )


def drop_outliers(df: DataFrame, col: str, method: str = "zscore", keys=(), limit: float | None = None):
    """|z| > 3, or beyond 1.5 interquartile ranges, per group."""
    keys = list(keys)
    if method == "zscore":
        limit = 3.0 if limit is None else limit
        stats = df.groupBy(*keys).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))
        joined, s = attach(df, stats, keys)
        inside = F.abs(F.try_divide(F.col(col) - s("mean"), s("std"))) <= limit
    elif method == "iqr":
        limit = 1.5 if limit is None else limit
        quartiles = exact_quantiles(df, col, [0.25, 0.75], keys)
        stats = quartiles.groupBy(*keys).agg(
            F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q25"),
            F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q75"),
        )
        joined, s = attach(df, stats, keys)
        reach = (s("q75") - s("q25")) * limit
        inside = F.col(col).between(s("q25") - reach, s("q75") + reach)
    else:
        raise ValueError(f"unknown outlier method: {method}")
    return joined.where(F.coalesce(inside, F.lit(True))).select(*df.columns)


def impute_mode(df: DataFrame, col: str, category: str | None = None) -> DataFrame:
    """Missing category → most frequent value (smallest on ties), or a category of its own."""
    if category is not None:
        return df.withColumn(col, F.coalesce(F.col(col), F.lit(category)))
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(col).alias("v")))["v"].alias("v")).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), mode))


def quality_report(df: DataFrame, as_of: str, cols, time_col: str = "time") -> DataFrame:
    """One row per column: rows, missing, mean, std, min, max, and rows stamped after ``as_of``."""
    long = to_long(df, cols, [time_col])
    future = F.col(time_col) > F.lit(as_of).cast("timestamp_ntz")
    return long.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("value").isNull()).alias("missing"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count_if(future).alias("future_rows"),
    )
