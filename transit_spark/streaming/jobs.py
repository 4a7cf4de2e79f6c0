"""Structured Streaming versions of cleaning, aggregation, enrichment, scoring and feedback."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from transit_spark import config as C
from transit_spark.functions.temporal import to_time
from transit_spark.operators.cleaning import clamp_negative, clip, drop_above, drop_outside, in_bounds, nan_to_null
from transit_spark.operators.evaluation import error_frame
from transit_spark.operators.forecast import predict
from transit_spark.operators.summary import exact_quantiles

#: Rows of all series that a task holds while it cuts them to the last of each.
HELD_ROWS = 200_000


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def event_time(sdf: DataFrame, col: str = "time") -> DataFrame:
    """Watermarks need TIMESTAMP; only in a UTC session the digits stay the same."""
    if sdf.sparkSession.conf.get("spark.sql.session.timeZone") != "UTC":
        raise ValueError("streams need spark.sql.session.timeZone = UTC")
    return sdf.withColumn(col, F.col(col).cast("timestamp"))


def stream_clean(sdf: DataFrame) -> DataFrame:
    """The stateless cleaning steps, unchanged from the batch side."""
    sdf = nan_to_null(sdf)
    if "time" in sdf.columns:
        sdf = to_time(sdf, ["time"])
    sdf = in_bounds(drop_above(clamp_negative(sdf)))
    if "speed" in sdf.columns:
        sdf = clip(sdf, "speed", float(C.MIN_SPEED_KMH), float(C.MAX_SPEED_KMH))
    if "temperature" in sdf.columns:
        sdf = drop_outside(sdf, "temperature", C.MIN_TEMPERATURE_C, C.MAX_TEMPERATURE_C)
    return sdf


def stream_dedupe(sdf: DataFrame, keys=C.DEMAND_KEYS, delay: str = "30 minutes", time_col: str = "time") -> DataFrame:
    """One row per key; state is dropped once the watermark has passed."""
    return event_time(sdf, time_col).withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_demand(sdf: DataFrame, size: str = "15 minutes", slide: str | None = None, delay: str = "30 minutes", value: str = "passengers") -> DataFrame:
    """Demand per window and route. Partial sums are built before the shuffle, so a busy route does
    not send its rows to one task."""
    window = F.window("time", size, slide) if slide else F.window("time", size)
    return (
        event_time(sdf).withWatermark("time", delay).groupBy(window.alias("w"), "route")
        .agg(F.sum(value).alias("total_demand"), F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "route", "total_demand", "n")
    )


def stream_enrich(sdf: DataFrame, static: DataFrame, on=("route", "stop")) -> DataFrame:
    return sdf.join(static, list(on), "left")


def keep_latest(sdf: DataFrame, cols, length: int = 12, keys=("route", "stop"), order=("time", "seq"), expire: str = "7 days") -> DataFrame:
    """(keys, time, x): the last ``length`` rows of each series a batch touches, as soon as there are so many.

    ``sdf`` is a stream whose first order column carries a watermark; further order columns are whole
    numbers. The state store holds at most ``length`` rows per series, and only the series a batch
    touches are read and written. A series without rows for ``expire`` (by the watermark) is forgotten. Each task first
    cuts its rows to the last ``length`` per series, so a busy series sends few of them to its state.
    Rows may come late: they are placed by their order.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    time, *ties = order
    marks = [f"_o{i}" for i in range(len(order))]
    packed = sdf.select(
        *keys, time, F.unix_micros(time).alias(marks[0]), *[F.col(c).cast("long").alias(m) for c, m in zip(ties, marks[1:])],
        F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"),
    )

    def last_rows(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values(marks, kind="stable").groupby(keys, dropna=False, sort=False).tail(length)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = last_rows(batch if held is None else pd.concat([held, batch], ignore_index=True))
            if len(held) > HELD_ROWS:
                yield held
                held = None
        if held is not None:
            yield held

    waits = pd.Timedelta(expire) // pd.Timedelta(milliseconds=1)

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = list(zip(*state.get)) if state.exists else []
        for batch in batches:
            fresh = zip(*[batch[m].tolist() for m in marks], [list(map(float, x)) for x in batch["_x"]])
            rows = sorted([*rows, *fresh], key=lambda r: r[:-1])[-length:]
        state.update(tuple(list(column) for column in zip(*rows)))
        newest = rows[-1][0] // 1000
        state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + waits)
        if len(rows) == length:
            yield pd.DataFrame([(*key, pd.Timestamp(rows[-1][0], unit="us"), [r[-1] for r in rows])], columns=[*keys, time, "x"])

    types = {f.name: f.dataType.simpleString() for f in packed.schema.fields}
    out = ", ".join(f"`{c}` {types[c]}" for c in [*keys, time]) + ", x array<array<double>>"
    kept = ", ".join(f"{m} array<bigint>" for m in marks) + ", x array<array<double>>"
    return packed.mapInPandas(cut, packed.schema).groupBy(*keys).applyInPandasWithState(update, out, kept, "append", GroupStateTimeout.EventTimeTimeout)


def stream_latest(
    sdf: DataFrame, model, cols, length: int = 12, keys=("route", "stop"), order=("time", "seq"), delay: str = "30 minutes", expire: str = "7 days",
) -> DataFrame:
    """Per batch and touched series the score of its last full window (``keep_latest``)."""
    timed = event_time(sdf, order[0]).withWatermark(order[0], delay)
    return predict(model, keep_latest(timed, cols, length, keys, order, expire)).drop("x")


def stream_feedback(predictions: DataFrame, actuals: DataFrame, delay: str = "1 hour", within: str = "1 hour", keys=("route", "stop")) -> DataFrame:
    """Forecasts joined to the values seen later for the same series and time, with error columns.

    ``predictions`` has ``created_at`` (when it was made) and ``time`` (what it is about).
    """
    made = event_time(event_time(predictions), "created_at").withWatermark("time", delay)
    seen = event_time(actuals).withWatermark("time", delay)
    made = made.select(*[F.col(k).alias(f"p_{k}") for k in keys], F.col("time").alias("p_time"), "created_at", "predicted")
    seen = seen.select(*keys, "time", F.col("passengers").cast("double").alias("actual"))
    early = F.col("created_at") >= F.col("time") - F.expr(f"INTERVAL {within}")
    on = (F.col("p_time") == F.col("time")) & early & (F.col("created_at") <= F.col("time"))
    for k in keys:
        on = on & (F.col(f"p_{k}") == F.col(k))
    joined = made.join(seen, on, "inner")
    return error_frame(joined.select(*keys, "time", "created_at", "predicted", "actual"))


def feedback_summary(errors: DataFrame, target_mape: float = C.ForecastDefaults().target_mape, keys=("route",)) -> DataFrame:
    """Running error per group and whether the model should be trained again; only pairs with both sides count."""
    return errors.groupBy(*keys).agg(
        F.count("error").alias("n"), F.avg("abs_error").alias("mae"), F.avg("pct_error").alias("mape")
    ).withColumn("retrain", F.col("mape") > target_mape)


def error_windows(errors: DataFrame, size: str = "1 hour", keys=("route",)) -> DataFrame:
    """(keys, window_start, window_end, n, mae, mape) of an error frame, batch or stream.

    On a stream (such as ``stream_feedback``) a window is returned once the watermark has passed it.
    Errors are summed before the shuffle; pairs with a missing side count nowhere.
    """
    known = errors.where(F.col("error").isNotNull())
    return (
        known.groupBy(F.window("time", size).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.avg("abs_error").alias("mae"), F.avg("pct_error").alias("mape"))
        .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "mae", "mape")
    )


def drift(windows: DataFrame, target: float, limit: float, slack: float = 0.0, keys=("route",), measure: str = "mae") -> DataFrame:
    """``windows`` with ``drift``, the cumulative sum S = max(0, S + measure - target - slack), and ``retrain``: S > ``limit``.

    A single bad window does not raise the flag, a lasting small excess does. Batch form: the sum is
    its running total less the least total so far, over the windows of a group, of which there is one per span of time.
    """
    group = Window.partitionBy(*keys).orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    total = windows.withColumn("_total", F.sum(F.col(measure) - (target + slack)).over(group))
    total = total.withColumn("drift", F.col("_total") - F.least(F.lit(0.0), F.min("_total").over(group)))
    return total.drop("_total").withColumn("retrain", F.col("drift") > limit)


def stream_drift(windows: DataFrame, target: float, limit: float, slack: float = 0.0, keys=("route",), measure: str = "mae") -> DataFrame:
    """``drift`` on a stream of closed windows; the state of a group is its sum so far.

    Windows of a group must come in the order of time, batch by batch: so they do from ``error_windows``,
    which closes them along the watermark. Within a batch they are sorted here.
    """
    keys = list(keys)
    columns = windows.columns

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total = state.get[0] if state.exists else 0.0
        rows = pd.concat(list(batches), ignore_index=True).sort_values("window_start")
        sums = []
        for value in rows[measure]:
            total = max(0.0, total + value - target - slack)
            sums.append(total)
        state.update((total,))
        yield rows[columns].assign(drift=sums, retrain=[s > limit for s in sums])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in windows.schema.fields) + ", drift double, retrain boolean"
    return windows.groupBy(*keys).applyInPandasWithState(update, out, "total double", "append", GroupStateTimeout.NoTimeout)


def watch_forecasts(
    predictions: DataFrame, actuals: DataFrame, path: str, target: float, limit: float, slack: float = 0.0, size: str = "1 hour",
    delay: str = "1 hour", within: str = "1 hour", series=("route", "stop"), keys=("route",), measure: str = "mae",
) -> DataFrame:
    """Forecasts meet their actual values, errors are summed per window, sums raise the retrain flag.

    Two queries in a row, since a state per group may not follow an aggregate in one: the first joins both
    streams and appends closed windows below ``path``, the second reads them as a stream. Both go on from their logs
    when called again; each processes what is there.
    """
    errors = stream_feedback(predictions, actuals, delay, within, series)
    windows = run_once(error_windows(errors, size, keys), f"{path}/windows")
    closed = predictions.sparkSession.readStream.schema(windows.schema).parquet(f"{path}/windows/rows")
    return run_once(stream_drift(closed, target, limit, slack, keys, measure), f"{path}/drift")


def freshness(df: DataFrame, event: str, stored: str, as_of: str) -> DataFrame:
    """Seconds from event to store (mean, p95, max) and age in seconds of the newest event."""
    from transit_spark.functions.temporal import epoch_micros

    lag = (epoch_micros(stored) - epoch_micros(event)) / 1_000_000
    timed = df.select(lag.alias("lag"), F.col(event).alias("event"))
    now = epoch_micros(F.lit(as_of).cast("timestamp_ntz"))
    p95 = exact_quantiles(timed, "lag", [0.95]).select("value").scalar()
    return timed.agg(
        F.count("lag").alias("n"), F.avg("lag").alias("mean_lag"), F.max("lag").alias("max_lag"),
        ((now - F.max(epoch_micros("event"))) / 1_000_000).alias("age"),
    ).withColumn("p95_lag", p95)


def run_once(sdf: DataFrame, path: str) -> DataFrame:
    """Processes what is there, appends it to parquet below ``path`` and reads that back."""
    query = (
        sdf.writeStream.format("parquet").outputMode("append")
        .option("path", f"{path}/rows").option("checkpointLocation", f"{path}/log")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sdf.sparkSession.read.schema(sdf.schema).parquet(f"{path}/rows")
