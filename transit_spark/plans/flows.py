"""Entry points that put the operators together."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark import config as C
from transit_spark.functions.spatial import center_features, next_stop_distance, stop_features
from transit_spark.functions.temporal import temporal_features, to_time
from transit_spark.operators import forecast as fc
from transit_spark.operators import schedule as sc
from transit_spark.operators.cleaning import clean_demand, clean_events, clean_gps, clean_weather
from transit_spark.operators.context import active_events, contextual_features
from transit_spark.operators.scaling import categorical_columns, encode, fit_labels, fit_scaler, numeric_columns, scale
from transit_spark.operators.series import series_features
from transit_spark.operators.summary import demand_by_time
from transit_spark.session import stage, stage_all
from transit_spark.sources.tables import StageStats, read_table, save_dataset, write_tables

IDENTIFIERS = ("time", "route", "stop", *C.DEMAND_COUNTS)


@dataclass
class Processed:
    """Result of a flow with what was fitted on the way."""

    data: DataFrame
    scaler: DataFrame | None = None
    labels: DataFrame | None = None


def demand_features(
    demand: DataFrame, stops: DataFrame | None = None, weather: DataFrame | None = None, events: DataFrame | None = None,
    lags=(), windows=(), target: str = C.TARGET, stops_on=("stop",),
) -> DataFrame:
    """Cleaned demand with temporal, spatial and contextual (and, on request, lag) features.

    The small sides (weather, active events per time, stop distances) are staged first. Their true
    sizes are then known when the joins are planned: those below Spark's broadcast threshold leave
    the demand rows where they are, larger ones are joined by shuffling.
    """
    sides: dict[str, DataFrame] = {}
    if stops is not None:
        sides |= {"stops": stops, "distances": next_stop_distance(stops)}
    if weather is not None:
        sides["weather"] = weather
    if events is not None:
        sides["active"] = active_events(to_time(demand.select("time"), ["time"]), events)
    sides = stage_all(sides)
    df = temporal_features(clean_demand(demand))
    if lags or windows:
        df = series_features(df, target, lags, windows, ["route", "stop"], ["time"])
    if stops is not None:
        if {"latitude", "longitude"} <= set(df.columns):
            df = center_features(df)
        df = stop_features(df, sides["stops"], stops_on, sides["distances"])
    if weather is not None or events is not None:
        df = contextual_features(df, sides.get("weather"), events, sides.get("active"))
    return df


def process_demand(
    demand: DataFrame, stops: DataFrame | None = None, weather: DataFrame | None = None, events: DataFrame | None = None,
    normalize: bool = True, method: str = "minmax", order=("seq",), **options,
) -> Processed:
    """Features, then label codes for text columns and scaling of the numeric ones.

    The numeric columns are listed before encoding, so label codes stay unscaled. Fitting reads the
    features again, so they are staged: joined once, then scanned by column.
    """
    df = demand_features(demand, stops, weather, events, **options)
    if not normalize:
        return Processed(df)
    df = stage(df)
    kept = df.drop(*IDENTIFIERS, *order)
    # The column lists are explicit, so hour and month are scaled as well.
    numeric = [c for c, t in kept.dtypes if t not in ("string", "timestamp_ntz", "timestamp", "date", "boolean")]
    texts = categorical_columns(kept)
    labels = fit_labels(df, texts) if texts else None
    scaler = fit_scaler(df, numeric, method)
    encoded = encode(df, labels) if texts else df
    return Processed(scale(encoded, scaler), scaler, labels)


def process_gps(gps: DataFrame, normalize: bool = True, method: str = "minmax") -> Processed:
    df = temporal_features(clean_gps(gps))
    if not normalize:
        return Processed(df)
    df = stage(df)
    scaler = fit_scaler(df, [c for c in C.GPS_NUMERIC if c in df.columns], method)
    return Processed(scale(df, scaler), scaler)


@dataclass
class Dataset:
    tables: dict[str, DataFrame]
    stats: dict[str, dict] = field(default_factory=dict)


def process_dataset(
    routes: DataFrame, stops: DataFrame, demand: DataFrame, gps: DataFrame, weather: DataFrame | None = None, events: DataFrame | None = None,
    normalize: bool = True, path: str | None = None, database: str | None = None, fmt: str = "csv", orders: dict | None = None, **options,
) -> Dataset:
    """All tables of a dataset; saved as files under ``path`` and as tables in ``database`` if given.

    The cleaned weather and events are staged first, so they are computed once for the demand step
    and for their own tables and survive a lost executor. ``stats`` has rows, columns and seconds of each table's write, or, without
    ``path``, nothing.
    """
    watch = StageStats()
    sides: dict[str, DataFrame] = {}
    if weather is not None:
        sides["weather"] = clean_weather(weather)
    if events is not None:
        sides["events"] = clean_events(events)
    tables: dict[str, DataFrame] = {"routes": routes, "stops": stops} | stage_all(sides)
    done = process_demand(demand, stops, tables.get("weather"), tables.get("events"), normalize, **options)
    tables["demand"] = done.data
    tables["gps"] = process_gps(gps, normalize).data
    if path is not None:
        write_tables(tables, path, "processed_", fmt, watch)
    if database is not None:
        save_dataset(tables, database, orders)
    return Dataset(tables, watch.report())


def process_files(spark: SparkSession, source: str, path: str | None = None, database: str | None = None, **options) -> Dataset:
    """``process_dataset`` on the CSV files of a folder; weather and events may be absent.

    Files have no sequence column, so of readings with one key the one with the least values counts.
    """
    raw = {name: read_table(spark, source, name) for name in ("routes", "stops", "demand", "gps", "weather", "events")}
    # Time features are computed anew from the cleaned time.
    demand = raw["demand"].select("route", "stop", "time", *C.DEMAND_COUNTS)
    return process_dataset(raw["routes"], raw["stops"], demand, raw["gps"], raw["weather"], raw["events"], path=path, database=database, order=(), **options)


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, records, columns)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("stage"), "records", F.lit(len(df.columns)).alias("columns"))
        for name, df in stages.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def candidate_timetables(routes: DataFrame, every=(1, 2, 3, 4), service: C.ServiceDefaults = sc.SERVICE) -> DataFrame:
    """Candidate k departs every k-th slot."""
    k = F.explode(F.array(*[F.lit(i) for i in every])).alias("candidate")
    base = routes.select("route").distinct().select("route", k)
    return base.select("route", "candidate", F.explode(F.sequence(F.lit(0), F.lit(service.last_slot), F.col("candidate"))).alias("slot"))


@dataclass
class DayPlan:
    forecast: DataFrame
    schedule: DataFrame
    headways: DataFrame
    kpis: DataFrame
    comparison: DataFrame


def plan_day(demand: DataFrame, length: int = 8, steps: int = 96, per_route: bool = True, fleet: int = sc.SERVICE.fleet, ridge: float = 1e-6) -> DayPlan:
    """Forecast each route's total demand, pick timetables and headways, compare with the fixed one."""
    totals = stage(demand_by_time(demand).withColumn("total_demand", F.col("total_demand").cast("double")))
    train = fc.windows(totals, ["total_demand"], length, 1, 1, ["route"])
    latest, _ = fc.latest_windows(totals, ["total_demand"], length, ["route"])
    if per_route:
        predicted = fc.forecast_per_route(fc.fit_per_route(train, length, ridge=ridge), latest, steps)
    else:
        predicted = fc.forecast(fc.fit_forecaster(train), latest, steps)
    predicted = stage(predicted.withColumn("predicted_demand", F.col("predicted_demand").cast("int")))
    slots = stage(sc.slot_demand(predicted))
    best = sc.best_schedule(candidate_timetables(slots), slots)
    chosen = candidate_timetables(slots).join(best.select("route", "day", "candidate"), ["route", "candidate"])
    trips = stage(sc.trip_loads(chosen, slots))
    fixed = stage(sc.trip_loads(sc.fixed_timetable(slots), slots))
    ours, others = sc.schedule_kpis(trips), sc.schedule_kpis(fixed)
    hourly = predicted.groupBy("route").agg((F.sum("predicted_demand") / (steps / 4)).alias("demand"))
    headways = sc.apply_fleet_limit(sc.best_headway(sc.headway_grid(hourly)), fleet)
    return DayPlan(predicted, trips, headways, ours, sc.compare(ours, others))


__all__ = [
    "DayPlan", "Dataset", "Processed", "candidate_timetables", "demand_features", "numeric_columns",
    "plan_day", "process_dataset", "process_demand", "process_files", "process_gps", "stage_counts",
]
