"""Demand slots, departure scoring, headways, fleet limits and schedule comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_spark.config import ServiceDefaults
from transit_spark.functions.temporal import hhmm, minute_of_day, plus_minutes
from transit_spark.operators.series import RANGE, ranged, running_total
from transit_spark.operators.summary import attach, exact_quantiles

SERVICE = ServiceDefaults()
ROUND_TRIP_MINUTES = 120


def slot_of(ts: str | Column, service: ServiceDefaults = SERVICE) -> Column:
    """Slot number counted from the first service hour."""
    return F.floor((minute_of_day(ts) - service.first_hour * 60) / service.slot_minutes).cast("int")


def slot_demand(df: DataFrame, value: str = "predicted_demand", service: ServiceDefaults = SERVICE) -> DataFrame:
    """(route, day, slot, time, demand): demand per slot of each service day, zeros filled in."""
    used = df.select(
        "route", F.col("time").cast("date").alias("day"), slot_of("time", service).alias("slot"), value
    ).where(F.col("slot").between(0, service.last_slot))
    totals = used.groupBy("route", "day", "slot").agg(F.sum(value).alias("demand"))
    spine = used.select("route", "day").distinct().select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(service.last_slot))).alias("slot")
    )
    start = plus_minutes(F.col("day").cast("timestamp_ntz"), F.col("slot") * service.slot_minutes + service.first_hour * 60)
    return spine.join(totals, ["route", "day", "slot"], "left").select(
        "route", "day", "slot", start.alias("time"), F.coalesce(F.col("demand"), F.lit(0)).alias("demand")
    )


def fixed_timetable(routes: DataFrame, day: str | None = None, service: ServiceDefaults = SERVICE) -> DataFrame:
    """A departure every slot of the service day. ``routes`` may bring its own ``day`` column."""
    base = routes.select("route", *([] if day else ["day"])).distinct()
    date = F.lit(day).cast("date") if day else F.col("day")
    slots = F.explode(F.sequence(F.lit(0), F.lit(service.last_slot))).alias("slot")
    return base.select("route", date.alias("day"), slots).select(
        "route", "day", "slot",
        plus_minutes(F.col("day").cast("timestamp_ntz"), F.col("slot") * service.slot_minutes + service.first_hour * 60).alias("departure_time"),
    )


def slot_loads(demand: DataFrame, capacity: int, max_wait: int, slot_minutes: int, stop_when_empty: bool) -> DataFrame:
    """What a bus leaving at each (route, day, slot) picks up: served and passenger-minutes waited.

    A slot's demand can only reach departures at most ``max_wait`` earlier, so each demand row is
    handed to those few departures and summed up per departure; the greedy filling is then plain
    arithmetic on a handful of columns. Nothing depends on how many trips or candidates exist.
    """
    reach = max_wait // slot_minutes
    back = F.explode(F.sequence(F.lit(0), F.lit(reach))).alias("offset")
    offered = demand.select("route", "day", F.col("slot").alias("_at"), F.greatest(F.col("demand"), F.lit(0)).alias("_d"), back)
    per_start = (
        offered.withColumn("slot", F.col("_at") - F.col("offset"))
        .where(F.col("slot") >= 0)
        .groupBy("route", "day", "slot")
        .agg(*[F.sum(F.when(F.col("offset") == o, F.col("_d"))).alias(f"_d{o}") for o in range(reach + 1)])
    )
    cols: dict[str, Column] = {}
    served, waited = F.lit(0), F.lit(0)
    going = F.lit(True)
    for o in range(reach + 1):
        d = F.coalesce(F.col(f"_d{o}"), F.lit(0))
        take = F.least(d, F.lit(capacity) - served)
        if stop_when_empty:
            going = going & (take > 0)
            take = F.when(going, take).otherwise(F.lit(0))
        served, waited = served + take, waited + take * (o * slot_minutes)
    cols["served"], cols["wait_minutes"] = served, waited
    return per_start.select("route", "day", "slot", *[c.alias(n) for n, c in cols.items()])


def score_trips(schedule: DataFrame, demand: DataFrame, capacity: int = SERVICE.capacity, max_wait: int = SERVICE.max_wait, slot_minutes: int = SERVICE.slot_minutes) -> DataFrame:
    """Schedule rows with ``served`` and ``wait_minutes``. A schedule without ``day`` runs every day.

    Trips do not use up each other's passengers.
    """
    return _loads_for(schedule, slot_loads(demand, capacity, max_wait, slot_minutes, False))


def _loads_for(schedule: DataFrame, loads: DataFrame) -> DataFrame:
    """Every trip of every day with demand on its route; a trip that meets no demand row serves nobody."""
    if "day" not in schedule.columns:
        schedule = schedule.join(loads.select("route", "day").distinct(), "route", "left")
    keys = ["route", "day", "slot"]
    added = [c for c in loads.columns if c not in keys]
    names = [*keys, *[c for c in schedule.columns if c not in keys], *added]
    met = schedule.join(loads, keys, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in added})
    return met.select(*names)


def trip_loads(schedule: DataFrame, demand: DataFrame, capacity: int = SERVICE.capacity, max_wait: int = SERVICE.max_wait, slot_minutes: int = SERVICE.slot_minutes) -> DataFrame:
    """Final trip table: a trip ends at the first slot that adds nobody."""
    joined = _loads_for(schedule, slot_loads(demand, capacity, max_wait, slot_minutes, True))
    return joined.withColumnRenamed("served", "served_passengers").withColumn(
        "load_factor", F.col("served_passengers") / F.lit(float(capacity))
    )


def score_schedules(candidates: DataFrame, demand: DataFrame, capacity: int = SERVICE.capacity, max_wait: int = SERVICE.max_wait) -> DataFrame:
    """Score of each (route, day, candidate): load factor x 100 - mean wait. Candidates that serve
    nobody are left out."""
    trips = score_trips(candidates, demand, capacity, max_wait)
    sums = trips.groupBy("route", "day", "candidate").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("served").alias("served"), F.sum("wait_minutes").alias("wait_minutes")
    ).where(F.col("served") > 0)
    return sums.withColumns(
        {
            "avg_wait": F.col("wait_minutes") / F.col("served"),
            "load_factor": F.col("served") / (F.col("trips") * capacity),
        }
    ).withColumn("score", F.col("load_factor") * 100 - F.col("avg_wait"))


def best_schedule(candidates: DataFrame, demand: DataFrame, capacity: int = SERVICE.capacity, max_wait: int = SERVICE.max_wait) -> DataFrame:
    """Best candidate per (route, day); the smaller number wins a tie."""
    scored = score_schedules(candidates, demand, capacity, max_wait)
    names = ["candidate", "trips", "served", "avg_wait", "load_factor", "score"]
    best = F.max_by(F.struct(*names), F.struct(F.col("score"), -F.col("candidate")))
    return scored.groupBy("route", "day").agg(best.alias("b")).select("route", "day", "b.*")


def headway_grid(demand: DataFrame, capacity: int = SERVICE.capacity, lo: int = 5, hi: int = 60) -> DataFrame:
    """Every whole-minute headway of each row of ``demand`` (needs ``demand`` = riders per hour)."""
    d, h = F.col("demand").cast("double"), F.col("headway")
    grid = demand.select("*", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("headway"))
    used = d / (F.lit(60.0) / h * capacity)
    u = F.col("utilisation")
    penalty = F.when(u < 0.7, (F.lit(0.7) - u) * d).when(u > 0.9, (u - 0.9) * d * 2).otherwise(0.0)
    return (
        grid.withColumn("trips_per_hour", F.lit(60.0) / h)
        .withColumn("utilisation", used)
        .withColumn("heuristic", F.lit(1.0) / (F.abs(u - 0.75) + 0.1))
        .withColumn("vehicles", F.ceil(F.lit(float(ROUND_TRIP_MINUTES)) / h).cast("int"))
        .withColumn("cost", h / 2 * d * 0.7 + penalty * 0.3)
    )


def best_headway(grid: DataFrame, keys=("route",)) -> DataFrame:
    """Cheapest headway per key; the shorter one wins a tie."""
    names = ["demand", "headway", "trips_per_hour", "utilisation", "vehicles", "cost"]
    best = F.min_by(F.struct(*names), F.struct("cost", "headway"))
    return grid.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def apply_fleet_limit(best: DataFrame, fleet: int | Column = SERVICE.fleet, keys=()) -> DataFrame:
    """Vehicles handed out in route order. The route that overflows gets what is left, later routes
    get none (and are not returned)."""
    fleet = F.lit(fleet) if isinstance(fleet, int) else fleet
    total = running_total(ranged(best, [*keys, "route"]), keys, ["route"], "vehicles", block=F.col(RANGE))
    before = F.col("_total") - F.col("vehicles")
    left = fleet - before
    fits = F.col("_total") <= fleet
    return (
        total.where(fits | (left > 0))
        .withColumns(
            {
                "headway": F.when(fits, F.col("headway")).otherwise(F.floor(F.lit(float(ROUND_TRIP_MINUTES)) / left)).cast("int"),
                "vehicles": F.when(fits, F.col("vehicles")).otherwise(left).cast("int"),
            }
        )
        .select(*best.columns)
    )


def schedule_kpis(trips: DataFrame, keys=(), capacity: int = SERVICE.capacity, trip_minutes: int = SERVICE.trip_minutes) -> DataFrame:
    """Demand-weighted mean wait, p95 wait, mean and peak occupancy, share of empty runs,
    vehicle-hours. ``trips`` needs served_passengers and wait_minutes."""
    keys = list(keys)
    load = F.col("served_passengers") / F.lit(float(capacity))
    per_trip = trips.withColumn("_wait", F.try_divide(F.col("wait_minutes"), F.col("served_passengers")).cast("double"))
    sums = per_trip.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trips"),
        F.try_divide(F.sum("wait_minutes"), F.sum("served_passengers")).alias("mean_wait"),
        F.avg(load).alias("mean_occupancy"),
        F.max(load).alias("peak_occupancy"),
        F.avg((load < 0.2).cast("double")).alias("empty_run_share"),
        (F.count(F.lit(1)) * trip_minutes / 60).alias("vehicle_hours"),
    )
    p95 = exact_quantiles(per_trip, "_wait", [0.95], keys).select(*keys, F.col("value").alias("p95_wait"))
    joined, stat = attach(sums, p95, keys)
    return joined.select(*sums.columns, stat("p95_wait").alias("p95_wait"))


def compare(ours: DataFrame, other: DataFrame) -> DataFrame:
    """Long table (metric, value) from two one-row KPI frames: both sides and the improvement."""
    a = ours.select(F.struct("trips", "mean_wait", "mean_occupancy")).scalar()
    renamed = other.select("trips", "mean_wait", "mean_occupancy")
    wide = renamed.select(
        a["mean_wait"].alias("wait_ours"),
        F.col("mean_wait").alias("wait_other"),
        a["mean_occupancy"].alias("load_ours"),
        F.col("mean_occupancy").alias("load_other"),
        (F.try_divide(F.col("mean_wait") - a["mean_wait"], F.col("mean_wait")) * 100).alias("wait_improvement_pct"),
        (F.try_divide(a["mean_occupancy"] - F.col("mean_occupancy"), F.col("mean_occupancy")) * 100).alias("load_improvement_pct"),
        (F.col("trips") - a["trips"]).cast("double").alias("saved_trips"),
    )
    return wide.unpivot([], list(wide.columns), "metric", "value")


def trip_board(trips: DataFrame, minutes: int = SERVICE.trip_minutes) -> DataFrame:
    """Departure board: end time, label, load of at least 80 %."""
    return trips.withColumns(
        {
            "end_time": plus_minutes("departure_time", minutes),
            "label": hhmm("departure_time"),
            "well_used": F.col("load_factor") >= 0.8,
        }
    )


def sensitivity(demand: DataFrame, fleet: int = SERVICE.fleet, demand_changes=(-20, -10, 0, 10, 20), fleet_changes=(-10, -5, 0, 5, 10)) -> DataFrame:
    """Best headways under changed demand and fleet, summed per scenario."""
    shifted = demand.select(
        "route", "demand", F.explode(F.array(*[F.lit(p) for p in demand_changes])).alias("demand_pct")
    ).withColumn("demand", F.col("demand") * (F.col("demand_pct") + 100) / 100)
    best = best_headway(headway_grid(shifted), ["demand_pct", "route"])
    scenarios = best.select("*", F.explode(F.array(*[F.lit(p) for p in fleet_changes])).alias("fleet_pct"))
    size = F.floor(F.lit(fleet) * (F.col("fleet_pct") + 100) / 100)
    kept = apply_fleet_limit(scenarios.withColumn("_fleet", size), F.col("_fleet"), ["demand_pct", "fleet_pct"])
    return kept.groupBy("demand_pct", "fleet_pct").agg(
        F.count(F.lit(1)).alias("routes_served"),
        F.sum("vehicles").alias("vehicles"),
        (F.sum(F.col("headway") / 2 * F.col("demand")) / F.sum("demand")).alias("mean_wait"),
    )


def robust_demand(df: DataFrame, z: float = 2.0) -> DataFrame:
    """Planner input: mean forecast plus ``z`` deviations."""
    return df.withColumn("robust_demand", F.col("predicted") + F.col("predicted_std") * z)
