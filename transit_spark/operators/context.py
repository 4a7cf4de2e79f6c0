"""Weather, city events and lookup joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_spark.functions.spatial import EARTH_RADIUS_KM, haversine
from transit_spark.functions.temporal import epoch_micros, floor_time
from transit_spark.operators.series import RANGE, ranged, running_totals
from transit_spark.session import stage, stage_all

WEATHER_COLS = ("temperature", "humidity", "rain_mm", "wind_speed", "conditions")

# Aligned pieces of 2**0 .. 2**TOP_LEVEL microseconds (about 407 days) cover any interval.
TOP_LEVEL = 45


def join_weather(df: DataFrame, weather: DataFrame, minutes: int = 15) -> DataFrame:
    """Left join on the time slot; several weather rows in one slot fan out."""
    cols = [c for c in WEATHER_COLS if c in weather.columns]
    slots = weather.select(floor_time("time", minutes).alias("_slot"), *cols)
    return df.withColumn("_slot", floor_time("time", minutes)).join(slots, "_slot", "left").drop("_slot")


def _bin(col: str, edges, labels) -> Column:
    """Right-closed bins; outside of them NULL."""
    c = F.col(col)
    cases = [((c > lo) & (c <= hi), label) for lo, hi, label in zip(edges, edges[1:], labels)]
    return reduce(lambda acc, case: acc.when(*case), cases[1:], F.when(*cases[0]))


def weather_features(df: DataFrame) -> DataFrame:
    new = {}
    if "rain_mm" in df.columns:
        new["is_raining"] = F.coalesce(F.col("rain_mm") > 0, F.lit(False)).cast("int")
        new["rain_intensity"] = _bin("rain_mm", (-0.1, 0, 1, 5, 100), ("none", "light", "moderate", "heavy"))
    if "temperature" in df.columns:
        new["temp_category"] = _bin("temperature", (0, 25, 30, 35, 50), ("cool", "comfortable", "hot", "very_hot"))
        if "humidity" in df.columns:
            new["heat_index"] = F.col("temperature") * (1 + F.col("humidity") / 200)
    return df.withColumns(new) if new else df


def aligned_pieces(spans: DataFrame) -> DataFrame:
    """Cuts each span ``_s`` <= x < ``_e`` of whole numbers into aligned pieces, at most two per level.

    A piece is (``_level``, ``_node``): the numbers node*2**level .. (node+1)*2**level - 1. A number
    lies in the span exactly when its own node on some level is one of the pieces, so "number in
    range" becomes a plain equi-join: no range condition, no pairs to filter, and a span of any
    length costs a few dozen rows.
    """
    inner = """
        flatten(transform(sequence(0, {top} - 1), k -> array(
            CASE WHEN -shiftright(-_s, k) < shiftright(_e, k) AND (-shiftright(-_s, k)) % 2 <> 0
                 THEN struct(k AS level, -shiftright(-_s, k) AS node) END,
            CASE WHEN -shiftright(-_s, k) < shiftright(_e, k) AND shiftright(_e, k) % 2 <> 0
                 THEN struct(k AS level, shiftright(_e, k) - 1 AS node) END)))
    """.format(top=TOP_LEVEL)
    outer = """
        CASE WHEN -shiftright(-_s, {top}) < shiftright(_e, {top})
             THEN transform(sequence(-shiftright(-_s, {top}), shiftright(_e, {top}) - 1),
                            n -> struct({top} AS level, n AS node))
             ELSE array() END
    """.format(top=TOP_LEVEL)
    pieces = F.filter(F.concat(F.expr(inner), F.expr(outer)), lambda p: p.isNotNull())
    return (
        spans.where(F.col("_s") < F.col("_e")).withColumn("_piece", F.explode(pieces))
        .withColumns({"_level": F.col("_piece.level"), "_node": F.col("_piece.node")})
        .drop("_s", "_e", "_piece")
    )


def interval_pieces(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """The aligned pieces, in microseconds, of each closed interval of time."""
    return aligned_pieces(intervals.withColumns({"_s": epoch_micros(start), "_e": epoch_micros(end) + 1}))


def look_up(times: DataFrame, pieces: DataFrame) -> DataFrame:
    """Each distinct ``time`` with every row of ``pieces`` that holds it."""
    look = (
        times.select("time").distinct()
        .withColumn("_micros", epoch_micros("time"))
        .withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(TOP_LEVEL))))
        .withColumn("_node", F.expr("shiftright(_micros, _level)"))
        .drop("_micros")
    )
    return look.join(pieces, ["_level", "_node"])


def active_events(times: DataFrame, events: DataFrame) -> DataFrame:
    """(time, active_count, active_impact) of each distinct time some event is active at.

    A sweep over the sorted instants at which events start or have ended, and the times asked for,
    cut into ranges: the running sum of starts and ends is the number of active events, and the running number of instants
    names the segment a time lies in. Between two instants nothing changes, so the largest impact belongs
    to a segment: events are spans of segment numbers, cut into aligned pieces that meet the segments asked for,
    of which there are never more than instants. Each time is looked up once.
    """
    has_impact = "impact_factor" in events.columns
    impact = F.max("impact_factor") if has_impact else F.max(F.lit(None).cast("double"))
    spans = (
        events.select(epoch_micros("start_time").alias("_s"), (epoch_micros("end_time") + 1).alias("_e"), *(["impact_factor"] if has_impact else []))
        .where(F.col("_s") < F.col("_e"))
        .groupBy("_s", "_e").agg(F.count(F.lit(1)).alias("n"), impact.alias("impact"))
    )
    asked = times.where(F.col("time").isNotNull()).select(F.col("time").cast("timestamp_ntz").alias("time")).distinct()
    sides = stage_all({"spans": spans, "asked": asked})
    spans = sides["spans"]
    none = F.lit(None).cast("timestamp_ntz").alias("time")
    starts = spans.select(F.col("_s").alias("at"), none, F.col("n").alias("step"), F.lit(1).alias("mark"))
    ends = spans.select(F.col("_e").alias("at"), none, (-F.col("n")).alias("step"), F.lit(1).alias("mark"))
    asked = sides["asked"].select(epoch_micros("time").alias("at"), "time", F.lit(0).cast("long").alias("step"), F.lit(0).alias("mark"))
    # One row per instant: a start or an end at a time takes effect for it.
    instants = starts.unionByName(ends).unionByName(asked).groupBy("at").agg(F.max("time").alias("time"), F.sum("step").alias("step"), F.max("mark").alias("mark"))
    swept = running_totals(ranged(instants, ["at"]), [], ["at"], ["step", "mark"], F.col(RANGE))
    swept = stage(swept.select("at", "time", "mark", F.col("_total_step").alias("active_count"), F.col("_total_mark").alias("segment")))
    seen = swept.where(F.col("time").isNotNull() & (F.col("active_count") > 0)).select("time", "active_count", "segment")
    marks = swept.where("mark = 1")
    numbered = (
        spans.join(marks.select(F.col("at").alias("_s"), F.col("segment").alias("first")), "_s")
        .join(marks.select(F.col("at").alias("_e"), F.col("segment").alias("after")), "_e")
        .groupBy(F.col("first").alias("_s"), F.col("after").alias("_e")).agg(F.max("impact").alias("impact"))
    )
    pieces = aligned_pieces(numbered).groupBy("_level", "_node").agg(F.max("impact").alias("impact"))
    # No piece is longer than there are segments.
    top = marks.agg(F.floor(F.log2(F.count(F.lit(1)) + 1)).cast("int")).scalar()
    look = seen.select("segment").distinct().withColumn("_level", F.explode(F.sequence(F.lit(0), top))).withColumn("_node", F.expr("shiftright(segment, _level)"))
    strongest = look.join(pieces, ["_level", "_node"]).groupBy("segment").agg(F.max("impact").alias("active_impact"))
    return seen.join(strongest, "segment", "left").select("time", "active_count", "active_impact")


def join_active_events(
    df: DataFrame, events: DataFrame, times: DataFrame | None = None, active: DataFrame | None = None
) -> DataFrame:
    """nearby_events: events whose closed interval holds the row's time; event_impact_factor: the
    largest impact among them (1.0 without any).

    ``times`` may name a cheaper frame that has every time of ``df`` (and perhaps more), such as the
    raw table ``df`` was cleaned from. ``active`` is a ready result of ``active_events``.
    """
    if active is None:
        active = active_events(df if times is None else times, events)
    return df.join(active, "time", "left").select(
        *df.columns,
        F.coalesce(F.col("active_count"), F.lit(0)).cast("int").alias("nearby_events"),
        F.coalesce(F.col("active_impact"), F.lit(1.0)).alias("event_impact_factor"),
    )


def commute_flag(df: DataFrame) -> DataFrame:
    hour = F.col("hour")
    weekday = F.coalesce(F.col("is_weekend"), F.lit(0)) == 0 if "is_weekend" in df.columns else F.lit(True)
    busy = hour.between(7, 9) | hour.between(16, 18)
    return df.withColumn("is_commute_time", F.coalesce(busy & weekday, F.lit(False)).cast("int"))


def contextual_features(
    df: DataFrame, weather: DataFrame | None = None, events: DataFrame | None = None, active: DataFrame | None = None
) -> DataFrame:
    if weather is not None:
        df = weather_features(join_weather(df, weather))
    if events is not None:
        df = join_active_events(df, events, active=active)
    return commute_flag(df)


def events_in_range(events: DataFrame, lo, hi, mode: str = "touch") -> DataFrame:
    """``touch``: start or end lies in the range; ``overlap``: also events that span it."""
    lo, hi = F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")
    start, end = F.col("start_time"), F.col("end_time")
    if mode == "touch":
        return events.where(start.between(lo, hi) | end.between(lo, hi))
    if mode == "overlap":
        return events.where((start <= hi) & (end >= lo))
    raise ValueError(f"unknown mode: {mode}")


def integrate_demand(demand: DataFrame, weather: DataFrame, events: DataFrame) -> DataFrame:
    """Inner joins on the exact time; adjusted_demand is passengers x factor, truncated."""
    return (
        demand.join(weather, "time")
        .join(events, "time")
        .withColumn("adjusted_demand", (F.col("passengers") * F.col("demand_factor")).cast("int"))
    )


def matching(df: DataFrame, other: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """Rows whose key is in ``other`` (or, with ``keep=False``, is not)."""
    return df.join(other.select(key).distinct(), key, "left_semi" if keep else "left_anti")


def enrich_routes(routes: DataFrame, attributes: DataFrame, key: str = "page_id") -> DataFrame:
    """Route list with its attributes; routes without attributes keep empty texts."""
    joined = routes.join(attributes, key, "left")
    names = [c for c in attributes.columns if c != key]
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in names})


def event_impact(df: DataFrame, attendance: str = "expected_attendance") -> DataFrame:
    return df.withColumn("impact_factor", F.lit(1.0) + F.col(attendance) / 50000 * 0.5)


def event_factor(df: DataFrame, kind: str = "event") -> DataFrame:
    factor = F.when(F.col(kind) == "traffic_jam", 1.5).when(F.col(kind) == "festival", 1.7).otherwise(1.0)
    return df.withColumn("demand_factor", factor)


def event_proximity(df: DataFrame, stops: DataFrame, events: DataFrame, km: float = 2.0, times: DataFrame | None = None) -> DataFrame:
    """event_nearby and event_distance of the nearest active event within ``km`` of the row's stop.

    Stops meet event places in cubes of space that are ``km`` wide, so a stop looks at 3x3x3 cubes
    wherever it lies. Only the (route, stop, time) that occur in ``df`` then meet the places near their
    stop, and those that are busy at that time stay.
    """

    def cell(lat: Column, lng: Column) -> list[Column]:
        # A straight line is never longer than the way over the surface; the slack covers rounding.
        width = km * (1 + 1e-9) / EARTH_RADIUS_KM
        lat, lng = F.radians(lat), F.radians(lng)
        return [
            F.floor(x / width).alias(name)
            for x, name in ((F.cos(lat) * F.cos(lng), "_x"), (F.cos(lat) * F.sin(lng), "_y"), (F.sin(lat), "_z"))
        ]

    steps = (-1, 0, 1)
    around = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(z).alias("z")) for x in steps for y in steps for z in steps])
    places = (
        stops.select("route", "stop", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lng"))
        .distinct()
        .select("*", *cell(F.col("_lat"), F.col("_lng")), F.explode(around).alias("_d"))
        .withColumns({c: F.col(c) + F.col(f"_d.{c[1]}") for c in ("_x", "_y", "_z")})
    )
    venue = ["_vlat", "_vlng"]
    held = events.select(F.col("latitude").alias("_vlat"), F.col("longitude").alias("_vlng"), "start_time", "end_time")
    venues = held.select(*venue).distinct().select("*", *cell(F.col("_vlat"), F.col("_vlng")))
    distance = haversine(F.col("_lat"), F.col("_lng"), F.col("_vlat"), F.col("_vlng"))
    reach = places.join(venues, ["_x", "_y", "_z"]).withColumn("_km", distance).where(F.col("_km") <= km)
    pieces = interval_pieces(held.join(reach.select(*venue).distinct(), venue, "left_semi"), "start_time", "end_time")
    busy = look_up(df if times is None else times, pieces.select(*venue, "_level", "_node").distinct()).select(*venue, "time").distinct()
    asked = df.select("route", "stop", "time").distinct().join(reach.select("route", "stop", *venue, "_km"), ["route", "stop"])
    near = asked.join(busy, [*venue, "time"]).groupBy("route", "stop", "time").agg(F.min("_km").alias("event_distance"))
    return df.join(near, ["route", "stop", "time"], "left").withColumn(
        "event_nearby", F.col("event_distance").isNotNull().cast("int")
    )
