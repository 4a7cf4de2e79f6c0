"""Distance expressions and stop features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_spark.config import Center
from transit_spark.operators.series import with_neighbours

EARTH_RADIUS_KM = 6371


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in km."""
    lat1, lng1, lat2, lng2 = (F.radians(c) for c in (lat1, lng1, lat2, lng2))
    half_lat, half_lng = F.sin((lat2 - lat1) / 2), F.sin((lng2 - lng1) / 2)
    chord = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lng * half_lng
    return F.asin(F.sqrt(chord)) * 2 * EARTH_RADIUS_KM


def center_features(df: DataFrame, center: Center = Center()) -> DataFrame:
    lat, lng = F.col("latitude"), F.col("longitude")
    return df.withColumns(
        {
            "distance_from_center": haversine(lat, lng, F.lit(center.lat), F.lit(center.lng)),
            "is_north": F.coalesce(lat > center.lat, F.lit(False)).cast("int"),
            "is_east": F.coalesce(lng > center.lng, F.lit(False)).cast("int"),
        }
    )


def next_stop_distance(stops: DataFrame) -> DataFrame:
    """(route, stop, distance_to_next_stop); the last stop of a route has none."""
    here = stops.select("route", "stop", "stop_order", F.struct("latitude", "longitude").alias("at"))
    there = with_neighbours(
        here, ["route"], ["stop_order", "stop"], ["at"],
        block=F.floor(F.col("stop_order") / 1024), strict=True,
    )
    distance = haversine(
        F.col("at.latitude"), F.col("at.longitude"),
        F.col("_next_at.value.latitude"), F.col("_next_at.value.longitude"),
    )
    return there.select("route", "stop", distance.alias("distance_to_next_stop")).where(
        F.col("_next_at").isNotNull()
    )


def stop_features(df: DataFrame, stops: DataFrame, on=("stop",), distances: DataFrame | None = None) -> DataFrame:
    """Stop coordinates, order, progress along the route and distance to the next stop.

    Joining on the stop name alone fans out when two routes share a name; pass
    ``on=('route', 'stop')`` to avoid that. ``distances`` is a ready result of
    ``next_stop_distance``.
    """
    on = list(on)
    distances = next_stop_distance(stops) if distances is None else distances
    coords = stops.select(
        *on, F.col("latitude").alias("stop_lat"), F.col("longitude").alias("stop_lng"), "stop_order"
    )
    totals = stops.groupBy("route").agg(F.count("stop").alias("total_stops"))
    return (
        df.join(coords, on, "left")
        .join(totals, "route", "left")
        .withColumn("route_progress", F.try_divide(F.col("stop_order"), F.col("total_stops")))
        .join(distances, ["route", "stop"], "left")
    )
