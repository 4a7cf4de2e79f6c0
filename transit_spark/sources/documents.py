"""Landed JSON documents of the route and weather services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_spark.functions.text import direction_name, variant_key
from transit_spark.schemas import PATH_DOC, STOP_DOC, VARIANT_DOC, WEATHER_DOC

EMPTY_BODIES = ("", "null", "[]", "{}")


def usable(body: str, status: str = "status") -> Column:
    return (F.col(status) == 200) & ~F.trim(F.coalesce(F.col(body), F.lit(""))).isin(*EMPTY_BODIES)


def usable_documents(df: DataFrame, body: str = "stops_json", status: str = "status") -> DataFrame:
    """Answered requests with a body worth parsing."""
    return df.where(usable(body, status))


def split_usable(df: DataFrame, body: str = "stops_json", status: str = "status") -> DataFrame:
    """Number of documents with and without data."""
    label = F.when(F.coalesce(usable(body, status), F.lit(False)), "have_data").otherwise("no_data")
    return df.groupBy(label.alias("outcome")).agg(F.count(F.lit(1)).alias("documents"))


def flatten_route_variants(df: DataFrame) -> DataFrame:
    """One row per variant of each (route, direction); absent names become ''."""
    variant = F.explode(F.from_json("vars_json", VARIANT_DOC)).alias("v")
    return df.select("route_id", "direction", variant).select(
        "route_id",
        direction_name("direction").alias("direction_name"),
        F.col("v.RouteVarId").alias("variant_id"),
        F.coalesce(F.col("v.RouteVarName"), F.lit("")).alias("variant_name"),
        F.coalesce(F.col("v.StartStop"), F.lit("")).alias("start_stop"),
        F.coalesce(F.col("v.EndStop"), F.lit("")).alias("end_stop"),
        F.col("v.Distance").alias("distance_m"),
        F.col("v.RunningTime").alias("running_minutes"),
    )


def flatten_route_stops(df: DataFrame) -> DataFrame:
    """One row per stop of each (route, direction, variant); exact repeats removed."""
    stop = F.explode(F.from_json("stops_json", STOP_DOC)).alias("s")
    return df.select("route_id", "direction", "variant_id", stop).select(
        "route_id", "direction", "variant_id",
        variant_key("direction", "variant_id").alias("variant_key"),
        F.col("s.Name").alias("stop_name"),
        F.col("s.Code").alias("stop_code"),
        F.col("s.Lat").alias("lat"),
        F.col("s.Lng").alias("lng"),
        F.concat(F.col("s.AddressNo"), F.lit(" "), F.col("s.Street")).alias("address"),
        F.col("s.Routes").alias("routes"),
        F.col("s.Status").alias("status"),
        F.col("s.StopType").alias("stop_type"),
    ).distinct()


def flatten_route_paths(df: DataFrame) -> DataFrame:
    """One row per path point with its position (from 0) and the number of points."""
    path = df.select("route_id", "direction", "variant_id", F.from_json("path_json", PATH_DOC).alias("p"))
    zipped = path.select(
        "route_id", "direction", "variant_id",
        F.size(F.col("p.lat")).alias("point_count"),
        F.posexplode(F.arrays_zip(F.col("p.lat").alias("lat"), F.col("p.lng").alias("lng"))).alias("position", "at"),
    )
    return zipped.select("route_id", "direction", "variant_id", "position", F.col("at.lat").alias("lat"), F.col("at.lng").alias("lng"), "point_count")


def route_documents(variants: DataFrame, stops: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per route: its variants, and per variant key ("outbound_12") the stops and the path.

    The inputs are the flat tables of this module. A variant without stops or path has an empty list; stops and
    paths of variants that are not listed are left out. Lists are sorted, so repeated runs give equal rows.
    """
    listed = variants.select("route_id", F.concat_ws("_", "direction_name", F.col("variant_id").cast("string")).alias("variant_key"), F.struct(*[c for c in variants.columns if c != "route_id"]).alias("variant"))
    at = ["route_id", "variant_key"]
    details = [c for c in stops.columns if c not in ("direction", "variant_id", *at)]
    per_stops = stops.groupBy(*at).agg(F.sort_array(F.collect_list(F.struct(*details))).alias("stops"))
    keyed = paths.withColumn("variant_key", variant_key("direction", "variant_id"))
    per_path = keyed.groupBy(*at).agg(F.sort_array(F.collect_list(F.struct("position", "lat", "lng"))).alias("path"))
    # Every list is as long as one variant's document was.
    whole = listed.join(per_stops, at, "left").join(per_path, at, "left")
    none = {c: F.array().cast(t.schema[c].dataType) for c, t in (("stops", per_stops), ("path", per_path))}
    return whole.groupBy("route_id").agg(
        F.sort_array(F.collect_list("variant")).alias("variants"),
        F.map_from_entries(F.array_distinct(F.sort_array(F.collect_list(F.struct("variant_key", F.coalesce("stops", none["stops"]).alias("stops")))))).alias("stops"),
        F.map_from_entries(F.array_distinct(F.sort_array(F.collect_list(F.struct("variant_key", F.coalesce("path", none["path"]).alias("path")))))).alias("paths"),
    )


def _conditions(w: Column) -> dict[str, Column]:
    first = F.get(w["weather"], F.lit(0))
    return {
        "temperature": w["main"]["temp"],
        "humidity": w["main"]["humidity"],
        "pressure": w["main"]["pressure"],
        "wind_speed": w["wind"]["speed"],
        "conditions": F.coalesce(first["main"], F.lit("")),
        "description": F.coalesce(first["description"], F.lit("")),
    }


def flatten_weather(df: DataFrame, doc: str = "doc", key: str = "id") -> DataFrame:
    """Current-weather documents; absent rain counts as 0."""
    w = F.col("w")
    cols = _conditions(w) | {
        "rain_1h": F.coalesce(w["rain"]["1h"], F.lit(0.0)),
        "rain_3h": F.coalesce(w["rain"]["3h"], F.lit(0.0)),
    }
    return df.select(key, F.from_json(doc, WEATHER_DOC).alias("w")).select(key, *[c.alias(n) for n, c in cols.items()])


def flatten_forecast(df: DataFrame, doc: str = "doc", key: str = "id") -> DataFrame:
    """Forecast documents: one row per entry of ``list``."""
    parsed = df.select(key, F.explode(F.from_json(doc, f"struct<list: array<{WEATHER_DOC}>>")["list"]).alias("w"))
    w = F.col("w")
    cols = {"time": w["dt_txt"].try_cast("timestamp_ntz")} | _conditions(w) | {
        "rain_3h": F.coalesce(w["rain"]["3h"], F.lit(0.0)),
        "clouds": F.coalesce(w["clouds"]["all"], F.lit(0.0)),
        "pop": F.coalesce(w["pop"], F.lit(0.0)),
    }
    return parsed.select(key, *[c.alias(n) for n, c in cols.items()])
