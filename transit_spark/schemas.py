"""Declared schemas of the logical tables (nothing is inferred from files)."""

from __future__ import annotations

RAW = {
    "routes": ("route string, num_stops int, num_buses int"),
    "stops": ("route string, stop string, stop_order int, latitude double, longitude double"),
    "demand": (
        "route string, stop string, time timestamp_ntz, boarding_count int, alighting_count int, "
        "passengers int, hour int, day_of_week int, is_weekend int, is_peak_hour int"
    ),
    "gps": (
        "route string, bus_id string, time timestamp_ntz, latitude double, longitude double, "
        "speed double, heading double"
    ),
    "weather": (
        "time timestamp_ntz, temperature double, humidity double, rain_mm double, "
        "wind_speed double, conditions string"
    ),
    "events": (
        "event_id string, name string, event_type string, location string, latitude double, "
        "longitude double, start_time timestamp_ntz, end_time timestamp_ntz, "
        "expected_attendance int, impact_factor double"
    ),
}

STORED = {
    "routes": "route_id string, route_name string, num_stops int, num_buses int, created_at timestamp_ntz",
    "stops": (
        "stop_id string, route_id string, stop_name string, stop_order int, latitude double, longitude double, "
        "created_at timestamp_ntz"
    ),
    "passenger_demand": (
        "time timestamp_ntz, route_id string, stop_id string, boarding_count int, "
        "alighting_count int, passengers int, hour int, is_peak_hour int, is_weekend int, is_holiday int"
    ),
    "gps_traces": (
        "time timestamp_ntz, route_id string, bus_id string, latitude double, longitude double, "
        "speed double, heading double"
    ),
    "weather_data": (
        "time timestamp_ntz, temperature double, humidity double, rain_mm double, "
        "wind_speed double, conditions string"
    ),
    "events": (
        "event_id string, event_name string, event_type string, location string, latitude double, "
        "longitude double, start_time timestamp_ntz, end_time timestamp_ntz, "
        "expected_attendance int, impact_factor double"
    ),
    "processed_features": "time timestamp_ntz, route_id string, stop_id string, features string",
    "predictions": (
        "time timestamp_ntz, route_id string, stop_id string, predicted_demand int, "
        "confidence_lower double, confidence_upper double, model_version string, created_at timestamp_ntz"
    ),
}

# Time-series tables are laid out by day so that a time range prunes partitions.
TIME_PARTITIONED = ("passenger_demand", "gps_traces", "weather_data", "processed_features", "predictions")

STORED_KEYS = {
    "routes": ("route_id",),
    "stops": ("route_id", "stop_id"),
    "passenger_demand": ("time", "route_id", "stop_id"),
    "gps_traces": ("time", "bus_id"),
    "weather_data": ("time",),
    "events": ("event_id",),
    "processed_features": ("time", "route_id", "stop_id"),
    "predictions": ("time", "route_id", "stop_id"),
}

DATASET_TABLES = {
    "routes": "routes",
    "stops": "stops",
    "demand": "passenger_demand",
    "gps": "gps_traces",
    "weather": "weather_data",
    "events": "events",
}

STORED_NAMES = {"route": "route_id", "stop": "stop_id", "order": "stop_order", "name": "event_name"}

#: Written when a row is stored, unless it brings a value.
STAMPED = ("created_at",)

STOP_DOC = "array<struct<Name: string, Code: string, Lat: double, Lng: double, AddressNo: string, Street: string, Routes: string, Status: string, StopType: string>>"
VARIANT_DOC = (
    "array<struct<RouteId: string, RouteVarId: bigint, RouteVarName: string, Distance: double, "
    "RunningTime: double, StartStop: string, EndStop: string>>"
)
PATH_DOC = "struct<lat: array<double>, lng: array<double>>"
WEATHER_DOC = (
    "struct<dt_txt: string, main: struct<temp: double, humidity: double, pressure: double>, "
    "wind: struct<speed: double>, weather: array<struct<main: string, description: string>>, "
    "rain: struct<`1h`: double, `3h`: double>, clouds: struct<all: double>, pop: double>"
)
