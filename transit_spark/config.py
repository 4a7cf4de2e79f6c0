"""Fixed values shared by the operators (thresholds, calendars, defaults)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Validation thresholds.
MIN_SPEED_KMH, MAX_SPEED_KMH = 0, 80
MIN_PASSENGERS, MAX_PASSENGERS = 0, 200
MIN_TEMPERATURE_C, MAX_TEMPERATURE_C = 15, 45
MIN_HUMIDITY, MAX_HUMIDITY = 0, 100

# Public holidays.
HOLIDAYS = (
    "2025-01-01",
    "2025-01-28", "2025-01-29", "2025-01-30", "2025-01-31",
    "2025-02-01", "2025-02-02", "2025-02-03", "2025-02-04",
    "2025-04-30",
    "2025-05-01",
    "2025-09-02",
)
HOLIDAY_DATES = tuple(dt.date.fromisoformat(day) for day in HOLIDAYS)

# Columns a scaler never picks up by itself.
NEVER_AUTO_SCALED = ("time", "year", "month", "day", "hour", "minute")

DEMAND_COUNTS = ("boarding_count", "alighting_count", "passengers")
DEMAND_KEYS = ("route", "stop", "time")
GPS_KEYS = ("route", "bus_id", "time")
GPS_NUMERIC = ("latitude", "longitude", "speed", "heading")
WEATHER_NUMERIC = ("temperature", "humidity", "rain_mm", "wind_speed")


@dataclass(frozen=True)
class Box:
    """Latitude/longitude bounds, inclusive."""

    lat_lo: float = 10.0
    lat_hi: float = 11.5
    lng_lo: float = 106.0
    lng_hi: float = 107.5


@dataclass(frozen=True)
class Center:
    """City centre used for distance and quadrant features."""

    lat: float = 10.7769
    lng: float = 106.7009


@dataclass(frozen=True)
class ForecastDefaults:
    """Defaults of the forecasting operators."""

    sequence_length: int = 12
    horizon: int = 2
    step: int = 1
    train: float = 0.70
    val: float = 0.15
    confidence: float = 0.95
    ensemble: int = 3
    target_mape: float = 15.0
    future_steps: int = 48


FEATURE_LAGS = (1, 2, 3, 6, 12)
FEATURE_WINDOWS = (3, 6, 12)

# Feature groups used to prepare a series for forecasting.
TEMPORAL_FEATURES = (
    "hour", "day_of_week", "is_weekend", "is_peak_hour",
    "is_morning_peak", "is_evening_peak", "hour_sin", "hour_cos",
    "dow_sin", "dow_cos", "rush_hour_intensity", "is_holiday",
)
SPATIAL_FEATURES = ("stop_order", "route_progress", "distance_to_next_stop")
CONTEXTUAL_FEATURES = (
    "temperature", "humidity", "is_raining", "heat_index",
    "nearby_events", "event_impact_factor", "is_commute_time",
)
FORECAST_FEATURES = TEMPORAL_FEATURES + SPATIAL_FEATURES + CONTEXTUAL_FEATURES
TARGET = "passengers"


@dataclass(frozen=True)
class ServiceDefaults:
    """Defaults of the schedule operators."""

    capacity: int = 50
    max_wait: int = 30
    slot_minutes: int = 15
    first_hour: int = 6
    last_hour: int = 18
    trip_minutes: int = 45
    fleet: int = 100

    @property
    def last_slot(self) -> int:
        return (self.last_hour - self.first_hour) * 60 // self.slot_minutes
