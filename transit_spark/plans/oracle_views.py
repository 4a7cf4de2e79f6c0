"""Shared parts of the reference SQL: named views, pulled into a query as CTEs when it names them."""

from __future__ import annotations

import re

from transit_spark.config import HOLIDAYS
from transit_spark.plans.fixtures import VIEWS, duck_view

HOLIDAYS_SQL = ", ".join(f"'{day}'" for day in HOLIDAYS)


def hav(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    """Haversine km in SQL."""
    return (
        f"(2*6371*asin(sqrt(pow(sin(radians({lat2}-{lat1})/2),2)"
        f"+cos(radians({lat1}))*cos(radians({lat2}))*pow(sin(radians({lng2}-{lng1})/2),2))))"
    )


LIB: dict[str, str] = {f"v_{name}": duck_view(name) for name in VIEWS}

LIB["v_demand_dedup"] = """
    SELECT * FROM v_demand_raw QUALIFY row_number() OVER (PARTITION BY route, stop, time ORDER BY seq) = 1"""
LIB["v_demand_valid"] = """
    SELECT seq, route, stop, time,
      CASE WHEN boarding_count < 0 THEN 0 ELSE boarding_count END AS boarding_count,
      CASE WHEN alighting_count < 0 THEN 0 ELSE alighting_count END AS alighting_count,
      CASE WHEN passengers < 0 THEN 0 ELSE passengers END AS passengers
    FROM v_demand_dedup
    WHERE coalesce(boarding_count <= 200, true) AND coalesce(alighting_count <= 200, true) AND coalesce(passengers <= 200, true)"""
LIB["v_demand_filled"] = """
    SELECT seq, route, stop, time,
      last_value(boarding_count IGNORE NULLS) OVER w AS boarding_count,
      last_value(alighting_count IGNORE NULLS) OVER w AS alighting_count,
      last_value(passengers IGNORE NULLS) OVER w AS passengers
    FROM v_demand_valid
    WINDOW w AS (PARTITION BY route, stop ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
LIB["v_demand"] = """
    SELECT * FROM v_demand_filled
    WHERE boarding_count IS NOT NULL AND alighting_count IS NOT NULL AND passengers IS NOT NULL"""
LIB["v_gps_dedup"] = """
    SELECT * FROM v_gps_raw QUALIFY row_number() OVER (PARTITION BY route, bus_id, time ORDER BY seq) = 1"""
LIB["v_gps_valid"] = """
    SELECT seq, route, bus_id, time, latitude, longitude,
      CASE WHEN speed < 0 THEN 0 WHEN speed > 80 THEN 80 ELSE speed END AS speed, heading
    FROM v_gps_dedup WHERE latitude BETWEEN 10.0 AND 11.5 AND longitude BETWEEN 106.0 AND 107.5"""
LIB["v_gps_gaps"] = """
    SELECT *, last_value(CASE WHEN speed IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS prev_rn,
      last_value(speed IGNORE NULLS) OVER b AS prev_speed,
      first_value(CASE WHEN speed IS NOT NULL THEN rn END IGNORE NULLS) OVER a AS next_rn,
      first_value(speed IGNORE NULLS) OVER a AS next_speed
    FROM (SELECT *, row_number() OVER (PARTITION BY route, bus_id ORDER BY time) AS rn FROM v_gps_valid)
    WINDOW b AS (PARTITION BY route, bus_id ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           a AS (PARTITION BY route, bus_id ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
LIB["v_gps_filled"] = """
    SELECT seq, route, bus_id, time, latitude, longitude,
      CASE WHEN speed IS NOT NULL THEN speed
           WHEN prev_rn IS NULL OR rn - prev_rn > 3 THEN NULL
           WHEN next_rn IS NULL THEN prev_speed
           ELSE prev_speed + (next_speed - prev_speed) * (rn - prev_rn) / (next_rn - prev_rn) END AS speed, heading
    FROM v_gps_gaps"""
LIB["v_gps"] = "SELECT * FROM v_gps_filled WHERE speed IS NOT NULL"
LIB["v_weather_dedup"] = "SELECT * FROM v_weather_raw QUALIFY row_number() OVER (PARTITION BY time ORDER BY seq) = 1"
LIB["v_weather_temp"] = "SELECT * FROM v_weather_dedup WHERE coalesce(temperature BETWEEN 15 AND 45, true)"
LIB["v_weather_valid"] = """
    SELECT seq, time, temperature,
      CASE WHEN humidity BETWEEN 0 AND 100 THEN humidity
           ELSE (SELECT median(humidity) FROM v_weather_temp WHERE humidity BETWEEN 0 AND 100) END AS humidity,
      rain_mm, wind_speed, conditions FROM v_weather_temp"""
LIB["v_weather_gaps"] = """
    SELECT *, last_value(CASE WHEN temperature IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS prev_rn,
      last_value(temperature IGNORE NULLS) OVER b AS prev_t,
      first_value(CASE WHEN temperature IS NOT NULL THEN rn END IGNORE NULLS) OVER a AS next_rn,
      first_value(temperature IGNORE NULLS) OVER a AS next_t,
      coalesce(last_value(conditions IGNORE NULLS) OVER b, first_value(conditions IGNORE NULLS) OVER a) AS cond
    FROM (SELECT *, row_number() OVER (ORDER BY time) AS rn FROM v_weather_valid)
    WINDOW b AS (ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           a AS (ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
LIB["v_weather"] = """
    SELECT seq, time,
      CASE WHEN temperature IS NOT NULL THEN temperature WHEN prev_rn IS NULL THEN next_t WHEN next_rn IS NULL THEN prev_t
           ELSE prev_t + (next_t - prev_t) * (rn - prev_rn) / (next_rn - prev_rn) END AS temperature,
      humidity, rain_mm, wind_speed, cond AS conditions FROM v_weather_gaps"""
LIB["v_city_dedup"] = "SELECT * FROM v_city_raw QUALIFY row_number() OVER (PARTITION BY name, start_time ORDER BY event_id) = 1"
LIB["v_city"] = """
    SELECT * FROM v_city_dedup WHERE end_time > start_time
      AND latitude BETWEEN 10.0 AND 11.5 AND longitude BETWEEN 106.0 AND 107.5"""

LIB["v_temporal"] = f"""
    SELECT *, CAST((day_of_week >= 5) AS INT) AS is_weekend, CAST(hour IN (7,8,16,17) AS INT) AS is_peak_hour,
      CAST(hour IN (7,8) AS INT) AS is_morning_peak, CAST(hour IN (16,17) AS INT) AS is_evening_peak,
      CASE WHEN hour <= 6 THEN 'night' WHEN hour <= 12 THEN 'morning' WHEN hour <= 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day,
      sin(2*pi()*hour/24) AS hour_sin, cos(2*pi()*hour/24) AS hour_cos,
      sin(2*pi()*day_of_week/7) AS dow_sin, cos(2*pi()*day_of_week/7) AS dow_cos,
      CAST(hour*60 + minute(time) AS INT) AS time_since_midnight,
      CAST(strftime(time, '%Y-%m-%d') IN ({HOLIDAYS_SQL}) AS INT) AS is_holiday,
      CAST(CASE WHEN day_of_week >= 5 THEN 0.3 ELSE 1.0 END AS DOUBLE) * CAST(CASE WHEN hour IN (8,17) THEN 1.0
        WHEN hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 18 THEN 0.8 WHEN hour IN (6,15) THEN 0.5 ELSE 0.2 END AS DOUBLE) AS rush_hour_intensity
    FROM (SELECT *, CAST(hour(time) AS INT) AS hour, CAST(isodow(time) - 1 AS INT) AS day_of_week, CAST(day(time) AS INT) AS day_of_month,
            CAST(month(time) AS INT) AS month, CAST(week(time) AS INT) AS week_of_year, CAST(quarter(time) AS INT) AS quarter FROM v_demand)"""
LIB["v_next_stop"] = f"""
    SELECT route, stop, {hav('latitude', 'longitude', 'nlat', 'nlng')} AS distance_to_next_stop FROM (
      SELECT *, lead(latitude) OVER w AS nlat, lead(longitude) OVER w AS nlng FROM v_stops
      WINDOW w AS (PARTITION BY route ORDER BY stop_order, stop)) WHERE nlat IS NOT NULL"""
LIB["v_spatial"] = """
    SELECT d.*, s.latitude AS stop_lat, s.longitude AS stop_lng, s.stop_order, n.total_stops,
      s.stop_order / n.total_stops AS route_progress, x.distance_to_next_stop
    FROM v_temporal d LEFT JOIN v_stops s USING (stop)
    LEFT JOIN (SELECT route, count(stop) AS total_stops FROM v_stops GROUP BY route) n ON n.route = d.route
    LEFT JOIN v_next_stop x ON x.route = d.route AND x.stop = d.stop"""
LIB["v_active"] = """
    SELECT t.time, count(*) AS n, max(e.impact_factor) AS impact
    FROM (SELECT DISTINCT time FROM v_demand) t JOIN v_city e ON e.start_time <= t.time AND e.end_time >= t.time GROUP BY t.time"""
LIB["v_context"] = """
    SELECT d.*, w.temperature, w.humidity, w.rain_mm, w.wind_speed, w.conditions,
      CAST(coalesce(w.rain_mm > 0, false) AS INT) AS is_raining,
      CASE WHEN w.rain_mm > -0.1 AND w.rain_mm <= 0 THEN 'none' WHEN w.rain_mm > 0 AND w.rain_mm <= 1 THEN 'light'
           WHEN w.rain_mm > 1 AND w.rain_mm <= 5 THEN 'moderate' WHEN w.rain_mm > 5 AND w.rain_mm <= 100 THEN 'heavy' END AS rain_intensity,
      CASE WHEN w.temperature > 0 AND w.temperature <= 25 THEN 'cool' WHEN w.temperature > 25 AND w.temperature <= 30 THEN 'comfortable'
           WHEN w.temperature > 30 AND w.temperature <= 35 THEN 'hot' WHEN w.temperature > 35 AND w.temperature <= 50 THEN 'very_hot' END AS temp_category,
      w.temperature * (1 + w.humidity / 200) AS heat_index,
      CAST(coalesce(a.n, 0) AS INT) AS nearby_events, coalesce(a.impact, 1.0) AS event_impact_factor,
      CAST((hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 18) AND is_weekend = 0 AS INT) AS is_commute_time
    FROM v_spatial d LEFT JOIN v_weather w ON time_bucket(INTERVAL '15 minutes', w.time) = time_bucket(INTERVAL '15 minutes', d.time)
    LEFT JOIN v_active a ON a.time = d.time"""
LIB["v_forecast"] = """
    SELECT route, stop, time, seq, CAST(passengers AS DOUBLE) AS actual,
      CAST(lag(passengers) OVER (PARTITION BY route, stop ORDER BY time) AS DOUBLE) AS predicted FROM v_demand"""
LIB["v_errors"] = """
    SELECT *, actual - predicted AS error, abs(actual - predicted) AS abs_error,
      abs((actual - predicted) / (actual + 1e-10)) * 100 AS pct_error
    FROM v_forecast WHERE actual IS NOT NULL AND predicted IS NOT NULL"""
LIB["v_totals"] = "SELECT route, time, CAST(sum(passengers) AS BIGINT) AS total_demand FROM v_demand GROUP BY route, time"
LIB["v_slot_input"] = "SELECT route, time, CAST(floor(sum(passengers)/4) AS INT) AS predicted_demand FROM v_demand GROUP BY route, time"
LIB["v_slots"] = """
    SELECT g.route, g.day, CAST(g.slot AS INT) AS slot, CAST(g.day AS TIMESTAMP) + to_minutes(CAST(360 + g.slot*15 AS INT)) AS time,
      CAST(coalesce(t.demand, 0) AS BIGINT) AS demand
    FROM (SELECT r.route, r.day, s.slot FROM (SELECT DISTINCT route, day FROM v_slot_used) r, (SELECT unnest(range(0, 49)) AS slot) s) g
    LEFT JOIN (SELECT route, day, slot, sum(predicted_demand) AS demand FROM v_slot_used GROUP BY ALL) t
      ON t.route = g.route AND t.day = g.day AND t.slot = g.slot"""
LIB["v_slot_used"] = """
    SELECT route, CAST(time AS DATE) AS day, CAST(floor((hour(time)*60 + minute(time) - 360) / 15) AS INT) AS slot, predicted_demand
    FROM v_slot_input WHERE floor((hour(time)*60 + minute(time) - 360) / 15) BETWEEN 0 AND 48"""
# Demand seen by a bus leaving at a slot: its own slot and the next two (30 minutes).
LIB["v_seen"] = """
    SELECT route, day, slot, time, greatest(demand, 0) AS d0,
      coalesce(greatest(lead(demand, 1) OVER w, 0), 0) AS d1, coalesce(greatest(lead(demand, 2) OVER w, 0), 0) AS d2
    FROM v_slots WINDOW w AS (PARTITION BY route, day ORDER BY slot)"""
LIB["v_loads"] = """
    SELECT *, t0 + t1 + t2 AS served, t1*15 + t2*30 AS wait_minutes FROM (
      SELECT *, least(d0, 50) AS t0, least(d0 + d1, 50) - least(d0, 50) AS t1,
        least(d0 + d1 + d2, 50) - least(d0 + d1, 50) AS t2 FROM v_seen)"""
LIB["v_final_loads"] = """
    SELECT *, a0 + a1 + a2 AS served_passengers, a1*15 + a2*30 AS wait_minutes FROM (
      SELECT *, t0 AS a0, CASE WHEN t0 > 0 THEN t1 ELSE 0 END AS a1,
        CASE WHEN t0 > 0 AND t1 > 0 THEN t2 ELSE 0 END AS a2 FROM (
          SELECT route, day, slot, time, t0, t1, t2 FROM v_loads))"""
LIB["v_candidates"] = """
    SELECT r.route, k.candidate, t.slot FROM (SELECT DISTINCT route FROM v_demand) r,
      (SELECT unnest([1,2,3,4]) AS candidate) k, (SELECT unnest(range(0, 49)) AS slot) t WHERE t.slot % k.candidate = 0"""
LIB["v_candidate_scores"] = """
    SELECT *, wait_sum / served_sum AS avg_wait, served_sum / (trips * 50) AS load_factor,
      served_sum / (trips * 50) * 100 - wait_sum / served_sum AS score FROM (
      SELECT route, day, candidate, count(*) AS trips, sum(served) AS served_sum, sum(wait_minutes) AS wait_sum
      FROM v_candidates JOIN v_loads USING (route, slot) GROUP BY ALL) WHERE served_sum > 0"""
LIB["v_hourly"] = "SELECT route, sum(passengers) / 24.0 AS demand FROM v_demand GROUP BY route"
LIB["v_grid"] = """
    SELECT *, CASE WHEN utilisation < 0.7::DOUBLE THEN (0.7::DOUBLE - utilisation) * demand WHEN utilisation > 0.9::DOUBLE THEN 2 * (utilisation - 0.9::DOUBLE) * demand ELSE 0 END AS penalty
    FROM (SELECT route, CAST(demand AS DOUBLE) AS demand, CAST(h AS INT) AS headway, 60.0::DOUBLE / h AS trips_per_hour,
            demand / (60.0::DOUBLE / h * 50) AS utilisation, CAST(ceil(120.0 / h) AS INT) AS vehicles
          FROM v_hourly, (SELECT unnest(range(5, 61)) AS h))"""
LIB["v_best_headway"] = """
    SELECT route, demand, headway, trips_per_hour, utilisation, vehicles, headway / 2 * demand * 0.7 + penalty * 0.3 AS cost
    FROM v_grid QUALIFY row_number() OVER (PARTITION BY route ORDER BY headway / 2 * demand * 0.7 + penalty * 0.3, headway) = 1"""
LIB["v_prep"] = """
    SELECT *, CASE WHEN rn <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN rn <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM (
      SELECT seq, passengers, coalesce(last_value(rain_mm IGNORE NULLS) OVER b, first_value(rain_mm IGNORE NULLS) OVER a) AS rain_mm,
        row_number() OVER b AS rn, count(*) OVER (PARTITION BY route, stop) AS n
      FROM (SELECT d.*, w.rain_mm FROM v_demand d LEFT JOIN v_weather w USING (time))
      WINDOW b AS (PARTITION BY route, stop ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             a AS (PARTITION BY route, stop ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""



def derive(prefix: str, views, changes: dict[str, str]) -> None:
    """The named views again under ``v_<prefix>_...``, built on one another, with some of their text changed."""
    for name in views:
        text = LIB[f"v_{name}"]
        for old, new in changes.items():
            text = text.replace(old, new)
        LIB[f"v_{prefix}_{name}"] = re.sub(rf"\bv_({'|'.join(views)})\b", rf"v_{prefix}_\1", text)


# Tables read from files have no sequence: of rows with one key the one with the least values counts.
derive("f", ("demand_dedup", "demand_valid", "demand_filled", "demand"), {"ORDER BY seq": "ORDER BY boarding_count NULLS FIRST, alighting_count NULLS FIRST, passengers NULLS FIRST"})
derive("f", ("gps_dedup", "gps_valid", "gps_gaps", "gps_filled", "gps"), {"ORDER BY seq": "ORDER BY latitude NULLS FIRST, longitude NULLS FIRST, speed NULLS FIRST, heading NULLS FIRST"})
derive("f", ("weather_dedup", "weather_temp"), {"ORDER BY seq": "ORDER BY temperature NULLS FIRST, humidity NULLS FIRST, rain_mm NULLS FIRST, wind_speed NULLS FIRST, conditions NULLS FIRST"})
derive("f", ("city_dedup", "city"), {"ORDER BY event_id": "ORDER BY CAST(event_id AS VARCHAR)"})

# A day planned from the line of each route: the forecast is the recursion x -> a + b * x.
LIB["v_lines"] = """
    SELECT route, regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM (
      SELECT route, CAST(total_demand AS DOUBLE) AS x, CAST(lead(total_demand) OVER (PARTITION BY route ORDER BY time) AS DOUBLE) AS y FROM v_totals)
    WHERE y IS NOT NULL GROUP BY route"""
LIB["v_p_slot_input"] = """
    SELECT route, time, CAST(trunc(p) AS INT) AS predicted_demand FROM (
      WITH RECURSIVE f AS (
        SELECT route, 0 AS step, max(time) AS time, CAST(arg_max(total_demand, time) AS DOUBLE) AS p FROM v_totals GROUP BY route
        UNION ALL SELECT f.route, f.step + 1, f.time + INTERVAL 15 MINUTE, a + b * p FROM f JOIN v_lines m ON m.route = f.route WHERE f.step < 96)
      SELECT * FROM f WHERE step > 0)"""
derive("p", ("slot_used", "slots", "seen", "loads", "final_loads", "candidate_scores"), {"v_slot_input": "v_p_slot_input"})
LIB["v_p_trips"] = """
    SELECT l.route, l.day, l.slot, b.candidate, l.served_passengers, l.wait_minutes FROM (
      SELECT route, day, candidate FROM v_p_candidate_scores QUALIFY row_number() OVER (PARTITION BY route, day ORDER BY score DESC, candidate) = 1) b
    JOIN v_p_final_loads l ON l.route = b.route AND l.day = b.day AND l.slot % b.candidate = 0"""

NAMES = re.compile(r"\bv_[a-z_]+\b")


def with_views(sql: str) -> str:
    """Prefixes the query with the views it needs, each after the views it is built on."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in NAMES.findall(text):
            if name in LIB and name not in order:
                need(LIB[name])
                if name not in order:
                    order.append(name)

    need(sql)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({LIB[name].strip()})" for name in order)
    body = sql.strip()
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
