"""Registered queries: cleaning, time and text scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from transit_spark import config as C
from transit_spark.functions import temporal as tm
from transit_spark.functions import text as tx
from transit_spark.operators import cleaning as cl
from transit_spark.operators import series as sr
from transit_spark.plans.oracle_views import HOLIDAYS_SQL
from transit_spark.plans.registry import check, rounded

DEMAND = ["seq", "route", "stop", "time", "boarding_count", "alighting_count", "passengers"]
DEMAND_SQL = ", ".join(DEMAND)
GPS_SQL = "seq, route, bus_id, time, round(latitude,6) AS latitude, round(longitude,6) AS longitude, round(speed,6) AS speed, heading"


@check("C1_to_time", "SELECT seq, route, TRY_CAST(time_text AS TIMESTAMP) AS time FROM v_demand_text")
def c1(fx):
    df = fx.view("demand_text").withColumnRenamed("time_text", "time")
    return tm.to_time(df, ["time"]).select("seq", "route", "time")


@check("C2_dedupe_first", f"SELECT {DEMAND_SQL} FROM v_demand_dedup")
def c2(fx):
    return cl.dedupe_first(fx.demand_raw, C.DEMAND_KEYS, ["seq"])


@check(
    "C3_clamp_negative",
    """SELECT seq, route, stop, time, CASE WHEN boarding_count < 0 THEN 0 ELSE boarding_count END AS boarding_count,
    CASE WHEN alighting_count < 0 THEN 0 ELSE alighting_count END AS alighting_count,
    CASE WHEN passengers < 0 THEN 0 ELSE passengers END AS passengers FROM v_demand_raw""",
)
def c3(fx):
    return cl.clamp_negative(fx.demand_raw)


@check(
    "C4_drop_above",
    f"""SELECT {DEMAND_SQL} FROM v_demand_raw WHERE coalesce(boarding_count <= 200, true)
    AND coalesce(alighting_count <= 200, true) AND coalesce(passengers <= 200, true)""",
)
def c4(fx):
    return cl.drop_above(fx.demand_raw)


@check("C5_in_bounds", f"SELECT {GPS_SQL} FROM v_gps_raw WHERE latitude BETWEEN 10.0 AND 11.5 AND longitude BETWEEN 106.0 AND 107.5")
def c5(fx):
    return rounded(cl.in_bounds(fx.gps_raw))


@check("C6_clip", "SELECT seq, round(CASE WHEN speed < 0 THEN 0 WHEN speed > 80 THEN 80 ELSE speed END, 6) AS speed FROM v_gps_raw")
def c6(fx):
    return rounded(cl.clip(fx.gps_raw, "speed", 0.0, 80.0).select("seq", "speed"))


@check("C7_drop_outside", "SELECT seq, time, round(temperature,6) AS temperature FROM v_weather_raw WHERE coalesce(temperature BETWEEN 15 AND 45, true)")
def c7(fx):
    return rounded(cl.drop_outside(fx.weather_raw, "temperature", 15, 45).select("seq", "time", "temperature"))


@check("C8_impute_median", "SELECT seq, time, round(humidity,6) AS humidity FROM v_weather_valid")
def c8(fx):
    dedup = cl.dedupe_first(fx.weather_raw, ["time"], ["seq"])
    valid = cl.drop_outside(dedup, "temperature", 15, 45)
    return rounded(cl.impute_median(valid, "humidity", 0, 100).select("seq", "time", "humidity"))


@check("C9_ffill", f"SELECT {DEMAND_SQL} FROM v_demand_filled")
def c9(fx):
    valid = cl.drop_above(cl.clamp_negative(cl.dedupe_first(fx.demand_raw, C.DEMAND_KEYS, ["seq"])))
    return sr.ffill(valid, ["route", "stop"], ["time"], list(C.DEMAND_COUNTS))


@check("C10_interpolate", f"SELECT {GPS_SQL} FROM v_gps_filled")
def c10(fx):
    valid = cl.clip(cl.in_bounds(cl.dedupe_first(fx.gps_raw, C.GPS_KEYS, ["seq"])), "speed", 0.0, 80.0)
    return rounded(sr.interpolate(valid, ["route", "bus_id"], ["time"], list(C.GPS_NUMERIC), limit=3))


@check("C11_interpolate_global", "SELECT time, round(temperature,6) AS temperature, conditions FROM v_weather")
def c11(fx):
    dedup = cl.drop_outside(cl.dedupe_first(fx.weather_raw, ["time"], ["seq"]), "temperature", 15, 45)
    filled = sr.interpolate_and_fill(dedup, [], ["time"], ["temperature"], ["conditions"])
    return rounded(filled.select("time", "temperature", "conditions"))


@check("C12_require", "SELECT seq, time, conditions FROM v_weather_raw WHERE conditions IS NOT NULL AND temperature IS NOT NULL")
def c12(fx):
    return cl.require(fx.weather_raw, ["conditions", "temperature"]).select("seq", "time", "conditions")


@check("C13_valid_intervals", "SELECT event_id, name, start_time, end_time FROM v_city_raw WHERE end_time > start_time")
def c13(fx):
    return cl.valid_intervals(fx.city_raw).select("event_id", "name", "start_time", "end_time")


@check("C14_clean_demand", f"SELECT {DEMAND_SQL} FROM v_demand")
def c14(fx):
    return fx.demand


@check("C15_clean_gps", f"SELECT {GPS_SQL} FROM v_gps")
def c15(fx):
    return rounded(fx.gps)


@check(
    "C16_clean_weather",
    """SELECT seq, time, round(temperature,6) AS temperature, round(humidity,6) AS humidity, rain_mm, wind_speed, conditions FROM v_weather""",
)
def c16(fx):
    return rounded(fx.weather)


@check(
    "C17_clean_events",
    """SELECT event_id, name, event_type, round(latitude,6) AS latitude, round(longitude,6) AS longitude, start_time, end_time,
    expected_attendance, round(impact_factor,6) AS impact_factor FROM v_city""",
)
def c17(fx):
    return rounded(fx.city)


@check(
    "C18_cleaning_report",
    """SELECT 'demand' AS "table", (SELECT count(*) FROM v_demand_raw) AS initial_records, (SELECT count(*) FROM v_demand) AS final_records,
      (SELECT count(*) FROM v_demand_raw) - (SELECT count(*) FROM v_demand_dedup) AS duplicates_removed,
      (SELECT count(*) FROM v_demand_raw) - (SELECT count(*) FROM v_demand) AS records_dropped
    UNION ALL SELECT 'gps', (SELECT count(*) FROM v_gps_raw), (SELECT count(*) FROM v_gps),
      (SELECT count(*) FROM v_gps_raw) - (SELECT count(*) FROM v_gps_dedup), (SELECT count(*) FROM v_gps_raw) - (SELECT count(*) FROM v_gps)
    UNION ALL SELECT 'weather', (SELECT count(*) FROM v_weather_raw), (SELECT count(*) FROM v_weather),
      (SELECT count(*) FROM v_weather_raw) - (SELECT count(*) FROM v_weather_dedup), (SELECT count(*) FROM v_weather_raw) - (SELECT count(*) FROM v_weather)
    UNION ALL SELECT 'events', (SELECT count(*) FROM v_city_raw), (SELECT count(*) FROM v_city),
      (SELECT count(*) FROM v_city_raw) - (SELECT count(*) FROM v_city_dedup), (SELECT count(*) FROM v_city_raw) - (SELECT count(*) FROM v_city)""",
)
def c18(fx):
    return (
        cl.cleaning_report(fx.demand_raw, fx.demand, C.DEMAND_KEYS, "demand")
        .unionByName(cl.cleaning_report(fx.gps_raw, fx.gps, C.GPS_KEYS, "gps"))
        .unionByName(cl.cleaning_report(fx.weather_raw, fx.weather, ["time"], "weather"))
        .unionByName(cl.cleaning_report(fx.city_raw, fx.city, ["name", "start_time"], "events"))
    )


@check(
    "C19_drop_outliers_zscore",
    """SELECT event_id, event_type, value FROM events JOIN (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1)
    USING (event_type) WHERE abs((value - m) / s) <= 3""",
)
def c19z(fx):
    return cl.drop_outliers(fx.events.select("event_id", "event_type", "value"), "value", "zscore", ["event_type"])


@check(
    "C19_drop_outliers_iqr",
    """SELECT event_id, event_type, value FROM events JOIN (SELECT event_type, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b
    FROM events GROUP BY 1) USING (event_type) WHERE value BETWEEN a - 1.5*(b-a) AND b + 1.5*(b-a)""",
)
def c19i(fx):
    return cl.drop_outliers(fx.events.select("event_id", "event_type", "value"), "value", "iqr", ["event_type"])


@check(
    "C20_impute_mode",
    """SELECT seq, coalesce(conditions, (SELECT conditions FROM v_weather_raw WHERE conditions IS NOT NULL GROUP BY 1
    ORDER BY count(*) DESC, conditions LIMIT 1)) AS conditions FROM v_weather_raw""",
)
def c20(fx):
    return cl.impute_mode(fx.weather_raw.select("seq", "conditions"), "conditions")


@check("C21_align_time", "SELECT event_id, time_bucket(INTERVAL '5 minutes', ts + INTERVAL 7 HOUR) AS time FROM events")
def c21(fx):
    return tm.align_time(fx.events.select("event_id", F.col("ts").alias("time")))


@check(
    "C22_quality_report",
    """SELECT 'temperature' AS "column", count(*) AS rows, count(*) - count(temperature) AS missing, round(avg(temperature),6) AS mean,
      round(stddev_samp(temperature),6) AS std, min(temperature) AS min, max(temperature) AS max,
      count(*) FILTER (WHERE time > TIMESTAMP '2024-01-20 00:00:00') AS future_rows FROM v_weather_raw
    UNION ALL SELECT 'humidity', count(*), count(*) - count(humidity), round(avg(humidity),6), round(stddev_samp(humidity),6),
      min(humidity), max(humidity), count(*) FILTER (WHERE time > TIMESTAMP '2024-01-20 00:00:00') FROM v_weather_raw""",
)
def c22(fx):
    return rounded(cl.quality_report(fx.weather_raw, "2024-01-20 00:00:00", ["temperature", "humidity"]))


def _temporal(fx, *cols):
    return rounded(tm.temporal_features(fx.demand).select("seq", *cols))


def _temporal_sql(*cols):
    return "SELECT seq, " + ", ".join(cols) + " FROM v_temporal"


@check("T1_calendar", _temporal_sql("hour", "day_of_week", "day_of_month", "month", "week_of_year", "quarter"))
def t1(fx):
    return _temporal(fx, "hour", "day_of_week", "day_of_month", "month", "week_of_year", "quarter")


@check("T2_is_weekend", _temporal_sql("is_weekend"))
def t2(fx):
    return _temporal(fx, "is_weekend")


@check("T3_peak_flags", _temporal_sql("is_peak_hour", "is_morning_peak", "is_evening_peak"))
def t3(fx):
    return _temporal(fx, "is_peak_hour", "is_morning_peak", "is_evening_peak")


@check("T4_time_of_day", _temporal_sql("time_of_day"))
def t4(fx):
    return _temporal(fx, "time_of_day")


@check("T5_cyclic", _temporal_sql(*[f"round({c},6) + 0.0 AS {c}" for c in ("hour_sin", "hour_cos", "dow_sin", "dow_cos")]))
def t5(fx):
    return _temporal(fx, "hour_sin", "hour_cos", "dow_sin", "dow_cos")


@check("T6_time_since_midnight", _temporal_sql("time_since_midnight"))
def t6(fx):
    return _temporal(fx, "time_since_midnight")


@check(
    "T7_is_holiday",
    f"""SELECT o_orderkey, t AS time, CAST(strftime(t, '%Y-%m-%d') IN ({HOLIDAYS_SQL}) AS INT) AS is_holiday
    FROM (SELECT o_orderkey, o_orderdate + INTERVAL 27 YEAR AS t FROM orders)""",
)
def t7(fx):
    moved = fx.table("orders").select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 27 YEAR")).alias("time"))
    return tm.temporal_features(moved).select("o_orderkey", "time", "is_holiday")


@check("T8_rush_hour_intensity", _temporal_sql("round(rush_hour_intensity,6) AS rush_hour_intensity"))
def t8(fx):
    return _temporal(fx, "rush_hour_intensity")


@check("T9_floor_time", "SELECT event_id, time_bucket(INTERVAL '15 minutes', ts) AS slot FROM events")
def t9(fx):
    return fx.events.select("event_id", tm.floor_time("ts", 15).alias("slot"))


@check("T10_hhmm", "SELECT event_id, strftime(ts, '%H:%M') AS time_str FROM events")
def t10(fx):
    return fx.events.select("event_id", tm.hhmm("ts").alias("time_str"))


@check(
    "T11_time_spine",
    """SELECT s.route, s.stop, s.time, CAST(coalesce(sum(d.passengers), 0) AS BIGINT) AS passengers
    FROM (SELECT k.route, k.stop, t.time FROM (SELECT DISTINCT route, stop FROM v_demand) k,
      (SELECT unnest(generate_series((SELECT min(time) FROM v_demand), (SELECT max(time) FROM v_demand), INTERVAL 15 MINUTE)) AS time) t) s
    LEFT JOIN v_demand d ON d.route = s.route AND d.stop = s.stop AND time_bucket(INTERVAL '15 minutes', d.time) = s.time GROUP BY ALL""",
)
def t11(fx):
    """From the first to the last slot of the data."""
    first, last = fx.demand.agg(F.min("time"), F.max("time")).first()
    return tm.densify(fx.demand, ["route", "stop"], str(first), str(last), "passengers")


@check("X1_route_code", "SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS code, CASE WHEN length(CAST(c_nationkey AS VARCHAR)) < 2 THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') ELSE CAST(c_nationkey AS VARCHAR) END AS route_code FROM customer UNION SELECT DISTINCT CAST(c_custkey AS VARCHAR), CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 2 THEN lpad(CAST(c_custkey AS VARCHAR), 2, '0') ELSE CAST(c_custkey AS VARCHAR) END FROM customer")
def x1(fx):
    customers = fx.table("customer")
    codes = customers.select(F.col("c_nationkey").cast("string").alias("code")).union(customers.select(F.col("c_custkey").cast("string"))).distinct()
    return codes.withColumn("route_code", tx.route_code("code"))


@check("X2_variant_key", "SELECT route_id, CASE direction WHEN 1 THEN 'outbound' ELSE 'inbound' END AS direction_name, CASE direction WHEN 1 THEN 'outbound' ELSE 'inbound' END || '_' || CAST(variant_id AS VARCHAR) AS variant_key FROM v_route_docs")
def x2(fx):
    return fx.view("route_docs").select(
        "route_id", tx.direction_name("direction").alias("direction_name"), tx.variant_key("direction", "variant_id").alias("variant_key")
    )


@check("X3_percent_text", "SELECT event_id, printf('%.1f%%', CAST(floor(value) / 512 AS DOUBLE) * 100) AS pct, round(CAST(rtrim(printf('%.1f%%', CAST(floor(value) / 512 AS DOUBLE) * 100), '%') AS DOUBLE) / 100, 6) AS ratio FROM events")
def x3(fx):
    # Sixty-fourths and the like have few digits, so the two engines' tie rules cannot differ by chance.
    texts = fx.events.select("event_id", tx.format_pct(F.floor("value") / F.lit(512.0)).alias("pct"))
    return rounded(texts.withColumn("ratio", tx.parse_pct("pct")))
