"""Registered queries: spatial, contextual, series, aggregates, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from transit_spark import config as C
from transit_spark.functions import spatial as sp
from transit_spark.functions import temporal as tm
from transit_spark.operators import context as cx
from transit_spark.operators import scaling as nm
from transit_spark.operators import series as sr
from transit_spark.operators import summary as su
from transit_spark.plans.oracle_views import hav
from transit_spark.plans.registry import check, rounded
from transit_spark.sources.documents import flatten_route_paths, flatten_route_stops
from transit_spark.sources.pages import extract_attributes, extract_links

CENTER = ("10.7769", "106.7009")


def r6(*cols: str) -> str:
    return ", ".join(f"round({c},6) AS {c}" for c in cols)


@check("G1_haversine", f"SELECT seq, round({hav('latitude', 'longitude', '10.5', '106.5')},6) AS km FROM v_gps_raw")
def g1(fx):
    km = sp.haversine(F.col("latitude"), F.col("longitude"), F.lit(10.5), F.lit(106.5))
    return rounded(fx.gps_raw.select("seq", km.alias("km")))


@check("G2_distance_from_center", f"SELECT seq, round({hav('latitude', 'longitude', *CENTER)},6) AS distance_from_center FROM v_gps")
def g2(fx):
    return rounded(sp.center_features(fx.gps).select("seq", "distance_from_center"))


@check("G3_quadrant", "SELECT seq, CAST(coalesce(latitude > 10.7769::DOUBLE, false) AS INT) AS is_north, CAST(coalesce(longitude > 106.7009::DOUBLE, false) AS INT) AS is_east FROM v_gps")
def g3(fx):
    return sp.center_features(fx.gps).select("seq", "is_north", "is_east")


@check("G4_stop_coordinates", f"SELECT seq, route, stop, {r6('stop_lat', 'stop_lng')}, stop_order FROM v_spatial")
def g4(fx):
    return rounded(sp.stop_features(fx.demand, fx.stops).select("seq", "route", "stop", "stop_lat", "stop_lng", "stop_order"))


@check("G5_route_progress", f"SELECT seq, total_stops, {r6('route_progress')} FROM v_spatial")
def g5(fx):
    return rounded(sp.stop_features(fx.demand, fx.stops).select("seq", "total_stops", "route_progress"))


@check("G6_distance_to_next_stop", f"SELECT seq, route, stop, {r6('distance_to_next_stop')} FROM v_spatial")
def g6(fx):
    return rounded(sp.stop_features(fx.demand, fx.stops).select("seq", "route", "stop", "distance_to_next_stop"))


@check(
    "G7_event_proximity",
    f"""SELECT d.seq, CAST(n.km IS NOT NULL AS INT) AS event_nearby, round(n.km,6) AS event_distance FROM v_demand d LEFT JOIN (
      SELECT t.route, t.stop, t.time, min(km) AS km FROM (SELECT DISTINCT route, stop, time FROM v_demand) t
      JOIN (SELECT s.route, s.stop, e.start_time, e.end_time, {hav('s.latitude', 's.longitude', 'e.latitude', 'e.longitude')} AS km
            FROM v_stops s, v_city e WHERE {hav('s.latitude', 's.longitude', 'e.latitude', 'e.longitude')} <= 2) r
      ON r.route = t.route AND r.stop = t.stop AND r.start_time <= t.time AND r.end_time >= t.time GROUP BY ALL) n
    ON n.route = d.route AND n.stop = d.stop AND n.time = d.time""",
)
def g7(fx):
    near = cx.event_proximity(fx.demand, fx.stops, fx.city, 2.0)
    return rounded(near.select("seq", "event_nearby", "event_distance"))


@check("G8_gap_minutes", "SELECT seq, round(CAST(date_diff('second', lag(time) OVER (PARTITION BY route, bus_id ORDER BY time), time) AS DOUBLE) / 60, 6) AS gap_minutes FROM v_gps")
def g8(fx):
    return rounded(sr.gap_minutes(fx.gps, ["route", "bus_id"], ["time"]).select("seq", "gap_minutes"))


@check(
    "J1_join_weather",
    f"""SELECT d.seq, {r6('temperature', 'humidity')}, rain_mm, wind_speed, conditions FROM v_demand d
    LEFT JOIN v_weather w ON time_bucket(INTERVAL '15 minutes', w.time) = time_bucket(INTERVAL '15 minutes', d.time)""",
)
def j1(fx):
    return rounded(cx.join_weather(fx.demand, fx.weather).select("seq", *cx.WEATHER_COLS))


@check("J2_rain_features", "SELECT seq, is_raining, rain_intensity FROM v_context")
def j2(fx):
    return cx.weather_features(cx.join_weather(fx.demand, fx.weather)).select("seq", "is_raining", "rain_intensity")


@check("J3_temperature_features", f"SELECT seq, temp_category, {r6('heat_index')} FROM v_context")
def j3(fx):
    return rounded(cx.weather_features(cx.join_weather(fx.demand, fx.weather)).select("seq", "temp_category", "heat_index"))


@check(
    "J4_active_events",
    """SELECT d.seq, CAST(coalesce(a.n, 0) AS INT) AS nearby_events, round(coalesce(a.impact, 1.0), 6) AS event_impact_factor
    FROM v_demand d LEFT JOIN v_active a ON a.time = d.time""",
)
def j4(fx):
    return rounded(cx.join_active_events(fx.demand, fx.city).select("seq", "nearby_events", "event_impact_factor"))


@check("J5_commute_flag", "SELECT seq, CAST((hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 18) AND is_weekend = 0 AS INT) AS is_commute_time FROM v_temporal")
def j5(fx):
    return cx.commute_flag(tm.temporal_features(fx.demand)).select("seq", "is_commute_time")


LO, HI = "2024-01-10 00:00:00", "2024-01-11 06:00:00"


@check("J6_events_touching", f"SELECT event_id, start_time, end_time FROM v_city WHERE start_time BETWEEN TIMESTAMP '{LO}' AND TIMESTAMP '{HI}' OR end_time BETWEEN TIMESTAMP '{LO}' AND TIMESTAMP '{HI}'")
def j6(fx):
    return cx.events_in_range(fx.city, LO, HI).select("event_id", "start_time", "end_time")


@check("J6_events_overlapping", f"SELECT event_id, start_time, end_time FROM v_city WHERE start_time <= TIMESTAMP '{HI}' AND end_time >= TIMESTAMP '{LO}'")
def j6b(fx):
    return cx.events_in_range(fx.city, LO, HI, "overlap").select("event_id", "start_time", "end_time")


@check(
    "J7_integrate_demand",
    """SELECT d.seq, d.time, d.passengers, w.rain_mm, e.event_type AS event, e.demand_factor,
      CAST(trunc(d.passengers * e.demand_factor) AS INT) AS adjusted_demand
    FROM v_demand d JOIN v_weather w USING (time) JOIN (
      SELECT DISTINCT start_time AS time, event_type, CAST(CASE event_type WHEN 'traffic_jam' THEN 1.5 WHEN 'festival' THEN 1.7 ELSE 1.0 END AS DOUBLE) AS demand_factor
      FROM v_city) e ON e.time = d.time""",
)
def j7(fx):
    events = cx.event_factor(fx.city.select(F.col("start_time").alias("time"), F.col("event_type").alias("event")).distinct())
    joined = cx.integrate_demand(fx.demand.select("seq", "time", "passengers"), fx.weather.select("time", "rain_mm"), events)
    return joined.select("seq", "time", "passengers", "rain_mm", "event", "demand_factor", "adjusted_demand")


CONTEXT = ["temperature", "humidity", "rain_mm", "wind_speed", "heat_index", "event_impact_factor"]


@check("J8_contextual_features", f"SELECT seq, {r6(*CONTEXT)}, conditions, is_raining, rain_intensity, temp_category, nearby_events, is_commute_time FROM v_context")
def j8(fx):
    df = cx.contextual_features(tm.temporal_features(fx.demand), fx.weather, fx.city)
    return rounded(df.select("seq", *CONTEXT, "conditions", "is_raining", "rain_intensity", "temp_category", "nearby_events", "is_commute_time"))


@check("J9_matching", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD')")
def j9(fx):
    homes = fx.table("customer").where(F.col("c_mktsegment") == "HOUSEHOLD").select(F.col("c_custkey").alias("o_custkey"))
    return cx.matching(fx.table("orders").select("o_orderkey", "o_custkey"), homes, "o_custkey")


@check("J9_not_matching", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD')")
def j9b(fx):
    homes = fx.table("customer").where(F.col("c_mktsegment") == "HOUSEHOLD").select(F.col("c_custkey").alias("o_custkey"))
    return cx.matching(fx.table("orders").select("o_orderkey", "o_custkey"), homes, "o_custkey", keep=False)


LABELS = {"distance": "Distance", "vehicle": "Vehicle", "fare": "Fare"}


@check(
    "J10_enrich_routes",
    """SELECT o.o_orderkey AS page_id, o.o_orderpriority AS route_name, coalesce(CASE WHEN p.html <> '<p>no data</p>' THEN CAST(o.o_custkey AS VARCHAR) || ' km' END, '') AS distance,
      coalesce(CASE WHEN p.html <> '<p>no data</p>' THEN o.o_orderpriority || ' & more' END, '') AS vehicle
    FROM orders o JOIN v_route_pages p ON p.page_id = o.o_orderkey""",
)
def j10(fx):
    routes = fx.table("orders").select(F.col("o_orderkey").alias("page_id"), F.col("o_orderpriority").alias("route_name"))
    attributes = extract_attributes(fx.view("route_pages").where(F.contains("html", F.lit("rouInfo"))), {k: LABELS[k] for k in ("distance", "vehicle")})
    return cx.enrich_routes(routes, attributes)


@check("J11_event_impact", "SELECT event_id, round(1.0 + expected_attendance / 50000 * 0.5, 6) AS impact_factor, CAST(CASE event_type WHEN 'traffic_jam' THEN 1.5 WHEN 'festival' THEN 1.7 ELSE 1.0 END AS DOUBLE) AS demand_factor FROM v_city_raw")
def j11(fx):
    df = cx.event_factor(cx.event_impact(fx.city_raw.drop("impact_factor")), "event_type")
    return rounded(df.select("event_id", "impact_factor", "demand_factor"))


SERIES = ["route", "stop"]
LAG_SQL = ", ".join(f"lag(passengers, {n}) OVER w AS passengers_lag_{n}" for n in C.FEATURE_LAGS)
ROLL_SQL = ", ".join(
    f"round(avg(passengers) OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 6) AS passengers_rolling_mean_{n}, "
    f"round(stddev_samp(passengers) OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 6) AS passengers_rolling_std_{n}"
    for n in C.FEATURE_WINDOWS
)


@check("W1_lag_features", f"SELECT seq, {LAG_SQL} FROM v_demand WINDOW w AS (PARTITION BY route, stop ORDER BY time)")
def w1(fx):
    df = sr.lag_features(fx.demand, "passengers", C.FEATURE_LAGS, SERIES, ["time"])
    return df.select("seq", *[f"passengers_lag_{n}" for n in C.FEATURE_LAGS])


@check("W1_lag_ungrouped", "SELECT route, time, total_demand, lag(total_demand, 1) OVER w AS total_demand_lag_1, lag(total_demand, 12) OVER w AS total_demand_lag_12 FROM v_totals WINDOW w AS (ORDER BY time, route)")
def w1b(fx):
    return sr.lag_features(su.demand_by_time(fx.demand).select("route", "time", "total_demand"), "total_demand", [1, 12], [], ["time", "route"])


@check("W2_rolling_features", f"SELECT seq, {ROLL_SQL} FROM v_demand WINDOW w AS (PARTITION BY route, stop ORDER BY time)")
def w2(fx):
    df = sr.rolling_features(fx.demand, "passengers", C.FEATURE_WINDOWS, SERIES, ["time"])
    return rounded(df.select("seq", *[c for c in df.columns if "_rolling_" in c]))


@check("W3_tail", "SELECT seq, route, stop, time FROM v_demand QUALIFY row_number() OVER (PARTITION BY route, stop ORDER BY time DESC) <= 12")
def w3(fx):
    return sr.tail(fx.demand, SERIES, 12, ["time"]).select("seq", "route", "stop", "time")


@check("W3_head", "SELECT seq, route, stop, time FROM v_demand QUALIFY row_number() OVER (PARTITION BY route, stop ORDER BY time) <= 5")
def w3b(fx):
    return sr.head(fx.demand, SERIES, 5, ["time"]).select("seq", "route", "stop", "time")


@check("W4_position", "SELECT seq, CAST(row_number() OVER (PARTITION BY route, stop ORDER BY time) AS BIGINT) AS position FROM v_demand")
def w4(fx):
    return sr.with_position(fx.demand, SERIES, ["time"]).select("seq", "position")


@check(
    "W5_even_sample",
    """SELECT event_id, ts FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS p, count(*) OVER () AS n FROM events)
    WHERE p IN (SELECT CASE WHEN i = 499 THEN (SELECT count(*) FROM events) - 1 ELSE CAST(floor(i * (((SELECT count(*) FROM events) - 1) / 499.0::DOUBLE)) AS BIGINT) END FROM range(0, 500) t(i))""",
)
def w5(fx):
    return sr.even_sample(fx.events.select("event_id", "ts"), ["ts", "event_id"], 500)


@check("A1_demand_by_time", "SELECT route, time, total_demand FROM v_totals")
def a1(fx):
    return su.demand_by_time(fx.demand)


@check("A2_demand_by_hour", "SELECT CAST(hour(time) AS INT) AS hour, route, CAST(sum(passengers) AS BIGINT) AS total_demand FROM v_demand GROUP BY ALL")
def a2(fx):
    return su.demand_by_hour(fx.demand)


@check("A3_trips_by_route", "SELECT route, count(*) AS trips FROM v_demand GROUP BY route")
def a3(fx):
    return su.trips_by_route(fx.demand)


@check("A4_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type")
def a4(fx):
    return su.value_counts(fx.events, "event_type")


@check("A4_most_frequent", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 1")
def a4b(fx):
    return su.value_counts(fx.events, "user_id", 1)


@check("A5_distinct_values", "SELECT DISTINCT route FROM v_demand")
def a5(fx):
    return su.distinct_values(fx.demand, "route")


@check("A5_n_unique", """SELECT 'user_id' AS "column", count(DISTINCT user_id) AS n_unique FROM events UNION ALL SELECT 'event_type', count(DISTINCT event_type) FROM events UNION ALL SELECT 'props', count(DISTINCT props) FROM events""")
def a5b(fx):
    return su.n_unique(fx.events, ["user_id", "event_type", "props"])


@check("A6_stops_per_route", "SELECT count(*) / count(DISTINCT route) AS stops_per_route FROM v_stops")
def a6(fx):
    return su.stops_per_route(fx.stops)


def _describe_sql(col: str, table: str) -> str:
    return f"""SELECT '{col}' AS "column", count({col}) AS count, round(avg({col}),6) AS mean, round(stddev_samp({col}),6) AS std,
    round(min({col}),6) AS min, round(max({col}),6) AS max, round(quantile_cont({col},0.25),6) AS q25, round(quantile_cont({col},0.5),6) AS q50,
    round(quantile_cont({col},0.75),6) AS q75 FROM {table}"""


@check("A7_describe", " UNION ALL ".join(_describe_sql(c, "v_gps_raw") for c in ("latitude", "longitude", "speed", "heading")))
def a7(fx):
    return rounded(su.describe(fx.gps_raw, C.GPS_NUMERIC))


@check(
    "A8_rank_correlations",
    "SELECT feature, round(correlation, 6) AS correlation FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(passengers AS DOUBLE)) AS correlation FROM v_temporal" for c in ("boarding_count", "alighting_count", "hour", "day_of_week", "is_weekend", "is_peak_hour", "time_since_midnight"))
    + ") ORDER BY correlation DESC LIMIT 5",
)
def a8(fx):
    cols = ["boarding_count", "alighting_count", "hour", "day_of_week", "is_weekend", "is_peak_hour", "time_since_midnight"]
    return rounded(su.rank_correlations(tm.temporal_features(fx.demand), "passengers", cols, 5))


@check("A9_drop_duplicates", "SELECT DISTINCT route, stop, time, passengers FROM v_demand_raw")
def a9(fx):
    return su.drop_duplicates(fx.demand_raw.select("route", "stop", "time", "passengers"))


@check("A10_union_all", "SELECT 'demand' AS source, route, time FROM v_demand UNION ALL SELECT 'gps', route, time FROM v_gps")
def a10(fx):
    return su.union_all([
        fx.demand.select(F.lit("demand").alias("source"), "route", "time"),
        fx.gps.select(F.lit("gps").alias("source"), "route", "time"),
    ])


@check("A11_melt", " UNION ALL ".join(f"SELECT route, '{c}' AS variable, CAST(sum({c}) AS BIGINT) AS value FROM v_demand GROUP BY route" for c in C.DEMAND_COUNTS))
def a11(fx):
    wide = fx.demand.groupBy("route").agg(*[F.sum(c).alias(c) for c in C.DEMAND_COUNTS])
    return su.melt(wide, ["route"])


@check("A12_top_k", "SELECT seq, route, stop, time, passengers FROM v_demand ORDER BY passengers DESC, seq LIMIT 25")
def a12(fx):
    return su.top_k(fx.demand.select("seq", "route", "stop", "time", "passengers"), [F.col("passengers").desc(), "seq"], 25)


@check(
    "A13_variant_summary",
    """SELECT s.route_id, s.direction, s.variant_id, stop_count, coalesce(point_count, 0) AS point_count FROM
      (SELECT route_id, direction, variant_id, CAST(json_array_length(stops_json) AS BIGINT) AS stop_count FROM v_route_docs WHERE json_array_length(stops_json) > 0) s
      LEFT JOIN (SELECT route_id, direction, variant_id, CAST(json_array_length(path_json, '$.lat') AS BIGINT) AS point_count FROM v_route_docs WHERE route_id % 3 <> 0) p
      ON p.route_id = s.route_id AND p.direction = s.direction AND p.variant_id = s.variant_id""",
)
def a13(fx):
    """Paths are missing for every third route."""
    docs = fx.view("route_docs")
    return su.variant_summary(flatten_route_stops(docs), flatten_route_paths(docs.where(F.col("route_id") % 3 != 0)))


SCALED = ["latitude", "longitude", "heading"]


def _scale_sql(center: str, scale: str) -> str:
    cols = ", ".join(
        f"round((g.{c} - {center.format(c=c)}) / {scale.format(c=c)}, 6) + 0.0 AS {c}" for c in SCALED
    )
    parts = ", ".join(
        f"min({c}) AS {c}_lo, max({c}) AS {c}_hi, avg({c}) AS {c}_avg, stddev_pop({c}) AS {c}_std, "
        f"quantile_cont({c},0.25) AS {c}_q25, quantile_cont({c},0.5) AS {c}_q50, quantile_cont({c},0.75) AS {c}_q75"
        for c in SCALED
    )
    return f"SELECT seq, {cols} FROM v_gps_raw g, (SELECT {parts} FROM v_gps_raw) p"


def _scaled(fx, method):
    df = fx.gps_raw.select("seq", *SCALED)
    return rounded(nm.scale(df, nm.fit_scaler(df, SCALED, method)))


@check("N1_minmax", _scale_sql("p.{c}_lo", "(p.{c}_hi - p.{c}_lo)"))
def n1(fx):
    return _scaled(fx, "minmax")


@check("N2_standard", _scale_sql("p.{c}_avg", "p.{c}_std"))
def n2(fx):
    return _scaled(fx, "standard")


@check("N3_robust", _scale_sql("p.{c}_q50", "(p.{c}_q75 - p.{c}_q25)"))
def n3(fx):
    return _scaled(fx, "robust")


@check(
    "N4_apply_scaler",
    "SELECT seq, round((g.speed - p.lo) / (p.hi - p.lo), 6) + 0.0 AS speed FROM v_gps_raw g, (SELECT min(speed) AS lo, max(speed) AS hi FROM v_gps) p",
)
def n4(fx):
    params = nm.fit_scaler(fx.gps, ["speed"])
    return rounded(nm.scale(fx.gps_raw.select("seq", "speed"), params, "features_minmax"))


@check("N5_unscale", f"SELECT seq, {r6(*SCALED)} FROM v_gps_raw")
def n5(fx):
    df = fx.gps_raw.select("seq", *SCALED)
    params = nm.fit_scaler(df, SCALED, "standard")
    return rounded(nm.unscale(nm.scale(df, params), params))


@check(
    "N6_encode",
    """SELECT seq, CAST(c.code AS INT) AS conditions FROM v_weather_raw JOIN (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code
    FROM (SELECT DISTINCT coalesce(conditions, 'nan') AS value FROM v_weather_raw)) c ON c.value = coalesce(conditions, 'nan')""",
)
def n6(fx):
    df = fx.weather_raw.select("seq", "conditions")
    return nm.encode(df, nm.fit_labels(df, ["conditions"]))


@check("N6_fit_labels", """SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INT) AS code FROM (SELECT DISTINCT 'props' AS "column", props AS value FROM events UNION ALL SELECT DISTINCT 'event_type', event_type FROM events)""")
def n6b(fx):
    return nm.fit_labels(fx.events, ["props", "event_type"])


@check("N7_one_hot", "SELECT seq, coalesce(conditions = 'Clear', false) AS \"conditions_Clear\", coalesce(conditions = 'Rain', false) AS \"conditions_Rain\" FROM v_weather_raw")
def n7(fx):
    return nm.one_hot(fx.weather_raw.select("seq", "conditions"), ["conditions"])


@check("N7_one_hot_drop_first", "SELECT seq, coalesce(conditions = 'Rain', false) AS \"conditions_Rain\" FROM v_weather_raw")
def n7b(fx):
    return nm.one_hot(fx.weather_raw.select("seq", "conditions"), ["conditions"], drop_first=True)


@check(
    "N8_scale_target",
    """SELECT seq, round((passengers - lo) / (hi - lo), 6) AS passengers, round(CAST(passengers AS DOUBLE), 6) AS restored FROM v_demand,
    (SELECT CAST(min(passengers) AS DOUBLE) AS lo, max(passengers) AS hi FROM v_demand)""",
)
def n8(fx):
    params = nm.fit_target(fx.demand, "passengers")
    scaled = nm.scale_target(fx.demand.select("seq", "passengers"), params, "passengers").withColumn("restored", F.col("passengers"))
    return rounded(nm.unscale_target(scaled, params, "passengers", column="restored"))


PARAMS_SQL = " UNION ALL ".join(
    f"SELECT 'features_robust' AS name, '{c}' AS \"column\", round(quantile_cont({c},0.5),6) AS center, "
    f"round(quantile_cont({c},0.75)-quantile_cont({c},0.25),6) AS scale, round(min({c}),6) AS min, round(max({c}),6) AS max FROM v_gps_raw"
    for c in SCALED
)


@check("N9_save_load_params", PARAMS_SQL)
def n9(fx):
    path = fx.fresh_dir() + "/params"
    nm.save_params(nm.fit_scaler(fx.gps_raw, SCALED, "robust"), path)
    return rounded(nm.load_params(fx.spark, path).select("name", "column", "center", "scale", "min", "max"))


@check("N10_scaler_info", " UNION ALL ".join(f"SELECT 'features_minmax' AS name, 3::BIGINT AS columns, '{c}' AS \"column\", round(min({c}),6) AS original_min, round(max({c}),6) AS original_max FROM v_gps_raw" for c in SCALED))
def n10(fx):
    return rounded(nm.scaler_info(nm.fit_scaler(fx.gps_raw, SCALED)))


@check(
    "N11_fit_all_columns",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", 'numeric' AS kind, round(min({c}), 6) + 0.0 AS low, round(max({c}), 6) + 0.0 AS high, 0::BIGINT AS classes FROM v_gps_raw" for c in ("heading", "latitude", "longitude", "seq", "speed"))
    + "".join(f" UNION ALL SELECT '{c}', 'categorical', NULL, NULL, count(DISTINCT {c}) FROM v_gps_raw" for c in ("bus_id", "route")),
)
def n11(fx):
    """Fitted without a list of columns: scalers for the numeric ones but times, codes for the texts."""
    ranges = nm.fit_scaler(fx.gps_raw).select("column", F.lit("numeric").alias("kind"), F.col("min").alias("low"), F.col("max").alias("high"), F.lit(0).cast("long").alias("classes"))
    codes = nm.fit_labels(fx.gps_raw, nm.categorical_columns(fx.gps_raw)).groupBy("column").agg(F.count(F.lit(1)).alias("classes"))
    none = F.lit(None).cast("double")
    return rounded(ranges.unionByName(codes.select("column", F.lit("categorical").alias("kind"), none.alias("low"), none.alias("high"), "classes")))


SITE = "http://transit.example"


@check(
    "S15_extract_links",
    r"""SELECT page_id, CAST(position AS INT) AS position, '' AS number, replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(a, '<[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS name,
      CASE WHEN href LIKE '/%' THEN 'http://transit.example' || href ELSE href END AS url FROM (
      SELECT page_id, position, a, replace(replace(replace(replace(replace(regexp_extract(a, '(?is)^<a\s[^>]*href="([^"]*)"', 1), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS href FROM (
      SELECT page_id, unnest(l) AS a, unnest(range(0, len(l))) AS position
      FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>') AS l FROM pages)))""",
)
def s15(fx):
    return extract_links(fx.pages, SITE)
