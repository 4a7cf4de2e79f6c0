"""Registered queries: files, tables, documents, pages, streams, flows."""

from __future__ import annotations

import time as clock
import uuid

from pyspark.sql import functions as F

from transit_spark import config as C
from transit_spark.functions.temporal import plus_minutes
from transit_spark.operators import forecast as fc
from transit_spark.plans import flows
from transit_spark.plans.checks_features import LABELS, r6
from transit_spark.plans.checks_planning import GLOBAL_LINE
from transit_spark.plans.registry import check, rounded, significant, significant_sql
from transit_spark.session import stage
from transit_spark.sources import documents as dc
from transit_spark.sources import pages as pg
from transit_spark.sources import tables as tb
from transit_spark.streaming import jobs as st

GPS = ["route", "bus_id", "time", "latitude", "longitude", "speed", "heading"]


@check("S1_S2_csv_round_trip", f"SELECT route, bus_id, time, {r6('latitude', 'longitude', 'speed')}, heading FROM v_gps")
def s1(fx):
    path = fx.fresh_dir()
    tb.write_tables({"gps": fx.gps.select(*GPS)}, path)
    return rounded(tb.read_table(fx.spark, path, "gps"))


@check(
    "S3_flatten_route_variants",
    """SELECT o_orderkey AS route_id, CASE o_orderkey % 2 WHEN 0 THEN 'outbound' ELSE 'inbound' END AS direction_name, unnest([o_custkey, o_custkey + 1]) AS variant_id,
      unnest(['To ' || o_orderpriority, '']) AS variant_name, unnest(['', 'Alpha']) AS start_stop, unnest(['', 'Stop ' || o_custkey]) AS end_stop,
      unnest([CAST(1000 + o_custkey AS DOUBLE) + 0.5, 900]) AS distance_m, unnest([CAST(30 + o_custkey % 40 AS DOUBLE), 25]) AS running_minutes FROM orders WHERE o_orderstatus <> 'F'""",
)
def s3v(fx):
    return dc.flatten_route_variants(fx.view("variant_docs"))


@check(
    "S3_flatten_route_stops",
    """SELECT DISTINCT route_id, direction, variant_id, CASE direction WHEN 1 THEN 'outbound' ELSE 'inbound' END || '_' || CAST(variant_id AS VARCHAR) AS variant_key,
      s.Name AS stop_name, s.Code AS stop_code, s.Lat AS lat, s.Lng AS lng, s.AddressNo || ' ' || s.Street AS address, s.Routes AS routes, s.Status AS status, s.StopType AS stop_type
    FROM (SELECT route_id, direction, variant_id, unnest(from_json(stops_json, '[{"Name":"VARCHAR","Code":"VARCHAR","Lat":"DOUBLE","Lng":"DOUBLE","AddressNo":"VARCHAR","Street":"VARCHAR","Routes":"VARCHAR","Status":"VARCHAR","StopType":"VARCHAR"}]')) AS s
      FROM v_route_docs WHERE stops_json <> 'null')""",
)
def s3(fx):
    return dc.flatten_route_stops(fx.view("route_docs"))


@check(
    "S4_flatten_route_paths",
    """SELECT route_id, direction, variant_id, CAST(i AS INT) AS position, lat[i + 1] AS lat, lng[i + 1] AS lng, CAST(len(lat) AS INT) AS point_count FROM (
      SELECT route_id, direction, variant_id, lat, lng, unnest(range(0, len(lat))) AS i FROM (
        SELECT route_id, direction, variant_id, CAST(json_extract(path_json, '$.lat') AS DOUBLE[]) AS lat, CAST(json_extract(path_json, '$.lng') AS DOUBLE[]) AS lng
        FROM v_route_docs WHERE path_json <> 'null'))""",
)
def s4(fx):
    return dc.flatten_route_paths(fx.view("route_docs"))


def _weather_sql(extra: str) -> str:
    num = "CAST(json_extract(doc, '{p}') AS DOUBLE)".format
    return f"""SELECT id, {num(p='$.main.temp')} AS temperature, {num(p='$.main.humidity')} AS humidity, {num(p='$.main.pressure')} AS pressure, {num(p='$.wind.speed')} AS wind_speed,
      coalesce(json_extract_string(doc, '$.weather[0].main'), '') AS conditions, coalesce(json_extract_string(doc, '$.weather[0].description'), '') AS description,
      coalesce({num(p='$.rain."3h"')}, 0) AS rain_3h, {extra} FROM v_weather_docs"""


@check("S5_flatten_weather", _weather_sql("coalesce(CAST(json_extract(doc, '$.rain.\"1h\"') AS DOUBLE), 0) AS rain_1h"))
def s5(fx):
    return dc.flatten_weather(fx.view("weather_docs"))


@check(
    "S6_flatten_forecast",
    _weather_sql("coalesce(CAST(json_extract(doc, '$.clouds.all') AS DOUBLE), 0) AS clouds, coalesce(CAST(json_extract(doc, '$.pop') AS DOUBLE), 0) AS pop, CAST(json_extract_string(doc, '$.dt_txt') AS TIMESTAMP) AS time"),
)
def s6(fx):
    docs = fx.view("weather_docs")
    wrapped = docs.select("id", F.concat(F.lit('{"list":['), F.col("doc"), F.lit("]}")).alias("doc"))
    return dc.flatten_forecast(wrapped)


def _database(fx) -> str:
    name = f"transit_{uuid.uuid4().hex}"
    fx.spark.sql(f"CREATE DATABASE {name} LOCATION '{fx.fresh_dir()}'")
    return name


@check("S7_save_table", "SELECT route, count(*) * 2 AS rows_stored, (SELECT count(*) FROM v_demand) AS rows_saved FROM v_demand GROUP BY route")
def s7(fx):
    name = f"{_database(fx)}.demand_copy"
    tb.save_table(fx.demand, name, "replace")
    saved = tb.save_table(fx.demand, name, "append")
    return fx.spark.table(name).groupBy("route").agg(F.count(F.lit(1)).alias("rows_stored")).withColumn("rows_saved", F.lit(saved).cast("long"))


@check("S8_day_partitions", "SELECT CAST(time AS DATE) AS day, count(*) AS n FROM v_gps GROUP BY ALL")
def s8(fx):
    db = _database(fx)
    tb.create_tables(fx.spark, db)
    tb.save_table(fx.gps, f"{db}.gps_traces")
    return fx.spark.table(f"{db}.gps_traces").groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@check(
    "S8_unique_keys",
    """SELECT time, route_id, bus_id, speed FROM (SELECT time, route AS route_id, bus_id, seq, round(speed,6) AS speed FROM v_gps)
    QUALIFY row_number() OVER (PARTITION BY time, bus_id ORDER BY seq) = 1""",
)
def s8b(fx):
    db = _database(fx)
    tb.create_tables(fx.spark, db)
    tb.save_table(fx.gps.unionByName(fx.gps), f"{db}.gps_traces", unique=True, order=["seq"])
    return rounded(fx.spark.table(f"{db}.gps_traces").select("time", "route_id", "bus_id", "speed"))


@check(
    "S8_keyed_append",
    """WITH first AS (SELECT * FROM v_gps WHERE time < TIMESTAMP '2024-01-20 00:00:00' QUALIFY row_number() OVER (PARTITION BY time, bus_id ORDER BY seq) = 1),
    later AS (SELECT * FROM v_gps WHERE time >= TIMESTAMP '2024-01-10 00:00:00' QUALIFY row_number() OVER (PARTITION BY time, bus_id ORDER BY seq DESC) = 1)
    SELECT time, route AS route_id, bus_id, round(speed, 6) AS speed, n1, n2, 0::BIGINT AS n3 FROM (
      SELECT * FROM first UNION ALL SELECT * FROM later WHERE (time, bus_id) NOT IN (SELECT (time, bus_id) FROM first)),
      (SELECT count(*) AS n1 FROM first), (SELECT count(*) AS n2 FROM later WHERE (time, bus_id) NOT IN (SELECT (time, bus_id) FROM first))""",
)
def s8c(fx):
    """Two batches that overlap by ten days, the second one twice: stored rows stay, new keys come in once."""
    db = _database(fx)
    tb.create_tables(fx.spark, db)
    first = fx.gps.where(F.col("time") < F.lit("2024-01-20").cast("timestamp_ntz"))
    later = fx.gps.where(F.col("time") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    batches = (first, [F.col("seq")]), (later, [F.col("seq").desc()]), (later, [F.col("seq").desc()])
    added = {f"n{i + 1}": F.lit(tb.append_new(batch, f"{db}.gps_traces", order)).cast("long") for i, (batch, order) in enumerate(batches)}
    return rounded(fx.spark.table(f"{db}.gps_traces").select("time", "route_id", "bus_id", "speed").withColumns(added))


@check(
    "S9_load_table",
    """SELECT time, route_id, bus_id, speed FROM (SELECT time, route AS route_id, bus_id, round(speed,6) AS speed FROM v_gps)
    WHERE route_id = 'R_view' AND time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-09 12:00:00' ORDER BY time DESC""",
)
def s9(fx):
    db = _database(fx)
    tb.create_tables(fx.spark, db)
    tb.save_table(fx.gps, f"{db}.gps_traces")
    span = ("2024-01-05 00:00:00", "2024-01-09 12:00:00")
    return rounded(tb.load_table(fx.spark, f"{db}.gps_traces", filters={"route_id": "R_view"}, time_range=span, columns=["time", "route_id", "bus_id", "speed"]))


@check("S10_recent", "SELECT seq, route, time FROM v_demand WHERE time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOUR AND route = 'R_click' ORDER BY time DESC")
def s10(fx):
    return tb.recent(fx.demand, 48, "R_click", "2024-01-31 00:00:00").select("seq", "route", "time")


@check("S11_run_sql", "SELECT route, max(passengers) AS busiest FROM v_demand GROUP BY route HAVING count(*) > 10")
def s11(fx):
    return tb.run_sql(fx.spark, "SELECT route, max(passengers) AS busiest FROM {demand} GROUP BY route HAVING count(*) > 10", demand=fx.demand)


@check(
    "S12_pack_features",
    "SELECT time, route AS route_id, stop AS stop_id, CAST(passengers AS DOUBLE) AS passengers, CAST(boarding_count AS DOUBLE) AS boarding_count, passengers IS NULL AS explicit_null FROM v_demand_raw",
)
def s12(fx):
    packed = tb.pack_features(fx.demand_raw, ["passengers", "boarding_count"])
    return packed.select(
        "time", "route_id", "stop_id",
        F.get_json_object("features", "$.passengers").cast("double").alias("passengers"),
        F.get_json_object("features", "$.boarding_count").cast("double").alias("boarding_count"),
        F.contains("features", F.lit('"passengers":null')).alias("explicit_null"),
    )


def _predictions(fx):
    df = fc.interval_from_members(fx.view("members"), F.array("m1", "m2", "m3"))
    return df.join(fx.demand_raw.select("seq", "route", "stop", "time"), "seq")


@check(
    "S13_save_predictions",
    """SELECT d.time, d.route AS route_id, d.stop AS stop_id, CAST(trunc(predicted) AS INT) AS predicted_demand, 'v1' AS model_version FROM v_demand_raw d JOIN (
      SELECT seq, (m1 + m2 + m3) / 3 AS predicted FROM v_members) USING (seq)""",
)
def s13(fx):
    name = f"{_database(fx)}.predictions"
    tb.save_predictions(_predictions(fx), "v1", name, "2024-02-01 00:00:00")
    return fx.spark.table(name).select("time", "route_id", "stop_id", "predicted_demand", "model_version")


@check(
    "S14_save_dataset",
    """SELECT 'passenger_demand' AS table_name, route AS route_id, count(*) AS n FROM v_demand GROUP BY route
    UNION ALL SELECT 'gps_traces', route, count(*) FROM (SELECT route FROM v_gps QUALIFY row_number() OVER (PARTITION BY time, bus_id ORDER BY seq) = 1) GROUP BY route
    UNION ALL SELECT 'stops', route, count(*) FROM v_stops GROUP BY route""",
)
def s14(fx):
    """Saved twice: the second time adds nothing."""
    db = _database(fx)
    dataset, orders = {"demand": fx.demand, "gps": fx.gps, "stops": fx.stops}, {"gps": ["seq"]}
    tb.save_dataset(dataset, db, orders)
    tb.save_dataset(dataset, db, orders)
    parts = [
        fx.spark.table(f"{db}.{t}").groupBy("route_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "route_id", "n")
        for t in ("passenger_demand", "gps_traces", "stops")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check(
    "S16_extract_attributes",
    """SELECT page_id, CASE WHEN ok THEN CAST(o_custkey AS VARCHAR) || ' km' ELSE '' END AS distance, CASE WHEN ok THEN o_orderpriority || ' & more' ELSE '' END AS vehicle,
      CASE WHEN ok AND page_id % 3 <> 0 THEN CAST(page_id AS VARCHAR) ELSE '' END AS fare
    FROM (SELECT o_orderkey AS page_id, o_custkey, o_orderpriority, o_orderstatus <> 'P' AS ok FROM orders)""",
)
def s16(fx):
    return pg.extract_attributes(fx.view("route_pages"), LABELS)


STOP_ROWS_SQL = """SELECT DISTINCT page_id, direction, stop_order, stop_name FROM (SELECT o_orderkey AS page_id,
    unnest(['To North','To North','To North','To South']) AS direction, unnest(['A','1','B','A']) AS stop_order,
    unnest(['Stop ' || o_custkey, 'Stop ' || o_orderkey, o_orderpriority, 'Gamma']) AS stop_name FROM orders WHERE o_orderstatus <> 'P')"""


@check("S17_extract_stops", STOP_ROWS_SQL)
def s17(fx):
    return pg.extract_stops(fx.view("route_pages"))


@check("S17_extract_inner_stops", f"SELECT * FROM ({STOP_ROWS_SQL}) WHERE stop_order NOT IN ('A', 'B')")
def s17b(fx):
    return pg.extract_stops(fx.view("route_pages"), skip_terminals=True)


@check(
    "S18_extract_timetable",
    """SELECT o_orderkey AS page_id, CAST(unnest([6, 7]) AS INT) AS "row", 'To South' AS direction, unnest(['1', '2']) AS stop_order, unnest(['Alpha', 'Beta ' || o_custkey]) AS stop_name,
      unnest(['05:' || lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0') || '-06:35', '06:10']) AS departure_time FROM orders WHERE o_orderstatus <> 'P'""",
)
def s18(fx):
    return pg.extract_timetable(fx.view("route_pages"))


@check("S18_timetable_by_word", "SELECT o_orderkey AS page_id, unnest(['1', '2']) AS stop_order, 'Unknown' AS direction FROM orders WHERE o_orderstatus <> 'P'")
def s18b(fx):
    """The last heading above the times is no heading North."""
    return pg.extract_timetable(fx.view("route_pages"), direction_word="North").select("page_id", "stop_order", "direction")


@check(
    "S15_select_links",
    """SELECT o_orderkey AS page_id, CAST(unnest(range(0, n)) AS INT) AS position, unnest(['7', '08'][:n]) AS number, unnest(['North ' || o_custkey, o_orderpriority][:n]) AS name,
      unnest(['http://transit.example/r/' || o_custkey, 'http://other.example/' || o_orderkey][:n]) AS url FROM (SELECT *, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS n FROM orders)""",
)
def s15b(fx):
    """Only the buttons of the result box, whatever boxes lie inside and around it."""
    return pg.extract_links(fx.view("list_pages"), "http://transit.example", selector="#divResult a.cms-button")


@check(
    "S16_table_attributes",
    """SELECT o_orderkey AS page_id, CASE o_orderstatus WHEN 'P' THEN '' ELSE 'Company ' || o_custkey END AS operator,
      CASE o_orderstatus WHEN 'P' THEN '' ELSE o_custkey || ' km' END AS distance, CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderpriority END AS fare FROM orders""",
)
def s16b(fx):
    """Labels in cells and in lists of the information table; a table elsewhere says something else."""
    return pg.extract_attributes(fx.view("list_pages"), {"operator": "Operator", "distance": "Distance", "fare": "Fare"}, within="#rouInfo table.tbl100")


@check(
    "S3_route_documents",
    """WITH docs AS (SELECT o_orderkey AS route_id, o_custkey AS variant_id, CASE o_orderkey % 2 WHEN 0 THEN 'outbound' ELSE 'inbound' END AS direction_name, o_orderstatus AS s FROM orders WHERE o_orderstatus <> 'F')
    SELECT route_id, 2::BIGINT AS variants, direction_name || '_' || variant_id AS variant_key, CASE s WHEN 'P' THEN 0 ELSE 2 END::BIGINT AS stops, CASE s WHEN 'P' THEN 0 ELSE 3 END::BIGINT AS points, CASE s WHEN 'P' THEN NULL ELSE 10.5::DOUBLE END AS second_lat FROM docs
    UNION ALL SELECT route_id, 2, direction_name || '_' || (variant_id + 1), 0, 0, NULL FROM docs""",
)
def s3d(fx):
    """One document per route, read back variant by variant."""
    docs = fx.view("route_docs")
    whole = dc.route_documents(dc.flatten_route_variants(fx.view("variant_docs")), dc.flatten_route_stops(docs), dc.flatten_route_paths(docs))
    each = whole.select("route_id", F.size("variants").cast("long").alias("variants"), F.explode("stops").alias("variant_key", "s"), "paths")
    path = F.try_element_at("paths", F.col("variant_key"))
    return each.select("route_id", "variants", "variant_key", F.size("s").cast("long").alias("stops"), F.size(path).cast("long").alias("points"), F.get(path, F.lit(1))["lat"].alias("second_lat"))


@check("S19_usable_documents", "SELECT route_id, direction, variant_id FROM v_route_docs WHERE status = 200 AND trim(stops_json) NOT IN ('', 'null', '[]', '{}')")
def s19(fx):
    return dc.usable_documents(fx.view("route_docs")).select("route_id", "direction", "variant_id")


@check("S19_split_usable", "SELECT CASE WHEN status = 200 AND trim(stops_json) NOT IN ('', 'null', '[]', '{}') THEN 'have_data' ELSE 'no_data' END AS outcome, count(*) AS documents FROM v_route_docs GROUP BY 1")
def s19b(fx):
    return dc.split_usable(fx.view("route_docs"))


@check(
    "S20_upsert",
    """SELECT route, stop, time, seq, passengers FROM (SELECT route, stop, time, seq, passengers FROM v_demand_raw)
    QUALIFY row_number() OVER (PARTITION BY route, stop, time ORDER BY seq DESC) = 1""",
)
def s20(fx):
    cols = ["route", "stop", "time", "seq", "passengers"]
    older = fx.demand_raw.where(F.col("time") < F.lit("2024-01-20").cast("timestamp_ntz")).select(*cols)
    return tb.upsert(older, fx.demand_raw.select(*cols), C.DEMAND_KEYS, "seq")


@check(
    "S20_upsert_table",
    """SELECT time, route AS route_id, bus_id, round(CASE WHEN time >= TIMESTAMP '2024-01-20 00:00:00' THEN speed + 1 ELSE speed END, 6) AS speed
    FROM v_gps QUALIFY row_number() OVER (PARTITION BY time, bus_id ORDER BY seq) = 1""",
)
def s20b(fx):
    db = _database(fx)
    tb.create_tables(fx.spark, db)
    from transit_spark.operators.cleaning import dedupe_first

    gps = dedupe_first(fx.gps, ["time", "bus_id"], ["seq"])
    tb.save_table(gps, f"{db}.gps_traces")
    late = gps.where(F.col("time") >= F.lit("2024-01-20").cast("timestamp_ntz")).withColumn("speed", F.col("speed") + 1)
    tb.upsert_table(late, f"{db}.gps_traces")
    return rounded(fx.spark.table(f"{db}.gps_traces").select("time", "route_id", "bus_id", "speed"))


# --- streams ------------------------------------------------------------------------------------


@check(
    "M1_stream_clean",
    """SELECT seq, route, stop, time, CASE WHEN passengers < 0 THEN 0 ELSE passengers END AS passengers FROM v_demand_raw
    WHERE coalesce(boarding_count <= 200, true) AND coalesce(alighting_count <= 200, true) AND coalesce(passengers <= 200, true)""",
)
def m1(fx):
    return st.run_once(st.stream_clean(fx.stream("demand_raw")), fx.fresh_dir()).select("seq", "route", "stop", "time", "passengers")


@check("M2_stream_dedupe", "SELECT DISTINCT route, stop, time FROM v_demand_raw")
def m2(fx):
    out = st.run_once(st.stream_dedupe(fx.stream("demand_raw")), fx.fresh_dir())
    return out.select("route", "stop", F.col("time").cast("timestamp_ntz").alias("time"))


def _closed(size: int, slide: int | None = None) -> str:
    """Windows the watermark (30 minutes behind the newest time) has closed."""
    step = slide or size
    starts = f"unnest(range(0, {size // step}))"
    return f"""SELECT w AS window_start, w + INTERVAL {size} MINUTE AS window_end, route, CAST(sum(passengers) AS BIGINT) AS total_demand, count(*) AS n FROM (
      SELECT route, passengers, time_bucket(INTERVAL '{step} minutes', time) - to_minutes(CAST({starts} * {step} AS INT)) AS w FROM v_demand_raw)
      WHERE w + INTERVAL {size} MINUTE <= (SELECT max(time) - INTERVAL 30 MINUTE FROM v_demand_raw) GROUP BY ALL"""


def _windows(fx, *args):
    out = st.run_once(st.stream_demand(fx.stream("demand_raw"), *args), fx.fresh_dir())
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@check("M3_stream_tumbling", _closed(15))
def m3(fx):
    return _windows(fx, "15 minutes")


@check("M3_stream_sliding", _closed(30, 15))
def m3b(fx):
    return _windows(fx, "30 minutes", "15 minutes")


@check("M4_stream_enrich", f"SELECT seq, d.route, d.stop, s.stop_order, {r6('s.latitude').replace('AS s.', 'AS ')} FROM v_demand_raw d LEFT JOIN v_stops s ON s.route = d.route AND s.stop = d.stop")
def m4(fx):
    enriched = st.stream_enrich(fx.stream("demand_raw"), fx.stops)
    return rounded(st.run_once(enriched, fx.fresh_dir()).select("seq", "route", "stop", "stop_order", "latitude"))


VALID_SQL = """SELECT seq, route, stop, time, CASE WHEN passengers < 0 THEN 0 ELSE passengers END AS passengers FROM v_demand_raw
    WHERE coalesce(boarding_count <= 200, true) AND coalesce(alighting_count <= 200, true) AND passengers <= 200 AND boarding_count IS NOT NULL AND alighting_count IS NOT NULL"""


def _latest(fx, model, length: int):
    stream = st.stream_clean(fx.stream("demand_raw")).na.drop()
    out = st.run_once(st.stream_latest(stream, model, ["passengers"], length), fx.fresh_dir())
    return out.withColumn("time", F.col("time").cast("timestamp_ntz"))


@check("M5_stream_latest")
def m5(fx):
    """Scores of the last full window per stop, its rows kept in the state store."""
    w = stage(fc.windows(fx.demand, ["passengers"], 12, 2, 1, ["route", "stop"]))
    return rounded(_latest(fx, fc.fit_forecaster(w), 12), 4)


@check(
    "M5_stream_latest_line",
    f"""SELECT route, stop, time, round(a + b * passengers, 4) AS prediction FROM
      (SELECT * FROM ({VALID_SQL}) QUALIFY row_number() OVER (PARTITION BY route, stop ORDER BY time DESC, seq DESC) = 1), ({GLOBAL_LINE})""",
)
def m5b(fx):
    """The line's score of the last value of each stop, as the stream leaves it."""
    w = stage(fc.windows(fx.demand, ["passengers"], 1, 1, 1, ["route", "stop"]))
    return rounded(_latest(fx, fc.fit_forecaster(w), 1), 4)


@check(
    "M5_stream_windows",
    f"""SELECT route, stop, max(time) AS time, CAST(sum(passengers) AS DOUBLE) AS window_sum, CAST(arg_min(passengers, (time, seq)) AS DOUBLE) AS oldest FROM (
      SELECT * FROM ({VALID_SQL}) QUALIFY row_number() OVER (PARTITION BY route, stop ORDER BY time DESC, seq DESC) <= 12) GROUP BY ALL HAVING count(*) = 12""",
)
def m5c(fx):
    """The last twelve rows of each stop, out of the state store."""
    stream = st.event_time(st.stream_clean(fx.stream("demand_raw")).na.drop()).withWatermark("time", "30 minutes")
    kept = st.run_once(st.keep_latest(stream, ["passengers"], 12), fx.fresh_dir())
    flat = F.flatten("x")
    total = F.aggregate(flat, F.lit(0.0), lambda a, v: a + v)
    return kept.select("route", "stop", F.col("time").cast("timestamp_ntz").alias("time"), total.alias("window_sum"), F.get(flat, F.lit(0)).alias("oldest"))


def _forecasts_and_actuals(fx):
    raw = fx.stream("demand_raw")
    # One series per row, so that every forecast meets exactly its own actual value.
    made = raw.select("route", "stop", "seq", "time", plus_minutes("time", -30).alias("created_at"), F.col("boarding_count").cast("double").alias("predicted"))
    return made, fx.stream("demand_raw").select("route", "stop", "seq", "time", "passengers").where(F.col("passengers").isNotNull())


@check(
    "M6_stream_feedback",
    """SELECT route, stop, time, seq, CAST(passengers AS DOUBLE) AS actual, CAST(boarding_count AS DOUBLE) AS predicted, CAST(passengers - boarding_count AS DOUBLE) AS error
    FROM v_demand_raw WHERE passengers IS NOT NULL""",
)
def m6(fx):
    made, seen = _forecasts_and_actuals(fx)
    out = st.run_once(st.stream_feedback(made, seen, keys=("route", "stop", "seq")), fx.fresh_dir())
    return out.select("route", "stop", F.col("time").cast("timestamp_ntz").alias("time"), "seq", "actual", "predicted", "error")


@check("M6_feedback_summary", f"SELECT route, count(*) AS n, round(avg(abs_error),6) AS mae, {significant_sql('avg(pct_error)')} AS mape, avg(pct_error) > 15 AS retrain FROM v_errors GROUP BY route")
def m6b(fx):
    from transit_spark.operators.evaluation import error_frame

    return st.feedback_summary(error_frame(fx.forecast)).select("route", "n", F.round("mae", 6).alias("mae"), significant("mape"), "retrain")


DRIFT_SQL = """SELECT route, window_start, n, round(mae, 4) AS mae, round(total - least(0, min(total) OVER g), 3) AS drift, total - least(0, min(total) OVER g) > 500 AS retrain FROM (
      SELECT *, sum(mae - 90) OVER g AS total FROM (
        SELECT route, date_trunc('day', time) AS window_start, count(*) AS n, avg(abs(passengers - boarding_count))::DOUBLE AS mae FROM v_demand_raw
        WHERE passengers IS NOT NULL AND date_trunc('day', time) + INTERVAL 1 DAY <= (SELECT max(time) - INTERVAL 1 HOUR FROM v_demand_raw WHERE {upto}) GROUP BY ALL)
      WINDOW g AS (PARTITION BY route ORDER BY window_start)) WINDOW g AS (PARTITION BY route ORDER BY window_start)"""


@check("M6_stream_drift", DRIFT_SQL.format(upto="passengers IS NOT NULL"))
def m6c(fx):
    """Daily error of forecasts that met their actual values on the stream, and its cumulative excess."""
    made, seen = _forecasts_and_actuals(fx)
    out = st.watch_forecasts(made, seen, fx.fresh_dir(), 85.0, 500.0, 5.0, "1 day", series=("route", "stop", "seq"))
    out = out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    return out.select("route", "window_start", "n", F.round("mae", 4).alias("mae"), F.round("drift", 3).alias("drift"), "retrain")


@check(
    "M7_freshness",
    """SELECT count(*) AS n, round(avg(s),6) AS mean_lag, max(s) AS max_lag, round(quantile_cont(s, 0.95),6) AS p95_lag,
      round(CAST(date_diff('microsecond', max(time), TIMESTAMP '2024-02-01 00:00:00') AS DOUBLE) / 1000000, 6) AS age
    FROM (SELECT time, CAST(date_diff('microsecond', time, stored_at) AS DOUBLE) / 1000000 AS s FROM v_arrivals)""",
)
def m7(fx):
    return rounded(st.freshness(fx.view("arrivals"), "time", "stored_at", "2024-02-01 00:00:00"))


# --- flows --------------------------------------------------------------------------------------

FEATURES = [
    "hour", "day_of_week", "month", "week_of_year", "is_weekend", "is_peak_hour", "time_of_day", "is_holiday", "rush_hour_intensity",
    "stop_order", "total_stops", "route_progress", "distance_to_next_stop", "temperature", "humidity", "rain_mm", "conditions",
    "is_raining", "rain_intensity", "temp_category", "heat_index", "nearby_events", "event_impact_factor", "is_commute_time",
]
ROUNDED = {"rush_hour_intensity", "route_progress", "distance_to_next_stop", "temperature", "humidity", "rain_mm", "heat_index", "event_impact_factor"}


@check("P1_demand_features", "SELECT seq, route, stop, time, passengers, " + ", ".join(r6(c) if c in ROUNDED else c for c in FEATURES) + " FROM v_context")
def p1(fx):
    df = flows.process_demand(fx.demand_raw, fx.stops, fx.weather, fx.city, normalize=False).data
    return rounded(df.select("seq", "route", "stop", "time", "passengers", *FEATURES))


def _mm(c: str) -> str:
    return f"round((v.{c} - p.{c}_lo) / CASE WHEN p.{c}_hi = p.{c}_lo THEN 1 ELSE p.{c}_hi - p.{c}_lo END, 6) + 0.0 AS {c}"


SCALED = [c for c in FEATURES if c not in ("time_of_day", "conditions", "rain_intensity", "temp_category")]
CODES = ["time_of_day", "conditions", "rain_intensity", "temp_category"]


@check(
    "P1_process_demand",
    "SELECT v.seq, v.passengers, "
    + ", ".join(_mm(c) for c in SCALED)
    + ", "
    + ", ".join(f"CAST((SELECT count(DISTINCT coalesce(u.{c}, 'nan')) FROM v_context u WHERE coalesce(u.{c}, 'nan') < coalesce(v.{c}, 'nan')) AS INT) AS {c}" for c in CODES)
    + " FROM v_context v, (SELECT "
    + ", ".join(f"CAST(min({c}) AS DOUBLE) AS {c}_lo, CAST(max({c}) AS DOUBLE) AS {c}_hi" for c in SCALED)
    + " FROM v_context) p",
)
def p1b(fx):
    df = flows.process_demand(fx.demand_raw, fx.stops, fx.weather, fx.city).data
    return rounded(df.select("seq", "passengers", *SCALED, *CODES))


@check(
    "P2_process_gps",
    "SELECT seq, route, bus_id, time, CAST(hour(time) AS INT) AS hour, "
    + ", ".join(f"round((v.{c} - p.{c}_lo) / (p.{c}_hi - p.{c}_lo), 9) + 0.0 AS {c}" for c in C.GPS_NUMERIC)
    + " FROM v_gps v, (SELECT " + ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in C.GPS_NUMERIC) + " FROM v_gps) p",
)
def p2(fx):
    return rounded(flows.process_gps(fx.gps_raw).data.select("seq", "route", "bus_id", "time", "hour", *C.GPS_NUMERIC), 9)


def _dataset(fx, **options):
    routes = fx.stops.groupBy("route").agg(F.count(F.lit(1)).cast("int").alias("num_stops")).withColumn("num_buses", F.lit(3))
    return flows.process_dataset(routes, fx.stops, fx.demand_raw, fx.gps_raw, fx.weather_raw, fx.city_raw, **options)


@check(
    "P3_process_dataset",
    """SELECT 'routes' AS stage, count(DISTINCT route) AS records FROM v_stops UNION ALL SELECT 'stops', count(*) FROM v_stops UNION ALL SELECT 'weather', count(*) FROM v_weather
    UNION ALL SELECT 'events', count(*) FROM v_city UNION ALL SELECT 'demand', count(*) FROM v_context UNION ALL SELECT 'gps', count(*) FROM v_gps""",
)
def p3(fx):
    path = fx.fresh_dir()
    tables = _dataset(fx, path=path, fmt="parquet").tables
    saved = {n: fx.spark.read.parquet(f"{path}/processed_{n}.parquet") for n in tables}
    return flows.stage_counts(saved).select("stage", "records")


@check(
    "P1_lagged_features",
    """SELECT seq, hour, lag(passengers, 1) OVER w AS passengers_lag_1, lag(passengers, 3) OVER w AS passengers_lag_3, round(avg(passengers) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS passengers_rolling_mean_3,
      round(stddev_samp(passengers) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS passengers_rolling_std_3, nearby_events FROM v_context WINDOW w AS (PARTITION BY route, stop ORDER BY time)""",
)
def p1c(fx):
    """The flow with lags and rolling means of the target."""
    df = flows.process_demand(fx.demand_raw, fx.stops, fx.weather, fx.city, normalize=False, lags=[1, 3], windows=[3]).data
    return rounded(df.select("seq", "hour", "passengers_lag_1", "passengers_lag_3", "passengers_rolling_mean_3", "passengers_rolling_std_3", "nearby_events"))


@check(
    "P3_process_files",
    """SELECT 'routes' AS stage, count(DISTINCT route) AS records, 0::BIGINT AS passengers FROM v_stops UNION ALL SELECT 'stops', count(*), 0 FROM v_stops UNION ALL SELECT 'weather', count(*), 0 FROM v_f_weather_temp
    UNION ALL SELECT 'events', count(*), 0 FROM v_f_city UNION ALL SELECT 'demand', count(*), CAST(sum(passengers) AS BIGINT) FROM v_f_demand UNION ALL SELECT 'gps', count(*), 0 FROM v_f_gps""",
)
def p3b(fx):
    """From CSV files to cleaned and scaled files."""
    source, path = fx.fresh_dir(), fx.fresh_dir()
    routes = fx.stops.groupBy("route").agg(F.count(F.lit(1)).cast("int").alias("num_stops")).withColumn("num_buses", F.lit(3))
    demand = fx.demand_raw.drop("seq").withColumns({c: F.lit(0) for c in ("hour", "day_of_week", "is_weekend", "is_peak_hour")})
    city = fx.city_raw.withColumn("location", F.lit("centre"))
    tb.write_tables({"routes": routes, "stops": fx.stops, "demand": demand, "gps": fx.gps_raw.drop("seq"), "weather": fx.weather_raw.drop("seq"), "events": city}, source)
    tables = flows.process_files(fx.spark, source, path, fmt="parquet").tables
    saved = {n: fx.spark.read.parquet(f"{path}/processed_{n}.parquet") for n in tables}
    counted = flows.stage_counts(saved).select("stage", "records")
    riders = saved["demand"].agg(F.sum("passengers")).first()[0]
    return counted.withColumn("passengers", F.when(F.col("stage") == "demand", F.lit(riders)).otherwise(F.lit(0)).cast("long"))


@check(
    "P4_stage_statistics",
    """SELECT *, true AS timed FROM (SELECT 'demand' AS stage, (SELECT count(*) FROM v_context) AS records UNION ALL SELECT 'gps', (SELECT count(*) FROM v_gps) UNION ALL SELECT 'weather', (SELECT count(*) FROM v_weather)
    UNION ALL SELECT 'events', (SELECT count(*) FROM v_city) UNION ALL SELECT 'stops', (SELECT count(*) FROM v_stops) UNION ALL SELECT 'routes', (SELECT count(DISTINCT route) FROM v_stops))""",
)
def p4(fx):
    """Rows per stage, and whether each stage's own seconds are positive and all of them fit into the run."""
    start = clock.monotonic()
    stats = _dataset(fx, path=fx.fresh_dir(), fmt="parquet", normalize=False).stats
    whole = sum(s["seconds"] for s in stats.values()) <= clock.monotonic() - start
    return fx.spark.createDataFrame([(n, s["records"], whole and s["seconds"] > 0) for n, s in stats.items()], "stage string, records bigint, timed boolean")
