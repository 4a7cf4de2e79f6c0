"""Transit tables derived from the driver's tables, as one SQL text for both engines.

``{...}`` tokens are the few spellings that differ. Every view is built row by row from a whole
table, so its size follows the table's.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from transit_spark.session import stage, work_dir

SPARK = {
    "S": "STRING",
    "TS": "TIMESTAMP_NTZ",
    "B15": "(CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) + make_dt_interval(0, hour(ts), (minute(ts) div 15) * 15, 0))",
    "H": "(CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) + make_dt_interval(0, hour(ts), 0, 0))",
    "M": "(CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) + make_dt_interval(0, hour(ts), minute(ts), 0))",
    "HRS": "make_dt_interval(0, CAST(event_id % 13 AS INT), 0, 0)",
    "LAG": "make_dt_interval(0, 0, CAST(event_id % 9 AS INT), 0)",
}
DUCK = {
    "S": "VARCHAR",
    "TS": "TIMESTAMP",
    "B15": "time_bucket(INTERVAL '15 minutes', ts)",
    "H": "date_trunc('hour', ts)",
    "M": "date_trunc('minute', ts)",
    "HRS": "to_hours(CAST(event_id % 13 AS INT))",
    "LAG": "to_minutes(CAST(event_id % 9 AS INT))",
}

VIEWS = {
    "demand_raw": (
        "events",
        """SELECT event_id AS seq, 'R_'||event_type AS route,
            'R_'||event_type||'_Stop_'||CAST(user_id % 5 + 1 AS {S}) AS stop, {B15} AS time,
            CAST(floor(value/2) AS INT) AS boarding_count,
            CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(floor(value) AS INT) - 5 - CAST(floor(value/2) AS INT) END AS alighting_count,
            CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(floor(value) AS INT) - 5 END AS passengers
        FROM {events}""",
    ),
    "demand_text": (
        "events",
        """SELECT event_id AS seq, 'R_'||event_type AS route,
            CASE WHEN event_id % 11 = 0 THEN 'not a time' ELSE CAST({B15} AS {S}) END AS time_text
        FROM {events}""",
    ),
    "gps_raw": (
        "events",
        """SELECT event_id AS seq, 'R_'||event_type AS route,
            'R_'||event_type||'_Bus_'||CAST(user_id % 3 + 1 AS {S}) AS bus_id, {M} AS time,
            CAST(9.9 AS DOUBLE) + CAST(event_id % 170 AS DOUBLE)/100 AS latitude,
            CAST(105.9 AS DOUBLE) + CAST((event_id*7) % 170 AS DOUBLE)/100 AS longitude,
            CASE WHEN event_id % 19 = 0 THEN NULL ELSE value - 10 END AS speed,
            CAST((event_id*37) % 360 AS DOUBLE) AS heading
        FROM {events}""",
    ),
    "weather_raw": (
        "events",
        """SELECT event_id AS seq, {B15} AS time,
            CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(14 AS DOUBLE) + CAST((event_id*13) % 330 AS DOUBLE)/10 END AS temperature,
            CAST(38 AS DOUBLE) + CAST((event_id*17) % 660 AS DOUBLE)/10 AS humidity,
            CAST(CASE event_id % 8 WHEN 0 THEN 0.5 WHEN 4 THEN 2 WHEN 2 THEN 6 ELSE 0 END AS DOUBLE) AS rain_mm,
            CAST(2 + event_id % 7 AS DOUBLE) AS wind_speed,
            CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'Rain' ELSE 'Clear' END AS conditions
        FROM {events}""",
    ),
    "city_raw": (
        "events",
        """SELECT event_id, 'Event '||CAST(event_id % 7 AS {S}) AS name,
            CASE user_id % 5 WHEN 0 THEN 'concert' WHEN 1 THEN 'festival' WHEN 2 THEN 'sports' WHEN 3 THEN 'conference' ELSE 'traffic_jam' END AS event_type,
            CAST(9.9 AS DOUBLE) + CAST(event_id % 170 AS DOUBLE)/100 AS latitude,
            CAST(105.9 AS DOUBLE) + CAST((event_id*7) % 170 AS DOUBLE)/100 AS longitude,
            {H} AS start_time, {H} + {HRS} AS end_time,
            CAST(100 + user_id*1000 AS INT) AS expected_attendance,
            CAST(1 AS DOUBLE) + CAST(100 + user_id*1000 AS DOUBLE)/50000*CAST(0.5 AS DOUBLE) AS impact_factor
        FROM {events}""",
    ),
    "arrivals": (
        "events",
        """SELECT event_id AS seq, 'R_'||event_type AS route, ts AS time, ts + {LAG} AS stored_at FROM {events}""",
    ),
    "stops": (
        "events",
        """SELECT DISTINCT 'R_'||event_type AS route, 'R_'||event_type||'_Stop_'||CAST(user_id % 5 + 1 AS {S}) AS stop,
            CAST(user_id % 5 + 1 AS INT) AS stop_order,
            CAST(10.75 AS DOUBLE) + CAST(0.015 AS DOUBLE)*CAST(user_id % 5 AS DOUBLE) + CAST(length(event_type) AS DOUBLE)/1000 AS latitude,
            CAST(106.65 AS DOUBLE) + CAST(0.025 AS DOUBLE)*CAST(user_id % 5 AS DOUBLE) - CAST(length(event_type) AS DOUBLE)/1000 AS longitude
        FROM {events}""",
    ),
    "members": (
        "events",
        """SELECT event_id AS seq, value AS m1, value + CAST(user_id % 7 AS DOUBLE) AS m2, value - CAST(user_id % 3 AS DOUBLE) AS m3
        FROM {events}""",
    ),
    "route_docs": (
        "orders",
        """SELECT o_orderkey AS route_id, CAST(1 + o_orderkey % 2 AS INT) AS direction, o_custkey AS variant_id,
            CASE o_orderstatus WHEN 'F' THEN 404 ELSE 200 END AS status,
            CASE o_orderstatus WHEN 'F' THEN 'null' WHEN 'P' THEN ' [] ' ELSE
              '[{{"Name":"Stop '||CAST(o_custkey AS {S})||'","Code":"C'||CAST(o_custkey AS {S})||'","Lat":10.'||CAST(10 + o_custkey % 90 AS {S})||
              ',"Lng":106.'||CAST(10 + o_custkey % 80 AS {S})||',"AddressNo":"'||CAST(o_custkey % 50 AS {S})||'","Street":"Main","Routes":"1, 2","Status":"Active","StopType":"Pole"}},'||
              '{{"Name":"Stop '||CAST(o_orderkey AS {S})||'","Code":"C'||CAST(o_orderkey AS {S})||'","Lat":10.'||CAST(10 + o_orderkey % 90 AS {S})||
              ',"Lng":106.'||CAST(10 + o_orderkey % 80 AS {S})||',"AddressNo":"'||CAST(o_orderkey % 50 AS {S})||'","Street":"'||o_orderpriority||'","Routes":"1","Status":"Active","StopType":"Shelter"}}]' END AS stops_json,
            CASE o_orderstatus WHEN 'F' THEN 'null' WHEN 'P' THEN '{{"lat":[],"lng":[]}}' ELSE
              '{{"lat":[10.'||CAST(10 + o_custkey % 90 AS {S})||',10.5,10.'||CAST(10 + o_orderkey % 90 AS {S})||'],"lng":[106.'||CAST(10 + o_custkey % 80 AS {S})||',106.5,106.'||CAST(10 + o_orderkey % 80 AS {S})||']}}' END AS path_json
        FROM {orders}""",
    ),
    "variant_docs": (
        "orders",
        """SELECT o_orderkey AS route_id, CAST(1 + o_orderkey % 2 AS INT) AS direction,
            CASE o_orderstatus WHEN 'F' THEN 'null' ELSE
              '[{{"RouteId":"'||CAST(o_orderkey AS {S})||'","RouteVarId":'||CAST(o_custkey AS {S})||',"RouteVarName":"To '||o_orderpriority||'","Distance":'||CAST(1000 + o_custkey AS {S})||'.5,"RunningTime":'||CAST(30 + o_custkey % 40 AS {S})||'}},'||
              '{{"RouteVarId":'||CAST(o_custkey + 1 AS {S})||',"StartStop":"Alpha","EndStop":"Stop '||CAST(o_custkey AS {S})||'","Distance":900,"RunningTime":25}}]' END AS vars_json
        FROM {orders}""",
    ),
    "weather_docs": (
        "events",
        """SELECT event_id AS id, '{{"dt_txt":"2024-01-'||lpad(CAST(1 + event_id % 28 AS {S}), 2, '0')||' '||lpad(CAST(event_id % 24 AS {S}), 2, '0')||':00:00",'||
            '"main":{{"temp":'||CAST(20 + event_id % 15 AS {S})||'.5,"humidity":'||CAST(50 + event_id % 50 AS {S})||',"pressure":1010}},"wind":{{"speed":'||CAST(user_id % 9 AS {S})||'.25}}'||
            CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 4 = 1 THEN ',"weather":[]' ELSE ',"weather":[{{"main":"'||event_type||'","description":"some '||event_type||'"}}]' END||
            CASE WHEN event_id % 3 = 0 THEN ',"rain":{{"1h":0.4,"3h":'||CAST(event_id % 5 AS {S})||'.5}},"clouds":{{"all":75}},"pop":0.6' ELSE '' END||'}}' AS doc
        FROM {events}""",
    ),
    "route_pages": (
        "orders",
        """SELECT o_orderkey AS page_id, CASE o_orderstatus WHEN 'P' THEN '<p>no data</p>' ELSE
            '<div id="rouInfo"><ul><li>Distance: '||CAST(o_custkey AS {S})||' km</li><li class="x">Vehicle: <b>'||o_orderpriority||'</b> &amp; more</li>'||
            CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '<li> Fare: '||CAST(o_orderkey AS {S})||' </li>' END||'</ul></div>'||
            '<h3>To North</h3><table><tr class="rowStop"><td><div>A</div></td><td>Stop '||CAST(o_custkey AS {S})||'</td></tr>'||
            '<tr class="rowStop"><td><div>1</div></td><td> Stop '||CAST(o_orderkey AS {S})||' </td></tr>'||
            '<tr class="rowStop"><td><div>1</div></td><td>Stop '||CAST(o_orderkey AS {S})||'</td></tr>'||
            '<tr class="rowStop"><td><div>B</div></td><td>'||o_orderpriority||'</td></tr></table>'||
            '<h3>To <i>South</i></h3><table><tr class="rowStop"><td><div>A</div></td><td>Gamma</td></tr><tr class="rowStop"><td><div>B</div></td><td> </td></tr></table>'||
            '<h2>Times</h2><table><tr><td>1</td><td>Alpha</td><td>x</td><td>05:'||lpad(CAST(o_custkey % 60 AS {S}), 2, '0')||'-06:35</td></tr>'||
            '<tr><td>2</td><td>Beta '||CAST(o_custkey AS {S})||'</td><td>06:10</td><td>07:00</td></tr><tr><td>3</td><td>Gamma</td><td>08:00</td></tr></table>' END AS html
        FROM {orders}""",
    ),
    "list_pages": (
        "orders",
        """SELECT o_orderkey AS page_id, '<html><script>if (a < b) {{ write("<div id=divResult>") }}</script><div class="menu"><a class="cms-button" href="/menu">Menu</a></div>'||
            CASE o_orderstatus WHEN 'P' THEN '<p>nothing found' ELSE
            '<div class="wide" id="divResult"><div><img src="x.png"><a class="big cms-button" title="a > b" href="/r/'||CAST(o_custkey AS {S})||'"><span class="icon">7</span><div class="routetrip"> North '||CAST(o_custkey AS {S})||' </div></a></div>'||
            '<a class="plain" href="/no">no</a><a class="cms-button">no place</a>'||
            CASE o_orderstatus WHEN 'F' THEN '' ELSE '<div><div><a href=http://other.example/'||CAST(o_orderkey AS {S})||' class=''cms-button''><span class="icon">08</span><div class="routetrip">'||o_orderpriority||'</div></a></div></div>' END||
            '</div><a class="cms-button" href="/after">After</a><table class="tbl100"><tr><td>Operator</td><td>someone else</td></tr></table>'||
            '<div id="rouInfo"><div>head</div><table class="a tbl100"><tr><td><b>Operator</b></td><td>Company '||CAST(o_custkey AS {S})||'</td></tr>'||
            '<tr><td>Facts</td><td><ul><li>Distance: '||CAST(o_custkey AS {S})||' km</li></ul></td><td><ul><li>Fare: '||o_orderpriority||'</li></ul></td></tr></table></div>' END||'</html>' AS html
        FROM {orders}""",
    ),
}


class _Tables(dict):
    """Leaves ``{table}`` in place for Spark, fills in the plain name for DuckDB."""

    def __init__(self, values, keep: bool):
        super().__init__(values)
        self.keep = keep

    def __missing__(self, key):
        return "{" + key + "}" if self.keep else key


def duck_view(name: str) -> str:
    return VIEWS[name][1].format_map(_Tables(DUCK, keep=False))


def spark_view(spark: SparkSession, name: str, source: DataFrame) -> DataFrame:
    table, text = VIEWS[name]
    source_sql = text.format_map(_Tables(SPARK | {table: "__source__"}, keep=False))
    view = f"src_{uuid.uuid4().hex}"
    source.createOrReplaceTempView(view)
    try:
        return spark.sql(source_sql.replace("__source__", view))
    finally:
        spark.catalog.dropTempView(view)


#: Views whose rows are few bytes in the source and costly to evaluate: their source's rows are dealt anew, so that all
#: cores take part, however few splits the file has.
SPREAD = ("route_pages", "list_pages")
TASKS_PER_CORE = 4


class Fixtures:
    """The driver's tables and the views derived from them, as lazy frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        rows = self.table(VIEWS[name][0])
        if name in SPREAD:
            rows = rows.repartition(TASKS_PER_CORE * self.spark.sparkContext.defaultParallelism)
        return spark_view(self.spark, name, rows)

    def stream(self, name: str) -> DataFrame:
        """The view over a stream of its source table's files."""
        source = VIEWS[name][0]
        schema = self.table(source).schema
        reader = self.spark.readStream.schema(schema).option("pathGlobFilter", f"{source}.parquet")
        return spark_view(self.spark, name, reader.parquet(self.sf_dir))

    def fresh_dir(self) -> str:
        return work_dir(self.spark)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def pages(self) -> DataFrame:
        return self.table("pages")

    @cached_property
    def demand_raw(self) -> DataFrame:
        return self.view("demand_raw")

    @cached_property
    def gps_raw(self) -> DataFrame:
        return self.view("gps_raw")

    @cached_property
    def weather_raw(self) -> DataFrame:
        return self.view("weather_raw")

    @cached_property
    def city_raw(self) -> DataFrame:
        return self.view("city_raw")

    @cached_property
    def stops(self) -> DataFrame:
        return self.view("stops")

    @cached_property
    def demand(self) -> DataFrame:
        from transit_spark.operators.cleaning import clean_demand

        return clean_demand(self.demand_raw)

    @cached_property
    def gps(self) -> DataFrame:
        from transit_spark.operators.cleaning import clean_gps

        return clean_gps(self.gps_raw)

    @cached_property
    def weather(self) -> DataFrame:
        from transit_spark.operators.cleaning import clean_weather

        return clean_weather(self.weather_raw)

    @cached_property
    def city(self) -> DataFrame:
        from transit_spark.operators.cleaning import clean_events

        return clean_events(self.city_raw)

    @cached_property
    def forecast(self) -> DataFrame:
        """Cleaned demand with the previous value of the stop as its forecast."""
        from pyspark.sql import functions as F

        from transit_spark.operators.series import lag_features

        lagged = lag_features(self.demand, "passengers", [1], ["route", "stop"], ["time"])
        pairs = lagged.select(
            "route", "stop", "time", "seq",
            F.col("passengers").cast("double").alias("actual"),
            F.col("passengers_lag_1").cast("double").alias("predicted"),
        )
        # Forecasts are a stored table; scores read them several times.
        return stage(pairs)

    @cached_property
    def slot_input(self) -> DataFrame:
        """(route, time, predicted_demand): a quarter of the route's demand per slot."""
        from pyspark.sql import functions as F

        return self.demand.groupBy("route", "time").agg(
            F.floor(F.sum("passengers") / 4).cast("int").alias("predicted_demand")
        )
