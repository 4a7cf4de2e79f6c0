"""Cases that no fixture reaches: odd files, odd markup, missing values, high latitudes, hot borders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from transit_spark.functions.temporal import temporal_features
from transit_spark.functions.text import unescape_html
from transit_spark.operators import cleaning as cl
from transit_spark.operators import context as cx
from transit_spark.operators import scaling as nm
from transit_spark.operators import schedule as sc
from transit_spark.operators import series as sr
from transit_spark.operators import summary as su
from transit_spark.sources import pages as pg
from transit_spark.sources import tables as tb
from transit_spark.streaming import jobs


@pytest.mark.parametrize("classes", [3, 1500])
def test_encode_has_one_path(spark, classes):
    df = spark.range(classes).select(F.col("id").cast("string").alias("c"), F.lit("x").alias("d"))
    labels = nm.fit_labels(df, ["c"])
    with pytest.raises(ValueError, match="no labels"):
        nm.encode(df, labels, ["c", "d"])
    codes = {r["c"] for r in nm.encode(df, labels, ["c"]).collect()}
    assert codes == set(range(classes))
    assert nm.encode(spark.createDataFrame([("unseen", "x")], "c string, d string"), labels).first()["c"] == 0


def test_one_hot_refuses_too_many_categories(spark):
    with pytest.raises(ValueError, match="more than 5"):
        nm.one_hot(spark.range(7).select(F.col("id").cast("string").alias("c")), ["c"], most=5)


def test_nan_is_missing_on_the_stream_too(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(nan, 10.8, 106.7), (200.0, nan, 106.7), (5.0, 0.0, 106.7)], "speed double, latitude double, longitude double")
    found = jobs.stream_clean(rows).collect()
    assert [r["speed"] for r in found] == [None, 80.0]
    assert found[1]["latitude"] is None
    assert [r["speed"] for r in cl.clip(rows, "speed", 0.0, 80.0).collect()] == [None, 80.0, 5.0]
    assert cl.drop_outside(rows, "latitude", 1.0, 90.0).count() == 2


@pytest.mark.parametrize("latitude", [0.0, 21.0, 60.0, -75.0, 89.99])
def test_every_stop_within_reach_is_found(spark, latitude):
    when = dt.datetime(2024, 1, 1, 12)
    around = [(-0.015, 0.0), (0.015, 0.0), (0.0, 0.012), (0.0, -0.012), (0.004, 0.017), (0.0, 0.05)]
    import math

    stretch = 1 / max(math.cos(math.radians(latitude)), 1e-3)
    stops = [("r", f"s{i}", latitude + a if latitude + a <= 90 else latitude - a, 179.999 + b * stretch) for i, (a, b) in enumerate(around)]
    stops = spark.createDataFrame([(r, s, la, (lo + 180) % 360 - 180) for r, s, la, lo in stops], "route string, stop string, latitude double, longitude double")
    venue = spark.createDataFrame([(latitude, 179.999, when - dt.timedelta(hours=1), when + dt.timedelta(hours=1))], "latitude double, longitude double, start_time timestamp_ntz, end_time timestamp_ntz")
    df = stops.select("route", "stop", F.lit(when).cast("timestamp_ntz").alias("time"))
    far = stops.select("stop", cx.haversine(F.col("latitude"), F.col("longitude"), F.lit(latitude), F.lit(179.999)).alias("km"))
    want = {r["stop"] for r in far.collect() if r["km"] <= 2.0}
    found = {r["stop"] for r in cx.event_proximity(df, stops, venue).where("event_nearby = 1").collect()}
    assert found == want and len(want) >= 4


def test_window_longer_than_a_chunk(spark, monkeypatch):
    rows = spark.range(60).select(F.lit("a").alias("k"), F.col("id"), (F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz")).alias("time"))
    placed = sr.with_positions(rows, ["k"], ["time"])
    chunked, window = sr.in_chunks(placed, ["k"], before=20, size=10)
    found = chunked.withColumn("back", F.lag("id", 20).over(window)).where("NOT _halo").collect()
    assert {r["id"]: r["back"] for r in found} == {i: (i - 20 if i >= 20 else None) for i in range(60)}


HTML = """<h3>Lượt đi</h3><table><tr id=x class='big rowStop'><td>A</td><td>&nbsp;Ben&#32;Thanh&nbsp;</td></tr>
<tr class="rowStop odd"><td>1</td><td>&nbsp;</td></tr><tr class=rowStop><td></td><td>Caf&#233; &amp; Bar&#x27;s</td></tr><tr class="rowStops"><td>9</td><td>no</td></tr></table>
<a class="x" href='/one'><span class='icon big'>1</span><div class="routetrip">One</div></a><a href=/two>Two</a><a HREF="http://x/?a=1&amp;b=2">Three</a><a name="n">none</a>"""


def test_markup_in_all_its_forms(spark):
    pages = spark.createDataFrame([(1, HTML)], "page_id long, html string")
    links = pg.extract_links(pages, "http://s").orderBy("position").collect()
    assert [(r["number"], r["name"], r["url"]) for r in links] == [("1", "One", "http://s/one"), ("", "Two", "http://s/two"), ("", "Three", "http://x/?a=1&b=2")]
    stops = {(r["stop_order"], r["stop_name"]) for r in pg.extract_stops(pages).collect()}
    assert stops == {("A", "Ben Thanh"), ("3", "Café & Bar's")}


def test_entities(spark):
    cases = {"a &lt;b&gt; &amp;lt; &#39;&#x41;&#xe9;&#128512;": "a <b> &lt; 'Aé😀", "&#0; &#9999999; &#xD800; &#;": "&#0; &#9999999; &#xD800; &#;", "&#38;lt; plain": "&lt; plain", "": ""}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", unescape_html(F.col("t")).alias("u")).collect()
    assert {r["t"]: r["u"] for r in rows} == cases


def test_trips_without_demand_serve_nobody(spark):
    demand = spark.createDataFrame([("r", dt.date(2024, 1, 1), 20, 30.0)], "route string, day date, slot int, demand double")
    plan = spark.createDataFrame([("r", s) for s in (4, 8, 20, 40, 60, 70)], "route string, slot int")
    found = sc.trip_loads(plan, demand).collect()
    assert len(found) == 6 and sum(r["served_passengers"] > 0 for r in found) >= 1
    assert all(r["served_passengers"] == 0 for r in found if r["slot"] in (40, 60, 70))


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "stops.csv").write_text("stop,extra,order,route,longitude,latitude\nS1,?,3,R1,106.5,10.5\n")
    row = tb.read_table(spark, str(tmp_path), "stops").first()
    assert row.asDict() == {"route": "R1", "stop": "S1", "stop_order": 3, "latitude": 10.5, "longitude": 106.5}
    (tmp_path / "routes.csv").write_text("route,num_stops\nR1,3\n")
    with pytest.raises(ValueError, match="num_buses"):
        tb.read_table(spark, str(tmp_path), "routes")


@pytest.fixture
def database(spark, tmp_path):
    name = f"findings_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_append_goes_by_name(spark, database):
    tb.save_table(spark.createDataFrame([(1, 2)], "x int, y int"), f"{database}.t", "replace")
    tb.save_table(spark.createDataFrame([(4, 3)], "y int, x int"), f"{database}.t")
    assert sorted(tuple(r) for r in spark.table(f"{database}.t").select("x", "y").collect()) == [(1, 2), (3, 4)]
    with pytest.raises(ValueError):
        tb.save_table(spark.createDataFrame([(4, 3)], "y int, z int"), f"{database}.t")


def test_upsert_without_days(spark, database):
    tb.create_tables(spark, database)
    name = f"{database}.stops"
    tb.upsert_table(spark.createDataFrame([("r", "a", 1), ("r", "b", 2)], "route string, stop string, order int"), name)
    tb.upsert_table(spark.createDataFrame([("r", "b", 9), ("q", "a", 5)], "route string, stop string, order int"), name)
    assert sorted((r["route_id"], r["stop_id"], r["stop_order"]) for r in spark.table(name).collect()) == [("q", "a", 5), ("r", "a", 1), ("r", "b", 9)]


def test_upsert_ties_are_settled(spark):
    at = dt.datetime(2024, 1, 1)
    now = spark.createDataFrame([("k", at, 5)], "k string, time timestamp_ntz, v int")
    new = spark.createDataFrame([("k", at, 9), ("k", at, 7), ("k", at, 8)], "k string, time timestamp_ntz, v int")
    for n in (1, 3):
        assert [r["v"] for r in tb.upsert(now, new.repartition(n), ["k"], "time").collect()] == [7]


def test_recent_ends_at_its_time(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 2, 3)], "time timestamp_ntz")
    assert [r["time"].day for r in tb.recent(rows, 24, as_of="2024-01-02 12:00:00").collect()] == [2]


def test_flags_of_a_missing_time(spark):
    row = temporal_features(spark.createDataFrame([(None,)], "time timestamp_ntz")).first()
    assert all(row[c] == 0 for c in ("is_weekend", "is_peak_hour", "is_morning_peak", "is_evening_peak", "is_holiday"))
    assert row["hour"] is None


def test_quantiles_shuffle_the_bracket_only(spark, monkeypatch):
    """Below the exchange on values, the bracket filter has already run."""
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    plans = []
    real = su.ranged
    monkeypatch.setattr(su, "ranged", lambda cells, order: plans.append(cells._jdf.queryExecution().executedPlan().toString().split("\n")) or real(cells, order))
    su.exact_quantiles(df, "v", [0.5], ["k"])
    (plan,) = plans
    assert not any("Exchange" in line and "_v#" in line for line in plan)
    bracket = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    assert any("Exchange hashpartitioning" in line and "_groupingexpression" in line for line in plan[:bracket])


def test_tuning_counts_windows_without_demand(spark, small_dir, monkeypatch):
    from transit_spark.plans import checks_planning as cp
    from transit_spark.plans.catalog import QUERIES

    real = cp._route_windows
    quiet = F.when(F.col("start") % 5 == 0, F.lit(0.0)).otherwise(F.col("y"))
    monkeypatch.setattr(cp, "_route_windows", lambda fx: (None, real(fx)[1].withColumn("y", quiet)))
    found = QUERIES["F14_tune"](spark, small_dir).collect()
    assert len(found) == 3 and all(r["mape"] > 1e6 for r in found)


def test_cleaning_without_a_sequence_fills_all_values(spark):
    """Columns that broke a tie between repeated rows are still values, and are filled."""
    at = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    demand = spark.createDataFrame([("r", "s", at[0], 1, 2), ("r", "s", at[1], None, 3), ("r", "s", at[2], 4, None)], "route string, stop string, time timestamp_ntz, passengers int, boarding_count int")
    assert [(r["passengers"], r["boarding_count"]) for r in cl.clean_demand(demand).orderBy("time").collect()] == [(1, 2), (1, 3), (4, 3)]
    weather = spark.createDataFrame([(at[0], 20.0, "Rain"), (at[1], None, None), (at[2], 22.0, "Clear")], "time timestamp_ntz, temperature double, conditions string")
    assert [(r["temperature"], r["conditions"]) for r in cl.clean_weather(weather).orderBy("time").collect()] == [(20.0, "Rain"), (21.0, "Rain"), (22.0, "Clear")]
