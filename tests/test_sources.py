"""Files, tables, documents and pages on small literal inputs."""

import datetime as dt
import re
import time
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from transit_spark.plans.fixtures import Fixtures
from transit_spark.sources import documents as dc
from transit_spark.sources import pages as pg
from transit_spark.sources import tables as tb

T0 = dt.datetime(2024, 1, 1)

PAGES = [
    (1, '<div id="rouInfo"><ul><li>Distance: 12 km</li><li>Vehicle: 40 seats</li><li>Fare: 6000</li></ul></div><h3>To North</h3><table><tr class="rowStop"><td><div>A</div></td><td>Alpha</td></tr><tr class="rowStop"><td><div>1</div></td><td>Beta</td></tr><tr class="rowStop"><td><div>B</div></td><td>Gamma</td></tr></table><h3>To South</h3><table><tr class="rowStop"><td><div>A</div></td><td>Gamma</td></tr><tr class="rowStop"><td><div>B</div></td><td> </td></tr></table>'),
    (2, "<table><tr><td>1</td><td>Alpha</td><td>x</td><td>05:00-05:35</td></tr><tr><td>2</td><td>Beta</td><td>06:10</td><td>07:00</td></tr><tr><td>3</td><td>Gamma</td><td>08:00</td></tr></table>"),
    (3, "<p>no data</p>"),
    (4, '<div><a class="cms-button" href="/r/1?a=1&amp;b=2"><span class="icon">01</span><div class="routetrip">North &amp; South</div></a> <a href="http://x/y">plain</a></div>'),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id int, html string")


def test_links(pages):
    got = [tuple(r) for r in pg.extract_links(pages, "http://site").orderBy("position").collect()]
    assert got == [(4, 0, "01", "North & South", "http://site/r/1?a=1&b=2"), (4, 1, "", "plain", "http://x/y")]


def test_attributes(pages):
    got = {r["page_id"]: (r["distance"], r["fare"]) for r in pg.extract_attributes(pages, {"distance": "Distance", "fare": "Fare"}).collect()}
    assert got == {1: ("12 km", "6000"), 2: ("", ""), 3: ("", ""), 4: ("", "")}


def test_stops_and_timetable(pages):
    got = sorted(tuple(r) for r in pg.extract_stops(pages).collect())
    assert got == [(1, "To North", "1", "Beta"), (1, "To North", "A", "Alpha"), (1, "To North", "B", "Gamma"), (1, "To South", "A", "Gamma")]
    assert [r["stop_name"] for r in pg.extract_stops(pages, skip_terminals=True).collect()] == ["Beta"]
    assert pg.extract_stops(pages, direction_word="South").count() == 1
    times = sorted((r["stop_order"], r["stop_name"], r["departure_time"]) for r in pg.extract_timetable(pages).collect())
    assert times == [("1", "Alpha", "05:00-05:35"), ("2", "Beta", "06:10")]


def test_broken_documents_give_no_rows(spark):
    df = spark.createDataFrame([(1, 1, 1, 200, "not json", "{}"), (2, 1, 2, 404, "null", "null")], "route_id int, direction int, variant_id int, status int, stops_json string, path_json string")
    assert dc.flatten_route_stops(df).count() == 0 and dc.flatten_route_paths(df).count() == 0
    assert [r["route_id"] for r in dc.usable_documents(df).collect()] == [1]


def test_optional_files_may_be_absent(spark, tmp_path):
    assert tb.read_table(spark, str(tmp_path), "weather") is None
    with pytest.raises(AnalysisException):
        tb.read_table(spark, str(tmp_path), "demand")


def test_csv_round_trip_and_counts(spark, tmp_path):
    df = spark.createDataFrame([(T0, 20.5, 50.0, 0.0, 1.5, "Rain, heavy"), (T0, None, 51.0, 0.5, 1.0, None)], "time timestamp_ntz, temperature double, humidity double, rain_mm double, wind_speed double, conditions string")
    assert tb.write_tables({"weather": df, "events": None}, str(tmp_path)) == {"weather": 2}
    back = tb.read_table(spark, str(tmp_path), "weather")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_save_modes_and_reading(spark, tmp_path):
    db = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}'")
    tb.create_tables(spark, db)
    rows = [("r", "b", T0 + dt.timedelta(hours=h), 10.5, 106.5, float(h), 0.0) for h in range(48)]
    gps = spark.createDataFrame(rows, "route string, bus_id string, time timestamp_ntz, latitude double, longitude double, speed double, heading double")
    assert tb.save_table(gps, f"{db}.gps_traces") == 48
    span = ("2024-01-01 10:00:00", "2024-01-01 12:00:00")
    df = tb.load_table(spark, f"{db}.gps_traces", filters={"bus_id": "b"}, time_range=span, columns=["time", "speed"], limit=2)
    assert [r["speed"] for r in df.collect()] == [12.0, 11.0]
    assert "PartitionFilters: [isnotnull(day" in df._jdf.queryExecution().toString()
    assert [r["speed"] for r in tb.recent(spark.table(f"{db}.gps_traces"), 2, "r", "2024-01-02 23:00:00").collect()] == [47.0, 46.0, 45.0]
    assert tb.save_table(gps, f"{db}.plain", "fail") == 48
    with pytest.raises(AnalysisException):
        tb.save_table(gps, f"{db}.plain", "fail")
    assert tb.save_table(gps.limit(1), f"{db}.plain", "replace") == 1 and spark.table(f"{db}.plain").count() == 1
    with pytest.raises(ValueError):
        tb.save_table(gps, f"{db}.plain", "merge")


def test_upsert_rewrites_only_touched_days(spark, tmp_path):
    db = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}'")
    tb.create_tables(spark, db)
    schema = "time timestamp_ntz, temperature double"
    base = [(T0 + dt.timedelta(hours=12 * i), float(i)) for i in range(4)]
    tb.save_table(spark.createDataFrame(base, schema), f"{db}.weather_data")
    tb.upsert_table(spark.createDataFrame([(T0, 99.0), (T0 + dt.timedelta(hours=1), 5.0)], schema), f"{db}.weather_data")
    got = sorted((r["time"].hour + 24 * (r["time"].day - 1), r["temperature"]) for r in spark.table(f"{db}.weather_data").collect())
    assert got == [(0, 99.0), (1, 5.0), (12, 1.0), (24, 2.0), (36, 3.0)]


def test_packed_features(spark):
    df = spark.createDataFrame([(T0, "r", "s", 3, float("nan"), None, "x")], "time timestamp_ntz, route string, stop string, a int, b double, c int, d string")
    assert tb.pack_features(df, ["a", "b", "c", "d", "missing"]).first()["features"] == '{"a":3.0,"b":null,"c":null,"d":"x"}'


def test_predictions_shape(spark):
    df = spark.createDataFrame([(T0, "r", "s", 12.9, 1.0, 20.0)], "time timestamp_ntz, route string, stop string, predicted double, lower double, upper double")
    row = tb.prediction_rows(df, "v2", "2024-01-02 00:00:00").first().asDict()
    assert row["predicted_demand"] == 12 and row["route_id"] == "r" and row["model_version"] == "v2" and row["confidence_upper"] == 20.0


def test_stage_statistics(spark, tmp_path):
    """A stage's seconds are those of its own write."""
    watch = tb.StageStats()
    slow = spark.range(7, numPartitions=1).select(F.expr("reflect('java.lang.Thread', 'sleep', CAST(200 AS BIGINT))").alias("s"), F.lit(1).alias("x"))
    tb.write_tables({"slow": slow, "quick": spark.range(3)}, str(tmp_path), fmt="parquet", stats=watch)
    report = watch.report()
    assert (report["slow"]["records"], report["slow"]["columns"], report["quick"]["records"]) == (7, 2, 3)
    assert report["slow"]["seconds"] > report["quick"]["seconds"] > 0


HTML = """<!-- <div id=x> --><div id="x" class="a b"><div>one<div class="b">two</div></div><br><p>open <p>more
<a class='c d' title="1 > 0" href="/q?a=1&amp;b=2">l<b>i</b>nk</a></div><div class="b">three<table><tr><td>k<table><tr><td>in</td></tr></table></td><td>v</td></tr></table></div>"""


@pytest.mark.parametrize(("selector", "found"), [
    ("#x", 1), ("#x .b", 1), (".b", 3), ("div.a.b#x", 1), ("div div div", 1), ("#x a.c", 1), ("#x a.e", 0), ("DIV.b", 3), ("td td", 1), ("#y a", 0), ("br", 1), ("p", 2),
])
def test_elements_by_container_and_class(spark, selector, found):
    df = spark.createDataFrame([(1, HTML), (2, None), (3, ""), (4, "no tags < at all")], "page_id int, html string")
    rows = pg.select_elements(df, selector).collect()
    assert len(rows) == found and {r["page_id"] for r in rows} <= {1} and [r["position"] for r in rows] == list(range(found))


def test_elements_end_where_they_end(spark):
    df = spark.createDataFrame([(1, HTML)], "page_id int, html string")
    first = lambda s: pg.select_elements(df, s).first()["element"]
    assert first("#x").endswith("</a></div>") and first("#x div").count("div>") == 3
    assert first("#x .b") == '<div class="b">two</div>' and first("br") == "<br>"
    assert first("tr").endswith("<td>v</td></tr>") and first("td td") == "<td>in</td>"
    assert first("p").endswith("</table></div>")  # never closed
    link = pg.extract_links(df, "http://s", selector="#x a.d").first()
    assert (link["name"], link["url"], link["position"]) == ("link", "http://s/q?a=1&b=2", 0)
    for wrong in ("", "a > b", "a[href]"):
        with pytest.raises(ValueError):
            pg.elements(F.col("html"), wrong)


def test_labels_in_cells(spark):
    html = "<div id=i><table><tr><td>Operator</td><td> A &amp; B </td></tr><tr><td>Distance</td><td><ul><li>Distance: 3 km</li></ul></td></tr></table></div><table><tr><td>Operator</td><td>other</td></tr></table>"
    df = spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")
    inside = pg.extract_attributes(df, {"operator": "Operator", "distance": "Distance", "none": "None"}, within="#i").orderBy("page_id").collect()
    assert [tuple(r) for r in inside] == [(1, "A & B", "3 km", ""), (2, "", "", "")]
    assert pg.extract_attributes(df, {"operator": "Operator"}).orderBy("page_id").first()["operator"] == "other"


def test_direction_of_timetable_rows(spark):
    row = "<tr><td>{}</td><td>S</td><td>x</td><td>05:00</td></tr>"
    html = f"<table>{row.format(0)}</table><h3>To North</h3><table>{row.format(1)}{row.format(2)}</table><h3>To <i>South</i></h3>{row.format(3)}<h3>Fares</h3>{row.format(4)}"
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    got = {r["stop_order"]: (r["row"], r["direction"]) for r in pg.extract_timetable(df, direction_word="To").collect()}
    assert got == {"0": (0, "Unknown"), "1": (1, "To North"), "2": (2, "To North"), "3": (3, "To South"), "4": (4, "Unknown")}


@pytest.fixture
def store(spark, tmp_path):
    db = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}/db'")
    tb.create_tables(spark, db)
    return db


def gps_rows(spark, rows):
    data = [("r", bus, T0 + dt.timedelta(hours=h), 10.5, 106.5, float(v), 0.0) for bus, h, v in rows]
    return spark.createDataFrame(data, "route string, bus_id string, time timestamp_ntz, latitude double, longitude double, speed double, heading double")


def stored_speeds(spark, name):
    return sorted((r["bus_id"], r["time"], r["speed"]) for r in spark.table(name).collect())


def test_keyed_append_adds_only_new_keys(spark, store):
    name = f"{store}.gps_traces"
    first = gps_rows(spark, [("a", h, h) for h in range(48)] + [("a", 0, 99)])
    assert tb.append_new(first, name, ["speed"]) == 48
    assert tb.append_new(first, name, ["speed"]) == 0  # known by its digest
    overlapping = gps_rows(spark, [("a", h, 1000 + h) for h in range(40, 60)] + [("b", 3, 5)])
    assert tb.append_new(overlapping, name) == 13
    got = {(b, t): v for b, t, v in stored_speeds(spark, name)}
    assert len(got) == 61 and got["a", T0 + dt.timedelta(hours=45)] == 45.0 and got["a", T0 + dt.timedelta(hours=50)] == 1050.0
    again = gps_rows(spark, [("a", h, -1) for h in range(60)])  # other rows, no new key
    assert tb.append_new(again, name) == 0 and len(stored_speeds(spark, name)) == 61
    assert [r["appended"] for r in spark.table(f"{name}_batches").orderBy("stored_at").collect()] == [48, 13, 0]
    assert tb.save_table(first.limit(1), name, "replace") == 1  # forgets the batches
    assert tb.append_new(first, name, ["speed"]) == 47


def test_keyed_append_after_a_write_that_broke_off(spark, store, monkeypatch):
    name = f"{store}.gps_traces"
    tb.append_new(gps_rows(spark, [("a", h, h) for h in range(5)]), name)
    before = stored_speeds(spark, name)
    second = gps_rows(spark, [("a", h, h) for h in range(30)])
    whole = tb._write

    def killed(df, action):
        raise RuntimeError("killed")

    def half(df, action):
        whole(df.where("speed < 12"), action)
        raise RuntimeError("killed")

    for broken in (killed, half):
        monkeypatch.setattr(tb, "_write", broken)
        with pytest.raises(RuntimeError):
            tb.append_new(second, name)
        monkeypatch.setattr(tb, "_write", whole)
        assert stored_speeds(spark, name)[:5] == before
    assert tb.append_new(second, name) == 18
    assert [v for _, _, v in stored_speeds(spark, name)] == [float(h) for h in range(30)]


def test_keyed_append_without_days_and_with_missing_keys(spark, store):
    name = f"{store}.events"
    schema = "event_id string, name string, start_time timestamp_ntz"
    assert tb.append_new(spark.createDataFrame([("EVT_1", "x", T0), (None, "y", T0), ("EVT_2", "z", T0)], schema), name) == 3
    assert tb.append_new(spark.createDataFrame([("EVT_2", "other", T0), (None, "q", T0), ("EVT_3", "n", T0)], schema), name) == 1
    assert sorted((r["event_id"] or "", r["event_name"]) for r in spark.table(name).collect()) == [("", "y"), ("EVT_1", "x"), ("EVT_2", "z"), ("EVT_3", "n")]
    with pytest.raises(ValueError, match="no declared keys"):
        tb.append_new(spark.range(1), f"{store}.unknown")


def test_key_filter_finds_exactly_the_stored_keys(spark, store, monkeypatch):
    """Few bits, so that many stored keys hit the filter by chance: they are compared all the same."""
    monkeypatch.setattr(tb, "KEY_BUCKETS", 1)
    monkeypatch.setattr(tb, "BITMAP_BITS", 64)
    monkeypatch.setattr(tb, "SENT_BITMAPS", 0)
    name = f"{store}.gps_traces"
    tb.append_new(gps_rows(spark, [(f"b{k}", h, 1) for k in range(40) for h in range(0, 72, 3)]), name)
    fresh = tb._stored_shape(gps_rows(spark, [(f"b{k}", h, 2) for k in range(30, 50) for h in range(0, 96, 2)]), "gps_traces")
    got = {(r["bus_id"], r["time"]) for r in tb.known_keys(fresh, name).collect()}
    assert got == {(f"b{k}", T0 + dt.timedelta(hours=h)) for k in range(30, 40) for h in range(0, 72, 6)}


def test_key_filter_reads_only_touched_days(spark, store):
    name = f"{store}.gps_traces"
    tb.append_new(gps_rows(spark, [("a", 24 * d, d) for d in range(6)]), name)
    fresh = tb._stored_shape(gps_rows(spark, [("a", 24 * d, d) for d in (2, 4)]), "gps_traces")
    text = tb.known_keys(fresh, name)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*day#\d+ (IN|INSET)", text)
    assert not any("speed" in schema for schema in re.findall(r"ReadSchema: (.*)", text))


def test_stamps_and_names(spark, store):
    tb.save_table(spark.createDataFrame([("r1", 4, 2)], "route string, num_stops int, num_buses int"), f"{store}.routes")
    row = spark.table(f"{store}.routes").first()
    assert row["route_id"] == "r1" and row["route_name"] is None and row["created_at"] is not None


def test_long_tables_take_time_in_proportion(spark):
    """Each row's end was looked for in all tokens of the page: half a minute for these rows."""
    rows = "".join(f"<tr><td><b>Label {i}</b></td><td><i>{i}</i></td><td></td></tr>" for i in range(3000))
    df = spark.createDataFrame([(1, f"<table>{rows}</table>")], "page_id long, html string")
    begun = time.time()
    found = pg.extract_attributes(df, {"last": "Label 2999", "none": "None"}).first()
    assert (found["last"], found["none"]) == ("2999", "")
    assert time.time() - begun < 10


def test_elements_of_odd_pages(spark):
    """Rows in rows, ends without starts, tags never closed, brackets in quotes, markup in comments and scripts."""
    html = '</tr><tr id="a"><td>1<table><TR><td title="</tr>">2</td></tr></table></td><!-- </tr> --><td>3<script>"</tr>"</script></tr><tr><td>4'
    got = lambda s: spark.createDataFrame([(html,)], "html string").select(pg.elements(F.col("html"), s)).first()[0]
    inner = '<TR><td title="</tr>">2</td></tr>'
    outer = f'<tr id="a"><td>1<table>{inner}</table></td><!-- </tr> --><td>3<script>"</tr>"</script></tr>'
    assert got("tr") == [outer, inner, "<tr><td>4"]
    assert got("#a td") == [f"<td>1<table>{inner}</table></td>", '<td title="</tr>">2</td>', '<td>3<script>"</tr>"</script></tr><tr><td>4']
    assert got("#a tr") == [inner] and got("script") == [html[html.index("<script>") :]]


def test_tags_of_many_attributes(spark):
    """The pattern of a tag went one call deeper with each attribute."""
    tag = "<div " + "".join(f'a{i}="" ' for i in range(20_000)) + 'id="x">'
    df = spark.createDataFrame([(f"{tag}in</div>",)], "html string")
    assert df.select(pg.elements(F.col("html"), "#x")).first()[0] == [f"{tag}in</div>"]


def test_pages_are_dealt_over_all_cores(spark, tmp_path):
    """One small file is one split, whatever the pages made from it cost."""
    orders = [(i, i % 7, "P"[: i % 2] or "O", "1-URGENT") for i in range(40)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    for name in ("route_pages", "list_pages"):
        pages = Fixtures(spark, str(tmp_path)).view(name)
        assert pages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert sorted(r["page_id"] for r in pages.select("page_id").collect()) == list(range(40))
