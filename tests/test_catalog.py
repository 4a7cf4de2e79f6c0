"""Registered queries against their SQL, plans, skew, streams against batch."""

import datetime as dt
import importlib.util
import pathlib
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from transit_spark.operators import cleaning as cl
from transit_spark.operators import context as cx
from transit_spark.operators import series as sr
from transit_spark.plans import catalog
from transit_spark.plans.catalog import ORACLES
from transit_spark.plans.fixtures import Fixtures

ROOT = pathlib.Path(__file__).resolve().parents[1]
spec = importlib.util.spec_from_file_location("compare", ROOT / "tools" / "compare.py")
compare = importlib.util.module_from_spec(spec)
spec.loader.exec_module(compare)

CHECKED = sorted(ORACLES)


@pytest.fixture(scope="module")
def duck(small_dir):
    return compare.connect(small_dir)


@pytest.mark.parametrize("name", CHECKED)
def test_equals_reference_sql(spark, duck, small_dir, name):
    _, rows, state, note = compare.compare(spark, duck, name, small_dir)
    assert state == "ok", note
    assert rows > 0


def test_entry_and_names(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"route", "hour", "is_peak_hour", "passengers"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_optional_subpackage(monkeypatch):
    """With its folder gone, the library's own queries stay and nothing of the subpackage is asked for."""
    for name in [m for m in sys.modules if m.startswith("transit_spark.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "transit_spark.llm", None)
    assert set(entry.queries()) == set(catalog.QUERIES) and set(entry.oracle_sql()) == set(catalog.ORACLES)


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["C14_clean_demand", "J4_active_events", "G7_event_proximity", "W2_rolling_features", "K5_best_schedule", "K11_sensitivity"])
def test_no_pairwise_join_and_no_python(spark, small_dir, name):
    text = plan(entry.queries()[name](spark, small_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in text


def test_filter_and_columns_reach_the_scan(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/events.parquet").where(F.col("value") > 400).select("event_id", "ts")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,400.0)]" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in text


def test_dedupe_limits_before_the_shuffle(spark, small_dir):
    text = plan(cl.dedupe_first(Fixtures(spark, small_dir).demand_raw, ["route", "stop", "time"], ["seq"]))
    assert "row_number(), 1, Partial" in text


def test_one_hot_series_is_spread_over_tasks(spark):
    """One series holding nearly all rows must not end up in one partition."""
    start = dt.datetime(2024, 1, 1)
    hot = spark.range(60_000).select(
        F.lit("hot").alias("k"), (F.lit(start) + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 15).cast("int"), F.lit(0))).cast("timestamp_ntz").alias("time"), F.col("id").alias("v")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = sr.with_positions(hot, ["k"], ["time"])
        sizes = [r["n"] for r in placed.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 30_000
        rows, _ = sr.in_chunks(placed, ["k"], before=2, size=5_000)
        spread = rows.repartition(4, "k", "_chunk").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
        assert max(r["n"] for r in spread) < 45_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    wrong = sr.lag_features(hot, "v", [1], ["k"], ["time"]).where(~F.col("v_lag_1").eqNullSafe(F.nullif(F.col("v"), F.lit(0)) - 1)).count()
    assert wrong == 0


def test_hot_event_interval_does_not_multiply_rows(spark):
    """Many events over one time: pieces are combined before they meet the times."""
    start = dt.datetime(2024, 1, 1)
    events = spark.range(20_000).select(F.lit(start).cast("timestamp_ntz").alias("start_time"), F.lit(start + dt.timedelta(days=3)).cast("timestamp_ntz").alias("end_time"), (F.col("id") / 1000).alias("impact_factor"))
    rows = spark.range(5_000).select("id", F.lit(start + dt.timedelta(hours=5)).cast("timestamp_ntz").alias("time"))
    got = cx.join_active_events(rows, events).agg(F.count("*").alias("n"), F.min("nearby_events").alias("lo"), F.max("event_impact_factor").alias("hi")).first()
    assert tuple(got) == (5_000, 20_000, 19.999)
