"""Sorted ranges instead of blocks by value: no task and no window takes the whole frame."""

import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from transit_spark.operators import cleaning as cl
from transit_spark.operators import context as cx
from transit_spark.operators import evaluation as ev
from transit_spark.operators import scaling as nm
from transit_spark.operators import schedule as sc
from transit_spark.operators import series as sr
from transit_spark.operators import summary as su

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def many_ranges(spark):
    """A session that cuts even small frames into 16 ranges."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield 16
    for k, v in before.items():
        spark.conf.set(k, v)


def one_day(spark, rows):
    """All rows on one day, twenty of them at each time."""
    stamp = F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor(F.col("id") / 20).cast("decimal(18,6)"))
    return spark.range(rows).select(stamp.alias("time"), F.col("id").alias("seq"), F.when(F.col("id") % 7 != 3, F.col("id") * 3 % 101).cast("double").alias("v"))


def test_ranges_are_sorted_and_of_like_size(spark, many_ranges):
    cut = sr.ranged(one_day(spark, 16_000), ["time", "seq"])
    parts = cut.groupBy(sr.RANGE).agg(F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).orderBy(sr.RANGE).collect()
    assert len(parts) == many_ranges and max(r["n"] for r in parts) < 3_000
    assert all(a["hi"] < b["lo"] for a, b in zip(parts, parts[1:]))
    assert sr.ranged(one_day(spark, 1_000), ["seq"], 1_600 // 16).select(sr.RANGE).distinct().count() > 80  # a hundred ranges


def test_one_day_without_keys_equals_pandas(spark, many_ranges):
    df = one_day(spark, 4_000)
    want = df.toPandas().sort_values(["time", "seq"])
    got = sr.lag_features(df, "v", [1, 5], (), ["time", "seq"]).toPandas().sort_values("seq")
    for n in (1, 5):
        assert np.array_equal(got[f"v_lag_{n}"].to_numpy(), want["v"].shift(n).to_numpy(), equal_nan=True)
    rolled = sr.rolling_features(df, "v", [6], (), ["time", "seq"]).toPandas().sort_values("seq")
    assert np.allclose(rolled["v_rolling_mean_6"], want["v"].rolling(6, min_periods=1).mean(), equal_nan=True)
    filled = sr.interpolate_and_fill(df, [], ["time", "seq"], ["v"]).toPandas().sort_values("seq")
    assert np.allclose(filled["v"], want["v"].interpolate().ffill().bfill())
    sample = sorted(r["seq"] for r in sr.even_sample(df, ["time", "seq"], 9).collect())
    assert sample == [int(i * 3999 / 8) if i < 8 else 3999 for i in range(9)]


def test_one_day_spreads_over_all_tasks(spark, many_ranges):
    """No window of a keyless series meets more than a few ranges' worth of rows in one task."""
    placed = sr.with_positions(one_day(spark, 32_000), [], ["time", "seq"])
    sizes = [r["n"] for r in placed.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 6 and max(sizes) < 10_000


def lone_windows(df):
    """Window expressions over a single partition, of the executed plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in re.findall(r"Window \[(.*)", text) if re.search(r"windowspecdefinition\((?![a-z_]+#)", line)]


@pytest.mark.parametrize("values", ["spread", "one value", "huge and tiny"])
def test_quantiles_without_keys(spark, many_ranges, values):
    made = {"spread": F.rand(3), "one value": F.lit(2.5), "huge and tiny": F.when(F.col("id") % 2 == 0, F.rand(3) * 1e-300).otherwise(F.rand(4) * 1e300)}
    df = su_stage(spark.range(5_000).select(made[values].alias("v")))
    data = [r["v"] for r in df.collect()]
    got = {r["prob"]: r["value"] for r in su.exact_quantiles(df, "v", [0.1, 0.5, 0.95], accuracy=100).collect()}
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(data, p), rel=1e-12)


def su_stage(df):
    from transit_spark.session import stage

    return stage(df)


def test_no_lone_window_meets_data_rows(spark, many_ranges):
    """Windows over everything see one row per range: their input comes from an aggregate by range."""
    df = one_day(spark, 4_000)
    for made in (su.exact_quantiles(df, "v", [0.5]), cl.impute_median(df, "v", 0, 50), sr.lag_features(df, "v", [1], (), ["time", "seq"]), ev.qq_points(df, "v")):
        text = made._jdf.queryExecution().executedPlan().toString()
        for piece in text.split("Exchange SinglePartition")[1:]:
            below = piece.splitlines()[1]
            assert "Aggregate" in below or "Project" in below and "Aggregate" in piece.splitlines()[2]


def test_labels_that_share_a_prefix(spark, many_ranges):
    names = [f"http://example.org/route/{i:05d}" for i in range(3_000)]
    df = spark.createDataFrame([(n, "x") for n in names], "a string, b string")
    codes = {(r["column"], r["value"]): r["code"] for r in nm.fit_labels(df, ["a", "b"]).collect()}
    assert [codes["a", n] for n in names] == list(range(3_000)) and codes["b", "x"] == 0
    cut = sr.ranged(df.distinct(), ["a"]).groupBy(sr.RANGE).count().collect()
    assert max(r["count"] for r in cut) < 600


def test_fleet_over_routes_that_share_a_prefix(spark, many_ranges):
    best = spark.range(500).select(F.format_string("R_long_prefix_%04d", "id").alias("route"), F.lit(10.0).alias("demand"), F.lit(20).alias("headway"), F.lit(3).alias("vehicles"))
    kept = sc.apply_fleet_limit(best, 100).orderBy("route").collect()
    assert len(kept) == 34 and sum(r["vehicles"] for r in kept) == 100 and kept[-1]["headway"] == 120


@pytest.mark.parametrize("n", [1, 2, 7])
def test_qq_samples_of_any_number(spark, n):
    df = spark.createDataFrame([(float(v),) for v in range(20)], "v double")
    got = sorted(r["position"] for r in ev.qq_points(df, "v", n).collect())
    assert got == sorted({0 if n == 1 else (19 if i == n - 1 else int(i * 19 / (n - 1))) for i in range(n)})
    one = spark.createDataFrame([(4.0,)], "v double")
    assert [(r["position"], r["value"]) for r in ev.qq_points(one, "v", n).collect()] == [(0, 4.0)]
    with pytest.raises(ValueError):
        ev.qq_points(df, "v", 0)


@pytest.mark.parametrize("seed", range(3))
def test_active_events_equal_a_plain_loop(spark, many_ranges, seed):
    """Events that touch, nest, repeat, last an instant or end before they start, and times at their borders."""
    draw = np.random.default_rng(seed)
    events = []
    for _ in range(80):
        start = int(draw.integers(0, 60))
        events.append((T0 + dt.timedelta(minutes=start), T0 + dt.timedelta(minutes=start + int(draw.choice([0, 1, 5, 40, -2]))), float(draw.integers(10, 20)) / 10))
    events += [events[0], (None, T0, 9.0), (T0, None, 9.0)]
    times = [T0 + dt.timedelta(seconds=30 * i) for i in range(-2, 230)] + [None, T0]
    rows = spark.createDataFrame([(t,) for t in times], "time timestamp_ntz")
    df = spark.createDataFrame(events, "start_time timestamp_ntz, end_time timestamp_ntz, impact_factor double")
    got = {r["time"]: (r["active_count"], r["active_impact"]) for r in cx.active_events(rows, df).collect()}
    want = {}
    for t in times:
        if t is not None and (active := [i for s, e, i in events if s is not None and e is not None and s <= t <= e]):
            want[t] = (len(active), max(active))
    assert got == want
    assert cx.active_events(rows, df.limit(0)).collect() == [] and cx.active_events(rows.limit(0), df).collect() == []
    counts = {r["time"]: (r["active_count"], r["active_impact"]) for r in cx.active_events(rows, df.drop("impact_factor")).collect()}
    assert counts == {t: (n, None) for t, (n, _) in want.items()}


def test_each_time_is_swept_once(spark, many_ranges, monkeypatch):
    """What is cut into ranges has a row per time and per start and end, whatever the length of events."""
    sizes = []
    real = cx.ranged
    monkeypatch.setattr(cx, "ranged", lambda df, order: sizes.append(df.count()) or real(df, order))
    events = spark.range(300).select(F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("start_time"), F.timestamp_seconds(F.col("id") * 60 + 30_000_000).cast("timestamp_ntz").alias("end_time"), F.lit(1.5).alias("impact_factor"))
    rows = spark.range(5_000).select(F.timestamp_seconds(F.col("id") * 7 + 3).cast("timestamp_ntz").alias("time"))
    found = cx.active_events(rows, events)
    assert found.count() == 5_000 and sizes[0] <= 5_000 + 600
