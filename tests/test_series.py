"""Series operators against hand-computed rows, pandas, and cuts in the middle of a series."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from transit_spark.operators import series as sr
from transit_spark.operators.forecast import latest_windows, moving_average, time_split, windows

START = dt.datetime(2024, 1, 1)


def frame(spark, values, key="a", minutes=15):
    rows = [(key, START + dt.timedelta(minutes=minutes * i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, time timestamp_ntz, v double")


def values(df, col="v"):
    return [r[col] for r in df.orderBy("k", "time").collect()]


@pytest.mark.parametrize("minutes", [15, 400, 2000])
def test_gap_interpolation_limit(spark, minutes):
    # With 400 and 2000 minutes between rows every gap crosses block (day) borders.
    df = frame(spark, [None, 1, None, None, None, None, 6, None, None, None, None], minutes=minutes)
    assert values(sr.interpolate(df, ["k"], ["time"], ["v"], limit=3)) == [None, 1, 2, 3, 4, None, 6, 6, 6, 6, None]


@pytest.mark.parametrize("minutes", [15, 700])
def test_fill_directions(spark, minutes):
    df = frame(spark, [None, 1, None, None, 4, None], minutes=minutes)
    assert values(sr.ffill(df, ["k"], ["time"], ["v"])) == [None, 1, 1, 1, 4, 4]
    assert values(sr.bfill(df, ["k"], ["time"], ["v"])) == [1, 1, 4, 4, 4, None]
    assert values(sr.fill_both(df, ["k"], ["time"], ["v"])) == [1, 1, 1, 1, 4, 4]
    assert values(sr.interpolate_and_fill(df, ["k"], ["time"], ["v"])) == [1, 1, 2, 3, 4, 4]


def test_rolling_small(spark):
    df = sr.rolling_features(frame(spark, [1, None, 3, 4]), "v", [3], ["k"], ["time"])
    assert values(df, "v_rolling_mean_3") == [1, 1, 2, 3.5]
    std = values(df, "v_rolling_std_3")
    assert std[:2] == [None, None] and std[2:] == pytest.approx([2**0.5, 0.5**0.5])


def random_series(spark, seed=3, n=400):
    rng = random.Random(seed)
    rows = []
    for key, share in (("hot", 0.6), ("b", 0.3), ("c", 0.1)):
        at = START
        for _ in range(int(n * share)):
            at += dt.timedelta(minutes=rng.choice([5, 15, 60, 900]))
            rows.append((key, at, None if rng.random() < 0.2 else float(rng.randrange(100))))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, time timestamp_ntz, v double")


def as_pandas(df):
    return df.toPandas().sort_values(["k", "time"]).reset_index(drop=True)


def close(a, b):
    return np.allclose(a.astype(float), b.astype(float), equal_nan=True)


def test_fill_and_interpolation_equal_pandas(spark):
    df = random_series(spark)
    base = as_pandas(df)
    grouped = base.groupby("k")["v"]
    assert close(as_pandas(sr.ffill(df, ["k"], ["time"], ["v"]))["v"], grouped.ffill())
    assert close(as_pandas(sr.bfill(df, ["k"], ["time"], ["v"]))["v"], grouped.bfill())
    want = grouped.transform(lambda x: x.interpolate(method="linear", limit=3))
    assert close(as_pandas(sr.interpolate(df, ["k"], ["time"], ["v"], limit=3))["v"], want)


def test_lag_and_rolling_equal_pandas_over_chunk_borders(spark, monkeypatch):
    monkeypatch.setattr(sr.in_chunks, "__defaults__", (0, 0, 13))  # chunks of 13 rows
    df = random_series(spark)
    got = as_pandas(sr.series_features(df, "v", [1, 2, 12], [3, 12], ["k"], ["time"]))
    grouped = as_pandas(df).groupby("k")["v"]
    for n in (1, 2, 12):
        assert close(got[f"v_lag_{n}"], grouped.shift(n))
    for n in (3, 12):
        assert close(got[f"v_rolling_mean_{n}"], grouped.transform(lambda x: x.rolling(n, min_periods=1).mean()))
        assert close(got[f"v_rolling_std_{n}"], grouped.transform(lambda x: x.rolling(n, min_periods=1).std()))


def test_null_key_has_no_lag(spark):
    rows = [(None, START, 1.0), (None, START + dt.timedelta(hours=1), 2.0), ("a", START, 3.0)]
    df = spark.createDataFrame(rows, "k string, time timestamp_ntz, v double")
    got = sr.lag_features(df, "v", [1], ["k"], ["time"]).collect()
    assert len(got) == 3 and all(r["v_lag_1"] is None for r in got)


@pytest.mark.parametrize("length,horizon,step", [(4, 1, 1), (12, 2, 3), (5, 3, 2)])
def test_window_count_and_content(spark, monkeypatch, length, horizon, step):
    monkeypatch.setattr(sr.in_chunks, "__defaults__", (0, 0, 17))
    df = random_series(spark).na.fill(0.0)
    got = windows(df, ["v"], length, horizon, step, ["k"])
    base = as_pandas(df)
    want = {}
    for key, part in base.groupby("k"):
        v = part["v"].tolist()
        for i in range(0, len(v) - length - horizon + 1, step):
            want[(key, i)] = (v[i : i + length], v[i + length + horizon - 1])
    rows = {(r["k"], r["start"]): ([x[0] for x in r["x"]], r["y"]) for r in got.collect()}
    assert rows == want


def test_short_series_are_reported(spark):
    df = frame(spark, range(20)).unionByName(frame(spark, range(3), key="short"))
    full, short = latest_windows(df, ["v"], 12, ["k"])
    assert [[x[0] for x in r["x"]] for r in full.collect()] == [[float(i) for i in range(8, 20)]]
    assert [(r["k"], r["rows_found"]) for r in short.collect()] == [("short", 3)]


def test_time_split_sizes(spark):
    df = time_split(frame(spark, range(33)), ["k"])
    got = {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert got == {"train": 23, "val": 4, "test": 6}


@pytest.mark.parametrize("n", [1, 2, 7, 50, 400, 1000])
def test_even_sample_equals_linspace(spark, n):
    df = frame(spark, range(400), minutes=30)
    got = [int(r["v"]) for r in sr.even_sample(df, ["time"], n).orderBy("time").collect()]
    want = list(range(400)) if n >= 400 else sorted(set(np.linspace(0, 399, n).astype(int).tolist()))
    assert got == want


def test_head_and_tail(spark):
    df = frame(spark, range(10)).unionByName(frame(spark, range(2), key="b"))
    assert values(sr.tail(df, ["k"], 3, ["time"])) == [7, 8, 9, 0, 1]
    assert values(sr.head(df, ["k"], 1, ["time"])) == [0, 0]


def test_moving_average_equals_pandas(spark):
    df = random_series(spark).na.fill(1.0)
    got = as_pandas(moving_average(df, 7, ["k"], "v"))
    base = as_pandas(df)
    want = []
    for _, row in base.iterrows():
        part = base[(base["k"] == row["k"]) & (base["time"] < row["time"]) & (base["time"] >= row["time"] - pd.Timedelta(days=7))]
        want.append(part["v"].mean())
    assert close(got["baseline"], pd.Series(want))


def test_running_total_over_blocks(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("n"))
    got = sr.running_total(df, [], ["id"], "n", F.floor(F.col("id") / 9)).orderBy("id").collect()
    assert [r["_total"] for r in got] == np.cumsum([i % 7 for i in range(100)]).tolist()
