"""Keyed state and chained queries on streams of several files, against the batch operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from transit_spark.operators import forecast as fc
from transit_spark.operators.evaluation import error_frame
from transit_spark.streaming import jobs as st

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "route string, stop string, time timestamp_ntz, seq bigint, passengers double"


def rows_of(count, seed=1):
    draw = random.Random(seed)
    return [(f"r{i % 2}", f"s{draw.choice('abc') if i % 5 else 'hot'}", T0 + dt.timedelta(minutes=5 * (i + draw.randint(-3, 3))), i, float(draw.randint(0, 50))) for i in range(count)]


def write(spark, rows, path, name):
    """One more file of the source, older than none of those before."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def source(spark, path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)


def last_per_series(frame):
    newest = {}
    for r in frame.collect():
        key = (r["route"], r["stop"])
        if key not in newest or newest[key][0] < r["time"]:
            newest[key] = (r["time"], [x[0] for x in r["x"]])
    return newest


def test_latest_rows_over_three_files_and_a_restart(spark, tmp_path):
    rows = rows_of(300)
    length = 4
    kept = lambda: st.run_once(st.keep_latest(st.event_time(source(spark, f"{tmp_path}/in")).withWatermark("time", "30 minutes"), ["passengers"], length), f"{tmp_path}/out")
    for k in range(2):
        write(spark, rows[100 * k : 100 * k + 100], f"{tmp_path}/in", f"part{k}")
    first = last_per_series(kept())
    write(spark, rows[200:], f"{tmp_path}/in", "part2")
    got = last_per_series(kept())  # goes on from its log and its state
    for until, found in ((200, first), (300, got)):
        batch, _ = fc.latest_windows(spark.createDataFrame(rows[:until], SCHEMA), ["passengers"], length, order=("time", "seq"))
        want = {(r["route"], r["stop"]): (r["time"], [x[0] for x in r["x"]]) for r in batch.collect()}
        assert found == want and len(want) > 4


def test_only_touched_series_are_written_and_old_ones_expire(spark, tmp_path):
    first = [("r", f"s{i}", T0, i, 1.0) for i in range(50)]
    write(spark, first, f"{tmp_path}/in", "a")
    write(spark, [("r", "s7", T0 + dt.timedelta(hours=1), 100, 2.0)], f"{tmp_path}/in", "b")
    write(spark, [("r", "s8", T0 + dt.timedelta(days=3), 101, 3.0)], f"{tmp_path}/in", "c")
    write(spark, [("r", "s8", T0 + dt.timedelta(days=3, hours=1), 102, 4.0)], f"{tmp_path}/in", "d")
    timed = st.event_time(source(spark, f"{tmp_path}/in")).withWatermark("time", "30 minutes")
    query = (
        st.keep_latest(timed, ["passengers"], 2, expire="1 day").writeStream.format("parquet")
        .option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/log").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    seen = [(p["numInputRows"], p["stateOperators"][0]["numRowsUpdated"], p["stateOperators"][0]["numRowsTotal"]) for p in query.recentProgress if p["stateOperators"]]
    assert seen[0] == (50, 50, 50) and seen[1] == (1, 1, 50)  # one series read and written of fifty
    assert seen[-1][2] == 1  # all but the one that still sends are forgotten
    got = {(r["stop"], tuple(x[0] for x in r["x"])) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {("s7", (1.0, 2.0)), ("s8", (1.0, 3.0)), ("s8", (3.0, 4.0))}


def test_busy_series_is_cut_before_the_state(spark, tmp_path):
    """A task passes on the last rows of a series only, whatever it holds."""
    hot = spark.range(50_000).select(F.lit("r").alias("route"), F.lit("s").alias("stop"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("time"), F.col("id").alias("seq"), F.col("id").cast("double").alias("passengers"))
    hot.coalesce(1).write.parquet(f"{tmp_path}/in/a")
    found = st.keep_latest(st.event_time(source(spark, f"{tmp_path}/in")).withWatermark("time", "30 minutes"), ["passengers"], 3)
    text = found._jdf.queryExecution().analyzed().toString()
    assert 0 < text.index("FlatMapGroupsInPandasWithState") < text.index("MapInPandas cut")
    assert [[x[0] for x in r["x"]] for r in st.run_once(found, f"{tmp_path}/out").collect()] == [[49997.0, 49998.0, 49999.0]]


@pytest.mark.parametrize("files", [1, 3])
def test_drift_on_the_stream_equals_the_batch(spark, tmp_path, files):
    draw = random.Random(files)
    rows = [(f"r{i % 2}", f"s{i}", T0 + dt.timedelta(minutes=7 * i), i, float(draw.randint(0, 20) + (15 if i > 250 else 0))) for i in range(400)]
    size = -(-len(rows) // files)
    for k in range(files):
        write(spark, rows[k * size : (k + 1) * size], f"{tmp_path}/in", f"part{k}")
    made = source(spark, f"{tmp_path}/in").select("route", "stop", "time", (F.col("time") - F.expr("INTERVAL 20 MINUTES")).alias("created_at"), F.lit(10.0).alias("predicted"))
    got = st.watch_forecasts(made, source(spark, f"{tmp_path}/in"), str(tmp_path / "q"), 5.0, 30.0, 0.5, "2 hours")
    pairs = spark.createDataFrame(rows, SCHEMA).select("route", F.col("time").cast("timestamp").alias("time"), F.lit(10.0).alias("predicted"), F.col("passengers").alias("actual"))
    windows = st.error_windows(error_frame(pairs), "2 hours")
    closed = windows.where(F.col("window_end") <= F.lit(rows[-1][2] - dt.timedelta(hours=1)).cast("timestamp"))
    want = st.drift(closed, 5.0, 30.0, 0.5)

    def told(df):
        return sorted((r["route"], r["window_start"], r["n"], round(r["mae"], 9), round(r["drift"], 6), r["retrain"]) for r in df.collect())

    assert told(got) == told(want)
    flags = [r["retrain"] for r in want.collect()]
    assert any(flags) and not all(flags)


def test_missing_sides_count_nowhere(spark):
    pairs = spark.createDataFrame([("r", T0, 1.0, 2.0), ("r", T0, None, 2.0), ("r", T0, 3.0, None)], "route string, time timestamp, actual double, predicted double")
    assert [(r["n"], r["mae"]) for r in st.error_windows(error_frame(pairs)).collect()] == [(1, 1.0)]
