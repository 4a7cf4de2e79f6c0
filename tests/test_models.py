"""Moment matrices, tuning and clustering against numpy and Spark ML."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from transit_spark.operators import forecast as fc

T0 = dt.datetime(2024, 1, 1)
WINDOW = "route string, x array<array<double>>, y double, start bigint, series_rows bigint"


def drawn_windows(spark, rows, steps, features, seed=1, routes=2):
    rng = np.random.default_rng(seed)
    true = rng.normal(size=steps * features)
    out = []
    for i in range(rows):
        x = rng.normal(size=(steps, features)) * np.linspace(0.5, 20, features) + np.linspace(-5, 40, features)
        out.append((f"r{i % routes}", x.tolist(), float(x.ravel() @ true + 3 + rng.normal()), i // routes, -(-rows // routes)))
    return spark.createDataFrame(out, WINDOW), out


def matrix(rows):
    return np.column_stack([np.array([np.ravel(r[1]) for r in rows]), np.ones(len(rows)), [r[2] for r in rows]])


def test_moments_equal_numpy(spark):
    df, rows = drawn_windows(spark, 101, 3, 2)
    got = {r["route"]: np.array(r["m"]) for r in fc.moments(df, 6, ["route"]).collect()}
    for route in ("r0", "r1"):
        v = matrix([r for r in rows if r[0] == route])
        assert np.allclose(got[route], v.T @ v)
    missing = df.withColumn("y", F.when(F.col("start") > 0, F.col("y")))
    v = matrix([r for r in rows if r[3] > 0])
    assert np.allclose(np.array(fc.moments(missing, 6).first()["m"]), v.T @ v)


def test_wide_windows_plan_and_run(spark):
    """Twelve steps of twenty features: 240 unknowns per route."""
    df, rows = drawn_windows(spark, 600, 12, 20, routes=1)
    got = fc.fit_per_route(df, 240, ridge=0.0).first()["weights"]
    v = matrix(rows)
    want = np.linalg.lstsq(v[:, :-1], v[:, -1], rcond=None)[0]
    assert np.allclose(v[:, :-1] @ got, v[:, :-1] @ want, atol=1e-5)


@pytest.mark.parametrize("size", [5, 7])
def test_wrong_size_is_an_error(spark, size):
    df, _ = drawn_windows(spark, 10, 3, 2)
    with pytest.raises(Exception, match="a window holds other than"):
        fc.fit_per_route(df, size).collect()


def test_columns_without_spread_and_repeated_columns(spark):
    rows = [("r", [[float(i), 4.0, 2.0 * i]], 3.0 * i + 1) for i in range(10)]
    got = fc.fit_per_route(spark.createDataFrame(rows, "route string, x array<array<double>>, y double"), 3, ridge=0.0).first()["weights"]
    assert got[1] == 0.0 and got[0] + 2 * got[2] == pytest.approx(3.0) and got[3] == pytest.approx(1.0)
    same = spark.createDataFrame([("r", [[float(i)]], 7.0) for i in range(5)], "route string, x array<array<double>>, y double")
    assert fc.fit_per_route(same, 1, ridge=0.0).first()["weights"] == pytest.approx([0.0, 7.0])


@pytest.mark.parametrize(("reg", "elastic"), [(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 0.4)])
def test_penalties_equal_spark_ml(spark, reg, elastic):
    df, rows = drawn_windows(spark, 150, 2, 3, seed=5)
    model = LinearRegression(labelCol="y", regParam=reg, elasticNetParam=elastic, tol=1e-12, maxIter=2000).fit(df.withColumn("features", array_to_vector(F.flatten("x"))))
    v = matrix(rows)
    ours = fc.solve_moments(v.T @ v, reg, elastic)
    assert np.allclose(ours, [*model.coefficients, model.intercept], rtol=1e-5, atol=1e-5)


def test_tuning_equals_one_fit_per_setting_and_fold(spark):
    df, rows = drawn_windows(spark, 240, 2, 2, seed=2)
    grid, folds = [{}, {"reg": 5.0}, {"reg": 5.0, "elastic": 0.5}], 3
    got = {r["setting"]: r["mape"] for r in fc.tune(df, grid, folds).collect()}
    v = matrix(rows)
    part = np.array([r[3] * (folds + 1) // r[4] for r in rows])
    for number, setting in enumerate(grid):
        errors = []
        for k in range(1, folds + 1):
            train, test = v[part < k], v[part == k]
            w = fc.solve_moments(train.T @ train, **setting)
            errors.append(np.mean(np.abs((test[:, -1] - test[:, :-1] @ w) / (test[:, -1] + 1e-10)) * 100))
        assert got[number] == pytest.approx(np.mean(errors), rel=1e-9)
    with pytest.raises(ValueError, match="reg and elastic"):
        fc.tune(df, [{"kind": "gbt"}])
    with pytest.raises(ValueError, match="no windows"):
        fc.tune(df.limit(0), grid)


def test_tuning_reads_the_windows_as_often_for_any_grid(spark):
    df, _ = drawn_windows(spark, 60, 1, 1)
    jobs = []
    for grid in ([{"reg": float(i)} for i in range(n)] for n in (2, 12)):
        spark.sparkContext.setJobGroup(f"tune-{len(grid)}", "tune")
        fc.tune(df, grid, 2).collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"tune-{len(grid)}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def plain_clusters(rows, k, rounds):
    """Farthest-first and mean steps over (key, vector) rows."""
    rows = sorted(rows)
    gap = lambda a, b: round(float(np.sum((np.array(a) - np.array(b)) ** 2)), 9)
    centres = [rows[0][1]]
    while len(centres) < k:
        d, _, v = min((-min(gap(v, c) for c in centres), key, v) for key, v in rows)
        if not d:
            break
        centres.append(v)
    near = lambda v: min((gap(v, c), i) for i, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in rows:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [np.mean(groups[i], axis=0) if i in groups else c for i, c in enumerate(centres)]
    return {key: near(v)[1] for key, v in rows}, sum(near(v)[0] for _, v in rows)


@pytest.mark.parametrize(("n", "k"), [(40, 4), (40, 1), (3, 5), (1, 2)])
def test_clusters_equal_plain_steps(spark, n, k):
    rng = np.random.default_rng(n * k)
    rows = [(f"r{i:02d}", [float(x) for x in rng.normal(size=3) + 4 * (i % 3)]) for i in range(n)]
    df = spark.createDataFrame([(key, *v) for key, v in rows], "route string, a double, b double, c double")
    assigned, per_cluster = fc.cluster_profiles(df.repartition(3), ["a", "b", "c"], k, 6)
    want, inertia = plain_clusters(rows, k, 6)
    assert {r["route"]: r["cluster"] for r in assigned.collect()} == want
    assert sum(r["inertia"] for r in per_cluster.collect()) == pytest.approx(inertia)


def test_clusters_of_equal_and_no_profiles(spark):
    same = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0)], "route string, v double")
    assigned, _ = fc.cluster_profiles(same, ["v"], 3)
    assert {r["route"]: r["cluster"] for r in assigned.collect()} == {"a": 0, "b": 0, "c": 1}
    assert fc.cluster_profiles(same.limit(0), ["v"], 2)[0].collect() == []
    with pytest.raises(ValueError):
        fc.cluster_profiles(same, ["v"], 0)
