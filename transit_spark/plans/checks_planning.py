"""Registered queries: forecasting, evaluation, schedules."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from transit_spark.functions.temporal import temporal_features
from transit_spark.operators import evaluation as ev
from transit_spark.operators import forecast as fc
from transit_spark.operators import schedule as sc
from transit_spark.operators import summary as su
from transit_spark.operators.context import join_weather, weather_features
from transit_spark.operators.scaling import fit_scaler, scale, unscale
from transit_spark.operators.series import lag_features
from transit_spark.plans.checks_features import r6
from transit_spark.plans.flows import candidate_timetables, plan_day
from transit_spark.plans.registry import check, rounded, significant, significant_sql
from transit_spark.session import stage

SERIES = ["route", "stop"]
Z95 = NormalDist().inv_cdf(0.975)


@check(
    "F1_prepare_series",
    f"""SELECT seq, split, {r6('rain_mm', 'passengers')} FROM (
      SELECT d.seq, split, (d.rain_mm - p.r_lo) / (p.r_hi - p.r_lo) AS rain_mm, (d.passengers - p.p_lo) / (p.p_hi - p.p_lo) AS passengers FROM v_prep d,
      (SELECT min(rain_mm) AS r_lo, max(rain_mm) AS r_hi, CAST(min(passengers) AS DOUBLE) AS p_lo, max(passengers) AS p_hi FROM v_prep WHERE split = 'train') p)""",
)
def f1(fx):
    weather = fx.weather.select("time", F.col("rain_mm"))
    df = fx.demand.join(weather, "time", "left")
    prepared, _ = fc.prepare_series(df, ["rain_mm"], SERIES, ["time", "seq"])
    return rounded(prepared.select("seq", "split", "rain_mm", "passengers"))


def _windows_sql(length: int, horizon: int, step: int) -> str:
    xs = ", ".join(f"lag(passengers, {length - 1 - i}) OVER w AS x{i}" for i in range(length))
    out = ", ".join(f"CAST(x{i} AS DOUBLE) AS x{i}" for i in range(length))
    return f"""SELECT route, stop, time, CAST(rn - {length} AS BIGINT) AS start, {out}, CAST(y AS DOUBLE) AS y FROM (
      SELECT route, stop, time, row_number() OVER w AS rn, {xs}, lead(passengers, {horizon}) OVER w AS y FROM v_demand
      WINDOW w AS (PARTITION BY route, stop ORDER BY time)) WHERE rn >= {length} AND (rn - {length}) % {step} = 0 AND y IS NOT NULL"""


@check("F2_windows", _windows_sql(12, 2, 3))
def f2(fx):
    w = fc.windows(fx.demand, ["passengers"], 12, 2, 3, SERIES)
    return w.select(*SERIES, "time", "start", *[F.get(F.get("x", F.lit(i)), F.lit(0)).alias(f"x{i}") for i in range(12)], "y")


@check(
    "F3_time_split",
    """SELECT seq, CASE WHEN rn <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN rn <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split
    FROM (SELECT seq, row_number() OVER (PARTITION BY route, stop ORDER BY time) AS rn, count(*) OVER (PARTITION BY route, stop) AS n FROM v_demand)""",
)
def f3(fx):
    return fc.time_split(fx.demand).select("seq", "split")


@check("F4_series", "SELECT seq, time, passengers FROM v_demand WHERE route = 'R_click' AND stop = 'R_click_Stop_2'")
def f4(fx):
    return fc.series(fx.demand, "R_click", "R_click_Stop_2").select("seq", "time", "passengers")


def _route_windows(fx, length: int = 8):
    totals = stage(su.demand_by_time(fx.demand).withColumn("total_demand", F.col("total_demand").cast("double")))
    return totals, fc.windows(totals, ["total_demand"], length, 1, 1, ["route"])


def _stop_windows(fx):
    """Training windows of all stops: a stored table, models read it several times."""
    return stage(fc.windows(fx.demand, ["passengers"], 12, 2, 1, SERIES))


@check("F5_global_model")
def f5(fx):
    """One linear model over the windows of all stops, predictions for every window."""
    w = _stop_windows(fx)
    model = fc.fit_forecaster(w)
    return rounded(fc.predict(model, w).select(*SERIES, "time", "y", "prediction"), 4)


# Windows of one value: the least squares have a closed form, which the reference SQL writes down.
PAIRS = "SELECT route, stop, time, CAST(passengers AS DOUBLE) AS x, CAST(lead(passengers) OVER (PARTITION BY route, stop ORDER BY time) AS DOUBLE) AS y FROM v_demand"
GLOBAL_LINE = f"SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM ({PAIRS}) WHERE y IS NOT NULL"
TOTAL_PAIRS = "SELECT route, time, CAST(total_demand AS DOUBLE) AS x, CAST(lead(total_demand) OVER (PARTITION BY route ORDER BY time) AS DOUBLE) AS y FROM v_totals"
ROUTE_LINES = f"SELECT route, regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM ({TOTAL_PAIRS}) WHERE y IS NOT NULL GROUP BY route"


def _pairs(fx):
    return stage(fc.windows(fx.demand, ["passengers"], 1, 1, 1, SERIES))


@check("F5_global_line", f"SELECT route, stop, time, y, round(a + b * x, 4) AS prediction FROM ({PAIRS}) w, ({GLOBAL_LINE}) m WHERE y IS NOT NULL")
def f5b(fx):
    """One line over the pairs of successive values of all stops."""
    w = _pairs(fx)
    return rounded(fc.predict(fc.fit_forecaster(w), w).select(*SERIES, "time", "y", "prediction"), 4)


_T, _V = "floor(n * 0.7::DOUBLE)", "floor(n * 0.15::DOUBLE)"


@check(
    "F5_held_out",
    f"""WITH p AS (SELECT route, stop, time, passengers, row_number() OVER (PARTITION BY route, stop ORDER BY time) AS r, count(*) OVER (PARTITION BY route, stop) AS n FROM v_demand),
    s AS (SELECT *, CASE WHEN r <= {_T} THEN 'train' WHEN r <= {_T} + {_V} THEN 'val' ELSE 'test' END AS split FROM p),
    w AS (SELECT route, split, CAST(passengers AS DOUBLE) AS x, CAST(lead(passengers) OVER (PARTITION BY route, stop, split ORDER BY time) AS DOUBLE) AS y FROM s),
    m AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM w WHERE split = 'train' AND y IS NOT NULL)
    SELECT route, count(*) AS n, round(avg(abs(y - (a + b * x))), 4) AS mae, round(sqrt(avg(pow(y - (a + b * x), 2))), 4) AS rmse,
      round(median(abs(y - (a + b * x))), 4) AS median_ae FROM w, m WHERE split = 'test' AND y IS NOT NULL GROUP BY route""",
)
def f5c(fx):
    """Fitted on the training rows, scored on the test rows; no window crosses a border."""
    prepared, params = fc.prepare_series(fx.demand, [], SERIES)
    _, _, scores = fc.held_out(prepared, params, ["passengers"], length=1, horizon=1, step=1)
    return rounded(scores.select("route", "n", "mae", "rmse", "median_ae"), 4)


@check(
    "F5_lagged_held_out",
    f"""WITH p AS (SELECT route, stop, time, passengers, row_number() OVER o AS r, count(*) OVER (PARTITION BY route, stop) AS n,
        coalesce(lag(passengers) OVER o, passengers) AS before FROM v_demand WINDOW o AS (PARTITION BY route, stop ORDER BY time)),
    s AS (SELECT *, CASE WHEN r <= {_T} THEN 'train' WHEN r <= {_T} + {_V} THEN 'val' ELSE 'test' END AS split FROM p),
    w AS (SELECT route, split, CAST(before AS DOUBLE) AS x1, CAST(passengers AS DOUBLE) AS x2, CAST(lead(passengers) OVER (PARTITION BY route, stop, split ORDER BY time) AS DOUBLE) AS y FROM s),
    m AS (SELECT *, (c1 * v22 - c2 * v12) / (v11 * v22 - v12 * v12) AS b1, (c2 * v11 - c1 * v12) / (v11 * v22 - v12 * v12) AS b2 FROM (SELECT {{normal}} FROM w WHERE split = 'train' AND y IS NOT NULL)),
    e AS (SELECT route, y - (my + b1 * (x1 - m1) + b2 * (x2 - m2)) AS error FROM w, m WHERE split = 'test' AND y IS NOT NULL)
    SELECT route, count(*) AS n, round(avg(abs(error)), 4) AS mae, round(sqrt(avg(pow(error, 2))), 4) AS rmse, round(median(abs(error)), 4) AS median_ae FROM e GROUP BY route""".format(
        normal="count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) AS v11, var_pop(x2) AS v22, covar_pop(x1, x2) AS v12, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2"
    ),
)
def f5d(fx):
    """As ``F5_held_out``, from the value before as a lag column beside the value itself."""
    lagged = lag_features(fx.demand, "passengers", [1], SERIES, ["time"])
    prepared, params = fc.prepare_series(lagged, ["passengers_lag_1"], SERIES)
    _, _, scores = fc.held_out(prepared, params, ["passengers_lag_1", "passengers"], length=1, horizon=1, step=1)
    return rounded(scores.select("route", "n", "mae", "rmse", "median_ae"), 4)


@check("F6_route_lines", f"SELECT route, time, y, round(a + b * x, 4) AS prediction FROM ({TOTAL_PAIRS}) JOIN ({ROUTE_LINES}) USING (route) WHERE y IS NOT NULL")
def f6b(fx):
    """A line per route over the pairs of successive totals."""
    _, w = _route_windows(fx, 1)
    return rounded(fc.predict_per_route(fc.fit_per_route(w, 1, ridge=0.0), w).select("route", "time", "y", "prediction"), 4)


@check(
    "F7_recursive_line",
    f"""SELECT * FROM (WITH RECURSIVE m AS ({ROUTE_LINES}), f AS (
      SELECT route, 0 AS step, max(time) AS time, arg_max(total_demand, time)::DOUBLE AS p FROM v_totals GROUP BY route
      UNION ALL SELECT f.route, f.step + 1, f.time + INTERVAL 15 MINUTE, a + b * p FROM f JOIN m ON m.route = f.route WHERE f.step < 12)
    SELECT route, step, time, round(p, 4) AS predicted_demand FROM f WHERE step > 0)""",
)
def f7b(fx):
    """Twelve steps ahead from the lines, each from the one before."""
    totals, w = _route_windows(fx, 1)
    latest, _ = fc.latest_windows(totals, ["total_demand"], 1, ["route"])
    return rounded(fc.forecast_per_route(fc.fit_per_route(w, 1, ridge=0.0), latest, 12), 4)


def _drawn_sql(member: int) -> str:
    place = f"(('0x' || substr(md5(concat_ws('|', route, stop, epoch_us(time), '{member}')), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
    cases = " ".join(f"WHEN {place} < {p!r}::DOUBLE THEN {n}" for n, p in enumerate(fc.DRAWN_AT_MOST))
    return f"CASE {cases} ELSE {len(fc.DRAWN_AT_MOST)} END::DOUBLE"


def _member_sql(member: int) -> str:
    return f"""SELECT (sum(c * y) - b * sum(c * x)) / sum(c) AS a, b FROM (SELECT *, ({_drawn_sql(member)}) AS c FROM ({PAIRS}) WHERE y IS NOT NULL),
      (SELECT (sum(c) * sum(c * x * y) - sum(c * x) * sum(c * y)) / (sum(c) * sum(c * x * x) - sum(c * x) * sum(c * x)) AS b
       FROM (SELECT *, ({_drawn_sql(member)}) AS c FROM ({PAIRS}) WHERE y IS NOT NULL)) GROUP BY b"""


@check(
    "F8_ensemble_lines",
    f"""SELECT route, stop, time, round(avg(p), 3) AS predicted, round(avg(p) - {Z95!r}::DOUBLE * stddev_pop(p), 3) AS lower, round(avg(p) + {Z95!r}::DOUBLE * stddev_pop(p), 3) AS upper
    FROM (SELECT route, stop, time, a + b * x AS p FROM ({PAIRS}) w, ({' UNION ALL '.join(_member_sql(42 + i) for i in range(3))}) m WHERE y IS NOT NULL) GROUP BY ALL""",
)
def f8c(fx):
    """Three lines over bootstrap samples that a checksum draws."""
    w = _pairs(fx)
    return rounded(fc.predict_interval(fc.fit_ensemble(w, 3), w).select(*SERIES, "time", "predicted", "lower", "upper"), 3)


@check("F9_latest_line", f"SELECT route, stop, time, round(a + b * x, 4) AS prediction FROM (SELECT * FROM ({PAIRS}) WHERE y IS NULL), ({GLOBAL_LINE})")
def f9c(fx):
    """The line's prediction from the last value of each stop."""
    full, _ = fc.predict_latest(fc.fit_forecaster(_pairs(fx)), fx.demand, ["passengers"], 1)
    return rounded(full.select(*SERIES, "time", "prediction"), 4)


@check("F12_saved_line", f"SELECT route, stop, time, round(a + b * x, 4) AS prediction, 1 AS features FROM ({PAIRS}) w, ({GLOBAL_LINE}) m WHERE y IS NOT NULL")
def f12b(fx):
    """The line, saved and loaded again."""
    w = _pairs(fx)
    path = fx.fresh_dir() + "/line"
    fc.save_model(fc.fit_forecaster(w), ["passengers"], path)
    model, features = fc.load_model(path)
    return rounded(fc.predict(model, w).select(*SERIES, "time", "prediction", F.lit(len(features)).alias("features")), 4)


@check("F6_per_route_models")
def f6(fx):
    """Least squares per route, in-sample predictions."""
    _, w = _route_windows(fx)
    return rounded(fc.predict_per_route(fc.fit_per_route(w, 8), w).select("route", "time", "y", "prediction"), 4)


_NORMAL = "count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) AS v11, var_pop(x2) AS v22, covar_pop(x1, x2) AS v12, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2"
TOTAL_TRIPLES = """SELECT route, time, CAST(lag(total_demand) OVER (PARTITION BY route ORDER BY time) AS DOUBLE) AS x1, CAST(total_demand AS DOUBLE) AS x2,
    CAST(lead(total_demand) OVER (PARTITION BY route ORDER BY time) AS DOUBLE) AS y FROM v_totals"""


@check(
    "F6_route_planes",
    f"""SELECT route, time, y, round(my + b1 * (x1 - m1) + b2 * (x2 - m2), 4) AS prediction FROM ({TOTAL_TRIPLES}) JOIN (
      SELECT *, (c1 * v22 - c2 * v12) / (v11 * v22 - v12 * v12) AS b1, (c2 * v11 - c1 * v12) / (v11 * v22 - v12 * v12) AS b2
      FROM (SELECT route, {_NORMAL} FROM ({TOTAL_TRIPLES}) WHERE x1 IS NOT NULL AND y IS NOT NULL GROUP BY route)) USING (route)
    WHERE x1 IS NOT NULL AND y IS NOT NULL""",
)
def f6c(fx):
    """A plane per route over windows of two totals; the reference solves the two equations by hand."""
    _, w = _route_windows(fx, 2)
    return rounded(fc.predict_per_route(fc.fit_per_route(w, 2, ridge=0.0), w).select("route", "time", "y", "prediction"), 4)


@check("F7_recursive_forecast")
def f7(fx):
    """48 steps ahead for all routes at once from the per-route models."""
    totals, w = _route_windows(fx)
    latest, _ = fc.latest_windows(totals, ["total_demand"], 8, ["route"])
    return rounded(fc.forecast_per_route(fc.fit_per_route(w, 8), latest, 48), 4)


@check(
    "F8_interval_from_members",
    f"""SELECT seq, {r6('predicted', 'predicted_std')}, round(predicted - {Z95!r}::DOUBLE * predicted_std, 6) AS lower, round(predicted + {Z95!r}::DOUBLE * predicted_std, 6) AS upper
    FROM (SELECT seq, avg(m) AS predicted, stddev_pop(m) AS predicted_std FROM (
      SELECT seq, m1 AS m FROM v_members UNION ALL SELECT seq, m2 FROM v_members UNION ALL SELECT seq, m3 FROM v_members) GROUP BY seq)""",
)
def f8(fx):
    df = fc.interval_from_members(fx.view("members"), F.array("m1", "m2", "m3"), 0.95)
    return rounded(df.select("seq", "predicted", "predicted_std", "lower", "upper"))


@check("F8_ensemble_interval")
def f8b(fx):
    """Three bootstrap models, mean and 95 % interval per window."""
    w = _stop_windows(fx)
    return rounded(fc.predict_interval(fc.fit_ensemble(w), w).select(*SERIES, "time", "predicted", "lower", "upper"), 3)


@check("F9_latest_prediction")
def f9(fx):
    """Prediction from the last full window of each stop."""
    w = _stop_windows(fx)
    full, _ = fc.predict_latest(fc.fit_forecaster(w), fx.demand, ["passengers"], 12)
    return rounded(full, 4)


@check(
    "F9_latest_window",
    """SELECT route, stop, max(time) AS time, CAST(sum(passengers) AS DOUBLE) AS window_sum FROM (
      SELECT * FROM v_demand QUALIFY row_number() OVER (PARTITION BY route, stop ORDER BY time DESC) <= 12) GROUP BY ALL HAVING count(*) = 12""",
)
def f9b(fx):
    full, _ = fc.latest_windows(fx.demand, ["passengers"], 12)
    total = F.aggregate(F.flatten("x"), F.lit(0.0), lambda a, v: a + v)
    return full.select(*SERIES, "time", total.alias("window_sum"))


@check(
    "F10_error_frame",
    f"""SELECT f.seq, f.actual, f.predicted, error, abs_error, {significant_sql('pct_error')} AS pct_error FROM v_forecast f LEFT JOIN v_errors e ON e.seq = f.seq""",
)
def f10(fx):
    return ev.error_frame(fx.forecast).select("seq", "actual", "predicted", "error", "abs_error", significant("pct_error"))


@check("F11_unscale_target", "SELECT seq, CAST(passengers AS DOUBLE) AS passengers, CAST(passengers AS DOUBLE) AS predicted FROM v_demand")
def f11(fx):
    params = fit_scaler(fx.demand, ["boarding_count", "passengers"])
    scaled = scale(fx.demand, params).withColumn("predicted", F.col("passengers"))
    both = unscale(scaled, params, renamed={"passengers": "passengers", "predicted": "passengers"})
    return rounded(both.select("seq", "passengers", "predicted"))


@check("F12_save_load_model")
def f12(fx):
    """A saved and reloaded model predicts what the original did."""
    w = _stop_windows(fx)
    path = fx.fresh_dir() + "/forecaster"
    fc.save_model(fc.fit_forecaster(w), ["passengers"], path)
    model, features = fc.load_model(path)
    return rounded(fc.predict(model, w).select(*SERIES, "time", "prediction", F.lit(len(features)).alias("features")), 4)


def _ma_sql(days: int) -> str:
    return f"""SELECT seq, round(avg(passengers) OVER (PARTITION BY route, stop ORDER BY time
      RANGE BETWEEN INTERVAL {days} DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), 6) AS baseline FROM v_demand"""


@check("F13_moving_average_7", _ma_sql(7))
def f13(fx):
    return rounded(fc.baseline(fx.demand, "ma7").select("seq", "baseline"))


@check("F13_moving_average_14", _ma_sql(14))
def f13b(fx):
    return rounded(fc.baseline(fx.demand, "ma14").select("seq", "baseline"))


@check("F13_same_slot_last_week", "SELECT d.seq, p.passengers AS baseline FROM v_demand d LEFT JOIN v_demand p ON p.route = d.route AND p.stop = d.stop AND p.time + INTERVAL 7 DAY = d.time")
def f13c(fx):
    return fc.baseline(fx.demand, "last_week").select("seq", "baseline")


@check("F14_tune")
def f14(fx):
    """Validation MAPE of three settings over two time-ordered folds, all windows."""
    _, w = _route_windows(fx)
    grid = [{"reg": 0.0}, {"reg": 1.0}, {"reg": 1.0, "elastic": 1.0}]
    return fc.tune(w, grid, 2).select("setting", "options", significant("mape", 4))


@check(
    "F14_tune_lines",
    """WITH w AS MATERIALIZED (SELECT x, y, CAST(floor((rn - 1) * 3 / n) AS INT) AS part FROM (SELECT CAST(total_demand AS DOUBLE) AS x, CAST(lead(total_demand) OVER o AS DOUBLE) AS y,
        row_number() OVER o AS rn, count(*) OVER (PARTITION BY route) AS n FROM v_totals WINDOW o AS (PARTITION BY route ORDER BY time)) WHERE y IS NOT NULL),
    t AS (SELECT fold, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) / stddev_pop(x) AS c, stddev_pop(x) AS sx, stddev_pop(y) AS sy
      FROM (SELECT unnest([1, 2]) AS fold) JOIN w ON part < fold GROUP BY fold),
    m AS (SELECT fold, mx, my, unnest([0, 1, 2]) AS setting, unnest([c, c / (1 + 1.0::DOUBLE / sy), sign(c) * greatest(abs(c) - 1, 0)]) / sx AS b FROM t),
    e AS (SELECT setting, fold, avg(abs((y - my - b * (x - mx)) / (y + 1e-10::DOUBLE)) * 100) AS mape FROM m JOIN w ON part = fold GROUP BY ALL)
    SELECT CAST(setting AS INT) AS setting, ["{'reg': 0.0}", "{'reg': 1.0}", "{'reg': 1.0, 'elastic': 1.0}"][setting + 1] AS options, MAPE AS mape FROM (SELECT setting, avg(mape) AS mape FROM e GROUP BY setting)"""
    .replace('["', "['").replace('", "', "', '").replace('"]', "']").replace("{'", "{''").replace("':", "'':").replace(", 'elastic", ", ''elastic").replace("MAPE AS", significant_sql("mape", 4) + " AS"),
)
def f14b(fx):
    """Three settings for lines over two folds; ridge and soft threshold have a closed form."""
    _, w = _route_windows(fx, 1)
    return fc.tune(w, [{"reg": 0.0}, {"reg": 1.0}, {"reg": 1.0, "elastic": 1.0}], 2).select("setting", "options", significant("mape", 4))


@check(
    "F15_error_by_horizon",
    " UNION ALL ".join(
        f"""SELECT {s * 15} AS horizon_minutes, count(*) AS n, round(avg(abs(a - p)),6) AS mae, round(sqrt(avg((a-p)*(a-p))),6) AS rmse,
        round(1 - sum((a-p)*(a-p)) / (var_pop(a) * count(*)),6) AS r2, max(abs(a-p)) AS max_error, round(median(abs(a-p)),6) AS median_ae
        FROM (SELECT CAST(total_demand AS DOUBLE) AS p, CAST(lead(total_demand, {s}) OVER (PARTITION BY route ORDER BY time) AS DOUBLE) AS a FROM v_totals) WHERE a IS NOT NULL"""
        for s in (1, 2, 4)
    ),
)
def f15(fx):
    scores = fc.error_by_horizon(su.demand_by_time(fx.demand), "total_demand", (1, 2, 4), ["route"])
    return rounded(scores.drop("mape"))


@check(
    "F15_mape",
    " UNION ALL ".join(
        f"""SELECT {s * 15} AS horizon_minutes, {significant_sql('avg(abs((a - p) / (a + 1e-10)) * 100)')} AS mape
        FROM (SELECT CAST(total_demand AS DOUBLE) AS p, CAST(lead(total_demand, {s}) OVER (PARTITION BY route ORDER BY time) AS DOUBLE) AS a FROM v_totals) WHERE a IS NOT NULL"""
        for s in (1, 2, 4)
    ),
)
def f15b(fx):
    scores = fc.error_by_horizon(su.demand_by_time(fx.demand), "total_demand", (1, 2, 4), ["route"])
    return scores.select("horizon_minutes", significant("mape"))


HOURS = range(24)
PROFILE_SQL = "SELECT route, [" + ", ".join(f"coalesce(avg(passengers) FILTER (WHERE hour(time) = {h}), 0)" for h in HOURS) + "] AS v FROM v_demand GROUP BY route"


def _clusters_sql(k: int, rounds: int = 10) -> str:
    """Farthest-first centres and mean steps, written out: WITH ... ending in ``done`` (route, cluster, d) for ``k`` clusters."""

    def gap(a: str, b: str) -> str:
        return "round(" + " + ".join(f"pow({a}.v[{h + 1}] - {b}.v[{h + 1}], 2)" for h in HOURS) + ", 9)"

    parts = [f"p AS MATERIALIZED ({PROFILE_SQL})", "s0 AS MATERIALIZED (SELECT 0 AS cluster, v FROM p ORDER BY route LIMIT 1)"]
    for i in range(1, k):
        parts.append(f"s{i} AS MATERIALIZED (SELECT * FROM s{i - 1} UNION ALL (SELECT {i}, any_value(p.v) FROM p, s{i - 1} c GROUP BY p.route ORDER BY min({gap('p', 'c')}) DESC, p.route LIMIT 1))")
    parts.append(f"c0 AS MATERIALIZED (SELECT * FROM s{k - 1})")
    near = "SELECT route, arg_min(cluster, ({g}, cluster)) AS cluster, min({g}) AS d FROM p, c{r} c GROUP BY route"
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(g=gap('p', 'c'), r=r)})")
        means = "[" + ", ".join(f"avg(v[{h + 1}])" for h in HOURS) + "]"
        parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (SELECT cluster, {means} AS v FROM a{r} JOIN p USING (route) GROUP BY cluster) m USING (cluster))")
    parts.append(f"done AS ({near.format(g=gap('p', 'c'), r=rounds)})")
    return "WITH " + ", ".join(parts)


@check("F16_cluster_routes", f"SELECT * FROM ({_clusters_sql(3)} SELECT route, CAST(cluster AS INT) AS cluster FROM done)")
def f16(fx):
    """Routes grouped by mean hourly demand."""
    return fc.cluster_routes(fx.demand, 3)


@check(
    "F16_inertia",
    " UNION ALL ".join(f"SELECT * FROM ({_clusters_sql(k)} SELECT {k} AS k, count(DISTINCT cluster) AS clusters, round(sum(d), 4) AS inertia FROM done)" for k in (1, 2, 3)),
)
def f16c(fx):
    """What one, two and three clusters leave of the spread."""
    return rounded(fc.inertia_by_k(fx.demand, 3), 4)


@check("F16_demand_profiles", "SELECT route, " + ", ".join(f"round(coalesce(avg(passengers) FILTER (WHERE hour(time) = {h}), 0),6) AS h{h}" for h in range(24)) + " FROM v_demand GROUP BY route")
def f16b(fx):
    return rounded(fc.demand_profiles(fx.demand))


def _metrics_sql(source: str, key: str | None = None) -> str:
    head = f"{key}, " if key else ""
    return f"""SELECT {head}count(*) AS n, round(avg(abs_error),6) AS mae, round(sqrt(avg(error*error)),6) AS rmse,
      round(1 - sum(error*error) / (var_pop(actual) * count(*)),6) AS r2, max(abs_error) AS max_error, round(median(abs_error),6) AS median_ae
      FROM {source}""" + (f" GROUP BY {key}" if key else "")


@check("E1_metrics", _metrics_sql("v_errors"))
def e1(fx):
    # MAPE is checked apart: with zeros among the actual values it is about 1e13.
    return rounded(ev.metrics(fx.forecast).drop("mape"))


@check("E1_mape", f"SELECT route, {significant_sql('avg(pct_error)')} AS mape FROM v_errors GROUP BY route")
def e1b(fx):
    return ev.metrics(fx.forecast, ["route"]).select("route", significant("mape"))


@check("E1_mape_overall", f"SELECT {significant_sql('avg(pct_error)')} AS mape FROM v_errors")
def e1c(fx):
    return ev.metrics(fx.forecast).select(significant("mape"))


@check(
    "E2_accuracy_report",
    f"""SELECT route, -({significant_sql('mape - 100')}) AS accuracy, 85.0::DOUBLE AS target_accuracy, mape <= 15 AS target_met
    FROM (SELECT route, avg(pct_error) AS mape FROM v_errors GROUP BY route)""",
)
def e2(fx):
    report = ev.accuracy_report(ev.metrics(fx.forecast, ["route"])).withColumn("missed", F.col("mape") - 100)
    return report.select("route", "target_accuracy", "target_met", significant("missed")).select("route", (-F.col("missed")).alias("accuracy"), "target_accuracy", "target_met")


def _histogram_sql(col: str) -> str:
    return f"""SELECT CAST(b.bin AS INT) AS bin, round(lo + b.bin * (hi - lo) / 50, 6) AS lower, round(lo + (b.bin + 1) * (hi - lo) / 50, 6) AS upper, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(0, 50)) AS bin) b, (SELECT min({col}) AS lo, max({col}) AS hi FROM v_errors) l
    LEFT JOIN (SELECT least(floor(({col} - lo) / ((hi - lo) / 50)), 49) AS bin, count(*) AS n FROM v_errors, (SELECT min({col}) AS lo, max({col}) AS hi FROM v_errors) GROUP BY 1) c ON c.bin = b.bin"""


@check("E3_histogram_error", _histogram_sql("error"))
def e3(fx):
    errors = ev.error_frame(fx.forecast)
    return rounded(ev.histogram(errors, "error"))


@check("E3_histogram_abs_error", _histogram_sql("abs_error"))
def e3b(fx):
    errors = ev.error_frame(fx.forecast)
    return rounded(ev.histogram(errors, "abs_error"))


@check("E4_residuals", "SELECT predicted, error AS residual FROM v_errors")
def e4(fx):
    return ev.residuals(fx.forecast)


def _poly_sql(coefficients, x: str) -> str:
    text = repr(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c!r}::DOUBLE)"
    return text


def _inverse_normal_sql(p: str) -> str:
    def tail(q: str) -> str:
        t = f"sqrt(-2 * ln({q}))"
        return f"({_poly_sql(ev.INV_C, t)} / {_poly_sql((*ev.INV_D, 1.0), t)})"

    r = f"(({p} - 0.5) * ({p} - 0.5))"
    body = f"({_poly_sql(ev.INV_A, r)} * ({p} - 0.5) / {_poly_sql((*ev.INV_B, 1.0), r)})"
    return f"CASE WHEN {p} < {ev.INV_TAIL} THEN {tail(p)} WHEN {p} > {1 - ev.INV_TAIL} THEN -{tail(f'(1 - {p})')} ELSE {body} END"


@check(
    "E5_qq_points",
    f"""SELECT position, value, round({_inverse_normal_sql('p')}, 6) AS theoretical FROM (
      SELECT i - 1 AS position, error AS value, CASE WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n) WHEN i = n THEN pow(0.5, 1.0 / n) ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p
      FROM (SELECT error, row_number() OVER (ORDER BY error) AS i, count(*) OVER () AS n FROM v_errors))""",
)
def e5(fx):
    """Ordered errors against normal quantiles, all points."""
    errors = ev.error_frame(fx.forecast)
    return rounded(ev.qq_points(errors, "error"))


@check(
    "E5_qq_sample_values",
    """SELECT p AS position, error AS value FROM (SELECT error, row_number() OVER (ORDER BY error) - 1 AS p FROM v_errors)
    WHERE p IN (SELECT CASE WHEN i = 199 THEN (SELECT count(*) FROM v_errors) - 1 ELSE CAST(floor(i * (((SELECT count(*) FROM v_errors) - 1) / 199.0::DOUBLE)) AS BIGINT) END FROM range(0, 200) t(i))""",
)
def e5b(fx):
    errors = ev.error_frame(fx.forecast)
    return ev.qq_points(errors, "error", 200).select("position", "value")


@check(
    "E6_stratified_metrics",
    """SELECT is_peak_hour, is_weekend, count(*) AS n, round(avg(abs_error),6) AS mae, round(sqrt(avg(error*error)),6) AS rmse,
      round(1 - sum(error*error) / (var_pop(actual) * count(*)),6) AS r2, max(abs_error) AS max_error, round(median(abs_error),6) AS median_ae
    FROM v_errors JOIN (SELECT seq, is_peak_hour, is_weekend FROM v_temporal) USING (seq) GROUP BY ALL""",
)
def e6(fx):
    labelled = temporal_features(fx.forecast)
    return rounded(ev.metrics(labelled, ["is_peak_hour", "is_weekend"]).drop("mape"))


STRATA_SQL = """(SELECT e.*, CAST(month(e.time) AS INT) AS month, CAST(coalesce(w.rain_mm > 0, false) AS INT) AS is_raining,
      CASE WHEN w.temperature > 0 AND w.temperature <= 25 THEN 'cool' WHEN w.temperature > 25 AND w.temperature <= 30 THEN 'comfortable'
           WHEN w.temperature > 30 AND w.temperature <= 35 THEN 'hot' WHEN w.temperature > 35 AND w.temperature <= 50 THEN 'very_hot' END AS temp_category
    FROM v_errors e LEFT JOIN v_weather w ON time_bucket(INTERVAL '15 minutes', w.time) = time_bucket(INTERVAL '15 minutes', e.time))"""


def _strata(fx):
    return temporal_features(weather_features(join_weather(fx.forecast, fx.weather)))


@check("E6_weather_strata", _metrics_sql(STRATA_SQL, "is_raining, temp_category"))
def e6c(fx):
    """Scores per rain and temperature class of the row's weather slot; rows without weather are dry and of no class."""
    return rounded(ev.metrics(_strata(fx), ["is_raining", "temp_category"]).drop("mape"))


@check("E6_month_strata", _metrics_sql(STRATA_SQL, "route, month"))
def e6d(fx):
    """Scores per route and month."""
    return rounded(ev.metrics(_strata(fx), ["route", "month"]).drop("mape"))


@check(
    "E6_mape",
    f"""SELECT is_peak_hour, is_weekend, {significant_sql('avg(pct_error)')} AS mape
    FROM v_errors JOIN (SELECT seq, is_peak_hour, is_weekend FROM v_temporal) USING (seq) GROUP BY ALL""",
)
def e6c(fx):
    labelled = temporal_features(fx.forecast)
    return ev.metrics(labelled, ["is_peak_hour", "is_weekend"]).select("is_peak_hour", "is_weekend", significant("mape"))


@check("E6_metrics_per_route", _metrics_sql("v_errors", "route"))
def e6b(fx):
    return rounded(ev.metrics(fx.forecast, ["route"]).drop("mape"))


@check(
    "E7_paired_t",
    """SELECT count(*) AS n, round(avg(d),6) AS mean_diff, round(stddev_samp(d),6) AS std_diff, round(avg(d) / (stddev_samp(d) / sqrt(count(*))),6) AS t, count(*) - 1 AS dof
    FROM (SELECT CAST(boarding_count - alighting_count AS DOUBLE) AS d FROM v_demand)""",
)
def e7(fx):
    return rounded(ev.paired_t(fx.demand, "boarding_count", "alighting_count"))


@check(
    "E7_chi_square",
    """SELECT round(sum((coalesce(o.o, 0) - r.r * c.c / n.n) * (coalesce(o.o, 0) - r.r * c.c / n.n) / (r.r * c.c / n.n)), 6) AS chi_square,
      (count(DISTINCT r.route) - 1) * (count(DISTINCT c.band) - 1) AS dof, CAST(max(n.n) AS BIGINT) AS n
    FROM (SELECT route, count(*)::DOUBLE AS r FROM v_demand GROUP BY 1) r, (SELECT passengers // 50 AS band, count(*)::DOUBLE AS c FROM v_demand GROUP BY 1) c,
      (SELECT count(*)::DOUBLE AS n FROM v_demand) n
    LEFT JOIN (SELECT route, passengers // 50 AS band, count(*) AS o FROM v_demand GROUP BY ALL) o ON o.route = r.route AND o.band = c.band""",
)
def e7b(fx):
    return rounded(ev.chi_square(fx.demand.withColumn("band", F.floor(F.col("passengers") / 50)), "route", "band"))


@check("K1_slot_demand", "SELECT route, day, slot, time, demand FROM v_slots")
def k1(fx):
    return sc.slot_demand(fx.slot_input)


@check(
    "K2_fixed_timetable",
    """SELECT route, DATE '2024-01-15' AS day, CAST(slot AS INT) AS slot, TIMESTAMP '2024-01-15 06:00:00' + to_minutes(CAST(slot * 15 AS INT)) AS departure_time
    FROM (SELECT DISTINCT route FROM v_demand), (SELECT unnest(range(0, 49)) AS slot)""",
)
def k2(fx):
    return sc.fixed_timetable(fx.demand, "2024-01-15")


@check("K3_score_trips", "SELECT route, candidate, day, CAST(slot AS INT) AS slot, CAST(served AS BIGINT) AS served, CAST(wait_minutes AS BIGINT) AS wait_minutes FROM v_candidates JOIN v_loads USING (route, slot)")
def k3(fx):
    return sc.score_trips(candidate_timetables(fx.demand), sc.slot_demand(fx.slot_input))


@check("K4_trip_loads", "SELECT route, day, slot, served_passengers, served_passengers / 50 AS load_factor FROM v_final_loads")
def k4(fx):
    slots = sc.slot_demand(fx.slot_input)
    trips = sc.trip_loads(sc.fixed_timetable(slots), slots)
    return trips.select("route", "day", "slot", "served_passengers", "load_factor")


SCORE_COLS = r6("avg_wait", "load_factor", "score")


@check(
    "K5_best_schedule",
    f"""SELECT route, day, candidate, trips, CAST(served_sum AS BIGINT) AS served, {SCORE_COLS} FROM v_candidate_scores
    QUALIFY row_number() OVER (PARTITION BY route, day ORDER BY score DESC, candidate) = 1""",
)
def k5(fx):
    return rounded(sc.best_schedule(candidate_timetables(fx.demand), sc.slot_demand(fx.slot_input)))


def _hourly(fx):
    return fx.demand.groupBy("route").agg((F.sum("passengers") / 24.0).alias("demand"))


@check(
    "K6_headway_grid",
    """SELECT route, round(demand,6) AS demand, headway, round(trips_per_hour,6) AS trips_per_hour, round(utilisation,6) AS utilisation, round(1.0 / (abs(utilisation - 0.75) + 0.1), 6) AS heuristic,
      vehicles, CAST(floor((0.7 * (headway / 2) * demand + 0.3 * penalty) * 10000 + 0.37) AS BIGINT) AS cost_in_10000ths FROM v_grid""",
)
def k6(fx):
    # Costs are multiples of 1/576 of a 10000th, so rounding to any digit meets ties, which the engines round differently; this border meets none.
    grid = sc.headway_grid(_hourly(fx))
    return rounded(grid.withColumn("cost_in_10000ths", F.floor(F.col("cost") * 10000 + 0.37)).drop("cost"))


@check("K6_best_headway", f"SELECT route, {r6('demand')}, headway, {r6('trips_per_hour', 'utilisation')}, vehicles, {r6('cost')} FROM v_best_headway")
def k6b(fx):
    return rounded(sc.best_headway(sc.headway_grid(_hourly(fx))))


@check(
    "K7_fleet_limit",
    f"""SELECT route, {r6('demand')}, CAST(CASE WHEN total <= 60 THEN headway ELSE floor(120 / (60 - total + vehicles)) END AS INT) AS headway, {r6('trips_per_hour', 'utilisation')},
      CAST(CASE WHEN total <= 60 THEN vehicles ELSE 60 - (total - vehicles) END AS INT) AS vehicles, {r6('cost')}
    FROM (SELECT *, sum(vehicles) OVER (ORDER BY route) AS total FROM v_best_headway) WHERE total <= 60 OR total - vehicles < 60""",
)
def k7(fx):
    return rounded(sc.apply_fleet_limit(sc.best_headway(sc.headway_grid(_hourly(fx))), 60))


def _fixed_trips(fx):
    slots = stage(sc.slot_demand(fx.slot_input))
    return stage(sc.trip_loads(sc.fixed_timetable(slots), slots))


def _kpi_sql(source: str, key: str | None = None) -> str:
    head = f"{key}, " if key else ""
    return f"""SELECT {head}count(*) AS trips, round(sum(wait_minutes) / sum(served_passengers), 6) AS mean_wait, round(avg(served_passengers / 50), 6) AS mean_occupancy,
      round(max(served_passengers / 50), 6) AS peak_occupancy, round(avg(CASE WHEN served_passengers / 50 < 0.2::DOUBLE THEN 1.0 ELSE 0.0 END), 6) AS empty_run_share,
      round(count(*) * 45 / 60, 6) AS vehicle_hours, round(quantile_cont(CASE WHEN served_passengers <> 0 THEN wait_minutes / served_passengers END, 0.95), 6) AS p95_wait FROM {source}""" + (
        f" GROUP BY {key}" if key else ""
    )


@check("K8_schedule_kpis", _kpi_sql("v_final_loads"))
def k8(fx):
    return rounded(sc.schedule_kpis(_fixed_trips(fx)))


@check("K8_kpis_per_route", _kpi_sql("v_final_loads", "route"))
def k8b(fx):
    return rounded(sc.schedule_kpis(_fixed_trips(fx), ["route"]))


@check(
    "K9_compare",
    """SELECT metric, round(value, 6) AS value FROM (
      SELECT unnest(['wait_ours','wait_other','load_ours','load_other','wait_improvement_pct','load_improvement_pct','saved_trips']) AS metric,
        unnest([a.w, b.w, a.l, b.l, (b.w - a.w) / b.w * 100, (a.l - b.l) / b.l * 100, CAST(b.n - a.n AS DOUBLE)]) AS value FROM
      (SELECT count(*) AS n, sum(wait_minutes) / sum(served_passengers) AS w, avg(served_passengers / 50) AS l FROM v_candidates JOIN v_final_loads USING (route, slot) WHERE candidate = 2) a,
      (SELECT count(*) AS n, sum(wait_minutes) / sum(served_passengers) AS w, avg(served_passengers / 50) AS l FROM v_final_loads) b)""",
)
def k9(fx):
    slots = stage(sc.slot_demand(fx.slot_input))
    half = stage(sc.trip_loads(candidate_timetables(slots, (2,)), slots))
    fixed = stage(sc.trip_loads(sc.fixed_timetable(slots), slots))
    return rounded(sc.compare(sc.schedule_kpis(half), sc.schedule_kpis(fixed)))


@check(
    "K10_trip_board",
    """SELECT route, time AS departure_time, time + INTERVAL 45 MINUTE AS end_time, strftime(time, '%H:%M') AS label, served_passengers, served_passengers / 50 >= 0.8::DOUBLE AS well_used,
      printf('%.1f%%', served_passengers / 50 * 100) AS load_text FROM v_final_loads""",
)
def k10(fx):
    from transit_spark.functions.text import format_pct

    board = sc.trip_board(_fixed_trips(fx)).withColumn("load_text", format_pct("load_factor"))
    return board.select("route", "departure_time", "end_time", "label", "served_passengers", "well_used", "load_text")


@check(
    "K11_sensitivity",
    """WITH s AS (SELECT h.route, h.demand * (100 + p) / 100 AS demand, CAST(p AS INT) AS demand_pct FROM v_hourly h, (SELECT unnest([-20,-10,0,10,20]) AS p)),
    g AS (SELECT *, 60.0::DOUBLE / h AS tph, demand / (60.0::DOUBLE / h * 50) AS u FROM s, (SELECT unnest(range(5, 61)) AS h)),
    c AS (SELECT *, h / 2 * demand * 0.7 + 0.3 * CASE WHEN u < 0.7::DOUBLE THEN (0.7::DOUBLE - u) * demand WHEN u > 0.9::DOUBLE THEN 2 * (u - 0.9::DOUBLE) * demand ELSE 0 END AS cost FROM g),
    b AS (SELECT *, CAST(ceil(120.0 / h) AS INT) AS vehicles FROM c QUALIFY row_number() OVER (PARTITION BY demand_pct, route ORDER BY cost, h) = 1),
    f AS (SELECT *, floor(60 * (100 + q) / 100) AS fleet, sum(vehicles) OVER (PARTITION BY demand_pct, q ORDER BY route) AS total FROM b, (SELECT unnest([-10,-5,0,5,10]) AS q)),
    k AS (SELECT demand_pct, q, demand, CASE WHEN total <= fleet THEN h ELSE floor(120 / (fleet - total + vehicles)) END AS headway,
        CASE WHEN total <= fleet THEN vehicles ELSE fleet - total + vehicles END AS vehicles FROM f WHERE total <= fleet OR total - vehicles < fleet)
    SELECT demand_pct, CAST(q AS INT) AS fleet_pct, count(*) AS routes_served, CAST(sum(vehicles) AS BIGINT) AS vehicles, round(sum(headway / 2 * demand) / sum(demand), 6) AS mean_wait FROM k GROUP BY ALL""",
)
def k11(fx):
    return rounded(sc.sensitivity(_hourly(fx), 60))


@check("K12_robust_demand", "SELECT seq, round(avg(m) + 2 * stddev_pop(m), 6) AS robust_demand FROM (SELECT seq, m1 AS m FROM v_members UNION ALL SELECT seq, m2 FROM v_members UNION ALL SELECT seq, m3 FROM v_members) GROUP BY seq")
def k12(fx):
    df = fc.interval_from_members(fx.view("members"), F.array("m1", "m2", "m3"))
    return rounded(sc.robust_demand(df).select("seq", "robust_demand"))


@check("P5_plan_day")
def p5(fx):
    """Forecast, timetable choice and comparison with the fixed timetable."""
    return rounded(plan_day(fx.demand).comparison, 4)


@check("P5_planned_trips")
def p5b(fx):
    """Trips of the chosen timetables."""
    trips = plan_day(fx.demand).schedule
    return trips.select("route", "day", "slot", "candidate", "served_passengers", "load_factor")


_COMPARED_SQL = """SELECT metric, round(value, 4) AS value FROM (
      SELECT unnest(['wait_ours','wait_other','load_ours','load_other','wait_improvement_pct','load_improvement_pct','saved_trips']) AS metric,
        unnest([a.w, b.w, a.l, b.l, (b.w - a.w) / nullif(b.w, 0) * 100, (a.l - b.l) / b.l * 100, CAST(b.n - a.n AS DOUBLE)]) AS value FROM
      (SELECT count(*) AS n, sum(wait_minutes) / sum(served_passengers) AS w, avg(served_passengers / 50) AS l FROM v_p_trips) a,
      (SELECT count(*) AS n, sum(wait_minutes) / sum(served_passengers) AS w, avg(served_passengers / 50) AS l FROM v_p_final_loads) b)"""


@check("P5_plan_day_lines", _COMPARED_SQL)
def p5c(fx):
    """The whole plan from one line per route: forecast, timetable choice, comparison with the fixed timetable."""
    return rounded(plan_day(fx.demand, length=1, ridge=0.0).comparison, 4)


@check("P5_planned_trips_lines", "SELECT route, day, slot, candidate, served_passengers, served_passengers / 50 AS load_factor FROM v_p_trips")
def p5d(fx):
    """Trips of the timetables chosen from the lines."""
    trips = plan_day(fx.demand, length=1, ridge=0.0).schedule
    return trips.select("route", "day", "slot", "candidate", "served_passengers", "load_factor")
