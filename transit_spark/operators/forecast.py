"""Windows, models and forecasts over many series at once."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transit_spark import config as C
from transit_spark.functions.temporal import epoch_micros, plus_minutes
from transit_spark.operators.evaluation import EPS, error_frame, metrics
from transit_spark.operators.scaling import fit_scaler, scale, unscale
from transit_spark.operators.series import fill_both, in_chunks, tail, with_positions
from transit_spark.operators.summary import union_all
from transit_spark.session import stage

DEFAULTS = C.ForecastDefaults()
SERIES = ("route", "stop")


def series(df: DataFrame, route: str | None = None, stop: str | None = None) -> DataFrame:
    if route is not None:
        df = df.where(F.col("route") == route)
    if stop is not None:
        df = df.where(F.col("stop") == stop)
    return df


def time_split(df: DataFrame, keys=SERIES, order=("time",), train: float = DEFAULTS.train, val: float = DEFAULTS.val, block=None):
    """Adds ``split``: the first int(n*train) rows of a series, the next int(n*val), the rest."""
    placed = with_positions(df, keys, order, block)
    n_train = F.floor(F.col("_size") * F.lit(train))
    n_val = F.floor(F.col("_size") * F.lit(val))
    label = F.when(F.col("_pos") <= n_train, "train").when(F.col("_pos") <= n_train + n_val, "val").otherwise("test")
    return placed.withColumn("split", label).drop("_pos", "_size")


def available_features(df: DataFrame, features=C.FORECAST_FEATURES, target: str = C.TARGET) -> list[str]:
    """Wanted features the frame has, target last."""
    return [c for c in features if c in df.columns and c != target] + [target]


def fill_series(df: DataFrame, features=C.FORECAST_FEATURES, keys=SERIES, order=("time",), target: str = C.TARGET) -> DataFrame:
    cols = available_features(df, features, target)
    return fill_both(df.select(*keys, *order, *cols), keys, order, cols)


def prepare_series(df: DataFrame, features=C.FORECAST_FEATURES, keys=SERIES, order=("time",), target: str = C.TARGET):
    """(scaled frame with ``split``, scaler). Fills per series; fits on the training rows only."""
    cols = available_features(df, features, target)
    labelled = stage(time_split(fill_series(df, features, keys, order, target), keys, order))
    params = fit_scaler(labelled.where(F.col("split") == "train"), cols, "minmax", "series_minmax")
    return scale(labelled, params), params


def windows(
    df: DataFrame, cols, length: int = DEFAULTS.sequence_length, horizon: int = DEFAULTS.horizon,
    step: int = DEFAULTS.step, keys=SERIES, order=("time",), target: str | None = None, block=None,
) -> DataFrame:
    """Sliding windows per series: ``x`` holds ``length`` rows of ``cols`` and ``y`` the target
    ``horizon`` rows after the window. ``time`` is the time of the window's last row."""
    keys, cols = list(keys), list(cols)
    target = target or cols[-1]
    placed = with_positions(df.select(*dict.fromkeys([*keys, *order, *cols, target])), keys, order, block)
    rows, chunk = in_chunks(placed, keys, before=length - 1, after=horizon)
    values = F.array(*[F.col(c).cast("double") for c in cols])
    out = rows.select(
        *keys, order[0], "_pos", "_size", "_halo",
        F.collect_list(values).over(chunk.rowsBetween(-(length - 1), 0)).alias("x"),
        F.lead(F.col(target).cast("double"), horizon).over(chunk).alias("y"),
    )
    pos = F.col("_pos")
    full = (pos >= length) & ((pos - length) % step == 0) & (pos + horizon <= F.col("_size"))
    return out.where(~F.col("_halo") & full).select(
        *keys, order[0], (pos - length).alias("start"), (F.col("_size")).alias("series_rows"), "x", "y"
    )


def latest_windows(df: DataFrame, cols, length: int = DEFAULTS.sequence_length, keys=SERIES, order=("time",)):
    """(last full window per series, series that are too short)."""
    keys, order = list(keys), list(order)
    last = tail(df, keys, length, order)
    values = F.array(*[F.col(c).cast("double") for c in cols])
    # At most ``length`` rows per series are left here.
    packed = last.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*order, values.alias("v")))).alias("rows")
    ).select(*keys, F.element_at("rows", -1)[order[0]].alias("time"), F.transform("rows", lambda r: r["v"]).alias("x"))
    short = packed.where(F.size("x") < length).select(*keys, F.size("x").alias("rows_found"))
    return packed.where(F.size("x") == length), short


# --- models -------------------------------------------------------------------------------------


def _with_features(df: DataFrame) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.flatten("x")))


def fit_forecaster(train: DataFrame, kind: str = "linear", reg: float = 0.0, elastic: float = 0.0, seed: int = 42, weight: str | None = None):
    """One global model over all series' windows; ``weight`` names a column of row weights."""
    data = _with_features(train.where(F.col("y").isNotNull())).select("features", "y", *([weight] if weight else []))
    weighted = {"weightCol": weight} if weight else {}
    if kind == "linear":
        return LinearRegression(labelCol="y", regParam=reg, elasticNetParam=elastic, solver="auto", **weighted).fit(data)
    if kind == "gbt":
        return GBTRegressor(labelCol="y", maxIter=20, maxDepth=4, seed=seed, **weighted).fit(data)
    raise ValueError(f"unknown model kind: {kind}")


def linear_score(x: Column, weights: Column) -> Column:
    """Intercept (last weight) plus the dot product of the flattened window with the weights."""
    products = F.zip_with(F.concat(F.flatten(x), F.array(F.lit(1.0))), weights, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, v: total + v)


def weights_of(model: LinearRegressionModel) -> Column:
    return F.array(*[F.lit(float(w)) for w in [*model.coefficients.toArray(), model.intercept]])


def predict(model, df: DataFrame, name: str = "prediction") -> DataFrame:
    """Linear models become a projection; others go through ``transform``."""
    if isinstance(model, LinearRegressionModel):
        return df.withColumn(name, linear_score(F.col("x"), weights_of(model)))
    return model.transform(_with_features(df)).drop("features").withColumnRenamed("prediction", name)


def moment_rows(train: DataFrame, size: int, keys=(), y: str = "y") -> DataFrame:
    """(keys, i, row): row i of the matrix of summed products of (window values, 1, y), per key.

    Every window gives one row per value, holding its products with all others; they are summed where
    they lie, so only ``size + 2`` rows of sums per key and task are shuffled, and the plan has as many sums as the
    window has values. A window of another size is an error, as its products would belong to other columns.
    """
    n = size + 2
    flat = F.flatten("x")
    checked = F.when(F.size(flat) == size, flat).otherwise(
        F.raise_error(F.concat(F.lit(f"a window holds other than {size} values: "), F.size(flat).cast("string")))
    )
    rows = train.where(F.col(y).isNotNull()).select(*keys, F.concat(checked, F.array(F.lit(1.0), F.col(y).cast("double"))).alias("v"))
    long = rows.select(*keys, "v", F.posexplode("v").alias("i", "a"))
    sums = long.groupBy(*keys, "i").agg(*[F.sum(F.col("a") * F.get("v", F.lit(j))).alias(f"s{j}") for j in range(n)])
    return sums.select(*keys, "i", F.array(*[f"s{j}" for j in range(n)]).alias("row"))


def moments(train: DataFrame, size: int, keys=(), y: str = "y") -> DataFrame:
    """(keys, m): the whole matrix per key, as an array of its rows; as large as the window, not the data."""
    rows = moment_rows(train, size, keys, y)
    packed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "row"))).alias("m"))
    return packed.select(*keys, F.transform("m", lambda r: r["row"]).alias("m"))


def solve_moments(m: np.ndarray, reg: float = 0.0, elastic: float = 0.0, ridge: float = 0.0, tol: float = 1e-9, rounds: int = 10_000) -> np.ndarray:
    """Weights (values, then intercept) that minimise the squared error, from the matrix of sums.

    ``reg`` and ``elastic`` penalise as Spark ML does with standardised columns: reg * (elastic * |w| +
    (1 - elastic) / 2 * w^2) on the scale of the columns' and the target's deviations. ``ridge`` is a plain
    constant added to the diagonal of the raw sums. Columns without spread get weight 0. The system is solved on
    standardised columns, by least squares of least norm where it is singular; with ``elastic`` by coordinate
    descent on the matrix.
    """
    m = np.asarray(m, dtype=float)
    k = len(m) - 2
    n = m[k, k]
    mean = m[k, : k] / n
    y_mean = m[k, k + 1] / n
    cov = m[:k, :k] / n - np.outer(mean, mean)
    cross = m[:k, k + 1] / n - mean * y_mean
    spread = np.sqrt(np.clip(np.diag(cov), 0, None))
    y_spread = np.sqrt(max(m[k + 1, k + 1] / n - y_mean**2, 0.0))
    live = spread > 1e-12 * np.maximum(np.abs(mean), 1e-300)
    weights = np.zeros(k)
    if live.any() and (ridge or y_spread > 0):
        s = spread[live]
        gram, target = cov[np.ix_(live, live)] / np.outer(s, s), cross[live] / s
        penalty = reg / y_spread if y_spread > 0 else 0.0
        if penalty and elastic:
            w = np.zeros(len(s))
            target = target / y_spread
            for _ in range(rounds):
                moved = 0.0
                for j in range(len(w)):
                    rest = target[j] - gram[j] @ w + gram[j, j] * w[j]
                    new = np.sign(rest) * max(abs(rest) - penalty * elastic, 0.0) / (gram[j, j] + penalty * (1 - elastic))
                    moved, w[j] = max(moved, abs(new - w[j])), new
                if moved < tol:
                    break
            weights[live] = w * y_spread / s
        else:
            system = gram + penalty * np.eye(len(s)) + np.diag(ridge / (n * s * s))
            weights[live] = np.linalg.lstsq(system, target, rcond=1e-12)[0] / s
    return np.append(weights, y_mean - weights @ mean)


def fit_per_route(train: DataFrame, size: int, key: str = "route", ridge: float = 1e-6) -> DataFrame:
    """(key, weights): least squares per route from sums of products.

    Only the sums are shuffled (combined on the map side), so a route with most of the rows is no
    heavier than any other; solving a system of ``size + 1`` unknowns per route is what is left.
    """

    def solve(batches):
        for batch in batches:
            found = [solve_moments(np.stack(m), ridge=ridge).tolist() for m in batch["m"]]
            yield pd.DataFrame({key: batch[key], "weights": found})

    summed = moments(train, size, [key])
    return summed.mapInPandas(solve, f"`{key}` {dict(summed.dtypes)[key]}, weights array<double>")


def predict_per_route(weights: DataFrame, df: DataFrame, key: str = "route") -> DataFrame:
    return df.join(weights, key).withColumn("prediction", linear_score(F.col("x"), F.col("weights"))).drop("weights")


def _next_window(x: Column, prediction: Column) -> Column:
    """Window moved by one row: the new row repeats the last one with the target replaced."""
    last = F.element_at(x, -1)
    row = F.concat(F.slice(last, F.lit(1), F.size(last) - 1), F.array(prediction))
    return F.concat(F.slice(x, F.lit(2), F.size(x) - 1), F.array(row))


def recursive_forecast(df: DataFrame, weights: Column, n: int) -> DataFrame:
    """``n`` steps for every series in one narrow pass: the recursion runs inside the row."""
    start = F.struct(F.col("x").alias("x"), F.expr("CAST(array() AS array<double>)").alias("done"))

    def advance(state: Column, _: Column) -> Column:
        p = linear_score(state["x"], weights)
        return F.struct(_next_window(state["x"], p).alias("x"), F.concat(state["done"], F.array(p)).alias("done"))

    return df.withColumn("predictions", F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, advance, lambda s: s["done"]))


def forecast(model, latest: DataFrame, n: int = DEFAULTS.future_steps, minutes: int = 15, every: int = 8) -> DataFrame:
    """(keys, step, time, predicted_demand): recursive forecast from each series' last window."""
    keys = [c for c in latest.columns if c not in ("x", "time")]
    if isinstance(model, LinearRegressionModel):
        done = recursive_forecast(latest, weights_of(model), n)
    else:
        # One model call per step for all series together; lineage is cut every few steps.
        state = latest.withColumn("predictions", F.expr("CAST(array() AS array<double>)"))
        for i in range(1, n + 1):
            state = predict(model, state).withColumns(
                {
                    "x": _next_window(F.col("x"), F.col("prediction")),
                    "predictions": F.concat(F.col("predictions"), F.array("prediction")),
                }
            ).drop("prediction")
            if i % every == 0 and i < n:
                state = stage(state)
        done = state
    return _steps(done, keys, minutes)


def forecast_per_route(weights: DataFrame, latest: DataFrame, n: int = DEFAULTS.future_steps, minutes: int = 15, key: str = "route"):
    keys = [c for c in latest.columns if c not in ("x", "time")]
    joined = latest.join(weights, key)
    return _steps(recursive_forecast(joined, F.col("weights"), n), keys, minutes)


def _steps(done: DataFrame, keys, minutes: int) -> DataFrame:
    return done.select(*keys, "time", F.posexplode("predictions").alias("_i", "predicted_demand")).select(
        *keys,
        (F.col("_i") + 1).alias("step"),
        plus_minutes("time", (F.col("_i") + 1) * minutes).alias("time"),
        "predicted_demand",
    )


#: How often a row is drawn in a bootstrap sample: the Poisson distribution of mean 1 up to each count.
DRAWN_AT_MOST = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183)


def drawn(keys, time: str, member: int) -> Column:
    """How often a member draws a row: decided by a checksum of its key, whatever the partitioning."""
    name = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], epoch_micros(time).cast("string"), F.lit(str(member)))
    place = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / float(1 << 32)
    count = F.lit(float(len(DRAWN_AT_MOST)))
    for times in reversed(range(len(DRAWN_AT_MOST))):
        count = F.when(place < DRAWN_AT_MOST[times], float(times)).otherwise(count)
    return count


def fit_ensemble(train: DataFrame, n: int = DEFAULTS.ensemble, seed: int = 42, keys=SERIES, time: str = "time", **options) -> list:
    """Models of ``n`` bootstrap samples of the windows, drawn by weights."""
    train = stage(train)
    return [fit_forecaster(train.withColumn("_drawn", drawn(keys, time, seed + i)), weight="_drawn", **options) for i in range(n)]


def interval_from_members(df: DataFrame, members: Column, level: float = DEFAULTS.confidence) -> DataFrame:
    """Mean of the members' predictions ± z times their population deviation."""
    z = NormalDist().inv_cdf((1 + level) / 2)
    n = F.size(members)
    mean = F.aggregate(members, F.lit(0.0), lambda t, v: t + v) / n
    spread = F.sqrt(F.aggregate(members, F.lit(0.0), lambda t, v: t + (v - mean) * (v - mean)) / n)
    return df.withColumns(
        {"predicted": mean, "predicted_std": spread, "lower": mean - spread * z, "upper": mean + spread * z}
    )


def predict_interval(models, df: DataFrame, level: float = DEFAULTS.confidence) -> DataFrame:
    names = [f"_member_{i}" for i in range(len(models))]
    for model, name in zip(models, names):
        df = predict(model, df, name)
    return interval_from_members(df, F.array(*names), level).drop(*names)


def predict_latest(model, df: DataFrame, cols, length: int = DEFAULTS.sequence_length, keys=SERIES, order=("time",)):
    """(one prediction per series, series with fewer than ``length`` rows)."""
    full, short = latest_windows(df, cols, length, keys, order)
    return predict(model, full).drop("x"), short


def predict_frame(model, prepared: DataFrame, params: DataFrame, cols, target: str = C.TARGET, **options) -> DataFrame:
    """Predictions of all windows on the original scale, with error columns."""
    scored = predict(model, windows(prepared, cols, target=target, **options), "predicted").drop("x")
    real = unscale(scored.withColumnRenamed("y", "actual"), params, renamed={"actual": target, "predicted": target})
    return error_frame(real)


def held_out(prepared: DataFrame, params: DataFrame, cols, grid=({},), target: str = C.TARGET, keys=SERIES, **options):
    """(model, setting, scores per group of the test rows on the original scale).

    No window crosses the border of a split: the split is part of the series' key. Every setting of
    ``grid`` is fitted on the training windows, the one with the least error on the validation windows
    is chosen (the first one, if they tie), and only that one meets the test windows.
    """
    from transit_spark.operators.evaluation import metrics

    own = [*keys, "split"]
    cut = stage(windows(prepared, cols, target=target, keys=own, **options))
    parts = {name: cut.where(F.col("split") == name) for name in ("train", "val", "test")}
    fitted = [(fit_forecaster(parts["train"], **setting), setting) for setting in grid]
    if len(fitted) > 1:
        tried = parts["val"]
        for i, (model, _) in enumerate(fitted):
            tried = predict(model, tried, f"_p{i}")
        errors = tried.agg(*[F.avg(F.abs(F.col("y") - F.col(f"_p{i}"))).alias(f"e{i}") for i in range(len(fitted))]).first()
        best = min(range(len(fitted)), key=lambda i: (errors[i] is None, errors[i]))
    else:
        best = 0
    model, setting = fitted[best]
    scored = predict(model, parts["test"], "predicted").drop("x").withColumnRenamed("y", "actual")
    real = unscale(scored, params, renamed={"actual": target, "predicted": target})
    return model, setting, metrics(real, [keys[0]])


def save_model(model, features, path: str) -> None:
    """Model and its feature list side by side."""
    spark = _session()
    model.write().overwrite().save(f"{path}/model")
    rows = [(type(model).__name__, i, f) for i, f in enumerate(features)]
    spark.createDataFrame(rows, "kind string, position int, feature string").write.mode("overwrite").parquet(f"{path}/features")


def load_model(path: str):
    """(model, feature list)."""
    rows = sorted(_session().read.parquet(f"{path}/features").collect(), key=lambda r: r["position"])
    loader = {"LinearRegressionModel": LinearRegressionModel, "GBTRegressionModel": GBTRegressionModel}[rows[0]["kind"]]
    return loader.load(f"{path}/model"), [r["feature"] for r in rows]


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.active()


# --- baselines and model selection --------------------------------------------------------------


def moving_average(df: DataFrame, days: int, keys=SERIES, value: str = C.TARGET) -> DataFrame:
    """Mean of the rows in the ``days`` days before each row (the row itself excluded).

    Series are cut into pieces of ``days`` days; each row is also shown to the next piece.
    """
    keys = list(keys)
    span = days * 86_400 * 1_000_000
    micros = df.withColumn("_micros", epoch_micros("time"))
    piece = F.floor(F.col("_micros") / span)
    copies = F.array(
        F.struct(piece.alias("piece"), F.lit(False).alias("halo")),
        F.struct((piece + 1).alias("piece"), F.lit(True).alias("halo")),
    )
    shown = micros.select("*", F.explode(copies).alias("_copy"))
    frame = Window.partitionBy(*keys, "_copy.piece").orderBy("_micros").rangeBetween(-span, -1)
    return (
        shown.withColumn("baseline", F.avg(value).over(frame))
        .where(~F.col("_copy.halo"))
        .select(*df.columns, "baseline")
    )


def same_slot_last_week(df: DataFrame, keys=SERIES, value: str = C.TARGET) -> DataFrame:
    past = df.select(*keys, plus_minutes("time", 7 * 1440).alias("time"), F.col(value).alias("baseline"))
    return df.join(past, [*keys, "time"], "left")


def baseline(df: DataFrame, kind: str, keys=SERIES, value: str = C.TARGET) -> DataFrame:
    if kind in ("ma7", "ma14"):
        return moving_average(df, int(kind[2:]), keys, value)
    if kind == "last_week":
        return same_slot_last_week(df, keys, value)
    raise ValueError(f"unknown baseline: {kind}")


def tune(data: DataFrame, grid: list[dict], folds: int = 3) -> DataFrame:
    """Validation MAPE per setting over time-ordered folds, best first.

    ``data`` comes from :func:`windows`; a setting names ``reg`` and ``elastic``. Fold k trains on the first k/(folds+1) of every series and
    validates on the next part. The windows are read twice, whatever the grid: once for the sums of
    products of each part, of which those before a fold add up to its training sums, and once to score every row with
    all models of its fold.
    """
    for setting in grid:
        if unknown := set(setting) - {"reg", "elastic"}:
            raise ValueError(f"settings of linear models are reg and elastic, not {sorted(unknown)}")
    part = F.floor(F.col("start") * (folds + 1) / F.col("series_rows")).cast("int")
    labelled = stage(data.withColumn("_part", part))
    first = labelled.select(F.size(F.flatten("x")).alias("n")).first()
    if first is None:
        raise ValueError("there are no windows to fit")
    # As many matrices as folds, each as large as a window: the driver adds and solves them.
    sums = {r["_part"]: np.array(r["m"]) for r in moments(labelled.where(F.col("_part") < folds), first["n"], ["_part"]).collect()}
    models = []
    for k in range(1, folds + 1):
        known = [sums[p] for p in range(k) if p in sums]
        if known:
            models += [(k, number, solve_moments(sum(known), **setting).tolist()) for number, setting in enumerate(grid)]
    spark = data.sparkSession
    # One short row of weights per fold and setting; rows meet the models of their fold.
    per_fold = spark.createDataFrame([(k, [(n, w) for f, n, w in models if f == k]) for k in sorted({k for k, _, _ in models})], "_part int, models array<struct<setting: int, weights: array<double>>>")
    scored = labelled.join(per_fold, "_part").select("_part", "y", F.explode(F.transform("models", lambda m: F.struct(m["setting"].alias("setting"), linear_score(F.col("x"), m["weights"]).alias("p")))).alias("s"))
    errors = scored.groupBy("_part", "s.setting").agg(F.avg(F.abs((F.col("y") - F.col("s.p")) / (F.col("y") + EPS)) * 100).alias("mape"))
    names = spark.createDataFrame([(n, str(setting)) for n, setting in enumerate(grid)], "setting int, options string")
    return errors.groupBy("setting").agg(F.avg("mape").alias("mape")).join(names, "setting").select("setting", "options", "mape").orderBy("mape", "setting")


def error_by_horizon(df: DataFrame, value: str, steps=(1, 2, 4), keys=SERIES, order=("time",), minutes: int = 15, predicted: str | None = None):
    """Scores of the forecast made at each row against the value 1, 2 and 4 rows later."""
    keys = list(keys)
    rows, chunk = in_chunks(with_positions(df, keys, order), keys, after=max(steps))
    later = F.array(
        *[F.struct(F.lit(s * minutes).alias("horizon_minutes"), F.lead(value, s).over(chunk).alias("actual")) for s in steps]
    )
    seen = rows.withColumn("_later", later).where(~F.col("_halo"))
    long = seen.select(F.col(predicted or value).cast("double").alias("predicted"), F.explode("_later").alias("l"))
    flat = long.select("l.horizon_minutes", F.col("l.actual").cast("double").alias("actual"), "predicted")
    return metrics(flat, ["horizon_minutes"])


def demand_profiles(df: DataFrame, value: str = C.TARGET) -> DataFrame:
    """One row per route with the mean demand of each hour (0 where there is none)."""
    hours = list(range(24))
    mean = df.groupBy("route").pivot("hour", hours).agg(F.avg(value)) if "hour" in df.columns else (
        df.withColumn("hour", F.hour("time")).groupBy("route").pivot("hour", hours).agg(F.avg(value))
    )
    return mean.select("route", *[F.coalesce(F.col(str(h)), F.lit(0.0)).alias(f"h{h}") for h in hours])


def _gap(a: Column, b: Column) -> Column:
    """Squared distance of two arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, v: t + v)


def _vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def cluster_profiles(profiles: DataFrame, cols, k: int = 3, rounds: int = 10, key: str = "route", digits: int = 9) -> tuple[DataFrame, DataFrame]:
    """((key, cluster, distance), (cluster, size, inertia, centre)): the same for any partitioning.

    Centres start farthest-first: the profile of the smallest key, then always the one farthest
    from its nearest centre, the smallest key on ties. ``rounds`` steps move each centre to the mean of its
    profiles; an emptied cluster keeps its centre, and equal distances go to the lower number. Distances are compared
    rounded to ``digits``, so that the order of summing decides nothing. Only the centres, ``k`` rows, reach the driver.
    """
    if k < 1:
        raise ValueError("at least one cluster is needed")
    rows = stage(profiles.select(key, F.array(*[F.col(c).cast("double") for c in cols]).alias("v")))
    first = rows.agg(F.min_by("v", key).alias("v")).first()["v"]
    centres = [] if first is None else [first]

    def distance(c) -> Column:
        return F.round(_gap(F.col("v"), _vector(c)), digits)

    def nearest() -> Column:
        return F.array_min(F.array(*[F.struct(distance(c).alias("d"), F.lit(i).alias("cluster")) for i, c in enumerate(centres)]))

    while centres and len(centres) < k:
        far = rows.agg(F.min_by(F.struct(nearest()["d"].alias("d"), "v"), F.struct(-nearest()["d"], F.col(key))).alias("f")).first()["f"]
        if not far["d"]:
            break  # there are no more different profiles
        centres.append(far["v"])
    for _ in range(rounds):
        if not centres:
            break
        means = rows.groupBy(nearest()["cluster"].alias("cluster")).agg(F.array(*[F.avg(F.get("v", F.lit(j))) for j in range(len(cols))]).alias("v")).collect()
        moved = {r["cluster"]: r["v"] for r in means}
        new = [moved.get(i, c) for i, c in enumerate(centres)]
        if new == centres:
            break
        centres = new
    found = nearest() if centres else F.lit(None).cast("struct<d: double, cluster: int>")
    assigned = rows.select(key, found["cluster"].alias("cluster"), found["d"].alias("distance"))
    per_cluster = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.sum("distance").alias("inertia"))
    at = profiles.sparkSession.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "cluster int, centre array<double>")
    return assigned, per_cluster.join(at, "cluster")


def cluster_routes(df: DataFrame, k: int = 3, value: str = C.TARGET, rounds: int = 10) -> DataFrame:
    """Routes grouped by their mean demand of each hour."""
    assigned, _ = cluster_profiles(demand_profiles(df, value), [f"h{h}" for h in range(24)], k, rounds)
    return assigned.select("route", "cluster")


def inertia_by_k(df: DataFrame, most: int = 5, value: str = C.TARGET, rounds: int = 10) -> DataFrame:
    """(k, clusters, inertia): what is left of the spread with 1 to ``most`` clusters."""
    profiles = stage(demand_profiles(df, value))
    parts = []
    for k in range(1, most + 1):
        _, per_cluster = cluster_profiles(profiles, [f"h{h}" for h in range(24)], k, rounds)
        parts.append(per_cluster.agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("clusters"), F.sum("inertia").alias("inertia")))
    return union_all(parts)
