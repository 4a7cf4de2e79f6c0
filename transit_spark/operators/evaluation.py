"""Forecast scores and the tables behind the error plots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_spark.operators.series import RANGE, ranged, running_total
from transit_spark.operators.summary import attach, quantile_columns

EPS = 1e-10


def error_frame(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    return df.withColumns(
        {
            "error": error,
            "abs_error": F.abs(error),
            "pct_error": F.abs(error / (F.col(actual) + EPS)) * 100,
        }
    )


def metrics(df: DataFrame, keys=(), actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """MAE, RMSE, MAPE, R² = 1 - SSE/SST, largest and median absolute error, per group."""
    keys = list(keys)
    pairs = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    errors = error_frame(pairs, actual, predicted)
    # var_pop * n is the total sum of squares, in one numerically stable pass.
    sums = errors.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.avg("pct_error").alias("mape"),
        (F.lit(1.0) - F.try_divide(F.sum(F.col("error") * F.col("error")), F.var_pop(actual) * F.count(F.lit(1)))).alias("r2"),
        F.max("abs_error").alias("max_error"),
    )
    median = quantile_columns(errors, "abs_error", {"median_ae": 0.5}, keys)
    joined, stat = attach(sums, median, keys)
    return joined.select(*sums.columns, stat("median_ae").alias("median_ae"))


def accuracy_report(scores: DataFrame, target_mape: float = 15.0) -> DataFrame:
    accuracy = 100 - F.col("mape")
    return scores.withColumns(
        {
            "accuracy": accuracy,
            "target_accuracy": F.lit(100 - float(target_mape)),
            "target_met": F.col("mape") <= target_mape,
        }
    )


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from min to max, the last one closed; empty bins hold 0."""
    values = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("v"))
    limits = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    row = limits.select(F.struct("lo", "hi")).scalar()
    width = (row["hi"] - row["lo"]) / bins
    index = F.least(F.floor(F.try_divide(F.col("v") - row["lo"], width)), F.lit(bins - 1))
    counts = values.groupBy(F.coalesce(index, F.lit(0)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counts, "bin", "left").select(
        "bin",
        (row["lo"] + F.col("bin") * width).alias("lower"),
        (row["lo"] + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )


def residuals(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    pairs = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return pairs.select(F.col(predicted).alias("predicted"), (F.col(actual) - F.col(predicted)).alias("residual"))


# Coefficients of the published rational approximation of the inverse normal
# distribution (relative error below 1.15e-9).
INV_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
INV_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
INV_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
INV_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)
INV_TAIL = 0.02425


RUN_PART = 100_000


def _poly(coefficients, x: Column) -> Column:
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + F.lit(c)
    return total


def inverse_normal(p: Column) -> Column:
    """Quantile of the standard normal distribution for 0 < p < 1."""

    def tail(q: Column) -> Column:
        t = F.sqrt(F.log(q) * -2)
        return _poly(INV_C, t) / _poly((*INV_D, 1.0), t)

    q = p - 0.5
    r = q * q
    return (
        F.when(p < INV_TAIL, tail(p))
        .when(p > 1 - INV_TAIL, -tail(1 - p))
        .otherwise(_poly(INV_A, r) * q / _poly((*INV_B, 1.0), r))
    )


def qq_points(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """(position, value, theoretical): ordered values against normal quantiles; ``n`` asks for so many evenly
    spaced ones (the first one for n = 1).

    Ordering by value alone is cut into ranges of like size; equal values are interchangeable, so they
    are counted first and expanded only for the positions asked for.
    """
    if n is not None and n < 1:
        raise ValueError("n must be at least 1")
    values = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("c")
    )
    values = ranged(values, ["v"])
    size = values.agg(F.sum("c").cast("double").alias("n")).scalar()
    ranked = running_total(values, [], ["v"], "c", F.col(RANGE)).withColumn("_n", size)
    count = F.col("_n")
    start, end = F.col("_total") - F.col("c"), F.col("_total") - 1
    if n is None:
        # A run of equal values may be very long: expand it in two steps.
        parts = ranked.select("v", end.alias("end"), "_n", F.explode(F.sequence(start, end, F.lit(RUN_PART))).alias("from"))
        upto = F.least(F.col("from") + (RUN_PART - 1), F.col("end"))
        points = parts.select("_n", F.col("v").alias("value"), F.explode(F.sequence(F.col("from"), upto)).alias("position"))
    else:
        # The i-th of n samples sits at floor(i * (N - 1) / (n - 1)); keep those inside this run.
        gap = F.greatest(count - 1, F.lit(1.0)) / F.lit(float(max(n - 1, 1)))
        first = F.greatest(F.ceil(start / gap) - 1, F.lit(0))
        last = F.least(F.floor(end / gap) + 1, F.lit(n - 1))
        sample = F.transform(
            F.sequence(F.least(first, F.lit(n - 1)), last),
            lambda i: F.when((i == n - 1) & (i > 0), count - 1).otherwise(F.floor(i * gap)).cast("long"),
        )
        run = F.array_distinct(F.filter(sample, lambda p: (p >= start) & (p <= end)))
        wanted = F.when(count <= n, F.sequence(start, end)).otherwise(run)
        points = ranked.select("_n", F.col("v").alias("value"), F.explode(wanted).alias("position"))
    i = F.col("position") + 1
    plotting = (
        F.when(i == 1, F.lit(1.0) - F.pow(F.lit(0.5), F.lit(1.0) / count))
        .when(i == count, F.pow(F.lit(0.5), F.lit(1.0) / count))
        .otherwise((i - 0.3175) / (count + 0.365))
    )
    return points.select("position", "value", inverse_normal(plotting).alias("theoretical"))


def paired_t(df: DataFrame, a: str, b: str) -> DataFrame:
    """Paired t statistic with its degrees of freedom."""
    d = F.col(a) - F.col(b)
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    stats = pairs.agg(F.count(F.lit(1)).alias("n"), F.avg(d).alias("mean_diff"), F.stddev_samp(d).alias("std_diff"))
    return stats.select(
        "n", "mean_diff", "std_diff",
        F.try_divide(F.col("mean_diff"), F.col("std_diff") / F.sqrt(F.col("n"))).alias("t"),
        (F.col("n") - 1).alias("dof"),
    )


def chi_square(df: DataFrame, row: str, col: str) -> DataFrame:
    """Chi-square statistic of the (row, col) contingency table, empty cells included."""
    cells = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row, col).agg(F.count(F.lit(1)).alias("o"))
    rows = cells.groupBy(row).agg(F.sum("o").alias("r"))
    cols = cells.groupBy(col).agg(F.sum("o").alias("c"))
    total = cells.agg(F.sum("o").alias("n")).scalar()
    # sum (o-e)²/e over all cells = sum o²/e - n, so cells nobody fell into need no row.
    stat = (
        cells.join(rows, row).join(cols, col)
        .agg((F.sum(F.col("o") * F.col("o") * total / (F.col("r") * F.col("c")))).alias("s"))
    )
    shape = rows.agg(F.count(F.lit(1)).alias("n")).scalar(), cols.agg(F.count(F.lit(1)).alias("n")).scalar()
    return stat.select((F.col("s") - total).alias("chi_square"), ((shape[0] - 1) * (shape[1] - 1)).alias("dof"), total.alias("n"))
