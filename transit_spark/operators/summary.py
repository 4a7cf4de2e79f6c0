"""Aggregates, exact quantiles, reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_spark.operators.series import RANGE, ranged, running_total


def same_keys(left: DataFrame, right: DataFrame, keys) -> Column:
    """Equi-join condition that also matches NULL keys."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def attach(df: DataFrame, stats: DataFrame, keys):
    """(df joined with the statistics of its group, accessor for a statistic).

    Without keys the single row is read as a scalar subquery, so no join is planned at all.
    """
    names = [c for c in stats.columns if c not in keys]
    if not keys:
        row = stats.select(F.struct(*names)).scalar()
        return df, lambda name: row[name]
    right = stats.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(c).alias(f"_stat_{c}") for c in names]
    )
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return df.join(right, on, "left"), lambda name: F.col(f"_stat_{name}")


def exact_quantiles(df: DataFrame, value: str, probs, keys=(), accuracy: int = 10_000) -> DataFrame:
    """(keys, prob, value): exact, linearly interpolated quantiles.

    ``percentile`` would hold all distinct values of a group in the memory of one task. Here a
    mergeable sketch first brackets every wanted rank and meets every row where it lies; the values
    below the bracket are reduced to a count on the map side, those above are not shuffled, and only
    the bracket (about 8/``accuracy`` of the rows) is sorted: in ranges of like size, each summed by itself, so
    that no bracket of any group lies in one task. In a group of at most ``accuracy`` rows the bracket
    holds them all.
    """
    keys = list(keys)
    margin = 4.0 / accuracy
    marks = [m for p in probs for m in (max(0.0, p - margin), min(1.0, p + margin))]
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    sketch = data.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("_v", marks, accuracy).alias("marks"),
    )
    joined, stat = attach(data, sketch, keys)
    n, found = stat("n"), stat("marks")

    def wanted(i: int, p: float) -> Column:
        lo = F.when(n <= accuracy, F.lit(float("-inf"))).otherwise(F.get(found, F.lit(2 * i)))
        hi = F.when(n <= accuracy, F.lit(float("inf"))).otherwise(F.get(found, F.lit(2 * i + 1)))
        v = F.col("_v")
        return F.when(
            v <= hi,
            F.struct(F.lit(p).alias("prob"), F.when(v >= lo, v).alias("cell"), n.alias("n")),
        )

    cells = (
        joined.select(
            *keys,
            F.explode(F.array(*[wanted(i, p) for i, p in enumerate(probs)])).alias("w"),
        )
        .where(F.col("w").isNotNull())
        .groupBy(*keys, F.col("w.prob").alias("prob"), F.col("w.n").alias("n"), F.col("w.cell").alias("cell"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    group = [*keys, "prob", "n"]
    summed = running_total(ranged(cells, [*group, "cell"]), group, ["cell"], "c", F.col(RANGE))
    ranked = summed.withColumns({"top": F.col("_total"), "rank": F.col("prob") * (F.col("n") - 1)})

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("top")) & (rank >= F.col("top") - F.col("c")), F.col("cell")))

    picked = ranked.groupBy(*keys, "prob").agg(
        at(F.floor("rank")).alias("lo"),
        at(F.ceil("rank")).alias("hi"),
        F.max(F.col("rank") - F.floor("rank")).alias("part"),
    )
    return picked.select(*keys, "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("value"))


def quantile_columns(df: DataFrame, value: str, named: dict[str, float], keys=()) -> DataFrame:
    """One row per group, one column per named quantile."""
    long = exact_quantiles(df, value, list(named.values()), keys)
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name) for name, p in named.items()]
    )


def to_long(df: DataFrame, cols, ids=(), as_type: str = "double") -> DataFrame:
    """(ids, column, value): the given columns under one type, one row per cell."""
    ids = list(ids)
    same = df.select(*ids, *[F.col(c).cast(as_type).alias(c) for c in cols])
    return same.unpivot(ids, list(cols), "column", "value")


def demand_by_time(df: DataFrame, value: str = "passengers") -> DataFrame:
    return df.groupBy("route", "time").agg(F.sum(value).alias("total_demand"))


def demand_by_hour(df: DataFrame, value: str = "passengers") -> DataFrame:
    return df.groupBy(F.hour("time").alias("hour"), "route").agg(F.sum(value).alias("total_demand"))


def trips_by_route(df: DataFrame) -> DataFrame:
    return df.groupBy("route").agg(F.count(F.lit(1)).alias("trips"))


def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """Most frequent values first; ties by value. With ``k`` only the first k are kept."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.col("n").desc(), col)
    return ordered if k is None else ordered.limit(k)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def n_unique(df: DataFrame, cols) -> DataFrame:
    """Distinct non-null values per column, one row each."""
    long = to_long(df, cols, as_type="string")
    return (
        long.where(F.col("value").isNotNull()).distinct()
        .groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    )


def stops_per_route(df: DataFrame) -> DataFrame:
    per_route = df.groupBy("route").agg(F.count(F.lit(1)).alias("n"))
    return per_route.agg((F.sum("n") / F.count("route")).alias("stops_per_route"))


def column_stats(df: DataFrame, cols, stats: dict) -> DataFrame:
    """One row per column. All columns are aggregated side by side in one pass, then turned."""
    wide = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{name}_{i}") for i, c in enumerate(cols) for name, f in stats.items()]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{name}_{i}").alias(name) for name in stats])
            for i, c in enumerate(cols)
        ]
    )
    return wide.select(F.inline(rows))


def describe(df: DataFrame, cols) -> DataFrame:
    """count, mean, std, min, exact quartiles and max, one row per column."""
    moments = column_stats(
        df, cols, {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    )
    quartiles = quantile_columns(to_long(df, cols), "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column"])
    return moments.join(quartiles, "column", "left")


def rank_correlations(df: DataFrame, target: str, cols, k: int = 15) -> DataFrame:
    """Pearson correlation of each column with the target, strongest positive first."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "feature", "correlation")
    return (
        long.where(F.col("correlation").isNotNull())
        .orderBy(F.col("correlation").desc(), "feature").limit(k)
    )


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.distinct()


def union_all(dfs) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def melt(df: DataFrame, ids, var: str = "variable", val: str = "value") -> DataFrame:
    return df.unpivot(list(ids), [c for c in df.columns if c not in ids], var, val)


def top_k(df: DataFrame, order, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def variant_summary(stops: DataFrame, points: DataFrame) -> DataFrame:
    """Stop count and path-point count per (route, direction, variant)."""
    keys = ["route_id", "direction", "variant_id"]
    n_stops = stops.groupBy(*keys).agg(F.count(F.lit(1)).alias("stop_count"))
    n_points = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("point_count"))
    return n_stops.join(n_points, keys, "left").withColumn(
        "point_count", F.coalesce(F.col("point_count"), F.lit(0).cast("long"))
    )
