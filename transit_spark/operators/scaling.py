"""Scalers and encoders. Fitted state is a small table: (name, column, method, center, scale, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transit_spark.config import NEVER_AUTO_SCALED
from transit_spark.operators.series import RANGE, ranged, with_positions
from transit_spark.operators.summary import column_stats, quantile_columns, to_long

METHODS = ("minmax", "standard", "robust")
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")
MAX_ONE_HOT = 1000


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if (t in NUMERIC or t.startswith("decimal")) and c not in NEVER_AUTO_SCALED]


def categorical_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def fit_scaler(df: DataFrame, cols=None, method: str = "minmax", name: str | None = None) -> DataFrame:
    """One row per column with centre, scale and the true value range.

    A column without spread gets scale 1, so it maps to 0.
    """
    if method not in METHODS:
        raise ValueError(f"unknown normalization method: {method}")
    cols = list(numeric_columns(df) if cols is None else cols)
    wanted = {"min": F.min, "max": F.max}
    if method == "standard":
        wanted |= {"mean": F.avg, "std": F.stddev_pop}
    stats = column_stats(df, cols, wanted)
    if method == "robust":
        quartiles = quantile_columns(to_long(df, cols), "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column"])
        stats = stats.join(quartiles, "column", "left")
    else:
        stats = stats.withColumns({q: F.lit(None).cast("double") for q in ("q25", "q50", "q75")})
    center = {"minmax": "min", "standard": "mean", "robust": "q50"}[method]
    spread = {"minmax": ("max", "min"), "standard": ("std", None), "robust": ("q75", "q25")}[method]
    spread = F.col(spread[0]) - (F.col(spread[1]) if spread[1] else F.lit(0.0))
    return stats.select(
        F.lit(name or f"features_{method}").alias("name"),
        "column",
        F.lit(method).alias("method"),
        F.col(center).alias("center"),
        F.when(spread == 0, 1.0).otherwise(spread).alias("scale"),
        "min", "max", "q25", "q50", "q75",
    )


def _fitted(params: DataFrame, name: str | None) -> dict[str, tuple[float, float]]:
    """Centre and scale per column: as many rows as the frame has columns."""
    rows = params if name is None else params.where(F.col("name") == name)
    found = {r["column"]: (r["center"], r["scale"]) for r in rows.select("column", "center", "scale").collect()}
    if not found:
        raise ValueError(f"scaler {name or ''} not found; fit it first")
    return found


def scale(df: DataFrame, params: DataFrame, name: str | None = None) -> DataFrame:
    """(x - center) / scale as a plain projection."""
    found = _fitted(params, name)
    missing = [c for c in found if c not in df.columns]
    if missing:
        raise ValueError(f"columns to scale are missing: {missing}")
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in found.items()})


def unscale(df: DataFrame, params: DataFrame, name: str | None = None, cols=None, renamed: dict | None = None) -> DataFrame:
    """x * scale + center. ``renamed`` maps a frame column to the fitted column it stands for, e.g.
    ``{'predicted': 'passengers'}``."""
    found = _fitted(params, name)
    wanted = renamed or {c: c for c in (cols or found)}
    missing = [c for c in wanted.values() if c not in found]
    if missing:
        raise ValueError(f"no scaler for columns: {missing}")
    return df.withColumns(
        {c: F.col(c) * F.lit(found[src][1]) + F.lit(found[src][0]) for c, src in wanted.items()}
    )


def target_name(target: str, method: str) -> str:
    return f"target_{target}_{method}"


def fit_target(df: DataFrame, target: str, method: str = "minmax") -> DataFrame:
    return fit_scaler(df, [target], method, target_name(target, method))


def scale_target(df: DataFrame, params: DataFrame, target: str, method: str = "minmax") -> DataFrame:
    return scale(df, params, target_name(target, method))


def unscale_target(df: DataFrame, params: DataFrame, target: str, method: str = "minmax", column: str | None = None):
    return unscale(df, params, target_name(target, method), renamed={column or target: target})


def _as_class(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit("nan"))


def fit_labels(df: DataFrame, cols) -> DataFrame:
    """(column, value, code): code is the rank of the value among the sorted distinct values."""
    classes = df.select(*[_as_class(c).alias(c) for c in cols]).unpivot([], list(cols), "column", "value").distinct()
    # Ranges of like size, whatever prefix the values share.
    placed = with_positions(ranged(classes, ["column", "value"]), ["column"], ["value"], block=F.col(RANGE))
    return placed.select("column", "value", (F.col("_pos") - 1).cast("int").alias("code"))


def encode(df: DataFrame, labels: DataFrame, cols=None) -> DataFrame:
    """Replaces each value by its code; a value not seen in fitting gets code 0.

    The label table is joined once per column; Spark broadcasts it where its size allows. A column
    without fitted labels is an error.
    """
    fitted = sorted(r["column"] for r in labels.select("column").distinct().collect())
    wanted = fitted if cols is None else list(cols)
    if unknown := [c for c in wanted if c not in fitted]:
        raise ValueError(f"no labels were fitted for columns: {unknown}")
    columns = list(df.columns)
    for c in wanted:
        classes = labels.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        df = (
            df.join(classes, _as_class(c) == F.col("_value"), "left")
            .withColumn(c, F.coalesce(F.col("_code"), F.lit(0)))
            .drop("_value", "_code")
        )
    return df.select(*columns)


def one_hot(df: DataFrame, cols, drop_first: bool = False, most: int = MAX_ONE_HOT) -> DataFrame:
    """Boolean column per sorted category, original column dropped, missing → all false.

    More than ``most`` categories are an error: each would be a column of the result.
    """
    for c in [c for c in cols if c in df.columns]:
        values = sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(most + 1).collect())
        if len(values) > most:
            raise ValueError(f"{c} has more than {most} categories")
        kept = values[1:] if drop_first else values
        df = df.withColumns({f"{c}_{v}": F.coalesce(F.col(c) == F.lit(v), F.lit(False)) for v in kept}).drop(c)
    return df


def save_params(params: DataFrame, path: str) -> None:
    params.write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame | None:
    """None when nothing was saved there yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scaler_info(params: DataFrame) -> DataFrame:
    """Per scaler: number of columns; per column: the value range before scaling."""
    return params.select(
        "name",
        F.count(F.lit(1)).over(Window.partitionBy("name")).alias("columns"),
        "column",
        F.col("min").alias("original_min"),
        F.col("max").alias("original_max"),
    )
