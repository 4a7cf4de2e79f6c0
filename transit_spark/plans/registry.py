"""Registry of named queries: the Spark side and, where SQL can say the same, the reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.plans.fixtures import Fixtures
from transit_spark.plans.oracle_views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Registers ``function(fixtures) -> DataFrame`` under ``name``."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(Fixtures(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return function

    return register


LARGE = 1_000_000.0


def significant(name: str, digits: int = 6):
    """A double rounded to so many decimals or, if it is large (as a MAPE over zeros is), to so many significant digits."""
    size = F.pow(F.lit(10.0), F.floor(F.log10(F.col(name))) - (digits - 1))
    return F.when(F.col(name) >= LARGE, F.round(F.col(name) / size) * size).otherwise(F.round(name, digits)).alias(name)


def significant_sql(value: str, digits: int = 6) -> str:
    size = f"pow(10.0::DOUBLE, floor(log10({value})) - {digits - 1})"
    return f"CASE WHEN {value} >= {LARGE}::DOUBLE THEN round(({value}) / {size}) * {size} ELSE round({value}, {digits}) END"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that both engines print the same digits."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df
