"""Files and catalog tables."""

from __future__ import annotations

import time as clock
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from transit_spark import schemas as S
from transit_spark.operators.series import head
from transit_spark.session import stage

DAY = "day"
#: Bits of one of Spark's bitmaps, and bitmaps (of 4 KB) per day in a filter of keys.
BITMAP_BITS, KEY_BUCKETS = 32_768, 16
#: Days listed in a scan, and bitmaps (8 MB) sent to all tasks; beyond them both are joined.
LISTED_DAYS, SENT_BITMAPS = 1000, 2000


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """CSV with header under the declared schema, its columns found by name. Columns that are not
    declared are left out, a declared one that is missing is an error; ``order`` stands for
    ``stop_order``. The optional weather and events files may be absent (None)."""
    try:
        # The header alone names the columns; text is cast afterwards, so no file is read for its types.
        raw = spark.read.option("header", True).csv(f"{path}/{name}.csv")
    except AnalysisException as error:
        if name in ("weather", "events") and error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if "order" in raw.columns and "stop_order" not in raw.columns:
        raw = raw.withColumnRenamed("order", "stop_order")
    wanted = [part.strip().rsplit(" ", 1) for part in S.RAW[name].split(",")]
    if missing := [c for c, _ in wanted if c not in raw.columns]:
        raise ValueError(f"{name}.csv lacks the columns {missing}")
    return raw.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in wanted])


def write_tables(tables: dict[str, DataFrame], path: str, prefix: str = "", fmt: str = "csv", stats: StageStats | None = None) -> dict[str, int]:
    """One directory of part files per table; returns the rows written. ``stats`` takes note of each write."""
    stats = stats or StageStats()
    return {
        name: stats.write(name, df, lambda w, n=name: w.mode("overwrite").format(fmt).option("header", True).save(f"{path}/{prefix}{n}.{fmt}"))
        for name, df in tables.items()
        if df is not None
    }


def _write(df: DataFrame, action) -> int:
    """Runs the write and returns its row count, observed while the rows pass by."""
    seen = Observation()
    action(df.observe(seen, F.count(F.lit(1)).alias("rows")).write)
    return seen.get["rows"]


def _exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_tables(spark: SparkSession, database: str = "default") -> None:
    """The declared tables; time series are partitioned by day."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, ddl in S.STORED.items():
        timed = name in S.TIME_PARTITIONED
        columns = f"{ddl}, {DAY} date" if timed else ddl
        layout = f" PARTITIONED BY ({DAY})" if timed else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{layout}")


def _stored_shape(df: DataFrame, name: str) -> DataFrame:
    """Column names, order and types of a declared table; absent columns become NULL, stamps the present."""
    for old, new in S.STORED_NAMES.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    wanted = [part.strip().rsplit(" ", 1) for part in S.STORED[name].split(",")]
    absent = {c: F.localtimestamp() if c in S.STAMPED else F.lit(None) for c, _ in wanted if c not in df.columns}
    cols = [absent.get(c, F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in wanted]
    if name in S.TIME_PARTITIONED:
        cols.append(F.col("time").cast("date").alias(DAY))
    return df.select(*cols)


def unique_rows(df: DataFrame, name: str, order=None) -> DataFrame:
    """First row per key of a declared table. Parquet tables enforce no keys, so this runs before a
    write; the per-partition limit keeps repeated keys out of the shuffle."""
    keys = S.STORED_KEYS[name]
    source = {new: old for old, new in S.STORED_NAMES.items() if old in df.columns and new not in df.columns}
    present = [source.get(k, k) for k in keys]
    return head(df, present, 1, order or [c for c in df.columns if c not in present])


def save_table(df: DataFrame, name: str, if_exists: str = "append", unique: bool = False, order=None) -> int:
    """Appends to, replaces or refuses an existing table; returns the rows saved.

    ``unique`` keeps one row per key of a declared table, the first along ``order``.
    """
    base = name.split(".")[-1]
    spark = df.sparkSession
    declared = base in S.STORED
    if unique and declared:
        df = unique_rows(df, base, order)
    out = _stored_shape(df, base) if declared else df
    if if_exists == "replace" and _exists(spark, f"{name}_batches"):
        spark.sql(f"DROP TABLE {name}_batches")  # what it lists is gone
    timed = DAY in out.columns and declared and base in S.TIME_PARTITIONED
    if timed:
        # Few files per day, while adaptive execution splits a big day over many tasks.
        out = out.hint("rebalance", F.col(DAY))
    modes = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}
    if if_exists not in modes:
        raise ValueError(f"unknown if_exists: {if_exists}")
    if if_exists == "append" and _exists(spark, name):
        columns = spark.table(name).columns
        if set(columns) != set(out.columns):
            raise ValueError(f"{name} has the columns {columns}, not {out.columns}")
        return _write(out.select(*columns), lambda w: w.insertInto(name))

    def create(writer):
        writer = writer.mode(modes[if_exists]).format("parquet")
        (writer.partitionBy(DAY) if timed else writer).saveAsTable(name)

    return _write(out, create)


def select_rows(
    df: DataFrame, filters: dict | None = None, time_range=None, columns=None, limit: int | None = None, newest_first: bool = True,
) -> DataFrame:
    """Equality filters, inclusive time range, projection, newest first, limit."""
    for c, v in (filters or {}).items():
        df = df.where(F.col(c) == F.lit(v))
    if time_range is not None:
        lo, hi = (F.lit(t).cast("timestamp_ntz") for t in time_range)
        df = df.where(F.col("time").between(lo, hi))
        if DAY in df.columns:
            df = df.where(F.col(DAY).between(lo.cast("date"), hi.cast("date")))
    if newest_first and "time" in df.columns:
        df = df.orderBy(F.col("time").desc())
    if limit is not None:
        df = df.limit(limit)
    wanted = columns or [c for c in df.columns if c != DAY]
    return df.select(*wanted)


def load_table(spark: SparkSession, name: str, **options) -> DataFrame:
    return select_rows(spark.table(name), **options)


def recent(df: DataFrame, hours: int = 24, route: str | None = None, as_of: str | Column | None = None) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of`` (default: now), newest first."""
    end = F.localtimestamp() if as_of is None else (F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of)
    start = end - F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0))
    df = df.where(F.col("time").between(start, end))
    if DAY in df.columns:
        df = df.where(F.col(DAY).between(start.cast("date"), end.cast("date")))
    if route is not None:
        key = "route_id" if "route_id" in df.columns else "route"
        df = df.where(F.col(key) == route)
    return df.orderBy(F.col("time").desc())


def run_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Spark SQL over the given frames: ``run_sql(spark, 'SELECT * FROM {demand}', demand=df)``."""
    return spark.sql(query, **tables)


def pack_features(df: DataFrame, cols, route: str = "route", stop: str = "stop") -> DataFrame:
    """(time, route_id, stop_id, features): numbers as float, NaN and NULL as JSON null."""
    types = dict(df.dtypes)

    def field(c: str) -> Column:
        if types[c] in ("string", "boolean"):
            return F.col(c)
        d = F.col(c).cast("double")
        return F.when(~F.isnan(d), d).alias(c)

    packed = F.to_json(F.struct(*[field(c).alias(c) for c in cols if c in types]), {"ignoreNullFields": "false"})
    return df.select("time", F.col(route).alias("route_id"), F.col(stop).alias("stop_id"), packed.alias("features"))


def save_features(df: DataFrame, cols, name: str = "processed_features") -> int:
    return save_table(pack_features(df, cols), name)


def prediction_rows(df: DataFrame, version: str, created_at: str | None = None) -> DataFrame:
    """Columns of the predictions table; the demand is cut to whole passengers."""
    stamp = F.localtimestamp() if created_at is None else F.lit(created_at).cast("timestamp_ntz")
    source = df.withColumnsRenamed({"predicted": "predicted_demand", "lower": "confidence_lower", "upper": "confidence_upper"})
    source = source.withColumns({"model_version": F.lit(version), "created_at": stamp})
    return _stored_shape(source, "predictions").drop(DAY)


def save_predictions(df: DataFrame, version: str, name: str = "predictions", created_at: str | None = None) -> int:
    return save_table(prediction_rows(df, version, created_at), name)


def _key_bits(rows: DataFrame, keys) -> DataFrame:
    """``rows`` with ``_bucket`` and ``_bit``: the place of the row's key in a filter of KEY_BUCKETS bitmaps."""
    place = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(KEY_BUCKETS * BITMAP_BITS))
    return rows.withColumns({"_bucket": F.floor(place / BITMAP_BITS).cast("int"), "_bit": place % BITMAP_BITS})


def _has_bit(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def _null_safe(left: DataFrame, right: DataFrame, keys) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def known_keys(fresh: DataFrame, name: str) -> DataFrame:
    """The keys of ``fresh`` (in stored shape) that the table holds already.

    Of a day-partitioned table only the days of ``fresh`` are read, and only key columns. A bitmap of
    the keys of ``fresh`` meets the stored rows where they lie: what misses it is no match and is not
    shuffled; what hits it is compared by the keys themselves.
    """
    base = name.split(".")[-1]
    keys = list(S.STORED_KEYS[base])
    days = [DAY] if base in S.TIME_PARTITIONED else []
    stored = fresh.sparkSession.table(name).select(*keys, *days)
    if days:
        touched = [r[0] for r in fresh.select(DAY).distinct().limit(LISTED_DAYS + 1).collect()]
        # A short list of days prunes folders; more days are met in the join below.
        if len(touched) <= LISTED_DAYS:
            stored = stored.where(F.col(DAY).isin([d for d in touched if d is not None]) | F.col(DAY).isNull())
    filters = stage(_key_bits(fresh, keys).groupBy(*days, "_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")))
    filters = filters.withColumnsRenamed({c: f"_f{c}" for c in (*days, "_bucket")})
    if filters.count() <= SENT_BITMAPS:
        filters = F.broadcast(filters)
    near = _key_bits(stored, keys)
    on = near["_bucket"] == filters["_f_bucket"]
    for day in days:
        on = on & near[day].eqNullSafe(filters[f"_f{day}"])
    hits = near.join(filters, on).where(_has_bit(F.col("_bits"), F.col("_bit"))).select(*keys)
    wanted = fresh.select(*keys)
    return wanted.join(hits, _null_safe(wanted, hits, keys), "left_semi")


def _digest(df: DataFrame) -> str:
    """A name for the rows of a batch, free of their order: their number and the sums of two hashes of each."""
    values = [F.col(f"`{c}`") for c in df.columns if c not in S.STAMPED]
    sums = [F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)")) for seed in (1, 2)]
    n, *hashes = df.agg(F.count(F.lit(1)), *sums).first()
    return f"{n}:{hashes[0]}:{hashes[1]}"


def _manifest(spark: SparkSession, name: str) -> str:
    """The table, beside ``name``, of the batches it holds."""
    manifest = f"{name}_batches"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {manifest} (batch string, rows bigint, appended bigint, stored_at timestamp_ntz) USING parquet")
    return manifest


def append_new(df: DataFrame, name: str, order=None) -> int:
    """Appends the rows whose keys a declared table does not hold yet; returns how many these are.

    Of rows with one key the first along ``order`` counts. A batch is noted beside the table once its rows are in: the same
    batch again is known by its digest and not compared at all. A write that breaks off leaves what was stored, and perhaps some of its
    own rows; the next one adds what is missing. Two writers of one key at a time are not kept apart.
    """
    base = name.split(".")[-1]
    if base not in S.STORED_KEYS:
        raise ValueError(f"{base} has no declared keys")
    spark = df.sparkSession
    # Staged: the batch is read for its digest, its keys and its rows.
    fresh = stage(_stored_shape(unique_rows(df, base, order), base))
    batch, manifest = _digest(fresh), _manifest(spark, name)
    if not spark.table(manifest).where(F.col("batch") == batch).isEmpty():
        return 0
    keys = S.STORED_KEYS[base]
    known = stage(known_keys(fresh, name))
    missing = fresh.join(known, _null_safe(fresh, known, keys), "left_anti")
    out = missing.hint("rebalance", F.col(DAY)) if base in S.TIME_PARTITIONED else missing
    appended = _write(out.select(*spark.table(name).columns), lambda w: w.insertInto(name))
    note = spark.createDataFrame([(batch, int(batch.split(":")[0]), appended)], "batch string, rows bigint, appended bigint")
    note.withColumn("stored_at", F.localtimestamp()).write.insertInto(manifest)
    return appended


def save_dataset(tables: dict[str, DataFrame], database: str = "default", orders: dict | None = None) -> dict[str, int]:
    """Saves each known dataset under its table name, with the stored column names; returns the rows added.

    Keys are enforced against what is stored, so saving a dataset again adds nothing. ``orders``
    says per dataset which of several rows of one key counts.
    """
    create_tables(next(df for df in tables.values() if df is not None).sparkSession, database)
    return {
        name: append_new(df, f"{database}.{S.DATASET_TABLES[name]}", (orders or {}).get(name))
        for name, df in tables.items()
        if df is not None and name in S.DATASET_TABLES
    }


def upsert(current: DataFrame, incoming: DataFrame, keys, ts: str) -> DataFrame:
    """Newest row per key; an incoming row wins a tie, and of incoming rows with one time the one with the least values."""
    rest = [c for c in current.columns if c not in keys and c != ts]
    both = current.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(ts).desc(), F.col("_new").desc(), *rest))
    return both.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank", "_new")


def upsert_table(incoming: DataFrame, name: str, ts: str = "time") -> None:
    """Upserts into a declared table. Of a day-partitioned one only the days ``incoming`` touches are
    rewritten; a table without days (routes, stops, events) has no time of its own, so an incoming row
    replaces a stored one, and it is rewritten as a whole."""
    spark = incoming.sparkSession
    base = name.split(".")[-1]
    fresh = _stored_shape(incoming, base)
    if base not in S.TIME_PARTITIONED:
        dated = [d.withColumn("_never", F.lit(None).cast("timestamp_ntz")) for d in (spark.table(name).select(*fresh.columns), fresh)]
        merged = stage(upsert(*dated, S.STORED_KEYS[base], "_never").select(*fresh.columns))
        merged.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
        return
    touched = spark.table(name).join(fresh.select(DAY).distinct(), DAY, "left_semi").select(*fresh.columns)
    # Staged first: a table cannot be read and overwritten by one statement.
    merged = stage(upsert(touched, fresh, S.STORED_KEYS[base], ts).select(*fresh.columns))
    # A session of its own, so that the caller's settings stay as they are.
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    if files := merged.inputFiles():
        columns = own.table(name).columns
        own.read.schema(merged.schema).parquet(*files).select(*columns).write.insertInto(name, overwrite=True)
        spark.catalog.refreshTable(name)


class StageStats:
    """Rows, columns and seconds per stage, taken while the stage's output is written."""

    def __init__(self) -> None:
        self._stages: dict[str, dict] = {}

    def write(self, name: str, df: DataFrame, action) -> int:
        """Runs ``action`` on the writer of ``df``; the stage's seconds are those of this write alone."""
        start = clock.monotonic()
        rows = _write(df, action)
        self._stages[name] = {"records": rows, "columns": len(df.columns), "seconds": clock.monotonic() - start}
        return rows

    def report(self) -> dict[str, dict]:
        return {name: dict(stage) for name, stage in self._stages.items()}
