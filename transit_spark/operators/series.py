"""Ordered-series operators whose work is bounded per task, however long one series is.

A plain ``Window.partitionBy(route, stop)`` puts a whole series into one task. Here every series is
cut twice instead:

* ``with_positions`` cuts it into time blocks (a day by default), counts the blocks with a map-side
  combined aggregate, and adds the running offset to the row number inside the block. The result is
  the exact position of each row in its series.
* ``in_chunks`` cuts it again by position into equal pieces and copies the few rows a bounded frame
  needs from the neighbouring piece ("halo" rows, dropped afterwards).

``with_neighbours`` carries the last/first known value over block borders, which is what forward
fill, backward fill and interpolation need.

Where there are no keys to cut by, or blocks could not be bounded, ``ranged`` cuts the whole frame into
sorted ranges of about equal size, whatever its values are; each range then is a block.

The only windows that still run over a whole series see one row per block, not one per input row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transit_spark.session import stage

CHUNK_ROWS = 100_000
RANGE = "_range"


def ranged(df: DataFrame, order, ranges: int | None = None) -> DataFrame:
    """``df`` with ``_range``: the number of its sorted range along ``order``, staged.

    Spark draws the borders from a bounded sample of the order columns, so ranges are of like size under
    any distribution as long as few rows are equal in all of ``order``. Without ``ranges`` their number
    follows the size of the data, up to the shuffle partitions of the session. The ranges are written
    out, so that every later reading, also one after a lost executor, sees the same borders.
    """
    sorted_out = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    return stage(sorted_out.withColumn(RANGE, F.spark_partition_id()))


def _in_blocks(df: DataFrame, keys, order, block: Column | None) -> tuple[DataFrame, Column | None]:
    """Without keys and block, the frame is cut into ranges: a day may hold any share of the rows."""
    return (df, block) if keys or block is not None else (ranged(df, order), F.col(RANGE))


def day_block(order) -> Column:
    return F.col(order[0]).cast("date")


def _block_of(order, block: Column | None) -> Column:
    return day_block(order) if block is None else block


def _keyed(keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))


def _cut(df: DataFrame, keys, order, block: Column | None) -> tuple[DataFrame, list[str]]:
    """(frame whose key columns are packed with the block into ``_g``, order inside a block).

    A packed key is never NULL itself: rows with NULL keys join like all others, and the planner adds
    no null filters to one side only, so both sides of the joins below can share their input's
    shuffle.
    """
    packed = F.struct(*keys, _block_of(order, block).alias("block")).alias("_g")
    rest = [c for c in df.columns if c not in keys]
    return df.select(packed, *rest), [c for c in order if c not in keys]


def _restored(cut: DataFrame, columns, keys, *added) -> DataFrame:
    return cut.select(*[F.col(f"_g.{c}").alias(c) if c in keys else F.col(c) for c in columns], *added)


def _blocks(summary: DataFrame, keys) -> tuple[DataFrame, object]:
    """One row per block with its series unpacked, and the window over a series' blocks."""
    names = {f"_key_{k}": F.col(f"_g.{k}") for k in keys}
    return summary.withColumns(names | {"_at": F.col("_g.block")}), Window.partitionBy(*names)


def with_positions(df: DataFrame, keys, order, block: Column | None = None) -> DataFrame:
    """Adds ``_pos`` (1-based position in the series) and ``_size`` (rows of the series).

    ``order`` must be a total order inside a series; ``block`` must not decrease along it.
    """
    keys, columns = list(keys), df.columns
    df, block = _in_blocks(df, keys, order, block)
    cut, inner = _cut(df, keys, order, block)
    counts, series = _blocks(cut.groupBy("_g").agg(F.count(F.lit(1)).alias("_rows")), keys)
    run = series.orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    offsets = counts.select(
        "_g",
        (F.sum("_rows").over(run) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(series).alias("_size"),
    )
    row = F.row_number().over(Window.partitionBy("_g").orderBy(*inner))
    placed = cut.withColumn("_row", row).join(offsets, "_g", "left")
    return _restored(placed, columns, keys, (F.col("_before") + F.col("_row")).alias("_pos"), "_size")


def running_totals(df: DataFrame, keys, order, values, block: Column) -> DataFrame:
    """Adds ``_total_<value>`` for each of ``values``: its inclusive running sum along ``order``.

    A prefix scan: sums inside each block, and before it the sums of the blocks of its series before.
    """
    keys, values = list(keys), list(values)
    cut, inner = _cut(df, keys, order, block)
    sums, series = _blocks(cut.groupBy("_g").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values]), keys)
    run = series.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_g", *[F.coalesce(F.sum(f"_sum_{v}").over(run), F.lit(0)).alias(f"_before_{v}") for v in values])
    inside = Window.partitionBy("_g").orderBy(*inner).rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.withColumns({f"_inner_{v}": F.sum(v).over(inside) for v in values}).join(offsets, "_g", "left")
    return _restored(summed, df.columns, keys, *[(F.col(f"_inner_{v}") + F.col(f"_before_{v}")).alias(f"_total_{v}") for v in values])


def running_total(df: DataFrame, keys, order, value: str, block: Column) -> DataFrame:
    """Adds ``_total``: inclusive running sum of ``value`` along ``order``."""
    return running_totals(df, keys, order, [value], block).withColumnRenamed(f"_total_{value}", "_total")


def in_chunks(placed: DataFrame, keys, before: int = 0, after: int = 0, size: int = CHUNK_ROWS):
    """(rows with ``_chunk`` and ``_halo``, window over one chunk). Needs ``_pos``.

    A chunk is several times as long as the frame reaches, so each row is copied to its neighbours only.
    """
    size = max(size, 4 * max(before, after))
    index = F.col("_pos") - 1
    chunk, inner = F.floor(index / size), index % size

    def copy(to: Column, halo: bool) -> Column:
        return F.struct(to.alias("chunk"), F.lit(halo).alias("halo"))

    copies = [copy(chunk, False)]
    if before:
        copies.append(F.when(inner >= size - before, copy(chunk + 1, True)))
    if after:
        copies.append(F.when((inner < after) & (chunk > 0), copy(chunk - 1, True)))
    exploded = F.explode(F.filter(F.array(*copies), lambda c: c.isNotNull()))
    rows = placed.select("*", exploded.alias("_copy")).select(
        *placed.columns, F.col("_copy.chunk").alias("_chunk"), F.col("_copy.halo").alias("_halo")
    )
    return rows, Window.partitionBy(*keys, "_chunk").orderBy("_pos")


def with_neighbours(
    df: DataFrame, keys, order, cols, block: Column | None = None, strict: bool = False
) -> DataFrame:
    """Adds ``_pos`` and, per column, ``_prev_<c>`` and ``_next_<c>``: ``struct(pos, value)`` of the
    nearest non-null value at or before / at or after the row (``strict``: not the row itself)."""
    keys, columns = list(keys), df.columns
    df, block = _in_blocks(df, keys, order, block)
    cut, inner = _cut(df, keys, order, block)
    inside = Window.partitionBy("_g")
    rows = cut.withColumn("_row", F.row_number().over(inside.orderBy(*inner)))

    def known(c: str, pos: str) -> str:
        return f"CASE WHEN `{c}` IS NOT NULL THEN struct({pos} AS pos, `{c}` AS value) END"

    row = "CAST(_row AS BIGINT)"
    ends = rows.groupBy("_g").agg(
        F.expr("count(1) AS _rows"),
        *[F.expr(f"min({known(c, row)}) AS `_first_{c}`") for c in cols],
        *[F.expr(f"max({known(c, row)}) AS `_last_{c}`") for c in cols],
    )
    ends, series = _blocks(ends, keys)
    back = series.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    ahead = series.orderBy(F.col("_at").desc()).rowsBetween(Window.unboundedPreceding, -1)

    def shifted(name: str) -> Column:
        """The block's outermost known value, with its position in the whole series."""
        moved = f"struct(`{name}`.pos + _before AS pos, `{name}`.value AS value)"
        return F.expr(f"last(CASE WHEN `{name}` IS NOT NULL THEN {moved} END, true)")

    carry = ends.withColumn("_before", F.coalesce(F.sum("_rows").over(back), F.lit(0))).select(
        "_g",
        "_before",
        *[shifted(f"_last_{c}").over(back).alias(f"_carry_prev_{c}") for c in cols],
        *[shifted(f"_first_{c}").over(ahead).alias(f"_carry_next_{c}") for c in cols],
    )
    edge = -1 if strict else 0
    upto = inside.orderBy("_row").rowsBetween(Window.unboundedPreceding, edge)
    onward = inside.orderBy(F.col("_row").desc()).rowsBetween(Window.unboundedPreceding, edge)
    placed = rows.join(carry, "_g", "left").withColumn("_pos", F.expr("_before + _row"))
    nearest = {}
    for c in cols:
        here = F.expr(f"last({known(c, '_pos')}, true)")
        nearest[f"_prev_{c}"] = F.coalesce(here.over(upto), F.col(f"_carry_prev_{c}"))
        nearest[f"_next_{c}"] = F.coalesce(here.over(onward), F.col(f"_carry_next_{c}"))
    return _restored(placed.withColumns(nearest), columns, keys, "_pos", *nearest)


def _filled(df: DataFrame, keys, order, cols, block, value) -> DataFrame:
    near = with_neighbours(df, keys, order, cols, block)
    fill = {c: F.when(_keyed(keys) & F.col(c).isNull(), value(c)).otherwise(F.col(c)) for c in cols}
    return near.withColumns(fill).select(*df.columns)


def ffill(df: DataFrame, keys, order, cols, block: Column | None = None) -> DataFrame:
    """Forward fill inside each series."""
    return _filled(df, keys, order, cols, block, lambda c: F.col(f"_prev_{c}.value"))


def bfill(df: DataFrame, keys, order, cols, block: Column | None = None) -> DataFrame:
    """Backward fill inside each series."""
    return _filled(df, keys, order, cols, block, lambda c: F.col(f"_next_{c}.value"))


def fill_both(df: DataFrame, keys, order, cols, block: Column | None = None) -> DataFrame:
    """Forward fill, then backward fill."""
    return _filled(
        df, keys, order, cols, block,
        lambda c: F.coalesce(F.col(f"_prev_{c}.value"), F.col(f"_next_{c}.value")),
    )


def _between(c: str, limit: int | None) -> Column:
    prev, nxt, pos = F.col(f"_prev_{c}"), F.col(f"_next_{c}"), F.col("_pos")
    lo, hi = prev["value"].cast("double"), nxt["value"].cast("double")
    steps = pos - prev["pos"]
    line = lo + (hi - lo) * steps / F.nullif(nxt["pos"] - prev["pos"], F.lit(0))
    value = F.when(prev.isNotNull(), F.when(nxt.isNotNull(), line).otherwise(lo))
    return value if limit is None else F.when(steps <= limit, value)


def interpolate(
    df: DataFrame, keys, order, cols, limit: int | None = None, block: Column | None = None
) -> DataFrame:
    """Linear in row position. Leading gaps stay; at most ``limit`` rows of a gap are filled; a
    trailing gap repeats the last value."""
    return _filled(df, keys, order, cols, block, lambda c: _between(c, limit))


def interpolate_and_fill(
    df: DataFrame, keys, order, numeric, other=(), block: Column | None = None
) -> DataFrame:
    """Interpolate ``numeric``, then forward fill and backward fill everything, in one pass."""

    def value(c: str) -> Column:
        first = _between(c, None) if c in numeric else F.col(f"_prev_{c}.value")
        return F.coalesce(first, F.col(f"_next_{c}.value").cast("double") if c in numeric else F.col(f"_next_{c}.value"))

    return _filled(df, keys, order, [*numeric, *other], block, value)


def series_features(
    df: DataFrame, col: str, lags=(), windows=(), keys=(), order=("time",), block: Column | None = None
) -> DataFrame:
    """Lag and trailing mean/std columns of ``col`` in one pass over the series."""
    keys = list(keys)
    reach = max([*lags, *[n - 1 for n in windows], 1])
    rows, chunk = in_chunks(with_positions(df, keys, order, block), keys, before=reach)
    keyed = _keyed(keys)
    new = {f"{col}_lag_{n}": F.when(keyed, F.lag(col, n).over(chunk)) for n in lags}
    for n in windows:
        frame = chunk.rowsBetween(-(n - 1), 0)
        new[f"{col}_rolling_mean_{n}"] = F.when(keyed, F.avg(col).over(frame))
        new[f"{col}_rolling_std_{n}"] = F.when(keyed, F.stddev_samp(col).over(frame))
    return rows.withColumns(new).where(~F.col("_halo")).select(*df.columns, *new)


def lag_features(df, col, lags, keys=(), order=("time",), block=None) -> DataFrame:
    return series_features(df, col, lags=lags, keys=keys, order=order, block=block)


def rolling_features(df, col, windows, keys=(), order=("time",), block=None) -> DataFrame:
    return series_features(df, col, windows=windows, keys=keys, order=order, block=block)


def gap_minutes(df: DataFrame, keys, order, time_col: str = "time", block=None) -> DataFrame:
    """Minutes since the previous row of the series."""
    from transit_spark.functions.temporal import minutes_between

    keys = list(keys)
    rows, chunk = in_chunks(with_positions(df, keys, order, block), keys, before=1)
    gap = F.when(_keyed(keys), minutes_between(F.col(time_col), F.lag(time_col).over(chunk)))
    return (
        rows.withColumn("gap_minutes", gap).where(~F.col("_halo")).select(*df.columns, "gap_minutes")
    )


def head(df: DataFrame, keys, n: int, order) -> DataFrame:
    """First ``n`` rows of each group. Spark limits each map partition before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def tail(df: DataFrame, keys, n: int, order) -> DataFrame:
    """Last ``n`` rows of each group."""
    return head(df, keys, n, [F.col(c).desc_nulls_last() for c in order])


def with_position(df: DataFrame, keys, order, name: str = "position", block=None) -> DataFrame:
    placed = with_positions(df, keys, order, block)
    return placed.select(*df.columns, F.col("_pos").alias(name))


def even_sample(df: DataFrame, order, n: int, block: Column | None = None) -> DataFrame:
    """``n`` evenly spaced rows of the ordered frame; all rows when there are at most ``n``.

    Blocks (sorted ranges by default) are only counted; rows are ranked in the at most ``n`` blocks that
    hold a sample.
    """
    columns = df.columns
    df, block = _in_blocks(df, (), order, block)
    cut = df.withColumn("_block", block)
    counts = cut.groupBy("_block").agg(F.count(F.lit(1)).alias("_rows"))
    run = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    spans = counts.select("_block", "_rows", F.sum("_rows").over(run).alias("_end"))
    size = spans.agg(F.max("_end").alias("n")).scalar()
    spans = spans.withColumns({"_size": size, "_start": F.col("_end") - F.col("_rows")})

    def sample(i: Column) -> Column:
        step = (F.col("_size") - 1) / F.lit(float(max(n - 1, 1)))
        return F.when((i == n - 1) & (i > 0), F.col("_size") - 1).otherwise(F.floor(i * step))

    # The samples that may fall into a block: positions grow with i, so their numbers are a range.
    scale = F.lit(float(max(n - 1, 1))) / F.greatest(F.col("_size") - 1, F.lit(1))
    first = F.greatest(F.floor(F.col("_start") * scale) - 1, F.lit(0))
    last = F.least(F.ceil(F.col("_end") * scale) + 1, F.lit(n - 1))
    numbers = F.sequence(F.least(first, last), last)
    inside = F.filter(
        F.array_distinct(F.transform(numbers, sample)), lambda p: (p >= F.col("_start")) & (p < F.col("_end"))
    )
    wanted = spans.withColumn("_wanted", inside).where((F.size("_wanted") > 0) | (F.col("_size") <= n))
    row = F.row_number().over(Window.partitionBy("_block").orderBy(*order))
    ranked = cut.join(wanted.select("_block", "_start", "_size", "_wanted"), "_block").withColumn(
        "_index", F.col("_start") + row - 1
    )
    chosen = (F.col("_size") <= n) | F.array_contains("_wanted", F.col("_index"))
    return ranked.where(chosen).select(*columns)
