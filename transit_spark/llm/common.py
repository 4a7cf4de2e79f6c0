"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.session import work_dir


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """A fresh folder in the shared place, for results that are read more than once.

    ``stage`` writes a frame and reads it back, so that a lost executor costs one stage and not the
    whole history. ``drop`` removes what no later step reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, work_dir(spark)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        target = f"{self.folder}/{name}"
        conf = self.spark.conf
        before = conf.get(CLEAN_UP, "false")
        conf.set(CLEAN_UP, "true")  # what was shuffled for the stage is not needed once it is written
        try:
            df.write.mode("overwrite").parquet(target)
        finally:
            conf.set(CLEAN_UP, before)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: What operators keep in a worker from task to task, by operator: how to let go of it.
KEPT: dict[str, Callable[[], None]] = {}


def give_back(own: str | None = None) -> None:
    """Returns what a worker has freed to the system. Workers are used again by later stages, and memory that
    an allocator keeps for itself there adds up with what their own stage needs; so does what other operators
    than ``own`` keep."""
    import gc

    import pyarrow

    for operator, let_go in KEPT.items():
        if operator != own:
            let_go()
    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems than Linux have no such call
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_batches(function: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``function`` over each Arrow batch, for ``mapInPandas``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        for batch in batches:
            yield function(batch)

    return run


def learnt_rows(column: str, modulus: int, held_out: int):
    """Whether crc32 of the id's text leaves a remainder other than ``held_out``; a null id is never learnt from."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus != held_out, F.lit(False))


def with_offsets(rows: DataFrame, block: str, keys: list[str], local: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the number of a row among those of the same ``keys``, from 0 and without gaps.

    ``local`` numbers the rows of each (``block``, keys) from 0; only one count per block and key is
    sorted here, never the rows.
    """
    from pyspark.sql import Window

    counts = rows.groupBy(*keys, block).agg((F.max(local) + 1).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(offsets, [*keys, block]).withColumn(out, F.col("_before") + F.col(local)).drop("_before")


def sample_ids(rows: DataFrame, id_column: str, group: str, per_group: int, numbers: dict | None = None) -> list[tuple]:
    """At most ``per_group`` distinct (id, group) pairs of every group, in the order of the ids' hash, which is
    free of the partitioning. With ``numbers`` each group named there has a number of its own, of at most ``per_group``.

    Only ids whose hash lies under a limit are sorted; the limit follows an estimate of a group's distinct ids
    and is raised for groups in which too few lie under it, so a task sorts some multiple of ``per_group``
    ids of a group, whatever its size. Pairs with a null are left out.
    """
    from pyspark.sql import Window

    spark = rows.sparkSession
    ids = rows.select(F.col(id_column).alias("_id"), F.col(group).alias("_group")).where("_id IS NOT NULL AND _group IS NOT NULL")
    kinds = dict(ids.dtypes)

    def want(group_value) -> int:
        return (numbers or {}).get(group_value, per_group)

    # The share of all hashes that are looked at: thrice what is wanted, as far as the estimate goes.
    open_groups = {r["_group"]: min(1.0, 3 * want(r["_group"]) / max(1, r["n"])) for r in ids.groupBy("_group").agg(F.approx_count_distinct("_id").alias("n")).collect()}
    out: list[tuple] = []
    while open_groups:
        shares = spark.createDataFrame([(g, share, want(g)) for g, share in open_groups.items()], f"_group {kinds['_group']}, _share double, _want int")
        place = F.xxhash64("_id") / F.lit(2.0**64) + 0.5
        near = ids.join(F.broadcast(shares), "_group").where((F.col("_share") >= 1) | (place < F.col("_share"))).select("_id", "_group", "_want").distinct()
        order = Window.partitionBy("_group").orderBy(F.xxhash64("_id"), "_id")
        found = near.withColumn("_turn", F.row_number().over(order)).where(F.col("_turn") <= F.col("_want")).select("_id", "_group").collect()
        counts: dict = {}
        for row in found:
            counts[row["_group"]] = counts.get(row["_group"], 0) + 1
        done = {g for g, share in open_groups.items() if share >= 1 or counts.get(g, 0) >= want(g)}
        out += [(r["_id"], r["_group"]) for r in found if r["_group"] in done]
        open_groups = {g: min(1.0, 4 * share) for g, share in open_groups.items() if g not in done}
    return out


def rows_of_sample(docs: DataFrame, pairs: list[tuple], group: str | None = None) -> DataFrame:
    """For each drawn (id, group) pair one row of ``docs`` (``doc_id``, ``text``, perhaps ``group``): of several, the one with the
    smallest text, reduced on the map side. The list, being bounded, is broadcast; without ``group`` only ids count."""
    kinds, keys = dict(docs.dtypes), ["doc_id", *([group] if group else [])]
    wanted = sorted({p[: len(keys)] for p in pairs})
    listed = docs.sparkSession.createDataFrame(wanted, ", ".join(f"{k} {kinds[k]}" for k in keys))
    return docs.join(F.broadcast(listed), keys, "left_semi").groupBy(*keys).agg(F.min("text").alias("text"))
