"""Jump consistent hashing of rows into shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.llm.common import Scratch, table, with_offsets

MULTIPLIER = np.uint64(2862933555777941757)
SHARDS = 8


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key, after Lamping and Veach.

    A key jumps to ever higher shard numbers; the last one below ``shards`` is its place. One more
    shard therefore either leaves a key where it is or takes it.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = np.array(keys, dtype=np.uint64)
    place = np.zeros(len(state), dtype=np.int64)
    going = np.arange(len(state))
    step = np.zeros(len(state), dtype=np.int64)
    while len(going):
        place[going] = step[going]
        state[going] = state[going] * MULTIPLIER + np.uint64(1)
        high = (state[going] >> np.uint64(33)).astype(np.float64) + 1.0
        step[going] = ((place[going] + 1) * (float(1 << 31) / high)).astype(np.int64)
        going = going[step[going] < shards]
    return place


def shards_of(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs`` with its shard among ``shards`` and among one more, and its slot.

    The xxhash64 of the key alone decides the shard, so equal keys always meet and adding rows or
    shards moves nothing else. ``slot`` numbers the rows of a shard from 0 without gaps; the order
    inside a shard is free. A null key hashes as the empty string; repeated rows get slots of
    their own; a null text has size 1 and checksum 0; other columns of ``docs`` are not read. No rows in, none out.
    """
    spark = docs.sparkSession
    value = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))).alias("_hash"),
        (F.coalesce(F.octet_length(value), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(value), F.lit(0)).cast("long").alias("text_crc32"),
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(shards, dtype=np.int64)
        for batch in batches:
            hashes = batch.pop("_hash").to_numpy(dtype=np.int64).view(np.uint64)
            at = jump(hashes, shards)
            batch["shard"], batch["grown_shard"] = at.astype(np.int32), jump(hashes, shards + 1).astype(np.int32)
            batch["_local"] = batch.groupby("shard").cumcount().to_numpy() + seen[at]
            seen += np.bincount(at, minlength=shards)
            batch["_task"] = task
            yield batch

    kind = dict(docs.select(F.col(f"`{key}`").alias("doc_id")).dtypes)["doc_id"]
    schema = f"doc_id {kind}, size long, text_crc32 long, shard int, grown_shard int, _local long, _task int"
    # The numbers of a task hold only once they are written: a task that runs again writes them anew as a whole.
    placed = Scratch(spark).stage(rows.mapInPandas(place, schema), "placed")
    return with_offsets(placed, "_task", ["shard"], "_local", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op10_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by doc_id, and their shard among nine."""
    return shards_of(table(spark, sf_dir, "documents"))


QUERIES = {"op10_jump_sharding": op10_jump_sharding}
ORACLES: dict[str, str] = {}
