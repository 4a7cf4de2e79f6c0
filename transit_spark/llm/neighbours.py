"""Approximate nearest neighbours by multiprobe p-stable hashing, with exact distances for the candidates."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.llm.common import Scratch, in_batches, table

NEAREST, QUERY_STEP = 20, 20
TABLES, HASHES = 3, 4
#: The hash width and the number of probes are chosen on at most so many vectors and queries, so that
#: this share of the sample's true neighbours is found.
SAMPLE, SAMPLE_QUERIES, TARGET, MAX_PROBES = 4000, 100, 0.965, 400
#: The first width tried, in lengths of the longest vector, and by how much the next one is wider.
WIDTH, WIDER = 1.2, 1.5
#: Vectors, or queries, of one bucket that one task compares.
BLOCK = 4096
SEED = 11


@dataclass
class Hashes:
    """Tables of ``HASHES`` functions floor(a x / w + b) each, with normally distributed (2-stable) a and b from 0 to 1."""

    directions: np.ndarray  # tables x hashes x width
    shifts: np.ndarray  # tables x hashes
    width: float
    probes: int

    def project(self, points: np.ndarray) -> np.ndarray:
        """Positions in units of the width: points x tables x hashes."""
        return np.einsum("nd,thd->nth", points, self.directions) / self.width + self.shifts

    def buckets(self, points: np.ndarray) -> np.ndarray:
        return np.floor(self.project(points)).astype(np.int64)

    def visits(self, points: np.ndarray, table: int) -> list[np.ndarray]:
        """For each point the buckets of a table in estimated order of success, its own first."""
        places = self.project(points)[:, table]
        return [probe_sequence(p, self.probes) for p in places]


def probe_sequence(place: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` buckets nearest to a projected point, by the sum of squared distances to the buckets' borders.

    Each hash may move by any number of steps down or up; sets of moves are taken from a heap in the
    order of their cost, as in the query-directed sequence of multiprobe hashing.
    """
    home = np.floor(place).astype(np.int64)
    inside = place - home
    moves = []
    for low in inside:
        steps = [(0.0, 0)]
        for k in range(1, 12):
            steps += [((low + k - 1) ** 2, -k), ((k - low) ** 2, k)]
        moves.append(sorted(steps))
    heap, seen, out = [(0.0, (0,) * len(place))], {(0,) * len(place)}, []
    while heap and len(out) < probes:
        cost, at = heapq.heappop(heap)
        out.append([home[i] + moves[i][a][1] for i, a in enumerate(at)])
        for i, a in enumerate(at):
            if a + 1 < len(moves[i]):
                more = at[:i] + (a + 1,) + at[i + 1 :]
                if more not in seen:
                    seen.add(more)
                    heapq.heappush(heap, (cost - moves[i][a][0] + moves[i][a + 1][0], more))
    return np.array(out)


def choose(points: np.ndarray, queries: np.ndarray, nearest: int, most: float) -> Hashes:
    """Hashes whose probes find ``TARGET`` of the nearest points of a sample.

    Vectors get one more component so that all have the length ``most``, to which queries are brought
    too; the largest inner product is then the smallest distance, and nothing depends on the scale of
    the data. The narrowest of the widths tried that reaches the target is taken. It is always
    reached: in a width far above ``most`` all points share one bucket, which is a scan of all of them.
    """
    rng = np.random.default_rng(SEED)
    width = points.shape[1] + 1
    directions, shifts = rng.standard_normal((TABLES, HASHES, width)), rng.random((TABLES, HASHES))
    scores = queries @ points.T
    true = np.argsort(-scores, axis=1, kind="stable")[:, : min(nearest + 1, len(points))]
    held, asked = lift(points, most), lift_queries(queries, most)
    hashes = Hashes(directions, shifts, most * WIDTH, MAX_PROBES)
    while True:
        own = hashes.buckets(held)
        rank = np.full((len(queries), true.shape[1]), MAX_PROBES)
        for t in range(TABLES):
            for q, sequence in enumerate(hashes.visits(asked, t)):
                order = {tuple(b): i for i, b in enumerate(sequence.tolist())}
                found = [order.get(tuple(own[i, t].tolist()), MAX_PROBES) for i in true[q]]
                rank[q] = np.minimum(rank[q], found)
        for probes in range(1, MAX_PROBES + 1):
            if (rank < probes).mean() >= TARGET:
                hashes.probes = probes
                return hashes
        hashes.width *= WIDER


def lift(points: np.ndarray, most: float) -> np.ndarray:
    """One more component: what is missing to the length ``most``."""
    squares = (points * points).sum(axis=1)
    return np.hstack([points, np.sqrt(np.maximum(most * most - squares, 0))[:, None]])


def lift_queries(queries: np.ndarray, most: float) -> np.ndarray:
    """Queries brought to the length ``most``, with zero as one more component."""
    lengths = np.sqrt((queries * queries).sum(axis=1))
    return np.hstack([queries * (most / lengths)[:, None], np.zeros((len(queries), 1))])


def _score(block: pd.DataFrame, nearest: int) -> pd.DataFrame:
    """The best candidates of each query in a block of one bucket."""
    asked, held = block[block["asks"]], block[~block["asks"]]
    empty = pd.DataFrame({"query_id": [], "rep": [], "score": []}).astype({"query_id": "int64", "rep": "int64", "score": "float64"})
    if not len(asked) or not len(held):
        return empty
    ids = held["id"].to_numpy()
    held = np.stack(held["vector"].to_numpy())
    out = []
    for at in range(0, len(asked), 256):
        part = asked.iloc[at : at + 256]
        scores = np.stack(part["vector"].to_numpy()) @ held.T
        top = min(nearest + 1, len(ids))
        pick = np.argpartition(-scores, top - 1, axis=1)[:, :top]
        floor = np.take_along_axis(scores, pick, axis=1).min(axis=1)
        q, c = np.nonzero(scores >= floor[:, None] - 1e-12)  # with the ties at the border
        out.append(pd.DataFrame({"query_id": part["id"].to_numpy()[q], "rep": ids[c], "score": scores[q, c]}))
    return pd.concat([empty, *out])


def nearest_neighbours(vectors: DataFrame, nearest: int = NEAREST, query_step: int = QUERY_STEP, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row whose id is divisible by ``query_step`` the ``nearest`` others found, by inner product.

    Every distinct vector is in one bucket of each table. A query visits the buckets of each table in
    the order in which their borders come near, as many as the sample asked for; candidates of all
    tables meet, the best ones are scored again exactly, and copies of a vector (of which never more
    than ``nearest`` + 1, the smallest ids, can be among the nearest) follow in the order of their
    ids. Buckets are met in blocks of bounded size. A query whose buckets hold too few candidates
    meets all distinct vectors instead.

    Null, zero and non-finite vectors and those with a null component take no part, nor do rows with
    a null id or with another length than the most frequent one; rows that repeat an id are one
    candidate each. Fewer other rows give fewer neighbours; other columns are not read; no rows in, none out.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    clean = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = scratch.stage(rows.where(F.coalesce(clean & F.col("id").isNotNull(), F.lit(False))), "rows")
    widths = sorted(((-r["n"], r["w"]) for r in rows.groupBy(F.size("vector").alias("w")).agg(F.count("*").alias("n")).collect()))
    schema = "query_id long, rank int, vec_id long, score double"
    if not widths:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == widths[0][1])
    copies = rows.groupBy("vector").agg(F.min("id").alias("rep"))
    copies = scratch.stage(copies, "distinct")
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    most, distinct = copies.agg(F.sqrt(F.max(squares)), F.count("*")).first()
    sample = copies.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").toPandas()["vector"]
    sample = np.stack(sample.to_numpy())
    hashes = choose(sample, sample[:SAMPLE_QUERIES], nearest, most)
    held = spark.sparkContext.broadcast(hashes)

    def settle(batch: pd.DataFrame) -> pd.DataFrame:
        own = held.value.buckets(lift(np.stack(batch["vector"].to_numpy()), most))
        return pd.DataFrame({"id": batch["rep"], "vector": batch["vector"], "buckets": [[b.tolist() for b in o] for o in own]})

    def probe(batch: pd.DataFrame) -> pd.DataFrame:
        asked = lift_queries(np.stack(batch["vector"].to_numpy()), most)
        visits = [held.value.visits(asked, t) for t in range(TABLES)]
        return batch.assign(buckets=[[v[i].tolist() for v in visits] for i in range(len(batch))])

    places = copies.mapInPandas(in_batches(settle), "id long, vector array<double>, buckets array<array<long>>")
    places = places.select("id", "vector", F.posexplode("buckets").alias("table", "bucket"))
    asking = rows.where(F.col("id") % query_step == 0).distinct()
    asks = asking.mapInPandas(in_batches(probe), "id long, vector array<double>, buckets array<array<array<long>>>")
    asks = asks.select("id", "vector", F.posexplode("buckets").alias("table", "bucket")).select("id", "vector", "table", F.explode("bucket").alias("bucket"))
    key = F.xxhash64("table", "bucket").alias("key")
    places, asks = scratch.stage(places.select("id", "vector", key), "places"), scratch.stage(asks.select("id", "vector", key), "asks")
    found = scratch.stage(_best(_meet(places, asks, nearest), nearest), "found")
    # A query is short if it has fewer candidates than it may need: the nearest ones and perhaps itself.
    enough = found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n")).where(F.col("n") >= min(nearest + 1, distinct))
    short = scratch.stage(asking.join(enough, "id", "left_anti"), "short")
    if not short.isEmpty():
        every = F.lit(0).cast("long").alias("key")
        scanned = _meet(copies.select(F.col("rep").alias("id"), "vector", every), short.select("id", "vector", every), nearest)
        rest = found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti")
        found = scratch.stage(rest.unionByName(_best(scanned, nearest)), "found-all")
    # Copies: the ids behind a distinct vector, of which the first nearest + 1 are enough for any query.
    shared = copies.join(rows, "vector").select("rep", F.col("id").alias("vec_id"), F.row_number().over(_order("rep", "id")).alias("turn"))
    expanded = found.select("query_id", "rep").join(shared.where(F.col("turn") <= nearest + 1), "rep").where("query_id <> vec_id")
    exact = expanded.join(asking.select(F.col("id").alias("query_id"), F.col("vector").alias("asked")), "query_id")
    exact = exact.join(copies.select("rep", "vector"), "rep")
    product = F.aggregate(F.zip_with("asked", "vector", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return _best(exact.select("query_id", "vec_id", product.alias("score")), nearest, "vec_id", extra=0).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def _meet(places: DataFrame, asks: DataFrame, nearest: int) -> DataFrame:
    """The best score of each query with the vectors of the same ``key``, in blocks of about ``BLOCK`` of either side."""
    sizes = places.groupBy("key").agg(F.count("*").alias("held")).join(asks.groupBy("key").agg(F.count("*").alias("asked")), "key")
    parts = sizes.select("key", F.ceil(F.col("held") / BLOCK).alias("held_parts"), F.ceil(F.col("asked") / BLOCK).alias("asked_parts"))
    salt = F.xxhash64("id", F.lit(3))
    both = [
        side.join(parts, "key").select(
            "key", F.pmod(salt, F.col(f"{own}_parts")).alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_parts") - 1)).alias(other),
            F.lit(own == "asked").alias("asks"), "id", "vector",
        ).select("key", "held", "asked", "asks", "id", "vector")
        for side, own, other in ((places, "held", "asked"), (asks, "asked", "held"))
    ]
    scored = both[0].union(both[1]).groupBy("key", "held", "asked").applyInPandas(lambda b: _score(b, nearest), "query_id long, rep long, score double")
    return scored.groupBy("query_id", "rep").agg(F.max("score").alias("score"))


def _order(key: str, *by):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(*by)


def _best(rows: DataFrame, nearest: int, tie: str = "rep", extra: int = 1) -> DataFrame:
    """The best rows per query; one more where the query itself may be among them."""
    rank = F.row_number().over(_order("query_id", F.col("score").desc(), F.col(tie)))
    return rows.withColumn("rank", rank).where(F.col("rank") <= nearest + extra)


def op7_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest others of every twentieth vector."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


QUERIES = {"op7_multiprobe": op7_multiprobe}
ORACLES: dict[str, str] = {}
