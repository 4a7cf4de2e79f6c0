"""Near-duplicate vectors by cover trees and their dual traversal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.llm.common import Scratch, in_batches, sample_ids, table
from transit_spark.llm.components import components

SIMILARITY = 0.98
#: Centres of cells: at most so many for all labels together, one per CELL vectors of a label. A label with
#: less than two centres' share is one cell and needs none.
CENTRES, CELL = 1024, 2000
#: Vectors of a block that meets other blocks in one task.
BLOCK = 2048
#: A node of a cover tree with so few points is not divided further.
LEAF = 8
#: Room for rounding when bounds are compared; pairs within it are decided by their own distance.
SLACK = 1e-7
PAIRS = 1 << 22


def units(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The vectors in double precision with length 1, and which of them can be compared at all.

    Null, zero and non-finite vectors and those with a null component cannot; neither can vectors
    of another length than the most frequent one of their batch, which the caller rules out before.
    """
    rows = [None if v is None else np.asarray(v, dtype=np.float64) for v in vectors]
    width = max((len(r) for r in rows if r is not None), default=0)
    out, good = np.zeros((len(rows), width)), np.zeros(len(rows), dtype=bool)
    for i, row in enumerate(rows):
        if row is not None and len(row) == width and np.isfinite(row).all():
            most = np.abs(row).max() if width else 0
            if most > 0:
                scaled = row / most
                out[i], good[i] = scaled / np.sqrt(scaled @ scaled), True
    return out, good


class CoverTree:
    """Nested levels of centres whose covering radii halve, over vectors of length 1.

    The root covers everything within 2. On each further level a node's points are shared out among
    centres of half the radius, which lie further apart than that; the node's own centre is the first
    of them. ``radius`` is the distance to the furthest point actually covered.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.members: list[np.ndarray] = []
        if len(points):
            self._grow(np.arange(len(points)), 2.0)

    def _node(self, members: np.ndarray, radius: float) -> int:
        self.centre.append(int(members[0]))
        self.radius.append(radius)
        self.children.append(None)
        self.members.append(members)
        return len(self.centre) - 1

    def _grow(self, members: np.ndarray, reach: float) -> None:
        first = self._node(members, self._furthest(members))
        pending = [(first, reach)]
        while pending:
            node, reach = pending.pop()
            members = self.members[node]
            if len(members) <= LEAF or self.radius[node] < 1e-7:
                continue
            reach = min(reach / 2, self.radius[node] / 2)
            made, left = [], members
            while len(left):
                away = _distance(self.points[left[:1]], self.points[left])[0]
                near = away <= reach
                near[0] = True
                own = left[near]
                made.append(self._node(own, float(away[near].max())))
                left = left[~near]
            self.children[node] = np.array(made)
            pending += [(m, reach) for m in made]

    def _furthest(self, members: np.ndarray) -> float:
        return float(_distance(self.points[members[:1]], self.points[members]).max())

    def freeze(self) -> CoverTree:
        self.centres, self.radii = np.array(self.centre, dtype=int), np.array(self.radius)
        self.single = np.array([len(m) == 1 for m in self.members], dtype=bool)
        return self


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def linked_pairs(left: CoverTree, right: CoverTree, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """All pairs of points with at least ``similarity``, by traversing both trees at once.

    A pair of nodes is dropped if its centres are further apart than both covering radii and the
    threshold, and taken whole if even the furthest points are near enough. Yields (left points, right points, all
    combinations?).
    """
    if not len(left.points) or not len(right.points):
        return
    limit = np.sqrt(2 - 2 * similarity)
    pending = [(0, 0)]
    while pending:
        a, b = pending.pop()
        some = [tree.children[n] if tree.children[n] is not None else np.array([n]) for tree, n in ((left, a), (right, b))]
        if left.children[a] is None and right.children[b] is None:
            ours, theirs = left.members[a], right.members[b]
            near = left.points[ours] @ right.points[theirs].T >= similarity
            i, j = np.nonzero(near)
            if len(i):
                yield ours[i], theirs[j], False
            continue
        step = max(1, PAIRS // len(some[1]))
        for at in range(0, len(some[0]), step):
            ours, theirs = some[0][at : at + step], some[1]
            dots = left.points[left.centres[ours]] @ right.points[right.centres[theirs]].T
            apart = np.sqrt(np.maximum(2 - 2 * dots, 0))
            # Two single points are a pair, which its own similarity decides.
            single = left.single[ours][:, None] & right.single[theirs][None]
            i, j = np.nonzero(single & (dots >= similarity))
            if len(i):
                yield left.centres[ours[i]], right.centres[theirs[j]], False
            reach = left.radii[ours][:, None] + right.radii[theirs][None]
            open_ = ~single & (apart - reach <= limit + SLACK)
            whole = open_ & (apart + reach <= limit - SLACK)
            for i, j in zip(*np.nonzero(whole)):
                yield left.members[ours[i]], right.members[theirs[j]], True
            pending += [(int(ours[i]), int(theirs[j])) for i, j in zip(*np.nonzero(open_ & ~whole))]


def _match(block: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links of the visitors of a block with its inhabitants: partial numbers of links, and edges that connect what links connect."""
    home, guests = block[block["visit"] == 0], block[block["visit"] != 0]
    points = [np.stack(side["unit"].to_numpy()) if len(side) else np.empty((0, 0)) for side in (home, guests)]
    trees = [CoverTree(p).freeze() for p in points]
    weights = [side["copies"].to_numpy() for side in (home, guests)]
    names = [side["vec_id"].to_numpy() for side in (home, guests)]
    inside = (guests["visit"] == 1).to_numpy()  # their own cell: both directions are met, so each counts for itself
    counts = [np.zeros(len(home), np.int64), np.zeros(len(guests), np.int64)]
    edges = []
    for ours, theirs, whole in linked_pairs(*trees, similarity):
        if whole:
            edges += [(names[0][ours[0]], names[1][theirs]), (names[0][ours], names[1][theirs[0]])]
            counts[1][theirs] += weights[0][ours].sum()
            counts[0][ours] += weights[1][theirs][~inside[theirs]].sum()
            same = np.isin(names[1][theirs], names[0][ours]) & inside[theirs]
            counts[1][theirs[same]] -= weights[1][theirs[same]]
            continue
        keep = ~(inside[theirs] & (names[0][ours] == names[1][theirs]))
        ours, theirs = ours[keep], theirs[keep]
        np.add.at(counts[1], theirs, weights[0][ours])
        out = ~inside[theirs]
        np.add.at(counts[0], ours[out], weights[1][theirs[out]])
        edges.append((names[0][ours], names[1][theirs]))
    forest = _forest(edges)
    rows = [pd.DataFrame({"a": n[c > 0], "b": n[c > 0], "n": c[c > 0]}) for n, c in zip(names, counts)]
    rows.append(pd.DataFrame({"a": forest[0], "b": forest[1], "n": 0}))
    return pd.concat(rows).astype({"a": "int64", "b": "int64", "n": "int64"})


def _forest(edges: list) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the edges: each end that is not the least of its part, with the least."""
    if not edges:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = (np.concatenate([np.broadcast_to(e[k], np.broadcast(e[0], e[1]).shape) for e in edges]) for k in (0, 1))
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        while not np.array_equal(up := root[root], root):
            root = up
        if np.array_equal(root, before):
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def near_vectors(vectors: DataFrame, similarity: float = SIMILARITY, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per vector the number of others of its label with at least ``similarity`` (cosine), and its component.

    Equal vectors of a label are one point with a number of copies. Each label's space is cut into
    cells around centres (a bounded sample); a point visits those other cells whose covering radius
    comes near enough, and every cell is met in blocks of bounded size, so a large cell or label is
    spread over many tasks. In a task, cover trees of inhabitants and visitors are traversed together.

    A null, zero or non-finite vector, one with a null component and one without a label links with
    nothing and is its own component; so do vectors of different lengths with each other, and rows
    with a null id (which stays null). A repeated id is one vector per row: its copies link when
    they are near, as any others do, and they share the id's component. Other columns are not read; no rows in, none out.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = vectors.select(*[F.col(f"`{c}`").alias(a) for c, a in ((id_column, "vec_id"), (vector, "embedding"), (label, "label"))])
    clean = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    valid = F.coalesce(clean & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    group = F.struct("label", F.size("embedding").alias("width"))
    own = rows.where(valid).groupBy(group.alias("space"), "embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    kind = dict(own.dtypes)

    def normalise(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(unit=[units(pd.Series([v]))[0][0] for v in batch["embedding"]]).drop(columns="embedding")

    points = own.mapInPandas(in_batches(normalise), f"space {kind['space']}, vec_id {kind['vec_id']}, copies long, unit array<double>")
    points = scratch.stage(points.select(F.xxhash64("space").alias("space_key"), "vec_id", "copies", "unit"), "points")
    broadcast = spark.sparkContext.broadcast(_centres(points))  # CENTRES vectors at most

    def settle(batch: pd.DataFrame) -> pd.DataFrame:
        cell, away = np.zeros(len(batch), np.int64), np.zeros(len(batch))
        keys = batch["space_key"].to_numpy()
        for key in np.unique(keys):
            heads = broadcast.value.get(int(key))
            if heads is not None:
                mine = np.nonzero(keys == key)[0]
                apart = _distance(np.stack(batch["unit"].iloc[mine].to_numpy()), heads)
                cell[mine], away[mine] = apart.argmin(axis=1), apart.min(axis=1)
        return batch.assign(cell=cell, away=away)

    settled = points.mapInPandas(in_batches(settle), f"space_key long, vec_id {kind['vec_id']}, copies long, unit array<double>, cell long, away double")
    settled = scratch.stage(settled, "settled")
    cells = scratch.stage(settled.groupBy("space_key", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")), "cells")
    centred = cells.where(F.col("space_key").isin(list(broadcast.value))) if broadcast.value else cells.limit(0)
    reach = {(r["space_key"], r["cell"]): r["radius"] for r in centred.collect()}  # a radius per centre
    limit = float(np.sqrt(2 - 2 * similarity)) + 1e-6

    def visits(batch: pd.DataFrame) -> pd.DataFrame:
        """For each point the cells it visits: its own (1), and later ones within reach of its own (2)."""
        out: list[list[int]] = [[] for _ in range(len(batch))]
        keys, cell = batch["space_key"].to_numpy(), batch["cell"].to_numpy()
        for key in np.unique(keys):
            heads = broadcast.value.get(int(key))
            if heads is None:
                continue
            mine = np.nonzero(keys == key)[0]
            number = np.arange(len(heads))
            radii = np.array([reach.get((int(key), j), -10.0) for j in number])
            apart = _distance(np.stack(batch["unit"].iloc[mine].to_numpy()), heads)
            go = (apart <= radii + limit) & (number[None] > cell[mine][:, None])
            for i, row in zip(mine, go):
                out[i] = number[row].tolist()
        return batch.assign(visits=out).drop(columns="away")

    columns = f"space_key long, vec_id {kind['vec_id']}, copies long, unit array<double>, cell long, visits array<long>"
    visiting = settled.mapInPandas(in_batches(visits), columns)
    # As many rows as cells, which grow with the labels: Spark decides how to join them.
    listed = cells.select("space_key", F.col("cell").alias("at"), F.ceil(F.col("n") / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks"))
    own_block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("own_blocks"))
    sizes = listed.select("space_key", F.col("at").alias("cell"), F.col("blocks").alias("own_blocks"))
    base = visiting.join(sizes, ["space_key", "cell"])
    guests = base.select("space_key", "cell", "own_blocks", "vec_id", "copies", "unit", F.explode(F.concat(F.array("cell"), "visits")).alias("at"))
    guests = guests.join(listed, ["space_key", "at"]).select(
        "space_key", "at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("home_block"),
        F.col("cell").alias("from_cell"), own_block.alias("guest_block"),
        F.when(F.col("cell") == F.col("at"), 1).otherwise(2).alias("visit"), "vec_id", "copies", "unit",
    )
    # Guests from one block of one cell meet one block of inhabitants: both sides are of bounded size.
    meetings = guests.select("space_key", "at", "home_block", "from_cell", "guest_block").distinct()
    homes = base.select("space_key", F.col("cell").alias("at"), F.pmod(F.xxhash64("vec_id"), F.col("own_blocks")).alias("home_block"), "vec_id", "copies", "unit")
    homes = homes.join(meetings, ["space_key", "at", "home_block"]).withColumn("visit", F.lit(0)).select(*guests.columns)
    met = homes.unionByName(guests).groupBy("space_key", "at", "home_block", "from_cell", "guest_block")
    found = met.applyInPandas(lambda block: _match(block, similarity), "a long, b long, n long")
    found = scratch.stage(found, "found")
    nodes = components(found.where("a <> b").select("a", "b"), scratch)
    totals = found.where("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    named = own.select("space", "embedding", F.col("vec_id").alias("rep"), "copies")
    named = named.join(totals, "rep", "left").join(nodes.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("space", "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = rows.where(valid).withColumn("space", group).join(named, ["space", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~valid).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _centres(points: DataFrame) -> dict[int, np.ndarray]:
    """The centres of each space that has several: points taken in the order of their hash.

    ``CENTRES`` at most in all: a space has one per CELL points, or its share of CENTRES if that is less, and
    no centre where this comes to less than two. Spaces are counted on Spark; those without centres never leave it.
    """
    spaces = points.groupBy("space_key").agg(F.count("*").alias("n"))
    total = spaces.agg(F.sum("n")).first()[0] or 0
    share = F.floor(F.lit(float(CENTRES)) * F.col("n") / F.lit(float(max(total, 1))))
    want = spaces.withColumn("want", F.least(F.ceil(F.col("n") / CELL), share)).where("want >= 2")
    spaces_wanted = {r["space_key"]: r["want"] for r in want.collect()}  # each takes two centres of CENTRES at least
    if not spaces_wanted:
        return {}
    own = points.where(F.col("space_key").isin(list(spaces_wanted))).select("space_key", "vec_id")
    drawn = [(key, i) for i, key in sample_ids(own, "vec_id", "space_key", max(spaces_wanted.values()), spaces_wanted)]
    chosen = points.sparkSession.createDataFrame(drawn, f"space_key long, vec_id {dict(points.dtypes)['vec_id']}")
    found: dict[int, list] = {}
    for row in points.join(F.broadcast(chosen), ["space_key", "vec_id"], "left_semi").select("space_key", "vec_id", "unit").collect():
        found.setdefault(row["space_key"], []).append((row["vec_id"], row["unit"]))
    return {key: np.array([unit for _, unit in sorted(rows)]) for key, rows in found.items()}


def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors within their label."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), good AS (
  SELECT vec_id, label, e FROM v
  WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), least AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), n AS (
  SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a
)
SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, least.component_id, v.vec_id = least.component_id AS kept
FROM v JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)
"""

QUERIES = {"op4_cover_tree": op4_cover_tree}
ORACLES = {"op4_cover_tree": SQL}
