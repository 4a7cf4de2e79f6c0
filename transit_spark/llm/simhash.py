"""SimHash fingerprints and their groups by covering locality-sensitive hashing."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.llm.common import Scratch, in_batches, table
from transit_spark.llm.components import components

BITS, RADIUS, WORDS, SEED = 64, 4, 4, 42
#: A bucket of more fingerprints than this is dealt anew by a second family of masks.
LARGE_BUCKET = 4096
#: Shingles hashed before their bits are added up.
STEP = 1 << 15


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The SimHash of the word shingles of ``text``; zero if it has no word."""
    parts = (text or "").encode().lower().split()  # bytes: only A-Z fall, only ASCII blanks split
    if not parts:
        return 0
    whole = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[words - 1 :] if len(parts) >= words else ends[-1:]
    first = starts[: len(last)]
    sums, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(last), STEP):
        pairs = zip(first[at : at + STEP].tolist(), last[at : at + STEP].tolist())
        hashes = np.array([digest(whole[a:b], SEED) for a, b in pairs], dtype=">u8")
        sums += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(sums * 2 > len(last)).tobytes(), "big")


@functools.lru_cache(4)
def masks(radius: int, seed: int = 1) -> np.ndarray:
    """The 2^(radius+1) - 1 masks of a covering family over 64 bits, after Pagh.

    Each bit position gets a non-zero vector of radius + 1 bits; the mask of a non-zero vector v keeps
    the positions whose vector has an odd product with v. The vectors of ``radius`` differing
    positions never span the whole space, so some v is orthogonal to all of them, and its mask hides
    every difference: the pair agrees under that mask.
    """
    dims = radius + 1
    order = np.random.default_rng(seed).permutation(BITS)
    vectors = np.empty(BITS, dtype=np.int64)
    vectors[order] = np.arange(BITS) % ((1 << dims) - 1) + 1
    out = []
    for v in range(1, 1 << dims):
        odd = [bin(int(x) & v).count("1") & 1 for x in vectors]
        out.append(sum(bit << i for i, bit in enumerate(odd)))
    return np.array(out, dtype=np.uint64)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id`` and the fingerprint as a signed long."""
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        marks = np.array([fingerprint(t, words) for t in batch["text"]], dtype=np.uint64)
        return pd.DataFrame({"doc_id": batch["doc_id"], "mark": marks.view(np.int64)})

    return rows.mapInPandas(in_batches(add), f"doc_id {dict(rows.dtypes)['doc_id']}, mark long")


def local_links(marks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``marks``: each mark that is linked, and the smallest of its part.

    Compares in blocks and joins parts as it goes; pairs are never kept.
    """
    n = len(marks)
    root = np.arange(n)

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    step = max(1, (1 << 20) // max(n, 1))
    for at in range(0, n, step):
        near = np.bitwise_count(marks[at : at + step, None] ^ marks[None, at:]) <= radius
        left, right = np.nonzero(near)
        left, right = left + at, right + at
        keep = left < right
        left, right = left[keep], right[keep]
        while len(left):
            # What already has one root needs no more joining.
            for i in np.unique(np.concatenate((left, right))):
                root[i] = top(i)
            differ = root[left] != root[right]
            left, right = left[differ], right[differ]
            if not len(left):
                break
            a, b = np.minimum(root[left], root[right]), np.maximum(root[left], root[right])
            _, one = np.unique(b, return_index=True)
            root[b[one]] = a[one]
    for i in range(n):
        root[i] = top(i)
    linked = root != np.arange(n)
    return marks[linked], marks[root[linked]]


def _keyed(marks: DataFrame, family: np.ndarray, key: str) -> DataFrame:
    """Each mark once per mask of ``family``: ``key`` (mask number) and ``key``_bits (what the mask keeps)."""
    listed = F.array(*[F.lit(int(m)) for m in family.view(np.int64)])
    return marks.select("*", F.posexplode(listed).alias(key, "_mask")).withColumn(f"{key}_bits", F.col("mark").bitwiseAND(F.col("_mask"))).drop("_mask")


def links(marks: DataFrame, scratch: Scratch, radius: int = RADIUS) -> DataFrame:
    """Edges (``a``, ``b``) that connect the distinct fingerprints of ``marks`` exactly as all pairs within ``radius`` do.

    A bucket of the first family shares about half of its bits; a large one is dealt anew by a second
    family, which leaves about a quarter of the bits free and so bounds a bucket at 2^16 or so
    different fingerprints, whatever the input. No bucket is cut or dropped.
    """
    first = _keyed(marks, masks(radius), "t")
    counted = first.groupBy("t", "t_bits").agg(F.count("*").alias("n")).where("n > 1")
    counted = scratch.stage(counted, "buckets")
    small = first.join(counted.where(f"n <= {LARGE_BUCKET}").select("t", "t_bits"), ["t", "t_bits"])
    large = first.join(counted.where(f"n > {LARGE_BUCKET}").select("t", "t_bits"), ["t", "t_bits"])
    second = _keyed(large, masks(radius, seed=2), "s")
    groups = small.groupBy("t", "t_bits").agg(F.collect_list("mark").alias("marks")).select("marks").union(
        second.groupBy("t", "t_bits", "s", "s_bits").agg(F.collect_list("mark").alias("marks")).where("size(marks) > 1").select("marks")
    )

    def connect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [local_links(np.sort(np.asarray(m, dtype=np.int64).view(np.uint64)), radius) for m in batch["marks"]]
            ends = [np.concatenate(side).view(np.int64) if found else np.empty(0, np.int64) for side in zip(*found)] or [[], []]
            yield pd.DataFrame({"a": ends[0], "b": ends[1]}).drop_duplicates()

    return groups.mapInPandas(connect, "a long, b long")


def _parts(points: DataFrame, scratch: Scratch, radius: int) -> DataFrame:
    """The distinct fingerprints ``mark`` of ``points`` with the smallest one, ``part``, that links lead to."""
    edges = scratch.stage(links(points.select("mark"), scratch, radius).distinct(), "links")
    nodes = components(edges, scratch)
    parts = points.join(nodes, points["mark"] == nodes["node"], "left").select(*points.columns, F.coalesce("component", "mark").alias("part"))
    return scratch.stage(parts, "parts")


def one_per_group(docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: one with the smallest id, null ids last.

    The group decides, not the id: rows that share an id, or have none, stay if their groups differ.
    Of rows of a group that share its smallest id the one with the smallest fingerprint stays, then
    the smallest row, or the row of smallest checksum if a column has a type without order (a map, say).
    Rows of one fingerprint are folded on the map side; no rows in, none out.
    """
    scratch = Scratch(docs.sparkSession)
    mark = F.pandas_udf(lambda texts: pd.Series(np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64)), "long")
    doc = F.col(f"`{id_column}`")
    row = F.struct(doc.isNull().alias("no_id"), doc.alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    least = F.min("best")
    if any(kind in of_column for _, of_column in docs.dtypes for kind in ("map<", "variant")):
        least = F.min_by("best", F.struct("best.no_id", "best.id", F.md5(F.to_json("best.row"))))
    points = docs.select(mark(F.col(f"`{text}`")).alias("mark"), row.alias("best")).groupBy("mark").agg(least.alias("best"))
    points = scratch.stage(points, "points")
    parts = _parts(points.select("mark", "best.no_id", "best.id"), scratch, radius)
    first = parts.groupBy("part").agg(F.min(F.struct("no_id", "id", "mark")).alias("first")).select("first.mark")
    return points.join(first, "mark", "left_semi").select("best.row.*")


def near_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """Per row of ``docs`` its fingerprint and the smallest id that links of at most ``radius`` bits lead to.

    Equal fingerprints are one point, however many rows share it. A null text has no word and
    fingerprint zero, like an empty one; a null id is reported with its group but names none (a group
    of null ids only has a null component); repeated rows are reported as often as they occur; other
    columns are not read; no rows in, none out.
    """
    scratch = Scratch(docs.sparkSession)
    marked = scratch.stage(fingerprints(docs, id_column, text, words), "marks")
    points = scratch.stage(marked.groupBy("mark").agg(F.min("doc_id").alias("least")), "points")
    parts = _parts(points, scratch, radius)
    least = parts.groupBy("part").agg(F.min("least").alias("component_id"))
    named = parts.join(least, "part").select("mark", "component_id")
    return marked.join(named, "mark").select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with fingerprint and near-duplicate group."""
    return near_groups(table(spark, sf_dir, "documents"))


QUERIES = {"op6_simhash": op6_simhash}
ORACLES: dict[str, str] = {}
