"""How the words of each source diverge from other sources and from their language: term digests in the shuffles, texts only for what is returned."""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from transit_spark.llm.common import Scratch, table

MIN_DOCS, RANKS, SCALE, SMOOTHING = 3, 200, 1_000_000_000, 1
#: Terms a task counts before it passes them on, and bytes of a text whose words are taken at a time.
HELD_TERMS, SLICE = 300_000, 1 << 22
#: Up to so many keys (of 8 bytes) whose texts are wanted are broadcast; more are joined.
BROADCAST_KEYS = 100_000
#: Every byte that is no ASCII letter and no part of a wider character becomes a blank; A-Z become a-z.
FOLD = bytes((b | 32 if 0x41 <= b <= 0x5A else b) if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Stands between the language and the term of a label; no term holds it.
BETWEEN = "\0"


def slices(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, SLICE bytes at a time; a term that reaches over a border is kept whole."""
    start = 0
    while len(data) - start > SLICE:
        end = data.find(b" ", start + SLICE)
        if end < 0:
            break
        yield data[start:end].split()
        start = end
    yield data[start:].split()


def named_groups(docs: DataFrame, lang: str, source: str, scratch: Scratch) -> tuple[DataFrame, Column]:
    """(gid, lang, source) of every group, and the expression that names a row's group by 64 bits.

    The seed is the first under which all groups have names of their own.
    """
    both = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang, source)]
    for seed in itertools.count():
        gid = F.xxhash64(F.lit(seed), *both)
        groups = scratch.stage(docs.select(gid.alias("gid"), both[0].alias("lang"), both[1].alias("source")).distinct(), f"groups-{seed}")
        found = groups.agg(F.count("*").alias("all"), F.count_distinct("gid").alias("names")).first()
        if found["all"] == found["names"]:
            return groups, gid
    raise AssertionError


def term_rows(docs: DataFrame, gid: Column, text: str, lang: str, digest: Callable[[bytes], int], labelled: bool = False) -> DataFrame:
    """Rows (gid, key, n, docs) of counts, and rows (key, label) that tell what a key stands for.

    A key is the digest of a language and a term, its lowest bit 0; a label is both in full. Counts are
    summed within parts of a task and carry no text, unless ``labelled``; each part names each of its
    keys once. A row of ``docs`` is a document, also if it is repeated.
    """
    rows = docs.select(
        gid.alias("gid"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    schema = pa.schema([("gid", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("docs", pa.int64()), ("label", pa.binary())])

    def flush(held: dict[int, tuple[str, Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for name in {lang for lang, _, _ in held.values()}:
            own = [(gid, n, seen) for gid, (lang, n, seen) in held.items() if lang == name]
            terms = list(set().union(*[n for _, n, _ in own]))
            head = f"{name}{BETWEEN}".encode()
            labels = [head + t for t in terms]
            keys = (np.fromiter(map(digest, labels), np.uint64, len(labels)) << np.uint64(1)).view(np.int64)
            key_of, label_of = dict(zip(terms, keys.tolist())), dict(zip(terms, labels))
            for gid, n, seen in own:
                size = len(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, gid)), pa.array(np.fromiter(map(key_of.__getitem__, n), np.int64, size)),
                        pa.array(np.fromiter(n.values(), np.int64, size)), pa.array(np.fromiter(map(seen.__getitem__, n), np.int64, size)),
                        pa.array([label_of[t] for t in n], pa.binary()) if labelled else pa.nulls(size, pa.binary()),
                    ],
                    schema=schema,
                )
            if not labelled:
                none = pa.nulls(len(keys), pa.int64())
                yield pa.RecordBatch.from_arrays([none, pa.array(keys), none, none, pa.array(labels, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[str, Counter, Counter]] = {}
        size = 0
        for batch in batches:
            texts = batch.column("text")
            for row, (gid, name) in enumerate(zip(batch.column("gid").to_pylist(), batch.column("lang").to_pylist())):
                _, n, seen = held.setdefault(gid, (name, Counter(), Counter()))
                before = len(n)
                own: set[bytes] = set()
                for terms in slices(texts[row].as_py().translate(FOLD)):
                    n.update(terms)
                    own.update(terms)
                seen.update(own)
                size += len(n) - before
                if size > HELD_TERMS:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    found = rows.mapInArrow(run, "gid long, key long, n long, docs long, label binary")
    return found.withColumn("label", F.col("label").cast("string"))


def few_broadcast(keys: DataFrame) -> DataFrame:
    """``keys``, staged, broadcast while there are at most BROADCAST_KEYS of them."""
    return F.broadcast(keys) if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else keys


def split_collisions(found: DataFrame, recount: Callable[[], DataFrame], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(gid, key, n, docs) of every part, and (key, label), each key standing for one label.

    The smallest and the largest label of a key tell whether it stands for several. Only then ``recount``
    reads the texts again, and the labels of such a key get keys of their own, with lowest bit 1: the
    first seed of a second digest under which they differ is taken.
    """
    counts = found.where("gid IS NOT NULL").select("gid", "key", "n", "docs")
    ends = scratch.stage(found.where("gid IS NULL").groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("last")), "ends")
    shared = scratch.stage(ends.where("label <> last").select("key"), "shared")
    if shared.isEmpty():
        return counts, ends.select("key", "label")
    several = scratch.stage(found.where("gid IS NULL").join(few_broadcast(shared), "key", "left_semi").select("key", "label").distinct(), "several")
    wanted = several.count()
    for seed in itertools.count():
        own = several.withColumn("own", F.xxhash64(F.lit(seed), "label").bitwiseOR(F.lit(1).cast("long")))
        if own.select("own").distinct().count() == wanted:
            break
    again = recount().join(few_broadcast(own), ["key", "label"]).select("gid", F.col("own").alias("key"), "n", "docs")
    single = counts.join(few_broadcast(shared), "key", "left_anti")
    names = ends.where("label = last").select("key", "label").unionByName(own.select(F.col("own").alias("key"), "label"))
    return single.unionByName(again), names


def share(count: Column, total: Column, terms: Column, scale: int, smoothing: int) -> Column:
    """1 + floor(scale * (count + smoothing) / (total + smoothing * terms)), exact for counts of any table."""
    high = F.lit(scale).cast("decimal(12,0)") * (count + smoothing).cast("decimal(20,0)")
    return F.call_function("div", high, (total + F.lit(smoothing) * terms).cast("decimal(20,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q) * (p - q) / q); both lie between 1 and scale + 1, so that the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def times(count: Column, value: Column) -> Column:
    return (count.cast("decimal(18,0)") * value.cast("decimal(20,0)")).cast("decimal(38,0)")


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, ranks: int = RANKS,
    scale: int = SCALE, smoothing: int = SMOOTHING, digest: Callable[[bytes], int] = xxhash.xxh64_intdigest,
) -> DataFrame:
    """Per group (lang, source): its distance to each other source of the language (part ``pair``), and the
    terms it uses more than its language does, the strongest first, to rank ``ranks`` (part ``term``).

    Counts, the choice of terms and all sums shuffle names of 64 bits for groups and for terms of a
    language; labels lie in a table beside them and are joined for ties at the last rank and for the
    result. Labels of one name are found by its smallest and largest label and get names of their own
    (``split_collisions``), so the result does not depend on ``digest``. All arithmetic is on integers.

    Pairs: terms that only one of two sources has meet the other's share of an unused term, so their sum
    comes from the source's histogram of counts; only terms that both have are joined. Null text, lang
    or source count as empty; groups without terms have distances (0 where the language keeps no
    term); each repeated row counts; extra columns are not read; no rows in, none out. Ties: item in byte order.
    """
    scratch = Scratch(docs.sparkSession)
    groups, gid = named_groups(docs, lang, source, scratch)
    found = scratch.stage(term_rows(docs, gid, text, lang, digest), "found")
    counts, labels = split_collisions(found, lambda: term_rows(docs, gid, text, lang, digest, labelled=True), scratch)
    # One shuffle by term brings all groups of a term together; a part of a task has one row of it per group.
    of_term = Window.partitionBy("key")
    used = counts.repartition("key").groupBy("key", "gid").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    used = used.select(
        "key", "gid", "n", F.sum("docs").over(of_term).alias("docs"), F.sum("n").over(of_term).alias("lang_n"), (F.min("gid").over(of_term) == F.col("gid")).alias("first")
    )
    used = scratch.stage(used.where(F.col("docs") >= min_docs).drop("docs"), "used")

    # One row per group: N of the group and of its language, V, and the share of a term that does not occur.
    first = F.col("first").cast("long")
    per_group = used.groupBy("gid").agg(F.sum("n").alias("total"), F.count("*").alias("own"), F.sum(first * F.col("lang_n")).alias("lang_total"), F.sum(first).alias("terms"))
    totals = groups.join(per_group, "gid", "left").na.fill(0, ["total", "own", "lang_total", "terms"])
    of_lang = totals.groupBy("lang").agg(F.sum("lang_total").alias("lang_total"), F.sum("terms").alias("terms"))
    totals = totals.drop("lang_total", "terms").join(of_lang, "lang")

    def p_of(n: Column, total: Column) -> Column:
        return share(n, total, F.col("terms"), scale, smoothing)

    unused = F.when(F.col("terms") > 0, p_of(F.lit(0).cast("long"), F.col("total")))
    totals = scratch.stage(totals.withColumn("unused", unused), "totals")
    shares = used.join(totals, "gid").select(
        "key", "gid", "n", p_of(F.col("n"), F.col("total")).alias("p"), "unused", p_of(F.col("lang_n"), F.col("lang_total")).alias("q")
    )
    parts = _pairs(shares, totals).unionByName(_terms(shares, labels, ranks, scratch))
    return parts.join(groups, "gid").select("lang", "source", "part", "item", "value", "rank")


def _pairs(shares: DataFrame, totals: DataFrame) -> DataFrame:
    """Sums of the gap over all kept terms, per ordered pair of sources of a language."""
    one = totals.select("lang", F.col("gid").alias("a"), F.col("own").alias("own_a"), F.col("unused").alias("unused_a"), "terms")
    two = totals.select("lang", F.col("gid").alias("b"), F.col("source").alias("item"), F.col("own").alias("own_b"), F.col("unused").alias("unused_b"))
    both = one.join(two, "lang").where("a <> b")
    bars = shares.groupBy("gid", "p").agg(F.count("*").alias("bar"))
    # Terms of a against the share of an unused term in b, and the other way round; then those that neither has.
    left = both.join(bars.withColumnRenamed("gid", "a"), "a").select("a", "b", times(F.col("bar"), gap(F.col("p"), F.col("unused_b"))).alias("value"))
    right = both.join(bars.withColumnRenamed("gid", "b"), "b").select("a", "b", times(F.col("bar"), gap(F.col("unused_a"), F.col("p"))).alias("value"))
    rest = both.select("a", "b", F.coalesce(times(F.col("terms") - F.col("own_a") - F.col("own_b"), gap(F.col("unused_a"), F.col("unused_b"))), F.lit(0)).cast("decimal(38,0)").alias("value"))
    # Terms that both have: their true gap in place of what the sums above hold for them.
    l, r = shares.select("key", "gid", "p", "unused").alias("l"), shares.select("key", "gid", "p", "unused").alias("r")
    p, q, p0, q0 = F.col("l.p"), F.col("r.p"), F.col("l.unused"), F.col("r.unused")
    mend = gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0)
    back = gap(q, p) - gap(q, p0) - gap(q0, p) + gap(q0, p0)
    met = l.join(r, F.col("l.key") == F.col("r.key")).where(F.col("l.gid") < F.col("r.gid"))
    met = met.groupBy(F.col("l.gid").alias("x"), F.col("r.gid").alias("y")).agg(*[F.sum(c.cast("decimal(20,0)")).cast("decimal(38,0)").alias(n) for c, n in ((mend, "mend"), (back, "back"))])
    met = met.select(F.inline(F.array(F.struct(F.col("x").alias("a"), F.col("y").alias("b"), F.col("mend").alias("value")), F.struct(F.col("y").alias("a"), F.col("x").alias("b"), F.col("back").alias("value")))))
    sums = left.unionByName(right).unionByName(rest).unionByName(met).groupBy("a", "b").agg(F.sum(F.col("value").cast("decimal(28,0)")).cast("long").alias("value"))
    named = sums.join(two.select("b", "item"), "b")
    order = Window.partitionBy("a").orderBy(F.col("value").desc(), "item")
    return named.select(F.col("a").alias("gid"), F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _terms(shares: DataFrame, labels: DataFrame, ranks: int, scratch: Scratch) -> DataFrame:
    """The terms a group uses more than its language, to the last rank; texts are joined for them alone."""
    risen = scratch.stage(shares.where("p > q").select("gid", "key", gap(F.col("p"), F.col("q")).alias("value")), "risen")
    place = F.row_number().over(Window.partitionBy("gid").orderBy(F.col("value").desc()))
    least = risen.select("gid", "value").withColumn("place", place).where(F.col("place") <= ranks).groupBy("gid").agg(F.min("value").alias("least"))
    # All terms of the least value that still has a place are candidates: their texts decide who takes it.
    near = scratch.stage(risen.join(least, "gid").where("value >= least").drop("least"), "near")
    named = labels.join(few_broadcast(near), "key").withColumn("item", F.substring_index("label", BETWEEN, -1))
    order = Window.partitionBy("gid").orderBy(F.col("value").desc(), "item")
    last = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    return last.select("gid", F.lit("term").alias("part"), "item", "value", "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources of all languages of the documents."""
    return source_divergence(table(spark, sf_dir, "documents"))


SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(text, '') AS body, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (
    SELECT doc, lang, source, translate(unnest(regexp_extract_all(body, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM docs),
kept AS (SELECT lang, term, CAST(count(*) AS BIGINT) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= {MIN_DOCS}),
languages AS (SELECT lang, CAST(count(*) AS BIGINT) AS v, CAST(sum(lang_n) AS BIGINT) AS lang_total FROM kept GROUP BY lang),
used AS (SELECT w.lang, w.source, w.term, CAST(count(*) AS BIGINT) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY w.lang, w.source, w.term),
totals AS (
    SELECT g.lang, g.source, coalesce(CAST(sum(u.n) AS BIGINT), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN used u ON g.lang = u.lang AND g.source = u.source GROUP BY g.lang, g.source),
shares AS (
    SELECT t.lang, t.source, k.term, coalesce(u.n, 0) AS n, 1 + ({SCALE} * (coalesce(u.n, 0) + {SMOOTHING})) // (t.total + {SMOOTHING} * l.v) AS p,
        1 + ({SCALE} * (k.lang_n + {SMOOTHING})) // (l.lang_total + {SMOOTHING} * l.v) AS lang_p
    FROM totals t JOIN languages l ON t.lang = l.lang JOIN kept k ON t.lang = k.lang
    LEFT JOIN used u ON t.lang = u.lang AND t.source = u.source AND k.term = u.term),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
    FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, CAST(((p - lang_p) * (p - lang_p)) // lang_p AS BIGINT) AS value FROM shares WHERE n > 0 AND p > lang_p)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= {RANKS}
"""
QUERIES = {"op13_source_divergence": op13_source_divergence}
ORACLES = {"op13_source_divergence": SQL}
