"""Source divergence against a plain computation over all terms and pairs."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from transit_spark.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def fold(term):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in term)


def plain(rows, min_docs=3, ranks=200, scale=10**9, smoothing=1):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        words = [fold(t) for t in TERM.findall(text or "")]
        group = (lang or "", source or "")
        groups.add(group)
        counts[group].update(words)
        docs[group[0]].update(set(words))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for g, s in groups if g == lang]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def share(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + scale * (n[t] + smoothing) // (total + smoothing * len(kept)) for t in kept}

        p, of_lang = share(counts[lang, source]), share(whole)
        pairs = []
        for other in sources:
            if other != source:
                q = share(counts[lang, other])
                pairs.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other.encode()))
        terms = [(-((p[t] - of_lang[t]) ** 2 // of_lang[t]), t.encode()) for t in kept if counts[lang, source][t] and p[t] > of_lang[t]]
        out += [(lang, source, "pair", i.decode(), -v, k + 1) for k, (v, i) in enumerate(sorted(pairs))]
        out += [(lang, source, "term", i.decode(), -v, k + 1) for k, (v, i) in enumerate(sorted(terms)[:ranks])]
    return sorted(out)


def check(docs, **options):
    found = divergence.source_divergence(docs, **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert [t for _, t in found.dtypes][-2:] == ["bigint", "int"]
    options.pop("digest", None)
    assert sorted(tuple(r) for r in found.collect()) == plain([(r["text"], r["lang"], r["source"]) for r in docs.collect()], **options)


def test_equals_plain_computation(documents):
    check(documents)


@pytest.mark.parametrize("buckets", [1, 7, 1000])
def test_colliding_digests_are_split(documents, buckets):
    check(documents.limit(80), digest=lambda label: len(label) * 31 % buckets if buckets < 50 else zlib.crc32(label) % buckets)


def test_collisions_by_join(documents, monkeypatch):
    monkeypatch.setattr(divergence, "BROADCAST_KEYS", 0)
    check(documents.limit(40), digest=lambda label: zlib.crc32(label) % 50)


def test_ties_at_the_last_rank_go_by_bytes(spark):
    draw = random.Random(3)
    terms = ["".join(draw.choices("abcdéß😀zZ", k=3)) for _ in range(60)]
    rows = [(" ".join(terms), "en", "a")] * 3 + [(" ".join(terms[:30]), "en", "b"), ("other words", "en", "b")]
    check(spark.createDataFrame(rows, "text string, lang string, source string"), ranks=7)


def test_options(documents):
    check(documents.limit(60), min_docs=1, ranks=3, scale=1000, smoothing=2)


def test_odd_rows(spark, odd_documents, no_documents):
    check(odd_documents)
    check(odd_documents, min_docs=1)
    check(odd_documents.unionByName(odd_documents).unionByName(odd_documents))
    assert divergence.source_divergence(no_documents).collect() == []
    rows = [(None, None, None), ("", "", "x"), ("123 ...", "en", "only signs"), ("a b", "fr", "a"), ("A B", "fr", None), ("a\x7fb\x80É", "fr", "a")]
    check(spark.createDataFrame(rows, "text string, lang string, source string"))


def test_counts_beyond_a_long_product(spark):
    """10^9 times a count of 10^10 passes 2^63; shares and gaps stay exact."""
    n, total, terms = 3 * 10**13 + 7, 10**14 + 1, 10**6
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms), 10**9, 1).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 1) // (total + terms)
    row = spark.range(1).select(divergence.gap(F.lit(10**9 + 1).cast("long"), F.lit(1).cast("long")).alias("f")).first()
    assert row["f"] == 10**18


def test_terms_over_slice_borders(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 5)
    draw = random.Random(1)
    for _ in range(300):
        text = "".join(draw.choices("aBé 1\n日", k=draw.randint(0, 60)))
        data = text.encode().translate(divergence.FOLD)
        assert [t.decode() for part in divergence.slices(data) for t in part] == [fold(t) for t in TERM.findall(text)]


def test_only_digests_are_shuffled_for_counts(documents):
    """What is counted holds no text, and each part names each key once."""
    found = divergence.term_rows(documents, F.xxhash64("lang", "source"), "text", "lang", zlib.crc32).collect()
    counted, named = [r for r in found if r["gid"] is not None], [r for r in found if r["gid"] is None]
    assert counted and all(r["label"] is None for r in counted) and {r["key"] for r in counted} == {r["key"] for r in named}
    assert len(named) == len({(r["key"], r["label"]) for r in named})  # one part here
    assert all(r["key"] % 2 == 0 for r in found)
