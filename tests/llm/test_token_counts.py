"""Token counts against the libraries, and what the cache spares."""

import random

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from transit_spark.llm import token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def library_count(path, text):
    if path.endswith(".model"):
        return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text or ""))
    return len(tokenizers.Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids)


def check(docs, cache, path=BYTES, limit=token_counts.LIMIT):
    got = token_counts.count_tokens(docs, cache, path, limit=limit).collect()
    ours = sorted((tuple(r) for r in got), key=repr)
    known = {}
    theirs = []
    for r in docs.collect():
        text = r["text"]
        if text not in known:
            known[text] = library_count(path, text)
        theirs.append((r["doc_id"], len((text or "").encode()), known[text], known[text] > limit))
    assert ours == sorted(theirs, key=repr)


@pytest.mark.parametrize("path", [BYTES, WORDS, PIECES])
def test_equals_library(spark, documents, odd_documents, tmp_path, path):
    check(documents.limit(60), f"{tmp_path}/a", path)
    check(odd_documents, f"{tmp_path}/b", path)


@pytest.mark.parametrize("at_most", [0, token_counts.BROADCAST_DIGESTS])
def test_only_distinct_misses_are_encoded(spark, documents, tmp_path, monkeypatch, at_most):
    """By both ways of fetching the texts: the join and the broadcast list."""
    monkeypatch.setattr(token_counts, "BROADCAST_DIGESTS", at_most)
    cache = f"{tmp_path}/counts"
    half, copies = documents.where("doc_id % 2 = 0"), documents.where("doc_id % 2 = 0").limit(5)
    first = half.unionByName(copies).unionByName(copies)
    distinct = first.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert token_counts.update_cache(first, cache, BYTES) == distinct
    assert spark.read.parquet(cache).count() == distinct
    assert token_counts.update_cache(first, cache, BYTES) == 0
    others = documents.select(F.coalesce("text", F.lit(""))).distinct().count() - distinct
    assert token_counts.update_cache(documents, cache, BYTES) == others
    check(documents, cache)
    assert spark.read.parquet(cache).count() == distinct + others


def test_stored_counts_are_what_is_returned_and_belong_to_one_tokenizer(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words here"), (2, "Some words here")], "doc_id long, text string")
    cache = f"{tmp_path}/counts"
    stored = docs.where("doc_id = 1").select(F.lit(token_counts.tokenizer_digest(BYTES)).alias("tokenizer"), F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(77).cast("long").alias("n_tokens"))
    stored.write.partitionBy("tokenizer").parquet(cache)
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, cache, BYTES).collect()} == {1: 77, 2: 3}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, cache, PIECES).collect()} == {1: library_count(PIECES, "some words here"), 2: library_count(PIECES, "Some words here")}
    stored.write.mode("append").partitionBy("tokenizer").parquet(cache)  # a second writer at the same time
    assert token_counts.count_tokens(docs, cache, BYTES).count() == 2


def test_no_rows(no_documents, tmp_path):
    counted = token_counts.count_tokens(no_documents, f"{tmp_path}/counts")
    assert counted.collect() == [] and counted.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_words_and_slices_add_up(monkeypatch):
    draw = random.Random(5)
    parts = ["the", "THE", " ", "  ", "\n", "\t", "\x0b", "\x0c", "'s", "'ll", "é", "😀", "\x85", "\x1c", "1", "22", "!", "?!", "<|endoftext|>", "<|", "日本語", "\r\n", "\u0301"]
    wide = ["\xa0", "\u3000", "\u2028"]
    texts = ["".join(draw.choices(parts + wide * (k % 2), k=draw.randint(0, 40))) for k in range(3000)]
    whole = tokenizers.Tokenizer.from_file(BYTES)
    expected = [len(e.ids) for e in whole.encode_batch(texts, add_special_tokens=False)]
    counter = token_counts.Counter(BYTES)
    assert counter.byte_level and [counter.count(t) for t in texts] == expected
    for name, value in {"SLICE_CHARS": 5, "BATCH_CHARS": 50, "KEPT_WORDS": 100, "KEPT_LENGTH": 6}.items():
        monkeypatch.setattr(token_counts, name, value)
    counter = token_counts.Counter(BYTES)
    assert [counter.count(t) for t in texts] == expected and len(counter.kept) <= 100
    assert any(len(list(counter.slices(t))) > 3 for t in texts) and all("".join(counter.slices(t)) == t for t in texts)
    assert not token_counts.Counter(WORDS).byte_level


def test_very_long_text(spark, tmp_path):
    check(spark.createDataFrame([(1, "many words in one line " * 100_000), (2, "x" * 100_000)], "doc_id long, text string"), f"{tmp_path}/counts")
