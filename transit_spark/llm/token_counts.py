"""Token counts through a cache of content digests: only texts that no run has met are encoded."""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from transit_spark.llm.common import Scratch, table

LIMIT = 1024
#: Up to so many digests (of 32 bytes each) to encode are broadcast, so that the texts of hits stay where they are.
BROADCAST_DIGESTS = 100_000
CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"
#: Characters of a slice of a long text, and of texts given to the library at a time.
SLICE_CHARS, BATCH_CHARS = 1 << 19, 1 << 18
#: Words whose counts a task keeps; longer ones than KEPT_LENGTH are not kept.
KEPT_WORDS, KEPT_LENGTH = 300_000, 40
#: White space and what follows up to the next. No token of a byte-level vocabulary reaches from a visible
#: character into white space, so counts of words add up; WIDE_SPACE is the white space beyond ASCII.
WORD = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Where a long text may be cut whatever its white space.
BORDER = re.compile(r"[!-~](?=[ \n\t])")


class Counter:
    """Counts tokens as the library of a vocabulary file does, without begin, end or added special tokens."""

    def __init__(self, path: str):
        self.byte_level, self.kept = False, {}
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.pieces = None
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.byte_level = splits_before_blanks(path)

    def library_counts(self, texts: list[str]) -> list[int]:
        """The library's own counts, BATCH_CHARS at a time."""
        counts, held, chars = [], [], 0
        for text in [*texts, None]:
            if held and (text is None or chars + len(text) > BATCH_CHARS):
                counts += self._encode(held)
                held, chars = [], 0
            if text is not None:
                held.append(text)
                chars += len(text)
        return counts

    def _encode(self, texts: list[str]) -> list[int]:
        if self.pieces is not None:
            return [len(ids) for ids in self.pieces.encode(texts, num_threads=1)]
        return [len(found.ids) for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def slices(self, text: str) -> Iterator[str]:
        """A long text in parts whose counts add up to its own."""
        start = 0
        while len(text) - start > SLICE_CHARS and (border := BORDER.search(text, start + SLICE_CHARS)):
            yield text[start : border.end()]
            start = border.end()
        yield text[start:]

    def count(self, text: str) -> int:
        """Tokens of a whole text; a byte-level vocabulary meets each distinct word once while it is kept."""
        if not self.byte_level:
            return self.library_counts([text])[0]
        total = 0
        for part in self.slices(text):
            if WIDE_SPACE.search(part):
                total += self.library_counts([part])[0]
                continue
            words = WORD.findall(part)
            kept = self.kept
            if new := [w for w in set(words) if w not in kept]:
                if len(kept) + len(new) > KEPT_WORDS:
                    kept = self.kept = {}
                    new = list(set(words))
                kept.update(zip(new, self.library_counts(new)))
            total += sum(map(kept.__getitem__, words))
            for word in new:
                if len(word) > KEPT_LENGTH:
                    del kept[word]
        return total


def splits_before_blanks(path: str) -> bool:
    """Whether the file's settings prove that a token never reaches from a visible character into white space:
    byte level by its own pattern, nothing normalised, and added tokens without blanks that strip none."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    before = told.get("pre_tokenizer") or {}
    added = told.get("added_tokens") or []
    return (
        before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        and told.get("normalizer") is None and told.get("post_processor") is None
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added)
    )


@functools.lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(8)
def tokenizer_digest(path: str) -> str:
    """Names what decides a count: the vocabulary file, the library and its version, and the settings used here."""
    import importlib.metadata

    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read()).hexdigest()
    settings = f"{library} {importlib.metadata.version(library)} whole texts, no added tokens"
    return hashlib.sha256(f"{content} {settings}".encode()).hexdigest()


def stored_counts(spark: SparkSession, cache: str) -> DataFrame:
    """The rows of the cache folder; none where there is no folder yet."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def null_as_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def update_cache(
    docs: DataFrame, cache: str, path: str | None = None, text: str = "text", normalise: Callable[[Column], Column] = null_as_empty,
) -> int:
    """Counts the texts of ``docs`` that the ``cache`` folder lacks, appends them, and returns how many these were.

    First only the sha256 of the contents is shuffled and compared with the stored digests of the same
    tokenizer. The texts behind the misses are then fetched, each once: by a broadcast list while there
    are at most BROADCAST_DIGESTS of them, else by a join after copies are folded where they lie. Copies of
    one text, however many, are encoded once. ``normalise`` must not change a count. Two writers at a time
    may store a digest twice, with the same count; readers allow for it.
    """
    spark, path = docs.sparkSession, path or vocabulary_path()
    scratch, version = Scratch(spark), tokenizer_digest(path)
    rows = docs.select(normalise(F.col(f"`{text}`")).alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    known = stored_counts(spark, cache).where(F.col("tokenizer") == version).select("digest")
    missing = scratch.stage(rows.select("digest").distinct().join(known, "digest", "left_anti"), "missing")
    wanted = missing.count()
    if not wanted:
        scratch.drop("missing")
        return 0
    if wanted <= BROADCAST_DIGESTS:
        texts = rows.join(F.broadcast(missing), "digest", "left_semi").groupBy("digest").agg(F.first("text").alias("text"))
    else:
        texts = rows.groupBy("digest").agg(F.first("text").alias("text")).join(missing, "digest", "left_semi")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"tokenizer": version, "digest": batch["digest"], "n_tokens": [counter(path).count(text) for text in batch["text"]]})

    texts.mapInPandas(encode, CACHE_SCHEMA).write.mode("append").partitionBy("tokenizer").parquet(cache)
    scratch.drop("missing")
    return wanted


def count_tokens(
    docs: DataFrame, cache: str, path: str | None = None, id_column: str = "doc_id", text: str = "text",
    limit: int = LIMIT, normalise: Callable[[Column], Column] = null_as_empty,
) -> DataFrame:
    """Per row its bytes, tokens, and whether it has more than ``limit`` tokens; the cache holds all counts after it.

    ``path`` names a vocabulary file that every executor has, ``cache`` a folder that all executors share
    and that later calls read again. The digest of the tokenizer is part of a stored count's key, so
    another file or library version meets no old counts. A null text counts as empty (0 bytes, 0
    tokens, unless the tokenizer gives an empty text some); ids may be null or repeat, and repeated rows
    each give their row; other columns are not read; no rows in, none out.
    """
    path = path or vocabulary_path()
    update_cache(docs, cache, path, text, normalise)
    spark = docs.sparkSession
    content = normalise(F.col(f"`{text}`"))
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
    )
    known = stored_counts(spark, cache).where(F.col("tokenizer") == tokenizer_digest(path)).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    return rows.join(known, "digest", "left").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, from a cache that is empty at first, so that every distinct text is encoded here."""
    return count_tokens(table(spark, sf_dir, "documents"), f"{Scratch(spark).folder}/counts")


QUERIES = {"op12_token_counts": op12_token_counts}
ORACLES: dict[str, str] = {}
