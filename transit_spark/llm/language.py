"""Language identification with error-correcting output codes over hashed n-grams."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.llm.common import give_back, learnt_rows, rows_of_sample, sample_ids, table

BUCKETS = 4096
#: The classifiers are fitted on at most so many documents, split evenly over the languages.
SAMPLE = 2400
STEPS, RATE, SHRINK = 150, 4.0, 1e-5
#: A document is ambiguous if the two nearest codewords are nearer to each other than this share of the score.
CLEAR = 0.6
#: An n-gram is usual if this share of the sample's documents of some language have it. A document is foreign if more
#: of its profile is unusual than ``FOREIGN``, or than ``FAR`` times what the share ``MOST`` of the sample keeps to.
COMMON, FOREIGN, FAR, MOST = 0.02, 0.1, 2.0, 0.999
UNKNOWN = "und"
#: Bytes of a text that are turned into n-grams at once.
BLOCK = 1 << 20
#: Profiles that are decoded at once.
PROFILES = 256


@functools.cache
def _letters() -> np.ndarray:
    """ASCII letters and the bytes of other characters stay, all else is a blank."""
    keep = np.full(256, 32, dtype=np.uint32)
    for i in [*range(97, 123), *range(128, 256)]:
        keep[i] = i
    return keep


def profile(text: str | None) -> np.ndarray:
    """Square roots of the shares of hashed byte bigrams and trigrams of the whole text, of length 1."""
    raw = np.frombuffer((text or "").lower().encode(), dtype=np.uint8)
    counts = np.zeros(BUCKETS)
    for at in range(0, len(raw), BLOCK):
        # Two bytes of overlap; each n-gram is counted where it begins.
        own = np.concatenate((_letters()[raw[at : at + BLOCK + 2]], np.array([32, 32], dtype=np.uint32)))
        a, b, c = own[:-2], own[1:-1], own[2:]
        a, b, c = a[:BLOCK], b[:BLOCK], c[:BLOCK]
        two, three = a << 8 | b, a << 16 | b << 8 | c
        for grams, seed in ((two[two != 0x2020], 2654435761), (three[(three >> 8 != 0x2020)], 2246822519)):
            counts += np.bincount((grams * np.uint32(seed)) >> np.uint32(20), minlength=BUCKETS)
    counts = np.sqrt(counts)
    norm = np.linalg.norm(counts)
    return (counts / norm if norm else counts).astype(np.float32)


def codewords(languages: int) -> np.ndarray:
    """One row of +1/-1 per language: rows of a Hadamard matrix without its constant column. Any two differ in half of the bits."""
    size = 8
    while size < languages:
        size *= 2
    matrix = np.array([[1]])
    while len(matrix) < size:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    words = matrix[:languages, 1:]
    return words[:, np.abs(words.sum(axis=0)) < languages]  # a bit that is equal in all words tells nothing


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray
    weights: np.ndarray  # BUCKETS x bits
    bias: np.ndarray
    trust: np.ndarray  # languages x bits: how well a bit was learnt for a language
    usual: np.ndarray | None = None  # which buckets of n-grams are usual in some language
    limit: float = np.inf  # the share of unusual n-grams up to which a text is of a learnt language

    def foreign(self, profiles: np.ndarray) -> np.ndarray:
        """Whether too much of each profile is unusual in all languages; the codewords tell only learnt ones apart."""
        return np.zeros(len(profiles), bool) if self.usual is None else (profiles**2)[:, ~self.usual].sum(axis=1) > self.limit

    def predict(self, profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and ambiguity of each profile, by loss-weighted decoding."""
        margins = profiles @ self.weights + self.bias
        loss = np.log1p(np.exp(-np.clip(margins[:, None, :] * self.words[None], -30, 30)))
        total = (loss * self.trust[None]).sum(axis=2) * self.words.shape[1]
        near = np.exp(-(total - total.min(axis=1, keepdims=True)))
        share = near / near.sum(axis=1, keepdims=True)
        best = total.argmin(axis=1)
        ordered = np.sort(share, axis=1)
        second = ordered[:, -2] if share.shape[1] > 1 else np.zeros(len(share))
        return best, ordered[:, -1], ordered[:, -1] - second < CLEAR * ordered[:, -1]


def fit(profiles: np.ndarray, targets: np.ndarray, languages: list[str]) -> Model:
    """One logistic classifier per bit, all bits at once; languages weigh the same."""
    words = codewords(len(languages)) if len(languages) > 1 else np.ones((1, 1))
    bits = words[targets].astype(np.float32)
    share = 1 / np.bincount(targets, minlength=len(languages))[targets]
    share = (share / share.sum()).astype(np.float32)[:, None]
    weights, bias = np.zeros((profiles.shape[1], words.shape[1]), np.float32), np.zeros(words.shape[1], np.float32)
    speed, bias_speed = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(STEPS):
        pull = -bits / (1 + np.exp(np.clip(bits * (profiles @ weights + bias), -30, 30))) * share
        speed = 0.9 * speed - RATE * (profiles.T @ pull + SHRINK * weights)
        bias_speed = 0.9 * bias_speed - RATE * pull.sum(axis=0)
        weights, bias = weights + speed, bias + bias_speed
    right = ((profiles @ weights + bias) * bits > 0).astype(float)
    trust = np.array([right[targets == i].mean(axis=0) for i in range(len(languages))])
    trust = np.maximum(trust, 1e-3)
    return Model(languages, words, weights, bias, trust / trust.sum(axis=1, keepdims=True), *usual_grams(profiles, targets, len(languages)))


def usual_grams(profiles: np.ndarray, targets: np.ndarray, languages: int) -> tuple[np.ndarray, float]:
    """The usual buckets and the limit of unusual ones. For the limit each document is held against the others, so
    that a sample too small to tell what is usual rejects nothing."""
    counts = np.array([(profiles[targets == i] > 0).sum(axis=0) for i in range(languages)])
    need = np.maximum(1, np.ceil(COMMON * np.bincount(targets, minlength=languages)))[:, None]
    usual, strange = counts >= need, np.zeros(len(profiles))
    for i in range(languages):
        others = np.delete(usual, i, axis=0).any(axis=0) | (counts[i] - 1 >= need[i])
        strange[targets == i] = (profiles[targets == i] ** 2)[:, ~others].sum(axis=1)
    return usual.any(axis=0), max(FOREIGN, FAR * float(np.quantile(strange, MOST)))


def learn(docs: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Fits on the documents whose crc32(id) mod 3 is not 1 and whose language is known; None if there is none.

    At most ``sample`` documents (20 of a language, where these are more), spread evenly over the languages, are taken
    in the order of their ids' hash. Of rows with the same id and language the one with the smallest text counts.
    """
    known = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in ((id_column, "doc_id"), (text, "text"), (lang, "lang"))])
    known = known.where(learnt_rows("doc_id", 3, 1) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    languages = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    if not languages:
        return None
    ids = sample_ids(known, "doc_id", "lang", max(20, sample // len(languages)))

    def profiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang": batch["lang"], "profile": [profile(t).tobytes() for t in batch["text"]]})

    kind = dict(known.dtypes)["doc_id"]
    rows = rows_of_sample(known, ids, "lang").mapInPandas(profiles, f"doc_id {kind}, lang string, profile binary").toPandas()
    rows = rows.sort_values(["doc_id", "lang"])
    data = np.frombuffer(b"".join(rows["profile"]), dtype=np.float32).reshape(len(rows), BUCKETS)
    names = sorted(rows["lang"].unique())
    return fit(data, rows["lang"].map({n: i for i, n in enumerate(names)}).to_numpy(), names)


def identify(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """Per row the predicted language, its score (0 to 1) and whether it is ambiguous.

    A null text, one without any letter, or no model at all gives ``und`` with score 0 and no
    ambiguity. Ids may be null or repeat; a null id counts as not held out. Whole texts are read, in
    blocks. With ``keep`` the row itself is passed on as the struct ``row``, with ``foreign``: whether
    the text has too many n-grams that are unusual in all learnt languages; else other columns are
    not read. No rows in, none out.
    """
    value = F.col(f"`{text}`")
    columns = [F.col(f"`{id_column}`").alias("doc_id"), value.alias("text"), F.coalesce(value.rlike(r"\p{L}"), F.lit(False)).alias("_letters")]
    if keep:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = docs.select(*columns).withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)))
    rows = rows.withColumn("_text", F.when(F.col("_letters"), F.col("text"))).drop("text", "_letters")

    def add(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "ambiguous": False, "foreign": False})
        has = texts.notna().to_numpy()
        if model is not None and has.any():
            known = texts[has]
            # A profile is far larger than most texts, so only some are in memory at once.
            found = []
            for at in range(0, len(known), PROFILES):
                profiles = np.stack([profile(t) for t in known.iloc[at : at + PROFILES]])
                found.append((*model.predict(profiles), model.foreign(profiles)))
            best, score, doubt, foreign = (np.concatenate(parts) for parts in zip(*found))
            out.loc[has, "lang_pred"] = [model.languages[i] for i in best]
            out.loc[has, "score"], out.loc[has, "ambiguous"] = score.astype(float), doubt
            out.loc[has, "foreign"] = foreign
        return out

    def add_all(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        give_back()
        yield from map(add, batches)

    predict = F.pandas_udf(add_all, "lang_pred string, score double, ambiguous boolean, foreign boolean")
    rows = rows.withColumn("_found", predict("_text"))
    found = ["lang_pred", "score", "ambiguous", *(["foreign"] if keep else [])]
    return rows.select("doc_id", "held_out", *[f"_found.{c}" for c in found], *(["row"] if keep else []))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))


QUERIES = {"op5_language": op5_language}
ORACLES: dict[str, str] = {}
