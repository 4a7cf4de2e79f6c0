"""Document quality by attention-based multiple-instance learning."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.llm.common import give_back, learnt_rows, rows_of_sample, sample_ids, table

#: Words of a passage; hashed pairs of bytes; hidden units; units of the attention.
PASSAGE, PAIRS, HIDDEN, ATTENTION = 64, 128, 24, 12
#: The model is fitted on at most so many labelled documents, half of each label as far as they reach, with all their passages.
SAMPLE = 3000
EPOCHS, BATCH, RATE, SHRINK = 14, 50, 4e-3, 1e-4
THRESHOLD = 0.3
#: Passages of a text that are in memory at once.
BLOCK = 2048
SHAPES = 13
FEATURES = SHAPES + 4 + PAIRS


@functools.cache
def _shapes() -> np.ndarray:
    """The class of each byte."""
    kinds = np.full(256, 11, dtype=np.int64)
    for number, signs in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r\t\v\f", b".", b",;:", b"!?", b"'\"-()", b"#$%&*|~^@\\/", b"<>[]{}=+_")):
        kinds[list(signs)] = number
    kinds[128:] = 12
    return kinds


def passages(text: str | None) -> Iterator[np.ndarray]:
    """Features of the passages of a whole text, in blocks; an empty text is one passage of zeros."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        yield np.zeros((1, FEATURES), dtype=np.float32)
        return
    data = np.frombuffer(raw, dtype=np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.nonzero(~blank & np.concatenate(([True], blank[:-1])))[0]
    cuts = np.append(begins[::PASSAGE], len(data))
    cuts[0] = 0
    for at in range(0, len(cuts) - 1, BLOCK):
        own = cuts[at : at + BLOCK + 1]
        n = len(own) - 1
        part = data[own[0] : own[-1]]
        number = np.repeat(np.arange(n), np.diff(own))
        shapes = np.bincount(number * SHAPES + _shapes()[part], minlength=n * SHAPES).reshape(n, SHAPES)
        low = part | np.uint8(32)
        pair = ((low[:-1].astype(np.uint32) << 8 | low[1:]) * np.uint32(2654435761)) >> np.uint32(25)
        pairs = np.bincount(number[:-1] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS)
        size = np.maximum(np.diff(own), 1)[:, None]
        sets, counts = [], []
        for k in range(at, at + n):
            mine = words[k * PASSAGE : (k + 1) * PASSAGE]
            sets.append(len(set(mine)))
            counts.append(len(mine))
        sets, counts = np.array(sets, dtype=float), np.array(counts, dtype=float)
        words_shape = np.stack((sets / counts, np.log(counts), np.log(size[:, 0] / counts), (sets > 0.6 * counts).astype(float)), axis=1)
        yield np.concatenate((np.sqrt(shapes / size), words_shape, np.sqrt(pairs / size)), axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def score(self, text: str | None) -> float:
        """The probability of label 1, from the attention-weighted mean of the encoded passages.

        The attention's softmax runs over the whole text block by block.
        """
        p = self.parts
        most, total, mean = -np.inf, 0.0, np.zeros(HIDDEN)
        for block in passages(text):
            hidden, attention = self._encode(block)
            top = max(most, float(attention.max()))
            share = np.exp(attention - top)
            keep = np.exp(most - top)
            total, mean, most = total * keep + share.sum(), mean * keep + share @ hidden, top
        return float(_sigmoid((mean / total) @ p["c"] + p["b"][0]))

    def _encode(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.parts
        hidden = np.tanh(np.clip((block - self.mean) / self.scale, -8, 8) @ p["E"] + p["e"])
        return hidden, (np.tanh(hidden @ p["V"]) * _sigmoid(hidden @ p["U"])) @ p["w"]


def moments(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of each feature, read block by block."""
    n, mean, square = 0, np.zeros(features.shape[1]), np.zeros(features.shape[1])
    for at in range(0, len(features), BLOCK):
        block = features[at : at + BLOCK].astype(np.float64)
        own, away = len(block), block.mean(axis=0) - mean
        square += ((block - block.mean(axis=0)) ** 2).sum(axis=0) + away**2 * n * own / (n + own)
        mean, n = mean + away * own / (n + own), n + own
    return mean.astype(np.float32), (np.sqrt(square / n) + 1e-3).astype(np.float32)


def fit(features: np.ndarray, sizes: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """Gated attention over encoded passages, learnt from the labels of whole documents with Adam.

    ``features`` holds the passages of all documents one after the other, ``sizes`` their numbers.
    """
    rng = np.random.default_rng(seed)
    mean, scale = moments(features)
    shape = {"E": (FEATURES, HIDDEN), "e": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "w": (ATTENTION,), "c": (HIDDEN,), "b": (1,)}
    p = {k: (rng.standard_normal(s) / np.sqrt(s[0]) if k in "EVUwc" else np.zeros(s)) for k, s in shape.items()}
    first, second = ({k: np.zeros(s) for k, s in shape.items()} for _ in range(2))
    starts, turn = np.concatenate(([0], np.cumsum(sizes)[:-1])), 0
    share = 0.5 / np.maximum(np.bincount(labels, minlength=2), 1)
    weight = share[labels] * len(labels)
    for _ in range(EPOCHS):
        order = rng.permutation(len(sizes))
        for at in range(0, len(order), BATCH):
            mine = order[at : at + BATCH]
            rows = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in mine])
            lengths = sizes[mine]
            begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            x = np.clip((features[rows].astype(np.float32) - mean) / scale, -8, 8)
            h = np.tanh(x @ p["E"] + p["e"])
            t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
            logits = (t * s) @ p["w"]
            a = np.exp(logits - np.repeat(np.maximum.reduceat(logits, begin), lengths))
            a /= np.repeat(np.add.reduceat(a, begin), lengths)
            z = np.add.reduceat(a[:, None] * h, begin, axis=0)
            miss = (_sigmoid(z @ p["c"] + p["b"][0]) - labels[mine]) * weight[mine] / len(mine)
            dz = np.repeat(miss[:, None] * p["c"], lengths, axis=0)
            da = (dz * h).sum(axis=1)
            dl = a * (da - np.repeat(np.add.reduceat(a * da, begin), lengths))
            dt, ds = dl[:, None] * p["w"] * s * (1 - t * t), dl[:, None] * p["w"] * t * s * (1 - s)
            dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
            slope = {"E": x.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ dl, "c": z.T @ miss, "b": np.array([miss.sum()])}
            turn += 1
            for k, g in slope.items():
                g = g + SHRINK * p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)
    return Model(mean, scale, p)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id", text: str = "text") -> Model | None:
    """Fits on labelled documents whose crc32(id) mod 5 is not 0; None if there is none.

    At most ``sample`` documents, half of each label, in the order of their ids' hash, each with all its passages: the
    driver holds some 0.75 bytes per byte of their texts. Of a document with several labels the
    lowest counts; null labels don't. Of rows with the same id the one with the smallest text counts.
    """
    own = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).where(learnt_rows("doc_id", 5, 0))
    marks = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ids = dict(sample_ids(own.select("doc_id").join(marks, "doc_id"), "doc_id", "quality", sample // 2))
    if not ids:
        return None

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()
        for batch in batches:
            for doc_id, value in zip(batch["doc_id"], batch["text"]):
                for number, block in enumerate(passages(value)):
                    yield pd.DataFrame({"doc_id": [doc_id], "block": [number], "n": [len(block)], "data": [block.astype(np.float16).tobytes()]})

    kind = dict(own.dtypes)["doc_id"]
    rows = rows_of_sample(own, list(ids.items())).mapInPandas(encode, f"doc_id {kind}, block int, n int, data binary").toPandas()
    rows = rows.sort_values(["doc_id", "block"])
    data = np.frombuffer(b"".join(rows["data"]), dtype=np.float16).reshape(-1, FEATURES)
    sizes = rows.groupby("doc_id", sort=True)["n"].sum()
    return fit(data, sizes.to_numpy(), sizes.index.map(ids).to_numpy().astype(int))


def rate(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """Per row the score (0 to 1, higher: label 1 likelier) and the decision at 0.3.

    A null text is an empty one, which is scored as a single passage of zeros; without a model every
    score is 0.5. Ids may be null or repeat; a null id counts as not held out. Whole texts are read,
    in blocks. With ``keep`` the row itself is passed on as the struct ``row``; else other columns
    are not read. No rows in, none out.
    """
    columns = [F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("_text")]
    if keep:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        give_back()
        for texts in batches:
            yield pd.Series([0.5 if model is None else model.score(t) for t in texts], dtype=float)

    rows = docs.select(*columns).withColumn("held_out", held_out).withColumn("score", F.pandas_udf(score, "double")("_text"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), *(["row"] if keep else []))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return rate(docs, learn(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op3_quality": op3_quality}
ORACLES: dict[str, str] = {}
