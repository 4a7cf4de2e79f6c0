"""Packing of tokenised documents into sequences by linear grouping and best fit."""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.llm.common import KEPT, Scratch, give_back, table, with_offsets

CAPACITY, END_ID = 4096, 1
#: Lengths over CAPACITY / LARGE_SHARE are large; they are rounded up in GROUPS groups of equal cardinality.
LARGE_SHARE, GROUPS = 8, 48
#: Words that a task keeps, of some 200 bytes each.
KEPT_LENGTH, KEPT_WORDS = 48, 600_000
#: Letters that have one form only and one lower case: those of Latin-1, composed.
LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
LETTERS = re.compile(f"[{LETTER}]+")
PLAIN = re.compile(rf"([{LETTER}]+)([!-&(-/:-@\[-`{{-~]+)")


class WordCoder:
    """Packed ids of whole texts, as the tokenizers library gives them.

    The vocabulary drops white space and never reaches across it, so texts are cut at ASCII blanks and
    the ids of words are kept; so are the two parts of letters followed by signs, which the
    vocabulary's own pattern always separates (an apostrophe, which it may join, is left alone).
    Words of plain letters are encoded many at a time: in lower case they need no normalising, and the last id of
    each is one that ends a word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.kept: dict[str, bytes] = {"": b""}
        self.letters, self.ends = self._for_letters(path)

    def _for_letters(self, path: str) -> tuple:
        """A tokenizer for lower-case letters between blanks and which of its ids end a word; nothing if the vocabulary is of another kind."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        kind = json.loads(self.tokenizer.to_str())
        steps = [[s["type"] for s in (kind[k] or {}).get(f"{k}s".replace("_", ""), [])] for k in ("normalizer", "pre_tokenizer")]
        mark = kind["model"].get("end_of_word_suffix")
        if steps != [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] or not mark or r"|[\p{L}]+|" not in kind["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex", ""):
            return None, None
        plain = Tokenizer.from_file(path)
        plain.normalizer = normalizers.Sequence([])
        plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ids = plain.get_vocab()
        ends = np.zeros(max(ids.values()) + 1, dtype=bool)
        ends[[i for token, i in ids.items() if token.endswith(mark)]] = True
        return plain, ends

    def _make_room(self, words: int) -> None:
        if len(self.kept) + words > KEPT_WORDS:
            self.kept = {"": b""}

    def _encode_letters(self, words: list[str]) -> None:
        if self.letters is not None and words:
            ids = np.array(self.letters.encode_batch_fast([" ".join(words).lower()], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) == len(words):
                packed = ids.tobytes()
                self.kept.update(zip(words, [packed[a:b] for a, b in zip([0, *ends], ends)]))
                return
        self._encode(words)

    def _encode(self, words: list[str]) -> None:
        for word, found in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
            self.kept[word] = struct.pack(f"<{len(found.ids)}I", *found.ids)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The packed ids of each text; words not met before are encoded text by text."""
        for text in texts:
            words = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            kept = self.kept
            new = set(words).difference(kept)
            if new:
                pairs = {w: m.groups() for w in new if "<|" not in w and (m := PLAIN.fullmatch(w))}
                single = (new - pairs.keys()).union(p for pair in pairs.values() for p in pair if p not in kept)
                self._make_room(len(single))
                letters = [w for w in single if LETTERS.fullmatch(w)]
                self._encode_letters(letters)
                self._encode(list(single.difference(letters)))
                kept = self.kept
                for word, (head, tail) in pairs.items():
                    if head not in kept or tail not in kept:
                        self._encode([head, tail])
                    kept[word] = kept[head] + kept[tail]
            try:
                packed = b"".join(map(kept.__getitem__, words))
            except KeyError:  # the kept words were cleared meanwhile
                packed = b"".join([struct.pack(f"<{len(f.ids)}I", *f.ids) for f in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)])
            for long in new:
                if len(long) > KEPT_LENGTH:
                    kept.pop(long, None)
            yield packed


@functools.lru_cache(2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


KEPT["packing"] = coder.cache_clear


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- the plan: everything here works on the number of pieces per length, so its size is bounded by the capacity


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of ``sizes`` within ``capacity`` of the largest total value."""
    best = np.zeros(capacity + 1)
    choices = []
    for _ in range(int(capacity // sizes.min())):
        more, pick = best.copy(), np.full(capacity + 1, -1)
        for i, size in enumerate(sizes):
            gain = best[: capacity + 1 - size] + values[i]
            better = gain > more[size:] + 1e-12
            more[size:][better], pick[size:][better] = gain[better], i
        choices.append(pick)
        if (pick < 0).all():
            break
        best = more
    counts, room = np.zeros(len(sizes), dtype=np.int64), capacity
    for pick in reversed(choices):
        if pick[room] >= 0:
            counts[pick[room]] += 1
            room -= sizes[pick[room]]
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns of few sizes and how often each is used, by column generation; what rounding down leaves is
    filled pattern by pattern. Together they hold ``demand`` pieces of each size at least."""
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)  # one column per pattern
    for _ in range(40 * k):
        amounts = np.linalg.solve(basis, demand.astype(float))
        prices = np.linalg.solve(basis.T, np.ones(k))
        value, pattern = best_pattern(sizes, prices, capacity)
        if value <= 1 + 1e-7:
            break
        direction = np.linalg.solve(basis, pattern.astype(float))
        ratios = np.where(direction > 1e-9, amounts / np.where(direction > 1e-9, direction, 1), np.inf)
        basis[:, int(ratios.argmin())] = pattern
    amounts = np.floor(np.linalg.solve(basis, demand.astype(float)) + 1e-7).clip(0).astype(np.int64)
    out = [(basis[:, j].astype(np.int64), int(amounts[j])) for j in range(k) if amounts[j] > 0]
    left = demand - sum((p * n for p, n in out), np.zeros(k, dtype=np.int64))
    while (left > 0).any():
        room, pattern = capacity, np.zeros(k, dtype=np.int64)
        for i in np.argsort(-sizes, kind="stable"):
            take = min(int(max(left[i], 0)), room // int(sizes[i]))
            pattern[i] += take
            room -= take * int(sizes[i])
        times = max(1, int(min((left[i] // pattern[i] for i in range(k) if pattern[i]), default=1)))
        out.append((pattern, times))
        left = left - pattern * times
    return out


def pack_large(counts: dict[int, int], capacity: int, groups: int) -> list[tuple[tuple[int, ...], int]]:
    """Classes (lengths in order, number of sequences) that hold all large pieces.

    Linear grouping: the pieces, longest first, are cut into groups of equal cardinality and rounded up
    to the longest of their group. Configurations of these few sizes are optimised, then the actual
    lengths take the places of their group, longest first.
    """
    total = sum(counts.values())
    if not total:
        return []
    lengths = np.array(sorted(counts, reverse=True))
    ends = np.cumsum([counts[l] for l in lengths])  # the piece of rank r has length lengths[bisect(ends, r + 1)]

    def length_at(rank: int) -> int:
        return int(lengths[bisect_left(ends, rank + 1)])

    share = -(-total // groups)
    cuts = list(range(0, total, share)) + [total]
    sizes, demand, starts = [], [], []
    for a, b in zip(cuts, cuts[1:]):
        size = length_at(a)
        if sizes and sizes[-1] == size:
            demand[-1] += b - a
        else:
            sizes.append(size)
            demand.append(b - a)
            starts.append(a)
    sizes, demand = np.array(sizes), np.array(demand)
    after = [s + d for s, d in zip(starts, demand)]
    place = list(starts)
    classes: dict[tuple[int, ...], int] = defaultdict(int)
    for pattern, times in configurations(sizes, demand, capacity):
        # Each place of the pattern takes the next ``times`` pieces of its group, fewer at the end of the group.
        slots = []
        for group in np.nonzero(pattern)[0]:
            for _ in range(int(pattern[group])):
                a, b = place[group], min(place[group] + times, after[group])
                place[group] = b
                slots.append((a, b))
        borders = {0, times}
        for a, b in slots:
            borders.add(b - a)
            first = bisect_left(ends, a + 1)
            while first < len(ends) and ends[first] < b:
                borders.add(int(ends[first]) - a)
                first += 1
        marks = sorted(x for x in borders if 0 <= x <= times)
        for low, high in zip(marks, marks[1:]):
            content = tuple(length_at(a + low) for a, b in slots if a + low < b)
            if content:
                classes[content] += high - low
    return list(classes.items())


def plan(histogram: dict[int, int], capacity: int = CAPACITY, large_share: int = LARGE_SHARE, groups: int = GROUPS) -> list[tuple[tuple[int, ...], int]]:
    """Classes of equal sequences for all pieces of ``histogram`` (length to number of pieces).

    Full pieces stand alone, large ones are packed by linear grouping, and the small ones go, longest
    first, each into the fullest sequence that has room (best fit), all equal ones in one step.
    """
    bound = capacity // large_share
    done = [((capacity,), histogram[capacity])] if histogram.get(capacity) else []
    large = {l: n for l, n in histogram.items() if bound < l < capacity and n}
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for content, n in pack_large(large, capacity, groups):
        rooms[capacity - sum(content)].append((content, n))
    open_rooms = sorted(rooms)
    for length in sorted((l for l, n in histogram.items() if l <= bound and n), reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(open_rooms, length)
            if at == len(open_rooms):
                # A new sequence is the fullest one with room until it is full itself.
                each = min(capacity // length, left)
                new = [((length,) * each, left // each)] + ([((length,) * (left % each), 1)] if left % each else [])
                left = 0
            else:
                room = open_rooms[at]
                content, n = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], open_rooms[at]
                # Equal pieces fill one sequence before the next.
                each = min(room // length, left)
                used = min(n, left // each)
                new = [(content + (length,) * each, used)] + ([(content, n - used)] if n > used else [])
                left -= each * used
            for content, n in new:
                room = capacity - sum(content)
                if room not in rooms:
                    open_rooms.insert(bisect_left(open_rooms, room), room)
                rooms[room].append((content, n))
    return done + [item for room in sorted(rooms) for item in rooms[room]]


def placements(classes: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length the runs (first rank, first sequence, offset) in order of rank."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    first = 0
    for content, n in classes:
        offset = 0
        for length in content:
            runs[length].append((ranks[length], first, offset))
            ranks[length] += n
            offset += length
        first += n
    return {length: np.array(found, dtype=np.int64) for length, found in runs.items()}


# --- the rows


def pieces_of(docs: DataFrame, path: str, capacity: int, end_id: int | None, id_column: str, text: str) -> DataFrame:
    """One row per piece, numbered within its task and length."""
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back("packing")
        task, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            out = []
            for doc, packed in zip(batch["doc_id"].tolist(), coder(path).encode(batch["text"])):
                whole = packed + end
                for number, start in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[start : start + 4 * capacity]
                    length = len(part) // 4
                    out.append((doc, number, start // 4, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "_task", "_local"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInPandas(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, _task int, _local long")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int | None = END_ID, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece with its sequence and place.

    Only documents longer than ``capacity`` are cut. The driver sees the number of pieces per length
    (``capacity`` numbers at most) and plans classes of equal sequences; every piece then finds its
    place from its rank among the pieces of its length. A null text is an empty one, which is its end
    id only (without ``end_id`` it has no piece); ids may be null or repeat, each row is packed on its
    own; other columns are not read; no rows in, none out.
    """
    scratch = Scratch(docs.sparkSession)
    cut = scratch.stage(pieces_of(docs, path or vocabulary_path(), capacity, end_id, id_column, text), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = placements(plan(histogram, capacity))
    ranked = with_offsets(cut, "_task", ["length"], "_local", "_rank")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch.pop("_rank").to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for length in np.unique(lengths):
                mine = np.nonzero(lengths == length)[0]
                found = runs[int(length)]
                at = np.searchsorted(found[:, 0], ranks[mine], side="right") - 1
                sequence[mine] = found[at, 1] + ranks[mine] - found[at, 0]
                offset[mine] = found[at, 2]
            yield batch.assign(sequence_id=sequence, offset=offset)

    kind = dict(cut.dtypes)["doc_id"]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select(*columns, "_rank").mapInPandas(place, schema)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op9_packing": op9_packing}
ORACLES: dict[str, str] = {}
