"""SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding."""

from __future__ import annotations

import functools
import hashlib
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.llm.common import in_batches, table

SPACE = "▁"
#: Runs between places where no piece can cross are kept up to this length and this number.
KEPT_LENGTH, KEPT_RUNS = 48, 1_000_000
NEVER = 1 << 60
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def pack(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class PieceCoder:
    """Encodes and decodes as the sentencepiece library does, for BPE models with byte fallback.

    A text is cut where no piece of the vocabulary can reach across (before a space mark that follows
    another character). Within such a run, the encoder walks through longest matches of an
    Aho-Corasick automaton. A piece may follow another only if merging the joint characters of both
    anew gives exactly these two; then the whole sequence is what the merges would give. Where no
    match fits, the position is marked in a bit field of failed positions and the walk goes back one
    piece. Characters outside the vocabulary are bytes.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal = model.normalizer_spec
        supported = (
            model.trainer_spec.model_type == 2 and model.trainer_spec.byte_fallback and not normal.precompiled_charsmap
            and not normal.remove_extra_whitespaces and normal.escape_whitespaces and not model.trainer_spec.treat_whitespace_as_suffix
        )
        if not supported or any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in model.pieces):
            raise ValueError("only BPE models with byte fallback, identity normalisation and plain pieces are supported")
        self.prefix = normal.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.texts = [p.piece for p in model.pieces]
        self.scores = [p.score for p in model.pieces]
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.begin, self.end = (next(i for i, p in enumerate(model.pieces) if p.piece == name) for name in ("<s>", "</s>"))
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.unknown_text = model.trainer_spec.unk_surface
        place = {score: i for i, score in enumerate(sorted({self.scores[i] for i in self.ids.values()}, reverse=True))}
        self.ranks = {p: place[self.scores[i]] for p, i in self.ids.items()}
        self.joints = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.letters = set("".join(self.ids))
        if not self.letters <= self.ids.keys():
            raise ValueError("a piece holds a character that is no piece")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece reaches across a space")
        self.lengths = [len(t) for t in self.texts]
        self.reach = max(self.lengths[i] for i in self.ids.values())
        self.automaton = ahocorasick.Automaton()
        for piece, number in self.ids.items():
            self.automaton.add_word(piece, number)
        self.automaton.make_automaton()
        signs = re.escape("".join(sorted(self._openers())))
        self.runs = re.compile(f" *[{signs}]*[^ {signs}]+| *[{signs}]+| +")
        self.fits = functools.lru_cache(1 << 19)(self._fits)
        self.shorter = functools.lru_cache(None)(self._next_shorter)
        self.alone = functools.lru_cache(None)(self._stands_alone)
        self.kept: dict[str, bytes] = {}
        self.surfaces = [self._surface(p) for p in model.pieces]
        self.controls = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.is_byte = [p.type == BYTE for p in model.pieces]

    def _surface(self, piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        if piece.type == CONTROL:
            return b""
        return (self.unknown_text if piece.type == UNKNOWN else piece.piece.replace(SPACE, " ")).encode()

    def merge(self, text: str) -> list[int]:
        """The pieces of ``text`` by merging the best-scored, leftmost pair again and again.

        Only for the joint characters of two pieces: each step looks at all pairs that are left.
        """
        parts = list(text)
        rank = self.ranks.get
        ranks = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < NEVER:
            i = ranks.index(least)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], NEVER)
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
        return [self.ids[p] for p in parts]

    def _openers(self) -> set[str]:
        """ASCII signs that follow nothing but a space mark or each other in any piece: a run ends before them."""
        signs = {c for c in self.letters if c.isascii() and not c.isalpha()}
        while bad := {j[1] for j in self.joints if j[1] in signs and j[0] != SPACE and j[0] not in signs}:
            signs -= bad
        return signs or {"\0"}

    def _fits(self, left: int, right: int) -> bool:
        return self.merge(self.texts[left] + self.texts[right]) == [left, right]

    def walk(self, text: str) -> list[int]:
        """The pieces of a run of vocabulary characters, by backtracking over longest matches."""
        lengths, fits, goal = self.lengths, self.fits, len(text)
        # Every character is a piece, so longest matches join without gaps. Most texts need only those
        # that follow each other from the start; what backtracking asks for besides is looked up at its place.
        longest, start = {}, 0
        for end, piece in self.automaton.iter_long(text):
            longest[start] = piece
            start = end + 1
        failed = bytearray(goal // 8 + 1)
        found: list[int] = []
        place, piece, last = 0, longest[0], None
        while True:
            end = place + lengths[piece]
            if not failed[end >> 3] >> (end & 7) & 1 and (self.alone(piece) if last is None else fits(last, piece)):
                found.append(piece)
                if end == goal:
                    return found
                place, last = end, piece
                piece = longest.get(end)
                if piece is None:
                    piece = longest[end] = next(self.automaton.iter_long(text[end : end + self.reach]))[1]
                continue
            other = self.shorter(piece)
            while other is None:
                failed[place >> 3] |= 1 << (place & 7)
                if not found:
                    raise ValueError("the vocabulary cannot encode the text")
                piece = found.pop()
                last = found[-1] if found else None
                place -= lengths[piece]
                other = self.shorter(piece)
            piece = other

    def _next_shorter(self, piece: int) -> int | None:
        """The longest other piece that ``piece`` starts with."""
        text = self.texts[piece]
        return next((self.ids[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.ids), None)

    def _stands_alone(self, piece: int) -> bool:
        """Whether merging the characters of a piece gives the piece itself."""
        return self.merge(self.texts[piece]) == [piece]

    def _run(self, run: str) -> bytes:
        """The packed ids of a run; a long or foreign one is first cut where no piece reaches across."""
        marked = run.replace(" ", SPACE)
        if len(run) <= KEPT_LENGTH and self.letters.issuperset(marked):
            return self._keep(run, pack(self.walk(marked)))
        start, numbers = 0, []
        for i in range(1, len(marked) + 1):
            if i == len(marked) or marked[i - 1 : i + 1] not in self.joints:
                # A character outside the vocabulary is in no joint, so it stands alone here.
                part = marked[start:i]
                numbers += self.walk(part) if part[0] in self.letters else [self.byte_ids[b] for b in part.encode()]
                start = i
        return self._keep(run, pack(numbers))

    def _keep(self, run: str, packed: bytes) -> bytes:
        if len(run) <= KEPT_LENGTH:
            if len(self.kept) >= KEPT_RUNS:
                self.kept.clear()
            self.kept[run] = packed
        return packed

    def encode_packed(self, text: str | None) -> bytes:
        """The ids with begin and end, as little-endian unsigned 32-bit integers."""
        text = (text or "").replace(SPACE, " ")  # both become the space mark
        if text and self.prefix:
            text = " " + text
        kept, run = self.kept, self._run
        return pack([self.begin]) + b"".join([kept.get(r) or run(r) for r in self.runs.findall(text)]) + pack([self.end])

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: control pieces vanish, one leading space of the first piece goes, bytes
        that are no UTF-8 become replacement characters one by one."""
        surfaces = self.surfaces
        first, last = 0, len(ids)
        while first < last and ids[first] in self.controls:
            first += 1
        while last > first and ids[last - 1] in self.controls:
            last -= 1
        ids = ids[first:last]
        if not self.controls.isdisjoint(ids):
            return self._mend(ids)
        whole = b"".join([surfaces[i] for i in ids])
        if self.prefix and ids and self.texts[ids[0]].startswith(SPACE):
            whole = whole[1:]
        try:
            return whole.decode()
        except UnicodeDecodeError:
            return self._mend(ids)

    def _mend(self, ids: list[int]) -> str:
        out: list[str] = []
        pending = bytearray()

        def flush() -> None:
            while pending:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(pending[:n]).decode())
                        del pending[:n]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    del pending[:1]

        for i, number in enumerate(ids):
            if self.is_byte[number]:
                pending += self.surfaces[number]
                continue
            flush()
            text = self.surfaces[number].decode()
            out.append(text[1:] if not i and self.prefix and self.texts[number].startswith(SPACE) else text)
        flush()
        return "".join(out)


@functools.lru_cache(2)
def coder(path: str) -> PieceCoder:
    return PieceCoder(path)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per row the number of ids, their checksum and that of the text they decode to.

    ``path`` names a model file that every executor has. With ``keep_ids`` also the ids and the
    decoded text. Rows stay where they are: nothing is shuffled and a batch is all that a task
    holds. A null text counts as empty (begin and end only); ids may be null or repeat; other
    columns are not read; no rows in, none out.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    path = path or model_path()
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def encode(batch: pd.DataFrame) -> pd.DataFrame:
        pieces = coder(path)
        counts, ids_sums, text_sums, ids, texts = [], [], [], [], []
        for value in batch["text"]:
            packed = pieces.encode_packed(value)
            numbers = np.frombuffer(packed, dtype="<u4").tolist()
            decoded = pieces.decode(numbers)
            counts.append(len(numbers))
            ids_sums.append(hashlib.sha256(packed).hexdigest())
            text_sums.append(hashlib.sha256(decoded.encode()).hexdigest())
            if keep_ids:
                ids.append(numbers)
                texts.append(decoded)
        out = pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": counts, "ids_sha256": ids_sums, "decoded_sha256": text_sums})
        return out.assign(ids=ids, decoded=texts) if keep_ids else out

    return rows.mapInPandas(in_batches(encode), schema + (", ids array<int>, decoded string" if keep_ids else ""))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded with begin and end ids, and decoded again."""
    return encode_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op1_sentencepiece": op1_sentencepiece}
ORACLES: dict[str, str] = {}
