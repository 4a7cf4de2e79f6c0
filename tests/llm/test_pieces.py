"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from transit_spark.llm import pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


@pytest.fixture(scope="module")
def own():
    return pieces.coder(pieces.model_path())


SIGNS = ["a", "b", "e", "t", "h", " ", "  ", "▁", "é", "\n", "\t", "日", "本", "😀", "́", "\x00", "ß", "<s>", "</s>", "<0x41>", "<unk>", "...", "1", "the", "ing", "​", "﻿", "\xa0", "-", "=="]


def test_random_texts(own, library):
    draw = random.Random(1)
    for i in range(4000):
        text = "".join(draw.choices(SIGNS, k=draw.randint(0, 40)))
        if i % 5 == 0:
            text = draw.choice(["a", "▁", " ", "=", "ab", "\n", "0", "e", "th"]) * draw.randint(0, 90) + draw.choice(["", "x", " "])
        assert own.encode(text) == library.encode(text, add_bos=True, add_eos=True), repr(text)


def test_joined_pieces_force_backtracking(own, library):
    draw = random.Random(2)
    for _ in range(3000):
        text = "".join(own.texts[draw.randint(259, 31999)] for _ in range(draw.randint(1, 5))).replace("▁", " ")
        assert own.encode(text) == library.encode(text, add_bos=True, add_eos=True), repr(text)


def test_random_ids_decode(own, library):
    draw = random.Random(3)
    for _ in range(4000):
        ids = [draw.choice([0, 1, 2, draw.randint(3, 258), draw.randint(3, 258), draw.randint(0, 31999)]) for _ in range(draw.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_documents(documents, library):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for row in pieces.encode_documents(documents, keep_ids=True).collect():
        ids = library.encode(texts[row["doc_id"]], add_bos=True, add_eos=True)
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row["decoded"] == library.decode(ids)
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(odd_documents, no_documents, library):
    rows = pieces.encode_documents(odd_documents, keep_ids=True).collect()
    assert len(rows) == odd_documents.count()
    assert all(r["ids"] == [1, 2] for r in rows if r["decoded"] == "")
    texts = sorted(t or "" for t in odd_documents.toPandas()["text"])
    assert sorted(r["decoded"] for r in rows) == sorted(library.decode(library.encode(t)) for t in texts)
    assert pieces.encode_documents(no_documents).count() == 0


def test_caches_are_bounded(own, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_RUNS", 50)
    fresh = pieces.PieceCoder(pieces.model_path())
    text = " ".join(f"word{i}" for i in range(500))
    assert fresh.encode(text) == own.encode(text)
    assert len(fresh.kept) <= 50
