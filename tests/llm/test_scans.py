"""License scans, packing, sharding against plain counterparts."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tokenizers

from transit_spark.llm import licenses, packing, sharding
from transit_spark.llm.common import give_back

MIT, APACHE = licenses.TEMPLATES["MIT"][0], licenses.TEMPLATES["Apache-2.0"][0]


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)


def test_alignment_is_ascending_and_finds_all_of_equal_texts():
    draw = random.Random(1)
    for _ in range(300):
        a, b = (draw.choices("abcdefghijklmnop", k=draw.randint(0, 25)) for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
        assert licenses.align(a, a) == [(i, i) for i in range(len(a))]


def test_longest_ascending_equals_quadratic_search():
    draw = random.Random(2)
    for _ in range(200):
        places = draw.sample(range(40), draw.randint(0, 14))
        best = []
        for place in places:
            best.append(1 + max((b for b, p in zip(best, places) if p < place), default=0))
        assert len(licenses._longest_ascending(list(enumerate(places)))) == max(best, default=0)


@pytest.mark.parametrize(("text", "names"), [
    (MIT, ["MIT"]), (f"before {MIT.upper()} after", ["MIT"]), (MIT.replace("Software", "Thing"), ["MIT"]), (MIT[: len(MIT) // 2], []),
    (f"{MIT}\n{MIT} {APACHE}", ["MIT", "MIT", "Apache-2.0"]), ("a license to kill", []), ("x. Licensed under CC BY-NC 4.0. y", ["CC-BY-NC-4.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]), ("", []), (None, []), ("?!", []),
    (APACHE.replace(" the ", " // the "), ["Apache-2.0"]), (" ".join(reversed(APACHE.split())), []),
])
def test_license_cases(scanner, text, names):
    assert [m[0] for m in scanner.scan(text)] == names


def test_license_lines_of_documents(documents):
    found = {r["doc_id"]: r["matches"] for r in licenses.scan_licenses(documents).collect()}
    for row in documents.collect():
        named = row["text"] is not None and "licen" in row["text"].lower()
        assert bool(found[row["doc_id"]]) == named
        assert all(m["coverage"] >= licenses.COVERAGE and "licen" in row["text"][m["first"] : m["end"]].lower() for m in found[row["doc_id"]])


def test_license_odd_rows(odd_documents, no_documents):
    assert sorted(len(r["matches"]) for r in licenses.scan_licenses(odd_documents).collect()) == [0] * odd_documents.count()
    assert licenses.scan_licenses(no_documents).count() == 0


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(packing.vocabulary_path())


def test_word_ids_equal_the_library(library):
    draw = random.Random(3)
    signs = ["a", "B", "é", "é", "́", " ", "\n", "\t", "\x85", "\xa0", "'s", "'", "'LL", "1", "²", "<|endoftext|>", "<|startoftext|>", "<|", ".", ",", "!!", "日本", "\x1c", "\x0b", "Σ", "ΑΣ", "İ", "_", "word", "THE", "[", "ß", "😀"]
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 30))) for _ in range(3000)] + [None, ""]
    own = packing.WordCoder(packing.vocabulary_path()).encode(texts)
    for text, packed, want in zip(texts, own, library.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert np.frombuffer(packed, dtype="<u4").tolist() == want.ids, repr(text)


def test_word_cache_is_bounded(monkeypatch, library):
    monkeypatch.setattr(packing, "KEPT_WORDS", 20)
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}." for i in range(n, n + 60)) for n in range(0, 400, 7)]
    for packed, want in zip(packing.WordCoder(packing.vocabulary_path()).encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(packed, dtype="<u4").tolist() == want.ids


def test_plain_words_are_encoded_together(library, monkeypatch):
    """A call for each word took most of the time; what is no plain letter still goes its own way."""
    coder, alone = packing.WordCoder(packing.vocabulary_path()), []
    monkeypatch.setattr(coder, "_encode", lambda words, encode=coder._encode: (alone.extend(words), encode(words)))
    texts = ["Écoute ÀÇÑß ÿother. other! l'été ŸES Σας", "plain words only", "é</w> a</w> ª µ ×÷ \u0065\u0301tude"]
    for text, packed in zip(texts, coder.encode(texts)):
        assert np.frombuffer(packed, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert not {"Écoute", "ÀÇÑß", "ÿother", "other", "plain", "words", "only", "é"} & set(alone) and {"l'été", "Σας", "ª"} <= set(alone)


def test_workers_let_go_of_what_others_kept():
    """Kept words stayed in a worker while other operators used it."""
    path = packing.vocabulary_path()
    held = packing.coder(path)
    give_back("packing")
    assert packing.coder(path) is held
    give_back()
    assert packing.coder(path) is not held


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_and_is_tight(seed):
    draw = random.Random(seed)
    capacity = draw.choice([64, 300, 4096])
    lengths = [min(capacity, max(1, int(draw.lognormvariate(draw.choice([2, 4, 6]), 1)))) for _ in range(draw.choice([0, 1, 30, 4000]))]
    histogram = dict(Counter(lengths))
    classes = packing.plan(histogram, capacity)
    held = Counter()
    for content, n in classes:
        assert sum(content) <= capacity and n > 0
        for length in content:
            held[length] += n
    assert held == Counter(lengths)
    used, bound = sum(n for _, n in classes), -(-sum(lengths) // capacity)
    rooms = []
    for length in sorted(lengths, reverse=True):  # best fit decreasing, piece by piece
        fit = min((r for r in rooms if r >= length), default=None)
        if fit is None:
            fit = capacity
        else:
            rooms.remove(fit)
        rooms.append(fit - length)
    assert bound <= used <= max(len(rooms) + 1, int(len(rooms) * 1.03))


def test_configurations_are_optimal_for_few_sizes():
    sizes, demand = np.array([7, 5, 3]), np.array([100, 100, 100])
    used = sum(n for _, n in packing.configurations(sizes, demand, 15))
    assert used == 100  # 7 + 5 + 3 fills a sequence exactly
    for pattern, _ in packing.configurations(sizes, demand, 15):
        assert pattern @ sizes <= 15


def check_packed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packed_documents(documents, library):
    rows = packing.pack(documents).collect()
    used = check_packed(rows, 4096)
    assert used <= -(-sum(r["length"] for r in rows) // 4096) * 1.03 + 2
    pieces = {(r["doc_id"], r["piece"]): r for r in rows}
    count = 0
    for row in documents.collect():
        ids = np.array([*library.encode(row["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for number, start in enumerate(range(0, len(ids), 4096)):
            part, piece = ids[start : start + 4096], pieces[row["doc_id"], number]
            assert (piece["start"], piece["length"], piece["ids_crc32"]) == (start, len(part), zlib.crc32(part.tobytes()))
            count += 1
    assert count == len(rows)


def test_packing_odd_rows(odd_documents, no_documents):
    rows = packing.pack(odd_documents, capacity=100).collect()
    check_packed(rows, 100)
    assert sum(r["doc_id"] == 1 for r in rows) == 2 and sum(r["length"] == 1 and r["start"] == 0 for r in rows) >= 3
    assert packing.pack(no_documents).count() == 0
    assert packing.pack(odd_documents.where("text IS NULL"), end_id=None).count() == 0


def slow_jump(key, shards):
    place, step = -1, 0
    while step < shards:
        place = step
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        step = int((place + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return place


def test_jump_equals_the_published_loop():
    draw = random.Random(4)
    keys = [draw.getrandbits(64) for _ in range(3000)] + [0, 1, (1 << 64) - 1]
    for shards in (1, 2, 8, 9, 1000):
        assert sharding.jump(np.array(keys, dtype=np.uint64), shards).tolist() == [slow_jump(k, shards) for k in keys]


def test_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.shards_of(docs).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], 8)
    assert len(rows) == len(texts) and set(by) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert all(80 < len(s) < 180 for s in by.values()) and 60 < sum(r["grown_shard"] == 8 for r in rows) < 170
    again = {r["doc_id"]: r["shard"] for r in sharding.shards_of(docs.repartition(5).where("doc_id % 3 = 0")).collect()}
    assert all(again[r["doc_id"]] == r["shard"] for r in rows if r["doc_id"] % 3 == 0)


def test_shards_odd_rows(odd_documents, no_documents):
    rows = sharding.shards_of(odd_documents, shards=3).collect()
    assert len(rows) == odd_documents.count()
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert {(r["size"], r["text_crc32"]) for r in rows if r["size"] == 1} == {(1, 0)}
    assert sharding.shards_of(no_documents).count() == 0
    with pytest.raises(ValueError):
        sharding.jump(np.array([1], dtype=np.uint64), 0)
