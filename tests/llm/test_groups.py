"""SimHash groups, near vectors and neighbours against comparisons of all pairs; components against a plain search."""

import random

import numpy as np
import pandas as pd
import pytest
import xxhash

from transit_spark.llm import near_vectors, neighbours, simhash
from transit_spark.llm.common import Scratch
from transit_spark.llm.components import components


def parts(nodes, edges):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


def test_components(spark):
    draw = random.Random(4)
    chain = [(i, i + 1) for i in range(1000, 1300)]
    star = [(5000, i) for i in range(5001, 5400)]
    other = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)]
    edges = chain + star + other + [(7, 7), (1000, 1001)]
    draw.shuffle(edges)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert found == parts({n for e in real for n in e}, real)
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    words = [w for w in words.translate(bytes(32 if i in (9, 10, 11, 12, 13) else i for i in range(256))).split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint(documents):
    for row in documents.limit(80).collect():
        assert simhash.fingerprint(row["text"]) == slow_fingerprint(row["text"])
    for text in (None, "", " \t\n", "ONE two", "A b C d", "a b c d e", "É é \x1c x \x85 y\xa0z", "w " * 40000):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_every_difference(radius):
    draw = random.Random(radius)
    family = [int(m) for m in simhash.masks(radius)]
    assert len(family) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        differing = sum(1 << b for b in draw.sample(range(64), radius))
        assert any(not m & differing for m in family)


def test_groups_equal_all_pairs(spark, monkeypatch):
    draw = random.Random(6)
    marks = [draw.getrandbits(64) for _ in range(30)]
    for _ in range(500):
        mark = draw.choice(marks)
        for bit in draw.sample(range(64), draw.randint(1, 6)):
            mark ^= 1 << bit
        marks.append(mark)
    marks = sorted(set(marks))
    pairs = [(a, b) for i, a in enumerate(marks) for b in marks[i + 1 :] if (a ^ b).bit_count() <= 4]
    want = parts(marks, pairs)
    for large in (simhash.LARGE_BUCKET, 3):  # the second family of masks must give the same
        monkeypatch.setattr(simhash, "LARGE_BUCKET", large)
        frame = spark.createDataFrame([(m - (1 << 64) if m >> 63 else m,) for m in marks], "mark long")
        found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(frame, Scratch(spark)).collect()]
        got = parts(marks, found)
        assert len(set(got.values())) == len(set(want.values()))
        assert all(got[a] == got[b] for a, b in pairs) and all((want[a] == want[b]) for a, b in found)


def test_near_groups_of_documents(spark, documents):
    rows = {r["doc_id"]: slow_fingerprint(r["text"]) for r in documents.collect()}
    ids = sorted(rows)
    want = parts(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (rows[a] ^ rows[b]).bit_count() <= 4])
    for row in simhash.near_groups(documents).collect():
        assert row["fingerprint"] == f"{rows[row['doc_id']]:016x}"
        assert row["component_id"] == want[row["doc_id"]]


def test_odd_documents(odd_documents, no_documents):
    found = simhash.near_groups(odd_documents).collect()
    assert len(found) == odd_documents.count()
    zero = [r for r in found if r["fingerprint"] == "0" * 16]
    assert len(zero) == 3 and {r["component_id"] for r in zero} == {2}
    assert simhash.near_groups(no_documents).count() == 0


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def near_truth(rows, similarity=0.98):
    good = [(i, np.array(v, dtype=float), l) for i, v, l in rows if i is not None and v and l is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    edges = []
    for n, (i, v, l) in enumerate(good):
        for j, w, m in good[n + 1 :]:
            if l == m and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= similarity:
                edges.append((i, j))
    ids = [i for i, _, _ in rows]
    links = {i: 0 for i in ids}
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    return links, parts(ids, edges)


def test_near_vectors_equal_all_pairs(spark, monkeypatch):
    draw = np.random.default_rng(7)
    heads = draw.standard_normal((12, 16))
    rows = []
    for i in range(700):
        v = heads[draw.integers(12)] + draw.standard_normal(16) * draw.choice([0.0, 0.05, 0.14, 0.3])
        rows.append((i * 3 % 701, [float(np.float32(x)) for x in v * draw.choice([1.0, 7.5])], int(draw.integers(2))))
    rows += [(9001, None, 1), (9002, [0.0] * 16, 1), (9003, [float("nan")] + [1.0] * 15, 1), (9004, [None] + [1.0] * 15, 1), (9005, rows[0][1], None), (9006, [float("inf")] * 16, 1), (9007, [], 1), (9008, rows[0][1][:8], rows[0][2])]
    links, want = near_truth(rows)
    for block, cell in ((near_vectors.BLOCK, near_vectors.CELL), (40, 60)):
        monkeypatch.setattr(near_vectors, "BLOCK", block)
        monkeypatch.setattr(near_vectors, "CELL", cell)
        found = {r["vec_id"]: r for r in near_vectors.near_vectors(vectors_frame(spark, rows)).collect()}
        assert len(found) == len(rows)
        for i in found:
            assert found[i]["n_links"] == links[i] and found[i]["component_id"] == want[i]
            assert found[i]["kept"] == (want[i] == i)


def test_centres_are_bounded_whatever_the_labels(spark, monkeypatch):
    draw = np.random.default_rng(3)
    rows = []
    for i in range(900):
        label = int(draw.integers(300)) if i % 3 else 1000  # one hot label, many small ones
        rows.append((i, [float(np.float32(x)) for x in np.eye(6)[draw.integers(6)] + draw.standard_normal(6) * 0.1], label))
    links, want = near_truth(rows)
    monkeypatch.setattr(near_vectors, "CENTRES", 8)
    monkeypatch.setattr(near_vectors, "CELL", 20)
    monkeypatch.setattr(near_vectors, "BLOCK", 50)
    taken = []
    inner = near_vectors._centres
    monkeypatch.setattr(near_vectors, "_centres", lambda points: taken.append(inner(points)) or taken[-1])
    found = {r["vec_id"]: r for r in near_vectors.near_vectors(vectors_frame(spark, rows)).collect()}
    assert 2 <= sum(map(len, taken[0].values())) <= 8
    assert all(found[i]["n_links"] == links[i] and found[i]["component_id"] == want[i] for i in links) and sum(links.values()) > 100


def test_near_vectors_odd(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [1.0, 0.0], 2)]
    found = near_vectors.near_vectors(vectors_frame(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in found) == [(0, 0, 0), (1, 1, 1), (1, 1, 1), (2, 0, 2)]
    assert near_vectors.near_vectors(vectors_frame(spark, [])).count() == 0


def test_cover_tree_invariants():
    points = np.random.default_rng(8).standard_normal((300, 5))
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = near_vectors.CoverTree(points).freeze()
    for node, children in enumerate(tree.children):
        away = np.sqrt(np.maximum(2 - 2 * points[tree.members[node]] @ points[tree.centre[node]], 0))
        assert away.max() <= tree.radius[node] + 1e-7
        if children is not None:
            assert sorted(np.concatenate([tree.members[c] for c in children])) == sorted(tree.members[node])
            assert tree.centre[children[0]] == tree.centre[node]
            assert all(tree.radius[c] <= tree.radius[node] / 2 + 1e-7 for c in children)
    pairs = set()
    for i, j, whole in near_vectors.linked_pairs(tree, tree, 0.9):
        pairs |= {(a, b) for a in i for b in j} if whole else set(zip(i, j))
    assert pairs == set(zip(*np.nonzero(points @ points.T >= 0.9)))


def test_neighbours_recall_and_scores(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    rows = pd.concat([rows, rows.head(60).assign(vec_id=lambda r: r["vec_id"] + 100001)])
    found = neighbours.nearest_neighbours(spark.createDataFrame([(int(i), [float(x) for x in v], int(l)) for i, v, l in rows[["vec_id", "embedding", "label"]].itertuples(index=False)], "vec_id long, embedding array<float>, label int")).toPandas()
    ids, data = rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_numpy()).astype(float)
    asked, hits = ids[ids % 20 == 0], 0
    for i in asked:
        scores = data @ data[ids == i][0]
        best = [v for v in ids[np.lexsort((ids, -scores.round(12)))] if v != i][:20]
        mine = found[found["query_id"] == i].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        assert i not in set(mine["vec_id"])
        np.testing.assert_allclose(mine["score"], [scores[ids == v][0] for v in mine["vec_id"]], atol=1e-12)
        assert all(a > b or (a == b and v < w) for (a, v), (b, w) in zip(zip(mine["score"], mine["vec_id"]), list(zip(mine["score"], mine["vec_id"]))[1:]))
        hits += len(set(best) & set(mine["vec_id"]))
    assert set(found["query_id"]) == set(asked)
    assert hits / 20 / len(asked) >= 0.9


def test_probe_sequence_is_ordered():
    place = np.array([3.2, -1.7, 0.05])
    home = np.floor(place)
    sequence = neighbours.probe_sequence(place, 60)
    assert sequence[0].tolist() == home.tolist() and len({tuple(b) for b in sequence.tolist()}) == 60
    cost = np.where(sequence < home, (place - sequence - 1) ** 2, np.where(sequence > home, (sequence - place) ** 2, 0)).sum(axis=1)
    assert (np.diff(cost) >= -1e-12).all()


def test_neighbours_odd(spark):
    rows = [(0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (3, [0.5, 0.5], None), (40, None, 1), (60, [0.0, 0.0], 1), (5, [float("nan"), 1.0], 1), (None, [1.0, 1.0], 1), (7, [1.0, None], 1)]
    found = neighbours.nearest_neighbours(vectors_frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in found) == [(0, 1, 20, 1.0), (0, 2, 3, 0.5), (20, 1, 0, 1.0), (20, 2, 3, 0.5)]
    assert neighbours.nearest_neighbours(vectors_frame(spark, [])).count() == 0
    assert neighbours.nearest_neighbours(vectors_frame(spark, [(1, [1.0, 2.0], 1)])).count() == 0


def _recall(rows, found):
    ids, data = rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_numpy()).astype(float)
    asked, hits = ids[ids % 20 == 0], 0
    for i in asked:
        best = [v for v in ids[np.argsort(-(data @ data[ids == i][0]), kind="stable")] if v != i][:20]
        hits += len(set(best) & set(found[found["query_id"] == i]["vec_id"]))
    assert (found.groupby("query_id").size() == 20).all() and set(found["query_id"]) == set(asked)
    return hits / 20 / len(asked)


@pytest.mark.parametrize("kind", ["short", "one long", "mixed"])
def test_neighbours_are_found_at_any_length(spark, kind):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    lengths = {"short": np.full(len(rows), 0.03), "one long": np.where(np.arange(len(rows)) == 7, 100.0, 1.0), "mixed": np.random.default_rng(3).lognormal(0, 1, len(rows))}[kind]
    rows["embedding"] = [np.asarray(v, dtype=float) * x for v, x in zip(rows["embedding"], lengths)]
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(rows["vec_id"], rows["embedding"])], "vec_id long, embedding array<double>")
    assert _recall(rows, neighbours.nearest_neighbours(frame).toPandas()) >= 0.9


def test_queries_without_candidates_meet_all_vectors(spark, monkeypatch):
    data = np.random.default_rng(4).standard_normal((300, 8))
    rows = pd.DataFrame({"vec_id": range(300), "embedding": list(data)})
    few = lambda points, queries, nearest, most: neighbours.Hashes(np.random.default_rng(1).standard_normal((neighbours.TABLES, neighbours.HASHES, 9)), np.zeros((neighbours.TABLES, neighbours.HASHES)), most / 50, 1)
    monkeypatch.setattr(neighbours, "choose", few)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    assert _recall(rows, neighbours.nearest_neighbours(frame).toPandas()) == 1
