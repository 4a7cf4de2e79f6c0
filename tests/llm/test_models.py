"""Quality and language: held-out accuracy, gradients, codes, odd rows; the pipeline against plain Python."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from transit_spark.llm import catalog, language, quality

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DIR}/labels.parquet")


def test_quality_held_out(docs, labels):
    found = quality.rate(docs, quality.learn(docs, labels)).toPandas()
    assert len(found) == docs.count() and found["score"].between(0, 1).all()
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found["doc_id"]]).all()
    assert (found["predicted"] == (found["score"] >= 0.3)).all()
    both = found[found["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert (both["predicted"] == both["quality"]).mean() > 0.95
    good, bad = both[both["quality"] == 1]["score"], both[both["quality"] == 0]["score"]
    assert np.mean(good.to_numpy()[:, None] > bad.to_numpy()[None]) > 0.97


def test_quality_learns_nothing_from_held_out_rows(spark, docs, labels):
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.learn(docs, l).parts for l in (labels, turned))
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_passages_cover_the_whole_text_and_blocks_agree(monkeypatch):
    text = "\n".join(f"Some words, number {i}!" * 3 for i in range(900))
    whole = np.concatenate(list(quality.passages(text)))
    assert len(whole) == -(-len(text.split()) // quality.PASSAGE)
    monkeypatch.setattr(quality, "BLOCK", 7)
    parts = list(quality.passages(text))
    assert len(parts) > 10
    np.testing.assert_allclose(np.concatenate(parts), whole, atol=0.1)  # a pair of bytes at a block's border counts once less


def test_attention_runs_over_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.standard_normal((400, quality.FEATURES)).astype(np.float32)
    sizes, marks = np.full(40, 10), np.arange(40) % 2
    data[::10][marks == 1, :3] += 4  # one passage of each document of label 1 stands out
    model = quality.fit(data, sizes, marks)
    scores = []
    for i in range(40):
        own = data[i * 10 : i * 10 + 10]
        values = []
        for cut in (10, 3):
            monkeypatch.setattr(quality, "passages", lambda text, cut=cut, own=own: iter(np.split(own, range(cut, 10, cut))))
            values.append(model.score("any"))
        assert abs(values[0] - values[1]) < 1e-6
        scores.append(values[0])
    assert np.mean((np.array(scores) > 0.5) == (marks == 1)) > 0.95


def test_score_equals_the_plain_formula(docs, labels):
    model = quality.learn(docs, labels)
    p, text = model.parts, " ".join(r["text"] for r in docs.limit(40).collect() if r["text"])
    hidden = [np.tanh(np.clip((x - model.mean) / model.scale, -8, 8) @ p["E"] + p["e"]) for x in np.concatenate(list(quality.passages(text)))]
    gate = [float((np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))) @ p["w"]) for h in hidden]
    share = np.exp(gate) / np.exp(gate).sum()
    mean = sum(a * h for a, h in zip(share, hidden))
    assert len(hidden) > 20 and abs(model.score(text) - 1 / (1 + np.exp(-(mean @ p["c"] + p["b"][0])))) < 1e-6


def test_a_step_goes_down_the_numeric_gradient(monkeypatch):
    rng = np.random.default_rng(2)
    sizes, marks = np.array([3, 1, 5, 2, 4, 6]), np.array([0, 1, 1, 0, 1, 0])
    data = rng.standard_normal((sizes.sum(), quality.FEATURES)).astype(np.float32)
    for name, value in (("EPOCHS", 1), ("BATCH", 6), ("SHRINK", 0.0)):
        monkeypatch.setattr(quality, name, value)
    after = quality.fit(data, sizes, marks)
    monkeypatch.setattr(quality, "RATE", 0.0)
    before = quality.fit(data, sizes, marks)
    ends = np.cumsum(sizes)

    def loss() -> float:
        out = []
        for end, size, mark in zip(ends, sizes, marks):
            monkeypatch.setattr(quality, "passages", lambda text, own=data[end - size : end]: iter([own]))
            s = before.score("any")
            out.append(-np.log(s if mark else 1 - s))
        return float(np.mean(out))

    checked = 0
    for k, own in before.parts.items():
        for at in rng.choice(own.size, min(own.size, 12), replace=False):
            spot = np.unravel_index(at, own.shape)
            kept = own[spot]
            own[spot] = kept + 1e-4
            up = loss()
            own[spot] = kept - 1e-4
            slope = (up - loss()) / 2e-4
            own[spot] = kept
            if abs(slope) > 1e-4:  # a first step of Adam has the gradient's sign
                assert np.sign(after.parts[k][spot] - kept) == -np.sign(slope), (k, spot)
                checked += 1
    assert checked > 30


def test_training_reads_all_passages_and_one_row_per_id(spark, monkeypatch):
    long = "word number of a long text. " * 64 * 150
    rows = [(1, long), (1, long + " more"), (2, "short one"), (3, None)] + [(4, "copy")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1), (4, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda data, sizes, labels: seen.append((data.shape, list(sizes), list(labels))))
    quality.learn(docs, marks)
    words = len(long.split())
    ids = [i for i in (1, 2, 3, 4) if zlib.crc32(str(i).encode()) % 5]
    sizes = {1: -(-words // quality.PASSAGE), 2: 1, 3: 1, 4: 1}
    assert 1 in ids and sizes[1] > 500
    assert seen == [((sum(sizes[i] for i in ids), quality.FEATURES), [sizes[i] for i in ids], [{1: 1, 2: 0, 3: 0, 4: 0}[i] for i in ids])]


def test_sample_is_the_smallest_hashes_of_each_group(spark):
    from pyspark.sql import functions as F

    from transit_spark.llm.common import sample_ids

    rows = spark.range(20000).select("id", F.when(F.col("id") % 9 == 0, "b").when(F.col("id") < 30, "c").otherwise("a").alias("g"))
    rows = rows.unionByName(spark.range(30000).select(F.lit(7).cast("long").alias("id"), F.lit("a").alias("g")))  # one id with most rows
    rows = rows.unionByName(spark.createDataFrame([(None, "a"), (1, None)], "id long, g string"))
    hashes = {}
    for r in rows.where("id IS NOT NULL AND g IS NOT NULL").distinct().select("id", "g", F.xxhash64("id").alias("h")).collect():
        hashes.setdefault(r["g"], []).append((r["h"], r["id"]))
    for n in (1, 40, 1500, 100000):
        found = sample_ids(rows, "id", "g", n)
        assert sorted(found) == sorted((i, g) for g, own in hashes.items() for _, i in sorted(own)[:n])
    assert len(sample_ids(rows, "id", "g", 50, {"a": 2})) == 2 + 50 + len(hashes["c"])


def test_quality_odd_rows(odd_documents, no_documents, docs, labels):
    model = quality.learn(docs, labels)
    found = quality.rate(odd_documents, model, keep=True).collect()
    assert len(found) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in found)
    assert quality.rate(no_documents, model).count() == 0
    assert quality.learn(no_documents, labels) is None and quality.learn(docs, labels.limit(0)) is None
    assert {r["score"] for r in quality.rate(odd_documents, None).collect()} == {0.5}


def test_language_held_out(docs):
    found = language.identify(docs, language.learn(docs)).toPandas().merge(docs.toPandas(), on="doc_id")
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found["doc_id"]]).all()
    held = found[found["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98 and found["score"].between(0, 1).all()


@pytest.mark.parametrize("n", [2, 3, 4, 7, 8, 20])
def test_codewords_are_far_apart(n):
    words = language.codewords(n)
    apart = [(words[i] != words[j]).sum() for i in range(n) for j in range(i)]
    assert min(apart) >= max(1, words.shape[1] // 2 - 1)


def test_language_corrects_a_wrong_bit():
    words = language.codewords(4)
    model = language.Model(list("abcd"), words, np.eye(words.shape[1]), np.zeros(words.shape[1]), np.full(words.shape, 1 / words.shape[1]))
    for i, word in enumerate(words):
        for bit in range(words.shape[1]):
            turned = word * 3.0
            turned[bit] *= -1
            best, score, doubt = model.predict(turned[None])
            assert best[0] == i
    _, _, doubt = model.predict(np.zeros((1, words.shape[1])))
    assert doubt[0]


def test_profile_runs_over_blocks(monkeypatch):
    text = "Ein längerer Text über Öfen und Häuser. " * 40
    whole = language.profile(text)
    monkeypatch.setattr(language, "BLOCK", 37)
    np.testing.assert_allclose(language.profile(text), whole, atol=1e-6)


def test_language_odd_rows(odd_documents, no_documents, docs):
    model = language.learn(docs)
    for row in language.identify(odd_documents, model, keep=True).collect():
        text = row["row"]["text"]
        none = text is None or not any(c.isalpha() for c in text)
        assert (row["lang_pred"] == "und") == none and 0 <= row["score"] <= 1
    assert language.identify(no_documents, model).count() == 0
    assert language.learn(no_documents) is None
    assert {r["lang_pred"] for r in language.identify(odd_documents, None).collect()} == {"und"}


def test_pipeline_equals_plain_steps(spark, docs, labels):
    """Each stage against a plain counterpart on its own input."""
    from test_groups import parts, slow_fingerprint
    from test_scans import check_packed

    now = docs
    for (name, stage), want in zip(corpus_pipeline.STAGES, ("quality", "language", "lines", "copies", "packing")):
        before = {r["doc_id"]: r for r in now.collect()}
        now = spark.createDataFrame(stage(spark, now, DIR).collect(), stage(spark, now, DIR).schema)
        if want == "packing":
            rows = now.collect()
            assert {r["doc_id"] for r in rows} == set(before)
            assert check_packed(rows, 4096) <= -(-sum(r["length"] for r in rows) // 4096) * 1.03 + 2
            continue
        assert now.schema == docs.schema, name
        after = {r["doc_id"]: r for r in now.collect()}
        if want in ("quality", "language"):
            assert all(after[i] == before[i] for i in after) and len(after) > 0.8 * len(before)
        elif want == "lines":
            assert set(after) == set(before) and all(r["n_chars"] == len(r["text"]) for r in after.values())
            seen = set()
            for i in sorted(before):
                new = []
                for line in before[i]["text"].split("\n"):
                    words = frozenset(line.lower().split())
                    new += [] if words and words in seen else [line]
                    seen.add(words)
                # Exact repeats are gone; what is left stands in its order; near repeats may be missing besides.
                rest, left = iter(new), after[i]["text"].split("\n") if after[i]["text"] or "" in new else []
                assert all(line in rest for line in left)
        else:
            ids = sorted(before)
            marks = {i: slow_fingerprint(before[i]["text"]) for i in ids}
            groups = parts(ids, [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (marks[a] ^ marks[b]).bit_count() <= 4])
            assert set(after) == set(groups.values())


def test_pipeline_filters_reject_junk_and_keep_clean(docs, labels):
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.filter_quality(docs.sparkSession, docs, DIR).select("doc_id").collect()}
    good, bad = [i for i, q in marks.items() if q == 1], [i for i, q in marks.items() if q == 0]
    assert np.mean([i in kept for i in good]) > 0.98 and np.mean([i in kept for i in bad]) < 0.1


def test_stages_take_odd_rows(spark, odd_documents, no_documents):
    columns = ["doc_id", "text", "lang", "source"]
    for frame in (odd_documents.select(*columns), odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, DIR).count() >= 0, name


def test_unlearnt_languages_go_and_clean_documents_stay(spark, docs):
    draw = np.random.default_rng(5)
    letters = [" ".join("".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), draw.integers(2, 11))) for _ in range(200)) for _ in range(20)]
    strange = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.", "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心", "x" * 5000,
    ]
    more = spark.createDataFrame([(10**6 + n, t) for n, t in enumerate(strange + letters)], "doc_id long, text string")
    kept = corpus_pipeline.filter_language(spark, docs.unionByName(more, allowMissingColumns=True), DIR)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    clean = {r["doc_id"] for r in docs.where(r"text RLIKE '\\p{L}'").select("doc_id").collect()}
    assert len(clean & ids) >= 0.998 * len(clean)
    assert not {10**6 + n for n in range(len(strange))} & ids
    assert not {10**6 + len(strange) + n for n in range(len(letters))} & ids


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    words = [f"{a}{b}" for a in "bcdfghklm" for b in "aeiou"]
    texts = [" ".join(np.random.default_rng(n).choice(words, 60)) for n in range(8)]
    rows = [
        (None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]),  # unrelated texts without id
        (5, texts[3]), (5, texts[4]), (5, texts[5]),  # one id, three texts
        (1, texts[5]), (None, texts[3]), (7, texts[6]), (9, texts[6]), (9, texts[7]), (9, texts[7]),
    ]
    found = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), DIR).collect()
    want = [(None, 0), (None, 1), (None, 2), (5, 3), (5, 4), (1, 5), (7, 6), (9, 7)]
    assert sorted((r["text"], r["doc_id"]) for r in found) == sorted((texts[n], i) for i, n in want)


def test_near_copies_with_a_column_without_order(spark):
    from pyspark.sql import functions as F

    from transit_spark.llm import simhash

    rows = [(3, "a b c d e f", "x"), (2, "a b c d e f", "y"), (2, "a b c d e f", "z"), (5, "another text that stands alone", "x"), (None, "a b c d e f", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("tags", F.create_map(F.lit("k"), "source"))
    found = [simhash.one_per_group(docs.repartition(n)).collect() for n in (1, 4)]
    assert [sorted(r["doc_id"] for r in f) for f in found] == [[2, 5], [2, 5]]
    assert len({r["tags"]["k"] for f in found for r in f if r["doc_id"] == 2}) == 1


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(catalog.QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in catalog.QUERIES} == {f"op{n}" for n in range(1, 14)}
