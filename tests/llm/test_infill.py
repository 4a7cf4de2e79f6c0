"""Fill-in-the-middle against plain string code."""

import hashlib
import random
import re

import numpy as np
import pytest

from transit_spark.llm import infill


def plain_fill(doc_id, text, per_cent=100, spm_per_cent=50):
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= per_cent:
        return len(units), "plain", None, None, text
    head, mid, tail = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    spm = h[3] % 100 < spm_per_cent
    return len(units), "spm" if spm else "psm", len(head), len(mid), f"<S>{tail}<P>{head}<M>{mid}" if spm else f"<P>{head}<S>{tail}<M>{mid}"


def check(docs, **options):
    got = infill.restore(infill.fill_in_middle(docs, **options)).collect()
    given = docs.collect()
    assert len(got) == len(given)
    ours = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) for r in got), key=repr)
    rates = {k: options[k] for k in ("per_cent", "spm_per_cent") if k in options}
    theirs = sorted(((r["doc_id"], *plain_fill(r["doc_id"], r["text"], **rates), r["text"] or "") for r in given), key=repr)
    assert ours == theirs


def drawn_texts(seed, count):
    draw = random.Random(seed)
    parts = ["a", "é", "😀", "\n", "\n\n", " ", "<", "P", ">", "<P", "S>", "<M>", "\r\n", " ", "word", "日本"]
    weights = [6, 4, 3, 6, 2, 4, 2, 2, 2, 1, 1, 0.2, 1, 1, 6, 3]
    return [(i, "".join(draw.choices(parts, weights, k=draw.randint(0, 30)))) for i in range(count)]


@pytest.mark.parametrize(("window", "block"), [(1 << 20, 1 << 23), (5, 40), (1, 1)])
def test_blocks_and_windows_of_any_size(monkeypatch, window, block):
    """In one process, so that windows and blocks of a few bytes can be forced."""
    import pyarrow as pa

    monkeypatch.setattr(infill, "WINDOW", window)
    monkeypatch.setattr(infill, "BLOCK", block)
    rows = drawn_texts(window, 400)
    column = pa.array([t.encode() for _, t in rows], pa.binary())
    hashes = np.array([[int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for i, _ in rows] for k in range(4)])
    seen = 0
    for i, j, data, at in infill.blocks(column):
        assert i == seen and len(data) <= block or j == i + 1
        out, out_at, units, form, prefix, middle, plain = infill.fill(data, at, hashes[:, i:j], 100, 50)
        back, back_at = infill.unfill(out, out_at, form)
        for k in range(j - i):
            n, name, head, mid, text = plain_fill(*rows[i + k])
            assert (units[k], infill.FORMS[form[k]], out[out_at[k] : out_at[k + 1]].tobytes()) == (n, name, text.encode())
            assert plain[k] == (head is None) and (plain[k] or (prefix[k], middle[k]) == (head, mid))
            assert back[back_at[k] : back_at[k + 1]].tobytes() == rows[i + k][1].encode()
        seen = j
    assert seen == len(rows)


def test_equals_plain_code(spark):
    check(spark.createDataFrame(drawn_texts(3, 500), "doc_id long, text string").repartition(3))


def test_rates(spark):
    docs = spark.createDataFrame(drawn_texts(4, 300), "doc_id long, text string")
    check(docs, per_cent=40, spm_per_cent=90)
    check(docs, per_cent=0)


def test_odd_rows(odd_documents, no_documents):
    check(odd_documents)
    assert infill.restore(infill.fill_in_middle(no_documents)).collect() == []
    kept = infill.fill_in_middle(odd_documents, keep=True).select("row.*")
    assert sorted(kept.collect(), key=repr) == sorted(odd_documents.collect(), key=repr)


def test_very_long_text(spark):
    text = "eine Zeile mit Wörtern\n" * 400_000 + "x" * 3_000_000
    check(spark.createDataFrame([(1, text), (2, "\n" * 2_000_000), (3, "short")], "doc_id long, text string"))


def test_torn_outputs_are_errors(spark):
    for output, form in (("<P>a<S>b", "psm"), ("<P>a<S>b<M>c", "spm"), ("<P>a<S>b<M>c<M>", "psm"), ("a", "odd")):
        with pytest.raises(Exception, match="marker|unknown form"):
            infill.restore(spark.createDataFrame([(output, form)], "output string, form string")).collect()
