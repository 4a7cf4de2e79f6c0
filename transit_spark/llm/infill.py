"""Fill-in-the-middle by displacement: every byte of a batch is given the shift to its place in the output."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_spark.llm.common import table

#: What marks prefix, suffix and middle; all of one length, so that a marker is found by a few comparisons.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = np.array([list(PREFIX), list(SUFFIX), list(MIDDLE)], dtype=np.uint8)
WIDE = MARKERS.shape[1]
SEED, PER_CENT, SPM_PER_CENT = 7, 100, 50
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"])
#: Bytes whose shifts are held at a time, and bytes of texts that are worked on together; a longer text is alone.
WINDOW, BLOCK = 1 << 20, 1 << 23


def windows(length: int) -> Iterator[tuple[int, int]]:
    for first in range(0, length, WINDOW):
        yield first, min(first + WINDOW, length)


def places(data: np.ndarray, test) -> np.ndarray:
    """Where ``test`` holds, found window by window; Arrow's offsets keep a block below 2 GB."""
    found = [np.flatnonzero(test(data[a:b])).astype(np.int32) + np.int32(a) for a, b in windows(len(data))]
    return np.concatenate(found) if found else np.empty(0, np.int32)


def shifts(starts: np.ndarray, shift: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Window by window the shift of each byte: segment k begins at ``starts[k]`` (ascending) and moves by
    ``shift[k]``. The steps between segments form a difference array; its running sum is the shift."""
    step = np.diff(shift, prepend=0)
    carried = 0
    for a, b in windows(length):
        i, j = np.searchsorted(starts, (a, b))
        difference = np.zeros(b - a, dtype=np.int64)
        np.add.at(difference, starts[i:j] - a, step[i:j])
        difference[0] += carried
        moved = np.cumsum(difference)
        carried = moved[-1]
        yield a, b, moved


def marker_places(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a marker stands within one text, and the number of that text (text k is ``data[at[k]:at[k + 1]]``)."""
    if len(data) < WIDE:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    first = places(data[: len(data) - WIDE + 1], lambda x: x == MARKERS[0, 0])
    hit = np.zeros(len(first), dtype=bool)
    for marker in MARKERS:
        hit |= np.all([data[first + k] == marker[k] for k in range(1, WIDE)], axis=0)
    first = first[hit]
    text = np.searchsorted(at, first, side="right") - 1
    whole = first + WIDE <= at[text + 1]
    return first[whole], text[whole]


def fill(data: np.ndarray, at: np.ndarray, hashes: np.ndarray, per_cent: int, spm_per_cent: int):
    """Output bytes and offsets of a block of texts, with units, forms and code points of prefix and middle."""
    begin, end = at[:-1].astype(np.int64), at[1:].astype(np.int64)
    # Scan the cuts: a unit ends after a newline or with its text.
    breaks = places(data, lambda x: x == 10)
    before, until = np.searchsorted(breaks, begin), np.searchsorted(breaks, end)
    open_end = end > begin
    open_end[open_end] = data[end[open_end] - 1] != 10
    units = until - before + open_end
    draws = hashes[:2] % (units + 1)
    cuts = []
    for unit in (draws.min(axis=0), draws.max(axis=0)):
        inside = (unit > 0) & (unit < units)
        cut = np.where(unit == 0, begin, end)
        cut[inside] = breaks[(before + unit - 1)[inside]].astype(np.int64) + 1
        cuts.append(cut)
    form = np.where(hashes[3] % 100 < spm_per_cent, SPM, PSM)
    plain = (begin == end) | (hashes[2] % 100 >= per_cent)
    plain[marker_places(data, at)[1]] = True
    form[plain] = PLAIN
    first, second = (np.where(plain, end, c) for c in cuts)
    marked = np.where(plain, 0, len(MARKERS) * WIDE)
    out_at = np.concatenate([[0], np.cumsum(end - begin + marked)])
    # Places of the parts: psm is P prefix S suffix M middle, spm is S suffix P prefix M middle.
    wide = np.where(plain, 0, WIDE)
    n_prefix, n_suffix = first - begin, end - second
    to = out_at[:-1]
    to_prefix = to + wide + np.where(form == SPM, n_suffix + wide, 0)
    to_suffix = to + wide + np.where(form == SPM, 0, n_prefix + wide)
    to_middle = to + 3 * wide + n_prefix + n_suffix
    starts = np.stack([begin, first, second], axis=1).ravel()
    shift = np.stack([to_prefix - begin, to_middle - first, to_suffix - second], axis=1).ravel()
    out = np.empty(out_at[-1], dtype=np.uint8)
    follows = np.zeros((len(starts) + 1), dtype=np.int64)  # bytes inside code points before each start and before the end
    total = 0
    for a, b, moved in shifts(starts, shift, len(data)):
        piece = data[a:b]
        moved += np.arange(a, b)
        out[moved] = piece
        inner = np.concatenate([[0], np.cumsum((piece & 0xC0) == 0x80)])
        i, j = np.searchsorted(starts, (a, b))
        follows[i:j] = total + inner[starts[i:j] - a]
        total += inner[-1]
    follows[np.searchsorted(starts, len(data)) :] = total
    marked_rows = np.flatnonzero(~plain)
    for marker, place in zip(MARKERS, (to_prefix, to_suffix, to_middle)):
        out[(place[marked_rows] - WIDE)[:, None] + np.arange(WIDE)] = marker
    cut_follows = follows[:-1].reshape(-1, 3)
    prefix_chars = first - begin - (cut_follows[:, 1] - cut_follows[:, 0])
    middle_chars = second - first - (cut_follows[:, 2] - cut_follows[:, 1])
    return out, out_at, units, form, prefix_chars, middle_chars, plain


def unfill(data: np.ndarray, at: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that were filled, from outputs and forms alone: the inverse gather."""
    begin, end = at[:-1].astype(np.int64), at[1:].astype(np.int64)
    place, text = marker_places(data, at)
    ours = form[text] != PLAIN
    place, text = place[ours].astype(np.int64), text[ours]
    marked = np.flatnonzero(form != PLAIN)
    if not np.array_equal(text, np.repeat(marked, 3)):
        raise ValueError("a text in form psm or spm does not hold each marker once")
    place = place.reshape(-1, 3)
    order = np.where((form[marked] == SPM)[:, None], [SUFFIX[1], PREFIX[1], MIDDLE[1]], [PREFIX[1], SUFFIX[1], MIDDLE[1]])
    if not np.array_equal(data[place + 1], order):
        raise ValueError("the markers of a text do not stand in the order of its form")
    spm = form[marked] == SPM
    ends = np.stack([place[:, 1], place[:, 2], end[marked]], axis=1)
    inside = place + WIDE  # where the first, second and third part begin
    n = ends - inside
    source = np.stack([begin, end, end], axis=1)  # of prefix, middle and suffix; a plain text is all prefix
    length = np.stack([end - begin, np.zeros_like(begin), np.zeros_like(begin)], axis=1)
    prefix, suffix = np.where(spm, 1, 0), np.where(spm, 0, 1)
    rows = np.arange(len(marked))
    for part, column in ((0, prefix), (1, np.full(len(marked), 2)), (2, suffix)):
        source[marked, part], length[marked, part] = inside[rows, column], n[rows, column]
    to = np.concatenate([[0], np.cumsum(length.ravel())])
    starts = to[:-1]
    out = np.empty(to[-1], dtype=np.uint8)
    for a, b, moved in shifts(starts, source.ravel() - starts, len(out)):
        moved += np.arange(a, b)
        out[a:b] = data[moved]
    return out, np.concatenate([[0], to[3::3]])


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [i, j) of a binary column with their bytes and offsets, at most BLOCK bytes unless one row has more."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, int(offsets[i]) + BLOCK, side="right")) - 1)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def binary(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])


def fill_in_middle(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", seed: int = SEED,
    per_cent: int = PER_CENT, spm_per_cent: int = SPM_PER_CENT, keep: bool = False,
) -> DataFrame:
    """Per row its lines ``n``, ``form`` (plain, psm or spm), code points of prefix and middle, and ``output``.

    The sha256 of seed and id alone draws the two cuts between lines and the form, so a row that runs
    again gives the same output. Nothing is shuffled. A null text counts as empty, and empty texts and
    texts that hold a marker stay plain (``prefix_chars`` and ``middle_chars`` null); a null id draws as
    the empty string; repeated rows each give their row; one line of any length is one unit. Other columns
    are not read, unless ``keep`` passes each row on as ``row``. No rows in, none out.
    """
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))), 256)
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("_text"),
        *[F.conv(F.substring(draw, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"_h{k}") for k in range(4)],
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep else []),
    )
    kept = ["doc_id", *(["row"] if keep else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.stack([batch.column(f"_h{k}").to_numpy() for k in range(4)]) if batch.num_rows else None
            for i, j, data, at in blocks(batch.column("_text")):
                out, out_at, units, form, prefix, middle, plain = fill(data, at, hashes[:, i:j], per_cent, spm_per_cent)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, j - i) for c in kept]
                    + [pa.array(units, pa.int64()), pa.array(FORMS[form], pa.string()), pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain), binary(out, out_at)],
                    names=[*kept, "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in kept)
    done = rows.mapInArrow(run, f"{kinds}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return done.withColumn("output", F.col("output").cast("string"))


def restore(filled: DataFrame) -> DataFrame:
    """The rows of ``filled`` (``output``, ``form`` and whatever else) with ``restored``: the text before it was filled.

    A null output restores as empty. A form other than plain whose text does not hold each marker once,
    in its order, is an error.
    """
    others = [c for c in filled.columns if c not in ("output", "restored")]
    rows = filled.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"), F.coalesce("output", F.lit("")).cast("binary").alias("_output"), F.coalesce("form", F.lit("plain")).alias("_form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("_form").to_pylist(), dtype=object)
            form = np.select([names == "plain", names == "psm", names == "spm"], [PLAIN, PSM, SPM], -1)
            if (form < 0).any():
                raise ValueError(f"unknown form {names[form < 0][0]!r}")
            for i, j, data, at in blocks(batch.column("_output")):
                out, out_at = unfill(data, at, form[i:j])
                yield pa.RecordBatch.from_arrays([batch.column("_row").slice(i, j - i), batch.column("_output").slice(i, j - i), binary(out, out_at)], names=["_row", "output", "restored"])

    done = rows.mapInArrow(run, f"_row {rows.schema['_row'].dataType.simpleString()}, output binary, restored binary")
    return done.select("_row.*", F.col("output").cast("string").alias("output"), F.col("restored").cast("string").alias("restored"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents filled and restored, by digest."""
    both = restore(fill_in_middle(table(spark, sf_dir, "documents")))
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


SQL = f"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS body, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
cut AS (
    SELECT doc_id, body, regexp_extract_all(body, '[^\\n]*\\n|[^\\n]+') AS units,
        CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
    FROM drawn),
parts AS (
    SELECT doc_id, body, CAST(len(units) AS BIGINT) AS n,
        CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= {PER_CENT} THEN 'plain'
             WHEN h4 % 100 < {SPM_PER_CENT} THEN 'spm' ELSE 'psm' END AS form,
        coalesce(array_to_string(list_slice(units, 1, least(h1 % (len(units) + 1), h2 % (len(units) + 1))), ''), '') AS head,
        coalesce(array_to_string(list_slice(units, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) + 1, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1))), ''), '') AS mid,
        coalesce(array_to_string(list_slice(units, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) + 1, len(units)), ''), '') AS tail
    FROM cut)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(head) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || mid ELSE '<S>' || tail || '<P>' || head || '<M>' || mid END) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN body ELSE head || mid || tail END) AS restored_sha256
FROM parts
"""
QUERIES = {"op11_fill_in_middle": op11_fill_in_middle}
ORACLES = {"op11_fill_in_middle": SQL}
