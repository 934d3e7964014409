"""Repeated byte strings over a whole corpus, by a sparse suffix array dealt out by sampled splitters.

Every string of ``length`` bytes (a window) belongs to one anchor: the place in it whose next ``gram`` bytes have the least code,
the leftmost of several. Equal windows have equal anchors, so only suffixes that begin at anchors are sorted, about
one byte in 35 for the defaults. A suffix's leading tokens are the code of its first ``gram`` bytes and a code of all the text that the
windows of this anchor cover.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.staging import drop, release, small_batches, staged

#: Bytes of text worked on at once, so that the arrays stay in a processor's cache. Longer texts are cut at its multiples.
STRETCH = 1 << 15
_PLACE_BITS = 18
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
_FACTOR, _SCATTER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * _FACTOR) ^ (np.arange(1, 257, dtype=np.uint64) * _SCATTER >> np.uint64(17))
#: An anchor's place is its first window's start, shifted by this, and how many windows follow that one.
RUN_BITS = 16
#: A null id comes after all others.
LAST_ID = (1 << 63) - 1


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One code of two, in this order."""
    out = a * _FACTOR
    out += b
    out ^= out >> np.uint64(32)
    out *= _SCATTER
    return out


def codes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit codes of the ``gram`` bytes (a power of two) from every place on."""
    out, width = _BYTE[data], 1
    while width < gram:
        out = _mixed(out[:-width], out[width:])
        width *= 2
    return out


def window_codes(code: np.ndarray, starts: np.ndarray, length: int, gram: int) -> list[np.ndarray]:
    """The codes that a window consists of; the last two may overlap."""
    return [code[starts + at] for at in [*range(0, length - gram, gram), length - gram]]


def _one(parts: list[np.ndarray], seed: int = 0) -> np.ndarray:
    out = np.full(len(parts[0]), seed, np.uint64)
    for part in parts:
        out = _mixed(out, part)
    return out


def anchors(data: np.ndarray, sizes: np.ndarray, length: int, gram: int):
    """Anchors of the windows inside each of the texts that follow one another in ``data``.

    Returns the first and the last window of each anchor (their starts in ``data``), the code of the anchor's suffix, and that of
    all the bytes these windows cover.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    code = codes(data, gram)
    least = (code & ~_PLACE) | np.arange(len(code), dtype=np.uint64)
    width, have = length - gram + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have:])
    at = (least & _PLACE).astype(np.int64)
    ends = np.cumsum(sizes)
    for start, end in zip(np.maximum(ends - length + 1, ends - sizes).tolist(), ends.tolist()):
        at[start:end] = -1  # windows that leave their text
    change = np.flatnonzero(at[1:] != at[:-1]) + 1
    first, last = np.concatenate([[0], change]), np.concatenate([change - 1, [len(at) - 1]])
    real = at[first] >= 0
    first, last = first[real], last[real]
    place = at[first]
    span = ((place - first) << 32 | (last - first)).astype(np.uint64)
    content = _one([*window_codes(code, first, length, gram), *window_codes(code, last, length, gram), span])
    return first, last, code[place], content


def _pieces(texts: list[bytes], length: int):
    """Runs of (row, place in its text, bytes) of about STRETCH bytes; pieces of one text share length - 1 bytes."""
    run, size = [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(1, len(text) - length + 1), STRETCH):
            piece = text[start: start + STRETCH + length - 1]
            run.append((row, start, piece))
            size += len(piece)
            if size >= STRETCH:
                yield run
                run, size = [], 0
    if run:
        yield run


ANCHORS = "token long, content long, doc long, version long, place long"


def _anchors(length: int, gram: int):
    def run(batches):
        for batch in batches:
            doc, version = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found = []
            for pieces in _pieces(batch.column(2).to_pylist(), length):
                sizes = np.array([len(p) for _, _, p in pieces], np.int64)
                first, last, token, content = anchors(np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8), sizes, length, gram)
                of = np.searchsorted(np.cumsum(sizes), first, side="right")
                rows, shifts = np.array([r for r, _, _ in pieces])[of], np.array([s for _, s, _ in pieces])[of]
                start = first - (np.cumsum(sizes) - sizes)[of] + shifts
                found.append((token.view(np.int64), content.view(np.int64), doc[rows], version[rows], start << RUN_BITS | (last - first)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=[c.split()[0] for c in ANCHORS.split(", ")])

    return run


def _gathered(batches) -> list[pa.ChunkedArray]:
    """The columns of one bucket, whose size the number of buckets bounds."""
    batches = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(batches).columns if batches else []


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Numbers of the runs of equal rows, from sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def multikey(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort: rows that equal another in all keys, run after run, and the number of each row's run.

    Sorts by the first key; only rows in runs that are still equal are sorted by the next one, and rows that are alone leave.
    """
    rows = np.arange(len(keys[0]))
    run = np.zeros(len(rows), np.int64)
    for i, key in enumerate(keys):
        values = key[rows]
        order = np.lexsort((values, run)) if i else np.argsort(values)
        rows, run = rows[order], _runs(run[order], values[order])
        twice = np.bincount(run, minlength=1)[run] > 1
        rows, run = rows[twice], run[twice]
    return rows, run


def _first(rows: np.ndarray, run: np.ndarray, doc: np.ndarray, place: np.ndarray):
    """Rows of each run by (doc, place), and whether each stands where its run's first one stands."""
    order = np.lexsort((place[rows], doc[rows], run))
    rows, run = rows[order], run[order]
    lead = rows[np.searchsorted(run, run)]
    return rows, run, (doc[rows] == doc[lead]) & (place[rows] == place[lead])


MARKS = "doc long, version long, place long, token long"


def _compare(batches):
    """Anchors whose whole text an earlier one has (no token), and those first with their text while others share their token.

    The first and the last token of a bucket may go on in its neighbours; the firsts of these are given on as well.
    """
    columns = _gathered(batches)
    if not columns:
        return
    token, content, doc, version, place = (c.to_numpy() for c in columns)
    low, high = token.min(), token.max()
    rows, _ = multikey([token])
    rows = np.union1d(rows, np.flatnonzero((token == low) | (token == high)))
    rows = rows[np.lexsort((place[rows], doc[rows], content[rows], token[rows]))]
    group, run = _runs(token[rows]), _runs(token[rows], content[rows])
    rows, run, first = _first(rows, run, doc, place)
    several = np.zeros(int(group[-1]) + 1, bool)
    starts = np.searchsorted(group, np.arange(len(several)))
    several[:] = run[starts] != run[np.append(starts[1:], len(run)) - 1]
    edge = several[group] | (token[rows] == low) | (token[rows] == high)
    keep = ~first | edge
    rows, first = rows[keep], first[keep]
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc[rows]), pa.array(version[rows]), pa.array(place[rows]), pa.array(token[rows], mask=~first)],
        names=["doc", "version", "place", "token"],
    )


#: ``part`` is -1 where all marks of a token come to one bucket.
PIECES = "token long, part int, doc long, version long, place long, piece binary"


def _cut(length: int):
    """The text that each marked anchor's windows cover."""

    def run(batches):
        for batch in batches:
            doc, version, texts, marks = batch.columns
            at, flat = marks.offsets.to_numpy(), marks.values
            token, place, part = (flat.field(i).to_numpy(zero_copy_only=False)[at[0]: at[-1]] for i in range(3))
            rows = np.repeat(np.arange(len(doc)), np.diff(at))
            start, more = place >> RUN_BITS, place & ((1 << RUN_BITS) - 1)
            held = texts.to_pylist()
            pieces = [held[r][s:e] for r, s, e in zip(rows.tolist(), start.tolist(), (start + more + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(token), pa.array(part), pa.array(doc.to_numpy()[rows]), pa.array(version.to_numpy()[rows]), pa.array(place), pa.array(pieces, pa.binary())],
                names=[c.split()[0] for c in PIECES.split(", ")],
            )

    return run


SPANS = "doc long, version long, start long, stop long, left long, right long"


def _windows(length: int, gram: int):
    """Spans of the windows that also stand earlier in this bucket.

    Of the others, those of tokens that are dealt to several buckets may stand in another: they are given on with two codes, undecided.
    """

    def run(batches):
        columns = _gathered(batches)
        if not columns:
            return
        part, doc, version, place = (c.to_numpy() for c in columns[1:5])
        pieces = columns[5].combine_chunks()
        bounds = np.frombuffer(pieces.buffers()[1], np.int32, len(pieces) + 1, pieces.offset * 4).astype(np.int64)
        data = np.frombuffer(pieces.buffers()[2], np.uint8)[bounds[0]: bounds[-1]]
        code = codes(data, gram)
        count = (place & ((1 << RUN_BITS) - 1)) + 1
        of = np.repeat(np.arange(len(place)), count)
        step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        parts = window_codes(code, (bounds[:-1] - bounds[0])[of] + step, length, gram)
        doc, version, start, split = doc[of], version[of], (place >> RUN_BITS)[of] + step, part[of] >= 0
        rows, runs = multikey(parts)
        rows, _, first = _first(rows, runs, doc, start)
        later = np.zeros(len(of), bool)
        later[rows[~first]] = True
        found = np.flatnonzero(later)
        found = found[np.lexsort((start[found], version[found], doc[found]))]
        new = np.flatnonzero(np.concatenate([
            [True], (doc[found][1:] != doc[found][:-1]) | (version[found][1:] != version[found][:-1]) | (np.diff(start[found]) > length)
        ])) if len(found) else found
        stop = start[found[np.append(new[1:], len(found)) - 1]] + length if len(found) else found
        lead, undecided = found[new], np.flatnonzero(~later & split)
        left, right = (_one([p[undecided] for p in parts], seed).view(np.int64) for seed in (1, 2))
        both, known = np.concatenate([lead, undecided]), np.arange(len(lead) + len(undecided)) < len(lead)
        blank = np.zeros(len(lead), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[both]), pa.array(version[both]), pa.array(start[both]), pa.array(np.concatenate([stop, start[undecided] + length])),
             pa.array(np.concatenate([blank, left]), mask=known), pa.array(np.concatenate([blank, right]), mask=known)],
            names=["doc", "version", "start", "stop", "left", "right"],
        )

    return run


KEPT = "doc_id long, kept binary, n_bytes long, spans array<struct<start:long,stop:long>>"


def _remove(batches):
    for batch in batches:
        out = []
        for doc, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
            joined: list[list[int]] = []
            for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
                if joined and start <= joined[-1][1]:
                    joined[-1][1] = max(stop, joined[-1][1])
                else:
                    joined.append([start, stop])
            edges = [0, *(x for span in joined for x in span), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((doc, kept, len(text), [{"start": a, "stop": b} for a, b in joined]))
        if out:
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "kept", "n_bytes", "spans"])


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, gram: int = 32, bucket: int = 1 << 18
) -> DataFrame:
    """Without every byte that a string of ``length`` bytes covers which also starts earlier.

    One row per row of ``docs``: ``doc_id, kept`` (the bytes that stay; a character may be cut), ``n_bytes, spans`` (maximal removed
    runs). Earlier means in a smaller id, or in the same id at a smaller place; strings never cross texts.

    * Anchors (``token, content``, their place) are written once, then dealt to buckets of about ``bucket`` rows by splitters that Spark
      samples over (token, content, id, place), so that a passage in very many documents is split as well.
    * A bucket is sorted by multikey quicksort. An anchor that has all its text in common with an earlier one is decided there: its windows
      all stand earlier. Of the others, those that share a token with a different text are looked into: their text is fetched,
      dealt out in the same way by token, and their windows sorted by their codes.
    * A token at either end of a sorted bucket may go on in the next: what is first there is looked into as well. A token with more texts
      than a bucket holds is dealt to several, and first windows of those, at most one per window and bucket, are compared across buckets.

    Windows are compared by codes of 128 bits or more, not byte by byte. Null texts are empty. A null id comes after all others, as
    the largest id would. Rows that repeat an id are texts of their own at the same places: of equal strings at the same id
    and place neither is earlier. An empty table gives an empty result; other columns are not read.
    """
    if not 0 < gram <= length or gram & (gram - 1) or length - gram >= 1 << RUN_BITS or STRETCH + 2 * length > 1 << _PLACE_BITS:
        raise ValueError("gram must be a power of two, at most length, and length must be below some 60000")
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(text).alias("version"), text.alias("text"))

    def dealt(df, rows, *keys):
        return df.repartitionByRange(max(1, ceil(df.count() / rows)), *keys)

    found, anchors_at = staged(texts.mapInArrow(_anchors(length, gram), ANCHORS), "anchors")
    marks, marks_at = staged(dealt(found, bucket, "token", "content", "doc", "place").mapInArrow(_compare, MARKS), "marks")
    del found
    drop(spark, anchors_at)
    most = max(1, bucket // 32)
    edges = marks.filter("token IS NOT NULL")
    wide = edges.groupBy("token").count().filter(F.col("count") > most).select("token", F.ceil(F.col("count") / most).cast("int").alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64("doc", "place"), F.col("parts")).cast("int"), F.lit(-1)).alias("part")
    edges = edges.join(wide, "token", "left").groupBy("doc", "version").agg(F.collect_list(F.struct("token", "place", part)).alias("marks"))
    cut = texts.join(edges, ["doc", "version"]).select("doc", "version", "text", "marks")
    pieces, pieces_at = staged(cut.mapInArrow(_cut(length), PIECES), "pieces")
    spans, _ = staged(dealt(pieces, most, "token", "part").mapInArrow(_windows(length, gram), SPANS), "spans")
    del edges, cut, pieces
    drop(spark, pieces_at)
    release(spark)

    # A string is undecided at most once per bucket, unless rows repeat an id.
    undecided = spans.filter("left IS NOT NULL")
    firsts = undecided.groupBy("left", "right").agg(F.min(F.struct("doc", "start")).alias("first"))
    later = undecided.join(firsts, ["left", "right"]).filter((F.col("doc") != F.col("first.doc")) | (F.col("start") != F.col("first.start")))
    start = F.shiftright("place", RUN_BITS)
    whole = marks.filter("token IS NULL").select(
        "doc", "version", start.alias("start"), (start + F.col("place").bitwiseAND((1 << RUN_BITS) - 1) + length).alias("stop")
    )
    all_spans = whole.unionByName(spans.filter("left IS NULL").select(whole.columns)).unionByName(later.select(whole.columns))
    grouped = all_spans.groupBy("doc", "version").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    same = (F.col("t.doc") == F.col("g.doc")) & (F.col("t.version") == F.col("g.version"))
    both = texts.alias("t").join(grouped.alias("g"), same, "left")
    kept = both.select("t.doc", "t.text", "g.spans").mapInArrow(_remove, KEPT)
    return kept.withColumn("doc_id", F.nullif("doc_id", F.lit(LAST_ID)))
