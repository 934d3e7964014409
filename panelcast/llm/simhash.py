"""SimHash fingerprints of word shingles, linked by multi-index hashing."""

from __future__ import annotations

from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.components import LINKS, connected_components, stars
from panelcast.llm.skew import split_join
from panelcast.llm.staging import small_batches, staged

BITS = 64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = regex.compile(rb"[\x20\x09-\x0d]")
#: Bytes of text whose words are held as objects at once.
STRETCH = 1 << 20


def _words(text: bytes):
    """Lists of the words of a text, a stretch at a time. ``bytes.split`` splits at exactly space and \\x09-\\x0D."""
    start = 0
    while start < len(text):
        cut = _BLANK.search(text, start + STRETCH)
        end = cut.start() if cut else len(text)
        yield text[start:end].split()
        start = end


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """The fingerprint of one UTF-8 text as an unsigned number; A-Z count as a-z."""
    ones, total, carry, digest = np.zeros(BITS, np.int64), 0, [], xxhash.xxh64_intdigest
    for found in _words(text.translate(_LOWER)):
        words = carry + found
        if len(words) >= width:
            joined = b" ".join(words)
            starts = np.zeros(len(words), np.int64)
            np.cumsum([len(w) + 1 for w in words[:-1]], out=starts[1:])
            ends = np.append(starts[width:] - 1, len(joined))
            hashes = [digest(joined[s:e], seed) for s, e in zip(starts.tolist(), ends.tolist())]
            ones += _ones(hashes)
            total += len(hashes)
        carry = words[-(width - 1):] if width > 1 else []
    if not total and carry:
        ones, total = _ones([digest(b" ".join(carry), seed)]), 1
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def _ones(hashes: list[int]) -> np.ndarray:
    """How many of the numbers have each bit set."""
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def probe_plan(rows: int, distance: int, segments: int | None = None) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of each segment.

    With m segments and r bits allowed, a = r mod m: two fingerprints within r agree up to floor(r / m) bits in one of the
    first a + 1 segments, or up to one bit less in one of the others. m follows the number of rows, so that a
    segment has about log2(rows) bits; any m finds the same links.
    """
    m = segments or max(2, min(4, round(BITS / max(1.0, log2(max(rows, 2))))))
    edges = [BITS * i // m for i in range(m + 1)]
    radius = [distance // m - (i > distance % m) for i in range(m)]
    return [(edges[i], edges[i + 1] - edges[i], radius[i]) for i in range(m) if radius[i] >= 0]


def _ball(bits: int, radius: int) -> np.ndarray:
    """Masks with at most ``radius`` of ``bits`` bits set; the first is zero."""
    return np.array([sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(range(bits), n)], np.uint64)


def _keys(plan):
    balls = [_ball(bits, radius) for _, bits, radius in plan]

    def run(batches):
        for batch in batches:
            prints, rep = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, ((first, bits, _), ball) in enumerate(zip(plan, balls)):
                value = (prints.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << bits) - 1)
                key = (value[:, None] ^ ball) | np.uint64(i << 60)
                table = np.broadcast_to(ball == 0, key.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().view(np.int64)), pa.array(~table.ravel()), pa.array(np.repeat(prints, len(ball))), pa.array(np.repeat(rep, len(ball)))],
                    names=["key", "asks", "fingerprint", "rep"],
                )

    return run


def _scan(distance: int):
    """Links between the table rows of a key and all its rows, from rows sorted by key, table rows first.

    Of one key only its table rows are held, which are bounded (see ``block``); rows that ask stream past them.
    """

    def run(batches):
        held = None
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            seen = 0
            if held is not None:
                seen = len(held[0])
                columns = [np.concatenate(x) for x in zip(held, columns)]
            key, block, asks, prints, rep = columns
            found_a, found_b, size = [], [], 0
            at, step, n = np.flatnonzero(~asks), 1, len(key)
            while len(at):
                at = at[at + step < n]
                at = at[(key[at] == key[at + step]) & (block[at] == block[at + step])]
                new = at[at + step >= seen]
                close = new[np.bitwise_count((prints[new] ^ prints[new + step]).view(np.uint64)) <= distance]
                close = close[rep[close] != rep[close + step]]
                if len(close):
                    found_a.append(rep[close])
                    found_b.append(rep[close + step])
                    size += len(close)
                if size > 1 << 20:  # keep a spanning forest of what is found so far
                    a, b = stars(np.concatenate(found_a), np.concatenate(found_b))
                    found_a, found_b, size = [a], [b], 0
                step += 1
            if n:
                last = ~asks & (key == key[-1]) & (block == block[-1])
                held = [c[last] for c in columns]
            if found_a:
                a, b = stars(np.concatenate(found_a), np.concatenate(found_b))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def hamming_links(prints: DataFrame, distance: int = 4, segments: int | None = None, block: int = 4096) -> DataFrame:
    """Links ``a, b`` that connect what lies within ``distance`` bits, of rows ``fingerprint, rep`` with distinct fingerprints.

    Every fingerprint is a table row under the value of each of its segments, and asks under all values in a small Hamming
    ball around it. Rows of a key meet in one sorted run; whole distances are verified there, and a run gives
    away a spanning forest of its links, never all pairs. Where more than ``block`` table rows share a key they are dealt to
    several blocks, and the rows of the key are sent to each of these: exact at any size.
    """
    plan = probe_plan(prints.count(), distance, segments)
    rows = prints.select("fingerprint", "rep").mapInArrow(_keys(plan), "key long, asks boolean, fingerprint long, rep long")
    table = prints.select("fingerprint", "rep").mapInArrow(
        _keys([(first, bits, 0) for first, bits, _ in plan]), "key long, asks boolean, fingerprint long, rep long"
    )
    hot, _ = staged(
        table.groupBy("key").count().filter(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")),
        "hot",
    )
    if hot.isEmpty():
        rows = rows.withColumn("block", F.lit(0))
    else:
        own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
        rows = rows.join(hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).select(
            "key", "fingerprint", "rep", "asks", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        ).withColumn("asks", F.col("asks") | (F.col("own") != F.col("block")))
    return (
        rows.select("key", "block", "asks", "fingerprint", "rep")
        .repartition("key", "block").sortWithinPartitions("key", "block", "asks")
        .mapInArrow(_scan(distance), LINKS)
    )


def _places(docs: DataFrame, id_col: str, text_col: str) -> list:
    """Columns that name a document: its id and a hash of its text, none of them null."""
    id_ = F.col(id_col).cast("long")
    return [id_.isNull().alias("none"), F.coalesce(id_, F.lit(0)).alias("own_id"), F.coalesce(F.xxhash64(F.col(text_col).cast("binary")), F.lit(0)).alias("version")]


PRINTS = "none boolean, own_id long, version long, fingerprint long"


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, distance: int, segments: int | None, block: int):
    """The written ``PRINTS`` of all documents, and per fingerprint the first document ``best`` of its component."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            found = [fingerprint(t or b"", width) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.array(found, np.uint64).view(np.int64))], names=[c.split()[0] for c in PRINTS.split(", ")]
            )

    texts = docs.select(*_places(docs, id_col, text_col), F.col(text_col).cast("binary").alias("text"))
    prints, _ = staged(texts.mapInArrow(run, PRINTS), "prints")
    classes, _ = staged(prints.groupBy("fingerprint").agg(F.min(F.struct("none", "own_id", "version")).alias("place")), "classes")
    links = hamming_links(classes.select("fingerprint", F.col("fingerprint").alias("rep")), distance, segments, block)
    named = classes.join(connected_components(links), F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "place", F.coalesce("component", "fingerprint").alias("group")
    )
    first = named.groupBy("group").agg(F.min("place").alias("best"))
    table, _ = staged(named.join(first, "group").select("fingerprint", "best"), "groups")
    return prints, table


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4,
    segments: int | None = None, block: int = 4096,
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (long) and ``component_id``, the smallest id that links reach.

    Equal fingerprints form one class before anything is compared, so exact copies never make pairs; empty and null texts
    are the class of fingerprint 0. A null id takes part under the ids of its class and is never a component's
    name, unless its component has no other. Rows with the same id are answered each for itself. An empty
    table gives an empty result; other columns are not read.
    """
    prints, table = _grouped(docs, id_col, text_col, width, distance, segments, block)
    found = split_join(prints, table, "fingerprint")
    return found.select(
        F.when(~F.col("none"), F.col("own_id")).alias("doc_id"), "fingerprint",
        F.when(~F.col("best.none"), F.col("best.own_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4) -> DataFrame:
    """One row of ``docs`` for each component of near duplicates; columns stay as they are.

    The row with the smallest (id, hash of the text) stays; null ids come last. Rows that repeat an id with different texts are documents of
    their own, rows that repeat both are one.
    """
    _, table = _grouped(docs, id_col, text_col, width, distance, None, 4096)
    names = ["none", "own_id", "version"]
    winners = table.select("best.*").distinct()
    rows = docs.select(F.struct("*").alias("row"), *_places(docs, id_col, text_col))
    return rows.join(winners, names, "left_semi").dropDuplicates(names).select("row.*")
