"""Near-duplicate lines: MinHash bands, exact Jaccard verification, one line kept per component."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.components import LINKS, connected_components, with_least
from panelcast.llm.skew import split_join
from panelcast.llm.staging import drop, small_batches, staged

#: Characters around a line that do not count.
BLANKS = " \t\r\x0b\x0c"
#: Characters hashed at once; small enough to stay in the processor's cache.
STRETCH = 1 << 15
#: Turns in which shingles are dealt over MinHash values, and a value that none has fallen to.
TURNS, NONE = 8, np.uint32(0xFFFFFFFF)
#: Classes of shingles in a sketch, a power of two.
CLASSES = 1024


@dataclass(frozen=True)
class Settings:
    """Lines are linked at a Jaccard similarity of ``similarity`` or more of their sets of ``width``-character shingles.

    A band is ``rows`` of ``values`` MinHash values; neighbouring bands share two of theirs. A pair at 0.8 shares one of 16 bands
    of 6 values with a probability of about 0.98, one at 0.9 of 0.9999; unrelated lines (below 0.1) of 0.00002.
    """

    width: int = 5
    similarity: float = 0.8
    values: int = 64
    bands: int = 16
    rows: int = 6
    #: Members of a key that one task holds at once.
    block: int = 16384


def shingles(line: str, width: int) -> set[str]:
    return {line[i: i + width] for i in range(max(1, len(line) - width + 1))}


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def packed_shingles(line: str, width: int) -> np.ndarray | None:
    """:func:`shingles` as sorted whole numbers that hold all their characters.

    None where 64 bits are too few, and for lines so short that a set is quicker.
    """
    bits = 64 // width
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) < max(128, width) or int(codes.max()) >> bits:
        return None
    packed = np.zeros(len(codes) - width + 1, np.uint64)
    for i in range(width):
        packed = (packed << np.uint64(bits)) | codes[i: i + len(packed)]
    packed.sort()
    fresh = np.ones(len(packed), bool)
    np.not_equal(packed[1:], packed[:-1], out=fresh[1:])
    return packed[fresh]


def packed_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    merged = np.concatenate([a, b])
    merged.sort(kind="stable")  # two sorted runs are merged
    both = int(np.count_nonzero(merged[1:] == merged[:-1]))
    return both / (len(merged) - both)


def split_lines(text: str):
    """(number, line without blanks around it) of every line that is not blank."""
    for number, line in enumerate(text.split("\n")):
        if line := line.strip(BLANKS):
            yield number, line


def _digest(line: str) -> bytes:
    """128 bits; the first half is a line's id, the second tells lines apart that share it."""
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def _ids(fresh: dict[bytes, str]) -> np.ndarray:
    return np.frombuffer(b"".join(fresh), "<i8")


def _hashes(codes: np.ndarray, width: int) -> np.ndarray:
    m = len(codes) - width + 1
    h = np.zeros(m, np.uint32)
    for i in range(width):
        h = h * np.uint32(0x01000193) + codes[i: i + m]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return h


def _blocks(lines: list[str], width: int):
    """Lines, padded to a shingle, in stretches that stay in the cache: (place of the first, lengths, codes)."""
    group, size, begin = [], 0, 0
    for i, line in enumerate(lines):
        if group and size + len(line) > STRETCH:
            yield begin, np.array([len(x) for x in group]), np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32)
            group, size, begin = [], 0, i
        group.append(line.ljust(width, "\0"))
        size += len(group[-1])
    if group:
        yield begin, np.array([len(x) for x in group]), np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32)


def _shingle_hashes(lengths: np.ndarray, codes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the shingles of lines laid end to end, without those that reach over a line's end."""
    if len(lengths) == 1:
        return _hashes(codes, width)
    good = np.ones(len(codes), bool)
    ends = np.cumsum(lengths)
    for back in range(1, width):
        good[ends - back] = False
    h = _hashes(codes, width)
    return h[good[: len(h)]]


def _mixed(h: np.ndarray, turn: int) -> np.ndarray:
    g = h + np.uint32(turn * 0x9E3779B9 & 0xFFFFFFFF)
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        g ^= g >> np.uint32(shift)
        g *= np.uint32(factor)
    g ^= g >> np.uint32(16)
    return g


def _share(g: np.ndarray, n: int) -> np.ndarray:
    """``g * n >> 32``: which of ``n`` equal parts of all hashes each lies in."""
    if n > 1 and n & (n - 1) == 0:
        return g >> np.uint32(33 - n.bit_length())
    return (g.astype(np.uint64) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _dealt(out: np.ndarray, at: np.ndarray, h: np.ndarray, turns: range) -> tuple[np.ndarray, np.ndarray]:
    """Fill values of ``out`` from shingles' hashes ``h`` and lines ``at``; returns those of lines with values left over."""
    lines, n = out.shape
    for turn in turns:
        now = np.full(lines * n, NONE, np.uint32)
        for start in range(0, len(h), STRETCH):
            own, g = at[start: start + STRETCH], _mixed(h[start: start + STRETCH], turn)
            np.minimum.at(now, own * n + _share(g, n), g)
        empty = out == NONE
        out[empty] = now.reshape(lines, n)[empty]
        take = (out == NONE).any(axis=1)[at]
        at, h = at[take], h[take]
        if not len(h):
            break
    return at, h


def signatures(lines: list[str], settings: Settings) -> np.ndarray:
    """MinHash values of whole lines, one row each; shorter lines than a shingle are one shingle.

    In each turn every shingle falls to one value by its hash, and a value is the least hash of the first turn that has any for it. Two lines agree in
    a value if the first shingle of both together is in both, as with a hash function for each value, and a line of
    hundreds of shingles takes about two turns instead of 64 functions.
    """
    out, left = np.full((len(lines), settings.values), NONE, np.uint32), []
    for begin, lengths, codes in _blocks(lines, settings.width):
        at = np.repeat(np.arange(len(lengths)), lengths - settings.width + 1)
        at, h = _dealt(out[begin: begin + len(lengths)], at, _shingle_hashes(lengths, codes, settings.width), range(2))
        left.append((at + begin, h))
    if left:
        at, h = _dealt(out, *map(np.concatenate, zip(*left)), range(2, TURNS))
        few = np.unique(at)  # lines of few shingles: all of them for each value that is left
        own, some = np.searchsorted(few, at), out[few]
        empty = some == NONE
        for value in np.flatnonzero(empty.any(axis=0)).tolist():
            now = np.full(len(few), NONE, np.uint32)
            np.minimum.at(now, own, _mixed(h, TURNS + value))
            some[empty[:, value], value] = now[empty[:, value]]
        out[few] = some
    return out


def band_keys(signature: np.ndarray, settings: Settings) -> np.ndarray:
    """A 64-bit key per line and band."""
    step = settings.values // settings.bands
    taken = (np.arange(settings.bands)[:, None] * step + np.arange(settings.rows)) % settings.values
    parts = signature[:, taken].astype(np.uint64)
    key = np.broadcast_to(np.arange(1, settings.bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(settings.rows):
        key = (key ^ parts[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _fresh(batch) -> dict[bytes, str]:
    """The lines of a batch of texts by their ids, each once."""
    fresh: dict[bytes, str] = {}
    for text in batch.column(0).to_pylist():
        for _, line in split_lines(text or ""):
            fresh.setdefault(_digest(line)[:8], line)
    return fresh


def _band_rows(settings: Settings):
    def run(batches):
        for batch in batches:
            fresh = _fresh(batch)
            if fresh:
                keys = band_keys(signatures(list(fresh.values()), settings), settings)
                ids = np.repeat(_ids(fresh), settings.bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "id"])

    return run


def _longer(batches, rows: int = 1 << 16):
    """The two columns of small batches as arrays of about ``rows`` rows: the work on an array costs about the same for a thousand rows."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
        if size >= rows:
            yield tuple(map(np.concatenate, zip(*held)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _buckets(batches):
    """Members of keys that several lines share, from rows sorted by key: ``key, leader, id``, where the leader is any member.

    A member may come more than once, as rows of one line do; the leader comes once.
    """
    key_before = leader_before = None
    given = False  # whether that leader was given away
    for key, ids in _longer(batches):
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        leaders = ids[starts]
        goes_on = key_before is not None and key[0] == key_before
        if goes_on:
            leaders[0] = leader_before
        counts = np.diff(np.append(starts, len(key)))
        leader = np.repeat(leaders, counts)
        other = ids != leader
        named = np.logical_or.reduceat(other, starts)  # the leader goes along with the first other member
        new = named.copy()
        if goes_on:
            new[0] &= not given
        given = bool(named[-1] or (goes_on and len(starts) == 1 and given))
        key_before, leader_before = key[-1], leaders[-1]
        if other.any() or new.any():
            columns = [np.concatenate(c) for c in ((key[starts[new]], key[other]), (leaders[new], leader[other]), (leaders[new], ids[other]))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "leader", "id"])


def sketches(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each line the number of its shingles, and for ``CLASSES`` classes of shingles whether it has an odd number of each, as bits.

    Two lines differ in at least as many shingles as classes. At a Jaccard similarity s they differ in
    (1 - s) / (1 + s) of both numbers together, so more classes than that rule out a link (see :func:`near`).
    """
    count, bits = np.empty(len(lines), np.int64), np.empty((len(lines), CLASSES // 64), np.uint64)
    for begin, lengths, codes in _blocks(lines, width):
        h = _shingle_hashes(lengths, codes, width)
        ends = np.cumsum(lengths - width + 1)
        starts = ends - (lengths - width + 1)
        for start, end in zip(starts.tolist(), ends.tolist()):
            h[start:end].sort()
        fresh = np.ones(len(h), bool)
        np.not_equal(h[1:], h[:-1], out=fresh[1:])
        fresh[starts] = True
        at = np.repeat(np.arange(0, len(lengths) * CLASSES, CLASSES), lengths - width + 1)[fresh]
        at += (h[fresh] * np.uint32(0x9E3779B1) >> np.uint32(32 - CLASSES.bit_length() + 1)).astype(np.int64)
        odd = (np.bincount(at, minlength=len(lengths) * CLASSES).reshape(-1, CLASSES) & 1).astype(np.uint8)
        count[begin: begin + len(lengths)] = np.add.reduceat(fresh, starts, dtype=np.int64)
        bits[begin: begin + len(lengths)] = np.packbits(odd, axis=1).view(np.uint64)
    return count, bits


def near(n_a: np.ndarray, a: np.ndarray, n_b: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sketches of rows allow the similarity; two shingles' room for hashes that coincide."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64) <= (n_a + n_b) * ((1 - similarity) / (1 + similarity)) + 2


def _bits(column: pa.Array) -> np.ndarray:
    """Sketches of a batch as rows of whole numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), CLASSES // 64)


LINES = "id long, line string, n int, sketch binary"


def _line_rows(batches):
    """``id, line`` of the lines of texts, once per batch."""
    for batch in batches:
        fresh = _fresh(batch)
        if fresh:
            yield pa.RecordBatch.from_arrays([pa.array(_ids(fresh)), pa.array(list(fresh.values()), pa.string())], names=["id", "line"])


def _sketched(settings: Settings):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                n, bits = sketches(batch.column(1).to_pylist(), settings.width)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(n, pa.int32()), pa.array([row.tobytes() for row in bits], pa.binary())], names=["id", "line", "n", "sketch"]
                )

    return run


def _occurrences(batches):
    for batch in batches:
        rows, numbers, digests = [], [], []
        for row, text in enumerate(batch.column(2).to_pylist()):
            for number, line in split_lines(text or ""):
                rows.append(row)
                numbers.append(number)
                digests.append(_digest(line))
        halves, at = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2), pa.array(rows, pa.int64())
        columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(numbers, pa.int64()), *(pa.array(halves[:, i].copy()) for i in (0, 1))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "line_no", "id", "check"])


class _Line:
    """A line whose shingles are packed when they are first asked for."""

    def __init__(self, line: str, width: int) -> None:
        self.line, self.width, self.asked, self.packed, self.plain = line, width, False, None, None

    def _packed(self) -> np.ndarray | None:
        if not self.asked:
            self.asked, self.packed = True, packed_shingles(self.line, self.width)
        return self.packed

    def like(self, other: _Line) -> float:
        a, b = self._packed(), other._packed()
        if a is not None and b is not None:
            return packed_jaccard(a, b)
        for side in (self, other):  # short lines, and characters of scripts beyond the packed ones
            side.plain = side.plain or shingles(side.line, side.width)
        return jaccard(self.plain, other.plain)


def _similar(settings: Settings):
    """Of pairs ``a, b`` with their lines, counts and sketches those that are similar."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = batch.column(3).to_numpy(), batch.column(6).to_numpy()
            keep = near(n_a, _bits(batch.column(4)), n_b, _bits(batch.column(7)), settings.similarity)
            last, held = None, None
            for i in np.flatnonzero(keep).tolist():
                x = batch.column(2)[i].as_py()
                if x != last:
                    last, held = x, _Line(x, settings.width)
                keep[i] = held.like(_Line(batch.column(5)[i].as_py(), settings.width)) >= settings.similarity
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, lines: DataFrame, settings: Settings) -> DataFrame:
    def side(name: str) -> DataFrame:
        return lines.select(F.col("id").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("line", "n", "sketch")])

    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.select("a", "b", "a_line", "a_n", "a_sketch", "b_line", "b_n", "b_sketch").mapInArrow(_similar(settings), LINKS)


MEMBERS = "key long, block int, asks boolean, component long, id long, line string, n int, sketch binary"


def _scan(settings: Settings):
    """Links that join components within each key, from rows ``MEMBERS`` sorted by key, block and table rows first.

    Of a key the table rows of one block are held, at most ``settings.block``. Every row is compared with the held ones of other components:
    all sketches at once, then, nearest first, shingle by shingle until a link joins the two components. So a run
    gives away a spanning forest, and no pair is left out that could join anything.
    """
    width, similarity = settings.width, settings.similarity

    def run(batches):
        now, size = None, 0
        for batch in batches:
            found = []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 5)]
            counts, bits = batch.column(6).to_numpy(), _bits(batch.column(7)) if batch.num_rows else None
            for i, (key, block, asks, component, id_, line) in enumerate(zip(*columns)):
                if now != (key, block):
                    now, size, root = (key, block), 0, {}
                    held = np.empty((64, CLASSES // 64), np.uint64)
                    n, labels, ids, lines = np.empty(64, np.int64), np.empty(64, np.int64), [], []
                own = component
                while own in root:
                    own = root[own]
                mine = _Line(line, width)
                # Most held rows are of the same component by now; sketches are compared with the others only.
                close = np.flatnonzero(labels[:size] != own)
                if len(close):
                    close = close[near(n[close], held[close], counts[i], bits[i], similarity)]
                if len(close) > 1:
                    close = close[np.argsort(np.bitwise_count(held[close] ^ bits[i]).sum(axis=1), kind="stable")]
                for j in close.tolist():
                    if labels[j] != own and mine.like(lines[j]) >= similarity:
                        found.append((id_, ids[j]))
                        root[own] = int(labels[j])
                        labels[:size][labels[:size] == own] = labels[j]
                        own = int(labels[j])
                if not asks:
                    if size == len(n):
                        held, n, labels = (np.concatenate([x, np.empty_like(x)]) for x in (held, n, labels))
                    held[size], n[size], labels[size] = bits[i], counts[i], own
                    ids.append(id_)
                    lines.append(mine)
                    size += 1
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return run


def line_links(docs: DataFrame, text_col: str, settings: Settings) -> DataFrame:
    """``node, component`` over ids of lines, complete for all pairs of lines that share a band.

    A band key's members are verified with one of them, its leader, which makes no more pairs than members. Those links are joined to
    components. Only keys of three members or more that are not all in one component are looked at again, by :func:`_scan`: once
    over their members in order, with no pair made into a row. Where such a key has more than ``settings.block`` open members, they are
    dealt to several blocks and all of them sent to each. Pairs whose sketches rule a link out are not compared further.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text")).filter("text IS NOT NULL")
    buckets, at_buckets = staged(
        texts.mapInArrow(_band_rows(settings), "key long, id long").repartition("key").sortWithinPartitions("key")
        .mapInArrow(_buckets, "key long, leader long, id long"),
        "buckets",
    )
    lines, at_lines = staged(
        texts.mapInArrow(_line_rows, "id long, line string").join(buckets.select("id").distinct().hint("shuffle_hash"), "id", "left_semi").dropDuplicates(["id"])
        .mapInArrow(_sketched(settings), LINES),
        "lines",
    )
    first = buckets.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    links, at_links = staged(_verified(first, lines, settings), "first-links")
    joined, at_joined = staged(connected_components(links), "first-components")
    members = buckets.select("key", "id").distinct().join(joined, F.col("id") == F.col("node"), "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    members, at_members = staged(members, "members")
    open_keys = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).filter(
        "low < high AND n > 2"
    ).select("key", F.ceil(F.col("n") / settings.block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = members.join(open_keys, "key").select(
        "key", "component", "id", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    ).withColumn("asks", F.col("own") != F.col("block"))
    rows = dealt.join(lines, "id").select(*[c.split()[0] for c in MEMBERS.split(", ")])
    more = rows.repartition("key", "block").sortWithinPartitions("key", "block", "asks").mapInArrow(_scan(settings), LINKS)
    found, at_found = staged(links.unionByName(more), "all-links")
    out = connected_components(found)
    drop(spark, at_buckets, at_lines, at_links, at_joined, at_members, at_found)
    return out


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per line that is not blank: ``doc_id, line_no, keep_doc_id, keep_line_no, kept``, and ``version`` of the row's text.

    Lines are compared without blanks around them. Equal lines, and lines that verified links connect, are one group; of a group
    the first line by (document, line number) is kept. Null ids come last. Rows that repeat an id and a text are the
    same document and are answered alike. Null, empty and blank texts have no line. An empty table gives an
    empty result; other columns are not read.
    """
    small_batches(docs.sparkSession)
    named, _ = staged(with_least(line_links(docs, text_col, settings)), "line-components")
    found, _ = staged(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("version"), F.col(text_col).alias("text"))
        .mapInArrow(_occurrences, "doc_id long, version long, line_no long, id long, check long"),
        "occurrences",
    )  # read twice below
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "line_no")
    own = found.groupBy("id").agg(F.min(F.struct(place.alias("place"), "check")).alias("first"), F.count("*").alias("rows"))
    grouped = own.join(named, F.col("id") == F.col("node"), "left").filter("rows > 1 OR component IS NOT NULL").select(
        "id", F.col("first.place").alias("place"), F.col("first.check").alias("own_check"), F.coalesce("component", "id").alias("group")
    )
    best = grouped.groupBy("group").agg(F.min("place").alias("best"))
    winners, _ = staged(grouped.join(best, "group").select("id", "own_check", "best"), "line-winners")
    # A line whose digest is that of another line in the first half only is no duplicate of it.
    target = F.when(F.col("check") == F.col("own_check"), F.col("best")).otherwise(place)
    rows = split_join(found, winners, "id").select("doc_id", "version", "line_no", target.alias("best"))
    return rows.select(
        "doc_id", "line_no", F.col("best.doc_id").alias("keep_doc_id"), F.col("best.line_no").alias("keep_line_no"),
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("version") == F.col("best.version")) & (F.col("line_no") == F.col("best.line_no"))).alias("kept"),
        "version",
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the lines that :func:`duplicate_lines` does not keep.

    A document all of whose lines lie in other documents is left out; documents that had no line stay. Blank lines stay.
    Columns stay as they are.
    """
    gone = duplicate_lines(docs, id_col, text_col, settings).filter(~F.col("kept"))
    lost = gone.groupBy("doc_id", "version").agg(F.collect_set("line_no").alias("lost")).select(
        F.col("doc_id").alias("lost_doc"), F.col("version").alias("lost_version"), "lost"
    )  # bounded by one document's lines

    @F.pandas_udf("string")
    def without(texts: pd.Series, lost: pd.Series) -> pd.Series:
        out = []
        for text, numbers in zip(texts, lost):
            if numbers is not None:
                numbers = set(numbers)
                text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in numbers)
                text = text if text.strip(BLANKS + "\n") else None
            out.append(text)
        return pd.Series(out, dtype=object)

    held = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("own_doc"), F.xxhash64(F.col(text_col)).alias("own_version"))
    joined = held.join(lost, F.col("own_doc").eqNullSafe(F.col("lost_doc")) & (F.col("own_version") == F.col("lost_version")), "left")
    text = F.when(F.col("lost").isNull(), F.col("row").getField(text_col)).otherwise(without(F.col("row").getField(text_col), F.col("lost")))
    kept = joined.select("row", "lost", text.alias("new_text")).filter("lost IS NULL OR new_text IS NOT NULL")
    return kept.select(*[F.col("new_text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
