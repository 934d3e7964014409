"""Packing of token sequences into windows of near-equal fill by multiway differencing."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.staging import small_batches
from panelcast.llm.tokens import encode_ids, slices

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Karmarkar-Karp: positions of ``sizes`` in ``ways`` parts of near-equal sums.

    Each number starts as a partition with one filled part. The two partitions with the largest spread are merged, the
    fullest parts of one with the emptiest of the other, until one is left.
    """
    heap = []
    for i, size in enumerate(sizes):
        parts = [(size, (i,))] + [(0, ())] * (ways - 1)
        heap.append((-size, i, parts))
    heapify(heap)
    while len(heap) > 1:
        _, order, left = heappop(heap)
        _, _, right = heappop(heap)
        merged = [(a + b, x + y) for (a, x), (b, y) in zip(left, reversed(right))]
        merged.sort(key=lambda part: part[0], reverse=True)
        heappush(heap, (merged[-1][0] - merged[0][0], order, merged))
    return [list(x) for _, x in heap[0][2]] if heap else []


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Parts of sums up to ``capacity``: one more part whenever the fullest exceeds it. Each size must fit in a window."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = differencing(sizes, ways)
        if all(sum(sizes[i] for i in part) <= capacity for part in parts):
            return [p for p in parts if p]
        ways += 1


class Packer:
    """Collects pieces and packs them a batch of ``batch`` windows at a time."""

    def __init__(self, capacity: int, batch: int, most: int, slack: int) -> None:
        self.capacity, self.most, self.least = capacity, most, min(16, most)
        self.budget = max(capacity, batch * (capacity - slack))
        self.pieces: list[tuple] = []  # document, start, ids, tokens of the document
        self.size = 0
        self.sequences = 0

    def add(self, doc, ids: np.ndarray):
        """Pieces that are ready once ``ids`` have been taken in."""
        total, at = len(ids), 0
        while total - at >= self.capacity:  # whole windows need no partner
            yield from self._emit([(doc, at, ids[at: at + self.capacity], total)])
            at += self.capacity
        while at < total:
            left = self.budget - self.size
            take = min(self.most, total - at, left, max(self.least, left // 16))
            self.pieces.append((doc, at, ids[at: at + take], total))
            self.size += take
            at += take
            if self.size == self.budget:
                yield from self.flush()

    def flush(self):
        pieces, self.pieces, self.size = self.pieces, [], 0
        for part in windows([len(p[2]) for p in pieces], self.capacity):
            # Pieces of one document stay in order within a window.
            yield from self._emit([pieces[i] for i in sorted(part)])

    def _emit(self, parts):
        offset = 0
        for doc, start, ids, total in parts:
            yield doc, start, len(ids), ids.tobytes(), total, self.sequences, offset
            offset += len(ids)
        self.sequences += 1


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = 2048,
    batch: int = 32, most: int = 256, slack: int = 8, ranks_path: str | None = None,
) -> DataFrame:
    """Sequences of at most ``capacity`` tokens, one row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds little-endian unsigned 32-bit numbers. A document is its text's ids by the tokenizer at ``path``, then
    ``end_id``; each of its ids lies in exactly one piece. Whole windows are cut from long documents first. What is left is
    cut into pieces of at most ``most`` ids, smaller ones as the batch fills up (they even out the rest), and gathered
    until ``batch`` windows are full but for ``slack`` ids each; :func:`windows` then deals the pieces to windows. A sequence
    is padded from its last id to ``capacity``.

    Documents are packed where they are read: there is no shuffle, a task holds one batch, and a lost task is run again
    with the same result. ``sequence_id`` is the number of the task and a count within it. Null and
    empty texts are documents of one token; rows that repeat an id are packed each for itself; null ids stay null;
    an empty table gives no piece; other columns are not read.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        packer = Packer(capacity, batch, most, slack)
        first = TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4")

        def arrow(rows):
            columns = list(zip(*rows))
            columns[5] = [first + s for s in columns[5]]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        for arrived in batches:
            names, texts = arrived.column(0).to_pylist(), [t or "" for t in arrived.column(1).to_pylist()]
            for a, b in slices(texts):
                rows = []
                for doc, ids in zip(names[a:b], encode_ids(texts[a:b], path, ranks_path)):
                    rows.extend(packer.add(doc, np.concatenate([ids, end])))
                if rows:
                    yield arrow(rows)
        if rows := list(packer.flush()):
            yield arrow(rows)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, PIECES)
