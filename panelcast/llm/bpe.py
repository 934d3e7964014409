"""Byte-pair encoding and decoding; long texts are encoded in leaves that are joined as a tree."""

from __future__ import annotations

from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.staging import small_batches
from panelcast.llm.tokens import ID, encode_ids, slices, special_strings, tokenizer

#: Where a word always ends: before a space that follows a visible character (no alternative of the word pattern holds a blank other than
#: as its first character, unless it is all blanks), and before a letter that follows a sign other than an apostrophe.
_STABLE = regex.compile(r"(?<=[\p{L}\p{N}\p{M}\p{P}\p{S}]) |(?<=[[\p{P}\p{S}]--'])\p{L}", regex.V1)
#: A stretch that lies in one word.
_ONE_WORD = regex.compile(r"\p{L}+|\p{N}+")


@lru_cache(maxsize=2)
def _sizes(path: str) -> np.ndarray:
    """Bytes of each token: one per character of its name, but for special ones."""
    loaded = tokenizer(path)
    out = np.zeros(loaded.get_vocab_size(with_added_tokens=True), np.int64)
    for name, i in loaded.get_vocab(with_added_tokens=True).items():
        out[i] = len(name)
    for i, token in loaded.get_added_tokens_decoder().items():
        out[i] = len(token.content.encode())
    return out


class Piece:
    """A stretch of text, its ids, and the character each id begins at."""

    def __init__(self, text: str, ids: np.ndarray, begins: np.ndarray) -> None:
        self.text, self.ids, self.begins = text, ids, begins

    @classmethod
    def encode(cls, text: str, path: str) -> Piece:
        found = tokenizer(path).encode(text, add_special_tokens=False)
        return cls(text, np.array(found.ids, ID), np.array([a for a, _ in found.offsets], np.int64))

    def whole(self, i: int, path: str) -> bool:
        """Whether token ``i`` begins where a character does, and not within one."""
        return int(_sizes(path)[self.ids[:i]].sum()) == len(self.text[: int(self.begins[i])].encode("utf-8", "surrogatepass"))

    def cut(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(self.begins, [start, end])
        return self.ids[a:b], self.begins[a:b]


def _last_two(text: str, reach: int) -> list[int]:
    """The last two stable places within ``reach`` of the end."""
    low = max(0, len(text) - reach)
    return [m.start() for m in _STABLE.finditer(text, low)][-2:]


def _first_two(text: str, reach: int) -> list[int]:
    found = []
    for m in _STABLE.finditer(text, 0, min(reach, len(text))):
        found.append(m.start())
        if len(found) == 2:
            break
    return found


def _whole_word(left: Piece, right: Piece, reach: int, path: str) -> tuple[int, int] | None:
    """Token boundaries around the join, at characters, such that all between lies in one run of letters or of digits."""
    specials = special_strings(path)
    longest = max(map(len, specials), default=1)
    seam = left.text[-longest + 1:] + right.text[: longest - 1]
    if any(s in seam for s in specials):
        return None
    a = int(np.searchsorted(left.begins, max(0, len(left.text) - reach)))
    b = int(np.searchsorted(right.begins, min(len(right.text), reach)))
    if not 0 < a < len(left.ids) or not 0 < b < len(right.ids):
        return None
    start, end = int(left.begins[a]), int(right.begins[b])
    around = left.text[int(left.begins[a - 1]):] + right.text[: end + 1]
    if _ONE_WORD.fullmatch(around) and left.whole(a, path) and right.whole(b, path):
        return start, end
    return None


def join(left: Piece, right: Piece, path: str, reach: int = 32) -> Piece:
    """The encoding of both texts together.

    A window around the join is encoded anew and doubled until it agrees with both sides.

    * Usually it reaches from the last stable place but one on the left to the second on the right. It agrees if between the two
      places of a side the tokens are the same; the join changes over at the inner places, where words end on
      either side whatever follows.
    * Within one long word there is no such place. There the window agrees if its first token is the left side's and its last the
      right side's. Then every two neighbouring tokens are neighbours in some valid encoding of the word, and such a
      sequence is the word's encoding.
    * A window that has grown to both sides in full is right by itself.
    """
    text, shift = left.text + right.text, len(left.text)
    while True:
        p, q = _last_two(left.text, reach), _first_two(right.text, reach)
        if len(p) == len(q) == 2:
            window = Piece.encode(left.text[p[0]:] + right.text[: q[1]], path)
            window.begins = window.begins + p[0]
            sides = ((left, p[0], p[1], 0), (right, q[0], q[1], shift))
            if all(
                np.array_equal(side.cut(a, b)[0], window.cut(a + by, b + by)[0]) and np.array_equal(side.cut(a, b)[1] + by, window.cut(a + by, b + by)[1])
                for side, a, b, by in sides
            ):
                return _splice(text, left, window, right, p[1], q[0], shift)
        elif (found := _whole_word(left, right, reach, path)) is not None:
            start, end = found
            window = Piece.encode(left.text[start:] + right.text[:end], path)
            window.begins = window.begins + start
            a, b = int(np.searchsorted(left.begins, start)), int(np.searchsorted(right.begins, end)) - 1
            if window.ids[0] == left.ids[a] and window.ids[-1] == right.ids[b] and len(window.ids) > 2 and (
                a + 1 < len(left.ids) and window.begins[1] == left.begins[a + 1] and window.begins[-1] == right.begins[b] + shift
            ):
                return _splice(text, left, window, right, start, end, shift)
        if reach >= max(len(left.text), len(right.text)):
            return Piece.encode(text, path)
        reach *= 2


def _splice(text, left, window, right, start, end, shift) -> Piece:
    a = np.searchsorted(left.begins, start)
    b = np.searchsorted(right.begins, end)
    ids, begins = window.cut(start, end + shift)
    return Piece(
        text, np.concatenate([left.ids[:a], ids, right.ids[b:]]),
        np.concatenate([left.begins[:a], begins, right.begins[b:] + shift]),
    )


def join_all(pieces: list[Piece], path: str) -> Piece:
    """Neighbours are joined, then neighbours of the results, until one is left."""
    while len(pieces) > 1:
        pieces = [join(*pair, path) if len(pair) == 2 else pair[0] for pair in (pieces[i: i + 2] for i in range(0, len(pieces), 2))]
    return pieces[0]


def halves(text: str, leaf: int) -> list[str]:
    """The text's halves, and theirs, until none is longer than ``leaf``."""
    if len(text) <= leaf:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], leaf) + halves(text[middle:], leaf)


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = 32_768, ranks_path: str | None = None
) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit) of every whole text, as the tokenizer at ``path`` gives them.

    Texts of up to ``leaf`` characters are encoded where they are read. Longer ones are cut into halves again and again; the
    leaves are dealt over all tasks, encoded there, and joined document by document. What comes together in
    one group is one document. Null counts as empty (no ids); every row is answered for itself, also if an id
    repeats or is null; an empty table gives an empty result; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def short(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                ids = [x.tobytes() for x in encode_ids(texts[a:b], path, ranks_path)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    def leaves(batches):
        numbers = count(TaskContext.get().partitionId() << 40)  # tells rows apart that repeat an id
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row, parts = next(numbers), halves(text, leaf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(parts), pa.int64()), pa.array([doc] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())],
                    names=["row", "doc_id", "leaf", "text"],
                )

    def encode_leaves(batches):
        for batch in batches:
            found = [Piece.encode(t, path) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f.ids.tobytes() for f in found], pa.binary()), pa.array([f.begins.astype(ID).tobytes() for f in found], pa.binary())],
                names=["row", "doc_id", "leaf", "text", "ids", "begins"],
            )

    def joined(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda r: r["leaf"])
        whole = join_all([Piece(r["text"], np.frombuffer(r["ids"], ID), np.frombuffer(r["begins"], ID).astype(np.int64)) for r in parts], path)
        return pa.table({"doc_id": pa.array([parts[0]["doc_id"]], pa.int64()), "ids": pa.array([whole.ids.tobytes()], pa.binary())})

    long = (
        rows.filter(F.length("text") > leaf).mapInArrow(leaves, "row long, doc_id long, leaf int, text string")
        .repartition("row", "leaf").mapInArrow(encode_leaves, "row long, doc_id long, leaf int, text string, ids binary, begins binary")
        .groupBy("row").applyInArrow(joined, "doc_id long, ids binary")
    )
    return rows.filter(F.length("text") <= leaf).mapInArrow(short, "doc_id long, ids binary").unionByName(long)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: the ids decoded by the tokenizer, special tokens kept as text. Null ids decode to null."""
    small_batches(encoded.sparkSession)

    def run(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            for a, b in slices([r or b"" for r in raw], 2 << 20):
                texts = tokenizer(path).decode_batch([np.frombuffer(r or b"", ID).tolist() for r in raw[a:b]], skip_special_tokens=False)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([None if r is None else t for r, t in zip(raw[a:b], texts)], pa.string())],
                    names=["doc_id", "ids", "text"],
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
