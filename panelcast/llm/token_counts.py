"""Token counts; huge documents by overlapping chunks spliced where their tokens are in step again."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.staging import small_batches
from panelcast.llm.tokens import slices, tokenizer

#: Where a word begins whatever stands around it: after a space or line break, at a digit (each is a word), and at a letter after a sign
#: that is no apostrophe and no mark that could join a letter. Tokens on either side do not depend on each other.
_STABLE = regex.compile(r"(?<=[ \n])\p{L}|\p{N}|(?<=[^\s\p{L}\p{N}\p{M}\p{C}\p{Z}'])\p{L}")
#: A stretch that lies in one word.
_ONE_WORD = regex.compile(r"\p{L}+|[^\s\p{L}\p{N}\p{M}\p{C}\p{Z}']+")
#: Words whose number of tokens a worker remembers.
REMEMBERED = 400_000


@lru_cache(maxsize=2)
def _memory(path: str) -> dict[str, int]:
    return {}


def count_short(texts: list[str], path: str) -> list[int]:
    """Tokens of each text: the sum over what lies between spaces and line breaks, counted once per distinct word."""
    known = _memory(path)
    rows = [text.replace("\n", " ").split(" ") for text in texts]
    new = list(set().union(*rows).difference(known))
    if len(known) + len(new) > REMEMBERED:
        known.clear()
        new = list(set().union(*rows))
    known.update(zip(new, map(len, tokenizer(path).encode_batch_fast(new, add_special_tokens=False))))
    return [sum(map(known.__getitem__, words)) for words in rows]


class _Chunk:
    """The tokens of ``text[start:end]``, with places counted in the whole text."""

    def __init__(self, text: str, start: int, end: int, path: str) -> None:
        found = tokenizer(path).encode(text[start:end], add_special_tokens=False)
        self.start, self.end = start, end
        self.ids = np.array(found.ids, np.int64)
        self.begins = np.array([a for a, _ in found.offsets], np.int64) + start
        ends = np.array([b for _, b in found.offsets], np.int64) + start
        #: Whether a token begins where a character does; others begin within one.
        self.whole = np.concatenate([[True], ends[:-1] <= self.begins[1:]])[: len(ends)]

    def before(self, place: int) -> int:
        return int(np.searchsorted(self.begins, place))


def _in_step(text: str, left: _Chunk, right: _Chunk) -> int | None:
    """A stable place in the overlap at which both have a token begin and from which to the next such place both have the same tokens."""
    places = [m.start() for m in _STABLE.finditer(text, right.start + 1, left.end)]
    for here, there in zip(places, places[1:]):
        a, b = left.before(here), left.before(there)
        c, d = right.before(here), right.before(there)
        if a < b < len(left.begins) and c < d and left.begins[a] == here == right.begins[c] and (
            b - a == d - c and (left.ids[a:b] == right.ids[c:d]).all() and (left.begins[a:b] == right.begins[c:d]).all()
        ):
            return here
    return _in_one_word(text, left, right)


def _in_one_word(text: str, left: _Chunk, right: _Chunk) -> int | None:
    """Where a token that both have begins, within one word longer than the overlap.

    Neighbours in either encoding are neighbours in an encoding of some word; a sequence all of whose neighbours are is the word's
    encoding. So up to a common token the left side's tokens hold, and from it on the right side's.
    """
    common, i, j = np.intersect1d(left.begins, right.begins, return_indices=True)  # the first token that begins at each place
    fits = (i > 0) & (j > 0) & (i + 2 < len(left.ids)) & (j + 2 < len(right.ids))
    i, j, common = i[fits], j[fits], common[fits]
    good = (left.ids[i] == right.ids[j]) & left.whole[i] & right.whole[j] & left.whole[i + 1] & right.whole[j + 1]
    good &= left.begins[i + 1] == right.begins[j + 1]
    for a, b, place in zip(i[good].tolist(), j[good].tolist(), common[good].tolist()):
        if _ONE_WORD.fullmatch(text, int(left.begins[a - 1]), int(right.begins[b + 2])):
            return place
    return None


def count_long(text: str, path: str, chunk: int = 16_384, overlap: int = 256) -> int:
    """Tokens of a text, of which only about two chunks are encoded at a time.

    A chunk reaches ``overlap`` characters into the next one. Where the two are in step, the count changes over from one to the
    other, between words or within a long one; if they are nowhere, the overlap is doubled and the first chunk encoded again.
    """
    total, start, at = 0, 0, 0  # `at`: what lies before is counted
    while True:
        end, reach = start + chunk, overlap
        if end + reach >= len(text):
            last = _Chunk(text, start, len(text), path)
            return total + len(last.ids) - last.before(at)
        while True:
            left = _Chunk(text, start, min(end + reach, len(text)), path)
            if left.end == len(text):
                return total + len(left.ids) - left.before(at)
            place = _in_step(text, left, _Chunk(text, end, left.end, path))
            if place is not None:
                break
            reach *= 2
        total += left.before(place) - left.before(at)
        start, at = end, place


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, huge: int = 32_768,
    chunk: int = 16_384, overlap: int = 256,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes`` (UTF-8), ``n_tokens, over_limit``, for a tokenizer whose words end at blanks.

    Texts of more than ``huge`` characters go by :func:`count_long`, the others by :func:`count_short`; both give what the
    library gives for the whole text. Special strings inside a text count as the library's default has
    it. Documents are counted where they are read, without a shuffle. Null counts as empty: 0 bytes, 0 tokens. Every row is
    answered for itself; an empty table gives an empty result; other columns are not read.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            names, texts = batch.column(0), [t or "" for t in batch.column(2).to_pylist()]
            counts: list[int] = []
            for a, b in slices(texts):
                short = [t if len(t) <= huge else "" for t in texts[a:b]]
                for text, n in zip(texts[a:b], count_short(short, path)):
                    counts.append(count_long(text, path, chunk, overlap) if len(text) > huge else n)
            yield pa.RecordBatch.from_arrays([names, batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
        .mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
