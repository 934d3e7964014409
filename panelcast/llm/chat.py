"""Chat conversations as token ids with a loss mask, and back."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.staging import small_batches
from panelcast.llm.tokens import ID, encode_ids, tokenizer

#: Control strings of this template, whose ids follow the vocabulary in this order.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = (TURN, TEXT, END)

# Whatever looks like a control string of this or another common template: <|...|>, <s>, </s>, [INST], [/INST].
_ESCAPE = re.compile(r"(?:<(?=\\*(?:\||/?s>))|\[(?=\\*/?INST\]))")
_UNESCAPE = re.compile(r"(<(?=\\+(?:\||/?s>))|\[(?=\\+/?INST\]))\\")


def escape(text: str) -> str:
    """The text with one more backslash after the first character of every control string, escaped ones included."""
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """What :func:`escape` was given."""
    return _UNESCAPE.sub(r"\1", text)


@dataclass(frozen=True)
class Template:
    """The tokenizer's file, and the first of the three ids that are reserved beside its vocabulary."""

    path: str
    first_reserved: int | None = None
    ranks_path: str | None = None
    learned_role: str = "assistant"

    def reserved(self) -> int:
        return tokenizer(self.path).get_vocab_size(with_added_tokens=True) if self.first_reserved is None else self.first_reserved


def assemble(roles: list[str], texts: list[str], template: Template) -> list[tuple[np.ndarray, int, int]]:
    """Ids of each turn, and where in them the text under the loss begins and ends (both 0 for other roles).

    Every segment is encoded on its own and reserved ids are set between segments, so no id joins what a user wrote with the
    template. Where a segment lies follows from the running sum of segment lengths.
    """
    first = template.reserved()
    control = [np.array([first + i], ID) for i in range(len(CONTROL))]
    names = sorted(set(roles))
    role_ids = dict(zip(names, encode_ids([escape(r) for r in names], template.path, template.ranks_path)))
    segments: list[np.ndarray] = []
    for role, ids in zip(roles, encode_ids([escape(t) for t in texts], template.path, template.ranks_path)):
        segments += [control[0], role_ids[role], control[1], ids, control[2]]
    ends = np.cumsum([len(s) for s in segments], dtype=np.int64).reshape(-1, 5)
    stream = np.concatenate(segments) if segments else np.zeros(0, ID)
    out = []
    for i, role in enumerate(roles):
        begin = ends[i - 1, 4] if i else 0
        learned = role == template.learned_role
        out.append((stream[begin: ends[i, 4]], int(ends[i, 2] - begin) * learned, int(ends[i, 3] - begin) * learned))
    return out


def disassemble(turns: list[tuple[np.ndarray, int, int]], template: Template) -> list[tuple[str, str, str | None, int]]:
    """Role, text, text under the loss (None where there is no loss) and formatted length of each turn, from its ids."""
    first = template.reserved()
    parts: list[list[int]] = []
    for ids, start, end in turns:
        marks = np.flatnonzero(ids >= first)
        if [int(ids[m]) - first for m in marks] != [0, 1, 2] or marks[0] != 0 or marks[2] != len(ids) - 1:
            raise ValueError("a turn's control ids are not in order")
        parts += [ids[1: marks[1]].tolist(), ids[marks[1] + 1: -1].tolist(), ids[start:end].tolist()]
    written = tokenizer(template.path).decode_batch(parts, skip_special_tokens=False)
    out, fixed = [], sum(map(len, CONTROL))
    for i, (_, start, _) in enumerate(turns):
        role, text, learned = written[3 * i: 3 * i + 3]
        out.append((unescape(role), unescape(text), unescape(learned) if start else None, fixed + len(role) + len(text)))
    return out


def format_turns(
    conversations: DataFrame, template: Template, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per turn: ``conv_id, turn, ids`` (little-endian unsigned 32-bit), ``loss_start, loss_end`` (positions in them).

    Turns are formatted where they are read. Null roles and texts count as empty. An empty table gives an empty result; other
    columns are not read.
    """
    small_batches(conversations.sparkSession)

    def run(batches):
        for batch in batches:
            done = assemble(batch.column(2).to_pylist(), batch.column(3).to_pylist(), template)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([d[0].tobytes() for d in done], pa.binary())]
                + [pa.array([d[i] for d in done], pa.int64()) for i in (1, 2)],
                names=["conv_id", "turn", "ids", "loss_start", "loss_end"],
            )

    return conversations.select(
        F.col(conv_col).cast("long"), F.col(turn_col).cast("long"), F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    ).mapInArrow(run, "conv_id long, turn long, ids binary, loss_start long, loss_end long")


def read_turns(formatted: DataFrame, template: Template) -> DataFrame:
    """``conv_id, turn, role, text, loss_text`` (null outside the loss) and ``formatted_chars`` of every formatted turn."""
    small_batches(formatted.sparkSession)

    def run(batches):
        for batch in batches:
            turns = [(np.frombuffer(i, ID), a, b) for i, a, b in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)))]
            read = disassemble(turns, template)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)]
                + [pa.array([r[i] for r in read], pa.string()) for i in range(3)] + [pa.array([r[3] for r in read], pa.int64())],
                names=["conv_id", "turn", "role", "text", "loss_text", "formatted_chars"],
            )

    return formatted.select("conv_id", "turn", "ids", "loss_start", "loss_end").mapInArrow(
        run, "conv_id long, turn long, role string, text string, loss_text string, formatted_chars long"
    )


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches):
    """Digests of conversations whose turns arrive in order; only the state of the current one is held."""
    now = None

    def close():
        return now["conv"], now["n"], now["turns"].hexdigest(), now["chars"], now["loss"].hexdigest(), now["formatted"]

    for batch in batches:
        out = []
        for conv, role, text, learned, chars in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5))):
            if now is None or now["conv"] != conv:
                if now is not None:
                    out.append(close())
                now = {"conv": conv, "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0}
            now["n"] += 1
            now["turns"].update(f"{role}\n{text}\n".encode())
            now["formatted"] += chars
            if learned is not None:
                now["loss"].update(learned.encode())
                now["chars"] += len(learned)
        if out:
            yield _rows(out)
    if now is not None:
        yield _rows([close()])


def _rows(out):
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation of what :func:`read_turns` gives.

    A digest over a conversation must see its turns one after the other. They are sorted by (turn, role, text) and stream
    through one task, which holds a hash state and no turns; all encoding and decoding happens before, spread over all rows. Turns
    with a null conversation form one conversation.
    """
    order = ("conv_id", "turn", "role", "text")
    return turns.repartition("conv_id").sortWithinPartitions(*order).select(*order, "loss_text", "formatted_chars").mapInArrow(_digest, DIGESTS)
