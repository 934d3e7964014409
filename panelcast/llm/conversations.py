"""Cheapest repair of a conversation's structure, in one pass over its turns."""

from __future__ import annotations

import hashlib
from itertools import product
from tempfile import SpooledTemporaryFile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.staging import small_batches

#: What counts as blank, and how a whole text ends, in Java's expressions.
_SOLID = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: Costs of the edits. A truncated turn that stays costs as much again as REROLE.
KEEP, REROLE, DELETE, INSERT, STAYS_CUT = 0, 3, 4, 3, 3
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
# States of the repaired roles: nothing yet, after s, after u, after a. The first and the last may end a conversation.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: The only role that an inserted or changed turn can have in each state.
_FORCED = ("u", "u", "a", "u")
_TAIL = ("", "ua", "a", "")
#: Backpointers of one conversation kept in memory; the rest goes to a temporary file of the task, gone with it.
HELD_BYTES = 1 << 20
_UNREACHED = 255


def _moves(initial: str, fault: int) -> list[tuple[int, int, str, str, str, int]]:
    """(from state, to state, inserted roles, edit, role it gives, cost) of every way over one turn, inserts first."""
    out = []
    for state, inserts in product(range(4), range(3)):
        at, inserted = state, ""
        for _ in range(inserts):
            inserted += _FORCED[at]
            at = _NEXT[at, _FORCED[at]]
        if inserts and (at == state or inserts == 2 and state in (USER, ASSISTANT)):
            continue  # back where it was
        cost = inserts * INSERT
        out.append((state, at, inserted, "D", "", cost + DELETE))
        if fault not in (BLANK, DUPLICATE):
            cut = STAYS_CUT * (fault == TRUNCATED)
            if (at, initial) in _NEXT:
                out.append((state, _NEXT[at, initial], inserted, "K", initial, cost + KEEP + cut))
            out.append((state, _NEXT[at, _FORCED[at]], inserted, "R", _FORCED[at], cost + REROLE + cut))
    return out


MOVES = {(initial, fault): _moves(initial, fault) for initial in "sua?" for fault in range(4)}
_EDITS = "DKR"


class Repair:
    """The best repair that ends in each state, of the turns seen so far.

    Of equally cheap ones the ASCII-least list of edits counts. Lists that end in different states after the same turns differ, and none
    begins another (each ends with an edit of the last turn), so their order is all that must be known of them; the lists
    themselves are one byte per turn and state, which says where a state was reached from.
    """

    def __init__(self) -> None:
        self.cost: list[float] = [0, float("inf"), float("inf"), float("inf")]
        self.rank = [0, 0, 0, 0]
        self.digest = [hashlib.sha256(), None, None, None]
        self.back = SpooledTemporaryFile(max_size=HELD_BYTES)
        self.turns = 0

    def add(self, initial: str, role: str, text: str, fault: int) -> None:
        best: list = [None] * 4
        for move in MOVES[initial if initial in "sua" and initial else "?", fault]:
            state, to, inserted, edit, _, cost = move
            key = (self.cost[state] + cost, self.rank[state], "I" * len(inserted) + edit)
            if key[0] < float("inf") and (best[to] is None or key < best[to][0]):
                best[to] = key, move
        order = sorted((b[0][1:], to) for to, b in enumerate(best) if b)
        digest, back = [None] * 4, bytearray([_UNREACHED] * 4)
        for to, found in enumerate(best):
            if found:
                state, _, inserted, edit, given, _ = found[1]
                digest[to] = self.digest[state].copy()
                lines = [ROLES[x] + ":" for x in inserted]
                if edit != "D":
                    lines.append((role if edit == "K" else ROLES[given]) + ":" + text)
                if lines:
                    digest[to].update(("\n" * (state != START) + "\n".join(lines)).encode())
                back[to] = state | len(inserted) << 2 | _EDITS.index(edit) << 4
        self.cost, self.digest = [b[0][0] if b else float("inf") for b in best], digest
        for rank, (_, to) in enumerate(order):
            self.rank[to] = rank
        self.back.write(back)
        self.turns += 1

    def close(self) -> tuple[int, str, str]:
        """Cost, edits and digest of the best repair."""
        cost, _, state = min((self.cost[s] + INSERT * len(_TAIL[s]), self.rank[s], s) for s in range(4) if self.digest[s])
        digest = self.digest[state]
        if _TAIL[state]:
            digest.update("".join("\n" + ROLES[x] + ":" for x in _TAIL[state]).encode())
        edits, end, step = ["I" * len(_TAIL[state])], self.turns, HELD_BYTES // 4
        while end:
            begin = max(0, end - step)
            self.back.seek(4 * begin)
            rows = self.back.read(4 * (end - begin))
            for i in range(end - begin - 1, -1, -1):
                found = rows[4 * i + state]
                edits.append("I" * (found >> 2 & 3) + _EDITS[found >> 4])
                state = found & 3
            end = begin
        self.back.close()
        return int(cost), "".join(reversed(edits)), digest.hexdigest()


REPAIRED = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


class _Conversation:
    def __init__(self, conv) -> None:
        self.conv, self.repair = conv, Repair()
        self.faults, self.illegal, self.last = [0] * 4, 0, None
        self.low = self.high = None
        self.distinct = 0

    def add(self, turn, initial, role, text, fault) -> None:
        self.faults[fault] += 1
        self.illegal += self.last is not None and self.last + initial not in LEGAL
        self.last = initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.distinct = turn if self.low is None else self.low, turn, self.distinct + 1
        self.repair.add(initial, role, text, fault)

    def row(self):
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.distinct, (1 << 63) - 1)
        return (self.conv, gaps, *self.faults[1:], self.illegal, *self.repair.close())


def _stream(batches):
    """Conversations whose turns arrive in order, over as many batches as they take."""
    names = [c.split()[0] for c in REPAIRED.split(", ")]

    def frame(rows):
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"conv_id": "Int64"} | {n: "int64" for n in names[1:7]})

    now = None
    for batch in batches:
        done = []
        for named, conv, real, has_turn, turn, initial, role, text, fault in zip(*(batch[c].tolist() for c in batch.columns)):
            conv = conv if named else None
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv)
            if real:
                now.add(turn if has_turn else None, initial, role, text, fault)
        if done:
            yield frame(done)
    if now is not None:
        yield frame([now.row()])


def repair(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None
) -> DataFrame:
    """Faults of every conversation and its cheapest repair: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    A turn's first fault counts: blank, duplicate (role and text stood earlier), truncated (does not end in ``.!?``). ``illegal`` counts neighbours
    whose roles' initials are not su, ua or au. A repair keeps turns (0), gives them another role (3), deletes them (4, a must for blank
    and duplicate ones) or inserts empty ones (3), so that the initials are ``(s?(ua)+)?``; a truncated turn that stays costs 3. ``audit`` holds
    the edits' initials, the ASCII-least of the cheapest; the digest is that of the repaired ``role:text`` lines.

    Duplicates are numbered by a window per (conversation, role, text), which Spark spills. Then a conversation's turns are brought together
    and sorted, and stream through one task, which holds four states of a dynamic programme, each with a running digest, and one byte per
    turn and state to find the way back by, on disk beyond ``HELD_BYTES``. That is the least a digest in order allows; texts are not held.

    Turns are sorted by (turn, nulls first; role; text). A null role or text counts as one space; an empty role fits nowhere, like an unknown one. A null conversation id is a conversation of
    its own. Rows for which ``present`` is not true only name their conversation, which has zeros and no edits if it has no others. An
    empty table gives an empty result; other columns are not read.
    """
    small_batches(turns.sparkSession)
    conv, turn = F.col(conv_col).cast("long"), F.col(turn_col).cast("long")
    rows = turns.select(
        conv.isNotNull().alias("named"), F.coalesce(conv, F.lit(0)).alias("conv"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("real"), turn.alias("at"),
        F.coalesce(role_col, F.lit(" ")).alias("role"), F.coalesce(text_col, F.lit(" ")).alias("text"),
    )
    same = Window.partitionBy("named", "conv", "real", "role", "text").orderBy(F.col("at").asc_nulls_first())
    fault = (
        F.when(~F.col("text").rlike(_SOLID), BLANK).when(F.row_number().over(same) > 1, DUPLICATE)
        .when(~F.col("text").rlike(_ENDED), TRUNCATED).otherwise(0)
    )
    return (
        rows.withColumn("fault", fault).repartition("named", "conv")
        .sortWithinPartitions("named", "conv", "real", F.col("at").asc_nulls_first(), "role", "text", F.col("fault") == DUPLICATE)
        .select(
            "named", "conv", "real", F.col("at").isNotNull().alias("has_turn"), F.coalesce("at", F.lit(0)).alias("turn"),
            F.substring("role", 1, 1).alias("initial"), "role", "text", "fault",
        )
        .mapInPandas(_stream, REPAIRED)
    )
