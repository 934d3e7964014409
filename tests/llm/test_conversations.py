"""Conversation repair against all repairs, and against a plain programme that keeps whole lists of edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import conversations, queries

SMALL = "/root/testdata/sf0.001"
NAMES = {"u": "user", "a": "assistant"}
TURNS = "conv_id long, turn long, role string, text string, conv long, fault string, named string"


def faulty(rows):
    """(role, text, first fault) of the turns, which are in order."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.findall("[^\x20\x09-\x0d]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def options(turn):
    role, text, fault = turn
    yield 4, "D", None, None
    if fault not in ("blank", "duplicate"):
        more = 3 * (fault == "truncated")
        yield more, "K", role[:1] or "?", f"{role}:{text}"  # an empty role fits nowhere, as any other name
        for to in "ua":
            yield 3 + more, "R", to, f"{NAMES[to]}:{text}"


def best_of_all(turns):
    """Tries every edit of every turn and up to two inserts before and after each."""
    inserts = [(0, "", "", [])] + [(3 * len(x), "I" * len(x), x, [NAMES[c] + ":" for c in x]) for x in ("u", "a", "ua", "au")]
    ways = [(0, "", "", [])]
    for turn in turns:
        ways = [
            (c + ic + oc, e + ie + oe, r + ir + (o or ""), t + it + ([line] if line is not None else []))
            for c, e, r, t in ways for ic, ie, ir, it in inserts for oc, oe, o, line in options(turn)
            if re.fullmatch("(s?(ua)*u?)?", r + ir + (o or ""))
        ]
    ways = [(c + ic, e + ie, t + it) for c, e, r, t in ways for ic, ie, ir, it in inserts if re.fullmatch("(s?(ua)+)?", r + ir)]
    return min(ways, key=lambda w: w[:2])


def plain(turns):
    """The same with the best whole list of edits per role before it."""
    steps = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", [])}

    def inserted(best):
        for _ in range(2):
            for at, (c, e, t) in list(best.items()):
                to = "a" if at == "u" else "u"
                new = (c + 3, e + "I", t + [NAMES[to] + ":"])
                best[to] = min(best.get(to, new), new)
        return best

    for turn in turns:
        after = {}
        for at, (c, e, t) in inserted(dict(best)).items():
            for cost, edit, role, line in options(turn):
                if role is None or role and role in steps[at]:
                    to, new = (at, (c + cost, e + edit, t)) if role is None else (role, (c + cost, e + edit, t + [line]))
                    after[to] = min(after.get(to, new), new)
        best = after
    return min(v for at, v in inserted(dict(best)).items() if at in ("", "a"))


def repaired(turns):
    repair = conversations.Repair()
    kinds = {None: 0, "blank": 1, "duplicate": 2, "truncated": 3}
    for role, text, fault in turns:
        repair.add(role[:1], role, text, kinds[fault])
    return repair.close()


def digest(lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


conversation = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["Hi.", "cut", " ", "Oh!\n"])), max_size=4)


@given(conversation)
@settings(max_examples=60, deadline=None)
def test_cheapest_of_all_repairs(rows):
    turns = faulty(rows)
    cost, edits, lines = best_of_all(turns)
    assert repaired(turns) == (cost, edits, digest(lines))
    assert plain(turns) == (cost, edits, lines)


@pytest.mark.parametrize("held", [8, 1 << 20])
def test_long_conversations(monkeypatch, held):
    monkeypatch.setattr(conversations, "HELD_BYTES", held)
    draw = random.Random(held)
    for n in (0, 1, 7, 300):
        turns = faulty([(draw.choice(["system", "user", "user", "assistant", "tool"]), draw.choice(["a.", "b", "c!", "", f"{draw.random()}?"])) for _ in range(n)])
        cost, edits, lines = plain(turns)
        assert repaired(turns) == (cost, edits, digest(lines))


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv] += {
            0: [], 1: [(turn, role, "")], 2: [(turn, role, re.sub("[.!?]", "", text))], 3: [(turn, role, text)] * 2, 4: [(turn, "user", text)]
        }.get(kind, [(turn, role, text)])
    return out


def expected(rows):
    out = []
    for conv, found in damaged(rows).items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns, at = faulty([r[1:] for r in found]), {r[0] for r in found if r[0] is not None}
        count = lambda kind: sum(f == kind for _, _, f in turns)
        initials = [r[:1] for r, _, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, edits, lines = plain(turns)
        gaps = max(at) - min(at) + 1 - len(at) if at else 0
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, edits, digest(lines)))
    return sorted(out, key=repr)


def test_query(spark):
    rows = [tuple(r) for r in queries.table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op13_conversation_repair(spark, SMALL).collect()), key=repr) == expected(rows)


def test_odd_rows(spark, tmp_path):
    draw = random.Random(3)
    rows = [
        (draw.choice([None, 1, 2, 2, 2, -5, 2**62]), draw.choice([None, None, 0, 1, 1, 2, 9, -3]), draw.choice([None, "", "system", "user", "assistant", "Ünal"]),
         draw.choice([None, "", "\x0b", "Yes.", "No", "é!", "\x85", "x" * 5000 + "? \n"]))
        for _ in range(400)
    ] + [(1000 + i, 0, "user", "Once.") for i in range(60)]
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], TURNS).repartition(5)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op13_conversation_repair(spark, str(tmp_path))
    want = expected(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert any(w[7] == "" and w[8] == digest([]) for w in want)
    assert conversations.repair(frame.limit(0)).collect() == [] and got.columns == [c.split()[0] for c in conversations.REPAIRED.split(", ")]
    # One conversation over many batches.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1024)
    one = [(1, i, draw.choice(["user", "assistant"]), f"{i}{draw.choice('.!x')}") for i in range(3000)]
    (row,) = conversations.repair(spark.createDataFrame(one, "conv_id long, turn long, role string, text string")).collect()
    cost, edits, lines = plain(faulty([r[2:] for r in one]))
    assert (row["cost"], row["audit"], row["repaired_sha256"]) == (cost, edits, digest(lines))
