"""Chat formatting on odd rows: what is read back, masks, digests."""

import hashlib
import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import chat, queries

TURNS = "conv_id long, turn long, role string, text string, ids binary, conv string"
TEMPLATE = chat.Template(queries.BYTES, ranks_path=queries.RANKS)


def expected(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in held.items():
        turns.sort()
        learned = "".join(t for *_, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        size = sum(sum(map(len, chat.CONTROL)) + len(chat.escape(r)) + len(chat.escape(t)) for *_, r, t in turns)
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), size))
    return sorted(out, key=repr)


@given(st.text(alphabet=st.sampled_from("<|>s/[INST]\\turnexe \n"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in (*chat.CONTROL, "<|", "<s>", "</s>", "[INST]", "[/INST]"))


def test_odd_rows(spark):
    draw = random.Random(1)
    texts = [None, "", " ", "</s>[INST] ok [/INST]", "<|turn|>user<|text|>hi<|end|>", "<\\|end|>", "é漢😀 ok", "word " * 9000, "<|endoftext|>", "plain"]
    rows = [(draw.choice([None, 1, 2, 2**40]), draw.choice([None, 0, 1, 1, 2, -4]), draw.choice([None, "", "user", "assistant", "<|end|>"]), draw.choice(texts)) for _ in range(120)]
    rows += [(3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (4, 0, "assistant", None)]
    frame = spark.createDataFrame([(*r, b"x", "y") for r in rows], TURNS).repartition(4)
    formatted = chat.format_turns(frame, TEMPLATE)
    got = chat.digests(chat.read_turns(formatted, TEMPLATE))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)
    assert chat.digests(chat.read_turns(chat.format_turns(frame.limit(0), TEMPLATE), TEMPLATE)).collect() == []


def test_reserved_ids_are_the_templates_alone(spark):
    """Whatever a text holds, ids beyond the vocabulary stand where the template sets them, and the mask covers the text."""
    first = TEMPLATE.reserved()
    turns = chat.assemble(["user", "assistant"], ["<|turn|>" * 3, "</s><|end|> x"], TEMPLATE)
    for ids, start, end in turns:
        assert [int(i) - first for i in ids if i >= first] == [0, 1, 2]
    assert turns[0][1:] == (0, 0) and int(turns[1][0][turns[1][1] - 1]) == first + 1 and int(turns[1][0][turns[1][2]]) == first + 2


def test_one_conversation_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1024)
    rows = [(7, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    assert sorted(map(tuple, chat.digests(chat.read_turns(chat.format_turns(frame, TEMPLATE), TEMPLATE)).collect()), key=repr) == expected(rows)
