"""Encoders, counts, packing and chat against the libraries on whole texts."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import example, given, settings as hypothesis_settings
from hypothesis import strategies as st

from panelcast.llm import bpe, chat, packing, queries, token_counts
from panelcast.llm.queries import BYTES, RANKS, WORD_PIECES
from panelcast.llm.tokens import encode_ids, tokenizer
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"
TEXTS = st.text(alphabet=st.sampled_from("abc deé'sl1, .\n\t\x85\xa0\x1c²<|>endoftxÜß漢字"), max_size=200)


def ids_of(text):
    return tokenizer(BYTES).encode(text, add_special_tokens=False).ids


@given(st.text(alphabet=st.characters(max_codepoint=255), max_size=80))
@example("a<|endoftext|>b")
@hypothesis_settings(max_examples=300, deadline=None)
def test_ranks_give_the_same_ids(text):
    assert encode_ids([text], BYTES, RANKS)[0].tolist() == ids_of(text)


@given(TEXTS)
@example("x<|endoftext|>y" * 8)
@example("hello" * 40)
@example(" " * 90)
@hypothesis_settings(max_examples=200, deadline=None)
def test_tree_of_leaves(text):
    parts = bpe.halves(text, 16)
    assert "".join(parts) == text
    assert bpe.join_all([bpe.Piece.encode(p, BYTES) for p in parts], BYTES).ids.tolist() == ids_of(text)


@pytest.mark.parametrize("kind", ["words", "one word", "digits", "blanks", "specials"])
def test_tree_of_long_texts(kind):
    draw = random.Random(kind)
    text = {
        "words": " ".join("".join(draw.choices("abcdefgh", k=draw.randrange(1, 9))) for _ in range(3000)), "one word": "".join(draw.choices("theanding", k=9000)),
        "digits": "".join(draw.choices("0123456789", k=6000)), "blanks": "a" + " " * 5000 + "b" + "\n " * 900, "specials": "ab<|endoftext|>cd " * 700,
    }[kind]
    joined = bpe.join_all([bpe.Piece.encode(p, BYTES) for p in bpe.halves(text, 500)], BYTES)
    assert joined.ids.tolist() == ids_of(text)


@given(TEXTS)
@hypothesis_settings(max_examples=200, deadline=None)
def test_counts(text):
    want = len(tokenizer(WORD_PIECES).encode(text, add_special_tokens=False).ids)
    assert token_counts.count_short([text], WORD_PIECES) == [want]
    assert token_counts.count_long(text, WORD_PIECES, chunk=40, overlap=4) == want


SCRIPTS = {
    "Cyrillic": ("абвгдежзиклмнопрстуфхцчшщыьэюя", " "), "Greek": ("αβγδεζηθικλμνξοπρσςτυφχψω", " "), "Chinese": ("的一是不了人我在有他这为之大来以个中上们", ""),
    "Chinese with stops": ("的一是不了人我在有他这为之大来以个中上们。，", ""), "Arabic": ("ابتثجحخدذرزسشصضطظعغفقكلمنهوي", " "), "mixed": ("abcеёж漢字한글ñ。!'7é", " "),
    "Hangul": ("가나다라마바사아자차카타파하", ""), "signs": ("=-#*~", ""), "emoji": ("😀😃🚀é", ""),
}


def script_text(name, n):
    draw, (letters, blank) = random.Random(name), SCRIPTS[name]
    if not blank:
        return "".join(draw.choices(letters, k=n))
    words = []
    while sum(map(len, words)) + len(words) < n:
        words.append("".join(draw.choices(letters, k=draw.randrange(1, 12))))
    return blank.join(words)


@pytest.mark.parametrize("name", sorted(SCRIPTS))
def test_every_script_in_bounded_chunks(monkeypatch, name):
    """Counts and ids are the library's, and nothing longer than twice a chunk is ever encoded at once."""
    text, seen = script_text(name, 30_000), []
    want_count, want_ids = len(tokenizer(WORD_PIECES).encode(text, add_special_tokens=False).ids), ids_of(text)

    class Watched:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, key):
            return getattr(self.inner, key)

        def encode(self, text, **options):
            seen.append(len(text))
            return self.inner.encode(text, **options)

    for module in (token_counts, bpe):
        monkeypatch.setattr(module, "tokenizer", lambda path: Watched(tokenizer(path)))
    assert token_counts.count_long(text, WORD_PIECES, chunk=2000, overlap=256) == want_count
    assert max(seen) <= 4000
    seen.clear()
    pieces = [bpe.Piece.encode(p, BYTES) for p in bpe.halves(text, 2000)]
    assert bpe.join_all(pieces, BYTES).ids.tolist() == want_ids
    assert name in ("signs", "emoji") or max(seen) <= 4000


@given(st.text(alphabet=st.sampled_from("абя漢字的了éÉÜß。!'s7 \n=İΣç\u0301"), min_size=30, max_size=300))
@hypothesis_settings(max_examples=300, deadline=None)
def test_other_scripts(text):
    want = len(tokenizer(WORD_PIECES).encode(text, add_special_tokens=False).ids)
    assert token_counts.count_long(text, WORD_PIECES, chunk=40, overlap=8) == want
    parts = bpe.halves(text, 16)
    assert bpe.join_all([bpe.Piece.encode(p, BYTES) for p in parts], BYTES).ids.tolist() == ids_of(text)


def test_queries_against_the_libraries(spark):
    """The queries' own columns over the whole test table."""
    rows = {r["doc_id"]: r["text"] or "" for r in queries.table(spark, SMALL, "documents").collect()}
    ids = {d: np.array(ids_of(t), "<u4") for d, t in rows.items()}
    words = {d: len(tokenizer(WORD_PIECES).encode(t, add_special_tokens=False).ids) for d, t in rows.items()}
    counts = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in queries.op8_token_counts(spark, SMALL).collect()}
    assert counts == {d: (len(t.encode()), words[d], words[d] > 2048) for d, t in rows.items()}
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op9_bpe(spark, SMALL).collect()}
    whole = tokenizer(BYTES)
    assert found == {
        d: (len(ids[d]), hashlib.sha256(ids[d].tobytes()).hexdigest(), hashlib.sha256(whole.decode(ids[d].tolist(), skip_special_tokens=False).encode()).hexdigest())
        for d in rows
    }
    held, places = {}, {}
    for r in queries.op1_packing(spark, SMALL).collect():
        own = np.append(ids[r["doc_id"]], np.uint32(1)).astype("<u4")
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(own[r["start"]: r["start"] + r["length"]].tobytes())
        held.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert held.keys() == rows.keys()
    for d, pieces in held.items():
        pieces.sort()
        assert [s for s, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))] and sum(n for _, n in pieces) == len(ids[d]) + 1
    for pieces in places.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))] and sum(n for _, n in pieces) <= 2048


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "word " * 20_000), (4, "x" * 40_000)]
    docs = plain.documents(spark, rows)
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in token_counts.token_counts(docs, WORD_PIECES).collect())
    assert got == sorted((d or 0, len(t or ""), len(tokenizer(WORD_PIECES).encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    back = bpe.decode(bpe.encode(docs, BYTES, leaf=1000, ranks_path=RANKS), BYTES).collect()
    assert sorted((r["doc_id"] or 0, r["text"], r["ids"]) for r in back) == sorted((d or 0, t or "", np.array(ids_of(t or ""), "<u4").tobytes()) for d, t in rows)
    assert bpe.encode(docs.limit(0), BYTES).count() == 0 and token_counts.token_counts(docs.limit(0), WORD_PIECES).count() == 0


def test_packing(spark):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices(["one", "two", "three", "sixty"], k=draw.randrange(0, 900)))) for i in range(200)] + [(500, None), (501, "long " * 9000)]
    pieces = packing.pack(plain.documents(spark, rows), BYTES).collect()
    sequences, documents = {}, {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        documents.setdefault(p["doc_id"], []).append((p["start"], np.frombuffer(p["ids"], "<u4").tolist()))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for doc, text in rows:
        assert [i for _, part in sorted(documents[doc]) for i in part] == ids_of(text or "") + [1]
    assert sum(p["length"] for p in pieces) > 0.9 * 2048 * len(sequences)
    assert packing.pack(plain.documents(spark, []), BYTES).count() == 0


def test_packing_of_odd_rows(spark):
    """Rows that repeat an id or have none are packed each for itself; every id of every row lies in one piece."""
    texts = [None, "", "a b c", "a b c", "x" * 30_000, "word " * 3000, "漢字 é <|endoftext|> ok"]
    rows = [(doc, text) for doc in (7, 7, None, -3) for text in texts]
    pieces = packing.pack(plain.documents(spark, rows).repartition(3), BYTES, ranks_path=RANKS).collect()
    want, got = Counter(), Counter()
    for doc, text in rows:
        ids = [*ids_of(text or ""), 1]
        want.update((doc, at, i, len(ids)) for at, i in enumerate(ids))
    for p in pieces:
        got.update((p["doc_id"], p["start"] + at, i, p["doc_tokens"]) for at, i in enumerate(np.frombuffer(p["ids"], "<u4").tolist()))
    assert got == want


@given(st.lists(st.integers(1, 100), max_size=60), st.integers(1, 9))
@hypothesis_settings(max_examples=60, deadline=None)
def test_differencing(sizes, ways):
    parts = packing.differencing(sizes, ways)
    assert sorted(i for p in parts for i in p) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in p) <= 100 for p in packing.windows(sizes, 100))


@given(st.text(alphabet=st.sampled_from("<\\|/s>[INST]turnex "), max_size=60))
@example("</s>[INST] ok [/INST]")
@hypothesis_settings(max_examples=300, deadline=None)
def test_escape(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in (*chat.CONTROL, "<|", "<s>", "</s>", "[INST]", "[/INST]"))
    template = chat.Template(BYTES)
    read = chat.disassemble(chat.assemble(["user", "assistant", text], [text] * 3, template), template)
    assert [r[:3] for r in read] == [("user", text, None), ("assistant", text, text), (text, text, None)]
