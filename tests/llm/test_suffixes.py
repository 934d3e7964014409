"""Removal of repeated strings against comparing all strings."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from check import rows as counted
from panelcast.llm import queries, suffixes
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"


def brute(rows, length):
    """(doc_id, bytes, removed, runs, digest of the rest) of every row."""
    first, held = {}, [(2**63 - 1 if d is None else d, (t or "").encode()) for d, t in rows]
    for doc, text in held:
        for s in range(len(text) - length + 1):
            first[text[s: s + length]] = min((doc, s), first.get(text[s: s + length], (doc, s)))
    out = []
    for (doc, text), (own, _) in zip(held, rows):
        gone = [False] * len(text)
        for s in range(len(text) - length + 1):
            if first[text[s: s + length]] != (doc, s):
                gone[s: s + length] = [True] * length
        kept = bytes(c for c, g in zip(text, gone) if not g)
        out.append((own, len(text), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(frame, **settings):
    return sorted(
        (
            (r["doc_id"], r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
            for r in suffixes.remove_repeats(frame, **settings).collect()
        ),
        key=repr,
    )


def corpus(seed):
    draw = random.Random(seed)
    pool = ["".join(draw.choices("ab é", k=draw.randrange(5, 60))) for _ in range(6)]
    rows = [
        (draw.choice([None, *range(40)]),
         "".join(draw.choice(pool) if draw.random() < 0.6 else "".join(draw.choices("abcdefé漢", k=draw.randrange(1, 30))) for _ in range(draw.randrange(12))))
        for _ in range(60)
    ]
    # Null and empty texts, runs of one byte, an id with two texts, repeated rows, a text of exactly one string.
    return rows + [(100, None), (101, ""), (102, "a" * 700), (103, "a" * 50), (5, rows[0][1]), rows[3], rows[3], (104, "a" * 12)]


@pytest.mark.parametrize("seed, length, gram, bucket", [(0, 12, 4, 300), (1, 20, 4, 1 << 20), (2, 9, 8, 400), (3, 16, 16, 1 << 20)])
def test_all_strings(spark, monkeypatch, seed, length, gram, bucket):
    monkeypatch.setattr(suffixes, "STRETCH", 300)
    rows = corpus(seed)
    assert got(plain.documents(spark, rows).repartition(3), length=length, gram=gram, bucket=bucket) == brute(rows, length)


def test_hot_passage_over_buckets(spark):
    """A passage in every document, whose places fill several buckets, with different texts around it."""
    draw = random.Random(9)
    passage = "".join(draw.choices("abcdefgh ", k=90))
    rows = [(i, "".join(draw.choices("xyz", k=draw.randrange(20))) + passage + "".join(draw.choices("xyz", k=draw.randrange(20)))) for i in range(200)]
    rows += [(i, rows[0][1]) for i in range(200, 300)]
    assert got(plain.documents(spark, rows), length=24, gram=8, bucket=500) == brute(rows, 24)


def test_empty_table_and_settings(spark):
    none = suffixes.remove_repeats(plain.documents(spark, [(1, "a")]).limit(0))
    assert none.collect() == [] and none.columns == ["doc_id", "kept", "n_bytes", "spans"]
    for wrong in ({"gram": 3}, {"length": 8, "gram": 16}, {"length": 1 << 17}):
        with pytest.raises(ValueError):
            suffixes.remove_repeats(plain.documents(spark, [(1, "a")]), **wrong)


@given(st.lists(st.tuples(*[st.integers(0, 2)] * 3), min_size=1, max_size=40))
@settings(max_examples=50, deadline=None)
def test_multikey(rows):
    keys = [np.array(k) for k in zip(*rows)]
    at, run = suffixes.multikey(keys)
    assert sorted(at) == [i for i, r in enumerate(rows) if rows.count(r) > 1]
    assert [rows[i] for i in at] == sorted(rows[i] for i in at)
    assert all((rows[a] == rows[b]) == (x == y) for a, x in zip(at, run) for b, y in zip(at, run))


def test_query_against_sql(spark):
    database = duckdb.connect()
    database.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    found, want = queries.op11_suffix_dedup(spark, SMALL), database.sql(queries.SQL["op11_suffix_dedup"])
    assert counted(found.columns, map(tuple, found.collect())) == counted(want.columns, want.fetchall())
