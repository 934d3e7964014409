"""Hard negatives against scoring all pairs."""

import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from check import rows as counted
from panelcast.llm import hard_negatives as hard, queries

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, id long, score long, summary string"


def brute(rows, scale=256, low=30, high=90):
    """Rows are (vec_id, vector, label); anchors those whose id is divisible by 10."""
    held = {}
    for vec, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            held[vec, label, tuple(math.floor(scale * x) for x in vector)] = None
    out = []
    for anchor, label, own in held:
        if anchor is None or anchor % 10:
            continue
        scored = sorted(
            {(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(own, v)))), math.inf if i is None else i, kind == label)
             for i, kind, v in held if i != anchor and len(v) == len(own)}
        )
        for negative, positive, _ in [s for s in scored if s[2]][:5]:
            p = -negative
            inside = [(-s, i) for s, i, same in scored if not same and low * p <= -100 * s <= high * p]
            out += [(anchor, positive, k + 1, i, p, s) for k, (s, i) in enumerate(inside[:10])]
    return sorted(tuple(None if x == math.inf else x for x in r) for r in out) if out else []


def got(spark, rows, **settings):
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], VECTORS).repartition(3)
    return sorted(hard.hard_negatives(frame, F.col("vec_id") % 10 == 0, **settings).collect(), key=repr)


def vectors(seed, n, size):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(4, size))
    return [(int(i), (centres[i % 4] * 0.6 + draw.normal(size=size) * 0.5).tolist(), int(draw.integers(3))) for i in range(n)]


@pytest.mark.parametrize("seed, size, settings", [(0, 16, {}), (1, 40, {"anchors_at_once": 3}), (2, 5, {}), (3, 1, {"anchors_at_once": 1})])
def test_all_pairs(spark, seed, size, settings):
    rows = vectors(seed, 120, size)
    want = brute(rows)
    assert len(want) > 50 and got(spark, rows, **settings) == sorted(want, key=repr)


def test_odd_rows(spark):
    draw = random.Random(4)
    rows = vectors(5, 60, 6)
    rows += [(60, None, 1), (61, [1.0] * 6, None), (62, [None] + [1.0] * 5, 1), (63, [math.nan] * 6, 1), (64, [math.inf] * 6, 2), (None, [0.5] * 6, 1)]
    rows += [(70, [], 1), (71, [], 1), (72, [], 2), (80, [0.5, 0.25], 0), (81, [0.5, 0.5], 0), (82, [0.25, 0.25], 1), (90, [0.0] * 6, 0)]
    rows += [rows[0], rows[0], rows[7], (10, rows[11][1], 2)] + [(200 + i, [0.5] * 6, i % 3) for i in range(40)]  # repeats and ties
    rows += [(1000, [1e18] * 3, 0), (1001, [1e18] * 3, 0), (1002, [9e15] * 3, 0), (1003, [1e16, 3.0, 1e14], 1), (1004, [2e9] * 3, 2), (1010, [3e8] * 3, 0)]
    draw.shuffle(rows)
    assert got(spark, rows) == sorted(brute(rows), key=repr)


def test_empty_table(spark):
    assert got(spark, []) == [] and got(spark, [(1, [1.0], 1)]) == []


@given(st.integers(1, 40), st.integers(0, 2**31))
@settings(max_examples=40, deadline=None)
def test_bounds_hold(size, seed):
    draw = np.random.default_rng(seed)
    left, right = (np.floor(draw.normal(size=(5, size)) * 300 + draw.integers(-200, 200)) for _ in range(2))
    scores = hard.products(left, right)
    for a, b in zip(hard.summaries(left), hard._read([r.tobytes() for r in hard._stored(right)], size)):
        low, high = hard.bounds(a, b)
        assert (low <= scores).all() and (scores <= high).all()


def test_query_against_sql(spark):
    database = duckdb.connect()
    database.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    found, want = queries.op12_hard_negatives(spark, SMALL), database.sql(queries.SQL["op12_hard_negatives"])
    rows = want.fetchall()
    assert rows and counted(found.columns, map(tuple, found.collect())) == counted(want.columns, rows)
