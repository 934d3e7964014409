"""Exact duplicates against plain grouping, with frequent digests and without."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from panelcast.llm import exact_dedup
from tests.llm import plain


def expected(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), doc is None, doc))
    out = []
    for doc, text in rows:
        low = re.sub("[\x20\x09-\x0d]", "", text or "")
        less, _, keep = min(groups[low], key=lambda g: (g[0], g[1], g[2] or 0))
        out.append((doc, keep, len(groups[low]), doc == keep and len(text or "") == -less, hashlib.sha256(low.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(seed, n=600):
    draw = random.Random(seed)
    pool = ["a b", "ab", "a\tb ", "\x0ba\x0cb\r\n", "é漢 \x85x", "é漢\x85 x", "\x1c", "\xa0", "long " * 4000, "long" * 4000]
    rows = [(i, draw.choice(pool) if draw.random() < 0.4 else f"text {i % 90} of its own" + " " * draw.randrange(3)) for i in range(n)]
    rows += [(1000 + i, "a  b") for i in range(n // 2)]  # one digest fills a third of all rows
    return rows + [(None, "a b"), (None, "only without an id"), (2000, None), (2001, ""), (2002, " \n"), (2000, None), (5, "  a b"), (5, "a b"), (5, "ab   ")]


@pytest.mark.parametrize("tracked, candidates", [(4096, 1024), (64, 8), (2048, 1)])
def test_groups(spark, tracked, candidates):
    rows = rows_of(tracked)
    frame = plain.documents(spark, rows).repartition(5)
    got = exact_dedup.exact_duplicates(frame, tracked=tracked, candidates=candidates)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_one_text_of_each_group_stays(spark):
    """Rows that repeat an id: of those that are the same but for blanks, only the longest original is kept."""
    rows = [(i % 7, "x" + " " * (i % 5) + "y") for i in range(40)] + [(9, "x y z")]
    got = exact_dedup.exact_duplicates(plain.documents(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)
    assert {(r["doc_id"], r["group_size"]) for r in got.filter("kept").collect()} == {(0, 40), (9, 1)}


def test_empty_table_and_plan(spark):
    none = exact_dedup.exact_duplicates(plain.documents(spark, [(1, "a")]).limit(0))
    assert none.collect() == []
    plan = exact_dedup.exact_duplicates(plain.documents(spark, rows_of(1, 50)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
