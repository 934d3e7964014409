"""Languages: the learner against a plain one, accuracy on rows that were held out, odd rows."""

import math
import random
import zlib

import numpy as np
import pytest

from panelcast.llm import language_id as lid, queries
from tests.llm import plain

WORDS = {
    "en": "the and with this that from have which their would about there".split(),
    "fr": "les des une dans pour avec cette leurs mais être nous vous".split(),
    "ru": "это как его она они что был для при или уже так".split(),
}


def plain_ftrl(rows, labels, s):
    """Coordinate by coordinate, as the method is written down."""
    z, n = {}, {}

    def weight(key):
        if abs(z.get(key, 0.0)) <= s.l1:
            return 0.0
        return -(z[key] - math.copysign(s.l1, z[key])) / ((s.beta + math.sqrt(n.get(key, 0.0))) / s.alpha + s.l2)

    before = math.inf
    for _ in range(s.passes):
        loss = 0.0
        for buckets, values, label in rows:
            weights = {(b, k): weight((b, k)) for b in buckets for k in range(labels)}
            logits = [sum(x * weights[b, k] for b, x in zip(buckets, values)) for k in range(labels)]
            top = max(logits)
            total = sum(math.exp(v - top) for v in logits)
            chance = [math.exp(v - top) / total for v in logits]
            loss -= math.log(max(chance[label], 1e-300))
            for b, x in zip(buckets, values):
                for k in range(labels):
                    g, old = x * (chance[k] - (k == label)), n.get((b, k), 0.0)
                    z[b, k] = z.get((b, k), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / s.alpha * weights[b, k]
                    n[b, k] = old + g * g
        if loss > (1 - s.still) * before:
            break
        before = loss
    return {key: weight(key) for key in z}


def test_learner_against_a_plain_one():
    draw, s = random.Random(1), lid.Settings(buckets=64, passes=5)
    rows = []
    for _ in range(40):
        label = draw.randrange(3)
        buckets = sorted(draw.sample(range(label * 10, label * 10 + 30), 8)) + [64]
        rows.append((np.array(buckets), np.array([draw.random() for _ in buckets]), label))
    got = lid.ftrl(rows, 3, s)
    want = plain_ftrl([(b.tolist(), x.tolist(), y) for b, x, y in rows], 3, s)
    assert all(math.isclose(got[key], w, rel_tol=1e-9, abs_tol=1e-12) for key, w in want.items())
    assert np.count_nonzero(got) == sum(w != 0 for w in want.values())


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_held_out_accuracy(spark, size):
    folder = f"/root/testdata/{size}"
    docs = {r["doc_id"]: (r["lang"], r["text"]) for r in queries.table(spark, folder, "documents").select("doc_id", "lang", "text").collect()}
    rows = queries.op5_language_id(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    known = {lang for lang, _ in docs.values()}
    assert all(0 <= r["score"] <= 1 and (r["lang_pred"] in known or (r["lang_pred"] == "und" and r["score"] == 0)) for r in rows)
    asked = [r for r in rows if r["held_out"] and docs[r["doc_id"]][0] and any(c.isalpha() for c in docs[r["doc_id"]][1] or "")]
    assert sum(r["lang_pred"] == docs[r["doc_id"]][0] for r in asked) >= 0.97 * len(asked)


def texts(draw, lang, n):
    return " ".join(draw.choices(WORDS[lang], k=n))


def test_odd_rows(spark):
    draw = random.Random(2)
    rows = [(i, texts(draw, lang, 30), lang) for i, lang in enumerate(draw.choices(sorted(WORDS), k=150))]
    odd = [
        (1000, None, "en"), (1001, "", "fr"), (1002, "12 ... \n 34", "ru"), (1003, texts(draw, "ru", 40), None), (None, texts(draw, "fr", 30), "fr"), (3, rows[3][1], rows[3][2]),
        (3, texts(draw, "ru", 30), "ru"), (1004, texts(draw, "en", 60_000), "en"), (1005, "\x00 \U0001d4d0\U0001d4d1 ß", None),
    ]
    found = lid.identify(plain.documents(spark, rows + odd).repartition(5)).collect()
    assert len(found) == len(rows) + len(odd)
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append(r)
    assert [(by[i][0]["lang_pred"], by[i][0]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by[1003][0]["lang_pred"] == "ru" and by[1004][0]["lang_pred"] == "en" and by[1005][0]["lang_pred"] in WORDS
    assert by[None][0]["lang_pred"] == "fr" and by[None][0]["held_out"] and len(by[3]) == 3
    kept = lid.keep_identified(plain.documents(spark, rows + odd))
    assert kept.columns == plain.documents(spark, rows).columns
    left = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert not {1000, 1001, 1002} & set(left) and {r[0] for r in rows} | {1003, 1004, None} <= set(left) and left.count(3) == 3


def test_nothing_to_learn_from(spark):
    empty = plain.documents(spark, [(1, "a")]).limit(0)
    assert lid.identify(empty).collect() == [] and lid.keep_identified(empty).collect() == []
    unlabelled = plain.documents(spark, [(1, "some words")]).withColumn("lang", lid.F.lit(None).cast("string"))
    assert [(r["lang_pred"], r["score"]) for r in lid.identify(unlabelled).collect()] == [("und", 0.0)]
    many = spark.createDataFrame([(i, "text", f"l{i}") for i in range(30)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        lid.identify(many, settings=lid.Settings(max_labels=10))


def test_grams_over_stretches(monkeypatch):
    text = "".join(random.Random(4).choices("ab cdé.", k=500))
    whole = sorted(np.concatenate([b for _, b in lid.grams([text], lid.Settings())]).tolist())
    monkeypatch.setattr(lid, "STRETCH", 17)
    assert sorted(np.concatenate([b for _, b in lid.grams([text], lid.Settings())]).tolist()) == whole
