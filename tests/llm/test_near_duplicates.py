"""SimHash groups, fuzzy lines, near vectors and components against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.llm import embeddings, line_dedup, queries, simhash
from panelcast.llm.components import connected_components, stars
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=60))
@hypothesis_settings(max_examples=50, deadline=None)
def test_stars_are_components(links):
    groups = plain.Groups()
    for a, b in links:
        groups.join(a, b)
    a, b = stars(np.array([x for x, _ in links]), np.array([y for _, y in links]))
    assert dict(zip(a.tolist(), b.tolist())) == {x: groups.find(x) for x in groups.up if groups.find(x) != x}


def test_components(spark):
    draw = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(200, 260)] + [(draw.randrange(300, 400), draw.randrange(300, 400)) for _ in range(60)]
    draw.shuffle(links)
    groups = plain.Groups()
    for a, b in links:
        groups.join(a, b)
    frame = spark.createDataFrame(links + [(7, 7)], "a long, b long").union(spark.createDataFrame([(None, 3)], "a long, b long")).repartition(20)
    got = {r["node"]: r["component"] for r in connected_components(frame).collect()}
    assert got == {x: groups.find(x) for x in groups.up if groups.find(x) != x}
    assert connected_components(frame.limit(0)).count() == 0


@given(st.text(alphabet=st.sampled_from("aBÀé \t\n\x0b\x1c\x85 z"), max_size=60))
@hypothesis_settings(max_examples=100, deadline=None)
def test_fingerprint_of_any_text(text):
    assert simhash.fingerprint(text.encode()) == plain.simhash(text)


def test_fingerprint_over_stretches(monkeypatch):
    text = " ".join(random.Random(1).choices(["ab", "cde", "f", "Ghi"], k=400))
    monkeypatch.setattr(simhash, "STRETCH", 50)
    assert simhash.fingerprint(text.encode()) == plain.simhash(text)


def test_simhash_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, SMALL, "documents").collect()]
    want = plain.simhash_groups(rows)
    got = queries.op6_simhash(spark, SMALL).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(got) == len(rows)
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {d: f"{plain.simhash(t):016x}" for d, t in rows}


@pytest.mark.parametrize("segments", [2, 3, 4])
@pytest.mark.parametrize("block", [4096, 8])
def test_all_hamming_links(spark, segments, block):
    draw = random.Random(segments)
    prints = {draw.getrandbits(64) for _ in range(200)}
    for base in list(prints)[:10]:  # dense groups and chains
        for _ in range(30):
            flips = sum(1 << b for b in draw.sample(range(64), draw.randrange(1, 6)))
            prints.add(base ^ flips)
            base = base ^ flips if draw.random() < 0.3 else base
    prints = sorted(prints)
    groups = plain.Groups()
    for i, a in enumerate(prints):
        groups.join(i, i)
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                groups.join(i, j)
    rows = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    links = simhash.hamming_links(spark.createDataFrame(rows, "fingerprint long, rep long"), 4, segments, block)
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert got == {i: groups.find(i) for i in range(len(prints)) if groups.find(i) != i}


EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "One two THREE four five"), (4, "One two THREE four five"), (5, "one two three four five"), (None, "one two three four five"), (6, "x" * 200_000), (7, "word " * 50_000), (None, "alone here")]


def test_simhash_edges(spark):
    got = simhash.near_duplicates(plain.documents(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    by = {(r["doc_id"], r["component_id"]) for r in got}
    assert {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (None, 4), (6, 6), (None, None)} <= by
    assert simhash.near_duplicates(plain.documents(spark, [])).count() == 0
    kept = simhash.keep_one(plain.documents(spark, EDGES))
    assert kept.columns == plain.documents(spark, EDGES).columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()) == [1, 4, 6, 7]
    # A null id is represented by its group; of rows that repeat an id, different texts are documents of their own.
    assert [r["text"] for r in kept.filter("doc_id IS NULL").collect()] == ["alone here"]
    twice = simhash.keep_one(plain.documents(spark, [(1, "a b c d e f"), (1, "g h i j k l"), (1, "a b c d e f"), (2, "g h i j k l"), (None, "x y z"), (None, "x y z")]))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in twice.collect()) == [(0, "x y z"), (1, "a b c d e f"), (1, "g h i j k l")]


def test_line_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, SMALL, "documents").collect()]
    want = plain.line_groups(rows)
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in queries.op4_line_dedup(spark, SMALL).collect()}
    assert got.keys() == want.keys()
    assert sum(got[k] == want[k] for k in want) >= 0.995 * len(want)
    # Whatever is joined is joined by pairs at or above the threshold.
    assert all(want[k] == want[got[k]] for k in want)


def test_line_variants(spark):
    draw = random.Random(3)
    letters = "abcdefghij klmnop"
    rows, n = [], 0
    for _ in range(20):
        base = "".join(draw.choices(letters, k=draw.randrange(40, 300))).strip()
        for _ in range(12):
            line = list(base)
            for _ in range(draw.randrange(0, 3)):
                line[draw.randrange(1, len(line) - 1)] = draw.choice("XYZ")
            rows.append((n, "".join(line) + "\n\nshort\n" + "".join(draw.choices(letters, k=30))))
            n += 1
    want = plain.line_groups(rows)
    found = line_dedup.duplicate_lines(plain.documents(spark, rows)).collect()
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in found}
    assert sum(got[k] == want[k] for k in want) >= 0.99 * len(want)
    assert all(want[k] == want[got[k]] for k in want)
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == (r["keep_doc_id"], r["keep_line_no"])) for r in found)


def test_recall_of_bands_by_similarity():
    """Of pairs of lines at a similarity, the share that has a band in common."""
    draw, letters, pairs = random.Random(1), "abcdefghijklmnopqrstuvwxyz     ", {0.8: [], 0.85: [], 0.9: []}
    while min(map(len, pairs.values())) < 400:
        a = "".join(draw.choices(letters, k=draw.randrange(60, 400))).strip()
        b = list(a)
        for _ in range(draw.randrange(1, max(2, len(b) // 28))):
            b[draw.randrange(len(b))] = draw.choice(letters)
        b = "".join(b).strip()
        alike = line_dedup.jaccard(line_dedup.shingles(a, 5), line_dedup.shingles(b, 5))
        for low, found in pairs.items():
            if low <= alike < low + 0.02 and len(found) < 400:
                found.append((a, b))
    settings = line_dedup.Settings()
    for low, least in ((0.8, 0.97), (0.85, 0.99), (0.9, 0.998)):
        left, right = (line_dedup.band_keys(line_dedup.signatures(list(side), settings), settings) for side in zip(*pairs[low]))
        assert (left == right).any(axis=1).mean() >= least


def test_signature_in_stretches(monkeypatch):
    draw = random.Random(2)
    lines = ["".join(draw.choices("abcdef ", k=k)) for k in (1, 4, 5, 6, 100, 700)]
    whole = line_dedup.signatures(lines, line_dedup.Settings())
    monkeypatch.setattr(line_dedup, "STRETCH", 64)
    assert (line_dedup.signatures(lines, line_dedup.Settings()) == whole).all()


def test_line_edges(spark):
    rows = [
        (2, "kept line of some length\nsecond"), (1, "own words only"), (3, "kept line of some length"), (4, None), (5, ""), (6, "  \n"),
        (7, "own words only\r\n\n  second \nnew here"), (1, "own words only"), (None, "second"), (8, "y" * 300_000),
    ]
    out = line_dedup.dedup_lines(plain.documents(spark, rows))
    assert out.columns == plain.documents(spark, rows).columns
    got = [(r["doc_id"], r["text"] if r["doc_id"] != 8 else "") for r in out.orderBy("doc_id").collect() if r["doc_id"] is not None]
    assert got == [
        (1, "own words only"), (1, "own words only"), (2, "kept line of some length\nsecond"), (4, None), (5, ""), (6, "  \n"), (7, "\nnew here"), (8, ""),
    ]
    assert line_dedup.dedup_lines(plain.documents(spark, [])).count() == 0


def brute_vectors(rows):
    sound = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links, groups = {i: 0 for i, _ in rows}, plain.Groups()
    for n, (i, x) in enumerate(sound):
        for j, y in sound[:n]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    return {i: (links[i], groups.find(i)) for i, _ in rows}


def test_vector_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in queries.table(spark, SMALL, "embeddings").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in queries.op10_embeddings(spark, SMALL).collect()}
    assert got == brute_vectors(rows)


def test_vectors_of_every_length(spark):
    """A minority length has links of its own, by lists and compared in whole."""
    draw = np.random.default_rng(6)
    rows = [(i, (v + 0.1 * draw.normal(size=12)).tolist()) for i, v in enumerate(np.repeat(draw.normal(size=(60, 12)), 4, axis=0))]
    rows += [(1000 + i, (v + 0.1 * draw.normal(size=7)).tolist()) for i, v in enumerate(np.repeat(draw.normal(size=(20, 7)), 3, axis=0))]
    rows += [(2000, [1.0, 2.0]), (2001, [2.0, 4.1]), (2002, [-1.0, 2.0]), (3000, [5.0]), (3001, [-5.0]), (3002, [0.5]), (4000, [1.0] * 30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    want = brute_vectors(rows)
    assert sum(n > 0 for n, _ in want.values()) > 200
    for settings in (embeddings.Settings(), embeddings.Settings(few=50, questions=0), embeddings.Settings(few=0, questions=0, block=3)):
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(frame, settings=settings).collect()}
        assert got == want


def test_recall_of_calibrated_probes(spark):
    """Far fewer lists are probed than the bound asks for, and at least 0.99 of the links are found; none is found that is none."""
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(30, 48))
    base = centres[draw.integers(30, size=1200)] * 0.7 + draw.normal(size=(1200, 48))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, base[:900] + draw.normal(size=(900, 48)) * draw.uniform(0.05, 0.3, (900, 1))]))]
    want = brute_vectors(rows)
    settings = embeddings.Settings(few=100, questions=200)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(frame, settings=settings).collect()}
    links = sum(n for n, _ in want.values())
    assert links > 1000 and all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.99 * links


@pytest.mark.parametrize("block", [2048, 5])
def test_dense_vectors(spark, block):
    draw = np.random.default_rng(4)
    rows, n = [], 0
    for _ in range(12):
        centre = draw.normal(size=10)
        for spread in draw.uniform(0, 0.35, 25):
            rows.append((n, [float(np.float32(v)) for v in centre + spread * draw.normal(size=10)]))
            n += 1
    rows += [(n + i, rows[3][1]) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit(1)).repartition(5)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(frame, settings=embeddings.Settings(block=block, few=0, questions=0)).collect()}
    assert got == brute_vectors(rows)


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0, 2.0]), (10, [1.0, 2.0, 3.0]), (9, [1.0, 2.0]), (None, [1.0, 2.0]), (11, [3e38, 3e38])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in embeddings.near_vectors(frame).collect())
    assert got == [(0, 0, 0, True)] + [(i, 0, i, True) for i in range(1, 7)] + [(7, 3, 7, True), (8, 3, 7, False), (9, 3, 7, False), (9, 3, 7, False), (10, 0, 10, True), (11, 0, 11, True)]
    assert embeddings.near_vectors(frame.limit(0)).count() == 0
    assert embeddings.near_vectors(frame.filter("vec_id < 7")).filter("n_links > 0").count() == 0


@given(st.text(alphabet="abcé0Я日 ", min_size=0, max_size=400), st.text(alphabet="abcé0Я日 ", min_size=0, max_size=400))
def test_packed_shingles(a, b):
    width = line_dedup.Settings().width
    a, b = a * 3, (a + b) * 2
    plain_sets = line_dedup.shingles(a, width), line_dedup.shingles(b, width)
    packed = line_dedup.packed_shingles(a, width), line_dedup.packed_shingles(b, width)
    if packed[0] is not None and packed[1] is not None:
        assert line_dedup.packed_jaccard(*packed) == line_dedup.jaccard(*plain_sets)
    if packed[0] is not None:
        assert len(packed[0]) == len(plain_sets[0])


def _member_batches(rows, size):
    """Batches as ``_scan`` reads them: key, block, asks, component, id, line and its sketch."""
    counts, bits = line_dedup.sketches([r[5] for r in rows], 5)
    for i in range(0, len(rows), size):
        part = rows[i: i + size]
        arrays = [pa.array(c) for c in zip(*part)]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array(counts[i: i + size]), pa.array([b.tobytes() for b in bits[i: i + size]], pa.binary())],
            names=["key", "block", "asks", "component", "id", "line", "n", "sketch"],
        )


def test_scan_packs_only_lines_it_compares(monkeypatch):
    rng, packed = random.Random(5), []
    pack = line_dedup.packed_shingles
    monkeypatch.setattr(line_dedup, "packed_shingles", lambda line, width: packed.append(line) or pack(line, width))

    def line():
        return "".join(rng.choice("abcdefghijklmnop ") for _ in range(200))

    twin = line()
    rows = [(1, 0, False, i, i, line()) for i in range(20)] + [(2, 0, False, 30, 30, twin), (2, 0, False, 31, 31, line()), (2, 0, False, 32, 32, twin + "x")]
    links = [(r["a"], r["b"]) for b in line_dedup._scan(line_dedup.Settings())(_member_batches(rows, 7)) for r in b.to_pylist()]
    assert links == [(32, 30)] and sorted(packed) == sorted([twin, twin + "x"])


def test_buckets_of_any_batches():
    """Keys that go on from batch to batch, also past the number of rows looked at together; one leader to a key."""
    rng = np.random.default_rng(3)
    key = np.sort(np.concatenate([rng.integers(0, 60_000, 100_000), np.full(90_000, 30_000)]))
    ids = rng.integers(0, 5_000, len(key))

    def found(size):
        batches = (pa.RecordBatch.from_arrays([pa.array(key[i: i + size]), pa.array(ids[i: i + size])], names=["key", "id"]) for i in range(0, len(key), size))
        out = list(line_dedup._buckets(batches))
        return len(out), sorted((r["key"], r["leader"], r["id"]) for b in out for r in b.to_pylist())

    (few, rows), (_, whole) = found(1000), found(len(key))
    members: dict[int, list[int]] = {}
    for k, i in zip(key.tolist(), ids.tolist()):
        members.setdefault(k, []).append(i)
    expected = sorted((k, m[0], i) for k, m in members.items() if len(set(m)) > 1 for i in [m[0], *(x for x in m if x != m[0])])
    assert rows == whole == expected and few <= 4


def test_shares_of_hashes():
    g = np.random.default_rng(2).integers(0, 1 << 32, 5000, dtype=np.uint32)
    g[:2] = 0, (1 << 32) - 1
    for n in (1, 2, 3, 48, 64, 128):
        assert line_dedup._share(g, n).tolist() == [x * n >> 32 for x in g.tolist()]
