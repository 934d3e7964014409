"""Near-duplicate vectors: inverted lists with product-quantised residuals, then exact cosines."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.components import connected_components, stars
from panelcast.llm.staging import drop, small_batches, staged


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the distinct vectors that the quantisers are fitted on (their expected number; drawn by a hash of the
    vector). There are about as many inverted lists as the root of the number of vectors, ``most_lists`` at most.

    How far lists are probed is calibrated on ``questions`` vectors (expected; 0 for the bound that loses no link), whose links among all
    vectors are found exhaustively: as far as finds ``recall`` of their links, a question's links counting one in all. Where fewer than
    ``least_asked`` of them have a link, the bound is kept. Lengths of ``few`` vectors or less are compared without lists.
    """

    cosine: float = 0.95
    sample_rows: int = 20_000
    most_lists: int = 4096
    subspaces: int = 8
    codewords: int = 256
    rounds: int = 8
    block: int = 2048
    questions: int = 1024
    recall: float = 1.0
    least_asked: int = 30
    few: int = 2048


@dataclass(frozen=True)
class Quantiser:
    """Coarse centroids, and for each subspace (columns from edge to edge) the codewords of residuals."""

    centroids: np.ndarray
    edges: tuple[int, ...]
    codewords: tuple[np.ndarray, ...]


def usable(vector: Column, identifier: Column) -> Column:
    """Whether a vector can link: not null, without null or non-finite components, not all zero, and its row has an id."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(identifier.isNotNull() & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of every row of x to every row of c."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1), 0)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(x[i: i + 1024], c).argmin(1) for i in range(0, len(x), 1024)]) if len(x) else np.zeros(0, np.int64)


def k_means(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Lloyd's centroids from evenly spaced rows; a centroid without rows stays where it is."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def fit_quantiser(x: np.ndarray, lists: int, settings: Settings) -> Quantiser:
    """Of unit vectors, one per row."""
    centroids = k_means(x, lists, settings.rounds)
    rest = x - centroids[_nearest(x, centroids)]
    parts = max(1, min(settings.subspaces, x.shape[1]))
    edges = tuple(x.shape[1] * i // parts for i in range(parts + 1))
    return Quantiser(centroids, edges, tuple(k_means(rest[:, a:b], settings.codewords, settings.rounds) for a, b in zip(edges, edges[1:])))


def _unit(raw: list[bytes], dims: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(-1, dims)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # the square of a huge component would overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _doubles(batches):
    """The vector column as bytes of doubles."""
    for batch in batches:
        out = [np.array(v, np.float64).tobytes() for v in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["node", "vector"])


def _lists(q: Quantiser, dims: int):
    """Per task and list: how many vectors it has and how far the farthest lies."""

    def run(batches):
        n, far = np.zeros(len(q.centroids), np.int64), np.zeros(len(q.centroids))
        for batch in batches:
            if batch.num_rows:
                x = _unit(batch.column(0).to_pylist(), dims)
                near = _nearest(x, q.centroids)
                n += np.bincount(near, minlength=len(n))
                np.maximum.at(far, near, np.sqrt(((x - q.centroids[near]) ** 2).sum(1)))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), pa.array(far[used])], names=["list", "n", "far"])

    return run


SEARCH = "list int, block int, asks boolean, node long, copies long, vector binary, code binary, error double"


#: Steps between no part and the whole of a distance that are told apart.
STEPS = 256


def _planes(q: Quantiser) -> np.ndarray:
    """Twice the distances between centroids."""
    return 2 * np.sqrt(_squares(q.centroids, q.centroids))


def _margins(q: Quantiser, dims: int, asked: np.ndarray, names: np.ndarray, cosine: float):
    """Links of the vectors ``asked`` with all others, by question and by how far the plane before the other's list lies, in steps of the
    distance between the two vectors: which does not depend on how near the links of the sample are."""
    planes, d2 = _planes(q), _squares(asked, q.centroids)
    near = d2.argmin(1)

    def run(batches):
        counts = np.zeros((len(asked), STEPS + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                y, nodes = _unit(batch.column(1).to_pylist(), dims), batch.column(0).to_numpy()
                alike = asked @ y.T
                a, b = np.nonzero(alike >= cosine)
                keep = names[a] != nodes[b]
                a, b = a[keep], b[keep]
                lists, apart = _nearest(y, q.centroids)[b], np.sqrt(np.maximum(2 - 2 * alike[a, b], 1e-12))
                gap = planes[near[a], lists]
                away = np.divide(d2[a, lists] - d2[a, near[a]], gap, out=np.zeros(len(a)), where=gap > 0)
                np.add.at(counts, (a, np.clip(np.ceil(away / apart * STEPS), 0, STEPS).astype(np.int64)), 1)
        who, step = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(step), pa.array(counts[who, step])], names=["who", "step", "n"])

    return run


def probe_margin(packed: DataFrame, q: Quantiser, dims: int, n: int, reach: float, settings: Settings) -> float:
    """How far from a question the plane before a list may lie for the list to be probed; ``reach`` at most.

    The direction from a vector to one that it links with is seldom that of a list, so the plane is a small part of their distance away.
    That part is taken from the sample, and the distance from the farthest link there can be.
    """
    rate = min(1.0, settings.questions / n)
    drawn = packed.filter(F.pmod(F.xxhash64("vector", F.lit(1)), F.lit(1 << 30)) < int(rate * (1 << 30))).select("node", "vector")
    asked = drawn.limit(4 * settings.questions).collect()  # a draw by hash has no more, but for chance
    if not asked:
        return reach
    names, unit = np.array([r["node"] for r in asked]), _unit([bytes(r["vector"]) for r in asked], dims)
    found = (
        packed.select("node", "vector").mapInArrow(_margins(q, dims, unit, names, settings.cosine), "who long, step long, n long")
        .groupBy("who", "step").agg(F.sum("n").alias("n")).collect()
    )
    counts = np.zeros((len(asked), STEPS + 1))
    for who, step, links in found:
        counts[who, step] = links
    counts = counts[counts.sum(axis=1) > 0]
    if len(counts) < settings.least_asked:
        return reach
    share = (counts / counts.sum(axis=1, keepdims=True)).mean(axis=0).cumsum()
    return reach * min(STEPS, int(np.searchsorted(share, settings.recall - 1e-9)) + 1) / STEPS


def _entries(q: Quantiser, dims: int, blocks: np.ndarray, far: np.ndarray, reach: float, margin: float, block_rows: int):
    """Every vector once as an entry of its list, and as a question to each list that may hold a link of it.

    ``y`` links with ``x`` only if it lies within ``reach``. If it is in the list of c while x is nearest to c0, the plane between c
    and c0 is within reach of x, and c is no farther from x than its farthest entry plus reach. Lists that fail
    either test hold no link. Most links are far nearer to the plane than that, so lists are probed up to ``margin``; where
    it is the reach, no link is lost.
    """
    gaps = _planes(q) / 2

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            node, raw = batch.column(0).to_numpy(), batch.column(2).to_pylist()
            x = _unit(raw, dims)
            d2 = _squares(x, q.centroids)
            near = d2.argmin(1)
            rest = x - q.centroids[near]
            codes, shown = np.zeros((len(x), len(q.codewords)), np.uint8), np.zeros_like(x)
            for i, (a, b) in enumerate(zip(q.edges, q.edges[1:])):
                codes[:, i] = _nearest(rest[:, a:b], q.codewords[i])
                shown[:, a:b] = q.codewords[i][codes[:, i]]
            error = np.sqrt(((rest - shown) ** 2).sum(1))
            own = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks[near]
            probe = (d2 - d2[np.arange(len(x)), near][:, None] <= 2 * margin * gaps[near] + 1e-9) & (np.sqrt(d2) <= far + reach + 1e-9) & (blocks > 0)
            who, where = np.nonzero(probe)
            n = blocks[where]
            who, where = np.repeat(who, n), np.repeat(where, n)
            part = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            take = np.concatenate([np.arange(len(x)), who])
            asks = np.arange(len(take)) >= len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([near, where]), pa.int32()), pa.array(np.concatenate([own, part]), pa.int32()), pa.array(asks),
                    batch.column(0).take(pa.array(take)), batch.column(1).take(pa.array(take)), batch.column(2).take(pa.array(take)),
                    pa.array([codes[t].tobytes() if not s else None for t, s in zip(take, asks)], pa.binary()), pa.array(error[take]),
                ],
                names=["list", "block", "asks", "node", "copies", "vector", "code", "error"],
            )

    return run


def _search(q: Quantiser, dims: int, reach: float, cosine: float):
    """Links of every question with the entries of a list's block, from rows sorted by (list, block, asks).

    Distances to entries are read from tables per question and subspace. An entry is nearer than its coded form by its error at
    most, so what the tables put beyond reach plus error is no link; the others are compared exactly, in doubles.
    """

    def scan(table, asks):
        nodes, copies, y, codes, error, at = table
        counts, pairs = np.zeros(len(asks[0]), np.int64), []
        for i in range(0, len(asks[0]), 256):
            x = asks[1][i: i + 256]
            rest = x - q.centroids[at]
            d2 = np.zeros((len(x), len(nodes)))
            for m, (a, b) in enumerate(zip(q.edges, q.edges[1:])):
                d2 += _squares(rest[:, a:b], q.codewords[m])[:, codes[:, m]]
            u, v = np.nonzero(d2 <= (reach + error + 1e-6) ** 2)
            for j in range(0, len(u), 1 << 16):
                a, b = u[j: j + (1 << 16)], v[j: j + (1 << 16)]
                close = ((x[a] * y[b]).sum(1) >= cosine) & (asks[0][i + a] != nodes[b])
                a, b = a[close], b[close]
                np.add.at(counts, i + a, copies[b])
                if len(a):
                    pairs.append(stars(asks[0][i + a], nodes[b]))
        return counts, pairs

    def run(batches):
        key, table = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            at, block, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            node, copies = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            x, error, codes = _unit(batch.column(5).to_pylist(), dims), batch.column(7).to_numpy(), batch.column(6)
            cuts = np.flatnonzero((at[1:] != at[:-1]) | (block[1:] != block[:-1])) + 1
            a_out, b_out, n_out = [], [], []
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                middle = s + int((~asks[s:e]).sum())
                if key != (at[s], block[s]):
                    key, table = (at[s], block[s]), None
                if middle > s:
                    c = np.frombuffer(b"".join(codes.slice(s, middle - s).to_pylist()), np.uint8).reshape(middle - s, -1)
                    new = (node[s:middle], copies[s:middle], x[s:middle], c, error[s:middle])
                    old = table[:5] if table is not None else None
                    table = (*(new if old is None else tuple(np.concatenate(p) for p in zip(old, new))), int(at[s]))
                if e > middle and table is not None:
                    counts, pairs = scan(table, (node[middle:e], x[middle:e]))
                    hit = counts > 0
                    a_out.append(node[middle:e][hit])
                    b_out.append(np.full(int(hit.sum()), -1))
                    n_out.append(counts[hit])
                    for a, b in pairs:
                        a_out.append(a)
                        b_out.append(b)
                        n_out.append(np.zeros(len(a), np.int64))
            if a_out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in (a_out, b_out, n_out)], names=["a", "b", "n"])

    return run


def _exhaustive(cosine: float):
    """Links among all vectors of one length, which are few: as :func:`_search` gives them."""

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("node").to_numpy())
        node, copies = (table.column(c).to_numpy()[order] for c in ("node", "copies"))
        x = _unit([table.column("vector")[i].as_py() for i in order.tolist()], int(table.column("dims")[0].as_py()))
        near = x @ x.T >= cosine
        np.fill_diagonal(near, False)
        n = (near * copies).sum(axis=1)
        hit = n > 0
        a, b = stars(*(node[side] for side in np.nonzero(near)))
        columns = [np.concatenate(c).astype(np.int64) for c in ((node[hit], a), (np.full(int(hit.sum()), -1), b), (n[hit], np.zeros(len(a))))]
        return pa.table([pa.array(c) for c in columns], names=["a", "b", "n"])

    return run


def _of_length(packed: DataFrame, dims: int, n: int, settings: Settings) -> DataFrame:
    """Links among vectors of one length, by inverted lists: ``a, b`` or, with b = -1, the number ``n`` of a's links."""
    lists = max(1, min(settings.most_lists, round(n**0.5)))
    rate = min(1.0, settings.sample_rows / n)

    def fitted(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("node").to_numpy())
        q = fit_quantiser(_unit([table.column("vector")[i].as_py() for i in order.tolist()], dims), lists, settings)
        parts = [q.centroids, *q.codewords]
        return pa.table({"part": pa.array(range(len(parts)), pa.int32()), "numbers": pa.array([p.tobytes() for p in parts], pa.binary())})

    sample = packed.filter(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(rate * (1 << 30)) + 1).select("node", "vector")
    parts = {
        r["part"]: np.frombuffer(r["numbers"], np.float64)
        for r in sample.groupBy(F.lit(0).alias("all")).applyInArrow(fitted, "part int, numbers binary").collect()  # bounded by the settings
    }
    if not parts:  # so few vectors that none was drawn
        raise ValueError("the sample is empty; raise sample_rows")
    many = max(1, min(settings.subspaces, dims))
    edges = tuple(dims * i // many for i in range(many + 1))
    q = Quantiser(parts[0].reshape(-1, dims), edges, tuple(parts[i + 1].reshape(-1, b - a) for i, (a, b) in enumerate(zip(edges, edges[1:]))))

    blocks, far = np.zeros(len(q.centroids), np.int64), np.zeros(len(q.centroids))
    for at, count, distance in packed.select("vector").mapInArrow(_lists(q, dims), "list long, n long, far double").groupBy("list").agg(F.sum("n"), F.max("far")).collect():
        blocks[at], far[at] = -(-count // settings.block), distance
    reach = (2 - 2 * settings.cosine) ** 0.5
    margin = probe_margin(packed, q, dims, n, reach, settings) if settings.questions else reach
    return (
        packed.select("node", "copies", "vector").mapInArrow(_entries(q, dims, blocks, far, reach, margin, settings.block), SEARCH)
        .repartition("list", "block").sortWithinPartitions("list", "block", "asks")
        .mapInArrow(_search(q, dims, reach, settings.cosine), FOUND)
    )


FOUND = "a long, b long, n long"


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors link at a cosine of ``settings.cosine`` or more, computed in doubles. Equal vectors are one class, compared once and
    counted as many times as there are rows. The quantisers are fitted on a bounded sample, every vector is indexed, and
    every vector asks. Lists are probed as far as a calibrated margin (see :class:`Settings`); table distances only leave out what
    provably is no link, and what they leave is compared exactly. Links of a list are counted and reduced to a spanning forest
    where they are found.

    Only vectors of one length are compared; every length that more than ``settings.few`` distinct vectors have gets lists of its own, the
    others are compared in whole. Vectors that are null, empty, all zero, have a null or non-finite component, or a null id, link
    with nothing. Rows that repeat an id are answered each for itself. An empty table gives an empty result; other columns
    are not read.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("sound", usable(F.col("vector"), F.col("vec_id")))
    classes, at_classes = staged(
        rows.filter("sound").groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()).withColumn("dims", F.size("vector")),
        "vectors",
    )
    packed, at_packed = staged(
        classes.select("node", "vector").mapInArrow(_doubles, "node long, vector binary").join(classes.select("node", "copies", "dims"), "node")
        .select("node", "copies", "vector", "dims"),
        "doubles",
    )
    counts = {r["dims"]: r["count"] for r in packed.groupBy("dims").count().collect()}  # one row per length
    many = sorted(d for d, n in counts.items() if n > settings.few)
    parts = [_of_length(packed.filter(F.col("dims") == d), d, counts[d], settings) for d in many]
    if len(counts) > len(many):
        parts.append(packed.filter(~F.col("dims").isin(many)).groupBy("dims").applyInArrow(_exhaustive(settings.cosine), FOUND))
    found, at_found = staged(reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], FOUND), "vector-links")
    counts = found.filter("b < 0").groupBy("a").agg(F.sum("n").alias("n"))
    named = classes.join(connected_components(found.filter("b >= 0").select("a", "b")), "node", "left").withColumn("group", F.coalesce("component", "node"))
    least = named.groupBy("group").agg(F.min("rep").alias("component_id"))
    done, _ = staged(
        named.join(least, "group").join(counts, F.col("node") == F.col("a"), "left").select(
            "vector", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"
        ),
        "vector-classes",
    )
    drop(spark, at_classes, at_packed, at_found)
    linked = rows.filter("sound").select("vec_id", "vector").join(done, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
