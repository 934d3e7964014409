"""Hard negatives of a set of anchors, by bounds from means and deviations of vector segments."""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.staging import scratch, small_batches, staged

#: Segments per vector, from coarse to fine; each level is asked only about what the one before could not rule out.
LEVELS = (1, 4, 16)
#: Anchors that a scan answers at once, and bytes of their vectors: what is broadcast.
ANCHORS, ANCHOR_BYTES = 4096, 32 << 20
LAST_ID = (1 << 63) - 1
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Components up to here give scores that doubles hold exactly; others are multiplied as Python's integers.
EXACT = float(1 << 20)


def summary(values: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row and segment: the mean, times the root of the segment's length, and the norm of what deviates from it."""
    edges = np.unique(np.linspace(0, values.shape[1], segments + 1).astype(np.int64))
    size = np.diff(edges)
    if not len(size):
        return np.zeros((len(values), 0)), np.zeros((len(values), 0))
    mean = np.add.reduceat(values, edges[:-1], axis=1) / size
    deviation = np.sqrt(np.add.reduceat((values - np.repeat(mean, size, axis=1)) ** 2, edges[:-1], axis=1))
    return mean * np.sqrt(size), deviation


def summaries(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    return [summary(values, segments) for segments in LEVELS]


def _stored(values: np.ndarray) -> np.ndarray:
    """Summaries of all levels side by side."""
    return np.concatenate([part for level in summaries(values) for part in level], axis=1)


def _read(stored: list[bytes], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """What :func:`_stored` put together, of rows whose vectors have ``length`` components."""
    widths = [min(segments, length) for segments in LEVELS for _ in range(2)]
    table = np.frombuffer(b"".join(stored)).reshape(len(stored), sum(widths))
    parts = np.split(table, np.cumsum(widths)[:-1], axis=1)
    return list(zip(parts[::2], parts[1::2]))


def bounds(left, right) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of inner products, from summaries of both sides at one level."""
    middle, reach = left[0] @ right[0].T, left[1] @ right[1].T
    reach += 1e-9 * (np.abs(middle) + reach) + 1e-6  # rounding
    return middle - reach, middle + reach


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers as 64-bit integers; larger ones stop at the ends of the range."""
    top = max(np.abs(left).max(initial=0), np.abs(right).max(initial=0))
    if top <= EXACT and left.shape[1] < 1 << 13:
        return (left @ right.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in side.tolist()], object).reshape(side.shape) for side in (left, right)]
    exact = whole[0].dot(whole[1].T).reshape(len(left), len(right)) if left.shape[1] else np.zeros((len(left), len(right)), object)
    return np.clip(exact, LEAST, MOST).astype(np.int64)


class Best:
    """The ``size`` best (score, id) pairs of each list: higher scores first, then smaller ids; a pair counts once."""

    def __init__(self, lists: int, size: int) -> None:
        self.size = size
        self.of, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        #: Scores below this cannot enter a list.
        self.least = np.full(lists, LEAST, np.int64)

    def add(self, of: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        useful = score >= self.least[of]
        if not useful.any():
            return
        of, score, id_ = (np.concatenate([a, b[useful]]) for a, b in ((self.of, of), (self.score, score), (self.id, id_)))
        order = np.lexsort((id_, -1 - score, of))
        of, score, id_ = of[order], score[order], id_[order]
        once = np.ones(len(of), bool)
        once[1:] = (of[1:] != of[:-1]) | (score[1:] != score[:-1]) | (id_[1:] != id_[:-1])
        of, score, id_ = of[once], score[once], id_[once]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        keep = rank < self.size
        self.of, self.score, self.id = of[keep], score[keep], id_[keep]
        full = rank[keep] == self.size - 1
        self.least[self.of[full]] = self.score[full]


def _matrix(lists: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of each vector length: their numbers and their components."""
    at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    size = np.diff(at)
    out = {}
    for length in np.unique(size).tolist():
        rows = np.flatnonzero(size == length)
        out[length] = rows, flat[at[rows][:, None] + np.arange(length)]
    return out


def _search(block, wanted, choose):
    """Scan rows ``id, label, vector, summary`` for the best of every list.

    ``wanted(of, best)`` gives, for the anchors ``of``, the scores below and above which a row is of no use; ``choose`` puts pairs (anchor, score, id) into lists.
    ``block`` holds, per vector length, the anchors' numbers, ids, labels, components and whether labels must agree.
    """

    def run(batches):
        anchors, same, lists, size = block.value
        sides = {length: (*a, summaries(a[3])) for length, a in anchors.items()}
        best = Best(lists, size)
        for batch in batches:
            ids, labels, stored = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            for length, (rows, values) in _matrix(batch.column(2)).items():
                if length not in sides:
                    continue
                of, own, own_label, own_values, levels = sides[length]
                plain = max(np.abs(values).max(initial=0), np.abs(own_values).max(initial=0)) <= EXACT
                alive = ((own_label[:, None] == labels[rows]) == same) & (own[:, None] != ids[rows])
                least, most = wanted(of, best)
                for own_level, level in zip(levels, _read(stored[rows].tolist(), length) if plain else ()):
                    seen = np.flatnonzero(alive.any(axis=0))
                    low, high = bounds(own_level, [part[seen] for part in level])
                    alive[:, seen] &= (high >= least[:, None]) & (low <= most[:, None])
                # Rows and anchors that nothing is left of go; of the others, pairs that are ruled out are not chosen.
                seen, asking = np.flatnonzero(alive.any(axis=0)), np.flatnonzero(alive.any(axis=1))
                if len(seen):
                    scores = products(own_values[asking], values[seen])
                    a, r = np.nonzero(alive[np.ix_(asking, seen)])
                    choose(best, of[asking[a]], scores[a, r], ids[rows[seen[r]]])
        if len(best.of):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (best.of, best.score, best.id)], names=["list", "score", "id"])

    return run


def _positives(best, of, score, id_):
    best.add(of, score, id_)


def _ranked(found: DataFrame, size: int) -> DataFrame:
    """The best of what the tasks found: at most ``size`` rows per list and task come here."""
    order = Window.partitionBy("list").orderBy(F.desc("score"), "id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, anchors_at_once: int = ANCHORS,
) -> DataFrame:
    """For every anchor and each of its positives, the best rows of other labels whose score is ``low`` to ``high`` per cent of the positive's.

    Returns ``anchor_id, positive_id, rank`` (from 1)``, negative_id, positive_score, negative_score``. A component x counts as
    floor(scale * x), a score is the exact inner product; higher scores come first, then smaller ids. Positives are the best other
    rows of the anchor's label. A positive with a negative score has no negatives.

    * Rows are written once to the shared folder: whole numbers, with the mean and deviation of every segment at each level.
    * Anchors go to all tasks in blocks of bounded size, and every block meets all rows in two scans: one for positives, one for negatives. No
      row is shuffled; a task gives away the best few of each list, which a window ranks.
    * In a scan, the products of segment means plus or minus those of deviations bound every score; what could still enter a list is
      looked at in finer segments, then scored.

    Rows with a null label or vector, or a null or non-finite component, take no part. Only vectors of the anchor's length are compared.
    A row with the anchor's id is not another row, rows that repeat id and score count once, and anchors that repeat id, label and vector are one.
    A null id comes last among ties and is null in the result. Scores beyond 64 bits stop at the ends of that range. An empty
    table, or one without anchors, gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows, _ = staged(
        vectors.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.col(label_col).cast("long").alias("label"),
            F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        ).mapInArrow(_scaled(scale), "id long, label long, vector array<double>, summary binary, asks boolean"),
        "scaled",
    )
    scanned = rows.select("id", "label", "vector", "summary")
    path, blocks = scratch(spark, "mined"), 0
    asking = rows.filter("asks").select("id", "label", "vector").distinct().toLocalIterator()
    while block := _next_block(asking, anchors_at_once):
        _mine(scanned, block, positives, negatives, low, high).write.mode("append").parquet(path)
        blocks += 1
    return spark.read.schema(MINED).parquet(path) if blocks else spark.createDataFrame([], MINED)


def _next_block(rows, most: int):
    """The next anchors, as many as the bounds on rows and bytes allow."""
    block, size = [], 0
    for row in islice(rows, most):
        block.append(row)
        size += 8 * len(row["vector"])
        if size >= ANCHOR_BYTES:
            break
    return block


def _scaled(scale: int):
    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            values = np.floor(scale * lists.values.to_numpy(zero_copy_only=False))
            vectors, stored = pa.ListArray.from_arrays(lists.offsets, pa.array(values)), np.empty(len(lists), object)
            for rows, components in _matrix(vectors).values():
                for row, parts in zip(rows.tolist(), _stored(components)):
                    stored[row] = parts.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), vectors, pa.array(stored, pa.binary()), batch.column(3)],
                names=["id", "label", "vector", "summary", "asks"],
            )

    return run


def _mine(scanned: DataFrame, block, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark, found = scanned.sparkSession, "list long, score long, id long"
    sides = {}
    for length in {len(r["vector"]) for r in block}:
        of = [i for i, r in enumerate(block) if len(r["vector"]) == length]
        sides[length] = (
            np.array(of), np.array([block[i]["id"] for i in of]), np.array([block[i]["label"] for i in of]),
            np.array([block[i]["vector"] for i in of], np.float64).reshape(len(of), length),
        )
    everything = np.full(len(block), MOST)
    near = spark.sparkContext.broadcast((sides, True, len(block), positives))
    best = _ranked(
        scanned.mapInArrow(_search(near, lambda of, best: (best.least[of], everything[of]), _positives), found), positives
    ).collect()  # a few rows per anchor of the block

    # List number of (anchor, its k-th positive): anchor * positives + k.
    least, most, names = np.full(len(block) * positives, MOST), np.full(len(block) * positives, LEAST), []
    for row in best:
        at = row["list"] * positives + row["rank"] - 1
        if row["score"] >= 0:
            least[at], most[at] = -(-low * row["score"] // 100), high * row["score"] // 100
        id_ = block[row["list"]]["id"]
        names.append((at, id_, None if row["id"] == LAST_ID else row["id"], row["score"]))

    def wanted(of, best):
        lists = of[:, None] * positives + np.arange(positives)
        return np.maximum(least, best.least)[lists].min(axis=1), most[lists].max(axis=1)

    def choose(best, of, score, id_):
        for k in range(positives):
            lists = of * positives + k
            inside = (score >= least[lists]) & (score <= most[lists])
            best.add(lists[inside], score[inside], id_[inside])

    far = spark.sparkContext.broadcast((sides, False, len(block) * positives, negatives))
    ranked = _ranked(scanned.mapInArrow(_search(far, wanted, choose), found), negatives)
    named = spark.createDataFrame(names, "list long, anchor_id long, positive_id long, positive_score long")
    return ranked.join(F.broadcast(named), "list").select(
        "anchor_id", "positive_id", "rank", F.nullif("id", F.lit(LAST_ID)).alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
