"""Connected components over links that are never gathered in one place."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.staging import drop, staged

LINKS = "a long, b long"


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over a block of links: each node with the smallest of its component (which itself is left out)."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(names))
    return names[moved], names[root[moved]]


def _reduce(batches):
    for batch in batches:
        a, b = stars(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _hook(links: DataFrame, to_self: bool) -> DataFrame:
    """Join every neighbour of ``a`` to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    out = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if to_self:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b")


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node) for every node that has a link and is not the smallest itself.

    ``links`` has two long columns ``a`` and ``b``; nulls and self-links are left out. Links are first reduced to
    stars within each batch by union-find; then every round joins larger neighbours to the smallest neighbour and
    smaller ones likewise (large star, small star), until nothing changes. Rounds grow with the logarithm of the
    longest chain. A round is a grouped minimum, which is summed before the shuffle, and a join, whose
    large partitions Spark may split; so a node with very many links does not meet in one task. Each round is
    written to the shared folder and the one before deleted.
    """
    spark = links.sparkSession
    a, b = links.columns
    now, path = staged(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
        .mapInArrow(_reduce, LINKS).distinct(),
        "links",
    )
    mark = F.struct(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.min("a"), F.max("b"))
    before, paths = now.agg(mark).first()[0], [path]
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: the larger neighbours of a node go to the least of the node and its neighbours.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        )
        # Small star: a node and its smaller neighbours go to the least of them.
        after, path = staged(_hook(large, True).distinct(), "links")
        mark_now = after.agg(mark).first()[0]
        if mark_now == before:
            drop(spark, path)
            break
        drop(spark, paths.pop())
        now, before = after, mark_now
        paths.append(path)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def with_least(components: DataFrame) -> DataFrame:
    """``node, component`` with a row for each component's smallest node as well."""
    return components.unionByName(components.select(F.col("component").alias("node"), "component").distinct())
