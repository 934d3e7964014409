"""Exact duplicates: frequent digests by broadcast, the others by an ordinary shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.staging import staged

#: What is deleted before texts are compared.
BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = 4096, candidates: int = 1024
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are identical without blanks. Of equal texts that with the most code points
    stays, then that with the smallest id (a null id comes last).

    * Digests are written once; everything else reads this narrow table.
    * A Misra-Gries summary (``tracked`` counters, merged over tasks) names the ``candidates`` digests of the highest estimates; a
      digest that fills more than a ``candidates``-th of all rows, and with room for what the counters err, is among them. The
      true count and the winner of every candidate are then aggregated from all rows; those that fill more than a
      ``tracked``-th are broadcast, at most ``candidates`` rows, and their documents leave the data before any shuffle.
    * All other digests are grouped and joined by shuffle.

    Null texts count as empty. Rows that repeat an id are told apart by their number of code points; a row that repeats both is
    the same document and gets the same answer. An empty table gives an empty result; columns other than the two named are not read.
    """
    rows, _ = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.sha2(normalised(F.col(text_col)).cast("binary"), 256).alias("digest"),
            F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("points"),
        ),
        "digests",
    )
    best = F.min(F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id")).alias("best")
    summary = rows.agg(F.expr(f"approx_top_k(digest, {candidates}, {tracked})").alias("found"), F.count("*").alias("total"))
    named = summary.select("total", F.explode("found.item").alias("digest"))
    frequent = (
        rows.join(F.broadcast(named), "digest")
        .groupBy("digest").agg(best, F.count("*").alias("group_size"), F.first("total").alias("total"))
        .filter(F.col("group_size") > F.greatest(F.lit(1), F.floor(F.col("total") / tracked)))
        .drop("total")
    )
    winners, _ = staged(frequent, "winners")  # at most `candidates` rows
    heavy = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    light = rest.join(rest.groupBy("digest").agg(best, F.count("*").alias("group_size")), "digest")
    kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("points") == -F.col("best.less"))
    return heavy.unionByName(light).select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))
