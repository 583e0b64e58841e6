"""Exact histogram of encoded lengths and what follows from it for every context limit.

Documents are counted by encoded length; sums from the longest length down (suffix sums) then give,
for any limit, how many documents exceed it and how many ids are left after truncation.

Results for odd input: null and empty texts have length 0; repeated rows count each; an empty table
gives an empty histogram; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm import bpe
from vitalframe.llm.common import written

# Running sums go through blocks of this many lengths, so that no window holds all lengths.
BLOCK = 1024


def encoded_lengths(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """One row per document: its number of ids."""
    return bpe.encode(docs, path, text, keep=()).select((F.length("ids") / bpe.ID_BYTES).cast("long").alias("length"))


def histogram(lengths: DataFrame) -> DataFrame:
    """Per length that occurs: docs, and the suffix sums docs_longer and ids_longer (lengths above it),
    docs_total and ids_total, and truncated_total (ids left when documents are cut at this length)."""
    # written once, as both the lengths and their blocks are made from them
    counts = written(lengths.groupBy("length").agg(F.count("*").alias("docs")), "lengths")
    counts = counts.withColumn("ids", F.col("length") * F.col("docs")).withColumn("block", F.floor(F.col("length") / BLOCK))
    # one row per block: as many as the longest text has thousands of ids
    blocks = counts.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum("ids").alias("block_ids"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(above), F.lit(0)).alias("above_docs"),
        F.coalesce(F.sum("block_ids").over(above), F.lit(0)).alias("above_ids"),
        F.sum("block_docs").over(everything).alias("docs_total"),
        F.sum("block_ids").over(everything).alias("ids_total"),
    )
    longer = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    summed = counts.join(blocks, "block").select(
        "length", "docs", "docs_total", "ids_total",
        (F.col("above_docs") + F.coalesce(F.sum("docs").over(longer), F.lit(0))).alias("docs_longer"),
        (F.col("above_ids") + F.coalesce(F.sum("ids").over(longer), F.lit(0))).alias("ids_longer"),
    )
    return summed.withColumn("truncated_total", F.col("ids_total") - F.col("ids_longer") + F.col("docs_longer") * F.col("length"))


def truncated_totals(hist: DataFrame, limits: Sequence[int]) -> DataFrame:
    """For each limit: documents above it and ids left after truncation, from the histogram alone."""
    asked = F.explode(F.array(*(F.lit(int(n)).cast("long") for n in limits))).alias("limit")
    over = F.col("length") > F.col("limit")
    return (
        hist.select("length", "docs", asked)
        .groupBy("limit")
        .agg(
            F.coalesce(F.sum(F.when(over, F.col("docs"))), F.lit(0)).alias("docs_longer"),
            F.sum(F.least("length", "limit") * F.col("docs")).alias("truncated_total"),
        )
    )


def quantiles(hist: DataFrame, shares: Sequence[float]) -> DataFrame:
    """For each share: the smallest length that at least this share of the documents does not exceed."""
    asked = F.explode(F.array(*(F.lit(float(p)) for p in shares))).alias("share")
    reached = F.col("docs_total") - F.col("docs_longer") >= F.ceil(F.col("share") * F.col("docs_total"))
    return hist.select("*", asked).where(reached).groupBy("share").agg(F.min("length").alias("length"))
