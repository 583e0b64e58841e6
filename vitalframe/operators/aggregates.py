"""Counting, shares, length statistics and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage of two counts, halves rounded up; NULL for an empty whole."""
    p, w = part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0))
    return F.round(p * F.lit(100.0) / w, digits)


def value_counts(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    return counts.orderBy(F.desc(name), *keys)


def share_of_total(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group counts and their share of all rows; the total is an aggregate of its own, so any number of groups does."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("count"))
    whole = df.agg(F.count("*").alias("_all"))
    joined = counts.crossJoin(F.broadcast(whole))  # one row
    return joined.withColumn("percentage", share(F.col("count"), F.col("_all"))).drop("_all").orderBy(F.desc("count"), *keys)


def share_within(df: DataFrame, parent: str, child: str) -> DataFrame:
    counts = df.groupBy(parent, child).agg(F.count("*").alias("count_val"))
    whole = F.sum("count_val").over(W.partitionBy(parent))
    return counts.withColumn("percentage", share(F.col("count_val"), whole)).orderBy(parent, F.desc("count_val"), child)


def count_if(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = (), total: str = "total") -> DataFrame:
    """Row count and one conditional count per name, in a single pass."""
    aggs = [F.count("*").alias(total), *[F.count_if(c).alias(n) for n, c in conditions.items()]]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def length_stats(df: DataFrame, columns: Mapping[str, str], limit: int = 8192) -> DataFrame:
    """Length statistics per ``{column: short name}`` plus joint token estimate (four characters a token)."""
    lengths = {short: F.length(col) for col, short in columns.items()}
    aggs = []
    for short, n in lengths.items():
        aggs += [
            F.round(F.avg(n), 0).alias(f"avg_{short}_chars"),
            F.min(n).alias(f"min_{short}_chars"),
            F.max(n).alias(f"max_{short}_chars"),
            F.round(F.avg(n) / 4, 0).alias(f"avg_{short}_tokens"),
            F.count_if(n > limit).alias(f"{short}_exceeds_limit"),
        ]
    both = sum(lengths.values(), F.lit(0))
    return df.agg(*aggs, F.round(F.avg(both) / 4, 0).alias("avg_total_tokens"))


def length_by(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    aggs = [F.count("*").alias("count")]
    for col, short in columns.items():
        aggs += [
            F.round(F.avg(F.length(col)), 0).alias(f"avg_{short}_chars"),
            F.round(F.avg(F.length(col)) / 4, 0).alias(f"avg_{short}_tokens"),
        ]
    return df.groupBy(key).agg(*aggs).orderBy(F.desc("count"), key)


def duplicate_report(df: DataFrame, col: str) -> DataFrame:
    """Texts that occur more than once: how many, how many rows, and their share.

    Grouping is on a digest, so whole prompts are read but only digests are shuffled.
    """
    groups = df.groupBy(F.md5(F.col(col)).alias("_digest")).agg(F.count("*").alias("_n"))
    again = F.when(F.col("_n") > 1, F.col("_n"))
    return groups.agg(
        F.count(again).alias("num_duplicate"),
        F.sum(again).alias("total_duplicate_records"),
        share(F.coalesce(F.sum(again), F.lit(0)), F.sum("_n")).alias("pct_duplicates"),
    )


def pct_of(df: DataFrame, cond: Column, name: str = "pct") -> DataFrame:
    return df.agg(
        F.count_if(cond).alias("matching"), F.count("*").alias("total"),
        share(F.count_if(cond), F.count("*")).alias(name),
    )


def stack_columns(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], name: str, value: str) -> DataFrame:
    """One row per listed column instead of one column each; a single scan."""
    renamed = df.select(*keys, *[F.col(c).alias(label) for c, label in columns.items()])
    return renamed.unpivot(list(keys), list(columns.values()), name, value)


def latest_k(df: DataFrame, by: Sequence[str], ts: str, k: int, tie: str) -> DataFrame:
    """Newest ``k`` rows per key with their rank."""
    w = W.partitionBy(*by).orderBy(F.desc(ts), F.desc(tie))
    return df.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= k)


def text_report(row: DataFrame, lines: Sequence[Column], name: str = "report_section") -> DataFrame:
    """Turn one aggregated row into numbered text lines."""
    return row.select(F.posexplode(F.array(*lines)).alias("line_no", name))
