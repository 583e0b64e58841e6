"""Exact ranks without funnelling a large group through one task.

A plain ``row_number`` sorts each partition of its window in a single task, so an unpartitioned
window, or one hot key, does not scale.  Here rows are first put into many small buckets whose
order agrees with the wanted order.  Counting the buckets is a partially aggregated ``groupBy``;
the running sum over the bucket counts gives each bucket its offset, and rows are only sorted
inside their bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.operators.cleaning import dedupe

# Hash buckets: four hexadecimal digits, at most 65,536 buckets per group.
HASH_PREFIX = 4
# Digits that split the rows of one time; rows without a time may be a large part of a table.
TIME_PREFIX = 2
# Buckets of more rows than this are thinned out where they lie, and rows of one task, where rows are
# made distinct and numbered.
HOT_ROWS = 100_000
TASK_ROWS = 1_000_000


def row_hash(columns: Sequence[str]) -> Column:
    """Engine-independent digest of the named columns."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def seeded_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def _offsets(df: DataFrame, groups: Sequence[str], buckets: Sequence[str]) -> DataFrame:
    """Rows before each bucket of its group, with the bucket's own count and the group's total."""
    counts = df.groupBy(*groups, *buckets).agg(F.count("*").alias("_in_bucket"))
    in_group = W.partitionBy(*groups)
    before = in_group.orderBy(*buckets).rowsBetween(W.unboundedPreceding, -1)
    return counts.select(
        *groups,
        *buckets,
        "_in_bucket",
        F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)).alias("_before"),
        F.sum("_in_bucket").over(in_group).alias("_group_rows"),
    )


def ranked(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    name: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """``row_number`` over ``groups`` ordered by ``order`` (ascending), computed bucket by bucket.

    ``bucket`` is a text that never falls while ``order`` rises; NULL counts as the smallest.
    NULL group values form a group of their own, as they do in a window.
    """
    keyed = df.withColumn("_bucket", F.coalesce(bucket, F.lit("")))
    keys = list(groups)
    if any(df.schema[g].nullable for g in groups):
        # Fields of equal structs may be NULL, so an ordinary equi-join keeps NULL groups.
        keyed = keyed.withColumn("_group", F.struct(*groups))
        keys = ["_group"]
    offsets = _offsets(keyed, keys, ["_bucket"])
    inside = W.partitionBy(*keys, "_bucket").orderBy(*order)
    out = (
        keyed.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [*keys, "_bucket"])
        .withColumn(name, F.col("_before") + F.col("_inside"))
    )
    if total:
        out = out.withColumn(total, F.col("_group_rows"))
    return out.drop("_group", "_bucket", "_inside", "_in_bucket", "_before", "_group_rows")


def hash_ranked(
    df: DataFrame, groups: Sequence[str], key: str, seed: int, name: str = "rank", total: str | None = None
) -> DataFrame:
    """Seeded random rank inside each group; ``key`` must identify a row."""
    hashed = df.withColumn("_hash", seeded_hash(key, seed))
    out = ranked(hashed, groups, ["_hash", key], F.substring("_hash", 1, HASH_PREFIX), name, total)
    return out.drop("_hash")


def surrogate_id(df: DataFrame, prefix: str, identity: Sequence[str], name: str = "patient_id") -> DataFrame:
    """``prefix1 .. prefixN`` in the order of the digest of ``identity``, which must be unique.

    The digest spreads rows evenly over the buckets whatever the data look like.
    """
    keyed = df.withColumn("_hash", row_hash(identity)).withColumn("_all", F.lit(0))
    out = ranked(keyed, ["_all"], ["_hash"], F.substring("_hash", 1, HASH_PREFIX), "_id")
    return out.withColumn(name, F.concat(F.lit(prefix), F.col("_id").cast("string"))).drop("_hash", "_all", "_id")


def distinct_surrogate_id(
    df: DataFrame, keys: Sequence[str], prefix: str, identity: Sequence[str], name: str = "patient_id"
) -> DataFrame:
    """``surrogate_id`` of ``dedupe`` by ``keys``, with one shuffle of the rows; ``identity`` must be among the keys.

    Rows of one key share the digest bucket of their identity, so rows that lie by bucket are made
    distinct and numbered in place. One pass counts the buckets first: rows of a large one, such as
    those of a key with a large part of the table, pass ``dedupe`` before they are moved.
    """
    zero = {f.name: F.when(F.col(f.name) == 0, F.lit(0).cast(f.dataType)).otherwise(F.col(f.name))
            for f in df.schema if f.name in keys and isinstance(f.dataType, T.FractionalType)}  # -0.0 is the same key
    df = df.withColumns(zero) if zero else df
    rows = df.withColumn("_bucket", F.substring(row_hash(identity), 1, HASH_PREFIX))
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    total, most = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    if most > HOT_ROWS:
        hot = F.broadcast(sizes.where(F.col("_n") > HOT_ROWS).select("_bucket"))  # at most 65,536 rows
        thinned = dedupe(rows.join(hot, "_bucket", "left_semi"), ["_bucket", *keys])
        rows = rows.join(hot, "_bucket", "left_anti").unionByName(thinned)
    wanted = -(-total // TASK_ROWS)
    few = wanted <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unique = dedupe(rows.repartition("_bucket") if few else rows.repartition(wanted, "_bucket"), ["_bucket", *keys])
    before = _offsets(unique.withColumn("_all", F.lit(0)), ["_all"], ["_bucket"]).select("_bucket", "_before")
    inside = F.row_number().over(W.partitionBy("_bucket").orderBy("_hash"))
    out = unique.withColumn("_hash", row_hash(identity)).withColumn("_inside", inside).join(before, "_bucket")
    number = (F.col("_before") + F.col("_inside")).cast("string")
    return out.select(*df.columns, F.concat(F.lit(prefix), number).alias(name))


def surrogate_id_by_time(
    df: DataFrame, prefix: str, ts: str, identity: Sequence[str], name: str = "patient_id"
) -> DataFrame:
    """As ``surrogate_id``, but ids rise with ``ts`` (NULL last); equal times go by digest.

    Days bound the table of running day totals; inside a day the buckets are the distinct times split
    256 ways by digest, and rows without a time split 65,536 ways, so neither a day nor a minute nor a
    large share of missing times is sorted by one task alone.
    """
    last = F.to_timestamp(F.lit("9999-12-31 00:00:00"))
    keyed = (
        df.withColumn("_ts", F.coalesce(F.col(ts), last))
        .withColumn("_day", F.to_date("_ts"))
        .withColumn("_hash", row_hash(identity))
        .withColumn("_split", F.when(F.col(ts).isNull(), F.substring("_hash", 1, HASH_PREFIX)).otherwise(F.substring("_hash", 1, TIME_PREFIX)))
    )
    buckets = ["_day", "_ts", "_split"]
    in_day = _offsets(keyed, ["_day"], ["_ts", "_split"])
    days = keyed.groupBy("_day").agg(F.count("*").alias("_day_rows"))
    running = W.orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    days = days.select("_day", F.coalesce(F.sum("_day_rows").over(running), F.lit(0)).alias("_day_before"))
    out = (
        keyed.withColumn("_inside", F.row_number().over(W.partitionBy(*buckets).orderBy("_hash")))
        .join(in_day, buckets)
        .join(days, "_day")
    )
    number = F.col("_day_before") + F.col("_before") + F.col("_inside")
    return out.withColumn(name, F.concat(F.lit(prefix), number.cast("string"))).drop(
        *buckets, "_hash", "_inside", "_in_bucket", "_before", "_group_rows", "_day_before"
    )


def top_k(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """First ``k`` rows per group.  Spark limits each map partition before the shuffle."""
    w = W.partitionBy(*groups).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
