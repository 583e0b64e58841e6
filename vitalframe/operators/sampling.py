"""Deterministic splits and exact-size samples."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitalframe.operators.ranking import HASH_PREFIX, _offsets, hash_ranked, seeded_hash
from vitalframe.sources.tables import materialize, work_path


def hash_bucket(key: str, buckets: int = 10) -> Column:
    """Stable bucket number of an id, the same in every engine that has md5."""
    return F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("bigint") % buckets


def hash_split(df: DataFrame, key: str, buckets: int = 10, train: int = 8) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows by hashed id; no shuffle."""
    bucket = hash_bucket(key, buckets)
    return df.filter(bucket < train), df.filter(bucket >= train)


def with_split(df: DataFrame, key: str, buckets: int = 10, train: int = 8, name: str = "split") -> DataFrame:
    return df.withColumn(name, F.when(hash_bucket(key, buckets) < train, "train").otherwise("validation"))


def class_targets(df: DataFrame, label: str, n: int) -> DataFrame:
    """Rows to draw per class: ``n`` shared out by class size, halves rounded up."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("original_count"))
    everything = F.sum("original_count").over(W.partitionBy())
    target = F.expr(f"({2 * n} * original_count + everything) div (2 * everything)")
    return counts.withColumn("everything", everything).select(label, "original_count", target.alias("target"))


# A sample of at most so many rows is drawn with broadcasts.
BROADCAST_ROWS = 100_000


def drawn(table: DataFrame, n: int) -> DataFrame:
    """The table of what a sample of ``n`` rows draws, about ``n`` short rows at most, marked for broadcast if they are few."""
    return F.broadcast(table) if n <= BROADCAST_ROWS else table


def stratified_ids(df: DataFrame, label: str, n: int, key: str, seed: int = 0) -> DataFrame:
    """Ids of exactly the class targets, chosen by seeded hash order inside each class.

    Hash buckets are counted and buckets beyond a class's target are dropped before any sort or shuffle of
    rows. ``df`` is read twice; only its key and label are.
    """
    keyed = (
        df.filter(F.col(label).isNotNull())
        .select(key, label)
        .withColumn("_hash", seeded_hash(key, seed))
        .withColumn("_bucket", F.substring("_hash", 1, HASH_PREFIX))
    )
    offsets = _offsets(keyed, [label], ["_bucket"])
    everything = F.sum("_in_bucket").over(W.partitionBy())
    target = F.expr(f"({2 * n} * _group_rows + _everything) div (2 * _everything)")
    wanted = (
        offsets.withColumn("_everything", everything)
        .withColumn("_room", target - F.col("_before"))
        .filter("_room > 0")
        .select(label, "_bucket", "_room")
    )
    inside = F.row_number().over(W.partitionBy(label, "_bucket").orderBy("_hash", key))
    return (
        keyed.join(drawn(wanted, n), [label, "_bucket"])
        .withColumn("_inside", inside)
        .filter(F.col("_inside") <= F.col("_room"))
        .select(key)
    )


def stratified_sample(df: DataFrame, label: str, n: int, key: str, seed: int = 0) -> DataFrame:
    """Rows of ``stratified_ids``. ``df`` is read more than once, so hand in a written table when it is costly."""
    return df.join(drawn(stratified_ids(df, label, n, key, seed), n), key, "left_semi")


def sample_before(
    source: DataFrame, build: Callable[[DataFrame], DataFrame], label: str, n: int, key: str, seed: int = 0
) -> DataFrame:
    """The stratified sample of ``build(source)`` without building the rows that are not drawn.

    ``build`` must work row by row and keep ``key``, which identifies a row of ``source``. Only what the
    label needs is computed for all rows, and only ids and labels are written; the ids then cut
    ``source`` down before anything else is built. ``source`` is read twice, so hand in a written table.
    """
    labels = build(source).select(key, label)
    labels = materialize(labels, work_path(source.sparkSession, "labels"))
    return build(source.join(drawn(stratified_ids(labels, label, n, key, seed), n), key, "left_semi"))


def random_n(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """``n`` rows in seeded random order; each task keeps only its own best ``n``."""
    return df.orderBy(seeded_hash(key, seed), key).limit(n)


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    return df.orderBy(seeded_hash(key, seed), key)


def head_labeled(df: DataFrame, label: str, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows that carry a label."""
    return df.filter(F.col(label).isNotNull()).orderBy(*order).limit(n)


def stratified_split(
    df: DataFrame, label: str, weights: Sequence[tuple[str, int]], key: str, seed: int = 0, name: str = "split"
) -> DataFrame:
    """Named parts with the given integer weights inside every class, e.g. ``[("train", 8), ("test", 2)]``."""
    whole = sum(w for _, w in weights)
    out = hash_ranked(df.filter(F.col(label).isNotNull()), [label], key, seed, "_rank", "_rows")
    chain, upto = None, 0
    for part, weight in weights[:-1]:
        upto += weight
        cond = F.col("_rank") * whole <= F.col("_rows") * upto
        chain = F.when(cond, part) if chain is None else chain.when(cond, part)
    last = F.lit(weights[-1][0])
    return out.withColumn(name, last if chain is None else chain.otherwise(last)).drop("_rank", "_rows")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows in class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    everyone = W.partitionBy()
    total = F.sum("n").over(everyone).cast("double")
    classes = F.count("*").over(everyone).cast("double")
    return counts.select(label, "n", (total / (classes * F.col("n"))).alias("weight"))


def budget_check(datasets: Sequence[tuple[str, DataFrame]], epochs: int = 3, limit: int = 50000) -> DataFrame:
    """Rows, training steps and whether the steps fit; only the first dataset is trained on."""
    out = None
    for i, (name, df) in enumerate(datasets):
        steps = F.col("row_count") * epochs
        part = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("dataset"),
            "row_count",
            (steps if i == 0 else F.lit(None).cast("bigint")).alias("total_steps"),
            (F.when(steps <= limit, "under_limit").otherwise("over_limit") if i == 0 else F.lit("ok")).alias("status"),
        )
        out = part if out is None else out.unionByName(part)
    return out
