"""Repeated lines removed with levelled sorted runs of line digests.

Documents come in batches. Each batch is reduced to one entry per line key (number of documents,
largest id) and merge-anti-joined with the runs so far: keys that no run holds become a run of their
own, the others are kept as increments to the run that has them. A run is a table bucketed and sorted by
key; when a level holds FAN_OUT runs they are merged into one run of the next level. All steps after
the first shuffle of a batch read buckets that already fit each other.

A line's key is the line without blanks at both ends and with A-Z lower-cased; keys are compared by
128-bit digest. A key of at least LEAST_CHARS code points found in at least LEAST_DOCS documents
loses all its lines, except in the largest id that holds it.

Results for odd input: null and empty texts are one empty line, which stays; rows with equal ids
count as a document each and keep or lose lines alike; a null id is smaller than any other; an empty
table gives no rows; extra columns pass through where asked for, whatever their names (n_lines,
n_dropped and kept_text are then there twice).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe.llm.common import HOT_KEYS, SALTS, lower_ascii, written
from vitalframe.sources.tables import work_path

LEAST_CHARS = 40
LEAST_DOCS = 5
FAN_OUT = 4
BATCHES = 4
STRIP = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(STRIP))
    # plain lower() is much faster and means the same where every character is ASCII
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(lower_ascii(bare))


def long_digest(line: Column, least_chars: int) -> Column:
    """Digest of a line's key, null for keys that are too short to count."""
    key = line_key(line)
    return F.when(F.length(line) >= least_chars, F.when(F.length(key) >= least_chars, F.unhex(F.md5(key))))


class LineRuns:
    """Levels of sorted runs with columns key, docs and last_id, and increments to their entries.

    A key is in one run only, that of the batch which brought it; what later batches know of it is kept
    as increments. Most lines stand in one batch, so increments are few.
    """

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.increments: list[DataFrame] = []

    def bucketed(self, df: DataFrame, part: str | None = None) -> DataFrame:
        """Write as a table in the shared folder, one file per bucket (and part), sorted by key."""
        name = f"line_run_{uuid.uuid4().hex}"
        writer = df.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key")
        if part:
            writer = writer.partitionBy(part)
        writer.option("path", work_path(self.spark, name)).saveAsTable(name)
        return self.spark.table(name)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, entries: DataFrame) -> None:
        """Merge-anti-join the entries of a batch (key, docs, last_id; one row per key) with the runs:
        unseen keys become a run of their own, the rest increments; then compact."""
        marked, seen = entries, F.lit(False)
        for n, run in enumerate(self.runs()):
            marked = marked.join(run.select("key", F.lit(True).alias(f"seen_{n}")), "key", "left")
            seen = seen | F.col(f"seen_{n}").isNotNull()
        batch = self.bucketed(marked.select("key", "docs", "last_id", seen.alias("seen")), "seen")
        self._push(0, batch.where(~F.col("seen")).drop("seen"))
        self.increments.append(batch.where("seen").drop("seen"))

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_out:
            # keys of different runs differ, so a merge only sorts
            merged = reduce(DataFrame.unionByName, self.levels[level])
            self.levels[level] = []
            self._push(level + 1, self.bucketed(merged))

    def totals(self) -> DataFrame:
        """key, docs and last_id: every run's entries with their increments."""
        if not self.runs():
            raise ValueError("no batch was added")
        more = reduce(DataFrame.unionByName, self.increments).groupBy("key").agg(F.sum("docs").alias("more_docs"), F.max("last_id").alias("later_id"))
        docs = (F.col("docs") + F.coalesce("more_docs", F.lit(0))).alias("docs")
        whole = lambda run: run.join(more, "key", "left").select("key", docs, F.greatest("last_id", "later_id").alias("last_id"))
        return reduce(DataFrame.unionByName, map(whole, self.runs()))


def entries(docs: DataFrame, batches: int, least_chars: int, id_col: str, text: str) -> DataFrame:
    """batch, key, docs and last_id: one row per batch and key, counted before the shuffle."""
    digests = F.transform(F.split(F.col(text), "\n"), lambda line: long_digest(line, least_chars))
    found = F.explode(F.array_distinct(F.filter(digests, lambda d: d.isNotNull())))
    return (
        docs.select(F.pmod(F.xxhash64(id_col), F.lit(batches)).cast("int").alias("batch"), F.col(id_col).alias("id"), found.alias("key"))
        .groupBy("batch", "key")
        .agg(F.count("*").alias("docs"), F.max("id").alias("last_id"))
    )


def repeated_keys(docs: DataFrame, least_docs: int, least_chars: int, batches: int, id_col: str, text: str) -> DataFrame:
    """Keys found in enough documents, with their number and the largest id that holds each."""
    store = LineRuns(docs.sparkSession)
    dealt = store.bucketed(entries(docs, batches, least_chars, id_col, text), "batch")
    for batch in range(batches):
        store.add(dealt.where(F.col("batch") == batch).drop("batch"))
    return written(store.totals().where(F.col("docs") >= least_docs), "repeated-lines")


def drop_repeated(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    batches: int = BATCHES,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The kept columns, n_lines, n_dropped and kept_text (the lines that stay, joined by line feeds)."""
    repeated = repeated_keys(docs, least_docs, least_chars, batches, id_col, text)
    # the caller's columns travel in a struct, so that their names meet none of those made here
    docs = docs.select(F.struct(*keep).alias("_row"), F.col(id_col).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # rows with equal id and text lose the same lines, so this pair finds a document again
    docs = docs.withColumn("_text_hash", F.xxhash64("_text"))
    digest = lambda line: long_digest(line, least_chars)
    digests = F.filter(F.transform(F.split("_text", "\n"), digest), lambda d: d.isNotNull())
    held = docs.select("_id", "_text_hash", F.explode(F.array_distinct(digests)).alias("key"))
    # a key with over 1/HOT_KEYS of the repeated entries is split; there are at most HOT_KEYS of them
    every = repeated.agg(F.sum("docs").alias("every"))
    hot = repeated.join(F.broadcast(every), F.col("docs") * HOT_KEYS > F.col("every")).select("key", F.lit(SALTS).alias("salts"))
    split = lambda df: df.join(F.broadcast(hot), "key", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    held = split(held).withColumn("salt", F.pmod(F.xxhash64("_id", "_text_hash"), F.col("salts")).cast("int")).drop("salts")
    repeated = split(repeated).select("key", "last_id", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    lost = F.coalesce(F.col("_id") < F.col("last_id"), F.col("last_id").isNotNull())
    drops = (
        held.join(repeated, ["key", "salt"]).where(lost)
        .groupBy(F.col("_id").alias("_of_id"), F.col("_text_hash").alias("_of_hash"))
        .agg(F.collect_set("key").alias("_drop"))
    )
    same = F.col("_id").eqNullSafe(F.col("_of_id")) & (F.col("_text_hash") == F.col("_of_hash"))
    joined = docs.join(drops, same, "left").withColumn("_lines", F.split("_text", "\n"))
    stays = F.filter("_lines", lambda line: ~F.coalesce(F.array_contains(F.col("_drop"), digest(line)), F.lit(False)))
    joined = joined.withColumn("_stays", F.when(F.col("_drop").isNull(), F.col("_lines")).otherwise(stays))
    return joined.select(
        *(F.col("_row")[c].alias(c) for c in keep),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_stays")).cast("long").alias("n_dropped"),
        F.array_join("_stays", "\n").alias("kept_text"),
    )
