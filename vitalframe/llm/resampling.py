"""Importance resampling toward a target: hashed n-gram features in Arrow kernels.

A batch of texts is lower-cased (A-Z), split, flattened and dictionary-encoded by Arrow; the indices,
shifted by one and two places within a document, form word pairs and triples. Each distinct word, pair
and triple of the batch is hashed once (the CRC of a longer run goes on from that of the shorter one)
and taken back to its places. One pass counts the buckets of a table; from the counts of corpus and
target every bucket gets a gain, and a second pass takes the gains and adds them up per document.
Ranks come from ranges of (score, id): range counts, their running sum, and a rank inside the range.

Results for odd input: null and empty texts have no features and weight 0; rows with a null id are
counted and weighed, but have no score and are never drawn; repeated rows count, and are drawn, each;
ties go to the smaller id; texts of any length are read whole; an empty corpus gives no rows, an empty
target counts as no features; extra columns play no part, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.common import written

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
# What is neither a digit, nor a small ASCII letter, nor beyond ASCII separates words.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Texts are cut into features this many characters at a time; a longer text is a batch of its own.
PART_CHARS = 1 << 20


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes, return_inverse=True)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature of a batch, the row it belongs to, and the number of words of each row."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BETWEEN_WORDS)
    flat, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(flat, "")
    coded = flat.filter(full).dictionary_encode()
    row = row.filter(full).to_numpy().astype(np.int64)
    word = coded.indices.to_numpy().astype(np.int64)
    spelled = coded.dictionary.cast(pa.binary()).to_pylist()
    continued = [b" " + w for w in spelled]
    crc = [zlib.crc32(w) for w in spelled]
    found, owners = [np.array(crc, np.uint32).take(word) if len(word) else np.zeros(0, np.uint32)], [row]
    run, run_crc = word, crc
    for shift in (1, 2):
        # runs that start at the same place in the same document, longer by one word
        same = row[shift:] == row[: len(row) - shift] if len(row) > shift else np.zeros(0, bool)
        codes = run[: len(same)][same] * len(spelled) + word[shift:][same]
        kinds, place = _distinct(codes)
        longer = [zlib.crc32(continued[w], run_crc[r]) for r, w in zip((kinds // max(1, len(spelled))).tolist(), (kinds % max(1, len(spelled))).tolist())]
        found.append(np.array(longer, np.uint32)[place] if len(place) else np.zeros(0, np.uint32))
        owners.append(row[: len(same)][same])
        run = np.zeros(len(row), np.int64)
        run[: len(same)][same] = place
        run_crc = longer
    return np.concatenate(found).astype(np.int64), np.concatenate(owners), np.bincount(row, minlength=len(texts))


def _parts(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of rows whose texts together stay near PART_CHARS, so that long texts do not add up."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for n, length in enumerate(lengths.tolist()):
        if held and held + length > PART_CHARS:
            yield start, texts.slice(start, n - start)
            start, held = n, 0
        held += length
    if start < len(texts):
        yield start, texts.slice(start)


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in _parts(batch.column(0)):
                held += np.bincount(features(part)[0] % buckets, minlength=buckets)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], names=["bucket", "n"])

    return texts.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket from the counts of corpus and target; one number per bucket comes to the driver."""
    spark = corpus.sparkSession
    both = spark.range(buckets).select(F.col("id").alias("bucket")).join(corpus.select("bucket", F.col("n").alias("s")), "bucket", "left")
    # written once, as both the gains and the sums are made from them
    both = written(both.join(target.select("bucket", F.col("n").alias("t")), "bucket", "left").fillna(0), "bucket-counts")
    sums = both.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("all_s"), F.coalesce(F.sum("t"), F.lit(0)).alias("all_t"))
    double = lambda c, more: (F.col(c) + F.lit(more)).cast("double")
    ratio = double("t", 1) * double("all_s", buckets) / (double("s", 1) * double("all_t", buckets))
    rows = both.join(F.broadcast(sums)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))  # one row
    return [r["gain"] for r in sorted(rows.collect(), key=lambda r: r["bucket"])]


def weigh(docs: DataFrame, gain: list[int], text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, n_words, n_features and weight (sum of the gains of all features) of every row."""
    table = np.array(gain, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in _parts(batch.column(1)):
                crc, owner, words = features(part)
                order = np.argsort(owner, kind="stable")
                number = np.bincount(owner, minlength=len(part))
                weight = np.zeros(len(part), np.int64)
                some = np.flatnonzero(number)
                if len(some):
                    starts = np.concatenate([[0], np.cumsum(number[some])[:-1]])
                    weight[some] = np.add.reduceat(table.take(crc[order] % len(table)), starts)
                made = [pa.array(c, pa.int64()) for c in (words, number, weight)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(part)), *made], names=["id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def noise(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, fixed by seed and id; null for a null id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Add rank (1, 2, ... by falling score, then rising id) to the drawn rows; all others have null.

    Drawn are percent of the rows with a score and enough words. Rows are small here; they go to ranges
    of (score, id, a spread), which are written so that counts and ranks see the same ranges.
    """
    n = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    takes_part = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    rows = scored.withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.desc("score"), F.col("id"), F.col("spread")]
    part = rows.where(takes_part).repartitionByRange(n, *order).withColumn("range", F.spark_partition_id())
    part = written(part, "score-ranges")
    counts = part.groupBy("range").agg(F.count("*").alias("held"))
    # one small row per range in this window
    before = F.sum("held").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("range", F.coalesce(before, F.lit(0)).alias("before"), F.sum("held").over(Window.partitionBy()).alias("all_rows"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    place = part.withColumn("inside", inside).join(counts, "range").withColumn("place", F.col("before") + F.col("inside"))
    drawn = F.when(100 * F.col("place") <= percent * F.col("all_rows"), F.col("place"))
    shown = ["id", "n_words", "n_features", "weight", "score"]
    return place.select(*shown, drawn.alias("rank")).unionByName(scored.where(~takes_part).select(*shown, F.lit(None).cast("long").alias("rank")))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
    seed: int = SEED, text: str = "text", id_col: str = "doc_id", target_text: str = "text",
) -> DataFrame:
    """Every document's id, n_words, n_features, weight, score and rank (null where it is not drawn)."""
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets), buckets)
    scored = written(weigh(docs, gain, text, id_col).withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scores")
    return ranked(scored, percent, least_words).withColumnRenamed("id", id_col)
